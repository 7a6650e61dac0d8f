"""Operators put together: the lake, its refresh, the cohort run, the registered queries."""
