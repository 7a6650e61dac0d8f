"""Operators that prepare training text, their queries and the SQL to compare them with."""
