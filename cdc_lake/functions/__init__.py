"""Column-level functions: rules, names, time and text."""
