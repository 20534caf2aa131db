"""Column functions: no action, no DataFrame, safe inside any projection."""
