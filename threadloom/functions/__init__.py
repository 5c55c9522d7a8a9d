"""Column functions.  All of them are built-in Catalyst expressions."""
