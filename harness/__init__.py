"""Binds the driver's tables to the library and lists the checked queries."""
