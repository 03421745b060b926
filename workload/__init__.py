"""Queries over the driver's tables, one per operator, and the SQL they must agree with."""
