"""Queries registered with the driver, each with the SQL that must give the same result."""
