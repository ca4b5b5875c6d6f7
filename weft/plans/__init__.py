"""Queries over the driver tables, with the SQL they are held against."""
