"""Whole plans: building an edition, the query catalogue on the driver tables, and its SQL."""
