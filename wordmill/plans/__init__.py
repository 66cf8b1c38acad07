"""Whole builds, and the queries of the driver."""
