"""Reporting views and the load of each source."""
