"""Marts, serving queries and end-to-end jobs."""
