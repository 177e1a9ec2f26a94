"""Stages put together into a lake, and the registered queries."""
