"""Incremental builds."""
