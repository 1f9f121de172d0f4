"""Picking up files as they arrive."""
