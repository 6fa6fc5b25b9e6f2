"""Repeated polls expressed as available-now streams."""
