"""Warehouse jobs, each a function from input frames to one output frame."""
