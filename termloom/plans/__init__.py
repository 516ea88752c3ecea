"""Specification, sizes and the plans built from them."""
