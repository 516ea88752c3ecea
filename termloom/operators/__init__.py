"""Operators on document collections and matrices."""
