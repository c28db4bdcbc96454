"""Scalar building blocks: money arithmetic, JSON fields, calendar helpers."""
