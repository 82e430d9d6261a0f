"""Operators that a large training-data pipeline needs; nothing else in glyphmill imports this subpackage."""
