"""Column functions: text, geometry, seeded draws."""
