"""Column expressions: lifecycle rules and web-target checks."""
