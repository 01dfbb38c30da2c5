"""Column expressions over messages, headers and offsets."""
