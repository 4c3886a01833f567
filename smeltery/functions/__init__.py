"""Column expressions: tolerant typing, exact money, masking and calendars."""
