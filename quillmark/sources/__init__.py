"""Where words, fields and documents come from."""
