"""DataFrame to DataFrame operators over words, fields, matches and form items."""
