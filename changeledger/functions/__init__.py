"""Column expressions: canonical form, tokens, decoding and status rules."""
