"""Column functions: text, tokens, language."""
