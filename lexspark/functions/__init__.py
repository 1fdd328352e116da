"""Column functions: identifiers, text, markup."""
