"""DataFrame operators over taxa and synonyms."""
