"""Core relational operators."""
