"""Operators put together: the two feeds, the search screen, checked queries."""
