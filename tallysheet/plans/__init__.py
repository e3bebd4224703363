"""Operators put together: the fact build, the monthly loads and the refresh groups."""
