"""Whole jobs put together from the operators, and the checked query list."""
