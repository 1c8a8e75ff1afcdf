"""Whole jobs, made of the operators and named after the question they answer."""
