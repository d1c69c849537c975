"""Inputs, queries and independent SQL that check the operators on the given tables."""
