"""Chains of operators, and the registered queries over the test tables."""
