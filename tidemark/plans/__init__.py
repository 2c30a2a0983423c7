"""Whole loads composed from the operators, and the registered queries."""
