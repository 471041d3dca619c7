"""Layered jobs built from the operators, and the list of registered queries."""
