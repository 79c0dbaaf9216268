"""Flows as chains of DataFrame steps, and the registered queries."""
