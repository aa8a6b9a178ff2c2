"""Composed flows and the registry of driver-table queries."""
