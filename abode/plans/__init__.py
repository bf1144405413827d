"""Programmes built from the operators, and the driver-table query catalogue."""
