"""Landed pages and lookup answers -> typed rows."""
