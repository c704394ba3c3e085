"""Whole-run plans and the registry of named check queries."""
