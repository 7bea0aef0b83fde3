"""Whole tables and runs, composed from the operators."""
