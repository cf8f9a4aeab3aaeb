"""Dimensions, facts, marts and the daily load, built from the operators."""
