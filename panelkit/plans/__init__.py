"""Whole flows: raw tables to feature table, feature table to chosen model."""
