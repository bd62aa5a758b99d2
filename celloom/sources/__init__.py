"""Readers, and the raw landing they feed."""
