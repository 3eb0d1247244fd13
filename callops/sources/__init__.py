"""Readers of landed feeds and layer tables."""
