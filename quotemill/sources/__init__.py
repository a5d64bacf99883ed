"""Readers and writers of the layered tables."""
