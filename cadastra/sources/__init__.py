"""Readers and writers of every layer."""
