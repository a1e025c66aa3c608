"""Readers of landed files and writers of result files and tables."""
