"""Readers and writers of the table and report formats."""
