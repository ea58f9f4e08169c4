"""Readers and writers of logs, catalogues and reports."""
