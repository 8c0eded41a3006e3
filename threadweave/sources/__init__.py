"""Readers (driver tables, month folders, fixture views) and sinks."""
