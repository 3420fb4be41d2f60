"""Readers for raw files and for the tables the streams write."""
