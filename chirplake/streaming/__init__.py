"""Structured Streaming wiring and progress monitoring."""
