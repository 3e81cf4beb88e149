"""Scoring of file streams."""
