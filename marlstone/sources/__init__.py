"""Readers, writers and the page parser."""
