"""Seamark sources."""
