"""Seamark operators."""
