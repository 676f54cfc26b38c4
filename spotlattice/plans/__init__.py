"""Runs of several stages."""
