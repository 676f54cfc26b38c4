"""Readers and writers of the formats the pipeline meets."""
