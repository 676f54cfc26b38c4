"""Work on streams."""
