"""streaming of textlab."""
