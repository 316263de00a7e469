"""sources of textlab."""
