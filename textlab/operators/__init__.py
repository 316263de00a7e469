"""operators of textlab."""
