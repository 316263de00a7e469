"""functions of textlab."""
