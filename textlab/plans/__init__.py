"""plans of textlab."""
