"""Reading landed files."""
