"""Tables and models in files."""
