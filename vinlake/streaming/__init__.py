"""The address drop as a stream of files."""
