"""The same stages over streams of files."""
