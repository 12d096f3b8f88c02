"""The batch stages over newly landed files."""
