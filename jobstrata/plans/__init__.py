"""The two batch stages and the reports on their tables."""
