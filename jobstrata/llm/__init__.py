"""Operators for preparing training text at scale: filtering, near-duplicates, extraction, tokenising, archives."""
