"""Incremental arrival of raw trip files."""
