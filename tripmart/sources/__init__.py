"""Inputs: trip files, zone lookup, file metadata, quality summaries."""
