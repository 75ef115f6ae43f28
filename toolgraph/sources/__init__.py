"""Readers and writers of catalogues, conversations, checkpoints and score tables."""
