"""Readers and writers of corpora, splits, archives, media lengths, logs and records."""
