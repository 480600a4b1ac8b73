"""Readers and writers of corpora, queries, snapshots and results."""
