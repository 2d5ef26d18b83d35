"""Readers: signature archives and JSON, raw vectors, FASTA, hash sets, listings."""
