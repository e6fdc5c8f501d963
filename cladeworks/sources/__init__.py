"""Readers and writers of sequence, hit, tree and report files."""
