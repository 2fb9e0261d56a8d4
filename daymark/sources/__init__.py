"""Readers, payload parsing, manifests and publishing."""
