"""Readers: raw files, mapping files, manifests, snapshots."""
