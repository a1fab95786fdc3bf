"""Readers: manifests, images, masks and legacy array files."""
