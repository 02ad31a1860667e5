"""Readers: file manifests, status and analysis files, markup tables, images."""
