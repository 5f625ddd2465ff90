"""Readers for import layouts, object manifests, logs and catalogues."""
