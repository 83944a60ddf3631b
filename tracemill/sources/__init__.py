"""Readers and writers of dataset directories, manifests and reports."""
