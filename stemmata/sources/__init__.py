"""Readers: XML dialects, JSON side data, TEI morphology, stored datasets."""
