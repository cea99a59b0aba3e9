"""Papyrine: curation and analysis of research-text corpora as Spark jobs."""
