"""Nasaq: curation of synthetic text datasets, expressed as Spark plans."""
