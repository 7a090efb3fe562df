"""Readers: raw dumps, dump listings, layered tables, and the star-schema feed."""
