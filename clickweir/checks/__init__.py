"""Registered queries over the star-schema feed, and the same queries as plain SQL."""
