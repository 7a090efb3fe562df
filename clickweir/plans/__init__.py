"""Whole jobs that read and write layers."""
