"""Incremental processing. The data arrives as whole months, so increments are
partitions handled in batch jobs; there is no event-time stream to keep state for."""
