"""Readers: archive containers, logs, indexes, rules and lookups."""
