"""Landed payloads, stored tables and log tables."""
