"""Readers, writers and the landed-page source."""
