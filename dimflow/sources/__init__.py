"""Readers, table writers and the shared work folder."""
