"""Readers, writers and validators of the file formats."""
