"""Readers and writers of files and catalog tables."""
