"""Readers and writers for catalogue files, responses, state and datasets."""
