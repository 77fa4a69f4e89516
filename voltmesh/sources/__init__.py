"""Readers for landed feeds, text files, tables and object listings."""
