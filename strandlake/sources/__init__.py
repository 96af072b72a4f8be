"""Readers: a folder of text files to one typed table."""
