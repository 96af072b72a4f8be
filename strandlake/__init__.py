"""Comparative-genomics tables and training-data operators as Spark jobs."""
