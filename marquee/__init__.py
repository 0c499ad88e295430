"""Catalogue features and nomination prediction as Spark jobs."""
