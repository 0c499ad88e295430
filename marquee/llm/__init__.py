"""Operators for training-data pipelines: tokens, packing, duplicates, quality, licences, language-model scores, neighbours."""
