"""Training-data operators. Nothing outside this package imports it (``corpus_pipeline.py`` belongs to it)."""
