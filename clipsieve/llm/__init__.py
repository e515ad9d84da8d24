"""Operators that prepare speech-and-text corpora for model training.

Nothing outside this folder imports it; ``__spark_entry__`` adds its queries only when the import works.
"""
