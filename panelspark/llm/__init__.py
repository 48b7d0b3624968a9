"""Training-data operators (language ID, de-duplication, tokens, packing, ...).

Nothing outside this folder, ``corpus_pipeline.py`` and the guarded part of
``__spark_entry__.py`` imports it.  Operators take DataFrames and column
names; ``catalog`` registers one query per operator.
"""
