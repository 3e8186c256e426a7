"""Training-data operators: dedup, filters, extraction, mixing, tokenisation.

Nothing else in ``loam`` imports this subpackage; ``__spark_entry__`` adds its
queries when it can be imported.
"""
