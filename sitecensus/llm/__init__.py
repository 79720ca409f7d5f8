"""Training-data operators: packing, classifiers, extraction, filters, search and deduplication.

Nothing outside this package imports it; ``__spark_entry__.py`` adds its queries only if it is there.
"""
