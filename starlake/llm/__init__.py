"""Training-data operators: token counts, WARC archives, near-duplicates, secrets, quality,
personal data, chat trees, packing and decontamination.

Each module holds one operator with a general interface; ``queries.py`` derives the registered
queries from them. Nothing else in the library imports this subpackage.
"""
