"""Training-data operators: tokens, filters, archives, near duplicates, classifiers, packing.

Nothing else in the library imports this subpackage; it can be deleted with
``tests/llm`` and ``corpus_pipeline.py`` and the rest goes on working.
"""
