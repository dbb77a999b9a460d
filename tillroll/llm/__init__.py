"""Training-data operators: tokenisation, deduplication, decontamination,
filters, extraction and packing over the corpus tables.

Nothing else in ``tillroll`` imports this package; its registered queries are
in :mod:`tillroll.llm.queries`.
"""
