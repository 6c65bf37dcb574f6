"""Operators for preparing training data: packing, extraction, filtering,
deduplication and formatting. Nothing else in the library imports this
subpackage; its registered queries are in ``mercato.llm.queries``.
"""
