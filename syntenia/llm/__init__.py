"""Training-data operators: dedup, decontamination, filtering, mixing, sharding.

Nothing else in the library imports this subpackage; its queries are listed in
``syntenia.llm.registry``.
"""
