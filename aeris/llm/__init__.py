"""Operators for training-data pipelines: URL reputation, near-duplicate joins, exact top-k
search, quality rules, source mixing, language models, classifiers, sharding and packing.

Nothing outside this subpackage (and ``corpus_pipeline.py``) imports it. Each operator has a
general interface of its own; :mod:`aeris.llm.catalog` applies it to its table as a query.
"""
