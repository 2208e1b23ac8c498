"""Training-data pipeline operators (dedup, decontamination, language ID,
extraction, tokenisation) as Spark jobs.

Each module holds one operator with its own general interface; ``queries``
registers the thin ``opN_`` queries over the benchmark tables and
``corpus_pipeline.py`` at the repository top chains five of them. Nothing
outside this subpackage imports it, except ``__spark_entry__.py`` (guarded).
"""
