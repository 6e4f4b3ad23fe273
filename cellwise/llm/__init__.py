"""Training-data operators over document tables.

Operators on ``documents(doc_id, text, ...)``: language ID, toxicity,
quality, LM scoring, BPE, near, exact and line deduplication, token files,
benchmark decontamination and the divergence of sources; WARC archives of pages;
codes of embedding vectors. Each module holds one operator; ``queries``
registers them, and ``corpus_pipeline.py`` at the repository top chains five.
Nothing else in the library imports this package.
"""
