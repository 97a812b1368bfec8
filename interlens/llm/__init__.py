"""Training-data operators: decontamination, packing, quality, licences, WARC,
toxicity, personal data, near-duplicate joins, substring deduplication, vector
codes, Merkle manifests and SimHash near duplicates.

Nothing outside this folder, ``tests/llm`` and ``corpus_pipeline.py`` imports it.
"""
