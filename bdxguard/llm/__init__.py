"""Operators for preparing training corpora: near-duplicates, fingerprints, language, quality, toxicity,
chat rendering, packing, token shards and byte-level BPE, each a ``DataFrame -> DataFrame`` function.

Nothing else in the library imports this subpackage.
"""
