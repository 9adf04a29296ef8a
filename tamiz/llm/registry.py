"""The queries of this subpackage and their SQL."""

from __future__ import annotations

from tamiz.llm import credentials, fingerprints, lexical, licenses, linededup, minhash, mixing, negatives, packing, pii, quality, substrings, toxicity

MODULES = [mixing, quality, substrings, toxicity, linededup, licenses, pii, packing, minhash, fingerprints, negatives, lexical, credentials]
QUERIES = {name: query for module in MODULES for name, query in module.QUERIES.items()}
ORACLES = {name: sql for module in MODULES for name, sql in module.ORACLES.items()}
