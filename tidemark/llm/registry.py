"""The named queries of this package and their SQL."""

from __future__ import annotations

import corpus_pipeline

from . import chat, collocations, decontaminate, embedding_dedup, jaccard_join, line_dedup, lm_score, packing, pii, quality, quality_rules, warc, whitening

MODULES = [embedding_dedup, jaccard_join, warc, decontaminate, chat, packing, line_dedup, lm_score, quality, pii, quality_rules, whitening, collocations]
QUERIES = {k: v for m in MODULES for k, v in m.QUERIES.items()} | {"pipeline": corpus_pipeline.run}
SQL = {k: v for m in MODULES for k, v in m.SQL.items()}
if corpus_pipeline.ORACLE_SQL:
    SQL["pipeline"] = corpus_pipeline.ORACLE_SQL
