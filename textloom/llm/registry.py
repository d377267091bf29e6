"""The queries of this package, and SQL for those that SQL can express."""

from __future__ import annotations

import corpus_pipeline
from textloom.llm import ann, bpe, html, katz, langid, mixing, neardup_vectors, simhash, substring, toxicity

QUERIES = {**katz.QUERIES, **langid.QUERIES, **substring.QUERIES, **neardup_vectors.QUERIES, **ann.QUERIES, **toxicity.QUERIES, **bpe.QUERIES, **simhash.QUERIES, **html.QUERIES, **mixing.QUERIES, "pipeline": corpus_pipeline.run}
ORACLE_SQL: dict[str, str] = {**substring.ORACLE_SQL, **neardup_vectors.ORACLE_SQL}
