"""All registered queries of the library and their SQL."""

from __future__ import annotations

from . import corpus, corpus_sql, oracle, queries

QUERIES = queries.QUERIES | corpus.QUERIES
SQL = oracle.SQL | corpus_sql.SQL
