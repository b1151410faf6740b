"""The catalogue of named queries and their SQL."""

from . import document_queries, record_queries, retrieval_queries

_PARTS = (retrieval_queries, document_queries, record_queries)
QUERIES: dict = {k: v for part in _PARTS for k, v in part.QUERIES.items()}
ORACLE: dict = {k: v for part in _PARTS for k, v in part.ORACLE.items()}
