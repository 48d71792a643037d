"""All registered queries."""

from loomstat.plans import (  # noqa: F401
    clean_queries,
    closed_queries,
    model_queries,
    report_queries,
    stream_queries,
    table_queries,
    text_queries,
    topic_queries,
)
from loomstat.plans.catalog import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
