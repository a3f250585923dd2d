"""All named queries; importing the package registers them."""

from tidemill.queries import (  # noqa: F401
    corpus_queries,
    evaluation_queries,
    feature_queries,
    source_queries,
    stream_queries,
    trend_queries,
    trial_queries,
)
from tidemill.queries.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
