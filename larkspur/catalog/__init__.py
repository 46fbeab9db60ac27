"""The registered queries; importing this package fills the registry."""

from larkspur.catalog import (  # noqa: F401
    attempt_queries, frame_queries, log_queries, model_queries, stream_queries)
from larkspur.catalog.base import QUERIES, SQL  # noqa: F401
