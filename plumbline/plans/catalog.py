"""Importing this module fills the registry."""

from plumbline.plans import fact_queries, gate_queries, match_queries, page_queries, segment_queries, source_queries, stream_queries, structured_queries, text_queries, verify_queries  # noqa: F401
from plumbline.plans.registry import ORACLES, QUERIES, SURVEY_IDS  # noqa: F401
