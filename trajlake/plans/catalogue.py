"""All queries of the reference's operators."""

from trajlake.plans import artifact_queries, corpus_queries, durable_queries, evaluation_queries, job_queries, planning_queries, record_queries, release_queries, replay_queries, source_queries, strict_queries, trace_queries  # noqa: F401
from trajlake.plans.registry import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
