"""Gold-layer model plans (staging, dimensions, facts, marts, data quality) and the DAG."""

from . import dag, dims, facts, marts, quality, staging  # noqa: F401
