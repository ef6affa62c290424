"""kiln — a PySpark gold-layer toolkit.

Turns messy operational extracts (all-text raw tables) into standardised
staging views, deduplicated dimensions, flagged facts, derived marts and
data-quality reports, using only DataFrame / SQL operators so the same code
runs on a laptop sample and on a cluster.
"""

__all__ = ["session", "functions", "operators", "sources", "plans", "streaming"]
