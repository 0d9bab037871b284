"""Physical-plan guards: broadcast only behind a size check.

``bounded_broadcast`` counts an already materialised (cached or
checkpointed) side and adds a broadcast hint only when the row count is
below the bound; above it the plain join is left to Catalyst/AQE, which
will plan a shuffle (sort-merge or shuffled hash) join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Rows a side may have before we stop hinting a broadcast.  Small keyed
# tables (frequent items, centroids, per-partition summaries) stay far
# below; anything that grows with the data falls back to a shuffle join.
DEFAULT_MAX_BROADCAST_ROWS = 2_000_000


def bounded_broadcast(df: DataFrame, max_rows: int = DEFAULT_MAX_BROADCAST_ROWS,
                      known_rows: int | None = None) -> DataFrame:
    """Return ``F.broadcast(df)`` when ``df`` has at most ``max_rows`` rows."""
    n = known_rows if known_rows is not None else df.count()
    return F.broadcast(df) if n <= max_rows else df
