"""Iteration control.

Driver loops re-plan one DataFrame per round.  Without a cut, the plan of
round *i* contains all *i* previous rounds; ``LineageCutter`` writes a
reliable checkpoint (to ``spark.checkpoint.dir``, which survives executor
loss, unlike a local checkpoint) every ``every`` rounds and releases the
previous one's cache.  ``ScratchTables`` does the same with tables whose
files, and whose exchanges' files, are dropped when the loop has no more use
for them.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

from lodestar.session import checkpoint_dir, drop_scratch, scratch_path

#: The files of a job's exchanges go when it ends, not when the driver next collects garbage.
DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Bytes of a batch for a Python worker, a copy of which lies outside the heap, where the session sets none.
BATCH_BYTES = ("spark.sql.execution.arrow.maxBytesPerBatch", str(16 << 20))
#: Rows may have megabytes: a writer, and a reader's batch, hold a row group of few of them.
FEW_ROWS = {"parquet.block.size": 16 << 20, "parquet.page.size.row.check.min": 1}


class LineageCutter:
    def __init__(self, spark: SparkSession, every: int = 5):
        checkpoint_dir(spark)
        self.every = max(1, every)
        self._cached: list[DataFrame] = []

    def __call__(self, df: DataFrame, round_no: int, force: bool = False) -> DataFrame:
        """Checkpoint ``df`` if ``round_no`` is due (or ``force``)."""
        if force or (round_no + 1) % self.every == 0:
            # an eager checkpoint runs one job to evaluate and one to write:
            # the second reads what the first has cached
            df.persist(StorageLevel.MEMORY_AND_DISK)
            try:
                return df.checkpoint(eager=True)
            finally:
                df.unpersist()
        return df

    def persist(self, df: DataFrame) -> DataFrame:
        """Cache a loop invariant (recomputed from lineage if lost)."""
        df = df.persist(StorageLevel.MEMORY_AND_DISK)
        self._cached.append(df)
        return df

    def release(self) -> None:
        for df in self._cached:
            df.unpersist()
        self._cached.clear()


class ScratchTables:
    """Tables written below spark.checkpoint.dir and read back.

    Within ``with``, the shuffle files of a write are dropped at its end; at the
    end of the block the tables go that weren't dropped before or ``keep``-ed."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self._paths: dict[DataFrame, str] = {}

    def __enter__(self) -> ScratchTables:
        self._before = {name: self.spark.conf.get(name, None) for name in (DROP_SHUFFLES, BATCH_BYTES[0])}
        self.spark.conf.set(DROP_SHUFFLES, "true")
        if self._before[BATCH_BYTES[0]] is None:
            self.spark.conf.set(*BATCH_BYTES)
        return self

    def __exit__(self, *_) -> None:
        for name, value in self._before.items():
            if value is None:
                self.spark.conf.unset(name)
            else:
                self.spark.conf.set(name, value)
        self.drop(*list(self._paths))

    def write(self, df: DataFrame, name: str, *by: str) -> DataFrame:
        path = scratch_path(self.spark, name)
        df.write.partitionBy(*by).options(**FEW_ROWS).parquet(path)
        table = self.spark.read.schema(df.schema).parquet(path)
        self._paths[table] = path
        return table

    def drop(self, *tables: DataFrame) -> None:
        for table in tables:
            drop_scratch(self.spark, self._paths.pop(table))

    def keep(self, table: DataFrame) -> DataFrame:
        """Not dropped at the end: the caller reads it."""
        del self._paths[table]
        return table
