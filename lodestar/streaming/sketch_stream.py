"""Count-min sketch under Structured Streaming.

One pass over the stream: each event becomes its five cells (stateless),
and ``groupBy(h, bucket).count()`` keeps the sketch as streaming state.
The state holds at most ``len(params) * n_buckets`` keys, so no watermark
is needed (the stream carries no event time).  The streaming checkpoint
lives under the shared ``spark.checkpoint.dir`` so a restarted query resumes
from its offsets and state.

The query itself emits nothing: once drained, its state is read from the
checkpoint by the state data source, a batch scan over the state store's
partitions.  No cell passes through the driver, and no sink is needed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lodestar.functions.hashing import CMS_BUCKETS
from lodestar.functions.text import rtrim_ws
from lodestar.operators.sketch import cms_sketch
from lodestar.session import scratch_path


def cms_stream_query(stream: DataFrame, col: str, checkpoint: str, n_buckets: int = CMS_BUCKETS):
    """Start the streaming sketch: it drains what is there (``availableNow``) and
    keeps the cells' counts as state below ``checkpoint``."""
    return (cms_sketch(stream, col, n_buckets).writeStream.outputMode("update").format("noop")
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())


def drained_sketch(spark: SparkSession, checkpoint: str) -> DataFrame:
    """The sketch ``(h, bucket, n)`` that a drained query left in its state."""
    state = spark.read.format("statestore").load(checkpoint)
    return state.select("key.h", "key.bucket", F.col("value.count").alias("n"))


def cms_stream(spark: SparkSession, source_dir: str, file_glob: str | None, schema: StructType | None,
               col: str, n_buckets: int = CMS_BUCKETS, timeout_s: float | None = None,
               fmt: str = "parquet", checkpoint: str | None = None,
               max_files_per_trigger: int | None = None) -> DataFrame:
    """T1 + T3: drain every file under ``source_dir`` (whose name matches
    ``file_glob``, if given) through the streaming sketch, then return the
    sketch as a batch DataFrame ``(h, bucket, n)`` ready for probing.  A table
    is a folder of part files or one file; ``source_dir`` may be either.  A
    stream that isn't drained within ``timeout_s`` is stopped and raises.

    ``fmt="text"`` reads one integer id per line (S14): the line is
    right-trimmed and cast, and ``col`` names the resulting column.
    Passing the ``checkpoint`` of an earlier run resumes it: only files
    that arrived since are read, and the counts add to the saved state.
    """
    reader = spark.readStream.option("pathGlobFilter", file_glob) if file_glob else spark.readStream
    # the stream reader takes a plain path for a folder; a pattern that matches
    # nothing else may also be a file
    source_dir = source_dir.rstrip("/")
    path = source_dir if file_glob else f"{source_dir[:-1]}[{source_dir[-1]}]"
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    if fmt == "text":
        stream = reader.text(path).select(
            rtrim_ws("value").cast("long").alias(col))
    else:
        stream = reader.schema(schema).format(fmt).load(path).select(col)
    checkpoint = checkpoint or scratch_path(spark, "cms-stream")
    q = cms_stream_query(stream, col, checkpoint, n_buckets)
    if q.awaitTermination(timeout_s) is False:
        q.stop()
        raise TimeoutError(f"the stream was not drained within {timeout_s} s")
    if q.exception() is not None:
        raise RuntimeError(f"streaming sketch failed: {q.exception()}")
    return drained_sketch(spark, checkpoint)
