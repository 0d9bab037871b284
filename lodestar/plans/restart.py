"""States of long fits, written so that a new run goes on where one ended."""

from __future__ import annotations

import json
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import SparkSession

SCHEMA = "rounds int, state string, history string"


def write_state(spark: SparkSession, state_dir: str, state: dict, history: list) -> None:
    """One small file per call, below the shared folder ``state_dir``."""
    row = [(len(history), json.dumps(state), json.dumps(history))]
    spark.createDataFrame(row, SCHEMA).coalesce(1).write.parquet(f"{state_dir.rstrip('/')}/part-{len(history)}-{uuid.uuid4().hex}")


def last_state(spark: SparkSession, state_dir: str) -> tuple[dict, list] | None:
    """The furthest state written, if there is one."""
    try:
        states = spark.read.schema(SCHEMA).parquet(f"{state_dir.rstrip('/')}/part-*")
    except AnalysisException as none:
        if "PATH_NOT_FOUND" in str(none):
            return None
        raise
    row = states.orderBy("rounds", ascending=False).first()
    return (json.loads(row.state), [tuple(h) for h in json.loads(row.history)]) if row else None
