"""Where intermediate tables go, and when they go away."""

from __future__ import annotations

import functools
import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"

_local: list[tempfile.TemporaryDirectory] = []
_owned: list[list[str]] = []


def shared_dir(spark: SparkSession) -> str:
    """The folder the cluster names for checkpoints.

    Every executor has to see the same files, so on a cluster the setting is
    required.  Single-machine runs, such as tests, may leave it unset; they use
    one temporary folder that is removed when Python ends.
    """
    context = spark.sparkContext
    root = spark.conf.get(CHECKPOINT_DIR, None) or context.getConf().get(CHECKPOINT_DIR) \
        or context.getCheckpointDir()
    if root is None:
        if not context.master.startswith("local"):
            raise ValueError(f"set {CHECKPOINT_DIR} to a folder that all executors see")
        if not _local:
            _local.append(tempfile.TemporaryDirectory(prefix="daymark-"))
        root = _local[0].name
    return root


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path in the shared folder, owned by the running stage if there is one."""
    path = f"{shared_dir(spark).rstrip('/')}/daymark/{label}-{uuid.uuid4().hex}"
    if _owned:
        _owned[-1].append(path)
    return path


def pinned(df: DataFrame, label: str = "pinned") -> DataFrame:
    """The rows written to the shared folder, so that later plans read the same rows.

    A written table is computed once, cuts the lineage and survives lost
    executors; later reads touch only the columns they need.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.mode("errorifexists").option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def empties_scratch(stage: Callable) -> Callable:
    """A stage that frees the intermediate tables it made once its own output is written.

    The stage may return only what reads its output.  A table is emptied by
    overwriting it, which any store can do.
    """
    @functools.wraps(stage)
    def run(*args, **options):
        made: list[str] = []
        _owned.append(made)
        try:
            return stage(*args, **options)
        finally:
            _owned.remove(made)
            empty = SparkSession.active().range(0)
            for path in made:
                empty.write.mode("overwrite").parquet(path)

    return run
