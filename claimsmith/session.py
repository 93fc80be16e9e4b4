"""Session helpers: a local session for tests/bench and the checkpoint folder."""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "claimsmith") -> SparkSession:
    """Local session for tests and the benchmark (UI off, UTC, AQE on)."""
    spark = (SparkSession.builder.master(f"local[{cores}]").appName(app)
             .config("spark.ui.enabled", "false")
             .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
             .config("spark.sql.adaptive.enabled", "true")
             .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
             .config("spark.sql.adaptive.skewJoin.enabled", "true")
             # A hot member's rows are split even where a group-by on the member follows the join.
             .config("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")
             .config("spark.sql.session.timeZone", "UTC")
             # HotSpot does not JIT methods above 8000 bytes of bytecode; wide
             # projections must fall back to per-operator code instead.
             .config("spark.sql.codegen.hugeMethodLimit", "8000")
             .config("spark.driver.memory", os.environ.get("CLAIMSMITH_DRIVER_MEMORY", "16g"))
             .config("spark.sql.execution.arrow.pyspark.enabled", "true")
             .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Checkpoint folder from the session (``spark.checkpoint.dir``); only
    when unset in local mode (tests) a fresh scratch folder is created; on a
    cluster an unset folder is an error."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if conf_dir:
        sc.setCheckpointDir(conf_dir)
        return conf_dir
    if not re.fullmatch(r"local(\[.*\])?", sc.master):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share; "
                         "intermediate tables can't be kept in a machine's own folder on a cluster")
    scratch = tempfile.mkdtemp(prefix="claimsmith-ckpt-")
    sc.setCheckpointDir(scratch)
    return scratch


def compile_wide_rows(spark: SparkSession) -> None:
    """``hugeMethodLimit`` 8000, as in ``local_session``, unless the session has a limit of its own: HotSpot
    interprets larger methods, and those that make the wide claim rows are larger."""
    limit = "spark.sql.codegen.hugeMethodLimit"
    if spark.conf.get(limit, "65535") == "65535":
        spark.conf.set(limit, "8000")


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh output folder under the shared checkpoint folder."""
    base = ensure_checkpoint_dir(spark)
    path = os.path.join(base, "out", f"{name}-{uuid.uuid4().hex}")
    return path
