"""Session helpers: settings every operator relies on and shared scratch space."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Rows of one group (or one whole table) that a single task may hold or sort.
# Operators count first and switch to their split form above this size.
SINGLE_TASK_ROWS_KEY = "spark.tidemark.singleTaskRows"
SINGLE_TASK_ROWS = 2_000_000


def local_session(cores: str = "8", partitions: int = 8, memory: str = "12g") -> SparkSession:
    """A local session for tests and the benchmark.

    The test files hold one row group each, so a scan is one task. With the low
    broadcast limit the fact join shuffles and spreads the rows over all cores.
    """
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("tidemark")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.autoBroadcastJoinThreshold", "1m")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def single_task_rows(spark: SparkSession) -> int:
    return int(spark.conf.get(SINGLE_TASK_ROWS_KEY, str(SINGLE_TASK_ROWS)))


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder: the cluster's own, or a new local one in local mode."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current is None:
        if not configured:
            if not context.master.startswith("local"):
                raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
            configured = tempfile.mkdtemp(prefix="tidemark-")
        context.setCheckpointDir(configured)
    return configured or current


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder, for tables an operator writes and reads back."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/tidemark-{uuid.uuid4().hex}/{name}"


def stored(df):
    """Cut the lineage with a reliable checkpoint in the shared folder."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()
