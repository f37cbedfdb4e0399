"""Session settings, the shared scratch folder and staged tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CHECKPOINT_DIR = "spark.checkpoint.dir"

# Runtime settings the operators rely on. A skewed join is split even when the
# split costs one more exchange: a hot key is worse than a shuffle.
RUNTIME = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}

# Set where the session leaves them open. Shuffled bytes are compressed and take some twenty
# times their size in the sorters and hash maps of a task, so small partitions are put together
# only up to this size: what a task holds then stays the same, however large the tables are.
UNLESS_SET = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "16m"}


def build_session(app: str = "stocktake", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app).config("spark.ui.enabled", "false")
    if master:
        builder = builder.master(master)
    for key, value in {**UNLESS_SET, **RUNTIME, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session somebody else started."""
    for key, value in RUNTIME.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    for key, value in UNLESS_SET.items():
        if spark.conf.get(key, None) is None:
            spark.conf.set(key, value)
    return spark


def scratch_dir(spark: SparkSession) -> str:
    """The shared folder for staged tables: the session's checkpoint folder.

    Only a local-mode session that names none gets a temporary folder.
    """
    root = spark.conf.get(CHECKPOINT_DIR, None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError(f"set {CHECKPOINT_DIR} to a folder that every executor can reach")
        root = tempfile.mkdtemp(prefix="stocktake-")
        spark.conf.set(CHECKPOINT_DIR, root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    app = spark.sparkContext.applicationId
    return f"{scratch_dir(spark)}/{app}/{label}-{uuid.uuid4().hex}"


def stage(df: DataFrame, label: str = "stage") -> DataFrame:
    """Write ``df`` once to the shared folder and read it back: lineage ends here,
    so a lost executor cannot make two readers see different rows."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


# Rows a side may have before it is no longer broadcast.
BROADCAST_ROWS = 500_000


def broadcast_if_few(
    side: DataFrame, counted: DataFrame | None = None, limit: int = BROADCAST_ROWS
) -> DataFrame:
    """Broadcast ``side`` when it is counted to have few rows.

    ``counted`` names something cheaper to count that has at least as many rows. Beyond
    the limit the side stays a plain shuffled join input.
    """
    few = (side if counted is None else counted).count() <= limit
    return F.broadcast(side) if few else side
