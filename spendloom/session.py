"""Session settings and the shared folder for written intermediates."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Run-time settings the merges and views rely on for hot keys.  The forced skew
# handling matters for joins that follow each other on one key: without it AQE
# leaves a hot partition whole rather than add the shuffle that splitting needs.
SKEW_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # Largest and smallest stored values come from the files' statistics.
    "spark.sql.parquet.aggregatePushdown": "true",
}

_local_scratch: dict[str, str] = {}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the skew settings to a session somebody else created."""
    for key, value in SKEW_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def local_session(app: str = "spendloom", cores: int | str = "*", **conf: str) -> SparkSession:
    """Session for tests and benchmarks on one machine."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "12g")
        # One session runs many different queries; keep their compiled code.
        .config("spark.sql.codegen.cache.maxEntries", "2000")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    return tune(builder.getOrCreate())


def scratch_root(spark: SparkSession) -> str:
    """Shared folder named by ``spark.checkpoint.dir``.

    A local session without the setting gets a temporary folder; a cluster
    session must name one that every executor can reach.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return shared.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    app = spark.sparkContext.applicationId
    if app not in _local_scratch:
        _local_scratch[app] = tempfile.mkdtemp(prefix="spendloom-")
    return _local_scratch[app]


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unused folder below the shared one."""
    return f"{scratch_root(spark)}/spendloom/{name}-{uuid.uuid4().hex}"
