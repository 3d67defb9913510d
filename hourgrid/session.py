"""Session settings the operators rely on, and the way lineage is cut."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from hourgrid.errors import ContractError

# UTC: every hour bucket and calendar field is defined in UTC.
# Co-partitioning on a subset of the join keys lets the grid join and the
# per-zone windows share one exchange on zone_id.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to an existing session."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def build_session(
    app_name: str = "hourgrid",
    master: str | None = None,
    conf: dict[str, str] | None = None,
) -> SparkSession:
    """Start (or reuse) a session; cluster sizing stays with the caller's conf."""
    builder = SparkSession.builder.appName(app_name)
    if master is not None:
        builder = builder.master(master)
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.parquet.compression.codec": "zstd",
        **(conf or {}),
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return configure(builder.getOrCreate())


def require_utc(spark: SparkSession) -> None:
    zone = spark.conf.get("spark.sql.session.timeZone")
    if zone not in ("UTC", "Etc/UTC", "Z", "GMT"):
        raise ContractError(
            f"spark.sql.session.timeZone must be UTC, got {zone}; call configure()"
        )


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the checkpoint folder: spark.checkpoint.dir, else one in the warehouse.

    Both are folders that all nodes share.
    """
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        folder = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/checkpoints"
    context.setCheckpointDir(folder)
    return folder


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write df to the shared checkpoint folder so later jobs restart from there."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
