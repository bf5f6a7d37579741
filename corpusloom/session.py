"""Session building and durable scratch tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def build_session(master: str | None = None, app: str = "corpusloom", **conf: str) -> SparkSession:
    """Session with the settings the operators assume; explicit `conf` wins."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        **conf,
    }
    for name, value in settings.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def scratch_root(spark: SparkSession) -> str:
    """Shared folder for intermediate tables.

    The cluster names it in `spark.checkpoint.dir`.  Only a local master may
    fall back to a temporary folder: on a cluster executors would not share it.
    """
    configured = spark.conf.get(CHECKPOINT_CONF, None) or spark.sparkContext.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_CONF} to a folder all executors can reach")
    folder = tempfile.mkdtemp(prefix="corpusloom-")
    spark.conf.set(CHECKPOINT_CONF, folder)
    return folder


def scratch_path(spark: SparkSession, tag: str) -> str:
    """A fresh path under the scratch root; nothing is ever overwritten there."""
    return f"{scratch_root(spark)}/corpusloom/{tag}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, tag: str) -> DataFrame:
    """Write `df` once as Parquet and read it back.

    Cuts the lineage durably, survives executor loss, and gives the optimizer
    real sizes for the next join.
    """
    path = scratch_path(df.sparkSession, tag)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def bucketed(df: DataFrame, tag: str, *keys: str) -> DataFrame:
    """Write `df` once as a table of buckets by `keys` and read it back.

    A join or aggregate on exactly `keys` then reads the table in place: only the other side
    moves.  There are as many buckets as shuffle partitions.  The table's files lie in the scratch folder;
    its name is only known to the session's catalog.
    """
    spark = df.sparkSession
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    name = f"corpusloom_{tag.replace('-', '_')}_{uuid.uuid4().hex}"
    dealt = df.repartition(buckets, *keys)
    dealt.write.format("parquet").bucketBy(buckets, *keys).option("path", scratch_path(spark, tag)).saveAsTable(name)
    return spark.table(name)
