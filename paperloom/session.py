"""Session settings and the few helpers that touch the cluster rather than the data."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # rasters and texts reach Python in batches of bounded bytes, whatever a row holds
    "spark.sql.execution.arrow.maxBytesPerBatch": str(64 << 20),
}


def build_session(master: str | None = None, app: str = "paperloom", **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The cluster's checkpoint folder; a temporary one only on a local master, as in tests.

    Elsewhere an unset ``spark.checkpoint.dir`` is an error: a folder of the driver's machine would take
    each executor's part of a table on a disk that no other machine reads.
    """
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir")
    if named is None and context.getCheckpointDir() is None:
        if not context.master.startswith("local") or context.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="spark-", dir="/tmp"))
    return (named or context.getCheckpointDir()).rstrip("/")


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` as a table in the cluster's shared checkpoint folder and continue from there.

    Unlike ``checkpoint()``, which counts first and computes again to write, this computes once, and
    readers take only the columns they need.
    """
    path = f"{shared_folder(df.sparkSession)}/paperloom-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    written = df.sparkSession.read.schema(df.schema).parquet(path)
    written.written_path = path
    return written


def discard(written: DataFrame) -> None:
    """Delete a table of :func:`cut_lineage` that nothing reads any more."""
    path = written.sparkSession._jvm.org.apache.hadoop.fs.Path(written.written_path)
    path.getFileSystem(written.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def discard_all(spark: SparkSession) -> None:
    """Delete every table that :func:`cut_lineage` has left in the shared folder, once a job's results are stored."""
    jvm, folder = spark._jvm, spark._jvm.org.apache.hadoop.fs.Path(f"{shared_folder(spark)}/paperloom-*")
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    for status in files.globStatus(folder) or []:
        files.delete(jvm.org.apache.hadoop.fs.Path(status.getPath().toString()), True)


def spread(df: DataFrame, per_core: int = 4) -> DataFrame:
    """Deal the rows evenly over a few tasks for each core, before work that costs more by the row than reading does.

    Files are split by bytes, so a small table of long computations is else read by one task.  Rows go by
    their place in the input: no key collects in a task, and nothing is sorted.
    """
    parts = per_core * df.sparkSession.sparkContext.defaultParallelism
    return df.withColumn("__place", F.monotonically_increasing_id()).repartition(parts, "__place").drop("__place")


def broadcast_if_small(df: DataFrame, max_rows: int = 10_000) -> DataFrame:
    """Ask for a broadcast only after counting: beyond ``max_rows`` Spark picks a shuffle join.

    The count stops at ``max_rows + 1`` rows.  Meant for tables keyed by a closed set (field
    groups, document types), which are read back from storage or derived from a tiny aggregate.
    """
    return F.broadcast(df) if df.limit(max_rows + 1).count() <= max_rows else df


def with_index(
    df: DataFrame, groups: list[str], order: list[str], name: str = "index", few_groups: bool = True
) -> DataFrame:
    """Number the rows of each group 0, 1, 2... in ``order``, without one task per group.

    A window over a group would sort a group holding a third of all rows in one task.  Here a
    range partitioning on (group, order) spreads such a group over many tasks, every row takes
    its position inside its partition, and the counts per (partition, group) - a table no longer
    than partitions x groups - supply the offsets.  The sorted rows are written out because the
    positions must not change between the two reads.  ``few_groups`` says that the groups are a
    closed set, which bounds the offsets and lets them be broadcast; else Spark picks the join.
    """
    keys = [F.col(g) for g in groups]
    base = "__position"
    part = "__partition"
    ordered = (
        df.repartitionByRange(*keys, *[F.col(o) for o in order])
        .sortWithinPartitions(*groups, *order)
        .withColumn(base, F.monotonically_increasing_id())
    )
    ordered = cut_lineage(ordered.withColumn(part, F.shiftright(base, 33)))
    counts = ordered.groupBy(part, *groups).agg(F.min(base).alias("__first"), F.count(F.lit(1)).alias("__rows"))
    # one row per (partition, group): the running sum over it stays small
    before = Window.partitionBy(*(groups or [F.lit(1)])).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    named = {g: f"__group_{i}" for i, g in enumerate(groups)}
    offsets = counts.withColumn("__offset", F.coalesce(F.sum("__rows").over(before), F.lit(0))).select(
        F.col(part).alias("__in"),
        *[F.col(g).alias(alias) for g, alias in named.items()],
        (F.col("__offset") - F.col("__first")).alias("__shift"),
    )
    condition = F.col(part) == F.col("__in")
    for group, alias in named.items():
        condition = condition & F.col(group).eqNullSafe(F.col(alias))
    joined = ordered.join(F.broadcast(offsets) if few_groups else offsets, condition, "left")
    return joined.select(*df.columns, (F.col(base) + F.col("__shift")).cast("bigint").alias(name))
