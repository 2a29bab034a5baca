"""Session helpers: building a local session for tests and benches, and
materialising intermediate tables in the cluster's shared checkpoint folder."""

from __future__ import annotations

import gc
import os
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  checkpoint_dir: str | None = None,
                  driver_memory: str = "16g") -> SparkSession:
    """A local session configured like the cluster one (AQE on, UI off).

    ``checkpoint_dir`` is only applied when the session has none configured,
    which is the case for tests and local benches.
    """
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("quarry")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.default.parallelism", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", driver_memory)
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    if checkpoint_dir and not checkpoint_root(spark):
        spark.conf.set("spark.checkpoint.dir", checkpoint_dir)
        spark.sparkContext.setCheckpointDir(checkpoint_dir)
    return spark


def checkpoint_root(spark: SparkSession) -> str | None:
    """The shared folder named by ``spark.checkpoint.dir`` (or set on the
    SparkContext); ``None`` when the session has none."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        try:
            root = spark.sparkContext.getCheckpointDir()
        except Exception:  # noqa: BLE001 - no SparkContext (e.g. Spark Connect)
            root = None
        if root:
            # the context returns a per-application sub folder; its parent is fine
            root = os.path.dirname(root.rstrip("/"))
    return root or None


PACKAGE_ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def on_workers(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver has it
    (a cluster gets the package by ``--py-files`` as usual)."""
    env = spark.sparkContext.environment
    known = env.get("PYTHONPATH", "")
    if PACKAGE_ROOT not in known.split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(x for x in (PACKAGE_ROOT, known) if x)


def materialize(df: DataFrame, name: str = "table") -> DataFrame:
    """Cut the lineage of ``df`` so later jobs and lost executors do not
    recompute it: the table is written as parquet into the shared checkpoint
    folder and read back (columnar, compressed, with column pruning and filter
    pushdown on re-read)."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


_written: list[str] = []  # scratch paths given out and not released


def release_scratch(spark: SparkSession, paths: list[str]) -> None:
    """Delete scratch tables that nothing reads any more, and let Spark clean up
    the shuffle files of plans that are gone."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for p in paths:
        path = jvm.org.apache.hadoop.fs.Path(p)
        path.getFileSystem(conf).delete(path, True)
        if p in _written:
            _written.remove(p)
    jvm.System.gc()


def release_shuffles(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of plans that are gone: its cleaner waits
    for the driver's garbage collection, which a large heap puts off past the job."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def scratch_written() -> list[str]:
    """Paths of the scratch tables written so far and not released."""
    return list(_written)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared checkpoint folder for written tables.  Only
    a local session may do without ``spark.checkpoint.dir``: driver and
    executors are one process there, so a temporary folder is shared."""
    root = checkpoint_root(spark)
    if not root:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="quarry-")
        spark.conf.set("spark.checkpoint.dir", root)
    path = f"{root.rstrip('/')}/quarry-{name}-{uuid.uuid4().hex[:12]}"
    _written.append(path)
    return path


def save_bucketed(df: DataFrame, name: str, key: str, buckets: int,
                  sort_by: str | tuple[str, ...] | None = None) -> DataFrame:
    """Write ``df`` as a table bucketed by ``key`` into the shared checkpoint
    folder and read it back.  Unlike a checkpoint under adaptive execution,
    the bucketed scan reports ``HashPartitioning(key, buckets)``, so later
    aggregations and joins keyed on ``key`` need no exchange.  ``sort_by``
    orders rows inside each bucket, so the parquet min/max statistics let
    lookups on that column skip row groups.  The catalog entry only carries
    the bucket layout into the returned DataFrame and is dropped at once; the
    files stay."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    table = f"quarry_{name}_{uuid.uuid4().hex[:12]}"
    w = df.write.option("compression", "zstd").bucketBy(buckets, key)
    if sort_by:
        w = w.sortBy(*([sort_by] if isinstance(sort_by, str) else sort_by))
    w.option("path", path).saveAsTable(table)
    out = spark.table(table)
    out.schema  # resolves the plan while the entry exists  # noqa: B018
    spark.sql(f"DROP TABLE {table}")
    return out


# Documents per partition / postings bucket: ~50k documents of ~200 tokens
# make ~6M postings, about 100-150 MB.
ROWS_PER_PARTITION = 50_000


def partition_count(spark: SparkSession, rows: int, rows_per_partition: int = ROWS_PER_PARTITION) -> int:
    """Partitions for ``rows`` documents: enough for every core, and one per
    ``rows_per_partition`` beyond that - independent of the session's
    shuffle-partition setting (which may be tuned for other jobs)."""
    try:
        cores = spark.sparkContext.defaultParallelism
    except Exception:  # noqa: BLE001 - no SparkContext (e.g. Spark Connect)
        cores = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return max(int(cores), -(-int(rows) // rows_per_partition), 1)


# Tokens of a postings bucket: about 0.6 postings a token, 50 MB as parquet and
# some 300 MB of a task's Python while the bucket is built or searched.
TOKENS_PER_BUCKET = 5_000_000


def bucket_count(spark: SparkSession, tokens: int) -> int:
    """Document buckets of the postings: one for each core at least, more with
    the tokens of the corpus, without a limit (see :func:`two_levels`)."""
    return max(spark.sparkContext.defaultParallelism, -(-int(tokens) // TOKENS_PER_BUCKET), 1)


def two_levels(spark: SparkSession, buckets: int, files: int | None = None) -> tuple[int, int]:
    """``(files, parts)``: how ``buckets`` document buckets are laid out.  Spark
    allows ``spark.sql.sources.bucketing.maxBuckets`` buckets of a table; beyond
    that a file holds several document buckets, one after another, and work
    inside a file goes bucket by bucket.  ``files``: a smaller limit."""
    most = int(spark.conf.get("spark.sql.sources.bucketing.maxBuckets", "100000"))
    files = max(1, min(most, buckets, files or buckets))
    return files, -(-buckets // files)


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]):
    """Session settings for the jobs inside the block, put back afterwards."""
    before = {k: spark.conf.get(k, None) for k in values}
    try:
        for k, v in values.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def spread(df: DataFrame, key: str, partitions: int | None = None) -> DataFrame:
    """Hash-partition ``df`` by ``key`` only when its scan puts the rows in
    too few tasks (for example one file with a single parquet row group is
    read by one task, whatever its size); otherwise return it unchanged, so
    a well-laid-out input is not shuffled.

    The check is one small job over the key column: rows per scan task,
    reduced on the executors to a single row (tasks with rows, the largest
    task, the total)."""
    from pyspark.sql import functions as F
    per_task = df.select(key).groupBy(F.spark_partition_id().alias("_p")).agg(
        F.count(F.lit(1)).alias("_n"))
    s = per_task.agg(F.count(F.lit(1)).alias("tasks"), F.max("_n").alias("biggest"),
                     F.sum("_n").alias("total")).first()
    if not s["total"]:
        return df
    n = partitions or partition_count(df.sparkSession, s["total"])
    if s["tasks"] < n and s["biggest"] > 2 * s["total"] / n:
        return df.repartition(n, key)
    return df
