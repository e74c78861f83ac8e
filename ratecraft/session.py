"""Session construction and the shared checkpoint folder."""

from __future__ import annotations

import hashlib
import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every ratecraft job relies on. AQE re-plans joins from runtime
# sizes (broadcast when a side turns out small, split skewed partitions),
# and UTC keeps any timestamp rendering deterministic.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(master: str | None = None, app: str = "ratecraft",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with ratecraft's defaults.

    ``master`` defaults to ``local[$BENCH_CPUS or *]``; on a cluster pass the
    cluster master (or leave it to spark-submit by passing ``"submit"``).
    """
    builder = SparkSession.builder.appName(app)
    if master != "submit":
        master = master or f"local[{os.environ.get('BENCH_CPUS', '*')}]"
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, setting one only in local mode.

    On a cluster the folder must be shared storage named by
    ``spark.checkpoint.dir``; a machine-local temp folder is only used when
    the master is local and nothing was configured (tests, laptops).
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir()
    if not sc.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="ratecraft-ckpt-"))
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint folder for file round trips."""
    base = checkpoint_dir(spark).rstrip("/")
    path = f"{base}/scratch-{name}-{uuid.uuid4().hex[:12]}"
    # the folder goes when the session's JVM ends
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    files = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    files.mkdirs(place)
    files.deleteOnExit(place)
    return path


def remove_path(spark: SparkSession, path: str) -> None:
    """Remove a scratch folder that nothing reads any more before the session ends."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


def materialize(df, name: str, rebalance: bool = False, path: str | None = None, buckets: tuple[str, int, str] | None = None):
    """Write ``df`` as a Parquet table in the shared checkpoint folder and read it back.

    Cuts lineage like ``checkpoint()`` (the table survives executor loss,
    unlike a local checkpoint), and the re-read keeps Parquet column pruning,
    filter pushdown and file statistics for the planner.

    ``rebalance`` adds an AQE rebalance before the write (splitting a
    partition that a hot key made huge, merging tiny ones). Row-level tables
    that later stages scan many times use it, so those scans get evenly
    sized splits; small aggregate outputs (one row per key, already hash
    partitioned by their aggregate) skip the extra shuffle. Callers that
    remove the table early name its ``path``.

    ``buckets`` (table name, number, key) writes it by hash buckets of the key:
    aggregates by the key (and more) and joins of two such tables of as many
    buckets then go bucket by bucket and shuffle no row. ``df`` should be dealt
    by the key into as many partitions, so that a bucket is few files. The
    caller ends it with ``drop_buckets``.
    """
    spark = df.sparkSession
    path = path or scratch_path(spark, name)
    if buckets is not None:
        table, number, key = buckets
        df.write.mode("overwrite").format("parquet").bucketBy(number, key).option("path", path).saveAsTable(table)
        return spark.table(table)
    (df.hint("rebalance") if rebalance else df).write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)       # known, so no job reads it from a file's end


def drop_buckets(spark: SparkSession, table: str, path: str) -> None:
    """End a table that ``materialize`` wrote by buckets."""
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    remove_path(spark, path)


def kept_table(spark: SparkSession, key: str, build):
    """The table that ``build()`` gives, kept under ``key`` for every session that shares the checkpoint folder.

    ``key`` must name all that the table follows from (input files, parameters).
    The table is written beside its place and moved there whole, so a reader
    never meets half of it. Where ``spark.checkpoint.dir`` is not set, the
    folder and so the table last as long as the session.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir") or checkpoint_dir(spark)
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    place = hadoop.Path(f"{root.rstrip('/')}/ratecraft-tables/{hashlib.md5(key.encode()).hexdigest()}")
    files = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not files.exists(place):
        own = scratch_path(spark, "kept")
        build().write.mode("overwrite").parquet(own)
        files.mkdirs(place.getParent())
        if not files.rename(hadoop.Path(own), place):
            return spark.read.parquet(place.toString() if files.exists(place) else own)     # another session was first, or no move is possible
    return spark.read.parquet(place.toString())


def fingerprint(spark: SparkSession, paths: list[str]) -> str:
    """A short text that changes when files under ``paths`` are added, removed or written anew."""
    hadoop, conf = spark.sparkContext._jvm.org.apache.hadoop.fs, spark.sparkContext._jsc.hadoopConfiguration()
    marks = []
    for path in paths:
        place = hadoop.Path(path)
        files = place.getFileSystem(conf)
        status, size = files.getFileStatus(place), files.getContentSummary(place)
        marks.append((status.getPath().toString(), status.getModificationTime(), size.getLength(), size.getFileCount()))
    return hashlib.md5(repr(marks).encode()).hexdigest()
