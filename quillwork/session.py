"""Session settings and the shared folder used to cut lineage."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings that matter at scale.  Anything given to spark-submit wins over these.
DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def get_spark(app: str = "quillwork", master: str | None = None, **conf: str) -> SparkSession:
    """Build or reuse a session; ``conf`` keys are full Spark keys passed as a dict with ``**``."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def _remote(spark: SparkSession, path: str):
    """A path of the cluster's file systems, as its file system and the path there."""
    named = spark._jvm.org.apache.hadoop.fs.Path(path)
    return named.getFileSystem(spark._jsc.hadoopConfiguration()), named


def delete(spark: SparkSession, path: str) -> None:
    """Delete a file or folder on whatever file system holds it; nothing happens if there is none."""
    files, named = _remote(spark, path)
    files.delete(named, True)


def exists(spark: SparkSession, path: str) -> bool:
    files, named = _remote(spark, path)
    return files.exists(named)


def rename(spark: SparkSession, old: str, new: str) -> None:
    files, named = _remote(spark, old)
    if not files.rename(named, _remote(spark, new)[1]):
        raise OSError(f"{old} could not be renamed to {new}")


def names_in(spark: SparkSession, path: str) -> list[str]:
    """Names of the files and folders in a folder, in order; none if it is not there."""
    files, named = _remote(spark, path)
    if not files.exists(named):
        return []
    return sorted(f.getPath().getName() for f in files.listStatus(named))


def shared_folder(spark: SparkSession) -> str:
    """This session's own folder below ``spark.checkpoint.dir``; it is deleted when the driver ends.

    Only a local session may go without that setting; it then gets a temporary folder.  On a cluster
    a folder of the local file system may be a network mount or not, so it is tried out: a table the
    executors write must be found by all of them.
    """
    context = spark.sparkContext
    known = getattr(context, "_quillwork_folder", None)
    if known:
        return known
    root = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    local = context.master.startswith("local")
    if root is None:
        if not local:
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="quillwork-")
        files, named = _remote(spark, root)
        files.deleteOnExit(named)
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(root)
    folder = f"{root.rstrip('/')}/quillwork-{uuid.uuid4().hex}"
    files, named = _remote(spark, folder)
    files.mkdirs(named)
    files.deleteOnExit(named)
    if not local and files.getScheme() == "file":
        _try_out(spark, f"{folder}/tried")
    context._quillwork_folder = folder
    return folder


def _try_out(spark: SparkSession, path: str) -> None:
    """Raise unless what executors write to a folder is there for the driver and for executors."""
    tasks = max(spark.sparkContext.defaultParallelism, 2)
    spark.range(0, tasks, 1, tasks).write.parquet(path)
    files, named = _remote(spark, path)
    written = sum(f.getPath().getName().startswith("part-") for f in files.listStatus(named))
    if written < tasks or spark.read.schema("id long").parquet(path).count() < tasks:
        raise RuntimeError(f"executors do not share {path}: set spark.checkpoint.dir to a folder they share")
    delete(spark, path)


def new_path(spark: SparkSession, purpose: str) -> str:
    """A fresh path below the session's shared folder."""
    return f"{shared_folder(spark)}/{purpose}-{uuid.uuid4().hex}"


def settle(df: DataFrame) -> DataFrame:
    """Compute ``df`` once as a table in the shared folder and return that table.

    The plan is cut, executor loss costs nothing already written, and the optimizer knows the real
    size of what follows.  The table stays until the driver ends; see :class:`Scratch` for tables
    that may go earlier.
    """
    return settle_at(df, new_path(df.sparkSession, "settled"))


def settle_at(df: DataFrame, path: str) -> DataFrame:
    """:func:`settle` in a folder of the caller's."""
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def buckets_of(spark: SparkSession) -> int:
    """As many buckets as a shuffle has partitions, so that either side may stay where it is."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


class Scratch:
    """Settled tables by name, owned by one job.

    Settling under a name in use deletes that name's earlier table as soon as the new one is written,
    so a loop holds one state, not all of them.  Leaving the ``with`` block, or :meth:`close`, deletes
    all tables but those named: a job that returns a lazy result keeps the tables it reads, and they go
    when the driver ends.  No frame that reads a deleted table may be used again.
    """

    def __init__(self, spark: SparkSession):
        self.spark, self.paths, self.tables = spark, {}, {}

    def settle(self, df: DataFrame, name: str, write=settle_at):
        """What ``write(df, path)`` returns: by default the settled table."""
        path = new_path(self.spark, name)
        try:
            table = write(df, path)
        except BaseException:
            delete(self.spark, path)
            raise
        self.drop(name)
        self.paths[name] = path
        return table

    def bucketed(self, df: DataFrame, name: str, key: str) -> DataFrame:
        """``df`` hashed by ``key`` into files sorted by it, a file a bucket, after one exchange.

        Joins and groups by the key need no further exchange of it, and a filter on one key reads one
        bucket.  The table is registered in the session's catalogue until it is dropped.
        """
        path, table = new_path(self.spark, name), f"quillwork_{uuid.uuid4().hex}"
        buckets = buckets_of(self.spark)
        self.drop(name)
        self.paths[name], self.tables[name] = path, table
        df.repartition(buckets, key).write.format("parquet").bucketBy(buckets, key).sortBy(key).option(
            "path", path).saveAsTable(table)
        return self.spark.table(table)

    def drop(self, *names: str) -> None:
        for name in names:
            if table := self.tables.pop(name, None):
                self.spark.sql(f"DROP TABLE IF EXISTS {table}")
            if path := self.paths.pop(name, None):
                delete(self.spark, path)

    def close(self, *keep: str) -> None:
        self.drop(*[name for name in self.paths if name not in keep])

    def __enter__(self) -> Scratch:
        return self

    def __exit__(self, *error) -> None:
        self.close()
