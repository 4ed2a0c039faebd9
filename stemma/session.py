"""Session settings and the shared folder that intermediate tables are written to."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"
#: Whether Spark deletes the shuffle files of an execution when it ends.
CLEANUP_KEY = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def get_spark(app: str = "stemma", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators assume (UTC, AQE, Arrow)."""
    b = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    if master:
        b = b.master(master)
    for key, value in conf.items():
        b = b.config(key.replace("__", "."), value)
    return b.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder (``spark.checkpoint.dir``), which every executor must reach.

    On a cluster a session that names none gets an error: a folder of one machine would lose rows.
    A ``local`` master, whose executor is this very process, gets a folder of its own.
    """
    context = spark.sparkContext
    named = spark.conf.get(CHECKPOINT_KEY, None) or context.getConf().get(CHECKPOINT_KEY) or context.getCheckpointDir()
    if not named:
        if not one_process(context.master):
            raise ValueError(f"{CHECKPOINT_KEY} is not set: name a folder that all executors share")
        named = tempfile.mkdtemp(prefix="stemma-checkpoint-")
        context.setCheckpointDir(named)
    return named.rstrip("/")


def one_process(master: str) -> bool:
    """Whether driver and executor are one process, so that every folder is shared."""
    return master == "local" or master.startswith("local[")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path in the shared folder. What is still there when the driver's Python ends is deleted then."""
    path = f"{shared_dir(spark)}/stemma-{label}-{uuid.uuid4().hex}"
    _left.setdefault(spark, set()).add(path)
    return path


def written(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back.

    It cuts the lineage, is computed once however often it is read, and outlives lost executors. What
    was shuffled for it is deleted at once, not when the driver happens to collect its garbage.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    before = spark.conf.get(CLEANUP_KEY, None)
    spark.conf.set(CLEANUP_KEY, "true")
    try:
        df.write.mode("overwrite").option("compression", "zstd").parquet(path)
    finally:
        spark.conf.unset(CLEANUP_KEY) if before is None else spark.conf.set(CLEANUP_KEY, before)
    return spark.read.schema(df.schema).parquet(path)


def removed(spark: SparkSession, path: str) -> None:
    """Delete a path in the shared folder, if it is there."""
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)
    _left.get(spark, set()).discard(path)


class Scratch:
    """Tables of one operator. On leaving the block all of them are deleted but those kept.

    An operator writes its result last, and keeps only that.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.own: list[tuple[DataFrame, str]] = []

    def __enter__(self) -> Scratch:
        return self

    def written(self, df: DataFrame, label: str) -> DataFrame:
        before = set(_left.get(self.spark, ()))
        out = written(df, label)
        self.own += [(out, p) for p in _left[self.spark] - before]
        return out

    def dropped(self, *tables: DataFrame) -> None:
        """Delete tables that nothing reads any more."""
        for p in [p for t, p in self.own if any(t is x for x in tables)]:
            removed(self.spark, p)
        self.own = [(t, p) for t, p in self.own if not any(t is x for x in tables)]

    def __exit__(self, *_: object) -> None:
        for _, p in self.own:
            removed(self.spark, p)
        self.own = []


_left: dict[SparkSession, set[str]] = {}


@atexit.register
def released() -> None:
    """Delete all tables that sessions still have in their shared folders."""
    for spark, paths in _left.items():
        for p in list(paths):
            try:
                removed(spark, p)
            except Exception:  # the session has ended  # noqa: BLE001
                break
    _left.clear()


def spread(df: DataFrame) -> DataFrame:
    """Rows dealt out to a number of partitions that is not coalesced: for few bytes that are much work."""
    return df.repartition(2 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200")))


def fed(df: DataFrame) -> DataFrame:
    """Rows for a step that is much work a row: dealt out if the input has fewer partitions than there are cores.

    A large input has many partitions and is never shuffled for this.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df
