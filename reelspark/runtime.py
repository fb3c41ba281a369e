"""Session set-up, table access and lineage cutting shared by every operator."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def session(cores: int | str = "*", shuffle_partitions: int = 8, **conf: str) -> SparkSession:
    """A local session for tests and benchmarks; on a cluster the caller brings its own session."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "6g")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def table(spark: SparkSession, root: str, name: str) -> DataFrame:
    """One Parquet table of a data directory."""
    return spark.read.parquet(f"{root}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir`` of the session.

    Where the session names none, a temporary folder is made, but only for a local master; on a cluster
    a machine-local folder would not be seen by the other machines, so that is an error.
    """
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if found:
        return found
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    made = f"file://{tempfile.mkdtemp(prefix='reelspark-')}"
    spark.conf.set("spark.checkpoint.dir", made)
    return made


def scratch(spark: SparkSession, label: str) -> str:
    """A new path in the shared folder; what is there is removed when the application ends."""
    path = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(where)
    return path


def cut(df: DataFrame, label: str = "cut", instead_of: DataFrame | None = None) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back: a plan without lineage that outlives lost executors.

    The table is removed when the application ends; ``instead_of``, an earlier one that nothing reads any more, at once.
    """
    spark = df.sparkSession
    path = scratch(spark, label)
    df.write.parquet(path)
    if (old := getattr(instead_of, "_cut", None)) is not None:
        where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(old)
        where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)
    out = spark.read.schema(df.schema).parquet(path)
    out._cut = path
    return out


def spread(df: DataFrame) -> DataFrame:
    """``df``, over as many tasks as run at once if it is read by less than half as many.

    A file with one row group is read by one task; before heavy expressions a shuffle of the few columns they need is the
    cheaper way. A table of many row groups is left as it is.
    """
    most = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(most) if 2 * df._jdf.queryExecution().toRdd().getNumPartitions() <= most else df
