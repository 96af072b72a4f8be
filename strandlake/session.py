"""Session helpers: shipping the package to executors, and the shared folder for intermediate tables."""

from __future__ import annotations

import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send the package to the executors once per application, as `spark-submit --py-files` would."""
    app = spark.sparkContext.applicationId
    if app not in _shipped:
        top = Path(__file__).resolve().parent
        archive = shutil.make_archive(f"{tempfile.mkdtemp(prefix='strandlake-')}/strandlake-{app}", "zip", top.parent, top.name)
        spark.sparkContext.addPyFile(archive)
        _shipped.add(app)


def scratch(spark: SparkSession) -> str:
    """The shared folder of the cluster, spark.checkpoint.dir. Where none is set, a folder of our own if all runs on this
    machine; on a cluster an error, since executors don't see each other's disks."""
    conf = spark.sparkContext.getConf()
    folder = conf.get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        master = conf.get("spark.master", "")
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        folder = tempfile.mkdtemp(prefix="spark-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def fresh(spark: SparkSession, label: str) -> str:
    """A path in the shared folder that nothing uses yet."""
    return f"{scratch(spark)}/{label}-{uuid.uuid4().hex}"


@contextmanager
def freed(spark: SparkSession) -> Iterator[None]:
    """What writes in this context have shuffled is deleted once they end, not when the JVM happens to collect garbage."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def kept(df: DataFrame, label: str) -> DataFrame:
    """`df`, written to the shared folder once, for use in several places."""
    path = fresh(df.sparkSession, label)
    with freed(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def kept_small(df: DataFrame, label: str, most: int = 500_000) -> DataFrame:
    """kept(), to be broadcast in joins if it has at most `most` rows."""
    table = kept(df, label)
    return F.broadcast(table) if table.count() <= most else table


def drop(*frames: DataFrame) -> None:
    """Delete the tables in the shared folder that the frames read."""
    for frame in frames:
        spark = frame.sparkSession
        base, jvm = scratch(spark).split(":")[-1].lstrip("/"), spark._jvm
        for path in {file.rsplit("/", 1)[0] for file in frame.inputFiles()}:
            if path.split(":")[-1].lstrip("/").startswith(base):
                where = jvm.org.apache.hadoop.fs.Path(path)
                where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
