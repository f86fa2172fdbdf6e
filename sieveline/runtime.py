"""Session-level helpers shared by all operators."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir`` of the session.

    Only where that setting is absent and the session is local (tests) a temporary folder of this machine is set; on a
    cluster its executors couldn't read it, so that is an error.
    """
    sc = spark.sparkContext
    path = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if path:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(path)
        return path
    if sc.getCheckpointDir() is None:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="sieveline-"))
    return sc.getCheckpointDir()


def cut(df: DataFrame) -> DataFrame:
    """Cut the lineage with a reliable checkpoint in the shared folder."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as Parquet into the shared folder and read it back.

    Unlike a checkpoint the result is columnar, so later reads prune columns.
    """
    path = f"{shared_dir(df.sparkSession)}/sieveline-{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    _written.append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


_written: list[str] = []


def forget(spark: SparkSession) -> int:
    """Remove the folders written so far, once no result that reads them is needed; returns how many."""
    n = len(_written)
    while _written:
        path = spark._jvm.org.apache.hadoop.fs.Path(_written.pop())
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    return n


def fresh(df: DataFrame, stem: str) -> str:
    """A column name that starts with ``stem`` and doesn't clash (case-insensitively) with one of ``df``."""
    taken = {c.lower() for c in df.columns}
    name = stem
    while name.lower() in taken:
        name += "_"
    return name


def width(spark: SparkSession) -> int:
    """Partitions for work that is heavy per byte: at least one for each core."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)


def by_key(df: DataFrame, *keys: str) -> DataFrame:
    """Hash partitions by ``keys`` in a number that adaptive execution keeps, whatever their bytes.

    An aggregate or join on the keys that follows needs no further shuffle. Used ahead of rule matching, whose cost
    isn't in the bytes by which partitions would be merged.
    """
    return df.repartition(width(df.sparkSession), *keys)


#: Scans of more splits are never spread, however many cores there are: each split is at most ``maxPartitionBytes``.
SPREAD_SPLITS = 16


def widen(df: DataFrame) -> DataFrame:
    """Spread a small scan over all cores: a shuffle of at most ``SPREAD_SPLITS`` splits (2 GB as Spark is set by default),
    and none of a larger scan, whose splits are work enough."""
    cores, splits = df.sparkSession.sparkContext.defaultParallelism, df.rdd.getNumPartitions()
    return df.repartition(cores) if splits < min(cores, SPREAD_SPLITS) else df


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give the package to the Python workers, once for each application: they may run in another folder or on another
    machine. The archive is served by the driver, so no shared folder is needed for it."""
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    root = Path(__file__).resolve().parent
    archive = Path(tempfile.mkdtemp(prefix="sieveline-code-")) / "sieveline_code.zip"
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as z:
        for f in sorted(root.rglob("*.py")):
            z.write(f, f.relative_to(root.parent))
    sc.addPyFile(str(archive))
    _shipped.add(sc.applicationId)
