"""Session settings the toolkit is written for."""

from __future__ import annotations

import gc
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Adaptive execution sizes shuffles, splits skewed join partitions and turns joins into
# broadcasts from measured sizes. No fixed shuffle width is set here: on a cluster the
# initial width comes from the cluster's own configuration.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


def build_session(
    app_name: str = "marlstone", master: str | None = None, **extra: str
) -> SparkSession:
    """Return a session; ``master`` and ``extra`` settings are for local runs and tests."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def settle(df: DataFrame) -> DataFrame:
    """``df`` computed once for the many passes of a model or a sweep.

    Where the cluster names a shared folder in ``spark.checkpoint.dir`` the rows are checkpointed
    there, which also cuts the lineage and survives lost executors. Without one (local runs) they
    are persisted and can be recomputed. A scope of :class:`SettledTables` frees both.
    """
    spark = df.sparkSession
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        return _owned(df.persist())
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(folder)
    return _owned(df.checkpoint())


def settle_packed(df: DataFrame) -> DataFrame:
    """As :func:`settle`, but in compressed files where a checkpoint holds plain rows: for texts and long tables."""
    spark = df.sparkSession
    if not spark.conf.get("spark.checkpoint.dir", None):
        return _owned(df.persist())
    folder = scratch_folder(spark)
    df.write.option("compression", "zstd").parquet(folder)
    if _SCOPES:
        _SCOPES[-1].folders.append((spark, folder))
    return spark.read.parquet(folder)


class SettledTables:
    """A scope that owns the tables settled inside it and frees them when it is left.

    Write or collect results inside the scope: what still reads a settled table afterwards computes it again,
    or fails if its rows were checkpointed. Scopes may be nested; a table belongs to the innermost.
    """

    def __enter__(self) -> SettledTables:
        self.tables: list[DataFrame] = []
        self.folders: list[tuple[SparkSession, str]] = []
        _SCOPES.append(self)
        return self

    def __exit__(self, *failure) -> None:
        _SCOPES.remove(self)
        for df in self.tables:
            file = _checkpoint_file(df)
            if file:
                remove_folder(df.sparkSession, file)
            else:
                df.unpersist(blocking=True)
        for spark, folder in self.folders:
            remove_folder(spark, folder)
        self.tables.clear()
        self.folders.clear()


_SCOPES: list[SettledTables] = []


def _checkpoint_file(df: DataFrame) -> str | None:
    """Where a checkpointed table's rows lie; None for another table."""
    plan = df._jdf.queryExecution().logical()
    if plan.getClass().getSimpleName() != "LogicalRDD":
        return None
    file = plan.rdd().getCheckpointFile()
    return file.get() if file.isDefined() else None


def _owned(df: DataFrame) -> DataFrame:
    if _SCOPES:
        _SCOPES[-1].tables.append(df)
    return df


def scratch_folder(spark: SparkSession) -> str:
    """A new folder that driver and executors share, under ``spark.checkpoint.dir``; a local one with a local master."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        base = tempfile.mkdtemp(prefix="marlstone-")
    return f"{base.rstrip('/')}/scratch-{uuid.uuid4().hex}"


def remove_folder(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def release_shuffles(spark: SparkSession) -> None:
    """Give back the shuffle files of stages that have ended. Spark deletes them when no table refers to them any
    more, which it notices at a collection of garbage only, by default every half hour."""
    gc.collect()  # Python's handles of tables
    spark._jvm.System.gc()
