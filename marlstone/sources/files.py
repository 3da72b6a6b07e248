"""Readers and writers. Every reader declares its schema; no reader infers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marlstone.sources import versions

_S, _I, _D = T.StringType(), T.IntegerType(), T.DoubleType()


def _schema(spec: Sequence[tuple[str, T.DataType]]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in spec])


# The columns of the accident table, in file order.
ACCIDENTS = _schema([
    ("accident_id", _I), ("city", _S), ("state", _S), ("latitude", _D), ("longitude", _D), ("date", _S),
    ("time", _S), ("hour", _I), ("day_of_week", _S), ("is_weekend", _I), ("road_type", _S), ("lanes", _I),
    ("traffic_signal", _I), ("weather", _S), ("visibility", _S), ("temperature", _I), ("traffic_density", _S),
    ("cause", _S), ("accident_severity", _S), ("vehicles_involved", _I), ("casualties", _I),
    ("is_peak_hour", _I), ("festival", _S), ("risk_score", _D),
])
# The columns of a publication record.
PUBLICATIONS = T.StructType([
    T.StructField("publication_url", _S), T.StructField("title", _S), T.StructField("year", _S),
    T.StructField("authors", T.ArrayType(_S)),
    T.StructField("author_links", T.ArrayType(T.StructType([T.StructField("name", _S), T.StructField("url", _S)]))),
    T.StructField("abstract", _S), T.StructField("organisations", T.ArrayType(_S)),
])
# The columns of the labelled texts.
NEWS = _schema([("label", _S), ("text", _S), ("source", _S)])


def _csv(spark: SparkSession):
    # Quotes inside quoted cells are doubled in these files, and cells may span lines.
    return spark.read.option("header", True).option("quote", '"').option("escape", '"')


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str, multiline: bool = False) -> DataFrame:
    """CSV with a header and a declared schema. ``multiline`` files are not split, so set it only when needed."""
    return _csv(spark).option("multiLine", multiline).schema(schema).csv(path)


def read_text_csv(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    """CSV with every column as text, for cleaning afterwards."""
    return read_csv(spark, path, _schema([(c, _S) for c in columns]))


def read_renamed_csv(spark: SparkSession, path: str, schema: T.StructType | str, names: Sequence[str]) -> DataFrame:
    """CSV whose columns get new names by position."""
    return read_csv(spark, path, schema).toDF(*names)


def read_records(spark: SparkSession, path: str, schema: T.StructType | str = PUBLICATIONS) -> DataFrame:
    """JSON lines; blank lines are skipped and a missing file is an empty table.

    A folder with versions gives the one that holds when this is called.
    """
    held = versions.current(spark, path)
    if held is None:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).json(held)


def _position():
    """Where a line stands: file, split, number. Sorts in file order however files are split."""
    return F.struct(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("split"),
        F.monotonically_increasing_id().alias("line"),
    ).alias("pos")


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Trimmed, non-blank lines as (pos, url); ``pos`` sorts in file order."""
    return spark.read.text(path).select(_position(), F.trim("value").alias("url")).filter(F.length("url") > 0)


def read_sitemap(spark: SparkSession, path: str) -> DataFrame:
    """Every ``<loc>`` value as (pos, url). The closing tag is the record separator, so that a
    large sitemap is read in splits."""
    rows = spark.read.option("lineSep", "</loc>").text(path)
    return rows.filter(F.contains("value", F.lit("<loc>"))).select(
        _position(), F.regexp_extract("value", "<loc>(.*)$", 1).alias("url")
    )


def write_csv(df: DataFrame, path: str, single_file: bool = False) -> None:
    """CSV with a header, written by the executors. ``single_file`` is for small result tables."""
    (df.coalesce(1) if single_file else df).write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def write_json(df: DataFrame, path: str, single_file: bool = False) -> None:
    """JSON lines, nested columns kept; used for records, audits and metrics."""
    (df.coalesce(1) if single_file else df).write.mode("overwrite").json(path)


def replace_records(spark: SparkSession, df: DataFrame, path: str) -> None:
    """Replace JSON lines that ``df`` itself may read, as a new version of the folder (:mod:`versions`).

    :func:`read_records` finds the former rows or the new ones at any time, never none and never a mixture.
    """
    versions.publish(spark, path, lambda folder: df.write.json(folder))


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)
