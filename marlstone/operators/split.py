"""Splits, class weights and label indexes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from marlstone.operators.scale import broadcast_within, hash_order, number_rows


def _in_share(key: str, share: float, seed: int | str):
    """True for about ``share`` of the keys: the leading 48 bits of the MD5 of key and seed, as a number below 1."""
    h, _ = hash_order(key, seed)
    return F.conv(F.substring(h, 1, 12), 16, 10).cast("double") / float(16**12) < share


def bernoulli_split(
    df: DataFrame, key: str, label: str, share: float = 0.8, seed: int = 42
) -> tuple[DataFrame, DataFrame]:
    """Random split with the same share for each class; rows without a class are test rows.

    A row's side depends on its key and the seed alone, so train and test stay complements however
    often and in whatever order the input is computed. ``key`` must be free of NULL.
    """
    train = _in_share(key, share, seed) & F.col(label).isNotNull()
    return df.filter(train), df.filter(~train)


def not_in(df: DataFrame, other: DataFrame, key: str) -> DataFrame:
    """Rows of ``df`` whose key is absent from ``other``."""
    return df.join(other.select(key), key, "left_anti")


def assert_key(df: DataFrame, key: str) -> DataFrame:
    """``df`` itself when ``key`` is unique and non-null, else an error."""
    row = df.groupBy(key).agg(F.count("*").alias("n")).agg(
        F.coalesce(F.max("n"), F.lit(0)).alias("most"), F.count_if(F.col(key).isNull()).alias("nulls")
    ).first()
    if row["most"] > 1 or row["nulls"]:
        raise ValueError(f"{key} is not a unique non-null key")
    return df


def random_split(df: DataFrame, key: str, share: float = 0.8, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """Random split of expected shares, decided by the key and the seed alone."""
    train = _in_share(key, share, seed)
    return df.filter(train), df.filter(~train)


def _with_cuts(df: DataFrame, key: str, seed: int | str, cuts: dict[str, object], label: str | None = None) -> DataFrame:
    """``df`` with ``_h`` (the random order) and, for each cut, the hash of its last row in that order.

    ``cuts`` gives the rank of the last row from the count ``_n`` of the class (of all rows without ``label``);
    rank 0 gives a null. Counts by the hash's first four digits, 65,536 a class, tell in which range a cut
    falls; only the rows of these ranges are ranked, never the table.
    """
    marked = df.withColumn("_h", hash_order(key, seed)[0])
    keys = [label] if label else []
    lead = F.substring("_h", 1, 4).alias("_r")
    counts = marked.groupBy(*keys, lead).agg(F.count("*").alias("_c"))
    whole = Window.partitionBy(*keys)
    before = F.coalesce(F.sum("_c").over(whole.orderBy("_r").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    counts = counts.select(*keys, "_r", "_c", before.alias("_before"), F.sum("_c").over(whole).alias("_n"))
    places = F.array(*[F.struct(F.lit(c).alias("cut"), (rank(F.col("_n")) - F.col("_before")).alias("rank")) for c, rank in cuts.items()])
    held = F.filter(places, lambda x: (x["rank"] > 0) & (x["rank"] <= F.col("_c")))
    held = counts.select(*[F.col(k).alias(f"_k_{k}") for k in keys], F.col("_r").alias("_at"), F.explode(held).alias("_cut"))
    same = [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in keys]
    near = marked.select(*keys, "_h", lead).join(broadcast_within(held), [F.col("_r") == F.col("_at"), *same])
    order = F.row_number().over(Window.partitionBy(*keys, "_cut").orderBy("_h"))
    last = near.withColumn("_rank", order).where("_rank = _cut.rank").groupBy(
        *[F.col(k).alias(f"_k_{k}") for k in keys]
    ).agg(*[F.max(F.when(F.col("_cut.cut") == c, F.col("_h"))).alias(c) for c in cuts])
    return marked.join(broadcast_within(last), same, "left").drop(*[f"_k_{k}" for k in keys]) if keys else marked.join(F.broadcast(last))


def hashed_split(df: DataFrame, key: str, share: float = 0.7, seed: int | str = 42) -> DataFrame:
    """Exact random split without strata: ``data_split`` is train or test, by hash order. ``key`` must be unique."""
    cut = _with_cuts(df, key, seed, {"_train": lambda n: F.floor(n * F.lit(share))})
    return cut.withColumn("data_split", F.when(F.col("_h") <= F.col("_train"), "train").otherwise("test")).drop("_h", "_train")


def stratified_split(
    df: DataFrame, key: str, label: str, test: float = 0.20, validation: float = 0.20, seed: int | str = 42
) -> DataFrame:
    """Exact stratified split: adds ``data_split`` (train, validation, test).

    Per class, the first ``round(test * n)`` rows in hash order are test, the next
    ``round(validation * rest)`` validation. With the defaults 64/16/20. ``key`` must be
    unique. A class, however large, is counted by hash ranges and never sorted.
    """
    def validated(n):
        return F.round(n * test) + F.round((n - F.round(n * test)) * validation)

    cut = _with_cuts(df, key, seed, {"_test": lambda n: F.round(n * test), "_validation": validated}, label)
    return cut.withColumn(
        "data_split",
        F.when(F.col("_h") <= F.col("_test"), "test").when(F.col("_h") <= F.col("_validation"), "validation").otherwise("train"),
    ).drop("_h", "_test", "_validation")


def stratified_folds(df: DataFrame, key: str, label: str, folds: int = 3, seed: int | str = 42) -> DataFrame:
    """Add ``fold`` (0 to folds - 1), dealt out per class in hash order."""
    h, cut = hash_order(key, seed)
    ranked = number_rows(df.select("*", h, cut), "_h", "_rank", partition=[label], range_name="_h_range")
    return ranked.withColumn("fold", F.pmod(F.col("_rank") - 1, F.lit(folds)).cast("int")).drop(
        "_h", "_h_range", "_rank"
    )


def class_weights(df: DataFrame, label: str) -> DataFrame:
    """Per class: n, ``inverse_weight`` (largest class / n, 4 digits), ``balanced_weight``."""
    counts = df.groupBy(label).agg(F.count("*").alias("n"))
    whole = counts.agg(F.struct(F.max("n").alias("most"), F.sum("n").alias("rows"), F.count("*").alias("classes"))).scalar()
    return counts.select(
        label,
        "n",
        F.round(whole["most"] / F.col("n"), 4).alias("inverse_weight"),
        (whole["rows"] / (whole["classes"] * F.col("n"))).alias("balanced_weight"),
    )


def with_class_weight(df: DataFrame, label: str, balanced: bool = False, name: str = "weight") -> DataFrame:
    """Add the class weight as a column; the classes are broadcast when they are few."""
    chosen = "balanced_weight" if balanced else "inverse_weight"
    weights = class_weights(df, label).select(label, F.col(chosen).alias(name))
    return df.join(broadcast_within(weights), label, "left")


def label_index(df: DataFrame, label: str) -> DataFrame:
    """Labels by descending frequency, ties by name: (label, n, index). Labels are numbered range by range."""
    counts = df.filter(F.col(label).isNotNull()).groupBy(label).agg(F.count("*").alias("n"))
    ranked = number_rows(counts, "n", "index", descending=True, ties=[label])
    return ranked.withColumn("index", (F.col("index") - 1).cast("double"))


def first_per_class(df: DataFrame, label: str, position: str, n: int = 40, text: str | None = None, shortest: int = 20) -> DataFrame:
    """First ``n`` rows per class in ``position`` order; with ``text``, rows of enough characters only.

    Spark applies the row limit before the shuffle, so a large class ships ``n`` rows per task.
    """
    rows = df.filter(F.length(text) >= shortest) if text else df
    order = Window.partitionBy(label).orderBy(position)
    return rows.withColumn("_rn", F.row_number().over(order)).filter(F.col("_rn") <= n).drop("_rn")
