"""Mixing sources to target weights: entropy balancing of document rates, rounded into copies."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from marlstone.llm.links import cut

#: Weights of the sources by code point, repeating; words of the mix per word of input; most copies of a document.
WEIGHTS = (5, 2, 1)
BUDGET = 1.5
MOST = 2
#: Newton stops at this relative error of every source.
EXACT, ROUNDS = 1e-9, 60
#: Larger sizes that are tried where words are left over.
TRIES = 32
#: Hash buckets that documents of one source and size are dealt into before they are ranked.
BUCKETS = 4096


def targets(sizes: pd.DataFrame, weights: Sequence[float] = WEIGHTS, budget: float = BUDGET, most: float = MOST) -> pd.DataFrame:
    """``sizes`` (source, source_size; null last) with ``target``: shares by weight of ``budget`` times all words.

    A target stops at ``most`` times its source's size; what is above goes to the others by weight, until
    no target is above.
    """
    out = sizes.copy()
    names = out["source"].map(lambda s: (s is None, s or ""))
    out = out.loc[names.sort_values().index].reset_index(drop=True)
    size = out["source_size"].to_numpy(float)
    weight = np.array([weights[i % len(weights)] for i in range(len(out))], float)
    target, free, left = np.zeros(len(out)), np.ones(len(out), bool), budget * size.sum()
    while free.any():
        share = left * weight / weight[free].sum()
        above = free & (share > most * size)
        if not above.any():
            target[free] = share[free]
            break
        target[above] = most * size[above]
        free &= ~above
        left -= target[above].sum()
    out["target"] = target
    return out


def balance(sizes: DataFrame, wanted: pd.DataFrame, most: float = MOST) -> pd.DataFrame:
    """``wanted`` with ``tilt``, the solution of the convex dual, by damped Newton steps.

    Among all rates r between 0 and ``most`` whose words meet the targets, the ones of least relative
    entropy to one copy each are ``most * s(tilt * size / scale)`` (s the logistic function): exponential
    tilts of the documents' odds by their size. The dual is one smooth convex function of a tilt per
    source. Each round sums its gradient and curvature over the table of sizes (source, size, docs) on
    Spark; the driver holds one number per source. Sums are decimals, so their order cannot matter.
    """
    state = wanted.copy()
    state["id"] = np.arange(len(state))
    state["tilt"], state["low"], state["high"] = 0.0, -np.inf, np.inf
    full = state["target"] >= most * state["source_size"] * (1 - 1e-12)
    state.loc[full, "tilt"] = np.inf  # every document as often as allowed
    spark = sizes.sparkSession
    active = ~full & (state["source_size"] > 0)
    for _ in range(ROUNDS):
        if not active.any():
            break
        tilts = spark.createDataFrame(
            [(int(r.id), float(r.tilt)) for r in state[active].itertuples()], "id bigint, tilt double")
        z = F.col("size") / F.col("scale")
        s = 1 / (1 + F.exp(-F.col("tilt") * z))
        words = F.col("docs") * F.col("size") * most
        found = sizes.join(F.broadcast(tilts), "id").groupBy("id").agg(
            F.sum((words * s).cast("decimal(38,8)")).cast("double").alias("value"),
            F.sum((words * s * (1 - s) * z).cast("decimal(38,8)")).cast("double").alias("slope"),
        ).toPandas().set_index("id")
        for i in state.index[active]:
            own = state.loc[i]
            miss = found.loc[own["id"], "value"] - own["target"]
            if abs(miss) <= EXACT * max(own["target"], 1.0):
                active[i] = False
                continue
            low, high = (own["low"], own["tilt"]) if miss > 0 else (own["tilt"], own["high"])
            slope = found.loc[own["id"], "slope"]
            step = own["tilt"] - miss / slope if slope > 0 else np.nan
            if not low < step < high or abs(step - own["tilt"]) > 50 + 10 * abs(own["tilt"]):
                if np.isfinite(low) and np.isfinite(high):
                    step = (low + high) / 2
                else:
                    step = own["tilt"] + np.sign(-miss) * max(8.0, 2 * abs(own["tilt"]))
            state.loc[i, ["low", "high", "tilt"]] = low, high, step
    return state


def _even(docs: list[int], size: list[int], copies: list[int], left: int) -> tuple[list[int], int]:
    """Copies with ``left`` more words (fewer, if negative), and the words that no copy fits: largest sizes first."""
    copies = list(copies)
    for k, (n, s) in enumerate(zip(docs, size)):
        if s and abs(left) >= s:
            move = min(abs(left) // s, MOST * n - copies[k] if left > 0 else copies[k])
            copies[k] += move if left > 0 else -move
            left += -move * s if left > 0 else move * s
    return copies, left


def _allot(own: pd.DataFrame) -> pd.DataFrame:
    """Whole copies for each size of one source: rounded along falling sizes, then words are evened out.

    Copies are the differences of rounded running sums of rates, so a size's documents get theirs to within
    one. The words still missing or too many are made good by single copies, largest fitting size first,
    which ends within the smallest size that can still move.
    """
    own = own.sort_values("size", ascending=False, ignore_index=True)
    docs, size = own["docs"].to_numpy(np.int64).tolist(), own["size"].to_numpy(np.int64).tolist()
    rate = [int(round(r * 10**6)) for r in own["rate"]]
    copies, run, before = [], 0, 0
    for n, r in zip(docs, rate):
        run += n * r
        now = (run + 500_000) // 10**6
        copies.append(min(max(now - before, 0), MOST * n))
        before = now
    copies, left = _even(docs, size, copies, int(round(own["target"].iloc[0])) - sum(c * s for c, s in zip(copies, size)))
    # Where that ends far off, a copy of a larger document goes the same way and smaller ones go back.
    larger = [k for k in reversed(range(len(size))) if size[k] > abs(left) and (copies[k] if left < 0 else copies[k] < MOST * docs[k])]
    for k in larger[:TRIES]:
        if not left:
            break
        step = 1 if left > 0 else -1
        other = [c + step * (i == k) for i, c in enumerate(copies)]
        other, rest = _even(docs, size, other, left - step * size[k])
        if abs(rest) < abs(left):
            copies, left = other, rest
            break
    own["copies"] = copies
    return own[["id", "size", "docs", "copies"]]


def mix(
    docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source",
    weights: Sequence[float] = WEIGHTS, budget: float = BUDGET,
) -> DataFrame:
    """One row per row of ``docs``: ``row`` (all its columns), size, source_size, target, copies.

    ``size`` is the number of words between ASCII white space. Rates that meet each source's target are
    found by entropy balancing (``balance``), and rounded into 0, 1 or 2 copies (``_allot``): both need only
    the documents counted by source and size. Which documents of a source and size get the odd copy is
    drawn by a hash of key and text: counts by hash bucket say which buckets are in, and only the
    bucket at the border is ranked, so no source and no size is ever one group.

    A null text has size 0; documents without words are kept once and count no words. A null source is a
    source of its own, last in order. Rows that agree in key, text and source are interchangeable. Reruns agree.
    Sources are taken to be few (one row each at the driver). An empty table gives an empty result.
    """
    size = F.coalesce(F.regexp_count(F.col("row")[text], F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    rows = rows.withColumn("size", size).withColumn("order", F.xxhash64(F.col("row")[key], F.col("row")[text], F.lit(29)))
    rows = rows.withColumns({"bucket": F.pmod("order", F.lit(BUCKETS)), "name": F.col("row")[source].cast("string")})
    spark = docs.sparkSession

    counts = cut(rows.groupBy("name", "size", "bucket").agg(F.count("*").alias("docs")))
    sizes = counts.groupBy(F.col("name").alias("source")).agg(
        F.sum(F.col("size") * F.col("docs")).alias("source_size"), F.max("size").alias("scale")).toPandas()
    sizes["source"] = sizes["source"].astype(object).where(sizes["source"].notna(), None)
    wanted = targets(sizes, weights, budget)
    wanted["id"] = np.arange(len(wanted))
    known = F.broadcast(spark.createDataFrame(
        [(r.source, int(r.id), int(r.source_size), float(r.target), int(r.scale)) for r in wanted.itertuples()],
        "_name string, id bigint, source_size bigint, target double, scale bigint"))

    def named(table: DataFrame) -> DataFrame:
        return table.join(known, F.col("name").eqNullSafe(F.col("_name"))).drop("_name")

    by_bucket = named(counts)
    by_size = cut(by_bucket.groupBy("id", "size", "target", "scale").agg(F.sum("docs").alias("docs")))
    tilted = balance(by_size, wanted)
    tilts = F.broadcast(spark.createDataFrame([(int(r.id), float(r.tilt)) for r in tilted.itertuples()], "id bigint, tilt double"))
    rate = F.when(F.col("size") == 0, F.lit(1.0)).when(F.col("tilt") == float("inf"), F.lit(float(MOST))).otherwise(
        MOST / (1 + F.exp(-F.col("tilt") * F.col("size") / F.col("scale"))))
    allotted = by_size.join(tilts, "id").withColumn("rate", rate).groupBy("id").applyInPandas(
        _allot, "id bigint, size bigint, docs bigint, copies bigint")
    allotted = allotted.select("id", "size", F.floor(F.col("copies") / F.col("docs")).alias("base"),
                               (F.col("copies") % F.col("docs")).alias("odd"))
    before = F.coalesce(F.sum("docs").over(
        Window.partitionBy("id", "size").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    share = by_bucket.withColumn("before", before).join(allotted, ["id", "size"]).select(
        "id", "size", "bucket", "base", F.least(F.greatest(F.col("odd") - F.col("before"), F.lit(0)), F.col("docs")).alias("odd"))

    group = Window.partitionBy("id", "size", "bucket").orderBy("order", F.col("row")[key])
    out = named(rows).withColumn("place", F.row_number().over(group)).join(share, ["id", "size", "bucket"])
    copies = (F.col("base") + (F.col("place") <= F.col("odd")).cast("long")).alias("copies")
    return out.select("row", "size", "source_size", "target", copies)


def op5_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "source")
    return mix(docs).select(
        "row.doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "copies")
