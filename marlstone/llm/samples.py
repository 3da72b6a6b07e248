"""Bounded samples of labelled rows to fit models on, the same on every run."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F



def remainder(key: str, mod: int) -> Column:
    """crc32 of the key as text, modulo ``mod``; -1 for a null key."""
    return F.coalesce(F.pmod(F.crc32(F.col(key).cast("string").cast("binary")), F.lit(mod)), F.lit(-1))


def bounded(rows: DataFrame, label: str, key: str, bound: int, seed: int = 17) -> DataFrame:
    """At most ``bound`` rows, about as many of each label as there are of the others.

    Each label's rate comes from its exact count; rows are chosen by a hash of key and seed, so neither
    order nor partitioning matters. Labels are few (languages, marks), so their counts fit anywhere.
    """
    counts = {r[label]: r["count"] for r in rows.groupBy(label).count().collect()}
    if not counts:
        return rows.limit(0)
    share = bound / len(counts)
    space = float(1 << 31)
    place = F.pmod(F.xxhash64(F.col(key), F.lit(seed)), F.lit(1 << 31))
    limits = pd.DataFrame({"_label": list(counts), "_limit": [min(1.0, share / n) * space for n in counts.values()]})
    limits = F.broadcast(rows.sparkSession.createDataFrame(limits, f"_label {rows.schema[label].dataType.simpleString()}, _limit double"))
    chosen = rows.join(limits, rows[label] == F.col("_label")).where(place < F.col("_limit"))
    return chosen.orderBy(F.xxhash64(F.col(key), F.lit(seed)), key).limit(bound).drop("_label", "_limit")
