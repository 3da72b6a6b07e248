"""Building blocks that keep the other operators distributed: checked broadcasts, joins that
survive hot keys, running totals and ranks over a total order, and exact quantiles.

Nothing here puts an unbounded group into one task: a total order is cut into ranges first, and
only one row per range (a bounded number) is ever added up in a single place.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from marlstone.session import settle

BROADCAST_ROWS = 10_000
OFFSET_ROWS = 200_000
#: Rows of an ordered range, and the least number of ranges.
RANGE_ROWS, LEAST_RANGES = 250_000, 32


def broadcast_within(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` marked for broadcast when it has at most ``max_rows`` rows, else ``df`` unchanged.

    The check reads at most ``max_rows + 1`` rows. A larger table takes the shuffle join that
    Spark plans without the hint.
    """
    rows = df.limit(max_rows + 1).collect()
    if len(rows) > max_rows:
        return df
    return F.broadcast(df.sparkSession.createDataFrame(rows, df.schema))


def lookup_join(
    big: DataFrame,
    terms: DataFrame,
    key: str,
    heat: str,
    spread: Column | str,
    hot_share: float = 0.001,
) -> DataFrame:
    """Left join of ``big`` with ``terms`` (one row per key) when some keys are very frequent.

    ``terms.heat`` says how often a key occurs in ``big``. Keys with at least ``hot_share`` of
    all occurrences number at most ``1 / hot_share``, so that part is broadcast whatever the
    table sizes. The other keys are joined by shuffle, where no key can be hot any more; rows
    already served travel under a spread-out key that matches nothing.
    """
    payload = [c for c in terms.columns if c != key]
    total = terms.agg(F.sum(heat).alias("n")).scalar()
    is_hot = F.col(heat) >= total * F.lit(hot_share)
    packed = terms.select(F.col(key), F.struct(*payload).alias("_row"), is_hot.alias("_hot"))
    hot = packed.filter("_hot").select(F.col(key), F.col("_row").alias("_hot_row"))
    cold = packed.filter(~F.col("_hot")).select(F.col(key).alias("_key"), F.col("_row").alias("_cold_row"))

    spread = F.col(spread) if isinstance(spread, str) else spread
    parked = F.concat(F.lit("\x00"), F.pmod(F.xxhash64(spread), F.lit(4096)).cast("string"))
    served = big.join(F.broadcast(hot), key, "left").withColumn(
        "_key", F.when(F.col("_hot_row").isNotNull(), parked).otherwise(F.col(key))
    )
    return (
        served.join(cold, "_key", "left")
        .withColumn("_row", F.coalesce("_hot_row", "_cold_row"))
        .select(*big.columns, *[F.col("_row")[c].alias(c) for c in payload])
    )


def with_range(df: DataFrame, column: str, splits: Sequence[float], name: str = "_range") -> DataFrame:
    """Add the index of the range each value falls into; equal values share a range."""
    if not splits:
        return df.withColumn(name, F.lit(0))
    edges = [float("-inf"), *splits, float("inf")]
    staged = df.withColumn("_v", F.col(column).cast("double"))
    return (
        Bucketizer(splits=edges, inputCol="_v", outputCol="_b", handleInvalid="keep")
        .transform(staged)
        .withColumn(name, F.col("_b").cast("int"))
        .drop("_v", "_b")
    )


def ordered_ranges(
    df: DataFrame, order: str, ties: Sequence[str] = (), descending: bool = False, partition: Sequence[str] = ()
) -> DataFrame:
    """``df`` settled in ranges of the order, sorted within each; ``_range`` is the range and ``_place`` ascends in it.

    Ranges follow ``order`` first and the tie keys within a heavy value, so a value that most rows have is cut
    like any other, and their number grows with the rows. Nulls of ``order`` come last when ascending and first
    when descending. Only rows equal in all keys share a range whatever their number.
    """
    rows = df.count()
    ranges = max(LEAST_RANGES, -(-rows // RANGE_ROWS))
    lead = F.desc_nulls_first(order) if descending else F.asc_nulls_last(order)
    keys = [*[F.asc(k) for k in partition], lead, *[F.asc(t) for t in ties]]
    dealt = settle(df.repartitionByRange(ranges, *keys).sortWithinPartitions(*keys))
    place = dealt.withColumn("_place", F.monotonically_increasing_id())
    return place.withColumn("_range", F.shiftright("_place", 33))


def _add_offsets(ranged: DataFrame, offsets: DataFrame, keys: list[str]) -> DataFrame:
    """``ranged`` with the columns of ``offsets`` (one row per key and range, keys named ``_k_``)."""
    return ranged.join(offsets, [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in keys], "left")


def running_totals(
    df: DataFrame,
    order: str,
    sums: dict[str, str],
    descending: bool = False,
    ties: Sequence[str] = (),
    partition: Sequence[str] = (),
    range_name: str | None = None,
) -> DataFrame:
    """Add running totals over a total order without a single-task window.

    ``sums`` maps a value column to the name of its running total (the row included). ``order``
    is the leading order key; ``ties`` are further ascending keys. ``range_name`` names
    an existing column that already cuts the order into ranges, monotone in it; without one,
    :func:`ordered_ranges` cuts them. Each range is summed in its own task, and the totals
    of the ranges (one row per range) are added up to give each range its starting value.
    """
    ranged = df if range_name else ordered_ranges(df, order, ties, descending, partition)
    cut = range_name or "_range"
    direction = F.desc if descending else F.asc
    keys = list(partition)
    inner = Window.partitionBy(*keys, cut)
    inner = inner.orderBy(direction(order), *[F.asc(t) for t in ties]) if range_name else inner.orderBy("_place")
    before = Window.partitionBy(*keys).orderBy(direction(cut) if range_name else F.asc(cut)).rowsBetween(Window.unboundedPreceding, -1)

    offsets = ranged.groupBy(*keys, cut).agg(*[F.sum(v).alias(f"_sum_{v}") for v in sums])
    offsets = offsets.select(
        *[F.col(k).alias(f"_k_{k}") for k in [*keys, cut]],
        *[F.coalesce(F.sum(f"_sum_{v}").over(before), F.lit(0)).alias(f"_off_{v}") for v in sums],
    )
    # One row per range, and per key that a range holds; their number is checked before broadcasting.
    offsets = broadcast_within(offsets, OFFSET_ROWS)
    inner = inner.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    out = ranged
    for v, name in sums.items():
        out = out.withColumn(name, F.sum(v).over(inner))
    out = _add_offsets(out, offsets, [*keys, cut])
    for v, name in sums.items():
        out = out.withColumn(name, F.col(name) + F.col(f"_off_{v}"))
    extra = [c for c in out.columns if c.startswith("_k_") or c.startswith("_off_")]
    return out.drop(*extra, *([] if range_name else ["_range", "_place"]))


def number_rows(
    df: DataFrame,
    order: str,
    name: str = "row_id",
    descending: bool = False,
    ties: Sequence[str] = (),
    partition: Sequence[str] = (),
    range_name: str | None = None,
) -> DataFrame:
    """Row numbers from 1 along a total order, computed range by range.

    Without ``range_name`` a row's place within its settled range is known as it is read, so numbering takes
    the one exchange that deals the ranges.
    """
    if range_name:
        return running_totals(
            df.withColumn("_one", F.lit(1).cast("bigint")), order, {"_one": name},
            descending, ties, partition, range_name,
        ).drop("_one")
    ranged, keys = ordered_ranges(df, order, ties, descending, partition), [*partition, "_range"]
    before = Window.partitionBy(*partition).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    counts = ranged.groupBy(*keys).agg(F.count("*").alias("_n"), F.min("_place").alias("_first"))
    offsets = counts.select(
        *[F.col(k).alias(f"_k_{k}") for k in keys], (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first") + 1).alias("_shift"))
    out = _add_offsets(ranged, broadcast_within(offsets, OFFSET_ROWS), keys)
    return out.withColumn(name, F.col("_place") + F.col("_shift")).select(*df.columns, name)


def hash_order(key: Column | str, seed: int | str, name: str = "_h") -> tuple[Column, Column]:
    """A repeatable random order: the MD5 text of key and seed, and its leading 4096-way range."""
    key = F.col(key) if isinstance(key, str) else key
    digest = F.md5(F.concat_ws("|", key.cast("string"), F.lit(str(seed))))
    return digest.alias(name), F.conv(F.substring(digest, 1, 3), 16, 10).cast("int").alias(f"{name}_range")


def exact_quantiles(
    df: DataFrame,
    columns: Sequence[str],
    probs: Sequence[float],
    bins: int = 2048,
    settle: int = 20_000,
) -> dict[str, list[float | None]]:
    """Exact linear-interpolated quantiles of numeric columns, NULL and NaN left out, infinities as values.

    Each wanted rank is narrowed by histograms. A round is one aggregate over the table for all
    columns and open ranks; it returns at most ``bins`` counts per open range, and a range then
    shrinks to the bin that holds the rank. A range of at most ``settle`` rows is counted by
    value, which settles its ranks. The driver sees bounded results only, and no task holds all
    values of a column.
    """
    number = {c: F.when(~F.isnan(F.col(c).cast("double")), F.col(c).cast("double")) for c in columns}
    values = df.select(*[number[c].alias(c) for c in columns])
    stats = values.agg(
        *[F.struct(F.count(c).alias("n"), F.min(c).alias("low"), F.max(c).alias("high")).alias(c) for c in columns]
    ).first()
    found: dict[tuple[str, int], float] = {}
    # (column, rank) -> (low, high, rows below low, rows inside); low and high occur in the column.
    open_ranks: dict[tuple[str, int], tuple[float, float, int, int]] = {}
    for c in columns:
        n = stats[c]["n"]
        for k in {k for p in probs for k in (int(p * (n - 1)), min(int(p * (n - 1)) + 1, n - 1))} if n else ():
            open_ranks[c, k] = (stats[c]["low"], stats[c]["high"], 0, n)
    while True:
        for key, (low, high, _, _) in list(open_ranks.items()):
            if low == high:
                found[key] = low
                del open_ranks[key]
        if not open_ranks:
            break
        ranges = sorted({(c, *state) for (c, _), state in open_ranks.items()})
        counted: dict[int, list] = {i: [] for i in range(len(ranges))}
        for row in _count_ranges(values, ranges, bins, settle).collect():
            counted[row["r"]].append((row["low"], row["high"], row["n"]))
        for i, (c, low, high, below, inside) in enumerate(ranges):
            start = below
            for bin_low, bin_high, n in sorted(counted[i]):
                for (name, k), state in list(open_ranks.items()):
                    if name == c and state == (low, high, below, inside) and start <= k < start + n:
                        open_ranks[name, k] = (bin_low, bin_high, start, n)
                start += n
    return {c: [_interpolate(found, c, stats[c]["n"], p) for p in probs] for c in columns}


def _place(v: Column, low: float, high: float, bins: int) -> Column:
    """The bin of a value within [low, high], monotone in it; ``low`` and ``high`` never share one.

    Ends of one sign and magnitude are cut into equal steps, others into equal steps of the logarithm, so
    that every round shrinks a range whatever its magnitudes. Infinities have bins of their own.
    """
    largest = sys.float_info.max
    if math.isinf(low) or math.isinf(high):
        inner = _place(v, max(low, -largest), min(high, largest), bins) if low < largest and high > -largest else F.lit(0.0)
        return F.when(v == float("inf"), F.lit(float(bins))).when(v == float("-inf"), F.lit(-1.0)).otherwise(inner)
    if low * high > 0 and 0.25 <= low / high <= 4 or max(abs(low), abs(high)) < 1e-290:
        return F.least(F.floor((v - low) / (high - low) * bins), F.lit(bins - 1)).cast("double")

    def steps(x):  # 0 for 0, from 1 (the least double) to 1456 either side of it
        return F.when(x == 0, 0.0).otherwise(F.signum(x) * (F.log(F.abs(x)) + 746))

    start = math.copysign(math.log(abs(low)) + 746, low) if low else 0.0
    end = math.copysign(math.log(abs(high)) + 746, high) if high else 0.0
    return F.greatest(F.lit(0.0), F.least(F.floor((steps(v) - start) / (end - start) * bins), F.lit(bins - 1)).cast("double"))


def _count_ranges(values: DataFrame, ranges: list[tuple], bins: int, settle: int) -> DataFrame:
    """Counts per range and bin (small ranges: per value): (r, low, high, n)."""
    pieces = []
    for i, (c, low, high, _, inside) in enumerate(ranges):
        v = F.col(c)
        place = v if inside <= settle else _place(v, low, high, bins)
        pieces.append(
            F.when(v.between(low, high), F.struct(F.lit(i).alias("r"), place.alias("b"), v.alias("v")))
        )
    hits = values.select(F.explode(F.array(*pieces)).alias("h")).filter("h IS NOT NULL").select("h.*")
    return hits.groupBy("r", "b").agg(F.min("v").alias("low"), F.max("v").alias("high"), F.count("v").alias("n"))


def _interpolate(found: dict, column: str, n: int, p: float) -> float | None:
    if not n:
        return None
    position = p * (n - 1)
    k = int(position)
    low, high = found[column, k], found[column, min(k + 1, n - 1)]
    return low if low == high or position == k else low + (high - low) * (position - k)
