"""Keeping a corpus of keyed records: merging, repairing, refreshing, counting, sampling.

Record order decides several rules (the last record wins, the newest are last), so these
operators take an explicit sequence column.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from marlstone.functions import text
from marlstone.operators.scale import hash_order, number_rows

KEY = "publication_url"
PARTS = ("/en/organisations/", "/en/publications/", "/en/persons/")


def keyed(df: DataFrame, key: str = KEY) -> DataFrame:
    """Rows with a non-empty key."""
    return df.filter(F.coalesce(F.col(key), F.lit("")) != "")


def titled(df: DataFrame) -> DataFrame:
    """Rows with a non-empty title."""
    return df.filter(F.coalesce("title", F.lit("")) != "")


def last_record(df: DataFrame, key: str = KEY, seq: str = "seq") -> DataFrame:
    """The last record per key, whole. Each task keeps one row per key before the shuffle."""
    order = Window.partitionBy(key).orderBy(F.desc(seq))
    return keyed(df, key).withColumn("_rn", F.row_number().over(order)).filter("_rn = 1").drop("_rn")


def merge(
    old: DataFrame,
    new: DataFrame,
    key: str = KEY,
    seq: str = "seq",
    tags: str = "organisations",
    fixed_tag: str | None = None,
) -> DataFrame:
    """Upsert ``new`` into ``old``. NULL means the field is absent, '' is a value.

    Per key: the last old record counts; of repeated new records each field's last present value
    counts; new fields win over old ones. ``tags`` become the sorted union of the old record's
    and every new record's, or of the old record's and ``fixed_tag`` when that is given.
    """
    fields = [c for c in old.columns if c not in (key, seq, tags)]
    base = last_record(old, key, seq).select(
        F.col(key), F.lit(True).alias("_old"), F.col(tags).alias("_old_tags"),
        *[F.col(c).alias(f"_old_{c}") for c in fields],
    )
    fresh = keyed(new, key)
    if fixed_tag is None:
        # A set per key, built from single tags: repeats of a record add nothing to it. A record's fields stand
        # beside each of its tags, so that one pass and one shuffle serve both.
        fresh = fresh.withColumn("_tag", F.explode_outer(tags))
        gathered = F.collect_set("_tag")
    else:
        gathered = F.array(F.lit(fixed_tag))
    latest = fresh.groupBy(key).agg(
        F.lit(True).alias("_new"), gathered.alias("_new_tags"),
        *[F.max_by(c, F.when(F.col(c).isNotNull(), F.col(seq))).alias(f"_new_{c}") for c in fields],
    )
    empty = F.array().cast("array<string>")
    union = F.array_sort(F.array_union(F.coalesce("_old_tags", empty), F.coalesce("_new_tags", empty)))
    # A record that only the old side has keeps its tags as they are.
    return base.join(latest, key, "full_outer").select(
        key,
        *[F.coalesce(f"_new_{c}", f"_old_{c}").alias(c) for c in fields],
        F.when(F.col("_new"), union).otherwise(F.col("_old_tags")).alias(tags),
    )


def replace_records(old: DataFrame, new: DataFrame, key: str = KEY, seq: str = "seq") -> DataFrame:
    """Whole-record replace by key: a new record displaces the old one."""
    both = old.withColumn("_side", F.lit(0)).unionByName(new.withColumn("_side", F.lit(1)), allowMissingColumns=True)
    order = Window.partitionBy(key).orderBy(F.desc("_side"), F.desc(seq))
    return both.withColumn("_rn", F.row_number().over(order)).filter("_rn = 1").drop("_rn", "_side")


def union_distinct(a: DataFrame, b: DataFrame) -> DataFrame:
    """Set union of two one-column lists."""
    return a.union(b).distinct()


def year_counts(df: DataFrame, year: str = "year") -> DataFrame:
    return df.groupBy(F.coalesce(F.col(year), F.lit("Unknown")).alias("year")).agg(F.count("*").alias("count")).orderBy("year")


def year_gaps(df: DataFrame, first: int = 2010, last: int = 2025, target: int = 10, year: str = "year") -> DataFrame:
    """Years of the spine with fewer than ``target`` records, years without any included."""
    years = [str(y) for y in range(first, last + 1)]
    spine = df.sparkSession.range(first, last + 1).select(F.col("id").cast("string").alias("year"))
    counts = df.filter(F.col(year).isin(years)).groupBy(F.col(year).alias("year")).agg(F.count("*").alias("n"))
    # Both sides have at most one row per year of the spine.
    return (
        spine.join(F.broadcast(counts), "year", "left")
        .select("year", F.coalesce("n", F.lit(0)).cast("bigint").alias("n"))
        .filter(F.col("n") < target)
    )


def needs_refresh(shortest: int = 500, everything: bool = False) -> Column:
    """Short abstract, an author called "profiles", or authors without links."""
    if everything:
        return F.lit(True)
    short = F.length(F.coalesce("abstract", F.lit(""))) < shortest
    placeholder = F.coalesce(F.exists("authors", lambda a: F.lower(a) == "profiles"), F.lit(False))
    authors, links = F.coalesce(F.size("authors"), F.lit(0)), F.coalesce(F.size("author_links"), F.lit(0))
    return short | placeholder | ((links <= 0) & (authors > 0))


def refresh(
    current: DataFrame, extracted: DataFrame, limit: int | None = None, key: str = KEY, seq: str = "seq",
    everything: bool = False,
) -> DataFrame:
    """Take longer abstracts and different authors from newly extracted pages.

    Adds ``changed``. ``limit`` counts changed rows only, in ``seq`` order.
    """
    fetched = extracted.select(
        F.col(key), F.coalesce("abstract", F.lit("")).alias("_abstract"),
        F.col("authors").alias("_authors"), F.col("author_links").alias("_links"), F.lit(True).alias("_found"),
    )
    joined = current.join(fetched, key, "left")
    due = needs_refresh(everything=everything) & F.coalesce("_found", F.lit(False)) & (F.coalesce(F.col(key), F.lit("")) != "")
    longer = due & (F.length("_abstract") > F.length(F.coalesce("abstract", F.lit(""))))
    other = due & (~F.col("authors").eqNullSafe(F.col("_authors")) | ~F.col("author_links").eqNullSafe(F.col("_links")))
    marked = joined.withColumn("_longer", longer).withColumn("_other", other)
    marked = marked.withColumn("changed", F.col("_longer") | F.col("_other"))
    if limit is not None:
        # The n-th changed row in order is where updating stops.
        place = F.struct(F.col(seq), F.col(key))
        last = marked.filter("changed").select(place.alias("p")).orderBy("p").limit(limit).agg(F.max("p")).scalar()
        marked = marked.withColumn("changed", F.col("changed") & (place <= last))
    return marked.select(
        *[
            F.when(F.col("changed") & F.col("_longer"), F.col("_abstract")).otherwise(F.col("abstract")).alias(c)
            if c == "abstract"
            else F.when(F.col("changed") & F.col("_other"), F.col("_authors")).otherwise(F.col("authors")).alias(c)
            if c == "authors"
            else F.when(F.col("changed") & F.col("_other"), F.col("_links")).otherwise(F.col("author_links")).alias(c)
            if c == "author_links"
            else F.col(c)
            for c in current.columns
        ],
        F.coalesce("changed", F.lit(False)).alias("changed"),
    )


def repair_urls(df: DataFrame, prefix: str, limit: int | None = None, key: str = KEY) -> DataFrame:
    """Canonical URLs from titles, with the original and whether it already matched."""
    repaired = text.repaired_url(key, "title", prefix, limit)
    return df.withColumn("original_url", F.col(key)).withColumn(key, repaired).withColumn(
        "matches", F.col("original_url").eqNullSafe(F.col(key))
    )


def repair_count(repaired: DataFrame) -> DataFrame:
    return repaired.agg(F.count_if(~F.col("matches")).alias("repaired"), F.count("*").alias("records"))


def crawlable_links(links: DataFrame, seed_url: str | None = None, url: str = "url") -> DataFrame:
    """Links to organisation, publication or person pages, on the seed's host when one is given."""
    wanted = F.lit(False)
    for part in PARTS:
        wanted = wanted | F.contains(F.col(url), F.lit(part))
    rows = links.filter(wanted)
    if seed_url is not None:
        rows = rows.filter(text.host(url) == text.host(F.lit(seed_url)))
    return rows


def newest(urls: DataFrame, n: int = 1000, position: str = "pos") -> DataFrame:
    """The last ``n`` of an ordered list."""
    return urls.orderBy(F.desc(position)).limit(n)


def newest_and_sample(
    urls: DataFrame, newest_n: int = 100, sample_n: int = 100, seed: int | str = 42, url: str = "url", position: str = "pos"
) -> DataFrame:
    """The newest URLs and a repeatable random sample of the older ones; a short list is kept whole."""
    total = urls.agg(F.count("*")).scalar()
    tail = newest(urls, newest_n, position)
    start = tail.agg(F.min(position)).scalar()
    digest = F.md5(F.concat_ws("|", F.col(url), F.lit(str(seed))))
    older = urls.filter(F.col(position) < start).orderBy(digest, F.col(position)).limit(sample_n)
    chosen = tail.select(url).union(older.select(url)).distinct().filter(total > newest_n + sample_n)
    return chosen.union(urls.filter(total <= newest_n + sample_n).select(url))


def augment(pubs: DataFrame, n: int, seed: int | str = 42, key: str = KEY) -> DataFrame:
    """``n`` varied copies of records drawn with replacement.

    Copy i is the record whose number in hash order of its URL is drawn from MD5(i | seed); its
    title and URL get a numbered suffix and its year moves by -1, 0 or 1.
    """
    h, cut = hash_order(key, seed)
    numbered = number_rows(pubs.select("*", h, cut), "_h", "_n", range_name="_h_range", ties=[key]).drop("_h", "_h_range")
    total = pubs.agg(F.count("*")).scalar()
    digest = F.md5(F.concat_ws("|", (F.col("id") + 1).cast("string"), F.lit(str(seed))))
    part = lambda start: F.conv(F.substring(digest, start, 8), 16, 10).cast("bigint")
    draws = pubs.sparkSession.range(n).select(
        (F.col("id") + 1).alias("copy"), (part(1) % total + 1).alias("_n"), (part(9) % 3 - 1).alias("_shift")
    )
    number = F.col("copy").cast("string")
    year = F.coalesce(F.col("year").try_cast("bigint"), F.lit(2023))
    changed = {
        "title": F.concat(F.coalesce("title", F.lit("Untitled")), F.lit(" (Augmented "), number, F.lit(")")),
        key: F.concat(F.coalesce(F.col(key), F.lit("http://example.com")), F.lit("?aug="), number),
        "year": (year + F.col("_shift")).cast("string"),
    }
    return numbered.join(draws, "_n").select("copy", *[changed.get(c, F.col(c)).alias(c) for c in pubs.columns])


def to_json_text(records: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Records as JSON text, and back: see :func:`from_json_text`."""
    return records.select(F.to_json(F.struct(*columns)).alias("json"))


def from_json_text(df: DataFrame, schema: str, column: str = "json") -> DataFrame:
    return df.select(F.from_json(column, schema).alias("r")).select("r.*")
