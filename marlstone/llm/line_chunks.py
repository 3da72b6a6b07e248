"""Removal of repeated line chunks. Chunk borders follow the content, so they survive lines put in before them.

DataFrame functions only: no Python runs on the data.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marlstone.llm.links import cut

#: Lines the rolling hash sees, its base and modulus, and the lines of a chunk on average.
SEEN, BASE, MODULUS, MEAN_LINES = 3, 31, 2_147_483_647, 4


def lines_of(text: Column) -> Column:
    return F.split(text, "\n", -1)


def chunks(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with ``chunks``: for each chunk of two lines or more its first line (from 1), lines and hash.

    A line's hash is the leading 32 bits of its MD5; the rolling hash is a polynomial over the hashes of the
    last ``SEEN`` lines. A chunk ends after a line whose rolling hash is divisible by ``MEAN_LINES``, and at
    the end of the text.
    """
    def number(line: Column) -> Column:
        return F.conv(F.substring(F.md5(line), 1, 8), 16, 10).cast("long")

    n = F.size("_h")
    before = lambda i, k: F.when(i > k, F.element_at("_h", (i - k).cast("int"))).otherwise(F.lit(0))

    def rolling(i: Column) -> Column:
        total = F.lit(0).cast("long")
        for k in reversed(range(SEEN)):
            total = (total * BASE + before(i, k)) % MODULUS
        return total

    hashed = docs.withColumn("_l", lines_of(F.col(text))).withColumns({
        "_h": F.transform("_l", number), "_x": F.transform("_l", lambda x: F.xxhash64(x)),
    }).drop("_l")
    ends = hashed.withColumn("_e", F.filter(
        F.sequence(F.lit(1), n), lambda i: (i == n) | (rolling(i) % MEAN_LINES == 0)
    ))

    def chunk(end: Column, k: Column) -> Column:
        start = F.when(k > 0, F.element_at("_e", k) + 1).otherwise(F.lit(1))
        return F.struct(start.alias("start"), (end - start + 1).alias("n"), F.xxhash64(
            F.slice("_x", start, end - start + 1)).alias("hash"))

    found = F.filter(F.transform("_e", chunk), lambda c: c["n"] > 1)
    return ends.withColumn("chunks", found).drop("_h", "_x", "_e")


def pairs(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with ``chunks`` as above, where every line and the next one are a chunk: they overlap."""
    hashed = docs.withColumn("_x", F.transform(lines_of(F.col(text)), lambda x: F.xxhash64(x)))
    both = F.zip_with("_x", F.slice("_x", F.lit(2), F.size("_x")), lambda a, b: F.when(b.isNotNull(), F.xxhash64(a, b)))
    found = F.transform(both, lambda h, i: F.struct((i + 1).alias("start"), F.lit(2).alias("n"), h.alias("hash")))
    return hashed.withColumn("chunks", F.filter(found, lambda c: c["hash"].isNotNull())).drop("_x")


def _joined(marks: Column) -> Column:
    """Sorted (start, n) with those that overlap made one."""
    none = F.expr("cast(array() AS array<struct<start:int,n:int>>)")

    def add(acc: Column, m: Column) -> Column:
        last = F.element_at(acc, -1)
        end = F.greatest(last["start"] + last["n"], m["start"] + m["n"])
        longer = F.struct(last["start"].alias("start"), (end - last["start"]).alias("n"))
        return F.when((F.size(acc) > 0) & (m["start"] < last["start"] + last["n"]), F.concat(
            F.slice(acc, F.lit(1), F.size(acc) - 1), F.array(longer))).otherwise(F.concat(acc, F.array(m)))

    return F.aggregate(marks, none, add)


def remove_repeated(docs: DataFrame, key: str = "doc_id", text: str = "text", every_pair: bool = False) -> DataFrame:
    """One row per row of ``docs``: ``row`` (all its columns), n_lines, removed (first line and lines of each chunk), clean.

    A chunk of two lines or more that occurs elsewhere in the corpus stays at its first place (smallest key,
    then first in the text) and is removed at the others, after its bytes were compared with the first place's.
    ``clean`` is the text without them.

    Borders set by the rolling hash depend on ``SEEN`` lines, so a short repeated passage inside different
    texts mostly shares no whole chunk with its other places. With ``every_pair`` each pair of neighbouring
    lines is a chunk instead, so every repeated run of two lines or more goes, whatever surrounds it, and with
    it all that the rolling hash finds; ``removed`` then holds runs. Every line stays at its first place.
    Only a line repeated without a repeated neighbour stays everywhere.

    Chunks travel as hashes and places first; counts are aggregated before they are shuffled. Only documents
    with a repeated chunk show its bytes, and only to the first place of the same hash. Joins are by document
    or by hash with one row a hash on one side, so adaptive execution splits a hot chunk. Equal chunks cost a
    row each, never a pair. Chunk places are checkpointed; texts are shuffled by document twice, to show
    repeated chunks and to cut them.

    A null text has no lines and a null ``clean``; an empty text has one empty line. Single lines are never
    removed. Rows that agree in key and text share their fate. Null keys come before all others. An
    empty table gives an empty result; other columns pass in ``row``.
    """
    rows = docs.select(F.col(key).alias("key"), F.xxhash64(text).alias("part"), F.struct(
        *[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    found = (pairs if every_pair else chunks)(docs.select(F.col(key).alias("key"), F.xxhash64(text).alias("part"), F.col(text).alias("text")))
    # The outer form: the plain one would add a filter on "chunks" that works out the whole array once more per line.
    found = found.select("key", "part", F.explode_outer("chunks").alias("c")).select("key", "part", "c.*")
    found = cut(found.where("n IS NOT NULL"))
    place = F.struct("key", "part", "start")
    first = found.groupBy("hash").agg(F.min(place).alias("first"), F.max(place).alias("last"))
    first = first.where(~F.col("first").eqNullSafe(F.col("last"))).select("hash", "first")
    marks = cut(found.join(first, "hash").groupBy("key", "part").agg(
        F.collect_set(F.struct("start", "n", "hash", place.eqNullSafe(F.col("first")).alias("is_first"))).alias("marks")))

    def same(a: DataFrame, b: DataFrame, how: str) -> DataFrame:
        b = b.select(F.col("key").alias("_key"), F.col("part").alias("_part"), *[c for c in b.columns if c not in ("key", "part")])
        return a.join(b, a["key"].eqNullSafe(b["_key"]) & (a["part"] == b["_part"]), how).drop("_key", "_part")

    lines = F.col("_lines")
    shown = same(rows, marks, "inner").withColumn("_lines", lines_of(F.col("row")[text])).select(
        "key", "part", F.explode_outer(F.transform("marks", lambda m: F.struct(m.alias("m"), F.array_join(
            F.slice(lines, m["start"], F.least(m["n"], F.size(lines))), "\n").alias("bytes")))).alias("s"),
    ).select("key", "part", "s.m.*", "s.bytes")
    original = shown.where("is_first").groupBy("hash").agg(F.min("bytes").alias("original"))
    gone = shown.where("NOT is_first").join(original, "hash").where(F.col("bytes") == F.col("original"))
    gone = gone.groupBy("key", "part").agg(F.sort_array(F.collect_set(F.struct("start", "n"))).alias("removed"))

    out = same(rows, gone, "left").withColumn("_lines", lines_of(F.col("row")[text]))
    removed = F.coalesce(_joined(F.col("removed")) if every_pair else "removed", F.expr("cast(array() AS array<struct<start:int,n:int>>)"))
    out = out.withColumn("removed", removed)

    def gap(k: Column) -> Column:
        start = F.when(k > 0, F.element_at("removed", k)["start"] + F.element_at("removed", k)["n"]).otherwise(F.lit(1))
        end = F.when(k < F.size("removed"), F.element_at("removed", k + 1)["start"]).otherwise(F.size(lines) + 1)
        return F.slice(lines, start, end - start)

    clean = F.when(F.size("removed") > 0, F.array_join(F.flatten(
        F.transform(F.sequence(F.lit(0), F.size("removed")), gap)), "\n")).otherwise(F.col("row")[text])
    count = F.when(lines.isNull(), F.lit(0)).otherwise(F.size(lines))
    return out.select("row", count.cast("long").alias("n_lines"), "removed", clean.alias("clean"))


def _summary(spark: SparkSession, sf_dir: str, **settings) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    gone = F.aggregate("removed", F.lit(0).cast("long"), lambda n, r: n + r["n"])
    return remove_repeated(docs, **settings).select(
        "row.doc_id", "n_lines", F.size("removed").cast("long").alias("removed_chunks"), gone.alias("removed_lines"),
        F.md5("clean").alias("clean_md5"))


def op6_line_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _summary(spark, sf_dir)


def op6b_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As ``op6_line_chunks``, whose SQL fixes the borders of the rolling hash, with every repeated run of lines."""
    return _summary(spark, sf_dir, every_pair=True)


OP6_SQL = """
WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS l, generate_subscripts(string_split(text, chr(10)), 1) AS i FROM documents),
h AS (SELECT *, CAST('0x' || substr(md5(l), 1, 8) AS BIGINT) AS h FROM l),
r AS (SELECT *, ((coalesce(lag(h, 2) OVER d, 0) * 31 + coalesce(lag(h) OVER d, 0)) % 2147483647 * 31 + h) % 2147483647 AS r
    FROM h WINDOW d AS (PARTITION BY doc_id ORDER BY i)),
c AS (SELECT *, coalesce(sum(CASE WHEN r % 4 = 0 THEN 1 ELSE 0 END)
    OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS c FROM r),
k AS (SELECT doc_id, c, min(i) AS s, count(*) AS n, string_agg(l, chr(10) ORDER BY i) AS t FROM c GROUP BY 1, 2),
g AS (SELECT *, n > 1 AND row_number() OVER (PARTITION BY t ORDER BY doc_id, s) > 1 AS gone FROM k),
out AS (SELECT doc_id, sum(n) AS n_lines, count(*) FILTER (gone) AS removed_chunks, coalesce(sum(n) FILTER (gone), 0) AS removed_lines,
    md5(coalesce(string_agg(t, chr(10) ORDER BY s) FILTER (NOT gone), '')) AS clean_md5 FROM g GROUP BY 1)
SELECT doc_id, CAST(coalesce(n_lines, 0) AS BIGINT) AS n_lines, coalesce(removed_chunks, 0) AS removed_chunks,
    CAST(coalesce(removed_lines, 0) AS BIGINT) AS removed_lines, clean_md5 FROM documents LEFT JOIN out USING (doc_id)
"""
