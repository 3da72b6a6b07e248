"""Inverted index and BM25 ranking as tables.

Index tables: ``docs`` (metadata), ``postings(term, doc_id, tf, dl)``, ``doc_stats(doc_id, dl)``
and ``term_stats(term, df, idf)``. Postings are a long table, so a term found in every document
is many rows, never one value; the document length travels with the posting, so that scoring
needs no join on documents.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from marlstone.functions import fixed, text
from marlstone.session import settle

#: Tokens of a shard of the index, documents in a block of a term's postings, and queries that a task answers together.
SHARD_TOKENS, BLOCK_DOCS, QUERY_BLOCK = 1 << 20, 128, 4096


@dataclass
class Index:
    docs: DataFrame
    postings: DataFrame
    doc_stats: DataFrame
    term_stats: DataFrame
    stemming: bool = False
    #: What blocks are dealt from (doc_id, terms), or the blocks themselves, see :func:`deal_blocks`.
    terms: DataFrame | None = None
    blocks: DataFrame | None = None


def build_documents(publications: DataFrame, seq: str = "seq") -> DataFrame:
    """One document per non-empty URL, the last record winning, with absent fields as '' or []."""
    keyed = publications.filter(F.coalesce("publication_url", F.lit("")) != "").withColumn(
        "doc_id", text.stable_id("publication_url")
    )
    last = Window.partitionBy("doc_id").orderBy(F.desc(seq))
    defaults = {
        "title": F.lit(""), "year": F.lit(""), "abstract": F.lit(""),
        "authors": F.array().cast("array<string>"),
        "author_links": F.array().cast("array<struct<name:string,url:string>>"),
        "organisations": F.array().cast("array<string>"),
    }
    have = set(publications.columns)
    columns = [F.coalesce(F.col(c), d).alias(c) if c in have else d.alias(c) for c, d in defaults.items()]
    return keyed.withColumn("_rn", F.row_number().over(last)).filter("_rn = 1").select(
        "doc_id", "publication_url", *columns
    )


def document_terms(docs: DataFrame, body: Column | str, key: str = "doc_id", stemming: bool = False) -> DataFrame:
    """(doc_id, terms) of every document, empty ones included."""
    return docs.select(F.col(key).alias("doc_id"), text.search_terms(body, stemming).alias("terms"))


def postings(terms: DataFrame) -> DataFrame:
    """Term frequency per document: (term, doc_id, tf, dl)."""
    return (
        terms.select("doc_id", F.size("terms").cast("bigint").alias("dl"), F.explode("terms").alias("term"))
        .groupBy("term", "doc_id", "dl")
        .agg(F.count("*").alias("tf"))
        .select("term", "doc_id", "tf", "dl")
    )


def document_lengths(terms: DataFrame) -> DataFrame:
    """(doc_id, dl), 0 for empty documents."""
    return terms.select("doc_id", F.size("terms").cast("bigint").alias("dl"))


def document_frequency(posting_rows: DataFrame) -> DataFrame:
    return posting_rows.groupBy("term").agg(F.count("*").alias("df"))


def idf(df: Column, n: Column) -> Column:
    return F.log1p((n - df + 0.5) / (df + 0.5))


def term_statistics(posting_rows: DataFrame, doc_stats: DataFrame) -> DataFrame:
    """(term, df, idf); the document count includes documents without terms."""
    n = doc_stats.agg(F.count("*")).scalar()
    return document_frequency(posting_rows).select("term", "df", idf(F.col("df"), n).alias("idf"))


def build_index(
    docs: DataFrame, body: Column | str | None = None, key: str = "doc_id", stemming: bool = False
) -> Index:
    """All index tables of a document table; stemming then applies to queries too."""
    if body is None:
        body = text.searchable_text(F.col("title"), F.col("abstract"), F.col("authors"), F.col("year"))
    terms = document_terms(docs, body, key, stemming)
    # Left lazy: a query's term filter then reaches the token rows. Use save_index for many queries.
    rows, lengths = postings(terms), document_lengths(terms)
    return Index(docs, rows, lengths, term_statistics(rows, lengths), stemming, terms)


def deal_blocks(terms: DataFrame) -> DataFrame:
    """Postings dealt by document: (shard, term, block, docs, tfs, dls, max_tf, min_dl), of rows with unique ``doc_id``.

    A shard is a stretch of an input partition that ends with the document that reaches ``SHARD_TOKENS`` tokens,
    also within a batch of rows, so nothing is shuffled and no shard grows with the table. A block holds up to ``BLOCK_DOCS`` documents of a
    term in ascending order, and the highest count and least length among them, which bound the score of its
    documents whatever the settings. The term '' lists every document of the shard, also those without terms.
    """
    kind = terms.select("doc_id").dtypes[0][1]
    part = F.shiftleft(F.spark_partition_id().cast("bigint"), 24).alias("part")
    return terms.select(part, "doc_id", "terms").mapInArrow(
        _dealt, f"shard bigint, term string, block int, docs array<{kind}>, tfs array<bigint>, dls array<bigint>, max_tf bigint, min_dl bigint")


def _dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held, tokens, shard = [], 0, 0
    for batch in batches:
        ends = np.cumsum(np.array(pc.list_value_length(batch.column(2)), np.int64))
        at, before = 0, 0
        while at < batch.num_rows:  # a batch may hold several shards
            last = min(int(np.searchsorted(ends, before + SHARD_TOKENS - tokens)), batch.num_rows - 1)
            held.append(batch.slice(at, last + 1 - at))
            tokens += int(ends[last]) - before
            at, before = last + 1, int(ends[last])
            if tokens >= SHARD_TOKENS:
                yield from _deal(pa.Table.from_batches(held), shard).to_batches()
                held, tokens, shard = [], 0, shard + 1
    if tokens or any(x.num_rows for x in held):
        yield from _deal(pa.Table.from_batches(held), shard).to_batches()


def _deal(table: pa.Table, number: int) -> pa.Table:
    table = table.take(pc.sort_indices(table["doc_id"])).combine_chunks()
    docs, dl = table["doc_id"].combine_chunks(), np.array(pc.list_value_length(table["terms"]), np.int64)
    n, rows = len(dl), np.arange(len(dl))
    words = pc.list_flatten(table["terms"])
    words = (words.combine_chunks() if isinstance(words, pa.ChunkedArray) else words).dictionary_encode()
    names = pa.concat_arrays([words.dictionary, pa.array([""], words.dictionary.type)])
    code = np.concatenate([np.array(words.indices, np.int64), np.full(n, len(names) - 1)])
    pair, tf = np.unique(code * n + np.concatenate([np.repeat(rows, dl), rows]), return_counts=True)
    term, doc = pair // n, pair % n
    begin = np.flatnonzero(np.diff(term, prepend=-1))
    place = np.arange(len(term)) - np.repeat(begin, np.diff(begin, append=len(term)))
    cut = np.flatnonzero(place % BLOCK_DOCS == 0)
    offsets = pa.array(np.append(cut, len(term)), pa.int32())
    lists = lambda values: pa.ListArray.from_arrays(offsets, values)
    length = dl[doc]
    return pa.table({
        "shard": pa.array(np.full(len(cut), table["part"][0].as_py() + number), pa.int64()),
        "term": names.take(pa.array(term[cut])), "block": pa.array(place[cut] // BLOCK_DOCS, pa.int32()),
        "docs": lists(docs.take(pa.array(doc))), "tfs": lists(pa.array(tf, pa.int64())), "dls": lists(pa.array(length)),
        "max_tf": pa.array(np.maximum.reduceat(tf, cut), pa.int64()), "min_dl": pa.array(np.minimum.reduceat(length, cut))})


def save_index(index: Index, path: str) -> Index:
    """Write the index tables as parquet and return the index over the written tables.

    Postings are range-partitioned by (term, doc_id) and sorted, so a term's rows lie together
    but a frequent term still spans files; a bloom filter on term skips the other files. Blocks, which
    serve many queries at once, lie by shard and are sorted by term.
    """
    spark = index.docs.sparkSession
    blocks = index.blocks if index.blocks is not None else deal_blocks(index.terms)
    blocks.sortWithinPartitions("term", "shard", "block").write.mode("overwrite").option(
        "parquet.bloom.filter.enabled#term", "true").parquet(f"{path}/blocks")
    index.docs.write.mode("overwrite").parquet(f"{path}/docs")
    (
        index.postings.repartitionByRange("term", "doc_id").sortWithinPartitions("term", "doc_id")
        .write.mode("overwrite").option("parquet.bloom.filter.enabled#term", "true").parquet(f"{path}/postings")
    )
    index.doc_stats.write.mode("overwrite").parquet(f"{path}/doc_stats")
    written = spark.read.parquet(f"{path}/postings")
    lengths = spark.read.parquet(f"{path}/doc_stats")
    (
        term_statistics(written, lengths).repartitionByRange("term").sortWithinPartitions("term")
        .write.mode("overwrite").parquet(f"{path}/term_stats")
    )
    spark.createDataFrame([(index.stemming,)], "stemming boolean").coalesce(1).write.mode("overwrite").parquet(
        f"{path}/settings"
    )
    return load_index(spark, path)


def load_index(spark: SparkSession, path: str) -> Index:
    read = lambda name: spark.read.parquet(f"{path}/{name}")
    return Index(
        read("docs"), read("postings"), read("doc_stats"), read("term_stats"), read("settings").first()["stemming"],
        blocks=read("blocks"),
    )


def attach_length(posting_rows: DataFrame, doc_stats: DataFrame) -> DataFrame:
    """Postings with the length from ``doc_stats``; a missing length is 0."""
    return posting_rows.drop("dl").join(doc_stats, "doc_id", "left").withColumn(
        "dl", F.coalesce("dl", F.lit(0).cast("bigint"))
    )


def attach_idf(posting_rows: DataFrame, term_stats: DataFrame) -> DataFrame:
    """Postings with the term's idf; a missing idf is 0."""
    return posting_rows.join(term_stats.select("term", "idf"), "term", "left").withColumn(
        "idf", F.coalesce("idf", F.lit(0.0))
    )


def _term_score(avgdl: Column, k1: float, b: float) -> Column:
    tf, dl = F.col("tf"), F.col("dl")
    weight = tf + k1 * (1 - b + b * (dl / avgdl))
    return F.col("idf") * (tf * (k1 + 1)) / F.when(weight == 0, 1.0).otherwise(weight)


def _average_length(index: Index) -> Column:
    mean = index.doc_stats.agg(F.avg("dl")).scalar()
    return F.when(mean > 0, mean)


def bm25_scores(
    index: Index,
    terms: list[str],
    k1: float = fixed.BM25_K1,
    b: float = fixed.BM25_B,
    allowed: DataFrame | None = None,
) -> DataFrame:
    """(doc_id, score) of one query. A repeated term counts again.

    The term list reaches the scan of the postings as a filter. ``allowed`` (doc_id) restricts
    the documents before they are scored; idf and average length stay corpus-wide.
    """
    weights = Counter(terms)
    spark = index.postings.sparkSession
    query = spark.createDataFrame(list(weights.items()), "term string, weight bigint")
    names = list(weights)
    matched = index.postings.filter(F.col("term").isin(names))
    if allowed is not None:
        matched = matched.join(allowed.select("doc_id"), "doc_id", "left_semi")
    # One row per query term: as long as the query itself.
    facts = query.join(index.term_stats.filter(F.col("term").isin(names)), "term", "left").select(
        "term", "weight", F.coalesce("idf", F.lit(0.0)).alias("idf")
    )
    scored = matched.join(F.broadcast(facts), "term").withColumn(
        "part", F.col("weight") * _term_score(_average_length(index), k1, b)
    )
    return scored.filter("part IS NOT NULL").groupBy("doc_id").agg(F.sum("part").alias("score"))


def with_organisation(docs: DataFrame, organisation: str) -> DataFrame:
    """Documents that carry the organisation."""
    return docs.filter(F.array_contains("organisations", organisation))


def search(
    index: Index, query: str, top_k: int = 10, organisation: str | None = None
) -> DataFrame:
    """The best documents of one query with their metadata, score at 4 digits."""
    terms = text.query_terms(query, index.stemming)
    allowed = with_organisation(index.docs, organisation) if organisation else None
    top = (
        bm25_scores(index, terms, allowed=allowed)
        .withColumn("_noise_free", F.round("score", 9))
        .orderBy(F.desc("_noise_free"), "doc_id").limit(top_k)
    )
    found = index.docs.join(F.broadcast(top), "doc_id", "right")
    return found.orderBy(F.desc("_noise_free"), "doc_id").select(
        F.round("_noise_free", 4).alias("score"), *index.docs.columns
    )


def search_many(
    index: Index,
    queries: DataFrame,
    top_k: int = 10,
    key: str = "query_id",
    query: str = "query",
    k1: float = fixed.BM25_K1,
    b: float = fixed.BM25_B,
) -> DataFrame:
    """The best documents of every query in a table: (query_id, rank, doc_id, score).

    Each shard of the index answers each block of queries in one task, which returns ``top_k`` documents a
    query, so no (query, document) row is ever shuffled: what travels is the blocks of the terms asked for,
    the queries once a shard, and the shards' best. A saved index brings its blocks; one that is still lazy
    deals them first, in one pass over the texts. A term's documents are spread over all shards.
    """
    blocks = index.blocks if index.blocks is not None else settle(deal_blocks(index.terms))
    total = lambda c: F.sum(F.aggregate(c, F.lit(0).cast("bigint"), lambda acc, x: acc + x))
    shards = blocks.filter("term = ''").groupBy("shard").agg(total("tfs").alias("n"), total("dls").alias("words")).collect()
    n, words = sum(r["n"] for r in shards), sum(r["words"] for r in shards)  # a row each
    mean = words / n if words else 1.0
    groups = max(1, -(-queries.count() // QUERY_BLOCK))
    asked = queries.select(F.col(key).alias("query_id"), F.explode(text.search_terms(query, index.stemming)).alias("term"))
    asked = asked.groupBy("query_id", "term").agg(F.count("*").alias("weight"))
    asked = asked.withColumn("group", F.pmod(F.xxhash64("query_id"), F.lit(groups)).cast("int"))
    found = blocks.join(asked.select("term", "group").distinct(), "term")
    if index.blocks is None:
        df = found.dropDuplicates(["shard", "term", "block"]) if groups > 1 else found
        rated = df.groupBy("term").agg(idf(F.sum(F.size("docs")), F.lit(n)).alias("idf"))
    else:
        rated = index.term_stats.select("term", "idf")
    every = F.lit(np.array([r["shard"] for r in shards], np.int64))
    rated = asked.join(rated, "term").select(
        "query_id", "term", F.col("group").alias("asked_by"), (F.col("weight") * F.col("idf")).alias("gain"),
        F.explode(every).alias("asked_of"))
    kinds = dict(asked.select("query_id").dtypes + [("doc_id", blocks.select(F.col("docs")[0].alias("x")).dtypes[0][1])])
    best = found.groupBy("shard", "group").cogroup(rated.groupBy("asked_of", "asked_by")).applyInArrow(
        _best_of_shard(top_k, k1, b, mean), f"query_id {kinds['query_id']}, doc_id {kinds['doc_id']}, score double")
    best = best.withColumn("score", F.round("score", 9))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), F.asc("doc_id"))
    return (
        best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top_k)
        .select("query_id", "rank", "doc_id", F.round("score", 4).alias("score"))
    )


def _best_of_shard(top_k: int, k1: float, b: float, mean: float):
    """The best documents of each query within a shard: query_id, doc_id, score (ties: smaller document).

    A query's terms are taken by falling bound. Once ``top_k`` documents have scores, a block is skipped if
    none of its documents can reach the least of these with the block's bound and all bounds still to come.
    """
    def share(tf, dl):
        weight = tf + k1 * (1 - b + b * (dl / mean))
        return tf * (k1 + 1) / np.where(weight == 0, 1.0, weight)

    def run(blocks: pa.Table, asked: pa.Table) -> pa.Table:
        out: list[tuple] = []
        blocks = blocks.take(pc.sort_indices(blocks, [("term", "ascending"), ("block", "ascending")])).combine_chunks()
        lists = blocks["docs"].combine_chunks() if blocks.num_rows else pa.array([], blocks.schema.field("docs").type)
        ends = np.concatenate([[0], np.cumsum(np.array(pc.list_value_length(lists), np.int64))])
        names = pc.unique(lists.flatten())
        names = names.take(pc.sort_indices(names))
        place = np.array(pc.index_in(lists.flatten(), names), np.int64)
        tf, dl = (np.array(pc.list_flatten(blocks[c]), float) for c in ("tfs", "dls"))
        top = share(np.array(blocks["max_tf"], float), np.array(blocks["min_dl"], float))
        ranges = {t: (at, at + n) for at, n, t in _runs(blocks["term"].to_pylist())}
        wanted = asked.sort_by("query_id").to_pydict()
        for at, n, name in _runs(wanted["query_id"]):
            terms = [(gain, *ranges[t]) for t, gain in zip(wanted["term"][at:at + n], wanted["gain"][at:at + n]) if t in ranges]
            terms = sorted(((gain * top[x:y].max(), gain, x, y) for gain, x, y in terms), reverse=True)
            rest = sum(bound for bound, *_ in terms)
            score, least = np.zeros(len(names)), -np.inf
            for bound, gain, x, y in terms:
                rest -= bound
                kept = np.arange(x, y)
                if least > 0:
                    edges = np.stack([place[ends[x:y]], place[ends[x + 1:y + 1] - 1] + 1], axis=1).ravel()
                    reached = np.maximum.reduceat(np.append(score, 0.0), edges)[::2]
                    kept = kept[reached + gain * top[x:y] + rest >= least - 1e-6]
                size = ends[kept + 1] - ends[kept]
                own = np.repeat(ends[kept] - np.cumsum(size) + size, size) + np.arange(int(size.sum()))
                score[place[own]] += gain * share(tf[own], dl[own])
                if len(score) > top_k and np.count_nonzero(score) >= top_k:
                    least = np.partition(score, -top_k)[-top_k]
            best = np.flatnonzero((score > 0) & (score >= least - 1e-6))
            best = best[np.lexsort((best, -np.round(score[best], 9)))][:top_k]
            out += [(name, int(k), float(score[k])) for k in best]
        return pa.table({
            "query_id": pa.array([x[0] for x in out], asked.schema.field("query_id").type),
            "doc_id": names.take(pa.array([x[1] for x in out], pa.int64())), "score": pa.array([x[2] for x in out], pa.float64())})

    return run


def _runs(values: list) -> list[tuple[int, int, object]]:
    """(start, length, value) of every stretch of equal values."""
    out: list[tuple[int, int, object]] = []
    for i, v in enumerate(values):
        if out and out[-1][2] == v:
            out[-1] = (out[-1][0], out[-1][1] + 1, v)
        else:
            out.append((i, 1, v))
    return out


def present(results: DataFrame, query: str, search_base: str, limit: int = 1000) -> DataFrame:
    """Result cards: highlighted title and shortened abstract, one profile link per author."""
    linked = F.transform(
        "author_links", lambda a: text.profile_link(a["url"], a["name"], search_base)
    )
    named = F.transform("authors", lambda a: text.profile_link(F.lit(""), a, search_base))
    authors = F.transform("authors", lambda a: text.highlight(a, query))
    return results.select(
        "doc_id", "score", "year",
        text.highlight("title", query).alias("title_html"),
        F.when(F.size("authors") > 0, F.array_join(authors, ", ")).otherwise("Unknown").alias("authors_html"),
        text.highlight(text.shorten("abstract", limit), query).alias("abstract_html"),
        F.when(F.size("author_links") > 0, linked).otherwise(named).alias("profiles"),
    )


