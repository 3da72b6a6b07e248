"""Toxicity of whole texts by a convolutional classifier, with a threshold for each language."""

from __future__ import annotations

import copy
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marlstone.llm import convolution as cnn
from marlstone.llm.samples import remainder
from marlstone.llm.texts import carried, slices
from marlstone.session import settle

#: Characters of labelled texts that one task trains on at a time. A longer table is dealt to shards of about that size.
SHARD_CHARS = 8 << 20
EPOCHS = 8
#: Marked documents up to which they are broadcast; the texts of a table with more are joined by shuffle.
SENT_MARKS = 2_000_000
#: Held-back texts whose scores are taken as they are; more are counted by score in steps of 1 / ``CUT_STEPS``.
CUT_ROWS, CUT_STEPS = 1 << 17, 4096
#: Marked texts of a language, of each kind, that a threshold of its own needs.
OWN_CUT = 12
#: Tasks whose sums the driver adds up itself; those of more are added up in a tree of this many branches.
FAN = 16


def fit(docs: DataFrame, labels: DataFrame) -> cnn.Classifier | None:
    """Fit on all labelled documents (doc_id, text, lang; doc_id, toxic).

    Rows with a null mark or an empty text take no part; of a document with several marks the highest holds, and
    a document that stands twice counts twice. Texts are read whole. One fifth of them, by a hash of the id, is
    kept from the fit and scored whole, in tasks, to place the thresholds: per language the cut that gets most
    marks right (middle of the best range), or the common cut where a language has few marks. ``lang`` is only
    learnt as a second target, so that the network itself tells the language of a text it scores.
    """
    marks = labels.where("toxic IS NOT NULL AND doc_id IS NOT NULL").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    if marks.count() <= SENT_MARKS:
        marks = F.broadcast(marks)
    marked = docs.select("doc_id", "text", "lang").join(marks, "doc_id").where("length(text) > 0")
    marked = marked.withColumn("toxic", (F.col("toxic") > 0).cast("int"))
    aside = F.pmod(F.xxhash64("doc_id", F.lit(23)), F.lit(5)) == 0
    size = marked.where(~aside).agg(
        F.count("*").alias("n"), F.sum("toxic").alias("bad"), F.sum(F.length("text")).alias("chars"), F.sort_array(F.collect_set("lang")).alias("names")
    ).first()
    if (size["bad"] or 0) in (0, size["n"]):
        return None
    names, shards = size["names"], 1 + size["chars"] // SHARD_CHARS
    dealt = marked.where(~aside).withColumn("shard", F.pmod(F.xxhash64("doc_id", F.lit(17)), F.lit(shards)).cast("int"))
    model = _trained(settle(dealt.groupBy("shard").applyInPandas(_packed(names), PACKED)), shards, size["n"], size["bad"], len(names))
    model.cuts = np.zeros(max(len(names), 1))
    sent = docs.sparkSession.sparkContext.broadcast(model)
    whole = marked.where(aside).select(F.struct("text", "toxic").alias("row"))
    test = whole.mapInArrow(_margins(sent, "text"), "row struct<text:string,toxic:int>, score double, told int")
    test = settle(test.select(F.col("row.toxic").alias("bad"), (1 - F.col("row.toxic")).alias("good"), "score", "told"))
    if test.count() > CUT_ROWS:
        near = (F.round(F.col("score") * CUT_STEPS) / CUT_STEPS).alias("score")
        test = test.groupBy("told", near).agg(F.sum("bad").alias("bad"), F.sum("good").alias("good"))
    test = test.toPandas()
    if test[["bad", "good"]].to_numpy().sum() > 1:
        bad, good, margin, told = (test[c].to_numpy() for c in ("bad", "good", "score", "told"))
        common = best_cut(margin, bad, good)
        for k in range(len(model.cuts)):
            mine = told == k
            enough = min(bad[mine].sum(), good[mine].sum()) >= OWN_CUT
            model.cuts[k] = best_cut(margin[mine], bad[mine], good[mine]) if enough else common
    return model


PACKED = "shard int, first binary, words binary, starts array<binary>, toxic binary, language binary"


def _packed(names: list[str]):
    """A shard's texts as one row: the places of their words in the network's tables, two bytes each, and their marks."""
    number = {name: k for k, name in enumerate(names)}

    def run(shard: pd.DataFrame) -> pd.DataFrame:
        shard = shard.sort_values(["doc_id", "text"], ignore_index=True)
        found = [([r.astype(np.uint16) for r in rows], at) for rows, at in (
            cnn.word_rows(data, at) for _, _, data, at in slices(pa.array(shard["text"], pa.large_string())))]
        rows = [np.concatenate(r).tobytes() for r in zip(*[r for r, _ in found])]
        first = np.concatenate([[0], np.cumsum(np.concatenate([np.diff(f) for _, f in found]))])
        language = shard["lang"].map(number).fillna(-1).to_numpy(np.int64)
        return pd.DataFrame({
            "shard": shard["shard"][:1], "first": [first.astype(np.int64).tobytes()], "words": [rows[0]], "starts": [rows[1:]],
            "toxic": [shard["toxic"].to_numpy(np.int64).tobytes()], "language": [language.tobytes()]})

    return run


def _unpacked(row) -> tuple:
    """Rows, first, toxic and language of a packed shard, as the network's fit takes them."""
    first, toxic, language = (np.frombuffer(row[c], np.int64) for c in ("first", "toxic", "language"))
    return tuple(np.frombuffer(r, np.uint16) for r in (row["words"], *row["starts"])), first, toxic, language


def _trained(packed: DataFrame, shards: int, texts: int, toxic: int, languages: int) -> cnn.Classifier:
    """One shard is trained in one task. Several are trained side by side from the same model, and the next round
    starts at the mean of what they learnt. Leans of words are counted over all shards first."""
    if shards == 1:
        return packed.rdd.map(lambda row: cnn.train(*_unpacked(row), languages, EPOCHS)).first()
    context = packed.sparkSession.sparkContext
    # As many tasks as run at once, each over several shards: sums of tasks then do not grow with the table.
    dealt = packed.rdd.coalesce(context.defaultParallelism)
    depth = max(1, int(np.ceil(np.log(dealt.getNumPartitions()) / np.log(FAN))))
    added = lambda a, b: [x + y for x, y in zip(a, b)]
    counts = dealt.map(lambda row: cnn.kind_counts(*_unpacked(row)[:3])).treeReduce(added, depth)
    now = cnn.begin(np.random.default_rng(3), counts, (float(toxic + 1), float(texts - toxic + 1)), languages)
    epochs = cnn.all_epochs(EPOCHS, texts) // EPOCHS

    def learnt(row, sent, k: int) -> list[np.ndarray]:
        rng, own, data = np.random.default_rng([3, k, row["shard"]]), copy.deepcopy(sent.value), _unpacked(row)
        cnn.advance(own, *data, rng.permutation(len(data[2])), rng, epochs)
        return cnn.moved(sent.value, own, len(data[2]))

    for k in range(EPOCHS):
        sent = context.broadcast(now)
        total = dealt.map(lambda row, sent=sent, k=k: learnt(row, sent, k)).treeReduce(added, depth)
        now = cnn.joined(now, total)
        sent.unpersist()
    return now.model


def best_cut(score: np.ndarray, toxic: np.ndarray, other: np.ndarray | None = None) -> float:
    """The cut with the fewest errors, each kind weighed by its rarity; the middle of the best range.

    ``toxic`` and ``other`` count the texts of a score; without ``other`` a score is one text.
    """
    order = np.argsort(score, kind="stable")
    score, toxic, other = score[order], toxic[order], (1 - toxic if other is None else other)[order]
    bad, good = max(toxic.sum(), 1), max(other.sum(), 1)
    missed = np.concatenate([[0], np.cumsum(toxic)]) / bad
    wrong = np.concatenate([[0], np.cumsum(other)])
    errors = missed + (wrong[-1] - wrong) / good
    best = np.flatnonzero(errors <= errors.min() + 1e-12)
    edges = np.concatenate([[score[0] - 1], score, [score[-1] + 1]])
    k = int(best[len(best) // 2])
    return float((edges[k] + edges[k + 1]) / 2)


def score(docs: DataFrame, model: cnn.Classifier | None, text: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``row`` (all its columns), score, predicted.

    The score is the logistic of the network's output less the cut of the language it tells, so 0.5 is that
    language's threshold. A null or empty text, or one without words, has the score of a text that reaches
    no filter. Without a model (no marks of both kinds) every score is 0. Only the text is read.
    """
    out = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    if model is None:
        found = out.withColumn("score", F.lit(0.0))
    else:
        sent = docs.sparkSession.sparkContext.broadcast(model)
        kind = f"row {docs.schema.simpleString()}, score double, told int"
        cuts = F.array(*[F.lit(float(c)) for c in model.cuts])
        margin = 0.5 * (F.col("score") - F.get(cuts, F.col("told")))
        found = out.mapInArrow(_margins(sent, text), kind).select("row", (0.5 * F.tanh(margin) + 0.5).alias("score"))
    return found.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def _margins(sent, text: str):
    """Per row the network's output for toxicity and the number of the language it tells."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        for batch in batches:
            whole, texts = carried(batch, text)
            for first, last, data, offsets in slices(texts):
                rows, at = cnn.word_rows(data, offsets)
                found = cnn.scores(model, rows, at)
                told = found[:, 1:].argmax(axis=1) if found.shape[1] > 1 else np.zeros(len(found), np.int64)
                yield pa.RecordBatch.from_arrays(
                    [whole.slice(first, last - first), pa.array(found[:, 0].astype(np.float64)), pa.array(told.astype(np.int32))],
                    ["row", "score", "told"])

    return run


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    learn = remainder("doc_id", 5) != 0
    model = fit(docs.where(learn), spark.read.parquet(f"{sf_dir}/labels.parquet").where(learn))
    return score(docs.select("doc_id", "text"), model).select(
        "row.doc_id", (remainder("row.doc_id", 5) == 0).alias("held_out"), "score", "predicted")
