"""Language identification by a bidirectional recurrent network over bytes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marlstone.llm.gru import PAD, Network, label_windows, train
from marlstone.llm.samples import bounded, remainder
from marlstone.llm.texts import carried, slices

#: Documents and characters of each that the network is fitted on.
SAMPLE_DOCS, SAMPLE_CHARS = 2048, 2048
HIDDEN, STEPS, BATCH, TRAIN_WINDOW = 8, 300, 256, 48
#: A text is labelled in windows of so many bytes, all of them; so many windows at once.
WINDOW, AT_ONCE = 128, 2048


def fit(rows: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", bound: int = SAMPLE_DOCS):
    """(network, languages) fitted on at most ``bound`` rows with a language and a text; None without any.

    Of each chosen text a stretch of ``SAMPLE_CHARS`` characters is used, its place drawn from the key's hash.
    """
    known = rows.where(F.col(lang).isNotNull() & (F.length(text) > 0)).select(
        F.col(key).alias("key"), F.col(text).alias("text"), F.col(lang).alias("lang"))
    start = F.pmod(F.xxhash64("key", F.lit(3)), F.greatest(F.length("text") - SAMPLE_CHARS // 2, F.lit(1))) + 1
    sample = bounded(known, "lang", "key", bound).select(
        "lang", F.substr("text", start.cast("int"), F.lit(SAMPLE_CHARS)).alias("text")).toPandas()
    if not len(sample):
        return None
    names = sorted(sample["lang"].unique())
    labels = np.searchsorted(names, sample["lang"].to_numpy())
    texts = [x.encode() for x in sample["text"]]
    return train(texts, labels, len(names), HIDDEN, STEPS, TRAIN_WINDOW, BATCH), names


def identify(docs: DataFrame, model: tuple[Network, list[str]] | None, text: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``row`` (all its columns), lang_pred, score.

    The network labels every byte of the whole text; the document's probability of a language is the mean
    over its bytes, ``lang_pred`` the likeliest (ties: first by name), ``score`` its probability. A text
    that is null or has no letter is ``und`` with score 0, and so is every text without a model. Long texts
    are read in windows, so memory does not grow with them. Only the text is read; other columns pass.
    """
    out = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    out = out.select("row", F.coalesce(F.col("row")[text].rlike(r"\p{L}"), F.lit(False)).alias("lettered"))
    if model is None:
        return out.select("row", F.lit("und").alias("lang_pred"), F.lit(0.0).alias("score"))
    sent = docs.sparkSession.sparkContext.broadcast(model)
    return out.mapInArrow(_label(sent, text), f"row {docs.schema.simpleString()}, lang_pred string, score double")


def pooled(net: Network, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Mean label probabilities over the bytes of each row of a slice; rows without bytes are zero."""
    size = np.diff(offsets)
    count = -(-size // WINDOW)
    sums = np.zeros((len(size), len(net.out_bias)))
    owner = np.repeat(np.arange(len(size)), count)
    start = offsets[owner] + WINDOW * (np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count))
    for k in range(0, len(owner), AT_ONCE):
        rows = owner[k:k + AT_ONCE]
        place = start[k:k + AT_ONCE] + np.arange(WINDOW)[:, None]
        inside = place < offsets[rows + 1]
        codes = np.where(inside, data[np.minimum(place, len(data) - 1)].astype(np.int64), PAD)
        np.add.at(sums, rows, label_windows(net, codes))
    return sums / np.maximum(size, 1)[:, None]


def _label(sent, text: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net, names = sent.value
        names = np.array([*names, "und"], object)
        for batch in batches:
            rows, texts = carried(batch, text)
            lettered = batch.column(batch.schema.get_field_index("lettered")).to_numpy(zero_copy_only=False)
            for first, last, data, offsets in slices(texts):
                told = lettered[first:last].astype(bool)
                chance = pooled(net, data, offsets) * told[:, None]
                best = np.where(told, chance.argmax(axis=1), len(names) - 1)
                yield pa.RecordBatch.from_arrays(
                    [rows.slice(first, last - first), pa.array(names[best], pa.string()),
                     pa.array(np.minimum(chance.max(axis=1), 1.0))], ["row", "lang_pred", "score"],
                )

    return run


def learn_and_identify(docs: DataFrame) -> DataFrame:
    """Fit on documents whose crc32(doc_id) mod 4 is not 2, label all; adds held_out."""
    model = fit(docs.where(remainder("doc_id", 4) != 2))
    return identify(docs, model).withColumn("held_out", remainder("row.doc_id", 4) == 2)


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang")
    return learn_and_identify(docs).select("row.doc_id", "held_out", "lang_pred", "score")
