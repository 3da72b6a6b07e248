"""Placement of documents on shards by a permutation-filled lookup table of prime size."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marlstone.llm.texts import hashes

#: Slots of the table, a prime; at least a hundred times the shards keeps shares within one hundredth.
SLOTS = 65_537


def is_prime(n: int) -> bool:
    return n > 1 and all(n % d for d in range(2, int(n ** 0.5) + 1))


def lookup_table(shards: Sequence[str], slots: int = SLOTS) -> np.ndarray:
    """The shard index of every slot.

    Each shard has a preference order of the slots, ``(offset + j * skip) mod slots`` with both numbers
    hashed from its name; as the size is prime the order is a permutation. Shards take turns, each
    claiming the first free slot of its order, until the table is full. So shards hold equally many slots
    (but for one), and a shard that leaves or joins moves few others' slots. Order of names does not matter.
    """
    if not is_prime(slots) or not 0 < len(set(shards)) == len(shards) <= slots:
        raise ValueError("slots must be a prime, shards distinct and at most as many")
    data = [name.encode() for name in shards]
    at = np.cumsum([0, *map(len, data)])
    offset, skip = (
        hashes(np.frombuffer(b"".join(data) + tag * len(data), np.uint8), at[:-1], at[1:], lower=False) * np.uint64(k)
        for tag, k in ((b"\x01", 0x9E3779B97F4A7C15), (b"\x02", 0xC2B2AE3D27D4EB4F))
    )
    offset = ((offset >> np.uint64(24)) % np.uint64(slots)).astype(np.int64)
    skip = ((skip >> np.uint64(24)) % np.uint64(max(slots - 1, 1))).astype(np.int64) + 1
    order = sorted(range(len(shards)), key=lambda i: shards[i])
    table = np.full(slots, -1)
    place = offset.copy()
    left = slots
    while left:
        for i in order:
            while table[place[i]] >= 0:
                place[i] = (place[i] + skip[i]) % slots
            table[place[i]] = i
            left -= 1
            if not left:
                break
    return table


def slot_of(key: Column, slots: int = SLOTS) -> Column:
    """The slot of a key: its hash as text modulo the table's size; null keys share one slot."""
    return F.pmod(F.xxhash64(F.coalesce(key.cast("string"), F.lit(""))), F.lit(slots)).cast("int")


def place(docs: DataFrame, shards: Sequence[str], key: str = "doc_id", slots: int = SLOTS) -> DataFrame:
    """Each row of ``docs`` as ``row`` with its slot and shard.

    The table has ``slots`` rows whatever the data, so it is broadcast and a row's shard is one lookup;
    nothing is shuffled. Rows of one key go to one shard; null keys count as one key. An empty table
    places nothing. Other columns pass untouched.
    """
    table = lookup_table(shards, slots)
    spark = docs.sparkSession
    lookup = spark.createDataFrame([(i, shards[s]) for i, s in enumerate(table.tolist())], "slot int, shard string")
    out = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    return out.withColumn("slot", slot_of(F.col("row")[key], slots)).join(F.broadcast(lookup), "slot").select("row", "slot", "shard")


def shard_names(count: int) -> list[str]:
    return [f"shard-{i:05d}" for i in range(count)]


def op4_lookup_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", F.octet_length("text").cast("long").alias("n_bytes"))
    return place(docs, shard_names(512)).select("row.doc_id", "slot", "shard", "row.n_bytes")
