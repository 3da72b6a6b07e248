"""Token files: documents as frequency-ranked token ids in byte-aligned variable-length coding."""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from marlstone.llm.links import shared_base
from marlstone.llm.texts import hashes, slices

TOKENIZER = "byte_bpe_50k.json"
#: Appended to each document.
END = 0
#: Ids of a coded block, at most one document more.
BLOCK_IDS = 1 << 18
#: Pieces of text whose ids a worker remembers.
REMEMBERED = 1 << 20
#: Bytes of text in a file part, which is one task's work.
PART_BYTES = 24 << 20


# --- the coding -------------------------------------------------------------------------------

_LENGTHS = np.array([[(c >> (2 * k) & 3) + 1 for k in range(4)] for c in range(256)], np.int64)


def encode(values: np.ndarray) -> tuple[bytes, bytes]:
    """Control bytes (two bits a value: its bytes less one, four values a byte) and data bytes, little-endian."""
    values = values.astype("<u4")
    size = (values > 0xFF).astype(np.int64) + (values > 0xFFFF) + (values > 0xFFFFFF)
    padded = np.zeros(-(-len(size) // 4) * 4, np.uint8)
    padded[:len(size)] = size
    quads = padded.reshape(-1, 4)
    control = quads[:, 0] | quads[:, 1] << 2 | quads[:, 2] << 4 | quads[:, 3] << 6
    every = values.view(np.uint8).reshape(-1, 4)
    return control.tobytes(), every[np.arange(4) <= size[:, None]].tobytes()


def decode(control: bytes, data: bytes, count: int) -> np.ndarray:
    """The values, by looking up the four lengths of every control byte in a table."""
    length = _LENGTHS[np.frombuffer(control, np.uint8)].ravel()[:count]
    raw = np.concatenate([np.frombuffer(data, np.uint8), np.zeros(3, np.uint8)])
    start = np.cumsum(length) - length
    out = raw[start].astype(np.uint32)
    for k in range(1, 4):
        more = np.flatnonzero(length > k)
        out[more] |= raw[start[more] + k].astype(np.uint32) << np.uint32(8 * k)
    return out


# --- tokens -----------------------------------------------------------------------------------

#: ASCII bytes that are no white space; with the leads of two-byte letters they may stand beside a cut.
_SOLID = np.zeros(256, bool)
_SOLID[:0x80] = True
_SOLID[[0x20, *range(0x09, 0x0E), *range(0x1C, 0x20)]] = False
_LEAD = np.zeros(256, bool)
_LEAD[0xC3:0xE0] = True
_LETTER = np.zeros(256, bool)
_LETTER[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = True
#: ASCII signs that are no letters, digits or control bytes.
_SIGNS = frozenset([*range(0x21, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x7F)])
#: Pieces in one call's text.
_JOINED = 1000
_workers: dict[str, "Pieces"] = {}


class Pieces:
    """Token ids of texts, by way of the ids of their pieces, which repeat.

    A text is cut before a single space between two characters that are no white space, and between an ASCII
    letter and a sign that no added token holds. The tokenizer splits words there too, with the space going to
    the following word, so pieces encode alike alone and within the text. Ids of pieces met before are taken from memory, others from the tokenizer. When the
    memory is full its older half goes, but for pieces met again.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        names = self.tokenizer.get_vocab(with_added_tokens=True)
        size = max(names.values()) + 1
        self.spaced = np.zeros(size, bool)
        self.spaced[[i for name, i in names.items() if name.startswith("\u0120")]] = True
        self.levels = [_NONE, _NONE]  # sorted hashes and their slots: many and recent
        self.count = 0  # slots in use; slot k has the ids from at[k] to at[k + 1]
        self.at = np.zeros(1 << 16, np.int32)
        added = {c for x in self.tokenizer.get_added_tokens_decoder().values() for c in x.content.encode()}
        self.signs = np.zeros(256, bool)
        self.signs[sorted(_SIGNS - added)] = True
        self.again = np.zeros(1 << 16, bool)  # slots met again
        self.ids = np.zeros(1 << 18, np.uint16 if size <= 1 << 16 else np.uint32)

    @staticmethod
    def of(path: str) -> "Pieces":
        if path not in _workers:
            _workers[path] = Pieces(path)
        return _workers[path]

    def forget_half(self) -> None:
        """Drop the older half of the slots, but those met again since the last time; these too if they are most."""
        half = self.count // 2
        keep = self.again[:self.count].copy()
        if int(keep[:half].sum()) > half // 2:
            keep[:half] = False
        keep[half:] = True
        kept = np.flatnonzero(keep)
        begin, size = self.at[kept].astype(np.int64), np.diff(self.at[:self.count + 1])[kept]
        ends = np.cumsum(size, dtype=np.int64)
        ids = self.ids[np.repeat(begin - ends + size, size) + np.arange(int(ends[-1]))]
        self.ids[:len(ids)] = ids
        moved = np.cumsum(keep, dtype=np.int32) - np.int32(1)
        self.levels = [(names[keep[slots]], moved[slots[keep[slots]]]) for names, slots in self.levels]
        self.count = len(kept)
        self.at[1:self.count + 1] = ends
        self.again[:] = False

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all rows of a slice, one after another, and where each row starts (rows + 1)."""
        n = len(data)
        closing = np.zeros(n, bool)  # characters before a cut, at their last byte
        closing[:] = _SOLID[data]
        closing[1:] |= (data[1:] >= 0x80) & _LEAD[data[:-1]]
        opening = _SOLID[data] | _LEAD[data]
        cut = np.zeros(n + 1, bool)
        if n > 2:
            cut[1:-2] = (data[1:-1] == 0x20) & closing[:-2] & opening[2:]
        if n > 1:
            cut[1:-1] |= _LETTER[data[:-1]] & self.signs[data[1:]]
        cut[offsets] = True
        edges = np.flatnonzero(cut)
        starts, ends = edges[:-1], edges[1:]
        distinct, first, which = np.unique(
            hashes(data, starts, ends, lower=False), return_index=True, return_inverse=True)
        if self.count > REMEMBERED:
            self.forget_half()
        slot = self._slots(distinct)
        fresh = slot < 0
        self.again[slot[~fresh]] = True
        if fresh.any():
            a, b = starts[first[fresh]], ends[first[fresh]]
            inner = np.concatenate([[0], np.cumsum(data == 0x20)])
            plain = (b - a > 1) & (data[a] == 0x20) & (inner[b] - inner[a] == 1) & closing[b - 1]
            plain[b - a > 1] &= opening[a[b - a > 1] + 1]
            slot[fresh] = self._learn(distinct[fresh], data, a, b, plain)
        slot = slot[which]
        begin = self.at[slot].astype(np.int64)
        length = self.at[slot + 1] - begin
        total = np.zeros(len(length) + 1, np.int64)
        np.cumsum(length, out=total[1:])
        index = np.repeat(begin - total[:-1], length) + np.arange(int(total[-1]))
        return self.ids[index], total[np.searchsorted(starts, offsets)]

    def _slots(self, names: np.ndarray) -> np.ndarray:
        slot = np.full(len(names), -1)
        for known, slots in self.levels:
            if len(known):
                place = np.minimum(np.searchsorted(known, names), len(known) - 1)
                same = known[place] == names
                slot[same] = slots[place[same]]
        return slot

    def _learn(self, names: np.ndarray, data: np.ndarray, a: np.ndarray, b: np.ndarray, plain: np.ndarray) -> np.ndarray:
        """Slots of new pieces, which are the bytes from ``a`` to ``b``. Plain ones (one space, in front) share a
        call's text: a token that starts with a space starts a piece."""
        joined, single = np.flatnonzero(plain), np.flatnonzero(~plain)
        size = (b - a)[joined]
        ends = np.cumsum(size)
        text = data[np.repeat(a[joined] - ends + size, size) + np.arange(int(size.sum()))].tobytes()
        bounds = [0, *ends[_JOINED - 1::_JOINED].tolist()]
        if len(joined) % _JOINED:
            bounds.append(len(text))
        order, counts, found = [], [], []
        groups = (joined[k:k + _JOINED] for k in range(0, len(joined), _JOINED))
        for group, out in zip(groups, self._call([text[x:y].decode() for x, y in zip(bounds, bounds[1:])])):
            begin = np.flatnonzero(self.spaced[out])
            if len(begin) == len(group) and begin[0] == 0:
                order.append(group)
                counts.append(np.diff(begin, append=len(out)))
                found.append(out)
            else:
                single = np.concatenate([single, group])
        if len(single):
            alone = self._call([data[x:y].tobytes().decode() for x, y in zip(a[single].tolist(), b[single].tolist())])
            order.append(single)
            counts.append(np.fromiter(map(len, alone), np.int64, len(alone)))
            found += alone
        used, new = int(self.at[self.count]), sum(map(len, found))
        while used + new > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
        while self.count + len(names) + 1 > len(self.at):
            self.at, self.again = (np.concatenate([x, np.zeros_like(x)]) for x in (self.at, self.again))
        self.ids[used:used + new] = np.concatenate(found)
        slots = np.empty(len(names), np.int32)
        slots[np.concatenate(order)] = self.count + np.arange(len(names))
        self.at[self.count + 1:self.count + len(names) + 1] = used + np.cumsum(np.concatenate(counts))
        self.count += len(names)
        many, recent = self.levels
        recent = _merged(recent, (names, slots))
        if len(recent[0]) > max(1 << 17, len(many[0]) // 4):
            many, recent = _merged(many, recent), _NONE
        self.levels = [many, recent]
        return slots

    def _call(self, texts: list[str]) -> list[np.ndarray]:
        out = []
        for k in range(0, len(texts), 4096):
            found = self.tokenizer.encode_batch_fast(texts[k:k + 4096], add_special_tokens=False)
            out += [np.array(x.ids, self.ids.dtype) for x in found]
        return out


_NONE = (np.zeros(0, np.uint64), np.zeros(0, np.int32))


def _merged(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    names, slots = np.concatenate([a[0], b[0]]), np.concatenate([a[1], b[1]])
    order = np.argsort(names, kind="stable")
    return names[order], slots[order]


def _tokenize(path: str):
    """Per row its ids, the end id included; then, as part -1, how often (n) the task met each id (seq)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces, counts, kind, seq = Pieces.of(path), np.zeros(1, np.int64), None, 0
        for batch in batches:
            column = {name: batch.column(i) for i, name in enumerate(batch.schema.names)}
            kind = column["key"].type
            for first, last, data, offsets in slices(column["text"]):
                ids, at = pieces.encode(data, offsets)
                n = last - first
                ids = np.insert(ids, at[1:], END).astype("<u4")
                at = at + np.arange(n + 1)
                new = np.bincount(ids)
                if len(new) > len(counts):
                    counts = np.concatenate([counts, np.zeros(len(new) - len(counts), np.int64)])
                counts[:len(new)] += new
                raw = pa.py_buffer(_narrow(ids))
                width = 2 if len(raw) == 2 * len(ids) else 4
                coded = pa.Array.from_buffers(pa.large_binary(), n, [None, pa.py_buffer((at * width)), raw]).cast(pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [column["part"].slice(first, n), pa.array(seq + np.arange(n)), column["key"].slice(first, n),
                     pa.array(np.diff(at)), coded], ["part", "seq", "key", "n", "ids"],
                )
                seq += n
        if kind is not None:
            met = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(met), -1)), pa.array(met), pa.nulls(len(met), kind), pa.array(counts[met]),
                 pa.nulls(len(met), pa.binary())], ["part", "seq", "key", "n", "ids"],
            )

    return run


def _narrow(ids: np.ndarray) -> bytes:
    return (ids.astype("<u2") if len(ids) == 0 or ids.max() < 1 << 16 else ids).tobytes()


def _write_blocks(ranks):
    """Blocks of a part: coded ids of whole documents, their keys and lengths."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rank, kind = ranks.value, None
        keys, lengths, ids, part, held, block = [], [], [], None, 0, 0  # a block's number is its first row's

        def close() -> pa.RecordBatch:
            control, data = encode(rank[np.concatenate(ids)])
            names = ["part", "block", "keys", "lengths", "n_ids", "control", "data"]
            key_list = pa.ListArray.from_arrays(pa.array([0, len(keys)], pa.int32()), pa.array(keys, kind))
            length_list = pa.ListArray.from_arrays(pa.array([0, len(keys)], pa.int32()), pa.array(lengths, pa.int64()))
            return pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int64()), pa.array([block], pa.int64()), key_list, length_list,
                 pa.array([held], pa.int64()), pa.array([control]), pa.array([data])], names,
            )

        for batch in batches:
            column = {name: batch.column(i) for i, name in enumerate(batch.schema.names)}
            kind = column["key"].type
            whole = zip(*[column[c].to_pylist() for c in ("part", "seq", "key", "n")], column["ids"])
            for own, seq, key, n, raw in whole:
                if keys and (own != part or held >= BLOCK_IDS):
                    yield close()
                    keys, lengths, ids, held = [], [], [], 0
                if not keys:
                    part, block = own, seq
                raw = raw.as_buffer()
                keys.append(key)
                lengths.append(n)
                ids.append(np.frombuffer(raw, "<u2" if len(raw) == 2 * n else "<u4"))
                held += n
        if keys:
            yield close()

    return run


def write_token_files(
    docs: DataFrame, folder: str, tokenizer: str, key: str = "doc_id", text: str = "text"
) -> str:
    """Write the token ids of all rows of ``docs`` in ascending order of ``key`` (nulls first) under ``folder``.

    The text (null: empty) is encoded with the tokenizer file, special tokens are not added, and the id
    ``END`` ends each document. Files are Parquet: ``blocks`` holds per block its part, number, keys,
    document lengths, control bytes and data bytes; ``ranks`` holds the id of each rank. The commonest id
    of all documents has rank 0 (ties: smaller id), so that most ids take one byte. Parts are ranges of
    the key that no document crosses, cut so that a part holds about ``PART_BYTES`` of text; rows of one
    key stand in the order of their text's hash, so rows of a hot key can be cut into parts as well.

    Ids are computed once and kept in a table beside the files until these are written. The tokenizer
    returns the same ids for a piece of text wherever it stands, so each worker asks it once per
    distinct piece. An empty table writes empty files.
    """
    spark = docs.sparkSession
    tie = F.xxhash64("text")
    texts = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    total = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(1, int(total // PART_BYTES))
    dealt = texts.repartitionByRange(parts, F.asc_nulls_first("key"), tie) if parts > 1 else texts.coalesce(1)
    dealt = dealt.sortWithinPartitions(F.asc_nulls_first("key"), tie)
    dealt = dealt.select(F.spark_partition_id().cast("long").alias("part"), "key", "text")
    kind = docs.schema[key].dataType.simpleString()
    kept = f"{folder}/ids"
    dealt.mapInArrow(_tokenize(tokenizer), f"part long, seq long, key {kind}, n long, ids binary").write.option(
        "compression", "zstd").mode("overwrite").parquet(kept)

    ids = spark.read.parquet(kept)
    counted = ids.where("part = -1").groupBy(F.col("seq").alias("id")).agg(F.sum("n").alias("n"))
    by_rank = counted.orderBy(F.desc("n"), "id").select("id").toPandas()["id"].to_numpy(np.int64)  # of vocabulary size
    rank = np.zeros(int(by_rank.max(initial=0)) + 1, np.uint32)
    rank[by_rank] = np.arange(len(by_rank))
    spark.createDataFrame(
        list(enumerate(by_rank.tolist())), "rank long, id long"
    ).coalesce(1).write.mode("overwrite").parquet(f"{folder}/ranks")

    shape = f"part long, block long, keys array<{kind}>, lengths array<bigint>, n_ids long, control binary, data binary"
    rows = ids.where("part >= 0")
    blocks = rows.mapInArrow(_write_blocks(spark.sparkContext.broadcast(rank)), shape)
    blocks.write.option("compression", "zstd").mode("overwrite").parquet(f"{folder}/blocks")
    path = spark._jvm.org.apache.hadoop.fs.Path(kept)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    return folder


def read_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """One row per document: key, start (ids of all documents before it), n_tokens, ids_crc32 and ids (binary, 4 bytes each)."""
    blocks = spark.read.parquet(f"{folder}/blocks")
    ids = [row["id"] for row in spark.read.parquet(f"{folder}/ranks").orderBy("rank").collect()]  # vocabulary size
    sizes = blocks.groupBy("part", "block").agg(F.sum("n_ids").alias("n"))
    parts = sizes.groupBy("part").agg(F.sum("n").alias("n"))
    before = parts.select(
        "part", F.coalesce(F.sum("n").over(
            Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    inside = F.sum("n").over(Window.partitionBy("part").orderBy("block").rowsBetween(Window.unboundedPreceding, -1))
    starts = sizes.withColumn("inside", F.coalesce(inside, F.lit(0))).join(before, "part").select(
        "part", "block", (F.col("before") + F.col("inside")).alias("first"))
    kind = blocks.schema["keys"].dataType.elementType.simpleString()
    return blocks.join(starts, ["part", "block"]).select(
        "keys", "lengths", "n_ids", "control", "data", "first"
    ).mapInArrow(
        _read_blocks(spark.sparkContext.broadcast(np.array(ids, "<u4"))),
        f"key {kind}, start long, n_tokens long, ids_crc32 long, ids binary",
    )


def _read_blocks(names):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = names.value
        for batch in batches:
            column = {name: batch.column(i) for i, name in enumerate(batch.schema.names)}
            for k in range(batch.num_rows):
                ids = table[decode(column["control"][k].as_py(), column["data"][k].as_py(), column["n_ids"][k].as_py())]
                keys, lengths = column["keys"][k].values, column["lengths"][k].values.to_numpy(zero_copy_only=False)
                raw = ids.astype("<u4").tobytes()
                ends = np.cumsum(lengths)
                pieces = [raw[4 * (e - n):4 * e] for e, n in zip(ends.tolist(), lengths.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [keys, pa.array(ends - lengths + column["first"][k].as_py()), pa.array(lengths),
                     pa.array([zlib.crc32(x) for x in pieces], pa.int64()), pa.array(pieces, pa.binary())],
                    ["key", "start", "n_tokens", "ids_crc32", "ids"],
                )

    return run


def shared_folder(spark: SparkSession) -> str:
    """A new folder in the cluster's shared one."""
    return f"{shared_base(spark)}/tokens-{uuid.uuid4().hex}"


def token_digest(docs: DataFrame, tokenizer: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The token files of ``docs`` written and read back: key, start, n_tokens, ids_crc32."""
    spark = docs.sparkSession
    folder = write_token_files(docs, shared_folder(spark), tokenizer, key, text)
    return read_token_files(spark, folder).select(F.col("key").alias(key), "start", "n_tokens", "ids_crc32")


def op10_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return token_digest(docs, public_tokenizers.path(TOKENIZER))
