"""Exact Jaccard self-join of documents on word n-grams, as a blocked product of the sparse
document by n-gram incidence matrix with its transpose."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from marlstone.llm.links import components, cut
from marlstone.llm.texts import carried, mix, shingle_sets, slices
from marlstone.session import release_shuffles

#: Rows of a matrix block, and columns multiplied at once.
BLOCK_ROWS = 256
BLOCK_COLUMNS = 2048
#: A row must share this part of its n-grams, found among its smallest hashes, to be looked at further.
FIRST_LOOK = 0.1
#: Smallest share of overlap, in hundredths.
SIMILARITY = 75


def jaccard_links(
    docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = 5, similarity: int = SIMILARITY
) -> DataFrame:
    """One row per row of ``docs``: key, n_shingles, component_id, n_links.

    Rows link when ``100 * intersection >= similarity * union`` of their sets of ``size``-word shingles.
    ``component_id`` is the smallest key that links reach, ``n_links`` the number of other rows linked
    directly.

    1. Rows with equal sets form one matrix row (its 64-bit set hash is its number), so exact copies
       are never paired.
    2. Of n n-grams a row may lack at most ``n - ceil(similarity * n)`` in any partner. So among its
       ``that + k`` smallest hashes at least k occur in other rows, with k = ``FIRST_LOOK * n``; rows that
       fail leave. Those left are looked at with all their n-grams, counted over all rows left; rows with
       too many n-grams of their own leave. The rest keep their rarest ``that + 1`` columns, of which
       any partner must hold one. Rows that share such a column fall into one diagonal block of the
       product (connected components); every link lies within a block.
    3. A block is multiplied in pieces of at most ``BLOCK_ROWS`` rows, cut by size class, since sizes
       of linked rows are within the similarity of each other. Overlap counts are accumulated over
       pieces of columns, and pairs whose remaining columns cannot reach the bound are discarded.
       A piece returns a spanning forest of its links and link counts per row, never all pairs.

    A null or empty text has no shingles, links with nothing and has its own key as component. Equal
    texts, repeated keys and repeated rows are ordinary rows. A null key takes part; components of
    null keys only are null. An empty table gives an empty result; other columns are not read.
    """
    rows, own = _linked(docs, key, text, size, similarity)
    linked = rows.where("n > 0").join(own, "node", "left").select("key", "n", "component_id", "n_links")
    alone = rows.where("n = 0").select("key", "n", F.col("key").alias("component_id"), F.lit(0).cast("long").alias("n_links"))
    return linked.unionByName(alone).select(
        F.col("key").alias(key), F.col("n").alias("n_shingles"), "component_id", "n_links"
    )


def drop_linked(
    docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = 5, similarity: int = SIMILARITY
) -> DataFrame:
    """``docs`` with one row of every component of ``jaccard_links``: one of its smallest key (null only if all are).

    Rows without links pass through where they are; a bitmap of the linked rows' numbers tells them
    apart. Only rows that may be linked are joined with the components, so few texts are shuffled.
    Rows without shingles stay. Columns and other values are as before.
    """
    every, own = _linked(docs, key, text, size, similarity)
    own = cut(own.where("n_links > 0").select("node", "component_id", "keeper"))
    del every
    release_shuffles(docs.sparkSession)  # the join's; the texts are shuffled after it
    bits = docs.sparkSession.sparkContext.broadcast(_member_bits(own))
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    whole = whole.mapInArrow(
        _told(size, text, bits), f"row {docs.schema.simpleString()}, node long, maybe boolean")
    free = whole.where("NOT maybe").select("row")
    tied = whole.where("maybe").join(own, "node", "left").where(
        F.col("component_id").isNull() & F.col("keeper").isNull() | F.col("row")[key].eqNullSafe(F.col("component_id"))
        & (F.col("node") == F.col("keeper")))
    once = tied.where("keeper IS NOT NULL").dropDuplicates(["keeper"]).select("row")
    return free.unionByName(tied.where("keeper IS NULL").select("row")).unionByName(once).select("row.*")


def _told(size: int, text: str, wanted):
    """Rows with their set's number and whether its bit is set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, texts = carried(batch, text)
            for first, last, _, at, node in _sets(texts, size):
                maybe = _inside(wanted.value, node) & (np.diff(at) > 0)
                yield pa.RecordBatch.from_arrays(
                    [rows.slice(first, last - first), pa.array(node), pa.array(maybe)], ["row", "node", "maybe"])

    return run


def _linked(docs: DataFrame, key: str, text: str, size: int, similarity: int) -> tuple[DataFrame, DataFrame]:
    """(key, n, node) for each row, and (node, component_id, keeper, n_links) for each distinct set that is not empty.

    ``keeper`` is the smallest number of a component's sets that hold its smallest key.
    """
    if not 50 < similarity <= 100:
        raise ValueError("similarity must be above 50 and at most 100 hundredths")
    texts = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    kind = docs.schema[key].dataType.simpleString()

    context = docs.sparkSession.sparkContext
    rows = cut(texts.mapInArrow(_numbered(size), f"key {kind}, n long, node long"))
    nodes = rows.where("n > 0").groupBy("node").agg(
        F.min("key").alias("first"), F.count("*").alias("copies"), F.first("n").alias("n")
    )
    lacking = F.col("n") - F.ceil(F.col("n") * similarity / 100).cast("long")

    met = Window.partitionBy("gram")
    shared = texts.select("text").mapInArrow(_first_look(size, similarity), "gram long, node long, held long")
    shared = shared.select("node", "held", (
        (F.min("node").over(met) < F.max("node").over(met)) | (F.min("held").over(met) < 0)
    ).cast("long").alias("other"))
    shared = shared.where("node IS NOT NULL AND (other > 0 OR held > 0)").groupBy("node").agg(
        F.sum(F.col("other") + F.greatest("held", F.lit(0))).alias("found"), F.max("held")
    )
    left = shared.join(nodes, "node").where(F.col("found") >= F.greatest(F.lit(1), F.floor(F.col("n") * FIRST_LOOK)))
    left = context.broadcast(_member_bits(left.select("node")))

    full = texts.select("text").mapInArrow(_sets_of(size, left, True), "gram long, node long")
    full = full.repartition("gram").groupBy("gram", "node").agg(F.lit(1).alias("one"))
    full = full.select("gram", "node", F.count("*").over(met).alias("held_by"))
    own = Window.partitionBy("node")
    ranked = full.join(nodes, "node").select(
        "gram", "node", lacking.alias("lacking"),
        F.sum((F.col("held_by") == 1).cast("long")).over(own).alias("alone"),
        F.row_number().over(own.orderBy("held_by", "gram")).alias("place"),
    ).where("alone <= lacking AND place <= lacking + 1")
    near = ranked.select(F.col("node").alias("a"), F.min("node").over(met).alias("b")).where("a <> b").distinct()
    blocks = cut(components(near))

    wanted = context.broadcast(_member_bits(blocks))
    sets = texts.select("text").mapInArrow(_sets_of(size, wanted, False), "node long, grams binary")
    placed = _tiles(blocks.join(nodes, "node"), similarity)
    tiles = sets.join(placed, "node").repartition("tile").sortWithinPartitions("tile", "side", "node")
    products = cut(tiles.mapInArrow(_multiply(similarity), "a long, b long, links long"))

    roots = components(products.where("b IS NOT NULL").select("a", "b"))
    degree = products.where("b IS NULL").groupBy(F.col("a").alias("node")).agg(F.sum("links").alias("links"))
    own = nodes.join(roots, "node", "left").join(degree, "node", "left").withColumn(
        "root", F.coalesce("root", "node")
    )
    least = own.groupBy("root").agg(F.min(F.struct(F.col("first").isNull(), "first", "node")).alias("least"))
    own = own.join(least, "root").select(
        "node", F.col("least.first").alias("component_id"), F.col("least.node").alias("keeper"),
        (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
    )
    return rows, own


def _node(grams: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The number of each set: a 64-bit hash of its members, the same in every order."""
    sums = np.zeros(len(grams) + 1, np.uint64)
    np.cumsum(mix(grams ^ np.uint64(0x2545F4914F6CDD1D)), out=sums[1:])
    return mix(sums[at[1:]] - sums[at[:-1]] + np.diff(at).astype(np.uint64)).view(np.int64)


def _sets(texts: pa.Array, size: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
    for first, last, data, offsets in slices(texts):
        grams, at = shingle_sets(data, offsets, size)
        yield first, last, grams, at, _node(grams, at)


def _numbered(size: int):
    """Per row the size and number of its set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column(batch.schema.get_field_index("key"))
            for first, last, _, at, node in _sets(batch.column(batch.schema.get_field_index("text")), size):
                yield pa.RecordBatch.from_arrays(
                    [keys.slice(first, last - first), pa.array(np.diff(at)), pa.array(node)], ["key", "n", "node"]
                )

    return run


def _first_look(size: int, similarity: int):
    """(gram, node, held) for the smallest n-grams of each row.

    N-grams that several rows of a slice hold are told once per slice, without a node and held -1; how
    many of them a row has is told once per row, under an n-gram number of its own. So a slice sends
    an n-gram once however many of its rows hold it.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, grams, at, node in _sets(batch.column(batch.schema.get_field_index("text")), size):
                rows = np.unique(node, return_index=True)[1]
                n = np.diff(at)[rows]
                rows, n = rows[n > 0], n[n > 0]
                take = np.minimum(n, n + similarity * n // -100 + np.maximum(1, (FIRST_LOOK * n).astype(np.int64)))
                if not len(rows):
                    continue
                index = np.repeat(at[rows] - np.cumsum(take) + take, take) + np.arange(int(take.sum()))
                gram, own = grams[index], np.repeat(node[rows], take)
                order = np.argsort(gram, kind="stable")
                gram, own = gram[order], own[order]
                lead = np.r_[True, gram[1:] != gram[:-1]]
                many = ~lead | np.r_[~lead[1:], False]
                told = gram[many & lead]
                name, held = np.unique(own[many], return_counts=True)
                place = mix(name.view(np.uint64) ^ grams[index[0]] ^ np.uint64(len(index)))
                none = pa.nulls(len(told), pa.int64())
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.r_[gram[~many], told, place].view(np.int64)),
                    pa.concat_arrays([pa.array(own[~many]), none, pa.array(name)]),
                    pa.array(np.r_[np.zeros((~many).sum(), np.int64), np.full(len(told), -1), held]),
                ], ["gram", "node", "held"])

    return run


#: Bits that tell tasks which rows lie in a block; a wrong yes costs time only.
MEMBER_BITS = 1 << 26


def _member_bits(blocks: DataFrame) -> np.ndarray:
    """A bitmap of fixed size of the numbers of all rows in blocks, each task's part joined by OR."""
    words = MEMBER_BITS // 64
    place = F.pmod(F.shiftrightunsigned("node", 20), F.lit(MEMBER_BITS))
    parts = blocks.select(F.floor(place / 64).cast("int").alias("word"), F.pmod(place, F.lit(64)).cast("int").alias("bit"))
    parts = parts.groupBy("word").agg(F.bit_or(F.expr("shiftleft(1L, bit)")).alias("bits")).toPandas()
    out = np.zeros(words, np.uint64)
    out[parts["word"].to_numpy(np.int64)] = parts["bits"].to_numpy(np.int64).view(np.uint64)
    return out


def _inside(bits: np.ndarray, node: np.ndarray) -> np.ndarray:
    place = (node.view(np.uint64) >> np.uint64(20)) % np.uint64(MEMBER_BITS)
    return ((bits[place >> np.uint64(6)] >> (place & np.uint64(63))) & np.uint64(1)).astype(bool)


def _sets_of(size: int, wanted, by_gram: bool):
    """The sets of rows whose bit is set: a row per n-gram (gram, node), or one per set (node, grams)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = wanted.value
        for batch in batches:
            for _, _, grams, at, node in _sets(batch.column(batch.schema.get_field_index("text")), size):
                once = np.unique(node, return_index=True)[1]
                rows = once[_inside(bits, node[once]) & (np.diff(at)[once] > 0)]
                if not len(rows):
                    continue
                if by_gram:
                    held = pa.array(np.concatenate([grams[at[k]:at[k + 1]] for k in rows]).view(np.int64))
                    names = pa.array(np.repeat(node[rows], np.diff(at)[rows]))
                    yield pa.RecordBatch.from_arrays([held, names], ["gram", "node"])
                else:
                    held = pa.array([grams[at[k]:at[k + 1]].tobytes() for k in rows], pa.binary())
                    yield pa.RecordBatch.from_arrays([pa.array(node[rows]), held], ["node", "grams"])

    return run


def _tiles(members: DataFrame, similarity: int) -> DataFrame:
    """(node, copies, tile, side): the pieces of its block's product that each row takes part in.

    Side 0 and 1 are the two sides of a product of different pieces, side 2 a product of a piece with
    itself. Linked sizes are within the similarity, so they fall into the same or the next class.
    """
    step = float(np.log(100 / similarity)) if similarity < 100 else 1e-9
    cls = F.floor(F.log(F.col("n").cast("double")) / step + 1e-9).cast("long")
    rows = members.select("node", "copies", F.col("root").alias("block"), cls.alias("cls"))
    sizes = rows.groupBy("block", "cls").agg(F.count("*").alias("rows"))
    whole = F.sum("rows").over(Window.partitionBy("block"))
    cuts = sizes.withColumn("whole", whole).withColumn("cuts", F.ceil(F.col("rows") / BLOCK_ROWS).cast("long"))
    by_class = Window.partitionBy("block").orderBy("cls").rangeBetween
    cuts = cuts.select(
        "block", "cls", "whole", "cuts",
        F.coalesce(F.sum("cuts").over(by_class(1, 1)), F.lit(0)).alias("above"),
        F.coalesce(F.sum("cuts").over(by_class(-1, -1)), F.lit(0)).alias("below"),
    )
    small = F.col("whole") <= BLOCK_ROWS
    part = F.when(small, F.lit(0)).otherwise(F.pmod(F.xxhash64("node"), F.col("cuts")))

    def tile(side, *names):
        return F.struct(F.xxhash64("block", *names).alias("tile"), F.lit(side).alias("side"))

    def all_of(count, make):
        return F.when(F.col(count) > 0, F.transform(F.sequence(F.lit(0).cast("long"), F.col(count) - 1), make)).otherwise(
            F.expr("array()").cast("array<struct<tile:bigint,side:int>>")
        )

    cls, mine = F.col("cls"), F.col("part")
    many = F.concat(
        all_of("cuts", lambda j: F.when(j == mine, tile(2, cls, mine, cls, mine))
               .when(j > mine, tile(0, cls, mine, cls, j)).otherwise(tile(1, cls, j, cls, mine))),
        all_of("above", lambda j: tile(0, cls, mine, cls + 1, j)),
        all_of("below", lambda j: tile(1, cls - 1, j, cls, mine)),
    )
    here = rows.join(cuts, ["block", "cls"]).withColumn("part", part)
    return here.select("node", "copies", F.explode(
        F.when(small, F.array(tile(2, F.lit(-1)))).otherwise(many)
    ).alias("t")).select("node", "copies", "t.tile", "t.side")


def _multiply(similarity: int):
    """Products of the pieces of a partition, which arrive ordered by piece and side."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tile, rows, out, held = None, [], [], 0
        for batch in batches:
            table = {name: batch.column(i) for i, name in enumerate(batch.schema.names)}
            tiles, sides = table["tile"].to_numpy().tolist(), table["side"].to_numpy().tolist()
            nodes, copies = table["node"].to_numpy().tolist(), table["copies"].to_numpy().tolist()
            for k, own in enumerate(tiles):
                if own != tile:
                    if len(rows) > 1:
                        out.append(_product(rows, similarity))
                        held += len(out[-1][0])
                    tile, rows = own, []
                    if held > 100_000:
                        yield _answer(out)
                        out, held = [], 0
                if not rows or rows[-1][:2] != (sides[k], nodes[k]):
                    rows.append((sides[k], nodes[k], copies[k], np.frombuffer(table["grams"][k].as_buffer(), np.uint64)))
        if len(rows) > 1:
            out.append(_product(rows, similarity))
        if out:
            yield _answer(out)

    return run


def _answer(out: list) -> pa.RecordBatch:
    a, b, links = (np.concatenate(x) for x in zip(*out))
    return pa.RecordBatch.from_arrays(
        [pa.array(a), pa.array(b, mask=links >= 0), pa.array(links, mask=links < 0)], ["a", "b", "links"]
    )


def _product(rows: list[tuple], similarity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Spanning links (a, b, -1) and link counts (a, 0, count) of one piece of the product."""
    same = rows[0][0] == 2
    left = [r for r in rows if r[0] != 1]
    right = left if same else [r for r in rows if r[0] == 1]
    if not left or not right:
        return (np.zeros(0, np.int64),) * 3
    counts, bound = overlaps([r[3] for r in left], None if same else [r[3] for r in right], similarity)
    linked = counts >= bound
    if same:
        np.fill_diagonal(linked, False)
    names = [np.array([r[1] for r in side], np.int64) for side in (left, right)]
    copies = [np.array([r[2] for r in side], np.int64) for side in (left, right)]
    degrees = [(names[0], linked @ copies[1])] + ([] if same else [(names[1], linked.T @ copies[0])])
    found = [(n[d > 0], np.zeros((d > 0).sum(), np.int64), d[d > 0]) for n, d in degrees]
    if same:
        a, b = _forest(linked)
        found.append((names[0][a], names[0][b], np.full(len(a), -1)))
    else:
        k = len(left)
        both = np.zeros((k + len(right),) * 2, bool)
        both[:k, k:], both[k:, :k] = linked, linked.T
        a, b = _forest(both)
        every = np.concatenate(names)
        found.append((every[a], every[b], np.full(len(a), -1)))
    return tuple(np.concatenate(x).astype(np.int64) for x in zip(*found))


def _forest(linked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of a symmetric link matrix."""
    todo = linked.any(axis=1)
    a, b = [], []
    for start in np.flatnonzero(todo).tolist():
        if not todo[start]:
            continue
        todo[start] = False
        front = [start]
        while front:
            row = front.pop()
            new = np.flatnonzero(linked[row] & todo)
            if len(new):
                todo[new] = False
                a.append(np.full(len(new), row))
                b.append(new)
                front.extend(new.tolist())
    none = np.zeros(0, np.int64)
    return (np.concatenate(a), np.concatenate(b)) if a else (none, none)


def overlaps(
    left: list[np.ndarray], right: list[np.ndarray] | None, similarity: int
) -> tuple[np.ndarray, np.ndarray]:
    """Overlap counts of two lists of n-gram sets (``right`` None: ``left`` with itself), and the least counts that link.

    The incidence matrix is multiplied in pieces of columns. A row leaves the product when no pair of it
    can still reach its bound, with all columns to come; its counts may then be too small, never too large.
    """
    sets = left if right is None else left + right
    sizes = np.array([len(x) for x in sets], np.int64)
    grams, column = np.unique(np.concatenate(sets), return_inverse=True)
    row = np.repeat(np.arange(len(sets)), sizes)
    times = np.bincount(column, minlength=len(grams))
    shared = times > 1
    keep = shared[column]
    column, row = (np.cumsum(shared) - 1)[column[keep]], row[keep]
    order = np.argsort(column, kind="stable")
    column, row = column[order], row[order]
    k = len(left)
    first, second = slice(0, k), slice(0, k) if right is None else slice(k, None)
    total = sizes[first][:, None] + sizes[second][None, :]
    bound = -(-similarity * total // (100 + similarity))
    counts = np.zeros(bound.shape, np.int64)
    rest = np.bincount(row, minlength=len(sets))
    live = np.ones(len(sets), bool)
    for start in range(0, int(shared.sum()), BLOCK_COLUMNS):
        a, b = np.searchsorted(column, [start, start + BLOCK_COLUMNS])
        piece = np.zeros((len(sets), BLOCK_COLUMNS), np.float32)
        piece[row[a:b], column[a:b] - start] = 1
        rest -= np.bincount(row[a:b], minlength=len(sets))
        x, y = np.flatnonzero(live[first]), np.flatnonzero(live[second])
        counts[np.ix_(x, y)] += (piece[first][x] @ piece[second][y].T).astype(np.int64)
        hope = counts + np.minimum(rest[first][:, None], rest[second][None, :]) >= bound
        if right is None:
            np.fill_diagonal(hope, False)
        ours, theirs = hope.any(axis=1), hope.any(axis=0)
        live[first] &= ours
        live[second] &= theirs
        if not ours.any():
            break
    return counts, bound


def op3_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_links(spark.read.parquet(f"{sf_dir}/documents.parquet"))


OP3_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
g AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 5
    THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))
    WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s FROM w),
n AS (SELECT doc_id, count(*) AS n FROM g GROUP BY doc_id),
pairs AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS i FROM g a JOIN g b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY 1, 2),
links AS (SELECT a, b FROM pairs JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * i >= 75 * (x.n + y.n - i)),
reach AS (SELECT a, b FROM links UNION SELECT reach.a, links.b FROM reach JOIN links ON links.a = reach.b),
low AS (SELECT a AS doc_id, min(b) AS low FROM reach GROUP BY 1),
deg AS (SELECT a AS doc_id, count(*) AS n_links FROM links GROUP BY 1)
SELECT doc_id, coalesce(n.n, 0) AS n_shingles, least(doc_id, coalesce(low, doc_id)) AS component_id, coalesce(n_links, 0) AS n_links
FROM documents LEFT JOIN n USING (doc_id) LEFT JOIN low USING (doc_id) LEFT JOIN deg USING (doc_id)
"""
