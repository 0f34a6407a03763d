r"""Hard negatives by inner product, over candidate blocks in Hilbert order with zone maps.

Candidates are sorted by label and, inside a label, by their place on a Hilbert curve through the vector space, and written
as Parquet rows of one block of vectors each. Beside its vectors a block row holds its zone map: the smallest and largest label
and the smallest and largest value of every dimension. Reading the zone maps alone reads no vectors.

An anchor looks for the best scores inside windows of scores. Interval arithmetic over a zone map bounds the scores
that a block can hold: with ``a`` the anchor, the sum of ``max(a, 0) * high + min(a, 0) * low`` from above and the
mirrored sum from below. A block whose bounds miss all windows of an anchor, or whose labels cannot fit, is not read for it.
Positives have one window per anchor, from the score that the anchor's own block already guarantees; each positive then
opens one window for its negatives. Bounds lose no row, so results are exact at any block size.

Anchors are packed in groups and zone maps in groups; each pair of groups is one row of a grid join, and each chosen block is
joined with the anchors that read it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from liftplan.llm.shared import stage

#: Vectors in a block, anchors in a group, zone maps in a group.
BLOCK_ROWS, GROUP_ANCHORS, GROUP_ZONES = 512, 512, 512
#: Bits of each dimension that the Hilbert key keeps.
HILBERT_BITS = 4
#: A component is scaled by this and rounded down; the result is cut to +-LARGEST so that scores fit 64 bits.
SCALE, LARGEST = 256, 1 << 26
#: Groups of each side that share a row or a column of the grid.
STRIPE = 4

_NONE, _ALL = -(1 << 62), 1 << 62


def hilbert_keys(cells: np.ndarray, bits: int) -> list[bytes]:
    """Place on the Hilbert curve of each row of ``cells`` (unsigned, below ``2 ** bits``), as bytes in curve order.

    Coordinates are turned into the transposed curve index one bit plane at a time, for all rows together.
    """
    n, dims = cells.shape
    if not n or not dims:
        return [b""] * n
    x = np.ascontiguousarray(cells.T, np.uint32)
    for bit in range(bits - 1, 0, -1):  # turn and flip the sub-cubes, coarse ones first
        at, below = np.uint32(1 << bit), np.uint32((1 << bit) - 1)
        for i in range(dims):
            upper = (x[i] & at) != 0
            swap = np.where(upper, np.uint32(0), (x[0] ^ x[i]) & below)
            x[0] ^= np.where(upper, below, swap)
            x[i] ^= swap
    for i in range(1, dims):  # Gray code over dimensions
        x[i] ^= x[i - 1]
    turn = np.zeros(n, np.uint32)
    for bit in range(bits - 1, 0, -1):
        turn ^= np.where((x[-1] >> np.uint32(bit)) & np.uint32(1), np.uint32((1 << bit) - 1), np.uint32(0))
    x ^= turn
    planes = np.stack([(x >> np.uint32(bit)) & np.uint32(1) for bit in range(bits - 1, -1, -1)])
    packed = np.packbits(planes.reshape(bits * dims, n).T.astype(np.uint8), axis=1)
    return [row.tobytes() for row in packed]


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    """Lists of whole numbers as rows; missing components are 0."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    lengths = column.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    if (lengths == dims).all():
        return flat.reshape(len(column), dims)
    out = np.zeros((len(column), dims), np.int64)
    at = np.repeat(np.arange(len(column)), lengths)
    out[at, np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = flat
    return out


class _Shape:
    """Dimensions and number types of a table's vectors; travels to the tasks."""

    def __init__(self, dims: int, largest: int):
        self.dims, self.largest = dims, largest
        self.kept = np.int16 if largest < 1 << 15 else np.int32
        most = dims * largest * largest
        #: Sums of products are exact in it.
        self.summed = np.float32 if most < 1 << 24 else np.float64 if most < 1 << 53 else np.int64

    def vectors(self, raw: bytes) -> np.ndarray:
        return np.frombuffer(raw, self.kept).reshape(-1, self.dims)

    def dot(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return a.astype(self.summed) @ b.astype(self.summed).T

    def bounds(self, a: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Least and greatest score of each anchor (rows) with any vector of each box (columns)."""
        up, down = np.maximum(a, 0), np.minimum(a, 0)
        return self.dot(up, low) + self.dot(down, high), self.dot(up, high) + self.dot(down, low)


def _keyed(shape: _Shape):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        side = 2 * shape.largest + 1
        for batch in batches:
            q = _matrix(batch.column(2), shape.dims)
            cells = ((q + shape.largest) << HILBERT_BITS) // side
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), batch.column(3), pa.array(hilbert_keys(cells, HILBERT_BITS), pa.binary()),
                 pa.array([v.tobytes() for v in q.astype(shape.kept)], pa.binary())], names=["vec_id", "label", "anchor", "key", "q"])
    return run


_BLOCK = pa.schema([("block", pa.int64()), ("n", pa.int32()), ("label_low", pa.int64()), ("label_high", pa.int64()), ("low", pa.binary()),
                    ("high", pa.binary()), ("ids", pa.binary()), ("labels", pa.binary()), ("anchors", pa.binary()), ("q", pa.binary())])
_BLOCK_SQL = "block long, n int, label_low long, label_high long, low binary, high binary, ids binary, labels binary, anchors binary, q binary"


def _runs(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.Table]:
    """Rows of a task in tables of ``size`` rows, the last one shorter."""
    held, n = [], 0
    for batch in batches:
        at = 0
        while at < batch.num_rows:
            part = batch.slice(at, size - n)
            held.append(part)
            at, n = at + part.num_rows, n + part.num_rows
            if n == size:
                yield pa.Table.from_batches(held)
                held, n = [], 0
    if n:
        yield pa.Table.from_batches(held)


def _packed(shape: _Shape, size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = TaskContext.get().partitionId() << 32
        for i, t in enumerate(_runs(batches, size)):
            ids, labels = (t.column(c).to_numpy() for c in ("vec_id", "label"))
            q = shape.vectors(b"".join(t.column("q").to_pylist()))
            yield pa.RecordBatch.from_pydict({
                "block": [first + i], "n": [len(ids)], "label_low": [labels.min()], "label_high": [labels.max()],
                "low": [q.min(axis=0).tobytes()], "high": [q.max(axis=0).tobytes()], "ids": [ids.tobytes()], "labels": [labels.tobytes()],
                "anchors": [t.column("anchor").to_numpy(zero_copy_only=False).tobytes()], "q": [q.tobytes()]}, schema=_BLOCK)
    return run


def _own(shape: _Shape, k: int):
    """Anchors of each block, with the least score that their positives have by what the block itself holds."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                at = np.flatnonzero(np.frombuffer(row["anchors"], bool))
                if not len(at):
                    continue
                ids, labels, q = np.frombuffer(row["ids"], np.int64), np.frombuffer(row["labels"], np.int64), shape.vectors(row["q"])
                scores = shape.dot(q[at], q).astype(np.int64)
                scores[(labels[at, None] != labels[None, :]) | (ids[at, None] == ids[None, :])] = _NONE
                least = np.partition(scores, -k, axis=1)[:, -k] if len(ids) >= k else np.full(len(at), _NONE)
                yield pa.RecordBatch.from_arrays([pa.array(ids[at]), pa.array(labels[at]), pa.array([q[i].tobytes() for i in at], pa.binary()), pa.array(least, pa.int64())],
                                                 names=["vec_id", "label", "q", "least"])
    return run


def _groups(width: int, size: int):
    """Anchors with their windows, ``size`` to a row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = TaskContext.get().partitionId() << 32
        for i, t in enumerate(_runs(batches, size)):
            bounds = []
            for name, empty in (("lows", _ALL), ("highs", _NONE)):  # places without a window hold no score
                table = np.full((t.num_rows, width), empty, np.int64)
                for j, values in enumerate(t.column(name).to_pylist()):
                    table[j, :len(values)] = values
                bounds.append(table.tobytes())
            yield pa.RecordBatch.from_pydict({"group": [first + i], "a_ids": [t.column("vec_id").to_numpy().tobytes()], "a_labels": [t.column("label").to_numpy().tobytes()],
                                              "a_q": [b"".join(t.column("q").to_pylist())], "lows": [bounds[0]], "highs": [bounds[1]]})
    return run


def _zones(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = TaskContext.get().partitionId() << 32
        for i, t in enumerate(_runs(batches, size)):
            yield pa.RecordBatch.from_pydict({"zone": [first + i], "blocks": [t.column("block").to_numpy().tobytes()],
                                              "label_range": [np.stack([t.column(c).to_numpy() for c in ("label_low", "label_high")]).tobytes()],
                                              "low": [b"".join(t.column("low").to_pylist())], "high": [b"".join(t.column("high").to_pylist())]})
    return run


_CHOSEN_SQL = "block long, a_ids binary, a_labels binary, a_q binary, lows binary, highs binary"


def _choose(shape: _Shape, width: int, same: bool):
    """Blocks that anchors of a group must read, each with those anchors."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                blocks, (first, last) = np.frombuffer(row["blocks"], np.int64), np.frombuffer(row["label_range"], np.int64).reshape(2, -1)
                ids, labels, a = np.frombuffer(row["a_ids"], np.int64), np.frombuffer(row["a_labels"], np.int64), shape.vectors(row["a_q"])
                lows, highs = (np.frombuffer(row[c], np.int64).reshape(-1, width) for c in ("lows", "highs"))
                least, most = shape.bounds(a, shape.vectors(row["low"]), shape.vectors(row["high"]))
                own = labels[:, None]
                if same:
                    read = (first <= own) & (own <= last)
                else:
                    read = ~((first == own) & (own == last))
                meets = np.zeros_like(read)
                for w in range(width):
                    meets |= (most >= lows[:, w, None]) & (least <= highs[:, w, None]) & (lows[:, w] <= highs[:, w])[:, None]
                read &= meets
                for j in np.flatnonzero(read.any(axis=0)).tolist():
                    at = np.flatnonzero(read[:, j])
                    yield pa.RecordBatch.from_pydict({"block": [blocks[j]], "a_ids": [ids[at].tobytes()], "a_labels": [labels[at].tobytes()], "a_q": [a[at].tobytes()],
                                                      "lows": [lows[at].tobytes()], "highs": [highs[at].tobytes()]})
    return run


def _score(shape: _Shape, width: int, same: bool, k: int):
    """The best ``k`` rows of a block in each window of each anchor that reads it."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids, labels, q = np.frombuffer(row["ids"], np.int64), np.frombuffer(row["labels"], np.int64), shape.vectors(row["q"])
                a_ids, a_labels = np.frombuffer(row["a_ids"], np.int64), np.frombuffer(row["a_labels"], np.int64)
                lows, highs = (np.frombuffer(row[c], np.int64).reshape(-1, width) for c in ("lows", "highs"))
                scores = shape.dot(shape.vectors(row["a_q"]), q)
                fits = (a_labels[:, None] == labels[None, :]) == same
                fits &= (scores >= lows.min(axis=1)[:, None]) & (scores <= highs.max(axis=1)[:, None])
                if same:
                    fits &= a_ids[:, None] != ids[None, :]
                at, of = np.nonzero(fits)
                got = scores[at, of].astype(np.int64)
                order = np.lexsort((ids[of], -got, at))
                at, of, got = at[order], of[order], got[order]
                out = []
                for w in range(width):
                    inside = np.flatnonzero((got >= lows[at, w]) & (got <= highs[at, w]))
                    begins = np.searchsorted(at[inside], at[inside])  # rows of one anchor stand together, best first
                    inside = inside[np.arange(len(inside)) - begins < k]
                    out.append((a_ids[at[inside]], np.full(len(inside), w), got[inside], ids[of[inside]]))
                anchor, window, score, found = (np.concatenate(c) for c in zip(*out, strict=True))
                yield pa.RecordBatch.from_arrays([pa.array(anchor), pa.array(window, pa.int32()), pa.array(score), pa.array(found)], names=["anchor_id", "window", "score", "vec_id"])
    return run


class Candidates:
    """Blocks of a table's vectors, their zone maps and the table's anchors.

    ``vectors`` has an id, a label (whole number) and a vector (list of numbers) per row; ``anchor`` marks anchor rows. Rows
    with a null id, label or vector, or with a null or non-finite component, take no part. Of several rows with one id the one with the
    smallest label, then vector, counts. Vectors shorter than the longest one count as filled up with 0.
    """

    def __init__(self, vectors: DataFrame, anchor: Column, id_col: str = "vec_id", label_col: str = "label", vector_col: str = "embedding",
                 block_rows: int = BLOCK_ROWS, positives: int = 5):
        v = F.col(f"`{vector_col}`").cast("array<double>")
        # A comparison with a null component is null, so the whole test is not true.
        finite = F.forall(v, lambda x: (F.abs(x) < float("inf")) & ~F.isnan(x))
        whole = F.transform(v, lambda x: F.greatest(F.lit(-LARGEST), F.least(F.lit(LARGEST), F.floor(x * SCALE))).cast("int"))
        valid = vectors.where(F.col(f"`{id_col}`").isNotNull() & F.col(f"`{label_col}`").isNotNull() & v.isNotNull() & finite)
        one = valid.select(F.col(f"`{id_col}`").cast("long").alias("vec_id"), F.col(f"`{label_col}`").cast("long").alias("label"), whole.alias("q"), anchor.alias("anchor"))
        rows = stage(one.groupBy("vec_id").agg(F.min(F.struct("label", "q", "anchor")).alias("r")).select("vec_id", "r.*"), "vectors")
        dims, largest = rows.agg(F.max(F.size("q")), F.max(F.array_max(F.transform("q", F.abs)))).first()
        self.shape, self.k = _Shape(max(dims or 1, 1), max(largest or 1, 1)), positives
        keyed = rows.select("vec_id", "label", "q", "anchor").mapInArrow(_keyed(self.shape), "vec_id long, label long, anchor boolean, key binary, q binary")
        # Equal vectors have one key; the id lets range partitions part them.
        placed = keyed.repartitionByRange("label", "key", "vec_id").sortWithinPartitions("label", "key", "vec_id")
        self.blocks = stage(placed.mapInArrow(_packed(self.shape, block_rows), _BLOCK_SQL), "vector-blocks")
        self.anchors = stage(self.blocks.select("ids", "labels", "anchors", "q").mapInArrow(_own(self.shape, positives), "vec_id long, label long, q binary, least long"), "anchors")
        zones = self.blocks.select("block", "label_low", "label_high", "low", "high")
        self.zones = stage(zones.mapInArrow(_zones(GROUP_ZONES), "zone long, blocks binary, label_range binary, low binary, high binary"), "zone-maps")

    def chosen(self, anchors: DataFrame, width: int, same: bool) -> DataFrame:
        """Block and packed anchors of each block that some of ``anchors`` (vec_id, label, q, lows, highs) must read."""
        groups = stage(anchors.select("vec_id", "label", "q", "lows", "highs").mapInArrow(
            _groups(width, GROUP_ANCHORS), "group long, a_ids binary, a_labels binary, a_q binary, lows binary, highs binary"), "anchor-groups")
        rows, columns = (max(1, -(-df.count() // STRIPE)) for df in (groups, self.zones))
        left = groups.withColumns({"row": F.pmod(F.xxhash64("group"), F.lit(rows)), "column": F.explode(F.sequence(F.lit(0), F.lit(columns - 1)).cast("array<long>"))})
        right = self.zones.withColumns({"column": F.pmod(F.xxhash64("zone"), F.lit(columns)), "row": F.explode(F.sequence(F.lit(0), F.lit(rows - 1)).cast("array<long>"))})
        grid = left.join(right, ["row", "column"]).select("a_ids", "a_labels", "a_q", "lows", "highs", "blocks", "label_range", "low", "high")
        return grid.mapInArrow(_choose(self.shape, width, same), _CHOSEN_SQL)

    def best(self, anchors: DataFrame, width: int, same: bool, k: int) -> DataFrame:
        """anchor_id, window, score, vec_id, rank: the first ``k`` rows in each window."""
        read = self.chosen(anchors, width, same).join(self.blocks.select("block", "ids", "labels", "q"), "block")
        found = read.drop("block").mapInArrow(_score(self.shape, width, same, k), "anchor_id long, window int, score long, vec_id long")
        ranked = F.row_number().over(Window.partitionBy("anchor_id", "window").orderBy(F.desc("score"), "vec_id"))
        return found.withColumn("rank", ranked).where(F.col("rank") <= k)

    def positives(self) -> DataFrame:
        """anchor_id, window (place from 0), positive_id, positive_score: the best other rows of an anchor's label."""
        opened = self.anchors.withColumns({"lows": F.array("least"), "highs": F.array(F.lit(_ALL))})
        found = self.best(opened, 1, True, self.k)
        return found.select("anchor_id", (F.col("rank") - 1).alias("window"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"))


def hard_negatives(vectors: DataFrame, anchor: Column, id_col: str = "vec_id", label_col: str = "label", vector_col: str = "embedding", positives: int = 5,
                   negatives: int = 5, least_percent: int = 80, most_percent: int = 100, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Hard negatives of each anchor and positive: anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    An anchor's positives are its ``positives`` best other rows of the same label. For each of them the best ``negatives`` rows of other labels count whose
    score lies between ``least_percent`` and ``most_percent`` of the positive's score; a negative positive score gives an empty
    window, and a pair without such rows gives none. Scores are inner products of components scaled by 256 and rounded down; ties go to the
    smaller id. See ``Candidates`` for nulls, repeated ids and odd vectors; an empty table, or one without anchors, gives no rows; extra
    columns are not read.
    """
    made = Candidates(vectors, anchor, id_col, label_col, vector_col, block_rows, positives)
    pairs = stage(made.positives(), "positives")
    # A whole number is at least p percent of the score when it is at least the quotient rounded up; at most, rounded down.
    low = F.expr(f"-((-positive_score * {least_percent} - pmod(-positive_score * {least_percent}, 100)) div 100)")
    high = F.expr(f"(positive_score * {most_percent} - pmod(positive_score * {most_percent}, 100)) div 100")
    windows = pairs.groupBy("anchor_id").agg(F.sort_array(F.collect_list(F.struct("window", low.alias("low"), high.alias("high")))).alias("w"))  # at most ``positives`` entries
    opened = made.anchors.join(windows.withColumnRenamed("anchor_id", "vec_id"), "vec_id").select("vec_id", "label", "q", F.col("w.low").alias("lows"), F.col("w.high").alias("highs"))
    found = made.best(opened, positives, False, negatives)
    return found.join(pairs, ["anchor_id", "window"]).select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("vec_id").alias("negative_id"),
                                                              "positive_score", F.col("score").alias("negative_score"))


_HELD = "list_transform(embedding, lambda x: floor(256 * x::DOUBLE))"


def oracle() -> str:
    """The registered form in SQL, over all pairs of anchor and row."""
    return f"""
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, {_HELD} AS q FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS anchor_id, b.vec_id AS vec_id, a.label = b.label AS same, list_inner_product(a.q, b.q)::BIGINT AS score
  FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT p.anchor_id, positive_id, CAST(row_number() OVER w AS INTEGER) AS rank, s.vec_id AS negative_id, positive_score, s.score AS negative_score
FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same AND 80 * positive_score <= 100 * s.score AND s.score <= positive_score
WINDOW w AS (PARTITION BY p.anchor_id, positive_id ORDER BY s.score DESC, s.vec_id)
QUALIFY rank <= 5"""


__all__ = ["Candidates", "hard_negatives", "hilbert_keys", "oracle"]
