r"""Best-fit packing of documents into sequences by a grouping genetic algorithm.

Documents are encoded and only those longer than a sequence are cut. Pieces that fill a sequence are one by themselves; the others are
dealt into blocks of a bounded number of pieces. A block is evolved on several islands, each a population of packings that lives in
one row:

* a packing (chromosome) says for each piece which bin it is in; bins are its genes;
* crossover injects whole well-filled bins of one parent into the other, drops the bins there that hold one of the injected pieces, and
  puts the displaced pieces back by best fit, long ones first; mutation empties some of the worst bins in the same way;
* fitness is the number of bins, then the sum of squared fills;
* after an epoch each island's elite migrates to the next island of its block (a join), and the next epoch begins.

The best packing of a block is kept but for its badly filled bins: their pieces of all blocks are pooled and packed anew in the next
round, until a round no longer halves the pool. So loss is a few bins in all, not a few per block.
"""

from __future__ import annotations

import os
import random
import sys
import types
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from liftplan.llm.shared import stage
from liftplan.llm.words import as_bytes, spans

CAPACITY = 4096
#: Pieces in a block on average, islands of a block, packings of an island, epochs, and children of an island in an epoch.
BLOCK_PIECES, ISLANDS, POPULATION, EPOCHS, CHILDREN = 2000, 3, 4, 2, 5
#: Bins filled less than this share go back to the pool.
WELL_FILLED = 0.99
#: Bytes of words whose ids a worker keeps at hand.
WORD_CACHE = 240 << 20


class WordEncoder:
    r"""Ids of texts with a vocabulary whose pre-tokeniser drops white space: no token reaches over ``[\x20\x09-\x0D]``, so words are encoded alone and kept.

    Vocabularies that keep white space would be encoded otherwise than as whole texts; they are refused. ASCII texts are lower-cased before the look-up
    where the vocabulary does so itself. Special tokens of the vocabulary keep their ids, as in the tokenizer when it is loaded.
    """

    def __init__(self, path: str, cache_bytes: int = WORD_CACHE):
        from tokenizers import Tokenizer

        self.tokenizer, self.cache_bytes = Tokenizer.from_file(path), cache_bytes
        added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        if self._ids(["a b"])[0] != b"".join(self._ids(["a", " b "])) or any(c.isspace() for t in added for c in t):
            raise ValueError("the vocabulary does not drop white space")
        self.lowers = self._ids(["Q"]) == self._ids(["q"])
        self.added = [t.encode() for t in added]
        self.known: dict[bytes, bytes] = {}
        self.held = 0

    def _ids(self, words: list[str]) -> list[bytes]:
        return [np.array(x.ids, "<u4").tobytes() for x in self.tokenizer.encode_batch_fast(words, add_special_tokens=False)]

    def encode(self, texts: list[bytes]) -> list[bytes]:
        """Ids of each text, 32 bits each."""
        split, missing, get = [], set(), self.known.get
        for text in texts:
            if self.lowers and text.isascii() and not any(t in text for t in self.added):
                text = text.lower()
            words = text.split()  # bytes are split at just these six characters
            got = list(map(get, words))
            if None in got:
                missing.update(w for w, g in zip(words, got) if g is None)
                split.append((words, got))
            else:
                split.append((None, got))
        order = list(missing)
        fresh = dict(zip(order, self._ids([w.decode("utf-8") for w in order]), strict=True))
        if self.held < self.cache_bytes:
            kept = {w: x for w, x in fresh.items() if len(w) < 60}
            self.known.update(kept)
            self.held += sum(len(w) + len(x) + 190 for w, x in kept.items())
        return [b"".join(got if words is None else [fresh[w] if g is None else g for w, g in zip(words, got)]) for words, got in split]


def _encoder(path: str) -> WordEncoder:
    """The encoder of this worker process; it keeps its words from one task to the next."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs a task per core
    kept = sys.modules.setdefault("_liftplan_words", types.ModuleType("_liftplan_words")).__dict__
    if path not in kept:
        kept[path] = WordEncoder(path)
    return kept[path]


def _pieces(path: str, end_id: int, capacity: int):
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, row = _encoder(path), TaskContext.get().partitionId() << 36
        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), as_bytes(batch.column(1))
            for a, b in spans(texts):
                made = []
                for doc_id, got in zip(ids[a:b], encoder.encode(texts[a:b]), strict=True):
                    raw = got + end
                    for piece, at in enumerate(range(0, len(raw), 4 * capacity)):
                        part = raw[at:at + 4 * capacity]
                        made.append((row, doc_id, piece, at // 4, len(part) // 4, zlib.crc32(part)))
                        row += 1
                columns = [pa.array(c, t) for c, t in zip(zip(*made, strict=True), (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()), strict=True)]
                yield pa.RecordBatch.from_arrays(columns, names=["row", "doc_id", "piece", "start", "length", "ids_crc32"])
    return run


class Packing:
    """Bins of pieces (by number) with the free places in each; best fit takes the fullest bin with room."""

    def __init__(self, lengths: list[int], capacity: int, bins: list[list[int]] | None = None):
        self.lengths, self.capacity, self.bins = lengths, capacity, bins or []
        self.free = [capacity - sum(map(lengths.__getitem__, b)) for b in self.bins]

    def place(self, pieces: list[int]) -> None:
        """Best fit of pieces in the given order. Bins wait by their free places; a bit set tells which counts occur."""
        lengths, bins, free = self.lengths, self.bins, self.free
        waiting: dict[int, list[int]] = {}
        occurs = 0
        for b, room in enumerate(free):
            if room:
                waiting.setdefault(room, []).append(b)
                occurs |= 1 << room
        for p in pieces:
            size = lengths[p]
            fits = occurs >> size
            if fits:
                room = size + (fits & -fits).bit_length() - 1
                stack = waiting[room]
                b = stack.pop()
                if not stack:
                    occurs ^= 1 << room
                bins[b].append(p)
                room -= size
            else:
                b, room = len(bins), self.capacity - size
                bins.append([p])
                free.append(room)
            free[b] = room
            if room:
                stack = waiting.setdefault(room, [])
                if not stack:
                    occurs |= 1 << room
                stack.append(b)

    def fitness(self) -> tuple[int, int]:
        return -len(self.bins), sum((self.capacity - f) ** 2 for f in self.free)

    def numbers(self) -> bytes:
        """Bin of each piece."""
        out = np.zeros(len(self.lengths), "<u4")
        for number, b in enumerate(self.bins):
            out[b] = number
        return out.tobytes()


def read_packing(lengths: list[int], capacity: int, numbers: bytes) -> Packing:
    of = np.frombuffer(numbers, "<u4")
    order = np.argsort(of, kind="stable")
    return Packing(lengths, capacity, [b.tolist() for b in np.split(order, np.flatnonzero(np.diff(of[order])) + 1)] if len(of) else [])


def cross(giver: Packing, taker: Packing, rng: random.Random) -> Packing:
    """The taker with some of the giver's best filled bins; displaced pieces return by best fit."""
    best = sorted(range(len(giver.bins)), key=giver.free.__getitem__)[:max(1, len(giver.bins) // 2)]
    injected = [giver.bins[b] for b in rng.sample(best, max(1, len(best) // 2))]
    taken = {p for b in injected for p in b}
    kept, displaced = [list(b) for b in injected], []
    for b in taker.bins:
        if taken.isdisjoint(b):
            kept.append(list(b))
        else:
            displaced += [p for p in b if p not in taken]
    return _returned(taker, kept, displaced)


def mutate(packing: Packing, rng: random.Random) -> Packing:
    """Some of the worst bins, and one other, emptied and filled anew."""
    order = sorted(range(len(packing.bins)), key=packing.free.__getitem__, reverse=True)
    gone = {*order[:rng.randint(1, 4)], rng.choice(order)}
    return _returned(packing, [list(b) for i, b in enumerate(packing.bins) if i not in gone], [p for i in gone for p in packing.bins[i]])


def _returned(model: Packing, kept: list[list[int]], displaced: list[int]) -> Packing:
    made = Packing(model.lengths, model.capacity, kept)
    made.place(sorted(displaced, key=lambda p: (-model.lengths[p], p)))
    return made


def evolve(lengths: list[int], capacity: int, population: list[Packing], size: int, children: int, rng: random.Random) -> list[Packing]:
    """An epoch: packings of ``size``, best first. All children are made: where no packing can have fewer bins, fills still differ."""
    if not population:
        order = sorted(range(len(lengths)), key=lambda p: (-lengths[p], p))
        for i in range(size):
            first = Packing(lengths, capacity)
            first.place(order if not i else sorted(order, key=lambda p: -lengths[p] * rng.uniform(0.8, 1.2)))
            population.append(first)
    population = sorted(population, key=Packing.fitness, reverse=True)[:size]
    for _ in range(children):
        a, b = rng.choice(population), rng.choice(population)
        child = mutate(a, rng) if a is b else cross(a, b, rng)
        if len(population) < size or child.fitness() > population[-1].fitness():
            population = sorted([*population, child], key=Packing.fitness, reverse=True)[:size]
    return population


_ISLAND_SQL = "block long, island int, lengths binary, packings array<binary>, bins int, fill long"


def _epoch(capacity: int, size: int, children: int, epoch: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                lengths = np.frombuffer(row["lengths"], "<u4").tolist()
                rng = random.Random(f"{row['block']}/{row['island']}/{epoch}")
                made = evolve(lengths, capacity, [read_packing(lengths, capacity, p) for p in row["packings"]], size, children, rng)
                bins, fill = made[0].fitness()
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row["block"]]), pa.array([row["island"]], pa.int32()), pa.array([row["lengths"]], pa.binary()), pa.array([[p.numbers() for p in made]], pa.list_(pa.binary())),
                     pa.array([bins], pa.int32()), pa.array([fill])], names=["block", "island", "lengths", "packings", "bins", "fill"])
    return run


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces of each block as packed arrays."""
    for batch in batches:
        for row in batch.to_pylist():
            pieces = sorted((p["row"], p["length"]) for p in row["pieces"])
            yield pa.RecordBatch.from_pydict({"block": [row["block"]], "rows": [np.array([p[0] for p in pieces], "<i8").tobytes()],
                                              "lengths": [np.array([p[1] for p in pieces], "<u4").tobytes()]})


def _placed(capacity: int, well_filled: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                lengths, of = np.frombuffer(row["lengths"], "<u4").astype(np.int64), np.frombuffer(row["best"], "<u4")
                order = np.argsort(of, kind="stable")
                fill = np.bincount(of, lengths).astype(np.int64)
                ends = np.cumsum(lengths[order])
                offsets = ends - lengths[order] - (np.cumsum(fill) - fill)[of[order]]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.frombuffer(row["rows"], "<i8")[order]), pa.array(lengths[order]), pa.array(np.full(len(of), row["block"])), pa.array(of[order].astype(np.int64)), pa.array(offsets),
                     pa.array(fill[of[order]] >= well_filled * capacity)], names=["row", "length", "block", "bin", "offset", "done"])
    return run


def pack_blocks(pieces: DataFrame, n_blocks: int, capacity: int, salt: int, islands: int = ISLANDS, population: int = POPULATION, epochs: int = EPOCHS,
                children: int = CHILDREN, well_filled: float = WELL_FILLED) -> DataFrame:
    """One round over pieces (row, length): row, length, block, bin, offset, and whether the bin is well filled."""
    dealt = pieces.groupBy(F.pmod(F.xxhash64("row", F.lit(salt)), F.lit(n_blocks)).alias("block")).agg(F.collect_list(F.struct("row", F.col("length").cast("int").alias("length"))).alias("pieces"))
    blocks = stage(dealt.mapInArrow(_blocks, "block long, rows binary, lengths binary"), "pack-blocks")
    isles = blocks.select("block", F.explode(F.sequence(F.lit(0), F.lit(islands - 1))).alias("island"), "lengths", F.array().cast("array<binary>").alias("packings"))
    isles = isles.repartition("block", "island")
    for epoch in range(epochs):
        isles = stage(isles.mapInArrow(_epoch(capacity, population, children, epoch), _ISLAND_SQL), "pack-islands")
        if epoch + 1 < epochs:
            elite = isles.select("block", ((F.col("island") + 1) % islands).alias("island"), F.col("packings")[0].alias("elite"))
            isles = isles.join(elite, ["block", "island"]).select("block", "island", "lengths", F.concat("packings", F.array("elite")).alias("packings"))
    best = isles.groupBy("block").agg(F.max_by(F.col("packings")[0], F.struct("bins", "fill", "island")).alias("best"))
    return blocks.join(best, "block").mapInArrow(_placed(capacity, well_filled), "row long, length long, block long, bin long, offset long, done boolean")


def pack_documents(docs: DataFrame, tokenizer_path: str, end_id: int, capacity: int = CAPACITY, block_pieces: int = BLOCK_PIECES, id_col: str = "doc_id", text_col: str = "text",
                   well_filled: float = WELL_FILLED) -> DataFrame:
    """Pieces of all documents and their places: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    Null text counts as empty (the end id alone); rows of one id, null ids among them, are documents of their own. Texts of any length are encoded
    whole and cut at ``capacity`` ids. An empty table gives no rows; other columns are not read.
    """
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))
    pieces = stage(rows.mapInArrow(_pieces(tokenizer_path, end_id, capacity), "row long, doc_id long, piece int, start long, length long, ids_crc32 long"), "pieces")
    whole = pieces.where(F.col("length") == capacity).select("row", (-1 - F.col("row")).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    pool, placed, turn = pieces.where(F.col("length") < capacity).select("row", "length"), whole, 0
    left = pool.count()
    while left:
        n_blocks = -(-left // block_pieces)
        made = stage(pack_blocks(pool, n_blocks, capacity, turn, well_filled=well_filled), "packed")
        again = made.where("NOT done").count() if n_blocks > 1 else 0
        if again * 2 > left:  # most bins cannot be filled, so another round would not either
            again = 0
        done = made.where("done") if again else made
        # Numbers of a round, block and bin: bins of a block are fewer than its pieces.
        placed = placed.unionByName(done.select("row", (F.lit(turn << 56) + F.shiftleft("block", 24) + F.col("bin")).alias("sequence_id"), "offset"))
        pool, left, turn = made.where("NOT done").select("row", "length"), again, turn + 1
    return pieces.join(placed, "row").select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


__all__ = ["Packing", "WordEncoder", "cross", "evolve", "mutate", "pack_blocks", "pack_documents", "read_packing"]
