"""N-gram Jaccard join by T-occurrence search.

Two texts link when their sets of five-word shingles have a Jaccard similarity of at least a threshold. Texts with equal
sets are one class. Shingles have one order for all classes: rare ones first, then those that an occurrence sketch of all
texts calls frequent. A class of n shingles that links to another shares at least T of its shingles with it, so at least one
of its first n - T + 1; only these go into inverted lists, dealt over shards by shingle. Then

1. short lists give all their pairs, long ones pairs with one member per size class only; pairs that sizes, places in the order or parity
   sketches of the sets rule out are dropped, none else;
2. a DivideSkip search decides the pairs of one class together: the lists of its rare shingles are merged by a heap, those of
   its frequent ones are probed by binary search, and classes that reach the required overlap stay;
3. the closest pair of each class is decided first, and links make components. Of the other pairs only those whose ends lie in
   different components are decided next, and last those of the members of long lists that are still apart. Pairs inside a
   component need no look: they cannot change it.

``ngram_links`` and ``link_counts`` decide the pairs inside components too and lose no link.

Long lists are cut into blocks of members of one size class, and pairs of blocks are what tasks are dealt. Between components,
a large component has blocks of its own, which do not meet each other.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.functions import pandas_udf

from liftplan.llm.components import components
from liftplan.llm.shared import bit_of, filled_bits, free_names, give_back, stage
from liftplan.llm.words import Words, as_bytes, mix, shingle_sets, spans

SHINGLE = 5
#: Similarity as a fraction, 0.75.
NUM, DEN = 75, 100
#: Lists of up to so many classes give all their pairs.
SHORT_LIST = 32
#: Members of a long list that meet those of another block in one piece of work.
BLOCK = 256
#: Earlier long lists that a member brings along, so that a pair is given by few of the lists that both are in.
EARLIER = 16
#: Smallest parity sketch, as 64-bit words; a class gets at least a bit per shingle.
SKETCH_WORDS = 4
#: Bytes of text for one shard of the inverted lists.
SHARD_BYTES = 12 << 20


def least_overlap(n: np.ndarray | int, m: np.ndarray | int, num: int = NUM, den: int = DEN):
    """Smallest overlap of linked sets of ``n`` and ``m`` shingles: den * o >= num * (n + m - o)."""
    return -(-num * (n + m) // (num + den))


def prefix_length(n: int, num: int = NUM, den: int = DEN) -> int:
    """Shingles of which a set of ``n`` shares at least one with every set that it links to."""
    return n - (-(-num * n // den)) + 1


def _size_bounds() -> np.ndarray:
    out = [1]
    while out[-1] < 1 << 31:
        out.append(out[-1] * DEN // NUM + 1)
    return np.array(out, np.int64)


_SIZES = _size_bounds()


def size_class(n: np.ndarray) -> np.ndarray:
    """Class of a set's size: linked sets are in the same class or in neighbouring ones."""
    return np.searchsorted(_SIZES, n, side="right") - 1


def class_of(tokens: np.ndarray) -> int:
    """64-bit name of a set of shingles."""
    if not len(tokens):
        return 0
    name = (int(mix(tokens).sum(dtype=np.uint64)) * 0x9E3779B97F4A7C15 + len(tokens)) % (1 << 64)
    return name - (1 << 64) if name >> 63 else name


def parity_sketch(tokens: np.ndarray) -> np.ndarray:
    """Parity of the number of shingles per bit: sketches of two sets differ in no more bits than the sets in shingles.

    The number of bits is a power of two. Half of a sketch laid over its other half is the sketch of half as many bits, so sets
    of different sizes can be compared.
    """
    words = max(SKETCH_WORDS, 1 << (-(-len(tokens) // 64) - 1).bit_length())
    bits = np.bincount((mix(tokens) % np.uint64(64 * words)).astype(np.int64), minlength=64 * words) & 1
    return np.packbits(bits.astype(np.uint8)).view(np.int64)


def sketches_differ(sketch: np.ndarray, others: list[np.ndarray]) -> np.ndarray:
    """Bits in which each of the others differs, all laid over to the shortest length of the two."""
    out = np.zeros(len(others), np.int64)
    by_length: dict[int, list[int]] = {}
    for i, other in enumerate(others):
        by_length.setdefault(len(other), []).append(i)
    for length, at in by_length.items():
        mine, theirs = sketch, np.stack([others[i] for i in at])
        while len(mine) > length:
            mine = mine[:len(mine) // 2] ^ mine[len(mine) // 2:]
        while theirs.shape[1] > len(mine):
            theirs = theirs[:, :theirs.shape[1] // 2] ^ theirs[:, theirs.shape[1] // 2:]
        # Of a signed number NumPy counts the bits of its absolute value.
        out[at] = np.bitwise_count((theirs ^ mine).view(np.uint64)).sum(axis=1)
    return out


def _sets(batches: Iterator[pa.RecordBatch], shingle: int) -> Iterator[tuple[list, list[np.ndarray]]]:
    for batch in batches:
        ids, texts = batch.column(0).to_pylist(), as_bytes(batch.column(1))
        for a, b in spans(texts):
            yield ids[a:b], shingle_sets(Words(texts[a:b], lower=True), shingle)
    give_back()


_MEMBER_SQL = "doc_id long, class long, n int, sketch array<long>, cells int, counts binary"
_SEGMENT = 1 << 14


def _describe(shingle: int, sketch_bits: int):
    """Rows per text (doc_id, class, n, sketch) and, at the end of a task, its occurrence sketch in segments."""
    def run(batches):
        counts = np.zeros(1 << sketch_bits, np.int64)
        schema = pa.schema([("doc_id", pa.int64()), ("class", pa.int64()), ("n", pa.int32()), ("sketch", pa.list_(pa.int64())), ("cells", pa.int32()), ("counts", pa.binary())])
        for ids, sets in _sets(batches, shingle):
            shift = np.uint64(64 - sketch_bits)
            if sets:
                counts += np.bincount((np.concatenate(sets) >> shift).astype(np.int64), minlength=1 << sketch_bits)
            names = [class_of(s) if len(s) else None for s in sets]
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(names, pa.int64()), pa.array([len(s) for s in sets], pa.int32()),
                 pa.array([parity_sketch(s) if len(s) else None for s in sets], pa.list_(pa.int64())), pa.nulls(len(ids), pa.int32()), pa.nulls(len(ids), pa.binary())], schema=schema)
        press = zstandard.ZstdCompressor(level=1)
        step = min(_SEGMENT, len(counts))
        used = [i for i in range(0, len(counts), step) if counts[i:i + step].any()]
        if used:
            n = len(used)
            yield pa.RecordBatch.from_arrays(
                [pa.nulls(n, pa.int64()), pa.nulls(n, pa.int64()), pa.nulls(n, pa.int32()), pa.nulls(n, pa.list_(pa.int64())),
                 pa.array([i // step for i in used], pa.int32()), pa.array([press.compress(counts[i:i + step].astype("<u4").tobytes()) for i in used], pa.binary())], schema=schema)
    return run


def _add_counts(batches):
    """Sum the segments of each number; a task gets all segments of its numbers."""
    total: dict[int, np.ndarray] = {}
    press = zstandard.ZstdDecompressor()
    for batch in batches:
        for number, blob in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            got = np.frombuffer(press.decompress(blob), "<u4").astype(np.int64)
            total[number] = total[number] + got if number in total else got
    yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), pa.array([v.astype("<i8").tobytes() for v in total.values()], pa.binary())], names=["cells", "counts"])


def frequent_cells(counts: DataFrame, sketch_bits: int) -> np.ndarray:
    """One bit per cell of the occurrence sketch: frequent or not. Its size is fixed by ``sketch_bits``, whatever the input."""
    # The driver takes the sums of one task at a time, 2 ** sketch_bits cells in all.
    cells = np.zeros(1 << sketch_bits, np.int64)
    step = min(_SEGMENT, len(cells))
    for row in counts.repartition(16, "cells").mapInArrow(_add_counts, "cells int, counts binary").toLocalIterator():
        cells[row["cells"] * step:(row["cells"] + 1) * step] = np.frombuffer(row["counts"], "<i8")
    return np.packbits(cells > 4 * cells.mean() + 64)


def _ordered(tokens: np.ndarray, frequent: np.ndarray, shift: np.uint64) -> tuple[np.ndarray, int]:
    """Shingles in the common order, and how many are rare."""
    cell = (tokens >> shift).astype(np.int64)
    often = (frequent[cell >> 3] >> (7 - (cell & 7)).astype(np.uint8)) & 1 == 1
    rare = tokens[~often]
    return np.concatenate([rare, tokens[often]]), len(rare)


def _post(shingle: int, frequent, sketch_bits: int, shards: int):
    """Rows (shard, blob): the postings of one block of texts for one shard."""
    def run(batches):
        cells, shift = frequent.value, np.uint64(64 - sketch_bits)
        press = zstandard.ZstdCompressor(level=1)
        for _, sets in _sets(batches, shingle):
            known, n_of, tokens, owner, place = {}, [], [], [], []
            for s in sets:
                if not len(s) or (name := class_of(s)) in known:
                    continue
                known[name] = i = len(known)
                p = prefix_length(len(s))
                tokens.append(_ordered(s, cells, shift)[0][:p])
                owner.append(np.full(p, i, np.uint32))
                place.append(np.arange(p, dtype=np.uint32))
                n_of.append(len(s))
            if not known:
                continue
            names, n_of = np.fromiter(known, np.int64), np.array(n_of, np.uint32)
            tokens, owner, place = mix(np.concatenate(tokens)), np.concatenate(owner), np.concatenate(place)
            shard = (tokens % np.uint64(shards)).astype(np.int64)
            # What is left of a shingle inside its shard: two that meet here only make a pair that is then turned down.
            short = (tokens >> np.uint64(32)).astype(np.uint32)
            order = np.lexsort((short, shard))
            ends = np.searchsorted(shard[order], np.arange(shards + 1))
            out_shard, out = [], []
            for i in range(shards):
                o = order[ends[i]:ends[i + 1]]
                if len(o):
                    used, at = np.unique(owner[o], return_inverse=True)
                    parts = [short[o], at.astype(np.uint32), place[o], names[used], n_of[used]]
                    head = np.array([len(o), len(used)], np.uint32).tobytes()
                    out_shard.append(i)
                    out.append(head + press.compress(b"".join(x.tobytes() for x in parts)))
            yield pa.RecordBatch.from_arrays([pa.array(out_shard, pa.int32()), pa.array(out, pa.binary())], names=["shard", "blob"])
    return run


def _unpack(blob: bytes, press) -> tuple[np.ndarray, ...]:
    n, m = np.frombuffer(blob[:8], np.uint32).tolist()
    raw = press.decompress(blob[8:])
    u4 = lambda a, k: np.frombuffer(raw, np.uint32, k, a)
    at = u4(4 * n, n)
    names, n_of = np.frombuffer(raw, np.int64, m, 12 * n), u4(12 * n + 8 * m, m)
    return u4(0, n), names[at], u4(8 * n, n).astype(np.int64), n_of[at].astype(np.int64)


def may_link(n_a, place_a, n_b, place_b, num: int = NUM, den: int = DEN):
    """Sizes and places leave room for the required overlap (places: of a shared shingle in both orders, the first shared one)."""
    small, large = np.minimum(n_a, n_b), np.maximum(n_a, n_b)
    rest = np.minimum(n_a - place_a, n_b - place_b)
    return (den * small >= num * large) & (rest >= least_overlap(n_a, n_b, num, den))


_LISTS_SQL = "kind byte, list long, x long, y long, n int, place int, size int, block int, own int, below int, above int"


def _lists(short_list: int, block: int = BLOCK):
    """Of the shards' postings: rows (kind 0) of pairs, and rows (kind 1) of members of long lists.

    A member has its size class and block, and how many blocks its own size class and those below and above it have in the list.
    """
    more = ["n", "place", "size", "block", "own", "below", "above"]
    schema = pa.schema([("kind", pa.int8()), ("list", pa.int64()), ("x", pa.int64()), ("y", pa.int64()), *((c, pa.int32()) for c in more)])

    def work(shard: int, blobs: list[bytes]):
        press = zstandard.ZstdDecompressor()
        token, name, place, n = (np.concatenate(c) for c in zip(*(_unpack(b, press) for b in blobs), strict=True))
        # Lists by shingle; inside a list by size class and then a fixed random order of classes, each class once.
        size = size_class(n)
        order = np.lexsort((place, name, mix(name.view(np.uint64)), size, token))
        token, name, place, n, size = token[order], name[order], place[order], n[order], size[order]
        fresh = np.r_[True, (token[1:] != token[:-1]) | (name[1:] != name[:-1])]
        token, name, place, n, size = token[fresh], name[fresh], place[fresh], n[fresh], size[fresh]
        new_list = np.r_[True, token[1:] != token[:-1]]
        begin = np.flatnonzero(new_list)
        length = np.diff(np.r_[begin, len(token)])
        at_begin, at_length = np.repeat(begin, length), np.repeat(length, length)
        here = np.arange(len(token))
        xs, ys = [], []

        def pair(i, j):
            ok = may_link(n[i], place[i], n[j], place[j])
            a, b = name[i[ok]], name[j[ok]]
            xs.append(np.minimum(a, b))
            ys.append(np.maximum(a, b))

        short = at_length <= short_list
        for step in range(1, short_list):
            i = here[short & (here + step < at_begin + at_length)]
            if not len(i):
                break
            pair(i, i + step)
        # In a long list each member meets the first one of its size class, and that one the first of the class before. The
        # order is the same in all lists, so many lists of one group of copies give the same few pairs.
        heads = np.flatnonzero(new_list | np.r_[True, size[1:] != size[:-1]])
        run_length = np.diff(np.r_[heads, len(token)])
        head = np.repeat(heads, run_length)
        i = here[~short & (here > head)]
        pair(head[i], i)
        i = heads[~short[heads] & ~new_list[heads]]
        pair(head[i - 1], i)
        if xs:
            both = np.unique(np.stack([np.concatenate(xs), np.concatenate(ys)]), axis=1)
            both = both[:, both[0] != both[1]]
            k = both.shape[1]
            if k:
                yield pa.RecordBatch.from_arrays([pa.array(np.zeros(k, np.int8)), pa.nulls(k, pa.int64()), pa.array(both[0]), pa.array(both[1]), *(pa.nulls(k, pa.int32()) for _ in more)], schema=schema)
        i = here[~short]
        if len(i):
            number = (np.int64(shard) << 32) | token[i].astype(np.int64)
            blocks = -(-run_length // block)
            next_to = (token[heads[1:]] == token[heads[:-1]]) & (size[heads[1:]] == size[heads[:-1]] + 1)
            below, above = np.zeros_like(blocks), np.zeros_like(blocks)
            below[1:][next_to], above[:-1][next_to] = blocks[:-1][next_to], blocks[1:][next_to]
            own, below, above = (np.repeat(c, run_length)[i] for c in (blocks, below, above))
            columns = [n[i], place[i], size[i], (i - head[i]) // block, own, below, above]
            yield pa.RecordBatch.from_arrays([pa.array(np.ones(len(i), np.int8)), pa.array(number), pa.array(name[i]), pa.nulls(len(i), pa.int64()), *(pa.array(c.astype(np.int32)) for c in columns)], schema=schema)

    def run(batches):
        current, held = None, []
        for batch in batches:
            for shard, blob in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if shard != current and held:
                    yield from work(current, held)
                    held = []
                current = shard
                held.append(blob)
        if held:
            yield from work(current, held)
        held = []
        give_back()
    return run


_MEET = ["list", "low", "a", "step", "b"]


def block_pairs(members: DataFrame) -> DataFrame:
    """Members of long lists, once for each pair of blocks that they are in (``_MEET``), with their side of it.

    Blocks of one size class meet each other and themselves, and those of the class above. Two members of a list whose sizes
    may link meet in one pair of blocks.
    """
    def each(count: str, low, a, step, b, side):
        at = lambda k: F.struct(low(k).alias("low"), a(k).alias("a"), F.lit(step).alias("step"), b(k).alias("b"), side(k).alias("side"))
        return F.transform(F.when(F.col(count) > 0, F.sequence(F.lit(0), F.col(count) - 1)).otherwise(F.array().cast("array<int>")), at)

    size, block = F.col("size"), F.col("block")
    same = each("own", lambda k: size, lambda k: F.least(block, k), 0, lambda k: F.greatest(block, k), lambda k: (block > k).cast("int"))
    up = each("above", lambda k: size, lambda k: block, 1, lambda k: k, lambda k: F.lit(0))
    down = each("below", lambda k: size - 1, lambda k: k, 1, lambda k: block, lambda k: F.lit(1))
    rest = [c for c in members.columns if c not in ("list", "size", "block", "own", "below", "above")]
    return members.select("list", F.explode(F.concat(same, up, down)).alias("at"), *rest).select("list", "at.*", *rest)


def block_pairs_apart(members: DataFrame, sketches: DataFrame, block: int = BLOCK) -> DataFrame:
    """As ``block_pairs``, for pairs of different groups only, with blocks made by group.

    A group with at least a block of members in a size class of a list has blocks of its own there, which need not meet each
    other; the members of smaller groups share blocks. So a large group costs a row per member and block of other groups, not
    one per block of its own.
    """
    here = ["list", "size"]
    groups = stage(members.groupBy(*here, "group").agg(F.count("*").alias("many")).withColumn("blocks", F.ceil(F.col("many") / block)), "join-list-groups")
    large = F.col("many") >= block
    shared = groups.groupBy(*here).agg(F.ceil(F.coalesce(F.sum(F.when(~large, F.col("many"))), F.lit(0)) / block).alias("shared"),
                                       F.coalesce(F.sum(F.when(large, F.col("blocks"))), F.lit(0)).alias("rest"))
    shared = stage(shared.select(*here, "shared", (F.col("shared") + F.col("rest")).alias("blocks")), "join-list-shared")
    # A list has at most one large group per block of members.
    upto = F.sum("blocks").over(Window.partitionBy(*here).orderBy("group").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    own = stage(groups.where(large).withColumn("upto", upto).join(shared.select(*here, "shared"), here).select(
        *here, "group", (F.col("shared") + F.col("upto") - F.col("blocks")).alias("first"), (F.col("shared") + F.col("upto")).alias("end")), "join-list-own")
    plan = groups.select(*here, "group")
    for name, step in (("own", 0), ("below", -1), ("above", 1)):
        near = lambda df: df.withColumn("size", F.col("size") - step)  # noqa: E731, B023
        plan = plan.join(near(shared.select(*here, F.col("blocks").alias(name), F.col("shared").alias(f"{name}_shared"))), here, "left")
        plan = plan.join(near(own.select(*here, "group", F.col("first").alias(f"{name}_first"), F.col("end").alias(f"{name}_end"))), [*here, "group"], "left")
    plan = stage(plan, "join-list-blocks")
    mine = F.pmod(F.xxhash64("x"), F.when(F.col("own_first").isNull(), F.col("own_shared")).otherwise(F.col("own_end") - F.col("own_first")))
    placed = members.join(plan, [*here, "group"]).join(sketches, "x").withColumn("at_block", (F.coalesce("own_first", F.lit(0)) + mine).cast("int"))
    size, block_no = F.col("size"), F.col("at_block")

    def each(name: str, low, a, step, b, side):
        every = F.when(F.col(name) > 0, F.sequence(F.lit(0), F.col(name).cast("int") - 1)).otherwise(F.array().cast("array<int>"))
        other = F.filter(every, lambda k: F.col(f"{name}_first").isNull() | (k < F.col(f"{name}_first")) | (k >= F.col(f"{name}_end")))
        return F.transform(other, lambda k: F.struct(low.alias("low"), a(k).alias("a"), F.lit(step).alias("step"), b(k).alias("b"), side(k).alias("side")))

    same = each("own", size, lambda k: F.least(block_no, k), 0, lambda k: F.greatest(block_no, k), lambda k: (block_no > k).cast("int"))
    up = each("above", size, lambda k: block_no, 1, lambda k: k, lambda k: F.lit(0))
    down = each("below", size - 1, lambda k: k, 1, lambda k: block_no, lambda k: F.lit(1))
    rest = [c for c in [*members.columns, *sketches.columns[1:]] if c not in ("list", "size")]
    return placed.select("list", F.explode(F.concat(same, up, down)).alias("at"), *rest).select("list", "at.*", *rest)


def _meet(inside: bool):
    """Pairs of members of two blocks (or of one) in the same component or in different ones that sizes, places and sketches leave open.

    A pair that an earlier list of both also has is left to that list.
    """
    def work(key, rows):
        side, name, group, n, place = (np.array(c, np.int64) for c in zip(*(r[:5] for r in rows), strict=True))
        sketch, earlier = [np.array(r[5], np.int64) for r in rows], [set(r[6]) for r in rows]
        alone = key[3] == 0 and key[2] == key[4]
        second = np.flatnonzero(side == 1)
        found = []
        for i in np.flatnonzero(side == 0).tolist():
            j = np.arange(i + 1, len(rows)) if alone else second
            j = j[(group[j] == group[i]) == inside]
            j = j[may_link(n[i], place[i], n[j], place[j])]
            if len(j):
                differ = sketches_differ(sketch[i], [sketch[x] for x in j.tolist()])
                j = j[differ <= n[i] + n[j] - 2 * least_overlap(n[i], n[j])]
                found.extend((min(a, b), max(a, b)) for a in [int(name[i])] for x, b in zip(j.tolist(), name[j].tolist(), strict=True) if earlier[i].isdisjoint(earlier[x]))
        if found:
            x, y = zip(*found, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()), pa.array(y, pa.int64())], names=["x", "y"])

    def run(batches):
        current, held = None, []
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if row[:5] != current and held:
                    yield from work(current, held)
                    held = []
                current = row[:5]
                held.append(row[5:])
        if held:
            yield from work(current, held)
        held = []
        give_back()
    return run


def _met(paired: DataFrame, inside: bool) -> DataFrame:
    """Pairs (x, y) of members dealt by pairs of blocks in the same group (``inside``) or in different ones that may link."""
    dealt = paired.select(*_MEET, "side", "x", "group", "n", "place", "sketch", "earlier")
    return dealt.repartition(*_MEET).sortWithinPartitions(*_MEET).mapInArrow(_meet(inside), "x long, y long").distinct()


def divide_skip(query: np.ndarray, n_rare: int, others: list[np.ndarray], num: int = NUM, den: int = DEN) -> list[int]:
    """Which of ``others`` (sets in rising order) reach the required overlap with ``query`` (in the common order).

    The query's last T - 1 shingles at most, T the smallest overlap that any of the others needs, are the long lists. A heap merges
    the lists of the rest, each with the others that hold the shingle; one met often enough there is probed in the long lists by
    binary search.
    """
    n = len(query)
    need = [int(least_overlap(n, len(o), num, den)) for o in others]
    if not need:
        return []
    # Frequent shingles are long lists, and so are rare ones up to the bound.
    n_short = max(n - (min(need) - 1), min(n_rare, n - min(need) // 2), 1)
    n_short = min(n_short, n)
    head, tail = query[:n_short], np.sort(query[n_short:])
    lists: dict[int, list[int]] = {}
    for i, other in enumerate(others):
        at = np.searchsorted(other, head)
        hit = np.flatnonzero((at < len(other)) & (other[np.minimum(at, len(other) - 1)] == head))
        for t in hit.tolist():
            lists.setdefault(t, []).append(i)
    met, count, out = None, 0, []

    def judge(i: int, count: int) -> None:
        if count + len(tail) < need[i]:
            return
        at = np.searchsorted(others[i], tail)
        count += int((others[i][np.minimum(at, len(others[i]) - 1)] == tail).sum())
        if count >= need[i]:
            out.append(i)

    for i in heapq.merge(*lists.values()):
        if i != met:
            if met is not None:
                judge(met, count)
            met, count = i, 0
        count += 1
    if met is not None:
        judge(met, count)
    return out


def _sets_of(shingle: int, wanted):
    """Rows (class, tokens) of the texts whose bit is set; one text stands for each class."""
    def run(batches):
        filled = wanted.value
        for ids, sets in _sets(batches, shingle):
            names, blobs = [], []
            for doc_id, s in zip(ids, sets, strict=True):
                if len(s) and bit_of(filled, (name := class_of(s)) ^ (doc_id or 0)):
                    names.append(name)
                    blobs.append(s.tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.int64()), pa.array(blobs, pa.binary())], names=["class", "tokens"])
    return run


def _search(frequent, sketch_bits: int):
    """Links (x, y) of rows (x, y, tokens) sorted by x; the row without y brings the set of x itself and comes first."""
    def run(batches):
        cells, shift = frequent.value, np.uint64(64 - sketch_bits)
        x = query = None
        ys, others = [], []

        def answer():
            hits = divide_skip(query[0], query[1], others) if others else []
            return pa.RecordBatch.from_arrays([pa.array([x] * len(hits), pa.int64()), pa.array([ys[i] for i in hits], pa.int64())], names=["a", "b"])

        for batch in batches:
            for name, y, tokens in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if y is None:
                    if others:
                        yield answer()
                        ys, others = [], []
                    x, query = name, _ordered(np.frombuffer(tokens, np.uint64), cells, shift)
                    continue
                if name != x:
                    raise ValueError(f"class {name} has candidates but no set")
                ys.append(y)
                others.append(np.frombuffer(tokens, np.uint64))
                if len(others) == 256:
                    yield answer()
                    ys, others = [], []
        if others:
            yield answer()
        x = query = None
        ys, others = [], []
        give_back()
    return run


_PAIR_KEY = ["group", "at_x", "at_y"]


def _decide(frequent, sketch_bits: int):
    """Links (a, b) of rows (group, at_x, at_y, x, y, tokens) sorted by these: sets (y null) before the pairs of their key."""
    def run(batches):
        cells, shift = frequent.value, np.uint64(64 - sketch_bits)
        key, sets, x, ys = None, {}, None, []

        def answer():
            query, n_rare = _ordered(sets[x], cells, shift)
            hits = divide_skip(query, n_rare, [sets[y] for y in ys])
            return pa.RecordBatch.from_arrays([pa.array([x] * len(hits), pa.int64()), pa.array([ys[i] for i in hits], pa.int64())], names=["a", "b"])

        for batch in batches:
            for *here, name, y, tokens in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if ys and (here != key or name != x or len(ys) == 256):
                    yield answer()
                    ys = []
                if here != key:
                    key, sets = here, {}
                if y is None:
                    sets[name] = np.frombuffer(tokens, np.uint64)
                else:
                    x = name
                    ys.append(y)
        if ys:
            yield answer()
    return run


class _Join:
    """What the steps of one join share."""

    def __init__(self, docs: DataFrame, id_col: str, text_col: str, shingle: int, sketch_bits: int | None, short_list: int, block: int = BLOCK):
        self.spark, self.shingle, self.short_list, self.block = docs.sparkSession, shingle, short_list, block
        self.rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
        size = self.rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
        # About a cell per shingle (a shingle is some six bytes of text), up to four million cells unless the caller wants more.
        self.bits = sketch_bits or min(22, max(16, (size // 6).bit_length()))
        self.shards = max(8, size // SHARD_BYTES)
        described = stage(self.rows.mapInArrow(_describe(shingle, self.bits), _MEMBER_SQL), "join-members")
        self.members = described.where("cells is null").select("doc_id", "class", "n", "sketch")
        self.classes = stage(self.members.where("class is not null").groupBy("class").agg(
            F.first("n").alias("n"), F.first("sketch").alias("sketch"), F.min("doc_id").alias("least_doc"), F.count("*").alias("copies")), "join-classes")
        self.frequent = self.spark.sparkContext.broadcast(frequent_cells(described.where("cells is not null").select("cells", "counts"), self.bits))

    def candidates(self) -> tuple[DataFrame, DataFrame]:
        """Pairs (x, y, differ) that short lists and the first members of size classes give, and the members of long lists."""
        posted = self.rows.select("doc_id", "text").mapInArrow(_post(self.shingle, self.frequent, self.bits, self.shards), "shard int, blob binary")
        by_shard = posted.repartition("shard").sortWithinPartitions("shard")
        lists = stage(by_shard.mapInArrow(_lists(self.short_list, self.block), _LISTS_SQL), "join-lists")
        return stage(self.open_pairs(lists.where("kind = 0").select("x", "y")), "join-pairs"), lists.where("kind = 1").drop("kind", "y")

    def open_pairs(self, pairs: DataFrame) -> DataFrame:
        """Pairs (x, y, differ) whose sketches leave room for the required overlap."""
        of = lambda side: self.classes.select(F.col("class").alias(side), F.col("n").alias(f"n_{side}"), F.col("sketch").alias(f"sketch_{side}"))
        both = pairs.distinct().join(of("x"), "x").join(of("y"), "y")
        x, y = F.col("sketch_x"), F.col("sketch_y")

        def over(longer, other):
            # Sizes of a pair differ by a third at most, so one sketch has at most twice the bits of the other.
            half = (F.size(longer) / 2).cast("int")
            laid = F.zip_with(F.slice(longer, F.lit(1), half), F.slice(longer, half + 1, half), lambda a, b: a.bitwiseXOR(b))
            return F.when(F.size(longer) > F.size(other), laid).otherwise(longer)

        differ = F.aggregate(F.zip_with(over(x, y), over(y, x), lambda a, b: F.bit_count(a.bitwiseXOR(b))), F.lit(0), lambda s, v: s + v)
        least = F.ceil(F.lit(NUM) * (F.col("n_x") + F.col("n_y")) / F.lit(NUM + DEN))
        return both.withColumn("differ", differ).where(F.col("differ") <= F.col("n_x") + F.col("n_y") - 2 * least).select("x", "y", "differ")

    def sets(self, pairs: DataFrame) -> DataFrame:
        """Rows (class, tokens) of the ends of pairs (x, y)."""
        ends = pairs.select(F.col("x").alias("class")).union(pairs.select("y")).distinct()
        key = F.col("class").bitwiseXOR(F.coalesce("least_doc", F.lit(0).cast("long")))
        # The bitmap thins the texts out; what it lets through too much meets no pair or brings a set twice.
        wanted = self.spark.sparkContext.broadcast(filled_bits(ends.join(self.classes, "class").select(key.alias("key"))))
        return self.rows.mapInArrow(_sets_of(self.shingle, wanted), "class long, tokens binary")

    def links(self, pairs: DataFrame) -> DataFrame:
        """Linked pairs (a, b) among distinct pairs (x, y) of classes."""
        found = self.sets(pairs)
        own = pairs.select(F.col("x").alias("class"), "x", F.lit(None).cast("long").alias("y")).distinct()
        asked = own.union(pairs.select(F.col("y").alias("class"), "x", "y"))
        by_query = found.join(asked, "class").select("x", "y", "tokens").repartition("x").sortWithinPartitions("x", F.col("y").asc_nulls_first())
        return stage(by_query.mapInArrow(_search(self.frequent, self.bits), "a long, b long"), "join-links")

    def links_inside(self, pairs: DataFrame, named: DataFrame) -> DataFrame:
        """Linked pairs (a, b) among distinct pairs (x, y) of classes of one component, by pairs of blocks of the component.

        A set goes to each pair of blocks once, not to each pair of classes.
        """
        blocks = named.groupBy("group").agg(F.count("*").alias("many")).where("many > 1").select("group", F.ceil(F.col("many") / self.block).alias("blocks"))
        placed = named.join(blocks, "group").select("class", "group", F.pmod(F.xxhash64("class"), F.col("blocks")).alias("at"))
        x = placed.select(F.col("class").alias("x"), "group", F.col("at").alias("at_x"))
        y = placed.select(F.col("class").alias("y"), F.col("group").alias("group_y"), F.col("at").alias("at_y"))
        keyed = stage(pairs.join(x, "x").join(y, "y").where(F.col("group") == F.col("group_y")).select(*_PAIR_KEY, "x", "y"), "join-inside")
        asked = keyed.select(*_PAIR_KEY, F.col("x").alias("class")).union(keyed.select(*_PAIR_KEY, "y")).distinct()
        brought = asked.join(self.sets(keyed.select("x", "y")), "class").select(*_PAIR_KEY, F.col("class").alias("x"), F.lit(None).cast("long").alias("y"), "tokens")
        both = brought.union(keyed.select(*_PAIR_KEY, "x", "y", F.lit(None).cast("binary")))
        by_key = both.repartition(*_PAIR_KEY).sortWithinPartitions(*_PAIR_KEY, F.col("y").isNotNull(), "x", "y")
        return stage(by_key.mapInArrow(_decide(self.frequent, self.bits), "a long, b long"), "join-links")


def _closest(pairs: DataFrame) -> DataFrame:
    """Of each class the pair with the least difference."""
    both = pairs.select(F.col("x").alias("node"), F.struct("differ", F.col("y").alias("other")).alias("to")).union(
        pairs.select("y", F.struct("differ", F.col("x").alias("other"))))
    best = both.groupBy("node").agg(F.min("to").alias("to")).select("node", "to.other")
    return best.select(F.least("node", "other").alias("x"), F.greatest("node", "other").alias("y")).distinct()


def _groups(join: _Join, pairs: DataFrame, members: DataFrame) -> DataFrame:
    """class, group and component_id of every class."""
    closest = stage(_closest(pairs), "join-closest")
    grouped = stage(components(join.links(closest)), "join-components")
    of = lambda side: grouped.select(F.col("node").alias(side), F.col("component").alias(f"group_{side}"))
    apart = F.coalesce("group_x", "x") != F.coalesce("group_y", "y")
    rest = pairs.join(of("x"), "x", "left").join(of("y"), "y", "left").where(apart).select("x", "y").join(closest, ["x", "y"], "left_anti")
    second = join.links(stage(rest, "join-rest"))
    grouped = stage(components(grouped.toDF("a", "b").union(second)), "join-components")
    long_lists = members.join(grouped, F.col("x") == F.col("node"), "left").withColumn("group", F.coalesce("component", "x")).drop("node", "component")
    mixed = long_lists.groupBy("list").agg(F.min("group").alias("low"), F.max("group").alias("high")).where("low != high").select("list")
    sketches = join.classes.select(F.col("class").alias("x"), "sketch")
    apart = stage(long_lists.join(mixed, "list", "left_semi").select("list", "size", "x", "group", "n", "place"), "join-apart")
    across = _met(block_pairs_apart(apart, sketches).withColumn("earlier", F.array().cast("array<long>")), inside=False)
    third = join.links(stage(across, "join-across"))
    grouped = stage(components(grouped.toDF("a", "b").union(third)), "join-components")
    named = (join.classes.join(grouped, F.col("class") == F.col("node"), "left")
             .select("class", "least_doc", F.coalesce("component", "class").alias("group")))
    least = named.groupBy("group").agg(F.min("least_doc").alias("component_id"))
    return named.join(least, "group").select("class", "group", "component_id")


def ngram_jaccard(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, sketch_bits: int | None = None,
                  short_list: int = SHORT_LIST) -> DataFrame:
    """One row per input row: doc_id, n_shingles, component_id, class (of equal sets) and group (of linked classes).

    ``component_id`` is the smallest id reachable by links, the row's own included. A text with fewer words than a shingle has one,
    its whole sequence; a null or empty text has none, is its own component and has a null class. Null ids are never a
    component's name unless it has no other. Repeated rows are linked to each other. An empty table gives an empty result; other columns are not read.
    """
    join = _Join(docs, id_col, text_col, shingle, sketch_bits, short_list)
    return (join.members.join(_groups(join, *join.candidates()), "class", "left")
            .select("doc_id", F.col("n").cast("long").alias("n_shingles"),
                    F.when(F.col("class").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"), "class", "group"))


def _links(join: _Join) -> DataFrame:
    """All linked pairs (a, b) of different classes, a < b."""
    pairs, members = join.candidates()
    named = stage(_groups(join, pairs, members).select("class", "group"), "join-groups")
    before = Window.partitionBy("x").orderBy("place", "list").rowsBetween(-EARLIER, -1)
    brought = members.withColumn("earlier", F.collect_list("list").over(before))
    groups = named.join(join.classes.select("class", "sketch"), "class").select(F.col("class").alias("x"), "group", "sketch")
    inside = _met(block_pairs(brought.join(groups, "x")), inside=True)
    return join.links_inside(pairs.select("x", "y").union(inside).distinct(), named)


def ngram_links(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, sketch_bits: int | None = None,
                short_list: int = SHORT_LIST, block: int = BLOCK) -> DataFrame:
    """One row per pair of classes that link: their classes ``a`` and ``b`` (a < b), and ``doc_a`` and ``doc_b``, the smallest id of each.

    Every link between different shingle sets is a row, also inside a component; a class's rows link to each other and are no rows here. A class all
    of whose ids are null has a null id. Null and empty texts link to nothing.
    """
    join = _Join(docs, id_col, text_col, shingle, sketch_bits, short_list, block)
    of = lambda side: join.classes.select(F.col("class").alias(side), F.col("least_doc").alias(f"doc_{side}"))
    return _links(join).join(of("a"), "a").join(of("b"), "b").select("a", "b", "doc_a", "doc_b")


def link_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, sketch_bits: int | None = None,
                short_list: int = SHORT_LIST, block: int = BLOCK) -> DataFrame:
    """One row per class: class, doc_id (its smallest), copies (its rows), and n_links, the other rows that a row of it links to, its own copies included."""
    join = _Join(docs, id_col, text_col, shingle, sketch_bits, short_list, block)
    found = _links(join)
    ends = found.union(found.select("b", "a")).toDF("class", "other").join(join.classes.select(F.col("class").alias("other"), F.col("copies").alias("there")), "other")
    others = ends.groupBy("class").agg(F.sum("there").alias("there"))
    return join.classes.join(others, "class", "left").select(
        "class", F.col("least_doc").alias("doc_id"), "copies", (F.col("copies") - 1 + F.coalesce("there", F.lit(0))).alias("n_links"))


def class_column(text: Column, shingle: int = SHINGLE) -> Column:
    """Class of a text's shingle set; null for a text without words."""
    @pandas_udf("long")
    def name(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            raw = [t.encode() if isinstance(t, str) else b"" for t in texts]
            sets = [x for a, b in spans(raw) for x in shingle_sets(Words(raw[a:b], lower=True), shingle)]
            yield pd.Series([class_of(x) if len(x) else None for x in sets], index=texts.index, dtype="Int64")
        give_back()

    return name(text)


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """One row of each group of linked texts, with all columns: the one with the smallest id.

    Rows without words all stay. Where several rows have that id, the one with the smallest class and text hash stays.
    """
    join = _Join(docs, id_col, text_col, shingle, None, SHORT_LIST)
    name, group, least, alone, place = free_names(docs, "class", "group", "least", "alone", "place")
    groups = _groups(join, *join.candidates()).select(F.col("class").alias(name), F.col("group").alias(group), F.col("component_id").alias(least))
    named = docs.withColumn(name, class_column(F.col(f"`{text_col}`"), shingle)).join(groups, name, "left")
    # Nearly always a single row of each group passes the test, so a group of any size is one row when rows meet.
    first = named.where(F.col(name).isNull() | F.col(f"`{id_col}`").cast("long").eqNullSafe(F.col(least)))
    # Rows without words get a group of their own each.
    first = first.withColumn(alone, F.when(F.col(name).isNull(), F.monotonically_increasing_id()))
    order = F.row_number().over(Window.partitionBy(group, alone).orderBy(name, F.xxhash64(F.col(f"`{text_col}`"))))
    return first.withColumn(place, order).where(F.col(place) == 1).select(*[F.col(f"`{c}`") for c in docs.columns])
