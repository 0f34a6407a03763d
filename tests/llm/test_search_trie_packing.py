"""Hard negatives, the prefix trie and packing against plain Python."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict
from math import floor, isfinite

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from liftplan.llm import hard_negatives, packing, prefix_trie
from liftplan.llm.shared import prepare
from tests.llm.brute import document_rows, documents

VECTORS = "vec_id long, label int, embedding array<float>"
TURNS = "conv_id long, turn long, role string, text string"
VOCABULARY = public_tokenizers.path("word_bpe_49k.json")


def vector_rows(seed, n, dims, centres=0):
    """Vectors around centres (or anywhere), with equal ones, short ones, zeros and every kind that takes no part."""
    rng = random.Random(seed)
    base = [[rng.gauss(0, 1) for _ in range(dims)] for _ in range(centres)]
    rows = []
    for i in range(n):
        near = rng.choice(base) if centres else [0.0] * dims
        rows.append((i, rng.choice([0, 0, 1, 2, 3]), [float(np.float32(x + rng.gauss(0, 0.05 if centres else 0.4))) for x in near]))
    same = [0.25] * dims
    rows += [(n + i, i % 3, same) for i in range(40)]
    rows += [(n + 50, 1, [0.5] * (dims - 1)), (n + 51, 2, []), (n + 100, 1, [0.0] * dims), (200, 0, None), (1000, None, same), (None, 1, same), (1001, 1, None)]
    rows += [(1002 + i, 1, [x, *same[1:]]) for i, x in enumerate([None, float("nan"), float("inf"), float("-inf")])]
    return [*rows, rows[0], (rows[0][0], 9, rows[0][2]), (-100, 1, same), (-7, 0, [1.0] * dims)]


def negatives(rows, k=5, low=80, high=100):
    valid = [(i, c, tuple(floor(256 * x) for x in v)) for i, c, v in rows
             if i is not None and c is not None and v is not None and all(x is not None and isfinite(x) for x in v)]
    one = {}
    for i, c, v in valid:
        one[i] = min(one.get(i, (c, v)), (c, v))
    score = lambda a, b: sum(x * y for x, y in zip(a, b, strict=False))
    out = Counter()
    for a, (label, v) in one.items():
        if a % 100:
            continue
        ranked = sorted((-score(v, w), i, c) for i, (c, w) in one.items() if i != a)
        for s, p, _ in [x for x in ranked if x[2] == label][:k]:
            fits = [x for x in ranked if x[2] != label and low * -s <= 100 * -x[0] <= high * -s][:k]
            out.update((a, p, rank, i, -s, -t) for rank, (t, i, _) in enumerate(fits, 1))
    return out


@pytest.mark.parametrize(("n", "dims", "block", "centres"), [(400, 6, 16, 0), (300, 3, 512, 0), (500, 8, 20, 12)])
def test_hard_negatives(spark, n, dims, block, centres):
    rows = vector_rows(n, n, dims, centres)
    df = spark.createDataFrame(rows, VECTORS)
    for name in ("block", "rank", "window", "key", "q", "row", "anchor", "low", "r"):
        df = df.withColumn(name, F.lit("clash"))
    got = hard_negatives.hard_negatives(df, F.col("vec_id") % 100 == 0, block_rows=block)
    assert Counter(map(tuple, got.collect())) == negatives(rows)
    other = hard_negatives.hard_negatives(df, F.col("vec_id") % 100 == 0, block_rows=block, positives=2, negatives=3, least_percent=33, most_percent=71)
    assert Counter(map(tuple, other.collect())) == Counter({x: c for x, c in _narrow(rows).items()})


def _narrow(rows):
    out = negatives(rows, 3, 33, 71)
    best = defaultdict(set)
    for a, p, _, _, s, _ in negatives(rows, 10**6, -10**9, 10**9):
        best[a].add((-s, p))
    kept = {a: {p for _, p in sorted(ps)[:2]} for a, ps in best.items()}
    return Counter({x: c for x, c in out.items() if x[1] in kept[x[0]]})


def test_large_components_score_exactly(spark):
    rows = [(i, i % 2, [float(3000 + 7 * i), -2500.5 + i, 0.125 * i]) for i in range(201)] + [(300, 0, [1e300, -1e300, 1.0])]
    got = hard_negatives.hard_negatives(spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>"), F.col("vec_id") % 100 == 0, block_rows=16)
    cut = [(i, c, [max(-262144.0, min(262144.0, x)) for x in v]) for i, c, v in rows]
    assert Counter(map(tuple, got.collect())) == negatives(cut)


def test_zone_maps_spare_blocks(spark):
    """Around well separated centres most blocks are not read, and none that is needed is left out."""
    rng = np.random.Generator(np.random.PCG64(3))
    centres = rng.normal(size=(40, 8)) * 2
    rows = [(i, int(i % 4), (centres[(i // 4) % 40] + rng.normal(size=8) * 0.02).tolist()) for i in range(4000)]
    df = spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>")
    made = hard_negatives.Candidates(df, F.col("vec_id") % 100 == 0, block_rows=16)
    opened = made.anchors.withColumns({"lows": F.array("least"), "highs": F.array(F.lit(1 << 62))})
    read = sum(len(r["a_ids"]) // 8 for r in made.chosen(opened, 1, True).collect())
    assert made.anchors.count() == 40 and read < 0.1 * 40 * made.blocks.count()
    got = hard_negatives.hard_negatives(df, F.col("vec_id") % 100 == 0, block_rows=16)
    assert Counter(map(tuple, got.collect())) == negatives(rows)


def test_hilbert_neighbours_are_one_step_apart():
    for dims, bits in ((2, 4), (3, 3), (4, 2)):
        cells = np.array(np.meshgrid(*[range(1 << bits)] * dims)).reshape(dims, -1).T
        keys = hard_negatives.hilbert_keys(cells, bits)
        path = cells[sorted(range(len(keys)), key=keys.__getitem__)].astype(int)
        assert len(set(keys)) == len(keys) and (np.abs(np.diff(path, axis=0)).sum(axis=1) == 1).all()


def test_no_vectors(spark):
    prepare(spark)
    empty = spark.createDataFrame([], VECTORS)
    assert hard_negatives.hard_negatives(empty, F.col("vec_id") % 100 == 0).collect() == []
    alone = spark.createDataFrame([(1, 1, [0.5]), (100, 1, [0.5])], VECTORS)
    assert hard_negatives.hard_negatives(alone, F.col("vec_id") % 100 == 0).collect() == []
    assert hard_negatives.hard_negatives(alone, F.col("vec_id") < 0).collect() == []


def turn_rows(seed=2):
    rng = random.Random(seed)
    says = [("user", "hi"), ("user", "hello there"), ("bot", "yes"), ("bot", "né"), (None, "x"), ("user", None), ("", ""), ("us", "erhi")]
    rows = []
    for c in [*range(0, 60), 100, 101, 205, 310, 311, -5, -100, -130]:
        for turn in range(rng.choice([1, 2, 3, 7, 8, 9])):
            rows.append((c, rng.choice([turn, turn, None, 3]), *rng.choice(says[:3] if c % 2 else says)))
    rows += [(401, t, "user", f"line {t % 3}") for t in range(70)] + [(402, t, "user", f"line {t % 3}") for t in range(64)]
    rows += [(500, 0, "user", "w" * 40_000), (None, 1, "user", "no id"), (None, 2, "user", "no id"), rows[4], rows[4]]
    rng.shuffle(rows)
    return rows


def trie_nodes(rows, group=100, most=6):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(ts)] for c, ts in own.items()}
    made = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % most
        base = c - (abs(c) % group) * (1 if c >= 0 else -1)
        made[c] = tuple(own.get(base, [])[:h] + own[c][h:])
    members = defaultdict(list)
    for c in sorted(made):
        for d in range(len(made[c]) + 1):
            members[made[c][:d]].append(c)
    out = Counter()
    for node, convs in members.items():
        under = [n for n in members if n[:len(node)] == node]
        kids = lambda n: sum(len(m) == len(n) + 1 and m[:len(n)] == n for m in members)
        saved = sum((len(members[n]) - 1) * len(n[-1][1]) for n in under if n)
        ends = ",".join(str(c) for c in convs if made[c] == node)
        out[(convs[0], len(node), members[node[:-1]][0] if node else None, len(convs), kids(node), sum(kids(n) == 0 for n in under), saved, hashlib.sha256(ends.encode()).hexdigest())] += 1
    return out


@pytest.mark.parametrize("seed", [2, 3])
def test_prefix_trie(spark, seed):
    rows = turn_rows(seed)
    df = spark.createDataFrame(rows, TURNS)
    for name in ("at", "part", "h", "n", "node", "root", "next", "i", "conv", "taken", "base"):
        df = df.withColumn(name, F.lit("clash"))
    prepare(spark)
    assert Counter(map(tuple, prefix_trie.prefix_trie(prefix_trie.shared_heads(df)).collect())) == trie_nodes(rows)


def test_trie_of_turnless_and_no_conversations(spark):
    prepare(spark)
    assert prefix_trie.prefix_trie(prefix_trie.shared_heads(spark.createDataFrame([], TURNS))).collect() == []
    bare = next(c for c in range(1, 99) if zlib.crc32(str(c).encode()) % 6 > 2)  # its group's first conversation is absent
    rows = [(bare, 0, "user", "gone")]
    assert Counter(map(tuple, prefix_trie.prefix_trie(prefix_trie.shared_heads(spark.createDataFrame(rows, TURNS))).collect())) == trie_nodes(rows)


def test_digest_pieces_join_as_one_text(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "PIECE_BYTES", 20)
    prepare(spark)
    rows = [(c, 0, "user", "same") for c in range(300)]
    turns = spark.createDataFrame([(c, 1, r, t) for c, _, r, t in rows], "conv_id long, at long, role string, text string")
    got = {r["depth"]: r["ends_sha256"] for r in prefix_trie.prefix_trie(turns).collect()}
    assert got == {0: hashlib.sha256().hexdigest(), 1: hashlib.sha256(",".join(map(str, range(300))).encode()).hexdigest()}


def test_words_encode_as_whole_texts():
    tokenizer = Tokenizer.from_file(VOCABULARY)
    rng = np.random.Generator(np.random.PCG64(7))
    parts = ["a", "Word", "ING", " ", "  ", "\n", "\t", "\r", "\x0b", "\x0c", "\x1c", ".", ",", "'s", "'", "é", "É", "H̱", "́", "日本", "7", "\u0085", " ", " ", "Σ", "İ",
             "<|endoftext|>", "<|ENDOFTEXT|>", "<|startoftext|>", "<|", "🙂"]
    cases = ["".join(parts[i] for i in rng.integers(0, len(parts), 25)) for _ in range(2500)] + [r[1] or "" for r in document_rows()]
    expected = [np.array(e.ids, "<u4").tobytes() for e in tokenizer.encode_batch(cases, add_special_tokens=False)]
    for cache in (0, 1 << 20):
        encoder = packing.WordEncoder(VOCABULARY, cache)
        assert encoder.encode([c.encode() for c in cases]) == expected
        assert encoder.encode([c.encode() for c in cases]) == expected
    with pytest.raises(ValueError):
        packing.WordEncoder(public_tokenizers.path("byte_bpe_50k.json"))


@pytest.mark.parametrize(("capacity", "block"), [(64, 40), (4096, 2000), (1, 50)])
def test_packing(spark, capacity, block):
    rows = document_rows()
    prepare(spark)
    got = packing.pack_documents(documents(spark), VOCABULARY, end_id=1, capacity=capacity, block_pieces=block).collect()
    tokenizer, expected = Tokenizer.from_file(VOCABULARY), Counter()
    for r in rows:
        ids = [*tokenizer.encode(r[1] or "", add_special_tokens=False).ids, 1]
        for i, at in enumerate(range(0, len(ids), capacity)):
            part = np.array(ids[at:at + capacity], "<u4")
            expected[(r[0], i, at, len(part), zlib.crc32(part.tobytes()))] += 1
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got) == expected
    bins = defaultdict(list)
    for r in got:
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
    for b in bins.values():
        at = 0
        for offset, length in sorted(b):
            assert offset == at
            at += length
        assert at <= capacity
    assert len(bins) <= 1.02 * -(-sum(r["length"] for r in got) // capacity) + 1


def test_packing_nothing(spark):
    prepare(spark)
    assert packing.pack_documents(documents(spark, []), VOCABULARY, end_id=1).collect() == []


def test_evolution_beats_best_fit():
    """Triples that fill bins exactly: best fit alone needs more bins, generations save some; no packing loses or doubles a piece."""
    rng = random.Random(11)
    lengths = []
    for _ in range(40):
        a = rng.randint(380, 490)
        b = rng.randint(250, (1000 - a) // 2)
        lengths += [a, b, 1000 - a - b]
    rng.shuffle(lengths)
    first = packing.evolve(lengths, 1000, [], 6, 0, random.Random(1))
    later = packing.evolve(lengths, 1000, list(first), 6, 400, random.Random(2))
    assert later[0].fitness() > first[0].fitness() and len(later[0].bins) < len(first[0].bins)
    for p in [*first, *later]:
        assert sorted(x for b in p.bins for x in b) == list(range(len(lengths)))
        assert all(sum(lengths[x] for x in b) == 1000 - f for b, f in zip(p.bins, p.free, strict=True)) and min(p.free) >= 0
    again = packing.read_packing(lengths, 1000, later[0].numbers())
    assert sorted(map(sorted, again.bins)) == sorted(map(sorted, later[0].bins))


def test_evolution_goes_on_after_the_least_number_of_bins():
    """Best fit needs the least number of bins at once; the other packings and all children are made nevertheless, and fill bins better."""
    rng = random.Random(3)
    lengths = [rng.randint(1, 300) for _ in range(200)]
    first = packing.evolve(lengths, 1000, [], 4, 0, random.Random(1))
    assert len(first) == 4 and len(first[0].bins) == -(-sum(lengths) // 1000)
    drawn = random.Random(2)
    later = packing.evolve(lengths, 1000, list(first), 4, 60, drawn)
    assert len(later) == 4 and drawn.getstate() != random.Random(2).getstate()
    assert later[0].fitness() > first[0].fitness() and len(later[0].bins) == len(first[0].bins)
    made = next(packing._epoch(1000, 4, 5, 0)(iter([pa.RecordBatch.from_pylist([{"block": 0, "island": 0, "lengths": np.array(lengths, "<u4").tobytes(), "packings": []}])])))
    assert len(made.column("packings")[0]) == 4


def test_elite_moves_between_islands(spark):
    """All islands of a block know the best packing after the last epoch, and the block's result is the best of all."""
    prepare(spark)
    rng = random.Random(5)
    rows = [(i, rng.randint(200, 500)) for i in range(300)]
    pieces = spark.createDataFrame(rows, "row long, length long")
    got = packing.pack_blocks(pieces, 2, 1000, 0, epochs=3, children=20).collect()
    assert sorted((r["row"], r["length"]) for r in got) == rows
    fill = Counter()
    for r in got:
        fill[(r["block"], r["bin"])] += r["length"]
    assert max(fill.values()) <= 1000 and len({r["block"] for r in got}) == 2
    assert {(r["block"], r["bin"]): r["done"] for r in got} == {b: n >= 990 for b, n in fill.items()}
