"""Exact de-duplication, Jaccard join, substring de-duplication and decontamination against plain Python."""

import hashlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from liftplan.llm import decontaminate, exact_dedup, ngram_join, substring_dedup
from liftplan.llm.components import components
from tests.llm.brute import document_rows, documents, jaccard_components, lower, shingles, substring_rows

ROWS = document_rows()


def bag(df):
    return Counter(tuple(r) for r in df.collect())


def expected_owners(rows):
    groups = defaultdict(list)
    for r in rows:
        groups[lower(r[1])].append(r[0])
    out, done = [], set()
    for r in rows:
        ids = groups[lower(r[1])]
        keep = max((i for i in ids if i is not None), default=None)
        kept = r[0] == keep and lower(r[1]) not in done
        if kept:
            done.add(lower(r[1]))
        out.append((r[0], keep, len(ids), kept, hashlib.sha256(lower(r[1]).encode()).hexdigest()))
    return Counter(out)


@pytest.mark.parametrize("bounds", [{}, {"block_bytes": 500, "trie_bytes": 900}])
def test_exact_dedup(spark, bounds):
    made = exact_dedup.exact_dedup(documents(spark), **bounds).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")
    assert bag(made) == expected_owners(ROWS)


def test_exact_dedup_smallest_and_empty(spark):
    rows = [(3, "A", None, None, 0), (1, "a", None, None, 0), (2, "b", None, None, 0)]
    made = exact_dedup.exact_dedup(documents(spark, rows), keep="smallest").where("kept").select("keep_id", "group_size")
    assert bag(made) == Counter([(1, 2), (2, 1)])
    assert exact_dedup.exact_dedup(documents(spark, [])).count() == 0


def test_trie_spills_and_keeps_every_value():
    trie, expected = exact_dedup.PatriciaTrie(3000), defaultdict(list)
    rng = np.random.Generator(np.random.PCG64(3))
    for i in range(3000):
        key = bytes(rng.integers(97, 100, rng.integers(0, 9)).tolist())
        trie.insert(key, i)
        expected[key].append(i)
    assert trie.spilled
    assert {k: sorted(v) for k, v in trie.groups()} == expected


@pytest.mark.parametrize("options", [{}, {"short_list": 2, "sketch_bits": 6}])
def test_jaccard_components(spark, options):
    got = bag(ngram_join.ngram_jaccard(documents(spark), **options).select("doc_id", "n_shingles", "component_id"))
    expected = Counter()
    for r, (n, members) in zip(ROWS, jaccard_components(ROWS), strict=True):
        least = min((ROWS[m][0] for m in members if ROWS[m][0] is not None), default=None)
        expected[(r[0], n, least if n else r[0])] += 1
    assert got == expected
    assert ngram_join.ngram_jaccard(documents(spark, [])).count() == 0


@pytest.mark.parametrize("options", [{}, {"short_list": 2, "sketch_bits": 6, "block": 7}])
def test_jaccard_links(spark, options):
    of_set = defaultdict(list)
    for r in ROWS:
        if shingles(r[1]):
            of_set[shingles(r[1])].append(r[0])
    sets, linked = list(of_set), defaultdict(set)
    for i, a in enumerate(sets):
        for b in sets[:i]:
            o = len(a & b)
            if 100 * o >= 75 * (len(a) + len(b) - o):
                linked[a].add(b)
                linked[b].add(a)
    least = {a: min((i for i in ids if i is not None), default=None) for a, ids in of_set.items()}
    got = ngram_join.ngram_links(documents(spark), **options).collect()
    assert all(r["a"] < r["b"] for r in got)
    assert Counter(frozenset([r["doc_a"], r["doc_b"]]) for r in got) == Counter(frozenset([least[a], least[b]]) for a in sets for b in linked[a] if least[a] < least[b])
    counts = bag(ngram_join.link_counts(documents(spark), **options).select("doc_id", "copies", "n_links"))
    assert counts == Counter((least[a], len(of_set[a]), len(of_set[a]) - 1 + sum(len(of_set[b]) for b in linked[a])) for a in sets)
    assert ngram_join.ngram_links(documents(spark, [])).count() == 0 == ngram_join.link_counts(documents(spark, [])).count()


def test_a_long_list_is_dealt_in_blocks(spark):
    rng, block = np.random.Generator(np.random.PCG64(6)), 10
    sizes = np.sort(rng.integers(60, 140, 300))
    kinds = ngram_join.size_class(sizes)
    many = {int(c): -(-int((kinds == c).sum()) // block) for c in set(kinds.tolist())}
    seen, rows = Counter(), []
    for i, (n, c) in enumerate(zip(sizes.tolist(), kinds.tolist(), strict=True)):
        rows.append((1, i, n, c, seen[c] // block, many[c], many.get(c - 1, 0), many.get(c + 1, 0)))
        seen[c] += 1
    members = spark.createDataFrame(rows, "list long, x long, n int, size int, block int, own int, below int, above int")
    work = defaultdict(lambda: ([], []))
    for r in ngram_join.block_pairs(members).collect():
        work[(r["low"], r["a"], r["step"], r["b"])][r["side"]].append(r["x"])
    assert max(len(a) + len(b) for a, b in work.values()) <= 2 * block
    met = Counter()
    for (_, a, step, b), (left, right) in work.items():
        met.update((x, y) for i, x in enumerate(left) for y in left[:i]) if step == 0 and a == b else met.update((x, y) for x in left for y in right)
    together = Counter(tuple(sorted(p)) for p in met.elements())
    assert set(together.values()) == {1}
    assert all((i, j) in together for j in range(300) for i in range(j) if 100 * sizes[i] >= 75 * sizes[j])


def test_a_large_group_does_not_meet_itself(spark):
    """Members of different groups meet in one pair of blocks; a large group has a row per member and block of the others."""
    rng, block = np.random.Generator(np.random.PCG64(8)), 10
    sizes = np.sort(rng.integers(60, 140, 300)).tolist()
    groups = [0 if rng.random() < 0.6 else int(rng.integers(1, 40)) for _ in sizes]
    kinds = ngram_join.size_class(np.array(sizes)).tolist()
    members = spark.createDataFrame([(1, c, x, g, n, 0) for x, (c, g, n) in enumerate(zip(kinds, groups, sizes, strict=True))],
                                    "list long, size int, x long, group long, n int, place int")
    sketches = spark.createDataFrame([(x, [x]) for x in range(300)], "x long, sketch array<long>")
    work, rows = defaultdict(lambda: ([], [])), Counter()
    for r in ngram_join.block_pairs_apart(members, sketches, block).collect():
        assert list(r["sketch"]) == [r["x"]]
        work[(r["low"], r["a"], r["step"], r["b"])][r["side"]].append(r["x"])
        rows[r["x"]] += 1
    met = Counter()
    for (_, a, step, b), (left, right) in work.items():
        assert max(len(left), len(right)) <= 4 * block  # dealt by hash
        met.update((x, y) for i, x in enumerate(left) for y in left[:i]) if step == 0 and a == b else met.update((x, y) for x in left for y in right)
    together = Counter(tuple(sorted(p)) for p in met.elements())
    assert set(together.values()) == {1}
    assert all((i, j) in together for j in range(300) for i in range(j) if groups[i] != groups[j] and 100 * sizes[i] >= 75 * sizes[j])
    # Where the group fills less than a block of a size class, it shares blocks with others.
    many = Counter(c for c, g in zip(kinds, groups, strict=True) if g == 0)
    large = {x for x in range(300) if groups[x] == 0 and many[kinds[x]] >= block}
    assert len(large) > 100 and not [p for p in together if large.issuperset(p)]
    others = -(-sum(g != 0 for g in groups) // block) + 2 * len(set(kinds))
    assert max(rows[x] for x in large) <= others


def test_one_row_of_each_group_stays(spark):
    docs = documents(spark)
    kept = ngram_join.keep_one(docs)
    assert kept.columns == docs.columns
    rows = [tuple(r)[:5] for r in kept.collect()]
    groups = {}
    for i, (n, members) in enumerate(jaccard_components(ROWS)):
        groups[i if n == 0 else min(members)] = members
    assert len(rows) == len(groups)
    kept_ids = Counter(r[0] for r in rows)
    for members in groups.values():
        ids = [ROWS[m][0] for m in members if ROWS[m][0] is not None]
        if ids:
            assert kept_ids[min(ids)] >= 1
    assert ngram_join.keep_one(documents(spark, [])).count() == 0


def test_divide_skip_counts_exactly():
    rng = np.random.Generator(np.random.PCG64(1))
    for _ in range(200):
        query = rng.permutation(np.unique(rng.integers(0, 80, rng.integers(1, 60)).astype(np.uint64)))
        others = [np.unique(rng.integers(0, 80, rng.integers(1, 60)).astype(np.uint64)) for _ in range(6)] + [np.sort(query), np.sort(query[:max(1, len(query) - 3)])]
        got = ngram_join.divide_skip(query, int(rng.integers(0, len(query) + 1)), others)
        want = [i for i, o in enumerate(others) if 100 * len(np.intersect1d(query, o)) >= 75 * len(np.union1d(query, o))]
        assert sorted(got) == want


def test_sketches_bound_the_difference():
    rng = np.random.Generator(np.random.PCG64(2))
    for _ in range(50):
        a, b = (np.unique(rng.integers(0, 3000, int(k)).astype(np.uint64)) for k in rng.integers(1, 3000, 2))
        x, y = ngram_join.parity_sketch(a), ngram_join.parity_sketch(b)
        differ = ngram_join.sketches_differ(x, [y, x]).tolist()
        assert differ[0] <= len(np.setxor1d(a, b)) and differ[1] == 0
        assert differ[0] == ngram_join.sketches_differ(y, [x])[0]


def test_sketches_of_near_copies_differ_by_their_own_bits():
    """Also where the first bit of a word differs, which makes the word a negative number."""
    rng, first_bits = np.random.Generator(np.random.PCG64(9)), 0
    for _ in range(200):
        a = np.unique(rng.integers(0, 1 << 62, 400).astype(np.uint64))
        b = np.unique(np.r_[a[:-8], rng.integers(0, 1 << 62, 8).astype(np.uint64)])
        x, y = ngram_join.parity_sketch(a), ngram_join.parity_sketch(b)
        got = ngram_join.sketches_differ(x, [y, x, y]).tolist()
        assert got == [sum((v & (1 << 64) - 1).bit_count() for v in (x ^ y).tolist()), 0, got[0]]
        assert got[0] <= len(np.setxor1d(a, b))
        first_bits += bool(((x ^ y) < 0).any())
    assert first_bits > 20


def test_components_of_paths_and_stars(spark):
    edges = [(i, i + 1) for i in range(200)] + [(1000, 1000 + i) for i in range(1, 50)] + [(7, 7), (None, 3)]
    got = {r[0]: r[1] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(201)}, **{1000 + i: 1000 for i in range(50)}}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


@pytest.mark.parametrize("bounds", [{}, {"block_bytes": 700, "bucket_bytes": 2000}])
def test_substring_dedup(spark, bounds):
    made = substring_dedup.substring_dedup(documents(spark), **bounds)
    assert bag(made.select("doc_id", "n_words", "n_removed", "kept_sha256")) == Counter(substring_rows(ROWS))
    assert made.where("sha2(kept_text, 256) != kept_sha256").count() == 0
    assert substring_dedup.substring_dedup(documents(spark, [])).count() == 0


def test_windows_with_one_hash_are_told_apart():
    words = np.array([1, 2, 3, 1, 2, 4, 1, 2, 3], np.uint64)
    at, ids = np.array([0, 3, 6]), np.array([5, 6, 7])
    later = substring_dedup.later_places(np.array([9, 9, 9], np.uint64), words, at, 3, ids, np.zeros(3, np.int64))
    assert later.tolist() == [False, False, True]


def test_contained_items(spark):
    items = [(1, ROWS[12][1]), (2, "a b c d"), (3, None), (4, ""), (None, "w1 w2 w3 w4 w5 w6"), (6, " ".join(f"w{i}" for i in range(40)))]
    rows = [*ROWS, (5000, "x " + " ".join(f"w{i}" for i in range(2, 40)) + " y", "en", "a", 1), (5001, " ".join(f"w{i}" for i in range(20)), "en", "a", 1)]
    got = bag(decontaminate.contained_items(documents(spark, rows), spark.createDataFrame(items, "item_id long, text string"), block_shingles=20).select("doc_id", "item_id", "shared", "n_item"))
    expected = Counter()
    for r in rows:
        for item, text in items:
            q = shingles(text)
            shared = len(q & shingles(r[1]))
            if q and 100 * shared >= 75 * len(q):
                expected[(r[0], item, shared, len(q))] += 1
    assert got == expected and any(k[0] == 5000 for k in got) and (5001, 6) not in {k[:2] for k in got}
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.contained_items(documents(spark), none).count() == 0
    clean = decontaminate.without_items(documents(spark, rows), spark.createDataFrame(items, "item_id long, text string"))
    hit = {(k[0]) for k in expected}
    assert Counter(r["doc_id"] for r in clean.collect()) == Counter(r[0] for r in rows if r[0] not in hit)


