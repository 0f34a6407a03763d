"""Small tables with every odd case, and the operators said again in plain Python."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter, defaultdict
from itertools import combinations

SPACED = re.compile(r"[^\x20\x09-\x0D]+")
LETTERED = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def texts(seed=5, n=60):
    """Random texts with copies, near copies, shared passages, nulls, empty, blank, short and very long ones."""
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)] + ["Ärger", "naïve", "日本", "the", "The", "of"]
    say = lambda k: [rng.choice(vocabulary) for _ in range(k)]
    passage = say(60)
    out = [None, "", "   \t\n", "one", "One", "two words", "a b c d", "A b C d", " ".join(say(30_000))]
    for i in range(n):
        words = say(rng.randint(5, 120))
        if i % 5 == 0:
            at = rng.randrange(len(words))
            words[at:at] = passage
        out.append(rng.choice([" ", "  ", "\n"]).join(words))
        if i % 3 == 0:
            near = list(words)
            near[rng.randrange(len(near))] = "changed"
            out += [" ".join(near), " ".join(words).upper(), " ".join(words)]
    base = say(100)
    for _ in range(50):  # a group of near copies that are not all linked to each other
        near = list(base)
        for at in rng.sample(range(100), 3):
            near[at] = rng.choice(vocabulary)
        out.append(" ".join(near))
    rng.shuffle(out)
    return out


def document_rows(seed=5):
    """(doc_id, text, lang, source, n_chars): ids out of order, one null id, repeated rows."""
    rng = random.Random(seed + 1)
    made = texts(seed)
    ids = rng.sample(range(1000), len(made))
    rows = [(i, t, "en", rng.choice(["b", "a", "ä", None, "hot", "hot", "hot"]), len(t or "")) for i, t in zip(ids, made, strict=True)]
    return [*rows, rows[3], rows[3], rows[40], (None, "a text without an id stands here", "en", "a", 5)]


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def documents(spark, rows=None, extra=True):
    """Documents; ``extra`` adds columns whose names the operators use themselves."""
    from pyspark.sql import functions as F

    df = spark.createDataFrame(document_rows() if rows is None else rows, SCHEMA)
    if extra:
        for name in ("size", "tie", "kept", "class", "group", "shard", "bucket", "rank", "score", "toxic", "virtual_slot", "ranges", "key"):
            df = df.withColumn(name, F.lit("clash"))
    return df


def shingles(text, k=5):
    words = SPACED.findall(lower(text))
    if len(words) >= k:
        return frozenset(tuple(words[i:i + k]) for i in range(len(words) - k + 1))
    return frozenset([tuple(words)]) if words else frozenset()


def jaccard_components(rows):
    """Row index -> (n_shingles, members) of rows linked at 0.75."""
    sets = [shingles(r[1]) for r in rows]
    holders = defaultdict(list)
    for i, s in enumerate(sets):
        for g in s:
            holders[g].append(i)
    shared = Counter(p for h in holders.values() for p in combinations(h, 2))
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for (i, j), o in shared.items():
        if 100 * o >= 75 * (len(sets[i]) + len(sets[j]) - o):
            parent[find(j)] = find(i)
    members = defaultdict(list)
    for i in range(len(rows)):
        members[find(i)].append(i)
    return [(len(sets[i]), members[find(i)]) for i in range(len(rows))]


def substring_rows(rows, k=20):
    """(doc_id, n_words, n_removed, sha256) per row; null ids come last, rows of one id and text are one place."""
    key = lambda r: (1 << 63) - 1 if r[0] is None else r[0]
    words = [SPACED.findall(r[1] or "") for r in rows]
    first = {}
    for r, w in zip(rows, words, strict=True):
        for i in range(len(w) - k + 1):
            place, window = (key(r), i), tuple(w[i:i + k])
            first[window] = min(first.get(window, place), place)
    out = []
    for r, w in zip(rows, words, strict=True):
        gone = {j for i in range(len(w) - k + 1) if first[tuple(w[i:i + k])] < (key(r), i) for j in range(i, i + k)}
        kept = " ".join(x for j, x in enumerate(w) if j not in gone)
        out.append((r[0], len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return out
