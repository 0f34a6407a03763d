"""Toxicity scores from a learned lexicon, fuzzy matching and context windows.

Terms and stems that mark toxic texts are learned from labelled rows and put into a trie. A word is matched by running a Levenshtein automaton of
the word over the trie: the automaton's state is the row of edit distances, a branch is left as soon as all of them exceed the bound. Each hit is weighed by the words
around it: inside quotation marks, beside words of reporting or denial, a term is rather quoted than meant. A logistic regression turns counts of hits into
a score.
"""

from __future__ import annotations

import math
import re
import sys
import types
import zlib
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.functions import pandas_udf

from liftplan.llm.shared import stage
from liftplan.llm.words import Words, as_bytes, shingle_sets, spans

#: Labelled rows that a model is fitted on, at most: those with the smallest hashes of their ids.
TRAIN_ROWS = 40_000
#: Terms and stems of the lexicon, at most: those that mark the most toxic rows.
LEXICON_SIZE = 2_000
#: A term is in the lexicon if the lower end of a confidence interval (so many deviations) of its share of toxic rows is this high.
LEAST_SHARE, DEVIATIONS = 0.55, 2.5
#: A stem is one only if it marks so many times the rows of its most frequent word.
STEM_GAIN = 1.5
STEM_LENGTHS = (4, 5, 6)
#: Words from this length on may differ by one edit from terms and stems from this length on.
FUZZY_LENGTH = 5
#: Words on each side of a hit that decide between quotation and abuse.
CONTEXT = 6
REPORTING = frozenset("said says wrote writes called calling quoted quote quotes quoting reported term word words slur insult claimed allegedly".split())
DENIAL = frozenset("not never no don't doesn't isn't wasn't".split())
ADDRESS = frozenset("you your you're u are".split())
_QUOTES = re.compile("[\"“”«»„]")
_EDGE = " \t\n\r\x0b\x0c.,;:!?\"'“”„«»()[]{}<>*_~`-—–…"
#: Words that a process remembers.
WORD_CACHE = 1_000_000


class Trie:
    """Terms (matched whole) and stems (matched at the beginning of a word)."""

    __slots__ = ("children", "kinds")

    def __init__(self):
        self.children, self.kinds = {}, 0

    def add(self, text: str, stem: bool) -> None:
        node = self
        for c in text:
            node = node.children.setdefault(c, Trie())
        node.kinds |= 2 if stem else 1


class Matcher:
    """Lexicon trie searched by Levenshtein automata; remembers words."""

    def __init__(self, terms: list[str], stems: list[str], fuzzy_length: int = FUZZY_LENGTH):
        self.root, self.fuzzy_length = Trie(), fuzzy_length
        for t in terms:
            self.root.add(t, False)
        for s in stems:
            self.root.add(s, True)
        # One edit leaves the first half of a term whole at the word's beginning or the second half at its end; under a
        # stem the second half may be followed by more and be moved by one place. Other words need no search.
        halves: dict[tuple[str, int], set[str]] = {}
        for text in {*terms, *stems}:
            h = len(text) // 2
            halves.setdefault(("head", h), set()).add(text[:h])
        for text in terms:
            halves.setdefault(("end", len(text) - len(text) // 2), set()).add(text[len(text) // 2:])
        for text in stems:
            for at in range(max(0, len(text) // 2 - 1), len(text) // 2 + 2):
                halves.setdefault((at, len(text) - len(text) // 2), set()).add(text[len(text) // 2:])
        self.slices = [(slice(0, n) if at == "head" else slice(-n, None) if at == "end" else slice(at, at + n), frozenset(s)) for (at, n), s in halves.items()]
        self.clean: set[str] = set()
        self.hits: dict[str, tuple[int, int]] = {}

    def look(self, words: list[str]) -> bool:
        """Whether any of the words, as they stand in a text, is a hit; all of them that are get into ``hits``."""
        if len(self.hits) > WORD_CACHE:
            self.hits = {}
        fresh = set(words)
        fresh -= self.clean
        for w in fresh:
            if w not in self.hits:
                got = self.match(w.strip(_EDGE).lower())
                if got[0]:
                    self.hits[w] = got
                elif len(self.clean) < WORD_CACHE:
                    self.clean.add(w)
        return not self.hits.keys().isdisjoint(words)

    def match(self, word: str) -> tuple[int, int]:
        """(kind, edits) of the best match: kind 1 term, 2 stem, 0 none."""
        for part, known in self.slices:
            if word[part] in known:
                return self._search(word)
        return 0, 0

    def _search(self, word: str) -> tuple[int, int]:
        most = 1 if len(word) >= self.fuzzy_length else 0
        best = (0, most + 1)
        stack = [(self.root, tuple(range(len(word) + 1)))]
        while stack:
            node, row = stack.pop()
            own = most if row[0] >= self.fuzzy_length else 0  # row[0] is the length of what the path spells
            if node.kinds & 1 and row[-1] <= own and row[-1] < best[1]:
                best = (1, row[-1])
            # A stem may end anywhere in the word.
            if node.kinds & 2 and (least := min(row)) <= own and least < best[1]:
                best = (2, least)
            for c, child in node.children.items():
                new = [row[0] + 1]
                for i, w in enumerate(word, 1):
                    new.append(min(new[-1] + 1, row[i] + 1, row[i - 1] + (w != c)))
                if min(new) <= most:
                    stack.append((child, tuple(new)))
        return best if best[0] else (0, 0)


def words_of(text: str) -> set[str]:
    """Different words, lower-cased and without marks at their ends."""
    return {w.strip(_EDGE).lower() for w in set(text.split())} - {""}


N_FEATURES = 7


def features(text: str, matcher: Matcher) -> np.ndarray:
    """Counts of hits: exact terms, stems, misspelled ones; meant and quoted; density; length."""
    words = text.split()
    out = np.zeros(N_FEATURES)
    out[6] = math.log1p(len(words)) / 10
    if not matcher.look(words):
        return out
    hits = [(i, matcher.hits[w]) for i, w in enumerate(words) if w in matcher.hits]
    quotes = np.cumsum([len(_QUOTES.findall(w)) for w in words])
    for i, (kind, edits) in hits:
        out[2 if edits else kind - 1] += 1
        near = [w.strip(_EDGE).lower() for w in (*words[max(0, i - CONTEXT):i], *words[i + 1:i + 1 + CONTEXT])]
        before = quotes[i] - len(_QUOTES.findall(words[i]))
        inside = before % 2 == 1 or _QUOTES.search(words[i][:1]) is not None
        quoted = min(1.0, 0.7 * inside + 0.4 * any(w in REPORTING for w in near) + 0.2 * any(w in DENIAL for w in near))
        meant = 1.0 - quoted + 0.3 * any(w in ADDRESS for w in near)
        out[3] += meant
        out[4] += quoted
    out[5] = 100 * len(hits) / len(words)
    out[:6] = np.log1p(out[:6])
    return out


@dataclass
class ToxicityModel:
    """Lexicon and weights; small whatever the input (see the bounds above)."""

    terms: list[str]
    stems: list[str]
    weights: list[float]
    bias: float
    name: str = field(default="")

    def matcher(self) -> Matcher:
        """The matcher of this process; it keeps its words from one task to the next."""
        kept = sys.modules.setdefault("_liftplan_toxicity", types.ModuleType("_liftplan_toxicity")).__dict__
        if self.name not in kept:
            kept.clear()
            kept[self.name] = Matcher(self.terms, self.stems)
        return kept[self.name]

    def score(self, text: str | None, matcher: Matcher) -> float:
        z = self.bias + float(np.dot(self.weights, features(text or "", matcher)))
        return 1 / (1 + math.exp(-max(-40.0, min(40.0, z))))


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.1, rounds: int = 50) -> tuple[np.ndarray, float]:
    """Weights and bias of a ridge logistic regression by Newton's method."""
    a = np.hstack([x, np.ones((len(x), 1))])
    w, penalty = np.zeros(a.shape[1]), np.full(a.shape[1], ridge)
    penalty[-1] = 1e-6
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        step = np.linalg.solve((a * (p * (1 - p) + 1e-9)[:, None]).T @ a + np.diag(penalty), a.T @ (y - p) - penalty * w)
        w = w + step
        if np.abs(step).max() < 1e-7:
            break
    return w[:-1], float(w[-1])


def held_out(doc_id: Column) -> Column:
    """Rows whose labels are never learned from: crc32 of the id as text is divisible by five."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0


def _marked():
    """Rows with the smallest shingle hash of their text; copies and most near copies have the same one."""
    def run(batches):
        for batch in batches:
            texts = as_bytes(batch.column(0))
            sets = [own for a, b in spans(texts) for own in shingle_sets(Words(texts[a:b], lower=True))]
            least = pa.array([int(x[0].view(np.int64)) if len(x) else None for x in sets], pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns, least], names=["text", "toxic", "mark"])
    return run


def training_rows(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, most: int) -> DataFrame:
    """text and toxic of at most ``most`` labelled rows, none of them held out; of rows with one mark (near copies) one stays."""
    usable = (labels.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
              .where(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1) & ~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.max("toxic").alias("toxic")))
    picked = usable.withColumn("order", F.xxhash64("doc_id")).orderBy("order", "doc_id").limit(most).select("doc_id", "toxic")
    # At most ``most`` rows of two numbers: sent to every task instead of moving the texts.
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("text")).join(F.broadcast(picked), "doc_id")
    marked = rows.select("text", "toxic").mapInArrow(_marked(), "text string, toxic int, mark long")
    return marked.groupBy("mark").agg(F.min(F.struct("text", "toxic")).alias("row")).select("row.text", "row.toxic")


def choose_lexicon(counts: dict[str, int]) -> tuple[list[str], list[str]]:
    """Terms and stems of the strong entries (stems begin with a full stop) and the toxic rows that each marks."""
    terms = {t: n for t, n in counts.items() if not t.startswith(".")}
    stems: dict[str, int] = {}
    for stem, n in sorted(((t[1:], n) for t, n in counts.items() if t.startswith(".")), key=lambda x: (-len(x[0]), x[0])):
        below = [t for t in stems if t.startswith(stem)]
        if n < STEM_GAIN * max((m for t, m in terms.items() if t.startswith(stem)), default=0):
            continue
        if any(stems[t] >= 0.95 * n for t in below):
            continue
        for t in below:
            del stems[t]
        stems[stem] = n
    return sorted(t for t in terms if not any(t.startswith(x) for x in stems)), sorted(stems)


def _terms():
    """Per task: how many toxic and other rows have each word and stem."""
    def run(batches):
        toxic, other = Counter(), Counter()
        for batch in batches:
            for text, label in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                words = words_of(text or "")
                # No word has a full stop in front, so it marks stems.
                own = words.union(*({"." + w[:n] for w in words if len(w) >= n} for n in STEM_LENGTHS))
                (toxic if label else other).update(own)
            if len(toxic) + len(other) > 500_000:
                yield made(toxic, other)
                toxic, other = Counter(), Counter()
        yield made(toxic, other)

    def made(toxic, other):
        names = list(toxic | other)
        return pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array([toxic[n] for n in names], pa.int64()), pa.array([other[n] for n in names], pa.int64())], names=["term", "toxic", "other"])
    return run


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", train_rows: int = TRAIN_ROWS, lexicon_size: int = LEXICON_SIZE) -> ToxicityModel:
    """A model from labelled rows that are not held out; without any, or with one class only, every text scores that class's share."""
    train = stage(training_rows(docs, labels, id_col, text_col, train_rows), "toxicity-train")
    counted = train.mapInArrow(_terms(), "term string, toxic long, other long").groupBy("term").agg(F.sum("toxic").alias("toxic"), F.sum("other").alias("other"))
    n, z = F.col("toxic") + F.col("other"), DEVIATIONS
    share = F.col("toxic") / n
    lower = (share + z * z / (2 * n) - z * F.sqrt(share * (1 - share) / n + z * z / (4 * n * n))) / (1 + z * z / n)
    strong = counted.where(lower >= LEAST_SHARE).orderBy(F.desc("toxic"), "other", "term").limit(lexicon_size).collect()
    terms, stems = choose_lexicon({r["term"]: r["toxic"] for r in strong})
    model = ToxicityModel(terms, stems, [0.0] * N_FEATURES, 0.0)
    model.name = f"{zlib.crc32(repr((model.terms, model.stems)).encode()):08x}"

    def measure(batches):
        matcher = model.matcher()
        for batch in batches:
            rows = [features(t or "", matcher).tolist() for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(rows, pa.list_(pa.float64())), batch.column(1)], names=["x", "toxic"])

    # At most train_rows rows of a few numbers.
    rows = train.mapInArrow(measure, "x array<double>, toxic int").collect()
    y = np.array([r["toxic"] for r in rows], float)
    if not len(y) or y.min() == y.max():
        rate = (y.sum() + 0.5) / (len(y) + 1)
        model.bias = math.log(rate / (1 - rate)) if len(y) else math.log(0.1 / 0.9)
        return model
    order = np.lexsort(np.array([r["x"] for r in rows]).T)  # the sum does not depend on the order of tasks
    weights, model.bias = fit_logistic(np.array([r["x"] for r in rows])[order], y[order])
    model.weights = weights.tolist()
    return model


def toxicity_score(text: Column, model: ToxicityModel) -> Column:
    """Score of each text, 0 to 1; a null text scores as an empty one."""
    @pandas_udf("double")
    def score(texts):
        matcher = model.matcher()
        return texts.map(lambda t: model.score(t if isinstance(t, str) else "", matcher)).astype(float)

    return score(text)


def score_documents(docs: DataFrame, model: ToxicityModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, held_out, score and predicted (1 from 0.5 on).

    Nothing but the text enters the score. A null id is held out by the rule for its missing text (false). Repeated rows score alike; an empty table gives an empty result.
    """
    doc_id = F.col(f"`{id_col}`").cast("long")
    rows = docs.select(doc_id.alias("doc_id"), F.coalesce(held_out(doc_id), F.lit(False)).alias("held_out"), toxicity_score(F.col(f"`{text_col}`"), model).alias("score"))
    return rows.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
