"""License scan by diagonal voting.

Every rolling word k-gram of a text is joined, by hash, to the places of the same k-gram in license templates. A match votes for the
diagonal text place - template place, and votes are counted per text, template and diagonal. Diagonals next to each other
(words put in or left out) are merged into spans; spans with enough votes are verified against the words of the text.

A notice of n words may lack or replace a share of them. So many changed words leave a number of its 2-grams, and that number is
what must vote, on diagonals that may lie up to n apart: every notice with at most so many departures (a word changed or left out, or a run put
in), that all in all move its words by n places at most, reaches the verification.
"""

from __future__ import annotations

from difflib import SequenceMatcher

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from liftplan.llm.shared import bit_of, filled_bits, stage
from liftplan.llm.words import ALPHANUMERIC, Words, as_bytes, spans, windows

#: Phrases that make a label wherever their words stand consecutively. Fixed values.
PHRASES = (
    ("gpl", "gnu general public license"),
    ("apache", "apache license"),
    ("cc-by", "cc by"),
    ("mit", "mit license"),
)
#: Notices and grants with labels of their own; a text may depart from them by some words.
TEMPLATES = (
    ("gpl-2.0", "gnu general public license version 2"),
    ("gpl-3.0", "gnu general public license version 3"),
    ("lgpl", "gnu lesser general public license"),
    ("agpl", "gnu affero general public license"),
    ("apache-2.0", "licensed under the apache license version 2 0"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("cc-by-sa", "licensed under cc by sa 4 0"),
    ("cc-by-nc", "creative commons attribution noncommercial 4 0 international license"),
    ("cc-by", "creative commons attribution 4 0 international license"),
    ("mit", "released under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software "
            "to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense "
            "and or sell copies of the software"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above "
            "copyright notice and this permission notice appear in all copies"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by "
            "the free software foundation"),
    ("apache-2.0", "you may not use this file except in compliance with the license you may obtain a copy of the license at"),
    ("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
    ("all-rights-reserved", "all rights reserved"),
    ("all-rights-reserved", "all rights reserved no part of this publication may be reproduced"),
)
#: Lengths of k-grams: notices with room for changed words and names of two or three words take the first, everything else the second.
SHORT, LONG = 2, 4
#: Diagonals of a name this close belong to one span.
NEIGHBOURS = 3
#: Share of a name's k-grams that must vote, and of a notice's words that must stand in the span in their order.
LEAST_VOTES, LEAST_WORDS = 0.5, 0.75
#: Templates of up to so many words (names and version numbers) must stand in full.
WHOLE_WORDS = 12
#: k-grams of different lengths have different hashes.
_SALT = {SHORT: 0x5D1C3A0F9B27E641, LONG: 0x2E96A0C4D17B835F}


def _grams(words: Words, hashes: np.ndarray, k: int) -> np.ndarray:
    return (windows(hashes, k) ^ np.uint64(_SALT[k])).view(np.int64)


def missing_words(n_words: int) -> int:
    """Words of a template that may be missing."""
    return 0 if n_words <= WHOLE_WORDS else n_words - int(np.ceil(LEAST_WORDS * n_words))


class Template:
    """Words of a phrase or notice, and its k-grams with their places."""

    def __init__(self, number: int, label: str, text: str, exact: bool):
        block = Words([text.encode()], ALPHANUMERIC, lower=True)
        self.number, self.label, self.exact = number, label, exact
        self.words = [block.word(i) for i in range(len(block))]
        if len(self.words) < SHORT:
            raise ValueError(f"a template has {SHORT} words at least: {text!r}")
        #: A notice with room for changed words: its votes are counted over diagonals up to its length apart.
        self.loose = not exact and len(self.words) > WHOLE_WORDS
        self.k = SHORT if self.loose or len(self.words) < LONG else LONG
        self.grams = _grams(block, block.hashes(), self.k).tolist()
        if self.loose:
            self.least = max(1, len(self.grams) - self.k * missing_words(len(self.words)))
        else:
            self.least = len(self.grams) if exact else max(1, int(np.ceil(LEAST_VOTES * len(self.grams))))


def templates(phrases=PHRASES, more=TEMPLATES) -> list[Template]:
    listed = [(label, text, True) for label, text in phrases] + [(label, text, False) for label, text in more]
    return [Template(i, *x) for i, x in enumerate(listed)]


def _roll():
    """Per text its k-grams of both lengths; the place of a k-gram is its index."""
    def run(batches):
        for batch in batches:
            keys, ties, texts = batch.column(0), batch.column(1), as_bytes(batch.column(2))
            for a, b in spans(texts):
                words = Words(texts[a:b], ALPHANUMERIC, lower=True)
                h = words.hashes()
                columns = []
                for k in (SHORT, LONG):
                    grams = _grams(words, h, k)
                    n = np.maximum(np.diff(words.first) - k + 1, 0)
                    offsets = np.zeros(len(n) + 1, np.int32)
                    np.cumsum(n, out=offsets[1:])
                    inside = words.doc[:len(grams)] == words.doc[k - 1:k - 1 + len(grams)]
                    columns.append(pa.ListArray.from_arrays(pa.array(offsets), pa.array(grams[inside])))
                yield pa.RecordBatch.from_arrays([keys.slice(a, b - a), ties.slice(a, b - a), *columns], names=["doc_id", "tie", "short", "long"])
    return run


def _votes(rows: DataFrame, spark: SparkSession, known: list[Template]) -> DataFrame:
    """Spans (doc_id, tie, template, begin, end, votes) with enough votes."""
    places = spark.createDataFrame([(g, t.number, i) for t in known for i, g in enumerate(t.grams)], "gram long, template int, place int")
    about = spark.createDataFrame([(t.number, t.least, t.k, 0 if t.exact else NEIGHBOURS, t.loose, len(t.words)) for t in known],
                                  "template int, least int, k int, near int, loose boolean, n int")
    rolled = rows.select("doc_id", "tie", "text").mapInArrow(_roll(), "doc_id long, tie long, short array<long>, long array<long>")
    exploded = [rolled.select("doc_id", "tie", F.posexplode(c).alias("pos", "gram")) for c in ("short", "long")]
    # Templates are a parameter: a few thousand places at most, sent to every task.
    met = exploded[0].union(exploded[1]).join(F.broadcast(places), "gram")
    # A repeated row votes once.
    votes = met.select("doc_id", "tie", "template", (F.col("pos") - F.col("place")).alias("diagonal"), "pos").distinct()
    per_diagonal = votes.groupBy("doc_id", "tie", "template", "diagonal").agg(F.count("*").alias("votes"), F.min("pos").alias("low"), F.max("pos").alias("high"))
    of_text = Window.partitionBy("doc_id", "tie", "template").orderBy("diagonal")
    far = F.col("diagonal") - F.lag("diagonal").over(of_text) > F.col("near")
    span = F.sum(F.when(far, 1).otherwise(0)).over(of_text.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    each = per_diagonal.join(F.broadcast(about), "template")
    chained = each.where("not loose").withColumn("span", span)
    # Two neighbouring stretches of n diagonals hold any diagonals that are up to n apart.
    stretch = F.floor(F.col("diagonal") / F.col("n"))
    stretched = each.where("loose").withColumn("span", F.explode(F.array(stretch, stretch - 1)))
    merged = chained.unionByName(stretched)
    found = merged.groupBy("doc_id", "tie", "template", "span").agg(
        F.sum("votes").alias("votes"), F.min("low").alias("begin"), (F.max("high") + F.max("k")).alias("end"), F.max("least").alias("least"))
    return found.where("votes >= least").select("doc_id", "tie", "template", "begin", "end", "votes")


def _thin(wanted):
    """n_words of each text, and the text itself only where its bit says that it may have spans."""
    def run(batches):
        filled = wanted.value
        for batch in batches:
            texts = as_bytes(batch.column(2))
            n = np.concatenate([np.diff(Words(texts[a:b], ALPHANUMERIC, lower=True).first) for a, b in spans(texts)]) if texts else np.zeros(0, np.int64)
            ties = batch.column(1).to_pylist()
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(n, pa.int64()), pa.array([t if bit_of(filled, tie) else None for t, tie in zip(texts, ties, strict=True)], pa.binary())],
                                             names=["doc_id", "tie", "n_words", "text"])
    return run


_OUT_SQL = ("doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, "
            "spans array<struct<label:string,begin:long,end:long,similarity:double>>")


def _verify(known: list[Template]):
    span = pa.struct([("label", pa.string()), ("begin", pa.int64()), ("end", pa.int64()), ("similarity", pa.float64())])
    schema = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_base", pa.int64()), ("first_word", pa.int64()), ("last_word", pa.int64()),
                        ("base_labels", pa.string()), ("labels", pa.string()), ("score", pa.float64()), ("spans", pa.list_(span))])

    def judge(text: bytes, hits: list[dict]) -> tuple[set, list[dict]]:
        """Starts of phrases, and verified spans."""
        block = Words([text], ALPHANUMERIC, lower=True)
        words = [block.word(i) for i in range(len(block))]
        base, out, seen = set(), [], {}
        for hit in sorted(hits, key=lambda h: (h["template"], h["begin"])):
            t = known[hit["template"]]
            if t.exact:
                at = hit["begin"]
                if words[at:at + len(t.words)] == t.words:
                    base.add((at, t.label))
                    out.append({"label": t.label, "begin": at, "end": at + len(t.words), "similarity": 1.0})
                continue
            # Words that the votes do not reach at either end of the template may stand around the span.
            n = len(t.words)
            parts = [(max(0, hit["begin"] - n), min(len(words), hit["end"] + n))]
            while parts:
                begin, end = parts.pop()
                if end - begin < n - missing_words(n):
                    continue
                blocks = SequenceMatcher(None, words[begin:end], t.words, autojunk=False).get_matching_blocks()
                real = [b for b in blocks if b.size]
                if sum(b.size for b in real) < n - missing_words(n):
                    continue
                first, last = begin + real[0].a, begin + real[-1].a + real[-1].size
                seen.setdefault(t.number, []).append((-sum(b.size for b in real) / n, first, last))
                # A second notice of the same kind may stand beside it.
                parts += [(begin, first), (last, end)] if t.loose else []
        for number, spans_of in seen.items():
            # Windows overlap: of spans that do, the most similar one stays.
            taken = []
            for share, first, last in sorted(set(spans_of)):
                if all(last <= a or first >= b for a, b in taken):
                    taken.append((first, last))
                    out.append({"label": known[number].label, "begin": first, "end": last, "similarity": -share})
        return base, out

    def run(batches):
        for batch in batches:
            rows = []
            for doc_id, n, text, hits in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                base, out = judge(text, hits) if hits else (set(), [])
                at = [a for a, _ in base]
                rows.append((doc_id, n, len(base), min(at, default=None), max(at, default=None), ",".join(sorted({x for _, x in base})),
                             ",".join(sorted({s["label"] for s in out})), max((s["similarity"] for s in out), default=0.0), out))
            columns = list(zip(*rows, strict=True)) or [()] * len(schema)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, schema.types, strict=True)], schema=schema)
    return run


def license_scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", phrases=PHRASES, more=TEMPLATES) -> DataFrame:
    """One row per input row: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score and spans.

    Base are the places of ``phrases``, their count, smallest and largest start (words from 0) and labels. ``labels`` adds those of verified spans of ``more``; both are
    distinct, sorted and joined by commas, empty if there is none. ``score`` is the largest share of a template's words found (1 for a phrase, 0 for none). Null text counts
    as empty. Null ids and repeated rows are kept as they are. An empty table gives an empty result; other columns are not read.
    """
    spark, known = docs.sparkSession, templates(phrases, more)
    text = F.col(f"`{text_col}`")
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.xxhash64(text, F.col(f"`{id_col}`").cast("long")).alias("tie"), text.alias("text"))
    # The votes are counted once and read twice: for the bitmap and for the join.
    found = stage(_votes(rows, spark, known), "license-spans")
    wanted = spark.sparkContext.broadcast(filled_bits(found.select("tie")))
    # All spans of a text: no more than it has words.
    hits = found.groupBy("tie").agg(F.collect_list(F.struct("template", "begin", "end")).alias("hits"))
    thin = rows.mapInArrow(_thin(wanted), "doc_id long, tie long, n_words long, text binary")
    return thin.join(hits, "tie", "left").select("doc_id", "n_words", "text", "hits").mapInArrow(_verify(known), _OUT_SQL)
