"""Toxicity, license scan and the pipeline."""

import random
import zlib
from collections import Counter

import pytest

import corpus_pipeline
from liftplan.llm import license_scan, toxicity
from liftplan.llm.shared import stage
from tests.llm.brute import LETTERED, document_rows, documents, jaccard_components, lower, shingles

ROWS = document_rows()
BAD = ("grumble", "blather", "vexation")


def labelled(n=600):
    rng = random.Random(11)
    rows, labels = [], []
    for i in range(n):
        words = [f"w{rng.randint(0, 300)}" for _ in range(rng.randint(10, 60))]
        toxic = i % 4 == 0
        if toxic:
            for _ in range(3):
                words.insert(rng.randrange(len(words)), rng.choice([*BAD, "zorb" + rng.choice(["ung", "heit", "lich", "ei"])]))
        rows.append((i, " ".join(words), "en", "a", 0))
        labels.append((i, 1, int(toxic)))
    return rows, labels


@pytest.fixture(scope="module")
def model(spark):
    rows, labels = labelled()
    return toxicity.fit(documents(spark, rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))


def test_lexicon_and_held_out_accuracy(spark, model):
    rows, labels = labelled()
    assert set(BAD) <= set(model.terms) and any(s.startswith("zorb") for s in model.stems)
    truth = {i: t for i, _, t in labels}
    scored = toxicity.score_documents(documents(spark, rows), model).collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in scored)
    tested = [r for r in scored if r["held_out"]]
    assert sum(r["predicted"] == truth[r["doc_id"]] for r in tested) / len(tested) > 0.97


def test_held_out_labels_are_not_learned(spark, model):
    rows, labels = labelled()
    turned = [(i, q, 1 - t if zlib.crc32(str(i).encode()) % 5 == 0 else t) for i, q, t in labels]
    again = toxicity.fit(documents(spark, rows), spark.createDataFrame(turned, "doc_id long, quality int, toxic int"))
    assert (again.terms, again.stems, again.weights, again.bias) == (model.terms, model.stems, model.weights, model.bias)


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(new[-1] + 1, row[j] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def test_automaton_finds_what_edit_distance_says():
    terms, stems = ["grumble", "scum", "blather", "trash"], ["lowei", "veju"]
    matcher, rng = toxicity.Matcher(terms, stems), random.Random(3)
    for _ in range(3000):
        word = list(rng.choice(terms + stems))
        for _ in range(rng.randint(0, 2)):
            at = rng.randrange(len(word) + 1)
            word[at:at + rng.randint(0, 1)] = rng.choice(["", "x", "e", "l"])
        word = "".join(word) + rng.choice(["", "", "ung", "s"])
        most = lambda t: int(len(word) >= 5 and len(t) >= 5)
        found = [d for d, t in [(edits(word, t), t) for t in terms] if d <= most(t)] + [
            d for d, s in [(min(edits(word[:n], s) for n in range(len(word) + 1)), s) for s in stems] if d <= most(s)]
        kind, d = matcher.match(word)
        assert (kind > 0) == bool(found) and (not found or d == min(found)), word


def test_quotation_counts_less_than_abuse():
    matcher = toxicity.Matcher(["grumble"], [])
    meant = toxicity.features("you are such a grumble and nothing else here", matcher)
    quoted = toxicity.features('he said the word " grumble " was reported in the news', matcher)
    assert meant[3] > quoted[3] and quoted[4] > meant[4]


def test_scores_of_odd_texts(spark, model):
    got = toxicity.score_documents(documents(spark), model).collect()
    assert Counter(r["doc_id"] for r in got) == Counter(r[0] for r in ROWS)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) and r["held_out"] is not None for r in got)
    assert toxicity.score_documents(documents(spark, []), model).count() == 0


def test_fit_without_labels(spark):
    none = toxicity.fit(documents(spark), spark.createDataFrame([], "doc_id long, quality int, toxic int"))
    assert toxicity.score_documents(documents(spark), none).where("predicted = 1").count() == 0


LICENSED = [(1, "This is under the GNU General Public License, version 3.", "en", "a", 0), (2, "MIT License mit LICENSE apache\tlicense", "en", "a", 0),
            (3, "cc by-nc 4.0", "en", "a", 0), (4, "gnu general license", "en", "a", 0), (5, "ccby, c c by", "en", "a", 0), (5, "ccby, c c by", "en", "a", 0),
            (6, "x " * 5000 + "released under the mit license", "en", "a", 0), (7, "Émit license", "en", "a", 0),
            (8, "Redistribution and use in source and binary forms, with or without any modification, are permitted provided that following conditions are met", "en", "a", 0),
            (9, "permission is hereby granted to nobody at all", "en", "a", 0)]


def test_license_scan(spark):
    rows = [*ROWS, *LICENSED]
    made = license_scan.license_scan(documents(spark, rows)).collect()
    expected = Counter()
    for r in rows:
        words, at, labels = LETTERED.findall(lower(r[1])), [], set()
        for label, phrase in license_scan.PHRASES:
            phrase = phrase.split()
            for i in range(len(words) - len(phrase) + 1):
                if words[i:i + len(phrase)] == phrase:
                    at.append(i)
                    labels.add(label)
        expected[(r[0], len(words), len(at), min(at, default=None), max(at, default=None), ",".join(sorted(labels)))] += 1
    assert Counter(tuple(r)[:6] for r in made) == expected
    labels = {r["doc_id"]: r["labels"] for r in made}
    assert labels[1] == "gpl,gpl-3.0" and labels[8] == "bsd" and labels[9] == "" and labels[6] == "mit"
    assert all(set(filter(None, r["base_labels"].split(","))) <= set(r["labels"].split(",")) and 0 <= r["score"] <= 1 for r in made)
    assert license_scan.license_scan(documents(spark, [])).count() == 0


def test_changed_notices_keep_their_labels(spark):
    rng = random.Random(2)
    say = lambda k: [f"v{rng.randint(0, 500)}" for _ in range(k)]
    around = lambda words: " ".join([*say(300), *words, *say(300)])
    notices = [(label, text.split()) for label, text in license_scan.TEMPLATES if len(text.split()) > license_scan.WHOLE_WORDS]
    cases = []
    for label, words in notices:
        n, half = len(words), len(words) // 2
        cases += [(label, [w if i % 7 != 6 else "other" for i, w in enumerate(words)]), (label, [w if i % 4 != 3 else "other" for i, w in enumerate(words)]),
                  (label, [w for i, w in enumerate(words) if i % 4 != 3])]
        cases += [(label, [*words[:half], *say(k), *words[half:]]) for k in (4, n // 2, n)]
        cases += [("", [w if i % 2 else "other" for i, w in enumerate(words)])]
    cases += [("all-rights-reserved", "copyright 2020 all rights reserved by them".split()), ("", "all rights are reserved".split()[:3])]
    made = license_scan.license_scan(documents(spark, [(i, around(w), "en", "a", 0) for i, (_, w) in enumerate(cases)])).collect()
    got = {r["doc_id"]: r["labels"] for r in made}
    assert [(i, label) for i, (label, _) in enumerate(cases) if label not in got[i].split(",")] == []
    twice = [*notices[0][1], *say(5), *notices[0][1]]
    spans = license_scan.license_scan(documents(spark, [(1, around(twice), "en", "a", 0)])).first()["spans"]
    n = len(notices[0][1])
    assert sorted((s["begin"], s["end"]) for s in spans if s["label"] == notices[0][0]) == [(300, 300 + n), (305 + n, 305 + 2 * n)]


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    """A folder with documents, labels and a benchmark."""
    folder = str(tmp_path_factory.mktemp("corpus"))
    rows, labels = labelled()
    rows = [(r[0] + 2000, *r[1:]) for r in rows]
    documents(spark, [*ROWS, *rows], extra=False).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(i + 2000, q, t) for i, q, t in labels], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(1, " ".join((rows[5][1] or "").split()[:30]))], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder


def test_pipeline_stages(spark, corpus):
    docs = spark.read.parquet(f"{corpus}/documents.parquet")
    seen = {}
    for name, function in corpus_pipeline.STAGES:
        made = function(spark, docs, corpus)
        if name != "sharding":
            assert made.columns == docs.columns
        made = stage(made, "test-pipeline")
        seen[name] = [tuple(r) for r in made.collect()]
        docs = made
    bad = lambda t: sum(any(w == b or w.startswith("zorb") for b in BAD) for w in (t or "").split())
    assert not any(bad(r[1]) for r in seen["toxicity"]) and len(seen["toxicity"]) == len(ROWS) + 450
    groups = {i if n == 0 else min(m) for i, (n, m) in enumerate(jaccard_components(seen["toxicity"]))}
    assert len(seen["ngram_jaccard"]) == len(groups)
    item = shingles(" ".join(labelled()[0][5][1].split()[:30]))
    clean = [r for r in seen["ngram_jaccard"] if 100 * len(item & shingles(r[1])) < 75 * len(item)]
    assert Counter(seen["decontamination"]) == Counter(clean) and len(clean) < len(seen["ngram_jaccard"])
    assert set(seen["mixing"]) <= set(clean) and max(Counter(seen["mixing"]).values()) <= 3
    assert Counter(r[:5] for r in seen["sharding"]) == Counter(seen["mixing"])
    assert {r[6] for r in seen["sharding"]} == set(range(corpus_pipeline.SHARDS))


def test_pipeline_run_and_empty(spark, corpus, tmp_path):
    assert corpus_pipeline.run(spark, corpus).count() == corpus_pipeline.query(spark, corpus).count()
    folder = str(tmp_path)
    for name, schema in (("documents", "doc_id long, text string, lang string, source string, n_chars long"), ("labels", "doc_id long, quality int, toxic int"), ("benchmark", "item_id long, text string")):
        spark.createDataFrame([], schema).write.parquet(f"{folder}/{name}.parquet")
    assert corpus_pipeline.run(spark, folder).count() == 0
