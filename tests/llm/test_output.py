"""Token file, sharding, mixing and WARC against plain Python."""

import base64
import hashlib
import io
import sys
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from liftplan.llm import mixing, ngram_join, sharding, token_file, warc
from liftplan.session import scratch_path
from tests.llm.brute import SPACED, document_rows, documents

ROWS = document_rows()
VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def tokenizer():
    made = Tokenizer.from_file(VOCABULARY)
    made.encode_special_tokens = True
    return made


@pytest.mark.parametrize("n", [0, 1, 4095, 4096, 4097, 20_000])
def test_planes_round_trip(n):
    ids = (np.arange(n, dtype=np.uint64) * 2_654_435_761 % (1 << 32)).astype(np.uint32)
    planes = token_file.to_planes(ids)
    assert [len(p) for p in planes] == [n] * 4 and (token_file.from_planes(planes) == ids).all()


def test_pieces_encode_as_whole_texts(tokenizer):
    rng = np.random.Generator(np.random.PCG64(4))
    parts = ["a", "Word", " ", " ", "  ", "\n", ".", ",", "'s", "é", "日本", "7", "\t", "\u0085", " ", "’", "<|endoftext|>", "..", "\r"]
    cases = ["".join(parts[i] for i in rng.integers(0, len(parts), 25)) for _ in range(1500)]
    cases += [r[1] or "" for r in ROWS]
    for cache in (0, 1 << 20):
        encoder = token_file.PieceEncoder(VOCABULARY, cache)
        got = encoder.encode([c.encode() for c in cases])
        assert [g.tolist() for g in got] == [e.ids for e in tokenizer.encode_batch(cases, add_special_tokens=False)]


def test_encoder_works_per_distinct_piece(tokenizer):
    rng = np.random.Generator(np.random.PCG64(6))
    words = [f"{a}{b}{c}" for a in "Talon" for b in "rim" for c in ("", "eth", "ando", "is")]
    lines = [" ".join(words[i] for i in rng.integers(0, len(words), 3)) + end for end in rng.choice([".", ",", ""], 12_000)]
    texts = ["\n".join(lines[i:i + 40]) for i in range(0, len(lines), 40)]
    encoder, calls = token_file.PieceEncoder(VOCABULARY), 0

    def count(_frame, event, _arg):
        nonlocal calls
        calls += event == "call"

    sys.setprofile(count)
    try:
        got = encoder.encode([t.encode() for t in texts])
    finally:
        sys.setprofile(None)
    assert [g.tolist() for g in got] == [e.ids for e in tokenizer.encode_batch(texts, add_special_tokens=False)]
    # The lines begin and end with a few words; no Python function runs for each line or place.
    assert calls < len(lines) / 2


def test_texts_of_a_call_do_not_touch(tokenizer):
    edges = ["", " ", "  ", "\n", ".", ",", "a", "é", "日", "\u00a0", "a ", " a", "a\n", "\na", "a.", ".a", "é ", "\né", " .", "a\n\n", "'s", "'"]
    cases = [c for left in edges for right in edges for c in (left, right)]
    expected = [e.ids for e in tokenizer.encode_batch(cases, add_special_tokens=False)]
    for cache in (0, 1 << 20):
        encoder = token_file.PieceEncoder(VOCABULARY, cache)
        for _ in range(2):
            assert [g.tolist() for g in encoder.encode([c.encode() for c in cases])] == expected
    assert [g.tolist() for g in encoder.encode([b""] * 3)] == [[]] * 3 and encoder.encode([]) == []


def test_token_file(spark, tokenizer):
    path = scratch_path(spark, "test-tokens")
    token_file.write_tokens(documents(spark), path, VOCABULARY, end_id=2, block=64, chunk_ids=500)
    got = sorted((r["start"], r["doc_id"], r["n_tokens"], list(r["ids"])) for r in token_file.read_tokens(spark, path).collect())
    at = 0
    for start, _, n, ids in got:
        assert start == at and n == len(ids) and ids[-1] == 2
        at += n
    order = [g[1] for g in got]
    assert order == sorted(order, key=lambda i: (i is not None, i))
    expected = Counter((r[0], tuple([*tokenizer.encode(r[1] or "", add_special_tokens=False).ids, 2])) for r in ROWS)
    assert Counter((g[1], tuple(g[3])) for g in got) == expected
    digests = {(r["start"], r["ids_crc32"]) for r in token_file.read_tokens(spark, path, digest=True).collect()}
    assert digests == {(g[0], zlib.crc32(np.array(g[3], "<u4").tobytes())) for g in got}


def test_special_tokens_keep_their_ids(spark):
    loaded = Tokenizer.from_file(VOCABULARY)
    end = "<|endoftext|>"
    cases = ["one two<|endoftext|> three", end, f"{end}{end}", f" {end} ", f"a. {end}\nb{end}.", f"a\n{end}\n\nb", f"{end}, é  {end}.", "<|endoftext", "a <|endoftext|x|>", "<| endoftext|>"]
    parts = ["a", "Word", " ", "  ", "\n", ".", ",", "'s", "é", "日本", "\t", end, "<|", "|>"]
    rng = np.random.Generator(np.random.PCG64(8))
    cases += ["".join(parts[i] for i in rng.integers(0, len(parts), 20)) for _ in range(800)]
    expected = [e.ids for e in loaded.encode_batch(cases, add_special_tokens=False)]
    assert expected[0] == [505, 734, 50256, 1115]
    for cache in (0, 1 << 20):
        got = token_file.PieceEncoder(VOCABULARY, cache, special_as_text=False).encode([c.encode() for c in cases])
        assert [g.tolist() for g in got] == expected
    path = scratch_path(spark, "test-tokens")
    token_file.write_tokens(documents(spark, [(i, c, "en", "a", 0) for i, c in enumerate(cases)]), path, VOCABULARY, end_id=2)
    assert {r["doc_id"]: list(r["ids"]) for r in token_file.read_tokens(spark, path).collect()} == {i: [*e, 2] for i, e in enumerate(expected)}


def test_token_file_of_no_documents(spark):
    path = scratch_path(spark, "test-tokens")
    token_file.write_tokens(documents(spark, []), path, VOCABULARY, end_id=2)
    assert token_file.read_tokens(spark, path).count() == 0


def test_shards(spark):
    path = scratch_path(spark, "test-slots")
    rows = sharding.shard_documents(documents(spark), path, 4, n_slots=64).collect()
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in rows) == Counter((r[0], len((r[1] or "").encode()) + 1, zlib.crc32((r[1] or "").encode())) for r in ROWS)
    places = defaultdict(list)
    for r in rows:
        places[r["shard"]].append(r["place"])
    assert all(sorted(p) == list(range(len(p))) for p in places.values())
    slots = {r["virtual_slot"]: r for r in sharding.read_map(spark, path, 1).collect()}
    assert sorted(slots) == list(range(64))
    loads = Counter()
    for s in slots.values():
        loads[s["shard"]] += s["bytes"]
    assert max(loads.values()) - min(loads.values()) <= max(s["bytes"] for s in slots.values())
    assert sum(loads.values()) == sum(r["size"] for r in rows)


def test_map_edits_move_few_bytes(spark):
    stats = spark.range(256).selectExpr("cast(id as int) AS virtual_slot", "100 + id % 7 AS bytes", "1L AS n_rows")
    path = scratch_path(spark, "test-slots")
    assert sharding.save_map(spark, path, stats, 8) == 1
    assert sharding.save_map(spark, path, stats, 9, version=1) == 2
    old, new = ({r["virtual_slot"]: (r["shard"], r["bytes"]) for r in sharding.read_map(spark, path, v).collect()} for v in (1, 2))
    loads = Counter()
    for shard, size in new.values():
        loads[shard] += size
    assert set(loads) == set(range(9)) and max(loads.values()) - min(loads.values()) <= 220
    moved = sum(size for slot, (shard, size) in new.items() if old[slot][0] != shard)
    assert moved <= 1.3 * sum(loads.values()) / 9
    assert sharding.save_map(spark, path, stats, 4, version=2) == 3
    assert {r["shard"] for r in sharding.read_map(spark, path, 3).collect()} == {0, 1, 2, 3}


def test_shards_of_no_documents_and_rows_with_shards(spark):
    assert sharding.shard_documents(documents(spark, []), scratch_path(spark, "test-slots"), 4, n_slots=16).count() == 0
    made = sharding.with_shards(documents(spark), scratch_path(spark, "test-slots"), 4, n_slots=16)
    assert Counter(tuple(r)[:5] for r in made.collect()) == Counter(ROWS)
    assert made.columns.count("shard") == 1


def mix_in_sql(rows):
    import pandas as pd

    con = duckdb.connect()
    con.register("given", pd.DataFrame({"doc_id": pd.array([r[0] for r in rows], dtype="Int64"), "text": [r[1] for r in rows], "source": [r[3] for r in rows]}))
    con.execute("CREATE TABLE documents AS SELECT doc_id::BIGINT AS doc_id, text::VARCHAR AS text, source::VARCHAR AS source FROM given")
    return con.execute(mixing.oracle()).fetchall()


def test_mix(spark):
    made = mixing.mix_sources(documents(spark), buckets=16)
    got = bag_of(made.select("doc_id", "size", "source_size", "target", "taken"))
    assert got == bag_of_rows(mix_in_sql(ROWS))
    again = bag_of(mixing.mix_sources(documents(spark).repartition(7), buckets=64).select("doc_id", "size", "source_size", "target", "taken"))
    assert got == again
    rows = made.collect()
    assert Counter((r["doc_id"], r["size"]) for r in rows) == Counter((r[0], len(SPACED.findall(r[1] or ""))) for r in ROWS)
    assert all(r["taken"] == r["size"] * r["copies"] <= 3 * r["size"] for r in rows)
    by_source = defaultdict(list)
    for r in rows:
        by_source[r["source"]].append(r)
    for own in by_source.values():
        assert own[0]["target"] <= 3 * own[0]["source_size"]
        assert abs(sum(r["taken"] for r in own) - own[0]["target"]) <= max(r["size"] for r in own) / 2 + 1
    assert abs(sum(own[0]["target"] for own in by_source.values()) - sum(r["size"] for r in rows)) < 1e-6 * sum(r["size"] for r in rows)


def bag_of(df):
    return bag_of_rows(tuple(r) for r in df.collect())


def bag_of_rows(rows):
    return Counter(tuple(round(v, 6) if isinstance(v, float) else v for v in r) for r in rows)


def test_mix_takes_the_rows_themselves(spark):
    wanted = Counter()
    for r in mixing.mix_sources(documents(spark)).collect():
        wanted[(r["doc_id"], r["source"])] += r["copies"]
    taken = mixing.take_mix(documents(spark))
    assert taken.columns == documents(spark).columns
    got = Counter((r["doc_id"], r["source"]) for r in taken.collect())
    differ = {k for k in wanted if wanted[k] != got.get(k, 0)}
    assert all(sum(1 for r in ROWS if r[0] == k[0]) > 1 for k in differ)  # only repeated rows at the last place


def test_favoured_documents_come_first(spark):
    rows = [(i, "a b c", "en", "x" if i < 200 else "y", 5) for i in range(400)]
    docs = documents(spark, rows).selectExpr("*", "if(doc_id % 2 = 0, 20.0, 0.05) AS liked")
    made = mixing.mix_sources(docs, favour_col="liked", weights=(1, 3)).where("source = 'x'").collect()
    taken = [r for r in made if r["copies"]]
    assert abs(sum(r["taken"] for r in made) - made[0]["target"]) <= 3
    assert sum(r["doc_id"] % 2 == 0 for r in taken) > 0.8 * len(taken)


def test_inclusion_follows_the_size(spark):
    """Over many documents the share that is taken once more is each size's probability; larger documents than that are certain."""
    sizes = [1, 4, 10, 25, 60]
    rows = [(i, "w " * sizes[i % 5], "en", "x", 5) for i in range(4000)] + [(9000 + i, "w " * (5000 - i), "en", "x", 5) for i in range(2)]
    rows += [(5000 + i, "w " * 90, "en", "y", 5) for i in range(2000)] + [(8000, None, "en", "x", 0)]
    taken, chance = {}, {}
    for seed in range(3):
        mixed = mixing._mixed(documents(spark, rows), "doc_id", "text", "source", None, (1, 1), 3, seed, 64).where("source = 'x'").collect()
        assert abs(sum(r["size"] * r["copies"] for r in mixed) - mixed[0]["target"]) <= 30
        for r in mixed:
            chance[r["size"]] = r["chance"]
            taken.setdefault(r["size"], []).append(r["more"])
    part = mixed[0]["part"]
    assert 0 < part < 1 and chance[0] == 0 and not any(taken[0]) and chance[5000] == chance[4999] == 1 and all(taken[5000] + taken[4999])
    assert [round(chance[k] / chance[1]) for k in sizes] == sizes and chance[60] < 1
    for k in sizes:
        n, p = len(taken[k]), chance[k]
        assert abs(sum(taken[k]) - n * p) <= 4.5 * (n * p * (1 - p)) ** 0.5 + 2
    expected = sum(chance[k] * k * 800 for k in sizes) + 9_999
    assert abs(expected - (mixed[0]["target"] - mixed[0]["whole"] * mixed[0]["source_size"])) < 1e-3 * expected


@pytest.mark.parametrize("rows", [[], [(1, None, "en", None, 0)], [(1, "", "en", "a", 0), (2, "x y", "en", "b", 0)]])
def test_mix_of_little(spark, rows):
    got = mixing.mix_sources(documents(spark, rows)).collect()
    assert len(got) == len(rows)
    assert bag_of_rows((r["doc_id"], r["size"], r["source_size"], r["target"], r["taken"]) for r in got) == bag_of_rows(mix_in_sql(rows)) if rows else True


PAGES = [(1, "http://a", "<p>x</p>"), (2, "http://b", "<p>x</p>"), (7, "http://c d\n", None), (8, None, ""), (3, "u", "日本" * 50_000), (3, "u", "日本" * 50_000),
         (None, "n", "<p>x</p>"), (None, "n", "only here"), (9, "gz", "\x1f\x8b\x08 WARC/1.1\r\n\r\nWARC/1.0")]


def page_table(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "'clash' AS record_type", "'clash' AS sha1", "'clash' AS owner")


@pytest.mark.parametrize("range_bytes", [40, 1000, 1 << 22])
def test_warc(spark, range_bytes):
    folder = scratch_path(spark, "test-warc")
    warc.write_warc(page_table(spark, PAGES), folder, archive_bytes=2000)
    rows = warc.read_warc(spark, folder, range_bytes).collect()
    owner = defaultdict(lambda: None)
    for i, _, html in PAGES:
        if i is not None:
            owner[html or ""] = max(i, owner[html or ""] or i)
    expected = Counter()
    for i, _, html in PAGES:
        body = (html or "").encode()
        revisit = owner[html or ""] is not None and i != owner[html or ""]
        expected[(i, len(body), base64.b32encode(hashlib.sha1(body).digest()).decode(), "revisit" if revisit else "response", owner[html or ""] if revisit else None)] += 1
    assert Counter((r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in rows) == expected
    assert all(bytes(r["payload"]).decode() in [p[2] or "" for p in PAGES] for r in rows if r["record_type"] == "response")


def test_warc_of_no_pages(spark):
    folder = scratch_path(spark, "test-warc")
    warc.write_warc(page_table(spark, []), folder)
    assert warc.read_warc(spark, folder).count() == 0


def test_ranges_are_read_by_many_tasks(spark):
    folder = scratch_path(spark, "test-warc")
    pages = [(i, f"http://{i}", f"<p>{i}</p>" * 200) for i in range(400)]
    warc.write_warc(page_table(spark, pages).repartition(3), folder)
    made = warc.read_warc(spark, folder, range_bytes=2000)
    used = made.groupBy(F.spark_partition_id()).count().collect()
    assert made.count() == 400 and len(used) > 8 and max(r["count"] for r in used) < 100


def test_damaged_member_is_an_error(spark, tmp_path):
    folder = f"file://{tmp_path}/warc"
    warc.write_warc(page_table(spark, [(i, "u", f"text {i}") for i in range(30)]).coalesce(1), folder)
    (archive,) = (tmp_path / "warc" / "archives").glob("*.warc.gz")
    data = bytearray(archive.read_bytes())
    second = bytes(data).find(warc.MAGIC, 10)
    data[second + 12:second + 60] = b"x" * 48
    archive.write_bytes(bytes(data))
    with pytest.raises(Exception, match="the manifest says"):
        warc.read_warc(spark, folder, 500).collect()


def test_archives_of_other_writers(spark, tmp_path):
    """No manifest, records without digest, records that are no responses, and members that are no records."""
    (tmp_path / "archives" / "deep").mkdir(parents=True)
    head = lambda kind, block, *more: "\r\n".join(["WARC/1.0", f"WARC-Type: {kind}", *more, f"Content-Length: {len(block)}"]).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"
    http = b"HTTP/1.1 200 OK\r\nContent-Length: 999\r\n\r\nhello"
    digest = base64.b32encode(hashlib.sha1(b"hello").digest()).decode()
    kind = "Content-Type: application/http; msgtype=response"
    members = [head("warcinfo", b"software: x"), head("request", b"GET / HTTP/1.1\r\n\r\n", "WARC-Target-URI: http://a"), head("response", http, "WARC-Target-URI: http://a", kind),
               b"no record", head("response", http, f"WARC-Payload-Digest: sha1:{digest}", kind), head("metadata", b"long " * 300_000)]
    data = b"".join(map(warc.member, members))
    (tmp_path / "archives" / "a.warc.gz").write_bytes(data)
    (tmp_path / "archives" / "deep" / "b.warc.gz").write_bytes(warc.member(members[2]))
    folder = f"file://{tmp_path}"
    got = warc.read_warc(spark, folder, 100, archives=warc.list_archives(spark, folder)).collect()
    seen = Counter((r["archive"], r["record_type"], r["url"], r["payload_digest"], bytes(r["payload"])[:5], r["payload_bytes"]) for r in got)
    assert seen == Counter({("a.warc.gz", "warcinfo", None, None, b"", 0): 1, ("a.warc.gz", "request", "http://a", None, b"", 0): 1,
                            ("a.warc.gz", "response", "http://a", None, b"hello", 5): 1, ("a.warc.gz", "response", None, digest, b"hello", 5): 1,
                            ("a.warc.gz", "metadata", None, None, b"", 0): 1, ("deep/b.warc.gz", "response", "http://a", None, b"hello", 5): 1})
    (tmp_path / "archives" / "a.warc.gz").write_bytes(warc.member(head("response", http, f"WARC-Payload-Digest: sha1:{digest[::-1]}", kind)))
    with pytest.raises(Exception, match="differs from its digest"):
        warc.read_warc(spark, folder, 100, archives=warc.list_archives(spark, folder)).collect()


def test_clashing_names_stay_as_they_are(spark):
    """Columns called as the operators' own helpers come back unchanged."""
    names = ["__own", "__slot", "__shard", "__source", "__whole", "__part", "__last", "__copy", "__class", "__group", "__least", "__alone", "__place"]
    rows = [(i, f"word{i} a b c d e f g h", "en", "x" if i % 2 else "y", 5) for i in range(40)] + [(50, "word1 a b c d e f g h", "en", "x", 5)]
    docs = documents(spark, rows)
    for name in names:
        docs = docs.withColumn(name, F.col("doc_id") * 10)
    for made in (mixing.take_mix(docs), sharding.with_shards(docs, scratch_path(spark, "test-map"), 3), ngram_join.keep_one(docs)):
        got = made.collect()
        assert got and all(r[n] == r["doc_id"] * 10 for r in got for n in names) and [c for c in made.columns if c in names] == names
    assert ngram_join.keep_one(docs).count() == 40


def test_false_magic_is_passed_over():
    class File(io.BytesIO):
        def read_at(self, n, at):
            self.seek(at)
            return self.read(n)

    good = warc.member(warc.record("response", 5, "u", b"body", "D", None))
    data = b"\x1f\x8b\x08junk" + good + warc.member(b"no record") + good[:30] + good
    found = list(warc.records_in(File(data), len(data), 0, len(data)))
    assert [f["offset"] for f in found] == [7, len(data) - len(good)]
