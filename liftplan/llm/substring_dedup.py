"""Substring de-duplication by super-k-mers.

A window is a run of 20 words of one text. Consecutive windows that share a minimiser (the smallest hash of their three-word runs) form
a super-k-mer, and its words travel as one string to the bucket of the minimiser: equal windows have equal minimisers, so all places of
a window meet in one bucket. There the strings are cut into windows again, windows are sorted, and every place of a window but the
first is marked. A block of a map task does the same with its own windows first and sends only the first place of each, so that a
passage costs a bucket one string per block, however many texts repeat it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from liftplan.llm.words import Words, as_bytes, mix, spans, windows

WINDOW = 20
MINIMISER = 3
BLOCK_BYTES = 8 << 20
#: Bytes of text per bucket, before the overlap of super-k-mers.
BUCKET_BYTES = 4 << 20
#: Stands for a null id: such rows come last.
LAST_ID = (1 << 63) - 1


def later_places(key: np.ndarray, words: np.ndarray, at: np.ndarray, k: int, doc_id: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Mask of the places whose window also starts earlier: smaller (doc_id, start).

    ``key`` is a hash of each window; windows with equal keys are compared word by word (``words`` hashes from ``at`` on).
    """
    later = np.zeros(len(key), bool)
    if len(key) < 2:
        return later
    order = np.argsort(key, kind="stable")
    same = key[order[1:]] == key[order[:-1]]
    if not same.any():
        return later
    many = order[np.r_[same, False] | np.r_[False, same]]
    # Equal keys side by side, each group by id and start; words decide between windows whose keys only happen to be equal.
    many = many[np.lexsort((start[many], doc_id[many], key[many]))]
    new = np.r_[True, key[many[1:]] != key[many[:-1]]]
    first = np.repeat(np.flatnonzero(new), np.diff(np.r_[np.flatnonzero(new), len(many)]))
    head = many[first]
    equal = np.ones(len(many), bool)
    for i in range(k):
        equal &= words[at[many] + i] == words[at[head] + i]
    if not equal.all():
        # Two different windows share a 64-bit hash: sort by a second one as well.
        other = np.zeros(len(key), np.uint64)
        for i in range(k):
            other[many] = mix(other[many] + words[at[many] + i])
        many = many[np.lexsort((start[many], doc_id[many], other[many], key[many]))]
        new = np.r_[True, (key[many[1:]] != key[many[:-1]]) | (other[many[1:]] != other[many[:-1]])]
        head = many[np.repeat(np.flatnonzero(new), np.diff(np.r_[np.flatnonzero(new), len(many)]))]
    later[many] = (doc_id[many] != doc_id[head]) | (start[many] != start[head])
    return later


def _minimisers(words: np.ndarray, k: int, m: int) -> np.ndarray:
    """Smallest hash of the m-word runs of each k-word window."""
    run = windows(words, m)
    width, have = k - m + 1, 1
    least = run
    while have * 2 <= width:
        least = np.minimum(least[:-have], least[have:])
        have *= 2
    rest = width - have
    return np.minimum(least[:len(least) - rest], least[rest:]) if rest else least


def _ranges(positions: np.ndarray, doc: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(doc, begin, end) in words covered by windows at rising ``positions``; touching ones are one range."""
    new = np.r_[True, (doc[1:] != doc[:-1]) | (positions[1:] > positions[:-1] + k)]
    head = np.flatnonzero(new)
    last = np.r_[head[1:] - 1, len(positions) - 1]
    return doc[head], positions[head], positions[last] + k


_MARK = pa.schema([("bucket", pa.int32()), ("doc_id", pa.int64()), ("tie", pa.int64()), ("ranges", pa.binary()), ("packed", pa.binary())])
_MARK_SQL = "bucket int, doc_id long, tie long, ranges binary, packed binary"


def _marks(doc_id: np.ndarray, tie: np.ndarray, begin: np.ndarray, end: np.ndarray, buckets: int) -> pa.RecordBatch:
    """One row per text: its ranges as pairs of 32-bit integers."""
    order = np.lexsort((begin, tie, doc_id))
    doc_id, tie, begin, end = doc_id[order], tie[order], begin[order], end[order]
    heads = np.flatnonzero(np.r_[True, (doc_id[1:] != doc_id[:-1]) | (tie[1:] != tie[:-1])])
    pairs = np.stack([begin, end], axis=1).astype("<i4")
    ends = np.r_[heads[1:], len(doc_id)]
    bucket = (mix(doc_id[heads].view(np.uint64)) % np.uint64(buckets)).astype(np.int32)
    return pa.RecordBatch.from_arrays([pa.array(bucket), pa.array(doc_id[heads]), pa.array(tie[heads]),
                                       pa.array([pairs[a:b].tobytes() for a, b in zip(heads.tolist(), ends.tolist(), strict=True)], pa.binary()), pa.nulls(len(heads), pa.binary())], schema=_MARK)


def _send(k: int, m: int, buckets: int, block_bytes: int):
    """Rows for the buckets: packed super-k-mers, and ranges that the block itself has found."""
    def block(ids, ties, texts) -> Iterator[pa.RecordBatch]:
        words = Words(texts)
        n = len(words) - k + 1
        if n <= 0:
            return
        h = words.hashes()
        at = np.flatnonzero(words.doc[:n] == words.doc[k - 1:])
        if not len(at):
            return
        doc = words.doc[at]
        start = at - words.first[doc]
        later = later_places(windows(h, k)[at], h, at, k, ids[doc], start)
        if later.any():
            d, a, b = _ranges(start[later], doc[later], k)
            yield _marks(ids[d], ties[d], a, b, buckets)
        at, doc, start = at[~later], doc[~later], start[~later]
        bucket = (mix(_minimisers(h, k, m)[at]) % np.uint64(buckets)).astype(np.int32)
        head = np.flatnonzero(np.r_[True, (at[1:] != at[:-1] + 1) | (bucket[1:] != bucket[:-1])])
        count = np.diff(np.r_[head, len(at)])
        bucket, at, doc, start = bucket[head], at[head], doc[head], start[head]
        order = np.argsort(bucket, kind="stable")
        ends = np.searchsorted(bucket[order], np.arange(buckets + 1))
        begin, end = words.starts[at], words.ends[at + count + k - 2]
        press = zstandard.ZstdCompressor(level=3)
        for i in range(buckets):
            o = order[ends[i]:ends[i + 1]]
            if not len(o):
                continue
            text = b" ".join([words.raw[a:b] for a, b in zip(begin[o].tolist(), end[o].tolist(), strict=True)])
            head = np.array([len(o)], "<i8").tobytes()
            blob = press.compress(head + ids[doc[o]].tobytes() + ties[doc[o]].tobytes() + start[o].astype("<i4").tobytes() + count[o].astype("<i4").tobytes() + text)
            yield pa.RecordBatch.from_arrays([pa.array([i], pa.int32()), pa.nulls(1, pa.int64()), pa.nulls(1, pa.int64()), pa.nulls(1, pa.binary()), pa.array([blob], pa.binary())], schema=_MARK)

    def run(batches):
        for batch in batches:
            ids, ties, texts = np.array(batch.column(0), np.int64), np.array(batch.column(1), np.int64), as_bytes(batch.column(2))
            for a, b in spans(texts, block_bytes):
                yield from block(ids[a:b], ties[a:b], texts[a:b])
    return run


def _count(k: int, buckets: int):
    """Ranges found in the buckets; ranges of the blocks pass through."""
    def work(blobs: list[bytes]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdDecompressor()
        ids, ties, start, count, texts = [], [], [], [], []
        for blob in blobs:
            raw = press.decompress(blob)
            n = int(np.frombuffer(raw, "<i8", 1)[0])
            ids.append(np.frombuffer(raw, "<i8", n, 8))
            ties.append(np.frombuffer(raw, "<i8", n, 8 + 8 * n))
            start.append(np.frombuffer(raw, "<i4", n, 8 + 16 * n))
            count.append(np.frombuffer(raw, "<i4", n, 8 + 20 * n))
            texts.append(raw[8 + 24 * n:])
        ids, ties, start, count = (np.concatenate(c).astype(np.int64) for c in (ids, ties, start, count))
        words = Words(texts).hashes()
        # Each string holds count + k - 1 words; its windows begin at the first count of them.
        size = count + k - 1
        begin = np.cumsum(size) - size
        own = np.repeat(np.arange(len(count)), count)
        step = np.arange(len(own)) - np.repeat(np.cumsum(count) - count, count)
        at, place = begin[own] + step, start[own] + step
        later = later_places(windows(words, k)[at], words, at, k, ids[own], place)
        if later.any():
            own, place = own[later], place[later]
            d, a, b = _ranges(place, own, k)
            yield _marks(ids[d], ties[d], a, b, buckets)

    def run(batches):
        current, held = None, []
        for batch in batches:
            ours = batch.column(4).is_valid().to_pylist()
            through = batch.filter(pa.array([not x for x in ours]))
            if through.num_rows:
                yield through
            for bucket, blob, ok in zip(batch.column(0).to_pylist(), batch.column(4).to_pylist(), ours, strict=True):
                if ok:
                    if bucket != current and held:
                        yield from work(held)
                        held = []
                    current = bucket
                    held.append(blob)
        if held:
            yield from work(held)
    return run


def _cut(with_text: bool):
    """The words of each text that no range covers."""
    def run(batches):
        for batch in batches:
            ids, texts, lists = batch.column(0).to_pylist(), as_bytes(batch.column(1)), batch.column(2).to_pylist()
            n_words, removed, kept = [], [], []
            for text, ranges in zip(texts, lists, strict=True):
                words = text.split()  # bytes.split() cuts at 0x20 and 0x09-0x0D
                n_words.append(len(words))
                if ranges:
                    pairs = np.frombuffer(b"".join(ranges), "<i4").reshape(-1, 2)
                    change = np.zeros(len(words) + 1, np.int64)
                    np.add.at(change, pairs[:, 0], 1)
                    np.add.at(change, pairs[:, 1], -1)
                    words = [words[i] for i in np.flatnonzero(np.cumsum(change[:-1]) == 0).tolist()]
                removed.append(n_words[-1] - len(words))
                kept.append(b" ".join(words))
            last = pa.array(kept, pa.binary()) if with_text else pa.nulls(len(kept), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(n_words, pa.int64()), pa.array(removed, pa.int64()), pa.array([hashlib.sha256(x).hexdigest() for x in kept]), last],
                                             names=["doc_id", "n_words", "n_removed", "kept_sha256", "kept_text"])
    return run


def substring_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, minimiser: int = MINIMISER,
                    with_text: bool = True, block_bytes: int = BLOCK_BYTES, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """One row per input row: doc_id, n_words, n_removed, kept_sha256 and kept_text (kept words joined by one blank).

    A word goes if a window over it also starts earlier: in a smaller id, or at a smaller place under the same id. A null text has no words, one with
    fewer words than a window loses none. Null ids count as one id after all others. Rows that repeat an id and text are the same place twice and lose
    only what other places had first. An empty table gives an empty result; other columns are not read.
    """
    text = F.col(f"`{text_col}`")
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.coalesce(F.col(f"`{id_col}`").cast("long"), F.lit(LAST_ID)).alias("key"), F.xxhash64(text).alias("tie"), text.alias("text"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(8, size // bucket_bytes)
    sent = rows.select("key", "tie", "text").mapInArrow(_send(window, minimiser, buckets, block_bytes), _MARK_SQL)
    marks = sent.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(_count(window, buckets), _MARK_SQL)
    # All ranges of a text: no more than it has windows.
    ranges = marks.groupBy(F.col("doc_id").alias("key"), "tie").agg(F.collect_list("ranges").alias("ranges"))
    joined = rows.join(ranges, ["key", "tie"], "left").select("doc_id", "text", "ranges")
    kept = joined.mapInArrow(_cut(with_text), "doc_id long, n_words long, n_removed long, kept_sha256 string, kept_text binary")
    return kept.withColumn("kept_text", F.col("kept_text").cast("string"))
