"""Benchmark decontamination: test items inside long documents.

The share of an item's shingles that a document holds (containment) is estimated by MinHash: the smallest shingle hashes of an item
are a sample of its shingles, and each lies in the document with that probability, however long the document is. Items are
partitioned by size; the partition fixes how many smallest hashes are kept. With more of them than an item may miss, a document over the threshold holds
at least one, so the search loses nothing. Candidates are verified by exact containment of the shingle sets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.functions import pandas_udf

from liftplan.llm.words import Words, as_bytes, shingle_sets, spans

SHINGLE = 5
THRESHOLD = (75, 100)
#: Shingles of items in one block of the search; a block is what every task holds.
BLOCK_SHINGLES = 2_000_000


def sketch_size(n: int, num: int, den: int) -> int:
    """Smallest hashes to keep of an item of ``n`` shingles: one more than it may miss."""
    return n - (-(-num * n // den)) + 1


class ItemIndex:
    """Items of one block: per size partition the smallest hashes (sorted, with their items), and all shingles for verification."""

    def __init__(self, ids: list, sets: list[np.ndarray], num: int, den: int):
        self.ids, self.sets, self.num, self.den = ids, sets, num, den
        size = np.array([len(s) for s in sets], np.int64)
        self.partitions = []
        for power in np.unique(np.log2(np.maximum(size, 1)).astype(np.int64)).tolist():
            items = [i for i, s in enumerate(sets) if len(s) and int(np.log2(len(s))) == power]
            if not items:
                continue
            # The largest item of the partition fixes the number of hashes for all of it.
            k = sketch_size(max(len(sets[i]) for i in items), num, den)
            kept = [sets[i][:max(k, 1)] for i in items]
            token, owner = np.concatenate(kept), np.repeat(items, [len(x) for x in kept])
            order = np.argsort(token, kind="stable")
            least = min(-(-num * len(sets[i]) // den) for i in items)
            self.partitions.append((least, token[order], owner[order]))

    def search(self, tokens: np.ndarray) -> list[tuple[int, int]]:
        """(item, shared shingles) of the items that the document's sorted set contains to the threshold."""
        found: set[int] = set()
        for least, token, owner in self.partitions:
            if len(tokens) < least:
                continue
            # Search the smaller side in the larger.
            if len(tokens) <= len(token):
                a, b = np.searchsorted(token, tokens, "left"), np.searchsorted(token, tokens, "right")
                hit = np.flatnonzero(b > a)
                for i in hit.tolist():
                    found.update(owner[a[i]:b[i]].tolist())
            else:
                at = np.minimum(np.searchsorted(tokens, token), len(tokens) - 1)
                found.update(owner[tokens[at] == token].tolist())
        out = []
        for i in sorted(found):
            item = self.sets[i]
            at = np.minimum(np.searchsorted(tokens, item), len(tokens) - 1)
            shared = int((tokens[at] == item).sum())
            if self.den * shared >= self.num * len(item):
                out.append((i, shared))
        return out


_HITS = pa.schema([("doc_id", pa.int64()), ("tie", pa.int64()), ("item_id", pa.int64()), ("shared", pa.int64()), ("n_item", pa.int64())])


def _look(block, shingle: int, num: int, den: int):
    def run(batches):
        items = ItemIndex(*block.value, num, den)
        for batch in batches:
            ids, ties, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist(), as_bytes(batch.column(2))
            for a, b in spans(texts):
                rows = [(d, t, items.ids[i], shared, len(items.sets[i]))
                        for d, t, tokens in zip(ids[a:b], ties[a:b], shingle_sets(Words(texts[a:b], lower=True), shingle), strict=True) if len(tokens)
                        for i, shared in items.search(tokens)]
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), _HITS.types, strict=True)], schema=_HITS)
    return run


def _blocks(items: DataFrame, shingle: int, block_shingles: int):
    """Ids and shingle sets of the items, block by block, as they come to the driver; no more than a block is held."""
    ids, sets, held = [], [], 0
    for row in items.toLocalIterator():
        own = shingle_sets(Words([(row[1] or "").encode()], lower=True), shingle)[0]
        if len(own):
            ids.append(row[0])
            sets.append(own)
            held += len(own)
        if held >= block_shingles:
            yield ids, sets
            ids, sets, held = [], [], 0
    if sets:
        yield ids, sets


def contained_items(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text",
                    shingle: int = SHINGLE, threshold: tuple[int, int] = THRESHOLD, block_shingles: int = BLOCK_SHINGLES) -> DataFrame:
    """One row per document and item found in it: doc_id, item_id, shared, n_item, containment, and tie (a hash of the text).

    An item is found where the document has at least ``threshold`` (a fraction) of its distinct shingles, lower-cased A-Z. An item with fewer words than a shingle has one shingle, its
    whole sequence, which only a text of the same few words has. Items and texts without words are never found. Null ids stay null; repeated rows give repeated
    results. No items or no documents give an empty result; other columns are not read. The items go over all documents in blocks of bounded size.
    """
    spark = docs.sparkSession
    text = F.col(f"`{text_col}`")
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.xxhash64(text).alias("tie"), text.alias("text"))
    asked = items.select(F.col(f"`{item_col}`").cast("long"), F.col(f"`{item_text_col}`"))
    parts = [rows.mapInArrow(_look(spark.sparkContext.broadcast(block), shingle, *threshold), "doc_id long, tie long, item_id long, shared long, n_item long")
             for block in _blocks(asked, shingle, block_shingles)]
    if not parts:
        return spark.createDataFrame([], "doc_id long, tie long, item_id long, shared long, n_item long, containment double")
    found = parts[0]
    for part in parts[1:]:
        found = found.union(part)
    return found.withColumn("containment", F.col("shared") / F.col("n_item"))




def without_items(docs: DataFrame, items: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text",
                  shingle: int = SHINGLE, threshold: tuple[int, int] = THRESHOLD, block_shingles: int = BLOCK_SHINGLES) -> DataFrame:
    """The rows, with all columns, whose texts contain no item (see contained_items). Nothing is moved between tasks."""
    context = docs.sparkSession.sparkContext
    kept = docs
    for block in _blocks(items.select(F.col(f"`{item_col}`").cast("long"), F.col(f"`{item_text_col}`")), shingle, block_shingles):
        kept = kept.where(~_contains(context.broadcast(block), shingle, *threshold)(F.col(f"`{text_col}`")))
    return kept


def _contains(block, shingle: int, num: int, den: int):
    @pandas_udf("boolean")
    def contains(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        items = ItemIndex(*block.value, num, den)
        for texts in batches:
            raw = [t.encode() if isinstance(t, str) else b"" for t in texts]
            sets = [x for a, b in spans(raw) for x in shingle_sets(Words(raw[a:b], lower=True), shingle)]
            yield pd.Series([bool(len(x)) and bool(items.search(x)) for x in sets], index=texts.index, dtype=bool)

    return contains
