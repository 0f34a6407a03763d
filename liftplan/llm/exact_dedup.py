"""Exact de-duplication with Patricia tries as owners of equal texts.

Equal means: identical bytes after lower-casing A-Z. Each map task first puts its
texts into a trie of its own, block by block, so that a text with any number of
copies leaves one row per block. These rows are partitioned by byte length and
content hash, and each partition inserts the full byte strings into a compressed
radix trie; a terminal holds the owner and the blocks that hold the text. A trie
over its memory bound moves its largest subtree to a file of the task and treats
that file afterwards in the same way.
"""

from __future__ import annotations

import hashlib
import pickle
import tempfile
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from liftplan.llm.shared import stage
from liftplan.llm.words import LOWER, as_bytes

#: Bytes of text in a block of a map task, and in a trie before a subtree is spilled.
BLOCK_BYTES = 32 << 20
TRIE_BYTES = 96 << 20


class _Node:
    __slots__ = ("label", "children", "held", "bytes")

    def __init__(self, label: bytes):
        self.label, self.children, self.held, self.bytes = label, {}, None, 0


def _shared(label: bytes, key: bytes, at: int) -> int:
    """Length of the common beginning of ``label`` and ``key[at:]``."""
    low, high = 0, min(len(label), len(key) - at)
    while low < high:
        mid = (low + high + 1) // 2
        if label[low:mid] == key[at + low:at + mid]:
            low = mid
        else:
            high = mid - 1
    return low


class PatriciaTrie:
    """Byte strings with a list of values each; subtrees beyond ``limit`` bytes go to files."""

    def __init__(self, limit: int = TRIE_BYTES):
        self.root, self.limit, self.spilled = _Node(b""), limit, {}

    def insert(self, key: bytes, value) -> None:
        """Add ``value`` to the terminal of ``key``."""
        if key[:1] in self.spilled:
            pickle.dump((key, [value]), self.spilled[key[:1]])
            return
        node, at, path = self.root, 0, [self.root]
        while at < len(key):
            child = node.children.get(key[at])
            if child is None:
                child = node.children[key[at]] = _Node(key[at:])
                node, at = child, len(key)
            elif key.startswith(child.label, at):
                node, at = child, at + len(child.label)
            else:
                n = _shared(child.label, key, at)
                upper = _Node(child.label[:n])
                upper.bytes = child.bytes
                child.label = child.label[n:]
                upper.children[child.label[0]] = child
                node.children[key[at]] = upper
                node, at = upper, at + n
            path.append(node)
        if node.held is None:
            node.held, cost = [], len(node.label) + 200
        else:
            cost = 32
        node.held.append(value)
        for n in path:
            n.bytes += cost
        if self.root.bytes > self.limit and self.root.children:
            self._spill()

    def _spill(self) -> None:
        """Move the largest subtree below the root to a file."""
        branch, child = max(self.root.children.items(), key=lambda x: x[1].bytes)
        out = self.spilled[bytes([branch])] = tempfile.TemporaryFile()
        for entry in self._walk(child, b""):
            pickle.dump(entry, out)
        del self.root.children[branch]
        self.root.bytes -= child.bytes

    @staticmethod
    def _walk(node: _Node, before: bytes) -> Iterator[tuple[bytes, list]]:
        stack = [(node, before)]
        while stack:
            node, before = stack.pop()
            key = before + node.label
            if node.held is not None:
                yield key, node.held
            stack.extend((c, key) for c in node.children.values())

    def groups(self) -> Iterator[tuple[bytes, list]]:
        """Each byte string with its values, spilled subtrees last; empties the trie."""
        yield from self._walk(self.root, b"")
        self.root = _Node(b"")
        for branch in list(self.spilled):
            with self.spilled.pop(branch) as file:
                file.seek(0)
                yield from self._reload(file)

    def _reload(self, file) -> Iterator[tuple[bytes, list]]:
        """Groups of one spilled subtree; what all its keys begin with is taken off before they are inserted."""
        common = None
        while (entry := _next(file)) is not None:
            key = entry[0]
            common = key if common is None else common[:_shared(common, key, 0)]
        file.seek(0)
        below = PatriciaTrie(self.limit)
        while (entry := _next(file)) is not None:
            for value in entry[1]:
                below.insert(entry[0][len(common):], value)
        for key, held in below.groups():
            yield common + key, held


def _next(file):
    try:
        return pickle.load(file)
    except EOFError:
        return None


_LOCAL = pa.schema([("doc_id", pa.int64()), ("rep", pa.int64()), ("best_here", pa.bool_()), ("n_here", pa.int64()),
                    ("n_bytes", pa.int64()), ("content_hash", pa.int64()), ("text_sha256", pa.string()), ("text", pa.binary())])
_LOCAL_SQL = ("doc_id long, rep long, best_here boolean, n_here long, n_bytes long, content_hash long, "
              "text_sha256 string, text binary")


def _stands(doc_id: int | None, largest: bool) -> tuple:
    """Order of owners: known ids before unknown ones, then the largest (or smallest)."""
    return (doc_id is not None, (doc_id if largest else -doc_id) if doc_id is not None else 0)


def _local_owners(largest: bool, block_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = TaskContext.get().partitionId() << 32
        ids: list = []
        trie, held = PatriciaTrie(1 << 62), 0

        def flush():
            nonlocal made, trie, held
            columns = {name: [] for name in _LOCAL.names}
            for key, rows in trie.groups():
                best = max(rows, key=lambda r: _stands(ids[r], largest))
                sha, content = hashlib.sha256(key).hexdigest(), xxhash.xxh3_64_intdigest(key) - (1 << 63)
                for r in rows:
                    row = (ids[r], made, r == best, len(rows), len(key), content, sha, key if r == best else None)
                    for name, value in zip(columns, row, strict=True):
                        columns[name].append(value)
                made += 1
            trie, held = PatriciaTrie(1 << 62), 0
            ids.clear()
            table = pa.table(columns, schema=_LOCAL)
            return table.to_batches(max_chunksize=2000)

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), as_bytes(batch.column(1)), strict=True):
                trie.insert(text.translate(LOWER), len(ids))
                ids.append(doc_id)
                held += len(text) + 100
                if held > block_bytes:
                    yield from flush()
        if ids:
            yield from flush()
    return run


_OWNED = pa.schema([("rep", pa.int64()), ("keep_id", pa.int64()), ("group_size", pa.int64()), ("wins", pa.bool_())])


def _owners(largest: bool, trie_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = PatriciaTrie(trie_bytes)
        for batch in batches:
            for key, *value in zip(as_bytes(batch.column(0)), *(c.to_pylist() for c in batch.columns[1:]), strict=True):
                trie.insert(key, tuple(value))
        rows = []
        for _, held in trie.groups():
            best = max(held, key=lambda v: (_stands(v[1], largest), -v[0]))
            size = sum(v[2] for v in held)
            rows.extend((v[0], best[1], size, v is best) for v in held)
            if len(rows) > 50_000:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), _OWNED.types, strict=True)], schema=_OWNED)
                rows = []
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), _OWNED.types, strict=True)], schema=_OWNED)
    return run


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "largest",
                block_bytes: int = BLOCK_BYTES, trie_bytes: int = TRIE_BYTES) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256, n_bytes (of the normalised text).

    ``keep`` is "largest" or "smallest" id. Null text counts as empty, a null id stands behind every known id, and of
    rows with equal text and id exactly one is kept. An empty table gives an empty result; other columns are not read.
    """
    if keep not in ("largest", "smallest"):
        raise ValueError("keep is 'largest' or 'smallest'")
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    local = stage(rows.mapInArrow(_local_owners(keep == "largest", block_bytes), _LOCAL_SQL), "dedup-blocks")
    owners = (local.where("best_here").repartition("n_bytes", "content_hash")
              .select("text", "rep", "doc_id", "n_here")
              .mapInArrow(_owners(keep == "largest", trie_bytes), "rep long, keep_id long, group_size long, wins boolean"))
    return (local.drop("text").join(owners, "rep")
            .select("doc_id", "keep_id", "group_size", (F.col("best_here") & F.col("wins")).alias("kept"), "text_sha256", "n_bytes"))
