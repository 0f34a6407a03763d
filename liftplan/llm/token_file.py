"""Token ids in a byte-plane file format.

The file is a folder of Parquet rows, one row per chunk. A chunk holds whole documents; their ids (32-bit) are cut into
blocks of a fixed number of ids, each block is transposed into its four byte planes, the planes of all blocks of the
chunk are laid end to end and compressed with zstandard, one frame per plane. Beside the frames a chunk row has its
index: part, number, place of its first id in the part, ids, and the documents with their lengths. The folder ``index``
beside it gives each part's first place in the whole file, so a document's place needs no look at other parts.
"""

from __future__ import annotations

import os
import sys
import types
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from liftplan.llm.words import as_bytes, spans

#: Ids in a block (the unit of transposition), and in a chunk before it is closed.
BLOCK_IDS = 4096
CHUNK_IDS = 1 << 18
#: Bytes of pieces whose ids a task keeps at hand.
PIECE_CACHE = 240 << 20


def to_planes(ids: np.ndarray, block: int = BLOCK_IDS) -> list[bytes]:
    """Four byte planes (lowest first): each block transposed, the last one as long as it is."""
    raw = np.ascontiguousarray(ids, "<u4").view(np.uint8).reshape(-1, 4)
    whole = len(raw) // block * block
    head = raw[:whole].reshape(-1, block, 4).transpose(2, 0, 1).reshape(4, -1)
    return [np.concatenate([h, t]).tobytes() for h, t in zip(head, raw[whole:].T, strict=True)]


def from_planes(planes: list[bytes], block: int = BLOCK_IDS) -> np.ndarray:
    """Ids of the planes."""
    columns = [np.frombuffer(p, np.uint8) for p in planes]
    n = len(columns[0])
    whole = n // block * block
    out = np.empty((n, 4), np.uint8)
    out[:whole] = np.stack([c[:whole].reshape(-1, block) for c in columns], axis=2).reshape(-1, 4)
    out[whole:] = np.stack([c[whole:] for c in columns], axis=1)
    return out.view("<u4").reshape(-1)


class PieceEncoder:
    """Ids (16 bits each) of texts with a byte-level BPE of at most 65,536 ids; pieces met before are looked up.

    The vocabulary's pre-tokeniser ends a token in front of a single blank between two characters that are no white space, on
    both sides of such a line feed, and between an ASCII letter and a full stop or comma. The texts of a call are cut there, each
    distinct piece is looked up once, or encoded alone, and what it gives is kept until ``cache_bytes`` are full. White space of
    any other kind stays inside a piece.
    With ``special_as_text`` the vocabulary's special tokens are spelled out like any other text; without it they keep their own ids, as
    the tokenizer does when it is loaded, and a text that holds one is encoded whole.
    """

    def __init__(self, tokenizer_path: str, cache_bytes: int = PIECE_CACHE, special_as_text: bool = True):
        from tokenizers import Tokenizer

        self.tokenizer, self.cache_bytes = Tokenizer.from_file(tokenizer_path), cache_bytes
        vocabulary = self.tokenizer.get_vocab()
        if max(vocabulary.values()) >= 1 << 16:
            raise ValueError("the encoder keeps ids in 16 bits")
        self.tokenizer.encode_special_tokens = special_as_text
        #: Texts that hold one of these are not cut.
        self.added = [] if special_as_text else [t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values()]
        #: Bytes that each id stands for: a byte-level vocabulary writes a byte as one character.
        self.id_bytes = np.zeros(1 << 16, np.int64)
        for token, number in vocabulary.items():
            self.id_bytes[number] = len(token)
        #: Ids of pieces.
        self.known: dict[bytes, bytes] = {}
        self.held = 0

    def _each(self, pieces: list[bytes]) -> list[bytes]:
        got = self.tokenizer.encode_batch_fast([p.decode("utf-8") for p in pieces], add_special_tokens=False)
        return [np.array(x.ids, "<u2").tobytes() for x in got]

    def _ask(self, pieces: list[bytes], glue: bytes) -> list[bytes]:
        """Ids of pieces, many in one string: the pre-tokeniser cuts between them, so the bytes of the ids tell them apart.

        Pieces begin with a blank and are not glued, or begin without one and are glued by a line feed.
        """
        out: list[bytes] = []
        groups = [pieces[i:i + 256] for i in range(0, len(pieces), 256)]
        for i in range(0, len(groups), 64):
            part = groups[i:i + 64]
            for group, got in zip(part, self.tokenizer.encode_batch_fast([glue.join(g).decode("utf-8") for g in part], add_special_tokens=False), strict=True):
                ids = np.array(got.ids, "<u2")
                reached = np.concatenate([[0], np.cumsum(self.id_bytes[ids])])
                ends = np.cumsum([len(p) + len(glue) for p in group]) - len(glue)
                begins = np.concatenate([[0], ends[:-1] + len(glue)])
                first, last = np.searchsorted(reached, begins), np.searchsorted(reached, ends)
                if not (reached[-1] == ends[-1] and (reached[first] == begins).all() and (reached[last] == ends).all()):
                    out += self._each(group)
                    continue
                raw = ids.tobytes()
                out += [raw[a:b] for a, b in zip((2 * first).tolist(), (2 * last).tolist(), strict=True)]
        return out

    def _look_up(self, pieces: list[bytes]) -> list[bytes]:
        """Ids of distinct pieces."""
        got = list(map(self.known.get, pieces))
        missing = [p for p, g in zip(pieces, got, strict=True) if g is None]
        if not missing:
            return got
        after_blank, plain, rest = [], [], []
        for p in missing:
            (rest if not _ends_solid(p) else after_blank if p[0] == 0x20 else plain).append(p)
        fresh = dict(zip(after_blank + plain + rest, self._ask(after_blank, b"") + self._ask(plain, b"\n") + self._each(rest), strict=True))
        if self.held < self.cache_bytes:
            kept = {p: x for p, x in fresh.items() if len(p) < 40}
            self.known.update(kept)
            self.held += sum(len(p) + len(x) + 190 for p, x in kept.items())
        return [fresh[p] if g is None else g for p, g in zip(pieces, got, strict=True)]

    def encode(self, texts: list[bytes]) -> list[np.ndarray]:
        """Ids of each text."""
        uncut = [i for i, t in enumerate(texts) if any(a in t for a in self.added)]
        if not uncut:
            return self._encode_cut(texts)
        whole = dict(zip(uncut, self._each([texts[i] for i in uncut]), strict=True))
        cut = iter(self._encode_cut([t for i, t in enumerate(texts) if i not in whole]))
        return [np.frombuffer(whole[i], "<u2").astype(np.uint32) if i in whole else next(cut) for i in range(len(texts))]

    def _encode_cut(self, texts: list[bytes]) -> list[np.ndarray]:
        raw = b"".join(texts)
        if not raw:
            return [np.zeros(0, np.uint32) for _ in texts]
        bounds = np.cumsum([0, *map(len, texts)])
        cuts = piece_cuts(np.frombuffer(raw, np.uint8), bounds)
        pieces = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(cuts) - 1, [None, pa.py_buffer(cuts), pa.py_buffer(raw)]).dictionary_encode()
        ids = pa.array(self._look_up(pieces.dictionary.to_pylist()), pa.large_binary()).take(pieces.indices)
        # The ids of all pieces stand end to end in the array's data.
        reached = np.frombuffer(ids.buffers()[1], np.int64)[ids.offset:ids.offset + len(cuts)] // 2
        flat = np.frombuffer(ids.buffers()[2], "<u2", reached[-1]).astype(np.uint32)
        at = reached[np.searchsorted(cuts, bounds)].tolist()
        return [flat[a:b] for a, b in zip(at, at[1:])]


#: Bytes that belong to no white space: printable ASCII, and the bytes of two-byte letters (a piece may begin with lead bytes C3-DF).
_SOLID_BYTES = np.zeros(256, bool)
_SOLID_BYTES[0x21:0x7F] = True
_SOLID_BYTES[0xC3:0xE0] = True
_SOLID = _SOLID_BYTES.tolist()
_LETTERS = np.zeros(256, bool)
_LETTERS[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = True


def piece_cuts(data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Places at which the pieces of texts laid end to end begin, and the end of the last; ``bounds`` are those of the texts."""
    begins = _SOLID_BYTES[data]
    ends = begins & (data < 0x80)
    ends[1:] |= begins[:-1] & (data[:-1] >= 0xC3) & (data[1:] >= 0x80) & (data[1:] < 0xC0)
    # A solid character of the same text on both sides.
    between = np.zeros(len(data), bool)
    between[1:-1] = ends[:-2] & begins[2:]
    between[bounds[bounds < len(data)]] = False
    between[bounds[bounds > 0] - 1] = False
    line = between & (data == 0x0A)
    cut = np.zeros(len(data) + 1, bool)
    cut[:-1] = line | (between & (data == 0x20))
    cut[1:] |= line
    cut[1:-1] |= ((data[1:] == 0x2E) | (data[1:] == 0x2C)) & _LETTERS[data[:-1]]
    cut[bounds] = True
    return np.flatnonzero(cut)


def _ends_solid(piece: bytes) -> bool:
    """The piece has a solid character after its blank and at its end, so others may be glued to it."""
    first, last = piece[1:2] if piece[0] == 0x20 else piece[:1], piece[-1]
    return bool(first) and _SOLID[first[0]] and (_SOLID[last] if last < 0x80 else last < 0xC0 and len(piece) > 1 and 0xC3 <= piece[-2] < 0xE0)


def _encoder(path: str) -> PieceEncoder:
    """The encoder of this worker process; it keeps its pieces from one task to the next."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs a task per core
    kept = sys.modules.setdefault("_liftplan_token_pieces", types.ModuleType("_liftplan_token_pieces")).__dict__
    if path not in kept:
        kept[path] = PieceEncoder(path, special_as_text=False)
    return kept[path]


_CHUNK = pa.schema([("part", pa.int64()), ("chunk", pa.int64()), ("first", pa.int64()), ("n_ids", pa.int64()), ("block", pa.int32()),
                    ("planes", pa.list_(pa.binary())), ("doc_ids", pa.list_(pa.int64())), ("lengths", pa.list_(pa.int64()))])
_CHUNK_SQL = "part long, chunk long, first long, n_ids long, block int, planes array<binary>, doc_ids array<long>, lengths array<long>"


def _write(tokenizer_path: str, end_id: int, block: int, chunk_ids: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, press = _encoder(tokenizer_path), zstandard.ZstdCompressor(level=1)
        part, chunk, first = TaskContext.get().partitionId(), 0, 0
        doc_ids, held, n = [], [], 0

        def close():
            nonlocal chunk, first, doc_ids, held, n
            planes = [press.compress(p) for p in to_planes(np.concatenate(held), block)]
            made = pa.RecordBatch.from_pydict({"part": [part], "chunk": [chunk], "first": [first], "n_ids": [n], "block": [block],
                                               "planes": [planes], "doc_ids": [doc_ids], "lengths": [[len(x) for x in held]]}, schema=_CHUNK)
            chunk, first, doc_ids, held, n = chunk + 1, first + n, [], [], 0
            return made

        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), as_bytes(batch.column(1))
            for a, b in spans(texts):
                for doc_id, got in zip(ids[a:b], encoder.encode(texts[a:b]), strict=True):
                    doc_ids.append(doc_id)
                    held.append(np.append(got, np.uint32(end_id)))
                    n += len(held[-1])
                    if n >= chunk_ids:
                        yield close()
        if held:
            yield close()
    return run


def write_tokens(docs: DataFrame, path: str, tokenizer_path: str, end_id: int, id_col: str = "doc_id", text_col: str = "text",
                 block: int = BLOCK_IDS, chunk_ids: int = CHUNK_IDS) -> None:
    """Encode whole texts as the tokenizer does when it is loaded, and write them to ``path`` in ascending id order, ``end_id`` after each.

    Null text counts as empty (its document is the end id alone); null ids come first; rows with equal ids stand side by
    side, ordered by text. An empty table gives a file without chunks. Other columns are not read.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))
    # The text hash keeps rows with one id from landing in one partition, and gives equal ids an order.
    keyed = rows.withColumn("tie", F.xxhash64("text"))
    placed = keyed.repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie").select("doc_id", "text")
    chunks = placed.mapInArrow(_write(tokenizer_path, end_id, block, chunk_ids), _CHUNK_SQL)
    chunks.write.option("compression", "uncompressed").parquet(f"{path}/chunks")
    parts = spark.read.parquet(f"{path}/chunks").groupBy("part").agg(F.sum("n_ids").alias("n_ids"), F.count("*").alias("n_chunks"))
    # One row per part, and parts are as many as tasks.
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts.withColumn("start", F.coalesce(F.sum("n_ids").over(before), F.lit(0))).write.parquet(f"{path}/index")



def _documents(digest: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdDecompressor()
        for batch in batches:
            for row in batch.to_pylist():
                ids = from_planes([press.decompress(p) for p in row["planes"]], row["block"])
                if len(ids) != row["n_ids"]:
                    raise ValueError(f"chunk {row['chunk']} of part {row['part']}: {len(ids)} ids, index says {row['n_ids']}")
                lengths = np.array(row["lengths"], np.int64)
                starts = np.cumsum(lengths) - lengths
                cut = [ids[a:a + n] for a, n in zip(starts.tolist(), lengths.tolist(), strict=True)]
                value = pa.array([zlib.crc32(c.tobytes()) for c in cut], pa.int64()) if digest else pa.array([c.astype(np.int64) for c in cut], pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row["part"]] * len(cut), pa.int64()), pa.array(row["doc_ids"], pa.int64()), pa.array(starts + row["first"]), pa.array(lengths), value],
                    names=["part", "doc_id", "in_part", "n_tokens", "ids_crc32" if digest else "ids"])
    return run


def read_tokens(spark: SparkSession, path: str, digest: bool = False) -> DataFrame:
    """Documents of a token file: doc_id, start, n_tokens and ids (or, with ``digest``, ids_crc32 of the 32-bit ids)."""
    chunks = spark.read.parquet(f"{path}/chunks")
    last = "ids_crc32 long" if digest else "ids array<long>"
    docs = chunks.mapInArrow(_documents(digest), f"part long, doc_id long, in_part long, n_tokens long, {last}")
    index = spark.read.parquet(f"{path}/index").select("part", "start")
    return docs.join(index, "part").select("doc_id", (F.col("start") + F.col("in_part")).alias("start"), "n_tokens", last.split()[0])


__all__ = ["PieceEncoder", "from_planes", "read_tokens", "to_planes", "write_tokens"]
