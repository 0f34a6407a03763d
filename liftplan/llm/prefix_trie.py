r"""Prefix trie of conversations by van Emde Boas recursion.

A conversation is a sequence of turns; a node of the trie is a distinct sequence of first turns. The recursion of a span of
``2 ** k`` turns cuts every sequence at half of it. What stands before the cut is named, so that equal prefixes have equal
names; the upper half is a problem of its own under the same root, and each lower half is one under the name of its cut
prefix. All problems of a level are solved together, so the number of rounds is the logarithm of the longest conversation, and
round k handles one row per ``2 ** k`` turns:

1. blocks: the name of each aligned run of ``2 ** k`` turns, from the names of its halves;
2. naming, long spans first: a span with root ``r`` whose upper half is complete gives the cut prefix the name of (r, upper
   half); in the last round each span is one turn and its root the prefix before it;
3. grafting: totals of the span below each root, short spans first (the total of the upper half plus those of the lower halves under
   its cut prefixes), then, long spans first, the whole total below each cut prefix, grafted onto the roots above.

Names are the first 128 bits of a SHA-256. No step holds a conversation, a node's members or a subtree in one row or task; the digest of the
members that end at a node is taken over their sorted ids as a stream, in pieces made before.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from liftplan.llm.shared import stage

#: Bytes of joined ids that go to the digest as one row.
PIECE_BYTES = 1 << 16


def _name(value: Column) -> Column:
    return F.substring(F.unhex(F.sha2(value, 256)), 1, 16)


def _root() -> Column:
    return _name(F.lit("").cast("binary"))


def numbered(turns: DataFrame) -> DataFrame:
    """Turns (conv_id, turn, role, text) with their place ``at`` from 1 in the conversation, in the order turn (null first), role, text.

    Places are counted in range partitions and moved by what stands before, so a conversation may be longer than a task can sort.
    """
    order = ["conv_id", F.asc_nulls_first("turn"), "role", "text"]
    cut = stage(turns.repartitionByRange(*order).withColumn("part", F.spark_partition_id()), "turns")
    inside = F.row_number().over(Window.partitionBy("conv_id", "part").orderBy(*order[1:]))
    sizes = cut.groupBy("conv_id", "part").agg(F.count("*").alias("n"))  # one row per conversation and partition that it reaches
    before = F.coalesce(F.sum("n").over(Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return cut.join(sizes.select("conv_id", "part", before.alias("before")), ["conv_id", "part"]).select(
        "conv_id", (inside + F.col("before")).alias("at"), "role", "text")


def shared_heads(conversations: DataFrame, group: int = 100, most: int = 6) -> DataFrame:
    """Conversations (conv_id, turn, role, text) rebuilt: the first ``h`` turns of the group's first conversation, then the own turns after the first ``h``.

    ``h`` is the CRC-32 of the decimal conv_id modulo ``most``; the group's first conversation is conv_id - conv_id % ``group``. Returns
    conv_id, at (from 1), role, text, with one row of null ``at`` for a conversation that is left without turns. Null roles and
    texts are empty, rows without a conv_id are left out, and repeated rows are turns of their own.
    """
    own = conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    placed = stage(numbered(own), "placed-turns")
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % most).cast("int")
    # A group's first conversation lends at most most - 1 turns to at most ``group`` others (twice that around 0).
    lent = placed.where(F.col("at") < most).select(F.col("conv_id").alias("base"), "at", "role", "text")
    sizes = placed.groupBy("conv_id").agg(F.count("*").alias("n")).select("conv_id", "n", h.alias("h"), (F.col("conv_id") - F.col("conv_id") % group).alias("base"))
    lengths = lent.groupBy("base").agg(F.count("*").alias("lent"))
    plan = stage(sizes.join(lengths, "base", "left").select("conv_id", "base", "n", "h", F.least("h", F.coalesce("lent", F.lit(0))).alias("taken")), "heads")
    head = plan.join(lent, "base").where("at <= taken").select("conv_id", "at", "role", "text")
    # The own turns' h is theirs alone, so only the number of turns taken is joined.
    tail = placed.where(F.col("at") > h).join(plan.select("conv_id", "taken"), "conv_id").select("conv_id", (F.col("at") - h + F.col("taken")).alias("at"), "role", "text")
    bare = plan.where("taken = 0 AND n <= h").select("conv_id", F.lit(None).cast("long").alias("at"), F.lit(None).cast("string").alias("role"), F.lit(None).cast("string").alias("text"))
    return head.unionByName(tail.withColumn("at", F.col("at").cast("long"))).unionByName(bare)


def _blocks(turns: DataFrame, levels: int) -> list[DataFrame]:
    """Names of complete aligned runs: for each k (conv, i, h), the run of ``2 ** k`` turns after place ``i * 2 ** k``."""
    made = [turns.select("conv", "i", "h")]
    for _ in range(1, levels):
        halves = made[-1].groupBy("conv", F.shiftright("i", 1).alias("up")).agg(
            F.max(F.when(F.col("i") % 2 == 0, F.col("h"))).alias("a"), F.max(F.when(F.col("i") % 2 == 1, F.col("h"))).alias("b"))
        made.append(stage(halves.where("a IS NOT NULL AND b IS NOT NULL").select("conv", F.col("up").alias("i"), _name(F.concat("a", "b")).alias("h")), "trie-blocks"))
    return made


def _spans(lengths: DataFrame, blocks: list[DataFrame], levels: int) -> list[DataFrame]:
    """For each k (conv, i, root, next): names of the prefixes of ``i * 2 ** k`` and ``(i + 1) * 2 ** k`` turns (``next`` null where there are fewer)."""
    made: list[DataFrame] = [None] * (levels + 1)
    # A conversation joins in at the first span that holds it whole.
    whole = lengths.select("conv", F.length(F.bin("n")).alias("k"), F.when(F.col("n") == 0, 0).otherwise(1).alias("any")).select("conv", (F.col("k") * F.col("any")).alias("k"))
    fresh = lambda k: whole.where(F.col("k") == k).select("conv", F.lit(0).cast("long").alias("i"), _root().alias("root"), F.lit(None).cast("binary").alias("next"))
    made[levels] = fresh(levels)
    for k in range(levels - 1, -1, -1):
        upper = blocks[k].where("i % 2 = 0").select("conv", F.shiftright("i", 1).alias("i"), "h")
        cut = made[k + 1].join(upper, ["conv", "i"], "left").withColumn("cut", F.when(F.col("h").isNotNull(), _name(F.concat("root", "h"))))
        halves = F.array(F.struct((F.col("i") * 2).alias("i"), F.col("root").alias("root"), F.col("cut").alias("next")),
                         F.struct((F.col("i") * 2 + 1).alias("i"), F.col("cut").alias("root"), F.col("next").alias("next")))
        down = cut.select("conv", F.inline(halves)).where("root IS NOT NULL")
        made[k] = stage(down.unionByName(fresh(k)), "trie-spans")
    return made


def _links(spans: DataFrame, odd: int) -> DataFrame:
    """Distinct (below, above): cut prefixes and the root of their span, for roots at even or odd places."""
    return spans.where(F.col("next").isNotNull() & (F.col("i") % 2 == odd)).groupBy(F.col("next").alias("below")).agg(F.min("root").alias("above"))


def _below(nodes: DataFrame, spans: list[DataFrame], levels: int) -> DataFrame:
    """node, leaves and saved summed over all nodes below it, for nodes that have some."""
    sums = [F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved")]
    # Totals of the span of 2 ** k turns below its root.
    within = [stage(nodes.where("depth > 0").groupBy(F.col("parent").alias("node"), (F.col("depth") - 1).alias("depth")).agg(*sums), "trie-within")]
    for k in range(1, levels + 1):
        step = 1 << k
        roots = within[-1].where(F.col("depth") % step == 0)
        lower = within[-1].where(F.col("depth") % step != 0).join(_links(spans[k - 1], 0), F.col("node") == F.col("below"))
        lower = lower.select(F.col("above").alias("node"), (F.col("depth") - step // 2).alias("depth"), "leaves", "saved")
        within.append(stage(roots.unionByName(lower).groupBy("node", "depth").agg(*sums), "trie-within"))
    # The root's longest span is the whole trie; shorter spans get what hangs below their far end.
    total = within[-1].where("depth = 0")
    for k in range(levels - 1, -1, -1):
        step = 1 << k
        roots = within[k].where(F.col("depth") % (2 * step) == step)
        graft = total.join(_links(spans[k], 1), F.col("node") == F.col("below")).select(F.col("above").alias("node"), (F.col("depth") - step).alias("depth"), "leaves", "saved")
        made = roots.unionByName(graft).groupBy("node", "depth").agg(*sums)
        total = stage(total.unionByName(made), "trie-below")
    return total


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted ids of a node joined by commas, in pieces; ``first`` is a piece's smallest id."""
    held: list[str] = []
    node, first, size = None, 0, 0

    def close():
        return pa.RecordBatch.from_pydict({"node": pa.array([node], pa.binary()), "first": pa.array([first], pa.int64()), "text": [",".join(held)]})

    for batch in batches:
        for key, conv in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            if held and (key != node or size >= PIECE_BYTES):
                yield close()
                held, size = [], 0
            if not held:
                node, first = key, conv
            held.append(str(conv))
            size += len(held[-1]) + 1
    if held:
        yield close()


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of each node's pieces, which come in order."""
    node, digest = None, None
    made: list[tuple[bytes, str]] = []
    for batch in batches:
        for key, text in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), strict=True):
            if key != node:
                if node is not None:
                    made.append((node, digest.hexdigest()))
                node, digest = key, hashlib.sha256()
            else:
                digest.update(b",")
            digest.update(text.encode())
        if made:
            yield pa.RecordBatch.from_pydict({"node": pa.array([m[0] for m in made], pa.binary()), "ends_sha256": [m[1] for m in made]})
            made = []
    if node is not None:
        yield pa.RecordBatch.from_pydict({"node": pa.array([node], pa.binary()), "ends_sha256": [digest.hexdigest()]})


def _ends(members: DataFrame) -> DataFrame:
    """node and ends_sha256 of nodes where conversations end."""
    ends = members.where("depth = n").select("node", "conv")
    pieces = ends.repartitionByRange("node", "conv").sortWithinPartitions("node", "conv").mapInArrow(_pieces, "node binary, first long, text string")
    return pieces.repartition("node").sortWithinPartitions("node", "first").mapInArrow(_digests, "node binary, ends_sha256 string")


def prefix_trie(turns: DataFrame) -> DataFrame:
    """Nodes of the trie of conversations given as conv_id, at, role, text (places from 1 without gaps; one row of null ``at`` for a conversation without turns).

    One row per node: conv_id (its smallest member), depth, parent_conv_id (null at the root), n_convs, n_children, n_leaves (nodes without children in its
    subtree), saved_tokens ((members - 1) times the characters of the node's last text, summed over the subtree) and ends_sha256 (of the comma-joined ascending ids of
    members that end there). Null roles and texts count as empty. A table without conversations gives no rows; the root of all others has no text. Other
    columns are not read.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    content = F.concat(F.length(role).cast("string"), F.lit(":"), role, text)
    each = stage(turns.select(F.col("conv_id").alias("conv"), (F.col("at") - 1).cast("long").alias("i"), _name(content.cast("binary")).alias("h"), F.length(text).cast("long").alias("chars")), "trie-turns")
    lengths = stage(each.groupBy("conv").agg(F.count("i").alias("n")), "trie-lengths")
    longest = lengths.agg(F.max("n")).first()[0] or 0
    levels = int(longest).bit_length()
    present = each.where("i IS NOT NULL")
    blocks = _blocks(present, levels)
    spans = _spans(lengths, blocks, levels)
    # Members: the root's, and for each turn the prefix that it ends.
    steps = present.alias("t").join(spans[0].where("next IS NOT NULL").alias("s"), ["conv", "i"]).select(
        "conv", (F.col("i") + 1).alias("depth"), F.col("next").alias("node"), F.col("root").alias("parent"), "chars") if levels else None
    root = lengths.select("conv", F.lit(0).cast("long").alias("depth"), _root().alias("node"), F.lit(None).cast("binary").alias("parent"), F.lit(0).cast("long").alias("chars"))
    members = (root.unionByName(steps) if levels else root).join(lengths, "conv")
    members = stage(members, "trie-members")
    nodes = members.groupBy("node", "depth").agg(F.min("conv").alias("conv_id"), F.count("*").alias("n_convs"), F.min("parent").alias("parent"), F.max("chars").alias("chars"), F.max("n").alias("longest"))
    nodes = stage(nodes.select("node", "depth", "conv_id", "n_convs", "parent", (F.col("longest") == F.col("depth")).cast("long").alias("leaves"),
                               ((F.col("n_convs") - 1) * F.col("chars")).alias("saved")), "trie-nodes")
    below = _below(nodes, spans, levels).select("node", F.col("leaves").alias("more_leaves"), F.col("saved").alias("more_saved"))
    children = nodes.where("parent IS NOT NULL").groupBy(F.col("parent").alias("node")).agg(F.count("*").alias("n_children"))
    named = nodes.select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    zero = lambda c: F.coalesce(c, F.lit(0).cast("long"))
    return (nodes.join(below, "node", "left").join(children, "node", "left").join(_ends(members), "node", "left").join(named, "parent", "left")
            .select("conv_id", "depth", "parent_conv_id", "n_convs", zero(F.col("n_children")).alias("n_children"), (F.col("leaves") + zero(F.col("more_leaves"))).alias("n_leaves"),
                    (F.col("saved") + zero(F.col("more_saved"))).alias("saved_tokens"), F.coalesce("ends_sha256", F.lit(hashlib.sha256().hexdigest())).alias("ends_sha256")))


def oracle(group: int = 100, most: int = 6) -> str:
    """The registered form in SQL: prefixes spelled out, subtrees by joining nodes with the prefixes of their smallest member."""
    step = "list_reduce([c] || [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[], lambda a, b: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END)"
    return f"""
WITH RECURSIVE own AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS pos
  FROM conversations WHERE conv_id IS NOT NULL),
digits(conv_id, rest, c) AS (
  SELECT DISTINCT conv_id, conv_id::VARCHAR, 4294967295::BIGINT FROM own
  UNION ALL
  SELECT conv_id, rest[2:], {step} FROM (SELECT conv_id, rest, xor(c, ascii(rest[1])::BIGINT) AS c FROM digits WHERE rest <> '') d),
heads AS (SELECT conv_id, xor(c, 4294967295) % {most} AS h, conv_id - conv_id % {group} AS base FROM digits WHERE rest = ''),
whole AS (
  SELECT h.conv_id, o.pos, 0 AS tail, o.role, o.text FROM heads h JOIN own o ON o.conv_id = h.base AND o.pos <= h.h
  UNION ALL
  SELECT h.conv_id, o.pos, 1, o.role, o.text FROM heads h JOIN own o ON o.conv_id = h.conv_id AND o.pos > h.h),
t AS (SELECT conv_id AS c, row_number() OVER (PARTITION BY conv_id ORDER BY tail, pos) AS d, md5(length(role) || ':' || role || text) AS h, length(text) AS chars FROM whole),
p AS (SELECT c, d, chars, md5(string_agg(h, ' ') OVER (PARTITION BY c ORDER BY d)) AS node FROM t
      UNION ALL SELECT conv_id, 0, 0, md5('') FROM heads),
m AS (SELECT *, max(d) OVER (PARTITION BY c) AS n, lag(node) OVER (PARTITION BY c ORDER BY d) AS parent FROM p),
nodes AS (SELECT node, any_value(d) AS d, min(c) AS conv, count(*) AS n_convs, any_value(parent) AS parent, (max(n) = any_value(d))::BIGINT AS leaf,
                 (count(*) - 1) * any_value(chars) AS saved, coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (WHERE d = n), '') AS ends
          FROM m GROUP BY node),
under AS (SELECT m.node, sum(x.leaf)::BIGINT AS n_leaves, sum(x.saved)::BIGINT AS saved_tokens FROM nodes x JOIN m ON m.c = x.conv AND m.d <= x.d GROUP BY m.node)
SELECT nodes.conv AS conv_id, nodes.d::BIGINT AS depth, up.conv AS parent_conv_id, nodes.n_convs,
       (SELECT count(*) FROM nodes k WHERE k.parent = nodes.node) AS n_children, n_leaves, saved_tokens, sha256(nodes.ends) AS ends_sha256
FROM nodes JOIN under USING (node) LEFT JOIN nodes up ON up.node = nodes.parent"""


__all__ = ["numbered", "oracle", "prefix_trie", "shared_heads"]
