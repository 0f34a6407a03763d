"""Mixing sources to target weights by Pareto order sampling.

A source of size S and target T is taken T / S times: each of its documents floor(T / S) times for certain, and a part of them
once more. For that part every document gets an inclusion probability l in proportion to its size, scaled so that the expected size is the wanted
one. Documents whose probability would be 1 or more are certain: they are taken once more and the others share what is left. The others
have a random number u fixed by their id and are ranked by (u / (1 - u)) / (l / (1 - l)), random odds over inclusion odds; the first ones are taken until
the wanted size is reached to within half a document. All of it is DataFrame functions. Probabilities come from one row per source and size. Ranks are
summed in two steps, per (source, rank bucket) and inside each bucket, so that no task holds a source; documents that need no rank get none.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from liftplan.llm.shared import free_names, stage

#: Rank buckets of a source; each holds an equal share of it on average.
BUCKETS = 4096
MOST_COPIES = 3
WEIGHTS = (5, 2, 1)
_WORDS = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    """Number of words; null: 0."""
    return F.coalesce(F.regexp_count(text, F.lit(_WORDS)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, most: int = MOST_COPIES) -> DataFrame:
    """Targets of sources: ``sizes`` (source, source_size) with source_no and target.

    Sources by code point (null last) weigh ``weights``, repeating. Targets share the sum of all sizes; one over ``most`` times its
    source's size stops there and the rest is shared again by weight. That ends at a level x with target = min(weight * x,
    most * size): sources in rising order of most * size / weight are full up to the first that the rest does not fill.
    One row per source is brought together; documents are not.
    """
    by_name = Window.orderBy(F.col("source").isNull(), "source")
    numbered = sizes.withColumn("source_no", F.row_number().over(by_name)).withColumn(
        "weight", F.element_at(F.array(*[F.lit(int(w)) for w in weights]), ((F.col("source_no") - 1) % len(weights) + 1).cast("int")).cast("long"))
    by_fill = Window.orderBy(F.col("source_size") / F.col("weight"), "source_no")
    total = F.sum("source_size").over(Window.partitionBy(F.lit(0)))
    full = F.coalesce(F.sum("source_size").over(by_fill.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)) * most
    open_weight = F.sum("weight").over(by_fill.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    level = (total - full).cast("double") / open_weight
    fits = F.col("level") * F.col("weight") <= F.col("source_size") * most
    first = F.min(F.when(F.col("fits"), F.struct("fill_no", "level"))).over(Window.partitionBy(F.lit(0)))
    return (numbered.withColumn("fill_no", F.row_number().over(by_fill)).withColumn("level", level).withColumn("fits", fits)
            .withColumn("first", first)
            .withColumn("target", F.when(F.col("fill_no") >= F.col("first.fill_no"), F.col("weight") * F.col("first.level"))
                        .otherwise((F.col("source_size") * most).cast("double")))
            .select("source", "source_no", "source_size", "target"))


def random_number(doc_id: Column, seed: int) -> Column:
    """A number over 0 and under 1, fixed by the id and the seed; a null id counts as the text "null"."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("null"))))
    return (F.conv(F.substring(digest, 1, 12), 16, 10).cast("long") + 0.5) / float(1 << 48)


def _least_key(doc_id: Column) -> Column:
    return F.coalesce(doc_id, F.lit(-(1 << 63)))


def mix_sources(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", favour_col: str | None = None,
                weights: Sequence[int] = WEIGHTS, most: int = MOST_COPIES, seed: int = 7, buckets: int = BUCKETS) -> DataFrame:
    """doc_id, source, size, source_size, target, copies and taken (size * copies) of each row; reruns agree.

    Inclusion odds grow with the size; ``favour_col`` (positive numbers, null: 1) multiplies them. A null or empty text has size 0 and probability 0,
    so that it has whole copies only; null sources are one source, the last; equal ids have equal random numbers and
    stand in the order of their texts' hashes. An empty table gives an empty result.
    """
    return _mixed(docs, id_col, text_col, source_col, favour_col, weights, most, seed, buckets).select(
        "doc_id", "source", "size", "source_size", "target", "copies", (F.col("size") * F.col("copies")).alias("taken"))


def _favour(favour_col: str | None) -> Column:
    favour = F.col(f"`{favour_col}`").cast("double") if favour_col else F.lit(1.0)
    return F.coalesce(F.when(favour > 0, favour), F.lit(1.0))


def _rank(doc_id: Column, chance: Column, favour: Column, seed: int) -> Column:
    """Random odds over inclusion odds; null for documents that are certain or have no chance."""
    u = random_number(doc_id, seed)
    return F.when((chance > 0) & (chance < 1), (u / (1 - u)) / (chance / (1 - chance) * favour))


def _chances(rows: DataFrame, targets: DataFrame) -> DataFrame:
    """Targets with ``per_word``, the inclusion probability per word, ``largest``, the largest size that is not certain, and ``rest``, the size wanted of others.

    From the largest size down, a size is certain as long as its probability, with all larger ones certain, is 1 or more.
    """
    sizes = rows.where("size > 0").groupBy("source", "size").agg(F.count("*").alias("n"))
    each = sizes.join(targets.where("part > 0"), sizes["source"].eqNullSafe(targets["source"])).select("source_no", "wanted", "size", "n")
    # One row per source and size.
    down = Window.partitionBy("source_no").orderBy(F.desc("size")).rowsBetween(Window.unboundedPreceding, -1)
    up = Window.partitionBy("source_no").orderBy("size").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    larger = F.coalesce(F.sum(F.col("size") * F.col("n")).over(down), F.lit(0))
    squares = F.sum(F.col("size") * F.col("size") * F.col("n")).over(up)
    each = each.withColumn("rest", F.col("wanted") - larger).withColumn("per_word", F.col("rest") / squares.cast("double"))
    open_sizes = each.where(F.col("per_word") * F.col("size") < 1).groupBy("source_no").agg(F.max_by(F.struct("per_word", F.col("size").alias("largest"), "rest"), "size").alias("open"))
    return targets.join(open_sizes, "source_no", "left").select(*targets.columns, "open.per_word", "open.largest", "open.rest")


def _chance(size: Column, part: Column, per_word: Column, largest: Column) -> Column:
    """Inclusion probability of a document; 1 for those larger than every size that is not certain."""
    return F.when((part > 0) & (size > 0), F.when(largest.isNull() | (size > largest), F.lit(1.0)).otherwise(per_word * size)).otherwise(F.lit(0.0))


def _mixed(docs, id_col, text_col, source_col, favour_col, weights, most, seed, buckets) -> DataFrame:
    text = F.col(f"`{text_col}`")
    rows = stage(docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{source_col}`").cast("string").alias("source"),
                             word_count(text).alias("size"), F.md5(F.coalesce(text, F.lit(""))).alias("tie"), _favour(favour_col).alias("favour")), "mix-sizes")
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets = source_targets(sizes, weights, most)
    times = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    targets = (targets.withColumn("whole", F.floor(times)).withColumn("part", times - F.col("whole"))
               .withColumn("wanted", F.col("target") - F.col("whole") * F.col("source_size")))
    targets = stage(_chances(rows, stage(targets, "mix-targets")), "mix-chances")
    chance = _chance(F.col("size"), F.col("part"), F.col("per_word"), F.col("largest"))
    each = (rows.join(targets, rows["source"].eqNullSafe(targets["source"])).drop(targets["source"]).withColumn("chance", chance)
            .withColumn("rank", _rank(F.col("doc_id"), F.col("chance"), F.col("favour"), seed)))
    # Were all chances equal, this share of the documents would stand before the rank; so buckets are of like size.
    share = F.col("rank") * F.col("part") / (1 - F.col("part") + F.col("rank") * F.col("part"))
    ranked = each.where("rank IS NOT NULL").withColumn("bucket", F.floor(share * buckets).cast("int"))
    inside = Window.partitionBy("source_no", "bucket").orderBy("rank", "doc_id", "tie").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    along = Window.partitionBy("source_no").orderBy("bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    sums = ranked.groupBy("source_no", "bucket").agg(F.sum("size").alias("bucket_size"))
    sums = sums.select("source_no", "bucket", (F.sum("bucket_size").over(along) - F.col("bucket_size")).alias("before_bucket"))
    before = F.col("before_bucket") + F.sum("size").over(inside) - F.col("size")
    placed = ranked.join(sums, ["source_no", "bucket"]).withColumn("more", before + F.col("size") / 2 <= F.col("rest")).select(*each.columns, "more")
    unranked = each.where("rank IS NULL").withColumn("more", F.col("chance") >= 1)
    return placed.unionByName(unranked).withColumn("copies", (F.col("whole") + F.when(F.col("more"), 1).otherwise(0)).cast("int"))


def take_mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", favour_col: str | None = None,
             weights: Sequence[int] = WEIGHTS, most: int = MOST_COPIES, seed: int = 7, buckets: int = BUCKETS) -> DataFrame:
    """The rows themselves, with all columns, each as often as the mix takes it.

    The mix comes down to one last place per source in the rank order, so texts are read where they lie and not moved. Rows that repeat an id and
    a text have one place and are taken alike. Null texts have no words, null sources are one source, the last; an empty table gives an empty result.
    """
    mixed = _mixed(docs, id_col, text_col, source_col, favour_col, weights, most, seed, buckets)
    last = F.max(F.when(F.col("more") & F.col("rank").isNotNull(), F.struct("rank", _least_key(F.col("doc_id")).alias("id"), "tie")))
    source, law, end, chance, copy = free_names(docs, "source", "law", "last", "chance", "copy")
    cuts = stage(mixed.groupBy(F.col("source").alias(source)).agg(F.first(F.struct("whole", "part", "per_word", "largest")).alias(law), last.alias(end)), "mix-cuts")
    doc_id, text = F.col(f"`{id_col}`").cast("long"), F.col(f"`{text_col}`")
    rank = _rank(doc_id, F.col(chance), _favour(favour_col), seed)
    own = F.struct(rank.alias("rank"), _least_key(doc_id).alias("id"), F.md5(F.coalesce(text, F.lit(""))).alias("tie"))
    more = (F.col(chance) >= 1) | (rank.isNotNull() & (own <= F.col(end)))
    copies = (F.col(law)["whole"] + F.when(more, 1).otherwise(0)).cast("int")
    taken = docs.join(cuts, F.col(f"`{source_col}`").cast("string").eqNullSafe(F.col(source)))
    taken = taken.withColumn(chance, _chance(word_count(text), F.col(law)["part"], F.col(law)["per_word"], F.col(law)["largest"]))
    return taken.withColumn(copy, F.explode(F.array_repeat(F.lit(0), copies))).select(*[docs[f"`{c}`"] for c in docs.columns])


def oracle(weights: Sequence[int] = WEIGHTS, most: int = MOST_COPIES, seed: int = 7) -> str:
    """The same as one SQL text for DuckDB: doc_id, size, source_size, target, taken."""
    listed = ", ".join(str(w) for w in weights)
    return f"""
WITH rows AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS size, md5(coalesce(text, '')) AS tie,
         (('0x' || substr(md5('{seed}:' || coalesce(doc_id::VARCHAR, 'null')), 1, 12))::BIGINT + 0.5::DOUBLE) / {float(1 << 48)}::DOUBLE AS u
  FROM documents),
sizes AS (SELECT source, sum(size)::BIGINT AS source_size FROM rows GROUP BY source),
numbered AS (SELECT *, row_number() OVER (ORDER BY source IS NULL, source COLLATE "C") AS source_no FROM sizes),
weighed AS (SELECT *, ([{listed}])[((source_no - 1) % {len(weights)} + 1)::INT]::BIGINT AS weight FROM numbered),
filled AS (
  SELECT *, row_number() OVER f AS fill_no,
         ((sum(source_size) OVER () - coalesce(sum(source_size) OVER (f ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) * {most})::DOUBLE
          / (sum(weight) OVER (f ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::DOUBLE) AS level
  FROM weighed WINDOW f AS (ORDER BY source_size::DOUBLE / weight::DOUBLE, source_no)),
first AS (SELECT min(fill_no) AS fill_no, arg_min(level, fill_no) AS level FROM filled WHERE level * weight::DOUBLE <= (source_size * {most})::DOUBLE),
targets AS (
  SELECT filled.source, source_size, CASE WHEN filled.fill_no >= first.fill_no THEN weight::DOUBLE * first.level ELSE (source_size * {most})::DOUBLE END AS target
  FROM filled, first),
times AS (SELECT *, CASE WHEN source_size > 0 THEN target / source_size::DOUBLE ELSE 0 END AS times FROM targets),
each AS (SELECT source, size, count(*) AS n FROM rows WHERE size > 0 GROUP BY 1, 2),
steps AS (
  SELECT each.source, each.size, (target - floor(times) * source_size::DOUBLE) - coalesce(sum(size * n) OVER (down ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::DOUBLE AS rest,
         sum(size * size * n) OVER (PARTITION BY each.source ORDER BY size ROWS UNBOUNDED PRECEDING)::DOUBLE AS squares
  FROM each JOIN times ON each.source IS NOT DISTINCT FROM times.source WHERE times - floor(times) > 0 WINDOW down AS (PARTITION BY each.source ORDER BY size DESC)),
laws AS (SELECT source, max(size) AS largest, arg_max(rest / squares, size) AS per_word, arg_max(rest, size) AS rest FROM steps WHERE rest / squares * size::DOUBLE < 1 GROUP BY source),
chances AS (
  SELECT rows.*, source_size, target, floor(times)::BIGINT AS whole, rest,
         CASE WHEN times - floor(times) > 0 AND size > 0 THEN CASE WHEN largest IS NULL OR size > largest THEN 1 ELSE per_word * size::DOUBLE END ELSE 0 END AS chance
  FROM rows JOIN times ON rows.source IS NOT DISTINCT FROM times.source LEFT JOIN laws ON rows.source IS NOT DISTINCT FROM laws.source),
ranked AS (SELECT *, (u / (1 - u)) / (chance / (1 - chance) * 1::DOUBLE) AS rank FROM chances WHERE chance > 0 AND chance < 1),
summed AS (
  SELECT *, sum(size) OVER (PARTITION BY source ORDER BY rank, doc_id NULLS FIRST, tie ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - size AS before
  FROM ranked),
taken AS (
  SELECT doc_id, size, source_size, target, whole, before::DOUBLE + size::DOUBLE / 2 <= rest AS more FROM summed
  UNION ALL SELECT doc_id, size, source_size, target, whole, chance >= 1 FROM chances WHERE NOT (chance > 0 AND chance < 1))
SELECT doc_id, size, source_size, target, (size * (whole + CASE WHEN more THEN 1 ELSE 0 END))::BIGINT AS taken FROM taken"""
