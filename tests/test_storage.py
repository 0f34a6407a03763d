"""Known keys, layouts by key and month, versions of tables, and counts of what is written."""

import random
import re
import time
from collections import Counter
from dataclasses import replace as replaced

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from liftplan.operators import aggregate, joins
from liftplan.operators.keyed import Keyed, key_set
from liftplan.plans import contract_raw, history
from liftplan.session import stage_by_key, staging
from liftplan.sources import (
    Catalog, TableSpec, append, curated_scan, drop_versions, keyed_scan, merge_partitions, read_table, replace, safe_replace, write_outputs,
)
from liftplan.suite import jobs
from liftplan.suite.registry import AS_OF, Inputs
from tests.test_operators import bag, frames, small_skew  # noqa: F401


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def keys_of(keyed):
    return {tuple(sorted(k)) for k in keyed.keys}


# ---- keys ----


def test_keys_follow_the_steps_that_keep_them(spark):
    t = Keyed(spark.createDataFrame([(1, 2, "x")], "A int, b int, c string"), key_set([("a",), ("b", "c"), ("a", "b")]))
    assert keys_of(t) == {("a",), ("b", "c")}  # a wider key says nothing new
    assert keys_of(t.where("a = 1")) == {("a",), ("b", "c")}
    assert keys_of(t.select("A", "c")) == {("a",)} and keys_of(t.select("c")) == set()
    assert keys_of(t.renamed({"A": "id", "c": "name"})) == {("id",), ("b", "name")}
    assert keys_of(t.with_columns({"b": F.lit(1), "d": F.lit(2)})) == {("a",)} and keys_of(t.drop("a")) == {("b", "c")}
    assert t.unique_over(["C", "B", "z"]) and not t.unique_over(["c"])
    assert t.distinct() is t and keys_of(t.select("c").distinct()) == {("c",)}
    assert t.best(["a", "c"], ["b"]) is t and keys_of(Keyed(t.df).best(["c"], ["b"])) == {("c",)}


def test_keys_of_lookups(spark):
    left = Keyed(spark.createDataFrame([(1, 7), (2, 8)], "k int, v int"), key_set([("k",)]))
    one = Keyed(spark.createDataFrame([(7, "a")], "id int, name string"), key_set([("id",)]))
    many = Keyed(spark.createDataFrame([(7, 1, "a"), (7, 2, "b")], "id int, n int, name string"), key_set([("id", "n")]))
    assert keys_of(joins.lookup(left, one, {"v": "id"}, {"name": "name"})) == {("k",)}
    got = joins.lookup(left, many, {"v": "id"}, {"line": "n", "name": "name"}, details=True)
    assert keys_of(got) == {("k", "line", "v")} and got.df.count() == got.df.select("k", "line").distinct().count() == 3
    assert keys_of(joins.lookup(left, many, {"v": "id"}, {"name": "name"})) == set()  # the part of the key that tells rows apart is gone
    assert keys_of(joins.lookup(left, many, {"v": "id"}, {"name": "name"}, one_to_one=["n"])) == {("k",)}
    assert keys_of(joins.lookup(left, one.df, {"v": "id"}, {"name": "name"})) == set()
    filled = joins.lookup(left, Keyed(one.df.selectExpr("id", "id as k"), one.keys), {"v": "id"}, {"k": "k"}, fill=True)
    assert keys_of(filled) == set()  # a filled column may repeat


@pytest.mark.parametrize("seed", range(3))
def test_lookup_of_a_known_key_equals_the_left_join(spark, seed):
    a, b = frames(spark, seed, [1, 2, 3, None], [2, 3, 4, None])
    b = b.where("kb IS NOT NULL").groupBy("kb").agg(F.min("vb").alias("vb"))
    known = Keyed(b, key_set([("kb",)]))
    got = joins.lookup(a, known, {"ka": "kb"}, {"vb": "vb"}, details=True)
    assert bag(got) == bag(a.join(b, F.col("ka") == F.col("kb"), "left").select("ka", "va", "vb"))
    assert got._jdf.queryExecution().optimizedPlan().toString().count("Join ") == 1


def test_scan_of_a_declared_key_has_no_distinct(spark, tmp_path):
    spark.range(50).selectExpr("id", "id % 5 AS g").write.parquet(str(tmp_path / "t"))
    catalog = Catalog.of_zone("parquet", str(tmp_path), ["t"], unique={"t": [("ID",)]})
    assert "Aggregate" not in plan_of(curated_scan(spark, catalog, "t", where=F.col("g") > 0, columns=["id", "g"]))
    assert "Aggregate" in plan_of(curated_scan(spark, catalog, "t", columns=["g"]))
    assert keys_of(keyed_scan(spark, catalog, "t", rename={"id": "no"})) == {("no",)}
    assert keys_of(keyed_scan(spark, catalog, "t", columns=["g"])) == {("g",)}
    bound = Catalog({"t": catalog.spec("t")}).bind("t", spark.range(3))  # a bound frame has only its own keys
    assert "Aggregate" in plan_of(curated_scan(spark, bound, "t"))


def test_raw_jobs_with_and_without_keys(spark):
    """Keys change the plan, not the rows."""
    inputs = Inputs(spark, "/root/testdata/sf0.001")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for run, name, most in ((contract_raw.run_summed, "contract_rows", 32), (contract_raw.run_mapped, "mapped_rows", 42)):
            known = run(spark, inputs.domain, AS_OF, jobs.CONTRACT)[name]
            bare = Catalog()
            for table in ("contract_header", "contract_item", "document_flow", "contract_commercial", "price_condition", "billing_item", "billing_header",
                          "customer_name", "material_master", "site", "movement", "movement_quantity", "purchase_header"):
                bare.bind(table, inputs.domain.frame(table))
            plain = run(spark, bare, AS_OF, jobs.CONTRACT)[name]
            count = lambda df: len(re.findall(r"\bExchange\b", plan_of(df)))
            assert count(known) <= most < count(plain)
            assert bag(known) == bag(plain)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


# ---- layout by key ----


def test_joins_on_a_staged_key_do_not_shuffle(spark):
    r = random.Random(1)
    a = [(r.choice([None, *range(40)]), i) for i in range(300)]
    b = [(r.choice([None, *range(60)]), i) for i in range(200)]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        with staging(spark):
            left = stage_by_key(spark.createDataFrame(a, "k int, v int"), "left", ["k"], 6)
            right = stage_by_key(spark.createDataFrame(b, "k2 int, w int"), "right", ["k2"], 6)
            sums = right.groupBy("k2").agg(F.sum("w").alias("total"))
            df = joins.lookup(joins.lookup(left, right, {"k": "k2"}, {"w": "w"}), sums, {"k": "k2"}, {"total": "total"})
            plan = plan_of(df)
            assert "Exchange" not in plan and plan.count("SortMergeJoin") == 2
            totals = Counter()
            for k, w in b:
                totals[k] += w
            want = Counter()
            for k, v in a:
                met = [w for k2, w in b if k is not None and k2 == k]
                want.update([(k, v, w, totals[k]) for w in met] or [(k, v, None, None)])
            assert bag(df) == want
            names = [t.name for t in spark.catalog.listTables() if t.name.startswith(("left_", "right_"))]
            assert len(names) == 2
        assert not [t for t in spark.catalog.listTables() if t.name in names]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


# ---- full join ----


@pytest.mark.parametrize("side", ["left", "right"])
def test_full_join_splits_a_hot_key_of_either_side(spark, small_skew, side):  # noqa: F811
    hot = spark.range(0, 60_000, 1, 8).select(F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).alias("k"), F.col("id").alias("v"))
    other = spark.range(0, 90_000, 2, 8).select(F.col("id").alias("p"), F.lit("x").alias("x"))
    df = joins.full_join_fill(hot, other, {"k": "p"}) if side == "left" else joins.full_join_fill(other, hot, {"p": "k"})
    want = hot.join(other, F.col("k") == F.col("p"), "full")
    df = df.select("k", "v", "p", "x")
    assert bag(df) == bag(want)
    assert "skewed" in plan_of(df)


def test_full_join_reads_whole_rows_once(spark, tmp_path):
    spark.range(10).selectExpr("id AS ka", "id AS va").write.parquet(str(tmp_path / "a"))
    spark.range(5, 15).selectExpr("id AS kb", "id AS vb").write.parquet(str(tmp_path / "b"))
    a, b = spark.read.parquet(str(tmp_path / "a")), spark.read.parquet(str(tmp_path / "b"))
    plan = joins.full_join_fill(a, b, {"ka": "kb"})._jdf.queryExecution().optimizedPlan().toString()
    schemas = re.findall(r"Relation \[([^\]]*)\]", plan)
    assert len(schemas) == 4 and "FullOuter" not in plan and "LeftAnti" not in plan
    read = plan_of(joins.full_join_fill(a, b, {"ka": "kb"}))
    assert len(re.findall(r"ReadSchema: struct<ka:bigint,va:bigint>", read)) == 1 and len(re.findall(r"ReadSchema: struct<kb:bigint,vb:bigint>", read)) == 1


def test_full_join_on_two_keys_with_nulls(spark):
    a = spark.createDataFrame([(1, "x", 1), (1, None, 2), (None, None, 3), (2, "y", 4), (2, "y", 5)], "a int, b string, v int")
    b = spark.createDataFrame([(1, "x", 1), (1, "x", 2), (1, None, 3), (None, None, 4), (3, "z", 5)], "c int, d string, w int")
    got = joins.full_join_fill(a, b, {"a": "c", "b": "d"})
    assert bag(got) == bag(a.join(b, (F.col("a") == F.col("c")) & (F.col("b") == F.col("d")), "full"))
    assert bag(joins.full_join_fill(a, b.limit(0), {"a": "c", "b": "d"})) == bag(a.join(b.limit(0), F.col("a") == F.col("c"), "full"))
    assert bag(joins.full_join_fill(a.limit(0), b, {"a": "c", "b": "d"})) == bag(a.limit(0).join(b, F.col("a") == F.col("c"), "full"))


# ---- versions ----


def rows(spark, spec):
    return sorted(tuple(r) for r in read_table(spark, Catalog({"t": spec}), "t").collect())


def test_reader_opened_before_the_switch_finishes(spark, tmp_path):
    spec = TableSpec("parquet", str(tmp_path / "t"))
    replace(spark.range(3), spec)
    readers = [read_table(spark, Catalog({"t": spec}), "t")]
    for n in (4, 5):
        safe_replace(spark.range(n), spec)
        readers.append(read_table(spark, Catalog({"t": spec}), "t"))
    assert [df.count() for df in readers] == [3, 4, 5]
    assert drop_versions(spark, spec, older_than=3600) == []
    gone = drop_versions(spark, spec, older_than=60, now=time.time() + 100)
    assert len(gone) >= 2 and rows(spark, spec) == [(i,) for i in range(5)]
    assert len([p for p in (tmp_path / "t").iterdir() if p.name.startswith("_version-")]) == 1
    assert drop_versions(spark, spec, older_than=0) == [] and drop_versions(spark, TableSpec("parquet", str(tmp_path / "none")), 0) == []


def test_replace_of_a_table_with_versions_adds_one(spark, tmp_path):
    spec = TableSpec("parquet", str(tmp_path / "t"))
    safe_replace(spark.range(3), spec)
    old = read_table(spark, Catalog({"t": spec}), "t")
    replace(old.where("id > 0"), spec)  # reads what it replaces
    assert old.count() == 3 and rows(spark, spec) == [(1,), (2,)]


def test_files_of_a_run_that_is_still_writing_stay(spark, tmp_path):
    spec = TableSpec("parquet", str(tmp_path / "t"))
    safe_replace(spark.range(3), spec)
    (tmp_path / "t" / "_version-running").mkdir()
    safe_replace(spark.range(4), spec)
    assert (tmp_path / "t" / "_version-running").exists()
    drop_versions(spark, spec, older_than=60, now=time.time() + 100)
    assert not (tmp_path / "t" / "_version-running").exists() and rows(spark, spec) == [(i,) for i in range(4)]


def files(folder):
    return {p: p.stat().st_mtime_ns for p in folder.rglob("*.parquet")}


def test_merge_leaves_untouched_partitions_alone(spark, tmp_path):
    spec = TableSpec("parquet", str(tmp_path / "t"))
    frame = lambda values: spark.createDataFrame(values, "id long, month string, v string")
    replace(frame([(i, f"m{i % 4}", "old") for i in range(40)] + [(99, None, "old")]), spec, partition_by=["month"])
    before = files(tmp_path / "t")
    reader = read_table(spark, Catalog({"t": spec}), "t")
    assert merge_partitions(frame([(1, "m1", "new"), (7, "m9", "new")]), spec, ["month"]) == ["month=m1", "month=m9"]
    want = sorted([(i, "old", f"m{i % 4}") for i in range(40) if i % 4 != 1] + [(1, "new", "m1"), (7, "new", "m9"), (99, "old", None)], key=str)
    table = lambda: read_table(spark, Catalog({"t": spec}), "t").select("id", "v", "month")
    assert sorted(map(tuple, table().collect()), key=str) == want
    after = files(tmp_path / "t")
    assert {p: after[p] for p in before} == before and reader.count() == 41
    # A second merge refers to folders of both versions, and a filter on the partition reads its folder only.
    merge_partitions(frame([(2, "m2", "newer")]), spec, ["month"])
    assert table().where("month = 'm2'").collect()[0]["v"] == "newer" and table().where("month = 'm1'").count() == 1
    assert table().count() == 10 + 10 + 1 + 1 + 1 + 1
    # Old folders that nothing refers to go after the grace period, the others stay.
    drop_versions(spark, spec, older_than=0, now=time.time() + 10)
    assert table().count() == 24 and not (tmp_path / "t" / "month=m1").exists() and (tmp_path / "t" / "month=m0").exists()
    append(frame([(500, "m0", "added")]), spec, partition_by=["month"])
    assert table().where("month = 'm0'").count() == 11 and table().count() == 25
    safe_replace(table(), spec, partition_by=["month"], grace_seconds=0)
    assert table().count() == 25 and not (tmp_path / "t" / "month=m0").exists()


def test_merge_needs_a_partitioned_file_table(spark, tmp_path):
    spec = TableSpec("parquet", str(tmp_path / "t"))
    replace(spark.range(3).selectExpr("id", "id AS p"), spec)
    with pytest.raises(ValueError):
        merge_partitions(spark.range(2).selectExpr("id", "id AS p"), spec, ["p"])
    with pytest.raises(ValueError):
        merge_partitions(spark.range(2), spec, [])
    new = TableSpec("parquet", str(tmp_path / "new"))
    assert merge_partitions(spark.range(2).selectExpr("id", "id AS p"), new, ["p"]) == ["p=0", "p=1"] and rows(spark, new) == [(0, 0), (1, 1)]


@pytest.mark.parametrize("unique", [True, False])
def test_history_merge_of_touched_partitions(spark, tmp_path, unique):
    specs = {n: TableSpec("parquet", str(tmp_path / n)) for n in ("now", "past")}
    schema = "key string, period string, v double, w double"
    past = [(k, f"20240{p}", float(i), float(i)) for i, (k, p) in enumerate((k, p) for k in "abc" for p in range(1, 6))]
    now = [("a", "202402", 50.0, None), ("z", "202402", None, None), ("q", "202407", 1.0, 2.0)]
    replace(spark.createDataFrame(past, schema), specs["past"], partition_by=["period"])
    replace(spark.createDataFrame(now, schema), specs["now"])
    kept = {p: t for p, t in files(tmp_path / "past").items() if "202402" not in str(p)}
    catalog, keys = Catalog(specs), ["key", "period"]
    whole = joins.merge_newer(read_table(spark, catalog, "past"), read_table(spark, catalog, "now"), keys).select("key", F.col("period").cast("string"), "v", "w")
    want = bag(whole)
    counts = history.merge_touched(spark, catalog, "now", "past", keys, ["period"], unique)
    assert counts == {"current": 3, "history": 3, "merged": 5, "partitions": 2} or not unique and counts["merged"] == 5 and counts["partitions"] == 2
    assert bag(read_table(spark, catalog, "past").select("key", F.col("period").cast("string"), "v", "w")) == want
    assert {p: files(tmp_path / "past")[p] for p in kept} == kept
    with pytest.raises(ValueError):
        history.merge_touched(spark, catalog, "now", "past", ["key"], ["period"])


# ---- counts, pieces, months ----


def test_rows_are_counted_as_they_are_written(spark, tmp_path):
    df = spark.range(1000)
    specs = {n: TableSpec("parquet", str(tmp_path / n)) for n in ("all", "some", "none")}
    made = {"all": df, "some": df.where("id % 3 = 0"), "none": df.where("id < 0")}
    seen = spark.sparkContext.accumulator(0)
    assert write_outputs(spark, lambda: made, specs) == {"all": 1000, "some": 334, "none": 0} and seen.value == 0
    again = {r["frame"]: r["n_rows"] for r in aggregate.reconcile(**{n: read_table(spark, Catalog(specs), n) for n in ("all", "some")}).collect()}
    assert again == {"all": 1000, "some": 334}


@pytest.mark.parametrize("size", [1, 7, 1000])
def test_pieces_join_to_the_whole_text(spark, size):
    r = random.Random(size)
    data = [(r.choice(["a", "b", None]), r.choice([None, "", "x", "yy", "zzz" * 5])) for _ in range(400)] + [("alone", None), ("alone", None), ("one", "t")]
    df = spark.createDataFrame(data, "k string, t string")
    pieces = aggregate.concat_pieces(df, ["k"], "t", ", ", size).collect()
    held = {}
    for p in sorted(pieces, key=lambda p: p["piece"]):
        held.setdefault(p["k"], []).append(p)
    assert all([p["piece"] for p in ps] == list(range(len(ps))) for ps in held.values())
    assert Counter((k, ", ".join(p["t"] for p in ps)) for k, ps in held.items()) == bag(aggregate.concat_text(df, ["k"], "t"))


def test_a_large_key_has_many_bounded_pieces(spark):
    df = spark.range(0, 1_000_000, 1, 8).select(F.lit("hot").alias("k"), F.format_string("%07d", "id").alias("t"))
    pieces = aggregate.concat_pieces(df, ["k"], "t", ",", 50_000)
    sizes = pieces.select(F.length("t").alias("n"), "piece", F.substring("t", 1, 7).cast("int").alias("first")).orderBy("piece").collect()
    assert max(s["n"] for s in sizes) <= 50_010 and len(sizes) >= 160
    assert [s["first"] for s in sizes] == sorted(s["first"] for s in sizes)
    assert sum(s["n"] + 1 for s in sizes) == 8_000_000


def test_text_dates_prune_month_folders(spark, tmp_path):
    spec = TableSpec("parquet", str(tmp_path / "t"), months={"day": "month"})
    days = ["20211231", "20220101", "20220228", "20220301", "20220315", "20220401", "2022", "", None, "20220399", "99999999"]
    replace(spark.createDataFrame(list(enumerate(days)), "id int, day string"), spec)
    catalog, day = Catalog({"t": spec}), lambda d: F.lit(d).cast("date")
    df = curated_scan(spark, catalog, "t", text_dates={"day": (day("2022-02-10"), day("2022-03-20"))})
    assert df.columns == ["id", "day"] and bag(df) == Counter({(2, "20220228"): 1, (3, "20220301"): 1, (4, "20220315"): 1})
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    filters = re.search(r"PartitionFilters: \[(.*?)\], P", plan_of(curated_scan(spark, catalog, "t", text_dates={"day": (day("2022-02-10"), day("2022-03-20"))})))[1]
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "month" in filters and "202202" in filters and "202203" in filters
    for p in (tmp_path / "t").rglob("*.parquet"):  # what cannot be read is not missed
        if not re.search(r"month=20220[23]", str(p)):
            p.write_bytes(b"no parquet")
            (p.parent / f".{p.name}.crc").unlink()
    known = Catalog({"t": replaced(spec, schema=T.StructType.fromDDL("id int, day string"))})
    assert bag(curated_scan(spark, known, "t", text_dates={"day": (day("2022-02-10"), day("2022-03-20"))})) == bag(df)
    replace(spark.createDataFrame(list(enumerate(days)), "id int, day string"), spec)
    open_start = curated_scan(spark, catalog, "t", text_dates={"day": (None, day("2022-01-05"))})
    assert bag(open_start) == Counter({(0, "20211231"): 1, (1, "20220101"): 1})
    plain = Catalog().bind("t", spark.createDataFrame(list(enumerate(days)), "id int, day string"))
    assert bag(curated_scan(spark, plain, "t", text_dates={"day": (day("2022-02-10"), day("2022-03-20"))})) == bag(df)
    append(spark.createDataFrame([(50, "20220302")], "id int, day string"), spec)
    assert curated_scan(spark, catalog, "t", text_dates={"day": (day("2022-03-02"), day("2022-03-02"))}).collect()[0]["id"] == 50
