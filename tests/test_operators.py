"""Operators against small fixtures and plain Python."""

import itertools
import random
from collections import Counter
from unittest.mock import MagicMock, call

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from liftplan.functions import dates, keys, numbers
from liftplan.operators import aggregate, columns, dedup, filters, joins, reshape
from liftplan.session import hadoop_fs, scratch_base, stage, staging
from liftplan.sources import Catalog, TableSpec, append, curated_scan, patch_rows, read_table, replace, safe_replace, write_outputs
from liftplan.sources.catalog import jdbc_options


def bag(df):
    return Counter(tuple(r) for r in df.collect())


def one(spark, expr):
    return spark.range(1).select(expr.alias("v")).first()["v"]


# ---- functions ----


@pytest.mark.parametrize("text, want", [("00012", "12"), ("000", ""), ("", ""), (None, None), ("0a0", "a0")])
def test_strip_zeros(spark, text, want):
    assert one(spark, keys.strip_zeros(F.lit(text).cast("string"))) == want


@pytest.mark.parametrize("text, want", [("20220105", "2022-01-05"), ("00000000", None), ("", None), (None, None), ("20221301", None)])
def test_parse_text_date(spark, text, want):
    got = one(spark, dates.parse_yyyymmdd(F.lit(text).cast("string")))
    assert (str(got) if got else None) == want


@pytest.mark.parametrize("text, want", [("0322900021000010", ("322900021", "10")), ("0322", ("322", "")), ("0" * 16, ("", "")), (None, (None, None))])
def test_split_composite(spark, text, want):
    a, b = keys.split_composite(F.lit(text).cast("string"))
    assert tuple(spark.range(1).select(a, b).first()) == want


def test_safe_division_and_numbers(spark):
    assert one(spark, numbers.safe_div(F.lit(1.0), F.lit(0.0))) is None
    assert one(spark, numbers.number_or_null(F.lit(""))) is None
    assert one(spark, numbers.number_or_null(F.lit("1.5"))) == 1.5


def test_composite_key_skips_nulls(spark):
    assert one(spark, keys.composite_key(F.lit("a"), F.lit(None).cast("string"), F.lit("b"))) == "ab"


# ---- filters ----


@pytest.mark.parametrize("until, last", [("year_end", "2022-12-31"), ("month_end", "2022-10-31"), (230, "2023-06-02")])
def test_in_period_ends(spark, until, last):
    days = spark.sql("SELECT explode(sequence(date'2022-01-01', date'2023-12-31')) AS d")
    got = days.where(filters.in_period("d", "2022-10-15", 100, until)).agg(F.min("d"), F.max("d")).first()
    assert [str(v) for v in got] == ["2022-07-07", last]


def test_remove_where_equals_bag_difference(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (2, None), (3, "b")], "k int, v string")
    pred = F.col("v") == "a"
    assert bag(filters.remove_where(df, pred)) == bag(df.exceptAll(df.where(pred)))


# ---- scans and sinks ----


def test_curated_scan_order_of_steps(spark):
    catalog = Catalog().bind("t", spark.createDataFrame([(1, "x", 5), (1, "x", 6), (2, "y", 5)], "a int, b string, c int"))
    df = curated_scan(spark, catalog, "t", where=F.col("c") > 4, columns=["a", "b"], rename={"a": "key"})
    assert df.columns == ["key", "b"] and bag(df) == Counter({(1, "x"): 1, (2, "y"): 1})


def test_curated_scan_reaches_the_file(spark, tmp_path):
    spec = TableSpec("parquet", str(tmp_path / "t"))
    replace(spark.range(10).select("id", (F.col("id") * 2).alias("x"), F.lit("p").alias("wide")), spec)
    df = curated_scan(spark, Catalog({"t": spec}), "t", where=F.col("x") > 4, columns=["id"])
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(x,4)" in plan and "wide" not in plan


def test_patch_rows_by_name(spark):
    df = patch_rows(spark.createDataFrame([("a", 1)], "k string, n int"), [{"n": 7}, {"k": "z"}])
    assert bag(df) == Counter([("a", 1), (None, 7), ("z", None)])


def test_append_adds_and_replace_replaces(spark, tmp_path):
    spec = TableSpec("parquet", str(tmp_path / "t"))
    for _ in range(2):
        append(spark.range(3), spec)
    assert spark.read.parquet(spec.location).count() == 6
    replace(spark.range(2).toDF("other"), spec, files=2)
    assert spark.read.parquet(spec.location).columns == ["other"]


def test_replace_partitioned(spark, tmp_path):
    spec = TableSpec("parquet", str(tmp_path / "t"))
    replace(spark.range(100).select("id", F.concat(F.lit("2022-0"), (F.col("id") % 3).cast("string")).alias("period")), spec, partition_by=["period"])
    assert spark.read.parquet(spec.location).where("period = '2022-01'").count() == 33


def test_safe_replace_of_own_input(spark, tmp_path):
    spec = TableSpec("parquet", str(tmp_path / "h"))
    replace(spark.range(5), spec)
    for n in (6, 7):
        old = read_table(spark, Catalog({"h": spec}), "h")
        safe_replace(old.union(spark.range(1).select(F.lit(n).cast("bigint"))), spec, grace_seconds=0)
    assert read_table(spark, Catalog({"h": spec}), "h").count() == 7
    assert len([p for p in (tmp_path / "h").iterdir() if p.name.startswith("_version-")]) == 1
    append(spark.range(3), spec)
    assert read_table(spark, Catalog({"h": spec}), "h").count() == 10


def test_safe_replace_that_fails_before_the_switch(spark, tmp_path, monkeypatch):
    spec = TableSpec("parquet", str(tmp_path / "h"))
    rows = lambda: sorted(r[0] for r in read_table(spark, Catalog({"h": spec}), "h").collect())
    replace(spark.range(3), spec)
    safe_replace(spark.range(4), spec)

    def fails(*_):
        raise OSError("no pointer today")

    with monkeypatch.context() as patched:
        patched.setattr("liftplan.sources.sinks._point_to", fails)
        with pytest.raises(OSError):
            safe_replace(spark.range(9), spec)
    assert rows() == [0, 1, 2, 3]
    safe_replace(spark.range(5), spec, grace_seconds=0)
    assert rows() == [0, 1, 2, 3, 4] and len([p for p in (tmp_path / "h").iterdir() if p.name.startswith("_version-")]) == 1


def staged_files(spark):
    fs, path, jvm = hadoop_fs(spark, f"{scratch_base(spark)}/liftplan")
    return {s.getPath().getName() for s in fs.listStatus(path)} if fs.exists(path) else set()


def test_write_outputs_leaves_no_staged_frames(spark, tmp_path):
    before = staged_files(spark)

    def job(n):
        kept = stage(spark.range(n), "outer")
        with staging(spark):  # a second run in the same process drops its own frames only
            assert stage(spark.range(2), "inner").count() == 2
        return {"all": kept, "even": kept.where("id % 2 = 0"), "unused": kept}

    specs = {n: TableSpec("parquet", str(tmp_path / n)) for n in ("all", "even")}
    write_outputs(spark, lambda: job(6), specs)
    write_outputs(spark, lambda: job(8), specs)
    assert {n: read_table(spark, Catalog(specs), n).count() for n in specs} == {"all": 8, "even": 4}
    assert staged_files(spark) == before
    with pytest.raises(KeyError):
        write_outputs(spark, lambda: job(1), {"none": specs["all"]})
    assert staged_files(spark) == before


def test_text_range_reaches_the_scan(spark, tmp_path):
    days = [("19970901",), ("19980630",), ("19980631",), ("1998-01-01",), ("19970831",), ("19980701",), (None,), ("1998011",), ("199801011",)]
    spark.createDataFrame(days, "shipped string").write.parquet(str(tmp_path / "d"))
    kept = spark.read.parquet(str(tmp_path / "d")).where(filters.text_date_between("shipped", "1997-09-01", "1998-06-30"))
    assert bag(kept) == Counter([("19970901",), ("19980630",)])
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(shipped,19970901)" in plan and "LessThanOrEqual(shipped,19980630)" in plan


def test_catalog_refuses_unknown(spark):
    with pytest.raises(KeyError):
        read_table(spark, Catalog(), "nothing")
    with pytest.raises(ValueError):
        read_table(spark, Catalog({"t": TableSpec("xml", "/x")}), "t")
    with pytest.raises(ValueError):
        read_table(spark, Catalog({"t": TableSpec("csv", "/x")}), "t")


def test_jdbc_read_is_split_over_tasks():
    spec = TableSpec("jdbc", "raw.orders", options={"url": "jdbc:any", "fetchsize": "5000"}, slice_column="id", slice_bounds=(0, 1000), slices=16)
    assert jdbc_options(spec) == {"url": "jdbc:any", "fetchsize": "5000", "dbtable": "raw.orders", "partitionColumn": "id",
                                  "lowerBound": "0", "upperBound": "1000", "numPartitions": "16"}
    assert "numPartitions" not in jdbc_options(TableSpec("jdbc", "t", slices=1))
    with pytest.raises(ValueError):
        jdbc_options(TableSpec("jdbc", "t"))


def test_scratch_comes_from_the_session(spark):
    assert scratch_base(spark) == spark.conf.get("spark.checkpoint.dir")
    df = spark.range(4).select(F.col("id").cast("decimal(18,3)").alias("d"), F.lit(None).cast("string").alias("n"))
    assert stage(df, "x").schema == T.StructType([T.StructField(f.name, f.dataType, True) for f in df.schema])


# ---- joins ----


def frames(spark, seed, keys_a, keys_b):
    r = random.Random(seed)
    a = [(r.choice(keys_a), i) for i in range(40)]
    b = [(r.choice(keys_b), i) for i in range(40)]
    return spark.createDataFrame(a, "ka int, va int"), spark.createDataFrame(b, "kb int, vb int")


@pytest.mark.parametrize("seed", range(3))
@pytest.mark.parametrize("unique", [True, False])
def test_full_join_fill_equals_full_join(spark, seed, unique):
    a, b = frames(spark, seed, [1, 2, 3, 4, None], [3, 4, 5, 6, None])
    got = joins.full_join_fill(a, b, {"ka": "kb"}, {"k": ("ka", "kb")}, unique_keys=unique).select("ka", "va", "kb", "vb", "k")
    want = a.join(b, F.col("ka") == F.col("kb"), "full").withColumn("k", F.coalesce("ka", "kb"))
    assert bag(got) == bag(want)


def test_full_join_fill_has_no_full_outer_join_on_hot_keys(spark):
    a, b = frames(spark, 1, [1, 2], [2, 3])
    plan = joins.full_join_fill(a, b, {"ka": "kb"})._jdf.queryExecution().optimizedPlan().toString()
    assert "FullOuter" not in plan and "LeftAnti" not in plan and "Join Inner" in plan


@pytest.mark.parametrize("seed", range(3))
def test_merge_newer(spark, seed):
    r = random.Random(seed)
    old = [(k, r.choice([None, "o"]), k) for k in [1, 2, 3, 3, None]]
    new = [(k, r.choice([None, "n"])) for k in [2, 3, 4, None]]
    o, n = spark.createDataFrame(old, "Key int, v string, only_old int"), spark.createDataFrame(new, "key int, v string")
    want = Counter()
    for k, v in new:
        hits = [x for x in old if k is not None and x[0] == k]
        want.update([(k, v if v is not None else h[1]) for h in hits] or [(k, v)])
    assert bag(joins.merge_newer(o, n, ["key"], keep_history=False)) == want
    gone = Counter((x[0], x[1]) for x in old if x[0] is None or x[0] not in [k for k, _ in new])
    assert bag(joins.merge_newer(o, n, ["key"])) == want + gone
    assert bag(joins.merge_newer(o, n, ["key"], unique_keys=True)) == want + gone


def test_merge_is_idempotent(spark):
    o = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    n = spark.createDataFrame([(2, "c"), (3, None)], "k int, v string")
    once = joins.merge_newer(o, n, ["k"])
    assert bag(joins.merge_newer(once, n, ["k"])) == bag(once)


def test_lookup_one_to_one_keeps_rows(spark):
    a = spark.createDataFrame([(1, None), (2, "x"), (None, None)], "k int, name string")
    dim = spark.createDataFrame([(1, "b"), (1, "a"), (2, "c")], "k int, label string")
    got = joins.lookup(a, dim, {"k": "k"}, {"name": "label"}, fill=True, one_to_one=["label"])
    assert bag(got) == Counter([(1, "a"), (2, "x"), (None, None)])


def test_lookup_same_dimension_twice(spark):
    a = spark.createDataFrame([(1, 2)], "x int, y int")
    dim = spark.createDataFrame([(1, "one"), (2, "two")], "k int, name string")
    df = joins.lookup(joins.lookup(a, dim, {"x": "k"}, {"nx": "name"}), dim, {"y": "k"}, {"ny": "name"})
    assert df.columns == ["x", "y", "nx", "ny"] and tuple(df.first()) == (1, 2, "one", "two")


def test_lookup_of_details_reads_the_left_side_once_and_is_no_outer_join(spark):
    left, right = spark.range(100).selectExpr("id AS ka", "id AS va"), spark.range(50).selectExpr("id AS kb", "id AS vb")
    twice = joins.lookup(joins.lookup(left, right, {"ka": "kb"}, {"v1": "vb"}, details=True), right, {"v1": "kb"}, {"v2": "vb"}, details=True)
    plan = twice._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Range (0, 100,") == 1 and "LeftAnti" not in plan
    assert twice.count() == 100 and twice.where("v2 IS NOT NULL").count() == 50


@pytest.mark.parametrize("seed", range(3))
def test_lookup_of_details_equals_left_join(spark, seed):
    a, b = frames(spark, seed, [1, 2, 3, None], [2, 3, 4, None])
    got = joins.lookup(a, b, {"ka": "kb"}, {"vb": "vb"}, details=True)
    assert got.columns == ["ka", "va", "vb"]
    assert bag(got) == bag(a.join(b, F.col("ka") == F.col("kb"), "left").select("ka", "va", "vb"))


# ---- dedup ----


def test_top1_is_cut_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), "id")
    plan = dedup.top1_per_key(df, ["k"], [F.desc("id")])._jdf.queryExecution().executedPlan().toString()
    assert "row_number(), 1, Partial" in plan


def brute_keep(rows, m1, k1, k2, order1, order2):
    """Row numbers, removal and adding back, as written down in the rules."""
    def ranked(rs, key, order):
        out = []
        for _, g in itertools.groupby(sorted(rs, key=lambda r: str(key(r))), key=lambda r: str(key(r))):
            g = sorted(g, key=order)
            out += [(r, i == 0) for i, r in enumerate(g)]
        return out
    bare = lambda r: all(r[i] is None for i in m1)
    one = ranked(rows, k1, order1)
    two = ranked([r for r, top in one if top], k2, order2)
    return Counter([r for r, top in two if top] + [r for r, top in one if not top and bare(r)] + [r for r, top in two if not top and bare(r)])


@pytest.mark.parametrize("odd", [False, True])
def test_keep_unmeasured_equals_brute_force(spark, odd):
    r = random.Random(7)
    rows = []
    for i in range(200):
        kg = r.choice([None, 1.0, 2.0])
        l15 = r.choice([None, 1.0]) if odd else (None if kg is None else 3.0)
        rows.append((i, r.choice("ab"), r.choice("xy"), r.choice([None, "f", "g"]), kg, l15, kg, l15))
    df = spark.createDataFrame(rows, "id int, g string, d string, f string, kg double, l15 double, t double, c double")
    got = dedup.keep_unmeasured(df, ["kg", "l15"], ["g", "t"], [F.desc("f")], ["d", "t", "c"], [F.asc_nulls_last("f")], ["id"])
    desc = lambda x: (x[3] is None, -ord(x[3]) if x[3] else 0, x[0])
    asc = lambda x: (x[3] is None, x[3] or "", x[0])
    assert bag(got) == brute_keep(rows, (4, 5), lambda x: (x[1], x[6]), lambda x: (x[2], x[6], x[7]), desc, asc)


# ---- aggregates and shapes ----


def test_concat_text_repeats_and_sorts(spark):
    df = spark.createDataFrame([(1, "b"), (1, "a"), (1, "b"), (1, None), (2, None)], "k int, t string")
    assert bag(aggregate.concat_text(df, ["k"], "t")) == Counter([(1, "a, b, b"), (2, "")])


def test_nth_values_past_the_end(spark):
    df = spark.createDataFrame([(1, 1, "a"), (1, 2, "b"), (2, 1, "c")], "k int, o int, v string")
    got = aggregate.nth_values(df, ["k"], ["o"], {"a": ("v", 0), "b": ("v", 1), "c": ("v", 2)})
    assert bag(got) == Counter([(1, "a", "b", None), (2, "c", None, None)])


UNIT_ROWS = [("both", "KG", 1.0), ("both", "L15", 2.0), ("kg", "KG", 3.0), ("l", "L15", 4.0), ("kk", "KG", 5.0), ("kk", "KG", 6.0),
             ("kk", "L15", 7.0), ("ll", "KG", 8.0), ("ll", "L15", 10.0), ("ll", "L15", 9.0), ("null", "KG", None), ("null", "L15", 1.0), ("other", "ST", 1.0)]


def test_pivot_strict(spark):
    df = spark.createDataFrame(UNIT_ROWS, "k string, u string, q double")
    assert bag(reshape.pivot_units(df, ["k"], "u", "q")) == Counter([("both", 1.0, 2.0), ("ll", 8.0, 9.0), ("null", None, 1.0)])


def test_pivot_loose(spark):
    df = spark.createDataFrame(UNIT_ROWS, "k string, u string, q double")
    plain = bag(reshape.pivot_units(df, ["k"], "u", "q", strict=False))
    assert ("kg", 3.0, None) in plain and ("l", None, 4.0) in plain and len(plain) == 6
    assert ("kg", 3.0, 3.0) in bag(reshape.pivot_units(df, ["k"], "u", "q", strict=False, repeat_single=True))


def test_unpivot_keeps_sums_and_nulls(spark):
    df = spark.createDataFrame([("a", 1.0, None), ("b", 2.0, 4.0)], "k string, m1 double, m2 double")
    got = reshape.unpivot_periods(df, ["k"], {"m1": "2022-01", "m2": "2022-02"}, "period", "v")
    assert bag(got) == Counter([("a", "2022-01", 1.0), ("a", "2022-02", None), ("b", "2022-01", 2.0), ("b", "2022-02", 4.0)])


def test_unpivot_of_two_measures(spark):
    df = spark.createDataFrame([("a", 1.0, None, 2.0, None)], "k string, t1 double, t2 double, v1 double, v2 double")
    got = reshape.unpivot_measures(df, ["k"], {"2022-01": {"t": "t1", "v": "v1"}, "2022-02": {"t": "t2", "v": "v2"}}, "period")
    assert got.columns == ["k", "period", "t", "v"]
    assert bag(got) == Counter([("a", "2022-01", 1.0, 2.0), ("a", "2022-02", None, None)])


def test_column_lists(spark):
    a = spark.createDataFrame([(1, 2, 3)], "Key int, b int, A int")
    b = spark.createDataFrame([(1, 2, 3)], "KEY int, a int, c int")
    assert columns.common_columns(a, b, ["key"]) == ["A"]
    with pytest.raises(ValueError):
        columns.rename_all(a, {"nope": "x"})


# ---- skew ----


def test_hot_key_results(spark):
    """A third of the rows share one key; results equal plain counting."""
    n = 30_000
    df = spark.range(n).select(F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).alias("k"), F.col("id").alias("v"))
    top = dedup.top1_per_key(df, ["k"], [F.desc("v")])
    assert top.count() == df.select("k").distinct().count()
    assert top.where("k = 0").first()["v"] == n - 3
    plan = spark.range(0, n, 2).select(F.col("id").alias("p"), F.lit(1).alias("x"))
    full = joins.full_join_fill(df, plan, {"k": "p"})
    assert full.count() == df.join(plan, F.col("k") == F.col("p"), "full").count()


@pytest.fixture
def small_skew(spark):
    """Thresholds at which small test data already counts as skewed."""
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20000", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20000", "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1000"}
    before = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def hot_and_unique(spark):
    hot = spark.range(0, 60_000, 1, 8).select(F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).alias("k"), F.col("id").alias("v"))
    return hot, spark.range(0, 60_000, 2, 8).select(F.col("id").alias("p"), F.lit("x").alias("x"))


@pytest.mark.parametrize("join", ["lookup", "details", "full"])
def test_hot_key_is_split(spark, small_skew, join):
    hot, unique = hot_and_unique(spark)
    if join == "lookup":
        df, want = joins.lookup(hot, unique, {"k": "p"}, {"x": "x"}), hot.count()
    elif join == "details":
        df = joins.lookup(unique, hot, {"p": "k"}, {"v": "v"}, details=True)
        want = unique.join(hot, F.col("p") == F.col("k"), "left").count()
    else:
        df = joins.full_join_fill(hot, unique, {"k": "p"})
        want = hot.join(unique, F.col("k") == F.col("p"), "full").count()
    assert len(df.collect()) == want
    assert "skewed" in df._jdf.queryExecution().executedPlan().toString()


def test_database_sinks_call_the_writer():
    """No database is started: the calls alone are checked."""
    target = TableSpec("jdbc", "curated.t", options={"url": "jdbc:any"})
    for sink, mode in ((append, "append"), (replace, "overwrite")):
        df = MagicMock()
        writer = df.write.format.return_value
        for step in ("options", "option", "mode"):
            getattr(writer, step).return_value = writer
        sink(df, target)
        df.write.format.assert_called_once_with("jdbc")
        writer.options.assert_called_once_with(url="jdbc:any")
        writer.mode.assert_called_once_with(mode)
        assert call("dbtable", "curated.t") in writer.option.call_args_list
        assert (call("truncate", "true") in writer.option.call_args_list) == (mode == "overwrite")
        writer.save.assert_called_once_with()
