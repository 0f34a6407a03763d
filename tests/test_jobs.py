"""Properties of the jobs on the derived tables and on literal rows."""

import subprocess
import sys
from collections import Counter
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from liftplan.operators.joins import asked_for, lookup, rejoin
from liftplan.plans import contract_raw, contract_summary, delivery_mapping, history, movements, plan, prototypes
from liftplan.session import TASK_SIZE, TASK_SIZES, Slices, hadoop_fs, scratch_base, stage, stage_sliced, staging, tune
from liftplan.sources import Catalog, TableSpec, read_table, replace
from liftplan.suite import jobs
from liftplan.suite.registry import AS_OF, Inputs

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def inputs(spark):
    return Inputs(spark, FOLDER)


@pytest.fixture(scope="module")
def summary(spark, inputs):
    return contract_summary.run(spark, jobs._with_plan(inputs), AS_OF, jobs.SUMMARY)


def test_summary_is_unique_on_its_keys(summary):
    rows = summary["contract_summary"]
    assert rows.count() == rows.select(*contract_summary.SUMMARY_KEYS).distinct().count() > 0
    assert rows.where(F.col("contract_no").isNull()).isEmpty()


def test_plan_only_rows_have_no_contract(summary):
    rows = summary["deals_without_contract"]
    assert rows.count() > 0
    assert rows.where(F.col("contract_no").isNotNull() | (F.col("sum_lifting_in_cbm") != 0)).isEmpty()


def test_full_join_covers_both_sides(spark, inputs):
    rows = contract_raw.run_summed(spark, inputs.domain, AS_OF, jobs.CONTRACT)["contract_rows"]
    planned = jobs._plans(inputs, 2022)
    both = contract_summary.contract_plan(rows, planned, jobs.SUMMARY)
    assert both.where(F.col("contract_no").isNotNull()).count() == rows.count()
    assert both.where(F.col("term_plan_period").isNotNull()).select(
        "supply_point", "term_plan_period", "material_number", "ship_to_number").distinct().count() == planned.count()


def test_unpivot_keeps_plan_totals(spark, inputs):
    """Without the top-1 step no tonne of the sheet is lost."""
    sheet = inputs.domain.frame("plan_2022").where("contract_status = 'active'")
    total = sheet.agg(*[F.sum(f"planvol_{m}") for m in plan.MONTHS]).first()
    options = plan.PlanOptions(1998, "plan_2022", "plan_to", "planvol_", extra_keys=("sold_to_name", "tracking_status"))
    assert plan.normalise(sheet, options).agg(F.sum("plan_to")).first()[0] == sum(total)


def test_top_plan_keys_are_unique(inputs):
    rows = jobs._plans(inputs, 2022)
    assert rows.count() == rows.select(*plan.TOP_KEYS).distinct().count()


def test_movement_literals(spark):
    """Sign, scale, blanks in line numbers, and the end of the as-of month in October."""
    base = {c: "x" for c in movements.MOVEMENT_COLUMNS} | {"bukrs": "DE01", "bwart": "601", "zeile": "0001"}
    rows = [base | {"mblnr": "m1", "zxbldat": "20221031"}, base | {"mblnr": "m2", "zxbldat": "20221031", "bwart": "602"},
            base | {"mblnr": "m3", "zxbldat": "20221101"}, base | {"mblnr": "m4", "zxbldat": "20220831"},
            base | {"mblnr": "m5", "zxbldat": "20221001", "bwart": "999"}, base | {"mblnr": "m6", "zxbldat": "20221001"}]
    q = [(m, " 0001 ", u, v, "DE01") for m in ("m1", "m2") for u, v in (("KG", 2000.0), ("L15", 3000.0))] + [("m6", "0001", "KG", 1.0, "DE01")]
    catalog = (Catalog().bind("movement", spark.createDataFrame([tuple(r[c] for c in movements.MOVEMENT_COLUMNS) for r in rows],
                                                                ", ".join(f"{c} string" for c in movements.MOVEMENT_COLUMNS)))
               .bind("movement_quantity", spark.createDataFrame(q, "mblnr string, zeile string, msehi string, adqnt double, bukrs string"))
               .bind("purchase_header", spark.createDataFrame([("x", "20220101", "FCA", "i2")], "ebeln string, aedat string, inco1 string, inco2 string")))
    got = movements.run(spark, catalog, "2022-10-15", movements.MovementOptions(first_day="2022-09-01"))["movements"]
    assert {(r.mblnr, r.lifting_in_kg, r.lifting_in_cbm, r.lifting_period, r.inco1) for r in got.collect()} == {
        ("m1", 2000.0, 3.0, "2022-10", "FCA"), ("m2", -2000.0, -3.0, "2022-10", "FCA"), ("m6", None, None, "2022-10", "FCA")}


def test_history_store_over_its_own_input(spark, tmp_path):
    specs = {n: TableSpec("parquet", str(tmp_path / n)) for n in ("contract_summary", "summary_history")}
    replace(spark.createDataFrame([("a", 2.0), ("c", None)], "key string, v double"), specs["contract_summary"])
    replace(spark.createDataFrame([("a", 1.0), ("b", 5.0)], "KEY string, v double"), specs["summary_history"])
    catalog = Catalog(specs)
    for _ in range(2):  # a second run changes nothing
        made = history.run_summary(spark, catalog)
        history.store(made["merged"], catalog, "summary_history")
        got = Counter(tuple(r) for r in read_table(spark, catalog, "summary_history").collect())
        assert got == Counter([("a", 2.0), ("b", 5.0), ("c", None)])


def test_period_exception_list(spark, inputs):
    listed = [r[0] for r in contract_raw.run_summed(spark, inputs.domain, AS_OF, jobs.CONTRACT)["contract_rows"]
              .where("bsark_e = 'TTFD' and contract_start_period <> substring(aedat, 1, 4)").select("vbeln").distinct().limit(3).collect()]
    options = contract_raw.ContractOptions(movement=jobs.MOVEMENT, period_contracts=listed)
    got = contract_raw.run_summed(spark, inputs.domain, AS_OF, options)["contract_rows"]
    assert got.where(F.col("vbeln").isin(listed)).count() > 0


def test_movement_days_reach_the_scan(spark, inputs, tmp_path):
    columns = ", ".join(f"{c} string" for c in movements.MOVEMENT_COLUMNS)
    spark.createDataFrame([], columns).write.parquet(str(tmp_path / "movement"))
    catalog = Catalog.of_zone("parquet", str(tmp_path), ["movement"])
    made = movements.filtered_movements(spark, catalog, "2022-10-15", movements.MovementOptions(first_day="2022-09-01"))
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    plan = made._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "GreaterThanOrEqual(zxbldat,20220901)" in plan and "LessThanOrEqual(zxbldat,20221031)" in plan


# ---- bounded tasks and disk ----


def test_prototype_files_grow_with_the_table(spark, tmp_path):
    """No task gets a fixed share of the table: twice the rows of a shuffle make twice the files."""
    def files(n):
        spec = TableSpec("parquet", str(tmp_path / str(n)))
        rows = spark.range(n).select(F.sha2(F.col("id").cast("string"), 512).alias("t")).distinct()
        assert prototypes.store_in_files(rows, spec).count() == n
        return len(list((tmp_path / str(n)).glob("*.parquet")))

    size, least = (spark.conf.get(k) for k in (TASK_SIZE, "spark.sql.adaptive.coalescePartitions.minPartitionSize"))
    spark.conf.set(TASK_SIZE, "256k")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.minPartitionSize", "256k")
    try:
        small, large = files(4000), files(30_000)
    finally:
        spark.conf.set(TASK_SIZE, size)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.minPartitionSize", least)
    assert small <= 3 < large


def test_task_size_is_bounded(spark):
    """Sixteen megabytes of a shuffle or 32 of a file for a task; a smaller size of the session's own stays."""
    for key, most in TASK_SIZES.items():
        before = spark.conf.get(key)
        try:
            for given, want in (("64MB", str(most)), ("8m", "8m")):
                spark.conf.set(key, given)
                assert tune(spark).conf.get(key) == want
        finally:
            spark.conf.set(key, before)


def test_staged_rows_leave_no_shuffle_files(tmp_path):
    """The shuffles of a staged frame go when it is written; the setting does not outlast the write."""
    code = """
import sys, pathlib
from pyspark.sql import functions as F
from liftplan.session import SHUFFLE_CLEANUP, build_session, stage
base = sys.argv[1]
spark = build_session("t", "local[2]", spark__ui__enabled="false", spark__local__dir=base + "/local", spark__checkpoint__dir=base + "/kept", spark__driver__host="127.0.0.1")
rows = stage(spark.range(1000).groupBy(F.col("id") % 7).count(), "rows")
print("left", len([*pathlib.Path(base, "local").rglob("shuffle_*.data")]), rows.count(), spark.conf.get(SHUFFLE_CLEANUP, None))
"""
    done = subprocess.run([sys.executable, "-c", code, str(tmp_path)], capture_output=True, text=True, timeout=120, cwd=Path(__file__).parents[1])
    assert "left 0 7 None" in done.stdout, done.stderr[-500:]


def test_terminal_shuffles_whole_rows_once(spark):
    """Both sides are staged; behind them comes one join on the contract, and a distinct that needs no shuffle of its own."""
    inputs = Inputs(spark, FOLDER)
    catalog = jobs._plain_units(inputs)
    for name in ("contract_commercial", "price_condition"):
        catalog.bind(name, catalog.frame(f"{name}_head"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        made = prototypes.run_terminal(spark, catalog)["contract_movements"]
        assert made._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 2
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_load_ids_of_asked_items_only(spark):
    """The newest entry of an asked item is the same; entries of other items, of no item and null ids do not come back."""
    rows = [("007", "A", "000012000001", "2"), ("008", "B", "000012000001", "3"), ("009", "C", "000013000001", "1"), ("010", "D", None, "1"),
            ("011", "E", "000012000002", "1"), ("011", "E", "000012000002", "1")]
    registry = spark.createDataFrame(rows, "lidno string, lid3cod1 string, lidaddon string, ca_timestamp string")
    items = spark.createDataFrame([("12", "1"), ("12", "1"), ("12", "2"), (None, "1"), ("99", "1")], "contract_no string, item_number string")
    whole = {tuple(r) for r in delivery_mapping.latest_load_ids(registry, (6, 6)).collect()}
    asked = [tuple(r) for r in delivery_mapping.latest_load_ids(registry, (6, 6), items).collect()]
    assert sorted(asked) == [("11", "E", "12", "2"), ("8", "B", "12", "1")] and set(asked) < whole


def test_asked_for_needs_no_second_shuffle(spark):
    """Distinct and lookup behind it use the shuffle it made; duplicates and null keys are as in the lookup of the whole dimension."""
    df = spark.createDataFrame([(1, "a"), (1, "b"), (None, "c"), (3, "d")], "k int, v string")
    dim = spark.createDataFrame([(1, 10), (1, 10), (1, 11), (2, 20), (None, 30)], "k2 int, w int")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        with staging(spark):
            df, dim = stage(df, "asking"), stage(dim, "asked")
            cut = asked_for(dim, df, {"k": "k2"}).distinct()
            assert sorted(map(tuple, cut.collect())) == [(1, 10), (1, 11)]
            made = lookup(df, cut, {"k": "k2"}, {"w": "w"})
            assert made._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 3  # rows, their keys, the dimension
            want = lookup(df, dim.distinct(), {"k": "k2"}, {"w": "w"})
            assert Counter(made.collect()) == Counter(want.collect())
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_staged_contract_rows_join_what_is_asked_for(spark, inputs):
    """Rows as in one plan; whole rows are shuffled by a few joins and the distinct only."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        with staging(spark):
            for run, name, most in ((contract_raw.run_summed, "contract_rows", 5), (contract_raw.run_mapped, "mapped_rows", 13)):
                made = run(spark, inputs.domain, AS_OF, jobs.CONTRACT, staged=True)[name]
                want = run(spark, inputs.domain, AS_OF, jobs.CONTRACT)[name]
                assert made.columns == want.columns
                assert Counter(made.collect()) == Counter(want.collect()) != Counter()

                def wide(df):
                    plan = df._jdf.queryExecution().executedPlan()
                    lines, found = plan.toString().splitlines(), 0
                    for i, line in enumerate(lines):
                        found += "Exchange hashpartitioning" in line and any("ktext" in x for x in lines[i + 1:i + 3])
                    return found
                assert wide(made) <= most < wide(want)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_asked_movements(spark):
    """Of documents and items that are asked for, with amounts; nulls ask for nothing."""
    moves = [("M1", "0001", "S1", "1", "1"), ("M1", "0002", "S1", "2", "2"), ("M2", "0001", "S2", "1", "1"), (None, "0001", "S2", "1", None)]
    empty = {c: None for c in movements.MOVEMENT_COLUMNS} | {"bukrs": "DE01", "bwart": "601", "zxbldat": "20220915", "ebeln": "E"}
    rows = [empty | dict(zip(("mblnr", "zeile", "kdauf", "kdpos", "oiposnr"), m)) for m in moves]
    schema = ", ".join(f"{c} string" for c in movements.MOVEMENT_COLUMNS)
    amounts = [(m, f" {z}", u, q, "DE01") for m, z, *_ in moves if m for u, q in (("KG", 1000.0), ("L15", 2000.0))]
    catalog = (Catalog().bind("movement", spark.createDataFrame([*rows, rows[0]], schema))
               .bind("movement_quantity", spark.createDataFrame(amounts, "mblnr string, zeile string, msehi string, adqnt double, bukrs string"))
               .bind("purchase_header", spark.createDataFrame([("20220901", "E", "FOB", "x")], "aedat string, ebeln string, inco1 string, inco2 string")))
    asked = spark.createDataFrame([("M1", "2", "S1"), ("M1", "2", "S1"), (None, None, None), ("M9", "1", "S9")], "mblnr string, posnr string, mseg_so string")
    got = movements.run(spark, catalog, "2022-10-15", asked=asked)["movements"]
    assert [(r.mblnr, r.oiposnr, r.aedat, abs(r.lifting_in_to)) for r in got.collect()] == [("M1", "2", "20220901", 1.0)]
    whole = movements.run(spark, catalog, "2022-10-15")["movements"]
    assert whole.count() == 4 and Counter(got.collect()) <= Counter(whole.collect())
    assert [tuple(r) for r in movements.order_documents(spark, catalog, "2022-10-15", asked=asked).collect()] == [("S1", "2", "M1")]


def test_rejoin_matches_nulls(spark):
    df = spark.createDataFrame([(1, None, "a"), (1, None, "b"), (None, 2, "c"), (1, 2, "d")], "k int, m int, v string")
    narrow = spark.createDataFrame([(1, None, 10), (None, 2, 20), (1, 2, None), (1, 2, 30), (7, 7, 70)], "k int, m int, w int")
    assert sorted(map(str, rejoin(df, narrow, ["k", "m"]).collect())) == sorted(map(str, spark.createDataFrame(
        [(1, None, "a", 10), (1, None, "b", 10), (None, 2, "c", 20), (1, 2, "d", None), (1, 2, "d", 30)], "k int, m int, v string, w int").collect()))


def _staged(spark):
    fs, path, _ = hadoop_fs(spark, f"{scratch_base(spark)}/liftplan")
    return {s.getPath().getName() for s in fs.listStatus(path)} if fs.exists(path) else set()


def test_join_in_slices(spark):
    """As the join of the whole frames, with null keys, repeated rows and slices of one side only; each slice is dropped when it is joined."""
    schema = "k string, m string, v int"
    left = spark.createDataFrame([(str(i % 40) if i % 7 else None, "x" if i % 3 else None, i % 90) for i in range(300)], schema)
    right = spark.createDataFrame([(str(i % 25) if i % 5 else None, "x" if i % 2 else None, i) for i in range(60)], schema).withColumnRenamed("v", "w")
    join = lambda a, b: rejoin(a, b, ["k", "m"])
    before = _staged(spark)
    with staging(spark) as kept:
        frames = Slices(left, "left", ["k", "m"], 5), Slices(right, "right", ["k", "m"], 5)
        made = kept(lambda: stage_sliced(join, "joined", *frames))
        assert all(f.take(i).isEmpty() for f in frames for i in range(5))
        few = stage_sliced(join, "few", Slices(left.limit(1), "left", ["k", "m"], 5), Slices(right.where("false"), "right", ["k", "m"], 5))
        assert few.count() == 0 and few.columns == made.columns
    assert Counter(made.collect()) == Counter(join(left, right).collect()) != Counter()
    assert [n.split("-")[0] for n in _staged(spark) - before] == ["joined"]


def test_legacy_steps_are_gone_with_their_shuffles(spark):
    """The job gives a stored frame; what it staged on the way is dropped, and nothing is left to shuffle."""
    catalog = Inputs(spark, FOLDER).domain
    stored = movements.run(spark, catalog, AS_OF, jobs.MOVEMENT)["movements"]
    sliced = movements.run(spark, catalog, AS_OF, jobs.MOVEMENT, staged=True)["movements"]
    assert sliced.columns == stored.columns and Counter(sliced.collect()) == Counter(stored.collect())
    catalog.bind("stored_movements", stage(stored, "stored-movements"))
    before = _staged(spark)
    made = prototypes.run_legacy(spark, catalog, AS_OF, prototypes.LEGACY_WINDOW)["contract_movements"]
    assert made.count() > 0 and "Exchange" not in made._jdf.queryExecution().executedPlan().toString()
    assert [n.rsplit("-", 1)[0] for n in _staged(spark) - before] == ["legacy-whole"]


def test_terminal_in_slices(spark):
    """The rows of one plan; the result is stored, nothing is left to shuffle and what was staged on the way is gone."""
    catalog = jobs._plain_units(Inputs(spark, FOLDER))
    for name in ("contract_commercial", "price_condition"):
        catalog.bind(name, catalog.frame(f"{name}_head"))
    moved = catalog.frame("movement").withColumn("kdauf", F.concat(F.lit("0"), F.substring("kdauf", 2, 15)))
    catalog.bind("movement", moved, catalog.unique("movement"))
    with staging(spark):
        want = prototypes.run_terminal(spark, catalog)["contract_movements"]
        before = _staged(spark)
        made = prototypes.run_terminal(spark, catalog, sliced=True)["contract_movements"]
        assert [n.rsplit("-", 1)[0] for n in _staged(spark) - before] == ["terminal-whole"]
        assert "Exchange" not in made._jdf.queryExecution().executedPlan().toString()
        assert made.columns == want.columns and Counter(made.collect()) == Counter(want.collect()) != Counter()


def test_delivery_rows_meet_a_staged_part_of_the_plan(spark):
    """The plan is cut to the rows' keys slice by slice, so it is no side of a join of the delivery rows; audit (twice, for its keys) and registry are."""
    with staging(spark):
        made = delivery_mapping.shared_rows(spark, jobs._with_plan(Inputs(spark, FOLDER)), AS_OF, jobs.MAPPING)
        text = made._jdf.queryExecution().optimizedPlan().toString()
        assert text.count("Join LeftSemi") == 3 and made.count() > 0
        assert any(n.startswith("asked-plan") for n in _staged(spark))
