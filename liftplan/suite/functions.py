"""Queries for column functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from liftplan.functions import dates, keys, numbers
from liftplan.suite.registry import AS_OF, query


def _day():
    return F.col("o_orderdate").cast("date")


def _orders(t, **columns):
    return t.orders.select("o_orderkey", *[c.alias(n) for n, c in columns.items()])


def _parts(t, **columns):
    return t.part.select("p_partkey", *[c.alias(n) for n, c in columns.items()])


def _lines(t, **columns):
    return t.lineitem.select("l_orderkey", "l_linenumber", *[c.alias(n) for n, c in columns.items()])


_LINE = "l_orderkey, l_linenumber::BIGINT AS l_linenumber"


@query("fn_strip_leading_zeros", """
SELECT c_custkey, regexp_replace(lpad(c_custkey::VARCHAR, 16, '0'), '^0+', '') AS code FROM customer""")
def fn_strip_leading_zeros(t):
    return t.customer.select("c_custkey", keys.strip_zeros(keys.pad_code("c_custkey", 16)).alias("code"))


@query("fn_regexp_replace", "SELECT p_partkey, replace(p_name || chr(65533) || p_brand, chr(65533), '') AS clean FROM part")
def fn_regexp_replace(t):
    return _parts(t, clean=keys.drop_text(F.concat("p_name", F.lit("�"), "p_brand"), "�"))


@query("fn_substring", "SELECT p_partkey, substr(p_name, 1, 4) AS head, substr(p_name, 5, 2) AS mid, substr(p_name, 3) AS tail FROM part")
def fn_substring(t):
    return _parts(t, head=keys.cut("p_name", 1, 4), mid=keys.cut("p_name", 5, 2), tail=keys.tail_from("p_name", 3))


@query("fn_column_substr", """
SELECT o_orderkey, substr(o_orderpriority, 3, 4) AS word, substr(CAST(CAST(o_orderdate AS DATE) AS VARCHAR), 6, 2) AS month_text
FROM orders""")
def fn_column_substr(t):
    return _orders(t, word=F.col("o_orderpriority").substr(3, 4), month_text=_day().cast("string").substr(6, 2))


@query("fn_left", "SELECT p_partkey, left(p_brand, 5) AS head FROM part")
def fn_left(t):
    return _parts(t, head=F.left("p_brand", F.lit(5)))


@query("fn_length", "SELECT p_partkey, length(p_name)::BIGINT AS n, length(p_size::VARCHAR)::BIGINT AS digits FROM part")
def fn_length(t):
    return _parts(t, n=F.length("p_name"), digits=F.length(F.col("p_size").cast("string")))


@query("fn_trim", "SELECT p_partkey, trim('  ' || p_name || ' ') AS label FROM part")
def fn_trim(t):
    return _parts(t, label=F.trim(F.concat(F.lit("  "), "p_name", F.lit(" "))))


@query("fn_upper", "SELECT p_partkey, upper(p_name) AS label FROM part")
def fn_upper(t):
    return _parts(t, label=F.upper("p_name"))


@query("fn_concat", """
SELECT o_orderkey, nullif(o_orderstatus, 'P') || '-' || o_orderpriority AS label FROM orders""")
def fn_concat(t):
    """A null part makes the whole text null."""
    return _orders(t, label=F.concat(F.nullif("o_orderstatus", F.lit("P")), F.lit("-"), "o_orderpriority"))


@query("fn_concat_ws", "SELECT o_orderkey, concat_ws('-', nullif(o_orderstatus, 'P'), o_orderpriority) AS label FROM orders")
def fn_concat_ws(t):
    """A null part is left out."""
    return _orders(t, label=F.concat_ws("-", F.nullif("o_orderstatus", F.lit("P")), "o_orderpriority"))


@query("fn_period_key", f"""
SELECT {_LINE}, strftime(l_shipdate, '%Y-%m') AS from_text, strftime(l_shipdate, '%Y-%m') AS from_date FROM lineitem""")
def fn_period_key(t):
    return _lines(t, from_text=dates.period_key(dates.text_yyyymmdd("l_shipdate")),
                  from_date=dates.date_period("l_shipdate"))


@query("fn_text_to_date", """
SELECT o_orderkey, CASE o_orderstatus WHEN 'P' THEN NULL WHEN 'F' THEN NULL
                   ELSE CAST(CAST(o_orderdate AS DATE) AS VARCHAR) END AS day FROM orders""")
def fn_text_to_date(t):
    """Zero dates and empty texts become null."""
    text = (F.when(F.col("o_orderstatus") == "P", "00000000").when(F.col("o_orderstatus") == "F", "")
            .otherwise(dates.text_yyyymmdd("o_orderdate")))
    return _orders(t, day=dates.parse_yyyymmdd(text))


@query("fn_text_to_time", "SELECT event_id, strftime(ts, '%H:%M:%S') AS clock FROM events")
def fn_text_to_time(t):
    return t.events.select("event_id", dates.parse_hhmmss(F.date_format("ts", "HHmmss")).alias("clock"))


@query("fn_date_format", "SELECT o_orderkey, strftime(o_orderdate, '%d.%m.%Y') AS german, strftime(o_orderdate, '%Y%m%d') AS compact FROM orders")
def fn_date_format(t):
    return _orders(t, german=dates.text_german("o_orderdate"), compact=dates.text_yyyymmdd("o_orderdate"))


@query("fn_date_add", """
SELECT o_orderkey, CAST(CAST(o_orderdate AS DATE) + 230 AS VARCHAR) AS later,
       CAST(CAST(o_orderdate AS DATE) - 100 AS VARCHAR) AS earlier FROM orders""")
def fn_date_add(t):
    return _orders(t, later=F.date_add(_day(), 230), earlier=F.date_add(_day(), -100))


@query("fn_datediff", f"""
SELECT o_orderkey, date_diff('day', DATE '{AS_OF}', CAST(o_orderdate AS DATE)) AS days FROM orders""")
def fn_datediff(t):
    return _orders(t, days=dates.days_until(_day(), AS_OF))


@query("fn_year_month", "SELECT o_orderkey, year(o_orderdate) AS y, month(o_orderdate) AS m FROM orders")
def fn_year_month(t):
    return _orders(t, y=F.year("o_orderdate"), m=F.month("o_orderdate"))


@query("fn_current", f"SELECT o_orderkey, '{AS_OF}' AS as_of, CAST(o_orderdate AS DATE) <= DATE '{AS_OF}' AS is_past FROM orders")
def fn_current(t):
    return _orders(t, as_of=dates.as_of_date(AS_OF), is_past=_day() <= dates.as_of_date(AS_OF))


@query("fn_from_utc", """
SELECT o_orderkey, strftime(o_orderdate + INTERVAL 24 HOUR, '%Y-%m-%d %H:%M:%S') AS stamp FROM orders""")
def fn_from_utc(t):
    """One hour east of UTC; the order time is put at 23:00."""
    stamp = dates.write_stamp(F.col("o_orderdate").cast("timestamp_ntz") + F.expr("INTERVAL 23 HOUR"))
    return _orders(t, stamp=F.date_format(stamp, "yyyy-MM-dd HH:mm:ss"))


@query("fn_case", f"""
SELECT {_LINE}, CASE WHEN l_quantity > 30 THEN 'large' WHEN l_quantity > 10 THEN 'medium'
                     WHEN l_returnflag = 'R' THEN 'back' END AS size FROM lineitem""")
def fn_case(t):
    q = F.col("l_quantity")
    return _lines(t, size=F.when(q > 30, "large").when(q > 10, "medium").when(F.col("l_returnflag") == "R", "back"))


@query("fn_null_fill", """
SELECT o_orderkey, coalesce(n, 0) AS n, coalesce(flag, 'none') AS flag
FROM orders LEFT JOIN (SELECT l_orderkey, count(*) AS n, min(l_returnflag) AS flag FROM lineitem GROUP BY 1)
     ON l_orderkey = o_orderkey""")
def fn_null_fill(t):
    per_order = t.lineitem.groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("n"), F.min("l_returnflag").alias("flag"))
    joined = t.orders.join(per_order, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    return joined.select("o_orderkey", F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("flag", F.lit("none")).alias("flag"))


@query("fn_coalesce", """
SELECT o_orderkey, coalesce(nullif(o_orderpriority, '5-LOW'), nullif(o_orderstatus, 'P'), '') AS label FROM orders""")
def fn_coalesce(t):
    return _orders(t, label=F.coalesce(F.nullif("o_orderpriority", F.lit("5-LOW")),
                                       F.nullif("o_orderstatus", F.lit("P")), F.lit("")))


@query("fn_arith", f"""
SELECT {_LINE}, l_quantity * 0.845 AS tonnes, l_quantity / 1000 AS thousandth, l_quantity * -1 AS negated,
       l_quantity - l_tax AS rest, l_extendedprice / nullif(l_discount, 0) AS quotient FROM lineitem""")
def fn_arith(t):
    q = F.col("l_quantity")
    return _lines(t, tonnes=q * 0.845, thousandth=numbers.thousandth("l_quantity"), negated=q * -1,
                  rest=q - F.col("l_tax"), quotient=numbers.safe_div("l_extendedprice", "l_discount"))


@query("fn_abs", "SELECT c_custkey, abs(c_acctbal - 5000) AS distance FROM customer")
def fn_abs(t):
    return t.customer.select("c_custkey", F.abs(F.col("c_acctbal") - 5000).alias("distance"))


@query("fn_round", f"SELECT {_LINE}, round(l_extendedprice / 7, 2) AS price FROM lineitem")
def fn_round(t):
    return _lines(t, price=F.round(F.col("l_extendedprice") / 7, 2))


@query("fn_ceil_floor", f"SELECT {_LINE}, ceil(l_extendedprice)::BIGINT AS up, floor(l_extendedprice)::BIGINT AS down FROM lineitem")
def fn_ceil_floor(t):
    return _lines(t, up=numbers.whole_up("l_extendedprice"), down=numbers.whole_down("l_extendedprice"))


@query("fn_cast", """
SELECT p_partkey, TRY_CAST(CASE WHEN p_size > 40 THEN '' WHEN p_size > 30 THEN p_name ELSE p_size::VARCHAR END AS DOUBLE) AS number,
       CAST(p_retailprice AS DOUBLE) AS price, TRY_CAST(p_size::VARCHAR AS BIGINT) AS whole FROM part""")
def fn_cast(t):
    size = F.col("p_size")
    text = F.when(size > 40, "").when(size > 30, F.col("p_name")).otherwise(size.cast("string"))
    return _parts(t, number=numbers.number_or_null(text), price=F.col("p_retailprice").cast("double"),
                  whole=numbers.number_or_null(size.cast("string"), "int"))


@query("fn_array_index", """
SELECT p_partkey, string_split(p_name, ' ')[1] AS w0, string_split(p_name, ' ')[2] AS w1,
       string_split(p_name, ' ')[3] AS w2 FROM part""")
def fn_array_index(t):
    """An index past the end gives null."""
    words = F.split("p_name", " ")
    return _parts(t, w0=F.get(words, F.lit(0)), w1=F.get(words, F.lit(1)), w2=F.get(words, F.lit(2)))


@query("fn_composite_split", f"""
SELECT {_LINE}, CASE WHEN l_orderkey = 0 THEN '' ELSE l_orderkey::VARCHAR END AS contract, l_linenumber::VARCHAR AS item
FROM lineitem""")
def fn_composite_split(t):
    both = F.concat(keys.pad_code("l_orderkey", 16), keys.pad_code("l_linenumber", 6))
    contract, item = keys.split_composite(both, 16, 6)
    return _lines(t, contract=contract, item=item)


@query("fn_composite_key", f"""
SELECT {_LINE}, l_orderkey::VARCHAR || coalesce(nullif(l_returnflag, 'N'), '') || l_partkey::VARCHAR AS key FROM lineitem""")
def fn_composite_key(t):
    return _lines(t, key=keys.composite_key("l_orderkey", F.nullif("l_returnflag", F.lit("N")), "l_partkey"))
