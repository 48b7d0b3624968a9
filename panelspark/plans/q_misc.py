"""Registered statistics (STA), rule (DQ) and scalar (SCA) queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelspark.functions import rules as R
from panelspark.functions import scalars as S
from panelspark.operators import quality as Q
from panelspark.operators import stats as ST
from panelspark.plans import views as V

V_LOG_SQL = "SELECT dayofmonth(ts) AS epoch, event_id AS step, value AS loss FROM events"


def _r(c, n=6):
    return F.round(F.col(c), n).alias(c)


# ---------------------------------------------------------------- STA
def sta01_summary(spark, sf_dir):
    s = ST.summary(V.v_log(spark, sf_dir), ["epoch"], "loss", ddof=0)
    return s.select("epoch", "count", _r("sum"), _r("mean"), _r("var", 4), _r("std", 6))


STA01_SQL = f"""
WITH l AS ({V_LOG_SQL})
SELECT epoch, count(loss) AS count, round(sum(loss), 6) AS sum, round(avg(loss), 6) AS mean,
       round(CASE WHEN count(loss) < 2 THEN 'NaN'::DOUBLE ELSE var_pop(loss) END, 4) AS var,
       round(CASE WHEN count(loss) < 2 THEN 'NaN'::DOUBLE ELSE stddev_pop(loss) END, 6) AS std
FROM l GROUP BY epoch"""


def sta02_var_ddof1(spark, sf_dir):
    s = ST.summary(V.v_log(spark, sf_dir), ["epoch"], "loss", ddof=1)
    return s.select("epoch", _r("var", 4), _r("std", 6))


STA02_SQL = f"""
WITH l AS ({V_LOG_SQL})
SELECT epoch, round(CASE WHEN count(loss) < 2 THEN 'NaN'::DOUBLE ELSE var_samp(loss) END, 4) AS var,
       round(CASE WHEN count(loss) < 2 THEN 'NaN'::DOUBLE ELSE stddev_samp(loss) END, 6) AS std
FROM l GROUP BY epoch"""


def sta03_running(spark, sf_dir):
    """Running statistics per epoch in step order.

    Returned: count, sum (2 dp, exact for 2-dp losses), sum of squares
    (4 dp, exact) and std.  The running mean of decimal data often sits exactly on a rounding
    tie, where engines round differently, so it is checked in pytest.
    """
    r = ST.running_summary(V.v_log(spark, sf_dir), ["epoch"], ["step"], "loss", ddof=0)
    return r.select("epoch", "step", "loss", "run_count", _r("run_sum", 2), _r("run_sumsq", 4), _r("run_std", 4))


STA03_SQL = f"""
WITH l AS ({V_LOG_SQL})
SELECT epoch, step, loss,
  count(loss) OVER w AS run_count, round(sum(loss) OVER w, 2) AS run_sum,
  round(sum(loss * loss) OVER w, 4) AS run_sumsq,
  round(CASE WHEN count(loss) OVER w < 2 THEN 'NaN'::DOUBLE ELSE stddev_pop(loss) OVER w END, 4) AS run_std
FROM l WINDOW w AS (PARTITION BY epoch ORDER BY step ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"""


def sta03_running_offset(spark, sf_dir):
    """Running std of values far from zero (the losses plus a billion)."""
    log = V.v_log(spark, sf_dir).withColumn("loss", F.col("loss") + 1e9)
    r = ST.running_summary(log, ["epoch"], ["step"], "loss", ddof=0)
    # a shift off the grid of the two-decimal losses: their std often lies on a rounding tie
    return r.select("epoch", "step", "run_count", F.round(F.col("run_std") + 0.0137, 1).alias("run_std"))


STA03_OFFSET_SQL = f"""
WITH l AS ({V_LOG_SQL})
SELECT epoch, step, count(loss) OVER w AS run_count,
  round(CASE WHEN count(loss) OVER w < 2 THEN 'NaN'::DOUBLE ELSE stddev_pop(loss) OVER w END + 0.0137, 1) AS run_std
FROM l WINDOW w AS (PARTITION BY epoch ORDER BY step ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"""


def sta04_epoch_report(spark, sf_dir):
    r = ST.epoch_report(V.v_log(spark, sf_dir), report_every=5)
    return r.select("epoch", "n_steps", _r("loss_mean"), _r("loss_std"))


STA04_SQL = f"""
WITH l AS ({V_LOG_SQL})
SELECT epoch, count(loss) AS n_steps, round(avg(loss), 6) AS loss_mean,
       round(CASE WHEN count(loss) < 2 THEN 'NaN'::DOUBLE ELSE stddev_pop(loss) END, 6) AS loss_std
FROM l WHERE epoch % 5 = 0 GROUP BY epoch"""


def sta05_every_nth(spark, sf_dir):
    return ST.every_nth_step(V.v_log(spark, sf_dir), 100)


STA05_SQL = f"WITH l AS ({V_LOG_SQL}) SELECT * FROM l WHERE step % 100 = 0"


def sta06_non_finite(spark, sf_dir):
    v = F.col("value")
    odd = F.when(v > 300, F.lit(float("inf"))).when(v < 0.05, F.lit(float("nan"))).otherwise(v)
    e = V.table(spark, sf_dir, "events").select("event_type", "value", odd.alias("ratio"))
    return ST.non_finite_flags(e, ["value", "ratio"], group=["event_type"])


STA06_SQL = """
WITH e AS (SELECT event_type, value,
  CASE WHEN value > 300 THEN 'inf'::DOUBLE WHEN value < 0.05 THEN 'NaN'::DOUBLE ELSE value END AS ratio FROM events)
SELECT event_type,
  coalesce(bool_or(isnan(value) OR isinf(value)), false) AS value_non_finite,
  coalesce(bool_or(isnan(ratio) OR isinf(ratio)), false) AS ratio_non_finite
FROM e GROUP BY event_type"""


# ---------------------------------------------------------------- DQ
def _customer_rules_view(spark, sf_dir):
    c = V.table(spark, sf_dir, "customer")
    return c.select("c_custkey", "c_name", "c_acctbal",
                    F.when(F.col("c_mktsegment") != "HOUSEHOLD", F.col("c_mktsegment")).alias("c_mktsegment"),
                    F.col("c_nationkey").cast("string").alias("c_nation_text"))


CUSTOMER_RULES = {
    "c_acctbal": R.in_range(-500, 9000),                                                  # DQ-4
    "c_mktsegment": R.optional(R.one_of(["MACHINERY", "BUILDING", "AUTOMOBILE"])),        # DQ-11, DQ-6
    "c_name": R.length_between(18, 18),                                                   # DQ-5
    "c_nation_text": R.all_of(R.of_type("int"), R.predicate(lambda c: c.cast("int") < 20)),  # DQ-7, DQ-2, DQ-1
    "c_custkey": R.any_of(R.in_range(None, 100), R.in_range(1400, None)),                 # DQ-8
    "not_a_column": R.must_be_null(),                                                     # ignored
}


def dq_customer_rules(spark, sf_dir):
    return Q.check_rules(_customer_rules_view(spark, sf_dir), CUSTOMER_RULES, mode="report")


DQ_CUSTOMER_SQL = """
WITH c AS (SELECT c_custkey, c_name, c_acctbal, CASE WHEN c_mktsegment <> 'HOUSEHOLD' THEN c_mktsegment END AS c_mktsegment,
                  CAST(c_nationkey AS VARCHAR) AS c_nation_text FROM customer)
SELECT
  count(*) FILTER (WHERE NOT coalesce(c_acctbal >= -500 AND c_acctbal <= 9000, false)) AS c_acctbal_violations,
  count(*) FILTER (WHERE NOT (c_mktsegment IS NULL OR coalesce(c_mktsegment IN ('MACHINERY', 'BUILDING', 'AUTOMOBILE'), false))) AS c_mktsegment_violations,
  count(*) FILTER (WHERE NOT coalesce(length(c_name) >= 18 AND length(c_name) <= 18, false)) AS c_name_violations,
  count(*) FILTER (WHERE NOT coalesce(TRY_CAST(c_nation_text AS INTEGER) IS NOT NULL AND CAST(c_nation_text AS INTEGER) < 20, false)) AS c_nation_text_violations,
  count(*) FILTER (WHERE NOT (coalesce(c_custkey <= 100, false) OR coalesce(c_custkey >= 1400, false))) AS c_custkey_violations
FROM c"""

PART_RULES = {
    "p_size": R.equals(50),            # DQ-3
    "p_brand": R.always(),             # DQ-9
    "p_note": R.must_be_null(),        # DQ-10
    "p_retailprice": R.in_range(None, 950.0),
}


def dq_part_rules(spark, sf_dir):
    p = V.table(spark, sf_dir, "part").select(
        "p_size", "p_brand", "p_retailprice", F.when(F.col("p_size") > 45, F.col("p_type")).alias("p_note"))
    return Q.check_rules(p, PART_RULES)


DQ_PART_SQL = """
WITH p AS (SELECT p_size, p_brand, p_retailprice, CASE WHEN p_size > 45 THEN p_type END AS p_note FROM part)
SELECT count(*) FILTER (WHERE p_size IS DISTINCT FROM 50) AS p_size_violations,
       0::BIGINT AS p_brand_violations,
       count(*) FILTER (WHERE p_note IS NOT NULL) AS p_note_violations,
       count(*) FILTER (WHERE NOT coalesce(p_retailprice <= 950.0, false)) AS p_retailprice_violations
FROM p"""


def dq_orders_flags(spark, sf_dir):
    """DQ-12 ``flag`` mode: rows with per-rule flags, summarised per status."""
    o = V.table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority")
    rules = {"o_orderstatus": R.one_of(["F", "O"]),
             "o_orderpriority": R.length_between(None, 8)}
    f = Q.check_rules(o, rules, mode="flag")
    return f.groupBy("o_orderstatus", "o_orderstatus_ok", "o_orderpriority_ok").agg(F.count("*").alias("n"))


DQ_ORDERS_SQL = """
SELECT o_orderstatus, coalesce(o_orderstatus IN ('F', 'O'), false) AS o_orderstatus_ok,
       coalesce(length(o_orderpriority) <= 8, false) AS o_orderpriority_ok, count(*) AS n
FROM orders GROUP BY ALL"""


# ---------------------------------------------------------------- SCA
def sca01_parse_dates(spark, sf_dir):
    l = V.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate")
    d = F.col("l_shipdate").cast("date")
    k = F.pmod(F.col("l_linenumber"), F.lit(4))
    text = (F.when(k == 0, F.date_format(d, "yyyy-MM-dd"))
            .when(k == 1, F.date_format(d, "yyyy/M/d"))
            .when(k == 2, F.date_format(d, "yyyyMMdd"))
            .otherwise(F.date_format(d, "yyyyMM")))
    t = l.select("l_orderkey", "l_linenumber", text.alias("date_text"))
    parsed = S.parse_date("date_text", strict=True)
    return t.select("l_orderkey", "l_linenumber", "date_text", parsed.alias("parsed"),
                    S.format_date(parsed).alias("formatted"))


SCA01_SQL = r"""
WITH t AS (
  SELECT l_orderkey, l_linenumber,
    CASE l_linenumber % 4 WHEN 0 THEN strftime(l_shipdate, '%Y-%m-%d') WHEN 1 THEN strftime(l_shipdate, '%Y/%-m/%-d')
         WHEN 2 THEN strftime(l_shipdate, '%Y%m%d') ELSE strftime(l_shipdate, '%Y%m') END AS date_text
  FROM lineitem),
p AS (
  SELECT *, CAST(CASE
      WHEN regexp_full_match(date_text, '\d{4}-\d{1,2}-\d{1,2}') THEN strptime(date_text, '%Y-%m-%d')
      WHEN regexp_full_match(date_text, '\d{4}/\d{1,2}/\d{1,2}') THEN strptime(date_text, '%Y/%m/%d')
      WHEN regexp_full_match(date_text, '\d{8}') THEN strptime(date_text, '%Y%m%d')
      WHEN regexp_full_match(date_text, '\d{6}') THEN strptime(date_text || '01', '%Y%m%d') END AS DATE) AS parsed
  FROM t)
SELECT l_orderkey, l_linenumber, date_text, parsed, strftime(parsed, '%Y-%m-%d') AS formatted FROM p"""


def sca03_sanitize(spark, sf_dir):
    p = V.table(spark, sf_dir, "pages").select("page_id", "url")
    return p.select("page_id", S.sanitize_filename("url").alias("safe_name"))


SCA03_SQL = r"""
SELECT page_id, regexp_replace(regexp_replace(url, '[\\/*?:"<>|]', '_', 'g'), '^\s+|\s+$', '', 'g') AS safe_name FROM pages"""


def sca04_str2bool(spark, sf_dir):
    lab = V.table(spark, sf_dir, "labels")
    o = V.table(spark, sf_dir, "orders")
    a = lab.select(F.col("doc_id").alias("id"), F.lit("quality").alias("field"),
                   S.str_to_bool(F.col("quality").cast("string")).alias("flag"))
    b = o.select(F.col("o_orderkey").alias("id"), F.lit("status").alias("field"),
                 S.str_to_bool("o_orderstatus").alias("flag"))
    return a.unionByName(b)


SCA04_SQL = """
SELECT doc_id AS id, 'quality' AS field,
  CASE WHEN lower(CAST(quality AS VARCHAR)) IN ('false','0','no','n','f') THEN false
       WHEN lower(CAST(quality AS VARCHAR)) IN ('true','1','yes','y','t') THEN true END AS flag FROM labels
UNION ALL
SELECT o_orderkey, 'status',
  CASE WHEN lower(o_orderstatus) IN ('false','0','no','n','f') THEN false
       WHEN lower(o_orderstatus) IN ('true','1','yes','y','t') THEN true END FROM orders"""


def sca05_kv_map(spark, sf_dir):
    l = V.table(spark, sf_dir, "lineitem")
    kv = F.concat_ws("=", "l_returnflag", "l_linestatus", F.col("l_linenumber").cast("string"))
    lists = (l.groupBy("l_orderkey")
             .agg(F.sort_array(F.collect_list(F.struct("l_linenumber", "l_partkey", "l_suppkey", "l_quantity",
                                                       kv.alias("kv")))).alias("_items"))
             .select("l_orderkey", F.transform("_items", lambda x: x["kv"]).alias("args")))
    m = lists.select("l_orderkey", S.kv_list_to_map("args").alias("m"))
    return m.select("l_orderkey", F.explode("m").alias("key", "value"))


SCA05_SQL = """
SELECT l_orderkey, l_returnflag AS key,
       arg_max(l_linestatus || '=' || CAST(l_linenumber AS VARCHAR), (l_linenumber, l_partkey, l_suppkey, l_quantity)) AS value
FROM lineitem GROUP BY l_orderkey, l_returnflag"""


def sca02_format_dates(spark, sf_dir):
    o = V.table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    return o.select("o_orderkey", S.format_date(F.col("o_orderdate").cast("date")).alias("formatted"))


SCA02_SQL = "SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS formatted FROM orders"


QUERIES = {
    "sca02_format_dates": sca02_format_dates,
    "sta01_summary": sta01_summary,
    "sta02_var_ddof1": sta02_var_ddof1,
    "sta03_running": sta03_running,
    "sta03_running_offset": sta03_running_offset,
    "sta04_epoch_report": sta04_epoch_report,
    "sta05_every_nth_step": sta05_every_nth,
    "sta06_non_finite": sta06_non_finite,
    "dq_customer_rules": dq_customer_rules,
    "dq_part_rules": dq_part_rules,
    "dq_orders_flags": dq_orders_flags,
    "sca01_parse_dates": sca01_parse_dates,
    "sca03_sanitize_filename": sca03_sanitize,
    "sca04_str2bool": sca04_str2bool,
    "sca05_kv_map": sca05_kv_map,
}

ORACLE = {
    "sca02_format_dates": SCA02_SQL,
    "sta01_summary": STA01_SQL,
    "sta02_var_ddof1": STA02_SQL,
    "sta03_running": STA03_SQL,
    "sta03_running_offset": STA03_OFFSET_SQL,
    "sta04_epoch_report": STA04_SQL,
    "sta05_every_nth_step": STA05_SQL,
    "sta06_non_finite": STA06_SQL,
    "dq_customer_rules": DQ_CUSTOMER_SQL,
    "dq_part_rules": DQ_PART_SQL,
    "dq_orders_flags": DQ_ORDERS_SQL,
    "sca01_parse_dates": SCA01_SQL,
    "sca03_sanitize_filename": SCA03_SQL,
    "sca04_str2bool": SCA04_SQL,
    "sca05_kv_map": SCA05_SQL,
}
