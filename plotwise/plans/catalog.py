"""Registered queries: every operator of the library run over the driver's
tables, each paired with an SQL statement that computes the same result
(the oracle).

The survey domain is mapped onto the tables as follows: customers/suppliers
are plots or sites, order/ship years are survey years, order priorities or
statuses are species, line quantities and whole cents are covers. Tables
carry no missing values, so queries blank some cells deterministically
(``when(key % m != 0, x)``) to exercise the missing-value rules; no query
filters rows to make the check cheaper.

Numeric outputs are kept exactly reproducible across engines: sums are taken
over whole numbers (quantities, cents), and other arithmetic is a fixed
sequence of single IEEE operations written the same way in both plans.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import exact as X
from ..functions import semantics as S
from ..functions import temporal as TM
from ..operators import corrections as C
from ..operators import flux as FX
from ..operators import grouped as G
from ..operators import impute as I
from ..operators import classify as K
from ..operators import joins as J
from ..operators import quality as Q
from ..operators import reshape as R
from ..operators import rules as RU
from ..session import stage, staging_dir
from ..sources import io as IO
from ..sources.io import table
from ..sources.inline import inline_table
from . import dictionaries as DD

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql.strip()
        return fn
    return deco


def _t(spark, sf, name):
    return table(spark, sf, name)


def _year(c):
    return F.year(F.col(c))


def _cents(c):
    return F.round(F.col(c) * F.lit(100.0))


def _sql_exact(x: str, tail: str = "") -> str:
    """The order-independent sum of doubles in SQL: integer parts, 26 and 26 bits of the fraction; one rounding at the end."""
    frac = f"(({x}) - floor({x})) * 67108864::DOUBLE"
    low = f"sum(CAST(floor(({frac} - floor({frac})) * 67108864::DOUBLE) AS BIGINT)){tail}"
    rest = f"(sum(CAST(floor({frac}) AS BIGINT)){tail} * 67108864 + {low})"
    return (f"(CAST(sum(CAST(floor({x}) AS BIGINT)){tail} + {rest} // 4503599627370496 AS DOUBLE)"
            f" + CAST({rest} % 4503599627370496 AS DOUBLE) / 4503599627370496::DOUBLE)")


# ==========================================================================
# scans, projections, filters
# ==========================================================================

@register("scan_filter_project", """
SELECT p_partkey AS species, p_brand AS "functionalGroup", p_size
FROM part WHERE p_type = 'PROMO'
""")
def scan_filter_project(spark, sf):
    return (_t(spark, sf, "part").filter(F.col("p_type") == "PROMO")
            .select(F.col("p_partkey").alias("species"), F.col("p_brand").alias("functionalGroup"), "p_size"))


def _events_nulled(spark, sf):
    return _t(spark, sf, "events").select(
        "event_id", F.nullif(F.col("event_type"), F.lit("view")).alias("et"),
        F.when(F.col("event_id") % 7 != 0, F.col("value")).alias("val"))


_EV_SQL = """WITH e AS (SELECT event_id, nullif(event_type, 'view') AS et,
  CASE WHEN event_id % 7 <> 0 THEN value END AS val FROM events)"""


@register("kleene_or_filter", _EV_SQL + " SELECT * FROM e WHERE et = 'click' OR val > 100")
def kleene_or_filter(spark, sf):
    e = _events_nulled(spark, sf)
    return e.filter((F.col("et") == "click") | (F.col("val") > 100))


@register("not_in_keeps_null", _EV_SQL + " SELECT * FROM e WHERE NOT coalesce(et IN ('click', 'error'), false)")
def not_in_keeps_null(spark, sf):
    return _events_nulled(spark, sf).filter(S.not_in("et", ["click", "error"]))


@register("compound_exclusion", _EV_SQL + " SELECT * FROM e WHERE NOT (et = 'click' AND val > 100)")
def compound_exclusion(spark, sf):
    e = _events_nulled(spark, sf)
    return e.filter(~((F.col("et") == "click") & (F.col("val") > 100)))


@register("regex_exclude_keeps_null", """
WITH p AS (SELECT p_partkey, CASE WHEN p_size <> 1 THEN p_name END AS pn FROM part)
SELECT * FROM p WHERE NOT coalesce(regexp_matches(pn, 'ring|bolt'), false)
""")
def regex_exclude_keeps_null(spark, sf):
    p = _t(spark, sf, "part").select("p_partkey", F.when(F.col("p_size") != 1, F.col("p_name")).alias("pn"))
    return p.filter(~S.matches("pn", "ring|bolt"))


@register("drop_all_null_columns", "SELECT * FROM part")
def drop_all_null_columns(spark, sf):
    p = _t(spark, sf, "part")
    p = p.select("*", F.lit(None).cast("string").alias("empty_note"),
                 F.when(F.col("p_size") > 100, F.col("p_name")).alias("never_set"))
    return R.drop_all_null_columns(p)


@register("try_numeric_columns", """
WITH e AS (SELECT event_id,
  CASE WHEN event_type = 'error' THEN 'u' || regexp_extract(props, '(\\d+)', 1) ELSE regexp_extract(props, '(\\d+)', 1) END AS k,
  CASE WHEN event_type = 'click' THEN CAST(value AS VARCHAR) || 'x' ELSE CAST(value AS VARCHAR) END AS v
  FROM events)
SELECT event_id, TRY_CAST(k AS DOUBLE) AS k, TRY_CAST(v AS DOUBLE) AS v FROM e
""")
def try_numeric_columns(spark, sf):
    e = _t(spark, sf, "events")
    k = F.regexp_extract("props", r"(\d+)", 1)
    e = e.select("event_id",
                 F.when(F.col("event_type") == "error", F.concat(F.lit("u"), k)).otherwise(k).alias("k"),
                 F.when(F.col("event_type") == "click", F.concat(F.col("value").cast("string"), F.lit("x")))
                  .otherwise(F.col("value").cast("string")).alias("v"))
    return e.withColumns({c: S.to_num(c) for c in ("k", "v")})


# ==========================================================================
# joins
# ==========================================================================

@register("group_count_full_join", """
WITH cnt AS (SELECT CASE WHEN l_orderkey % 50 <> 0 THEN 'O' || CAST(l_orderkey AS VARCHAR) END AS orderkey, count(*) AS n_lines
             FROM lineitem GROUP BY 1),
o AS (SELECT CASE WHEN o_orderkey % 50 <> 0 THEN 'O' || CAST(o_orderkey AS VARCHAR) END AS orderkey, o_totalprice
      FROM (SELECT o_totalprice, CASE WHEN o_orderstatus = 'F' THEN o_orderkey ELSE -1 - o_orderkey END AS o_orderkey FROM orders) z)
SELECT coalesce(cnt.orderkey, o.orderkey) AS orderkey, CAST(cnt.n_lines AS DOUBLE) AS n_lines, o.o_totalprice
FROM cnt FULL JOIN o ON cnt.orderkey IS NOT DISTINCT FROM o.orderkey
""")
def group_count_full_join(spark, sf):
    li = _t(spark, sf, "lineitem").select(
        F.when(F.col("l_orderkey") % 50 != 0, F.concat(F.lit("O"), F.col("l_orderkey").cast("string"))).alias("orderkey"))
    cnt = li.groupBy("orderkey").agg(F.count(F.lit(1)).alias("n_lines"))
    # orders of other states get keys that no line has
    key = F.when(F.col("o_orderstatus") == "F", F.col("o_orderkey")).otherwise(-1 - F.col("o_orderkey"))
    o = (_t(spark, sf, "orders").withColumn("o_orderkey", key)
         .select(F.when(F.col("o_orderkey") % 50 != 0, F.concat(F.lit("O"), F.col("o_orderkey").cast("string")))
                 .alias("orderkey"), "o_totalprice"))
    # n_lines is missing for orders without lines; reported as a double so a
    # missing count converts the same way in every client
    return J.natural_join(cnt, o, "full").withColumn("n_lines", F.col("n_lines").cast("double"))


@register("dimension_chain_join", """
SELECT l.l_orderkey, l.l_partkey, l.l_quantity, o.o_custkey, CAST(year(o.o_orderdate) AS INTEGER) AS "Year",
       c.c_mktsegment, n.n_name, r.r_name
FROM lineitem l
LEFT JOIN orders o ON l.l_orderkey IS NOT DISTINCT FROM o.o_orderkey
LEFT JOIN customer c ON o.o_custkey IS NOT DISTINCT FROM c.c_custkey
LEFT JOIN nation n ON c.c_nationkey IS NOT DISTINCT FROM n.n_nationkey
LEFT JOIN region r ON n.n_regionkey IS NOT DISTINCT FROM r.r_regionkey
WHERE year(o.o_orderdate) > 1996 AND (n.n_name = 'NATION_3' OR r.r_name = 'EUROPE')
""")
def dimension_chain_join(spark, sf):
    li = _t(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
    o = _t(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    c = _t(spark, sf, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    # nation (25 rows) and region (5 rows) are fixed-size dimensions
    n = _t(spark, sf, "nation")
    r = _t(spark, sf, "region")
    j = J.join(li, o, [("l_orderkey", "o_orderkey")], "left")
    j = J.join(j, c, [("o_custkey", "c_custkey")], "left")
    j = J.join(j, n, [("c_nationkey", "n_nationkey")], "left", broadcast=True)
    j = J.join(j, r, [("n_regionkey", "r_regionkey")], "left", broadcast=True)
    out = j.select("l_orderkey", "l_partkey", "l_quantity", "o_custkey", _year("o_orderdate").alias("Year"),
                   "c_mktsegment", "n_name", "r_name")
    return out.filter((F.col("Year") > 1996) & ((F.col("n_name") == "NATION_3") | (F.col("r_name") == "EUROPE")))


@register("natural_left_join", """
WITH o AS (SELECT CASE WHEN o_custkey NOT IN (7, 8) THEN 'C' || CAST(o_custkey AS VARCHAR) END AS custkey, o_orderkey, o_orderstatus FROM orders),
c AS (SELECT CASE WHEN c_custkey <> 7 THEN 'C' || CAST(c_custkey AS VARCHAR) END AS custkey, c_mktsegment, c_acctbal FROM customer)
SELECT o.custkey, o.o_orderkey, o.o_orderstatus, c.c_mktsegment, c.c_acctbal
FROM o LEFT JOIN c ON o.custkey IS NOT DISTINCT FROM c.custkey
""")
def natural_left_join(spark, sf):
    o = _t(spark, sf, "orders").select(
        F.when(~F.col("o_custkey").isin(7, 8), F.concat(F.lit("C"), F.col("o_custkey").cast("string"))).alias("custkey"),
        "o_orderkey", "o_orderstatus")
    c = _t(spark, sf, "customer").select(
        F.when(F.col("c_custkey") != 7, F.concat(F.lit("C"), F.col("c_custkey").cast("string"))).alias("custkey"),
        "c_mktsegment", "c_acctbal")
    return J.natural_join(o, c, "left")


@register("left_patch_join", """
WITH p AS (SELECT o_orderkey, o_custkey, CASE WHEN o_orderstatus = 'P' THEN 'X' END AS o_orderstatus,
                  o_totalprice + CAST(1.0 AS DOUBLE) AS o_totalprice
           FROM orders WHERE o_orderpriority = '1-URGENT')
SELECT b.o_orderkey, b.o_custkey, coalesce(p.o_orderstatus, b.o_orderstatus) AS o_orderstatus,
       coalesce(p.o_totalprice, b.o_totalprice) AS o_totalprice, b.o_orderpriority
FROM orders b LEFT JOIN p ON b.o_orderkey IS NOT DISTINCT FROM p.o_orderkey
                         AND b.o_custkey IS NOT DISTINCT FROM p.o_custkey
""")
def left_patch_join(spark, sf):
    o = _t(spark, sf, "orders")
    base = o.select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority")
    patch = (o.filter(F.col("o_orderpriority") == "1-URGENT")
             .select("o_orderkey", "o_custkey",
                     F.when(F.col("o_orderstatus") == "P", F.lit("X")).alias("o_orderstatus"),
                     (F.col("o_totalprice") + F.lit(1.0)).alias("o_totalprice")))
    return J.patch_join(base, patch, ["o_orderkey", "o_custkey"], ["o_orderstatus", "o_totalprice"], "left")


@register("full_patch_join", """
WITH b AS (SELECT o_orderkey, CASE WHEN o_orderstatus <> 'O' THEN o_custkey END AS o_custkey, o_orderstatus, o_totalprice FROM orders),
p AS (SELECT o_orderkey, o_custkey, o_totalprice + CAST(1.0 AS DOUBLE) AS o_totalprice, o_orderpriority
      FROM orders WHERE o_orderpriority = '1-URGENT')
SELECT coalesce(b.o_orderkey, p.o_orderkey) AS o_orderkey, CAST(coalesce(b.o_custkey, p.o_custkey) AS DOUBLE) AS o_custkey,
       b.o_orderstatus, coalesce(p.o_totalprice, b.o_totalprice) AS o_totalprice, p.o_orderpriority
FROM b FULL JOIN p ON b.o_orderkey IS NOT DISTINCT FROM p.o_orderkey AND b.o_custkey IS NOT DISTINCT FROM p.o_custkey
""")
def full_patch_join(spark, sf):
    o = _t(spark, sf, "orders")
    base = o.select("o_orderkey", F.when(F.col("o_orderstatus") != "O", F.col("o_custkey")).alias("o_custkey"), "o_orderstatus",
                    "o_totalprice")
    patch = (o.filter(F.col("o_orderpriority") == "1-URGENT")
             .select("o_orderkey", "o_custkey", (F.col("o_totalprice") + F.lit(1.0)).alias("o_totalprice"),
                     "o_orderpriority"))
    out = J.patch_join(base, patch, ["o_orderkey", "o_custkey"], ["o_totalprice"], "full")
    return out.withColumn("o_custkey", F.col("o_custkey").cast("double"))  # nullable: reported as a double


@register("right_join_dictionary", """
WITH d AS (SELECT n_nationkey, n_name FROM nation WHERE n_regionkey IN (1, 3)
           UNION ALL SELECT 99, 'NATION_99')
SELECT CAST(c.c_custkey AS DOUBLE) AS c_custkey, coalesce(c.c_nationkey, d.n_nationkey) AS c_nationkey, c.c_acctbal, d.n_name
FROM customer c RIGHT JOIN d ON c.c_nationkey IS NOT DISTINCT FROM d.n_nationkey
""")
def right_join_dictionary(spark, sf):
    c = _t(spark, sf, "customer").select("c_custkey", "c_nationkey", "c_acctbal")
    d = (_t(spark, sf, "nation").filter(F.col("n_regionkey").isin(1, 3)).select("n_nationkey", "n_name")
         .unionByName(inline_table(spark, [(99, "NATION_99")], "n_nationkey int, n_name string")))
    # the unmatched dictionary row has no customer: the (nullable) key is reported as a double
    return (J.join(c, d, [("c_nationkey", "n_nationkey")], "right")
            .withColumn("c_custkey", F.col("c_custkey").cast("double")))


@register("semi_join_dictionary", """
WITH p AS (SELECT p_partkey, CASE WHEN p_size <> 1 THEN p_brand END AS p_brand, p_size FROM part),
d AS (SELECT * FROM (VALUES ('Brand#1'), ('Brand#12'), ('Brand#25'), (NULL)) t(brand))
SELECT * FROM p WHERE EXISTS (SELECT 1 FROM d WHERE p.p_brand IS NOT DISTINCT FROM d.brand)
""")
def semi_join_dictionary(spark, sf):
    p = _t(spark, sf, "part").select("p_partkey", F.when(F.col("p_size") != 1, F.col("p_brand")).alias("p_brand"),
                                     "p_size")
    d = inline_table(spark, [("Brand#1",), ("Brand#12",), ("Brand#25",), (None,)], "brand string")
    return J.semi_join(p, d, [("p_brand", "brand")], broadcast=True)


@register("lookup_fanout", """
WITH e AS (SELECT event_id, event_type, CASE WHEN event_id % 10 <> 0 THEN value END AS value FROM events),
lk AS (SELECT * FROM (VALUES ('purchase', CAST(1.5 AS DOUBLE)), ('click', CAST(0.5 AS DOUBLE)),
                             ('purchase', CAST(1.5 AS DOUBLE)), ('view', CAST(NULL AS DOUBLE))) t(event_type, default_value))
SELECT e.event_id, e.event_type, CASE WHEN e.value IS NULL THEN lk.default_value ELSE e.value END AS value
FROM e LEFT JOIN lk ON e.event_type IS NOT DISTINCT FROM lk.event_type
""")
def lookup_fanout(spark, sf):
    e = _t(spark, sf, "events").select(
        "event_id", "event_type", F.when(F.col("event_id") % 10 != 0, F.col("value")).alias("value"))
    # fixed lookup with a duplicated row: matching rows are doubled, as in the source
    lk = inline_table(spark, [("purchase", 1.5), ("click", 0.5), ("purchase", 1.5), ("view", None)],
                               "event_type string, default_value double")
    return I.lookup_fill(e, lk, "event_type", "value", "default_value", broadcast=True)


@register("presence_flag_join", """
WITH ev AS (SELECT user_id, strftime(ts, '%Y-%m-%d') AS day, event_type, event_id, value FROM events),
p AS (SELECT user_id, day, CAST(1 AS DOUBLE) AS presence FROM ev WHERE event_type IN ('view', 'click'))
SELECT c.user_id, c.day, c.event_id, c.value, p.presence
FROM (SELECT user_id, day, event_id, value FROM ev WHERE event_type NOT IN ('view', 'click')) c
LEFT JOIN p ON c.user_id IS NOT DISTINCT FROM p.user_id AND c.day IS NOT DISTINCT FROM p.day
""")
def presence_flag_join(spark, sf):
    e = _t(spark, sf, "events").select("user_id", F.date_format("ts", "yyyy-MM-dd").alias("day"),
                                       "event_type", "event_id", "value")
    marks = F.col("event_type").isin("view", "click")
    cover = e.filter(~marks).select("user_id", "day", "event_id", "value")
    return C.presence_join(cover, e.filter(marks), ["user_id", "day"])


# ==========================================================================
# rescale and corrections
# ==========================================================================

@register("observer_scale", """
SELECT l_orderkey, l_linenumber, rf,
       CASE WHEN coalesce(rf = 'R', false) THEN l_quantity * CAST(1.2 AS DOUBLE) ELSE l_quantity END AS cover
FROM (SELECT l_orderkey, l_linenumber, l_quantity, CASE WHEN l_linenumber <> 3 THEN l_returnflag END AS rf FROM lineitem)
""")
def observer_scale(spark, sf):
    li = _t(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", F.when(F.col("l_linenumber") != 3, F.col("l_returnflag")).alias("rf"),
        F.col("l_quantity").alias("cover"))
    return I.mask_scale(li, "cover", F.col("rf") == "R", 1.2)


@register("unit_rescale", """
WITH b AS (SELECT l_orderkey, l_linenumber, CAST(year(l_shipdate) AS INTEGER) AS "Year", l_quantity, l_tax FROM lineitem),
s AS (SELECT l_orderkey, l_linenumber, "Year",
        CASE WHEN "Year" IN (1996, 1998) THEN l_quantity * 10 ELSE l_quantity END AS height,
        CASE WHEN "Year" IN (1996, 1998) THEN l_tax * 10 ELSE l_tax END AS moss FROM b)
SELECT l_orderkey, l_linenumber, "Year", height,
       CASE WHEN "Year" = 1997 AND l_orderkey = 5 THEN CAST(7.5 AS DOUBLE) ELSE moss END AS moss FROM s
""")
def unit_rescale(spark, sf):
    li = _t(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", _year("l_shipdate").alias("Year"),
        F.col("l_quantity").alias("height"), F.col("l_tax").alias("moss"))
    yrs = S.is_in("Year", [1996, 1998])
    return C.apply_ordered_many(li, [
        ("height", yrs, F.col("height") * 10),
        ("moss", yrs, F.col("moss") * 10),
        ("moss", (F.col("Year") == 1997) & (F.col("l_orderkey") == 5), F.lit(7.5)),
    ])


def _gate_sql(src: str, val: str, rec: str, op: str, thr: str) -> str:
    return f"""(SELECT b.l_suppkey, b."Year", bool_or(coalesce(g.s {op} CAST({thr} AS DOUBLE) * b.tv, false)) AS gate
      FROM {src} b JOIN (SELECT l_suppkey, "Year",
           CASE WHEN count(CASE WHEN recorder = '{rec}' THEN {val} END) = count(CASE WHEN recorder = '{rec}' THEN 1 END)
                THEN sum(CASE WHEN recorder = '{rec}' THEN {val} END) END AS s
           FROM {src} GROUP BY 1, 2) g
        ON b.l_suppkey IS NOT DISTINCT FROM g.l_suppkey AND b."Year" IS NOT DISTINCT FROM g."Year"
      WHERE b.recorder = '{rec}' GROUP BY 1, 2)"""


@register("group_ratio_rescale", f"""
WITH base AS (SELECT l_orderkey, l_linenumber, l_suppkey, CAST(year(l_shipdate) AS INTEGER) AS "Year",
                     l_returnflag AS recorder,
                     CASE WHEN NOT (l_linenumber = 7 AND l_quantity > 45) THEN l_quantity END AS cover,
                     CAST((l_suppkey % 5 + 1) * 200 AS DOUBLE) AS tv FROM lineitem),
s1 AS (SELECT b.*, CASE WHEN coalesce(f.gate, false) THEN b.cover * CAST(1.3 AS DOUBLE) ELSE b.cover END AS cover1
       FROM base b LEFT JOIN {_gate_sql('base', 'cover', 'A', '<', '1.35')} f
         ON b.l_suppkey IS NOT DISTINCT FROM f.l_suppkey AND b."Year" IS NOT DISTINCT FROM f."Year")
SELECT b.l_orderkey, b.l_linenumber, b.l_suppkey, b."Year", b.recorder,
       CASE WHEN coalesce(f.gate, false) THEN b.cover1 / CAST(1.5 AS DOUBLE) ELSE b.cover1 END AS cover
FROM s1 b LEFT JOIN {_gate_sql('s1', 'cover1', 'R', '>', '1.5')} f
  ON b.l_suppkey IS NOT DISTINCT FROM f.l_suppkey AND b."Year" IS NOT DISTINCT FROM f."Year"
""")
def group_ratio_rescale(spark, sf):
    li = _t(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_suppkey", _year("l_shipdate").alias("Year"),
        F.col("l_returnflag").alias("recorder"),
        F.when(~((F.col("l_linenumber") == 7) & (F.col("l_quantity") > 45)), F.col("l_quantity")).alias("cover"),
        ((F.col("l_suppkey") % 5 + 1) * 200).cast("double").alias("tv"))
    rules = [I.GateRule("A", "<", 1.35, 1.3), I.GateRule("R", ">", 1.5, 1.5, divide=True)]
    out = I.ratio_gated_rescale(li, ["l_suppkey", "Year"], "cover", "recorder", "tv", rules)
    return out.select("l_orderkey", "l_linenumber", "l_suppkey", "Year", "recorder", "cover")


@register("coalesce_blank", """
WITH c AS (SELECT c_custkey,
  CASE WHEN c_custkey % 10 = 0 THEN '' WHEN c_custkey % 10 = 1 THEN NULL ELSE c_mktsegment END AS "TTtreat",
  'GR-' || CAST(c_nationkey AS VARCHAR) AS "GRtreat",
  CASE WHEN c_custkey % 13 <> 0 THEN c_name END AS recorder FROM customer)
SELECT c_custkey, CASE WHEN "TTtreat" IS NULL OR "TTtreat" = '' THEN "GRtreat" ELSE "TTtreat" END AS "TTtreat",
       coalesce(recorder, 'unknown botanist') AS recorder FROM c
""")
def coalesce_blank(spark, sf):
    c = _t(spark, sf, "customer")
    m = F.col("c_custkey") % 10
    c = c.select("c_custkey",
                 F.when(m == 0, F.lit("")).when(m == 1, F.lit(None)).otherwise(F.col("c_mktsegment")).alias("TTtreat"),
                 F.concat(F.lit("GR-"), F.col("c_nationkey").cast("string")).alias("GRtreat"),
                 F.when(F.col("c_custkey") % 13 != 0, F.col("c_name")).alias("recorder"))
    out = C.coalesce_blank(c, "TTtreat", "GRtreat", missing_label="unknown botanist", label_col="recorder")
    return out.drop("GRtreat")


@register("recode_values", """
SELECT c_custkey,
  CASE c_mktsegment WHEN 'HOUSEHOLD' THEN 'HH' WHEN 'MACHINERY' THEN 'MACH' ELSE c_mktsegment END AS segment,
  CASE c_nationkey WHEN 0 THEN 100 WHEN 1 THEN 101 ELSE c_nationkey END AS nationkey
FROM customer
""")
def recode_values(spark, sf):
    c = _t(spark, sf, "customer")
    return c.select("c_custkey",
                    S.recode("c_mktsegment", {"HOUSEHOLD": "HH", "MACHINERY": "MACH"}).alias("segment"),
                    S.recode("c_nationkey", {0: 100, 1: 101}).alias("nationkey"))


@register("normalise_names", """
SELECT p_partkey, regexp_replace(p_name, '[ _]', '.', 'g') AS species,
       regexp_replace(p_type || ' ' || p_brand, ' ', '', 'g') AS "Treatment" FROM part
""")
def normalise_names(spark, sf):
    p = _t(spark, sf, "part")
    return p.select("p_partkey", C.normalise_names("p_name").alias("species"),
                    F.regexp_replace(F.concat_ws(" ", "p_type", "p_brand"), " ", "").alias("Treatment"))


@register("composite_id", """
WITH c AS (SELECT c_custkey, c_mktsegment AS "siteID", CASE WHEN c_custkey % 11 <> 0 THEN c_nationkey END AS block,
                  CASE WHEN c_custkey % 3 = 0 THEN 'C' WHEN c_custkey % 3 = 1 THEN 'FGB' END AS treatment FROM customer),
b AS (SELECT *, coalesce(substr("siteID", 1, 3), 'NA') || coalesce(CAST(block AS VARCHAR), 'NA') AS "blockID" FROM c)
SELECT c_custkey, "siteID", "blockID", "blockID" || coalesce(treatment, 'NA') AS "plotID" FROM b
""")
def composite_id(spark, sf):
    c = _t(spark, sf, "customer")
    m = F.col("c_custkey") % 3
    c = c.select("c_custkey", F.col("c_mktsegment").alias("siteID"),
                 F.when(F.col("c_custkey") % 11 != 0, F.col("c_nationkey")).alias("block"),
                 F.when(m == 0, F.lit("C")).when(m == 1, F.lit("FGB")).alias("treatment"))
    c = c.withColumn("blockID", S.paste(S.r_substr("siteID", 1, 3), F.col("block")))
    c = c.withColumn("plotID", S.paste("blockID", "treatment"))
    return c.select("c_custkey", "siteID", "blockID", "plotID")


@register("substring_parts", """
SELECT c_custkey, substr(c_name, 1, 3) AS code, right(c_name, 1) AS last_char, substr(c_name, 4) AS rest,
       substr(c_mktsegment, 2, 3) AS mid FROM customer
""")
def substring_parts(spark, sf):
    c = _t(spark, sf, "customer")
    return c.select("c_custkey", S.r_substr("c_name", 1, 3).alias("code"), S.str_sub_from("c_name", -1).alias("last_char"),
                    S.str_sub_from("c_name", 4).alias("rest"), S.r_substr("c_mktsegment", 2, 4).alias("mid"))


@register("strict_if_else", """
WITH p0 AS (SELECT p_partkey, CASE WHEN p_size % 10 <> 0 THEN CAST(p_size AS DOUBLE) END AS block,
                   CASE WHEN p_partkey % 9 <> 0 THEN p_brand END AS name, p_type AS treatment,
                   p_retailprice AS biomass FROM part),
p1 AS (SELECT p_partkey, name, treatment, biomass,
         CASE WHEN (treatment = 'SMALL' AND block IS NULL) IS NULL THEN NULL
              WHEN treatment = 'SMALL' AND block IS NULL THEN CAST(4 AS DOUBLE) ELSE block END AS block FROM p0),
p2 AS (SELECT p_partkey, name, treatment, biomass,
         CASE WHEN (treatment = 'ECONOMY' AND block = 5) IS NULL THEN NULL
              WHEN treatment = 'ECONOMY' AND block = 5 THEN CAST(6 AS DOUBLE) ELSE block END AS block FROM p1),
p3 AS (SELECT p_partkey, name, treatment, biomass,
         CASE WHEN (treatment = 'PROMO' AND block = 11 AND name = 'Brand#3') IS NULL THEN NULL
              WHEN treatment = 'PROMO' AND block = 11 AND name = 'Brand#3' THEN CAST(12 AS DOUBLE) ELSE block END AS block FROM p2)
SELECT p_partkey, block, name, biomass,
  CASE WHEN (block = 12 AND biomass = 901.1) IS NULL THEN NULL
       WHEN block = 12 AND biomass = 901.1 THEN 'FB' ELSE treatment END AS treatment FROM p3
""")
def strict_if_else(spark, sf):
    p = _t(spark, sf, "part").select(
        "p_partkey", F.when(F.col("p_size") % 10 != 0, F.col("p_size").cast("double")).alias("block"),
        F.when(F.col("p_partkey") % 9 != 0, F.col("p_brand")).alias("name"),
        F.col("p_type").alias("treatment"), F.col("p_retailprice").alias("biomass"))
    b, n, t = F.col("block"), F.col("name"), F.col("treatment")
    return C.apply_ordered_many(p, [
        ("block", (t == "SMALL") & b.isNull(), F.lit(4.0)),
        ("block", (t == "ECONOMY") & (b == 5), F.lit(6.0)),
        ("block", (t == "PROMO") & (b == 11) & (n == "Brand#3"), F.lit(12.0)),
        ("treatment", (b == 12) & (F.col("biomass") == 901.1), F.lit("FB")),
    ]).select("p_partkey", "block", "name", "biomass", "treatment")


_FIXES = [  # fixed correction rows: (customer, year, column, value)
    (1, 1996, "price", "100.5"),
    (2, 1997, "price", "200.25"),
    (3, 1998, "status", "X"),
    (4, 1999, "price", "0"),
    (4, 1999, "status", "Z"),
    (10, 1995, "price", "12.75"),
]


@register("point_corrections", """
WITH o AS (SELECT o_orderkey, o_custkey, CAST(year(o_orderdate) AS INTEGER) AS "Year",
                  o_totalprice AS price, o_orderstatus AS status, o_orderpriority FROM orders),
s1 AS (SELECT o_orderkey, o_custkey, "Year", o_orderpriority,
  CASE WHEN o_custkey = 1 AND "Year" = 1996 THEN CAST(100.5 AS DOUBLE)
       WHEN o_custkey = 2 AND "Year" = 1997 THEN CAST(200.25 AS DOUBLE)
       WHEN o_custkey = 4 AND "Year" = 1999 THEN CAST(0 AS DOUBLE)
       WHEN o_custkey = 10 AND "Year" = 1995 THEN CAST(12.75 AS DOUBLE) ELSE price END AS price,
  CASE WHEN o_custkey = 3 AND "Year" = 1998 THEN 'X' WHEN o_custkey = 4 AND "Year" = 1999 THEN 'Z' ELSE status END AS status
  FROM o)
SELECT o_orderkey, o_custkey, "Year", o_orderpriority, price,
  CASE WHEN o_custkey = 5 AND "Year" = 1996 AND o_orderpriority = '1-URGENT' THEN 'U'
       WHEN o_custkey = 6 AND "Year" = 1997 AND o_orderpriority = '5-LOW' THEN 'L' ELSE status END AS status
FROM s1
""")
def point_corrections(spark, sf):
    o = _t(spark, sf, "orders").select(
        "o_orderkey", "o_custkey", _year("o_orderdate").alias("Year"), F.col("o_totalprice").alias("price"),
        F.col("o_orderstatus").alias("status"), "o_orderpriority")
    fixes = inline_table(spark, _FIXES, "o_custkey long, Year int, column string, value string")
    out = C.point_corrections(o, fixes, ["o_custkey", "Year"], ["price", "status"], broadcast=True)
    fixes2 = inline_table(spark,   # fixed second-stage rows keyed by (customer, year, priority)
        [(5, 1996, "1-URGENT", "status", "U"), (6, 1997, "5-LOW", "status", "L")],
        "o_custkey long, Year int, o_orderpriority string, column string, value string")
    out = C.point_corrections(out, fixes2, ["o_custkey", "Year", "o_orderpriority"], ["status"], broadcast=True)
    return out.select("o_orderkey", "o_custkey", "Year", "o_orderpriority", "price", "status")


@register("class_rollup", """
WITH t AS (SELECT p_partkey, CASE WHEN p_size % 17 <> 0 THEN p_type END AS trait FROM part)
SELECT l.l_orderkey, l.l_linenumber, l.l_partkey,
  CASE WHEN l.l_partkey IN (1, 2, 3) THEN 'graminoid'
       WHEN l.l_partkey IN (4, 5, 6, 7) THEN 'forb'
       WHEN coalesce(regexp_matches(t.trait, 'ECONOMY'), false) THEN 'STANDARD'
       WHEN coalesce(regexp_matches(t.trait, 'PROMO'), false) THEN 'STANDARD'
       ELSE t.trait END AS "functionalGroup"
FROM lineitem l LEFT JOIN t ON l.l_partkey IS NOT DISTINCT FROM t.p_partkey
""")
def class_rollup(spark, sf):
    li = _t(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    traits = _t(spark, sf, "part").select(
        "p_partkey", F.when(F.col("p_size") % 17 != 0, F.col("p_type")).alias("trait"))
    return C.class_rollup(li, traits, "l_partkey", "p_partkey", "trait", "functionalGroup",
                          merge_patterns={"ECONOMY": "STANDARD", "PROMO": "STANDARD"},
                          key_overrides={"graminoid": [1, 2, 3], "forb": [4, 5, 6, 7]})


@register("carry_rows_forward", """
WITH o AS (SELECT o_orderkey, o_custkey, CAST(year(o_orderdate) AS INTEGER) AS "Year" FROM orders)
SELECT * FROM o UNION ALL
SELECT o_orderkey, o_custkey, 1997 FROM o WHERE o_custkey IN (5, 6, 7, 8, 9, 10) AND "Year" = 1996
""")
def carry_rows_forward(spark, sf):
    o = _t(spark, sf, "orders").select("o_orderkey", "o_custkey", _year("o_orderdate").alias("Year"))
    return C.carry_rows_forward(o, S.is_in("o_custkey", [5, 6, 7, 8, 9, 10]) & (F.col("Year") == 1996), "Year", 1997)


@register("dictionary_override", """
WITH kd AS (SELECT * FROM (VALUES ('Brand#1', 'small ring', 'ring.small', CAST(1000.0 AS DOUBLE)),
                                  ('Brand#2', 'red widget', 'widget.red', CAST(NULL AS DOUBLE)),
                                  ('Brand#3', 'blue bolt', 'bolt.blue', CAST(5.0 AS DOUBLE))) t(p_brand, old, new, cover_new)),
gm AS (SELECT * FROM (VALUES ('hot gear', 'gear.hot'), ('ring.small', 'ring.tiny'), ('small gizmo', 'gizmo')) t(old, new)),
a AS (SELECT p.p_partkey, p.p_brand, coalesce(kd.new, p.p_name) AS species, coalesce(kd.cover_new, p.p_retailprice) AS cover
      FROM part p LEFT JOIN kd ON p.p_brand IS NOT DISTINCT FROM kd.p_brand AND p.p_name IS NOT DISTINCT FROM kd.old)
SELECT a.p_partkey, a.p_brand, CASE WHEN gm.new IS NOT NULL THEN gm.new ELSE a.species END AS species, a.cover
FROM a LEFT JOIN gm ON a.species IS NOT DISTINCT FROM gm.old
""")
def dictionary_override(spark, sf):
    p = _t(spark, sf, "part").select("p_partkey", "p_brand", F.col("p_name").alias("species"),
                                     F.col("p_retailprice").alias("cover"))
    keyed = inline_table(spark,   # fixed keyed corrections: (brand, old name) -> new name, new cover
        [("Brand#1", "small ring", "ring.small", 1000.0), ("Brand#2", "red widget", "widget.red", None),
         ("Brand#3", "blue bolt", "bolt.blue", 5.0)],
        "p_brand string, old string, new string, cover_new double")
    gmap = inline_table(spark,   # fixed global name map, applied after the keyed stage
        [("hot gear", "gear.hot"), ("ring.small", "ring.tiny"), ("small gizmo", "gizmo")], "old string, new string")
    return C.dictionary_override(p, keyed, ["p_brand", ("species", "old")], "species", "cover", gmap,
                                 new_name="new", new_value="cover_new", old_name="old", broadcast=True)


@register("paired_zero_fill", """
WITH b AS (SELECT l_orderkey, l_linenumber, CASE WHEN l_linenumber % 3 <> 0 THEN l_tax END AS acro,
                  CASE WHEN l_linenumber % 2 <> 0 THEN l_discount END AS pleuro,
                  CASE WHEN l_linenumber NOT IN (1, 6) THEN l_quantity END AS "totalBryophytes" FROM lineitem),
s1 AS (SELECT l_orderkey, l_linenumber, pleuro, "totalBryophytes",
         CASE WHEN pleuro IS NOT NULL AND acro IS NULL THEN CAST(0 AS DOUBLE) ELSE acro END AS acro FROM b),
s2 AS (SELECT l_orderkey, l_linenumber, acro, "totalBryophytes",
         CASE WHEN acro IS NOT NULL AND pleuro IS NULL THEN CAST(0 AS DOUBLE) ELSE pleuro END AS pleuro FROM s1)
SELECT l_orderkey, l_linenumber, acro, pleuro,
       CASE WHEN "totalBryophytes" IS NULL THEN pleuro + acro ELSE "totalBryophytes" END AS "totalBryophytes" FROM s2
""")
def paired_zero_fill(spark, sf):
    ln = F.col("l_linenumber")
    li = _t(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", F.when(ln % 3 != 0, F.col("l_tax")).alias("acro"),
        F.when(ln % 2 != 0, F.col("l_discount")).alias("pleuro"),
        F.when(~ln.isin(1, 6), F.col("l_quantity")).alias("totalBryophytes"))
    return C.paired_zero_fill(li, "acro", "pleuro", "totalBryophytes")


@register("rebuild_ids", """
WITH p AS (SELECT p_partkey, p_type || ' ' || p_brand AS "turfID", 'Site' || CAST(p_size AS VARCHAR) AS "siteID",
                  p_name AS species FROM part)
SELECT p_partkey, "siteID",
       substr("siteID", 1, 3) || CASE WHEN regexp_matches("turfID", 'PROMO') THEN "turfID" ELSE substr("turfID", 4) END AS "turfID",
       regexp_replace(species, ' ', '.', 'g') AS species FROM p
""")
def rebuild_ids(spark, sf):
    p = _t(spark, sf, "part").select(
        "p_partkey", F.concat_ws(" ", "p_type", "p_brand").alias("turfID"),
        F.concat(F.lit("Site"), F.col("p_size").cast("string")).alias("siteID"), F.col("p_name").alias("species"))
    p = C.rebuild_ids(p, "turfID", "siteID", "PROMO")
    return p.withColumn("species", F.regexp_replace("species", " ", ".")).select("p_partkey", "siteID", "turfID", "species")


@register("decimal_repair", """
SELECT o_orderkey, CASE WHEN o_totalprice > 400000 THEN o_totalprice / CAST(100 AS DOUBLE) ELSE o_totalprice END AS o_totalprice
FROM orders
""")
def decimal_repair(spark, sf):
    o = _t(spark, sf, "orders")
    return o.select("o_orderkey", C.decimal_repair("o_totalprice", 400000.0).alias("o_totalprice"))


# ==========================================================================
# sets, reshape
# ==========================================================================

@register("union_by_name", """
SELECT o_orderkey AS key, o_totalprice AS price FROM orders
UNION ALL BY NAME SELECT l_orderkey AS key, l_quantity AS qty FROM lineitem
UNION ALL BY NAME SELECT event_id AS key, event_type FROM events
""")
def union_by_name(spark, sf):
    a = _t(spark, sf, "orders").select(F.col("o_orderkey").alias("key"), F.col("o_totalprice").alias("price"))
    b = _t(spark, sf, "lineitem").select(F.col("l_orderkey").alias("key"), F.col("l_quantity").alias("qty"))
    c = _t(spark, sf, "events").select(F.col("event_id").alias("key"), "event_type")
    return R.bind_rows(a, b, c)


@register("union_date_timestamp", """
SELECT o_orderkey AS id, CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP) AS date, 'orders' AS src FROM orders
UNION ALL SELECT event_id AS id, ts AS date, 'events' AS src FROM events
""")
def union_date_timestamp(spark, sf):
    a = _t(spark, sf, "orders").select(F.col("o_orderkey").alias("id"), F.to_date("o_orderdate").alias("date"),
                                       F.lit("orders").alias("src"))
    b = _t(spark, sf, "events").select(F.col("event_id").alias("id"), F.col("ts").alias("date"),
                                       F.lit("events").alias("src"))
    return R.bind_rows(a, b)


@register("distinct_projection", """
SELECT DISTINCT l_returnflag, l_linestatus, CAST(year(l_shipdate) AS INTEGER) AS "Year" FROM lineitem
""")
def distinct_projection(spark, sf):
    li = _t(spark, sf, "lineitem")
    return li.select("l_returnflag", "l_linestatus", _year("l_shipdate").alias("Year")).distinct()


@register("distinct_levels", "SELECT DISTINCT event_type FROM events")
def distinct_levels(spark, sf):
    return Q.distinct_levels(_t(spark, sf, "events"), "event_type")


@register("unpivot_long", """
WITH li AS (SELECT l_orderkey, l_linenumber, l_quantity,
                   CASE WHEN l_linenumber <> 2 THEN l_extendedprice END AS l_extendedprice, l_discount, l_tax FROM lineitem)
SELECT l_orderkey, l_linenumber, 'l_quantity' AS species, l_quantity AS cover FROM li
UNION ALL SELECT l_orderkey, l_linenumber, 'l_extendedprice', l_extendedprice FROM li
UNION ALL SELECT l_orderkey, l_linenumber, 'l_discount', l_discount FROM li
UNION ALL SELECT l_orderkey, l_linenumber, 'l_tax', l_tax FROM li
""")
def unpivot_long(spark, sf):
    li = _t(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_quantity",
        F.when(F.col("l_linenumber") != 2, F.col("l_extendedprice")).alias("l_extendedprice"), "l_discount", "l_tax")
    cols = R.col_range(li, "l_quantity", "l_tax")
    return R.to_long(li, ["l_orderkey", "l_linenumber"], cols, "species", "cover")


@register("long_fill_spread", """
WITH s AS (SELECT l_orderkey, CASE WHEN count(l_quantity) = count(*) THEN sum(l_quantity) END AS sumcover
           FROM lineitem GROUP BY 1),
o AS (SELECT o_orderkey, o_custkey, CASE WHEN o_orderkey % 7 <> 0 THEN round(o_totalprice) END AS tg,
             CASE WHEN o_orderkey % 5 <> 0 THEN CAST(o_custkey AS DOUBLE) END AS tf FROM orders)
SELECT o.o_orderkey, o.o_custkey, s.sumcover, coalesce(o.tf, s.sumcover) AS "totalForbs",
       coalesce(o.tg, s.sumcover) AS "totalGraminoids"
FROM o LEFT JOIN s ON o.o_orderkey IS NOT DISTINCT FROM s.l_orderkey
""")
def long_fill_spread(spark, sf):
    sums = (_t(spark, sf, "lineitem").groupBy("l_orderkey")
            .agg(S.sum_strict("l_quantity").alias("sumcover")))
    o = _t(spark, sf, "orders").select(
        "o_orderkey", "o_custkey",
        F.when(F.col("o_orderkey") % 7 != 0, F.round("o_totalprice")).alias("totalGraminoids"),
        F.when(F.col("o_orderkey") % 5 != 0, F.col("o_custkey").cast("double")).alias("totalForbs"))
    base = J.join(o, sums, [("o_orderkey", "l_orderkey")], "left")
    return C.total_fallback(base, ["o_orderkey", "o_custkey", "sumcover"], ["totalForbs", "totalGraminoids"], "sumcover")


@register("pre_post_long", """
WITH m AS (SELECT l_orderkey, l_linenumber, (l_discount + l_discount) / 2 AS pre, (l_tax + l_discount) / 2 AS post
           FROM lineitem)
SELECT l_orderkey, l_linenumber, 'pre' AS pre_post_cut, pre AS m_ndvi FROM m
UNION ALL SELECT l_orderkey, l_linenumber, 'post', post FROM m
""")
def pre_post_long(spark, sf):
    li = _t(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", F.col("l_discount").alias("Before_1"), F.col("l_tax").alias("After_1"),
        F.col("l_discount").alias("After_2"))
    # the pre-cut "mean" adds the first reading to itself, as the source does
    li = li.select("l_orderkey", "l_linenumber",
                   ((F.col("Before_1") + F.col("Before_1")) / 2).alias("pre_cut"),
                   ((F.col("After_1") + F.col("After_2")) / 2).alias("post_cut"))
    long = R.to_long(li, ["l_orderkey", "l_linenumber"], ["pre_cut", "post_cut"], "pre_post_cut", "m_ndvi")
    return long.withColumn("pre_post_cut", S.recode("pre_post_cut", {"pre_cut": "pre", "post_cut": "post"}))


@register("pair_mean", """
SELECT l_orderkey, l_linenumber, (l_extendedprice + l_extendedprice * (1 - l_discount)) / 2 AS pair_mean FROM lineitem
""")
def pair_mean(spark, sf):
    li = _t(spark, sf, "lineitem")
    return li.select("l_orderkey", "l_linenumber",
                     ((F.col("l_extendedprice") + F.col("l_extendedprice") * (F.lit(1) - F.col("l_discount"))) / 2)
                     .alias("pair_mean"))


@register("explode_lookup_fill", """
WITH li AS (SELECT l_orderkey, l_linenumber, CAST(year(l_shipdate) AS INTEGER) AS year, l_returnflag AS site,
                   l_linenumber AS block,
                   CASE WHEN NOT (l_linenumber > 4 AND l_returnflag <> 'N') THEN right('Round ' || l_linestatus, 1) END AS round
            FROM lineitem),
lk AS (SELECT year, site, UNNEST(blocks) AS block, round_new FROM (VALUES
         (1996, 'A', [5], '2'), (1996, 'R', [5, 6, 7], '1'), (1997, 'A', [5, 6], '1'), (1998, 'R', [5, 6, 7], '3')
       ) t(year, site, blocks, round_new))
SELECT li.l_orderkey, li.l_linenumber, li.year, li.site, li.block,
       CASE WHEN li.round IS NULL THEN lk.round_new ELSE li.round END AS round
FROM li LEFT JOIN lk ON li.year IS NOT DISTINCT FROM lk.year AND li.site IS NOT DISTINCT FROM lk.site
                    AND li.block IS NOT DISTINCT FROM lk.block
""")
def explode_lookup_fill(spark, sf):
    li = _t(spark, sf, "lineitem")
    li = li.select("l_orderkey", "l_linenumber", _year("l_shipdate").alias("year"),
                   F.col("l_returnflag").alias("site"), F.col("l_linenumber").alias("block"),
                   F.when(~((F.col("l_linenumber") > 4) & (F.col("l_returnflag") != "N")),
                          S.str_sub_from(F.concat(F.lit("Round "), F.col("l_linestatus")), -1)).alias("round"))
    lookup = inline_table(spark,   # fixed rounds to impute: (year, site, blocks, round)
        [(1996, "A", [5], "2"), (1996, "R", [5, 6, 7], "1"), (1997, "A", [5, 6], "1"), (1998, "R", [5, 6, 7], "3")],
        "year int, site string, block array<int>, round_new string")
    return I.explode_lookup_fill(li, lookup, "block", ["year", "site", "block"], "round", "round_new",
                                 broadcast=True)


_TREATMENTS = ["C", "F", "G", "B", "FB", "GB", "GF", "FGB"]  # fixed values: design treatments in order


@register("design_grid", """
WITH s AS (SELECT DISTINCT s_name AS "siteID" FROM supplier),
g AS (SELECT "siteID", b, treatment FROM s
      CROSS JOIN (VALUES (1), (2), (3), (4)) bt(b)
      CROSS JOIN (VALUES ('C'), ('F'), ('G'), ('B'), ('FB'), ('GB'), ('GF'), ('FGB')) tt(treatment))
SELECT "siteID", substr("siteID", 1, 3) || CAST(b AS VARCHAR) AS "blockID", treatment,
       substr("siteID", 1, 3) || CAST(b AS VARCHAR) || treatment AS "plotID" FROM g
""")
def design_grid(spark, sf):
    s = _t(spark, sf, "supplier").select(F.col("s_name").alias("siteID"))
    g = R.expand_levels(s, {"blockID": [1, 2, 3, 4], "treatment": _TREATMENTS})
    g = g.withColumn("blockID", S.paste(S.r_substr("siteID", 1, 3), F.col("blockID")))
    return g.withColumn("plotID", S.paste("blockID", "treatment"))


_LEVELS = ["AFR1", "AFR2", "AFR3", "AFR4", "AME1", "AME2", "AME3", "AME4", "ASI1", "ASI2", "ASI3", "ASI4"]


@register("ordered_levels", """
WITH j AS (SELECT c.c_custkey, substr(r.r_name, 1, 3) || CAST(n.n_nationkey % 4 + 1 AS VARCHAR) AS lab
           FROM customer c LEFT JOIN nation n ON c.c_nationkey IS NOT DISTINCT FROM n.n_nationkey
           LEFT JOIN region r ON n.n_regionkey IS NOT DISTINCT FROM r.r_regionkey),
k AS (SELECT c_custkey, lab, CASE lab WHEN 'AFR1' THEN 1 WHEN 'AFR2' THEN 2 WHEN 'AFR3' THEN 3 WHEN 'AFR4' THEN 4
        WHEN 'AME1' THEN 5 WHEN 'AME2' THEN 6 WHEN 'AME3' THEN 7 WHEN 'AME4' THEN 8
        WHEN 'ASI1' THEN 9 WHEN 'ASI2' THEN 10 WHEN 'ASI3' THEN 11 WHEN 'ASI4' THEN 12 END AS level_rank FROM j)
SELECT c_custkey, CASE WHEN level_rank IS NOT NULL THEN lab END AS label, CAST(level_rank AS DOUBLE) AS level_rank FROM k
""")
def ordered_levels(spark, sf):
    c = _t(spark, sf, "customer").select("c_custkey", "c_nationkey")
    j = J.join(c, _t(spark, sf, "nation"), [("c_nationkey", "n_nationkey")], "left", broadcast=True)
    j = J.join(j, _t(spark, sf, "region"), [("n_regionkey", "r_regionkey")], "left", broadcast=True)
    lab = F.concat(S.r_substr("r_name", 1, 3), (F.col("c_nationkey") % 4 + 1).cast("string"))
    rank = S.level_rank(lab, _LEVELS)
    return j.select("c_custkey", F.when(rank.isNotNull(), lab).alias("label"),
                    rank.cast("double").alias("level_rank"))  # missing outside the levels: reported as a double


@register("date_formats", """
WITH d AS (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d FROM orders),
t AS (SELECT o_orderkey, strftime(d, '%-m/%-d/%y') AS mdy, strftime(d, '%-d.%-m.%Y') AS dmy FROM d)
SELECT o_orderkey, mdy, dmy, strftime(CAST(strptime(mdy, '%m/%d/%y') AS DATE), '%Y-%m-%d') AS date1,
       strftime(CAST(strptime(dmy, '%d.%m.%Y') AS DATE), '%Y-%m-%d') AS date2 FROM t
""")
def date_formats(spark, sf):
    o = _t(spark, sf, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("d"))
    o = o.select("o_orderkey", F.date_format("d", "M/d/yy").alias("mdy"), F.date_format("d", "d.M.yyyy").alias("dmy"))
    return o.select("o_orderkey", "mdy", "dmy",
                    TM.format_date(TM.parse_date_2digit_year("mdy", "M/d/yy")).alias("date1"),
                    TM.format_date(TM.parse_date("dmy", "d.M.yyyy")).alias("date2"))


@register("mixed_date_parse", """
WITH d AS (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d FROM orders),
t AS (SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN strftime(d, '%-d.%-m.%Y')
                              ELSE CAST(datediff('day', DATE '1899-12-30', d) AS VARCHAR) END AS raw FROM d)
SELECT o_orderkey, raw,
       strftime(CASE WHEN contains(raw, '.') THEN CAST(try_strptime(raw, '%d.%m.%Y') AS DATE)
                     ELSE DATE '1899-12-30' + CAST(floor(TRY_CAST(raw AS DOUBLE)) AS INTEGER) END, '%Y-%m-%d') AS date
FROM t
""")
def mixed_date_parse(spark, sf):
    o = _t(spark, sf, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("d"))
    raw = (F.when(F.col("o_orderkey") % 2 == 0, F.date_format("d", "d.M.yyyy"))
           .otherwise(F.datediff(F.col("d"), F.lit(TM.SPREADSHEET_ORIGIN).cast("date")).cast("string")))
    o = o.select("o_orderkey", raw.alias("raw"))
    return o.select("o_orderkey", "raw", TM.format_date(TM.mixed_date("raw")).alias("date"))


# ==========================================================================
# grouped mutate / windows (orders by customer and year, values in cents)
# ==========================================================================

def _orders_cy(spark, sf):
    return _t(spark, sf, "orders").select(
        "o_orderkey", "o_custkey", _year("o_orderdate").alias("Year"), "o_orderpriority", "o_orderstatus",
        F.when(F.col("o_orderkey") % 6 != 0, _cents("o_totalprice")).alias("cents"))


_OCY_SQL = """WITH o AS (SELECT o_orderkey, o_custkey, CAST(year(o_orderdate) AS INTEGER) AS "Year", o_orderpriority,
  o_orderstatus, CASE WHEN o_orderkey % 6 <> 0 THEN round(o_totalprice * 100.0) END AS cents FROM orders)"""


@register("group_mean_broadcast", _OCY_SQL + """
SELECT o_orderkey, o_custkey, "Year", cents, avg(cents) OVER (PARTITION BY o_custkey) AS mean_cents FROM o
""")
def group_mean_broadcast(spark, sf):
    o = _orders_cy(spark, sf).select("o_orderkey", "o_custkey", "Year", "cents")
    return G.group_mean(o, ["o_custkey"], "cents", "mean_cents")


@register("strict_group_sum", _OCY_SQL + """
SELECT o_orderkey, o_custkey, "Year", cents,
  CASE WHEN count(cents) OVER w = count(*) OVER w THEN sum(cents) OVER w END AS sumcover
FROM o WINDOW w AS (PARTITION BY o_custkey, "Year")
""")
def strict_group_sum(spark, sf):
    o = _orders_cy(spark, sf).select("o_orderkey", "o_custkey", "Year", "cents")
    return G.group_sum_strict(o, ["o_custkey", "Year"], "cents", "sumcover")


@register("group_size_column", _OCY_SQL + """
SELECT o_orderkey, o_custkey, "Year", count(*) OVER (PARTITION BY o_custkey, "Year") AS "sameDayMeasurement" FROM o
""")
def group_size_column(spark, sf):
    o = _orders_cy(spark, sf).select("o_orderkey", "o_custkey", "Year")
    return G.group_size(o, ["o_custkey", "Year"], "sameDayMeasurement")


@register("targeted_group_sum", _OCY_SQL + """
SELECT o_orderkey, o_custkey, "Year", o_orderpriority,
  CASE WHEN o_custkey < 50 AND "Year" = 1996 AND o_orderpriority = '1-URGENT'
       THEN CASE WHEN count(cents) OVER w = count(*) OVER w THEN sum(cents) OVER w END
       ELSE cents END AS cents
FROM o WINDOW w AS (PARTITION BY o_custkey, "Year", o_orderpriority)
""")
def targeted_group_sum(spark, sf):
    o = _orders_cy(spark, sf).select("o_orderkey", "o_custkey", "Year", "o_orderpriority", "cents")
    pred = (F.col("o_custkey") < 50) & (F.col("Year") == 1996) & (F.col("o_orderpriority") == "1-URGENT")
    return G.targeted_group_sum(o, ["o_custkey", "Year", "o_orderpriority"], "cents", pred)


@register("first_row_per_key", """
SELECT o_custkey, o_orderkey, o_totalprice, strftime(o_orderdate, '%Y-%m-%d') AS order_day FROM orders
WHERE year(o_orderdate) = 1997
QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) = 1
""")
def first_row_per_key(spark, sf):
    o = (_t(spark, sf, "orders").filter(_year("o_orderdate") == 1997)
         .select("o_custkey", "o_orderkey", "o_totalprice", "o_orderdate"))
    first = G.first_row_per_key(o, ["o_custkey"], ["o_orderdate", "o_orderkey"])
    return first.select("o_custkey", "o_orderkey", "o_totalprice",
                        F.date_format("o_orderdate", "yyyy-MM-dd").alias("order_day"))


@register("sampling_index", _OCY_SQL + """
SELECT o_custkey, "Year", row_number() OVER (PARTITION BY o_custkey ORDER BY "Year") AS sampling
FROM (SELECT DISTINCT o_custkey, "Year" FROM o)
""")
def sampling_index(spark, sf):
    return G.sampling_index(_orders_cy(spark, sf), "o_custkey", "Year")


@register("pooled_group_mean", """
WITH b AS (SELECT l_orderkey, l_linenumber, l_quantity AS m1, CAST(l_linenumber AS DOUBLE) AS m2,
                  CASE WHEN l_linenumber % 2 = 0 THEN l_quantity END AS m3,
                  CASE WHEN l_quantity > 25 THEN CAST(l_partkey % 10 AS DOUBLE) END AS m4 FROM lineitem),
r AS (SELECT *, coalesce(m1, 0) + coalesce(m2, 0) + coalesce(m3, 0) + coalesce(m4, 0) AS rs,
             CAST(m1 IS NOT NULL AS BIGINT) + CAST(m2 IS NOT NULL AS BIGINT) + CAST(m3 IS NOT NULL AS BIGINT)
             + CAST(m4 IS NOT NULL AS BIGINT) AS rc FROM b)
SELECT l_orderkey, l_linenumber, count(*) OVER w AS "sameDayMeasurement",
       sum(rs) OVER w / nullif(CAST(sum(rc) OVER w AS DOUBLE), 0) AS "SM"
FROM r WINDOW w AS (PARTITION BY l_orderkey)
""")
def pooled_group_mean(spark, sf):
    li = _t(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", F.col("l_quantity").alias("m1"), F.col("l_linenumber").cast("double").alias("m2"),
        F.when(F.col("l_linenumber") % 2 == 0, F.col("l_quantity")).alias("m3"),
        F.when(F.col("l_quantity") > 25, (F.col("l_partkey") % 10).cast("double")).alias("m4"))
    li = G.pooled_group_mean(li, ["l_orderkey"], ["m1", "m2", "m3", "m4"], "SM",
                             extra={"sameDayMeasurement": F.count(F.lit(1))})
    return li.select("l_orderkey", "l_linenumber", "sameDayMeasurement", "SM")


@register("row_mean", """
WITH b AS (SELECT l_orderkey, l_linenumber, CASE WHEN l_linenumber <> 1 THEN l_quantity END AS m1,
                  CASE WHEN l_linenumber % 2 = 0 THEN CAST(l_linenumber AS DOUBLE) END AS m2,
                  CASE WHEN l_linenumber NOT IN (1, 3) THEN CAST(l_suppkey % 10 AS DOUBLE) END AS m3,
                  CASE WHEN l_linenumber % 2 = 0 THEN CAST(l_partkey % 10 AS DOUBLE) END AS m4 FROM lineitem),
r AS (SELECT l_orderkey, l_linenumber,
        (coalesce(m1, 0) + coalesce(m2, 0) + coalesce(m3, 0) + coalesce(m4, 0))
        / nullif(CAST(CAST(m1 IS NOT NULL AS INT) + CAST(m2 IS NOT NULL AS INT) + CAST(m3 IS NOT NULL AS INT)
                      + CAST(m4 IS NOT NULL AS INT) AS DOUBLE), 0) AS soilmoisture FROM b)
SELECT * FROM r WHERE soilmoisture IS NOT NULL
""")
def row_mean(spark, sf):
    ln = F.col("l_linenumber")
    li = _t(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", F.when(ln != 1, F.col("l_quantity")).alias("m1"),
        F.when(ln % 2 == 0, ln.cast("double")).alias("m2"),
        F.when(~ln.isin(1, 3), (F.col("l_suppkey") % 10).cast("double")).alias("m3"),
        F.when(ln % 2 == 0, (F.col("l_partkey") % 10).cast("double")).alias("m4"))
    out = li.select("l_orderkey", "l_linenumber", S.row_mean("m1", "m2", "m3", "m4").alias("soilmoisture"))
    return out.filter(F.col("soilmoisture").isNotNull())


# ==========================================================================
# imputation (customer x status x year covers in cents, some missing)
# ==========================================================================

def _comp(spark, sf):
    """Long cover table: unit = customer, item = order status, period = year;
    every cell present, cover missing on a deterministic subset."""
    comp = (_t(spark, sf, "orders")
            .groupBy(F.col("o_custkey").alias("turfID"), F.col("o_orderstatus").alias("species"),
                     _year("o_orderdate").alias("Year"))
            .agg(F.sum(_cents("o_totalprice")).alias("cover0")))
    comp = comp.select("turfID", "species", "Year",
                       F.when((F.col("turfID") + F.col("Year")) % 4 != 0, F.col("cover0")).alias("cover"),
                       F.lit(1).alias("presence"))
    cust = _t(spark, sf, "customer").select(F.col("c_custkey").alias("turfID"),
                                            F.col("c_nationkey").alias("siteID"),
                                            F.col("c_mktsegment").alias("Treatment"))
    # read by several branches: staged once in the shared folder when the
    # cluster names one, otherwise each branch recomputes it
    return stage(J.join(comp, cust, "turfID", "left"), staging_dir(spark), "covers")


_COMP_SQL = """WITH comp0 AS (SELECT o_custkey AS "turfID", o_orderstatus AS species, CAST(year(o_orderdate) AS INTEGER) AS "Year",
                      sum(round(o_totalprice * 100.0)) AS cover0 FROM orders GROUP BY 1, 2, 3),
comp AS (SELECT c0."turfID", c0.species, c0."Year",
                CASE WHEN (c0."turfID" + c0."Year") % 4 <> 0 THEN c0.cover0 END AS cover, 1 AS presence,
                c.c_nationkey AS "siteID", c.c_mktsegment AS "Treatment"
         FROM comp0 c0 LEFT JOIN customer c ON c0."turfID" IS NOT DISTINCT FROM c.c_custkey),
samp AS (SELECT "turfID", "Year", row_number() OVER (PARTITION BY "turfID" ORDER BY "Year") AS s
         FROM (SELECT DISTINCT "turfID", "Year" FROM comp)),
cs AS (SELECT comp.*, samp.s FROM comp JOIN samp USING ("turfID", "Year"))"""

_ADJ_SQL = """adj AS (SELECT m."siteID", m."Treatment", m."turfID", m.species, m."Year", avg(n.cover) AS cover,
               'Subturf w/o cover. Imputed as mean of adjacent years' AS flag
        FROM cs m JOIN cs n ON m."turfID" = n."turfID" AND m.species = n.species AND abs(m.s - n.s) = 1
        WHERE m.presence IS NOT NULL AND m.cover IS NULL AND n.cover IS NOT NULL
        GROUP BY 1, 2, 3, 4, 5 HAVING count(*) = 2)"""

_GM_SQL = """miss AS (SELECT DISTINCT "siteID", "Treatment", "turfID", "Year", species FROM comp
         WHERE "Treatment" <> 'BUILDING' AND cover IS NULL AND presence IS NOT NULL),
means AS (SELECT "siteID", species, "Year", avg(cover) AS cover FROM comp GROUP BY 1, 2, 3),
gm AS (SELECT miss.*, means.cover FROM miss LEFT JOIN means
       ON miss."siteID" IS NOT DISTINCT FROM means."siteID" AND miss.species IS NOT DISTINCT FROM means.species
      AND miss."Year" IS NOT DISTINCT FROM means."Year")"""

_KEYS6 = ["siteID", "Treatment", "turfID", "species", "Year"]


def _adjacent(comp):
    return I.adjacent_impute(comp, unit=["turfID"], item=["species"], period="Year", value="cover",
                             presence="presence", out_keys=_KEYS6)


def _group_mean(comp):
    miss = (comp.filter((F.col("Treatment") != "BUILDING") & F.col("cover").isNull() & F.col("presence").isNotNull())
            .select(*_KEYS6).distinct())
    return I.group_mean_impute(comp, ["siteID", "species", "Year"], "cover", miss)


@register("adjacent_impute", _COMP_SQL + ", " + _ADJ_SQL + " SELECT * FROM adj")
def adjacent_impute(spark, sf):
    return _adjacent(_comp(spark, sf))


@register("adjacent_impute_totals", """
WITH tot0 AS (SELECT o_custkey AS "turfID", CAST(year(o_orderdate) AS INTEGER) AS "Year",
                     sum(round(o_totalprice * 100.0)) AS t0 FROM orders GROUP BY 1, 2),
tot AS (SELECT t."turfID", t."Year", CASE WHEN (t."turfID" + t."Year") % 3 <> 0 THEN t.t0 END AS "totalGraminoids",
               c.c_mktsegment AS "Treatment"
        FROM tot0 t LEFT JOIN customer c ON t."turfID" IS NOT DISTINCT FROM c.c_custkey),
samp AS (SELECT "turfID", "Year", row_number() OVER (PARTITION BY "turfID" ORDER BY "Year") AS s
         FROM (SELECT DISTINCT "turfID", "Year" FROM tot)),
ts AS (SELECT tot.*, samp.s FROM tot JOIN samp USING ("turfID", "Year")),
nb AS (SELECT DISTINCT "turfID", s, "totalGraminoids" FROM ts WHERE "totalGraminoids" IS NOT NULL)
SELECT m."turfID", m."Treatment", m."Year", avg(n."totalGraminoids") AS "totalGraminoids",
       'Subturf w/o cover. Imputed as mean of adjacent years' AS flag
FROM ts m JOIN nb n ON m."turfID" = n."turfID" AND abs(m.s - n.s) = 1
WHERE m."totalGraminoids" IS NULL AND m."Treatment" IN ('HOUSEHOLD', 'MACHINERY', 'FURNITURE', 'AUTOMOBILE')
GROUP BY 1, 2, 3 HAVING count(*) = 2
""")
def adjacent_impute_totals(spark, sf):
    o = _t(spark, sf, "orders")
    tot = (o.groupBy(F.col("o_custkey").alias("turfID"), _year("o_orderdate").alias("Year"))
           .agg(F.sum(_cents("o_totalprice")).alias("t0")))
    tot = tot.select("turfID", "Year",
                     F.when((F.col("turfID") + F.col("Year")) % 3 != 0, F.col("t0")).alias("totalGraminoids"))
    cust = _t(spark, sf, "customer").select(F.col("c_custkey").alias("turfID"), F.col("c_mktsegment").alias("Treatment"))
    tot = J.join(tot, cust, "turfID", "left")
    missing = F.col("totalGraminoids").isNull() & S.is_in("Treatment", ["HOUSEHOLD", "MACHINERY", "FURNITURE", "AUTOMOBILE"])
    return I.adjacent_impute(tot, unit=["turfID"], item=[], period="Year", value="totalGraminoids", presence=None,
                             out_keys=["turfID", "Treatment", "Year"], missing=missing, distinct_neighbours=True)


@register("group_mean_impute", _COMP_SQL + ", " + _GM_SQL + " SELECT * FROM gm")
def group_mean_impute(spark, sf):
    return _group_mean(_comp(spark, sf))


_PREC_SQL = _COMP_SQL + ", " + _ADJ_SQL + ", " + _GM_SQL + """,
prec AS (SELECT c."siteID", c."Treatment", c."turfID", c.species, c."Year", c.presence,
                coalesce(g.cover, coalesce(a.cover, c.cover)) AS cover
         FROM comp c
         LEFT JOIN adj a ON c."siteID" IS NOT DISTINCT FROM a."siteID" AND c."Treatment" IS NOT DISTINCT FROM a."Treatment"
              AND c."turfID" IS NOT DISTINCT FROM a."turfID" AND c.species IS NOT DISTINCT FROM a.species
              AND c."Year" IS NOT DISTINCT FROM a."Year"
         LEFT JOIN gm g ON c."siteID" IS NOT DISTINCT FROM g."siteID" AND c."Treatment" IS NOT DISTINCT FROM g."Treatment"
              AND c."turfID" IS NOT DISTINCT FROM g."turfID" AND c.species IS NOT DISTINCT FROM g.species
              AND c."Year" IS NOT DISTINCT FROM g."Year"
         WHERE coalesce(g.cover, coalesce(a.cover, c.cover)) IS NOT NULL)"""


def _precedence(spark, sf):
    comp = _comp(spark, sf)
    return I.apply_imputations(comp, _KEYS6, "cover", _adjacent(comp), _group_mean(comp))


@register("imputation_precedence", _PREC_SQL + """
SELECT "siteID", "Treatment", "turfID", species, "Year", presence, cover FROM prec
""")
def imputation_precedence(spark, sf):
    return _precedence(spark, sf).select(*_KEYS6, "presence", "cover")


@register("cover_over_time", _PREC_SQL + """
SELECT "turfID", "Year", count(*) AS n_species, round(sum(cover), 2) AS total_cover FROM prec GROUP BY 1, 2
""")
def cover_over_time(spark, sf):
    p = _precedence(spark, sf)
    return G.cover_over_time(p, ["turfID", "Year"], "cover").withColumn("total_cover", F.round("total_cover", 2))


# ==========================================================================
# quality checks, listings, dictionary
# ==========================================================================

@register("duplicate_value_check", """
SELECT l_orderkey, l_linenumber, count(DISTINCT cover) + max(CASE WHEN cover IS NULL THEN 1 ELSE 0 END) AS n
FROM (SELECT l_orderkey, l_linenumber, CASE WHEN l_partkey % 13 <> 0 THEN l_quantity END AS cover FROM lineitem)
GROUP BY 1, 2 HAVING count(DISTINCT cover) + max(CASE WHEN cover IS NULL THEN 1 ELSE 0 END) > 1
""")
def duplicate_value_check(spark, sf):
    li = _t(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", F.when(F.col("l_partkey") % 13 != 0, F.col("l_quantity")).alias("cover"))
    return Q.duplicate_value_check(li, ["l_orderkey", "l_linenumber"], "cover")


@register("unique_key_violations", """
SELECT l_orderkey, l_linenumber, l_partkey, count(*) OVER (PARTITION BY l_orderkey, l_linenumber) AS n
FROM lineitem QUALIFY n > 1
""")
def unique_key_violations(spark, sf):
    li = _t(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    return Q.unique_key_violations(li, ["l_orderkey", "l_linenumber"])


@register("completeness_check", """
SELECT l_suppkey, CAST(year(l_shipdate) AS INTEGER) AS "Year", count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) < 80
""")
def completeness_check(spark, sf):
    li = _t(spark, sf, "lineitem").select("l_suppkey", _year("l_shipdate").alias("Year"))
    return Q.completeness_check(li, ["l_suppkey", "Year"], 80)


@register("missing_listing", """
SELECT DISTINCT o_custkey, CAST(year(o_orderdate) AS INTEGER) AS "Year", o_orderpriority AS "Treatment" FROM orders
WHERE o_orderkey % 9 = 0 AND o_orderpriority IN ('1-URGENT', '2-HIGH')
""")
def missing_listing(spark, sf):
    o = _t(spark, sf, "orders").select(
        "o_custkey", _year("o_orderdate").alias("Year"), F.col("o_orderpriority").alias("Treatment"),
        F.when(F.col("o_orderkey") % 9 != 0, F.col("o_totalprice")).alias("totalGraminoids"))
    return Q.missing_listing(o, "totalGraminoids", ["o_custkey", "Year", "Treatment"],
                             where=S.is_in("Treatment", ["1-URGENT", "2-HIGH"]))


@register("quality_checks_one_pass", """
WITH x AS (SELECT l_orderkey, l_linenumber, l_suppkey, CAST(year(l_shipdate) AS INTEGER) AS year,
                  CASE WHEN l_partkey % 13 <> 0 THEN l_quantity END AS cover, CASE WHEN l_partkey % 17 <> 0 THEN l_returnflag END AS flag FROM lineitem)
SELECT 'row id' AS "check", 'l_orderkey=' || l_orderkey || ';l_linenumber=' || l_linenumber AS keys, count(*) AS n FROM x GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1
UNION ALL SELECT 'one cover', 'l_orderkey=' || l_orderkey || ';l_linenumber=' || l_linenumber, count(*) FROM x GROUP BY l_orderkey, l_linenumber
  HAVING count(DISTINCT cover) + max(CASE WHEN cover IS NULL THEN 1 ELSE 0 END) > 1
UNION ALL SELECT 'all years', 'l_suppkey=' || l_suppkey || ';year=' || year, count(*) FROM x GROUP BY l_suppkey, year HAVING count(*) < 80
UNION ALL SELECT 'flags known', 'l_suppkey=' || l_suppkey || ';flag=' || coalesce(flag, 'NA'), count(*) FROM x WHERE flag IS NULL AND l_linenumber > 3 GROUP BY l_suppkey, flag
UNION ALL SELECT 'covers known', 'year=' || year, count(*) FROM x WHERE cover IS NULL GROUP BY year
""")
def quality_checks_one_pass(spark, sf):
    x = _t(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_suppkey", _year("l_shipdate").alias("year"), F.when(F.col("l_partkey") % 13 != 0, F.col("l_quantity")).alias("cover"),
        F.when(F.col("l_partkey") % 17 != 0, F.col("l_returnflag")).alias("flag"))
    row = ("l_orderkey", "l_linenumber")
    return Q.violations(x, [
        Q.Check("row id", "unique", row), Q.Check("one cover", "one value", row, value="cover"), Q.Check("all years", "complete", ("l_suppkey", "year"), expected=80),
        Q.Check("flags known", "known", ("l_suppkey", "flag"), value="flag", where=F.col("l_linenumber") > 3), Q.Check("covers known", "known", ("year",), value="cover")])


_WORDS_SQL = """WITH w AS (SELECT lang, source, CASE doc_id % 4 WHEN 0 THEN replace(w, 'a', 'å') WHEN 1 THEN replace(w, 'o', 'Ø') WHEN 2 THEN replace(w, 'e', 'æ') ELSE w END AS word
  FROM (SELECT lang, source, doc_id, unnest(regexp_extract_all(text, '[A-Za-z]+')) AS w FROM documents))"""


@register("locale_text_range", _WORDS_SQL + """
SELECT lang, source, arg_min(word, icu_sort_key(word, 'nb')) AS first, arg_max(word, icu_sort_key(word, 'nb')) AS last FROM w GROUP BY 1, 2
""")
def locale_text_range(spark, sf):
    docs = _t(spark, sf, "documents").select("lang", "source", "doc_id", F.explode(F.regexp_extract_all("text", F.lit("[A-Za-z]+"), F.lit(0))).alias("w"))
    k, w = F.col("doc_id") % 4, F.col("w")
    letter = lambda a, b: F.replace(w, F.lit(a), F.lit(b))
    words = docs.select("lang", "source", F.when(k == 0, letter("a", "å")).when(k == 1, letter("o", "Ø")).when(k == 2, letter("e", "æ")).otherwise(w).alias("word"))
    return Q.text_range(words, ["lang", "source"], "word", collation="nb")


# ==========================================================================
# delimited files: orders written as field sheets, read back by the rules of the readers
# ==========================================================================

def _folder(spark, name):
    folder = staging_dir(spark)
    if folder is None:
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    return f"{folder.rstrip('/')}/{name}-{uuid.uuid4().hex}"


_SHEET = T.StructType([T.StructField("id", T.IntegerType()), T.StructField("site", T.StringType()), T.StructField("cover", T.DoubleType())])
_SHEET_SQL = """WITH c AS (SELECT o_orderkey AS k, o_orderdate, o_custkey, o_orderpriority, CAST(round(o_totalprice * 100) AS BIGINT) AS cents FROM orders),
s AS (SELECT k, CASE WHEN k % 53 = 0 THEN '#' || k ELSE CAST(k AS VARCHAR) END AS id,
             CASE WHEN k % 43 = 0 THEN 'NA' WHEN k % 47 = 0 THEN '' ELSE o_orderpriority END AS site,
             CASE WHEN k % 31 = 0 THEN 'WHAT HAPPENED' WHEN k % 37 = 0 THEN 'NA' WHEN k % 41 = 0 THEN '' WHEN k % 59 = 0 THEN '1,2,3'
                  ELSE (cents // 100) || ',' || lpad(CAST(cents % 100 AS VARCHAR), 2, '0') END AS cover FROM c)"""


def _sheet_files(spark, sf):
    """Orders as text cells with a decimal comma, some of them missing, blank or no number; written as delimited files."""
    k, cents = F.col("o_orderkey"), F.round(F.col("o_totalprice") * 100).cast("long")
    number = F.concat(F.floor(cents / 100).cast("string"), F.lit(","), F.lpad((cents % 100).cast("string"), 2, "0"))
    cells = _t(spark, sf, "orders").select(
        F.when(k % 53 == 0, F.concat(F.lit("#"), k.cast("string"))).otherwise(k.cast("string")).alias("id"),
        F.when(k % 43 == 0, F.lit("NA")).when(k % 47 == 0, F.lit("")).otherwise(F.col("o_orderpriority")).alias("site"),
        F.when(k % 31 == 0, F.lit("WHAT HAPPENED")).when(k % 37 == 0, F.lit("NA")).when(k % 41 == 0, F.lit("")).when(k % 59 == 0, F.lit("1,2,3")).otherwise(number).alias("cover"))
    path = _folder(spark, "sheets")
    cells.write.option("header", True).option("sep", ";").option("emptyValue", '""').csv(path)
    return IO.read_cells(spark, path, _SHEET.fieldNames())


@register("typed_sheet_read", _SHEET_SQL + """
SELECT TRY_CAST(id AS INTEGER) AS id, CASE WHEN site <> 'NA' THEN site END AS site, TRY_CAST(replace(cover, ',', '.') AS DOUBLE) AS cover FROM s
""")
def typed_sheet_read(spark, sf):
    return IO.typed_cells(_sheet_files(spark, sf), _SHEET, decimal_comma=True)


@register("bad_cell_listing", _SHEET_SQL + """
SELECT 'id' AS "column", id AS text FROM s WHERE TRY_CAST(id AS INTEGER) IS NULL
UNION ALL SELECT 'cover', cover FROM s WHERE cover NOT IN ('', 'NA') AND TRY_CAST(replace(cover, ',', '.') AS DOUBLE) IS NULL
""")
def bad_cell_listing(spark, sf):
    return IO.bad_cells(_sheet_files(spark, sf), _SHEET, decimal_comma=True).select("column", "text")


@register("keep_first_by_file_order", """
SELECT CAST(o_custkey AS VARCHAR) AS customer, CAST(o_orderkey AS VARCHAR) AS first_order FROM orders
QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderpriority DESC, o_orderkey) = 1
""")
def keep_first_by_file_order(spark, sf):
    path = _folder(spark, "ordered")
    # files in a known order; their names tell it
    (_t(spark, sf, "orders").orderBy(F.desc("o_orderpriority"), "o_orderkey").select(F.col("o_custkey").cast("string").alias("customer"), F.col("o_orderkey").cast("string").alias("first_order"))
     .write.option("header", True).option("sep", ";").csv(path))
    cells = IO.read_cells(spark, path, ["customer", "first_order"]).select("customer", "first_order", IO.POSITION)
    return G.first_row_per_key(cells, ["customer"], [IO.POSITION]).select("customer", "first_order")


_CLEAN = T.StructType([T.StructField("s_suppkey", T.LongType()), T.StructField("s_name", T.StringType()), T.StructField("s_acctbal", T.DoubleType())])


@register("published_round_trip", """
SELECT s_suppkey, CASE s_suppkey % 5 WHEN 0 THEN 'NA' WHEN 1 THEN NULL WHEN 2 THEN '' WHEN 3 THEN s_name || ', "x"' ELSE s_name END AS s_name,
       CASE WHEN s_suppkey % 7 <> 0 THEN s_acctbal END AS s_acctbal FROM supplier
""")
def published_round_trip(spark, sf):
    k = F.col("s_suppkey") % 5
    clean = _t(spark, sf, "supplier").select(
        F.col("s_suppkey").cast("long"), F.when(k == 0, F.lit("NA")).when(k == 1, F.lit(None)).when(k == 2, F.lit("")).when(k == 3, F.concat("s_name", F.lit(', "x"'))).otherwise(F.col("s_name")).alias("s_name"),
        F.when(F.col("s_suppkey") % 7 != 0, F.col("s_acctbal")).alias("s_acctbal"))
    path = _folder(spark, "published")
    IO.publish_csv(clean, f"{path}/suppliers.csv", missing="")
    return IO.read_published(spark, f"{path}/suppliers.csv", _CLEAN, missing="")


@register("logit_histogram", """
WITH x AS (SELECT CASE WHEN l_discount > 0 AND l_discount < 1 THEN ln(l_discount / (1.0 - l_discount)) END AS lg FROM lineitem)
SELECT CASE WHEN lg < -5.0 THEN 0 WHEN lg >= 0.0 THEN 11
            ELSE CAST(floor(10 * (lg - (-5.0)) / (0.0 - (-5.0))) AS BIGINT) + 1 END AS bucket,
       count(*) AS n FROM x WHERE lg IS NOT NULL GROUP BY 1
""")
def logit_histogram(spark, sf):
    return Q.logit_histogram(_t(spark, sf, "lineitem"), "l_discount", -5.0, 0.0, 10)


_DESCRIPTIONS = [  # fixed description table: TableID (NULL = general), name, description, units, how measured
    (None, "o_orderkey", "Order identifier", None, "assigned"),
    (None, "o_orderstatus", "Order status", "F, O, P", "recorded"),
    ("orders", "o_date", "Order date", "yyyy-mm-dd", "recorded"),
    ("lineitem", "o_date", "Ship date", "yyyy-mm-dd", "recorded"),
    (None, "is_final", "Order is final", None, "derived"),
    (None, "o_orderdate", "Order time", None, "recorded"),
    ("orders", "cust", "Customer", None, "assigned"),
    (None, "o_orderpriority", "Priority", "1-5", "recorded"),
]


@register("data_dictionary", """
WITH r AS (SELECT CAST(min(o_orderkey) AS VARCHAR) || ' - ' || CAST(max(o_orderkey) AS VARCHAR) AS k,
                  min(o_orderstatus) || ' - ' || max(o_orderstatus) AS st,
                  CAST(min(CAST(o_orderdate AS DATE)) AS VARCHAR) || ' - ' || CAST(max(CAST(o_orderdate AS DATE)) AS VARCHAR) AS d,
                  min(o_orderpriority) || ' - ' || max(o_orderpriority) AS pr,
                  CAST(min(CAST(o_custkey AS INTEGER)) AS VARCHAR) || ' - ' || CAST(max(CAST(o_custkey AS INTEGER)) AS VARCHAR) AS cu
           FROM orders)
SELECT 'o_orderkey' AS "Variable name", 'Order identifier' AS "Description", 'numeric' AS "Variable type", k AS "Variable range or levels", CAST(NULL AS VARCHAR) AS "Units/treatment level", 'assigned' AS "How measured" FROM r
UNION ALL SELECT 'o_orderstatus', 'Order status', 'categorical', st, 'F, O, P', 'recorded' FROM r
UNION ALL SELECT 'o_date', 'Order date', 'date', d, 'yyyy-mm-dd', 'recorded' FROM r
UNION ALL SELECT 'o_orderpriority', 'Priority', 'categorical', pr, '1-5', 'recorded' FROM r
UNION ALL SELECT 'is_final', 'Order is final', 'categorical', NULL, NULL, 'derived' FROM r
UNION ALL SELECT 'o_orderdate', 'Order time', NULL, NULL, NULL, 'recorded' FROM r
UNION ALL SELECT 'o_orderdate', 'Order time', NULL, NULL, NULL, 'recorded' FROM r
UNION ALL SELECT 'cust', 'Customer', 'numeric', cu, NULL, 'assigned' FROM r
""")
def data_dictionary(spark, sf):
    o = _t(spark, sf, "orders").select(
        "o_orderkey", "o_orderstatus", F.to_date("o_orderdate").alias("o_date"), "o_orderpriority",
        (F.col("o_orderstatus") == "F").alias("is_final"), "o_orderdate", F.col("o_custkey").cast("int").alias("cust"))
    desc = inline_table(spark, 
        _DESCRIPTIONS, "TableID string, `Variable name` string, Description string, "
                       "`Units/treatment level` string, `How measured` string")
    return Q.data_dictionary(o, desc, "orders")


# ==========================================================================
# flux (events as 1 Hz-style logger readings)
# ==========================================================================

def _matched(spark, sf):
    ev = _t(spark, sf, "events")
    # one logger per user: a reading only meets the windows of its own logger
    readings = ev.select("event_id", "user_id", "ts", "value")
    windows = (ev.filter(F.col("event_type") == "signup")
               .select(F.col("event_id").alias("measurement_id"), "user_id", F.col("ts").alias("start"),
                       (F.col("ts") + F.expr("INTERVAL 12 HOURS")).alias("end")))
    m = FX.match_windows(readings, windows, "ts", "start", "end", bucket_seconds=14_400, extra_keys=["user_id"])
    return m.withColumn("seconds", FX.elapsed_seconds("ts", "start"))


_MATCH_SQL = """WITH w AS (SELECT event_id AS measurement_id, user_id, ts AS start, ts + INTERVAL 12 HOUR AS "end" FROM events
           WHERE event_type = 'signup'),
m AS (SELECT w.measurement_id, r.event_id, r.value,
             CAST(epoch_us(r.ts) - epoch_us(w.start) AS DOUBLE) / 1000000.0 AS seconds
      FROM events r JOIN w ON r.user_id = w.user_id AND r.ts >= w.start AND r.ts < w."end")"""


@register("flux_window_match", _MATCH_SQL + " SELECT measurement_id, event_id, seconds FROM m")
def flux_window_match(spark, sf):
    return _matched(spark, sf).select("measurement_id", "event_id", "seconds")


def _flux_slope_sql() -> str:
    const = 1.0 * (25.0 + math.pi * 60.0 * 0.0004) * 3.6  # pressure x (chamber and tubing volume) x mmol per hour
    return _MATCH_SQL + f""",
s AS (SELECT measurement_id, count(*) AS n_readings, CAST(count(*) AS DOUBLE) AS n, {_sql_exact('seconds')} AS sx, {_sql_exact('value')} AS sy,
             {_sql_exact('seconds * seconds')} AS sxx, {_sql_exact('seconds * value')} AS sxy FROM m GROUP BY 1),
b AS (SELECT measurement_id, n_readings, CASE WHEN n >= 2 AND n * sxx - sx * sx > 0 THEN (n * sxy - sx * sy) / (n * sxx - sx * sx) END AS slope FROM s)
SELECT measurement_id, n_readings, slope,
       slope * {const!r}::DOUBLE / (0.082057::DOUBLE * (CAST(measurement_id % 20 AS DOUBLE) + 283.15::DOUBLE) * 0.0625::DOUBLE) AS flux
FROM b
"""


@register("flux_slope", _flux_slope_sql())
def flux_slope(spark, sf):
    s = FX.measurement_slopes(_matched(spark, sf), ["measurement_id"], "value", "seconds")
    # the air temperature of each measurement is an input
    temp_k = (F.col("measurement_id") % 20).cast("double") + F.lit(283.15)
    return s.select("measurement_id", "n_readings", "slope", FX.flux_from_slope("slope", temp_k).alias("flux"))


@register("flux_gep", f"""
WITH f AS (SELECT user_id, strftime(ts, '%Y-%m-%d') AS day, CASE WHEN event_type IN ('purchase', 'click') THEN 'NEE' ELSE 'ER' END AS kind, value FROM events),
p AS (SELECT user_id, day, {_sql_exact('CASE WHEN kind = $$NEE$$ THEN value END')} / nullif(CAST(count(value) FILTER (kind = 'NEE') AS DOUBLE), 0) AS "NEE",
             {_sql_exact('CASE WHEN kind = $$ER$$ THEN value END')} / nullif(CAST(count(value) FILTER (kind = 'ER') AS DOUBLE), 0) AS "ER",
             count(value) FILTER (kind = 'NEE') AS "n_NEE", count(value) FILTER (kind = 'ER') AS "n_ER" FROM f GROUP BY 1, 2)
SELECT user_id, day, "NEE", "ER", "n_NEE", "n_ER", "NEE" - "ER" AS "GEP" FROM p
""")
def flux_gep(spark, sf):
    f = _t(spark, sf, "events").select(
        "user_id", F.date_format("ts", "yyyy-MM-dd").alias("day"),
        F.when(F.col("event_type").isin("purchase", "click"), F.lit("NEE")).otherwise(F.lit("ER")).alias("kind"), "value")
    return FX.gep(f, ["user_id", "day"], "kind", "value")


@register("exact_group_sums", f"""
WITH x AS (SELECT o_custkey, o_orderpriority, CASE WHEN o_orderkey % 11 <> 0 THEN o_totalprice * 1.2::DOUBLE / 7::DOUBLE END AS v FROM orders)
SELECT o_custkey, o_orderpriority, {_sql_exact('v')} AS total, {_sql_exact('v')} / nullif(CAST(count(v) AS DOUBLE), 0) AS mean,
       CASE WHEN count(v) = count(*) THEN {_sql_exact('v')} END AS strict
FROM x GROUP BY 1, 2
""")
def exact_group_sums(spark, sf):
    x = _t(spark, sf, "orders").select("o_custkey", "o_orderpriority", F.when(F.col("o_orderkey") % 11 != 0, F.col("o_totalprice") * F.lit(1.2) / F.lit(7.0)).alias("v"))
    return x.groupBy("o_custkey", "o_orderpriority").agg(X.sum_exact("v").alias("total"), X.mean_exact("v").alias("mean"), G.strict_sum_of(x, "v").alias("strict"))


@register("affinity_class", """
WITH j AS (SELECT l.l_partkey, r.r_name FROM lineitem l
           LEFT JOIN supplier s ON l.l_suppkey IS NOT DISTINCT FROM s.s_suppkey
           LEFT JOIN nation n ON s.s_nationkey IS NOT DISTINCT FROM n.n_nationkey
           LEFT JOIN region r ON n.n_regionkey IS NOT DISTINCT FROM r.r_regionkey),
a AS (SELECT l_partkey, bool_or(coalesce(r_name = 'AFRICA', false)) AS nem, bool_or(coalesce(r_name = 'AMERICA', false)) AS bor,
             bool_or(coalesce(r_name IN ('EUROPE', 'ASIA'), false)) AS alp FROM j GROUP BY 1)
SELECT l_partkey, CASE WHEN nem AND NOT alp THEN 'lowland' WHEN alp AND NOT nem AND NOT bor THEN 'alpine' ELSE 'generalist' END AS affinity
FROM a
""")
def affinity_class(spark, sf):
    li = _t(spark, sf, "lineitem").select("l_partkey", "l_suppkey")
    s = _t(spark, sf, "supplier").select("s_suppkey", "s_nationkey")
    j = J.join(li, s, [("l_suppkey", "s_suppkey")], "left")
    j = J.join(j, _t(spark, sf, "nation"), [("s_nationkey", "n_nationkey")], "left", broadcast=True)
    j = J.join(j, _t(spark, sf, "region"), [("n_regionkey", "r_regionkey")], "left", broadcast=True)
    return K.affinity(j, "l_partkey", "r_name", nemoral=["AFRICA"], boreal=["AMERICA"], alpine=["EUROPE", "ASIA"])


_STATUS_LEVELS = ["S", "J", "1", "F", "D"]  # fixed values: presence codes from lowest to highest


@register("highest_status", """
WITH e AS (SELECT user_id, strftime(ts, '%Y-%m-%d') AS day,
                  CASE event_type WHEN 'signup' THEN 'S' WHEN 'view' THEN 'J' WHEN 'click' THEN '1'
                                  WHEN 'purchase' THEN 'F' WHEN 'error' THEN 'D' END AS code FROM events),
r AS (SELECT *, CASE code WHEN 'S' THEN 1 WHEN 'J' THEN 2 WHEN '1' THEN 3 WHEN 'F' THEN 4 WHEN 'D' THEN 5 END AS rk FROM e)
SELECT user_id, day, arg_max(code, rk) AS status FROM r GROUP BY 1, 2
""")
def highest_status(spark, sf):
    e = _t(spark, sf, "events").select(
        "user_id", F.date_format("ts", "yyyy-MM-dd").alias("day"),
        S.recode("event_type", {"signup": "S", "view": "J", "click": "1", "purchase": "F", "error": "D"}).alias("code"))
    return K.highest_status(e, ["user_id", "day"], "code", _STATUS_LEVELS, out="status")


# ==========================================================================
# flagship: biomass-style chain ending in plot-ready totals
# ==========================================================================

_SITE_NAMES = {"NATION_1": "Alrust", "NATION_2": "Fauske", "NATION_3": "Gudmedalen"}


@register("plot_ready_totals", """
WITH li AS (SELECT CAST(year(l.l_shipdate) AS INTEGER) AS year, l.l_linenumber AS block0, l.l_linestatus AS treatment,
                   l.l_returnflag AS fg0, l.l_quantity AS biomass, n.n_name AS site0, r.r_name AS zone
            FROM lineitem l
            LEFT JOIN supplier s ON l.l_suppkey IS NOT DISTINCT FROM s.s_suppkey
            LEFT JOIN nation n ON s.s_nationkey IS NOT DISTINCT FROM n.n_nationkey
            LEFT JOIN region r ON n.n_regionkey IS NOT DISTINCT FROM r.r_regionkey
            WHERE l.l_linestatus <> 'X'),
e1 AS (SELECT year, treatment, fg0, biomass, zone,
              CASE site0 WHEN 'NATION_1' THEN 'Alrust' WHEN 'NATION_2' THEN 'Fauske' WHEN 'NATION_3' THEN 'Gudmedalen' ELSE site0 END AS site1,
              CASE WHEN (year = 1996 AND site0 = 'NATION_1' AND block0 = 1) IS NULL THEN NULL
                   WHEN year = 1996 AND site0 = 'NATION_1' AND block0 = 1 THEN 2 ELSE block0 END AS block1
       FROM li),
e2 AS (SELECT year, treatment, biomass, zone, site1, block1,
              CASE WHEN (year = 1999 AND site1 = 'Fauske' AND fg0 = 'R') IS NULL THEN NULL
                   WHEN year = 1999 AND site1 = 'Fauske' AND fg0 = 'R' THEN 'B' ELSE fg0 END AS fg1 FROM e1)
SELECT year, zone, treatment, fg1 AS removed_fg, sum(biomass) AS biomass,
       count(DISTINCT coalesce(substr(site1, 1, 3), 'NA') || coalesce(CAST(block1 AS VARCHAR), 'NA') || coalesce(treatment, 'NA')) AS n_plots
FROM e2 GROUP BY 1, 2, 3, 4
""")
def plot_ready_totals(spark, sf):
    li = _t(spark, sf, "lineitem").select(
        _year("l_shipdate").alias("year"), F.col("l_linenumber").alias("block"), F.col("l_linestatus").alias("treatment"),
        F.col("l_returnflag").alias("removed_fg"), F.col("l_quantity").alias("biomass"), "l_suppkey")
    s = _t(spark, sf, "supplier").select("s_suppkey", "s_nationkey")
    j = J.join(li, s, [("l_suppkey", "s_suppkey")], "left")
    j = J.join(j, _t(spark, sf, "nation"), [("s_nationkey", "n_nationkey")], "left", broadcast=True)
    j = J.join(j, _t(spark, sf, "region"), [("n_regionkey", "r_regionkey")], "left", broadcast=True)
    b = j.select("year", "block", "treatment", "removed_fg", "biomass",
                 F.col("n_name").alias("site"), F.col("r_name").alias("zone"))
    b = b.filter(F.col("treatment") != "X")
    b = C.apply_ordered_many(b, [
        ("block", (F.col("year") == 1996) & (F.col("site") == "NATION_1") & (F.col("block") == 1), F.lit(2)),
    ])
    b = b.withColumn("site", S.recode("site", _SITE_NAMES))
    b = C.apply_ordered_many(b, [
        ("removed_fg", (F.col("year") == 1999) & (F.col("site") == "Fauske") & (F.col("removed_fg") == "R"), F.lit("B")),
    ])
    b = b.withColumn("plotID", S.paste(S.r_substr("site", 1, 3), F.col("block"), F.col("treatment")))
    return (b.groupBy("year", "zone", "treatment", "removed_fg")
            .agg(F.sum("biomass").alias("biomass"), F.count_distinct("plotID").alias("n_plots")))


# ==========================================================================
# dataset chains over the driver tables
# ==========================================================================
# lineitem rows become biomass sheet rows: ship year + 20 -> survey year
# (2015-2021), supplier nation -> field site code, line number -> block,
# part -> treatment, return flag -> removed group, quantity / 100 -> biomass (g),
# supplier -> recorder name. Missing blocks, treatments, dates and rounds and
# the site spelling "OVSen" appear on deterministic subsets.

_FIELD_CODES = ["ULV", "LAV", "GUD", "SKJ", "ALR", "HOG", "RAM", "VES", "FAU", "VIK", "ARH", "OVS"]
_BIO_TREATMENTS = ["C", "F", "G", "B", "FB", "GB", "GF", "FGB"]
_BIO_NAMES = ["Olav", "Anja Petek", "PS", "IA", "VG", "sari", None, "x", "y", "z"]
_BIO_FG = {"A": "F", "N": "G", "R": "B"}


def _pick(expr, values):
    """Element ``expr`` (0-based) of a fixed list, as a literal lookup."""
    m = F.create_map(*[x for i, v in enumerate(values) for x in (F.lit(i), F.lit(v))])
    return F.try_element_at(m, expr.cast("int"))


def _biomass_raw(spark, sf):
    li = _t(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
                                          "l_returnflag", "l_shipdate")
    s = _t(spark, sf, "supplier").select("s_suppkey", "s_nationkey")
    j = J.join(li, s, [("l_suppkey", "s_suppkey")], "left")
    year = (_year("l_shipdate") + 20).cast("double")
    code = _pick(F.col("s_nationkey") % 12, _FIELD_CODES)
    site = F.when((code == "OVS") & (F.col("l_linenumber") == 7), F.lit("OVSen")).otherwise(code)
    block = F.when(F.col("l_suppkey") % 17 != 0, F.col("l_linenumber").cast("double"))
    trt = (F.when(F.col("l_partkey") % 97 == 0, F.lit(None).cast("string"))
           .when(F.col("l_partkey") % 50 == 0, F.lit("RTC"))
           .otherwise(_pick(F.col("l_partkey") % 8, _BIO_TREATMENTS)))
    date = F.when(~((year == 2018) & (F.col("l_orderkey") % 5 == 0)),
                  F.add_months(F.to_date("l_shipdate"), 240).cast("timestamp"))
    rnd = F.when(F.col("l_orderkey") % 7 != 0,
                 F.concat(F.lit("Round "), (F.col("l_linenumber") % 2 + 1).cast("string")))
    return j.select(year.alias("Year"), site.alias("Site"), block.alias("Block"), trt.alias("Treatment"),
                    S.recode("l_returnflag", _BIO_FG).alias("Removed functional group"), date.alias("Date"),
                    rnd.alias("Round"), (F.col("l_quantity") / 100).alias("Biomass"),
                    _pick(F.col("l_suppkey") % 10, _BIO_NAMES).alias("Name"),
                    F.lit(None).cast("string").alias("Remark"))


def _sql_list_pick(expr: str, values) -> str:
    arms = " ".join(f"WHEN {i} THEN {'NULL' if v is None else repr(v)}" for i, v in enumerate(values))
    return f"CASE {expr} {arms} END"


# The biomass record repairs in order, written out for the oracle (fixed values): column, condition, new value.
_REPAIRS_SQL = [
    ("block", "year = 2019 AND site = 'ARH' AND block IS NULL", "4.0"),
    ("block", "year = 2015 AND site = 'ALR' AND block = 4", "5.0"),
    ("block", "year = 2016 AND site = 'ALR' AND block = 1 AND name = 'Olav'", "2.0"),
    ("block", "year = 2017 AND site = 'ALR' AND block = 1 AND name = 'Anja Petek'", "2.0"),
    ("block", "year = 2019 AND site = 'HOG' AND block = 3 AND treatment = 'F' AND name = 'PS'", "4.0"),
    ("block", "year = 2019 AND site = 'ULV' AND coalesce(block IN (4, 5, 6), false) AND name = 'IA'", "3.0"),
    ("block", "year = 2019 AND site = 'VES' AND block = 3 AND treatment = 'FGB' AND name = 'PS'", "4.0"),
    ("treatment", "year = 2019 AND site = 'VIK' AND block = 5 AND biomass = CAST(0.57 AS DOUBLE) AND name = 'VG'", "'FB'"),
    ("removed_fg", "year = 2019 AND site = 'VIK' AND block = 2 AND biomass = CAST(1.77 AS DOUBLE) AND name = 'sari'", "'F'"),
    ("removed_fg", "year = 2019 AND site = 'GUD' AND block = 12 AND biomass = CAST(0.56 AS DOUBLE) AND name = 'PS'", "'G'"),
    ("removed_fg", "year = 2019 AND site = 'GUD' AND block = 12 AND biomass = CAST(0.17 AS DOUBLE) AND name = 'PS'", "'B'"),
    ("removed_fg", "year = 2019 AND site = 'GUD' AND block = 12 AND biomass = CAST(0.89 AS DOUBLE) AND name = 'PS'", "'G'"),
    ("treatment", "year = 2019 AND site = 'SKJ' AND block = 2 AND coalesce(biomass IN (CAST(0.43 AS DOUBLE), CAST(1.84 AS DOUBLE)), false) AND name = 'sari'", "'FB'"),
]


def _sql_edits(prev: str, edits) -> tuple[str, str]:
    """CTE chain of ordered strict edits: an unknown condition gives NULL."""
    ctes, cur = [], prev
    for i, (target, cond, val) in enumerate(edits):
        name = f"rep{i}"
        ctes.append(f"{name} AS (SELECT * REPLACE (CASE WHEN ({cond}) IS NULL THEN NULL WHEN {cond} THEN {val} ELSE {target} END AS {target}) FROM {cur})")
        cur = name
    return ",\n".join(ctes), cur


def _biomass_sql() -> str:
    raw = f"""raw AS (
  SELECT CAST(year(l.l_shipdate) + 20 AS DOUBLE) AS "Year",
         CASE WHEN {_sql_list_pick('s.s_nationkey % 12', _FIELD_CODES)} = 'OVS' AND l.l_linenumber = 7 THEN 'OVSen'
              ELSE {_sql_list_pick('s.s_nationkey % 12', _FIELD_CODES)} END AS "Site",
         CASE WHEN l.l_suppkey % 17 <> 0 THEN CAST(l.l_linenumber AS DOUBLE) END AS "Block",
         CASE WHEN l.l_partkey % 97 = 0 THEN NULL WHEN l.l_partkey % 50 = 0 THEN 'RTC'
              ELSE {_sql_list_pick('l.l_partkey % 8', _BIO_TREATMENTS)} END AS "Treatment",
         CASE l.l_returnflag WHEN 'A' THEN 'F' WHEN 'N' THEN 'G' WHEN 'R' THEN 'B' ELSE l.l_returnflag END AS fg,
         CASE WHEN NOT (year(l.l_shipdate) + 20 = 2018 AND l.l_orderkey % 5 = 0)
              THEN CAST(l.l_shipdate AS DATE) + INTERVAL 20 YEAR END AS "Date",
         CASE WHEN l.l_orderkey % 7 <> 0 THEN 'Round ' || CAST(l.l_linenumber % 2 + 1 AS VARCHAR) END AS "Round",
         l.l_quantity / 100 AS "Biomass",
         {_sql_list_pick('l.l_suppkey % 10', _BIO_NAMES)} AS "Name",
         CAST(NULL AS VARCHAR) AS "Remark"
  FROM lineitem l LEFT JOIN supplier s ON l.l_suppkey IS NOT DISTINCT FROM s.s_suppkey)"""
    rounds = ", ".join(f"({y}, '{s}', {b}, '{r}')" for y, s, b, r in DD.BIOMASS_ROUNDS)
    dates = ", ".join(f"({y}, '{s}', DATE '{d}')" for y, s, d in DD.BIOMASS_DATES)
    sites = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in DD.SITE_FROM_FIELD_CODE.items())
    reps, last = _sql_edits("b1", _REPAIRS_SQL)
    return f"""WITH {raw},
b0 AS (SELECT "Year" AS year, CAST(CAST("Date" AS DATE) AS DATE) AS date,
              CASE WHEN "Site" = 'OVSen' THEN 'OVS' ELSE "Site" END AS site, "Block" AS block,
              "Treatment" AS treatment, fg AS removed_fg, right("Round", 1) AS round, "Biomass" AS biomass,
              "Name" AS name, "Remark" AS remark FROM raw),
rl AS (SELECT CAST(year AS DOUBLE) AS year, site, CAST(UNNEST(blocks) AS DOUBLE) AS block, round_new
       FROM (VALUES {rounds}) t(year, site, blocks, round_new)),
b1 AS (SELECT b0.year, b0.date, b0.site, b0.block, b0.treatment, b0.removed_fg,
              CASE WHEN b0.round IS NULL THEN rl.round_new ELSE b0.round END AS round, b0.biomass, b0.name, b0.remark
       FROM b0 LEFT JOIN rl ON b0.year IS NOT DISTINCT FROM rl.year AND b0.site IS NOT DISTINCT FROM rl.site
                           AND b0.block IS NOT DISTINCT FROM rl.block
       WHERE b0.treatment <> 'RTC'),
{reps},
dl AS (SELECT CAST(year AS DOUBLE) AS year, site, newdate FROM (VALUES {dates}) t(year, site, newdate)),
b2 AS (SELECT r.year, CASE WHEN r.date IS NULL THEN dl.newdate ELSE r.date END AS date,
              CASE r.site {sites} ELSE r.site END AS site, r.block, r.treatment, r.removed_fg, r.round, r.biomass,
              r.name, r.remark
       FROM {last} r LEFT JOIN dl ON r.year IS NOT DISTINCT FROM dl.year AND r.site IS NOT DISTINCT FROM dl.site),
b3 AS (SELECT *, coalesce(substr(site, 1, 3), 'NA') || coalesce(CASE WHEN block = floor(block) AND abs(block) < 1e15
              THEN CAST(CAST(block AS BIGINT) AS VARCHAR) ELSE CAST(block AS VARCHAR) END, 'NA') AS "blockID" FROM b2)
SELECT CAST(year AS INTEGER) AS year, strftime(date, '%Y-%m-%d') AS date, round, site AS "siteID", "blockID",
       "blockID" || coalesce(treatment, 'NA') AS "plotID", treatment, removed_fg, biomass, name, remark FROM b3"""


@register("biomass_chain", _biomass_sql())
def biomass_chain(spark, sf):
    from . import biomass as BM
    clean = BM.clean_biomass(_biomass_raw(spark, sf))
    return clean.withColumn("date", F.date_format("date", "yyyy-MM-dd"))


# a rule table made of the nations: two rules each, the second one tests what the first one left; rows without a
# supplier leave every rule unknown whose other tests hold
@register("ordered_rules_table", """
WITH x AS (SELECT l_orderkey, l_linenumber, CASE WHEN l_partkey % 97 <> 0 THEN CAST(l_suppkey % 25 AS INTEGER) END AS nation, l_returnflag AS flag, l_quantity AS quantity FROM lineitem),
f AS (SELECT * REPLACE (CASE WHEN nation IS NULL THEN NULL WHEN l_linenumber = nation % 7 + 1 THEN 'X' || nation % 3 ELSE flag END AS flag) FROM x)
SELECT * REPLACE (CASE WHEN nation IS NULL THEN NULL WHEN flag = 'X' || nation % 3 THEN CAST(nation AS DOUBLE) ELSE quantity END AS quantity) FROM f
""")
def ordered_rules_table(spark, sf):
    n = F.col("n_nationkey").cast("int")
    mark = F.concat(F.lit("X"), (n % 3).cast("string"))

    def test(step: int, target: str, column: str, given, value):
        return F.struct((n * 2 + step).alias("seq"), F.lit(target).alias("target"), F.lit(column).alias("column"), F.lit("==").alias("op"),
                        F.array(given.cast("string")).alias("values"), F.lit("set").alias("action"), value.cast("string").alias("value"))

    tests = [test(0, "flag", "nation", n, mark), test(0, "flag", "l_linenumber", n % 7 + 1, mark), test(1, "quantity", "nation", n, n), test(1, "quantity", "flag", mark, n)]
    rules = _t(spark, sf, "nation").select(F.explode(F.array(*tests)).alias("r")).select("r.*")
    x = _t(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", F.when(F.col("l_partkey") % 97 != 0, (F.col("l_suppkey") % 25).cast("int")).alias("nation"),
                                         F.col("l_returnflag").alias("flag"), F.col("l_quantity").alias("quantity"))
    return RU.apply_rules(x, RU.rules_of(rules))


# events become soil-moisture sheet rows: user -> site and block, event ->
# treatment, values -> readings (whole numbers as text, some unreadable),
# day of the event -> day in July of the survey year. Turf ids carry the
# fragments the chains exclude on deterministic subsets.

_SM_OLD = [old for old, _, _, _ in DD.SITE_CODES]
_SM_V2 = [v2 for _, v2, _, _ in DD.SITE_CODES]


def _ev(spark, sf, year: int):
    """Every event is a reading of one of the survey years 2016, 2017, 2018, by its day."""
    return _t(spark, sf, "events").filter(F.dayofmonth("ts") % 3 == year - 2016)


def _july(year: int):
    return F.concat(F.lit(f"{year}-07-"), F.lpad(F.dayofmonth("ts").cast("string"), 2, "0"))


def _sm1516_raw(spark, sf):
    e = _ev(spark, sf, 2016)
    eid = F.col("event_id")
    site = _pick(F.col("user_id") % 12, _SM_OLD)
    block = (F.col("user_id") % 4 + 1).cast("int")
    trt = _pick(eid % 8, _BIO_TREATMENTS)
    turf = F.concat(site, block.cast("string"), trt)
    turf = (F.when(eid % 23 == 0, F.concat(turf, F.lit("TT1"))).when(eid % 29 == 0, F.concat(turf, F.lit("RTC")))
            .when(eid % 31 == 0, F.concat(turf, F.lit("P"))).otherwise(turf))
    date = F.when(eid % 2 == 0, _july(2015)).otherwise(_july(2016))
    return e.select(
        date.alias("date"), site.alias("site"), block.cast("double").alias("block"), turf.alias("turfID"),
        F.when(eid % 37 == 0, F.lit(None).cast("string")).when(eid % 41 == 0, F.lit("XC")).otherwise(trt)
         .alias("treatment"),
        F.when(eid % 5 != 0, trt).alias("removal"),
        F.floor("value").cast("string").alias("M1"), (F.col("user_id") % 10).cast("string").alias("M2"),
        F.when(eid % 3 == 0, F.lit("x")).otherwise((eid % 7).cast("string")).alias("M3"),
        F.when(eid % 2 != 0, (eid % 5).cast("string")).alias("M4"),
        F.lit(None).cast("string").alias("blockSD"), F.lit(None).cast("string").alias("Moisture"),
        F.col("event_type").alias("weather"), F.concat(F.lit("R"), (F.col("user_id") % 3).cast("string")).alias("recorder"),
        F.when(eid % 11 == 0, F.lit("fewer readings")).when(eid % 13 == 0, F.lit("bad")).alias("comments"))


def _sm1516_sql() -> str:
    old_new = " ".join(f"WHEN '{o}' THEN '{n}'" for o, _, _, n in DD.SITE_CODES)
    fixes = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in DD.SITE_NAME_FIXES.items())
    site = _sql_list_pick("user_id % 12", _SM_OLD)
    trt = _sql_list_pick("event_id % 8", _BIO_TREATMENTS)
    july = "'-07-' || lpad(CAST(day(ts) AS VARCHAR), 2, '0')"
    return f"""WITH e AS (SELECT *, {site} AS site, CAST(user_id % 4 + 1 AS INTEGER) AS block, {trt} AS trt FROM events
           WHERE day(ts) % 3 = 0),
r0 AS (SELECT *, site || CAST(block AS VARCHAR) || trt AS t0 FROM e),
raw AS (SELECT CASE WHEN event_id % 2 = 0 THEN '2015' || {july} ELSE '2016' || {july} END AS date, site, block,
          CASE WHEN event_id % 23 = 0 THEN t0 || 'TT1' WHEN event_id % 29 = 0 THEN t0 || 'RTC'
               WHEN event_id % 31 = 0 THEN t0 || 'P' ELSE t0 END AS "turfID",
          CASE WHEN event_id % 37 = 0 THEN NULL WHEN event_id % 41 = 0 THEN 'XC' ELSE trt END AS treatment,
          CASE WHEN event_id % 5 <> 0 THEN trt END AS removal,
          CAST(CAST(floor(value) AS BIGINT) AS VARCHAR) AS "M1", CAST(user_id % 10 AS VARCHAR) AS "M2",
          CASE WHEN event_id % 3 = 0 THEN 'x' ELSE CAST(event_id % 7 AS VARCHAR) END AS "M3",
          CASE WHEN event_id % 2 <> 0 THEN CAST(event_id % 5 AS VARCHAR) END AS "M4",
          event_type AS weather, 'R' || CAST(user_id % 3 AS VARCHAR) AS recorder,
          CASE WHEN event_id % 11 = 0 THEN 'fewer readings' WHEN event_id % 13 = 0 THEN 'bad' END AS comments
        FROM r0),
f AS (SELECT *, TRY_CAST("M1" AS DOUBLE) AS d1, TRY_CAST("M2" AS DOUBLE) AS d2, TRY_CAST("M3" AS DOUBLE) AS d3,
             TRY_CAST("M4" AS DOUBLE) AS d4 FROM raw
      WHERE (coalesce(comments IN ('fewer readings', 'above table', 'above table 100%'), false) OR comments IS NULL)
        AND NOT coalesce(regexp_matches("turfID", 'TT1'), false) AND NOT coalesce(regexp_matches("turfID", 'TT2'), false)
        AND NOT coalesce(regexp_matches("turfID", 'TT3'), false) AND NOT coalesce(regexp_matches("turfID", 'TT4'), false)
        AND NOT coalesce(regexp_matches("turfID", 'RTC'), false) AND NOT coalesce(regexp_matches("turfID", 'P'), false)
        AND treatment IS NOT NULL),
g AS (SELECT date, "turfID",
             sum(coalesce(d1, 0) + coalesce(d2, 0) + coalesce(d3, 0) + coalesce(d4, 0))
             / nullif(CAST(sum(CAST(d1 IS NOT NULL AS BIGINT) + CAST(d2 IS NOT NULL AS BIGINT)
                               + CAST(d3 IS NOT NULL AS BIGINT) + CAST(d4 IS NOT NULL AS BIGINT)) AS DOUBLE), 0) AS sm
      FROM f GROUP BY 1, 2),
j AS (SELECT f.*, g.sm, CASE f.site {old_new} ELSE f.site END AS site1, coalesce(f.removal, 'C') AS removal1
      FROM f LEFT JOIN g ON f.date IS NOT DISTINCT FROM g.date AND f."turfID" IS NOT DISTINCT FROM g."turfID")
SELECT strftime(CAST(try_strptime(date, '%Y-%m-%d') AS DATE), '%Y-%m-%d') AS date,
       CASE site1 {fixes} ELSE site1 END AS "siteID",
       coalesce(substr(site1, 1, 3), 'NA') || coalesce(CAST(block AS VARCHAR), 'NA') AS "blockID",
       coalesce(substr(site1, 1, 3), 'NA') || coalesce(CAST(block AS VARCHAR), 'NA') || removal1 AS "plotID",
       removal1 AS treatment, sm AS soilmoisture, weather, recorder, "turfID"
FROM j WHERE NOT (treatment = 'XC')"""


@register("soil_moisture_2015_16_chain", _sm1516_sql())
def soil_moisture_2015_16_chain(spark, sf):
    from . import soil_moisture as SMP
    out = SMP.sm_2015_16(_sm1516_raw(spark, sf))
    return out.withColumn("date", F.date_format("date", "yyyy-MM-dd"))


def _sm2017_raw(spark, sf):
    e = _ev(spark, sf, 2017)
    eid = F.col("event_id")
    d = F.to_date(_july(2017))
    date = (F.when(eid % 53 == 0, F.lit("n.a.")).when(eid % 10 == 4, F.date_format(d, "d.M.yy"))
            .when(eid % 2 == 0, F.date_format(d, "d.M.yyyy"))
            .otherwise(F.datediff(d, F.lit("1899-12-30").cast("date")).cast("string")))
    code = _pick(F.col("user_id") % 12, _FIELD_CODES)
    block = (F.col("user_id") % 4 + 1).cast("int")
    trt = _pick(eid % 8, _BIO_TREATMENTS)
    turf = F.concat(code, block.cast("string"), trt)
    turf = (F.when(eid % 19 == 0, F.concat(F.col("user_id").cast("string"), F.lit(" TTC")))
            .when(eid % 23 == 0, F.concat(turf, F.lit("TT1"))).when(eid % 31 == 0, F.concat(turf, F.lit("P")))
            .otherwise(turf))
    allnull = eid % 47 == 0
    return e.select(
        date.alias("Date"), code.alias("Site"), F.when(eid % 3 != 0, block.cast("double")).alias("SCBlock...5"),
        F.when(eid % 3 == 0, block.cast("double")).alias("SCBlock...6"), turf.alias("Turf ID"),
        F.when((eid % 19 == 0) | (eid % 43 == 0), F.lit(None).cast("string")).otherwise(trt).alias("Treatment"),
        F.when(~allnull, F.floor("value").cast("string")).alias("Measurement1"),
        F.when(~allnull & (eid % 4 != 0), (F.col("user_id") % 10).cast("string")).alias("Measurement2"),
        F.when(~allnull, F.when(eid % 3 == 0, F.lit("x")).otherwise((eid % 7).cast("string"))).alias("Measurement3"),
        F.lit(None).cast("string").alias("Measurement4"),
        F.col("event_type").alias("Weather"), F.concat(F.lit("R"), (F.col("user_id") % 3).cast("string")).alias("Recorder"))


def _sm2017_sql() -> str:
    code = _sql_list_pick("user_id % 12", _FIELD_CODES)
    trt = _sql_list_pick("event_id % 8", _BIO_TREATMENTS)
    sites = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in DD.SITE_FROM_FIELD_CODE.items())
    return f"""WITH e AS (SELECT *, {code} AS code, CAST(user_id % 4 + 1 AS INTEGER) AS block, {trt} AS trt,
                  CAST('2017-07-' || lpad(CAST(day(ts) AS VARCHAR), 2, '0') AS DATE) AS d,
                  event_id % 47 = 0 AS allnull FROM events WHERE day(ts) % 3 = 1),
raw AS (SELECT CASE WHEN event_id % 53 = 0 THEN 'n.a.' WHEN event_id % 10 = 4 THEN strftime(d, '%-d.%-m.%y') WHEN event_id % 2 = 0 THEN strftime(d, '%-d.%-m.%Y')
                    ELSE CAST(datediff('day', DATE '1899-12-30', d) AS VARCHAR) END AS "Date",
               code AS "Site", CASE WHEN event_id % 3 <> 0 THEN block END AS b5,
               CASE WHEN event_id % 3 = 0 THEN block END AS b6,
               CASE WHEN event_id % 19 = 0 THEN CAST(user_id AS VARCHAR) || ' TTC'
                    WHEN event_id % 23 = 0 THEN code || CAST(block AS VARCHAR) || trt || 'TT1'
                    WHEN event_id % 31 = 0 THEN code || CAST(block AS VARCHAR) || trt || 'P'
                    ELSE code || CAST(block AS VARCHAR) || trt END AS "turfID",
               CASE WHEN event_id % 19 = 0 OR event_id % 43 = 0 THEN NULL ELSE trt END AS "Treatment",
               CASE WHEN NOT allnull THEN CAST(CAST(floor(value) AS BIGINT) AS VARCHAR) END AS m1,
               CASE WHEN NOT allnull AND event_id % 4 <> 0 THEN CAST(user_id % 10 AS VARCHAR) END AS m2,
               CASE WHEN NOT allnull THEN CASE WHEN event_id % 3 = 0 THEN 'x' ELSE CAST(event_id % 7 AS VARCHAR) END END AS m3,
               CAST(NULL AS VARCHAR) AS m4, event_type AS "Weather", 'R' || CAST(user_id % 3 AS VARCHAR) AS "Recorder"
        FROM e),
p AS (SELECT *, CASE WHEN regexp_matches("Date", '[.][0-9][0-9]$') THEN CAST(try_strptime("Date", '%d.%m.%y') AS DATE)
                     WHEN contains("Date", '.') THEN CAST(try_strptime("Date", '%d.%m.%Y') AS DATE)
                     ELSE DATE '1899-12-30' + CAST(floor(TRY_CAST("Date" AS DOUBLE)) AS INTEGER) END AS pdate,
             TRY_CAST(m1 AS DOUBLE) AS d1, TRY_CAST(m2 AS DOUBLE) AS d2, TRY_CAST(m3 AS DOUBLE) AS d3,
             TRY_CAST(m4 AS DOUBLE) AS d4 FROM raw
      WHERE NOT coalesce(regexp_matches("turfID", 'TT1'), false) AND NOT coalesce(regexp_matches("turfID", 'TT2'), false)
        AND NOT coalesce(regexp_matches("turfID", 'TT3'), false) AND NOT coalesce(regexp_matches("turfID", 'TT4'), false)
        AND NOT coalesce(regexp_matches("turfID", 'RTC'), false) AND NOT coalesce(regexp_matches("turfID", 'P'), false)),
m AS (SELECT *, (coalesce(d1, 0) + coalesce(d2, 0) + coalesce(d3, 0) + coalesce(d4, 0))
                / nullif(CAST(CAST(d1 IS NOT NULL AS INT) + CAST(d2 IS NOT NULL AS INT) + CAST(d3 IS NOT NULL AS INT)
                              + CAST(d4 IS NOT NULL AS INT) AS DOUBLE), 0) AS soilmoisture,
             CASE WHEN "Treatment" IS NULL AND coalesce(regexp_matches("turfID", 'TTC'), false) THEN 'C'
                  ELSE "Treatment" END AS trt1 FROM p),
s AS (SELECT *, CASE "Site" {sites} ELSE "Site" END AS site1, coalesce(b5, b6) AS block1 FROM m
      WHERE soilmoisture IS NOT NULL AND trt1 IS NOT NULL)
SELECT strftime(pdate, '%Y-%m-%d') AS date, site1 AS "siteID",
       coalesce(substr(site1, 1, 3), 'NA') || coalesce(CAST(block1 AS VARCHAR), 'NA') AS "blockID",
       coalesce(substr(site1, 1, 3), 'NA') || coalesce(CAST(block1 AS VARCHAR), 'NA') || trt1 AS "plotID",
       trt1 AS treatment, soilmoisture, "Weather" AS weather, "Recorder" AS recorder, "turfID" FROM s"""


@register("soil_moisture_2017_chain", _sm2017_sql())
def soil_moisture_2017_chain(spark, sf):
    from . import soil_moisture as SMP
    out = SMP.sm_2017(_sm2017_raw(spark, sf))
    return out.withColumn("date", F.date_format("date", "yyyy-MM-dd"))


_TTC_NUMS = [t.split(" ")[0] for t, _ in DD.TTC_TURF]
_TTC_SITES = [{o: n for o, _, _, n in DD.SITE_CODES}[f[:3]]
              for _, f in DD.TTC_TURF]


def _sm2018_raw(spark, sf):
    e = _ev(spark, sf, 2018)
    eid, uid = F.col("event_id"), F.col("user_id")
    old = _pick(uid % 12, _SM_OLD)
    v2 = F.when(uid % 50 == 0, F.lit("XXX")).otherwise(_pick(uid % 12, _SM_V2))
    block = uid % 4 + 1
    trt = _pick(eid % 8, _BIO_TREATMENTS)
    fc = F.concat(old, block.cast("string"), trt)
    turf = (F.when(eid % 9 == 0, F.concat(F.lit("TTC "), _pick(uid % 31, _TTC_NUMS)))
            .when(eid % 13 == 0, F.concat(fc, F.lit("P"))).otherwise(fc))
    ts = F.to_timestamp(F.concat(_july(2018), F.lit(" 10:00:00")))
    return e.select(
        F.when(eid % 7 != 0, ts).alias("Date"), v2.alias("Site"), block.cast("double").alias("FCBlock"),
        turf.alias("turfID"), F.when(eid % 11 != 0, trt).alias("Treatment"),
        F.when((eid % 9 == 0) & (eid % 27 == 0), F.lit(None).cast("string"))
         .when(eid % 5 == 0, F.lit("u")).otherwise((eid % 6).cast("string")).alias("Measurement1"),
        F.floor("value").cast("string").alias("Measurement2"),
        F.when(eid % 4 != 0, (uid % 7).cast("string")).alias("Measurement3"),
        (uid % 10).cast("string").alias("Measurement4"),
        F.col("event_type").alias("Weather"), F.concat(F.lit("R"), (uid % 3).cast("string")).alias("Recorder"))


def _sm2018_sql() -> str:
    old = _sql_list_pick("user_id % 12", _SM_OLD)
    v2 = _sql_list_pick("user_id % 12", _SM_V2)
    trt = _sql_list_pick("event_id % 8", _BIO_TREATMENTS)
    nums = _sql_list_pick("user_id % 31", _TTC_NUMS)
    sites = ", ".join(f"('{v}', '{n}')" for _, v, _, n in DD.SITE_CODES)
    ttc = ", ".join(f"('{a}', '{b}')" for a, b in DD.TTC_TURF)
    fixes = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in DD.SITE_NAME_FIXES.items())
    cols = '"Date", "blockID", "turfID", "Treatment", m1, m2, m3, m4, "Weather", "Recorder", "siteID"'
    return f"""WITH e AS (SELECT *, {old} AS old, {v2} AS v2c, user_id % 4 + 1 AS block, {trt} AS trt FROM events
           WHERE day(ts) % 3 = 2),
raw AS (SELECT CASE WHEN event_id % 7 <> 0
                    THEN CAST('2018-07-' || lpad(CAST(day(ts) AS VARCHAR), 2, '0') || ' 10:00:00' AS TIMESTAMP) END AS "Date",
               CASE WHEN user_id % 50 = 0 THEN 'XXX' ELSE v2c END AS "Site", CAST(block AS DOUBLE) AS "FCBlock",
               CASE WHEN event_id % 9 = 0 THEN 'TTC ' || {nums}
                    WHEN event_id % 13 = 0 THEN old || CAST(block AS VARCHAR) || trt || 'P'
                    ELSE old || CAST(block AS VARCHAR) || trt END AS "turfID",
               CASE WHEN event_id % 11 <> 0 THEN trt END AS "Treatment",
               CASE WHEN event_id % 9 = 0 AND event_id % 27 = 0 THEN NULL WHEN event_id % 5 = 0 THEN 'u'
                    ELSE CAST(event_id % 6 AS VARCHAR) END AS m1,
               CAST(CAST(floor(value) AS BIGINT) AS VARCHAR) AS m2,
               CASE WHEN event_id % 4 <> 0 THEN CAST(user_id % 7 AS VARCHAR) END AS m3,
               CAST(user_id % 10 AS VARCHAR) AS m4, event_type AS "Weather", 'R' || CAST(user_id % 3 AS VARCHAR) AS "Recorder"
        FROM e),
sites AS (SELECT * FROM (VALUES {sites}) t(v2, new)),
ttc AS (SELECT * FROM (VALUES {ttc}) t("TTtreat", "turfID")),
t1 AS (SELECT *, CASE WHEN length(replace("turfID", 'TTC ', '')) < 4 THEN replace("turfID", 'TTC ', '') || ' TTC'
                      ELSE replace("turfID", 'TTC ', '') END AS ttreat, 'C' AS trtc
       FROM raw WHERE coalesce(regexp_matches("turfID", 'TTC'), false)),
t2 AS (SELECT t1."Date", t1."FCBlock" AS "blockID", t1.ttreat AS "TTtreat",
              t1.trtc AS "Treatment",
              t1.m1, t1.m2, t1.m3, t1.m4, t1."Weather", t1."Recorder", s.new AS "siteID"
       FROM t1 RIGHT JOIN sites s ON t1."Site" IS NOT DISTINCT FROM s.v2),
t3 AS (SELECT t2."Date", t2."blockID", d."turfID", t2."Treatment", t2.m1, t2.m2, t2.m3, t2.m4, t2."Weather",
              t2."Recorder", t2."siteID"
       FROM t2 RIGHT JOIN ttc d ON t2."TTtreat" IS NOT DISTINCT FROM d."TTtreat" WHERE t2.m1 IS NOT NULL),
m0 AS (SELECT r."Date", r."FCBlock" AS "blockID", r."turfID", r."Treatment", r.m1, r.m2, r.m3, r.m4, r."Weather",
              r."Recorder", s.new AS "siteID"
       FROM raw r RIGHT JOIN sites s ON r."Site" IS NOT DISTINCT FROM s.v2),
u AS (SELECT {cols} FROM m0 WHERE NOT coalesce(regexp_matches("turfID", 'T'), false)
                              AND NOT coalesce(regexp_matches("turfID", 'P'), false)
      UNION ALL SELECT {cols} FROM t3),
v AS (SELECT *, TRY_CAST(replace(m1, 'u', '0') AS DOUBLE) AS d1, TRY_CAST(replace(m2, 'u', '0') AS DOUBLE) AS d2,
             TRY_CAST(replace(m3, 'u', '0') AS DOUBLE) AS d3, TRY_CAST(replace(m4, 'u', '0') AS DOUBLE) AS d4 FROM u),
w AS (SELECT *, (coalesce(d1, 0) + coalesce(d2, 0) + coalesce(d3, 0) + coalesce(d4, 0))
                / nullif(CAST(CAST(d1 IS NOT NULL AS INT) + CAST(d2 IS NOT NULL AS INT) + CAST(d3 IS NOT NULL AS INT)
                              + CAST(d4 IS NOT NULL AS INT) AS DOUBLE), 0) AS sm
      FROM v WHERE "Treatment" IS NOT NULL),
x AS (SELECT *, CASE WHEN "Date" IS NULL AND "siteID" = 'Arhelleren' THEN TIMESTAMP '2018-07-02 00:00:00'
                     ELSE "Date" END AS dt1 FROM w),
y AS (SELECT *, CASE WHEN dt1 IS NULL AND "siteID" = 'Ovstedal' THEN TIMESTAMP '2018-07-02 00:00:00'
                     ELSE dt1 END AS dt2 FROM x)
SELECT strftime(dt2, '%Y-%m-%d %H:%M:%S') AS date, CASE "siteID" {fixes} ELSE "siteID" END AS "siteID",
       substr("siteID", 1, 3) AS "blockID", "Treatment" AS treatment, sm AS soilmoisture, "Weather" AS weather,
       "Recorder" AS recorder, "turfID" FROM y"""


@register("soil_moisture_2018_chain", _sm2018_sql())
def soil_moisture_2018_chain(spark, sf):
    from . import soil_moisture as SMP
    out = SMP.sm_2018(_sm2018_raw(spark, sf))
    return out.withColumn("date", F.date_format("date", "yyyy-MM-dd HH:mm:ss"))


def _soil_moisture_sql() -> str:
    """The union of the three surveys, with zones and levels written out."""
    return f"""WITH u AS (
  SELECT date || ' 00:00:00' AS date, "siteID", "blockID", "plotID", treatment, soilmoisture, weather, recorder, "turfID" FROM ({_sm1516_sql()})
  UNION ALL SELECT date || ' 00:00:00', "siteID", "blockID", "plotID", treatment, soilmoisture, weather, recorder, "turfID" FROM ({_sm2017_sql()})
  UNION ALL SELECT date, "siteID", "blockID", NULL, treatment, soilmoisture, weather, recorder, "turfID" FROM ({_sm2018_sql()})),
c AS (SELECT *, CASE WHEN "siteID" IN ('Ulvehaugen', 'Lavisdalen', 'Gudmedalen', 'Skjelingahaugen') THEN 'alpine'
        WHEN "siteID" IN ('Alrust', 'Hogsete', 'Rambera', 'Veskre') THEN 'sub.alpine'
        WHEN "siteID" IN ('Fauske', 'Vikesland', 'Arhelleren', 'Ovstedalen') THEN 'boreal' END AS biogeographic_zone,
      CASE WHEN "siteID" IN ('Ulvehaugen', 'Alrust', 'Fauske') THEN 1 WHEN "siteID" IN ('Lavisdalen', 'Hogsete', 'Vikesland') THEN 2
        WHEN "siteID" IN ('Gudmedalen', 'Rambera', 'Arhelleren') THEN 3 WHEN "siteID" IN ('Skjelingahaugen', 'Veskre', 'Ovstedalen') THEN 4 END AS level FROM u)
SELECT date, "siteID", "blockID", "plotID", treatment, soilmoisture, weather, recorder, "turfID", biogeographic_zone,
  CAST(level AS DOUBLE) AS prep_level, biogeographic_zone || CAST(level AS VARCHAR) AS climate,
  CAST(CASE biogeographic_zone WHEN 'boreal' THEN 0 WHEN 'sub.alpine' THEN 4 WHEN 'alpine' THEN 8 END + level AS DOUBLE) AS climate_rank FROM c"""


@register("soil_moisture_union", _soil_moisture_sql())
def soil_moisture_union(spark, sf):
    from . import soil_moisture as SMP
    out = SMP.soil_moisture(_sm1516_raw(spark, sf), _sm2017_raw(spark, sf), _sm2018_raw(spark, sf))
    out = SMP.with_climate(out)
    return out.withColumns({"date": F.date_format("date", "yyyy-MM-dd HH:mm:ss"), "prep_level": F.col("prep_level").cast("double"),
                            "climate_rank": F.col("climate_rank").cast("double")})


# lineitem rows become greenness readings: supplier nation -> site as spelled
# in the field files (with Norwegian letters), line number -> block, part ->
# treatment, discount / tax -> readings, ship day -> survey day.

_RF19 = list(DD.REFLECTANCE_SITES_2019)
_RF21 = list(DD.REFLECTANCE_SITES_2021)


def _rf_base(spark, sf):
    li = _t(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_discount",
                                          "l_tax", "l_shipdate")
    s = _t(spark, sf, "supplier").select("s_suppkey", "s_nationkey")
    return J.join(li, s, [("l_suppkey", "s_suppkey")], "left")


@register("reflectance_2019_chain", f"""
WITH b AS (SELECT l.*, s.s_nationkey FROM lineitem l LEFT JOIN supplier s ON l.l_suppkey IS NOT DISTINCT FROM s.s_suppkey),
raw AS (SELECT {_sql_list_pick('s_nationkey % 12', _RF19)} AS site, l_linenumber AS block,
               {_sql_list_pick('l_partkey % 8', _BIO_TREATMENTS)} AS treatment, CAST(l_orderkey AS VARCHAR) AS ttc_id,
               CAST(l_linenumber AS VARCHAR) || ':00' AS "Time", CAST(NULL AS VARCHAR) AS notes,
               strftime(CAST('2019-07-' || lpad(CAST(day(l_shipdate) AS VARCHAR), 2, '0') AS DATE), '%-m/%-d/%y') AS dtext,
               l_discount * 5 AS v1, l_tax * 5 AS v2 FROM b),
c AS (SELECT *, CASE site {" ".join(f"WHEN '{k}' THEN '{v}'" for k, v in DD.REFLECTANCE_SITES_2019.items())} ELSE site END AS "siteID" FROM raw),
d AS (SELECT *, CASE "siteID" {" ".join(f"WHEN '{k}' THEN '{v}'" for k, v in DD.REFLECTANCE_CODES.items())} ELSE "siteID" END AS code FROM c)
SELECT "siteID", coalesce(code, 'NA') || coalesce(CAST(block AS VARCHAR), 'NA') AS "blockID",
       coalesce(code, 'NA') || coalesce(CAST(block AS VARCHAR), 'NA') || coalesce(treatment, 'NA') AS "plotID",
       treatment AS "Treatment", ttc_id AS "TTC_ID", 'post_cut' AS pre_post_cut,
       strftime(CAST(try_strptime(dtext, '%m/%d/%y') AS DATE), '%Y-%m-%d') AS date, "Time",
       (v1 + v2) / 2 AS m_ndvi, notes FROM d
""")
def reflectance_2019_chain(spark, sf):
    from . import reflectance as RFP
    b = _rf_base(spark, sf)
    d = F.to_date(F.concat(F.lit("2019-07-"), F.lpad(F.dayofmonth("l_shipdate").cast("string"), 2, "0")))
    raw = b.select(_pick(F.col("s_nationkey") % 12, _RF19).alias("Site"), F.col("l_linenumber").cast("double").alias("Block"),
                   _pick(F.col("l_partkey") % 8, _BIO_TREATMENTS).alias("Treatment"),
                   F.col("l_orderkey").cast("string").alias("TTC_ID"),
                   F.concat(F.col("l_linenumber").cast("string"), F.lit(":00")).alias("Time"),
                   F.lit(None).cast("string").alias("notes"), F.date_format(d, "M/d/yy").alias("Date"),
                   (F.col("l_discount") * 5).alias("Value1"), (F.col("l_tax") * 5).alias("Value2"))
    return RFP.ndvi_2019(raw).withColumn("date", F.date_format("date", "yyyy-MM-dd"))


@register("reflectance_2021_chain", f"""
WITH b AS (SELECT l.*, s.s_nationkey FROM lineitem l LEFT JOIN supplier s ON l.l_suppkey IS NOT DISTINCT FROM s.s_suppkey),
raw AS (SELECT {_sql_list_pick('s_nationkey % 12', _RF21)} AS site, l_linenumber AS block,
               {_sql_list_pick('l_partkey % 8', _BIO_TREATMENTS)} AS plot,
               CAST(l_linenumber AS VARCHAR) || ':00' AS "Time", CAST(NULL AS VARCHAR) AS notes,
               strftime(CAST('2021-07-' || lpad(CAST(day(l_shipdate) AS VARCHAR), 2, '0') AS DATE), '%-d.%-m.%Y') AS dtext,
               l_discount * 5 AS a1, l_tax * 5 AS a2, (l_discount + l_tax) * 4 AS b1 FROM b),
c AS (SELECT *, CASE site {" ".join(f"WHEN '{k}' THEN '{v}'" for k, v in DD.REFLECTANCE_SITES_2021.items())} ELSE site END AS "siteID" FROM raw),
d AS (SELECT *, CASE "siteID" {" ".join(f"WHEN '{k}' THEN '{v}'" for k, v in DD.REFLECTANCE_CODES.items())} ELSE "siteID" END AS code,
             strftime(CAST(try_strptime(dtext, '%d.%m.%Y') AS DATE), '%Y-%m-%d') AS date FROM c),
e AS (SELECT "siteID", coalesce(code, 'NA') || coalesce(CAST(block AS VARCHAR), 'NA') AS "blockID",
             coalesce(code, 'NA') || coalesce(CAST(block AS VARCHAR), 'NA') || coalesce(plot, 'NA') AS "plotID",
             plot AS "Treatment", date, "Time", notes, (b1 + b1) / 2 AS before, (a1 + a2) / 2 AS after FROM d)
SELECT "siteID", "blockID", "plotID", "Treatment", 'pre_cut' AS pre_post_cut, date, "Time", before AS m_ndvi, notes FROM e
UNION ALL
SELECT "siteID", "blockID", "plotID", "Treatment", 'post_cut', date, "Time", after, notes FROM e
""")
def reflectance_2021_chain(spark, sf):
    from . import reflectance as RFP
    b = _rf_base(spark, sf)
    d = F.to_date(F.concat(F.lit("2021-07-"), F.lpad(F.dayofmonth("l_shipdate").cast("string"), 2, "0")))
    raw = b.select(_pick(F.col("s_nationkey") % 12, _RF21).alias("Site"), F.col("l_linenumber").alias("Block"),
                   _pick(F.col("l_partkey") % 8, _BIO_TREATMENTS).alias("Plot"),
                   F.concat(F.col("l_linenumber").cast("string"), F.lit(":00")).alias("Time"),
                   F.lit(None).cast("string").alias("notes"), F.date_format(d, "d.M.yyyy").alias("Date"),
                   (F.col("l_discount") * 5).alias("After.1"), (F.col("l_tax") * 5).alias("After.2"),
                   ((F.col("l_discount") + F.col("l_tax")) * 4).alias("Before.1"),
                   (F.col("l_tax") * 3).alias("Before.2"), (F.dayofmonth("l_shipdate") <= 15).alias("__first"))
    # two weekly files (first and second half of the month), bound back together by the chain
    return RFP.ndvi_2021(raw.filter("__first").drop("__first"), raw.filter(~F.col("__first")).drop("__first"))


def _biomass_totals_sql() -> str:
    chain = _biomass_sql()
    climate = ", ".join(f"('{s}', '{z}', {lv})" for s, z, lv in DD.CLIMATE)
    levels = " ".join(f"WHEN '{x}' THEN {i + 1}" for i, x in enumerate(DD.CLIMATE_LEVELS))
    tlev = ", ".join(f"'{x}'" for x in DD.PLOT_TREATMENT_LEVELS)
    return f"""WITH chain AS ({chain}),
cl AS (SELECT * FROM (VALUES {climate}) t("siteID", zone, lvl)),
j AS (SELECT c.*, zone || CAST(lvl AS VARCHAR) AS lab FROM chain c LEFT JOIN cl ON c."siteID" IS NOT DISTINCT FROM cl."siteID"),
k AS (SELECT year, CASE WHEN (CASE lab {levels} END) IS NOT NULL THEN lab END AS climate,
             CASE WHEN treatment IN ({tlev}) THEN treatment END AS treatment, removed_fg, biomass FROM j)
SELECT year, climate, treatment, removed_fg, round(sum(biomass), 6) AS biomass FROM k GROUP BY 1, 2, 3, 4"""


@register("biomass_plot_totals", _biomass_totals_sql())
def biomass_plot_totals(spark, sf):
    from . import biomass as BM
    t = BM.plot_totals(BM.clean_biomass(_biomass_raw(spark, sf)))
    return t.withColumn("biomass", F.round("biomass", 6))


# Relational plot database from the driver tables: supplier -> turf (31 of 40
# turf indices are transplant controls of the fixed dictionary), ship year +
# 19 -> year (2014-2020), part -> species, line -> subplot, quantities ->
# covers. On a third of the turf-years one species is recorded in subplots
# only (missing cover); recorders and reference totals vary by turf-year so
# that every recorder gate fires somewhere.

_REC = ["Siri", "Owen", "PM", None, "Anna"]


def _turf_sql(t: str) -> str:
    return (f"CASE WHEN {t} < 31 THEN {_sql_list_pick(t, _TTC_NUMS)} || ' TTC' "
            f"ELSE 'X' || CAST({t} AS VARCHAR) || ' TTC' END")


def _turf_col(t):
    return F.when(t < 31, F.concat(_pick(t, _TTC_NUMS), F.lit(" TTC"))).otherwise(
        F.concat(F.lit("X"), t.cast("string"), F.lit(" TTC")))


def _community_db(spark, sf):
    from .community import CommunityInputs  # noqa: F401 - documents the target layout
    li = _t(spark, sf, "lineitem")
    t = F.col("l_suppkey") % 40
    base = li.select(_turf_col(t).alias("turfID"), (_year("l_shipdate") + 19).alias("year"),
                     F.concat(F.lit("Sp."), (F.col("l_partkey") % 40).cast("string")).alias("species"),
                     F.col("l_linenumber").alias("subTurf"), F.col("l_quantity").alias("q"), t.alias("t"),
                     (F.col("l_partkey") % 40).alias("p"))
    sub = base.select("turfID", "year", "species", "subTurf")
    cov = (base.filter(~((F.col("p") == 39) & ((F.col("t") + F.col("year")) % 3 == 0)))
           .groupBy("turfID", "year", "species").agg(F.sum("q").alias("cover")))
    part = _t(spark, sf, "part")
    taxon = (part.select(F.concat(F.lit("Sp."), (F.col("p_partkey") % 40).cast("string")).alias("species"))
             .distinct().withColumn("speciesName", F.upper("species")))
    ts = _t(spark, sf, "supplier").select((F.col("s_suppkey") % 40).alias("t")).distinct()
    turfs = ts.select(_turf_col(F.col("t")).alias("turfID"),
                      F.when(F.col("t") % 3 == 0, F.lit("")).otherwise(F.lit("TTC")).alias("TTtreat"),
                      F.when(F.col("t") % 3 == 0, F.lit("TTC")).alias("GRtreat"),
                      F.concat(F.lit("P"), F.col("t").cast("string")).alias("destinationPlotID"))
    plots = ts.select(F.concat(F.lit("P"), F.col("t").cast("string")).alias("plotID"),
                      F.concat(F.lit("B"), F.col("t").cast("string")).alias("blockID"))
    site = F.when(F.col("t") < 31, _pick(F.col("t"), _TTC_SITES)).otherwise(
        F.concat(F.lit("S"), (F.col("t") % 5).cast("string")))
    blocks = ts.select(F.concat(F.lit("B"), F.col("t").cast("string")).alias("blockID"), site.alias("siteID"))
    sites = blocks.select("siteID").distinct().select(
        "siteID", F.length("siteID").alias("temperature_level"), (F.length("siteID") % 4).alias("precipitation_level"))
    env = base.groupBy("turfID", "year", "t").agg(F.count(F.lit(1)).alias("n"), F.max("q").alias("mq"))
    k = (F.col("t") + F.col("year")) % 5
    env = env.select(
        "turfID", "year", _pick(k, _REC).alias("recorder"),
        (F.col("n") * _pick(F.col("t") % 4, [10.0, 25.0, 60.0, 0.0])).alias("totalVascular"),
        (F.col("mq") * 2).alias("totalBryophytes"), (F.col("n") % 30).cast("double").alias("vegetationHeight"),
        (F.col("n") % 7).cast("double").alias("mossHeight"), F.col("mq").alias("litter"))
    return dict(character_traits=None, sub_turf_community=sub, turf_community=cov, taxon=taxon, turfs=turfs,
                plots=plots, blocks=blocks, sites=sites, turf_environment=env)


def _community_relational_sql() -> str:
    rec = _sql_list_pick("(t + year) % 5", _REC)
    tv = _sql_list_pick("t % 4", [10.0, 25.0, 60.0, 0.0])
    ttc = ", ".join(f"('{a}', '{b}')" for a, b in DD.TTC_TURF)
    sidx = "s_suppkey % 40"
    return f"""WITH base AS (SELECT {_turf_sql('l_suppkey % 40')} AS "turfID", CAST(year(l_shipdate) + 19 AS INTEGER) AS year,
                     'Sp.' || CAST(l_partkey % 40 AS VARCHAR) AS species, l_linenumber AS "subTurf", l_quantity AS q,
                     l_suppkey % 40 AS t, l_partkey % 40 AS p FROM lineitem),
sub AS (SELECT "turfID", year, species, count(*) AS n_subturf FROM base GROUP BY 1, 2, 3),
cov AS (SELECT "turfID", year, species, sum(q) AS cover FROM base
        WHERE NOT (p = 39 AND (t + year) % 3 = 0) GROUP BY 1, 2, 3),
ts AS (SELECT DISTINCT {sidx} AS t FROM supplier),
turfs AS (SELECT {_turf_sql('t')} AS "turfID", CASE WHEN t % 3 = 0 THEN '' ELSE 'TTC' END AS "TTtreat",
                 CASE WHEN t % 3 = 0 THEN 'TTC' END AS "GRtreat", 'P' || CAST(t AS VARCHAR) AS "destinationPlotID" FROM ts),
plots AS (SELECT 'P' || CAST(t AS VARCHAR) AS "plotID", 'B' || CAST(t AS VARCHAR) AS "blockID" FROM ts),
blocks AS (SELECT 'B' || CAST(t AS VARCHAR) AS "blockID",
                  CASE WHEN t < 31 THEN {_sql_list_pick('t', _TTC_SITES)} ELSE 'S' || CAST(t % 5 AS VARCHAR) END AS "siteID"
           FROM ts),
env AS (SELECT "turfID", year, {rec} AS recorder, count(*) * {tv} AS "totalVascular",
               max(q) * 2 AS "totalBryophytes", CAST(count(*) % 30 AS DOUBLE) AS "vegetationHeight",
               CAST(count(*) % 7 AS DOUBLE) AS "mossHeight", max(q) AS litter FROM base GROUP BY "turfID", year, t),
d0 AS (SELECT coalesce(sub."turfID", cov."turfID") AS "turfID", coalesce(sub.year, cov.year) AS year,
              coalesce(sub.species, cov.species) AS species, cov.cover
       FROM sub FULL JOIN cov ON sub."turfID" IS NOT DISTINCT FROM cov."turfID" AND sub.year IS NOT DISTINCT FROM cov.year
                             AND sub.species IS NOT DISTINCT FROM cov.species),
d1 AS (SELECT b."siteID", p."blockID", tu."destinationPlotID" AS "plotID", d0."turfID", tu."TTtreat", tu."GRtreat",
              d0.year AS "Year", d0.species, d0.cover, e.recorder, e."totalVascular", e."totalBryophytes",
              e."vegetationHeight", e."mossHeight"
       FROM d0 LEFT JOIN turfs tu ON d0."turfID" IS NOT DISTINCT FROM tu."turfID"
       LEFT JOIN plots p ON tu."destinationPlotID" IS NOT DISTINCT FROM p."plotID"
       LEFT JOIN blocks b ON p."blockID" IS NOT DISTINCT FROM b."blockID"
       LEFT JOIN env e ON d0."turfID" IS NOT DISTINCT FROM e."turfID" AND d0.year IS NOT DISTINCT FROM e.year
       WHERE d0.year > 2014 AND (tu."TTtreat" = 'TTC' OR tu."GRtreat" = 'TTC')),
d2 AS (SELECT * REPLACE (
         CASE WHEN "Year" IN (2015, 2017) THEN "vegetationHeight" * 10 ELSE "vegetationHeight" END AS "vegetationHeight",
         CASE WHEN "Year" = 2017 AND "turfID" = '301 TTC' THEN CAST(7.5 AS DOUBLE)
              WHEN "Year" IN (2015, 2017) THEN "mossHeight" * 10 ELSE "mossHeight" END AS "mossHeight",
         CASE WHEN "TTtreat" IS NULL OR "TTtreat" = '' THEN "GRtreat" ELSE "TTtreat" END AS "TTtreat",
         coalesce(recorder, 'unknown botanist') AS recorder) FROM d1),
d3 AS (SELECT * REPLACE (CASE WHEN coalesce(recorder = 'PM', false) THEN cover * CAST(1.2 AS DOUBLE) ELSE cover END AS cover)
       FROM d2),
g AS (SELECT "turfID", "Year",
         coalesce(count(CASE WHEN recorder = 'Siri' THEN cover END) = count(CASE WHEN recorder = 'Siri' THEN 1 END)
                  AND sum(CASE WHEN recorder = 'Siri' THEN cover END)
                      < CAST(1.35 AS DOUBLE) * max(CASE WHEN recorder = 'Siri' THEN "totalVascular" END), false) AS g1,
         count(CASE WHEN recorder = 'Owen' THEN cover END) = count(CASE WHEN recorder = 'Owen' THEN 1 END) AS owen_strict,
         sum(CASE WHEN recorder = 'Owen' THEN cover END) AS s2_0,
         sum(CASE WHEN recorder = 'Owen' THEN cover * CAST(1.3 AS DOUBLE) END) AS s2_1,
         min(CASE WHEN recorder = 'Owen' THEN "totalVascular" END) AS t2
       FROM d3 GROUP BY 1, 2),
g2 AS (SELECT "turfID", "Year", g1,
         coalesce(owen_strict AND (CASE WHEN g1 THEN s2_1 ELSE s2_0 END) > CAST(1.5 AS DOUBLE) * t2, false) AS g2 FROM g),
d4 AS (SELECT d3.* REPLACE (
         CASE WHEN coalesce(g2.g2, false)
              THEN (CASE WHEN coalesce(g2.g1, false) THEN d3.cover * CAST(1.3 AS DOUBLE) ELSE d3.cover END) / CAST(1.5 AS DOUBLE)
              ELSE (CASE WHEN coalesce(g2.g1, false) THEN d3.cover * CAST(1.3 AS DOUBLE) ELSE d3.cover END) END AS cover)
       FROM d3 LEFT JOIN g2 ON d3."turfID" IS NOT DISTINCT FROM g2."turfID" AND d3."Year" IS NOT DISTINCT FROM g2."Year"),
dict AS (SELECT * FROM (VALUES {ttc}) t("TTtreat", "turfID")),
d5 AS (SELECT d4."siteID", d4."Year", d4.species, d4.cover, d4.recorder, d4."totalBryophytes", d4."vegetationHeight",
              d4."mossHeight", 'C' AS "Treatment", d4."turfID" AS "TTtreat", dict."turfID" AS "turfID"
       FROM d4 LEFT JOIN dict ON d4."turfID" IS NOT DISTINCT FROM dict."TTtreat"
       WHERE d4."turfID" IN (SELECT "TTtreat" FROM dict)),
d6 AS (SELECT *, substr("turfID", 4, 1) AS "blockID" FROM d5
       WHERE cover IS NOT NULL AND NOT ("TTtreat" = '37 TTC' AND "Year" > 2015))
SELECT "siteID", "blockID", "TTtreat", "Year", species, cover, recorder, "totalBryophytes", "vegetationHeight",
       "mossHeight", "Treatment", "turfID" FROM d6
UNION ALL
SELECT "siteID", "blockID", "TTtreat", 2017, species, cover, recorder, "totalBryophytes", "vegetationHeight",
       "mossHeight", "Treatment", "turfID" FROM d6 WHERE "TTtreat" IN ('297 TTC', '246 TTC') AND "Year" = 2016"""


@register("community_relational_chain", _community_relational_sql())
def community_relational_chain(spark, sf):
    from . import community as CM
    db = _community_db(spark, sf)
    inp = CM.CommunityInputs(**db, sheets=[], sheet_2018=None, bryophytes_2017=None, species_corrections=None,
                             merge_dictionary=None)
    return CM.relational_covers(inp)


# Composition sheets from lineitem: order -> turf (site, block, treatment; one
# turf per order, so the sheets grow with the data),
# ship year + 20 -> year, line number -> subplot code ('%' cover rows, 'T'
# presence rows, a numbered subplot otherwise), part -> species column, summed
# quantities -> cover text. Three sheets (years 2015-16, 2017-18, 2019-21) with
# different column sets are bound by name, as the yearly files are.

_CSITES = ["Ulvhaugen", "Lavisdalen", "Gudmedalen", "Skjellingahaugen", "Alrust", "Hogsete", "Rambera", "Veskre",
           "Fauske", "Vikesland", "Arhelleren", "Ovstedal"]
_SPECIES_COLS = ["Sp 0", "Agr cap", "Hol lan", "Jun sp", "Sp 1", "Sp 2", "Sp 3", "Sp 4", "Sp 5", "Sp 5x", "Sp 6", "Sp 7",
                 "Sp 8", "Sp 9"]
_NAMED = {10: "Agr cap", 11: "Hol lan", 12: "Jun sp"}
# Orders below this number share turf names (so dictionaries, corrections and
# fixes find their turfs); later turfs carry a running suffix, so turfs grow
# with the data. Every 31st of them is a transplant control, in dictionary order.
_SHARED_TURFS = 6000
_CREC = ["A", "B", "Siri", None]
_CORRECTIONS = [  # fixed species corrections: old, new, siteID, turfID, Year, cover, functionalGroup
    ("Sp.3", "Sp.3b", "Alrust", "Alr2F", 2016, "5", None),
    ("Sp.2", "Sp.2b", "Fauske", "Fau1C", 2017, None, None),
    ("Sp.1", "Sp.1b", "Veskre", "Ves3GB", 2018, "WHAT HAPPENED", None),
    ("Sp.4", "Sp.4x", None, None, None, "", None),
    ("Sp.6", "Sp.6x", None, None, None, "", None),
    ("Vio.can", "Vio.x", None, None, None, "", None),
]
_MERGE = [("Sp.4x", "Sp.44"), ("Sp.7", "Sp.77")]  # fixed merge dictionary: old, new


def _community_sheets(spark, sf):
    li = _t(spark, sf, "lineitem")
    sub = (F.when(F.col("l_linenumber") <= 4, F.lit("%")).when(F.col("l_linenumber") <= 6, F.lit("T"))
           .otherwise(F.lit("3")))
    cells = li.select(F.col("l_orderkey").alias("g"), (_year("l_shipdate") + 20).alias("yr"), sub.alias("subPlot"),
                      F.coalesce(_pick(F.col("l_partkey") % 13 - 10, list(_NAMED.values())),
                                 F.concat(F.lit("Sp "), (F.col("l_partkey") % 13).cast("string"))).alias("sp"),
                      F.col("l_quantity").alias("q"))
    # one sheet row per (turf, year, subplot): aggregate on those three keys,
    # then derive the row's descriptive columns from them
    wide = cells.groupBy("g", "yr", "subPlot").agg(*[F.sum(F.when(F.col("sp") == c, F.col("q"))).alias(c) for c in _SPECIES_COLS])
    g, yr = F.col("g"), F.col("yr")
    site = _pick(g % 12, _CSITES)
    shared, control, xc = g < _SHARED_TURFS, g % 31 == 0, g % 23 == 3
    number = F.concat(_pick(F.floor(g / 31) % 31, _TTC_NUMS), F.lit(" TTC"))
    site = (F.when(shared & control, _pick(F.floor(g / 31) % 31, _TTC_SITES))
            .when(shared & xc, F.lit("Alrust")).otherwise(site))
    block = (F.when(shared & xc, F.lit("2")).when((site == "Gudmedalen") & (g % 7 == 0), F.lit("16"))
             .otherwise((g % 5 + 1).cast("string")))
    trt = F.when(shared & control, F.lit("C")).when(shared & xc, F.lit("XC")).otherwise(_pick(g % 9, _BIO_TREATMENTS + ["XC"]))
    turf = (F.when(shared & control, number)
            .otherwise(F.concat(F.substring(site, 1, 3), block, trt,
                                F.when(shared, F.lit("")).otherwise(F.concat(F.lit("."), F.floor(g / 180).cast("string"))))))
    k = g * 7 + yr

    def num(expr, null_when):
        return F.when(~null_when, expr.cast("string"))

    wide = wide.select(
        "yr", site.alias("siteID"), block.alias("blockID"), trt.alias("Treatment"), turf.alias("turfID"),
        F.when(shared & control, number).when(g % 11 == 0, F.lit("TT2")).alias("TTtreat"), "subPlot", yr.cast("string").alias("year"),
        _pick((g + yr) % 4, _CREC).alias("recorder"),
        num(k % 60, (g + yr) % 5 == 0).alias("totalGraminoids"), num(k % 70, (g + yr) % 6 == 0).alias("totalForbs"),
        num(k % 40, (g + yr) % 7 == 0).alias("totalBryophytes"), num(k % 30, g % 13 == 0).alias("vegetationHeight"),
        num(k % 9, g % 17 == 0).alias("mossHeight"), num(k % 11, g % 19 == 0).alias("litter"),
        num(k % 5, (g + yr) % 3 == 0).alias("acro"), num(k % 4, (g + yr) % 4 == 1).alias("pleuro"),
        # texts made in a loop over the row: fused with the aggregation, one expression per column is a method too large to be compiled
        F.transform(F.array(*[F.col(f"`{c}`") for c in _SPECIES_COLS]), lambda x: x.cast("bigint").cast("string")).alias("cells"))
    wide = wide.select(*[c for c in wide.columns if c != "cells"], *[F.get("cells", F.lit(i)).alias(c) for i, c in enumerate(_SPECIES_COLS)])
    y = F.col("yr")
    s1 = wide.filter(y <= 2016).drop("yr")
    s2 = wide.filter((y >= 2017) & (y <= 2018)).drop("yr", "acro", "pleuro")
    s3 = wide.filter(y >= 2019).drop("yr", "TTtreat")
    return [s2, s1, s3]


@register("community_composition_chain")
def community_composition_chain(spark, sf):
    from . import community as CM
    corr = inline_table(spark, _CORRECTIONS, "old string, new string, siteID string, turfID string, Year int, "
                                             "cover string, functionalGroup string")
    merge = inline_table(spark, _MERGE, "old string, new string")
    layout = CM.SheetLayout(species_first="Sp 0", species_last_kept="Sp 9", species_last_long="Sp 8")
    inp = CM.CommunityInputs(character_traits=None, sub_turf_community=None, turf_community=None, taxon=None,
                             turfs=None, plots=None, blocks=None, sites=None, turf_environment=None,
                             sheets=_community_sheets(spark, sf), sheet_2018=None, bryophytes_2017=None,
                             species_corrections=corr, merge_dictionary=merge, layout=layout)
    return CM.composition_long(inp, staging_dir(spark))


def _community_composition_sql() -> str:
    site = _sql_list_pick("g % 12", _CSITES)
    trt = _sql_list_pick("g % 9", _BIO_TREATMENTS + ["XC"])
    rec = _sql_list_pick("(g + yr) % 4", _CREC)
    ttc = ", ".join(f"('{a}', '{b}')" for a, b in DD.TTC_TURF)

    def q(v):
        return "NULL" if v is None else ("'" + v.replace("'", "''") + "'" if isinstance(v, str) else str(v))
    corr = ", ".join("(" + ", ".join(q(v) for v in r) + ")" for r in _CORRECTIONS)
    merge = ", ".join(f"('{a}', '{b}')" for a, b in _MERGE)
    levels = ", ".join(f"('{s}')" for s in _SPECIES_COLS if s not in ("Sp 5x", "Sp 9"))
    tot = ["totalGraminoids", "totalForbs", "totalBryophytes", "vegetationHeight", "mossHeight", "litter", "acro",
           "pleuro"]
    tot_cast = ", ".join(f'TRY_CAST("{c}" AS DOUBLE) AS "{c}"' for c in tot)
    tot_cols = ", ".join(f'"{c}"' for c in tot)
    return f"""WITH l0 AS (SELECT l_orderkey AS g, CAST(year(l_shipdate) + 20 AS BIGINT) AS yr, l_linenumber, l_partkey,
                   l_quantity FROM lineitem),
l1 AS (SELECT *, g < {_SHARED_TURFS} AS shared, g % 31 = 0 AS control, g % 23 = 3 AS xc, {_sql_list_pick('g // 31 % 31', _TTC_NUMS)} || ' TTC' AS number,
              CASE WHEN g < {_SHARED_TURFS} AND g % 31 = 0 THEN {_sql_list_pick('g // 31 % 31', _TTC_SITES)}
                   WHEN g < {_SHARED_TURFS} AND g % 23 = 3 THEN 'Alrust' ELSE {site} END AS site FROM l0),
l2 AS (SELECT *, CASE WHEN shared AND xc THEN '2' WHEN site = 'Gudmedalen' AND g % 7 = 0 THEN '16' ELSE CAST(g % 5 + 1 AS VARCHAR) END AS block,
              CASE WHEN shared AND control THEN 'C' WHEN shared AND xc THEN 'XC' ELSE {trt} END AS trt, g * 7 + yr AS k FROM l1),
base AS (SELECT g, yr, site AS "siteID", block AS "blockID", trt AS "Treatment",
           CASE WHEN shared AND control THEN number
                ELSE substr(site, 1, 3) || block || trt || CASE WHEN shared THEN '' ELSE '.' || CAST(g // 180 AS VARCHAR) END END AS "turfID",
           CASE WHEN yr >= 2019 THEN NULL WHEN shared AND control THEN number WHEN g % 11 = 0 THEN 'TT2' END AS "TTtreat",
           CASE WHEN l_linenumber <= 4 THEN '%' WHEN l_linenumber <= 6 THEN 'T' ELSE '3' END AS "subPlot",
           CAST(yr AS VARCHAR) AS "Year", {rec} AS recorder,
           CASE WHEN NOT ((g + yr) % 5 = 0) THEN CAST(k % 60 AS VARCHAR) END AS "totalGraminoids",
           CASE WHEN NOT ((g + yr) % 6 = 0) THEN CAST(k % 70 AS VARCHAR) END AS "totalForbs",
           CASE WHEN NOT ((g + yr) % 7 = 0) THEN CAST(k % 40 AS VARCHAR) END AS "totalBryophytes",
           CASE WHEN NOT (g % 13 = 0) THEN CAST(k % 30 AS VARCHAR) END AS "vegetationHeight",
           CASE WHEN NOT (g % 17 = 0) THEN CAST(k % 9 AS VARCHAR) END AS "mossHeight",
           CASE WHEN NOT (g % 19 = 0) THEN CAST(k % 11 AS VARCHAR) END AS litter,
           CASE WHEN NOT ((g + yr) % 3 = 0) AND NOT (yr BETWEEN 2017 AND 2018) THEN CAST(k % 5 AS VARCHAR) END AS acro,
           CASE WHEN NOT ((g + yr) % 4 = 1) AND NOT (yr BETWEEN 2017 AND 2018) THEN CAST(k % 4 AS VARCHAR) END AS pleuro,
           CASE l_partkey % 13 WHEN 10 THEN 'Agr cap' WHEN 11 THEN 'Hol lan' WHEN 12 THEN 'Jun sp' ELSE 'Sp ' || CAST(l_partkey % 13 AS VARCHAR) END AS sp,
           l_quantity AS q FROM l2),
cells AS (SELECT g, yr, "subPlot", sp, CAST(CAST(sum(q) AS BIGINT) AS VARCHAR) AS v FROM base GROUP BY 1, 2, 3, 4),
sheet AS (SELECT DISTINCT g, yr, "siteID", "blockID", "Treatment", "turfID", "TTtreat", "subPlot", "Year", recorder,
                 {tot_cols} FROM base WHERE "subPlot" IN ('%', 'T')),
lv AS (SELECT * FROM (VALUES {levels}) t(species)),
long AS (SELECT s.*, lv.species, c.v AS cover, c9.v AS "Sp 9"
         FROM sheet s CROSS JOIN lv
         LEFT JOIN cells c ON s.g = c.g AND s.yr = c.yr AND s."subPlot" = c."subPlot" AND lv.species = c.sp
         LEFT JOIN cells c9 ON s.g = c9.g AND s.yr = c9.yr AND s."subPlot" = c9."subPlot" AND c9.sp = 'Sp 9'),
pres AS (SELECT "siteID", "Treatment", "turfID", "Year", species, CAST(1.0 AS DOUBLE) AS presence
         FROM long WHERE "subPlot" = 'T' AND cover IS NOT NULL),
comp AS (SELECT l."siteID", l."blockID", l."Treatment", l."turfID", l."TTtreat", l."Year", l.recorder, {", ".join(f'l."{c}"' for c in tot)},
                l."Sp 9", l.species, l.cover, p.presence
         FROM long l LEFT JOIN pres p ON l."siteID" IS NOT DISTINCT FROM p."siteID"
              AND l."Treatment" IS NOT DISTINCT FROM p."Treatment" AND l."turfID" IS NOT DISTINCT FROM p."turfID"
              AND l."Year" IS NOT DISTINCT FROM p."Year" AND l.species IS NOT DISTINCT FROM p.species
         WHERE l."subPlot" = '%'),
num AS (SELECT "siteID", "blockID", "Treatment", "turfID", "TTtreat", CAST(TRY_CAST("Year" AS DOUBLE) AS INTEGER) AS "Year",
               recorder, {tot_cast}, "Sp 9", regexp_replace(species, '[ _]', '.', 'g') AS species,
               TRY_CAST(cover AS DOUBLE) AS cover, presence FROM comp),
corr AS (SELECT * FROM (VALUES {corr}) t(old, new, "siteID", "turfID", "Year", cover, "functionalGroup")),
p AS (SELECT old, new, "siteID", "turfID", "Year", TRY_CAST(cover AS DOUBLE) AS cover FROM corr
      WHERE NOT coalesce(old IN ('Vio.can', 'Com.ten', 'Sel.sel'), false) AND cover <> 'WHAT HAPPENED'),
keyed AS (SELECT * FROM p WHERE "Year" IS NOT NULL),
names AS (SELECT old, new FROM p WHERE "Year" IS NULL AND NOT coalesce(old IN ('Eri.bor'), false)
          UNION ALL SELECT * FROM (VALUES {merge}) t(old, new)),
k1 AS (SELECT n.* REPLACE (coalesce(k.new, n.species) AS species, coalesce(k.cover, n.cover) AS cover)
       FROM num n LEFT JOIN keyed k ON n."Year" IS NOT DISTINCT FROM k."Year" AND n."turfID" IS NOT DISTINCT FROM k."turfID"
            AND n."siteID" IS NOT DISTINCT FROM k."siteID" AND n.species IS NOT DISTINCT FROM k.old),
k2 AS (SELECT k1.* REPLACE (CASE WHEN nm.new IS NOT NULL THEN nm.new ELSE k1.species END AS species)
       FROM k1 LEFT JOIN names nm ON k1.species IS NOT DISTINCT FROM nm.old),
dict AS (SELECT * FROM (VALUES {ttc}) t("TTtreat", "turfID")),
i0 AS (SELECT k2.*, d."turfID" AS "turfID.new" FROM k2 LEFT JOIN dict d ON k2."turfID" IS NOT DISTINCT FROM d."TTtreat"),
i1 AS (SELECT * REPLACE (CASE WHEN "turfID.new" IS NOT NULL THEN "turfID.new" ELSE "turfID" END AS "turfID") FROM i0),
i2 AS (SELECT * REPLACE (CASE WHEN ("blockID" = '16' AND "siteID" = 'Gudmedalen') IS NULL THEN NULL
                              WHEN "blockID" = '16' AND "siteID" = 'Gudmedalen' THEN replace("turfID", '16', '5')
                              ELSE "turfID" END AS "turfID") FROM i1),
i3 AS (SELECT * REPLACE (CASE WHEN ("siteID" = 'Alrust' AND "blockID" = '3' AND "Year" = 2015 AND "Treatment" = 'C') IS NULL THEN NULL
                              WHEN "siteID" = 'Alrust' AND "blockID" = '3' AND "Year" = 2015 AND "Treatment" = 'C' THEN 'Alr3C'
                              ELSE "turfID" END AS "turfID") FROM i2),
i4 AS (SELECT * REPLACE (CASE "turfID" WHEN 'Alr4FGB' THEN 'Alr5C' WHEN 'Lav1G ' THEN 'Lav1G' ELSE "turfID" END AS "turfID") FROM i3),
i5 AS (SELECT * REPLACE (CASE WHEN ("blockID" = '16' AND "siteID" = 'Gudmedalen') IS NULL THEN NULL
                              WHEN "blockID" = '16' AND "siteID" = 'Gudmedalen' THEN replace("blockID", '16', '5')
                              ELSE "blockID" END AS "blockID") FROM i4),
i6 AS (SELECT * REPLACE (CASE WHEN ("turfID" = 'Gud12C') IS NULL THEN NULL WHEN "turfID" = 'Gud12C' THEN '12'
                              ELSE "blockID" END AS "blockID") FROM i5)
SELECT * FROM i6
WHERE NOT ("blockID" = '4' AND "Year" = 2015 AND "siteID" = 'Alrust') AND NOT ("turfID" = 'Gud12C' AND "Year" = 2015)
  AND NOT ("turfID" = 'Alr3C' AND recorder = 'Siri') AND "turfID" IS NOT NULL"""


ORACLE["community_composition_chain"] = _community_composition_sql().strip()


_GROUPS = ["forb", "graminoid", "pteridophyte", "woody"]
_NAMED_GROUPS = [("Agr.cap", "graminoid"), ("Hol.lan", "graminoid"), ("Jun.sp", "woody")]


def _community_inputs(spark, sf):
    from . import community as CM
    db = _community_db(spark, sf)
    part = _t(spark, sf, "part")
    n = F.col("p_partkey") % 40
    traits = (part.select(F.concat(F.lit("Sp."), n.cast("string")).alias("species"), _pick(n % 4, _GROUPS).alias("value"))
              .distinct().unionByName(inline_table(spark, _NAMED_GROUPS, "species string, value string"))
              .withColumn("trait", F.lit("functionalGroup")).select("species", "trait", "value"))
    t = F.col("s_suppkey") % 31
    bryo = (_t(spark, sf, "supplier")
            .groupBy(_pick(t, [f for _, f in DD.TTC_TURF]).alias("turfID"), _pick(t, [n for n, _ in DD.TTC_TURF]).alias("TTtreat"))
            .agg(F.round(F.max("s_acctbal") / 100).alias("totalBryophytes"),
                 F.count(F.lit(1)).cast("double").alias("mossHeight"),
                 F.round(F.min("s_acctbal") / 100).alias("vegetationHeight")))
    corr = inline_table(spark, _CORRECTIONS, "old string, new string, siteID string, turfID string, Year int, "
                                             "cover string, functionalGroup string")
    merge = inline_table(spark, _MERGE, "old string, new string")
    layout = CM.SheetLayout(species_first="Sp 0", species_last_kept="Sp 9", species_last_long="Sp 8")
    db["character_traits"] = traits
    return CM.CommunityInputs(**db, sheets=_community_sheets(spark, sf), sheet_2018=None, bryophytes_2017=bryo,
                              species_corrections=corr, merge_dictionary=merge, layout=layout)


def _community_chain_sql() -> str:
    """The chain after its two input stages, written out from the rules of the field scripts."""
    ttc = ", ".join(f"('{a}', '{b}')" for a, b in DD.TTC_TURF)
    nums = _sql_list_pick("s_suppkey % 31", [n for n, _ in DD.TTC_TURF])
    turfs = _sql_list_pick("s_suppkey % 31", [f for _, f in DD.TTC_TURF])
    five = ["mossHeight", "vegetationHeight", "totalBryophytes", "totalGraminoids", "totalForbs"]
    same = lambda a, b, cols: " AND ".join(f'{a}."{c}" IS NOT DISTINCT FROM {b}."{c}"' for c in cols)
    patch = lambda t, cols: ", ".join(f'coalesce({t}."{c}", x."{c}") AS "{c}"' for c in cols)
    k6 = ["siteID", "blockID", "turfID", "Treatment", "Year", "species"]
    k = ["siteID", "blockID", "Treatment", "turfID", "Year", "TTtreat"]
    fcols = ["siteID", "blockID", "Treatment", "turfID", "Year", "recorder", "totalGraminoids", "totalForbs", "totalBryophytes",
             "vegetationHeight", "mossHeight", "litter", "acro", "pleuro", "Sp 9"]
    fsel = ", ".join(f'"{c}"' for c in fcols)
    return f"""WITH comp AS ({_community_composition_sql()}),
gr AS ({_community_relational_sql()}),
traits AS (SELECT DISTINCT 'Sp.' || CAST(p_partkey % 40 AS VARCHAR) AS species,
                  CASE p_partkey % 40 % 4 WHEN 0 THEN 'forb' WHEN 1 THEN 'graminoid' WHEN 2 THEN 'pteridophyte' ELSE 'woody' END AS fg FROM part
           UNION ALL SELECT * FROM (VALUES ('Agr.cap', 'graminoid'), ('Hol.lan', 'graminoid'), ('Jun.sp', 'woody')) t(species, fg)),
bryo AS (SELECT {turfs} AS "turfID", {nums} AS "TTtreat", round(max(s_acctbal) / 100) AS "totalBryophytes",
                CAST(count(*) AS DOUBLE) AS "mossHeight", round(min(s_acctbal) / 100) AS "vegetationHeight" FROM supplier GROUP BY s_suppkey % 31),
ttc AS (SELECT * FROM (VALUES {ttc}) t("TTtreat", "turfID")),
fgbs AS (SELECT {fsel} FROM (SELECT DISTINCT {fsel}, "TTtreat", presence FROM comp WHERE "Treatment" IN ('FGB', 'GF') AND "Year" > 2015)),
t1516 AS (SELECT DISTINCT c."siteID", c."blockID", c."Treatment", t."turfID", t."TTtreat", c."Year", c."totalGraminoids", c."totalForbs",
                 c."totalBryophytes", c."vegetationHeight", c."mossHeight", c."Sp 9"
          FROM (SELECT * FROM comp WHERE "Treatment" = 'C' AND "Year" NOT IN (2017, 2018)) c
          RIGHT JOIN ttc t ON c."TTtreat" IS NOT DISTINCT FROM t."TTtreat" AND c."turfID" IS NOT DISTINCT FROM t."turfID"),
t17a AS (SELECT DISTINCT c."siteID", c."blockID", c."Treatment", t."turfID", c."Year", c.recorder, c."totalGraminoids", c."totalForbs", c.acro, c.pleuro,
                t."TTtreat", c."totalBryophytes", c."vegetationHeight", c."mossHeight", c.litter, c."Sp 9"
         FROM (SELECT * FROM comp WHERE "Treatment" = 'C' AND "Year" = 2017) c
         RIGHT JOIN ttc t ON c."TTtreat" IS NOT DISTINCT FROM t."TTtreat" AND c."turfID" IS NOT DISTINCT FROM t."turfID"),
t17 AS (SELECT a."siteID", a."blockID", a."Treatment", coalesce(a."turfID", b."turfID") AS "turfID", a."Year", a.recorder, a."totalGraminoids",
               a."totalForbs", a.acro, a.pleuro, b."TTtreat", b."totalBryophytes", b."vegetationHeight", b."mossHeight"
        FROM t17a a FULL JOIN bryo b ON a."turfID" IS NOT DISTINCT FROM b."turfID"),
m0 AS (SELECT * REPLACE (CASE WHEN length("blockID") IS NULL THEN NULL WHEN length("blockID") > 1 THEN regexp_replace("blockID", '[^0-9]', '', 'g')
                              ELSE "blockID" END AS "blockID") FROM comp),
m1 AS (SELECT {", ".join(f'coalesce(c."{c}", g."{c}") AS "{c}"' for c in k6)},
              {", ".join(f'coalesce(g."{c}", c."{c}") AS "{c}"' for c in ["cover", "recorder", "totalBryophytes", "vegetationHeight", "mossHeight"])},
              c."TTtreat", c."totalGraminoids", c."totalForbs", c.litter, c.acro, c.pleuro, c."Sp 9", c.presence
       FROM m0 c FULL JOIN gr g ON {same("c", "g", k6)}),
yrs AS (SELECT "turfID", "Year", row_number() OVER (PARTITION BY "turfID" ORDER BY "Year" NULLS LAST) AS s
        FROM (SELECT DISTINCT "turfID", "Year" FROM m1)),
miss AS (SELECT m1.*, yrs.s FROM m1 JOIN yrs ON {same("m1", "yrs", ["turfID", "Year"])} WHERE m1.cover IS NULL AND m1.presence IS NOT NULL),
near AS (SELECT "turfID", species, s, count(*) AS n, {_sql_exact('cover')} AS total FROM (
           SELECT m1."turfID", m1.species, m1.cover, yrs.s FROM m1 JOIN yrs ON {same("m1", "yrs", ["turfID", "Year"])} WHERE m1.cover IS NOT NULL) z GROUP BY 1, 2, 3),
-- one row for each missing row and each known row one occasion before or after; exactly two make a mean
mkeys AS (SELECT {", ".join(f'"{c}"' for c in k6)}, s, count(*) AS copies FROM miss GROUP BY ALL),
adj AS (SELECT {", ".join(f'k."{c}"' for c in k6)}, sum(n.total) / CAST(sum(n.n) AS DOUBLE) AS cover
        FROM mkeys k JOIN near n ON {same("k", "n", ["turfID", "species"])} AND n.s IN (k.s - 1, k.s + 1)
        GROUP BY {", ".join(f'k."{c}"' for c in k6)} HAVING max(k.copies) * sum(n.n) = 2),
smean AS (SELECT "siteID", species, "Year", {_sql_exact('cover')} / nullif(CAST(count(cover) AS DOUBLE), 0) AS cover FROM m1 GROUP BY ALL),
mmean AS (SELECT DISTINCT {", ".join(f'k."{c}"' for c in k6)}, s.cover
          FROM m1 k LEFT JOIN smean s ON {same("k", "s", ["siteID", "species", "Year"])}
          WHERE k."Treatment" <> 'XC' AND k.cover IS NULL AND k.presence IS NOT NULL),
m2 AS (SELECT x.* EXCLUDE (presence) REPLACE (coalesce(mmean.cover, adj.cover, x.cover) AS cover)
       FROM m1 x LEFT JOIN adj ON {same("x", "adj", k6)} LEFT JOIN mmean ON {same("x", "mmean", k6)}
       WHERE coalesce(mmean.cover, adj.cover, x.cover) IS NOT NULL),
r1 AS (SELECT x.* REPLACE ({patch("t", five)}) FROM m2 x LEFT JOIN t1516 t ON {same("x", "t", k)}),
r2 AS (SELECT x.* EXCLUDE ("TTtreat") REPLACE ({patch("t", five)}) FROM r1 x LEFT JOIN t17 t ON {same("x", "t", k + ["recorder", "acro", "pleuro"])}),
r3 AS (SELECT {", ".join(f'coalesce(x."{c}", f."{c}") AS "{c}"' for c in fcols)}, x.species, x.cover
       FROM r2 x FULL JOIN fgbs f ON {same("x", "f", fcols)}),
z1 AS (SELECT * REPLACE (CASE WHEN pleuro IS NOT NULL AND acro IS NULL THEN 0.0 ELSE acro END AS acro) FROM r3),
z2 AS (SELECT * REPLACE (CASE WHEN acro IS NOT NULL AND pleuro IS NULL THEN 0.0 ELSE pleuro END AS pleuro) FROM z1),
z3 AS (SELECT * REPLACE (CASE WHEN "totalBryophytes" IS NULL THEN pleuro + acro ELSE "totalBryophytes" END AS "totalBryophytes",
         coalesce(substr("siteID", 1, 3), 'NA') || coalesce(CASE WHEN coalesce(contains("turfID", 'TTC'), false) THEN "turfID" ELSE substr("turfID", 4) END, 'NA') AS "turfID",
         replace("Treatment", ' ', '') AS "Treatment", replace(species, ' ', '.') AS species) FROM z2),
z4 AS (SELECT * REPLACE (CASE WHEN "turfID" = 'Gud12C' THEN '12' ELSE "blockID" END AS "blockID") FROM z3),
f1 AS (SELECT * REPLACE (CASE WHEN "turfID" = 'Alr2XC' AND "Year" = 2016 AND species = 'Agr.cap'
         THEN (SELECT CASE WHEN count(cover) = count(*) THEN {_sql_exact('cover')} END FROM z4 WHERE "turfID" = 'Alr2XC' AND "Year" = 2016 AND species = 'Agr.cap')
         ELSE cover END AS cover) FROM z4),
f2 AS (SELECT f1.*, CASE WHEN f1.species IN ('Jun.sp', 'Phl.sp', 'Luz.tri') THEN 'graminoid'
         WHEN f1.species IN ('Ped.pal', 'Pop.tre', 'Ste.als', 'Ste.sp', 'Porub', 'Arenaria', 'Pilosella') THEN 'forb'
         WHEN t.fg IN ('pteridophyte', 'woody') THEN 'forb' ELSE t.fg END AS "functionalGroup"
       FROM f1 LEFT JOIN traits t ON f1.species IS NOT DISTINCT FROM t.species),
f3 AS (SELECT *, CASE WHEN count(cover) OVER w = count(*) OVER w THEN {_sql_exact('cover', ' OVER w')} END AS sumcover FROM f2
       WINDOW w AS (PARTITION BY "turfID", "Year", "functionalGroup")),
f4 AS (SELECT * REPLACE (
         CASE "turfID" || ' ' || "Year" WHEN 'Alr3G 2017' THEN 8.6 WHEN 'Alr5F 2017' THEN 17.5 WHEN 'Alr5G 2017' THEN 17.5 WHEN 'Fau2F 2017' THEN 4.0
           WHEN 'Alr1C 2017' THEN 15.0 WHEN 'Ulv2C 2017' THEN 0.0 WHEN 'Ovs1C 2017' THEN 21.0 ELSE "mossHeight" END AS "mossHeight",
         CASE "turfID" || ' ' || "Year" WHEN 'Ulv3B 2017' THEN 44.5 WHEN 'Arh2FB 2017' THEN 127.5 WHEN 'Ovs1C 2017' THEN 76.85 ELSE "vegetationHeight" END AS "vegetationHeight",
         CASE "turfID" || ' ' || "Year" WHEN 'Alr1F 2015' THEN 0.0 WHEN 'Alr1FGB 2015' THEN 0.0 WHEN 'Ovs1C 2015' THEN 100.0 WHEN 'Fau2C 2015' THEN 40.0
           ELSE "totalBryophytes" END AS "totalBryophytes",
         CASE "turfID" || ' ' || "Year" WHEN 'Fau2C 2015' THEN 65.0 WHEN 'Gud12C 2015' THEN 70.0 WHEN 'Vik2C 2015' THEN 60.0 ELSE "totalForbs" END AS "totalForbs",
         CASE "turfID" || ' ' || "Year" WHEN 'Gud12C 2015' THEN 22.0 WHEN 'Vik2C 2015' THEN 30.0 ELSE "totalGraminoids" END AS "totalGraminoids") FROM f3),
f5 AS (SELECT * REPLACE (
         CASE WHEN species = 'Hol.lan' AND "Year" = 2017 AND "turfID" = 'Fau1C' THEN 70.0 WHEN species = 'Hol.lan' AND "Year" = 2017 AND "turfID" = 'Fau2C' THEN 60.0
              WHEN species = 'Hol.lan' AND "Year" = 2017 AND "turfID" = 'Vik5C' THEN 45.0 ELSE "totalGraminoids" END AS "totalGraminoids",
         CASE WHEN species = 'Hol.lan' AND "Year" = 2017 AND "turfID" = 'Fau1C' THEN 70.0 WHEN species = 'Hol.lan' AND "Year" = 2017 AND "turfID" = 'Fau2C' THEN 25.0
              WHEN species = 'Hol.lan' AND "Year" = 2017 AND "turfID" = 'Vik5C' THEN 60.0 ELSE "totalForbs" END AS "totalForbs") FROM f4)
SELECT DISTINCT CASE "siteID" WHEN 'Ulvhaugen' THEN 'Ulvehaugen' WHEN 'Skjellingahaugen' THEN 'Skjelingahaugen' WHEN 'Ovstedal' THEN 'Ovstedalen'
         ELSE "siteID" END AS "siteID", "blockID", "Treatment", "turfID", "Year", "totalGraminoids" AS "graminoidCov", "totalForbs" AS "forbCov",
       "totalBryophytes" AS "mossCov", "vegetationHeight", "mossHeight", litter, cover, species, "functionalGroup", sumcover
FROM f5"""


# The whole chain: both stages above, side tables, merge, imputation, attribute
# re-join, roll-up, strict sums and point corrections. Sums and means of scaled
# covers are exact, so their bits don't depend on the order of the rows.
@register("community_chain", _community_chain_sql())
def community_chain(spark, sf):
    from . import community as CM
    folder = staging_dir(spark)
    if folder is None:
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    return CM.community(_community_inputs(spark, sf), folder)
