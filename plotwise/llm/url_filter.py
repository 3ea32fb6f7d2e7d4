"""URL filters by a temporal list join (built-in functions only).

Dated list entries (a key is added to or removed from a list) become validity intervals; every capture is
judged against the entries that were active when it was fetched. A key is a host, a parent domain, or a host with
leading path segments. Captures and intervals meet by key and calendar month, so a capture only meets
intervals of its own month: rows made are linear in captures, however long a key's history is.

The most specific active entry decides (more path segments, then more host labels); among equals the
latest added, then ``block`` before ``allow``. Without an active entry a capture is kept.

Defined results: null or unparsable URLs and null fetch dates match nothing and are kept; list rows with a
null in any needed column are ignored; an add and a remove on one day leave the key listed; repeated
list rows count once; repeated captures give one row each; empty lists keep everything; extra columns are
ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: Host after ``//`` (an IPv6 address in brackets), or at the start of a URL without a scheme, and the path.
HOST = r"^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//(?:[^/?#@]*@)?(\[[^\]/?#]*\]|[^/?#:]+)"
BARE_HOST = r"^((?:[a-zA-Z0-9_-]+\.)+(?:[a-zA-Z][a-zA-Z0-9-]*|\d+))\.?(?::\d+)?(?:[/?#]|$)"
PATH = r"^(?:(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//)?[^/?#]*(/[^?#]*)"
ADDRESS = r"^(?:\[.*\]|\d+(?:\.\d+){3})$"
#: Registries sell names below these labels of a country's domain.
SECOND_LEVEL = r"^(?:ac|co|com|edu|gob|gov|go|mil|ne|net|or|org)\.[a-z]{2}$"
#: Specificity of a path key: above that of any host.
PATH_RANK = 1000


def host_of(url: Column) -> Column:
    """Lower-cased host without trailing dots; empty where there is none."""
    found = F.coalesce(F.nullif(F.regexp_extract(url, HOST, 1), F.lit("")), F.regexp_extract(url, BARE_HOST, 1), F.lit(""))
    return F.regexp_replace(F.lower(found), r"\.+$", "")


def path_segments(url: Column) -> Column:
    return F.filter(F.split(F.coalesce(F.regexp_extract(url, PATH, 1), F.lit("")), "/"), lambda s: s != "")


def keys_of(host: Column, segments: Column) -> Column:
    """Array of (key, specificity): the host, its parent domains of two labels or more (no registry's, such as ``co.uk``; an address
    has none), and the host with its first 1, 2, ... path segments; empty without a host."""
    labels = F.split(host, r"\.")
    n = F.size(labels)
    item = lambda key, rank: F.struct(key.alias("key"), rank.cast("int").alias("specificity"))
    last = F.when(host.rlike(ADDRESS), F.lit(1)).otherwise(F.greatest(n - 1, F.lit(1)))
    hosts = F.transform(F.sequence(F.lit(1), last), lambda i: item(F.array_join(F.slice(labels, i, n), "."), n - i + 1))
    hosts = F.filter(hosts, lambda k: (k["key"] == host) | ~k["key"].rlike(SECOND_LEVEL))
    numbers = F.when(F.size(segments) > 0, F.sequence(F.lit(1), F.greatest(F.size(segments), F.lit(1)))).otherwise(F.array().cast("array<int>"))
    paths = F.transform(numbers, lambda i: item(F.concat(host, F.lit("/"), F.array_join(F.slice(segments, 1, i), "/")), F.lit(PATH_RANK) + i))
    return F.when(host == "", F.array().cast("array<struct<key:string,specificity:int>>")).otherwise(F.concat(hosts, paths))


def intervals(entries: DataFrame) -> DataFrame:
    """(key, verdict, valid_from, valid_to) from (key, verdict, action 'add'|'remove', listed_on): an add
    holds until the next remove of the key and verdict, exclusive; valid_to null: still listed."""
    given = entries.select("key", "verdict", "action", F.col("listed_on").cast("date").alias("listed_on")).dropna().distinct()
    daily = given.groupBy("key", "verdict", "listed_on").agg(F.max((F.col("action") == "add").cast("int")).alias("on"))
    order = W.partitionBy("key", "verdict").orderBy("listed_on")
    changes = daily.withColumn("was", F.lag("on").over(order)).filter(F.col("was").isNull() | (F.col("was") != F.col("on")))
    return (changes.withColumn("valid_to", F.lead("listed_on").over(order)).filter(F.col("on") == 1)
            .select("key", "verdict", F.col("listed_on").alias("valid_from"), "valid_to"))


def judge(captures: DataFrame, entries: DataFrame) -> DataFrame:
    """(page_id, url, fetched_on, blocked, n_active, matched_key, verdict, listed_on), one row per capture row
    of (page_id, url, fetched_on)."""
    # repeated captures are judged once and given back as often
    each = captures.select("page_id", "url", F.col("fetched_on").cast("date").alias("fetched_on")).groupBy("page_id", "url", "fetched_on").agg(F.count("*").alias("_n"))
    month = lambda d: F.trunc(d, "month")
    last = each.agg(F.max("fetched_on").alias("_last"))
    asked = (each.withColumn("_k", F.explode(keys_of(host_of(F.col("url")), path_segments(F.col("url")))))
             .select("page_id", "url", "fetched_on", "_n", "_k.key", "_k.specificity", month(F.col("fetched_on")).alias("_month")).filter(F.col("_month").isNotNull()))
    # one row of one date: broadcasting it is bounded
    end = F.least(F.coalesce(F.date_sub("valid_to", 1), F.col("_last")), F.col("_last"))
    by_month = (intervals(entries).join(F.broadcast(last), F.lit(True)).filter(F.col("valid_from") <= F.col("_last"))
                .withColumn("_month", F.explode(F.sequence(month(F.col("valid_from")), month(F.greatest(end, F.col("valid_from"))), F.expr("interval 1 month"))))
                .select("key", "verdict", "valid_from", "valid_to", "_month"))
    active = (asked.join(by_month, ["key", "_month"])
              .filter((F.col("valid_from") <= F.col("fetched_on")) & (F.col("valid_to").isNull() | (F.col("fetched_on") < F.col("valid_to")))))
    best = F.max(F.struct("specificity", "valid_from", (F.col("verdict") == "block").alias("_block"), "key", "verdict"))
    judged = active.groupBy("page_id", "url", "fetched_on").agg(F.count("*").alias("n_active"), best.alias("_best"))
    judged = judged.select(F.col("page_id").alias("_p"), F.col("url").alias("_u"), F.col("fetched_on").alias("_f"), "n_active", "_best")
    same = each["page_id"].eqNullSafe(F.col("_p")) & each["url"].eqNullSafe(F.col("_u")) & each["fetched_on"].eqNullSafe(F.col("_f"))
    return (each.join(judged, same, "left").withColumn("_n", F.explode(F.array_repeat(F.lit(1), F.col("_n").cast("int"))))
            .select("page_id", "url", "fetched_on", F.coalesce(F.col("_best._block"), F.lit(False)).cast("int").alias("blocked"),
                    F.coalesce("n_active", F.lit(0)).cast("long").alias("n_active"), F.col("_best.key").alias("matched_key"),
                    F.col("_best.verdict").alias("verdict"), F.col("_best.valid_from").alias("listed_on")))
