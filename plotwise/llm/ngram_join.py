"""N-gram Jaccard join: a size-aware heavy-light join over word shingles.

Texts whose shingle sets are equal are one class and take part once. Two sets link when their Jaccard
similarity reaches the threshold.

* Light sets (sizes up to a boundary chosen by cost) enumerate fixed-size subsets: two sets of sizes a and b link
  exactly when they share o(a, b) elements, so they link exactly when they share a subset of that size.
* Heavy sets scan inverted lists. Elements are ordered by document frequency (counted over all
  documents for the elements in the lowest part of the hash range, which come first; then by hash), and a set
  is listed under its prefix only: its first n - ceil(t n) + 1 elements, of which two linked sets share
  one. An element of one document has no list, so a text without near copies drops out before any
  set is moved. Lists are gathered under the smallest document of the element (the pivot); the members'
  whole sets meet there and are intersected exactly.

A group of more than ``BLOCK`` members (or ``ELEMENTS`` elements) is cut into blocks, so no task's memory grows with
it. First each block meets itself and ``CENTRES`` members drawn from the whole group, which is linear in the group and joins
its near copies. Sets that are in one component by then needn't meet any more: only pairs of blocks with
different components go on. A task returns a spanning forest of its links, fewer edges than members, and
compares no two sets that it already knows to be joined; components are exact and rows stay linear.

Hashes are 63 bits wide; classes are keyed by size and two independent 64-bit sums.

Defined results: null, empty and blank texts have an empty set and link with nothing; a null doc_id
gets no component; rows that share a doc_id are one node; repeated rows are equal sets; texts of
any length are read whole; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import comb

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from plotwise.llm.graph import components
from plotwise.llm.tables import fresh, sift, stage, unstage
from plotwise.llm.text import buffer, distinct, mix, shingles, slices

#: Part of the hash range whose elements are counted and come first in the order.
COUNTED = 0.25
#: Members of a block, and elements of its sets all together: what meets in one task is two blocks at most.
BLOCK, ELEMENTS = 1000, 400_000
#: Members of a large group that all its blocks meet (at most).
CENTRES = 16
#: What a set of n elements costs on the inverted lists, in rows per element.
LIST_COST = 4


def need(n: int, percent: int) -> int:
    """Elements that a set of n shares at least with any set it links with."""
    return -(-percent * n // 100)


def overlap(a: int, b: int, percent: int) -> int:
    """Common elements from which sets of sizes a and b link: 100 i >= percent (a + b - i)."""
    return -(-percent * (a + b) // (100 + percent))


def partners(n: int, percent: int) -> range:
    return range(need(n, percent), 100 * n // percent + 1)


def n_subsets(n: int, percent: int) -> int:
    """Subset rows that a set of n elements gives as a light set."""
    return sum(comb(n, overlap(n, m, percent)) for m in partners(n, percent))


def light_boundary(percent: int, list_cost: float = LIST_COST) -> int:
    """The largest size up to which enumerating subsets costs at most the rows of the inverted lists."""
    n = 1
    while n_subsets(n + 1, percent) <= list_cost * (n + 1):
        n += 1
    return n


def _keys(batch: pa.RecordBatch, n_words: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct keys by row, ascending, and the n+1 offsets of the rows."""
    h, row, _ = shingles(*buffer(batch.column("text")), n_words)
    h, row = distinct(h >> np.uint64(1), row)
    return h, row, np.searchsorted(row, np.arange(batch.num_rows + 1))


def _set_rows(n_words: int, percent: int, light: int):
    limit = np.uint64(int(COUNTED * 2**63))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            key, row, off = _keys(b, n_words)
            n = np.diff(off)
            place = np.arange(len(key)) - off[row]
            prefix = n - (percent * n + 99) // 100 + 1
            keep = (key < limit) | (place < prefix[row]) | (n[row] <= light)
            sums = []
            for salt in (0x51ED270B, 0x2545F491):
                c = np.zeros(len(key) + 1, np.uint64)
                np.cumsum(mix(key ^ (np.uint64(salt) << np.uint64(17))), out=c[1:])
                sums.append((c[off[1:]] - c[off[:-1]]).view(np.int64))
            kept = np.concatenate([[0], np.cumsum(keep)])
            counted = np.concatenate([[0], np.cumsum(key < limit)])
            yield pa.RecordBatch.from_arrays([
                b.column("doc_id"), pa.array(n, pa.int64()), *[pa.array(s) for s in sums], pa.array(counted[off[1:]] - counted[off[:-1]], pa.int32()),
                pa.ListArray.from_arrays(pa.array(kept[off], pa.int32()), pa.array(key[keep].astype(np.int64)))], ["doc_id", "n", "h1", "h2", "n_counted", "elems"])

    return rows


def _subset_rows(percent: int, light: int):
    """(a, b, s1, s2, doc, n): the subsets of a light set, keyed by the pair of sizes they link."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for doc, n, elems in zip(batch.column("doc").to_pylist(), batch.column("n").to_pylist(), batch.column("elems").to_pylist(), strict=True):
                x = np.array(elems, np.uint64)
                parts = [mix(x ^ np.uint64(s)) for s in (0xA076_1D64, 0xE703_7ED1)]
                for m in partners(n, percent):
                    if max(m, n) > light:
                        continue
                    left_out = n - overlap(n, m, percent)
                    for gone in combinations(range(n), left_out):
                        s = [(int(p.sum()) - int(p[list(gone)].sum())) % 2**64 for p in parts]
                        out.append((min(n, m), max(n, m), *[v - 2**64 if v >= 2**63 else v for v in s], doc, n))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out, strict=True)], ["a", "b", "s1", "s2", "doc", "n"])

    return rows


def _light_edges(classes: DataFrame, percent: int, light: int) -> DataFrame:
    """Links among light sets: the sharers of a subset, each to the smallest sharer of the smaller size
    (sharers of the larger size alone need not link with each other)."""
    subsets = classes.filter(F.col("n") <= light).select("doc", "n", "elems").mapInArrow(_subset_rows(percent, light), "a long, b long, s1 long, s2 long, doc long, n long")
    keys = ["a", "b", "s1", "s2"]
    centres = subsets.filter("n = a").groupBy(*keys).agg(F.min("doc").alias("centre"))
    return subsets.join(centres, keys).filter("doc <> centre").select(F.col("doc").alias("x"), F.col("centre").alias("y")).distinct()


def _prefix_lists(classes: DataFrame, percent: int, least: int) -> DataFrame:
    """(pivot, doc, n): every heavy set under the pivots of its shared prefix elements."""
    limit = int(COUNTED * 2**63)
    heavy = classes.filter(F.col("n") >= least)
    prefix = F.expr(f"n - (({percent} * n + 99) div 100) + 1")
    listed = (heavy.select("doc", "n", F.posexplode("elems").alias("pos", "key"))
              .filter((F.col("key") < limit) | (F.col("pos") < prefix)).select("key", "doc"))
    # dealt by element once: counted and joined in the same layout
    listed = listed.repartition("key")
    shared = listed.groupBy("key").agg(F.count("*").alias("df"), F.min("doc").alias("pivot")).filter("df > 1")
    found = listed.join(shared, "key").withColumn("outside", (F.col("key") >= limit).cast("int"))
    found = found.join(heavy.select("doc", "n", "n_counted"), "doc").withColumn("p", prefix)
    each = W.partitionBy("doc")
    unique = F.col("n_counted") - F.sum(1 - F.col("outside")).over(each)
    rank = F.row_number().over(each.orderBy("outside", "df", "key"))
    # elements outside the counted range were cut to the prefix when they were listed
    return (found.withColumn("rank", unique + rank).filter((F.col("outside") == 1) | (F.col("rank") <= F.col("p")))
            .select("pivot", "doc", "n").distinct())


def _group_edges(percent: int):
    def links(group: pd.DataFrame) -> pd.DataFrame:
        """A spanning forest of the links among a task's sets that have different labels: within a block, or
        between two blocks (``i`` and ``j``)."""
        empty = pd.DataFrame({"x": pd.Series(dtype="int64"), "y": pd.Series(dtype="int64")})
        m = len(group)
        label = np.unique(group["label"].to_numpy(), return_inverse=True)[1]
        if label.max(initial=0) == 0:
            return empty
        docs, n = group["doc"].to_numpy(), group["n"].to_numpy()
        first = np.concatenate([[0], np.cumsum(n)])
        keys = np.concatenate(group["elems"].to_numpy())
        owner = np.repeat(np.arange(m), n)
        order = np.argsort(keys, kind="stable")
        begin = np.flatnonzero(np.concatenate([[True], keys[order][1:] != keys[order][:-1]]))
        size = np.diff(np.concatenate([begin, [len(keys)]]))
        member = np.empty(len(keys), np.int64)
        member[order] = np.repeat(np.arange(len(begin)), size)  # the list of each element
        lists = owner[order]

        across = group["i"].iloc[0] != group["j"].iloc[0]
        if across:  # the smaller block asks the other
            side = (group["own"] == group["i"]).to_numpy()
            asking = np.flatnonzero(side if 2 * side.sum() <= m else ~side)
        else:  # the largest label comes last: nothing is left to ask then
            asking = np.argsort(np.bincount(label)[label], kind="stable")
        asked, out = np.zeros(m, bool), []
        for i in asking:
            asked[i] = True
            open_ = (label != label[i]) & ((side != side[i]) if across else ~asked)
            own = member[first[i] : first[i + 1]]
            own = own[size[own] > 1]
            if not len(own) or not open_.any():
                continue
            # positions of all members of the lists of i's elements
            count, start = size[own], begin[own]
            at = np.repeat(start - np.concatenate([[0], np.cumsum(count)[:-1]]), count) + np.arange(count.sum())
            common = np.bincount(lists[at], minlength=m)
            for j in np.flatnonzero(open_ & (common > 0) & (100 * common >= percent * (n[i] + n - common))):
                if label[i] != label[j]:
                    label[label == label[j]] = label[i]
                    out.append((docs[i], docs[j]))
        return pd.DataFrame(out, columns=["x", "y"]).astype("int64") if out else empty

    return links


def _meet(docs: DataFrame, tasks: DataFrame, n_words: int, percent: int) -> DataFrame:
    """The links found by ``tasks``: (doc, pivot, i, j, own, label), a row for each set in each task (pivot, i, j)."""
    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            key, _, off = _keys(b, n_words)
            yield pa.RecordBatch.from_arrays([b.column("doc"), pa.array(np.diff(off), pa.int64()), pa.ListArray.from_arrays(pa.array(off, pa.int32()), pa.array(key.astype(np.int64)))], ["doc", "n", "elems"])

    # only texts that meet others are moved
    tasks = stage(tasks, "tasks")
    wanted = stage(tasks.select("doc").distinct(), "wanted")
    may, _ = sift(docs.select(F.col("doc_id").cast("long").alias("doc"), "text"), "doc", wanted)
    whole = may.join(wanted, "doc", "left_semi").mapInArrow(sets, "doc long, n long, elems array<long>")
    return tasks.join(whole, "doc").groupBy("pivot", "i", "j").applyInPandas(_group_edges(percent), "x long, y long")


def _n_blocks(members: str, elements: str, block: int) -> Column:
    return F.ceil(F.greatest(F.col(members) / block, F.col(elements) / ELEMENTS)).cast("int")


def _dealt(blocks: str) -> Column:
    return F.pmod(F.xxhash64("doc", "pivot"), F.col(blocks).cast("long")).cast("int")


def _centre_tasks(hot: DataFrame) -> DataFrame:
    """Every block of a large group with the group's centres: linear in the group."""
    drawn = F.xxhash64("pivot", "doc")
    centres = hot.groupBy("pivot", F.pmod(drawn, F.lit(CENTRES))).agg(F.min_by("doc", F.struct(drawn, "doc")).alias("doc"), F.first("blocks").alias("blocks"))
    everywhere = centres.select("doc", "pivot", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("i"))
    members = hot.select("doc", "pivot", _dealt("blocks").alias("i")).unionByName(everywhere).distinct()
    return members.withColumns({"j": F.col("i"), "own": F.col("i"), "label": F.col("doc")})


def _open_tasks(hot: DataFrame, found: DataFrame, block: int) -> DataFrame:
    """Pairs of blocks of the large groups that centres leave open. A component that fills a block has blocks of its own,
    which needn't meet each other; the members of all smaller ones share blocks."""
    labelled = (hot.select("doc", "pivot", "n").join(found, F.col("doc") == F.col("node"), "left")
                .select("doc", "pivot", "n", F.coalesce("component", "doc").alias("label")))
    labels = labelled.groupBy("pivot", "label").agg(F.count("*").alias("k"), F.sum("n").alias("total"))
    part = F.when((F.col("k") >= block) | (F.col("total") >= ELEMENTS), F.col("label"))
    labels = stage(labels.withColumn("part", part), "labels")
    group = W.partitionBy("pivot")  # a row for each part: as many as blocks at most
    parts = (labels.groupBy("pivot", "part").agg(F.sum("k").alias("k"), F.sum("total").alias("total")).withColumn("blocks", _n_blocks("k", "total", block))
             .withColumn("all", F.sum("blocks").over(group).cast("int")).withColumn("parts", F.count("*").over(group))
             .withColumn("start", F.coalesce(F.sum("blocks").over(group.orderBy("part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).cast("int"))
             .filter("part is null or parts > 1").select(F.col("pivot").alias("_pivot"), F.col("part").alias("_part"), "blocks", "all", "start"))
    placed = labels.join(parts, (F.col("pivot") == F.col("_pivot")) & F.col("part").eqNullSafe(F.col("_part"))).select("pivot", "label", "part", "blocks", "all", "start")
    # block i meets block j: a member goes to the tasks (min(i, j), max(i, j)) of its group
    return (labelled.join(placed, ["pivot", "label"]).withColumn("own", F.col("start") + _dealt("blocks"))
            .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("all") - 1)))
            .filter("part is null or other < start or other >= start + blocks")
            .select("doc", "pivot", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "label"))


def _heavy_edges(docs: DataFrame, classes: DataFrame, n_words: int, percent: int, light: int, block: int) -> DataFrame:
    lists = stage(_prefix_lists(classes, percent, need(light + 1, percent)), "lists")  # small: ids only
    sizes = lists.groupBy("pivot").agg(F.count("*").alias("m"), F.sum("n").alias("total")).filter("m > 1")
    groups = stage(sizes.select("pivot", _n_blocks("m", "total", block).alias("blocks")), "groups")
    zero = F.lit(0)
    tasks = (lists.join(groups.filter("blocks = 1"), "pivot")
             .select("doc", "pivot", zero.alias("i"), zero.alias("j"), zero.alias("own"), F.col("doc").alias("label")))
    large = groups.filter("blocks > 1")
    if large.isEmpty():
        return _meet(docs, tasks, n_words, percent)
    hot = lists.join(large, "pivot")
    first = stage(_meet(docs, _centre_tasks(hot), n_words, percent), "centre-links")
    return _meet(docs, tasks.unionByName(_open_tasks(hot, components(first), block)), n_words, percent).unionByName(first)


def link(docs: DataFrame, n_words: int = 4, percent: int = 85, block: int = BLOCK) -> DataFrame:
    """(doc_id, n_shingles, component_id), one row per row of ``docs``; the component is the smallest
    doc_id that links reach."""
    return _linked(docs, n_words, percent, block)[-1]


def _linked(docs: DataFrame, n_words: int, percent: int, block: int) -> tuple[DataFrame, ...]:
    """The staged tables that the result reads, and the result."""
    light = light_boundary(percent)
    sets = stage(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
                 .mapInArrow(_set_rows(n_words, percent, light), "doc_id long, n long, h1 long, h2 long, n_counted int, elems array<long>"), "sets")
    usable = sets.filter("doc_id is not null and n > 0")
    classes = stage(usable.groupBy("n", "h1", "h2").agg(F.min("doc_id").alias("doc"), F.first("n_counted").alias("n_counted"), F.first("elems").alias("elems")), "classes")
    edges = _light_edges(classes, percent, light).unionByName(_heavy_edges(docs, classes, n_words, percent, light, block))
    # a doc_id on several different texts is one node: its classes are joined
    several = usable.groupBy("doc_id").agg(F.count("*").alias("k")).filter("k > 1").select("doc_id")
    owned = usable.join(several, "doc_id").join(classes.select("n", "h1", "h2", "doc"), ["n", "h1", "h2"]).select("doc_id", "doc").distinct()
    same = owned.join(owned.groupBy("doc_id").agg(F.min("doc").alias("y")), "doc_id").select(F.col("doc").alias("x"), "y")
    found = components(edges.unionByName(same))
    labels = classes.select("n", "h1", "h2", "doc").join(found, F.col("doc") == F.col("node"), "left").select("n", "h1", "h2", F.coalesce("component", "doc").alias("c"))
    return sets, classes, found, (
        sets.select("doc_id", "n", "h1", "h2").join(labels, ["n", "h1", "h2"], "left")
        .select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("doc_id").isNotNull(), F.coalesce("c", "doc_id")).alias("component_id")))


def _nodes(docs: DataFrame, node: str) -> DataFrame:
    """``docs`` with a column ``node``: the id or, where an id stands on several texts, a number of the id and the text beyond
    2**62, so that every node is one text."""
    own, id_ = F.col("doc_id").cast("long"), fresh(docs, "_several")[0]
    several = stage(docs.select(own.alias(id_), F.xxhash64("text").alias("h")).filter(F.col(id_).isNotNull())
                    .groupBy(id_).agg(F.min("h").alias("a"), F.max("h").alias("b")).filter("a <> b").select(id_), "several")
    if several.isEmpty():
        return docs.withColumn(node, own)
    may, clean = sift(docs, "doc_id", several)
    number = F.lit(2**62) + F.xxhash64("doc_id", "text").bitwiseAND(F.lit(2**61 - 1))
    told = may.join(several, own == F.col(id_), "left").withColumn(node, F.when(F.col(id_).isNotNull(), number).otherwise(own)).drop(id_)
    return clean.withColumn(node, own).unionByName(told)


def keep_one(docs: DataFrame, n_words: int = 4, percent: int = 85) -> DataFrame:
    """``docs`` with one row for each group of linked texts (its smallest doc_id; ids that stand on several texts come last; one of
    repeated rows). Texts are judged one by one: other texts under an id stay unless they are linked themselves, and
    texts without words and rows without an id all stay. Same columns."""
    node, key, drop, number = fresh(docs, "_node", "_id", "_drop", "_row")
    given = _nodes(docs, node)
    sets, classes, parts, linked = _linked(given.select(F.col(node).alias("doc_id"), "text"), n_words, percent, BLOCK)
    found = stage(linked, "links")
    unstage(sets, classes, parts)
    # one row per text to be dropped or, where rows repeat, kept once
    state = found.filter("doc_id is not null and n_shingles > 0").groupBy("doc_id").agg(F.min("component_id").alias("c"), F.count("*").alias("k"))
    touched = stage(state.filter("c <> doc_id or k > 1").select(F.col("doc_id").alias(key), (F.col("c") != F.col("doc_id")).alias(drop)), "touched")
    # only rows that may be dropped or repeated are moved
    may, clean = sift(given, node, touched.select(key))
    found = may.join(touched, F.col(node) == F.col(key), "left").filter(~F.coalesce(drop, F.lit(False)))
    # a repeated text has a key and keeps its first row; a row without a key only shares the sieve
    order = W.partitionBy(key, node).orderBy(F.xxhash64(*[F.col(c) for c in docs.columns]))
    found = found.withColumn(number, F.row_number().over(order)).filter(F.col(key).isNull() | (F.col(number) == 1))
    return clean.select(*docs.columns).unionByName(found.select(*docs.columns))
