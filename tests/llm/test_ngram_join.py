import random
from itertools import combinations

import pytest

from plotwise.llm import ngram_join as J
from plotwise.llm.graph import components


def shingles(text, n):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        low = low.replace(c, " ")
    w = [x for x in low.split(" ") if x]
    return {tuple(w[i : i + n]) for i in range(max(1, len(w) - n + 1))} if w else set()


def brute(rows, n=4, percent=85):
    sets = [(i, shingles(t, n)) for i, t in rows]
    up = {i: i for i, _ in sets if i is not None}

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for (i, a), (j, b) in combinations(sets, 2):
        if i is not None and j is not None and a and b and 100 * len(a & b) >= percent * len(a | b):
            x, y = root(i), root(j)
            up[max(x, y)] = min(x, y)
    return sorted(((i, len(s), None if i is None else root(i)) for i, s in sets), key=repr)


def corpus(seed, n=60):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(40)]
    base = [[rng.choice(words) for _ in range(m)] for m in (4, 6, 12, 15, 16, 17, 20, 30, 60, 120)]
    out = []
    for _ in range(n):
        t = list(rng.choice(base))
        for _ in range(rng.choice((0, 0, 1, 1, 2, 3))):
            k = rng.randrange(len(t))
            t[k : k + rng.randint(0, 1)] = [rng.choice(words)] if rng.random() < 0.7 else []
        out.append(" ".join(t).upper() if rng.random() < 0.2 else "\t ".join(t))
    return out + ["", None, " \n ", "one", "One", "one two", "ONE two", "a b c d", "a b c d"]


@pytest.mark.parametrize("n,percent,block", [(4, 85, 2000), (4, 85, 5), (5, 80, 2000), (2, 60, 7)])
def test_matches_brute_force(documents, n, percent, block):
    rows = list(enumerate(corpus(n * percent + block)))
    got = sorted(map(tuple, J.link(documents(*rows), n, percent, block).collect()), key=repr)
    assert got == brute(rows, n, percent)


def test_nulls_repeats_and_empty(documents):
    long = " ".join(f"x{i}" for i in range(80))
    rows = [(9, long), (9, long), (None, long), (4, long + " end"), (4, "quite another text of some words"), (2, "quite another text of some words"), (7, None)]
    got = {(r.doc_id, r.n_shingles): r.component_id for r in J.link(documents(*rows)).collect()}
    assert got[9, 77] == 2 and got[4, 78] == 2 and got[2, 3] == 2 and got[None, 77] is None and got[7, 0] == 7
    assert J.link(documents(*rows).limit(0)).count() == 0


def test_keep_one_of_each_group(documents):
    long = " ".join(f"x{i}" for i in range(80))
    df = documents((3, long), (3, long), (1, long + " end"), (5, None), (6, ""), (None, long), (8, "single text here now"), (8, "single text here now"))
    kept = J.keep_one(df)
    assert kept.columns == df.columns
    assert sorted((r.doc_id or -1, r.text) for r in kept.collect() if r.text) == [(-1, long), (1, long + " end"), (8, "single text here now")]
    assert sorted(r.doc_id for r in kept.collect() if not r.text) == [5, 6]


def test_keep_one_judges_texts_not_ids(documents):
    other = "quite another text of some words that nobody else has"
    near = " ".join(f"y{i}" for i in range(80))
    df = documents((1, "alpha beta gamma delta epsilon zeta"), (1, other), (1, ""), (1, None), (1, other), (2, near), (3, near + " end"), (3, "a third text for this id of several words"), (4, near + " tail"))
    kept = sorted((r.doc_id, r.text or "") for r in J.keep_one(df).collect())
    assert kept == sorted([(1, "alpha beta gamma delta epsilon zeta"), (1, other), (1, ""), (1, ""), (2, near), (3, "a third text for this id of several words")])


def test_crafted_words_are_told_apart(documents):
    # Thue-Morse words, alike in every position sum
    bits = [bin(i).count("1") % 2 for i in range(4096)]
    words = ["".join(ab[k] for k in bits[:m]) for ab in ("xy", "yx") for m in (1024, 2048, 4096)]
    rows = [(i, f"{w} and the same end") for i, w in enumerate(words)]
    assert sorted(map(tuple, J.link(documents(*rows), 2).collect())) == brute(rows, 2)


def test_boundary_and_bounds():
    light = J.light_boundary(85)
    assert all(J.n_subsets(n, 85) <= J.LIST_COST * n for n in range(1, light + 1)) and J.n_subsets(light + 1, 85) > J.LIST_COST * (light + 1)
    for a in range(1, 60):
        for b in J.partners(a, 85):
            o = J.overlap(a, b, 85)
            assert 100 * o >= 85 * (a + b - o) and 100 * (o - 1) < 85 * (a + b - o + 1)


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, i) for i in range(101, 160)] + [(300, 299), (299, 300), (400, 400)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert all(got[i] == 0 for i in range(1, 61)) and all(got[i] == 100 for i in range(101, 160)) and got[300] == 299 and 400 not in got


def families(sizes, drift, seed):
    """Groups of near copies that all share a rare passage; ``drift`` copies change one another in a chain."""
    rng, rows = random.Random(seed), []
    shared = [f"rare{i}" for i in range(6)]
    for f, size in enumerate(sizes):
        now = [f"f{f}w{i}" for i in range(90)]
        for c in range(size):
            text = list(now)
            text[rng.randrange(90)] = f"e{f}x{c}"
            if c < drift:
                now = text
            rows.append(" ".join(shared + text))
    rng.shuffle(rows)
    return list(enumerate(rows))


@pytest.mark.parametrize("sizes,drift", [((60,), 0), ((30, 25, 1, 1, 2), 0), ((40, 12), 40), ((1,) * 30, 0)])
def test_large_groups(documents, sizes, drift):
    rows = families(sizes, drift, sum(sizes))
    got = sorted(map(tuple, J.link(documents(*rows), 4, 85, 7).collect()), key=repr)
    assert got == brute(rows)


def test_near_copies_settle_in_linear_tasks(spark):
    """Members of one component don't meet again; a stranger meets every block once."""
    hot = spark.range(1, 101).selectExpr("id doc", "1L pivot", "10L n", "10 blocks")
    found = spark.range(2, 101).selectExpr("id node", "1L component")
    assert J._open_tasks(hot, found, 10).count() == 0
    left = J._open_tasks(hot, found.filter("node < 100"), 10)
    tasks = left.select("i", "j").distinct().count()
    assert tasks <= 11 and left.filter("label = 1").count() == 99
    first = J._centre_tasks(hot)
    assert first.select("i", "j").distinct().count() == 10 and first.count() <= 100 + 10 * J.CENTRES
