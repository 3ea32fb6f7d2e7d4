import random
import zlib

import pytest
from pyspark.sql import functions as F

from plotwise.llm import toxicity as T

LABELS = "doc_id long, quality int, toxic int"


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, last = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
    return row[-1]


def test_automaton_equals_edit_distance():
    rng = random.Random(4)
    terms = {"idiot": 2.0, "worthless": 3.0, "fool": 1.0, "moron": 2.5, "disgusting": 1.5}
    a = T.TrieAutomaton(terms)
    words = list(terms) + ["".join(rng.choice("idotfmrnwhles") for _ in range(rng.randint(1, 10))) for _ in range(400)]
    for w in list(terms):
        for _ in range(60):
            x = list(w)
            for _ in range(rng.randint(1, 3)):
                k = rng.randrange(len(x) + 1)
                x[k : k + rng.randint(0, 1)] = rng.choice(["", "x", "o"])
            words.append("".join(x))
    for w in words:
        exact = terms.get(w)
        fuzzy = [v for t, v in terms.items() if 0 < distance(w, t) <= T.allowed_edits(t)]
        assert a.match(w) == ((1, exact) if exact else (2, max(fuzzy)) if fuzzy else (0, 0.0)), w


def test_beginnings_match_exactly():
    a = T.TrieAutomaton({"lowe*": 2.0, "idiot": 1.0})
    assert a.match("loweich") == (3, 2.0) and a.match("lowe") == (3, 2.0) and a.match("lowi")[0] == 0 and a.match("idi0t") == (2, 1.0)


def test_context_separates_quotation_from_abuse():
    m = T.Model({"idiot": 4.0}, [1.0] * T.N_FEATURES + [0.0])
    plain, quoted, said, direct = (T.Scorer(m).features(t) for t in ("an idiot came along", 'the sign "an idiot came" stood there', "he said idiot and left", "you are an idiot"))
    assert plain[0] > 0 and plain[3] == 0 and quoted[0] == said[0] == 0 and quoted[3] > 0 and said[3] > 0 and direct[4] > 0 == plain[4]


@pytest.fixture
def corpus(documents, spark):
    rng = random.Random(9)
    words = ["".join(rng.choice("aeioulmnrst") for _ in range(rng.randint(2, 7))) for _ in range(300)]
    bad = ["blockhead", "nitwit", "scoundrel", "dimwit"]
    rows, labels = [], []
    for i in range(600):
        t = [rng.choice(words) for _ in range(rng.randint(5, 60))]
        toxic = int(rng.random() < 0.2)
        for _ in range(toxic * rng.randint(1, 4)):
            w = list(rng.choice(bad))
            if rng.random() < 0.2:
                w[rng.randrange(len(w))] = "x"
            t.insert(rng.randrange(len(t)), "".join(w))
        rows.append((i, " ".join(t)))
        labels.append((i, 1, toxic))
    return rows, labels


def test_held_out_accuracy(documents, spark, corpus):
    rows, labels = corpus
    docs, table = documents(*rows), spark.createDataFrame(labels, LABELS)
    model = T.learn(docs, table)
    got = {r.doc_id: r for r in T.score(docs, model).withColumn("out", T.held_out(F.col("doc_id"))).collect()}
    test = [(got[i].predicted, y) for i, _, y in labels if got[i].out]
    assert {i for i, r in got.items() if r.out} == {i for i, _ in rows if zlib.crc32(str(i).encode()) % 4 == 2}
    found = sum(p and y for p, y in test)
    assert found / max(1, sum(y for _, y in test)) > 0.9 and found / max(1, sum(p for p, _ in test)) > 0.9


def test_labels_of_the_held_out_fold_and_other_columns_change_nothing(documents, spark, corpus):
    rows, labels = corpus
    flipped = [(i, q, 1 - y if zlib.crc32(str(i).encode()) % 4 == 2 else y) for i, q, y in labels]
    a = T.learn(documents(*rows), spark.createDataFrame(labels, LABELS))
    b = T.learn(documents(*rows, source="other"), spark.createDataFrame(flipped, LABELS))
    assert a.terms == b.terms and a.weights == pytest.approx(b.weights)


def test_nulls_empties_and_no_labels(documents, spark):
    docs = documents((1, None), (2, ""), (None, "you idiot"), (2, ""))
    labels = spark.createDataFrame([(None, None, 1), (1, None, None)], LABELS)
    model = T.learn(docs, labels)
    got = T.score(docs, model).collect()
    assert len(got) == 4 and all(r.score == T.PRIOR and r.predicted == 0 for r in got)
    assert T.reject(docs, model).count() == 4 and T.score(docs.limit(0), model).count() == 0
    m = T.Model({"idiot": 4.0}, [2.0] * T.N_FEATURES + [-3.0])
    assert sorted((r.doc_id or 0) for r in T.reject(docs, m).collect()) == [1, 2, 2]


def test_rare_terms_and_words_beside_their_beginning_stay_in_the_lexicon(documents, spark):
    rows, labels, rare = [], [], 0
    for i in range(4000):
        toxic = int(i % 5 == 0)
        text = "one two three"
        if toxic:
            text = ["one bloomtwit two", "one bloomtwit two", "one blockhead two"][i // 5 % 3]
            trains = zlib.crc32(str(i).encode()) % 4 != 2 and zlib.crc32(f"half{i}".encode()) % 2 == 0
            if trains and rare < 3:
                text, rare = text + " zuckwit", rare + 1
        rows.append((i, text))
        labels.append((i, 1, toxic))
    terms = T.learn(documents(*rows), spark.createDataFrame(labels, LABELS)).terms
    assert {"zuckwit", "blockhead", "bloomtwit", "blo*"} <= set(terms)
    assert T.TrieAutomaton(terms).match("blxckhead")[0] == 2


def test_beginnings_left_out_change_no_match():
    rng = random.Random(3)
    for _ in range(50):
        words = ["".join(rng.choice("ab") for _ in range(rng.randint(3, 8))) for _ in range(12)]
        terms = {w if rng.random() < 0.4 else f"{w[: rng.randint(3, 6)]}*": float(rng.randint(1, 4)) for w in words}
        a, b = T.TrieAutomaton(terms), T.TrieAutomaton(T.prune(terms))
        for _ in range(60):
            w = "".join(rng.choice("abc") for _ in range(rng.randint(1, 9)))
            assert a.match(w) == b.match(w)


def test_misspellings_and_contexts_add_recall(documents, spark):
    """Ablation on planted texts: without the automaton misspelt terms are lost, words of clean texts are no misspellings."""
    rng = random.Random(12)
    bad = ["blockhead", "scoundrel", "nincompoop", "deadbeat"]
    words = ["".join(rng.choice("aeioulmnrst") for _ in range(rng.randint(2, 7))) for _ in range(300)] + ["deadheat"]
    texts, labels = [], []
    for i in range(1200):
        t = [rng.choice(words) for _ in range(40)] + (["deadheat"] if i % 7 == 0 else [])
        if i % 5 == 0:
            t.insert(rng.randrange(40), rng.choice(bad))
        texts.append((i, " ".join(t)))
        labels.append((i, 1, int(i % 5 == 0)))
    model = T.learn(documents(*texts), spark.createDataFrame(labels, LABELS))
    assert "deadheat" in model.clean and set(bad) <= set(model.terms) - model.exact
    planted = []
    for k in range(60):
        w = list(rng.choice(bad))
        at = rng.randrange(1, len(w))
        w[at : at + rng.randint(0, 1)] = rng.choice("xyz0")
        planted.append(" ".join([*(rng.choice(words) for _ in range(20)), "".join(w), *(rng.choice(words) for _ in range(20))]))
    clean = [" ".join(rng.choice(words) for _ in range(41)) for _ in range(60)]
    both, exact_only = T.Scorer(model), T.Scorer(T.Model(model.terms, model.weights, exact=frozenset(model.terms)))
    found = [sum(s.score(t) >= T.THRESHOLD for t in planted) for s in (both, exact_only)]
    assert found[0] >= 57 and found[0] - found[1] >= 15  # beginnings find some of them alone
    assert sum(both.score(t) >= T.THRESHOLD for t in clean) <= 2
    # quoted, a text scores no higher than said straight out
    straight, quoted = "you are a blockhead and nothing else", 'they wrote "you are a blockhead" and nothing else'
    assert both.features(quoted)[0] == 0 < both.features(straight)[0]
