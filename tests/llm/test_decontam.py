import random

import numpy as np
import pytest

from plotwise.llm import decontam as D

ITEMS = "item_id long, text string, extra string"


def words(rng, n):
    return ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 6))) for _ in range(n)]


def smith_waterman(a, b):
    h = np.zeros((len(a) + 1, len(b) + 1), int)
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            h[i, j] = max(0, h[i - 1, j - 1] + (2 if a[i - 1] == b[j - 1] else -1), h[i - 1, j] - 1, h[i, j - 1] - 1)
    return h.max() / (2 * len(a))


def test_alignment_equals_the_full_table():
    rng = np.random.default_rng(1)
    for _ in range(60):
        a, b = rng.integers(0, 6, rng.integers(1, 15)), rng.integers(0, 6, rng.integers(0, 25))
        assert D.align(a, b) == pytest.approx(smith_waterman(a, b) if len(b) else 0.0)


@pytest.mark.parametrize("block", [D.BLOCK_BYTES, 600])
def test_finds_exact_and_edited_copies_and_leaves_clean_documents(documents, spark, monkeypatch, block):
    monkeypatch.setattr(D, "BLOCK_BYTES", block)
    rng = random.Random(5)
    items = [words(rng, rng.randint(15, 50)) for _ in range(12)]
    rows, want = [], set()
    for i in range(80):
        t = words(rng, rng.randint(0, 120))
        if i % 3 == 0:
            k = rng.randrange(len(items))
            copy = list(items[k])
            if i % 2:  # every seventh word is another one
                copy = [w if j % 7 else "zz" + w for j, w in enumerate(copy)]
            t[len(t) // 2 : len(t) // 2] = [w.upper() + "," for w in copy] if i % 4 == 0 else copy
            want.add((i, k))
        rows.append((i, " ".join(t)))
    bench = spark.createDataFrame([(k, " ".join(w), "x") for k, w in enumerate(items)] + [(90, None, "x"), (91, "", "x"), (92, "too short", "x")], ITEMS)
    docs = documents(*rows, (200, None), (201, ""))
    assert {(r.doc_id, r.item_id) for r in D.find(docs, bench).collect()} == want
    kept = D.drop(docs, bench)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == ({i for i, _ in rows} | {200, 201}) - {i for i, _ in want}


def test_an_item_in_every_document_is_still_found(documents, spark):
    rng = random.Random(6)
    item = words(rng, 20)
    docs = documents(*[" ".join([*words(rng, 9), *item]) for _ in range(30)])
    assert D.find(docs, spark.createDataFrame([(1, " ".join(item), "")], ITEMS)).count() == 30


def test_empty_tables(documents, spark):
    bench = spark.createDataFrame([(1, "a b c d e f g h i j", "")], ITEMS)
    docs = documents("a b c d e f g h i j")
    assert D.find(docs.limit(0), bench).count() == 0
    assert D.find(docs, bench.limit(0)).count() == 0 and D.drop(docs, bench.limit(0)).count() == 1


def test_short_items_and_scripts_without_blanks_are_found(documents, spark):
    items = ["Who wrote Faust?", "法国的首都是哪里？", "เมืองหลวงของฝรั่งเศส", "下列哪一项是水的化学式，请选择正确答案。", "où est-il né", "?!"]
    docs = documents("then: who wrote Faust, they ask", "who wrote the Faust", "问题：法国的首都是哪里。", "x" + items[2] + "y", "他问下列哪一项是水的化学式、请选正确答案", "“où est—il né”", "où est il mort", "首都是", "who wrote", None, "")
    bench = spark.createDataFrame([(k, t, "") for k, t in enumerate(items)], ITEMS)
    assert {(r.doc_id, r.item_id) for r in D.find(docs, bench).collect()} == {(0, 0), (2, 1), (3, 2), (4, 3), (5, 4)}
    assert {r.doc_id for r in D.drop(docs, bench).collect()} == {1, 6, 7, 8, 9, 10}


def test_words_of_any_script():
    text = "Ab1 “naïve”—日本語カナ，テスト xกข 한국어 z"
    low = np.frombuffer(text.encode(), np.uint8)
    s, e, row = D.token_spans(low, np.array([0, len(low)]))
    assert [low[a:b].tobytes().decode() for a, b in zip(s, e, strict=True)] == ["Ab1", "naïve", *"日本語カナテスト", "x", "ก", "ข", "한국어", "z"]


def test_stock_phrases_of_templated_items_are_clean(documents, spark):
    capital = [f"what is the capital of the {a} {b}" for a, b in (("French", "Republic"), ("Polish", "Commonwealth"), ("Danish", "Kingdom"), ("Roman", "Empire"))]
    cause = "which of the following is the most likely cause of persistent dry cough"
    passage = " ".join(f"p{i}" for i in range(40))
    rng = random.Random(8)
    rows = [" ".join([*words(rng, 9), phrase, *words(rng, 9)]) for phrase in ["what is the capital of", "which of the following is the most likely cause of"] for _ in range(12)]
    leaks = [capital[0], cause, *[" ".join(passage.split()[:20])] * 15]  # half a passage, however often
    docs = documents(*rows, *[" ".join([*words(rng, 9), x, *words(rng, 9)]) for x in leaks])
    bench = spark.createDataFrame([(k, t, "") for k, t in enumerate([*capital, cause, passage])], ITEMS)
    n = len(rows)
    assert {(r.doc_id, r.item_id) for r in D.find(docs, bench).collect()} == {(n, 0), (n + 1, 4), *((n + 2 + i, 5) for i in range(15))}
    assert {r.doc_id for r in D.drop(docs, bench).collect()} == set(range(n))


@pytest.mark.parametrize("rate", [0.2, 0.25, 0.3, 0.35])
def test_recall_against_full_alignment(documents, spark, rate):
    """Items with words changed at random, inside other texts: found where Smith-Waterman over the whole text finds them."""
    rng = random.Random(int(rate * 100))
    items = [words(rng, rng.choice((10, 14, 20, 35))) for _ in range(150)]
    texts = [[*words(rng, 60), *(rng.choice(words(rng, 1)) if rng.random() < rate else w for w in item), *words(rng, 60)] for item in items]
    docs, bench = documents(*[" ".join(t) for t in texts]), spark.createDataFrame([(k, " ".join(t), "") for k, t in enumerate(items)], ITEMS)
    found = {(r.doc_id, r.item_id) for r in D.find(docs, bench).collect()}
    number = {}
    code = lambda ws: np.array([number.setdefault(w, len(number)) for w in ws], np.uint64)
    full = [k for k, (item, t) in enumerate(zip(items, texts, strict=True)) if D.align(code(item), code(t)) >= D.MIN_SCORE]
    assert len(full) > 50 and sum((k, k) in found for k in full) >= 0.93 * len(full)
    assert all(a == b for a, b in found)
