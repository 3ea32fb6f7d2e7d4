import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from plotwise.llm import fill_middle as M
from plotwise.llm.text import buffer

UNIT = re.compile(r"[A-Za-z]+|[^A-Za-z]", re.DOTALL)


def brute(i, text):
    text = text or ""
    u = UNIT.findall(text)
    x = hashlib.sha256(f"1:{'' if i is None else i}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(x[8 * k : 8 * k + 8], 16) for k in range(4))
    if not text or any(s in text for s in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return i, len(u), "plain", None, None, text
    a, b = sorted((h1 % (len(u) + 1), h2 % (len(u) + 1)))
    p, m, s = "".join(u[:a]), "".join(u[a:b]), "".join(u[b:])
    if h4 % 100 < 20:
        return i, len(u), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return i, len(u), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def texts(n=800):
    rng = random.Random(3)
    alphabet = "aZbzAé語😀 \n\t09_[@`{\x00\x7f<PSM>"
    return ["".join(rng.choice(alphabet) for _ in range(rng.randrange(60))) for _ in range(n)] + \
        ["", None, "a", "a" * 70, "é" * 9, "abcdefgh", "abcdefg", "x<P>y", "<S>", "<M", "<P", "ß" * 500 + "tail", "word " * 3000]


def test_matches_brute_force(documents):
    rows = list(enumerate(texts()))
    got = {r.doc_id: tuple(r) for r in M.transform(documents(*rows)).collect()}
    assert got == {i: brute(i, t) for i, t in rows}
    assert {v[2] for v in got.values()} == {"plain", "psm", "spm"}


def test_restores_every_text(documents):
    rows = list(enumerate(texts(300)))
    got = M.transform(documents(*rows)).select("doc_id", M.restored(F.col("output"), F.col("form")).alias("t")).collect()
    assert {r.doc_id: r.t for r in got} == {i: t or "" for i, t in rows}


@pytest.mark.parametrize("size", range(25))
def test_select_at_word_edges(size):
    text = ("a1" * 20)[:size] + "é" + "b" * size
    n_units = len(UNIT.findall(text))
    k = np.arange(n_units + 1)
    buf, off = buffer(pa.array(["zz"] + [text] * len(k), pa.string()))
    n, one, two, chars, _ = M.cut_bytes(buf, off, np.stack([np.append(0, k), np.append(0, k)]))
    want = ["".join(UNIT.findall(text)[:j]) for j in k]
    assert n[1:].tolist() == [n_units] * len(k)
    assert one[1:].tolist() == two[1:].tolist() == [len(w.encode()) for w in want]
    assert chars[1:].tolist() == [len(w) for w in want]


def test_letters_of_every_byte():
    every = np.arange(256, dtype=np.uint8)
    got = np.frombuffer(M.letters(every.view("<u8")).tobytes(), np.uint8) >> 7
    assert got.tolist() == [int(chr(b).isascii() and chr(b).isalpha()) for b in range(256)]
    cont = np.frombuffer(M.continuations(every.view("<u8")).tobytes(), np.uint8) >> 7
    assert cont.tolist() == [int(0x80 <= b < 0xC0) for b in range(256)]


def test_nulls_repeats_empty_tables_and_other_parameters(documents):
    rows = [(None, "some text here"), (None, None), (4, "one two three four"), (4, "one two three four"), (5, "")]
    df = documents(*rows)
    assert sorted(map(tuple, M.transform(df).collect()), key=repr) == sorted((brute(*r) for r in rows), key=repr)
    clashing = df.withColumnRenamed("lang", "h1").withColumnRenamed("source", "output").withColumnRenamed("n_chars", "form")
    assert M.transform(clashing).count() == 5
    assert M.transform(df.limit(0)).collect() == []
    marks = ("(a|", "b)*", "[c")
    made = M.transform(df, seed="other", fim_percent=100, spm_percent=50, sentinels=marks)
    back = made.select("form", M.restored(F.col("output"), F.col("form"), marks).alias("t")).collect()
    assert sorted(r.t for r in back) == sorted(t or "" for _, t in rows)
