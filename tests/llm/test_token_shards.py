import collections
import os

import numpy as np
import pytest

from plotwise.llm import token_shards as T

pytestmark = pytest.mark.skipif(not os.path.exists(T.VOCABULARY), reason="no vocabulary file")


@pytest.fixture(scope="module")
def encoder():
    with open(T.VOCABULARY, "rb") as f:
        return T.Encoder(f.read())


TEXTS = ["", None, "a  b\n\nc d\n e \t f g  \n x1²3 .,!? \n", " ", "\n", "it's we'll 'quoted'", "日本語 text", "naïve größe ñandú 12½", "a b\xa0 c\x1cd", "x " * 5000, "  ..a1 1a"]


def test_ids_equal_those_of_the_whole_text(encoder):
    ids, off = encoder.encode(TEXTS)
    for i, t in enumerate(TEXTS):
        assert ids[off[i] : off[i + 1]].tolist() == encoder.bpe.encode_ordinary(t or "")


def test_crafted_pieces_are_told_apart(encoder):
    # Thue-Morse words, alike in every position sum
    bits = [bin(i).count("1") % 2 for i in range(4096)]
    words = ["".join(ab[k] for k in bits[:m]) for m in (1024, 2048, 4096) for ab in ("ab", "ba")]
    texts = [" ".join(words), *words]
    ids, off = encoder.encode(texts)
    for i, t in enumerate(texts):
        assert ids[off[i] : off[i + 1]].tolist() == encoder.bpe.encode_ordinary(t)


@pytest.mark.parametrize("n", [1, 2, 3, 5, 64, 65, 1000, 4097])
def test_permutation(n):
    a, b = T.permute(np.arange(n), n, "k"), T.permute(np.arange(n), n, "other")
    assert sorted(a.tolist()) == list(range(n)) and (n < 64 or a.tolist() != b.tolist())
    assert n < 1000 or abs(np.corrcoef(np.arange(n), a)[0, 1]) < 0.1


def test_round_trip(documents, encoder, tmp_path):
    docs = documents(*[(i, t) for i, t in enumerate(TEXTS)], (None, "no id"), *[(100 + i, f"text number {i} " * (i % 40)) for i in range(200)]).repartition(5)
    folder = str(tmp_path / "shards")
    rows = T.materialise(docs, folder, sequence=32, shard_slots=50).collect()
    assert sorted(r.slot for r in rows) == list(range(len(rows)))
    ids = T.read_slots(folder, 0, len(rows), 32, 50)
    assert np.array_equal(T.read_slots(folder, 45, 20, 32, 50), ids[45:65])
    parts = collections.defaultdict(dict)
    for r in rows:
        assert (r.shard, r.byte_offset) == (r.slot // 50, r.slot % 50 * 64)
        assert sum(d.n for d in r.docs) == r.n_tokens and all(ids[r.slot][r.n_tokens :] == T.END)
        for d in r.docs:
            parts[d.doc_id][d.token] = ids[r.slot][d.at : d.at + d.n]
    for r in docs.collect():
        whole = np.concatenate([parts[r.doc_id][k] for k in sorted(parts[r.doc_id])]).tolist()
        assert whole == [*encoder.bpe.encode_ordinary(r.text or ""), T.END]


def test_repeated_rows_and_empty_table(documents, tmp_path):
    docs = documents((1, "same text"), (1, "same text"))
    rows = T.materialise(docs.coalesce(1), str(tmp_path / "a"), sequence=64).collect()
    assert len(rows) == 1 and [d.doc_id for d in rows[0].docs] in ([1], [1, 1])
    assert T.materialise(docs.limit(0), str(tmp_path / "b")).count() == 0


def test_production_sizes():
    assert T.SEQUENCE == 2048 and T.SHARD_SLOTS * T.SEQUENCE * 2 == 64 << 20
