import hashlib
import math
import random
import re

import pytest

from plotwise.llm import secret_scan as S

BASE = {
    "assign": re.compile(r"""([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""),
    "access": re.compile("AKIA[A-Z0-9]+"),
    "hex": re.compile("[0-9a-f]+"),
}


def brute(text):
    found = []
    for k, kind in enumerate(("assign", "access", "hex")):
        for m in BASE[kind].finditer(text or ""):
            if (kind == "assign" and len(m[2]) >= 12) or (kind == "access" and len(m[0]) >= 18) or (kind == "hex" and len(m[0]) >= 16):
                found.append((m.start(), k, f"{kind}:{m.start()}:{m.end()}"))
    return [x for *_, x in sorted(found)]


def random_texts(n=300):
    rng = random.Random(2)
    parts = ["password", "PassWd", "secret", "toKen", "ſecret", "token", "api_key", "ApiKey", "=", ":", " ", '"', "'", "AKIA", "ABCDEFGHIJKLMN", "deadbeef", "0123456789abcdef", "é", "\n", "x.y-z", "hunter22hunter22", "0", "pwd"]
    return ["".join(rng.choice(parts) for _ in range(rng.randint(0, 25))) for _ in range(n)]


def test_base_spans_match_the_patterns(documents):
    texts = random_texts() + [None, "", "token=secret: abcdefghijklmnop", "password= short password=longenough12", "AKIA" + "A" * 13, "AKIA" + "A" * 14, "f" * 15, "f" * 16]
    got = {r.doc_id: r for r in S.scan(documents(*texts)).collect()}
    for i, t in enumerate(texts):
        want = brute(t)
        assert got[i].base_sha256 == hashlib.sha256(",".join(want).encode()).hexdigest()
        assert [x for x in got[i].spans.split(",") if x and not x.startswith("guess")] == want
        for kind in ("assign", "access", "hex"):
            assert got[i][f"n_{kind}"] == sum(x.startswith(kind) for x in want)


@pytest.mark.parametrize("weak,strong", [("password1", "vT9#qLx2w"), ("qwertyuiop", "q7Wm!zR4tk"), ("2019-05-11", "8f-K2-0aZq"), ("aaaaaaaaaaaa", "a8Kd0qPz1mXv"), ("abcabcabcabc", "zq8Lm3Rt9WxP"), ("letmein123", "J4x9!Lm2Qz")])
def test_guess_cost_orders_values(weak, strong):
    assert S.guess_cost(weak) < S.MIN_GUESSES <= S.guess_cost(strong)


def brute_cost(value, ranks=S.WORD_RANK):
    """Every segment of every kind, listed first; then the cheapest way through them."""
    n, low = len(value), value.lower()
    plain, choice = low.translate(S.LEET), math.log10(5)
    edges = [(i, i + 1, S._alphabet(value[i]), None) for i in range(n)]
    for i in range(n):
        for j in range(i + 1, n + 1):
            part, kind = low[i:j], S.DATE.fullmatch(value, i, j)
            if kind:
                edges.append((i, j, choice + math.log10(120 if j - i == 4 else 365 * 120), None))
            if 3 <= j - i <= 20 and plain[i:j] in ranks:
                edges.append((i, j, choice + math.log10(ranks[plain[i:j]] + 1) + 0.3 * (value[i:j] != part) + 0.3 * (plain[i:j] != part), None))
            steps = list(zip(part, part[1:]))
            if j - i >= 3 and all(s in S.NEIGHBOURS for s in steps):
                edges.append((i, j, choice + math.log10(47 * 2 * (j - i)), None))
            if j - i >= 3 and all(abs(ord(a) - ord(b)) <= 1 for a, b in steps):
                edges.append((i, j, choice + S._alphabet(part[0]) + math.log10(3 * (j - i)), None))
            for unit in range(1, 17):
                if (j - i) % unit == 0 and (j - i) // unit >= 2 and part == part[:unit] * ((j - i) // unit):
                    edges.append((i, j, choice + math.log10((j - i) // unit), i + unit))  # the unit is paid for as it is
    best = [0.0] + [math.inf] * n
    for j in range(1, n + 1):
        best[j] = min(best[i if via is None else via] + c for i, k, c, via in edges if k == j)
    return best[n]


def test_cost_is_the_least_over_segmentations():
    rng = random.Random(4)
    parts = ["password", "P@ssw0rd", "dragon", "qwerty", "zxcv", "1234", "aaaa", "2019", "20190511", "k", "Z", "7", "#", "abab", "xyzxyz", "mon"]
    values = ["".join(rng.choice(parts) for _ in range(rng.randint(1, 4))) for _ in range(250)]
    for v in values:
        if len({v[i : i + 8].lower() for i in range(len(v) - 7)}) == max(0, len(v) - 7):  # without copies
            assert S.guess_cost(v) == pytest.approx(brute_cost(v)), v
        else:
            assert S.guess_cost(v) <= brute_cost(v) + 1e-9
    assert S.guess_cost("") == 0


def test_long_values():
    rng = random.Random(5)
    noise = "".join(rng.choice("abcdefghijkmnpqrstuvwxyz23456789") for _ in range(5000))
    assert S.guess_cost(noise) > 1000
    for weak in ("*" * 200, "*" * 100_000, "x" * 129, "=-" * 3000, "passwordletmeinadmin" * 500, "1234567890" * 80):
        assert S.guess_cost(weak) < S.MIN_GUESSES, weak[:30]
    unit = noise[:40]
    assert S.guess_cost(unit * 50) < S.guess_cost(unit) + 6  # a copy of what stood before


def test_masks_and_placeholders_are_no_secrets(documents):
    texts = ["password: " + "*" * n for n in (100, 128, 129, 200)] + ["pwd: " + "x" * 300, "secret=${SOME_LONG_VARIABLE}", "token: {{ vault.path.to.it }}", "pwd=$DB_PASSWORD_X", "auth: %PASSWORD_OF_USER%", "pwd: $(cat_the_file)"]
    assert {r.spans for r in S.scan(documents(*texts)).collect()} == {""}


def test_planted_values_against_words_of_the_corpus(documents):
    rng = random.Random(6)
    vocabulary = ["".join(rng.choice("bcdfgklmnprst") + rng.choice("aeiou") for _ in range(rng.randint(2, 4))) for _ in range(300)]
    texts = [" ".join(rng.choice(vocabulary) for _ in range(60)) for _ in range(150)]
    weak = [rng.choice(vocabulary) + rng.choice(vocabulary).title() + rng.choice(("", "1", "77")) for _ in range(60)]
    strong = ["".join(rng.choice("ABCDEFGHJKLMNPQRSTUVWXYZabcdefghijkmnpqrstuvwxyz23456789!#%&") for _ in range(rng.randint(12, 24))) for _ in range(60)]
    docs = documents(*texts, *[f"pwd: {w if len(w) >= 8 else w + 'aaaaaaaa'} end" for w in weak], *[f"passphrase is {v} end" for v in strong])
    found = {r.doc_id: "guess" in r.spans for r in S.scan(docs).collect()}
    assert sum(found[150 + i] for i in range(60)) <= 3 and sum(found[210 + i] for i in range(60)) >= 58
    # without the corpus the same words look like noise
    assert sum(S.guess_cost(w) >= S.MIN_GUESSES for w in weak) > 20


def test_method_adds_spans_only_in_credential_contexts(documents):
    docs = documents("pwd: vT9#qLx2wq", "pwd: password1", "code vT9#qLx2wq", "auth=Zk3!9fQw&x and on", "the word is long", None)
    got = {r.doc_id: r.spans for r in S.scan(docs).collect()}
    assert got[0].startswith("guess:0:") and got[3].startswith("guess:0:") and [got[i] for i in (1, 2, 4, 5)] == [""] * 4
    assert S.scan(docs.limit(0)).count() == 0
