"""Secret scans: base patterns, and a password guess-cost programme over credential-context values.

Base kinds (leftmost, non-overlapping per kind; a match whose length falls short is dropped after it was
consumed): ``assign``, ``access``, ``hex``. The method adds kind ``guess``: a value that stands in a
credential context (a wider list of keys than ``assign``) and whose cheapest segmentation into words,
dates, repeats, keyboard walks, sequences and brute-force spans costs at least ``MIN_GUESSES`` (log10).
Template placeholders such as ``${NAME}`` are no values. The value of a base assignment is costed too
(``assign_costs``), and base spans always stay.

Words are ranked: a short fixed list of password words, then the words of the corpus by the number of documents that hold them
(``word_ranks``, over all documents), so what counts as a word follows the texts and their languages.

Offsets are code points, end exclusive; a span is the whole match.

Defined results: null and empty texts have no spans; repeated rows and null ids give one row each; very
long texts and values are scanned whole, in time linear in their length; extra columns are ignored; an empty table gives an
empty result.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plotwise.llm.text import LOWER, buffer, slices, word_spans, words_array

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")
HEX = re.compile(r"[0-9a-f]{16,}")
#: Wider contexts: the key, then a value of at least 8 characters.
CONTEXT = re.compile(r"""\b(pwd|pass|passphrase|password|passwd|passcode|pin_?code|secret|token|api_?key|access_?key|auth|bearer|credentials?|private_?key)["']?\x20*(?:[:=]|\x20is\x20)\x20*["']?([^\s"'<>,;]{8,})""", re.IGNORECASE | re.ASCII)
#: A text without any of these has neither an assignment nor a credential context.
KEYS = ("pass", "pwd", "secret", "token", "apikey", "api_key", "pin_code", "pincode", "accesskey", "access_key", "auth", "bearer", "credential", "privatekey", "private_key")
KINDS = ("assign", "access", "hex", "guess")
MIN_ASSIGN = 12

#: log10 of guesses from which a value counts as a secret.
MIN_GUESSES = 9.0
#: Corpus words that are ranked at most, the fewest documents that hold one, and its least and most letters.
MAX_WORDS, MIN_DOCS, LETTERS = 50_000, 20, (3, 20)
#: Values that stand for others.
PLACEHOLDER = re.compile(r"[$#@%]?\{.*|[$%]\(.*|\$[A-Za-z_]\w*|%\w+%", re.DOTALL)

#: Fixed list of frequent password words, by rank.
COMMON = ("password letmein welcome admin login master dragon monkey qwerty shadow sunshine princess football baseball superman batman trustno iloveyou "
          "secret changeme default guest test user root hello freedom whatever access flower summer winter spring autumn example sample token value "
          "string none null true false your here please enter insert placeholder").split()
WORD_RANK = {w: i + 1 for i, w in enumerate(COMMON)}
MAX_WORD = max(map(len, COMMON))
#: Rows of a keyboard, for walks.
ROWS = ("`1234567890-=", "qwertyuiop[]", "asdfghjkl;'", "zxcvbnm,./")
NEIGHBOURS = {(a, b) for row in ROWS for x, y in zip(row, row[1:], strict=False) for a, b in ((x, y), (y, x))}
LEET = str.maketrans("@4301$5!7", "aaeoissit")
DATE = re.compile(r"(?:19|20)\d\d(?:[-/.]?(?:0[1-9]|1[0-2])(?:[-/.]?(?:0[1-9]|[12]\d|3[01]))?)?|(?:0[1-9]|[12]\d|3[01])[-/.]?(?:0[1-9]|1[0-2])[-/.]?(?:19|20)\d\d")


def _alphabet(ch: str) -> float:
    return math.log10(10 if ch.isdigit() else 26 if ch.isalpha() else 33)


#: Characters of a copy at least; places within a stretch where a segment may start, from its first on.
COPY, INSIDE = 8, 64


def guess_cost(value: str, ranks: dict[str, int] = WORD_RANK) -> float:
    """log10 of the guesses that the cheapest segmentation of ``value`` takes (0 for an empty value).

    best[j] is the least cost of the first j characters over all last segments: a brute-force character,
    a word (rank, times 2 for capitals or substitutes), a date, a repeat of what stands just before,
    a copy of what stands anywhere before, a keyboard walk or a sequence. Each segment also costs the choice of its kind.
    In a long walk, sequence or repeat only starts near its two ends are tried; others cost more. A copy starts at the cheapest place
    of its stretch.
    """
    n = len(value)
    low, plain = value.lower(), value.lower().translate(LEET)
    if len(low) != n:  # some letters change their number of code points
        low = plain = value
    best, choice = [0.0] + [math.inf] * n, math.log10(5)
    walk = run = 1  # lengths of the walk and the run that end at j
    same = [0] * 17  # of each period, how many characters up to j equal those a period before
    seen: dict[str, int] = {}  # where each short piece ended last
    source = size = 0  # the place before which, and how many characters up to j, a copy runs
    starts: deque[int] = deque()  # places where a copy may start, by rising cost
    pushed = 0
    longest = max(map(len, ranks), default=0) if ranks is not WORD_RANK else MAX_WORD
    for j in range(1, n + 1):
        ch = low[j - 1]
        if j > 1:
            a = low[j - 2]
            walk = walk + 1 if (a, ch) in NEIGHBOURS else 1
            run = run + 1 if abs(ord(ch) - ord(a)) == 1 or a == ch else 1
        least = best[j - 1] + _alphabet(value[j - 1])
        for start in range(j - walk, min(j - 2, j - walk + INSIDE)):
            least = min(least, best[start] + choice + math.log10(47 * 2 * (j - start)))
        for start in range(j - run, min(j - 2, j - run + INSIDE)):
            least = min(least, best[start] + choice + _alphabet(low[start]) + math.log10(3 * (j - start)))
        for length in range(LETTERS[0], min(j, longest) + 1):
            rank = ranks.get(plain[j - length : j])
            if rank:
                twists = 0.3 * (value[j - length : j] != low[j - length : j]) + 0.3 * (plain[j - length : j] != low[j - length : j])
                least = min(least, best[j - length] + choice + math.log10(rank + 1) + twists)
        if ch.isdigit():
            for length in (4, 6, 7, 8, 10):
                if j >= length and DATE.fullmatch(value, j - length, j):
                    least = min(least, best[j - length] + choice + math.log10(120 if length == 4 else 365 * 120))
        for unit in range(1, min(16, j - 1) + 1):  # xyzxyz...: the unit, then its count
            same[unit] = same[unit] + 1 if low[j - 1 - unit] == ch else 0
            most = same[unit] // unit + 1
            for times in range(2, most + 1) if most <= INSIDE else (*range(2, 9), *range(most - 7, most + 1)):
                least = min(least, best[j - (times - 1) * unit] + choice + math.log10(times))
        if size and low[source] == ch:
            source, size = source + 1, size + 1
        else:
            size = 0
        if j >= COPY:
            piece = low[j - COPY : j]
            if not size and piece in seen:
                source, size = seen[piece], COPY
            seen[piece] = j
            while pushed <= j - COPY:
                while starts and best[starts[-1]] >= best[pushed]:
                    starts.pop()
                starts.append(pushed)
                pushed += 1
            if size:
                while starts and starts[0] < j - size:
                    starts.popleft()
                if starts:  # the copy's place and its length
                    length = j - starts[0]
                    least = min(least, best[starts[0]] + choice + math.log10(1 + source - length) + math.log10(length))
        best[j] = least
    return best[n]


def _word_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(word, n): documents that hold each word, summed over the slices of a batch."""
    letters = np.zeros(256, bool)
    letters[97:123] = True
    for b in slices(batches, limit=8 << 20):
        buf, off = buffer(b.column("text"))
        low = LOWER[buf]
        start, end, row = word_spans(low, off, letters)
        coded = words_array(low, start, end, letters).dictionary_encode()
        use = (end - start >= LETTERS[0]) & (end - start <= LETTERS[1])
        pairs = np.unique(row[use] * max(len(coded.dictionary), 1) + coded.indices.to_numpy()[use].astype(np.int64))
        n = np.bincount(pairs % max(len(coded.dictionary), 1), minlength=len(coded.dictionary))
        some = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([coded.dictionary.take(pa.array(some)).cast(pa.string()), pa.array(n[some])], ["word", "n"])


def word_ranks(docs: DataFrame, most: int = MAX_WORDS, min_docs: int = MIN_DOCS) -> dict[str, int]:
    """Ranks of words of a-z: the fixed list, then those of the most documents (at most ``most``)."""
    counted = docs.select("text").mapInArrow(_word_rows, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    out = dict(WORD_RANK)
    for r in counted.filter(F.col("n") >= min_docs).orderBy(F.desc("n"), "word").limit(most).collect():
        out.setdefault(r["word"], len(out) + 1)
    return out


def spans(text: str | None, min_guesses: float = MIN_GUESSES, ranks: dict[str, int] = WORD_RANK) -> list[tuple[int, int, str]]:
    """(start, end, kind), ordered by start, then by kind as listed."""
    if not text:
        return []
    out = [(m.start(), m.end(), "hex") for m in HEX.finditer(text)]
    if "AKIA" in text:
        out += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text)]
    low = text.lower()
    if any(k in low for k in KEYS):
        base = [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if len(m.group(2)) >= MIN_ASSIGN]
        out += base
        ends = {e for _, e, _ in base}
        for m in CONTEXT.finditer(text):
            if m.end() not in ends and not PLACEHOLDER.fullmatch(m.group(2)) and guess_cost(m.group(2), ranks) >= min_guesses:
                out.append((*m.span(), "guess"))
    return sorted(out, key=lambda x: (x[0], KINDS.index(x[2])))


def assign_costs(text: str | None, ranks: dict[str, int] = WORD_RANK) -> list[float]:
    """Guess cost of the value of every base assignment."""
    return [guess_cost(m.group(2), ranks) for m in ASSIGN.finditer(text or "") if len(m.group(2)) >= MIN_ASSIGN]


def _joined(found: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{k}:{s}:{e}" for s, e, k in found)


def scan(docs: DataFrame, min_guesses: float = MIN_GUESSES) -> DataFrame:
    """doc_id, counts by kind, the base digest and all spans, one row per row of ``docs``."""
    # at most MAX_WORDS words
    ranks = docs.sparkSession.sparkContext.broadcast(word_ranks(docs))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            found = [spans(t, min_guesses, ranks.value) for t in b.column("text").to_pylist()]
            base = [[x for x in f if x[2] != "guess"] for f in found]
            count = {k: pa.array([sum(x[2] == k for x in f) for f in found], pa.int64()) for k in KINDS}
            digest = pa.array([hashlib.sha256(_joined(f).encode()).hexdigest() for f in base])
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), *count.values(), digest, pa.array([_joined(f) for f in found])], ["doc_id", "n_assign", "n_access", "n_hex", "n_guess", "base_sha256", "spans"])

    return docs.select("doc_id", "text").mapInArrow(rows, "doc_id long, n_assign long, n_access long, n_hex long, n_guess long, base_sha256 string, spans string")
