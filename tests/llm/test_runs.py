"""Periodic runs against a search by every period and place."""

import hashlib
import random
import zlib
from fractions import Fraction

import numpy as np
import pytest
from odd import no_documents, odd_documents, odd_rows, space_words

from sortwell.llm import periodic_runs as P
from sortwell.llm.common import documents


def runs_by_hand(words):
    """All (start, length, period): longest stretches of every period, shorter periods first."""
    ids = P.numbered(words)
    found = {}
    for q in range(1, len(ids) // 3 + 1):
        same = np.concatenate([[False], ids[:-q] == ids[q:], [False]]).astype(np.int8)
        for low, high in zip(np.flatnonzero(np.diff(same) == 1), np.flatnonzero(np.diff(same) == -1)):
            length = int(high - low) + q
            if length >= max(24, 3 * q):
                found.setdefault((int(low), length), q)
    return sorted((s, n, q) for (s, n), q in found.items())


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def report_by_hand(doc_id, text):
    words = space_words(text)
    h = None if doc_id is None else zlib.crc32(str(doc_id).encode())
    if h is not None and h % 10 == 0 and words:
        g, n = h // 10, len(words)
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[a + (i - a) % p] if i >= a else words[i] for i in range(n)]
    runs = sorted(runs_by_hand(words), key=lambda r: (r[0], r[2]))
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
    shown = (None,) * 4 if best is None else (*best, 1000 * best[1] // best[2])
    return (doc_id, len(runs), *shown, digest("".join(f"{s},{n},{q}\n" for s, n, q in runs)),
            digest(" ".join(w for i, w in enumerate(words) if i not in gone)))


def ordered(rows):
    return sorted((tuple(r) for r in rows), key=str)


def tile_runs(words):
    """The operator's own steps on one document, without Spark."""
    spans = {}
    for size, own, part in P.tiles(P.numbered(words)):
        for q, low, high in P.fragments(size, own, part.tolist()):
            spans.setdefault(q, []).append((low, high))
    runs = []
    for q, found in spans.items():
        low, high = None, None
        for a, b in [*sorted(found), (1 << 60, 1 << 60)]:
            if high is not None and a <= high:
                high = max(high, b)
                continue
            if high is not None and high - low + q >= max(24, 3 * q):
                runs.append((low, high - low + q, q))
            low, high = a, b
    return sorted(runs)


def patterns():
    rng = random.Random(5)
    yield ["a"] * 500
    yield list("ab" * 300 + "a" * 200 + "ab" * 40)
    yield list(("a" * 40 + "b") * 30)
    yield [str(i % 97) for i in range(97 * 3)]
    yield [str(i % 97) for i in range(97 * 3 - 1)]
    for _ in range(300):
        words = []
        while len(words) < rng.randrange(400):
            base = [rng.choice("abc") for _ in range(rng.randrange(1, 60))]
            words += base * rng.randrange(1, 9) + base[: rng.randrange(len(base))]
            if rng.random() < 0.2:
                words += words[-rng.randrange(1, 90):] * rng.randrange(1, 5)
        yield words
    for _ in range(100):
        yield [rng.choice("ab" if rng.random() < 0.5 else "aaaaaab") for _ in range(rng.randrange(300))]


def test_tiles_find_every_run():
    for words in patterns():
        assert tile_runs(words) == runs_by_hand(words), words


def test_tiles_of_a_long_text_stay_linear():
    words = ["w"] * 200_000
    found = [f for size, own, part in P.tiles(P.numbered(words)) for f in P.fragments(size, own, part.tolist())
             if size <= 64]
    assert {q for q, _, _ in found} == {1}


def test_no_tile_without_repeats():
    assert not list(P.tiles(np.arange(10_000, dtype=np.int32)))


@pytest.mark.parametrize("make", [odd_documents, no_documents])
def test_report_of_odd_documents(spark, make):
    found = P.run_report(make(spark).select("doc_id", "text"))
    want = [report_by_hand(r[0], r[1]) for r in odd_rows()] if make is odd_documents else []
    assert ordered(found.collect()) == ordered(want)


def test_extra_columns_and_texts_with_runs(spark):
    words = [f"w{i}" for i in range(7)]
    rows = [(1, "x " + " ".join(words * 5) + "\n y", "r"), (1, "x " + " ".join(words * 5) + "\n y", "r"), (None, "z " * 30, "r")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, rid string")
    found = P.periodic_runs(docs)
    assert found.columns == ["id", "n_words", "runs", "collapsed", "collapsed_sha256"]
    got = [(r.id, r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in found.collect()]
    copy = (1, 37, [(1, 35, 7)], "x " + " ".join(words) + " y")
    assert sorted(got, key=str) == sorted([copy, copy, (None, 30, [(0, 30, 1)], "z")], key=str)


def test_report_of_whole_table(spark, sf):
    docs = documents(spark, sf, "doc_id", "text")
    want = [report_by_hand(*r) for r in docs.collect()]
    assert any(r[1] for r in want)
    assert ordered(P.run_report(docs).collect()) == ordered(want)
