"""Ranked search, benchmark decontamination and spelling variants against brute force."""

from __future__ import annotations

import os
import random
import sys

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import brute  # noqa: E402
import corpus  # noqa: E402

from meterloom.llm import decontaminate, ranked, spelling, terms  # noqa: E402

ITEMS = "item_id bigint, text string, size string, found string, name string, body string"


def bench(spark, rows):
    return spark.createDataFrame([(i, t, "s", "f", "n", "b") for i, t in rows], ITEMS)


def item_rows() -> list[tuple]:
    texts = [t for t in corpus.texts() if t]
    long = max(texts, key=lambda t: len(t.split())).split()
    rows = [
        (7, " ".join(long[100:140])),
        (70, " ".join(long[105:118]).upper() + "!"),
        (8, "one two"),
        (9, "É é"),
        (10, "..."),
        (11, ""),
        (12, None),
        (None, "one two"),
        (13, "na na na na na na na na na na na na"),
        (13, "never seen before"),
        (14, " ".join(texts[10].split()[40:70])),
        (15, "thing " * 12),
    ]
    return [*rows, rows[0]]


@pytest.fixture(scope="module")
def docs(spark):
    return corpus.frame(spark).cache()


@pytest.fixture(scope="module")
def odd(spark):
    """Repeated rows and null ids."""
    rows = [row for row in corpus.rows() if row[0] % 3 == 0]
    return corpus.frame(spark, rows + rows + [(None, *row[1:]) for row in rows]).cache()


@pytest.fixture(scope="module")
def nothing(spark):
    return corpus.frame(spark, [])


def pairs(frame):
    return [(r["doc_id"], r["text"]) for r in frame.collect()]


@pytest.mark.parametrize("term_bytes", [1 << 21, 400])
def test_ranked(spark, docs, odd, nothing, term_bytes):
    items = bench(spark, item_rows())
    for frame in (docs, odd, nothing):
        found = ranked.ranked(frame, items, k=3, term_bytes=term_bytes)
        assert sorted(map(tuple, found.collect())) == brute.ranked(pairs(frame), item_rows(), 3)


def test_ranked_ties_and_no_items(spark, docs):
    rows = [(40 - i, "same words here", None, None, 0, None, "k", "l", "m", "n") for i in range(30)]
    frame = corpus.frame(spark, rows)
    found = ranked.ranked(frame, bench(spark, [(1, "words")]), k=20).collect()
    assert [(r["rank"], r["doc_id"]) for r in sorted(found, key=lambda r: r["rank"])] == [(k + 1, 11 + k) for k in range(20)]
    assert ranked.ranked(docs, bench(spark, [])).collect() == []


@pytest.mark.parametrize("windows", [1 << 20, 200])
@pytest.mark.parametrize("length", [10, 3])
def test_benchmark_hits(spark, docs, odd, nothing, windows, length):
    items = bench(spark, item_rows())
    for frame in (docs, odd, nothing):
        found = decontaminate.marked(frame, items, length, into="hits", windows=windows)
        assert found.columns == [*frame.columns, "hits"]
        rows = found.collect()
        assert len(rows) == frame.count()
        for row in rows:
            n_words, n_hit, held = brute.benchmark_hits(row["text"], item_rows(), length)
            assert (row["hits"]["n_words"], row["hits"]["n_hit"], row["hits"]["items"]) == (n_words, n_hit, held)
            body = (row["text"] or "").encode()
            words = [w for s in row["hits"]["spans"] for w in brute.terms(body[s["start"] : s["end"]].decode())]
            assert len(words) == n_hit


def test_benchmark_hits_verify_collisions(spark, docs, monkeypatch):
    monkeypatch.setattr(decontaminate, "window_hashes", lambda words, length: np.zeros(max(0, len(words) - length + 1), np.uint64))
    tests = decontaminate.item_windows([("1", b"one two three"), ("2", b"two three four")], 3)
    *_, runs, found = decontaminate.Scanner(tests).scan([b"zero one two three", b"two three", b"x two three four y"])
    assert runs == [(1, 4), (7, 10)] and found == [(0, 0), (2, 1)]


def test_decontaminated(spark, docs, odd):
    items = bench(spark, item_rows())
    for frame in (docs, odd):
        clean = decontaminate.decontaminated(frame, items, "documents")
        assert clean.columns == frame.columns
        want = [(i, t) for i, t in pairs(frame) if not brute.benchmark_hits(t, item_rows(), 10)[1]]
        assert sorted(pairs(clean), key=str) == sorted(want, key=str)
        cut = decontaminate.decontaminated(frame, items, "spans")
        assert cut.columns == frame.columns
        before, after = pairs(frame), pairs(cut)
        assert len(before) == len(after)
        for i, text in after:
            assert any(i == j and (text == t or len(text) < len(t)) for j, t in before)
    with pytest.raises(ValueError):
        decontaminate.decontaminated(docs, items, "words")
    one = corpus.frame(spark, [(1, "Keep é this, ONE. Two and one two\nthat", None, None, 0, None, "k", "l", "m", "n")])
    assert pairs(decontaminate.decontaminated(one, items, "spans")) == [(1, "Keep é this,  and \nthat")]


def variant_rows() -> list[tuple]:
    rng = random.Random(3)
    words = ["".join(rng.choices("abcde", k=rng.randint(6, 9))) for _ in range(40)] + ["Überlänge", "ñandúes", "x" * 90, "ab" * 60]
    out = []
    for i in range(60):
        line = []
        for word in rng.choices(words, [1 / (k + 1) for k in range(len(words))], k=80):
            at, kind = rng.randrange(len(word)), rng.randrange(12)
            if kind == 0:
                word = word[:at] + word[at + 1 :]
            elif kind == 1:
                word = word[:at] + rng.choice("abcdeé") + word[at:]
            elif kind == 2:
                word = word[:at] + rng.choice("abcdeé") + word[at + 1 :]
            line.append(word.upper() if kind == 3 else word)
        text = rng.choice([" ", "-", "\n", "1", "ā"]).join(line)
        out.append((None if i % 20 == 7 else i, text, None, None, len(text), None, "k", "l", "m", "n"))
    return [*out, *out[:10]]


@pytest.mark.parametrize("shard_words", [1 << 14, 40, 3])
def test_variants(spark, shard_words):
    frame = corpus.frame(spark, variant_rows())
    found = spelling.variants(frame, shard_words=shard_words)
    assert found.columns == ["word", "n", "n_near", "form", "form_n", "root"]
    rows = found.collect()
    want = brute.spelling([(r[0], r[1]) for r in variant_rows()])
    assert len(rows) == len(want) and len(want) > 200
    assert {r["word"]: tuple(r)[1:] for r in rows} == want


def test_variants_of_awkward_texts(docs, odd, nothing):
    for frame in (docs, odd):
        found = {r["word"]: tuple(r)[1:] for r in spelling.variants(frame).collect()}
        assert found == brute.spelling(pairs(frame))
    assert spelling.variants(nothing).collect() == []


def test_variants_chain(spark):
    """Forms lead over several words to the root."""
    texts = ["abcdefgh " * 2000, "abcdefg " * 200, "abcdefz " * 20, "abcdeyz " * 2]
    frame = corpus.frame(spark, [(3 + i, t, None, None, len(t), None, "k", "l", "m", "n") for i, t in enumerate(texts)])
    found = {r["word"]: (r["form"], r["root"]) for r in spelling.variants(frame).collect()}
    assert found == {w: v[2:5:2] for w, v in brute.spelling(pairs(frame)).items()}
    assert found["abcdeyz"] == ("abcdefz", "abcdefgh")


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text("abé", min_size=7, max_size=45), min_size=2, max_size=30, unique=True), st.integers(1, 8))
def test_near_words(texts, guests):
    words = [text.encode("latin-1") for text in texts]
    home = np.arange(len(words)) >= min(guests, len(words) - 1)
    n = np.arange(len(words)) % 4
    rows = {int(w): (int(c), int(b)) for w, c, b in zip(*spelling.near_words(words, n, home), strict=True)}
    for i, a in enumerate(words):
        near = [j for j, b in enumerate(words) if (home[i] or home[j]) and brute.near_spelling(a, b)]
        best = min(near, key=lambda j: (-n[j], texts[j]), default=None)
        assert rows.get(i) == (None if best is None else (len(near), best))


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text("aZ0é\x80 -\x00", max_size=30), max_size=6))
def test_terms(texts):
    for text in texts:
        line = terms.plain(text.encode())
        assert [w.decode() for w in line.split()] == brute.terms(text)
        starts, ends = terms.term_edges(np.frombuffer(line, np.uint8))
        assert [line[a:b] for a, b in zip(starts, ends, strict=True)] == line.split()
