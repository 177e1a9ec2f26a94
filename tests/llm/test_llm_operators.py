"""Each operator against its brute-force version on awkward documents."""

from __future__ import annotations

import os
import random
import sys
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import brute  # noqa: E402
import corpus  # noqa: E402

from meterloom.llm import (  # noqa: E402
    langid,
    linededup,
    mixing,
    nearest,
    overlap,
    packing,
    pages,
    quality,
    suffix,
    tokens,
)

BYTES, WORDS = (public_tokenizers.path(f) for f in ("byte_bpe_50k.json", "word_bpe_49k.json"))


@pytest.fixture(scope="module")
def docs(spark):
    return corpus.frame(spark).cache()


@pytest.fixture(scope="module")
def nothing(spark):
    return corpus.frame(spark, [])


@pytest.fixture(scope="module")
def twice(spark):
    """Repeated rows and null ids."""
    rows = [row for row in corpus.rows() if row[0] % 3 == 0]
    return corpus.frame(spark, rows + rows + [(None, *row[1:]) for row in rows])


ALL = {
    "language": lambda d: langid.identified(d, into="found"),
    "quality": quality.judged,
    "bytes": suffix.without_repeats,
    "tokens": lambda d: tokens.token_counts(d, BYTES),
    "overlap": overlap.near_components,
    "lines": linededup.line_report,
    "packing": lambda d: packing.packed(d, WORDS, size=64),
    "mix": mixing.plan_mix,
}


@pytest.mark.parametrize("name", ALL)
def test_empty_table(nothing, name):
    assert ALL[name](nothing).collect() == []


@pytest.mark.parametrize("name", [n for n in ALL if n != "packing"])
def test_repeated_rows_and_null_ids(twice, name):
    found = ALL[name](twice).collect()
    assert len(found) == twice.count()
    by_id = {}
    for row in found:
        if row["doc_id"] is not None:
            assert by_id.setdefault(row["doc_id"], row) == row


def test_stages_keep_columns_and_rows(docs, nothing, twice):
    for stage in (linededup.without_repeats, overlap.one_of_each, mixing.mixed):
        for table in (docs, nothing, twice):
            assert stage(table).columns == table.columns
            assert stage(table).count() >= 0


def test_one_of_each_by_rows(spark):
    """Ids that are missing or occur twice: one row of each group stays, and no other text goes."""
    rng = random.Random(9)
    a, b = corpus.prose(rng, 60), corpus.prose(rng, 60)
    rows = [(1, a), (5, a), (5, b), (None, a), (7, a), (1, a), (None, "no other"), (3, ""), (3, None)]
    frame = corpus.frame(spark, [(i, t, None, None, k, None, "k", "l", "m", "n") for k, (i, t) in enumerate(rows)])
    found = [(r["doc_id"], r["text"]) for r in overlap.one_of_each(frame).collect()]
    assert sorted(found, key=str) == sorted([(1, a), (5, b), (None, "no other"), (3, ""), (3, None)], key=str)


@pytest.mark.parametrize("percent", [80, 90, 91, 97])
def test_linked_rows_meet(percent):
    """Every pair over the threshold, as unlike as it may be, has a column of its front in common."""
    rng, none = np.random.default_rng(percent), np.zeros(0, np.uint64)
    met = 0
    for size in [*range(10, 60), *range(60, 1000, 13), *range(1000, 6000, 700)]:
        x = np.unique(rng.integers(0, 1 << 64, size, dtype=np.uint64))
        for lost in {0, rng.integers(0, size), size} if size < 60 else {0, rng.integers(0, size)}:
            lost = min(int(lost), size - -(-percent * size // 100))
            common = np.delete(x, rng.choice(size, lost, replace=False))
            more = 100 * len(common) // percent - size
            y = np.unique(np.concatenate([common, rng.integers(0, 1 << 64, max(0, more), dtype=np.uint64)]))
            assert 100 * len(common) >= percent * len(np.union1d(x, y))
            if len(np.union1d(x, y)) > len(common):
                met += 1
                assert len(np.intersect1d(overlap.front(x, percent, none, none), overlap.front(y, percent, none, none)))
    assert met > 100


def test_single_shingles_in_common_move_no_sets(spark, monkeypatch):
    """Texts of few words have many shingles in common; only copies are sent to be multiplied."""
    sent = []
    full_sets = overlap.full_sets
    monkeypatch.setattr(overlap, "full_sets", lambda docs, n: sent.append(docs.count()) or full_sets(docs, n))
    rng = random.Random(3)
    texts = [[f"w{rng.randrange(40)}" for _ in range(150)] for _ in range(400)]
    for i in range(0, 20, 2):
        texts[i + 1] = [*texts[i][:70], "changed", *texts[i][71:]]
    texts = [" ".join(words) for words in texts]
    data = [(i, t, None, None, i, None, "k", "l", "m", "n") for i, t in enumerate(texts)]
    found = overlap.near_components(corpus.frame(spark, data), 3, 90).collect()
    want = brute.near_components(list(enumerate(texts)), 3, 90)
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in found} == want
    assert len({c for _, c in want.values()}) == 390
    assert 20 <= sent[0] < 100


@pytest.mark.parametrize("rows,tile", [(40, 512), (40, 5), (300, 64)])
def test_tiles_of_a_dense_group(spark, monkeypatch, rows, tile):
    """A group of alike texts, linked or not, in several tiles, against brute force."""
    monkeypatch.setattr(overlap, "TILE_ROWS", tile)
    rng = random.Random(rows)
    base = corpus.prose(rng, 70).split()
    texts = []
    for _ in range(rows):
        words = list(base)
        for _ in range(rng.randint(0, 5)):
            words[rng.randrange(len(words))] = corpus.prose(rng, 1)
        texts.append(" ".join(words))
    data = [(i, t, None, None, i, None, "k", "l", "m", "n") for i, t in enumerate(texts)]
    found = overlap.near_components(corpus.frame(spark, data), 3, 90).collect()
    want = brute.near_components(list(enumerate(texts)), 3, 90)
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in found} == want
    assert len({c for _, c in want.values()}) > 3


def test_block_links_is_a_forest():
    rng = np.random.default_rng(4)
    sets = [np.unique(rng.integers(0, 40, 30).astype(np.uint64)) for _ in range(50)]
    components = rng.integers(0, 12, 50)
    found = overlap.block_links(sets, components, 50)
    links = [
        (i, j)
        for i in range(50)
        for j in range(i)
        if components[i] != components[j]
        and 100 * len(np.intersect1d(sets[i], sets[j])) >= 50 * len(np.union1d(sets[i], sets[j]))
    ]

    def roots(pairs):
        parent = list(range(50))

        def root(k):
            while parent[k] != k:
                k = parent[k]
            return k

        for x, y in pairs:
            x, y = root(x), root(y)
            parent[max(x, y)] = min(x, y)
        return [root(k) for k in range(50)]

    assert roots(found) == roots(links) and len(found) == 50 - len(set(roots(links)))


def test_language_learns_and_predicts(docs):
    found = {r["doc_id"]: r["found"] for r in langid.identified(docs, into="found").collect()}
    for i, text in enumerate(corpus.texts()):
        lang, score = found[i + 1]["lang"], found[i + 1]["score"]
        assert 0 <= score <= 1
        if not any(c.isalpha() for c in text or ""):
            assert (lang, score) == ("und", 0.0)
    clear = [i + 1 for i, t in enumerate(corpus.texts()) if t and len(t) > 200 and "sch" in t]
    assert clear and all(found[i]["lang"] == "de" for i in clear)


def test_language_without_labels(docs):
    found = langid.identified(docs.withColumn("lang", F.lit(None).cast("string")), into="found")
    assert {r["found"]["lang"] for r in found.collect()} == {"und"}


def test_language_grams_do_not_depend_on_pieces(monkeypatch):
    text = "Über  die, 12 Wörter -- und so"
    whole = Counter(np.concatenate(list(langid.grams(text))).tolist())
    for piece in (1, 2, 3, 7, len(text)):
        monkeypatch.setattr(langid, "PIECE", piece)
        assert Counter(np.concatenate(list(langid.grams(text))).tolist()) == whole


def test_quality_figures(docs):
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    for row in quality.judged(docs).collect():
        text = corpus.texts()[row["doc_id"] - 1]
        want = brute.quality(text)
        assert tuple(row[n] for n in names) == want, text
        assert row["base_failed"] == (want[0] < 20 or 100 * want[4] > 30 * want[0])
        assert not (row["base_failed"] and row["kept"])


def test_em_finds_the_better_rule():
    # Rule 0 is right, rule 1 mostly, rule 2 votes at random.
    patterns = [((1, 1, 1), 400), ((1, 1, -1), 390), ((1, -1, 1), 40), ((-1, -1, 1), 90), ((-1, -1, -1), 80)]
    found = quality.estimate(patterns, 3)
    assert 0.7 < found.prior < 0.95
    _, weights = found.evidence()
    assert weights[0][1] < weights[1][1] < weights[2][1] <= 0
    assert min(weights[0][0], weights[1][0]) > 1 > weights[2][0] >= 0


@pytest.mark.parametrize("length,gram", [(400, 100), (60, 20)])
def test_repeated_bytes(docs, length, gram):
    want = brute.repeated_bytes(corpus.texts(), length)
    found = suffix.without_repeats(docs, length, gram)
    for row in found.collect():
        assert tuple(row)[1:] == want[row["doc_id"] - 1], corpus.texts()[row["doc_id"] - 1]


def test_runs_do_not_depend_on_pieces(monkeypatch):
    rng = np.random.default_rng(3)
    data = rng.integers(97, 100, 5000).astype(np.uint8)
    starts = lambda runs: {i: a for f, e, a in zip(*runs, strict=True) for i in range(f, e + 1)}
    whole = starts(suffix.all_runs(data, 60, 20))
    assert set(whole) == set(range(len(data) - 59))
    for piece in (100, 777, 5000):
        monkeypatch.setattr(suffix, "PIECE", piece)
        assert starts(suffix.all_runs(data, 60, 20)) == whole


def test_token_counts(docs):
    tokenizer = Tokenizer.from_file(BYTES)
    for common in (1, 50, 1 << 18):
        for row in tokens.token_counts(docs, BYTES, limit=30, common=common).collect():
            text = corpus.texts()[row["doc_id"] - 1] or ""
            n = len(tokenizer.encode(text, add_special_tokens=False))
            assert tuple(row)[1:] == (len(text.encode()), n, n > 30), text


@pytest.mark.parametrize("text", ["a  b", "a   b", "a \n \n b", "a\n \nb", " \n x", "x \n", "\x1c \x1c a", "a \t b\n\n", "  ", "\n a"])
def test_units_tokenize_as_the_whole(text):
    tokenizer = Tokenizer.from_file(BYTES)
    ids = [i for unit in tokens.units(text) for i in tokenizer.encode(unit, add_special_tokens=False).ids]
    assert "".join(tokens.units(text)) == text
    assert ids == tokenizer.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("n,percent", [(5, 80), (3, 90), (1, 50)])
def test_near_components(docs, n, percent):
    want = brute.near_components([(r[0], r[1]) for r in corpus.rows()], n, percent)
    found = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in overlap.near_components(docs, n, percent).collect()}
    assert found == want


def test_near_components_of_a_drifting_group(spark):
    """A chain of edits: neighbours link, hubs link only with some, so pairs remain."""
    words = [f"w{i}" for i in range(200)]
    rows = []
    for i in range(60):
        words[3 * i + 1] = f"e{i}"
        rows.append((100 - i, " ".join(words), "en", "s", 0, None, None, None, None, None))
    want = brute.near_components([(r[0], r[1]) for r in rows], 3, 90)
    found = overlap.near_components(corpus.frame(spark, rows), 3, 90).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in found} == want


def test_one_of_each_keeps_the_smallest(docs):
    want = brute.near_components([(r[0], r[1]) for r in corpus.rows()], 5, 80)
    kept = {r["doc_id"] for r in overlap.one_of_each(docs).collect()}
    assert kept == {i for i, (_, component) in want.items() if i == component}


@pytest.mark.parametrize("batches,fanout", [(1, 2), (4, 4), (5, 2)])
def test_repeated_lines(docs, batches, fanout):
    want = brute.repeated_lines([(r[0], r[1]) for r in corpus.rows()])
    for row in linededup.line_report(docs, batches=batches, fanout=fanout).collect():
        lines, dropped, text = want[row["doc_id"]]
        assert tuple(row)[1:] == (lines, dropped, brute.sha(text.encode()))
    for row in linededup.without_repeats(docs, batches=batches, fanout=fanout).collect():
        text = corpus.texts()[row["doc_id"] - 1]
        assert row["text"] == (None if text is None else want[row["doc_id"]][2])


def test_line_runs_are_levelled(spark):
    runs = linededup.LineRuns(spark, fanout=2)
    for batch in range(5):
        keys = spark.createDataFrame([(batch, bytearray([k])) for k in range(batch, batch + 3)], "doc_id bigint, key binary")
        fresh = {bytes(r["key"])[0]: r["fresh"] for r in runs.add(keys).collect()}
        assert fresh == {k: batch == 0 or k == batch + 2 for k in range(batch, batch + 3)}
    assert [len(level) for level in runs.levels] == [1, 0, 1]
    totals = {bytes(r["key"])[0]: (r["docs"], r["largest"]) for r in runs.totals().collect()}
    assert totals == {0: (1, 0), 1: (2, 1), 2: (3, 2), 3: (3, 3), 4: (3, 4), 5: (2, 4), 6: (1, 4)}


def test_line_totals_rest_on_the_anti_join(spark):
    runs = linededup.LineRuns(spark, fanout=2)
    for batch in range(4):
        keys = spark.createDataFrame([(batch, bytearray([k])) for k in (0, batch + 1)], "doc_id bigint, key binary")
        runs.add(keys)
        every = runs._every(runs.runs)
        assert every.where("fresh").groupBy("key").count().where("count > 1").isEmpty()
    # What three later batches added to key 0 is one row of a merged run.
    assert every.where("NOT fresh").count() <= 2
    assert {bytes(r["key"])[0]: r["docs"] for r in runs.totals().collect()} == {0: 4, 1: 1, 2: 1, 3: 1, 4: 1}
    runs.close()


def test_hot_lines_lose_the_same_rows(spark, monkeypatch):
    lines = spark.createDataFrame([(d, bytearray([k])) for k in range(5) for d in range(3 + 20 * k)], "doc_id bigint, key binary")
    repeated = lines.groupBy("key").agg(F.count("*").alias("docs"), F.max("doc_id").alias("largest"))
    want = {(d, k) for k in range(5) for d in range(2 + 20 * k)}
    for hot in (1, 3, 4096):
        monkeypatch.setattr(linededup, "HOT", hot)
        found = [(r["doc_id"], bytes(r["key"])[0]) for r in linededup.holders(lines, repeated, lines.count()).collect()]
        assert len(found) == len(want) and set(found) == want


def test_mix_without_ids_comes_near_its_target(spark):
    rows = [(None, f"word{i} and three more", "ab"[i % 2]) for i in range(1_000)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    got = mixing.plan_mix(docs).groupBy("target").agg(F.sum("taken").alias("taken"))
    assert len(got.collect()) == 2 and all(abs(r["taken"] - r["target"]) <= 4 for r in got.collect())
    assert mixing.mixed(docs).count() * 4 == got.agg(F.sum("taken")).first()[0]


@pytest.mark.parametrize("size", [16, 2048])
def test_packing_round_trip(docs, size, monkeypatch):
    tokenizer = Tokenizer.from_file(WORDS)
    ids = {r[0]: np.array([*tokenizer.encode(r[1] or "", add_special_tokens=False).ids, 1], np.uint32) for r in corpus.rows()}
    found = packing.packed(docs, WORDS, size=size).collect()
    covered = Counter()
    for r in found:
        piece = ids[r["doc_id"]][r["start"] : r["start"] + r["length"]]
        assert len(piece) == r["length"] and zlib.crc32(piece.astype("<u4").tobytes()) == r["ids_crc32"]
        assert r["doc_tokens"] == len(ids[r["doc_id"]])
        covered.update((r["doc_id"], r["start"] + k) for k in range(r["length"]))
    assert set(covered.values()) == {1} and len(covered) == sum(map(len, ids.values()))
    sequences = {}
    for r in sorted(found, key=lambda r: (r["sequence_id"], r["offset"])):
        assert r["offset"] == sequences.get(r["sequence_id"], 0)
        sequences[r["sequence_id"]] = r["offset"] + r["length"]
    assert all(n == size or n & (n - 1) == 0 for n in sequences.values())


def test_packing_with_few_open_windows(monkeypatch):
    monkeypatch.setattr(packing, "OPEN", 3)
    rng = np.random.default_rng(1)
    packer = packing.SumOfSquares(64)
    total = 0
    for i, n in enumerate(rng.integers(1, 150, 300)):
        packer.add(packing.Piece(i, 0, np.arange(n, dtype=np.uint32), int(n)))
        total += int(n)
        assert packer.counts.sum() <= 3
    packer.finish()
    fills = [sum(len(p.ids) for p in w.pieces) for w in packer.done]
    assert sum(fills) == total and all(f == 64 or f & (f - 1) == 0 for f in fills)
    assert sum(f < 64 for f in fills) <= 6


def test_sum_of_squares_choice():
    packer = packing.SumOfSquares(10)
    for n in (6, 6, 6, 4):
        packer.add(packing.Piece(0, 0, np.zeros(n, np.uint32), n))
    # Filling one of three equal levels lowers the sum most.
    assert packer.counts[6] == 2 and packer.counts[4] == 0 and len(packer.done) == 1


def test_mix_hits_targets(docs):
    rows = mixing.plan_mix(docs).collect()
    sources = {r[0]: r[3] for r in corpus.rows()}
    sizes, taken, target, biggest = Counter(), Counter(), {}, Counter()
    for r in rows:
        s = sources[r["doc_id"]]
        assert r["size"] == len(brute.words(corpus.texts()[r["doc_id"] - 1]))
        assert r["taken"] <= 3 * r["size"] and (r["size"] == 0 or r["taken"] % r["size"] == 0)
        sizes[s] += r["size"]
        taken[s] += r["taken"]
        target[s] = r["target"]
        biggest[s] = max(biggest[s], r["size"])
    assert sum(target.values()) == pytest.approx(sum(sizes.values()))
    for s in target:
        assert target[s] <= 3 * sizes[s] + 1e-9
        assert abs(taken[s] - target[s]) <= biggest[s] / 2 + 1e-9
    assert sorted(map(tuple, rows), key=str) == sorted(map(tuple, mixing.plan_mix(docs.repartition(5)).collect()), key=str)


def test_mixed_repeats_rows_as_planned(docs):
    plan = {r["doc_id"]: r["taken"] for r in mixing.plan_mix(docs).collect()}
    seen = Counter(r["doc_id"] for r in mixing.mixed(docs).collect())
    for i, text in enumerate(corpus.texts()):
        assert len(brute.words(text)) * seen[i + 1] == plan[i + 1]


@pytest.mark.parametrize("shard_rows,block_rows", [(1000, 1000), (40, 2), (7, 3)])
def test_top_products(spark, shard_rows, block_rows, monkeypatch):
    monkeypatch.setattr(nearest, "LEAF", 4)
    rng = np.random.default_rng(2)
    vectors = [(int(i), [float(x) for x in rng.normal(size=6)]) for i in range(150)]
    vectors += [(200 + i, [0.5] * 6) for i in range(60)]  # Ties.
    bad = [(300, None), (400, [0.1, None, 1.0, 1.0, 1.0, 1.0]), (500, [float("nan")] * 6), (600, [float("inf")] * 6), (None, [1.0] * 6), (700, [])]
    short = [(800, [1.0, 2.0]), (801, [2.0, 1.0])]
    rows = vectors + [vectors[3]] + bad + short
    df = spark.createDataFrame([(i, v, "x") for i, v in rows], "vec_id bigint, embedding array<double>, block string")
    whole = [(i, [int(np.floor(x * 1024)) for x in v]) for i, v in vectors + short]
    found = nearest.top_k(df, 10, 10, 1024, shard_rows=shard_rows, block_rows=block_rows)
    assert sorted(map(tuple, found.collect())) == brute.top_products(whole, 10, 10)
    assert nearest.top_k(df.limit(0)).collect() == []


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var a="</p>";</script></head><body>
<header><h1>Site</h1></header><nav><ul><li><a href=/>Home</a></li></ul></nav><div class="cookie-notice">We use cookies, yes.</div>
<div class="ad">Buy it, now.</div><article><h1>Head &amp; line</h1><p><b>First part, here.<br><p>Second&nbsp;&#233;
 part, with <a href=x>a link</a>.</p><ul><li>One<li>Two</ul><aside>Aside, of it.</aside></article>
<section id="comments"><p>Nice one, really nice, thanks.</p></section><form><input><button>Send</button></form>
<footer>&copy; all</footer></body></html>"""


def test_main_text(spark):
    rows = [(1, "u", PAGE), (1, "u", PAGE), (2, None, None), (3, "u", ""), (4, "u", "plain"), (5, "u", "<div><p>cut off, he<b"), (None, "u", "<script>x")]
    df = spark.createDataFrame([(*r, "z") for r in rows], "page_id bigint, url string, html string, text string")
    found = [tuple(r) for r in pages.extracted(df).collect()]
    article = "Head & line\nFirst part, here.\nSecond é part, with a link.\nOne\nTwo"
    want = [(1, "u", article), (1, "u", article), (2, None, ""), (3, "u", ""), (4, "u", "plain"), (5, "u", "cut off, he"), (None, "u", "")]
    assert found == [(*w, len(w[2])) for w in want]
    assert pages.extracted(df.limit(0)).collect() == []


def test_main_text_of_bare_divisions():
    page = "<body><div id=menu><a href=1>One</a> <a href=2>Two</a></div><div class=post><h2>Title</h2>" + "".join(
        f"<p>Paragraph {i}, of the post; and so on.</p>" for i in range(4)
    ) + "<p>Short</p></div><div class='sidebar'><p>Not this, nor that.</p></div></body>"
    assert pages.main_text(page).split("\n") == ["Title", *[f"Paragraph {i}, of the post; and so on." for i in range(4)], "Short"]


POST = [f"Paragraph {i} of the post, with text; and so on, to its end." for i in range(4)]
POST_HTML = "".join(f"<p>{p}</p>" for p in POST)


@pytest.mark.parametrize(
    "page",
    [
        '<div class="layout has-sidebar"><article>{}</article></div>',
        '<div class="layout sidebar"><article>{}</article></div>',
        '<div class="elementor-widget-container"><div>{}</div></div>',
        '<div class="widget"><div>{}</div></div>',
        '<div id="page-with-sidebar"><main>{}</main></div>',
        '<form id=f><div role=search><article>{}</article></div></form>',
        '<div aria-hidden=true class="search related"><section>{}</section></div>',
    ],
)
def test_names_do_not_remove_the_article(page):
    head = '<div class="entry-header"><h1>Entry title</h1></div><div class=header><h2 class="post-header">Post title</h2></div>'
    menu, ad = "<nav><ul><li><a href=1>Home</a><li><a href=2>News</a></ul></nav>", "<div class='ad'>Buy this, or that.</div>"
    found = pages.main_text(f"<html><body>{menu}{ad}{page.format(head * ('article' in page) + POST_HTML)}<footer>All rights.</footer></body></html>")
    assert found.split("\n") == ["Entry title", "Post title"] * ("article" in page) + POST


@pytest.mark.parametrize(
    "page, n",
    [
        ("<section>{}{}{}</section><section><p>The conclusion, in short.</p></section>", 13),
        ("<div>{}{}{}</div><div><p>A short part.</p></div><div><p>One more, short.</p></div>", 14),
    ],
)
def test_small_parts_on_content_paths_stay(page, n):
    found = pages.main_text(f"<html><body>{page.replace('{}', POST_HTML)}<footer>All rights.</footer></body></html>")
    assert found.split("\n")[:12] == POST * 3 and len(found.split("\n")) == n


@pytest.mark.parametrize(
    "page, want",
    [
        ("<div class=x1>{menu}</div><h1>Title</h1><div>By me</div>{post}<div class=x2>Buy this.</div>", ["Title", "By me", *POST]),
        ("<div><div class=x1>{menu}</div>{post}<h2>Part two</h2><div class=x3>{menu}</div>{post}</div>", [*POST, "Part two", *POST]),
        ("<article><h1>Title</h1>{post}<ul><li>One<li>Two</ul><div class=x3>{menu}</div></article>", ["Title", *POST, "One", "Two"]),
    ],
)
def test_scores_select_blocks(page, want):
    menu = "<a href=1>Home</a> <a href=2>News</a> <a href=3>About</a>"
    found = pages.main_text(f"<html><body>{page.format(menu=menu, post=POST_HTML)}<div class=x9>{menu}</div></body></html>")
    assert found.split("\n") == want


@pytest.mark.parametrize(
    "page, want",
    [
        ('<p class="a"">Hello world.</p><p class="b">rest</p>', ["Hello world.", "rest"]),
        ("<p data-x=it's>Hello</p><p>rest of the page</p>", ["Hello", "rest of the page"]),
        ('<img alt="5" tall"><p>rest</p>', ["rest"]),
        ('<p "a>b</p><p title="x>y" id=\'c>\'>d</p><p e=f/>g</p>', ["b", "d", "g"]),
        ('<p>one</p><p class="two>three</p><p>four</p>', ["one", "three", "four"]),
        ('<p>one</p><p title="x>y" class="two', ["one", 'y" class="two']),
        ("<p>one</p><p two", ["one"]),
    ],
)
def test_stray_quotes_lose_no_text(page, want):
    assert [block.text for block in pages.blocks(page)] == want


AWKWARD = [*"aAbZ .,'\n\t_-%é ßÿµ°²½İΣςſ你🙂1２<|>", "\x1c", " ", "  ", "<|endoftext|>", "<|EndOfText|>", "'S", "'ll", " ."]


@settings(max_examples=400, deadline=None)
@given(st.lists(st.sampled_from(AWKWARD), max_size=14).map("".join))
def test_units_and_words_tokenize_as_the_whole(text):
    by_bytes, by_words = tokens.tokenizer(BYTES), tokens.WordIds(WORDS)
    ids = [i for unit in tokens.units(text) for i in by_bytes.encode(unit, add_special_tokens=False).ids]
    assert ids == by_bytes.encode(text, add_special_tokens=False).ids
    whole = tokens.tokenizer(WORDS).encode(text, add_special_tokens=False).ids
    assert by_words.encode([text])[0].tolist() == whole


def test_remembered_words_are_bounded(monkeypatch):
    monkeypatch.setattr(tokens, "REMEMBERED", 5)
    ids, whole = tokens.WordIds(WORDS), Tokenizer.from_file(WORDS)
    for text in ("one two three", "four five six one", "seven one two", "w" * 100 + " one"):
        assert ids.encode([text])[0].tolist() == whole.encode(text, add_special_tokens=False).ids
        assert "w" * 100 not in ids.young and len(ids.old) <= 5


def test_remembered_words_are_bounded_within_a_portion():
    whole = Tokenizer.from_file(WORDS)
    texts = [f"{'b' * 70} {' '.join(f'w{i % 37}q{i}' for i in range(k, k + 90))} w{k} w{k}" for k in range(0, 300, 30)]
    for most in (1, 7, 100, 1000):
        ids = tokens.WordIds(WORDS, most)
        for _ in range(2):
            found = ids.encode(texts)
            assert [f.tolist() for f in found] == [whole.encode(t, add_special_tokens=False).ids for t in texts]
            assert len(ids.young) <= most and len(ids.old) <= most
            assert "b" * 70 not in ids.young and "b" * 70 not in ids.old
            assert all(type(v) is bytes for kept in (ids.young, ids.old) for v in kept.values())
