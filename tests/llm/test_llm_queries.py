"""The registered queries against SQL, or against brute force, on the small tables."""

from __future__ import annotations

import os
import random
import sys

import compare
import public_tokenizers
import pytest
from tokenizers import Tokenizer

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import brute  # noqa: E402

import corpus_pipeline  # noqa: E402
from meterloom.llm.common import kept, table  # noqa: E402
from meterloom.llm.queries import ORACLES, QUERIES  # noqa: E402


def documents(spark, small):
    return {r["doc_id"]: r["text"] for r in table(spark, small, "documents").collect()}


def test_one_query_per_operator():
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, small, sql_side, name):
    assert compare.difference(QUERIES[name](spark, small), sql_side, ORACLES[name]) is None


def test_op1_held_out_accuracy(spark, small):
    lang = {r["doc_id"]: r["lang"] for r in table(spark, small, "documents").collect()}
    rows = QUERIES["op1_hyperdimensional_language"](spark, small).collect()
    held = [r for r in rows if r["held_out"] and lang[r["doc_id"]]]
    assert len(rows) == len(lang) and len(held) > 20
    assert sum(r["lang_pred"] == lang[r["doc_id"]] for r in held) >= 0.97 * len(held)


def test_op2_figures_and_labels(spark, small):
    texts = documents(spark, small)
    rows = QUERIES["op2_quality_votes"](spark, small).collect()
    for r in rows:
        assert tuple(r)[1:6] == brute.quality(texts[r["doc_id"]])
    label = {r["doc_id"]: r["quality"] for r in table(spark, small, "labels").collect()}
    sure = [r for r in rows if r["doc_id"] in label and not r["base_failed"]]
    assert sum(r["kept"] == bool(label[r["doc_id"]]) for r in sure) >= 0.9 * len(sure)


def test_op3_bytes(spark, small):
    texts = documents(spark, small)
    ids = sorted(texts)
    want = dict(zip(ids, brute.repeated_bytes([texts[i] for i in ids], 400), strict=True))
    assert {r["doc_id"]: tuple(r)[1:] for r in QUERIES["op3_repeated_bytes"](spark, small).collect()} == want


def test_op4_pages(spark, small):
    rows = QUERIES["op4_main_text"](spark, small).collect()
    html = {r["page_id"]: r["html"] for r in table(spark, small, "pages").collect()}
    assert len(rows) == len(html)
    for r in rows:
        assert r["text"] and r["n_chars"] == len(r["text"])
        body = html[r["page_id"]]
        article = body[body.index("<article>") :].split("</article>")[0]
        for block in r["text"].split("\n"):
            assert block.split(" ")[0].split("&")[0] in article


def test_op5_tokens(spark, small):
    texts = documents(spark, small)
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    for r in QUERIES["op5_token_counts"](spark, small).collect():
        assert r["n_tokens"] == len(tokenizer.encode(texts[r["doc_id"]] or "", add_special_tokens=False))


def test_pipeline_stages(spark, small):
    docs = table(spark, small, "documents")
    columns = docs.columns
    stages = dict(corpus_pipeline.STAGES)
    before = [(r["doc_id"], r["text"]) for r in docs.collect()]
    docs = kept(stages["language id"](spark, docs, small), "test")
    after = [(r["doc_id"], r["text"]) for r in docs.collect()]
    assert set(after) <= set(before) and len(after) >= 0.98 * len(before) and docs.columns == columns
    docs = kept(stages["line dedup"](spark, docs, small), "test")
    want = brute.repeated_lines(after)
    lines = [(r["doc_id"], r["text"]) for r in docs.collect()]
    assert docs.columns == columns and {i: want[i][2] for i, _ in after} == dict(lines)
    docs = kept(stages["n-gram jaccard join"](spark, docs, small), "test")
    groups = brute.near_components(lines, 5, 80)
    assert docs.columns == columns
    assert {r["doc_id"] for r in docs.collect()} == {i for i, (_, c) in groups.items() if c == i}
    docs = kept(stages["mixing sources"](spark, docs, small), "test")
    assert docs.columns == columns
    mixed = docs.count()
    packed = stages["packing"](spark, docs, small).collect()
    assert sum(r["start"] == 0 for r in packed) == mixed


def test_language_stage_drops_noise_and_keeps_short_texts(spark, small):
    docs = table(spark, small, "documents")
    pick = random.Random(1)

    def noise(low, high):
        return " ".join("".join(chr(pick.randint(low, high)) for _ in range(pick.randint(3, 8))) for _ in range(200))

    bad = [noise(*span) for span in ((97, 122), (0x430, 0x44F), (0xE01, 0xE2E), (0x3B1, 0x3C9)) for _ in range(10)]
    words = [r["text"].split()[0] for r in docs.where("lang IS NOT NULL AND n_chars > 400").limit(60).collect()]
    short = [word for word in words if any(c.isalpha() for c in word)]
    rows = [(10**9 + i, text, None, None, len(text)) for i, text in enumerate(bad + short)]
    planted = docs.select("doc_id", "text", "lang", "source", "n_chars").unionByName(
        spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    )
    stay = {r["doc_id"] for r in corpus_pipeline.identify_language(spark, planted, small).collect()}
    assert [i for i in range(len(bad)) if 10**9 + i in stay] == []
    assert all(10**9 + len(bad) + i in stay for i in range(len(short)))


def test_pipeline_runs_whole(spark, small):
    assert corpus_pipeline.run(spark, small).count() > 0
