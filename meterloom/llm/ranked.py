"""Ranked lexical search by an Aho-Corasick scan of the documents.

The terms of all items form one automaton, each guarded by a space on both sides; it
is broadcast, and every task runs it over its plain texts (terms, with spaces for all
else). What it puts out are the term frequencies of a document; the terms lead to the
items by a list of postings. There is no index of documents: one scan sums the
corpus statistics (documents with each term, documents, terms), a second one scores.

A task keeps the best ``k`` documents of each item. These rows are merged in two
steps, so that no task gets more than a share of an item's candidates.

The broadcast is bounded: items are dealt into blocks of about ``term_bytes`` bytes of
text, and a block has an automaton, two scans and a result of its own.

Defined cases: a null or empty text has no terms and counts nowhere; a document without id counts in
the statistics but is not listed; rows that share an id are ranked each for itself; an
item without id, or without a term found anywhere, has no result; rows of one item id are one
item with the terms of all; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from operator import itemgetter

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from meterloom.llm.common import kept, mapped
from meterloom.llm.terms import plain

#: Bytes of item text in one automaton, which takes some 50 times as much memory.
TERM_BYTES = 1 << 21
#: Shares of an item's candidates in the first of the two merges.
SHARES = 64
#: Rows of the statistics that are no terms.
DOCUMENTS, TERMS = -1, -2

Rows = Iterator[pa.RecordBatch]


@dataclass
class Items:
    """Automaton, term count and postings (item, times) of each term; ids of the items."""

    ids: pa.Array
    automaton: ahocorasick.Automaton
    terms: int
    begin: np.ndarray
    item: np.ndarray
    times: np.ndarray


def build_items(ids: pa.Array, bodies: list[list[bytes]]) -> Items:
    numbers: dict[bytes, int] = {}
    rows = []
    for item, parts in enumerate(bodies):
        for term, times in Counter(term for body in parts for term in plain(body).split()).items():
            rows.append((numbers.setdefault(term, len(numbers)), item, times))
    automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS)
    for term, number in numbers.items():
        automaton.add_word(f" {term.decode('latin-1')} ", number)
    if numbers:
        automaton.make_automaton()
    rows.sort()
    term, item, times = np.array(rows, np.int64).reshape(-1, 3).T
    begin = np.searchsorted(term, np.arange(len(numbers) + 1))
    return Items(ids, automaton, len(numbers), begin, item, times)


def frequencies(items: Items, body: bytes | None) -> tuple[int, np.ndarray, np.ndarray]:
    """Number of terms of a text, and numbers and frequencies of those that items have."""
    text = plain(body or b"")
    inside = np.frombuffer(text, np.uint8) != 32
    size = int(np.count_nonzero(inside[1:] & ~inside[:-1]) + inside[0]) if len(inside) else 0
    if not size or not items.terms:
        return size, np.zeros(0, np.int64), np.zeros(0, np.int64)
    found = Counter(map(itemgetter(1), items.automaton.iter(f" {text.decode('latin-1')} ")))
    terms = np.fromiter(found.keys(), np.int64, len(found))
    return size, terms, np.fromiter(found.values(), np.int64, len(found))


def statistics(bodies: DataFrame, shared, terms: int) -> tuple[int, int, np.ndarray]:  # noqa: ANN001
    """Documents with a term, their terms, and the documents of each item term: one
    number per term of the block reaches the driver."""

    def count(batches: Rows) -> Rows:
        items = shared.value
        seen = np.zeros(items.terms, np.int64)
        documents = total = 0
        for batch in batches:
            for body in batch.column(0):
                size, found, _ = frequencies(items, body.as_py())
                documents += size > 0
                total += size
                seen[found] += 1
        held = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(held, [DOCUMENTS, TERMS])), pa.array(np.append(seen[held], [documents, total]))],
            ["term", "seen"],
        )

    counts = mapped(bodies, count, "term bigint, seen bigint").groupBy("term").agg(F.sum("seen").alias("seen")).toArrow()
    sums = dict(zip(counts.column("term").to_pylist(), counts.column("seen").to_pylist(), strict=True))
    documents, total = sums.pop(DOCUMENTS, 0), sums.pop(TERMS, 0)
    seen = np.zeros(terms, np.int64)
    seen[list(sums)] = list(sums.values())
    return documents, total, seen


class Ranker:
    """Scores documents and keeps the best ``k`` of each item; one in each task."""

    def __init__(self, items: Items, documents: int, total: int, seen: np.ndarray, k: int) -> None:
        self.items, self.documents, self.total, self.k = items, documents, total, k
        self.weight = np.array([math.floor(1000 * math.log((2 * documents + 2) / (2 * n + 1))) for n in seen.tolist()], np.int64)
        self.best: list[list[tuple[int, int]]] = [[] for _ in range(len(items.ids))]
        self.least = np.ones(len(items.ids), np.int64)

    def scores(self, size: int, terms: np.ndarray, times: np.ndarray) -> np.ndarray:
        items = self.items
        m = 100 - 25 + (25 * size * self.documents) // self.total
        part = self.weight[terms] * ((1_000_000_000 * times) // (1000 * times + 12 * m))
        begin = items.begin[terms]
        count = items.begin[terms + 1] - begin
        at = np.repeat(begin - np.cumsum(count) + count, count) + np.arange(count.sum())
        scores = np.zeros(len(items.ids), np.int64)
        np.add.at(scores, items.item[at], np.repeat(part, count) * items.times[at])
        return scores

    def add(self, doc_id: int, body: bytes | None) -> None:
        size, terms, times = frequencies(self.items, body)
        if not len(terms):
            return
        scores = self.scores(size, terms, times)
        for item in np.flatnonzero(scores >= self.least).tolist():
            heap, entry = self.best[item], (int(scores[item]), -doc_id)
            if len(heap) < self.k:
                heapq.heappush(heap, entry)
            else:
                heapq.heappushpop(heap, entry)
            if len(heap) == self.k:
                self.least[item] = max(1, heap[0][0])


def _best(rows: DataFrame, keys: list[str], k: int) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), "doc_id")
    return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def ranked(
    docs: DataFrame,
    items: DataFrame,
    k: int = 20,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    term_bytes: int = TERM_BYTES,
) -> DataFrame:
    """item_id, rank, doc_id and score of the ``k`` best documents of each item."""
    encoded = lambda name: F.encode(F.col(name).cast("string"), "UTF-8")
    bodies = docs.select(F.col(doc_id).cast("long").alias("doc_id"), encoded(text).alias("body"))
    wanted = items.select(F.col(item_id).alias("item_id"), encoded(item_text).alias("body"))
    wanted = kept(wanted.where("item_id IS NOT NULL AND body IS NOT NULL"), "search-items")
    blocks = max(1, -(-(wanted.agg(F.sum(F.octet_length("body"))).first()[0] or 0) // term_bytes))
    kind = wanted.schema["item_id"].dataType.simpleString()
    found = None
    for block in range(blocks):
        part = wanted.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == block)
        part = part.groupBy("item_id").agg(F.collect_list("body").alias("bodies")).orderBy("item_id").toArrow()
        best = _scan(bodies, build_items(part.column(0).combine_chunks(), part.column(1).to_pylist()), k, kind)
        found = best if found is None else found.union(best)
    few = _best(found, ["item_id", "share"], k)
    return _best(few, ["item_id"], k).select("item_id", "rank", "doc_id", "score")


def _scan(bodies: DataFrame, items: Items, k: int, kind: str) -> DataFrame:
    """item_id, doc_id, score, share: every task's best documents of each item."""
    shared = bodies.sparkSession.sparkContext.broadcast(items)
    documents, total, seen = statistics(bodies.select("body"), shared, items.terms)

    def score(batches: Rows) -> Rows:
        ranker = Ranker(shared.value, documents, total, seen, k)
        for batch in batches:
            for name, body in zip(batch.column(0), batch.column(1), strict=True):
                if name.is_valid:
                    ranker.add(name.as_py(), body.as_py())
        item = [i for i, heap in enumerate(ranker.best) for _ in heap]
        rows = [entry for heap in ranker.best for entry in heap]
        share = TaskContext.get().partitionId() % SHARES
        yield pa.RecordBatch.from_arrays(
            [
                shared.value.ids.take(pa.array(item, pa.int64())),
                pa.array([-name for _, name in rows], pa.int64()),
                pa.array([value for value, _ in rows], pa.int64()),
                pa.array([share] * len(rows), pa.int32()),
            ],
            ["item_id", "doc_id", "score", "share"],
        )

    return mapped(bodies, score, f"item_id {kind}, doc_id bigint, score bigint, share int")
