"""Benchmark decontamination by a broadcast hash set of test n-grams.

The windows of ``length`` consecutive terms of every benchmark item (of all its terms, if
they are fewer) are hashed and sent to every task. A task hashes the windows of its
texts, portion by portion, looks them up, and verifies each hit on the words
themselves, so a collision changes nothing. There is no shuffle of documents.

The set is bounded: items are dealt into blocks of about ``windows`` windows each (some
30 bytes a window), and the documents are scanned once per block, each scan adding to what the
ones before it found. A benchmark of a million windows is one block.

Defined cases: a null or empty text has no terms and is clean; an item without id or
without terms takes no part; rows of one item id are one item; repeated rows and ids of
documents are judged row by row; an empty table of items leaves all documents clean;
all other columns stay, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterloom.llm.arrays import BASE, INVERSE, mixed, powers, prefix_sums, spans
from meterloom.llm.common import fresh, kept, mapped
from meterloom.llm.terms import body_portions, plain, term_edges

#: Terms of a window.
LENGTH = 10
#: Windows of one broadcast set.
WINDOWS = 1 << 20
#: Slots of the table that is asked first, for each window of the set.
SLOTS = 16

Rows = Iterator[pa.RecordBatch]
FOUND = "struct<n_words:bigint,n_hit:bigint,items:array<string>,spans:array<struct<start:bigint,end:bigint>>>"


@dataclass
class WindowSet:
    """Windows of ``length`` terms: sorted hashes, and where the words and the item of each are."""

    length: int
    hashes: np.ndarray
    item: np.ndarray
    start: np.ndarray
    end: np.ndarray

    def __post_init__(self) -> None:
        self.bits = max(10, (SLOTS * len(self.hashes)).bit_length())

    def slots(self) -> np.ndarray:
        table = np.zeros(1 << self.bits, bool)
        table[self.hashes >> np.uint64(64 - self.bits)] = True
        return table


@dataclass
class ItemWindows:
    items: list[str]
    words: bytes
    windows: list[WindowSet]


def window_hashes(words: np.ndarray, length: int) -> np.ndarray:
    """Hashes of all windows of ``length`` of the words with these hashes."""
    n = len(words)
    if n < length:
        return np.zeros(0, np.uint64)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(words * powers(BASE, n), out=sums[1:])
    starts = np.arange(n - length + 1)
    return mixed((sums[length:] - sums[: n - length + 1]) * powers(INVERSE, n)[starts] + np.uint64(length))


def edges_and_hashes(text: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    data = np.frombuffer(text, np.uint8)
    starts, ends = term_edges(data)
    return starts, ends, spans(prefix_sums(data), starts, ends)


def item_windows(items: list[tuple[str, bytes]], length: int) -> ItemWindows:
    """The windows of (id, text) items."""
    names: dict[str, int] = {}
    found: dict[int, list[tuple[np.ndarray, ...]]] = {}
    words, at = [], 0
    for name, body in items:
        line = b" ".join(plain(body).split())
        if not line:
            continue
        starts, ends, hashes = edges_and_hashes(line)
        size = min(length, len(starts))
        index = names.setdefault(name, len(names))
        parts = (window_hashes(hashes, size), starts[: len(starts) - size + 1] + at, ends[size - 1 :] + at)
        found.setdefault(size, []).append((np.full(len(parts[0]), index), *parts))
        words.append(line)
        at += len(line)
    sets = []
    for size, parts in sorted(found.items()):
        item, hashes, start, end = (np.concatenate(column) for column in zip(*parts, strict=True))
        order = np.argsort(hashes, kind="stable")
        sets.append(WindowSet(size, hashes[order], item[order], start[order], end[order]))
    return ItemWindows(list(names), b"".join(words), sets)


class Scanner:
    """Looks texts up in a test set; one in each task."""

    def __init__(self, tests: ItemWindows) -> None:
        self.tests = tests
        self.slots = [windows.slots() for windows in tests.windows]

    def scan(self, bodies: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[tuple[int, int]], list[tuple[int, int]]]:
        """Ends of the bodies in their joint text, start and end of all its words, hit runs
        (first word, word behind) and (body, item) pairs."""
        text = plain(b"\n".join(bodies))
        stops = np.cumsum([len(body) + 1 for body in bodies])
        starts, ends, hashes = edges_and_hashes(text)
        body = np.searchsorted(stops, starts, "right")
        runs: list[tuple[int, int]] = []
        pairs: set[tuple[int, int]] = set()
        for windows, slots in zip(self.tests.windows, self.slots, strict=True):
            size = windows.length
            values = window_hashes(hashes, size)
            first = np.flatnonzero(slots[values >> np.uint64(64 - windows.bits)])
            first = first[body[first] == body[first + size - 1]]
            low = np.searchsorted(windows.hashes, values[first], "left")
            high = np.searchsorted(windows.hashes, values[first], "right")
            for at, a, b in zip(first[low < high].tolist(), low[low < high].tolist(), high[low < high].tolist(), strict=True):
                line = b" ".join(text[starts[at] : ends[at + size - 1]].split())
                for k in range(a, b):
                    if self.tests.words[windows.start[k] : windows.end[k]] == line:
                        runs.append((at, at + size))
                        pairs.add((int(body[at]), int(windows.item[k])))
        return stops, starts, ends, runs, sorted(pairs)


def _blocks(items: DataFrame, length: int, windows: int) -> Iterator[ItemWindows]:
    """Test sets of about ``windows`` windows that together hold all items (name, body)."""
    items = kept(items, "test-items")
    total = items.agg(F.sum(F.octet_length("body") / 2 + 1)).first()[0] or 0
    # A window has a term of two bytes at least, its gap included: never more windows than that.
    blocks = max(1, -(-int(total) // windows))
    for block in range(blocks):
        part = items.where(F.pmod(F.xxhash64("name"), F.lit(blocks)) == block).orderBy("name").toArrow()
        yield item_windows(list(zip(part.column("name").to_pylist(), part.column("body").to_pylist(), strict=True)), length)


def marked(
    docs: DataFrame,
    items: DataFrame,
    length: int = LENGTH,
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    into: str = "found",
    windows: int = WINDOWS,
) -> DataFrame:
    """``docs`` with struct ``into``: n_words, n_hit (words inside windows of items), items
    (ids as strings, sorted) and spans (byte ranges of the runs of hit words)."""
    tests = items.select(
        F.col(item_id).cast("string").alias("name"), F.encode(F.col(item_text).cast("string"), "UTF-8").alias("body")
    ).where("name IS NOT NULL AND body IS NOT NULL")
    body = fresh(docs, "body")
    schema = T.StructType([*docs.schema.fields, T.StructField(into, T._parse_datatype_string(FOUND))])
    found = docs
    for k, test in enumerate(_blocks(tests, length, windows)):
        if k:
            found = kept(found, "test-hits")
        found = mapped(
            found.withColumn(body, F.encode(F.col(text).cast("string"), "UTF-8")),
            _marker(docs.sparkSession.sparkContext.broadcast(test), into, body),
            schema,
        )
    return found


def _marker(shared, into: str, body: str):  # noqa: ANN001, ANN202
    def mark(batches: Rows) -> Rows:
        scanner = Scanner(shared.value)
        names = shared.value.items
        for batch in batches:
            at = batch.schema.get_field_index(body)
            earlier = batch.schema.get_field_index(into)
            keep = [i for i in range(batch.num_columns) if i not in (at, earlier)]
            for row, bodies in body_portions(batch, at):
                stops, starts, ends, runs, pairs = scanner.scan(bodies)
                begins = np.concatenate(([0], stops[:-1]))
                hit = np.zeros(len(starts), bool)
                for a, b in runs:
                    hit[a:b] = True
                held: list[set[str]] = [set() for _ in bodies]
                for k, item in pairs:
                    held[k].add(names[item])
                if earlier >= 0:
                    for k, old in enumerate(batch.column(earlier).slice(row, len(bodies)).to_pylist()):
                        held[k].update(old["items"])
                        for span in old["spans"]:
                            low, high = np.searchsorted(starts, [span["start"] + begins[k], span["end"] + begins[k]])
                            hit[low:high] = True
                edges = np.searchsorted(starts, np.concatenate(([0], stops)))
                found = []
                for k in range(len(bodies)):
                    a, b = edges[k], edges[k + 1]
                    n = int(hit[a:b].sum())
                    ranges = []
                    if n:
                        change = np.flatnonzero(np.diff(np.concatenate(([0], hit[a:b].astype(np.int8), [0])))) + a
                        ranges = [
                            {"start": int(starts[x] - begins[k]), "end": int(ends[y - 1] - begins[k])}
                            for x, y in zip(change[0::2], change[1::2], strict=True)
                        ]
                    found.append({"n_words": int(b - a), "n_hit": n, "items": sorted(held[k]), "spans": ranges})
                columns = [batch.column(i).slice(row, len(bodies)) for i in keep]
                span = pa.struct([("start", pa.int64()), ("end", pa.int64())])
                kind = pa.struct(
                    [("n_words", pa.int64()), ("n_hit", pa.int64()), ("items", pa.list_(pa.string())), ("spans", pa.list_(span))]
                )
                fields = [batch.schema.field(i).name for i in keep]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(found, kind)], [*fields, into])

    return mark


def decontaminated(
    docs: DataFrame,
    items: DataFrame,
    remove: str = "documents",
    length: int = LENGTH,
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    windows: int = WINDOWS,
) -> DataFrame:
    """``docs`` without the documents that hold a window, or (``remove="spans"``) with the
    runs of hit words cut out of their text; the same columns. A null text stays null."""
    into = fresh(docs, "found")
    found = marked(docs, items, length, text, item_id, item_text, into, windows)
    if remove == "documents":
        return found.where(F.col(into)["n_hit"] == 0).select(*docs.columns)
    if remove != "spans":
        raise ValueError(f"remove is documents or spans, not {remove!r}")
    at = F.encode(F.col(text).cast("string"), "UTF-8")
    spans_ = F.col(into)["spans"]
    # What lies before each span, and behind the last one.
    pieces = F.transform(
        F.sequence(F.lit(0), F.size(spans_)),
        lambda k: F.substring(
            at,
            (F.when(k == 0, F.lit(0)).otherwise(F.get(spans_["end"], k - 1)) + 1).cast("int"),
            (
                F.coalesce(F.get(spans_["start"], k), F.octet_length(at))
                - F.when(k == 0, F.lit(0)).otherwise(F.get(spans_["end"], k - 1))
            ).cast("int"),
        ),
    )
    joined = F.decode(F.aggregate(pieces, F.lit(b""), lambda whole, piece: F.concat(whole, piece)), "UTF-8")
    cut = F.when(F.col(into)["n_hit"] > 0, joined).otherwise(F.col(text))
    return found.select(*[cut.alias(c) if c == text else F.col(c) for c in docs.columns])


def hit_report(docs: DataFrame, items: DataFrame, length: int = LENGTH, doc_id: str = "doc_id", **names) -> DataFrame:
    """Per document: doc_id, n_words, n_hit, n_items, items_sha256, contaminated."""
    text = names.get("text", "text")
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    found = marked(rows, items, length, **{**names, "text": "text", "into": "found"})
    return found.select(
        "doc_id",
        "found.n_words",
        "found.n_hit",
        F.size("found.items").cast("long").alias("n_items"),
        F.sha2(F.array_join("found.items", ",").cast("binary"), 256).alias("items_sha256"),
        (F.col("found.n_hit") > 0).alias("contaminated"),
    )
