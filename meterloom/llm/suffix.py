"""Removal of every byte that lies in a repeated string of ``length`` bytes.

The dealt method, a difference-cover suffix sort, names sampled positions, recurses on
names and settles the other positions from the sampled ones. On bytes its first sort
alone moves two thirds of all positions with their triples, many times the input; see the
README. Here the sample follows the text: position p is sampled if its GRAM-byte hash is the smallest of
some window of starts, so equal strings sample equal places, and two of about 300 positions are sampled, not two of three.
Every start i belongs to the sampled position that its own string contains first by hash; the starts of one sampled
position are a run. Names are hashes of whole strings:

1. A run's name is the hash of all bytes its strings touch. If it occurs twice, all its strings do.
2. A run that shares its sampled string, but not its name, with another is cut into
   cells of CELL starts, aligned to the sampled position, and each cell is named likewise.
3. A cell that shares its middle, but not its name, is cut into single starts.

What is left at any step is unique, or is decided by the next; nothing is dropped. Steps
work on one representative per name, so copies and common passages do not multiply. Equal
texts are collapsed first.

Defined cases: a null text is empty; texts under ``length`` bytes lose nothing; repeated rows are copies of
each other and lose all their bytes if they are long enough; an empty table gives an empty
result; other columns are ignored. Strings are compared by 64-bit hashes, texts by 128 bits.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterloom.llm.arrays import mixed, prefix_sums, spans
from meterloom.llm.common import kept, mapped

LENGTH, GRAM, CELL = 400, 100, 16
#: Low bits of an ordering key hold the place, so equal hashes sample the first place.
PLACE_BITS = 23
#: Starts that are handled at once.
PIECE = 1 << 22

Rows = Iterator[pa.RecordBatch]
ITEM = "k1 bigint, k2 bigint, weight bigint, settled boolean, gate bigint, name bigint, low bigint, high bigint, anchor bigint"


def sampled(data: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of starts of one piece: first, last, sampled position."""
    starts = len(data) - length + 1
    width = length - gram + 1
    sums = prefix_sums(data)
    at = np.arange(len(data) - gram + 1)
    keys = (spans(sums, at, at + gram) >> np.uint64(PLACE_BITS) << np.uint64(PLACE_BITS)) | at.astype(np.uint64)
    rows = -(-len(keys) // width)
    padded = np.full(rows * width, np.iinfo(np.uint64).max, np.uint64)
    padded[: len(keys)] = keys
    grid = padded.reshape(rows, width)
    ahead = np.minimum.accumulate(grid, axis=1).ravel()
    behind = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    least = np.minimum(behind[:starts], ahead[width - 1 : width - 1 + starts])
    anchor = (least & np.uint64((1 << PLACE_BITS) - 1)).astype(np.int64)
    first = np.concatenate(([0], np.flatnonzero(np.diff(anchor)) + 1))
    last = np.concatenate((first[1:] - 1, [starts - 1]))
    return first, last, anchor[first]


def all_runs(data: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """:func:`sampled` over a text of any length; a run may be cut where pieces meet."""
    parts = []
    for at in range(0, max(0, len(data) - length + 1), PIECE):
        first, last, anchor = sampled(data[at : at + PIECE + length - 1], length, gram)
        parts.append((first + at, last + at, anchor + at))
    if not parts:
        none = np.zeros(0, np.int64)
        return none, none, none
    return tuple(np.concatenate(column) for column in zip(*parts, strict=True))


def _signed(values: np.ndarray) -> pa.Array:
    return pa.array(values.view(np.int64))


def _items(keys: list[tuple], parts: list[tuple], settled: list[bool]) -> pa.RecordBatch:
    counts = [len(part[0]) for part in parts]
    column = lambda values, kind: pa.array(np.repeat(np.array(values, kind), counts))
    joined = [np.concatenate([part[k] for part in parts]) if parts else np.zeros(0, np.int64) for k in range(5)]
    return pa.RecordBatch.from_arrays(
        [
            column([k[0] for k in keys], np.int64),
            column([k[1] for k in keys], np.int64),
            column([k[2] for k in keys], np.int64),
            column(settled, bool),
            _signed(joined[0].astype(np.uint64)),
            _signed(joined[1].astype(np.uint64)),
            *[pa.array(joined[k].astype(np.int64)) for k in (2, 3, 4)],
        ],
        [field.split()[0] for field in ITEM.split(", ")],
    )


def runs_of(texts: DataFrame, length: int, gram: int) -> DataFrame:
    """Step 1: an item per run of each distinct text."""

    def split(batches: Rows) -> Rows:
        for batch in batches:
            keys, parts = [], []
            for k1, k2, body, copies in zip(*(batch.column(i) for i in range(4)), strict=True):
                data = np.frombuffer(body.as_buffer(), np.uint8)
                first, last, anchor = all_runs(data, length, gram)
                if len(first):
                    sums = prefix_sums(data)
                    gates = spans(sums, anchor, anchor + gram)
                    names = mixed(spans(sums, first, last + length) + (anchor - first).astype(np.uint64))
                    keys.append((k1.as_py(), k2.as_py(), copies.as_py()))
                    parts.append((gates, names, first, last, anchor))
                if sum(len(p[0]) for p in parts) > 1 << 18:
                    yield _items(keys, parts, [False] * len(keys))
                    keys, parts = [], []
            yield _items(keys, parts, [False] * len(keys))

    return mapped(texts.select("k1", "k2", "body", "copies"), split, ITEM)


def finer(texts: DataFrame, parents: DataFrame, length: int, cell: int) -> DataFrame:
    """Steps 2 and 3: the items of ``cell`` starts that the parents consist of."""
    lists = parents.groupBy("k1", "k2").agg(
        F.collect_list(F.struct("low", "high", "anchor", "weight")).alias("runs")
    )
    both = texts.join(lists, ["k1", "k2"]).select("k1", "k2", "body", "runs")

    def cut(batches: Rows) -> Rows:
        for batch in batches:
            for k1, k2, body, runs in zip(*(batch.column(i) for i in range(4)), strict=True):
                sums = prefix_sums(np.frombuffer(body.as_buffer(), np.uint8))
                keys, parts, settled = [], [], []
                for run in runs.values:
                    run = run.as_py()
                    low, high, anchor, weight = run["low"], run["high"], run["anchor"], run["weight"]
                    # Distances back from the sampled position, cell by cell.
                    cells = np.arange((anchor - high) // cell, (anchor - low) // cell + 1)
                    first = np.maximum(low, anchor - (cells * cell + cell - 1))
                    last = np.minimum(high, anchor - cells * cell)
                    middle = anchor - cells * cell
                    mark = mixed(cells.astype(np.uint64) + np.uint64(cell))
                    gates = spans(sums, middle, middle + length - cell + 1) ^ mark
                    names = mixed(spans(sums, first, last + length) + (middle - first).astype(np.uint64)) ^ mark
                    keys.append((k1.as_py(), k2.as_py(), weight))
                    settled.append(weight > 1)
                    parts.append((gates, names, first, last, np.full(len(cells), anchor)))
                    if len(keys) >= 1 << 12:
                        yield _items(keys, parts, settled)
                        keys, parts, settled = [], [], []
                yield _items(keys, parts, settled)

    return mapped(both, cut, ITEM)


def decided(items: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The runs of starts that are now known to repeat; the parents of the next step."""
    names = kept(
        items.groupBy("gate", "name").agg(
            F.sum("weight").alias("weight"),
            F.min(F.struct("k1", "k2", "low", "high", "anchor")).alias("one"),
        ),
        "suffix-names",
    )
    twice = names.where("weight > 1").select("gate", "name")
    found = items.where("NOT settled").join(twice, ["gate", "name"]).select("k1", "k2", "low", "high")
    gates = (
        names.groupBy("gate")
        .agg(F.count("*").alias("names"), F.min("weight").alias("least"))
        .where("names > 1 AND least = 1")
        .select("gate")
    )
    return found, names.join(gates, "gate").select("one.*", "weight")


def _removed(length: int) -> Callable[[Rows], Rows]:
    def remove(batches: Rows) -> Rows:
        for batch in batches:
            out = []
            for k1, k2, body, runs in zip(*(batch.column(i) for i in range(4)), strict=True):
                data = np.frombuffer(body.as_buffer(), np.uint8)
                spans_, left = 0, data
                if runs.is_valid and len(runs.values):
                    low = runs.values.field(0).to_numpy()
                    high = runs.values.field(1).to_numpy()
                    steps = np.zeros(len(data) + 1, np.int64)
                    np.add.at(steps, low, 1)
                    np.add.at(steps, high + length, -1)
                    gone = np.cumsum(steps[:-1]) > 0
                    spans_ = int(gone[0]) + int(np.count_nonzero(gone[1:] & ~gone[:-1]))
                    left = data[~gone]
                out.append((k1.as_py(), k2.as_py(), len(data), len(data) - len(left), spans_, hashlib.sha256(left.tobytes()).hexdigest()))
            columns = list(zip(*out, strict=True)) or [()] * 6
            kinds = [pa.int64()] * 5 + [pa.string()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                ["k1", "k2", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
            )

    return remove


def without_repeats(
    docs: DataFrame, length: int = LENGTH, gram: int = GRAM, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256."""
    spark = docs.sparkSession
    body = F.coalesce(F.encode(F.col(text).cast("string"), "UTF-8"), F.lit("").cast("binary"))
    keyed = docs.select(F.col(doc_id).alias("doc_id"), body.alias("body")).select(
        "doc_id", "body", F.xxhash64("body").alias("k1"), F.xxhash64(F.lit(length), "body").alias("k2")
    )
    distinct = keyed.groupBy("k1", "k2").agg(F.first("body").alias("body"), F.count("*").alias("copies"))
    # Bucketed by key: the three joins below then leave the texts where they are.
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    name = f"meterloom_texts_{uuid.uuid4().hex}"
    distinct.repartition(buckets, "k1", "k2").write.bucketBy(buckets, "k1", "k2").saveAsTable(name)
    texts = spark.table(name)
    items = kept(runs_of(texts, length, gram), "suffix-runs")
    found, parents = decided(items)
    hits = kept(found, "suffix-hits")
    for cell in (CELL, 1):
        items = kept(finer(texts, kept(parents, "suffix-parents"), length, cell), "suffix-cells")
        found, parents = decided(items)
        hits = hits.union(kept(found, "suffix-hits"))
    lists = hits.groupBy("k1", "k2").agg(F.collect_list(F.struct("low", "high")).alias("runs"))
    done = mapped(
        texts.join(lists, ["k1", "k2"], "left").select("k1", "k2", "body", "runs"),
        _removed(length),
        "k1 bigint, k2 bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string",
    )
    done = kept(done, "suffix-done")
    spark.sql(f"DROP TABLE {name}")
    return keyed.select("doc_id", "k1", "k2").join(done, ["k1", "k2"]).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"
    )
