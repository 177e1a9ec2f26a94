"""Line deduplication with levelled sorted runs of line hashes.

Documents come in batches. A batch's line keys are reduced to one row each (documents
that hold it, largest id) and merge-anti-joined with the runs so far: keys that no run has
become the batch's own run, keys that one has become a count beside it. So a key is
new in exactly one run, and its total is that row and its counts from later batches. When a
level has ``fanout`` runs, they are merged into one run of the next level, so every key
is rewritten once per level and a batch meets few runs. The number of batches is a
parameter, not a share of the input: each batch reads the keys of the runs, and with a fixed
number that stays in proportion to the input.

A document enters the runs with its distinct keys only, so a key that a third of all documents
holds is summed in the map tasks. To find the documents that lose a line, keys of at least one
:data:`HOT`-th of all rows (there can be no more than that many) are broadcast, and their rows
shuffled by document; the other keys are joined by key. Lost executors are harmless: runs are
tables of the shared folder.

Defined cases: a null or empty text is one empty line and gives an empty text; lines
are kept in order, line ends included; keys under ``least_chars`` code points always stay;
rows of one id count as one document; a null id is below every other id; an empty table
gives an empty result. :func:`without_repeats` keeps all columns of its input,
whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterloom.llm.common import fresh, kept, mapped, released, ship, small_batches

#: ASCII white space that is stripped from both ends of a key.
BLANK = " \t\n\x0b\x0c\r"
LEAST_CHARS, LEAST_DOCS = 20, 3
#: Batches and runs of a level: two batches meet merged runs.
BATCHES, FANOUT = 5, 3
#: Most keys that are broadcast.
HOT = 4_096

Rows = Iterator[pa.RecordBatch]


def line_key(line: str, least_chars: int) -> bytes | None:
    """128-bit hash of the stripped, A-Z lower-cased line; None if it is too short."""
    line = line.strip(BLANK)
    if len(line) < least_chars:
        return None
    return hashlib.blake2b(line.encode("utf-8", "surrogatepass").lower(), digest_size=16).digest()


def line_keys(docs: DataFrame, least_chars: int) -> DataFrame:
    """doc_id and key for each distinct key of each row of ``docs`` (doc_id, text)."""

    def split(batches: Rows) -> Rows:
        for batch in batches:
            rows, keys = [], []
            for i, body in enumerate(batch.column(1)):
                found = {line_key(line, least_chars) for line in (body.as_py() or "").split("\n")} - {None}
                rows.extend([i] * len(found))
                keys.extend(found)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(rows, pa.int64())), pa.array(keys, pa.binary())], ["doc_id", "key"]
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return mapped(docs, split, f"doc_id {kind}, key binary")


class LineRuns:
    """Sorted runs of (key, docs, largest, fresh): the state between batches.

    ``fresh`` marks the keys that no earlier batch held, each in one run; the other rows
    are what later batches add to them.
    """

    def __init__(self, spark: SparkSession, fanout: int = FANOUT) -> None:
        self.spark, self.fanout = spark, fanout
        self.levels: list[list[DataFrame]] = [[]]
        self.merged: list[DataFrame] = []

    @property
    def runs(self) -> list[DataFrame]:
        return [run for level in self.levels for run in level]

    def _every(self, runs: list[DataFrame]) -> DataFrame:
        every = runs[0]
        for run in runs[1:]:
            every = every.union(run)
        return every

    def add(self, keys: DataFrame) -> DataFrame:
        """Enter a batch of (doc_id, key), distinct per document; returns its run.

        Runs that were merged are deleted by the next call.
        """
        released(*self.merged)
        self.merged = []
        counted = keys.groupBy("key").agg(
            F.count("*").alias("docs"), F.max("doc_id").alias("largest")
        )
        if self.runs:
            known = self._every(self.runs).where("fresh").select("key", F.lit(False).alias("fresh"))
            rows = counted.join(known, "key", "left").select(
                "key", "docs", "largest", F.coalesce("fresh", F.lit(True)).alias("fresh")
            )
        else:
            rows = counted.withColumn("fresh", F.lit(True))
        # Equal keys are in one task already, so sorting there costs no shuffle.
        run = kept(rows.sortWithinPartitions("fresh", "key"), "line-run")
        self.levels[0].append(run)
        self._compact()
        return run

    def _compact(self) -> None:
        level = 0
        while len(self.levels[level]) >= self.fanout:
            if level + 1 == len(self.levels):
                self.levels.append([])
            old = self.levels[level]
            # Fresh rows are of different keys; what was added to one key becomes one row.
            merged = self._every(old).groupBy("key", "fresh").agg(
                F.sum("docs").alias("docs"), F.max("largest").alias("largest")
            )
            merged = merged.select("key", "docs", "largest", "fresh").sortWithinPartitions("fresh", "key")
            self.levels[level + 1].append(kept(merged, "line-run"))
            self.levels[level] = []
            self.merged += old
            level += 1

    def totals(self) -> DataFrame:
        """key, docs, largest over all batches."""
        every = self._every(self.runs)
        later = every.where("NOT fresh").groupBy("key").agg(
            F.sum("docs").alias("more"), F.max("largest").alias("later")
        )
        return every.where("fresh").join(later, "key", "left").select(
            "key",
            (F.col("docs") + F.coalesce("more", F.lit(0))).alias("docs"),
            F.greatest("largest", "later").alias("largest"),
        )

    def close(self) -> None:
        """Delete all runs; what was computed from them must be written."""
        released(*self.runs, *self.merged)
        self.levels, self.merged = [[]], []


def holders(lines: DataFrame, repeated: DataFrame, rows: int) -> DataFrame:
    """doc_id and key of ``lines`` for each key of ``repeated``, but for its largest document."""
    hot = F.broadcast(repeated.where(F.col("docs") * HOT >= rows).select("key", "largest"))
    rest = repeated.where(F.col("docs") * HOT < rows).select("key", "largest")
    often = lines.join(hot, "key")
    others = lines.join(hot.select("key"), "key", "left_anti").join(rest, "key")
    return often.unionByName(others).where(~F.col("doc_id").eqNullSafe(F.col("largest"))).select("doc_id", "key")


def dropped_keys(docs: DataFrame, doc_id: str, text: str, batches: int, fanout: int, least_chars: int, least_docs: int) -> DataFrame:
    """doc_id and the list of keys whose lines the document loses."""
    small_batches(docs.sparkSession)
    lines = line_keys(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text")), least_chars)
    lines = kept(lines, "line-keys")
    runs = LineRuns(docs.sparkSession, fanout)
    for batch in range(batches):
        part = lines.where(F.pmod(F.xxhash64("doc_id"), F.lit(batches)) == batch)
        runs.add(part.distinct())
    repeated = kept(runs.totals().where(F.col("docs") >= least_docs), "line-repeated")
    runs.close()
    hits = holders(lines, repeated, lines.count())
    keys = kept(hits.groupBy("doc_id").agg(F.collect_set("key").alias("keys")), "line-dropped")
    released(lines, repeated)
    return keys


def _stripped(least_chars: int):
    def keep(body: str | None, keys: list[bytes] | None) -> tuple[str, int, int]:
        lines = (body or "").split("\n")
        if not keys:
            return body or "", len(lines), 0
        gone = set(keys)
        left = [line for line in lines if line_key(line, least_chars) not in gone]
        return "\n".join(left), len(lines), len(lines) - len(left)

    return keep


def line_report(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    batches: int = BATCHES,
    fanout: int = FANOUT,
    least_chars: int = LEAST_CHARS,
    least_docs: int = LEAST_DOCS,
) -> DataFrame:
    """Per document: doc_id, n_lines, n_dropped, kept_sha256 of the text that stays."""
    keys = dropped_keys(docs, doc_id, text, batches, fanout, least_chars, least_docs).withColumnRenamed("doc_id", "of")
    body = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    joined = body.join(keys, body["doc_id"].eqNullSafe(keys["of"]), "left").select("doc_id", "text", "keys")
    keep = _stripped(least_chars)

    def digest(parts: Rows) -> Rows:
        for part in parts:
            found = [keep(t.as_py(), k.as_py()) for t, k in zip(part.column(1), part.column(2), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [
                    part.column(0),
                    pa.array([f[1] for f in found], pa.int64()),
                    pa.array([f[2] for f in found], pa.int64()),
                    pa.array([hashlib.sha256(f[0].encode("utf-8", "surrogatepass")).hexdigest() for f in found], pa.string()),
                ],
                ["doc_id", "n_lines", "n_dropped", "kept_sha256"],
            )

    kind = body.schema["doc_id"].dataType.simpleString()
    return mapped(joined, digest, f"doc_id {kind}, n_lines bigint, n_dropped bigint, kept_sha256 string")


def without_repeats(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    batches: int = BATCHES,
    fanout: int = FANOUT,
    least_chars: int = LEAST_CHARS,
    least_docs: int = LEAST_DOCS,
) -> DataFrame:
    """``docs`` with the repeated lines taken out of ``text``; the same columns."""
    of, gone = fresh(docs, "line_of"), fresh(docs, "line_keys")
    keys = dropped_keys(docs, doc_id, text, batches, fanout, least_chars, least_docs).toDF(of, gone)
    keep = _stripped(least_chars)
    ship(docs.sparkSession)

    @F.pandas_udf("string")
    def strip(bodies, lists):  # noqa: ANN001, ANN202
        import pandas as pd

        return pd.Series(
            [None if b is None else keep(b, None if k is None else list(k))[0] for b, k in zip(bodies, lists, strict=True)],
            dtype=object,
        )

    joined = docs.join(keys, docs[doc_id].eqNullSafe(keys[of]), "left")
    changed = F.when(F.col(gone).isNull(), F.col(text)).otherwise(strip(F.col(text), F.col(gone)))
    return joined.select(*[changed.alias(c) if c == text else docs[c] for c in docs.columns])
