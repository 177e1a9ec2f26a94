"""Language identification with hyperdimensional profiles.

Every letter (and the gap between words) has a random vector of +1 and -1. An n-gram is
its letters' vectors, each permuted by its distance from the end, multiplied together;
a document is the sum of its n-grams; a language is the sum of the signs of its training
documents. A document gets the language whose prototype has the largest cosine.

Every task needs all prototypes: languages x DIMENSIONS numbers. Prototypes come from at
most about ``train_docs`` labelled documents, taken by a hash of the id; predictions
read every whole text. Letter vectors follow from the code point, so tasks agree.

Defined cases: a null text, or one without a letter, is ``und`` with score 0; so is every
text if nothing can be learned. A null label or null id teaches nothing. Equal cosines go to the smaller
language name. Repeated rows get equal answers; other columns are kept by
:func:`identified` and do not matter.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache, lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterloom.llm.common import fresh, mapped, ship, small_batches
from meterloom.llm.terms import body_portions

UNKNOWN = "und"
DIMENSIONS, N, SEED = 1024, 3, 7
#: n-gram vectors a worker keeps (one byte a dimension); it starts anew when they are full.
REMEMBERED = 1 << 15
#: Code points that are handled at once.
PIECE = 1 << 20


@cache
def letters() -> np.ndarray:
    """Code point to its lower-case letter, or 0 if it is no letter."""
    table = np.zeros(0x110000, np.int64)
    for point in range(0x110000):
        char = chr(point)
        if char.isalpha():
            low = char.lower()
            table[point] = ord(low) if len(low) == 1 else point
    return table


def grams(text: str) -> Iterator[np.ndarray]:
    """Keys of the n-grams of a text: words are framed by one gap (letter 0)."""
    carry = np.zeros(1, np.int64)
    for at in range(0, len(text) + 1, PIECE):
        piece = text[at : at + PIECE]
        points = np.frombuffer(piece.encode("utf-32-le", "surrogatepass"), np.uint32)
        line = np.concatenate((carry, letters()[points]))
        if at + PIECE > len(text):
            line = np.append(line, 0)
        keep = np.ones(len(line), bool)
        keep[1:] = (line[1:] != 0) | (line[:-1] != 0)
        line = line[keep]
        if len(line) >= N:
            keys = np.zeros(len(line) - N + 1, np.int64)
            for k in range(N):
                keys = (keys << 21) | line[k : len(line) - N + 1 + k]
            yield keys
        carry = line[-(N - 1) :]


@lru_cache(1 << 12)
def letter_vector(point: int) -> np.ndarray:
    bits = np.random.Generator(np.random.PCG64([SEED, point])).integers(0, 2, DIMENSIONS, dtype=np.int8)
    return bits * 2 - 1


class Space:
    """n-gram vectors, made when first met."""

    def __init__(self) -> None:
        self.rows: dict[int, int] = {}
        self.vectors = np.zeros((REMEMBERED, DIMENSIONS), np.int8)

    def vector(self, key: int) -> np.ndarray:
        product = np.ones(DIMENSIONS, np.int8)
        for distance in range(N):
            point = (key >> (21 * distance)) & 0x1FFFFF
            product = product * np.roll(letter_vector(point), distance)
        return product

    def bundle(self, keys: np.ndarray) -> np.ndarray:
        """Sum of the vectors of all keys."""
        total = np.zeros(DIMENSIONS, np.float32)
        keys, counts = np.unique(keys, return_counts=True)
        for at in range(0, len(keys), 4096):
            part = keys[at : at + 4096].tolist()
            if len(self.rows) + len(part) > REMEMBERED:
                self.rows.clear()
            for key in part:
                if key not in self.rows:
                    self.vectors[len(self.rows)] = self.vector(key)
                    self.rows[key] = len(self.rows)
            index = np.fromiter((self.rows[key] for key in part), np.int64, len(part))
            total += counts[at : at + 4096].astype(np.float32) @ self.vectors[index].astype(np.float32)
        return total

    def measure(self, text: str | None) -> tuple[np.ndarray, int]:
        """The document's vector, and how many n-grams it is the sum of."""
        total, seen = np.zeros(DIMENSIONS, np.float64), 0
        for keys in grams(text or ""):
            total += self.bundle(keys)
            seen += len(keys)
        return total, seen

    def document(self, text: str | None) -> np.ndarray | None:
        """The document's vector, or None without letters."""
        total, seen = self.measure(text)
        return total if seen else None


@cache
def space() -> Space:
    return Space()


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def prototypes(labelled: DataFrame, text: str, lang: str, doc_id: str, train_docs: int) -> dict[str, np.ndarray]:
    """One vector per language; what the driver gets is this model."""
    named = labelled.where(F.col(lang).isNotNull() & F.col(doc_id).isNotNull())
    rows = named.count()
    if rows > train_docs:
        named = named.where(F.pmod(F.xxhash64(doc_id), F.lit(1 << 30)) < int((1 << 30) * train_docs / rows))

    def bundles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Gone with the task: a worker outlives it and serves the stages that follow.
        own = Space()
        sums: dict[str, np.ndarray] = {}

        def out() -> pa.RecordBatch:
            names = list(sums)
            values = pa.array([sums[name].tolist() for name in names], pa.list_(pa.int64()))
            return pa.RecordBatch.from_arrays([pa.array(names, pa.string()), values], ["lang", "bundle"])

        for batch in batches:
            for body, name in zip(batch.column(0), batch.column(1), strict=True):
                vector = own.document(body.as_py())
                if vector is not None:
                    sums.setdefault(name.as_py(), np.zeros(DIMENSIONS, np.int64))
                    sums[name.as_py()] += np.sign(vector).astype(np.int64)
            if len(sums) > 64:
                yield out()
                sums = {}
        if sums:
            yield out()

    parts = mapped(named.select(F.col(text).cast("string"), F.col(lang).cast("string")), 
        bundles, "lang string, bundle array<bigint>"
    )
    summed = (
        parts.select("lang", F.posexplode("bundle").alias("at", "value"))
        .groupBy("lang", "at")
        .agg(F.sum("value").alias("value"))
    )
    model: dict[str, np.ndarray] = {}
    for row in summed.toLocalIterator():
        model.setdefault(row["lang"], np.zeros(DIMENSIONS))[row["at"]] = row["value"]
    return model


def predictor(model: dict[str, np.ndarray]):
    """A column function: text to struct(lang, score)."""
    names = sorted(model)
    matrix = np.array([model[name] / (np.linalg.norm(model[name]) or 1) for name in names], np.float32)

    @F.pandas_udf("lang string, score double")
    def predict(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for part in parts:
            found = []
            for body in part:
                vector = space().document(body) if names else None
                length = np.linalg.norm(vector) if vector is not None else 0
                if vector is None:
                    found.append((UNKNOWN, 0.0))
                else:
                    cosines = matrix @ (vector / (length or 1)).astype(np.float32)
                    best = int(np.argmax(cosines))
                    found.append((names[best], float(min(1.0, max(0.0, cosines[best])))))
            yield pd.DataFrame(found, columns=["lang", "score"])

    return predict


def identified(
    docs: DataFrame,
    labelled: DataFrame | None = None,
    doc_id: str = "doc_id",
    text: str = "text",
    lang: str = "lang",
    train_docs: int = 200_000,
    into: str = "language",
) -> DataFrame:
    """``docs`` with struct ``into`` (lang, score), learned from ``labelled`` documents,
    by default those of ``docs`` that :func:`held_out` leaves for learning."""
    if labelled is None:
        labelled = docs.where(~held_out(F.col(doc_id)))
    ship(docs.sparkSession)
    predict = predictor(prototypes(labelled, text, lang, doc_id, train_docs))
    return docs.withColumn(into, predict(F.col(text).cast("string")))


def measured(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    lang: str = "lang",
    train_docs: int = 200_000,
    into: str = "language",
) -> DataFrame:
    """``docs`` with struct ``into`` (lang, score, grams: the text's n-grams), learned as
    :func:`identified` learns, in one pass over the texts.

    Texts come and go in small portions, and n-gram vectors go with the task that made them.
    """
    small_batches(docs.sparkSession)
    model = prototypes(docs.where(~held_out(F.col(doc_id))), text, lang, doc_id, train_docs)
    names = sorted(model)
    matrix = np.array([model[name] / (np.linalg.norm(model[name]) or 1) for name in names], np.float32)
    body = fresh(docs, "body")
    kind = T.StructType([T.StructField("lang", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("grams", T.LongType())])

    def answer(vector: np.ndarray, grams_: int) -> dict:
        if not grams_ or not names:
            return {"lang": UNKNOWN, "score": 0.0, "grams": grams_}
        cosines = matrix @ (vector / (np.linalg.norm(vector) or 1)).astype(np.float32)
        best = int(np.argmax(cosines))
        return {"lang": names[best], "score": float(min(1.0, max(0.0, cosines[best]))), "grams": grams_}

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Space()
        fields = pa.struct([("lang", pa.string()), ("score", pa.float64()), ("grams", pa.int64())])
        for batch in batches:
            at = batch.schema.get_field_index(body)
            rest = batch.drop_columns([body])
            for row, bodies in body_portions(batch, at):
                found = [answer(*own.measure(text_.decode())) for text_ in bodies]
                part = rest.slice(row, len(bodies))
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(found, fields)], [*part.schema.names, into])

    encoded = docs.withColumn(body, F.encode(F.col(text).cast("string"), "UTF-8"))
    return mapped(encoded, measure, T.StructType([*docs.schema.fields, T.StructField(into, kind)]))
