"""The corpus pipeline: raw documents to packed training sequences.

Every stage works on all rows its predecessor kept; all but the last return the columns of
``documents``. Run under a session whose ``spark.checkpoint.dir`` is a shared folder.

1. Language id: documents without a letter go, and those with a text unlike any learned
   language (cosine under LEAST_SCORE); texts of a length at which labelled documents of a
   learned language score as low are too short to judge and stay.
2. Line dedup: repeated lines of 20 code points and more stay in one document only.
3. N-gram Jaccard join (five words, 0.8): one document of each group of near copies stays.
4. Mixing: sources are sampled or repeated towards their target weights.
5. Packing: token windows of 2,048.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterloom.llm import langid, linededup, mixing, overlap, packing
from meterloom.llm.common import fresh, kept, table

#: Cosine with the nearest language below which a text counts as none: five deviations of a random text's.
LEAST_SCORE = 5 / langid.DIMENSIONS**0.5
#: Share of a length's labelled documents that may score lower where texts are judged.
LOW = 0.01
#: Words that a packing worker remembers: its executor still holds what the stages before took.
REMEMBERED = 1 << 16


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    into, size = fresh(docs, "language"), fresh(docs, "length")
    grams = F.col(into)["grams"]
    # Lengths by powers of two: some 40 rows reach the driver.
    named = langid.measured(docs, into=into).withColumn(size, F.floor(F.log2(F.greatest(grams, F.lit(1)))))
    named = kept(named, "language-scores")
    own = named.where(F.col(into)["lang"] == F.col("lang")).groupBy(size)
    low = own.agg(F.percentile_approx(F.col(into)["score"], LOW).alias("low"))
    judged = [row[size] for row in low.where(F.col("low") >= LEAST_SCORE).collect()]
    good = (F.col(into)["score"] >= LEAST_SCORE) | ~F.col(size).isin(judged)
    return named.where((F.col(into)["lang"] != langid.UNKNOWN) & good).drop(into, size)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return linededup.without_repeats(docs)


def keep_one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the smallest id of a group, and documents without id."""
    return overlap.one_of_each(docs, n=5, percent=80)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed(docs)


def pack_windows(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("word_bpe_49k.json")
    return packing.packed(docs, path, size=2048, end=1, remembered=REMEMBERED)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language id", identify_language),
    ("line dedup", drop_repeated_lines),
    ("n-gram jaccard join", keep_one_of_near_copies),
    ("mixing sources", mix_sources),
    ("packing", pack_windows),
]

#: Prototypes and tokenizers are beyond SQL: tests hold line dedup and the join against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = kept(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
