"""Mixing sources to target weights with hash-threshold histograms.

Every document has a hash of its id (of its text if that is null). A source takes whole copies of all its
documents, and one more copy of those whose hash is at most the source's threshold.
The threshold comes from histograms of words by source and hash bucket: the bucket
in which the budget ends is the only one that is split further, level by level, until
it holds one hash value. Nothing is sorted and no document passes the driver.

Defined cases: a null text has size 0; a null source is a source of its own; repeated
ids share one hash and are taken together, as do equal texts without id; a source of size 0 has target 0; an empty
table gives an empty result. Extra columns are ignored by :func:`plan_mix` and kept
by :func:`mixed`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meterloom.llm.common import WORD, fresh, kept

#: Bits of the hash (the first 15 hexadecimal digits of an MD5) and of one level.
HASH_BITS, LEVEL_BITS = 60, 12


def words_in(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def id_hash(doc_id: Column, text: Column) -> Column:
    """Hash of the id; of the text where there is no id, so that such rows are not all alike."""
    body = F.concat(F.lit("\n"), F.coalesce(text.cast("string"), F.lit("")))
    digits = F.substring(F.md5(F.coalesce(doc_id.cast("string"), body).cast("binary")), 1, 15)
    return F.conv(digits, 16, 10).cast("long")


def source_targets(sized: DataFrame, weights: tuple[int, ...], cap: int) -> DataFrame:
    """One row per source: size, target, whole copies and words still needed.

    Water filling: sources sorted by cap over weight are capped until the level that
    shares the rest among the others lies below the next cap. The windows see one
    row per source.
    """
    sources = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    order = Window.orderBy(F.col("source").isNull(), "source")
    weight = F.element_at(
        F.array(*[F.lit(w) for w in weights]),
        ((F.row_number().over(order) - 1) % len(weights) + 1).cast("int"),
    )
    limit = F.col("source_size") * cap
    weighed = sources.select("*", weight.cast("long").alias("weight"), limit.alias("limit"))
    rising = Window.orderBy(F.col("limit") / F.col("weight"), F.col("source").isNull(), "source")
    below, rest = rising.rowsBetween(Window.unboundedPreceding, -1), rising.rowsBetween(0, Window.unboundedFollowing)
    every = rising.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    left = F.sum("source_size").over(every) - F.coalesce(F.sum("limit").over(below), F.lit(0))
    levels = weighed.select(
        "*", (left.cast("double") / F.sum("weight").over(rest)).alias("level")
    )
    fits = F.when(F.col("level") * F.col("weight") <= F.col("limit"), F.col("level"))
    level = F.first(fits, ignorenulls=True).over(every)
    target = F.least(F.col("limit").cast("double"), F.col("weight") * level)
    aimed = levels.select("source", "source_size", F.coalesce(target, F.lit(0.0)).alias("target"))
    copies = F.when(
        F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))
    ).otherwise(0)
    return aimed.select("*", copies.cast("long").alias("copies")).select(
        "*", (F.col("target") - F.col("copies") * F.col("source_size")).alias("need")
    )


def thresholds(sized: DataFrame, targets: DataFrame) -> DataFrame:
    """``targets`` with the largest hash a source takes once more (-1: none)."""
    bounds = kept(
        targets.select(
            "*",
            F.lit(0).cast("long").alias("low"),
            F.lit((1 << HASH_BITS) - 1).cast("long").alias("high"),
            F.lit(0).cast("long").alias("before"),
            F.lit(0).cast("long").alias("inside"),
        ),
        "mix-bounds",
    )
    for shift in range(HASH_BITS - LEVEL_BITS, -1, -LEVEL_BITS):
        edges = bounds.select(
            F.col("source").alias("of"), "low", "high", F.col("before").alias("start"), "need"
        )
        histogram = (
            sized.join(
                edges,
                F.col("source").eqNullSafe(F.col("of")) & F.col("hash").between(F.col("low"), F.col("high")),
            )
            .groupBy("of", F.shiftright("hash", shift).alias("bucket"), "start", "need")
            .agg(F.sum("size").alias("inside"), F.min("hash").alias("low"), F.max("hash").alias("high"))
        )
        upto = Window.partitionBy("of").orderBy("bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        running = histogram.select("*", (F.col("start") + F.sum("inside").over(upto)).alias("until"))
        # The first bucket that ends beyond the need, else the last one.
        ends = F.struct((F.col("until") <= F.col("need")).alias("a"), F.when(F.col("until") <= F.col("need"), -F.col("bucket")).otherwise(F.col("bucket")).alias("b"))
        edge = running.groupBy("of").agg(
            F.min_by(F.struct("low", "high", (F.col("until") - F.col("inside")).alias("before"), "inside"), ends).alias("edge")
        )
        bounds = kept(
            targets.join(edge, F.col("source").eqNullSafe(F.col("of"))).select(*targets.columns, "edge.*"),
            "mix-bounds",
        )
        if not bounds.where("low < high").limit(1).count():
            break
    # The last bucket is one hash value: take it if that brings the sum nearer.
    nearer = F.col("before") + F.col("inside") / 2 <= F.col("need")
    last = F.when(F.col("need") <= 0, -1).when(nearer, F.col("high")).otherwise(F.col("low") - 1)
    return bounds.select("source", "source_size", "target", "copies", last.alias("threshold"))


def mix_limits(
    docs: DataFrame, doc_id: str, text: str, source: str, weights: tuple[int, ...], cap: int
) -> tuple[DataFrame, DataFrame]:
    """Sizes and hashes of the documents; whole copies and threshold of the sources."""
    sized = kept(
        docs.select(
            F.col(doc_id).alias("doc_id"),
            F.col(source).alias("source"),
            words_in(F.col(text)).alias("size"),
            id_hash(F.col(doc_id), F.col(text)).alias("hash"),
        ),
        "mix-sizes",
    )
    targets = kept(source_targets(sized, weights, cap), "mix-targets")
    return sized, thresholds(sized, targets)


def plan_mix(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    weights: tuple[int, ...] = (1, 2, 3),
    cap: int = 3,
) -> DataFrame:
    """Per document: doc_id, size, source_size, target, taken (words, repeats counted)."""
    sized, limits = mix_limits(docs, doc_id, text, source, weights, cap)
    limits = limits.withColumnRenamed("source", "of")
    times = F.col("copies") + (F.col("hash") <= F.col("threshold")).cast("long")
    return sized.join(limits, F.col("source").eqNullSafe(F.col("of"))).select(
        "doc_id", "size", "source_size", "target", (times * F.col("size")).alias("taken")
    )


def mixed(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    weights: tuple[int, ...] = (1, 2, 3),
    cap: int = 3,
) -> DataFrame:
    """The mix itself: every row of ``docs`` as often as it is taken, same columns."""
    _, limits = mix_limits(docs, doc_id, text, source, weights, cap)
    of, times, copy = (fresh(docs, name) for name in ("mix_of", "mix_times", "mix_copy"))
    limits = limits.select(
        F.col("source").alias(of), F.struct("copies", "threshold").alias(times)
    )
    taken = F.col(times)["copies"] + (id_hash(F.col(doc_id), F.col(text)) <= F.col(times)["threshold"]).cast("long")
    repeats = F.when(taken > 0, F.sequence(F.lit(1), taken))
    return docs.join(limits, F.col(source).eqNullSafe(F.col(of))).select(
        *[docs[column] for column in docs.columns], F.explode(repeats).alias(copy)
    ).drop(copy)
