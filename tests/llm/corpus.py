"""Small documents with every awkward case, and with planted copies."""

from __future__ import annotations

import random

from pyspark.sql import types as T

SCHEMA = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
        # Names that operators use inside.
        T.StructField("size", T.StringType()),
        T.StructField("key", T.StringType()),
        T.StructField("line_of", T.StringType()),
        T.StructField("mix_of", T.StringType()),
        T.StructField("language", T.StringType()),
    ]
)


def prose(rng: random.Random, n: int, syllables: str = "th an er on re ing st ou") -> str:
    parts = syllables.split()
    return " ".join("".join(rng.choices(parts, k=rng.randint(1, 4))) for _ in range(n))


def texts() -> list[str | None]:
    rng = random.Random(5)
    base = prose(rng, 120)
    near = base.split()
    near[60] = "Changed"
    passage = prose(rng, 80)
    lines = "A repeated line of enough length\n  a REPEATED line of enough length\t\nshort"
    long = prose(rng, 6000)
    out: list[str | None] = [None, "", " ", "\n", "\n\n\n", "one", "ONE", "one two", "É é", "12 34 !?", "a\x1cb c\x85d"]
    out += [base, base, base.upper(), " ".join(near), base + " tail end", base.replace(" ", "\n")]
    out += [prose(rng, 50) + " " + passage + " " + prose(rng, 40) for _ in range(4)]
    out += [lines, lines + "\nmore", "x\n" + lines, lines.replace("enough", "ENOUGH")]
    out += ["na " * 400, "a" * 3000, "ab" * 900, long, long + " x", "word%%% " * 60, "  two  spaces \n \n\tand tabs ", "tail space "]
    out += ["before<|endoftext|>after <|endoftext|>", "it's we'll THEY'RE 1234 naïve 你好 🙂🙂"]
    out += [prose(rng, rng.randint(5, 90), "der sch ein ung be ver") for _ in range(12)]
    out += [prose(rng, rng.randint(5, 90)) for _ in range(12)]
    return out


def rows() -> list[tuple]:
    out = []
    for i, text in enumerate(texts()):
        lang = None if i % 7 == 0 else ("de" if text and "sch" in text else "en")
        source = None if i % 9 == 0 else f"src{(i % 4) ** 2}"
        out.append((i + 1, text, lang, source, len(text or ""), None, "k", "l", "m", "n"))
    return out


def frame(spark, data=None):
    return spark.createDataFrame(rows() if data is None else data, SCHEMA).repartition(3, "n_chars")
