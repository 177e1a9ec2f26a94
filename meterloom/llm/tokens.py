"""Token counts from distinct pre-tokens, and token ids from remembered words.

Both rest on one fact: a tokenizer's pieces never reach over certain white space, so a
text's tokens are those of its units, one after the other.

:func:`token_counts` counts the pieces of each distinct unit of the corpus once, in
a table, and joins it to the documents' unit frequencies; no ids are kept. Most
frequencies need no join: the ``common`` most frequent units and their pieces, a
table of bounded size, are known to every task, which sums them on the spot. Only the
other units of a document become rows, keyed by the unit, and are summed again by document.
A frequent unit is common and never a key, so no key is hot.

Defined cases: a null or empty text has no token; special strings inside a text count as
the tokenizer's default has it; repeated rows and ids are counted row by row; an empty table gives
an empty result; other columns are ignored.
"""

from __future__ import annotations

import os
import re
from collections import Counter
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterloom.llm.common import kept, mapped

#: Units that every task knows: at most COMMON of at most COMMON_CHARS code points.
COMMON, COMMON_CHARS = 1 << 18, 24
#: Characters of text whose units are in memory at once.
PIECE = 1 << 20
#: Distinct units a task sums before it sends them.
SENT = 1 << 18
#: Words of each of the two generations that a worker remembers the ids of, some 150 bytes each.
REMEMBERED = 1 << 19
#: Longer words are not remembered.
WORD_CHARS = 64

# White space as the tokenizer's pattern has it: Python's without the four separators.
_WHITE, _BLACK = r"[^\S\x1c-\x1f]", r"[\S\x1c-\x1f]"
UNIT = re.compile(f"{_WHITE}*{_BLACK}+|{_WHITE}+")
#: A stop or comma behind anything but a plain letter, digit or gap: both may be one piece.
MARK_RUN = re.compile(r"[.,](?<=[^0-9A-Za-zÀ-ÖØ-öø-ÿ \n][.,])")
DOUBLE_WHITE = re.compile(r"\s\s")

Rows = Iterator[pa.RecordBatch]


@cache
def tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def units(text: str) -> list[str]:
    """Pieces of a text, each white space (if any) and then none, the last maybe white.

    Byte-level pre-tokens never hold white space after anything else, and what they look
    ahead to is in the same unit, so units are tokenized on their own.
    """
    if DOUBLE_WHITE.search(text):
        return UNIT.findall(text)
    # Single white characters only: cutting before every space and line end is the same.
    parts = text.replace("\n", " \n").split(" ")
    found = [part if part[:1] == "\n" else " " + part for part in parts[1:]]
    return ([parts[0]] if parts[0] else []) + found


def pieces(path: str, words: list[str]) -> list[int]:
    return [len(e) for e in tokenizer(path).encode_batch_fast(words, add_special_tokens=False)]


def portions(batch: pa.RecordBatch, column: int, piece: int = PIECE) -> Iterator[tuple[list[int], list[str]]]:
    """Row numbers and texts of a batch, about ``piece`` characters at a time."""
    rows, texts, size = [], [], 0
    for i, body in enumerate(batch.column(column)):
        rows.append(i)
        texts.append(body.as_py() or "")
        size += len(texts[-1])
        if size >= piece:
            yield rows, texts
            rows, texts, size = [], [], 0
    if rows:
        yield rows, texts


def unit_table(docs: DataFrame, path: str) -> DataFrame:
    """unit, seen (documents that hold it), pieces: one row per distinct unit."""

    def distinct(batches: Rows) -> Rows:
        for batch in batches:
            seen: Counter[str] = Counter()
            for _, texts in portions(batch, 0):
                for text in texts:
                    seen.update(set(units(text)))
                if len(seen) > SENT:
                    yield _counter(seen)
                    seen = Counter()
            yield _counter(seen)

    def count(batches: Rows) -> Rows:
        for batch in batches:
            found = pieces(path, batch.column(0).to_pylist())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.int64())], ["unit", "seen", "pieces"])

    seen = mapped(docs.select("text"), distinct, "unit string, seen bigint")
    return mapped(seen.groupBy("unit").agg(F.sum("seen").alias("seen")), count, "unit string, seen bigint, pieces bigint")


def _counter(seen: Counter[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(list(seen), pa.string()), pa.array(list(seen.values()), pa.int64())], ["unit", "seen"]
    )


def token_counts(
    docs: DataFrame, path: str, limit: int = 1024, doc_id: str = "doc_id", text: str = "text", common: int = COMMON
) -> DataFrame:
    """Per document: doc_id, n_bytes, n_tokens, over_limit (more than ``limit``)."""
    docs = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    table = kept(unit_table(docs, path), "token-units")
    usual = (
        table.where(F.length("unit") <= COMMON_CHARS)
        .orderBy(F.desc("seen"), "unit")
        .limit(common)
        .select("unit", "pieces")
        .toArrow()
    )
    shared = docs.sparkSession.sparkContext.broadcast(
        dict(zip(usual.column(0).to_pylist(), usual.column(1).to_pylist(), strict=True))
    )
    kind = docs.schema["doc_id"].dataType.simpleString()

    def frequencies(batches: Rows) -> Rows:
        """A row per document (unit null, known tokens), and one per other unit of it."""
        known = shared.value
        row = TaskContext.get().partitionId() << 40
        for batch in batches:
            sizes: list[int] = []
            for at, texts in portions(batch, 1):
                heads, sizes = [], []
                rows, rest, times = [], [], []
                for text in texts:
                    row += 1
                    total = 0
                    for unit, n in Counter(units(text)).items():
                        here = known.get(unit)
                        if here is None:
                            rows.append(row)
                            rest.append(unit)
                            times.append(n)
                        else:
                            total += here * n
                    heads.append((row, total))
                    sizes.append(len(text.encode()))
                n, m = len(heads), len(rows)
                none = pa.nulls(m, batch.schema.field(0).type)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([h[0] for h in heads] + rows, pa.int64()),
                        pa.concat_arrays([batch.column(0).take(pa.array(at, pa.int64())), none]),
                        pa.array(sizes + [None] * m, pa.int64()),
                        pa.array([None] * n + rest, pa.string()),
                        pa.array([h[1] for h in heads] + times, pa.int64()),
                    ],
                    ["row", "doc_id", "n_bytes", "unit", "times"],
                )

    found = mapped(docs, frequencies, f"row bigint, doc_id {kind}, n_bytes bigint, unit string, times bigint")
    found = kept(found, "token-frequencies")
    others = (
        found.where("unit IS NOT NULL")
        .join(table.select("unit", "pieces"), "unit")
        .select("row", F.lit(None).cast(kind).alias("doc_id"), F.lit(None).cast("long").alias("n_bytes"), (F.col("times") * F.col("pieces")).alias("times"))
    )
    heads = found.where("unit IS NULL").select("row", "doc_id", "n_bytes", "times")
    summed = heads.union(others).groupBy("row").agg(
        F.max("doc_id").alias("doc_id"), F.max("n_bytes").alias("n_bytes"), F.sum("times").alias("n_tokens")
    )
    return summed.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))


def plain_words(text: str) -> list[str]:
    """A text cut where a lower-casing tokenizer that drops white space cuts it too:
    at spaces and line ends, and before a stop or comma that follows a Latin letter or digit.

    Latin-1 texts are lower-cased first, as every such character has one lower case and
    no other composed form; not so where a special string might then arise.
    """
    if text.isascii() or _latin(text):
        if "<|" not in text:
            text = text.lower()
    if not MARK_RUN.search(text):
        text = text.replace(".", " .").replace(",", " ,")
    return text.replace("\n", " ").split(" ")


def _latin(text: str) -> bool:
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return True


class Remembered(dict[str, bytes]):
    """Words and their ids, at most ``most`` met since the last change; ``old`` has those before it."""

    def __init__(self, most: int) -> None:
        super().__init__()
        self.most = most
        self.old: dict[str, bytes] = {}
        #: Words met for the first time, with room for their ids.
        self.new: dict[str, bytearray] = {}

    def __missing__(self, word: str) -> bytes | bytearray:
        if len(self) >= self.most:
            self.old = dict(self)
            self.clear()
        ids = self.old.get(word)
        if ids is None:
            # Both generations may have dropped a word of this very portion.
            ids = self.new.setdefault(word, bytearray())
        self[word] = ids
        return ids


class WordIds:
    """Token ids of texts whose :func:`plain_words` are remembered, two generations
    of ``remembered`` words: what was used since the last change outlives the next."""

    def __init__(self, path: str, remembered: int | None = None) -> None:
        self.path = path
        self.young = Remembered(remembered or REMEMBERED)

    @property
    def old(self) -> dict[str, bytes]:
        return self.young.old

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text (unsigned 32-bit)."""
        young = self.young
        parts = [list(map(young.__getitem__, plain_words(text))) for text in texts]
        new, young.new = young.new, {}
        encodings = tokenizer(self.path).encode_batch_fast(list(new), add_special_tokens=False)
        for ids, encoding in zip(new.values(), encodings, strict=True):
            ids += np.array(encoding.ids, np.uint32).tobytes()
        found = [np.frombuffer(b"".join(part), np.uint32) for part in parts]
        for generation in (young, young.old):
            for word in generation.keys() & new.keys():
                if len(word) > WORD_CHARS:
                    del generation[word]
                else:
                    generation[word] = bytes(new[word])
        return found


@cache
def word_ids(path: str, remembered: int | None = None) -> WordIds:
    return WordIds(path, remembered)
