"""Grouping of spelling variants by a frequency-vector trie.

A word has a vector: how many of its letters are in each of GROUPS letter groups. The
trie has a level per group and branches by the count. One inserted, deleted or replaced
letter raises at most one count by one and lowers at most one by one, so a depth-first
search that may spend one surplus and one deficit meets every near word at its leaf. Leaf words
are verified letter by letter. The search goes down with all words at once: a node keeps those
that still have the budget to be there.

The vocabulary is counted in one shuffle and never leaves the cluster. The upper trie,
all nodes of more than ``shard_words`` words and their children, is found level by level by
counts; its leaves are the shards. It has about vocabulary / shard_words nodes a level
and is all the driver gets. Every word goes down it: to its own shard, and to the
shards behind its own that the budget reaches. A leaf of equal vectors with more words is
dealt into tiles. A shard is searched in one task, with a trie of its own.

Each pair is met once, and a shard sends one row per word: its near words' number and best. A form has
at least ten times its word's count, so chains are short, and following all of them at once
doubles the distance each round.

Defined cases: a null text has no runs; a null id is an empty one; repeated rows count
repeatedly; an empty table gives an empty result; other columns are ignored. Words are of
Latin-1 letters, of any length.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterloom.llm.arrays import prefix_sums, spans
from meterloom.llm.common import kept, mapped, ship
from meterloom.llm.terms import body_portions

LEAST_CHARS, LEAST_COUNT, FORM_TIMES, SPOILT = 7, 2, 10, 31
#: Letter groups, from even to rare; every letter that is not named is in the last one.
LETTERS = ("e", "n", "t", "h", "i", "s", "r", "a", "o", "dl", "cu", "gy", "bvk", "mwp")
GROUPS = len(LETTERS) + 1
#: Words of a shard.
SHARD_WORDS = 1 << 14
#: Word pairs that are compared at once, and letters of words that are compared as rows of a matrix.
PAIRS, WIDTH = 1 << 16, 40

Rows = Iterator[pa.RecordBatch]

_GROUP = np.full(256, GROUPS - 1, np.int64)
for _number, _letters in enumerate(LETTERS):
    for _letter in _letters:
        _GROUP[ord(_letter)] = _number
#: zlib.crc32 of single bytes, without its first and last step.
_CRC = np.array([zlib.crc32(bytes([byte])) ^ zlib.crc32(b"\0") for byte in range(256)], np.uint32)


def spoilt(run: bytes, value: int) -> bytes:
    """The UTF-8 run without the letter that its checksum names."""
    letters = run.decode()
    at = value % len(letters)
    return (letters[:at] + letters[at + 1 :]).encode()


def checksums(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, first: np.ndarray) -> np.ndarray:
    """crc32 of data[start:end] for each pair, continued from ``first``."""
    size = ends - starts
    order = np.argsort(-size, kind="stable")
    at, left = starts[order], -size[order]
    value = first[order] ^ np.uint32(0xFFFFFFFF)
    for k in range(int(size.max(initial=0))):
        n = np.searchsorted(left, -k)
        value[:n] = _CRC[(value[:n] ^ data[at[:n] + k]) & 255] ^ (value[:n] >> np.uint32(8))
    found = np.empty_like(value)
    found[order] = value ^ np.uint32(0xFFFFFFFF)
    return found


def words_of(names: list[bytes], bodies: list[bytes], least_chars: int, every: int) -> tuple[pa.Array, np.ndarray]:
    """Distinct words of texts and how often they occur, without a Python object for most of them."""
    text = b"\n".join(bodies).lower()
    data = np.frombuffer(text, np.uint8)
    lead = data == 0xC3
    inside = np.zeros(len(data) + 2, bool)
    inside[1:-1] = ((data >= 97) & (data <= 122)) | lead
    inside[2:-1] |= lead[:-1]
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = edges[0::2], edges[1::2]
    double = np.concatenate(([0], np.cumsum(lead)))
    long = ends - starts - (double[ends] - double[starts]) >= least_chars
    starts, ends = starts[long], ends[long]
    body = np.searchsorted(np.cumsum([len(body) + 1 for body in bodies]), starts, "right")
    first = np.array([zlib.crc32(name) for name in names], np.uint32)[body]
    short = ends - starts <= 2 * WIDTH
    value = np.zeros(len(starts), np.uint32)
    value[short] = checksums(data, starts[short], ends[short], first[short])
    for k in np.flatnonzero(~short).tolist():
        value[k] = zlib.crc32(text[starts[k] : ends[k]], int(first[k]))
    hit = value % every == 0
    odd = [spoilt(text[a:b], v) for a, b, v in zip(starts[hit].tolist(), ends[hit].tolist(), value[hit].tolist(), strict=True)]
    odd = [word for word in odd if len(word.decode()) >= least_chars]
    starts, ends = starts[~hit], ends[~hit]
    _, one, times = np.unique(spans(prefix_sums(data), starts, ends), return_index=True, return_counts=True)
    starts, size = starts[one], ends[one] - starts[one]
    stops = np.cumsum(size)
    letters = data[np.repeat(starts - stops + size, size) + np.arange(size.sum())]
    offsets = np.concatenate(([0], stops)).astype(np.int32)
    words = pa.StringArray.from_buffers(len(one), pa.py_buffer(offsets), pa.py_buffer(letters))
    words = pa.concat_arrays([words, pa.array([word.decode() for word in odd], pa.string())])
    return words, np.concatenate((times, np.ones(len(odd), np.int64)))


def vocabulary(docs: DataFrame, least_chars: int, least_count: int, every: int) -> DataFrame:
    """word, n: the words of ``docs`` (doc_id, body) and how often they occur."""

    def count(batches: Rows) -> Rows:
        for batch in batches:
            names = [(name or "").encode() + b":" for name in batch.column(0).to_pylist()]
            for row, bodies in body_portions(batch, 1):
                words, times = words_of(names[row : row + len(bodies)], bodies, least_chars, every)
                yield pa.RecordBatch.from_arrays([words, pa.array(times)], ["word", "n"])

    counted = mapped(docs, count, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))
    return counted.where(F.col("n") >= least_count)


def vectors(words: list[bytes]) -> np.ndarray:
    """A row of letter-group counts for each word; counts of 100 and more are 100."""
    letters = np.frombuffer(b"".join(words), np.uint8)
    row = np.repeat(np.arange(len(words)), [len(word) for word in words])
    counts = np.bincount(row * GROUPS + _GROUP[letters], minlength=len(words) * GROUPS)
    return np.minimum(counts, 100).astype(np.uint8).reshape(len(words), GROUPS)


def spend(own: np.ndarray, count: int, surplus: np.ndarray, deficit: np.ndarray):
    """Which words may go to the child with this count, and what they have left then."""
    change = own.astype(np.int16) - count
    go = (change == 0) | ((change == 1) & surplus) | ((change == -1) & deficit)
    return go, surplus & (change != 1), deficit & (change != -1)


class Shards:
    """The upper trie: prefixes of counts that end in a leaf, and tiles of each leaf."""

    def __init__(self, leaves: dict[bytes, int]) -> None:
        self.names = sorted(leaves)
        self.tiles = np.array([leaves[name] for name in self.names], np.int64)
        self.first = np.cumsum(self.tiles) - self.tiles
        self.root: dict = {}
        for number, name in enumerate(self.names):
            node = self.root
            for count in name[:-1]:
                node = node.setdefault(count, {})
            node[name[-1]] = number

    def reached(self, rows: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(leaf, words that reach it, which of them are at home there), depth first."""
        every = np.arange(len(rows))
        free = np.ones(len(rows), bool)
        stack = [(self.root, 0, every, free, free)]
        while stack:
            node, level, words, surplus, deficit = stack.pop()
            if isinstance(node, int):
                yield node, words, surplus & deficit
                continue
            for count, child in node.items():
                go, s, d = spend(rows[words, level], count, surplus, deficit)
                if go.any():
                    stack.append((child, level + 1, words[go], s[go], d[go]))


def upper_trie(rows: DataFrame, shard_words: int) -> Shards:
    """Counts prefixes of ``vector`` level by level, below nodes of more than shard_words words."""
    leaves: dict[bytes, int] = {}
    heavy = [b""]
    for level in range(1, GROUPS + 1):
        if not heavy:
            break
        parent = F.substring("vector", 1, level - 1)
        node = F.substring("vector", 1, level).alias("node")
        open_rows = rows
        if level > 1:
            named = rows.sparkSession.createDataFrame([(bytearray(name),) for name in heavy], "parent binary")
            open_rows = rows.withColumn("parent", parent).join(named, "parent", "left_semi")
        counts = open_rows.groupBy(node).agg(F.count("*").alias("words")).toArrow()
        heavy = []
        for name, words in zip(counts.column("node").to_pylist(), counts.column("words").to_pylist(), strict=True):
            if words > shard_words and level < GROUPS:
                heavy.append(name)
            else:
                leaves[name] = -(-words // shard_words)
    return Shards(leaves)


def dealt(rows: DataFrame, shards: Shards) -> DataFrame:
    """shard, home, word, n: each word at home in one shard, and a guest in those behind it."""
    shared = rows.sparkSession.sparkContext.broadcast(shards)

    def deal(batches: Rows) -> Rows:
        trie = shared.value
        for batch in batches:
            words = [word.encode("latin-1") for word in batch.column(0).to_pylist()]
            if not words:
                continue
            home = np.zeros(len(words), np.int64)
            visits = list(trie.reached(vectors(words)))
            for leaf, at, here in visits:
                home[at[here]] = leaf
            # Equal words never meet, so any spread over tiles will do.
            spread = np.array([zlib.crc32(word) for word in words], np.int64)
            shard, row, at_home = [], [], []
            for leaf, at, here in visits:
                own = spread[at] % trie.tiles[leaf]
                for tile in range(trie.tiles[leaf]):
                    go = np.where(here, tile >= own, leaf > home[at])
                    row.append(at[go])
                    at_home.append((here & (tile == own))[go])
                    shard.append(np.full(go.sum(), trie.first[leaf] + tile))
            row = np.concatenate(row)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.concatenate(shard)),
                    pa.array(np.concatenate(at_home)),
                    batch.column(0).take(pa.array(row)),
                    batch.column(1).take(pa.array(row)),
                ],
                ["shard", "home", "word", "n"],
            )

    return mapped(rows.select("word", "n"), deal, "shard bigint, home boolean, word string, n bigint")


class Leaves:
    """A shard's trie: words at home, sorted by their vectors, so a node is a range of them."""

    def __init__(self, words: list[bytes], at_home: np.ndarray) -> None:
        self.words = words
        rows = vectors(words)
        home = np.flatnonzero(at_home)
        self.order = home[np.lexsort(rows[home].T[::-1])]
        self.home, self.rows = rows[self.order], rows
        self.size = np.array([len(word) for word in words], np.int64)
        letters = np.array([word[:WIDTH].ljust(WIDTH, b"\0") for word in words], f"S{WIDTH}")
        self.left = letters.view(np.uint8).reshape(-1, WIDTH)
        letters = np.array([b"\1" * (WIDTH - len(word)) + word[-WIDTH:] for word in words], f"S{WIDTH}")
        self.right = letters.view(np.uint8).reshape(-1, WIDTH)
        weigh = np.array([1, 256, 65536], np.int32)
        self.head = self.left[:, :3].astype(np.int32) @ weigh
        self.tail = self.right[:, -3:].astype(np.int32) @ weigh

    def met(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs (word, word at home) that the budget allows and that begin or end alike, each once."""
        every = np.arange(len(self.words))
        free = np.ones(len(every), bool)
        stack = [(0, 0, len(self.order), every, free, free)]
        # A pair of words at home counts from its first word on.
        place = np.full(len(every), -1)
        place[self.order] = np.arange(len(self.order))
        head, tail = self.head[self.order], self.tail[self.order]
        while stack:
            level, low, high, words, surplus, deficit = stack.pop()
            if level == GROUPS or (high - low) * len(words) <= PAIRS:
                step = max(1, PAIRS // max(1, high - low))
                for at in range(0, len(words), step):
                    part = slice(at, at + step)
                    a = words[part]
                    # Words have seven letters or more: one change leaves three at the front or three at the end.
                    alike = (self.head[a][:, None] == head[low:high]) | (self.tail[a][:, None] == tail[low:high])
                    alike &= place[a][:, None] < np.arange(low, high)
                    x, y = np.nonzero(alike)
                    change = self.rows[a[x], level:].astype(np.int8) - self.home[y + low, level:].astype(np.int8)
                    go = (np.maximum(change, 0).sum(1) <= surplus[part][x]) & (np.maximum(-change, 0).sum(1) <= deficit[part][x])
                    yield a[x[go]], self.order[y[go] + low]
                continue
            column = self.home[low:high, level]
            edges = np.concatenate(([0], np.flatnonzero(column[1:] != column[:-1]) + 1, [high - low]))
            for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
                go, s, d = spend(self.rows[words, level], int(column[a]), surplus, deficit)
                if go.any():
                    stack.append((level + 1, low + a, low + b, words[go], s[go], d[go]))

    def near(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Which pairs differ by one letter: their common front and end leave out one at most."""
        short = np.minimum(self.size[a], self.size[b])
        gap = np.abs(self.size[a] - self.size[b])
        none = np.zeros(len(a), bool)
        front = np.argmin(np.column_stack((self.left[a] == self.left[b], none)), 1)
        back = np.argmin(np.column_stack((self.right[a][:, ::-1] == self.right[b][:, ::-1], none)), 1)
        good = (gap <= 1) & (np.minimum(front, short) + np.minimum(back, short) >= short - (gap == 0))
        for k in np.flatnonzero(np.maximum(self.size[a], self.size[b]) > WIDTH).tolist():
            good[k] = one_change(self.words[a[k]], self.words[b[k]])
        return good


def one_change(a: bytes, b: bytes) -> bool:
    """Whether two different words differ by one inserted, deleted or replaced letter."""
    a, b = sorted((a, b), key=len)
    if len(b) - len(a) > 1 or a == b:
        return False
    front = next((k for k in range(len(a)) if a[k] != b[k]), len(a))
    return a[front + (len(a) == len(b)) :] == b[front + 1 :]


def near_words(words: list[bytes], n: np.ndarray, at_home: np.ndarray):
    """Per word with a near word here: its number, their number, the best one's number."""
    trie = Leaves(words, at_home)
    left, right = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for a, b in trie.met():
        good = trie.near(a, b)
        left += [a[good], b[good]]
        right += [b[good], a[good]]
    a, b = np.concatenate(left), np.concatenate(right)
    place = np.empty(len(words), np.int64)
    place[sorted(range(len(words)), key=words.__getitem__)] = np.arange(len(words))
    order = np.lexsort((place[b], -n[b], a))
    a, b = a[order], b[order]
    first = np.flatnonzero(np.concatenate(([True], a[1:] != a[:-1]))) if len(a) else np.zeros(0, np.int64)
    return a[first], np.diff(np.append(first, len(a))), b[first]


def _search(group: pa.Table) -> pa.Table:
    names = group.column("word")
    words = [word.encode("latin-1") for word in names.to_pylist()]
    word, count, best = near_words(words, group.column("n").to_numpy(), group.column("home").to_numpy())
    return pa.table(
        {
            "word": names.take(pa.array(word, pa.int64())),
            "near": pa.array(count, pa.int64()),
            "best": names.take(pa.array(best, pa.int64())),
            "best_n": group.column("n").take(pa.array(best, pa.int64())),
        }
    )


def roots(forms: DataFrame) -> DataFrame:
    """word, root: where the forms (word, form) lead; each round doubles the distance."""
    ends = kept(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        ahead = ends.select(F.col("word").alias("root"), F.col("root").alias("far"))
        stepped = ends.join(ahead, "root", "left").select("word", F.coalesce("far", "root").alias("root"), F.col("far").isNotNull().alias("moved"))
        stepped = kept(stepped, "spelling-roots")
        ends = stepped.select("word", "root")
        if not stepped.where("moved").limit(1).count():
            return ends


def variants(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    least_chars: int = LEAST_CHARS,
    least_count: int = LEAST_COUNT,
    form_times: int = FORM_TIMES,
    every: int = SPOILT,
    shard_words: int = SHARD_WORDS,
) -> DataFrame:
    """word, n, n_near, form, form_n, root of every word of the corpus."""
    if least_chars < LEAST_CHARS:
        raise ValueError(f"words have at least {LEAST_CHARS} letters, not {least_chars}")
    ship(docs.sparkSession)
    rows = docs.select(F.col(doc_id).cast("string").alias("doc_id"), F.encode(F.col(text).cast("string"), "UTF-8").alias("body"))
    words = kept(vocabulary(rows, least_chars, least_count, every), "spelling-words")

    def with_vector(batches: Rows) -> Rows:
        for batch in batches:
            found = vectors([word.encode("latin-1") for word in batch.column(0).to_pylist()])
            column = pa.array([row.tobytes() for row in found], pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns, column], ["word", "n", "vector"])

    vectored = kept(mapped(words, with_vector, "word string, n bigint, vector binary"), "spelling-vectors")
    guests = dealt(vectored, upper_trie(vectored, shard_words))
    found = guests.groupBy("shard").applyInArrow(_search, "word string, near bigint, best string, best_n bigint")
    best = F.min(F.struct((-F.col("best_n")).alias("n"), F.col("best").alias("word"))).alias("best")
    near = found.groupBy("word").agg(F.sum("near").alias("n_near"), best)
    good = F.col("best.n") <= F.col("n") * -form_times
    joined = kept(
        words.join(near, "word", "left").select(
            "word",
            "n",
            F.coalesce("n_near", F.lit(0)).alias("n_near"),
            F.when(good, F.col("best.word")).alias("form"),
            F.when(good, -F.col("best.n")).alias("form_n"),
        ),
        "spelling-forms",
    )
    ends = roots(joined.where("form IS NOT NULL").select("word", "form"))
    return joined.join(ends, "word", "left").select(
        "word", "n", "n_near", "form", "form_n", F.coalesce("root", "word").alias("root")
    )
