"""Sum-of-squares online packing of documents into windows of ``size`` tokens.

Each task packs the documents of its partition in their order. Whole windows are cut
off long documents; what is left of a document goes to the fill level that makes the
sum of squared counts of partially filled windows smallest, or to a new window, with
the counts in one array. When a partition ends, or when too many windows are open, the
emptiest are cut up to fill the fullest; of the very last one, pieces whose lengths
are powers of two become sequences of their own. So nothing is padded, and a sequence
that is shorter than ``size`` has a power of two of tokens.

A task holds at most OPEN windows and one portion of texts. There is no shuffle, and
equal partitions give equal packings after a retry.

Defined cases: a null or empty text is its end token alone; repeated rows and ids are packed row by row;
an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterloom.llm.common import mapped, small_batches
from meterloom.llm.tokens import portions, word_ids

#: Partially filled windows a task keeps open.
OPEN = 2048
#: Characters of text whose words are in memory at once.
PIECE = 1 << 18
#: Sequence numbers of one partition.
SEQUENCES = 1 << 40


@dataclass
class Piece:
    doc_id: object
    start: int
    ids: np.ndarray
    doc_tokens: int

    def cut(self, length: int) -> tuple[Piece, Piece]:
        return (
            Piece(self.doc_id, self.start, self.ids[:length], self.doc_tokens),
            Piece(self.doc_id, self.start + length, self.ids[length:], self.doc_tokens),
        )


@dataclass
class Window:
    pieces: list[Piece] = field(default_factory=list)
    fill: int = 0

    def put(self, piece: Piece) -> None:
        self.pieces.append(piece)
        self.fill += len(piece.ids)


class SumOfSquares:
    """Places pieces; ``done`` collects full windows."""

    def __init__(self, size: int) -> None:
        self.size = size
        self.counts = np.zeros(size + 1, np.int64)
        self.open: list[list[Window]] = [[] for _ in range(size + 1)]
        self.done: list[Window] = []

    def level_for(self, length: int) -> int:
        """The level to fill up by ``length``; 0 is a new window. Fullest of equals."""
        levels = np.arange(self.size - length, 0, -1)
        levels = levels[self.counts[levels] > 0]
        if not len(levels):
            return 0
        grown = np.where(levels + length < self.size, 2 * self.counts[levels + length] + 1, 0)
        change = grown - 2 * self.counts[levels] + 1
        best = int(np.argmin(change))
        return int(levels[best]) if change[best] <= 2 * self.counts[length] + 1 else 0

    def add(self, piece: Piece) -> None:
        while len(piece.ids) >= self.size:
            head, piece = piece.cut(self.size)
            self.done.append(Window([head], self.size))
        length = len(piece.ids)
        if not length:
            return
        level = self.level_for(length)
        if level:
            window = self.open[level].pop()
            self.counts[level] -= 1
        else:
            window = Window()
        # A copy lets go of the document's other ids.
        window.put(Piece(piece.doc_id, piece.start, piece.ids.copy(), piece.doc_tokens))
        self._keep(window)
        if self.counts.sum() > OPEN:
            self.settle()

    def _keep(self, window: Window) -> None:
        if window.fill == self.size:
            self.done.append(window)
        else:
            self.open[window.fill].append(window)
            self.counts[window.fill] += 1

    def settle(self) -> None:
        """Cut up the emptiest windows to fill the fullest; at most one stays open."""
        windows = [window for level in reversed(self.open) for window in level]
        self.open = [[] for _ in range(self.size + 1)]
        self.counts[:] = 0
        first, last = 0, len(windows) - 1
        while first < last:
            to, giver = windows[first], windows[last]
            piece = giver.pieces.pop()
            giver.fill -= len(piece.ids)
            head, tail = piece.cut(min(len(piece.ids), self.size - to.fill))
            to.put(head)
            if len(tail.ids):
                giver.put(tail)
            first += to.fill == self.size
            last -= giver.fill == 0
        for window in windows[: last + 1] if windows else []:
            self._keep(window)

    def finish(self) -> None:
        self.settle()
        for level in self.open:
            for window in level:
                length = 1 << (window.fill.bit_length() - 1)
                part = Window()
                for piece in window.pieces:
                    while len(piece.ids):
                        head, piece = piece.cut(min(len(piece.ids), length - part.fill))
                        part.put(head)
                        if part.fill == length:
                            window.fill -= length
                            self.done.append(part)
                            part, length = Window(), 1 << max(0, window.fill.bit_length() - 1)


def packed(
    docs: DataFrame,
    path: str,
    size: int = 2048,
    end: int = 1,
    doc_id: str = "doc_id",
    text: str = "text",
    remembered: int | None = None,
) -> DataFrame:
    """Per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    ``remembered`` trades a worker's memory for time: see :class:`WordIds`.
    """
    docs = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    small_batches(docs.sparkSession)
    kind = docs.schema["doc_id"].dataType.simpleString()
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = SumOfSquares(size)
        sequence = TaskContext.get().partitionId() * SEQUENCES
        id_type = None

        def out() -> pa.RecordBatch:
            nonlocal sequence
            rows: list[tuple] = []
            for window in packer.done:
                offset = 0
                for p in window.pieces:
                    crc = zlib.crc32(p.ids.astype("<u4").tobytes())
                    rows.append((p.doc_id, p.start, len(p.ids), crc, p.doc_tokens, sequence, offset))
                    offset += len(p.ids)
                sequence += 1
            packer.done = []
            columns = list(zip(*rows, strict=True)) or [()] * len(names)
            types = [id_type] + [pa.int64()] * 6
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)

        for batch in batches:
            id_type = batch.schema.field(0).type
            for rows, texts in portions(batch, 1, PIECE):
                for i, ids in zip(rows, word_ids(path, remembered).encode(texts), strict=True):
                    whole = np.append(ids, np.uint32(end))
                    packer.add(Piece(batch.column(0)[i].as_py(), 0, whole, len(whole)))
                yield out()
        packer.finish()
        if packer.done:
            yield out()

    return mapped(docs, 
        pack,
        f"doc_id {kind}, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint",
    )
