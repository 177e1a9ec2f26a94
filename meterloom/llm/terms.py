"""Terms of a text: longest runs of ASCII letters and digits and of all other characters
beyond ASCII. In UTF-8 these are runs of bytes, so texts are cut without decoding them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

INSIDE = np.zeros(256, bool)
INSIDE[48:58] = INSIDE[65:91] = INSIDE[97:123] = INSIDE[128:] = True
#: A-Z to a-z, other term bytes as they are, the rest to a space.
PLAIN = bytes(byte + 32 if 65 <= byte <= 90 else byte if INSIDE[byte] else 32 for byte in range(256))
#: Bytes of text that are handled at once.
PORTION = 1 << 20


def plain(body: bytes) -> bytes:
    """The terms of a text, lower-cased, with spaces for everything else."""
    return body.translate(PLAIN)


def term_edges(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of every term of ``data``, the bytes of a plain text."""
    inside = np.concatenate(([False], data != 32, [False]))
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    return edges[0::2], edges[1::2]


def body_portions(batch: pa.RecordBatch, column: int) -> Iterator[tuple[int, list[bytes]]]:
    """First row and texts (null: empty) of a batch of binary texts, about PORTION bytes at a time."""
    first, bodies, size = 0, [], 0
    for i, body in enumerate(batch.column(column)):
        bodies.append(body.as_py() or b"")
        size += len(bodies[-1])
        if size >= PORTION:
            yield first, bodies
            first, bodies, size = i + 1, [], 0
    if bodies:
        yield first, bodies
