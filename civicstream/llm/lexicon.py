"""Token ids of whole texts by way of their distinct pieces.

Texts repeat few pieces very often. A task reads a block of texts, collects the pieces that it
has not seen yet, has all of them encoded in one call, and then lays out the ids of each text.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa

from civicstream.llm import common, textscan

#: Bytes of text whose new pieces are encoded together.
BLOCK_BYTES = 8 << 20

#: A task forgets its pieces when it has this many; only speed depends on it.
MAX_PIECES = 300_000

#: Pieces as bytes -> (ids of all pieces one after another, number of ids of each).
Encode = Callable[[list[bytes]], tuple[np.ndarray, np.ndarray]]


class Lexicon:
    def __init__(self, encode: Encode):
        self.encode = encode
        self.clear()

    def clear(self) -> None:
        self.row: dict[bytes, int] = {}
        self.flat, self.start, self.count = (np.empty(0, np.uint32), np.empty(0, np.int64),
                                             np.empty(0, np.int64))
        self.pending: list[bytes] = []

    def rows(self, buf: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Number of each piece, by its bytes; new ones wait for ``settle``."""
        number, first = textscan.names(buf, start, end)
        out = np.empty(len(first), np.int32)
        row, pending, data = self.row, self.pending, buf.tobytes()
        for i, (a, b) in enumerate(zip(start[first].tolist(), end[first].tolist())):
            piece = data[a:b]
            r = row.get(piece)
            if r is None:
                r = row[piece] = len(row)
                pending.append(piece)
            out[i] = r
        return out[number]

    def settle(self) -> None:
        if self.pending:
            flat, count = self.encode(self.pending)
            start = len(self.flat) + np.cumsum(count) - count
            self.flat = np.concatenate([self.flat, flat.astype(np.uint32)])
            self.start = np.concatenate([self.start, start])
            self.count = np.concatenate([self.count, count])
            self.pending = []

    def ids(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        count = self.count[rows]
        return self.flat[common.ragged(self.start[rows], count)], count


def encode_batches(batches: Iterator[pa.RecordBatch], column: str, encode: Encode
                   ) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """(rows, ids of their texts one after another, offsets of the texts' ids)."""
    lexicon = Lexicon(encode)
    held: list[tuple[pa.RecordBatch, np.ndarray, np.ndarray]] = []
    held_bytes = 0

    def emit():
        lexicon.settle()
        for rows, pieces, owner in held:
            ids, count = lexicon.ids(pieces)
            per_text = np.bincount(owner, weights=count, minlength=rows.num_rows).astype(np.int64)
            yield rows, ids, np.concatenate([[0], np.cumsum(per_text)])
        held.clear()
        if len(lexicon.row) > MAX_PIECES:
            lexicon.clear()
        common.release()

    for batch in batches:
        for part in common.slices(batch, column):
            buf, offsets = common.text_buffer(part.column(column))
            start, end, owner = textscan.pieces(buf, offsets)
            held.append((part, lexicon.rows(buf, start, end), owner.astype(np.int32)))
            held_bytes += len(buf)
            if held_bytes >= BLOCK_BYTES:
                yield from emit()
                held_bytes = 0
    yield from emit()
    lexicon.clear()
    common.release()
