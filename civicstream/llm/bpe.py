"""Byte-level BPE encoding and decoding by corpus-level merge replay (operator 1).

Every task collects the distinct pieces of a block of texts and replays the merges over all of
them together: an inverted index leads from the rank of a pair to the positions where the pair
stands; ranks are taken in ascending order, and a merge updates the pairs with its two
neighbours only. The ids of the texts are then laid out from the ids of their pieces. Blocks are
independent, so there is no shuffle, memory is bounded by the block, and a lost task is
recomputed from its input split.

Null text encodes to no ids and decodes to no bytes; an empty text likewise. Repeated rows are
encoded each. Other columns pass through unchanged; an existing column of the output's name is
replaced.
"""

from __future__ import annotations

import base64
import functools
import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from civicstream.llm import common, lexicon

_NONE = np.int64(2**62)


class Ranks:
    """A vocabulary of byte strings by rank, with every pair of tokens that makes a token."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        size = max(ranks.values()) + 1
        self.tokens = [b""] * size
        for token, rank in ranks.items():
            self.tokens[rank] = token
        self.byte = np.array([ranks[bytes([b])] for b in range(256)], np.int64)
        pairs, made = [], []
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                left, right = ranks.get(token[:cut]), ranks.get(token[cut:])
                if left is not None and right is not None:
                    pairs.append(left << 32 | right)
                    made.append(rank)
        order = np.argsort(np.array(pairs, np.int64))
        self.pairs = np.array(pairs, np.int64)[order]
        self.made = np.array(made, np.int64)[order]
        self.length = np.array([len(t) for t in self.tokens], np.int64)
        self.start = np.cumsum(self.length) - self.length
        self.bytes = np.frombuffer(b"".join(self.tokens), np.uint8)

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of the token that a pair makes, or _NONE."""
        if not len(self.pairs):
            return np.full(len(left), _NONE)
        key = left << 32 | right
        i = np.minimum(np.searchsorted(self.pairs, key), len(self.pairs) - 1)
        return np.where(self.pairs[i] == key, self.made[i], _NONE)

    def decode(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(bytes of all ids one after another, number of bytes of each)."""
        count = self.length[ids]
        return self.bytes[common.ragged(self.start[ids], count)], count


@functools.cache
def load_ranks(path: str) -> Ranks:
    """Read a rank file: a base64 token and its rank on each line."""
    with open(path, "rb") as lines:
        return Ranks({base64.b64decode(a): int(b) for a, b in (x.split() for x in lines if x.strip())})


def distinct(x: np.ndarray) -> np.ndarray:
    x = np.sort(x)
    return x[np.concatenate([[True], x[1:] != x[:-1]])] if len(x) else x


def replay(ranks: Ranks, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all pieces one after another, and how many each has.

    In a piece, the pair of the lowest rank is merged first, the leftmost of equals; a piece
    that is a token itself is that token.
    """
    whole = np.array([ranks.ranks.get(p, -1) for p in pieces], np.int64)
    size = np.array([len(p) for p in pieces], np.int64)
    todo = np.flatnonzero(whole < 0)
    sizes = size[todo]
    token = ranks.byte[np.frombuffer(b"".join([pieces[i] for i in todo]), np.uint8)]
    n = len(token)
    word = np.repeat(np.arange(len(todo)), sizes)
    after = np.arange(1, n + 1)
    before = np.arange(-1, n - 1)
    ends = np.cumsum(sizes)
    after[ends[sizes > 0] - 1] = n                       # n: no neighbour
    before[(ends - sizes)[sizes > 0]] = n
    token = np.append(token, -1)
    after, before, word = np.append(after, n), np.append(before, n), np.append(word, -1)
    alive = np.ones(n + 1, bool)
    alive[n] = False
    best = np.full(n + 1, _NONE)                         # rank of the pair beginning here
    index: dict[int, list[np.ndarray]] = {}
    heap: list[int] = []

    def add(at: np.ndarray) -> None:
        """Look up the pairs that begin at these positions and index them by rank."""
        at = at[alive[at]]
        r = np.full(len(at), _NONE)
        paired = after[at] < n
        r[paired] = ranks.rank(token[at[paired]], token[after[at[paired]]])
        best[at] = r
        at, r = at[r < _NONE], r[r < _NONE]
        if not len(at):
            return
        order = np.argsort(r, kind="stable")
        at, r = at[order], r[order]
        cuts = np.flatnonzero(np.diff(r)) + 1
        for rank, group in zip(r[np.concatenate([[0], cuts])].tolist(), np.split(at, cuts)):
            if rank not in index:
                index[rank] = []
                heapq.heappush(heap, rank)
            index[rank].append(group)

    add(np.arange(n))
    while heap:
        rank = heapq.heappop(heap)
        at = distinct(np.concatenate(index.pop(rank)))
        at = at[alive[at] & (best[at] == rank)]
        if not len(at):
            continue
        # of overlapping pairs (a a a) every second one from the left
        if len(at) > 1:
            touching = after[at[:-1]] == at[1:]
            if touching.any():
                chain = np.concatenate([[0], np.cumsum(~touching)])
                place = np.arange(len(at)) - np.flatnonzero(np.concatenate([[True], ~touching]))[chain]
                at = at[place % 2 == 0]
        # where a merge would bring forth a pair of a lower rank, that pair comes first:
        # merge only the leftmost pair of such a word now
        if len(at) > 1:
            merged = np.full(len(at), rank)
            right = after[after[at]]
            left = before[at]
            low = np.full(len(at), False)
            ok = right < n
            low[ok] |= ranks.rank(merged[ok], token[right[ok]]) < rank
            ok = left < n
            low[ok] |= ranks.rank(token[left[ok]], merged[ok]) < rank
            low |= ranks.rank(merged, merged) < rank
            if low.any():
                careful = np.isin(word[at], word[at[low]])
                first = np.concatenate([[True], word[at[1:]] != word[at[:-1]]])
                rest = at[careful & ~first]
                at = at[~careful | first]
                if len(rest):
                    index[rank] = [rest]
                    heapq.heappush(heap, rank)
        gone = after[at]
        token[at] = rank
        alive[gone] = False
        best[gone] = _NONE
        best[at] = _NONE
        nxt = after[gone]
        after[at] = nxt
        has = nxt < n
        before[nxt[has]] = at[has]
        prev = before[at]
        again = np.concatenate([at, prev[prev < n]])
        # chains of neighbours that were merged together share positions
        add(distinct(again))
    left = np.flatnonzero(alive[:n])
    made = np.bincount(word[left], minlength=len(todo)).astype(np.int64) if len(todo) else sizes
    count = np.ones(len(pieces), np.int64)
    count[todo] = made
    out = np.empty(int(count.sum()), np.uint32)
    start = np.cumsum(count) - count
    single = whole >= 0
    out[start[single]] = whole[single]
    out[common.ragged(start[todo], made)] = token[left]
    return out, count


def encode(df: DataFrame, ranks_path: str, text_col: str = "text", ids_col: str = "ids") -> DataFrame:
    """Add ``ids_col``: the ids of the whole text, as little-endian unsigned 32-bit integers in
    a binary column; see ``ids_array`` for an array. The rank file must be readable at the same
    path on every executor (it comes with the Python environment). ``text_col`` itself is
    dropped from the result."""
    common.prepare(df.sparkSession)
    common.require(df, text_col)
    df = df.withColumn(text_col, common.utf8_text(text_col))
    keep = [c for c in df.columns if c not in (text_col, ids_col)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks = load_ranks(ranks_path)
        for rows, ids, offsets in lexicon.encode_batches(
                batches, text_col, lambda pieces: replay(ranks, pieces)):
            yield pa.RecordBatch.from_arrays(
                [*(rows.column(c) for c in keep), common.binary_column(ids, offsets * 4)],
                [*keep, ids_col])

    return df.select(*keep, text_col).mapInArrow(run, common.schema_of(df, keep, f"`{ids_col}` binary"))


def decode(df: DataFrame, ranks_path: str, ids_col: str = "ids", bytes_col: str = "decoded") -> DataFrame:
    """Add ``bytes_col``: the bytes that the ids of ``ids_col`` (as ``encode`` makes them) stand
    for. Null ids decode to no bytes."""
    common.prepare(df.sparkSession)
    common.require(df, ids_col)
    keep = [c for c in df.columns if c != bytes_col]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks = load_ranks(ranks_path)
        for batch in batches:
            for rows in common.slices(batch, ids_col):
                buf, offsets = common.text_buffer(rows.column(ids_col))
                data, count = ranks.decode(np.frombuffer(buf.tobytes(), "<u4"))
                ends = np.concatenate([[0], np.cumsum(count)])
                yield pa.RecordBatch.from_arrays(
                    [*(rows.column(c) for c in keep), common.binary_column(data, ends[offsets // 4])],
                    [*keep, bytes_col])

    return df.select(*keep).mapInArrow(run, common.schema_of(df, keep, f"`{bytes_col}` binary"))


def n_ids(ids: Column) -> Column:
    return (F.octet_length(ids) / 4).cast("long")


def digest(df: DataFrame, ranks_path: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of each document: encode, then decode."""
    ids = encode(df.select("doc_id", "text"), ranks_path)
    both = decode(ids, ranks_path)
    return both.select("doc_id", n_ids(F.col("ids")).alias("n_tokens"),
                       F.sha2("ids", 256).alias("ids_sha256"),
                       F.sha2("decoded", 256).alias("decoded_sha256"))
