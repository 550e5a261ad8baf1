"""Token-ID files with one zstandard dictionary for all documents (operator 8).

``write`` encodes whole texts with a tokenizers file, appends an end id, and writes shards in
ascending document order. Texts are cut into pieces that the library encodes once each; a text
that holds the content of one of the file's added tokens is encoded by the library as a whole. Every document is compressed on its own with a dictionary that was
trained on serialized id arrays, so a short document can be read alone and still compresses
well. The dictionary is stored beside the shards; shards name it by its SHA-256.

A shard: header (magic, id width in bytes, SHA-256 of the dictionary), the zstandard frames of
its documents one after another, the index (document ids, null flags, end offsets of the frames,
numbers of ids), and a trailer (number of documents, offset of the index).

Null text is an empty text: the end id alone. Null document ids come first. Repeated document
ids are all kept, ordered by number of ids and then by frame. An empty table gives no shard.
Columns other than the document id and the text are not written.
"""

from __future__ import annotations

import functools
import hashlib
import os
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from civicstream.llm import common, files, lexicon

MAGIC = b"TOKZ0001"
HEADER = struct.Struct("<8sB32s")
TRAILER = struct.Struct("<QQ")

#: The dictionary is trained on this many documents at most, and this many bytes of each.
SAMPLE_DOCS, SAMPLE_BYTES, DICTIONARY_BYTES = 1000, 1 << 14, 1 << 16
LEVEL = 3


# --- encoding with the tokenizers library ---------------------------------------------------


@functools.cache
def _byte_alphabet() -> dict[int, str]:
    """Byte-level alphabet: printable Latin-1 bytes stand for themselves, the others are code
    points from 256 upwards, in ascending order."""
    same = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in same]
    return {b: chr(b) for b in same} | {b: chr(256 + i) for i, b in enumerate(rest)}


@functools.cache
def _tokenizer(tokenizer_path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer
    tokenizer = Tokenizer.from_file(tokenizer_path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


@functools.cache
def _model(tokenizer_path: str):
    return _tokenizer(tokenizer_path).model


@functools.cache
def _added(tokenizer_path: str) -> list[str]:
    """Contents of the added tokens, which the library finds before it cuts a text."""
    return [t.content for t in _tokenizer(tokenizer_path).get_added_tokens_decoder().values()]


def with_added_tokens(texts: pa.Array, tokenizer_path: str) -> list[int]:
    """Places of the texts that hold the content of an added token."""
    found = np.zeros(len(texts), bool)
    for content in _added(tokenizer_path):
        found |= pc.match_substring(texts, content).fill_null(False).to_numpy(False)
    return np.flatnonzero(found).tolist()


@functools.cache
def id_width(tokenizer_path: str) -> int:
    from tokenizers import Tokenizer
    return 2 if Tokenizer.from_file(tokenizer_path).get_vocab_size() <= 1 << 16 else 4


def encode_pieces(tokenizer_path: str, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The library's ids of every piece, one after another, and how many each has."""
    tokenize, alphabet = _model(tokenizer_path).tokenize, _byte_alphabet()
    out: list[int] = []
    count = np.empty(len(pieces), np.int64)
    for i, piece in enumerate(pieces):
        tokens = tokenize(piece.decode("latin-1").translate(alphabet))
        out.extend([t.id for t in tokens])
        count[i] = len(tokens)
    return np.array(out, np.uint32), count


def _serialized(batches: Iterator[pa.RecordBatch], text_col: str, tokenizer_path: str, end_id: int,
                width: int) -> Iterator[tuple[pa.RecordBatch, list[bytes], np.ndarray]]:
    """(rows, id array of each text with the end id, numbers of ids)."""
    end = end_id.to_bytes(width, "little")
    for rows, ids, offsets in lexicon.encode_batches(
            batches, text_col, lambda pieces: encode_pieces(tokenizer_path, pieces)):
        data = memoryview(ids.astype(f"<u{width}")).cast("B")
        at = (offsets * width).tolist()
        texts, count = [bytes(data[a:b]) + end for a, b in zip(at[:-1], at[1:])], np.diff(offsets) + 1
        column = rows.column(text_col)
        for i in with_added_tokens(column, tokenizer_path):
            whole = _tokenizer(tokenizer_path).encode(column[i].as_py(), add_special_tokens=False).ids
            texts[i], count[i] = np.array(whole, f"<u{width}").tobytes() + end, len(whole) + 1
        yield rows, texts, count


# --- dictionary -----------------------------------------------------------------------------


def train_dictionary(df: DataFrame, id_col: str, text_col: str, tokenizer_path: str, end_id: int,
                     ) -> bytes:
    """Dictionary from a bounded sample: the documents with the smallest hashes of their ids."""
    width = id_width(tokenizer_path)
    key = F.xxhash64(F.col(id_col).cast("string"))
    last = df.select(key.alias("k")).orderBy("k").limit(SAMPLE_DOCS).agg(F.max("k")).head()[0]
    if last is None:
        return b""

    def run(batches):
        for _, texts, _ in _serialized(batches, text_col, tokenizer_path, end_id, width):
            yield pa.RecordBatch.from_arrays([pa.array([t[:SAMPLE_BYTES] for t in texts], pa.binary())],
                                             ["ids"])

    sample = (df.where(key <= last).select(common.utf8_text(text_col).alias(text_col))
              .mapInArrow(run, "ids binary").orderBy("ids").limit(SAMPLE_DOCS))
    samples = [bytes(r.ids) for r in sample.collect()]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes()
    except zstandard.ZstdError:  # too few or too short samples to train on
        return b""


def _dictionary(data: bytes) -> zstandard.ZstdCompressionDict | None:
    return zstandard.ZstdCompressionDict(data) if data else None


# --- writing --------------------------------------------------------------------------------


def write(df: DataFrame, path: str, tokenizer_path: str, end_id: int, id_col: str = "doc_id",
          text_col: str = "text") -> DataFrame:
    """Write ``df`` to shards below ``path`` and return their list (``shard, file, n_docs, n_ids``,
    also written to ``path/manifest``). ``id_col`` must be an integer."""
    spark = common.prepare(df.sparkSession)
    common.require(df, id_col, text_col)
    width = id_width(tokenizer_path)
    dictionary = train_dictionary(df, id_col, text_col, tokenizer_path, end_id)
    digest = hashlib.sha256(dictionary).digest()
    files.write(f"{path}/dictionary", dictionary)
    shards = common.partitions(spark)
    edges = df.agg(F.percentile_approx(F.col(id_col).cast("long"),
                                       [i / shards for i in range(1, shards)] or [0.5], 10_000)).head()[0]
    edges = sorted(set(edges or []))

    def compress(batches):
        at = np.array(edges, np.int64)
        packer = zstandard.ZstdCompressor(level=LEVEL, dict_data=_dictionary(dictionary),
                                          write_content_size=True)
        for rows, texts, count in _serialized(batches, text_col, tokenizer_path, end_id, width):
            doc = rows.column(id_col)
            shard = np.where(doc.is_null().to_numpy(False), 0,
                             np.searchsorted(at, doc.fill_null(0).to_numpy(False), side="left"))
            yield pa.RecordBatch.from_arrays(
                [pa.array(shard.astype(np.int32)), doc, pa.array(count),
                 pa.array([packer.compress(t) for t in texts], pa.binary())],
                ["shard", "doc", "n", "frame"])

    def save(batches):
        done = []
        out = None
        for batch in batches:
            shard = batch.column("shard").to_numpy()
            for a, b in _runs(shard):
                if out is None or out.shard != shard[a]:
                    if out is not None:
                        done.append(out.close())
                    out = _ShardWriter(path, int(shard[a]), width, digest)
                out.add(batch.slice(a, b - a))
        if out is not None:
            done.append(out.close())
        if done:
            yield pa.RecordBatch.from_pylist(done, pa.schema(
                [("shard", pa.int32()), ("file", pa.string()), ("n_docs", pa.int64()), ("n_ids", pa.int64())]))

    frames = df.select(F.col(id_col).cast("long").alias(id_col), common.utf8_text(text_col).alias(text_col)
                       ).mapInArrow(compress, f"shard int, doc long, n long, frame binary")
    manifest = (frames.repartitionById(shards, "shard")
                .sortWithinPartitions("shard", F.col("doc").asc_nulls_first(), "n", "frame")
                .mapInArrow(save, "shard int, file string, n_docs long, n_ids long"))
    manifest.write.parquet(f"{path}/manifest")
    return spark.read.parquet(f"{path}/manifest")


def _runs(values: np.ndarray) -> Iterator[tuple[int, int]]:
    cuts = [0, *(np.flatnonzero(np.diff(values)) + 1).tolist(), len(values)]
    yield from ((a, b) for a, b in zip(cuts[:-1], cuts[1:]) if b > a)


class _ShardWriter:
    def __init__(self, path: str, shard: int, width: int, digest: bytes):
        self.shard = shard
        self.file = files.attempt_name(f"shard-{shard:06d}")
        system, at = files.resolve(f"{path}/{self.file}")
        system.create_dir(os.path.dirname(at), recursive=True)
        self.out = system.open_output_stream(at)
        self.out.write(HEADER.pack(MAGIC, width, digest))
        self.size = HEADER.size
        self.docs, self.nulls, self.ends, self.counts = [], [], [], []

    def add(self, rows: pa.RecordBatch) -> None:
        buf, offsets = common.text_buffer(rows.column("frame"))
        self.out.write(buf.tobytes())
        doc = rows.column("doc")
        self.docs.append(doc.fill_null(0).to_numpy(False))
        self.nulls.append(doc.is_null().to_numpy(False))
        self.ends.append(self.size + offsets[1:])
        self.counts.append(rows.column("n").to_numpy())
        self.size += int(offsets[-1])

    def close(self) -> dict:
        counts = np.concatenate(self.counts)
        for array, kind in ((self.docs, "<i8"), (self.nulls, "u1"), (self.ends, "<u8"), (self.counts, "<u4")):
            self.out.write(np.concatenate(array).astype(kind).tobytes())
        self.out.write(TRAILER.pack(len(counts), self.size))
        self.out.close()
        return {"shard": self.shard, "file": self.file, "n_docs": len(counts), "n_ids": int(counts.sum())}


# --- reading --------------------------------------------------------------------------------


class Shard:
    """Random access to the documents of one shard."""

    def __init__(self, uri: str, dictionary: bytes):
        system, path = files.resolve(uri)
        self.file = system.open_input_file(path)
        size = self.file.size()
        n, index = TRAILER.unpack(self.file.read_at(TRAILER.size, size - TRAILER.size))
        magic, self.width, digest = HEADER.unpack(self.file.read_at(HEADER.size, 0))
        if magic != MAGIC:
            raise ValueError(f"{uri} is not a token file")
        if digest != hashlib.sha256(dictionary).digest():
            raise ValueError(f"{uri} needs another dictionary")
        raw = self.file.read_at(n * 21, index)
        self.docs = np.frombuffer(raw, "<i8", n)
        self.null = np.frombuffer(raw, "u1", n, 8 * n).astype(bool)
        ends = np.frombuffer(raw, "<u8", n, 9 * n).astype(np.int64)
        self.at = np.concatenate([[HEADER.size], ends])
        self.counts = np.frombuffer(raw, "<u4", n, 17 * n).astype(np.int64)
        self.unpacker = zstandard.ZstdDecompressor(dict_data=_dictionary(dictionary))

    def ids(self, i: int, j: int) -> list[np.ndarray]:
        """Id arrays of the documents i to j - 1."""
        data = self.file.read_at(int(self.at[j] - self.at[i]), int(self.at[i]))
        edges = self.at[i:j + 1] - self.at[i]
        return [np.frombuffer(self.unpacker.decompress(data[a:b]), f"<u{self.width}").astype("<u4")
                for a, b in zip(edges[:-1], edges[1:])]

    def find(self, doc_id: int) -> list[np.ndarray]:
        """Id arrays of the documents of this id, by binary search in the index."""
        skip = int(self.null.sum())
        i, j = (skip + np.searchsorted(self.docs[skip:], doc_id, side) for side in ("left", "right"))
        return self.ids(int(i), int(j)) if j > i else []


def read(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens, ids (little-endian unsigned
    32-bit integers) of every document of the files below ``path``."""
    common.prepare(spark)
    manifest = spark.read.parquet(f"{path}/manifest")
    # one row per shard, so the running total over all of them is small
    starts = manifest.withColumn("start", F.coalesce(F.sum("n_ids").over(
        Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))

    def run(batches):
        dictionary = None
        for batch in batches:
            for row in batch.to_pylist():
                dictionary = files.read(f"{path}/dictionary") if dictionary is None else dictionary
                shard = Shard(f"{path}/{row['file']}", dictionary)
                start = row["start"] + np.cumsum(shard.counts) - shard.counts
                for i in range(0, len(shard.docs), 1000):
                    j = min(i + 1000, len(shard.docs))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(shard.docs[i:j], mask=shard.null[i:j]), pa.array(start[i:j]),
                         pa.array(shard.counts[i:j]), pa.array([x.tobytes() for x in shard.ids(i, j)], pa.binary())],
                        ["doc_id", "start", "n_tokens", "ids"])

    return (starts.select("shard", "file", "start")
            .repartitionById(common.partitions(spark), F.col("shard") % common.partitions(spark))
            .mapInArrow(run, "doc_id long, start long, n_tokens long, ids binary"))


def digest(df: DataFrame, tokenizer_path: str, end_id: int) -> DataFrame:
    """Write the documents to files in the shared folder, read them back: doc_id, start,
    n_tokens, ids_crc32."""
    path = common.shared_folder(df.sparkSession, "tokens")
    write(df, path, tokenizer_path, end_id)
    return read(df.sparkSession, path).select(
        "doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
