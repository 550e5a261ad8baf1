"""Operators 1 and 8 against the libraries themselves."""

import hashlib
import zlib

import numpy as np
import public_tokenizers
import pytest
import regex
import tiktoken
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from civicstream.llm import bpe, textscan, tokenfile
from tests.llm import edge_cases

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def reference():
    return tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, special_tokens={},
                             mergeable_ranks=bpe.load_ranks(RANKS).ranks)


mixed = st.lists(st.text(alphabet=st.sampled_from(list("ab'stvemldr \n\t12²é中!#= \u0085\x1c𝒳")), max_size=40),
                 max_size=8)


@settings(deadline=None, max_examples=200)
@given(mixed)
def test_pieces_are_the_matches_of_the_pattern(texts):
    pattern = regex.compile(public_tokenizers.PATTERN)
    raw = [t.encode() for t in texts]
    offsets = np.concatenate([[0], np.cumsum([len(r) for r in raw])]).astype(np.int64)
    buf = np.frombuffer(b"".join(raw), np.uint8)
    start, end, owner = textscan.pieces(buf, offsets)
    got = [[] for _ in texts]
    for a, b, o in zip(start, end, owner):
        got[o].append(buf[a:b].tobytes().decode())
    assert got == [pattern.findall(t) for t in texts]


@settings(deadline=None, max_examples=200)
@given(st.lists(st.text(alphabet=st.sampled_from(list("aabcdehinorst=éñ ")), min_size=1, max_size=60), max_size=20))
def test_replay_equals_merging_each_piece(texts):
    ranks = bpe.load_ranks(RANKS)
    reference = tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, special_tokens={},
                                  mergeable_ranks=ranks.ranks)
    raw = [t.encode() for t in texts]
    ids, count = bpe.replay(ranks, raw)
    ends = np.concatenate([[0], np.cumsum(count)]).astype(int)
    assert [ids[a:b].tolist() for a, b in zip(ends[:-1], ends[1:])] == \
        [reference._encode_single_piece(r) for r in raw]


def test_lower_rank_pairs_that_appear_late_come_first():
    # merging (b, c) makes a pair of a lower rank with its neighbour, before the second (b, c)
    ranks = bpe.Ranks({bytes([i]): i for i in range(256)} | {b"bcb": 256, b"bc": 257})
    assert bpe.replay(ranks, [b"bcbc", b"bcbcbc", b"xbcx"])[0].tolist() == [256, 99, 256, 99, 257, 120, 257, 120]


def test_op1_edge_cases(spark, reference):
    data = edge_cases.rows()
    expected = []
    for r in data:
        ids = reference.encode_ordinary(r[1] or "")
        expected.append((r[0], len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                         hashlib.sha256((r[1] or "").encode()).hexdigest()))
    assert edge_cases.result(bpe.digest(edge_cases.table(spark), RANKS)) == sorted(expected, key=repr)
    assert bpe.digest(edge_cases.table(spark, []), RANKS).count() == 0


def test_op1_keeps_other_columns(spark):
    out = bpe.encode(edge_cases.table(spark), RANKS)
    assert {"doc_id", "lang", "rid", "ids"} <= set(out.columns) and out.count() == len(edge_cases.rows())


def op8_expected(data):
    tokenizer = Tokenizer.from_file(TOKENIZER)
    docs = [(r[0], tokenizer.encode(r[1] or "", add_special_tokens=False).ids + [2]) for r in data]
    docs.sort(key=lambda d: (d[0] is not None, d[0] or 0, len(d[1])))
    out, start = [], 0
    for doc, ids in docs:
        out.append((doc, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return sorted(out, key=repr)


def test_op8_edge_cases(spark):
    assert edge_cases.result(tokenfile.digest(edge_cases.table(spark), TOKENIZER, 2)) == op8_expected(edge_cases.rows())
    assert tokenfile.digest(edge_cases.table(spark, []), TOKENIZER, 2).count() == 0


def test_op8_dictionary_and_single_documents(spark, tmp_dir):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    manifest = tokenfile.write(df, f"file://{tmp_dir}/t", TOKENIZER, 2)
    dictionary = open(f"{tmp_dir}/t/dictionary", "rb").read()
    assert len(dictionary) > 256
    row = manifest.orderBy("shard").head()
    shard = tokenfile.Shard(f"{tmp_dir}/t/{row.file}", dictionary)
    doc = int(shard.docs[len(shard.docs) // 2])
    text = df.where(f"doc_id = {doc}").head().text
    assert shard.find(doc)[0].tolist() == Tokenizer.from_file(TOKENIZER).encode(text).ids + [2]
    assert shard.find(10**9) == []
    with pytest.raises(ValueError):
        tokenfile.Shard(f"{tmp_dir}/t/{row.file}", b"another")


@pytest.mark.parametrize("query", ["op1_bpe", "op8_token_files"])
def test_queries_match_the_libraries(spark, query, reference):
    from civicstream.llm import queries
    folder = "/root/testdata/sf0.001"
    data = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    got = edge_cases.result(queries.QUERIES[query](spark, folder))
    if query == "op8_token_files":
        assert got == op8_expected(data)
    else:
        assert [(r[0], r[1], r[2]) for r in got] == sorted(
            [(d, len(i), hashlib.sha256(np.array(i, "<u4").tobytes()).hexdigest())
             for d, t in data for i in [reference.encode_ordinary(t or "")]], key=repr)


def test_op8_added_tokens(spark):
    end = "<|endoftext|>"
    texts = [f"hello {end} x", f"{end}start of it", f"the end{end}", f"{end}{end} twice {end}\n{end} more", end,
             "no such token < |endoftext|>", f"<|endoftext{end}|>", None, f"\u0e01 \u00e9{end}\u0301", "plain after"]
    data = [(i, t, "en", "s", 0, "c", 1, 2, 3) for i, t in enumerate(texts)]
    assert Tokenizer.from_file(TOKENIZER).encode(texts[0], add_special_tokens=False).ids == [31373, 220, 50256, 2124]
    assert edge_cases.result(tokenfile.digest(edge_cases.table(spark, data), TOKENIZER, 2)) == op8_expected(data)


def test_words_that_a_polynomial_hash_confuses(spark, reference):
    """Thue-Morse words and their swaps have equal polynomials modulo 2^64 for every odd base."""
    a, b = "a", "b"
    for _ in range(12):
        a, b = a + b, b + a
    data = [(1, a), (2, b), (3, f"{b} {a}")]
    docs = spark.createDataFrame(data, "doc_id long, text string").coalesce(1)
    library = Tokenizer.from_file(TOKENIZER)
    expected, ids8 = [], {}
    for doc, text in data:
        ids = np.array(reference.encode_ordinary(text), "<u4")
        expected.append((doc, len(ids), hashlib.sha256(ids.tobytes()).hexdigest(), hashlib.sha256(text.encode()).hexdigest()))
        ids8[doc] = np.array([*library.encode(text, add_special_tokens=False).ids, 2], "<u4")
    assert edge_cases.result(bpe.digest(docs, RANKS)) == expected
    got = {r.doc_id: (r.n_tokens, r.ids_crc32) for r in tokenfile.digest(docs, TOKENIZER, end_id=2).collect()}
    assert got == {d: (len(ids), zlib.crc32(ids.tobytes())) for d, ids in ids8.items()}


def test_span_hash_is_the_polynomial_modulo_the_prime():
    rng = np.random.default_rng(2)
    buf = rng.integers(0, 256, 20_000, dtype=np.uint8)
    start = rng.integers(0, 12_000, 200)
    end = start + rng.integers(0, 8000, 200)
    prime, point = 2**61 - 1, textscan._POINT
    expected = []
    for a, b in zip(start.tolist(), end.tolist()):
        value = 0
        for c in reversed(buf[a:b].tolist()):
            value = (value * point + c) % prime
        expected.append((value + (b - a) * 0xD6E8FEB86659FD93) % 2**64)
    got = textscan.span_hash(textscan.prefix_sums(buf), start, end)
    assert (got == textscan.mix(np.array(expected, np.uint64))).all()
    word = [0]
    for _ in range(12):
        word += [1 - x for x in word]
    both = np.array(word + [1 - x for x in word], np.uint8) + 97
    one, other = textscan.span_hash(textscan.prefix_sums(both), np.array([0, 4096]), np.array([4096, 8192]))
    assert one != other


def test_word_hash_and_numbers_tell_words_apart():
    rng = np.random.default_rng(5)
    words = {bytes(rng.integers(0, 3, n, dtype=np.uint8)) for n in range(1, 200) for _ in range(40)}
    words |= {b"abcdefg", b"abcdefg\x0f", b"abcdefgx", b"abcdefgy\0", b"x" * 64, b"x" * 65, b"\0" * 7, b"\0" * 8}
    some = sorted(words) * 2
    sizes = np.array([len(w) for w in some])
    buf, end = np.frombuffer(b"".join(some), np.uint8), np.cumsum(sizes)
    h = textscan.word_hash(buf, end - sizes, end)
    assert len(np.unique(h)) == len(words) and np.array_equal(h[:len(words)], h[len(words):])
    alone = np.frombuffer(b"-" + some[7], np.uint8)
    assert textscan.word_hash(alone, np.array([1]), np.array([len(alone)]))[0] == h[7]
    assert len(textscan.word_hash(buf, end[:0], end[:0])) == 0
    for keys in (h, rng.integers(0, 50, 999), h[:0], np.array([2**63 + 5, 1, 2**63 + 5], np.uint64)):
        _, *want = np.unique(keys, return_index=True, return_inverse=True, return_counts=True)
        assert all(np.array_equal(x, y) for x, y in zip(textscan.numbered(keys), want))
