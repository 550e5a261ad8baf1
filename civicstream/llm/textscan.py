"""Array code over the bytes of many texts at once: words, pieces, 64-bit hashes."""

from __future__ import annotations

import functools
import sys
import unicodedata

import numpy as np

from civicstream.llm import common

U64 = np.uint64
_BASE = U64(0x9E3779B97F4A7C15 | 1)

#: A-Z to a-z, other bytes unchanged.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

#: Bytes of words `[^\x20\x09-\x0D]+`.
NOT_SPACE = np.ones(256, bool)
NOT_SPACE[[32, 9, 10, 11, 12, 13]] = False

#: Bytes of words `[^\x00-\x2F\x3A-\x60\x7B-\x7F]+` (after lower-casing A-Z).
ALNUM = np.zeros(256, bool)
ALNUM[0x30:0x3A] = ALNUM[0x61:0x7B] = ALNUM[0x80:] = True


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective finalizer on 64-bit values."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


#: Span hashes are polynomials modulo this prime: modulo a power of two, whatever the base, texts
#: like the Thue-Morse word and its swap would have the same hash.
_PRIME = (1 << 61) - 1
_P, _LOW31, _LOW30 = U64(_PRIME), U64((1 << 31) - 1), U64((1 << 30) - 1)
_POINT = 0x9E3779B97F4A7C15 % _PRIME
_STEP = 1 << 12
#: Spans that are hashed at once: their intermediate arrays stay in the processor's cache.
_SOME = 1 << 15
_powers: list[np.ndarray] = []


def _reduced(x: np.ndarray) -> np.ndarray:
    """A number congruent to x, below 2^61 + 8."""
    return (x & _P) + (x >> U64(61))


def _residue(x: np.ndarray) -> np.ndarray:
    x = _reduced(x)
    return np.where(x >= _P, x - _P, x)


def _times(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """x * y modulo the prime, of numbers below it."""
    x1, x0, y1, y0 = x >> U64(31), x & _LOW31, y >> U64(31), y & _LOW31
    middle = x1 * y0 + x0 * y1
    # 2^62 = 2, and middle * 2^31 = (middle >> 30) * 2^61 + (middle & low) * 2^31
    return _residue(_reduced(x1 * y1 * U64(2) + (middle >> U64(30)) + ((middle & _LOW30) << U64(31))) + _reduced(x0 * y0))


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the point and of its inverse, at least n + 1 of them."""
    if not _powers or len(_powers[0]) < n + 1:
        size = max(1 << 16, 1 << int(n).bit_length())
        out = []
        for base in (_POINT, pow(_POINT, -1, _PRIME)):
            steps = np.ones(_STEP, U64)
            for i in range(1, _STEP):
                steps[i] = int(steps[i - 1]) * base % _PRIME
            far, jump = [1], pow(base, _STEP, _PRIME)
            while len(far) * _STEP < size:
                far.append(far[-1] * jump % _PRIME)
            table = np.empty((len(far), _STEP), U64)
            for i, x in enumerate(far):
                table[i] = _times(U64(x), steps)
            out.append(table.ravel())
        _powers[:] = out
    return _powers[0], _powers[1]


#: Prefix sums of a text: of the bytes times the lower 31 bits, and the upper 30, of the powers.
Sums = tuple[np.ndarray, np.ndarray]


def prefix_sums(buf: np.ndarray) -> Sums:
    """Prefix sums modulo 2^64; ``span_hash`` takes differences of them, which are exact for
    spans below 2^25 bytes."""
    up, _ = _power_tables(len(buf))
    sums = []
    for part in (up[:len(buf)] & _LOW31, up[:len(buf)] >> U64(31)):
        out = np.zeros(len(buf) + 1, U64)
        part *= buf
        np.cumsum(part, out=out[1:])
        sums.append(out)
    return sums[0], sums[1]


def span_hash(sums: Sums, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hash of the byte spans [start, end): equal bytes, equal hash, wherever they are."""
    low, high = sums
    _, down = _power_tables(len(low) - 1)
    if len(start) and int((end - start).max()) >> 25:
        return _long_hash(sums, start, end)
    out = np.empty(len(start), U64)
    for i in range(0, len(start), _SOME):
        a, b = start[i:i + _SOME], end[i:i + _SOME]
        h = _times(_residue(high[b] - high[a]), U64(1 << 31)) + _residue(low[b] - low[a])
        h = _times(_residue(h), down[a])
        out[i:i + _SOME] = mix(h + (b - a).astype(U64) * U64(0xD6E8FEB86659FD93))
    return out


def _long_hash(sums: Sums, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of spans of which some are too long for one difference: those are taken in parts."""
    out = np.empty(len(start), U64)
    long = (end - start) >> 25 > 0
    out[~long] = span_hash(sums, start[~long], end[~long])
    for i in np.flatnonzero(long).tolist():
        cuts = np.arange(start[i], end[i], 1 << 24)
        parts = span_hash(sums, cuts, np.append(cuts[1:], end[i]))
        total = 0
        for h in parts.tolist():
            total = (total * _POINT + h) % _PRIME
        out[i] = mix(np.array([total], U64))[0]
    return out


def _eights(buf: np.ndarray) -> np.ndarray:
    """The eight bytes from every byte on (zeros behind the last) as one number."""
    padded = np.zeros(len(buf) + 8, np.uint8)
    padded[:len(buf)] = buf
    return np.ndarray((len(buf) + 1,), "<u8", padded, strides=(1,))


#: Masks of the first bytes of eight.
_KEEP = np.array([(1 << (8 * i)) - 1 for i in range(9)], U64)
#: Words of up to this many bytes are hashed eight bytes at a time.
_SHORT_WORD = 64


def word_hash(buf: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hash of the byte spans [start, end), like ``span_hash`` but from the bytes themselves:
    cheaper where spans are short. Different spans of up to seven bytes have different hashes."""
    at = _eights(buf)
    out = np.empty(len(start), U64)
    for i in range(0, len(start), _SOME):
        a = start[i:i + _SOME]
        size = end[i:i + _SOME] - a
        whole = np.minimum(size, 8)
        h = mix((at[a] & _KEEP[whole]) ^ whole.astype(U64) << U64(56))
        more = np.flatnonzero((size > 7) & (size <= _SHORT_WORD))
        h[more] += size[more].astype(U64) * U64(0xD6E8FEB86659FD93)
        step = 8
        while len(more):
            part = at[a[more] + step] & _KEEP[np.minimum(size[more] - step, 8)]
            h[more] = mix(h[more] * _BASE + part)
            step += 8
            more = more[size[more] > step]
        out[i:i + _SOME] = h
    long = np.flatnonzero(end - start > _SHORT_WORD)
    if len(long):
        sizes = (end - start)[long]
        to = np.cumsum(sizes)
        out[long] = span_hash(prefix_sums(buf[common.ragged(start[long], sizes)]), to - sizes, to)
    return out


def numbered(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of the distinct keys in ascending order: the index of the first; the number of each key among
    them; how often they occur. ``np.unique`` sorts several times more slowly to tell the first."""
    if not len(keys):
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int64)
    bits = len(keys).bit_length()
    if keys.min() >= 0 and int(keys.max()).bit_length() + bits <= 64:     # keys and indices are sorted as one number
        both = np.sort(keys.astype(U64) << U64(bits) | np.arange(len(keys), dtype=U64))
        order, ascending = (both & U64((1 << bits) - 1)).astype(np.int64), both >> U64(bits)
    else:
        order = np.argsort(keys)
        ascending = keys[order]
    new = np.ones(len(keys), bool)
    new[1:] = ascending[1:] != ascending[:-1]
    number = np.empty(len(keys), np.int64)
    number[order] = np.cumsum(new) - 1
    edge = np.flatnonzero(new)
    return np.minimum.reduceat(order, edge), number, np.diff(np.append(edge, len(keys)))


def names(buf: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A number for each byte span, equal exactly where the bytes are equal, and the index of the
    first span of each number. Spans of up to seven bytes are their own key; longer ones are found
    by their hash and compared byte by byte."""
    if not len(start):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    size = end - start
    at = _eights(buf)
    key = at[start] & _KEEP[np.minimum(size, 7)] | np.minimum(size, 7).astype(U64) << U64(56)
    long = np.flatnonzero(size > 7)
    key[long] = word_hash(buf, start[long], end[long]) | U64(1 << 63)
    first, number, _ = numbered(key)
    like = first[number[long]]
    wrong = size[long] != size[like]
    at_long, at_like = start[long], start[like]
    chunks = np.where(wrong, 0, (size[long] + 7) // 8)
    step = np.minimum(8 * common.ragged(np.zeros_like(chunks), chunks), np.repeat(size[long], chunks) - 8)
    which = np.repeat(np.arange(len(long)), chunks)
    differ = at[at_long[which] + step] != at[at_like[which] + step]
    wrong[which[differ]] = True
    if wrong.any():
        firsts, seen = first.tolist(), {}
        for i in long[wrong].tolist():
            text = buf[start[i]:end[i]].tobytes()
            if text not in seen:
                seen[text] = len(firsts)
                firsts.append(i)
            number[i] = seen[text]
        first = np.array(firsts)
    return number, first


def spans(buf: np.ndarray, offsets: np.ndarray, inside: np.ndarray
          ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Maximal runs of bytes in the class ``inside``, cut at text borders: start, end, and the
    number of the text. Classes must not split a multi-byte character."""
    n = len(buf)
    if not n:
        empty = np.empty(0, np.int64)
        return empty, empty, empty
    hit = inside[buf]
    before = np.empty(n, bool)
    before[0] = False
    before[1:] = hit[:-1]
    before[offsets[:-1][offsets[:-1] < n]] = False
    after = np.empty(n, bool)
    after[-1] = False
    after[:-1] = hit[1:]
    after[offsets[1:][offsets[1:] > 0] - 1] = False
    start = np.flatnonzero(hit & ~before)
    end = np.flatnonzero(hit & ~after) + 1
    return start, end, np.searchsorted(offsets, start, side="right") - 1


def grams(h: np.ndarray, owner: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of k consecutive items of the same owner, and the index of the first item."""
    n = len(h) - k + 1
    if n <= 0:
        return np.empty(0, U64), np.empty(0, np.int64)
    first = np.flatnonzero(owner[:n] == owner[k - 1:])
    out = h[:n].copy()
    for j in range(1, k):
        out *= _BASE
        out ^= out >> U64(29)
        out += h[j:n + j]
    return mix(out[first]), first


def counts_of(owner: np.ndarray, n: int) -> np.ndarray:
    return np.bincount(owner, minlength=n).astype(np.int64)


# --- pieces: the pattern of byte-level tokenizers, as run boundaries ------------------------

#: White_Space code points; the contractions that the pattern splits off.
_WHITE = [9, 10, 11, 12, 13, 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029,
          0x202F, 0x205F, 0x3000]
_SHORT = "stmd"
_LONG = ("re", "ve", "ll")
_OTHER, _LETTER, _NUMBER, _SPACE = range(4)


@functools.cache
def char_classes() -> np.ndarray:
    out = np.zeros(sys.maxunicode + 1, np.uint8)
    for c in range(sys.maxunicode + 1):
        kind = unicodedata.category(chr(c))[0]
        if kind == "L":
            out[c] = _LETTER
        elif kind == "N":
            out[c] = _NUMBER
    out[_WHITE] = _SPACE
    return out


def code_points(buf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Code points of UTF-8 bytes, and the byte where each begins."""
    at = np.flatnonzero((buf & 0xC0) != 0x80)
    points = np.frombuffer(buf.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
    return points, at


def pieces(buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte spans of the matches of the pattern
    `'s|'t|'re|'ve|'m|'ll|'d| ?\\p{L}+| ?\\p{N}+| ?[^\\s\\p{L}\\p{N}]+|\\s+(?!\\S)|\\s+`
    in every text (its matches cover a text without gaps): start, end, number of the text.

    A match is a run of letters, numbers, white space or other characters. A run takes one
    U+0020 before it along; white space before a run gives up its last character; an
    apostrophe that begins a match takes the letters of a contraction along.
    """
    n_bytes = len(buf)
    if not n_bytes:
        empty = np.empty(0, np.int64)
        return empty, empty, empty
    cp, at = code_points(buf)
    n = len(cp)
    kind = char_classes()[cp]
    filled = offsets[:-1][offsets[1:] > offsets[:-1]]
    head = np.zeros(n + 1, bool)
    head[np.searchsorted(at, filled)] = True
    head[n] = True
    begin = head.copy()
    begin[1:n] |= kind[1:] != kind[:-1]
    run = np.flatnonzero(begin)                      # run starts, then n
    a, b = run[:-1], run[1:]
    k = kind[a]
    cut = np.zeros(n + 1, bool)
    white = k == _SPACE
    cut[a[white]] = True
    cut[b[white & ~head[b]] - 1] = True              # last space before a run in the same text
    word = ~white
    led = word & ~head[a]
    led[led] = cp[a[led] - 1] == 32                  # U+0020 before it goes along
    cut[a[word & ~led]] = True
    # contractions: a lone apostrophe that begins a match, then letters of the same text
    short = np.flatnonzero((k[:-1] == _OTHER) & (b[:-1] - a[:-1] == 1) & (cp[a[:-1]] == 39)
                           & ~led[:-1] & (k[1:] == _LETTER) & ~head[a[1:]])
    if len(short):
        s, e = a[short + 1], b[short + 1]
        one = np.isin(cp[s], [ord(x) for x in _SHORT])
        second = cp[np.minimum(s + 1, n - 1)]
        two = np.zeros(len(s), bool)
        for x, y in _LONG:
            two |= (cp[s] == ord(x)) & (second == ord(y)) & (e - s >= 2)
        taken = one | two
        cut[s[taken]] = False
        cut[(s + np.where(one, 1, 2))[taken]] = True
    cut |= head
    where = np.flatnonzero(cut[:n])
    start = at[where]
    end = np.append(start[1:], n_bytes)
    return start, end, np.searchsorted(offsets, start, side="right") - 1
