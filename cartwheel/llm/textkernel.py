"""Words, lines and rolling hashes of many texts at once, in numpy over Arrow buffers.

A *word* is a maximal run of ``[^\\x20\\x09-\\x0D]``. The separators are ASCII,
so words are found on the UTF-8 bytes. No text is ever turned into Python
objects: a slice of an Arrow string column is one byte buffer with offsets,
and everything below is vectorised over that buffer.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b
from typing import NamedTuple

import numpy as np
import pyarrow as pa

SLICE_BYTES = 2 << 20

_U = np.uint64
_MULT = 0x9E3779B97F4A7C15 | 1


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser for 64-bit values (wraps silently)."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def byte_values(seed: int) -> np.ndarray:
    """A pseudo-random 64-bit value for each of the 256 bytes."""
    base = (np.arange(256, dtype=_U) + _U(1)) * _U(0xD1342543DE82EF95)
    return mix64(mix64(base ^ _U(seed & 0xFFFFFFFF)) + _U(seed & 0xFFFFFFFF))


_POWERS: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """``M**i`` and ``M**-i`` modulo 2**64 for ``i < n``."""
    have = _POWERS.get("up")
    if have is None or len(have) < n:
        size = max(n, 1 << 20)
        inverse = pow(_MULT, -1, 1 << 64)
        for key, step in (("up", _MULT), ("down", inverse)):
            a = np.full(size, step, dtype=_U)
            a[0] = 1
            _POWERS[key] = np.multiply.accumulate(a)
    return _POWERS["up"][:n], _POWERS["down"][:n]


class Texts(NamedTuple):
    """Some consecutive rows: their bytes, and where each text begins and ends."""

    first: int
    buf: np.ndarray
    off: np.ndarray

    @property
    def n(self) -> int:
        return len(self.off) - 1

    def doc_of(self, positions: np.ndarray) -> np.ndarray:
        """The row of each position. Positions ascend."""
        cuts = np.searchsorted(positions, self.off)
        return np.repeat(np.arange(self.n), np.diff(cuts))


def slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[Texts]:
    """Split a string column into runs of rows of about ``limit`` bytes; null is empty.

    A single text longer than ``limit`` makes a slice of its own: texts are
    never cut.
    """
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type)
    _, offsets, data = column.buffers()
    off = np.frombuffer(offsets, dtype=np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1]
    off = off.astype(np.int64)
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    row = 0
    while row < len(column):
        end = int(np.searchsorted(off, off[row] + limit, side="right")) - 1
        end = min(max(end, row + 1), len(column))
        yield Texts(row, raw[off[row] : off[end]], off[row : end + 1] - off[row])
        row = end


SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


class Words(NamedTuple):
    start: np.ndarray
    end: np.ndarray
    doc: np.ndarray
    per_doc: np.ndarray


def words(t: Texts, space: np.ndarray = SPACE) -> Words:
    """Where the words of all rows start and end, ascending, with their row; ``space`` tells the bytes that are in none."""
    n = len(t.buf)
    solid = ~space[t.buf]
    begins = np.zeros(n + 1, dtype=bool)
    begins[t.off] = True
    before = np.zeros(n, dtype=bool)
    before[1:] = solid[:-1]
    start = np.flatnonzero(solid & (~before | begins[:n]))
    after = np.zeros(n, dtype=bool)
    after[:-1] = solid[1:]
    end = np.flatnonzero(solid & (~after | begins[1:])) + 1
    per_doc = np.diff(np.searchsorted(start, t.off))
    return Words(start, end, np.repeat(np.arange(t.n), per_doc), per_doc)


def rolling_prefix(buf: np.ndarray, seed: int = 1) -> np.ndarray:
    """Prefix sums from which :func:`rolling_hash` gets a value of any span."""
    up, _ = _powers(len(buf))
    out = np.zeros(len(buf) + 1, dtype=_U)
    np.cumsum(byte_values(seed)[buf] * up, out=out[1:])
    return out


def rolling_hash(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Cheap values of the spans ``[start, end)``, equal for equal bytes.

    A polynomial modulo 2**64 has known pairs of different strings of one
    value: good to choose places by, never to tell that spans are equal.
    """
    _, down = _powers(len(prefix))
    return mix64((prefix[end] - prefix[start]) * down[start] + (end - start).astype(_U))


#: A Mersenne prime: products are reduced by shifts.
_PRIME = (1 << 61) - 1
#: Bases of the polynomial modulo the prime, one for each independent hash.
_BASES = (0x0A3C59AC2F1B6D47, 0x1D8E4E27C47D124F)


def _reduce(x: np.ndarray) -> np.ndarray:
    x = (x & _U(_PRIME)) + (x >> _U(61))
    return np.where(x >= _U(_PRIME), x - _U(_PRIME), x)


def _shift32(x: np.ndarray) -> np.ndarray:
    """``x * 2**32`` modulo the prime, of reduced values."""
    return _reduce(((x << _U(32)) & _U(_PRIME)) + (x >> _U(29)))


def _times(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Products modulo the prime, of reduced values, in halves of 32 bits."""
    half = _U(0xFFFFFFFF)
    xh, xl, yh, yl = x >> _U(32), x & half, y >> _U(32), y & half
    middle = _reduce(xh * yl + xl * yh)
    return _reduce(_reduce(xl * yl) + _shift32(middle) + _reduce((xh * yh) << _U(3)))


def _prime_powers(n: int, which: int) -> tuple[np.ndarray, np.ndarray]:
    """``base**i`` and ``base**-i`` modulo the prime for ``i < n``, by doubling."""
    have = _POWERS.get(f"up {which}")
    if have is None or len(have) < n:
        base = _BASES[which]
        for key, step in ((f"up {which}", base), (f"down {which}", pow(base, -1, _PRIME))):
            a = np.ones(1, dtype=_U)
            while len(a) < max(n, 1 << 20):
                a = np.concatenate([a, _times(a, np.full(1, pow(step, len(a), _PRIME), _U))])
            _POWERS[key] = a
    return _POWERS[f"up {which}"][:n], _POWERS[f"down {which}"][:n]


def prefix_hash(buf: np.ndarray, which: int = 0) -> np.ndarray:
    """Prefix sums, modulo the prime, from which :func:`span_hash` gets the hash of any span."""
    up, _ = _prime_powers(len(buf), which)
    out = np.zeros(len(buf) + 1, dtype=_U)
    step, carry = 1 << 22, _U(0)
    for lo in range(0, len(buf), step):  # sums of this many products fit in 64 bits
        value, power = buf[lo : lo + step].astype(_U) + _U(1), up[lo : lo + step]
        low, high = np.cumsum(value * (power & _U(0xFFFFFFFF))), np.cumsum(value * (power >> _U(32)))
        part = _reduce(_reduce(low) + _shift32(_reduce(high)) + carry)
        out[lo + 1 : lo + 1 + len(part)] = part
        carry = part[-1]
    return out


def span_hash(prefix: np.ndarray, start: np.ndarray, end: np.ndarray, which: int = 0) -> np.ndarray:
    """Hashes of the spans ``[start, end)``: a polynomial modulo 2**61 - 1, then mixed with the length.

    Equal bytes give equal hashes; two given different spans of ``n`` bytes
    meet for at most ``n`` of the 2**61 bases.
    """
    _, down = _prime_powers(len(prefix), which)
    value = _times(_reduce(prefix[end] + _U(_PRIME) - prefix[start]), down[start])
    return mix64(value + ((end - start).astype(_U) << _U(3)) * _U(0xD1342543DE82EF95))


def codes_of(buf: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, pa.Array]:
    """A number for each span ``[start, end)``, equal for equal bytes alone, and the distinct spans by number."""
    size = end - start
    cuts = np.concatenate([[0], np.cumsum(size)])
    flat = buf[np.repeat(start - cuts[:-1], size) + np.arange(cuts[-1])]
    spans = pa.Array.from_buffers(pa.large_binary(), len(size), [None, pa.py_buffer(cuts.astype(np.int64)), pa.py_buffer(flat)])
    coded = spans.dictionary_encode()
    return coded.indices.to_numpy().astype(np.int64), coded.dictionary


def strong_hashes(spans: pa.Array, key: bytes = b"") -> np.ndarray:
    """64 bits of BLAKE2 of each of some distinct spans."""
    raw = b"".join(blake2b(x, digest_size=8, key=key).digest() for x in spans.to_pylist())
    return np.frombuffer(raw, dtype="<u8").astype(_U)


def word_hash(buf: np.ndarray, w: Words) -> np.ndarray:
    """64-bit hashes of words; each distinct word of ``buf`` is hashed once."""
    codes, spans = codes_of(buf, w.start, w.end)
    return strong_hashes(spans)[codes]


def window_hash(items: np.ndarray, width: int) -> np.ndarray:
    """Hashes of all runs of ``width`` consecutive items (in order)."""
    n = len(items) - width + 1
    if n <= 0:
        return np.zeros(0, dtype=_U)
    out = np.zeros(n, dtype=_U)
    for i in range(width):
        out = mix64(out + items[i : i + n]) + _U(i + 1)
    return out


def by_doc(hashes: np.ndarray, doc: np.ndarray, n_docs: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct ``(doc, hash)`` pairs, sorted: their docs, hashes, and counts per doc."""
    order = np.lexsort((hashes, doc))
    h, d = hashes[order], doc[order]
    new = np.ones(len(h), dtype=bool)
    new[1:] = (h[1:] != h[:-1]) | (d[1:] != d[:-1])
    h, d = h[new], d[new]
    return d, h, np.bincount(d, minlength=n_docs)


def int64(x: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(x).view(np.int64) if x.dtype == _U else x.astype(np.int64)
