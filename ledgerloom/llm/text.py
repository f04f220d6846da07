"""Words, lines and hashes of whole Arrow text columns, in numpy.

A *word* is a maximal run of bytes other than space and 0x09-0x0D, which for
UTF-8 is the same as ``[^\\x20\\x09-\\x0D]+`` over code points.  Null text counts
as empty text.  Batches are cut between documents into slices of bounded size,
so memory follows the longest document and not the batch.
"""

from __future__ import annotations

import contextlib
import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

SLICE_BYTES = 2 << 20
LONG_WORD = 64
PRIME = np.uint64(0x9E3779B97F4A7C15)
SEPARATOR = np.zeros(256, bool)
SEPARATOR[[9, 10, 11, 12, 13, 32]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
BYTE_HASH = np.random.RandomState(20240607).randint(0, 2**63 - 1, 256, dtype=np.int64).astype(np.uint64) * np.uint64(2)
BYTE_HASH |= np.uint64(1)


def tidy() -> None:
    """Gives freed memory back to the system: workers are used again, and what one task leaves adds to the next."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):       # a C library without it
        ctypes.CDLL(None).malloc_trim(0)


def mix(h: np.ndarray) -> np.ndarray:
    """Finalise 64-bit hashes: every input bit reaches every output bit."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The column's bytes and its n + 1 offsets; nulls are empty."""
    a = pc.fill_null(column.cast(pa.large_string()), "")
    _, offsets, data = a.buffers()
    off = np.frombuffer(offsets, np.int64)[a.offset:a.offset + len(a) + 1] if len(a) else np.zeros(1, np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[off[0]:off[-1]], off - off[0]


def slices(column: pa.Array, most: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) of runs of rows of about ``most`` bytes; a longer text stands alone.

    When the batch is done, freed memory goes back to the system.
    """
    buf, off = utf8(column)
    lo, rows = 0, len(off) - 1
    while lo < rows:
        hi = max(lo + 1, int(np.searchsorted(off, off[lo] + most, "right")) - 1)
        yield lo, hi, buf[off[lo]:off[hi]], off[lo:hi + 1] - off[lo]
        lo = hi
    tidy()


def spans(buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, row) of every word, in order."""
    inside = ~SEPARATOR[buf]
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    edge = off[:-1][off[:-1] < off[1:]]          # a word never runs on into the next text
    first[edge] = inside[edge]
    last[off[1:][off[:-1] < off[1:]] - 1] = inside[off[1:][off[:-1] < off[1:]] - 1]
    start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    return start, end, np.searchsorted(off, start, "right") - 1


def hashes(buf: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash of every span.  Spans over LONG_WORD bytes go through xxhash one by one."""
    size = end - start
    short = np.minimum(size, LONG_WORD + 1).astype(np.int16)
    order = np.argsort(-short, kind="stable")
    first, n = start[order], short[order]
    h = np.full(len(n), 0x243F6A8885A308D3, np.uint64)
    for j in range(min(LONG_WORD, int(n[0]) if len(n) else 0)):
        k = int(np.searchsorted(-n, -j, "left"))  # spans with more than j bytes come first
        x = (h[:k] ^ BYTE_HASH[buf[first[:k] + j]]) * PRIME
        h[:k] = x ^ (x >> np.uint64(29))
    out = np.empty_like(h)
    out[order] = mix(h + n.astype(np.uint64))
    for i in np.flatnonzero(size > LONG_WORD):
        out[i] = xxhash.xxh64_intdigest(buf[start[i]:end[i]].tobytes())
    return out


def windows(h: np.ndarray, row: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, index of the first word) of every run of ``n`` words within one text."""
    if len(h) < n:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    at = np.flatnonzero(row[:len(row) - n + 1] == row[n - 1:])
    acc = h[at]
    for j in range(1, n):
        acc = (acc ^ (acc >> np.uint64(32))) * PRIME + h[at + j]
    return mix(acc), at


def repeated(keys: np.ndarray) -> np.ndarray:
    """Which of the keys occur twice or more."""
    order = np.argsort(keys, kind="stable")
    k = keys[order]
    same = k[1:] == k[:-1]
    twice = np.zeros(len(k), bool)
    twice[1:] |= same
    twice[:-1] |= same
    out = np.zeros(len(k), bool)
    out[order] = twice
    return out


def text_of(buf: np.ndarray, off: np.ndarray, i: int) -> bytes:
    return buf[off[i]:off[i + 1]].tobytes()


def in_row(keys: np.ndarray, row: np.ndarray) -> np.ndarray:
    """The keys made different for each text, so that only repeats within one text meet."""
    return mix(keys + (row.astype(np.uint64) + np.uint64(1)) * PRIME)


def structure(buf: np.ndarray, off: np.ndarray) -> dict[str, np.ndarray]:
    """Per text, as long: n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    rows = len(off) - 1
    start, end, row = spans(buf, off)
    total = lambda marks: np.diff(np.concatenate([[0], np.cumsum(marks)])[off])
    symbol = np.zeros(256, bool)
    symbol[list(b"#*$%&|<>")] = True
    tri, at = windows(hashes(buf, start, end), row, 3)
    again = at[repeated(in_row(tri, row[at]))]
    covered = np.zeros(len(start), bool)
    for j in range(3):
        covered[again + j] = True
    return {
        "n_words": np.bincount(row, minlength=rows),
        "word_chars": total(((buf & 0xC0) != 0x80) & ~SEPARATOR[buf]),
        "n_symbols": total(symbol[buf]),
        "n_dup_lines": np.array([duplicate_lines(text_of(buf, off, i)) for i in range(rows)], np.int64),
        "n_repeat_words": np.bincount(row[covered], minlength=rows),
    }


def duplicate_lines(text: bytes) -> int:
    """Lines with a word that equal an earlier line."""
    lines = text.split(b"\n")
    if len(lines) < 2:
        return 0
    lines = [x for x in lines if x.strip(b" \t\n\x0b\x0c\r")]
    return len(lines) - len(set(lines))
