"""Words, hashes and bounded groups of rows inside one task."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of a word after A-Z are lower-cased: digits, a-z and every byte of a non-ASCII character.
WORD_BYTES = np.zeros(256, dtype=bool)
WORD_BYTES[0x30:0x3A] = WORD_BYTES[0x61:0x7B] = WORD_BYTES[0x80:] = True

#: Bytes whose words are hashed at once.
SLICE = 512 << 10

_BASE = 0x9E3779B97F4A7C15 | 1
_powers = np.ones(1, dtype=np.uint64)


def powers(n: int) -> np.ndarray:
    """The first ``n`` powers of the hash base, modulo 2^64."""
    global _powers
    if len(_powers) < n:
        size = max(n, 4096)
        with np.errstate(over="ignore"):
            _powers = np.cumprod(np.r_[np.uint64(1), np.full(size, _BASE, dtype=np.uint64)], dtype=np.uint64)
    return _powers[:n]


def mixed(h: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser, so that all bits of a polynomial hash can be used."""
    with np.errstate(over="ignore"):
        h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def groups(sizes: list[int], most: int) -> Iterator[tuple[int, int]]:
    """Consecutive slices of at most ``most`` in total, or of one row."""
    start = total = 0
    for i, size in enumerate(sizes):
        if i > start and total + size > most:
            yield start, i
            start, total = i, 0
        total += size
    if start < len(sizes):
        yield start, len(sizes)


def text_groups(batches: Iterator[pa.RecordBatch], column: str = "text", most: int = 2 << 20):
    """Small batches with their texts as UTF-8 (null as empty): no more text is unpacked at once."""
    for batch in batches:
        column_at = batch.schema.get_field_index(column)
        sizes = [x or 0 for x in pc.binary_length(batch.column(column_at)).to_pylist()]
        for i, j in groups(sizes, most):
            part = batch.slice(i, j - i)
            yield part, [x or b"" for x in part.column(column_at).cast(pa.binary()).to_pylist()]


def words(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all words in order, and where each text's words begin (one more entry than texts).

    A-Z are lower-cased; a word is a run of ``WORD_BYTES``. Texts without words get an empty range.
    Bytes are taken in slices of ``SLICE``, whatever the texts' lengths: what is held besides the texts
    and the hashes does not grow with them. A word that goes on in the next slice keeps its sum.
    """
    whole = b"\x00".join(texts).lower() + b"\x00"
    hashes, starts = [np.zeros(0, dtype=np.uint64)], [np.zeros(0, dtype=np.int64)]
    open_sum, open_length, open_start = 0, 0, 0
    with np.errstate(over="ignore"):
        for begin in range(0, len(whole), SLICE):
            buffer = np.frombuffer(whole, dtype=np.uint8, count=min(SLICE, len(whole) - begin), offset=begin)
            at = np.flatnonzero(WORD_BYTES[buffer])
            first = np.flatnonzero(np.diff(at, prepend=-2) > 1)
            lengths = np.diff(first, append=len(at))
            sums = np.zeros(0, dtype=np.uint64)
            if len(at):
                offset = np.arange(len(at)) - np.repeat(first, lengths)
                terms = (buffer[at].astype(np.uint64) + np.uint64(1)) * powers(int(lengths.max()))[offset]
                sums = np.add.reduceat(terms, first)
            places = at[first] + begin
            if open_length and len(at) and at[0] == 0:
                sums[0] = np.uint64((open_sum + pow(_BASE, open_length, 1 << 64) * int(sums[0])) % (1 << 64))
                lengths[0] += open_length
                places[0] = open_start
            elif open_length:
                sums, lengths = np.r_[np.uint64(open_sum), sums], np.r_[open_length, lengths]
                places = np.r_[open_start, places]
            open_length = 0
            # the last byte of all ends any word, so nothing stays open at the end
            if len(at) and at[-1] == len(buffer) - 1:
                open_sum, open_length, open_start = int(sums[-1]), int(lengths[-1]), int(places[-1])
                sums, lengths, places = sums[:-1], lengths[:-1], places[:-1]
            hashes.append(mixed(sums + lengths.astype(np.uint64)))
            starts.append(places)
    begins = np.r_[0, np.cumsum([len(x) + 1 for x in texts])].astype(np.int64)
    return np.concatenate(hashes), np.searchsorted(np.concatenate(starts), begins)
