"""Words and hashes of many texts at once, as numpy arrays over the bytes of an Arrow column."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes of text taken at once; arrays over the bytes of one piece are all that is held beside the batch.
PIECE_BYTES = 1 << 20

_ODD = np.uint64(0x9E3779B97F4A7C15)
_MULTIPLIERS = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers whose output bits all depend on all input bits."""
    x = (x ^ (x >> np.uint64(30))) * _MULTIPLIERS[0]
    x = (x ^ (x >> np.uint64(27))) * _MULTIPLIERS[1]
    return x ^ (x >> np.uint64(31))


def lower_table() -> np.ndarray:
    """Each byte, with A-Z in lower case."""
    table = np.arange(256, dtype=np.uint8)
    table[65:91] += 32
    return table


def byte_class(*spans: tuple[int, int]) -> np.ndarray:
    """True for the bytes in any of the inclusive spans."""
    table = np.zeros(256, dtype=bool)
    for first, last in spans:
        table[first : last + 1] = True
    return table


#: Bytes of words that white space separates: all but space and tab to carriage return.
NOT_BLANK = ~byte_class((0x20, 0x20), (0x09, 0x0D))


def pieces(column: pa.Array | pa.ChunkedArray, limit: int = PIECE_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(index of the first text, bytes, offsets) for stretches of whole texts of about `limit` bytes.

    A null counts as an empty text. A text longer than the limit is a piece of its own.
    """
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2] or b"", dtype=np.uint8)
    first = 0
    while first < len(column):
        last = max(int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1, first + 1)
        yield first, data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]
        first = last


def word_bounds(data: np.ndarray, offsets: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, text index) of each maximal run of `inside` bytes; runs end where their text ends."""
    if not len(data):
        none = np.zeros(0, dtype=np.int64)
        return none, none, none
    word = inside[data]
    opens = word.copy()
    opens[1:] &= ~word[:-1]
    firsts = offsets[:-1][offsets[:-1] < len(data)]
    opens[firsts] = word[firsts]
    closes = word.copy()
    closes[:-1] &= ~word[1:]
    lasts = offsets[1:][offsets[1:] > 0] - 1
    closes[lasts] = word[lasts]
    starts = np.flatnonzero(opens)
    return starts, np.flatnonzero(closes) + 1, np.searchsorted(offsets, starts, "right") - 1


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each byte range, eight bytes at a time."""
    padded = np.concatenate([data, np.zeros(8, dtype=np.uint8)])
    eights = np.ndarray(shape=(len(data) + 1,), dtype="<u8", buffer=padded.data, strides=(1,))
    length = ends - starts
    hashes = mix(length.astype(np.uint64) + _ODD)
    active, at = np.arange(len(starts)), starts
    left = length
    while len(active):
        block = eights[at]
        short = left < 8
        block[short] &= (np.uint64(1) << (left[short].astype(np.uint64) * np.uint64(8))) - np.uint64(1)
        hashes[active] = mix((hashes[active] ^ block) * _ODD)
        more = left > 8
        active, at, left = active[more], at[more] + 8, left[more] - 8
    return hashes


def sequence_hashes(words: np.ndarray, owner: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, owner) of each run of `width` words of one owner; `owner` ascends."""
    n = len(words) - width + 1
    if n <= 0:
        return words[:0], owner[:0]
    with np.errstate(over="ignore"):
        total = np.zeros(n, dtype=np.uint64)
        for k in range(width):
            total = (total + words[k : k + n]) * _MULTIPLIERS[1] + np.uint64(width)
            total ^= total >> np.uint64(29)
        total = mix(total)
    whole = owner[:n] == owner[width - 1 :]
    return total[whole], owner[:n][whole]


def shingles(column: pa.Array | pa.ChunkedArray, width: int = 5, inside: np.ndarray = NOT_BLANK) -> Iterator[tuple[int, list[np.ndarray]]]:
    """(index of the first text, ascending distinct shingle hashes of each text) for stretches of texts.

    Words are lower-cased (A-Z). A text with fewer words than `width`, but not none, has its whole
    sequence as its one shingle; a null or a text without words has none.
    """
    lower = lower_table()
    for first, data, offsets in pieces(column):
        data = lower[data]
        starts, ends, owner = word_bounds(data, offsets, inside)
        words = word_hashes(data, starts, ends)
        texts = len(offsets) - 1
        counts = np.bincount(owner, minlength=texts)
        at = np.concatenate([[0], np.cumsum(counts)])
        hashes, of = sequence_hashes(words, owner, width)
        bounds = np.searchsorted(of, np.arange(texts + 1))
        out = []
        for i in range(texts):
            if counts[i] >= width:
                out.append(np.unique(hashes[bounds[i] : bounds[i + 1]]))
            elif counts[i]:
                own = words[at[i] : at[i + 1]]
                out.append(sequence_hashes(own, np.zeros(len(own), dtype=np.int64), len(own))[0])
            else:
                out.append(hashes[:0])
        yield first, out
