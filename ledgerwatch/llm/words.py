"""Words, word hashes and shingles of many texts at once, as numpy arrays.

A word is a run of ASCII letters, digits and any non-ASCII bytes of the text in UTF-8; everything
else separates.  Texts are hashed in slices of a bounded number of bytes, so memory follows the
slice (or one longer text), not the batch.
"""

import numpy as np

SLICE_BYTES = 2_000_000
PAD = np.uint64(0x5851F42D4C957F2D)


def mix64(x):
    """A bijective 64-bit mixer (splitmix64) over an array."""
    with np.errstate(over="ignore"):
        x = (x + np.uint64(0x9E3779B97F4A7C15)).astype(np.uint64)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


_BYTE = mix64(np.arange(256, dtype=np.uint64))
_POSITION = mix64(np.arange(4096, dtype=np.uint64) + np.uint64(1 << 40)) | np.uint64(1)
IS_WORD = np.zeros(256, dtype=bool)
IS_WORD[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True


def slices(texts, most_bytes=SLICE_BYTES):
    """Yield (first index, list of UTF-8 texts) with bounded total bytes; null counts as empty."""
    first, size, part = 0, 0, []
    for i, text in enumerate(texts):
        raw = text.encode("utf-8", "replace") if isinstance(text, str) else b""
        if part and size + len(raw) > most_bytes:
            yield first, part
            first, size, part = i, 0, []
        part.append(raw)
        size += len(raw) + 1
    if part:
        yield first, part


def runs(data, kind):
    """Starts and ends of the maximal runs of equal non-zero ``kind`` (one small int per byte)."""
    k = kind[data]
    edge = np.flatnonzero(np.diff(k, prepend=np.uint8(0), append=np.uint8(0)))
    at, upto = edge[:-1], edge[1:]
    real = k[at] != 0 if len(at) else np.zeros(0, bool)
    return at[real], upto[real], k


def hash_runs(data, starts, ends):
    """A 64-bit hash of each byte run."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    lens = ends - starts
    first = np.cumsum(lens) - lens
    within = np.arange(int(lens.sum())) - np.repeat(first, lens)
    taken = data[within + np.repeat(starts, lens)]
    with np.errstate(over="ignore"):
        turn = (within >> 12).astype(np.uint64) * np.uint64(2) + np.uint64(1)
        value = _BYTE[taken] * _POSITION[within & 4095] * turn
        return mix64(np.add.reduceat(value, first) + lens.astype(np.uint64))


def layout(raws):
    """One byte array for a slice, and where each text begins; the last entry is the end."""
    data = np.frombuffer(b"\n".join(raws) + b"\n", dtype=np.uint8)
    begins = np.zeros(len(raws) + 1, dtype=np.int64)
    np.cumsum([len(r) + 1 for r in raws], out=begins[1:])
    return data, begins


def word_hashes(raws, kind=IS_WORD.view(np.uint8)):
    """(hash of every word, offsets: words of text i are offsets[i]:offsets[i + 1])."""
    data, begins = layout(raws)
    starts, ends, _ = runs(data, kind)
    return hash_runs(data, starts, ends), np.searchsorted(starts, begins)


def ngrams(hashes, offsets, n):
    """Hashes of all word n-grams and their offsets per text.

    A text with fewer than n words, but at least one, has one n-gram of all its words.
    """
    count = np.diff(offsets)
    owner = np.repeat(np.arange(len(count)), count)
    at = np.arange(len(hashes))
    end = offsets[1:][owner] if len(owner) else at
    start = offsets[:-1][owner] if len(owner) else at
    keep = (at + n <= end) | ((at == start) & (end - start < n))
    at, end, owner = at[keep], end[keep], owner[keep]
    with np.errstate(over="ignore"):
        out = np.zeros(len(at), np.uint64)
        for j in range(n):
            there = at + j < end
            part = np.where(there, hashes[np.minimum(at + j, len(hashes) - 1)], PAD)
            out = mix64(out * np.uint64(0x100000001B3) + part)
    return out, np.searchsorted(owner, np.arange(len(count) + 1))
