"""Vectorised word hashes: one pass of array operations over the bytes of many texts."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

from tidemark.llm.common import ship

CHUNK_BYTES = 2 << 20
BLOCK_BYTES = 256 << 10  # some 40 bytes are held for each byte of a block
ODD = np.array(
    [0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93], "u8"
)


def byte_table(separators: bytes, lower: bool = True) -> np.ndarray:
    """Code of each byte inside a word, 0 for those between words; A-Z fold to a-z."""
    table = np.arange(1, 257, dtype="u8")
    if lower:
        table[65:91] = table[97:123]
    table[list(separators)] = 0
    return table


SPACES = bytes([32, *range(9, 14)])
# Everything in ASCII that is neither a letter nor a digit.
SYMBOLS = bytes(c for c in range(128) if not chr(c).isalnum())


def mixed(values: np.ndarray) -> np.ndarray:
    """Spread the entropy of 64-bit values over all their bits."""
    values = (values ^ (values >> np.uint64(32))) * ODD[0]
    values = (values ^ (values >> np.uint64(29))) * ODD[3]
    return values ^ (values >> np.uint64(32))


def chunks(texts: list[bytes], size: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about ``size`` bytes; a longer text stands alone."""
    start = total = 0
    for at, text in enumerate(texts):
        if total and total + len(text) > size:
            yield start, at
            start, total = at, 0
        total += len(text)
    if start < len(texts):
        yield start, len(texts)


def _parts(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sum, length and start of every run of codes that are not 0."""
    inside = codes != 0
    edges = np.flatnonzero(np.diff(inside, prepend=False, append=False))
    starts = edges[::2]
    lengths = edges[1::2] - starts
    if not len(starts):
        return np.zeros(0, "u8"), lengths, starts
    offsets = np.concatenate([[0], np.cumsum(lengths)[:-1]])
    place = np.arange(int(lengths.sum())) - np.repeat(offsets, lengths)
    powers = np.full(int(lengths.max()), ODD[1], "u8")
    powers[0] = 1
    powers = np.cumprod(powers, dtype="u8")
    return np.add.reduceat(mixed(codes[inside] * ODD[2]) * powers[place], offsets), lengths, starts


def word_hashes(
    texts: list[bytes], table: np.ndarray, block: int = BLOCK_BYTES
) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all words in order, and the number of words of each text.

    The bytes are read in blocks; a word that goes on in the next block is put together from its
    parts, so besides the texts and the result no more than some blocks are held, however long a
    text or a word is.
    """
    stops = np.cumsum(np.fromiter(map(len, texts), "i8", len(texts)) + 1)
    data = np.frombuffer(b" ".join([*texts, b""]), "u1")
    found: list[tuple] = []
    total, size, begin = 0, 0, 0  # of the word that the last block ended in
    for at in range(0, len(data), block):
        codes = table[data[at : at + block]]
        codes[stops[slice(*np.searchsorted(stops, [at + 1, at + len(codes) + 1]))] - 1 - at] = 0
        sums, lengths, starts = _parts(codes)
        starts = starts + at
        if size and codes[0]:
            sums[0] = (total + int(sums[0]) * pow(int(ODD[1]), size, 1 << 64)) % (1 << 64)
            lengths[0] += size
            starts[0] = begin
        elif size:
            sums, lengths, starts = (
                np.concatenate([np.array([x], of.dtype), of])
                for x, of in ((total, sums), (size, lengths), (begin, starts))
            )
        size = 0
        if codes[-1]:
            total, size, begin = int(sums[-1]), int(lengths[-1]), int(starts[-1])
            sums, lengths, starts = sums[:-1], lengths[:-1], starts[:-1]
        found.append((mixed(sums + lengths.astype("u8")), starts))
    if not found:
        return np.zeros(0, "u8"), np.zeros(len(texts), "i8")
    starts = np.concatenate([s for _, s in found])
    counts = np.diff(np.searchsorted(starts, np.concatenate([[0], stops])))
    return np.concatenate([h for h, _ in found]), counts


def grams(hashes: np.ndarray, counts: np.ndarray, gaps: tuple[int, ...]) -> tuple:
    """Hashes of the word itself and the words ``gaps`` after it, and the text of each.

    Only places whose last word is still in the same text count.
    """
    text_of = np.repeat(np.arange(len(counts)), counts)
    reach = gaps[-1] if gaps else 0
    n = max(0, len(hashes) - reach)
    value = hashes[:n].copy()
    for k, gap in enumerate(gaps):
        value = mixed(value * ODD[1] + hashes[gap : gap + n] * ODD[2] + np.uint64(k + gap))
    same = text_of[:n] == text_of[reach : reach + n]
    return value[same], text_of[:n][same]


ship(__name__)
