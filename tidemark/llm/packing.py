"""Best-fit packing of tokenised documents into sequences, by best-two-fit.

Texts are tokenised where they are read, and the pieces are staged with their ids.  Row numbers and
lengths alone are dealt over shards of about ``SHARD_PIECES`` pieces by a hash of the staged row
number, and every shard packs on its own, so no task sees more however large the corpus or a source
is.  The places found are joined to the pieces by row number; no task holds the ids of a shard.  A shard holds thousands of
sequences, of which at most the last few stay unfilled, so dealing costs next to no space.
"""

from __future__ import annotations

import re
import struct
import zlib
from collections.abc import Iterable, Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidemark.llm.common import Scratch, give_back, plain_text, ship, slices, small_batches

SEQUENCE_TOKENS = 2048
SHARD_PIECES = 50_000
CACHE_WORDS = 600_000  # about 120 MB, and as much again once a second generation begins
BLOCK_BYTES = 4 << 20  # texts whose words are numbered at once
# ASCII characters that are neither letters nor digits; the apostrophe begins parts of its own.
SYMBOLS = "".join(c for c in map(chr, range(33, 127)) if not c.isalnum() and c != "'")
SYMBOL_BYTES = SYMBOLS.encode()
# Each is one code point in lower case too, and none joins another under NFC.
LATIN_LETTERS = re.compile("[a-zA-ZÀ-ÖØ-öø-ÿ]+")
ASCII_PARTS = re.compile("[a-zA-Z]+|[0-9]|[^a-zA-Z0-9]+")
WORD_END = "</w>"

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


class WordEncoder:
    """Token ids of texts, remembering the ids of each word between ASCII white space.

    The tokenizer drops white space and never joins across it, and reads A-Z as a-z, so the ids of a
    text are those of its lower-cased words in a row.  Arrow splits the texts and numbers their
    different words, so only these are looked up, and lays out the ids.  The tokenizer also parts
    letters from the symbols behind them, so a new word of letters with symbols at its end is put
    together from both.  Words of Latin-1 letters and runs of symbols, lower-cased and with their
    bytes as letters, are what its model merges, and go straight to that.  Other new words are
    encoded together and told apart by the tokens that end a word, where it is plain how many of
    these a word has; the rest one by one, as are all of a group whose total differs.
    """

    def __init__(self, path: str, cache_words: int = CACHE_WORDS):
        self.cache_words = cache_words
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for token, i in vocabulary.items() if token.endswith(WORD_END)]] = True
        as_letters = self.tokenizer.pre_tokenizer.pre_tokenize_str
        self.letters = {n: as_letters(chr(n))[0][0] for n in range(0xC0, 0x100)}
        self.ids: dict[bytes, bytes] = {}
        self.before: dict[bytes, bytes] = {}

    def _parts(self, text: str) -> int:
        """Into how many parts the tokenizer splits a word before merging; 0: not plain."""
        if text.isalpha():
            return 1
        core = text.rstrip(SYMBOLS)
        if core.isalpha() and "<|" not in text:
            return 2
        if text.isascii() and "'" not in text and "<|" not in text:
            return len(ASCII_PARTS.findall(text))
        return 0

    def _encode_one(self, word: bytes) -> bytes:
        ids = self.tokenizer.encode(word.decode(), add_special_tokens=False).ids
        return np.array(ids, "<u4").tobytes()

    def _merge(self, part: bytes, letters: str | None = None) -> bytes:
        """Ids of a part that the tokenizer passes to its model, as it is or as ``letters``."""
        ids = self.ids.get(part)
        if ids is None and (ids := self.before.get(part)) is None:
            found = [t.id for t in self.model.tokenize(letters or part.decode())]
            ids = struct.pack(f"<{len(found)}I", *found)
        self.ids[part] = ids
        return ids

    def _learn(self, words: Iterable[bytes]) -> None:
        """Split symbols off the ends of words of letters, and learn what is left to learn."""
        others, joined = set(), []
        for word in words:
            core = word.rstrip(SYMBOL_BYTES)
            tail = word[len(core) :]
            if not core:
                ids = b""
            elif core.isalpha() and core.islower():
                ids = self._merge(core)
            elif LATIN_LETTERS.fullmatch(text := core.decode()):
                ids = self._merge(core, text.lower().translate(self.letters))
            elif tail and text.lower().isalpha():
                joined.append((word, core, tail))
                if core not in self.ids:
                    others.add(core)
                continue
            else:
                others.add(word)
                continue
            self.ids[word] = ids + self._merge(tail) if tail else ids
        self._encode_all(others)
        for word, core, tail in joined:
            self.ids[word] = self.ids[core] + self._merge(tail)

    def _encode_all(self, words: set[bytes]) -> None:
        texts = {word: word.decode() for word in words}
        parts = {word: self._parts(text) for word, text in texts.items()}
        plain = [word for word, n in parts.items() if n]
        for word, n in parts.items():
            if not n:
                self.ids[word] = self._encode_one(word)
        for at in range(0, len(plain), 2000):
            group = plain[at : at + 2000]
            text = " ".join([texts[word] for word in group])
            ids = np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4")
            last = np.flatnonzero(self.ends[ids])
            cuts = np.cumsum([parts[word] for word in group])
            if len(last) != cuts[-1]:
                self.ids.update((word, self._encode_one(word)) for word in group)
                continue
            stops = ((last[cuts - 1] + 1) * 4).tolist()
            data = ids.tobytes()
            self.ids.update(zip(group, map(data.__getitem__, map(slice, [0, *stops], stops))))

    def _look_up(self, words: list[bytes]) -> list[bytes]:
        """Ids of different words."""
        found = list(map(self.ids.get, words))
        new = [word for word, ids in zip(words, found) if ids is None]
        if not new:
            return found
        if len(self.ids) + len(new) > self.cache_words:
            # Words that come again move on to the next generation, rare ones are forgotten.
            again = {word: ids for word, ids in zip(words, found) if ids is not None}
            self.before, self.ids = self.ids, again
        elif self.before:
            self.ids.update((word, self.before[word]) for word in new if word in self.before)
            new = [word for word in new if word not in self.ids]
        self._learn(new)
        return [self.ids[word] if ids is None else ids for word, ids in zip(words, found)]

    def encode_texts(self, texts: pa.Array, end: bytes = b"") -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, each with ``end`` behind it, and where each text begins and
        the last one ends."""
        lower = pc.ascii_lower(texts)
        reserved = pc.match_substring(texts, "<|")
        if pc.any(reserved).as_py():
            # Reserved strings are known by their case.
            lower = pc.if_else(reserved, texts, lower)
        words = pc.ascii_split_whitespace(lower)
        stops = words.offsets.to_numpy()[1:]
        numbered = words.values.dictionary_encode()
        known = numbered.dictionary.cast(pa.binary()).to_numpy(zero_copy_only=False).tolist()
        ids = [*self._look_up(known), end]
        order = np.insert(numbered.indices.to_numpy(), stops, len(ids) - 1)
        laid = pa.array(ids, pa.large_binary()).take(pa.array(order))
        _, places, data = laid.buffers()
        places = np.frombuffer(places, "i8", len(order) + 1) // 4
        bounds = places[np.concatenate([[0], stops + np.arange(1, len(stops) + 1)])]
        return np.frombuffer(data, "<u4", bounds[-1]), bounds

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit numbers."""
        data = pa.array([text.encode("utf-8", "replace")], pa.binary())
        return self.encode_texts(data.cast(pa.string()))[0].tobytes()

    def forget(self) -> None:
        self.ids, self.before = {}, {}


_encoders: dict[str, WordEncoder] = {}


def _blocks(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of at most ``most`` bytes of text; a longer text is one of its own."""
    held: list[pa.RecordBatch] = []
    room = most
    for batch in slices(batches):
        ends = np.cumsum(pc.binary_length(batch.column("text")).to_numpy(), dtype="i8")
        start = 0
        while start < len(ends):
            before = ends[start - 1] if start else 0
            stop = int(np.searchsorted(ends, before + room, "right"))
            if stop <= start and held:
                yield pa.concat_batches(held)
                held, room = [], most
                continue
            stop = max(stop, start + 1)
            held.append(batch.slice(start, stop - start))
            room -= ends[stop - 1] - before
            start = stop
    if held:
        yield pa.concat_batches(held)


def _pieces(path: str, size: int, with_ids: bool, cache_words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoders.setdefault(path, None) or WordEncoder(path)
        _encoders[path], encoder.cache_words = encoder, cache_words
        for block in _blocks(batches, BLOCK_BYTES):
            ids, bounds = encoder.encode_texts(block.column("text"), bytes(4))
            counts = -(-np.diff(bounds) // size)
            doc = np.repeat(np.arange(len(counts)), counts)
            piece = np.arange(len(doc)) - np.repeat(np.cumsum(counts) - counts, counts)
            cuts = np.append(bounds[doc] + piece * size, bounds[-1])
            data = memoryview(ids).cast("B")
            crcs = [zlib.crc32(data[a * 4 : b * 4]) for a, b in pairwise(cuts.tolist())]
            columns = [
                block.column("doc_id").take(pa.array(doc)),
                pa.array(piece, pa.int32()),
                pa.array(piece * size, pa.int64()),
                pa.array(np.diff(cuts), pa.int64()),
                pa.array(crcs, pa.int64()),
            ]
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            if with_ids:
                names.append("ids")
                flat = pa.array(ids.view("<i4"))
                columns.append(pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), flat))
            yield pa.RecordBatch.from_arrays(columns, names)
        encoder.forget()  # the worker goes on to other stages
        give_back()

    return run


class _Pool:
    """Lengths still to pack, as a bit set with counts: the largest within a gap in one step."""

    def __init__(self, lengths: np.ndarray, size: int):
        self.size = size
        order = np.argsort(lengths, kind="stable")
        bounds = np.searchsorted(lengths[order], np.arange(size + 2))
        self.rows = [order[a:b].tolist() for a, b in zip(bounds[:-1], bounds[1:])]
        self.bits = sum(1 << n for n, rows in enumerate(self.rows) if rows)

    def largest(self, gap: int) -> int:
        return (self.bits & ((1 << (gap + 1)) - 1)).bit_length() - 1

    def take(self, length: int) -> int:
        rows = self.rows[length]
        row = rows.pop()
        if not rows:
            self.bits &= ~(1 << length)
        return row

    def put(self, length: int, row: int) -> None:
        self.rows[length].append(row)
        self.bits |= 1 << length

    def best_pair(self, gap: int, above: int) -> tuple[int, int] | None:
        """Two lengths with the largest sum within ``gap`` that is more than ``above``."""
        best, found = above, None
        first = self.largest(gap - 1)
        while first > 0 and 2 * first > best:
            second = self.largest(min(first, gap - first))
            if second == first and len(self.rows[first]) < 2:
                second = self.largest(min(first - 1, gap - first))
            if second > 0 and first + second > best:
                best, found = first + second, (first, second)
                if best == gap:
                    break
            first = self.largest(first - 1)
        return found


def best_two_fit(lengths: np.ndarray, size: int) -> list[list[int]]:
    """Bins of row numbers whose lengths add up to at most ``size`` each.

    A bin is filled greedily with the largest piece that fits.  While it has a gap, its smallest
    piece gives way to two unpacked ones if those fill the widened gap more tightly.
    """
    pool = _Pool(np.asarray(lengths), size)
    bins = []
    while pool.bits:
        gap, held = size, []
        while gap and (length := pool.largest(gap)) > 0:
            held.append((length, pool.take(length)))
            gap -= length
        while gap and len(held) > 1 and pool.bits:
            smallest = min(range(len(held)), key=held.__getitem__)
            length, row = held[smallest]
            pair = pool.best_pair(gap + length, length)
            if pair is None:
                break
            held[smallest : smallest + 1] = [(n, pool.take(n)) for n in pair]
            pool.put(length, row)
            gap += length - sum(pair)
        bins.append([row for _, row in held])
    return bins


def _pack(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = [b for b in batches if b.num_rows]
        if not table:
            return
        rows = pa.Table.from_batches(table)
        lengths = rows["length"].to_numpy()
        shard = rows["_shard"][0].as_py()
        bins = best_two_fit(lengths, size)
        order = np.concatenate(bins)
        sizes = np.fromiter(map(len, bins), "i8", len(bins))
        ends = np.cumsum(lengths[order]) - lengths[order]
        first = np.concatenate([[0], np.cumsum(sizes)[:-1]])
        packed = rows.take(pa.array(order)).drop_columns(["_shard"])
        packed = packed.append_column("sequence_id", pa.array(np.repeat((shard << 40) + np.arange(len(bins)), sizes)))
        packed = packed.append_column("offset", pa.array(ends - np.repeat(ends[first], sizes)))
        yield from packed.to_batches(max_chunksize=10_000)

    return run


def pack(
    docs: DataFrame,
    tokenizer: str,
    size: int = SEQUENCE_TOKENS,
    with_ids: bool = True,
    cache_words: int = CACHE_WORDS,
) -> DataFrame:
    """One row per piece: ``doc_id, piece, start, length, ids_crc32``, ``ids`` if asked for, and
    its place, ``sequence_id, offset``.

    A document is its token ids and a closing id 0; null and empty texts are that id alone.
    Documents above ``size`` tokens are cut into pieces of ``size``, the last may be shorter.
    Repeated rows are packed as often as they occur.  An empty table gives no rows; other columns
    are not read.  ``cache_words`` bounds the words that a task remembers, some 200 bytes each: fewer
    cost time and change no result.
    """
    small_batches(docs.sparkSession)
    scratch = Scratch(docs.sparkSession, "pack")
    schema = PIECES + (", ids array<int>" if with_ids else "")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), plain_text().alias("text"))
    pieces = texts.mapInArrow(_pieces(tokenizer, size, with_ids, cache_words), schema)
    pieces = scratch.stage(pieces.withColumn("_row", F.monotonically_increasing_id()), "pieces")
    shards = max(1, -(-pieces.count() // SHARD_PIECES))
    dealt = pieces.select("_row", "length").repartition(shards, "_row")
    dealt = dealt.withColumn("_shard", F.spark_partition_id().cast("long"))
    places = dealt.mapInArrow(_pack(size), "_row long, length long, sequence_id long, offset long")
    # Places are the small side: pieces are shuffled, not sorted.
    places = places.drop("length").hint("shuffle_hash")
    return pieces.join(places, "_row").drop("_row")


def digests(packed: DataFrame) -> DataFrame:
    """Packed rows with ``ids_crc32`` computed from the ids that they hold, and without these."""
    columns = [c for c in packed.columns if c not in ("ids", "ids_crc32")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("ids")
            values, at = ids.values.to_numpy(zero_copy_only=False), ids.offsets.to_pylist()
            data = memoryview(np.ascontiguousarray(values, "<i4")).cast("B")
            crcs = [zlib.crc32(data[a * 4 : b * 4]) for a, b in zip(at, at[1:])]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in columns), pa.array(crcs, pa.int64())],
                [*columns, "ids_crc32"],
            )

    kinds = ", ".join(f"{c} {kind}" for c, kind in packed.dtypes if c in columns)
    return packed.select(*columns, "ids").mapInArrow(run, f"{kinds}, ids_crc32 bigint").select(
        *[c for c in packed.columns if c != "ids"]
    )


ship(__name__)
