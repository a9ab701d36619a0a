"""Alignment of two tokenizers' tokens by byte ranges, by merge-path partitioning.

Both tokenizers' tokens of a text end at increasing byte offsets.  The merge of the two lists of
ends is a path of steps through their grid; binary searches along its diagonals cut it into
pieces of equally many steps, each merged by itself.  A piece emits the overlaps (every end closes one
segment, which lies in one token of either side) and numbers the groups it sees from 0; running sums of the
pieces' closed groups stitch what lies across a boundary together.

Texts beyond ``SEGMENT_BYTES`` are cut where both tokenizers start afresh, before a run of blanks
that follows a character that is none, so memory stays bounded; a cut is an end of both.

Overlaps are kept as numbers of the distinct id pairs of a block of texts.  Blocks send each pair
once to be counted corpus-wide, the counts come back to the blocks, and a block's pairs alone are in
memory when its texts are summed up.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
import sentencepiece
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import Scratch, ship

SEGMENT_BYTES = 1 << 20
PIECE_STEPS = 1 << 16
BLOCK_LINKS = 1 << 21
BLANK = "▁"  # fixed value: how the piece vocabulary writes a blank

Batches = Iterator[pa.RecordBatch]


class Pair:
    """Both tokenizers: ids of a text as arrays, and the bytes of every id."""

    def __init__(self, ranks_path: str, pattern: str, piece_path: str):
        with open(ranks_path, "rb") as lines:
            ranks = {base64.b64decode(t): int(n) for t, n in map(bytes.split, lines)}
        self.a = tiktoken.Encoding("a", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.a_bytes = [b""] * (max(ranks.values()) + 1)
        for token, n in ranks.items():
            self.a_bytes[n] = token
        self.b = sentencepiece.SentencePieceProcessor(model_file=piece_path)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_bytes = [
            bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace(BLANK, " ").encode()
            for i, p in enumerate(pieces)
        ]
        # Where no piece goes on with a blank, nothing is merged across the start of blanks.
        self.cuts = not any(BLANK in p.lstrip(BLANK) for p in pieces)
        self.a_sizes = np.array([len(t) for t in self.a_bytes], "i8")
        self.b_sizes = np.array([len(t) for t in self.b_bytes], "i8")

    def encode(self, text: str) -> tuple[np.ndarray, np.ndarray] | None:
        """Ids of a text that starts with the added blank; None where either loses a byte of it."""
        a = self.a.encode_to_numpy(text, allowed_special=set(), disallowed_special=())
        b = self.b.encode(text[1:], num_threads=1)
        data = text.encode()
        if b"".join(map(self.b_bytes.__getitem__, b)) != data:
            return None
        if b"".join(map(self.a_bytes.__getitem__, a.tolist())) != data:
            return None
        return a.astype("i8"), np.array(b, "i8")

    def segments(self, text: str, size: int) -> Iterator[str]:
        """The text in parts of about ``size`` characters, cut where both tokenizers start afresh."""
        at = 0
        while self.cuts and len(text) - at > 2 * size:
            cut = at + size
            while 0 <= (cut := text.find(" ", cut)) and text[cut - 1].isspace():
                cut += 1
            if cut < 0 or len(text) - cut < 2:
                break
            yield text[at:cut]
            at = cut
        yield text[at:]


_pairs: dict[tuple, Pair] = {}


def merge_path(a: np.ndarray, b: np.ndarray, steps: int) -> tuple[np.ndarray, np.ndarray]:
    """How many of ``a`` and ``b`` a merge has taken after every ``steps`` steps; ``a`` goes first.

    One binary search per diagonal, all of them at once.
    """
    total = len(a) + len(b)
    taken = np.append(np.arange(0, total, steps), total)
    low, high = np.maximum(0, taken - len(b)), np.minimum(taken, len(a))
    while (open_ := low < high).any():
        middle = (low[open_] + high[open_]) // 2
        first = a[middle] <= b[taken[open_] - 1 - middle]
        low[open_] = np.where(first, middle + 1, low[open_])
        high[open_] = np.where(first, high[open_], middle)
    return low, taken - low


def merge_piece(a, b, i0: int, i1: int, j0: int, j1: int) -> tuple:
    """One piece of the merge by itself: its overlaps as index pairs, the groups of its tokens
    counted from the piece's start, and which ends of ``a`` are ends of ``b`` too."""
    own_a, own_b = a[i0:i1], b[j0:j1]
    next_b = j0 + np.searchsorted(own_b, own_a)
    common = next_b < len(b)
    common[common] = b[next_b[common]] == own_a[common]
    next_a = i0 + np.searchsorted(own_a, own_b, side="right")
    seen = next_a > 0
    seen[seen] = a[next_a[seen] - 1] == own_b[seen]
    closed = np.concatenate([[0], np.cumsum(common)])
    group_a, group_b = closed[:-1], closed[next_a - i0] - seen
    # An end of both is one overlap, that of ``a``; overlaps come out in the order of their ends.
    new = np.flatnonzero(~seen)
    before = np.concatenate([[0], np.cumsum(~seen)])
    place_a = np.arange(i1 - i0) + before[next_b - j0]
    place_b = np.arange(len(new)) + next_a[new] - i0
    links_a, links_b = np.empty((2, i1 - i0 + len(new)), "i8")
    links_a[place_a], links_b[place_a] = np.arange(i0, i1), next_b
    links_a[place_b], links_b[place_b] = next_a[new], j0 + new
    return links_a, links_b, group_a, group_b, common


@dataclass
class Aligned:
    """Overlaps as indexes of tokens, the group of every token, and the ends that both have."""

    links_a: np.ndarray
    links_b: np.ndarray
    group_a: np.ndarray
    group_b: np.ndarray
    common: np.ndarray


def align_ends(a: np.ndarray, b: np.ndarray, steps: int = PIECE_STEPS) -> Aligned:
    """Align two increasing lists of token ends that finish at the same offset."""
    i, j = merge_path(a, b, steps)
    pieces = [
        merge_piece(a, b, *bounds) for bounds in zip(i[:-1], i[1:], j[:-1], j[1:])
    ]
    if not pieces:
        none = np.zeros(0, "i8")
        return Aligned(none, none, none, none, none.astype(bool))
    before = np.concatenate([[0], np.cumsum([p[4].sum() for p in pieces])])
    stitched = [
        (la, lb, ga + n, gb + n, common) for (la, lb, ga, gb, common), n in zip(pieces, before)
    ]
    return Aligned(*map(np.concatenate, zip(*stitched)))


@cache
def _digits(most: int) -> tuple[np.ndarray, np.ndarray]:
    """Decimal digits of 0 to ``most``, right-aligned in rows of bytes, and how many there are."""
    ids = np.arange(most + 1)
    width = len(str(most))
    powers = 10 ** np.arange(width - 1, -1, -1)
    digits = (ids[:, None] // powers % 10 + 48).astype("u1")
    return digits, 1 + (ids[:, None] >= powers[:-1]).sum(1)


def group_texts(a_ids, b_ids, of_a, of_b, found: Aligned, n: int) -> list[bytes]:
    """The groups of each of ``n`` texts as ``a1,a2|b1;a3|b2``; ``of_a, of_b``: texts of the tokens."""
    groups = int(found.common.sum())
    size_a = np.bincount(found.group_a, minlength=groups)
    size_b = np.bincount(found.group_b, minlength=groups)
    before_a = np.concatenate([[0], np.cumsum(size_a)])
    before_b = np.concatenate([[0], np.cumsum(size_b)])
    place_a = np.arange(len(a_ids)) + before_b[found.group_a]
    place_b = np.arange(len(b_ids)) + before_a[found.group_b + 1]
    total = len(a_ids) + len(b_ids)
    ids, after = np.zeros(total, "i8"), np.full(total, ord(","), "u1")
    ids[place_a], ids[place_b] = a_ids, b_ids
    after[before_a[1:] + before_b[:-1] - 1] = ord("|")
    after[before_a[1:] + before_b[1:] - 1] = ord(";")
    digits, sizes = (table[ids] for table in _digits(max(1 << 16, int(ids.max(initial=0)))))
    cells = np.concatenate([digits, after[:, None]], 1)
    data = cells[np.arange(cells.shape[1]) >= (digits.shape[1] - sizes)[:, None]].tobytes()
    tokens = np.bincount(of_a, minlength=n) + np.bincount(of_b, minlength=n)
    ends = np.concatenate([[0], np.cumsum(sizes + 1)])[np.concatenate([[0], np.cumsum(tokens)])].tolist()
    return [data[x : max(x, y - 1)] for x, y in zip(ends, ends[1:])]


@dataclass
class _Open:
    """What is known of a text after some of its segments."""

    sha: object = field(default_factory=hashlib.sha256)
    counts: np.ndarray = field(default_factory=lambda: np.zeros(4, "i8"))


class _Writer:
    """Gathers the segments of one task into blocks of about ``BLOCK_LINKS`` overlaps."""

    def __init__(self, pair: Pair, segment_bytes: int, steps: int, block_links: int, with_groups: bool):
        self.pair, self.segment_bytes, self.steps = pair, segment_bytes, steps
        self.block_links, self.with_groups = block_links, with_groups
        self.block = TaskContext.get().partitionId() << 33
        self.open = _Open()
        self.part = 0
        self.waiting: list[tuple] = []  # segments: row, doc_id, ids of either side, last
        self.size = 0
        self.parts: list[tuple] = []
        self.keys: list[np.ndarray] = []
        self.links = 0

    def read(self, row: int, doc_id: int | None, data: bytes | None) -> Iterator[pa.RecordBatch]:
        for ids, last in self._encoded(data):
            self.waiting.append((row, doc_id, *ids, last))
            self.size += len(ids[0]) + len(ids[1])
            if self.size >= self.segment_bytes // 2:
                self._merge()
                if self.links >= self.block_links:
                    yield self._block()

    def _encoded(self, data: bytes | None) -> Iterator[tuple]:
        none = np.zeros(0, "i8")
        try:
            text = (data or b"").decode()
        except UnicodeDecodeError:
            text = ""
        if not text:
            yield (none, none), True
            return
        segments = list(self.pair.segments(" " + text, self.segment_bytes))
        if len(segments) > 1 and any(self.pair.encode(s) is None for s in segments):
            segments = []  # asked beforehand, as nothing of such a text may be written
        for at, segment in enumerate(segments):
            ids = self.pair.encode(segment)
            if ids is None:
                break
            yield ids, at == len(segments) - 1
        else:
            if segments:
                return
        yield (none, none), True

    def _merge(self) -> None:
        n = len(self.waiting)
        a_ids = np.concatenate([s[2] for s in self.waiting])
        b_ids = np.concatenate([s[3] for s in self.waiting])
        n_a, n_b = (np.array([len(s[at]) for s in self.waiting]) for at in (2, 3))
        of_a, of_b = np.repeat(np.arange(n), n_a), np.repeat(np.arange(n), n_b)
        found = align_ends(
            np.cumsum(self.pair.a_sizes[a_ids]), np.cumsum(self.pair.b_sizes[b_ids]), self.steps
        )
        keys = a_ids[found.links_a] << 32 | b_ids[found.links_b]
        n_links = np.bincount(of_a[found.links_a], minlength=n)
        n_groups = np.bincount(of_a[found.common], minlength=n)
        texts = group_texts(a_ids, b_ids, of_a, of_b, found, n)
        self.keys.append(keys)
        self.links += len(keys)
        for at, (row, doc_id, _, _, last) in enumerate(self.waiting):
            counts, sha = self.open.counts, self.open.sha
            if counts.any() and n_a[at]:
                sha.update(b";")
            sha.update(texts[at])
            counts += (n_a[at], n_b[at], n_groups[at], n_links[at])
            groups = texts[at].decode() if self.with_groups else None
            whole = (None,) * 5
            if last:
                whole = (*counts.tolist(), sha.hexdigest() if counts.any() else "")
            self.parts.append((row, self.part, doc_id, *whole, groups, int(n_links[at])))
            self.part += 1
            if last:
                self.open, self.part = _Open(), 0
        self.waiting, self.size = [], 0

    def _block(self) -> pa.RecordBatch:
        keys = np.concatenate(self.keys)
        places, pairs = pd.factorize(keys)
        counts = np.bincount(places, minlength=len(pairs))
        offsets = np.concatenate([[0], np.cumsum([p[-1] for p in self.parts])]).astype("i4")
        lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(places.astype("i4")))
        rows = list(zip(*(p[:-1] for p in self.parts)))
        n = len(self.parts)
        columns = [
            pa.array([self.block] * (n + 1), pa.int64()),
            *(
                pa.array([*values, None], kind.type)
                for values, kind in zip(rows, PARTS)
            ),
            pa.concat_arrays([lists, pa.nulls(1, lists.type)]),
            pa.array([*[None] * n, pairs], pa.list_(pa.int64())),
            pa.array([*[None] * n, counts], pa.list_(pa.int64())),
        ]
        self.block += 1
        self.parts, self.keys, self.links = [], [], 0
        return pa.RecordBatch.from_arrays(columns, ["block", *[k.name for k in PARTS], "links", "pairs", "counts"])

    def rest(self) -> Iterator[pa.RecordBatch]:
        if self.waiting:
            self._merge()
        if self.parts:
            yield self._block()


COUNTS = ("n_a", "n_b", "n_groups", "n_links")
PARTS = [
    pa.field("row", pa.int64()), pa.field("part", pa.int32()), pa.field("doc_id", pa.int64()),
    *[pa.field(c, pa.int64()) for c in COUNTS],
    pa.field("groups_sha256", pa.string()), pa.field("groups", pa.string()),
]
STAGED = (
    "block long, row long, part int, doc_id long, n_a long, n_b long, n_groups long, n_links long, "
    "groups_sha256 string, groups string, links array<int>, pairs array<long>, counts array<long>"
)


def _align(paths: tuple, *options):
    def run(batches: Batches) -> Batches:
        pair = _pairs.get(paths) or _pairs.setdefault(paths, Pair(*paths))
        writer = _Writer(pair, *options)
        for batch in batches:
            for row, doc_id, text in zip(*(batch.column(c) for c in ("row", "doc_id", "text"))):
                yield from writer.read(row.as_py(), doc_id.as_py(), text.as_py())
        yield from writer.rest()

    return run


def _aligned(docs: DataFrame, paths, segment_bytes, steps, block_links, with_groups) -> DataFrame:
    rows = docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("text").cast("binary").alias("text"),
    )
    return rows.mapInArrow(_align(tuple(paths), segment_bytes, steps, block_links, with_groups), STAGED)


def _sum_up(batches: Batches) -> Batches:
    """Rows sorted by block: first its pairs' counts in their order, then its texts' overlaps."""
    block, totals, best = None, [], []
    for batch in batches:
        blocks, kinds = batch.column("block").to_numpy(), batch.column("kind").to_numpy()
        change = np.flatnonzero((np.diff(blocks) != 0) | (np.diff(kinds) != 0)) + 1
        for start, stop in zip([0, *change], [*change, len(blocks)]):
            if start == stop:
                continue
            run = batch.slice(start, stop - start)
            if blocks[start] != block:
                block, totals, best = blocks[start], [], []
            if kinds[start] == 0:
                totals.append(run.column("total").to_numpy())
                best.append(run.column("best").to_numpy())
                continue
            totals = [np.concatenate([*totals, np.zeros(0, "i8")])]
            best = [np.concatenate([*best, np.zeros(0, "i8")])]
            links = run.column("links")
            of = np.repeat(np.arange(len(run)), [len(x) for x in links])
            places = links.flatten().to_numpy()
            sums = []
            for values in (best[0], totals[0]):
                sums.append(np.zeros(len(run), "i8"))
                np.add.at(sums[-1], of, values[places])
            kept = ["row", "doc_id", *COUNTS, "groups_sha256"]
            yield pa.RecordBatch.from_arrays(
                [*(run.column(c) for c in kept), *map(pa.array, sums)], [*kept, "n_best", "count_sum"]
            )


def alignment(
    docs: DataFrame,
    ranks_path: str,
    pattern: str,
    piece_path: str,
    segment_bytes: int = SEGMENT_BYTES,
    steps: int = PIECE_STEPS,
    block_links: int = BLOCK_LINKS,
) -> DataFrame:
    """``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256`` of every document.

    Tokenizer A (byte-level ranks with a splitting pattern) reads a blank and the text, tokenizer B
    (a piece vocabulary) the text, to which it adds the blank itself.  Offsets where tokens of both
    end cut them into groups; tokens link where their byte ranges overlap.  ``n_best`` counts the
    links whose id pair occurs most often of all with its B id, corpus-wide, and ``count_sum`` adds
    up the pairs' occurrences.  Texts that are null, empty or not valid, or that a tokenizer does not give back
    byte by byte, have no tokens: zeros and ''.  Repeated rows count as rows, null ids stay; an
    empty table gives no rows, and other columns are not read.
    """
    scratch = Scratch(docs.sparkSession, "alignment")
    paths = (ranks_path, pattern, piece_path)
    staged = _aligned(docs, paths, segment_bytes, steps, block_links, False).drop("groups", "part")
    staged = scratch.stage(staged, "blocks")
    tables = staged.where(F.col("pairs").isNotNull()).select("block", "pairs", "counts")
    pairs = tables.select("block", F.posexplode(F.arrays_zip("pairs", "counts")).alias("place", "pair"))
    pairs = pairs.select("block", "place", F.col("pair.pairs").alias("pair"), F.col("pair.counts").alias("n"))
    totals = scratch.stage(pairs.groupBy("pair").agg(F.sum("n").alias("total")), "totals")
    b_id = F.col("pair").bitwiseAND((1 << 32) - 1).alias("b_id")
    most = totals.groupBy(b_id).agg(F.max("total").alias("most"))
    known = totals.withColumn("b_id", b_id).join(most, "b_id").select(
        "pair", "total", (F.col("total") == F.col("most")).cast("long").alias("best")
    )
    back = pairs.join(known, "pair").select(
        "block", F.lit(0).alias("kind"), F.col("place").cast("long").alias("place"), "total", "best"
    )
    texts = staged.where(F.col("row").isNotNull()).drop("pairs", "counts")
    texts = texts.withColumns({"kind": F.lit(1), "place": F.col("row")})
    both = back.unionByName(texts, allowMissingColumns=True)
    summed = (
        both.repartition("block").sortWithinPartitions("block", "kind", "place")
        .mapInArrow(
            _sum_up,
            "row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, "
            "groups_sha256 string, n_best long, count_sum long",
        )
    )
    # A text of several segments has as many rows, and its counts on the last.
    whole = summed.groupBy("row").agg(
        *[F.max(c).alias(c) for c in ("doc_id", *COUNTS, "groups_sha256")],
        *[F.sum(c).alias(c) for c in ("n_best", "count_sum")],
    )
    return whole.select("doc_id", *COUNTS, "n_best", "count_sum", "groups_sha256")


def groups(
    docs: DataFrame,
    ranks_path: str,
    pattern: str,
    piece_path: str,
    segment_bytes: int = SEGMENT_BYTES,
    steps: int = PIECE_STEPS,
) -> DataFrame:
    """The groups themselves: ``doc_id, row, part, groups``, as ``a1,a2|b1;a3|b2,b3`` of ids.

    ``row`` tells documents of one id apart.  A long text has several parts, in order; no group
    reaches from one into the next.
    """
    paths = (ranks_path, pattern, piece_path)
    found = _aligned(docs, paths, segment_bytes, steps, BLOCK_LINKS, True)
    return found.where(F.col("row").isNotNull()).select("doc_id", "row", "part", "groups")


ship(__name__)
