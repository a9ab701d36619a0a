"""Codes of vectors: per part the nearest entry of a codebook, in whole numbers throughout.

Components become integers, vectors are cut into equal parts, and the codebook of each part
position is improved in rounds (assign every part to its nearest entry, replace each entry by the
mean of its parts, rounded down).  The nearest entry is found on integer Walsh-Hadamard transforms
of the zero-padded parts and entries: squared differences there add up to the padded length times
the squared distance, and in sequency order the first few hold most of it.  An entry goes as soon
as its sum so far exceeds the whole sum of a good candidate, so no entry that could be nearest is
lost, and ties stay whole until the lowest index is taken.

A round is one pass over the staged integers.  Each task reduces its parts to one sum per part,
entry and position, so a round shuffles a fixed number of rows per task; the codebooks (parts x
entries x part length numbers, whatever the table's size) travel with the tasks.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import Scratch, ship

PARTS = 4
ENTRIES = 256
ROUNDS = 4
SCALE = 1024
CELLS = 1 << 20  # part-entry pairs that are compared together in a task
HOT_SHARE = 1000  # a label with more than this fraction of the rows is hot: fewer than this many


def sequency_order(size: int) -> np.ndarray:
    """Places of the Walsh functions of 0, 1, 2, ... sign changes in the butterfly's output."""
    bits = size.bit_length() - 1
    gray = np.arange(size) ^ (np.arange(size) >> 1)
    order = np.zeros(size, "i8")
    for bit in range(bits):
        order |= ((gray >> bit) & 1) << (bits - 1 - bit)
    return order


def walsh(rows: np.ndarray) -> np.ndarray:
    """Integer Walsh-Hadamard transform of each row, zero-padded to a power of two, by sequency."""
    size = 1 << max(0, rows.shape[1] - 1).bit_length()
    out = np.zeros((len(rows), size), "i8")
    out[:, : rows.shape[1]] = rows
    half = 1
    while half < size:
        pairs = out.reshape(len(rows), -1, 2, half)
        out = np.stack([pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]], 2)
        out = out.reshape(len(rows), size)
        half *= 2
    return out[:, sequency_order(size)]


def _nearest(parts: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of the nearest entry of each transformed part, and the scaled squared distance."""
    size = parts.shape[1]
    low = min(2, size)
    sums = np.zeros((len(parts), len(entries)), "i8")
    for at in range(low):
        sums += (parts[:, at, None] - entries[None, :, at]) ** 2
    # The whole distance to the entry that leads so far: nothing beyond it can be nearest.
    bound = ((parts - entries[sums.argmin(1)]) ** 2).sum(1)
    row, entry = np.nonzero(sums <= bound[:, None])
    sums = sums[row, entry]
    while low < size:
        high = min(size, 2 * low)
        sums += ((parts[row, low:high] - entries[entry, low:high]) ** 2).sum(1)
        left = sums <= bound[row]
        row, entry, sums = row[left], entry[left], sums[left]
        low = high
    starts = np.flatnonzero(np.diff(row, prepend=-1))
    least = np.minimum.reduceat(sums, starts)
    # Candidates are in order of row and entry: the first at the least distance is the lowest.
    best = np.flatnonzero(sums == least[row])
    best = best[np.flatnonzero(np.diff(row[best], prepend=-1))]
    return entry[best], least


def nearest(parts: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nearest entry (lowest index of equals) and exact squared distance of each integer part."""
    found, scaled = np.zeros(len(parts), "i8"), np.zeros(len(parts), "i8")
    codes = walsh(entries)
    step = max(1, CELLS // len(entries))
    for at in range(0, len(parts), step):
        piece = walsh(parts[at : at + step])
        found[at : at + step], scaled[at : at + step] = _nearest(piece, codes)
    return found, scaled // codes.shape[1]


def _vectors(batch: pa.RecordBatch, width: int) -> np.ndarray:
    column = batch.column("vector")
    return column.flatten().to_numpy().astype("i8").reshape(len(column), width)


def _integers(scale: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column("vector")
            numbers = np.floor(column.flatten().to_numpy() * scale).astype("i4")
            sizes = np.fromiter(map(len, column), "i4", len(column))
            offsets = pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype("i4"))
            ints = pa.ListArray.from_arrays(offsets, pa.array(numbers))
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), batch.column("label"), ints], ["vec_id", "label", "vector"]
            )

    return run


def _sums(books: np.ndarray):
    """Count and sums of the parts of each entry, one row per part, entry and position."""
    parts, entries, width = books.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((parts, entries, width), "i8")
        count = np.zeros((parts, entries), "i8")
        for batch in batches:
            if not batch.num_rows:
                continue
            vectors = _vectors(batch, parts * width)
            for p in range(parts):
                own = vectors[:, p * width : (p + 1) * width]
                entry, _ = nearest(own, books[p])
                np.add.at(total[p], entry, own)
                np.add.at(count[p], entry, 1)
        p, e = np.nonzero(count)
        at = np.tile(np.arange(width), len(p))
        p, e = np.repeat(p, width), np.repeat(e, width)
        yield pa.RecordBatch.from_pydict(
            {
                "part": p.astype("i4"), "entry": e.astype("i4"), "at": at.astype("i4"),
                "n": count[p, e], "total": total[p, e, at],
            }
        )

    return run


def _codes(books: np.ndarray):
    parts, _, width = books.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            vectors = _vectors(batch, parts * width)
            error = np.zeros(len(vectors), "i8")
            code = np.zeros((len(vectors), parts), "u1")
            for p in range(parts):
                entry, distance = nearest(vectors[:, p * width : (p + 1) * width], books[p])
                code[:, p], error = entry, error + distance
            text = [row.tobytes().hex() for row in code]
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), batch.column("label"), pa.array(text), pa.array(error)],
                ["vec_id", "label", "code", "error"],
            )

    return run


def _train(ints: DataFrame, books: np.ndarray, rounds: int) -> np.ndarray:
    for _ in range(rounds):
        sums = ints.select("vector").mapInArrow(
            _sums(books), "part int, entry int, at int, n long, total long"
        )
        # A fixed number of rows, that of the numbers in the codebooks.
        found = sums.groupBy("part", "entry", "at").agg(F.sum("n").alias("n"), F.sum("total").alias("total"))
        found = found.toArrow()
        part, entry, at, n, total = (found[c].to_numpy() for c in ("part", "entry", "at", "n", "total"))
        books = books.copy()
        books[part, entry, at] = total // n
    return books


def limit(width: int) -> int:
    """Largest integer component for which every sum of the transform stays in 64 bits."""
    size = 1 << max(0, width - 1).bit_length()
    return min(math.isqrt((1 << 60) // (size * size)), (1 << 31) - 1)


def encode(
    vectors: DataFrame,
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
    scale: int = SCALE,
) -> tuple[DataFrame, np.ndarray]:
    """``vec_id, label, code, error`` of every usable vector, and the codebooks.

    Vectors that are null or empty or hold null or non-finite components are left out.  The codebooks
    (parts x entries x part length) start from the vectors of the smallest non-null ids; with fewer
    vectors than ``entries`` they are shorter, and of repeated ids the smaller vector comes first.
    ``code`` has two hex digits per part, so ``entries`` is at most 256; ``error`` is the squared
    distance to the coded vector, in the integers.  A length that ``parts`` does not divide is
    extended by zeros.  The vector of the smallest id sets the length: others, and
    vectors with a component so large (some 65,000 for parts of 16) that squares leave 64 bits, keep their row
    with a null ``code`` and ``error``.  An empty table gives no rows and empty codebooks; columns other than
    ``vec_id, embedding, label`` are not read.
    """
    if not 1 <= entries <= 256:
        raise ValueError("entries must be from 1 to 256: a code is two hex digits")
    scratch = Scratch(vectors.sparkSession, "codes")
    value = F.col("embedding").cast("array<double>")
    finite = F.forall(value, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    kept = vectors.where(finite & (F.size(value) > 0)).select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.col("label").cast("string").alias("label"),
        value.alias("vector"),
    )
    first = kept.where(F.col("vec_id").isNotNull()).orderBy("vec_id", "vector").limit(1).collect()
    empty = np.zeros((parts, 0, 0), "i8")
    if not first:
        none = kept.select("vec_id", "label", F.lit(None).cast("string").alias("code"), F.lit(None).cast("long").alias("error"))
        return none, empty
    length = len(first[0].vector)
    width = -(-length // parts)
    most = limit(width) / scale
    fits = (F.size("vector") == length) & F.forall("vector", lambda v: F.abs(v) < most)
    padded = F.concat("vector", F.array_repeat(F.lit(0.0), parts * width - length))
    usable = kept.where(fits).select("vec_id", "label", padded.alias("vector"))
    ints = usable.mapInArrow(_integers(scale), "vec_id long, label string, vector array<int>")
    ints = scratch.stage(ints, "integers")
    start = ints.where(F.col("vec_id").isNotNull()).orderBy("vec_id", "vector").limit(entries)
    start = np.array([r.vector for r in start.select("vector").collect()], "i8").reshape(-1, parts, width)
    unfit = kept.where(~fits).select(
        "vec_id", "label", F.lit(None).cast("string").alias("code"), F.lit(None).cast("long").alias("error")
    )
    if not len(start):
        return unfit, empty
    books = _train(ints, np.ascontiguousarray(start.swapaxes(0, 1)), rounds)
    coded = ints.mapInArrow(_codes(books), "vec_id long, label string, code string, error long")
    return scratch.stage(coded.unionByName(unfit), "coded"), books


def books_sha256(books: np.ndarray) -> str:
    """Digest of all entries' numbers by part, entry and position."""
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def with_label_errors(coded: DataFrame) -> DataFrame:
    """Adds ``label_error``, the summed errors of a label's rows; rows without a label are one.

    Labels with more than a thousandth of the rows, of which there are fewer than a thousand, come
    back by a broadcast and load no single task; the rows of the others meet theirs by a shuffle.
    """
    key = F.coalesce(F.concat(F.lit("="), "label"), F.lit(""))
    keyed = coded.withColumn("_key", key)
    totals = keyed.groupBy("_key").agg(
        F.count(F.lit(1)).alias("_n"), F.sum("error").alias("label_error")
    )
    totals = Scratch(coded.sparkSession, "codes").stage(totals, "labels")
    rows = totals.agg(F.sum("_n")).first()[0] or 0
    is_hot = F.col("_n") * HOT_SHARE > rows
    hot = totals.where(is_hot).select("_key", "label_error")
    rest = totals.where(~is_hot).select("_key", "label_error")
    near = keyed.join(F.broadcast(hot), "_key")
    far = keyed.join(F.broadcast(hot), "_key", "left_anti").join(rest, "_key")
    return near.unionByName(far).drop("_key")


def _oracle() -> str:
    steps = [
        """
  kept AS MATERIALIZED (
    SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor(CAST(x AS DOUBLE) * 1024) AS BIGINT)) AS v
    FROM embeddings
    WHERE embedding IS NOT NULL AND len(embedding) > 0
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
  p AS MATERIALIZED (
    SELECT vec_id, label, k AS part, v[k * (len(v) // 4) + 1 : (k + 1) * (len(v) // 4)] AS p
    FROM kept, range(4) AS r(k)),
  b0 AS MATERIALIZED (
    SELECT part, entry, p AS e
    FROM p JOIN (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS entry FROM kept
                 QUALIFY entry < 256) USING (vec_id))"""
    ]
    for r in range(5):
        steps.append(f"""
  a{r} AS MATERIALIZED (
    SELECT vec_id, label, part, p,
           min({{'d': list_sum(list_transform(list_zip(p, e), lambda z: (z[1] - z[2]) * (z[1] - z[2]))), 'e': entry}}) AS best
    FROM p JOIN b{r} USING (part) GROUP BY ALL)""")
        steps.append(f"""
  b{r + 1} AS MATERIALIZED (
    SELECT part, entry, coalesce(m.e, b.e) AS e
    FROM b{r} b LEFT JOIN (
      SELECT part, entry,
             list(CAST(CASE WHEN s % n < 0 THEN s // n - 1 ELSE s // n END AS BIGINT) ORDER BY i) AS e
      FROM (SELECT part, best.e AS entry, i, sum(p[i]) AS s, count(*) AS n
            FROM a{r}, range(1, (SELECT max(len(p)) FROM p) + 1) AS g(i) GROUP BY ALL)
      GROUP BY ALL) m USING (part, entry))""")
    return f"""
WITH {",".join(steps[:-1])},
  rows AS (
    SELECT vec_id, label, string_agg(lower(printf('%02x', best.e)), '' ORDER BY part) AS code,
           CAST(sum(best.d) AS BIGINT) AS error
    FROM a4 GROUP BY ALL),
  books AS (
    SELECT sha256(string_agg(CAST(e[i] AS VARCHAR), ',' ORDER BY part, entry, i)) AS codebooks_sha256
    FROM b4, range(1, (SELECT max(len(e)) FROM b4) + 1) AS g(i))
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
FROM rows, books
"""


ORACLE = _oracle()

ship(__name__)
