"""Set-similarity join of documents on word n-grams, to components: rare-first prefix filtering.

1. Count n-grams: every task counts hashes of its n-grams into ``COUNTERS`` counters, which are
   added up by slices; 8 MB in all, whatever the corpus.  They order n-grams from rare to frequent
   (then by hash).  A shared counter can only make the order less sharp, never the result wrong:
   prefix filtering holds for any order that is the same everywhere.
2. Per document: its set, as 64-bit hashes; a fingerprint of the set, by which equal sets become
   one class with one representative; the prefix in that order; and counts of the set by hash
   range.  Only the prefix and the counts are kept, not the set.
3. Documents that share a prefix n-gram are candidates.  Length and positional filters use sizes
   and places in the prefix; the suffix filter bounds what the rest can share by the smaller
   counts of each hash range.
4. First each document is paired with one hub of every n-gram it shares: a number of pairs in
   proportion to the prefixes, also in a group of thousands of copies.  What links there is
   contracted to components.  Then every candidate pair that still lies across two components is
   formed, once, and verified.  Pairs within one component need no look, as membership is known.
5. Verification compares whole sets.  They are computed again from the text, for the documents
   that occur in a pair (a fixed 8 MB bit map says which may).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm import hashing
from tidemark.llm.common import Scratch, plain_text, ship, slices, small_batches
from tidemark.llm.components import components

COUNTER_BITS = 20
COUNTERS = 1 << COUNTER_BITS
SLICES = 64
RANGES = 64
MAP_BITS = 26


def sets_of(texts: list[str | None], n: int) -> Iterator[np.ndarray]:
    """For each text the hashes of its n-grams in order, repeats included.

    A text with fewer words than ``n`` has its whole word sequence as the one n-gram.
    """
    table = hashing.byte_table(hashing.SPACES)
    data = [(t or "").encode("utf-8", "replace") for t in texts]
    for start, end in hashing.chunks(data):
        hashes, counts = hashing.word_hashes(data[start:end], table)
        values, owner = hashing.grams(hashes, counts, tuple(range(1, n)))
        stops = np.searchsorted(owner, np.arange(len(counts) + 1))
        words = np.concatenate([[0], np.cumsum(counts)])
        for k, count in enumerate(counts):
            if 0 < count < n:
                few = hashes[words[k] : words[k + 1]]
                own = np.array([count], "u8")
                gaps = tuple(range(1, int(count)))
                yield hashing.mixed(hashing.grams(few, np.array([count]), gaps)[0] + own)
            else:
                yield values[stops[k] : stops[k + 1]]


def _count_grams(n: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, held, size = np.zeros(COUNTERS, "u4"), [], 0
        shift = np.uint64(64 - COUNTER_BITS)

        def add():
            np.add(total, np.bincount(np.concatenate(held), minlength=COUNTERS), out=total,
                   casting="unsafe")

        for batch in slices(batches):
            for grams in sets_of(batch.column("text").to_pylist(), n):
                held.append((grams >> shift).astype("i8"))
                size += len(grams)
                if size > COUNTERS:
                    add()
                    held, size = [], 0
        if held:
            add()
        yield pa.RecordBatch.from_pydict(
            {"slice": pa.array(range(SLICES), pa.int32()),
             "counts": [part.tobytes() for part in np.split(total, SLICES)]}
        )

    return run


def _add_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    totals: dict[int, np.ndarray] = {}
    for batch in batches:
        for number, counts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            here = totals.setdefault(number, np.zeros(COUNTERS // SLICES, "u8"))
            if len(counts) == 4 * len(here):
                here += np.frombuffer(counts, "u4")
    for number, here in totals.items():
        yield pa.RecordBatch.from_pydict(
            {"slice": pa.array([number], pa.int32()), "counts": [here.tobytes()]}
        )


def gram_counts(texts: DataFrame, n: int) -> np.ndarray:
    """Occurrences of n-grams by the leading bits of their hash, over all texts: 8 MB."""
    schema = "slice int, counts binary"
    parts = texts.mapInArrow(_count_grams(n), schema).repartition(SLICES, "slice")
    found = parts.mapInArrow(_add_counts, schema).collect()
    total = np.zeros(COUNTERS, "u8")
    width = COUNTERS // SLICES
    for number, counts in found:
        total[number * width : (number + 1) * width] = np.frombuffer(counts, "u8")
    return np.minimum(total, (1 << 24) - 1).astype("u4")


def prefix_length(size: int, num: int, den: int) -> int:
    """How many of the rarest n-grams two sets of similarity num/den cannot both miss."""
    return size - -(-size * num // den) + 1 if size else 0


def _describe(n: int, num: int, den: int, counts):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        order = counts.value
        shift, low = np.uint64(64 - COUNTER_BITS), np.uint64(24)
        for batch in slices(batches):
            sizes, marks, prefixes, ranges = [], [], [], []
            for grams in sets_of(batch.column("text").to_pylist(), n):
                own = np.unique(grams)
                size = len(own)
                # Rare first, then by hash; the sort is stable and the hashes are sorted.
                rank = (order[own >> shift].astype("u8") << np.uint64(40)) | (own >> low)
                first = np.argsort(rank, kind="stable")[: prefix_length(size, num, den)]
                sizes.append(size)
                marks.append(
                    np.array([np.add.reduce(hashing.mixed(own)),
                              np.add.reduce(hashing.mixed(own ^ hashing.ODD[1]))], "u8").tobytes()
                )
                prefixes.append(own[first].view("i8"))
                ranges.append(np.bincount((own & np.uint64(RANGES - 1)).astype("i8"),
                                          minlength=RANGES).astype("i4"))
            yield pa.RecordBatch.from_pydict(
                {"doc_id": batch.column("doc_id"), "label": batch.column("label"),
                 "size": pa.array(sizes, pa.int32()), "mark": pa.array(marks, pa.binary()),
                 "prefix": pa.array(prefixes, pa.list_(pa.int64())),
                 "ranges": pa.array(ranges, pa.list_(pa.int32()))}
            )

    return run


def _sets(n: int, wanted):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = wanted.value
        for batch in slices(batches):
            at = batch.column("bit").to_numpy()
            hit = (bits[at >> 6] >> (at & 63).astype("u8")) & np.uint64(1) == 1
            rows = batch.filter(pa.array(hit))
            found = [np.unique(x).view("i8") for x in sets_of(rows.column("text").to_pylist(), n)]
            yield pa.RecordBatch.from_pydict(
                {"label": rows.column("label"), "grams": pa.array(found, pa.list_(pa.int64()))}
            )

    return run


def _compare(num: int, den: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            left, right = (batch.column(c).to_numpy(False) for c in ("left", "right"))
            keep = []
            for x, y in zip(left, right):
                both = len(x) + len(y)
                same = both - len(np.unique(np.concatenate([x, y])))
                keep.append(same > 0 and same * (num + den) >= num * both)
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return run


def label_of(text: Column) -> Column:
    """What tells texts apart: equal texts have one label."""
    return F.unhex(F.md5(text.cast("binary")))


class _Join:
    """The steps of one join, with what they stage."""

    def __init__(self, docs: DataFrame, n: int, num: int, den: int):
        self.spark = docs.sparkSession
        small_batches(self.spark)
        self.scratch = Scratch(self.spark, "jaccard")
        self.n, self.num, self.den = n, num, den
        self.texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), plain_text().alias("text"))
        self.texts = self.texts.withColumn("label", label_of(F.col("text")))

    def describe(self) -> DataFrame:
        share = self.spark.sparkContext.broadcast
        counts = share(gram_counts(self.texts.select("text"), self.n))
        rows = self.texts.mapInArrow(
            _describe(self.n, self.num, self.den, counts),
            "doc_id long, label binary, size int, mark binary, prefix array<long>, ranges array<int>",
        )
        return self.scratch.stage(rows.withColumn("row", F.monotonically_increasing_id()), "docs")

    def may_link(self, a: str, b: str) -> Column:
        """Length and positional filters of two postings of the same n-gram.

        At the first n-gram both have in common nothing before it is shared, so a pair that links
        passes there at least.
        """
        size_a, size_b = F.col(f"{a}.size"), F.col(f"{b}.size")
        both = size_a.cast("long") + size_b
        rest = F.least(size_a - F.col(f"{a}.at"), size_b - F.col(f"{b}.at")).cast("long")
        short, long = F.least(size_a, size_b).cast("long"), F.greatest(size_a, size_b)
        return (short * self.den >= long * self.num) & (rest * (self.num + self.den) >= both * self.num)

    def verify(self, pairs: DataFrame, classes: DataFrame) -> DataFrame:
        """The pairs ``a, b`` of class rows that link."""
        facts = classes.select("row", "label", "size", "ranges")
        one = facts.select(*[F.col(c).alias(f"{c}_a") for c in facts.columns])
        two = facts.select(*[F.col(c).alias(f"{c}_b") for c in facts.columns])
        wide = pairs.join(one, F.col("a") == F.col("row_a")).join(two, F.col("b") == F.col("row_b"))
        shared = F.aggregate(
            F.zip_with("ranges_a", "ranges_b", lambda x, y: F.least(x, y)),
            F.lit(0).cast("long"),
            lambda total, x: total + x,
        )
        both = F.col("size_a").cast("long") + F.col("size_b")
        wide = wide.where(shared * (self.num + self.den) >= both * self.num)
        wide = self.scratch.stage(wide.select("a", "b", "label_a", "label_b"), "pairs")
        used = wide.select(F.explode(F.array("label_a", "label_b")).alias("label"))
        bit = F.xxhash64("label").bitwiseAND((1 << MAP_BITS) - 1)
        words = (
            used.select(bit.alias("bit"))
            .groupBy(F.shiftright("bit", 6).alias("word"))
            .agg(F.bit_or(F.expr("shiftleft(1L, CAST(bit & 63 AS INT))")).alias("bits"))
            .toArrow()  # at most 2**(MAP_BITS - 6) rows
        )
        wanted = np.zeros(1 << (MAP_BITS - 6), "u8")
        wanted[words["word"].to_numpy()] = words["bits"].to_numpy().view("u8")
        wanted = self.spark.sparkContext.broadcast(wanted)
        sets = self.texts.select("label", "text", bit.alias("bit")).mapInArrow(
            _sets(self.n, wanted), "label binary, grams array<long>"
        )
        # Copies of one text have one label and one set.
        sets = self.scratch.stage(sets.dropDuplicates(["label"]), "sets")
        left = sets.select(F.col("label").alias("label_a"), F.col("grams").alias("left"))
        right = sets.select(F.col("label").alias("label_b"), F.col("grams").alias("right"))
        both = wide.join(left, "label_a").drop("label_a").join(right, "label_b").drop("label_b")
        links = both.mapInArrow(_compare(self.num, self.den), "a long, b long")
        links = self.scratch.stage(links, "links")
        self.scratch.drop(wide, sets)
        return links

    def run(self) -> DataFrame:
        """A row per document: its id, ``label``, size, component, and whether it stays."""
        rows = self.describe()
        classes = (
            rows.where("size > 0").groupBy("size", "mark").agg(F.min("row").alias("class"))
        )
        chosen = classes.select(F.col("class").alias("row"))
        first = self.scratch.stage(rows.join(chosen, "row", "left_semi").drop("mark"), "classes")
        postings = first.select("row", "size", F.posexplode("prefix").alias("at", "gram"))
        hub = F.min(F.struct("at", "size", "row")).alias("hub")
        shared = postings.groupBy("gram").agg(F.count(F.lit(1)).alias("n"), hub).where("n > 1")
        postings = self.scratch.stage(postings.join(shared.drop("n"), "gram"), "postings")
        p = postings.select(F.struct("row", "size", "at").alias("p"), "hub")
        stars = p.where((F.col("p.row") != F.col("hub.row")) & self.may_link("p", "hub"))
        stars = stars.select(F.col("p.row").alias("a"), F.col("hub.row").alias("b")).distinct()
        stars = self.scratch.stage(stars, "stars")
        links = self.verify(stars, first)
        group = components(links)
        across = self.across(postings, group, stars)
        links = links.unionByName(self.verify(across, first))
        group = components(links)
        self.scratch.drop(postings, stars)
        # Component of every class, then of every row; its name is the smallest doc_id in it.
        named = classes.join(group, F.col("class") == F.col("node"), "left").select(
            "size", "mark", F.coalesce("component", "class").alias("group")
        )
        wide = rows.select("doc_id", "label", "size", "mark", "row").join(named, ["size", "mark"], "left")
        wide = wide.withColumn("group", F.coalesce("group", "row"))
        best = wide.groupBy("group").agg(
            F.min("doc_id").alias("component_id"),
            F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "row")).alias("best"),
        )
        return wide.join(best, "group").select(
            "doc_id", "label", F.col("size").cast("long").alias("n_shingles"), "component_id",
            (F.col("row") == F.col("best.row")).alias("kept"),
        )

    def across(self, postings: DataFrame, group: DataFrame, tried: DataFrame) -> DataFrame:
        """Candidate pairs of two components that have not been compared."""
        placed = (
            postings.drop("hub")
            .join(group, F.col("row") == F.col("node"), "left")
            .select("gram", "row", "size", "at", F.coalesce("component", "row").alias("group"))
        )
        mixed = placed.groupBy("gram").agg(F.min("group").alias("x"), F.max("group").alias("y"))
        placed = placed.join(mixed.where("x <> y").select("gram"), "gram")
        x, y = placed.alias("x"), placed.alias("y")
        open_pairs = x.join(
            y,
            (F.col("x.gram") == F.col("y.gram"))
            & (F.col("x.row") < F.col("y.row"))
            & (F.col("x.group") != F.col("y.group"))
            & self.may_link("x", "y"),
        ).select(F.col("x.row").alias("a"), F.col("y.row").alias("b")).distinct()
        known = tried.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        return open_pairs.join(known, ["a", "b"], "left_anti")


def near_duplicates(docs: DataFrame, n: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """One row per document: ``doc_id, n_shingles, component_id, kept``.

    Words are runs of bytes other than ASCII white space, with A-Z in lower case.  A document's
    set is its distinct ``n``-word shingles (its whole word sequence where it has fewer words), and
    two documents link when ``den * intersection >= num * union``.  ``component_id`` is the
    smallest ``doc_id`` reachable by links; one row of each component is ``kept``, that with the
    smallest ``doc_id`` (null last).  Null texts and texts without words have empty sets and link
    with nothing.  Repeated rows link like any equal texts.  A component whose ids are all null
    has a null name.  An empty table gives no rows; other columns are not read.
    """
    return _Join(docs, n, num, den).run().drop("label")


def without_near_duplicates(docs: DataFrame, n: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """One row of each component, with all its columns, under the rules of :func:`near_duplicates`.

    Of linked rows that agree in ``doc_id`` and text, any one stays; rows with an empty set all
    stay.  Extra columns are carried whatever their names.
    """
    scratch = Scratch(docs.sparkSession, "jaccard")
    found = _Join(docs, n, num, den).run().groupBy("doc_id", "label")
    found = found.agg(F.bool_or("kept").alias("kept"), F.count_if(F.col("n_shingles") > 0).alias("n"))
    keep = scratch.stage(found.where("kept").drop("kept"), "keep")
    rows = docs.select(F.struct("*").alias("row")).select(
        "row", F.col("row.doc_id").cast("long").alias("own_id"), label_of(plain_text("row.text")).alias("own")
    )
    same = F.col("own_id").eqNullSafe(F.col("doc_id")) & (F.col("own") == F.col("label"))
    rows = rows.join(keep, same)
    if keep.where("n > 1").isEmpty():
        return rows.select("row.*")
    again = rows.where("n > 1").dropDuplicates(["own_id", "own"])
    return rows.where("n <= 1").select("row.*").unionAll(again.select("row.*"))


ship(__name__)
ship(hashing.__name__)
