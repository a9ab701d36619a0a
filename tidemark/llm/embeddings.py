"""Near-duplicate vectors: random-hyperplane sign hashing in several tables, exact cosines.

Equal vectors of a label become one class first, so a vector that occurs very often is compared
once.  In every table a class falls into the bucket of its signs; only buckets with two classes or
more go on.  A bucket is dealt into blocks of about ``BLOCK`` classes, and each pair of blocks is
one unit of work: a matrix product finds the pairs, so neither memory nor a task grows with a
bucket.  A unit gives the number of links of each class and the links that span what it connected,
not the pairs.  A pair that meets in several tables counts in the first of them: each class
carries its signs of all tables.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import Scratch, ship
from tidemark.llm.components import components

TABLES = 24
BITS = 20
BLOCK = 1024
COSINE = 0.98


def _signs(tables: int, bits: int, seed: int):
    """Adds the unit vector's sign codes, one int per table."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes: dict[int, np.ndarray] = {}
        powers = 1 << np.arange(bits)
        for batch in batches:
            codes = []
            for vector in batch.column("vector").to_numpy(False):
                size = len(vector)
                if size not in planes:
                    draw = np.random.default_rng([seed, size])
                    planes[size] = draw.standard_normal((size, tables * bits))
                signs = np.asarray(vector, "f8") @ planes[size] >= 0
                codes.append((signs.reshape(tables, bits) @ powers).astype("i4"))
            yield batch.append_column("codes", pa.array(codes, pa.list_(pa.int32())))

    return run


def _units(threshold: float):
    """Compares the blocks of one unit at a time; rows come sorted by unit."""

    def compare(rows: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(rows)
        table_no = table["table_no"][0].as_py()
        side = table["side"].to_numpy()
        ids, count = table["class"].to_numpy(), table["n"].to_numpy()
        x = np.stack([np.asarray(v, "f8") for v in table["vector"].to_numpy()])
        x /= np.abs(x).max(axis=1, keepdims=True)  # no square leaves the range of doubles
        x /= np.sqrt(np.einsum("ij,ij->i", x, x))[:, None]
        codes = np.stack(table["codes"].to_numpy())
        left, right = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
        alone = len(right) == 0
        if alone:
            right = left
        a, b = np.nonzero(x[left] @ x[right].T >= threshold)
        a, b = left[a], right[b]
        if alone:
            a, b = a[a < b], b[a < b]
        new = ~(codes[a, :table_no] == codes[b, :table_no]).any(axis=1)
        a, b = a[new], b[new]
        links = np.zeros(len(ids), "i8")
        np.add.at(links, a, count[b])
        np.add.at(links, b, count[a])
        # Each linked class points to the smallest it meets, by repeated minimum over the links.
        least = np.arange(len(ids))
        order = np.argsort(ids)
        rank = np.empty_like(order)
        rank[order] = np.arange(len(ids))
        least = rank.copy()
        while True:
            before = least.copy()
            np.minimum.at(least, a, least[b])
            np.minimum.at(least, b, least[a])
            if (before == least).all():
                break
        used = np.flatnonzero(links)
        return pa.RecordBatch.from_pydict(
            {"class": ids[used], "n_links": links[used], "near": ids[order[least[used]]]}
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unit, held = None, []
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = list(zip(*(batch.column(c).to_pylist() for c in ("bucket", "first", "second"))))
            start = 0
            for at in range(1, len(keys) + 1):
                if at == len(keys) or keys[at] != keys[start]:
                    if keys[start] != unit and held:
                        yield compare(held)
                        held = []
                    unit = keys[start]
                    held.append(batch.slice(start, at - start))
                    start = at
        if held:
            yield compare(held)

    return run


def near_vectors(
    vectors: DataFrame,
    cosine: float = COSINE,
    tables: int = TABLES,
    bits: int = BITS,
    block: int = BLOCK,
    seed: int = 7,
) -> DataFrame:
    """One row per vector: ``vec_id, n_links, component_id, kept``.

    Vectors of equal, non-null label link when their cosine in double precision is at least
    ``cosine`` and they share a bucket in some table (a pair at exactly 0.98 is missed with a
    probability below 0.001; no pair below the threshold links).  ``n_links`` counts other rows
    linked directly, ``component_id`` is the smallest ``vec_id`` reachable, ``kept`` says that it
    is the row's own.  Vectors that are null, empty or zero or hold null or non-finite numbers,
    and vectors without a label, link with nothing.  Vectors of different length do not link.
    Repeated rows link with each other like any equal vectors.  Null ids are kept as null and do
    not name a component unless all of it is null.  An empty table gives no rows; other columns
    are not read.
    """
    scratch = Scratch(vectors.sparkSession, "vectors")
    value = F.col("embedding").cast("array<double>")
    finite = F.forall(value, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    good = F.col("label").isNotNull() & finite & F.exists(value, lambda v: v != 0)
    rows = vectors.select(
        F.monotonically_increasing_id().alias("row"),
        F.col("vec_id").cast("long").alias("vec_id"),
        F.when(good, F.col("label").cast("string")).alias("label"),
        # Adding zero makes -0.0 the same as 0.0.
        F.when(good, F.transform(value, lambda v: v + 0.0)).alias("vector"),
    )
    rows = scratch.stage(rows, "rows")
    usable = rows.where(F.col("label").isNotNull())
    classes = usable.groupBy("label", "vector").agg(
        F.min("row").alias("class"), F.count(F.lit(1)).alias("n")
    )
    signed = classes.select("class", "n", "label", "vector").mapInArrow(
        _signs(tables, bits, seed),
        "class long, n long, label string, vector array<double>, codes array<int>",
    )
    signed = scratch.stage(signed, "classes")
    places = signed.select(
        "class", F.posexplode("codes").alias("table_no", "code"), "label", F.size("vector").alias("size")
    )
    key = ["table_no", "code", "label", "size"]
    full = (
        places.groupBy(*key).agg(F.count(F.lit(1)).alias("members")).where("members > 1")
        .withColumn("bucket", F.monotonically_increasing_id())
    )
    full = scratch.stage(full, "buckets")
    # A class goes to every unit that its block is part of, on the left or on the right.
    blocks = F.ceil(F.col("members") / block).cast("int")
    placed = (
        places.join(full, key)
        .withColumn("blocks", blocks)
        .withColumn("own", F.pmod(F.xxhash64("class"), F.col("blocks")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select(
            "bucket", "table_no", "class",
            F.least("own", "other").alias("first"), F.greatest("own", "other").alias("second"),
            (F.col("own") > F.col("other")).cast("int").alias("side"),
        )
    )
    unit = ["bucket", "first", "second"]
    work = placed.join(signed.select("class", "n", "vector", "codes"), "class")
    found = (
        work.repartition(*unit).sortWithinPartitions(*unit)
        .mapInArrow(_units(cosine), "class long, n_links long, near long")
    )
    found = scratch.stage(found, "links")
    group = components(found.select(F.col("class").alias("a"), F.col("near").alias("b")))
    links = found.groupBy("class").agg(F.sum("n_links").alias("links"))
    known = (
        classes.select("label", "vector", "n", "class")
        .join(links, "class", "left")
        .join(group, F.col("class") == F.col("node"), "left")
        .select(
            "label", "vector", F.coalesce("component", "class").alias("group"),
            (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
        )
    )
    wide = rows.join(known, ["label", "vector"], "left").select(
        "vec_id", F.coalesce("group", "row").alias("group"),
        F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"),
    )
    names = wide.groupBy("group").agg(F.min("vec_id").alias("component_id"))
    return wide.join(names, "group").select(
        "vec_id", "n_links", "component_id",
        F.col("vec_id").eqNullSafe(F.col("component_id")).alias("kept"),
    )


ship(__name__)
