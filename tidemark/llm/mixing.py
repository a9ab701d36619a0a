"""Mixing sources to target weights by Poisson replication.

Every document is repeated a Poisson number of times, with the mean its source needs to reach its
target share.  The Poisson value is the inverse of the distribution at a uniform number that a
keyed hash of the document gives, so it depends on nothing but seed, document and mean: a task
that runs again draws the same.  A mean above ``PART_MEAN`` is split into equal parts, each with a
number of its own, as the sum of Poisson values is one of the summed mean; the distribution of a
large mean would start below the smallest double.  The copies are dealt over all partitions by a second hash and
sorted by it within them, which is a shuffle of the whole corpus.

Sizes of sources come from one aggregate with partial sums.  The table of means has a row per
source; it is broadcast if its names and arrays were added up to be within ``BROADCAST_BYTES``.
Else only the sources with more than a ``HOT_SHARE``-th of all documents are, fewer than so many
rows; documents of the others are shuffled to their source, salted by their id.  So a source with a
third of all rows loads no single task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import Scratch

BROADCAST_BYTES = 8 << 20
ROW_BYTES = 64  # of a row besides its name and array
HOT_SHARE = 1000
SALTS = 16
PART_MEAN = 500.0  # exp(-mean) is exact to the last digits up to 708
UNIT = 2.0**-52


def _uniform(seed: str, *columns: Column) -> Column:
    """A number in (0, 1) from 52 bits of a keyed hash."""
    text = F.concat_ws("|", F.lit(seed), *[F.coalesce(c.cast("string"), F.lit("")) for c in columns])
    bits = F.conv(F.left(F.md5(text.cast("binary")), F.lit(13)), 16, 10).cast("double")
    return (bits + 0.5) * UNIT


def _parts(mean: Column) -> Column:
    """Into how many equal parts a mean is split."""
    return F.greatest(F.ceil(mean / PART_MEAN), F.lit(1)).cast("int")


def _draw(sums: Column, parts: Column, seed: str, doc_id: Column) -> Column:
    """The Poisson value of a document: the sum of a draw for each part."""

    def below(drawn: Column) -> Column:
        return F.size(F.filter(sums, lambda total: total <= drawn))

    numbers = F.transform(F.sequence(F.lit(1), parts - 1), lambda k: _uniform(f"{seed} part", doc_id, k))
    more = F.aggregate(numbers, F.lit(0), lambda times, drawn: times + below(drawn))
    return below(_uniform(seed, doc_id)) + F.when(parts > 1, more).otherwise(0)


def _distribution(mean: Column) -> Column:
    """Cumulative probabilities of 0, 1, 2 ... far into the tail (16 deviations and 30)."""
    ends = F.ceil(mean + 16 * F.sqrt(mean)).cast("int") + 30
    start = F.struct(
        F.exp(-mean).alias("p"), F.exp(-mean).alias("sum"), F.array(F.exp(-mean)).alias("all")
    )

    def step(state, k):
        p = state["p"] * mean / k
        total = state["sum"] + p
        return F.struct(
            p.alias("p"), total.alias("sum"), F.concat(state["all"], F.array(total)).alias("all")
        )

    return F.aggregate(F.sequence(F.lit(1), ends), start, step, lambda state: state["all"])


def means(
    docs: DataFrame, weights: dict[str, float] | None, temperature: float, total: float | None
) -> DataFrame:
    """``source, n_docs, mean``: how often a document of each source is to occur on average.

    The share of a source is its entry in ``weights`` (0 where it has none), or by default its
    number of documents to the power ``temperature``.  Shares are scaled so that ``total``
    documents (default: as many as there are) are expected.
    """
    sizes = docs.groupBy("source").agg(F.count(F.lit(1)).alias("n_docs"))
    if weights is None:
        weight = F.pow(F.col("n_docs").cast("double"), F.lit(float(temperature)))
    else:
        given = F.create_map(*[F.lit(x) for pair in weights.items() for x in pair])
        weight = F.coalesce(F.element_at(given, F.col("source")), F.lit(0.0))
    sizes = sizes.withColumn("weight", weight)
    sums = sizes.agg(F.sum("n_docs").alias("all_docs"), F.sum("weight").alias("all_weights"))
    wanted = F.col("all_docs").cast("double") if total is None else F.lit(float(total))
    share = F.col("weight") / F.col("all_weights")
    # One row of totals.
    return sizes.join(F.broadcast(sums)).select(
        "source", "n_docs", F.when(F.col("all_weights") > 0, share * wanted / F.col("n_docs"))
        .otherwise(F.lit(0.0)).alias("mean")
    )


def _with_means(rows: DataFrame, table: DataFrame) -> DataFrame:
    """``row`` with the columns of its source in the staged table of means."""
    same = F.col("row.source").eqNullSafe(F.col("source"))
    name = F.coalesce(F.octet_length(F.col("source").cast("string")), F.lit(0))
    held = (ROW_BYTES + name + 8 * F.size("sums")).cast("long")
    sizes = table.agg(F.sum(held).alias("held"), F.sum("n_docs").alias("docs")).first()
    if (sizes.held or 0) <= BROADCAST_BYTES:
        return rows.join(F.broadcast(table), same)
    is_hot = F.col("n_docs") * HOT_SHARE > sizes.docs
    hot = table.where(is_hot)
    others = table.where(~is_hot).withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    rest = rows.join(F.broadcast(hot.select("source")), same, "left_anti")
    rest = rest.withColumn("own", F.pmod(F.xxhash64("row.doc_id"), F.lit(SALTS)).cast("int"))
    return rows.join(F.broadcast(hot), same).unionByName(
        rest.join(others, same & (F.col("own") == F.col("salt"))).drop("own", "salt")
    )


def copies_of(
    docs: DataFrame,
    weights: dict[str, float] | None = None,
    temperature: float = 0.5,
    total: float | None = None,
    seed: str = "mix",
) -> DataFrame:
    """Documents repeated and shuffled: ``row`` (all their columns), ``copy`` and ``order``.

    ``copy`` counts the repeats of a row from 0; ``order`` is the uniform number that puts it in
    its place.  A null source is a source of its own (in ``weights`` it cannot be named, so it gets
    0 there).  A null ``doc_id`` is drawn as an empty one.  Rows that repeat a ``doc_id`` share
    their draw, each is repeated on its own, and the copies are told apart by a further hash of the
    text only where they tie in order.  An empty table gives no rows.  Extra columns are carried
    whatever their names.
    """
    scratch = Scratch(docs.sparkSession, "mix")
    table = means(docs, weights, temperature, total)
    table = scratch.stage(
        table.select("source", "n_docs", _parts(F.col("mean")).alias("parts"), "mean").select(
            "source", "n_docs", "parts", _distribution(F.col("mean") / F.col("parts")).alias("sums")
        ),
        "means",
    )
    rows = docs.select(F.struct("*").alias("row"))
    doc_id = F.col("row.doc_id")
    times = _draw(F.col("sums"), F.col("parts"), seed, doc_id)
    copies = F.when(times > 0, F.sequence(F.lit(0), times - 1))
    rows = _with_means(rows, table).select("row", F.explode(copies).alias("copy"))
    rows = rows.withColumn("order", _uniform(f"{seed} order", doc_id, F.col("copy")))
    return rows.repartition("order").sortWithinPartitions("order")


def mix(docs: DataFrame, **options) -> DataFrame:
    """The rows of :func:`copies_of` with the columns of documents, ``_copy`` and ``_order``.

    Input columns with one of the last two names are replaced.
    """
    mixed = copies_of(docs, **options)
    taken = {"_copy", "_order"}
    given = [F.col("row").getField(c).alias(c) for c in docs.columns if c.lower() not in taken]
    return mixed.select(*given, F.col("copy").alias("_copy"), F.col("order").alias("_order"))


ORACLE = r"""
WITH RECURSIVE sizes AS (
  SELECT source, count(*) AS n_docs, pow(CAST(count(*) AS DOUBLE), 0.5) AS weight
  FROM documents GROUP BY source),
means AS (
  SELECT source, weight / sum(weight) OVER () * CAST(sum(n_docs) OVER () AS DOUBLE) / n_docs AS mean
  FROM sizes),
steps AS (
  SELECT source, mean, 0 AS k, exp(-mean) AS p, exp(-mean) AS total FROM means
  UNION ALL
  SELECT source, mean, k + 1, p * mean / (k + 1), total + p * mean / (k + 1)
  FROM steps WHERE k < CAST(ceil(mean + 16 * sqrt(mean)) AS INT) + 30),
sums AS (SELECT source, list(total) AS sums FROM steps GROUP BY source),
drawn AS (
  SELECT d.*, len(list_filter(s.sums, lambda x: x <=
      (CAST(CAST('0x' || left(md5('mix|' || coalesce(CAST(d.doc_id AS VARCHAR), '')), 13) AS BIGINT)
        AS DOUBLE) + 0.5) * pow(2.0, -52))) AS times
  FROM documents d JOIN sums s ON d.source IS NOT DISTINCT FROM s.source),
copies AS (
  SELECT doc_id, text, lang, source, n_chars,
         CAST(unnest(range(0, times)) AS INTEGER) AS copy
  FROM drawn)
SELECT *, (CAST(CAST('0x' || left(md5('mix order|' || coalesce(CAST(doc_id AS VARCHAR), '') || '|'
    || copy), 13) AS BIGINT) AS DOUBLE) + 0.5) * pow(2.0, -52) AS order_key
FROM copies
"""
