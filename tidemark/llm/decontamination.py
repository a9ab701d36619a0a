"""Benchmark decontamination: windows of test words, looked up in every training text.

Each benchmark item gives its windows of ``n`` consecutive words (an item of fewer words is one
window).  The distinct windows form a dictionary with a 64-bit hash; it is broadcast if its counted size is
within ``BROADCAST_BYTES``, else it is joined by a shuffle of hashes.  Texts beyond ``PIECE_CHARS``
are cut into pieces of ``PIECE_WORDS`` words, each with the first words of the next one, so neither a
long text nor its windows are held at once.  Words are hashed once, and every place of a piece becomes a
row that hashes its window from these in generated code; a hit counts only if the words themselves
agree.

Hit words are bits: a window sets at most a few 64-bit masks, which are joined by OR before and
after the shuffle, so a text or passage with very many hits stays small.  Everything is DataFrame
operations; no Python runs on executors.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import Scratch, plain_text, ship

WINDOW = 10
MOST_WORDS = 64  # of a window
PIECE_CHARS = 1 << 16
PIECE_WORDS = 4096
BROADCAST_BYTES = 32 << 20
ROW_BYTES = 120  # of a window in a hash table, beside its words

# Fixed value: the characters between words once A-Z are lower-cased.
GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]"
LETTER = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]"
# The same before A-Z are lower-cased.
RAW_GAP = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]"
RAW_LETTER = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def lower_ascii(text: Column) -> Column:
    """A-Z lower-cased and nothing else; texts all of ASCII take the faster way."""
    plain = F.octet_length(text) == F.length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, UPPER, UPPER.lower()))


def words_of(text: Column) -> Column:
    """Splitting is several times faster than extracting; only the ends can be empty."""
    return F.array_remove(F.split(text, f"{GAP}+"), "")


def bound(value: Column, use) -> Column:
    """``use(value)`` with ``value`` worked out once, though ``use`` names it in further lambdas."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def word_hashes(words: Column) -> Column:
    return F.transform(words, lambda w: F.xxhash64(w))


def window_hash(hashes: Column, at: Column, size: Column, n: int) -> Column:
    """Hash of the ``size`` words from ``at`` on; the nulls of places beyond it are passed over."""
    return F.xxhash64(*[F.when(size > k, F.get(hashes, at + k)) for k in range(n)])


def dictionary(scratch: Scratch, benchmark: DataFrame, n: int) -> tuple[DataFrame, DataFrame]:
    """Distinct windows ``window, hash, size, gram``, and ``window, item`` of the items they occur in."""
    items = benchmark.select(
        F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"),
        words_of(lower_ascii(plain_text())).alias("words"),
    ).where(F.size("words") > 0)
    size = F.least(F.size("words"), F.lit(n))
    grams = items.select(
        "item",
        F.explode(
            bound(
                F.struct(F.col("words"), size.alias("size")),
                lambda s: F.transform(
                    F.sequence(F.lit(1), F.size(s["words"]) - s["size"] + 1),
                    lambda at: F.slice(s["words"], at, s["size"]),
                ),
            )
        ).alias("gram"),
    )
    grams = scratch.stage(grams, "grams")
    windows = grams.select("gram").distinct().select(
        F.monotonically_increasing_id().alias("window"),
        word_hashes(F.col("gram")).alias("hashes"),
        F.size("gram").alias("size"),
        "gram",
    )
    hashed = window_hash(F.col("hashes"), F.lit(0), F.col("size"), n).alias("hash")
    windows = scratch.stage(windows.select("window", hashed, "size", "gram"), "windows")
    places = grams.distinct().join(windows.select("window", "gram"), "gram").select("window", "item")
    return windows, scratch.stage(places, "places")


def small_enough(table: DataFrame, size: Column, limit: int) -> bool:
    """Whether a staged table, at ``size`` bytes a row, may be broadcast."""
    return (table.agg(F.sum(size)).first()[0] or 0) <= limit


def _scan(
    scratch: Scratch,
    docs: DataFrame,
    benchmark: DataFrame,
    n: int,
    broadcast_bytes: int,
    keep_row: bool,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Staged documents, their hits ``row, start, size, window``, and the windows' items."""
    if not 1 <= n <= MOST_WORDS:
        raise ValueError(f"a window has 1 to {MOST_WORDS} words")
    windows, places = dictionary(scratch, benchmark, n)
    run = F.lit(f"(?:{LETTER}++{GAP}*+){{1,{PIECE_WORDS}}}+")
    text = lower_ascii(plain_text())
    rows = scratch.stage(
        docs.select(
            F.monotonically_increasing_id().alias("row"),
            F.col("doc_id").cast("long").alias("doc_id"),
            F.size(words_of(text)).cast("long").alias("n_words"),
            F.when(F.length(text) <= PIECE_CHARS, F.array(text))
            .otherwise(F.regexp_extract_all(text, run, F.lit(0))).alias("pieces"),
            *([F.struct("*").alias("own")] if keep_row else []),
        ),
        "rows",
    )
    # A piece with the first words of the next one, which has enough of them unless it is the last.
    head = f"^(?:{LETTER}++{GAP}*+){{1,{max(1, n - 1)}}}+"
    with_next = bound(
        F.col("pieces"),
        lambda all_pieces: F.transform(
            all_pieces,
            lambda piece, at: F.struct(
                piece.alias("piece"),
                F.regexp_extract(F.coalesce(F.get(all_pieces, at + 1), F.lit("")), head, 0).alias("next"),
            ),
        ),
    )
    pieces = rows.select("row", F.posexplode(with_next).alias("piece_no", "piece"))
    own = words_of(F.col("piece.piece"))
    pieces = pieces.select(
        "row", (F.col("piece_no").cast("long") * PIECE_WORDS).alias("first"),
        F.size(own).alias("own"),
        F.concat(own, words_of(F.col("piece.next"))).alias("words"),
    )
    # A row for every place of a piece and every window size in use, of which there are at most n.
    sizes = sorted(r[0] for r in windows.select("size").distinct().collect())
    hashed = pieces.select("row", "first", "own", "words", word_hashes(F.col("words")).alias("hashes"))
    probes = (
        hashed.select("*", F.explode(F.array(*map(F.lit, sizes or [n]))).alias("size"))
        .select("*", F.posexplode("hashes").alias("at", "_"))
        .where((F.col("at") < F.col("own")) & (F.col("at") + F.col("size") <= F.size("hashes")))
    )
    hashed_place = window_hash(F.col("hashes"), F.col("at"), F.col("size"), max(sizes or [n]))
    probes = probes.select("row", "first", "words", "size", "at", hashed_place.alias("hash"))
    gram = F.slice("words", F.col("at") + 1, F.col("size"))
    start = (F.col("first") + F.col("at")).alias("start")
    known = windows.select("window", "hash", F.col("gram").alias("item_gram"))
    if small_enough(windows, F.octet_length(F.concat_ws("  ", "gram")) + ROW_BYTES, broadcast_bytes):
        hits = probes.join(F.broadcast(known), "hash").where(gram == F.col("item_gram"))
    else:
        # Beyond the bound windows are shuffled by hash, each with its own words and not its piece's.
        alone = probes.select("row", start, "size", "hash", gram.alias("gram"))
        return rows, scratch.stage(
            alone.join(known, "hash").where("gram = item_gram").select("row", "start", "size", "window"), "hits"
        ), places
    return rows, scratch.stage(hits.select("row", start, "size", "window"), "hits"), places


def _masks(hits: DataFrame) -> DataFrame:
    """``row, block, mask``: the hit words as bits of blocks of 64 words."""
    spans = hits.groupBy("row", "start").agg(F.max("size").alias("size"))
    last = F.col("start") + F.col("size") - 1
    blocks = spans.select(
        "row", "start", (last + 1).alias("stop"),
        F.explode(F.sequence(F.shiftright("start", 6), F.shiftright(last, 6))).alias("block"),
    )
    low = F.greatest(F.col("start") - F.col("block") * 64, F.lit(0)).cast("int")
    high = F.least(F.col("stop") - F.col("block") * 64, F.lit(64)).cast("int")
    mask = F.call_function(
        "shiftleft", F.call_function("shiftrightunsigned", F.lit(-1).cast("long"), 64 - (high - low)), low
    )
    return blocks.groupBy("row", "block").agg(F.bit_or(mask).alias("mask"))


def contamination(
    docs: DataFrame, benchmark: DataFrame, n: int = WINDOW, broadcast_bytes: int = BROADCAST_BYTES
) -> DataFrame:
    """``doc_id, n_words, n_hit, n_items, items_sha256, contaminated`` of every document.

    A word is hit inside any occurrence of a window.  Null and empty texts have no words and are
    clean; null and empty items have no windows.  Rows of one ``item_id`` are one item, as are rows
    without one, whose name is empty.  Repeated documents are rows of their own.  An empty benchmark leaves
    every document clean; no documents give no rows.  Other columns are not read.
    """
    scratch = Scratch(docs.sparkSession, "decontamination")
    rows, hits, places = _scan(scratch, docs, benchmark, n, broadcast_bytes, keep_row=False)
    hit = _masks(hits).groupBy("row").agg(F.sum(F.bit_count("mask")).alias("n_hit"))
    # No side is forced: adaptive execution sees the bytes of the windows' items.
    met = hits.select("row", "window").distinct().join(places, "window").select("row", "item").distinct()
    items = met.groupBy("row").agg(
        F.count(F.lit(1)).alias("n_items"), F.sort_array(F.collect_list("item")).alias("items")
    )
    zero = F.lit(0).cast("long")
    return (
        rows.select("row", "doc_id", "n_words")
        .join(hit.join(items, "row"), "row", "left")
        .select(
            "doc_id", "n_words",
            F.coalesce("n_hit", zero).alias("n_hit"),
            F.coalesce("n_items", zero).alias("n_items"),
            F.sha2(F.coalesce(F.array_join("items", ","), F.lit("")), 256).alias("items_sha256"),
            (F.coalesce("n_hit", zero) > 0).alias("contaminated"),
        )
    )


def decontaminate(
    docs: DataFrame,
    benchmark: DataFrame,
    n: int = WINDOW,
    remove: str = "spans",
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """The documents without their hit words, or without the documents that have any.

    ``remove`` is ``"spans"`` (hit words go, each with what stands between it and the word before)
    or ``"documents"``.  All columns stay as they are, but for the text of rows with hits.
    """
    if remove not in ("spans", "documents"):
        raise ValueError("remove must be 'spans' or 'documents'")
    scratch = Scratch(docs.sparkSession, "decontamination")
    rows, hits, _ = _scan(scratch, docs, benchmark, n, broadcast_bytes, keep_row=True)
    rows = rows.select("row", "own")
    hit_rows = hits.select("row").distinct()
    if remove == "documents":
        return rows.join(hit_rows, "row", "left_anti").select("own.*")
    unit = F.lit(f"{RAW_GAP}*+{RAW_LETTER}++|{RAW_GAP}++")
    units = rows.join(hit_rows, "row", "left_semi").select(
        "row", F.posexplode(F.regexp_extract_all("own.text", unit, F.lit(0))).alias("at", "unit")
    )
    bits = F.sequence(F.lit(0), F.lit(63))
    covered = _masks(hits).select(
        "row",
        F.explode(
            bound(
                F.struct("block", "mask"),
                lambda s: F.transform(
                    F.filter(bits, lambda b: F.call_function("getbit", s["mask"], b) == 1),
                    lambda b: (s["block"] * 64 + b).cast("int"),
                ),
            )
        ).alias("at"),
    )
    left = units.join(covered, ["row", "at"], "left_anti")
    # One document's units at a time.
    texts = left.groupBy("row").agg(F.sort_array(F.collect_list(F.struct("at", "unit"))).alias("units"))
    texts = texts.select("row", F.array_join(F.col("units.unit"), "").alias("rest"))
    cut = rows.join(hit_rows.withColumn("hit", F.lit(True)), "row", "left").join(texts, "row", "left")
    text = F.when(F.col("hit"), F.coalesce("rest", F.lit(""))).otherwise(F.col("own.text"))
    return cut.select(F.col("own").withField("text", text).alias("own")).select("own.*")


ORACLE = rf"""
WITH words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{UPPER.lower()}'), '{LETTER}+') AS w
  FROM documents),
items AS (
  SELECT CAST(item_id AS VARCHAR) AS item,
         regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{UPPER.lower()}'), '{LETTER}+') AS w
  FROM benchmark),
grams AS (
  SELECT DISTINCT item, least(len(w), {WINDOW}) AS size, w[i : i + least(len(w), {WINDOW}) - 1] AS gram
  FROM (SELECT item, w, unnest(range(1, len(w) - least(len(w), {WINDOW}) + 2)) AS i FROM items WHERE len(w) > 0)),
places AS (
  SELECT doc_id, size, i, w[i : i + size - 1] AS gram
  FROM (SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS i
        FROM words, (SELECT DISTINCT size FROM grams))),
hits AS (SELECT doc_id, i, size, item FROM places JOIN grams USING (size, gram)),
covered AS (
  SELECT doc_id, count(DISTINCT word_no) AS n_hit
  FROM (SELECT doc_id, unnest(range(i, i + size)) AS word_no FROM hits) GROUP BY doc_id),
named AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, item FROM hits) GROUP BY doc_id)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM words LEFT JOIN covered USING (doc_id) LEFT JOIN named USING (doc_id)
"""

ship(__name__)
