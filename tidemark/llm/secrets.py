"""Secret scans in native column expressions: fixed patterns, and entropy of sliding windows.

Everything is one projection over the text, without a shuffle.  Matches and the gaps between them
(``regexp_extract_all`` and ``split`` by the same pattern) give positions as running sums of
lengths, in code points.  Entropy is followed along a candidate string by the counts of its
characters: moving the window by one takes one character out of the counts and one in.

Time grows with the length of a text and not with its square: what a lambda uses again and again is
bound first (``_bind``), and lists grow within pieces of bounded size only.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import plain_text

# The patterns of the scan, and how long a match must be.
ASSIGN = (
    r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
ASSIGN_VALUE_CHARS = 6
ACCESS = "AKIA[A-Z0-9]+"
ACCESS_CHARS = 20
HEX = "[0-9a-f]+"
HEX_CHARS = 24

SPANS = "array<struct<start:bigint,kind_no:int,kind:string,stop:bigint>>"

# Lists grow by copying, so they grow in pieces: of so many lengths, and of so many windows.
SUM_PIECE, WINDOW_PIECE = 256, 512
# Counts of one window, a bit field for each character of the alphabet, so many in a long.
COUNT_BITS, COUNTS_IN_LONG = 6, 10


@dataclass(frozen=True)
class CharClass:
    """Strings over one alphabet, which must hold every kind of character in ``needs``.

    A window of ``window`` (at most 63) ASCII letters, digits or ``+/_=-`` is suspicious from ``bits`` of Shannon entropy per character.
    A string ends where the next character is none of ``inside``.  If the alphabet holds ``=``,
    this stands only at the end, as padding.
    """

    name: str
    alphabet: str
    needs: tuple[str, ...]
    window: int
    bits: float
    inside: str = "A-Za-z0-9"


DIGITS, LOWER, UPPER = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
CLASSES = (
    CharClass("entropy_hex", DIGITS + "abcdef", ("[0-9]", "[a-f]"), 20, 3.0),
    CharClass("entropy_key", DIGITS + UPPER, ("[0-9]", "[A-Z]"), 20, 3.4),
    CharClass("entropy_text", DIGITS + LOWER + UPPER + "+/_=-", ("[0-9]", "[a-z]", "[A-Z]"), 20, 3.7, r"A-Za-z0-9+/_\-"),
    CharClass("entropy_lower", DIGITS + LOWER, ("[0-9]", "[g-z]"), 20, 3.5),
    # Three changes from lower to upper case tell keys from most names.
    CharClass("entropy_letters", LOWER + UPPER, ("[a-z][A-Z]+[a-z]+[A-Z]+[a-z]+[A-Z]",), 20, 3.7, "A-Za-z0-9+/"),
)
# What is no secret: suspicious parts with a placeholder of documentation, and whole candidates
# that are subresource digests or one character.
ALLOWED = ("(?i)example", "(?i)placeholder")
ALLOWED_WHOLE = ("(?i)^sha(256|384|512)-", r"^(.)\1*$")


def _bind(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value worked out once, however often lambdas in ``use`` name it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _pieces(length: Column, size: int) -> Column:
    """Numbers of the pieces of ``size`` elements; the piece 0 of an empty list is empty."""
    last = F.floor((F.greatest(length, F.lit(1)) - 1) / size).cast("int")
    return F.sequence(F.lit(0), last)


def _sums(lengths: Column) -> Column:
    """Sum of the elements up to and with each one."""

    def follow(piece: Column, start: Column) -> Column:
        def step(state: Column, length: Column) -> Column:
            at = state["at"] + length
            return F.struct(at.alias("at"), F.concat(state["sums"], F.array(at)).alias("sums"))

        none = F.array().cast("array<bigint>")
        return F.aggregate(
            piece, F.struct(start.alias("at"), none.alias("sums")), step, lambda state: state["sums"]
        )

    def joined(pieces: Column) -> Column:
        totals = F.transform(pieces, lambda p: F.aggregate(p, F.lit(0).cast("bigint"), lambda s, n: s + n))
        none = F.array(F.lit(0).cast("bigint"))
        starts = F.aggregate(totals, none, lambda s, n: F.concat(s, F.array(F.element_at(s, -1) + n)))
        return _bind(starts, lambda starts: F.flatten(F.transform(pieces, lambda p, k: follow(p, F.get(starts, k)))))

    def cut(lengths: Column) -> Column:
        return F.transform(
            _pieces(F.size(lengths), SUM_PIECE),
            lambda k: F.slice(lengths, k * SUM_PIECE + 1, SUM_PIECE),
        )

    return _bind(lengths, lambda lengths: _bind(cut(lengths), joined))


def _matches(text: Column, pattern: str, group: int = 0) -> Column:
    """All matches: ``start``, ``stop`` and ``own``, the text of the group."""

    def placed(found: Column, gaps: Column, own: Column) -> Column:
        lengths = F.transform(
            found, lambda m, i: (F.length(m) + F.length(F.get(gaps, i))).cast("bigint")
        )
        return _bind(
            _sums(lengths),
            lambda stops: F.transform(
                found,
                lambda m, i: F.struct(
                    (F.get(stops, i) - F.length(m)).alias("start"), F.get(stops, i).alias("stop"),
                    F.get(own, i).alias("own"),
                ),
            ),
        )

    def with_group(found: Column, gaps: Column) -> Column:
        if not group:
            return placed(found, gaps, found)
        groups = F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
        return _bind(groups, lambda own: placed(found, gaps, own))

    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.split(text, pattern, -1)
    return _bind(found, lambda found: _bind(gaps, lambda gaps: with_group(found, gaps)))


def _span(start: Column, stop: Column, kind_no: int, kind: str) -> Column:
    return F.struct(
        start.alias("start"), F.lit(kind_no).alias("kind_no"), F.lit(kind).alias("kind"),
        stop.alias("stop"),
    )


def _base(text: Column, pattern: str, kind_no: int, kind: str, chars: int, group: int = 0) -> Column:
    """Spans of the matches whose group has at least so many characters."""
    found = F.filter(_matches(text, pattern, group), lambda m: F.length(m["own"]) >= chars)
    return F.transform(found, lambda m: _span(m["start"], m["stop"], kind_no, kind))


def _if_found(text: Column, test: str, spans: Column) -> Column:
    return F.when(text.rlike(test), spans).otherwise(F.array().cast(SPANS))


def _scan(at: Column, of: CharClass, first_window: Column) -> Column:
    """Suspicious parts of one piece, given as numbers of characters; places count from the string."""
    size, letters = of.window, range(len(of.alphabet))
    word = F.array(*[F.lit(a // COUNTS_IN_LONG) for a in letters])
    shift = F.array(*[F.lit(a % COUNTS_IN_LONG * COUNT_BITS) for a in letters])
    unit = F.array(*[F.lit(1 << a % COUNTS_IN_LONG * COUNT_BITS).cast("bigint") for a in letters])
    bits = F.array(*[F.lit(math.log2(c) if c else 0.0) for c in range(size + 1)])
    weight = F.array(*[F.lit(c * math.log2(c) if c else 0.0) for c in range(size + 1)])
    zero = F.lit(0).cast("bigint")
    # Entropy is log2(size) - total / size.
    most = (math.log2(size) - of.bits) * size + 1e-9

    def count(counts: Column, a: Column) -> Column:
        held = F.call_function("shiftright", F.get(counts, F.get(word, a)), F.get(shift, a))
        return held.bitwiseAND(F.lit((1 << COUNT_BITS) - 1).cast("bigint")).cast("int")

    def in_word(w: Column, a: Column) -> Column:
        return F.when(F.get(word, a) == w, F.get(unit, a)).otherwise(zero)

    def noted(state: Column, counts: Column, total: Column, begin: Column) -> Column:
        """The state after a window: the part at its end, if any, is from ``start`` to ``stop``."""
        end = begin + size
        bad, apart = total <= most, begin > state["stop"]
        closed = F.concat(
            state["parts"], F.array(F.struct(state["start"].alias("start"), state["stop"].alias("stop")))
        )
        return F.struct(
            counts.alias("counts"), total.alias("total"),
            F.when(bad & apart, begin).otherwise(state["start"]).alias("start"),
            F.when(bad, end).otherwise(state["stop"]).alias("stop"),
            F.when(bad & apart & (state["stop"] >= 0), closed).otherwise(state["parts"]).alias("parts"),
        )

    def step(state: Column, k: Column) -> Column:
        gone, come = F.get(at, k - 1), F.get(at, k + size - 1)
        less, more = count(state["counts"], gone), count(state["counts"], come)
        moved = (
            state["total"] - F.get(weight, less) + F.get(weight, less - 1)
            - F.get(weight, more) + F.get(weight, more + 1)
        )
        total = F.when(gone == come, state["total"]).otherwise(moved)
        counts = F.when(gone == come, state["counts"]).otherwise(
            F.transform(state["counts"], lambda c, w: c - in_word(w, gone) + in_word(w, come))
        )
        # The state is bound, as its fields are used more than once.
        return _bind(
            F.struct(counts.alias("counts"), total.alias("total")),
            lambda new: noted(state, new["counts"], new["total"], first_window + k),
        )

    def ended(state: Column) -> Column:
        last = F.struct(state["start"].alias("start"), state["stop"].alias("stop"))
        return F.when(state["stop"] >= 0, F.concat(state["parts"], F.array(last))).otherwise(state["parts"])

    def begun(counts: Column, first: Column) -> Column:
        total = F.aggregate(first, F.lit(0.0), lambda s, a: s + F.get(bits, count(counts, a)))
        nothing = F.struct(
            F.lit(-1).alias("start"), F.lit(-1).alias("stop"),
            F.array().cast("array<struct<start:int,stop:int>>").alias("parts"),
        )
        return _bind(
            F.struct(total.alias("total"), nothing.alias("none")),
            lambda s: noted(s["none"], counts, s["total"], first_window),
        )

    words = F.sequence(F.lit(0), F.lit((len(of.alphabet) - 1) // COUNTS_IN_LONG))

    def whole(first: Column) -> Column:
        counts = F.transform(words, lambda w: F.aggregate(first, zero, lambda s, a: s + in_word(w, a)))
        return _bind(counts, lambda counts: begun(counts, first))

    later = F.when(F.size(at) > size, F.sequence(F.lit(1), F.size(at) - size)).otherwise(
        F.array().cast("array<int>")
    )
    return F.aggregate(later, _bind(F.slice(at, 1, size), whole), step, ended)


def _joined_parts(parts: Column) -> Column:
    """Parts of neighbouring pieces that touch made one."""

    def joined(parts: Column) -> Column:
        starts = F.filter(
            parts, lambda p, i: F.coalesce(p["start"] > F.get(parts, i - 1)["stop"], F.lit(True))
        )
        stops = F.filter(
            parts, lambda p, i: F.coalesce(F.get(parts, i + 1)["start"] > p["stop"], F.lit(True))
        )
        return F.zip_with(
            starts, stops, lambda a, b: F.struct(a["start"].alias("start"), b["stop"].alias("stop"))
        )

    return _bind(parts, joined)


def entropy_spans(string: Column, of: CharClass, allowed: tuple[str, ...] = ()) -> Column:
    """Parts of a string (``start`` and ``stop`` within it) covered by suspicious windows.

    The string is of the alphabet of the class.  Parts that match one of ``allowed`` are left out; a
    string shorter than a window has none.
    """
    if of.window >= 1 << COUNT_BITS:
        raise ValueError(f"{of.name}: windows of {of.window} characters do not fit into the counts")

    def pieces(at: Column) -> Column:
        def piece(k: Column) -> Column:
            own = F.slice(at, k * WINDOW_PIECE + 1, WINDOW_PIECE + of.window - 1)
            return _bind(own, lambda own: _scan(own, of, k * WINDOW_PIECE))

        parts = F.flatten(F.transform(_pieces(F.size(at) - of.window + 1, WINDOW_PIECE), piece))
        return F.when(F.size(at) >= of.window, _joined_parts(parts)).otherwise(
            F.array().cast("array<struct<start:int,stop:int>>")
        )

    def unknown(chars: Column, part: Column) -> Column:
        own = F.array_join(F.slice(chars, part["start"] + 1, part["stop"] - part["start"]), "")
        return _bind(own, lambda own: ~reduce(or_, [own.rlike(known) for known in allowed]))

    def found(chars: Column) -> Column:
        # split may leave an empty string at the end
        at = F.transform(F.filter(chars, lambda c: c != ""), lambda c: F.instr(F.lit(of.alphabet), c) - 1)
        parts = _bind(at, pieces)
        return F.filter(parts, lambda part: unknown(chars, part)) if allowed else parts

    return _bind(F.split(string, ""), found)


def _entropy(text: Column, of: CharClass, kind_no: int, allowed: tuple[str, ...]) -> Column:
    letters, size = of.alphabet.replace("-", r"\-").replace("=", ""), of.window
    string = f"[{letters}]{{{size},}}"
    if "=" in of.alphabet:
        string = f"(?:{string}={{0,2}}|[{letters}]{{{size - 1}}}={{1,2}}|[{letters}]{{{size - 2}}}==)"
    pattern = f"(?<![{of.inside}]){string}(?![{of.inside}])"

    def candidate(match: Column) -> Column:
        good = F.lit(True)
        for need in of.needs:
            good = good & match["own"].rlike(need)
        for known in ALLOWED_WHOLE:
            good = good & ~match["own"].rlike(known)
        return good

    def inner(match: Column) -> Column:
        return F.transform(
            entropy_spans(match["own"], of, allowed),
            lambda part: _span(match["start"] + part["start"], match["start"] + part["stop"], kind_no, of.name),
        )

    found = F.filter(_matches(text, pattern), candidate)
    return _if_found(text, pattern, F.flatten(F.transform(found, inner)))


def _joined(spans: Column) -> Column:
    texts = F.transform(
        F.array_sort(spans),
        lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["stop"].cast("string")),
    )
    return F.array_join(texts, ",")


def find_secrets(
    docs: DataFrame, classes: tuple[CharClass, ...] = CLASSES, allowed: tuple[str, ...] = ALLOWED
) -> DataFrame:
    """One row per document: ``doc_id, n_assign, n_access, n_hex, base_sha256, spans``.

    The three counted kinds are matches of fixed patterns, leftmost and without overlap within a
    kind.  ``spans`` holds these and the parts found by entropy, as ``kind:start:stop`` in code
    points with an exclusive end, by start, then kind; parts found by entropy may overlap the
    others.  Parts that hold a match of ``allowed`` give no span by entropy; base matches stay.  Null
    texts count as empty and give no span.  Repeated rows are scanned as often as they occur; an
    empty table gives no rows; other columns are not read.
    """
    text = F.col("_text")
    by_entropy = [_entropy(text, c, 4 + k, allowed) for k, c in enumerate(classes)]
    access, hexes = f"AKIA[A-Z0-9]{{{ACCESS_CHARS - 4},}}", f"[0-9a-f]{{{HEX_CHARS},}}"
    # Every candidate of any class is such a run: one cheap look instead of one for each class.
    some_run = f"[A-Za-z0-9+/_=\\-]{{{min((c.window for c in classes), default=1)}}}"
    rows = docs.select("doc_id", plain_text().alias("_text")).select(
        "doc_id",
        _if_found(
            text, ASSIGN, _base(text, ASSIGN, 1, "assign", ASSIGN_VALUE_CHARS, group=2)
        ).alias("_assign"),
        _if_found(text, access, _base(text, ACCESS, 2, "access", ACCESS_CHARS)).alias("_access"),
        # A run of at least so many characters is the same as a run that is long enough.
        _if_found(text, hexes, _base(text, hexes, 3, "hex", HEX_CHARS)).alias("_hex"),
        _if_found(text, some_run, F.concat(F.array().cast(SPANS), *by_entropy)).alias("_entropy"),
    )
    base = F.concat("_assign", "_access", "_hex")
    return rows.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        *[F.size(f"_{k}").cast("long").alias(f"n_{k}") for k in ("assign", "access", "hex")],
        F.sha2(_joined(base), 256).alias("base_sha256"),
        _joined(F.concat(base, "_entropy")).alias("spans"),
    )
