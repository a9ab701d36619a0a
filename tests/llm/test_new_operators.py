"""Tokenizer alignment, vector codes and decontamination against plain Python, and edge cases."""

import hashlib
import itertools
import random
import re
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidemark.llm import alignment, decontamination, vector_codes
from tidemark.llm.queries import QUERIES

SMALL = "/root/testdata/sf0.001"
PATHS = (
    public_tokenizers.path("byte_bpe_50k.tiktoken"),
    public_tokenizers.PATTERN,
    public_tokenizers.path("piece_bpe_32k.model"),
)
NAMES = ["row", "part", "block", "pair", "n", "size", "_key", "a.b", "window", "own", "label_error"]
RNG = random.Random(3)


def clash():
    """Columns with names that the operators use inside."""
    return {name: F.lit(1) for name in NAMES}


# -- tokenizer alignment ------------------------------------------------------------------------

BYTE_OF = {}


def byte_level():
    """Characters that stand for bytes in the byte-level vocabulary."""
    if not BYTE_OF:
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        others = [b for b in range(256) if b not in shown]
        BYTE_OF.update({chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(others)})
    return BYTE_OF


def plain_alignment(texts):
    a_side = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a_side.encode_special_tokens = True
    b_side = sentencepiece.SentencePieceProcessor(model_file=PATHS[2])
    found, counts = [], Counter()
    for text in texts:
        tokens = []
        if text:
            a = a_side.encode(" " + text, add_special_tokens=False)
            a_bytes = [bytes(byte_level()[c] for c in t) for t in a.tokens]
            b = b_side.encode(text)
            pieces = [b_side.id_to_piece(i) for i in b]
            b_bytes = [
                bytes([int(p[3:5], 16)]) if b_side.is_byte(i) else p.replace("▁", " ").encode()
                for i, p in zip(b, pieces)
            ]
            if b"".join(a_bytes) == b"".join(b_bytes) == (" " + text).encode():
                tokens = [
                    [(i, e - len(t), e) for i, t, e in zip(ids, parts, itertools.accumulate(map(len, parts)))]
                    for ids, parts in ((a.ids, a_bytes), (b, b_bytes))
                ]
        if not tokens:
            found.append(None)
            continue
        links, start = [], 0
        for a_id, low, high in tokens[0]:
            while tokens[1][start][2] <= low:
                start += 1
            at = start
            while at < len(tokens[1]) and tokens[1][at][1] < high:
                links.append((a_id, tokens[1][at][0]))
                at += 1
        cuts = sorted({t[2] for t in tokens[0]} & {t[2] for t in tokens[1]})
        groups, before = [], 0
        sides = [iter(t) for t in tokens]
        for cut in cuts:
            group = []
            for side in sides:
                ids = []
                for i, _, end in side:
                    ids.append(str(i))
                    if end == cut:
                        break
                group.append(",".join(ids))
            groups.append("|".join(group))
        found.append((len(tokens[0]), len(tokens[1]), len(cuts), links, ";".join(groups)))
        counts.update(links)
    best = {}
    for (_, b), n in counts.items():
        best[b] = max(n, best.get(b, 0))
    rows = []
    for one in found:
        if one is None:
            rows.append((0, 0, 0, 0, 0, 0, ""))
            continue
        n_a, n_b, n_groups, links, text = one
        rows.append((
            n_a, n_b, n_groups, len(links), sum(counts[p] == best[p[1]] for p in links),
            sum(counts[p] for p in links), hashlib.sha256(text.encode()).hexdigest(),
        ))
    return rows


COLUMNS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
WORDS = ["the", "unter", "ß", "naïve", "中文字", "👩‍👩‍👧", "a1b2", "...", "\n", "\n\n  x", "\t", "  ", "    ", "don't", "'ll", " ", "é", "https://x.y/z", "<s>", "<|endoftext|>", "<0x0A>", "\x00", " ", "12345"]


def odd_texts():
    texts = [None, "", " ", "  ", "a", "\n", " a b ", "x▁y", "�", "ﬁ ½ ①", "a" * 3000, "ab " * 2000]
    texts += ["".join(RNG.choice(WORDS) + RNG.choice(["", " ", " ", "  "]) for _ in range(RNG.randrange(60))) for _ in range(60)]
    texts += [texts[20], texts[20], " ".join(RNG.choice(WORDS[:9]) for _ in range(4000))]
    return texts


@pytest.mark.parametrize("sizes", [(1 << 20, 1 << 16, 1 << 21), (64, 7, 50)])
def test_alignment_equals_plain(spark, sizes):
    texts = odd_texts()
    rows = [(i if i % 9 else None, t) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns(clash()).repartition(3)
    got = alignment.alignment(docs, *PATHS, *sizes).collect()
    want = Counter(zip([r[0] for r in rows], plain_alignment(texts)))
    assert Counter((r.doc_id, tuple(r[c] for c in COLUMNS)) for r in got) == want
    parts = alignment.groups(docs, *PATHS, *sizes[:2]).orderBy("row", "part").collect()
    whole = Counter()
    for _, own in itertools.groupby(parts, key=lambda r: r.row):
        text = ";".join(r.groups for r in own)
        whole[hashlib.sha256(text.encode()).hexdigest() if text else ""] += 1
    assert whole == Counter(r.groups_sha256 for r in got)


def test_alignment_of_tables_and_empty(spark):
    texts = [r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").orderBy("doc_id").collect()]
    got = QUERIES["op11_tokenizer_alignment"](spark, SMALL).orderBy("doc_id").collect()
    assert [tuple(r[c] for c in COLUMNS) for r in got] == plain_alignment(texts)
    none = spark.createDataFrame([], "doc_id long, text string")
    assert alignment.alignment(none, *PATHS).count() == 0
    bad = spark.sql("SELECT 1L AS doc_id, CAST(X'61FF62' AS STRING) AS text")
    assert alignment.alignment(bad, *PATHS).first().n_a == 0
    nulls = spark.createDataFrame([(1, None), (2, "")], "doc_id long, text string")
    assert {r.n_links for r in alignment.alignment(nulls, *PATHS).collect()} == {0}


def test_both_forms_of_the_byte_vocabulary_agree():
    pair = alignment.Pair(*PATHS)
    json = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    json.encode_special_tokens = True
    points = [c for c in range(0x3000 + 0x600) if not 0xD800 <= c < 0xE000] + list(range(0x1F300, 0x1F700))
    for at in range(0, len(points), 500):
        text = " " + " ".join(f"a{chr(c)}b {chr(c)}{chr(c)}  {chr(c)}1" for c in points[at : at + 500])
        assert pair.a.encode_ordinary(text) == json.encode(text, add_special_tokens=False).ids


@settings(deadline=None, max_examples=60)
@given(st.lists(st.integers(1, 4), min_size=1, max_size=60), st.randoms(), st.integers(1, 9))
def test_pieces_of_the_merge_are_equal_and_complete(sizes, rng, steps):
    a = np.cumsum(sizes)
    b = np.array(sorted({*rng.sample(range(1, int(a[-1]) + 1), rng.randrange(int(a[-1]))), int(a[-1])}))
    i, j = alignment.merge_path(a, b, steps)
    work = np.diff(i) + np.diff(j)
    assert (work[:-1] == steps).all() and work.sum() == len(a) + len(b)
    found = alignment.align_ends(a, b, steps)
    ends = sorted({*a.tolist(), *b.tolist()})
    want = sorted((int(np.searchsorted(a, e)), int(np.searchsorted(b, e))) for e in ends)
    assert sorted(zip(found.links_a.tolist(), found.links_b.tolist())) == want
    common = sorted(set(a.tolist()) & set(b.tolist()))
    assert found.group_a.tolist() == [sum(c < e for c in common) for e in a.tolist()]
    assert found.group_b.tolist() == [sum(c < e for c in common) for e in b.tolist()]


def test_segments_are_where_both_start_afresh():
    pair = alignment.Pair(*PATHS)
    for text in odd_texts():
        if not text:
            continue
        text = " " + text
        whole, parts = pair.encode(text), [pair.encode(s) for s in pair.segments(text, 16)]
        assert "".join(pair.segments(text, 16)) == text
        if whole is not None:
            for side in (0, 1):
                assert np.concatenate([p[side] for p in parts]).tolist() == whole[side].tolist()


# -- vector codes -------------------------------------------------------------------------------


def plain_codes(rows, parts=4, entries=256, rounds=4, scale=1024):
    """(vec_id, code, error) of rows (vec_id, vector) and the codebooks, in Python's integers."""
    kept = [(i, [int(np.floor(float(x) * scale)) for x in v]) for i, v in rows]
    width = len(kept[0][1]) // parts
    cut = lambda v, p: v[p * width : (p + 1) * width]
    first = sorted(kept)[:entries]
    books = [[cut(v, p) for _, v in first] for p in range(parts)]

    def near(v, p):
        return min((sum((x - y) ** 2 for x, y in zip(cut(v, p), e)), n) for n, e in enumerate(books[p]))

    for _ in range(rounds):
        met = [[[] for _ in first] for _ in range(parts)]
        for _, v in kept:
            for p in range(parts):
                met[p][near(v, p)[1]].append(cut(v, p))
        books = [
            [[sum(c) // len(own) for c in zip(*own)] if own else old for own, old in zip(met[p], books[p])]
            for p in range(parts)
        ]
    out = []
    for i, v in kept:
        best = [near(v, p) for p in range(parts)]
        out.append((i, "".join(f"{n:02x}" for _, n in best), sum(d for d, _ in best)))
    return out, books


def test_codes_equal_plain(spark):
    rows = [(i, [round(RNG.uniform(-1, 1), 2) for _ in range(12)]) for i in range(90)]
    rows += [(100 + i, rows[i][1]) for i in range(20)]
    rows += [(200, [0.0] * 12), (201, [-0.0] * 12), (202, [60.0, -60.0] * 6)]
    labels = [None if i % 5 == 0 else i % 3 for i in range(len(rows))]
    bad = [(300, None, 1), (301, [None] * 12, 1), (302, [float("nan")] * 12, 1), (303, [float("inf")] * 12, None)]
    odd = [(400, [1.0] * 5, 2), (401, [1e9] * 12, 2), (402, [1e308] * 12, 2)]
    frame = spark.createDataFrame(
        [(i, v, n) for (i, v), n in zip(rows, labels)] + bad + odd, "vec_id long, embedding array<double>, label int"
    )
    coded, books = vector_codes.encode(frame.withColumns(clash()).repartition(3), entries=30)
    want, plain_books = plain_codes(rows, entries=30)
    got = {r.vec_id: r for r in vector_codes.with_label_errors(coded).collect()}
    assert {i: (r.code, r.error) for i, r in got.items() if i < 300} == {i: (c, e) for i, c, e in want}
    assert books.tolist() == plain_books
    assert set(got) & {300, 301, 302, 303} == set()
    assert all(got[i].code is None and got[i].error is None for i in (400, 401, 402))
    sums = Counter()
    for (_, _, error), label in zip(want, labels):
        sums[label] += error
    assert all(got[i].label_error == sums[label] for (i, _), label in zip(rows, labels))
    text = ",".join(str(x) for part in plain_books for entry in part for x in entry)
    assert vector_codes.books_sha256(books) == hashlib.sha256(text.encode()).hexdigest()


def test_codes_without_usable_rows(spark):
    schema = "vec_id long, embedding array<float>, label int"
    assert vector_codes.encode(spark.createDataFrame([], schema))[0].count() == 0
    none = spark.createDataFrame([(1, None, 1), (2, [], 1), (3, [None], 1)], schema)
    assert vector_codes.with_label_errors(vector_codes.encode(none)[0]).count() == 0
    one = vector_codes.encode(spark.createDataFrame([(None, [1.0] * 8, None), (5, [1.0] * 8, None)], schema))[0]
    assert sorted((r.code, r.error) for r in one.collect()) == [("00000000", 0)] * 2
    repeated = spark.createDataFrame([(1, [2.0] * 4, 1), (1, [1.0] * 4, 1)], schema)
    assert vector_codes.encode(repeated)[1][0, :, 0].tolist() == [1024, 2048]


@settings(deadline=None, max_examples=40)
@given(st.integers(1, 40), st.integers(1, 40), st.integers(1, 20), st.randoms())
def test_elimination_finds_the_nearest(m, k, width, rng):
    most = vector_codes.limit(width)
    span = rng.choice([1, 3, 100, most])
    draw = lambda n: np.array([[rng.randint(-span, span) for _ in range(width)] for _ in range(n)], "i8")
    parts, entries = draw(m), draw(k)
    found, distance = vector_codes.nearest(parts, entries)
    exact = [[sum((int(x) - int(y)) ** 2 for x, y in zip(p, e)) for e in entries] for p in parts]
    assert distance.tolist() == [min(d) for d in exact]
    assert found.tolist() == [d.index(min(d)) for d in exact]


@pytest.mark.parametrize("size", [1, 2, 4, 8, 16, 32])
def test_transform_is_orthogonal_and_by_sequency(size):
    matrix = vector_codes.walsh(np.eye(size, dtype="i8")).T
    assert (matrix @ matrix.T == size * np.eye(size)).all()
    assert [(np.diff(np.sign(r)) != 0).sum() for r in matrix] == list(range(size))


# -- decontamination ----------------------------------------------------------------------------


def words(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", lowered)


def plain_hits(docs, items, n):
    windows = {}
    for item, text in items:
        own = words(text)
        size = min(n, len(own))
        for i in range(len(own) - size + 1 if own else 0):
            windows.setdefault(tuple(own[i : i + size]), set()).add("" if item is None else str(item))
    sizes = {len(w) for w in windows}
    rows = []
    for doc_id, text in docs:
        own, hit, met = words(text), set(), set()
        for size in sizes:
            for i in range(len(own) - size + 1):
                found = windows.get(tuple(own[i : i + size]))
                if found:
                    hit.update(range(i, i + size))
                    met |= found
        digest = hashlib.sha256(",".join(sorted(met)).encode()).hexdigest()
        rows.append((doc_id, len(own), len(hit), len(met), digest, bool(hit)))
    return rows


def contaminated_case():
    vocabulary = ["ab", "AB", "c", "É", "é", "x1", "zz", "中", "İ", "Kelvin", "K"]
    items = [(i, " ".join(RNG.choice(vocabulary) for _ in range(RNG.choice([1, 2, 4, 5, 9, 30])))) for i in range(25)]
    items += [(3, "one two three four five six"), (None, "seven eight nine ten eleven"), (40, None), (41, " .,"), (42, "ab ab ab ab ab ab ab ab")]
    rare = [f"w{i}" for i in range(400)]
    docs = [(0, None), (1, ""), (2, " -- "), (3, "ab"), (3, "ab"), (None, "AB ab"), (5, "Seven, EIGHT; nine-ten (eleven)!")]
    for i in range(6, 60):
        own = [RNG.choice(rare) for _ in range(RNG.randrange(120))]
        for _ in range(RNG.randrange(3)):
            at = RNG.randrange(len(own) + 1)
            own[at:at] = (RNG.choice(items)[1] or "").upper().replace("É", "é").split()
        docs.append((i, "".join(w + RNG.choice([" ", ", ", "\n", "--"]) for w in own)))
    docs += [(100, "ab " * 3000), (101, "".join(f"q{i} " for i in range(9000)) + "one two three four five six")]
    return docs, items


@pytest.mark.parametrize("limit", [decontamination.BROADCAST_BYTES, 0])
def test_contamination_equals_plain(spark, monkeypatch, limit):
    monkeypatch.setattr(decontamination, "PIECE_WORDS", 63)
    monkeypatch.setattr(decontamination, "PIECE_CHARS", 500)
    docs, items = contaminated_case()
    frame = spark.createDataFrame(docs, "doc_id long, text string").withColumns(clash())
    tests = spark.createDataFrame(items, "item_id long, text string").withColumns(clash())
    for n in (1, 5, 64):
        got = decontamination.contamination(frame, tests, n, broadcast_bytes=limit).collect()
        assert Counter(map(tuple, got)) == Counter(plain_hits(docs, items, n))


def test_contamination_beyond_broadcast_is_joined_by_hash(spark, plan_of):
    docs, items = contaminated_case()
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    tests = spark.createDataFrame(items, "item_id long, text string")
    assert not decontamination.small_enough(tests, F.lit(100), 1000)
    got = decontamination.contamination(frame, tests)
    assert "Python" not in plan_of(got) and "Arrow" not in plan_of(got)


def test_decontaminate_removes_spans_or_documents(spark):
    docs, items = contaminated_case()
    items = [i for i in items if len(words(i[1])) >= 4]
    frame = spark.createDataFrame(docs, "doc_id long, text string").withColumns(clash())
    tests = spark.createDataFrame(items, "item_id long, text string")
    plain = plain_hits(docs, items, 5)
    whole = decontamination.decontaminate(frame, tests, 5, remove="documents")
    assert whole.columns == frame.columns
    kept = Counter((d, t) for (d, t), r in zip(docs, plain) if not r[5])
    assert Counter((r.doc_id, r.text) for r in whole.collect()) == kept and any(r[5] for r in plain)
    cut = decontamination.decontaminate(frame, tests, 5)
    assert cut.columns == frame.columns
    got = Counter((r.doc_id, len(words(r.text))) for r in cut.collect())
    assert got == Counter((r[0], r[1] - r[2]) for r in plain)
    texts = {r.doc_id: r.text for r in cut.collect()}
    assert texts[5] == ")!" and texts[0] is None and texts[101].split() == [f"q{i}" for i in range(9000)]
    for (d, t), r in zip(docs, plain):
        if not r[5] and d not in (3, None):
            assert texts[d] == t


def test_contamination_of_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b c")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "a b c")], "item_id long, text string")
    row = decontamination.contamination(docs, items.where("false")).first()
    assert (row.n_words, row.n_hit, row.n_items, row.contaminated) == (3, 0, 0, False)
    assert row.items_sha256 == hashlib.sha256(b"").hexdigest()
    assert decontamination.contamination(docs.where("false"), items).count() == 0
    assert decontamination.decontaminate(docs, items.where("false")).first().text == "a b c"
    assert decontamination.decontaminate(docs, items).first().text == ""
