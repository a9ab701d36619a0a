"""Every stage of the corpus pipeline, and the whole, against plain Python."""

import hashlib
import math
import re
from collections import Counter

import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline
from tests.llm.brute import near_components

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def uniform(*parts):
    return (int(hashlib.md5("|".join(map(str, parts)).encode()).hexdigest()[:13], 16) + 0.5) * 2.0**-52


def times(mean, drawn):
    p = total = math.exp(-mean)
    k = 0
    while total <= drawn:
        k += 1
        p *= mean / k
        total += p
    return k


def test_stages_equal_plain_python(spark, tmp_path):
    texts = [" ".join(f"g{(i * 37 + j * j * (i % 7 + 1)) % 997}" for j in range(40)) for i in range(120)]
    bad = {i for i in range(120) if i % 3 == 0}
    texts = [t + " vile nasty vile" if i in bad else t for i, t in enumerate(texts)]
    texts += [texts[1], " " + texts[2].replace(" ", "  "), texts[4] + " more", None, ""]
    rows = [(i, t, "en", "a" if i % 4 else "b", len(t or "")) for i, t in enumerate(texts)]
    folder = f"file://{tmp_path}"
    spark.createDataFrame(rows, DOCS).write.parquet(f"{folder}/documents.parquet")
    labels = [(i, 1, int(i in bad)) for i in range(120)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)

    clean = stages["toxicity"](spark, docs, folder).checkpoint()
    assert {r.doc_id for r in clean.collect()} == {r[0] for r in rows} - bad and clean.columns == docs.columns

    once = stages["exact_dedup"](spark, clean, folder).checkpoint()
    plain = lambda t: re.sub("[\x20\x09-\x0d]", "", t or "")
    got = once.collect()
    assert once.columns == docs.columns
    assert Counter(plain(r.text) for r in got) == Counter({plain(r.text) for r in clean.collect()})

    apart = stages["jaccard_join"](spark, once, folder).checkpoint()
    parts = near_components([(r.doc_id, r.text) for r in got], 5, 80, 100)
    kept = apart.collect()
    assert Counter(parts[r.doc_id][1] for r in kept) == Counter({c for _, c in parts.values()})
    assert apart.columns == docs.columns and len(kept) < len(got)

    mixed = stages["mixing"](spark, apart, folder).checkpoint()
    sizes = Counter(r.source for r in kept)
    weights = {x: math.sqrt(n) for x, n in sizes.items()}
    mean = {x: weights[x] / sum(weights.values()) * len(kept) / n for x, n in sizes.items()}
    want = Counter({r.doc_id: times(mean[r.source], uniform("mix", r.doc_id)) for r in kept})
    assert Counter(r.doc_id for r in mixed.collect()) == +want and mixed.columns == docs.columns

    plain_ids = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    ids = {r.doc_id: (*plain_ids.encode(r.text or "", add_special_tokens=False).ids, 0) for r in kept}
    for packed in (stages["packing"](spark, mixed, folder), corpus_pipeline.run(spark, folder)):
        assert Counter((r.doc_id, tuple(r.ids)) for r in packed.collect()) == Counter({(d, ids[d]): n for d, n in want.items() if n})

    none = docs.where("false")
    for _, stage in corpus_pipeline.STAGES:
        none = stage(spark, none, folder)
        assert none.count() == 0
        none = none if set(docs.columns) <= set(none.columns) else docs.where("false")
