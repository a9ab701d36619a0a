"""The registered queries of this package, and their SQL where SQL can say the same."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from tidemark.llm import (
    alignment,
    chat,
    decontamination,
    embeddings,
    exact_dedup,
    html,
    jaccard,
    mixing,
    packing,
    secrets,
    token_counts,
    toxicity,
    vector_codes,
)
from tidemark.llm.common import Scratch, read_table
from tidemark.session import scratch_path

# Fixed value: the conversation that is formatted besides those of the table.
CONTROL_TEXT = "</s>[INST] ok [/INST]"


def op1_html_extraction(spark, sf_dir):
    return html.extract(read_table(spark, sf_dir, "pages"))


def op2_exact_dedup(spark, sf_dir):
    return exact_dedup.exact_duplicates(read_table(spark, sf_dir, "documents"))


def op3_secret_scans(spark, sf_dir):
    return secrets.find_secrets(read_table(spark, sf_dir, "documents"))


def op4_embedding_dedup(spark, sf_dir):
    return embeddings.near_vectors(read_table(spark, sf_dir, "embeddings"))


def op5_mixing(spark, sf_dir):
    mixed = mixing.mix(read_table(spark, sf_dir, "documents"))
    return mixed.withColumnsRenamed({"_copy": "copy", "_order": "order_key"})


def op6_chat_formatting(spark, sf_dir):
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    rows = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    one = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(CONTROL_TEXT).alias("text"),
    )
    return chat.read_back(chat.format_chats(rows.unionByName(one), *ranks), *ranks)


def op7_jaccard_join(spark, sf_dir):
    documents = read_table(spark, sf_dir, "documents")
    return jaccard.near_duplicates(documents, n=3, num=90, den=100).drop("kept")


def op8_packing(spark, sf_dir):
    vocabulary = public_tokenizers.path("word_bpe_49k.json")
    return packing.digests(packing.pack(read_table(spark, sf_dir, "documents"), vocabulary))


def op9_toxicity(spark, sf_dir):
    documents, labels = (read_table(spark, sf_dir, t) for t in ("documents", "labels"))
    return toxicity.toxicity(documents, labels)


def op10_token_counts(spark, sf_dir):
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    folder = scratch_path(spark, "token-files")
    written = token_counts.write_files(read_table(spark, sf_dir, "documents"), folder, *ranks)
    written = Scratch(spark, "token-files").stage(written, "documents")
    paths = [r.path for r in written.select("path").distinct().collect()]  # one row per file
    counts = token_counts.count_tokens(token_counts.read_files(spark, paths, width=2), separator=50_256)
    ids = written.select(token_counts.file_name().alias("file"), "doc_no", "doc_id")
    return counts.join(ids, ["file", "doc_no"], "left")


def op11_tokenizer_alignment(spark, sf_dir):
    return alignment.alignment(
        read_table(spark, sf_dir, "documents"),
        public_tokenizers.path("byte_bpe_50k.tiktoken"),
        public_tokenizers.PATTERN,
        public_tokenizers.path("piece_bpe_32k.model"),
    )


def op12_vector_codes(spark, sf_dir):
    coded, books = vector_codes.encode(read_table(spark, sf_dir, "embeddings"))
    return vector_codes.with_label_errors(coded).select(
        "vec_id", "code", "error", "label_error",
        F.lit(vector_codes.books_sha256(books)).alias("codebooks_sha256"),
    )


def op13_decontamination(spark, sf_dir):
    documents, benchmark = (read_table(spark, sf_dir, t) for t in ("documents", "benchmark"))
    return decontamination.contamination(documents, benchmark)


QUERIES = {
    "op1_html_extraction": op1_html_extraction,
    "op2_exact_dedup": op2_exact_dedup,
    "op3_secret_scans": op3_secret_scans,
    "op4_embedding_dedup": op4_embedding_dedup,
    "op5_mixing": op5_mixing,
    "op6_chat_formatting": op6_chat_formatting,
    "op7_jaccard_join": op7_jaccard_join,
    "op8_packing": op8_packing,
    "op9_toxicity": op9_toxicity,
    "op10_token_counts": op10_token_counts,
    "op11_tokenizer_alignment": op11_tokenizer_alignment,
    "op12_vector_codes": op12_vector_codes,
    "op13_decontamination": op13_decontamination,
}

ORACLES = {
    "op2_exact_dedup": exact_dedup.ORACLE,
    "op5_mixing": mixing.ORACLE,
    "op12_vector_codes": vector_codes.ORACLE,
    "op13_decontamination": decontamination.ORACLE,
}
