"""One registered query per operator, each over its whole table with production parameters."""

from __future__ import annotations

import uuid
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from leadpanel.llm import bpe, chat, exact, licenses, lines, minhash, packing, prefix_trie, quality, sentencepiece_codec, spelling, vectors, warc
from leadpanel.session import ensure_checkpoint_dir

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def register(fn: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@query("op1_line_templates", lines.ORACLE)
def op1(spark, folder):
    return lines.deduplicate(table(spark, folder, "documents"))


@query("op2_warc_revisits", warc.ORACLE)
def op2(spark, folder):
    path = f"{ensure_checkpoint_dir(spark)}/warc-{uuid.uuid4()}"
    warc.write_archives(table(spark, folder, "pages"), path)
    return warc.resolve_revisits(warc.read_archives(spark, path))


@query("op3_sentencepiece_codec")
def op3(spark, folder):
    model = public_tokenizers.path("piece_bpe_32k.model")
    return sentencepiece_codec.encode_documents(table(spark, folder, "documents"), model, with_ids=False)


@query("op4_neighbour_quality")
def op4(spark, folder):
    return quality.classify(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query("op5_sorted_projections", vectors.ORACLE)
def op5(spark, folder):
    return vectors.near_vectors(table(spark, folder, "embeddings"), threshold=0.93)


@query("op6_heavy_hitter_exact_dedup", exact.ORACLE)
def op6(spark, folder):
    return exact.mark_duplicates(table(spark, folder, "documents"))


@query("op7_power_of_two_packing")
def op7(spark, folder):
    tokenizer = public_tokenizers.path("byte_bpe_50k.json")
    return packing.pack(table(spark, folder, "documents"), tokenizer, with_ids=False)


@query("op8_fast_similarity_sketch", minhash.ORACLE)
def op8(spark, folder):
    return minhash.near_duplicates(table(spark, folder, "documents"), shingle=3, percent=85)


@query("op9_license_scan")
def op9(spark, folder):
    return licenses.scan(licenses.with_paths(table(spark, folder, "documents")))


@query("op10_chat_format", chat.ORACLE)
def op10(spark, folder):
    turns = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    trap = spark.createDataFrame(
        [(-1, 0, "user", chat.TRAP), (-1, 1, "assistant", chat.TRAP)],
        "conv_id bigint, turn bigint, role string, text string",
    )
    return chat.digests(chat.read_back(chat.format_conversations(turns.unionByName(trap))))


@query("op11_trie_pair_spelling", spelling.ORACLE)
def op11(spark, folder):
    return spelling.spelling_variants(table(spark, folder, "documents"))


@query("op12_segment_tree_bpe")
def op12(spark, folder):
    tokenizer = public_tokenizers.path("word_bpe_49k.json")
    return bpe.encode_documents(table(spark, folder, "documents"), tokenizer, with_ids=False, with_text=False)


@query("op13_count_min_prefix_trie", prefix_trie.ORACLE)
def op13(spark, folder):
    return prefix_trie.prefix_trie(table(spark, folder, "conversations"))
