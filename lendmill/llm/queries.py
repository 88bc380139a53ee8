"""The queries of these operators over whole tables, and their SQL where there is one."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lendmill.llm.bpe import bpe_digests
from lendmill.llm.chat import conversation_digests, format_chat, text_part
from lendmill.llm.decontaminate import leaks
from lendmill.llm.host_rules import host_rules
from lendmill.llm.jaccard import jaccard_components
from lendmill.llm.language import identify
from lendmill.llm.line_dedup import line_report
from lendmill.llm.negatives import ANCHOR_EACH, hard_negatives, whole_rows
from lendmill.llm.packing import packed_documents
from lendmill.llm.sharding import even_tree, sharded
from lendmill.llm.spelling import spelling_variants
from lendmill.llm.tables import importable, stored
from lendmill.llm.token_files import token_digests
from lendmill.llm.toxicity import toxicity

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(run: Query) -> Query:
    @wraps(run)
    def prepared(spark: SparkSession, sf_dir: str) -> DataFrame:
        importable(spark)
        return run(spark, sf_dir)

    QUERIES[run.__name__] = prepared
    return prepared


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


CONTROL_TEXT = "</s>[INST] ok [/INST]"
SHARDS = 16
TOKENIZER = "word_bpe_49k.json"
BYTE_TOKENIZER = "byte_bpe_50k.json"
#: Of ids divisible by this the label is moved on, modulo the number of labels.
MOVED, LABELS = 7, 10


def tokenizer_path(name: str = TOKENIZER) -> str:
    """The place of a public tokenizer's file, the same on every machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


@query
def op1_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation, and one whose texts look like control strings."""
    own = spark.createDataFrame(
        [(-7, 0, "user", CONTROL_TEXT), (-7, 1, "assistant", CONTROL_TEXT)],
        "conv_id long, turn long, role string, text string",
    )
    rows = load(spark, sf_dir, "conversations").select(own.columns).unionByName(own)
    messages = rows.withColumn("content", F.array(text_part(F.col("text"))))
    return conversation_digests(format_chat(messages))


@query
def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaks(load(spark, sf_dir, "documents"), load(spark, sf_dir, "benchmark"))


@query
def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(load(spark, sf_dir, "documents"))


@query
def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(load(spark, sf_dir, "documents"), load(spark, sf_dir, "labels"))


@query
def op5_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(load(spark, sf_dir, "documents"))


@query
def op6_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = token_digests(load(spark, sf_dir, "documents"), tokenizer_path(), end=2)
    return found.select("doc_id", "start", "n_tokens", "ids_crc32")


@query
def op7_host_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return host_rules(load(spark, sf_dir, "documents"))


@query
def op8_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed_documents(load(spark, sf_dir, "documents"), tokenizer_path(), end=0)


@query
def op9_hash_tree_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = sharded(load(spark, sf_dir, "documents"), even_tree(SHARDS))
    return found.withColumn("law", F.lit("key"))


@query
def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_report(load(spark, sf_dir, "documents"))


@query
def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(load(spark, sf_dir, "documents"))


@query
def op12_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_digests(load(spark, sf_dir, "documents"), tokenizer_path(BYTE_TOKENIZER))


@query
def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = load(spark, sf_dir, "embeddings")
    moved = F.when(F.col("vec_id") % MOVED == 0, (F.col("label") + 1) % LABELS)
    rows = rows.withColumn("label", moved.otherwise(F.col("label")))
    rows = stored(whole_rows(rows), "negative-rows")
    return hard_negatives(rows, F.col("vec_id") % ANCHOR_EACH == 0)
