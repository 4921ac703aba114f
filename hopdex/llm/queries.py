"""The corpus operators as queries over the given tables."""

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hopdex.llm.bpe import encode_documents
from hopdex.llm.common import table
from hopdex.llm.decontaminate import find_contamination
from hopdex.llm.filter_audit import audit_filters
from hopdex.llm.fuzzy_lines import dedup_lines
from hopdex.llm.language_id import identify_languages
from hopdex.llm.line_rules import rate_documents
from hopdex.llm.ngram_join import similar_documents
from hopdex.llm.quality_mil import score_quality
from hopdex.llm.simhash import similar_fingerprints
from hopdex.llm.spelling import group_variants
from hopdex.llm.suffix_dedup import remove_repeats
from hopdex.llm.toxicity import score_toxicity
from hopdex.llm.url_rules import judge_urls

QUERIES = {}


def _vocabulary() -> str:
    return public_tokenizers.path("byte_bpe_50k.json")


def query(function):
    QUERIES[function.__name__] = function
    return function


@query
def op1_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return remove_repeats(table(spark, folder, "documents")).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"
    )


@query
def op2_decontamination(spark, folder):
    found = find_contamination(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return found.drop("k_id", "k_text")


@query
def op3_language_id(spark, folder):
    return identify_languages(table(spark, folder, "documents"), _vocabulary())


@query
def op4_line_rules(spark, folder):
    return rate_documents(table(spark, folder, "documents")).drop("removed_words")


@query
def op5_quality_mil(spark, folder):
    return score_quality(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query
def op6_fuzzy_lines(spark, folder):
    cut = dedup_lines(table(spark, folder, "documents"))
    return cut.select("doc_id", "n_lines", "n_removed", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


@query
def op7_toxicity(spark, folder):
    return score_toxicity(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query
def op8_bpe(spark, folder):
    encoded = encode_documents(table(spark, folder, "documents"), _vocabulary())
    return encoded.select(
        "doc_id", "n_tokens", "ids_sha256", F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256")
    )


@query
def op9_url_rules(spark, folder):
    return judge_urls(table(spark, folder, "pages"))


@query
def op10_ngram_join(spark, folder):
    return similar_documents(table(spark, folder, "documents")).drop("k_id", "k_text")


@query
def op11_filter_audit(spark, folder):
    return audit_filters(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query
def op12_spelling_variants(spark, folder):
    return group_variants(table(spark, folder, "documents"))


@query
def op13_simhash(spark, folder):
    return similar_fingerprints(table(spark, folder, "documents"))
