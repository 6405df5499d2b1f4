"""The registered queries of this package, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assayer.llm.common import table
from assayer.llm.langid import fit_languages, identify_language
from assayer.llm import decontam, jaccard, lexsearch, linedup, lmscore, packing, prefixtrie, quality, setsketch, spans, urlfilter
from assayer.llm.toxicity import fit_toxicity, score_toxicity


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return score_toxicity(docs, fit_toxicity(docs, table(spark, sf_dir, "labels")))


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return identify_language(docs, fit_languages(docs))


# The rules of the query, fixed values.
URL_RULES = (
    ("allow", "org/"),
    ("block", "example.org/es/"),
    ("block", "example.org/en/1"),
    ("allow", "com/fr/"),
    ("block", "com/de/"),
)


def op3_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A page's label is that of the document whose id is the first number of its path."""
    pages, labels = table(spark, sf_dir, "pages"), table(spark, sf_dir, "labels")
    _, path = urlfilter.host_and_path(F.col("url"))
    number = F.regexp_extract(path, r"/([0-9]{1,18})", 1)
    linked = pages.select("page_id", F.when(number != "", number.cast("bigint")).alias("doc_id"))
    bad = labels.select("doc_id", F.when((F.col("quality") == 0) | (F.col("toxic") == 1), 1).otherwise(0).alias("bad"))
    return urlfilter.judge_urls(pages, linked.join(bad, "doc_id").select("page_id", "bad"), URL_RULES)


def op4_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return lmscore.score_texts(docs, lmscore.fit_language_model(docs))


def op5_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.jaccard_components(table(spark, sf_dir, "documents"))


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = spans.remove_repeated_spans(table(spark, sf_dir, "documents"), count_as=("n_sentences", "n_removed"))
    return kept.select("doc_id", "text", "n_sentences", "n_removed")


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.apply_quality_rules(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontam.find_contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linedup.dedup_lines(table(spark, sf_dir, "documents"), count_as="n_removed").select("doc_id", "text", "n_removed")


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefixtrie.prefix_trie(prefixtrie.rebuilt(prefixtrie.numbered(table(spark, sf_dir, "conversations"))))


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexsearch.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return setsketch.near_duplicates(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_toxicity": op1_toxicity,
    "op2_language_id": op2_language_id,
    "op3_url_filters": op3_url_filters,
    "op4_lm_scoring": op4_lm_scoring,
    "op5_ngram_jaccard_join": op5_ngram_jaccard_join,
    "op6_substring_dedup": op6_substring_dedup,
    "op7_quality_rules": op7_quality_rules,
    "op8_decontamination": op8_decontamination,
    "op9_line_dedup": op9_line_dedup,
    "op10_packing": op10_packing,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_lexical_search": op12_lexical_search,
    "op13_minhash_dedup": op13_minhash_dedup,
}
ORACLES: dict[str, str] = {"op5_ngram_jaccard_join": jaccard.SQL, "op8_decontamination": decontam.SQL, "op9_line_dedup": linedup.SQL, "op11_prefix_trie": prefixtrie.SQL, "op12_lexical_search": lexsearch.SQL, "op13_minhash_dedup": setsketch.SQL}
