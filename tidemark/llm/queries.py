"""The dealt operators as queries over the supplied tables, with production parameters over whole tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import (
    chat, decontam, langid, lm, mixing, neighbours, pagediff, runs, sharding, simhash, surrogates, urlcascade, variants,
)
from tidemark.llm.common import in_fold, ship, table

SURROGATE_KEY = "replace this key in production"
REPETITION = 2.0


def nearest_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    ship(spark)
    return neighbours.nearest(table(spark, folder, "embeddings"), F.col("vec_id") % 20 == 0)


def page_text(spark: SparkSession, folder: str) -> DataFrame:
    ship(spark)
    found = pagediff.main_text(table(spark, folder, "pages").select("page_id", "url", "html"))
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def mixed_sources(spark: SparkSession, folder: str) -> DataFrame:
    goal = mixing.Goal(max_repetition=REPETITION)
    return mixing.mixed(table(spark, folder, "documents"), goal, columns=["doc_id", "source"])


def lm_scores(spark: SparkSession, folder: str) -> DataFrame:
    ship(spark)
    docs = table(spark, folder, "documents")
    return lm.scored(docs, ~in_fold("doc_id", 7, 2)).select(
        "doc_id", in_fold("doc_id", 7, 2).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def chat_format(spark: SparkSession, folder: str) -> DataFrame:
    turns = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    own = "</s>[INST] ok [/INST]"
    more = spark.createDataFrame([(-7, 0, "user", own), (-7, 1, "assistant", own)], turns.schema)
    parts = turns.unionAll(more).withColumn("parts", chat.text_parts(F.col("text")))
    return chat.digests(chat.format_conversations(parts))


def language(spark: SparkSession, folder: str) -> DataFrame:
    ship(spark)
    docs = table(spark, folder, "documents").select("doc_id", "text", "lang")
    profiles = langid.learn(docs.where(~in_fold("doc_id", 4, 2)))
    found = langid.with_language(docs.drop("lang"), profiles)
    return found.select("doc_id", in_fold("doc_id", 4, 2).alias("held_out"), "lang_pred", "score")


def shards(spark: SparkSession, folder: str) -> DataFrame:
    return sharding.shard_rows(table(spark, folder, "documents"), 16)


def benchmark_leaks(spark: SparkSession, folder: str) -> DataFrame:
    ship(spark)
    docs = table(spark, folder, "documents").select("doc_id", "text")
    found = decontam.contaminated(docs, table(spark, folder, "benchmark"))
    return found.select("doc_id", F.explode("found").alias("found")).select("doc_id", "found.*")


def near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    ship(spark)
    found = simhash.near_duplicates(table(spark, folder, "documents"))
    digits = F.lower(F.lpad(F.hex("fingerprint"), 16, "0"))
    return found.select("doc_id", digits.alias("fingerprint"), "component_id")


def surrogate_texts(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return surrogates.surrogated(docs, SURROGATE_KEY)


def spelling_variants(spark: SparkSession, folder: str) -> DataFrame:
    ship(spark)
    words = variants.word_counts(table(spark, folder, "documents"), misspell=97)
    return variants.grouped_variants(words).select("word", "form", "root", "n", "n_near", "form_n")


URL_RULES = [
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
]


def url_verdicts(spark: SparkSession, folder: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    found = urlcascade.judged(table(spark, folder, "pages").select("page_id", "url"), rules)
    return found.select("page_id", "host", "path", "rule", "verdict")


def periodic_texts(docs: DataFrame) -> DataFrame:
    """(doc_id, text), one text in ten, by the CRC-32 of the id, with its end made periodic; the others as they are.

    With h the CRC-32, g = h div 10 and n words, each word i from a = g % n on becomes word a + (i - a) % p, where
    p = 1 + (n - a) div (3 + g % 8). Words are a column of their own, so that they are split once a text.
    """
    h = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    words = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "")
    n, a, p = F.size("words"), F.col("a"), F.col("p")
    split = docs.select(
        "doc_id", "text", F.floor(h / 10).alias("g"), F.when(h % 10 == 0, words).alias("words"))
    begun = split.select("*", F.when(n > 0, F.col("g") % n).cast("int").alias("a"))
    step = F.when(n > 0, F.lit(1) + F.floor((n - a) / (F.lit(3) + F.col("g") % 8))).cast("int")
    placed = begun.select("*", step.alias("p"))
    repeated = F.transform("words", lambda w, i: F.when(i < a, w).otherwise(F.get("words", a + (i - a) % p)))
    return placed.select("doc_id", F.when(n > 0, F.array_join(repeated, " ")).otherwise(F.col("text")).alias("text"))


def run_digests(found: DataFrame) -> DataFrame:
    """Number, most periodic run and digests of ``runs`` and ``collapsed``."""
    none = F.lit(None).cast("struct<start:long,length:long,period:long>")
    top = F.reduce("runs", none, lambda best, run: F.when(
        best.isNull() | (run["length"] * best["period"] > best["length"] * run["period"]), run).otherwise(best))
    lines = F.transform("runs", lambda r: F.concat_ws(
        ",", r["start"].cast("string"), r["length"].cast("string"), F.concat(r["period"].cast("string"), F.lit("\n"))))
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), top.alias("top"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    ).select(
        "doc_id", "n_runs", "top.start", "top.length", "top.period",
        F.floor(F.lit(1000) * F.col("top.length") / F.col("top.period")).alias("exponent_milli"),
        "runs_sha256", "collapsed_sha256")


def periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    ship(spark)
    return run_digests(runs.with_runs(periodic_texts(table(spark, folder, "documents"))))


QUERIES = {
    "op1_projected_neighbours": nearest_neighbours,
    "op2_page_differencing": page_text,
    "op3_temperature_mixing": mixed_sources,
    "op4_attention_scores": lm_scores,
    "op5_chat_parts": chat_format,
    "op6_rank_order_language": language,
    "op7_label_propagation_shards": shards,
    "op8_string_tiling": benchmark_leaks,
    "op9_ball_simhash": near_duplicates,
    "op10_surrogates": surrogate_texts,
    "op11_spelling_variants": spelling_variants,
    "op12_url_cascade": url_verdicts,
    "op13_periodic_runs": periodic_runs,
}
