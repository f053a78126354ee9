"""The queries of the numbered operators, each over its whole table, and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.llm import (
    chat, decontaminate, hard_negatives, mixing, near_dedup, oracles, packing, personal, quality_rank, repetition, secrets,
    suffix_tree, url_rules, vector_codes,
)
from ledgerlens.llm.common import bounded_batches, read
from ledgerlens.session import staged

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = oracles.ORACLES


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        bounded_batches(spark)
        return fn(spark, sf_dir)

    QUERIES[fn.__name__] = run
    return run


@query
def op4_mix_sources(spark, sf_dir):
    found = mixing.copies(read(spark, sf_dir, "documents"))
    return found.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("n_copies")).alias("taken"))


def folded(doc_id, folds):
    """The fold of a document by the CRC of its id; a missing id is in fold 0."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % folds, F.lit(0))


def learned_ranking(measured: DataFrame, labels: DataFrame) -> quality_rank.Ranking:
    """What is learned from the features (doc_id, x) of the documents outside fold 0."""
    known = labels.select("doc_id", F.col("quality").alias("label"))
    return quality_rank.fit(measured.filter(folded("doc_id", 5) != 0), known)


@query
def op2_quality_rank(spark, sf_dir):
    measured = staged(read(spark, sf_dir, "documents").select("doc_id", quality_rank.features("text").alias("x")), "features")
    ranking = learned_ranking(measured, read(spark, sf_dir, "labels"))
    held_out = (folded("doc_id", 5) == 0).alias("held_out")
    scored = measured.select("doc_id", held_out, quality_rank.score(F.col("x"), ranking).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= ranking.cut).cast("int"))


@query
def op3_decontaminate(spark, sf_dir):
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate.matched(docs, read(spark, sf_dir, "benchmark"), decontaminate.Settings(matches=False), name="found")
    items = F.array_sort(F.transform("found.items", lambda i: i.cast("string")))
    return found.select(
        "doc_id", "found.n_words", "found.n_hit", F.size(items).cast("long").alias("n_items"),
        F.sha2(F.array_join(items, ",").cast("binary"), 256).alias("items_sha256"),
        decontaminate.is_contaminated(F.col("found")).alias("contaminated"),
    )


def kind_count(kind):
    return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")


@query
def op9_scan_secrets(spark, sf_dir):
    scan = secrets.scanner(spark)
    found = read(spark, sf_dir, "documents").select("doc_id", scan("text").alias("spans"))
    base = F.filter("spans", lambda s: s["kind"] != "random")
    return found.select(
        "doc_id", *[kind_count(kind) for kind in secrets.KINDS],
        F.sha2(secrets.digest(base).cast("binary"), 256).alias("base_sha256"), secrets.digest(F.col("spans")).alias("spans"),
    )


@query
def op6_repetition_rules(spark, sf_dir):
    m = F.col("m")
    found = read(spark, sf_dir, "documents").select("doc_id", repetition.measurer()("text").alias("m"))
    return found.select(
        "doc_id", "m.n_words", "m.word_chars", "m.n_symbols", "m.n_dup_lines", "m.n_repeat_words", "m.n_covered",
        repetition.base_failed(m).alias("base_failed"), repetition.kept(m).alias("kept"),
    )


NEAR = near_dedup.Settings(shingle=3, percent=85)


@query
def op5_near_dedup(spark, sf_dir):
    found = near_dedup.grouped(read(spark, sf_dir, "documents"), NEAR)
    return found.select(
        "doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept")
    )


@query
def op10_personal_data(spark, sf_dir):
    found = personal.scanned(read(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s["kind"] != "context")
    return found.select(
        "doc_id", *[kind_count(kind) for kind in personal.KINDS],
        F.sha2(personal.digest(base).cast("binary"), 256).alias("base_sha256"), personal.digest(F.col("spans")).alias("spans"),
    )


@query
def op7_suffix_tree(spark, sf_dir):
    found = suffix_tree.scored(read(spark, sf_dir, "documents"), folded("doc_id", 10) != 0)
    return found.select(
        "doc_id", (~F.col("is_training")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score"
    )


@query
def op1_chat_perspectives(spark, sf_dir):
    found = chat.perspectives(read(spark, sf_dir, "conversations"))
    masks = F.transform("masks", lambda m: F.concat_ws(":", m["start"].cast("string"), m["end"].cast("string")))
    said = F.aggregate("masks", F.lit(0), lambda n, m: n + m["end"] - m["start"])
    return found.select(
        "conv_id", "perspective", "block", "n_turns", "text", F.array_join(masks, ",").alias("masks"), said.alias("n_masked")
    )


# The given list: a rule fits its host and all subdomains, and paths that start with its path.
LISTED = (
    url_rules.Rule("allow", "org", "/"), url_rules.Rule("block", "example.org", "/es/"),
    url_rules.Rule("block", "example.org", "/en/1"), url_rules.Rule("allow", "com", "/fr/"),
    url_rules.Rule("block", "com", "/de/"),
)


@query
def op8_url_rules(spark, sf_dir):
    """The list's verdicts are the labels to learn from; what it leaves open is judged by the mined rules."""
    pages = read(spark, sf_dir, "pages").select("page_id", "url")
    verdict = url_rules.listed(url_rules.host_of(F.col("url")), url_rules.path_of(F.col("url")), LISTED)["verdict"]
    found = url_rules.judged(pages, pages.select("url", verdict.alias("label")), LISTED)
    return found.select("page_id", "judged.host", "judged.path", "judged.rule", "judged.verdict")


@query
def op11_pack_sequences(spark, sf_dir):
    return packing.packed(read(spark, sf_dir, "documents"))


@query
def op12_vector_codes(spark, sf_dir):
    coded, books = vector_codes.compressed(read(spark, sf_dir, "embeddings"))
    return vector_codes.with_label_error(coded).select(
        "vec_id", "code", "error", "label_error", F.lit(vector_codes.digest(books)).alias("codebooks_sha256")
    )


@query
def op13_hard_negatives(spark, sf_dir):
    """Every seventh id has a wrong label, as the contract has it."""
    vec_id, label = F.col("vec_id"), F.col("label")
    wrong = F.coalesce(F.pmod(vec_id, F.lit(7)) == 0, F.lit(False))
    rows = read(spark, sf_dir, "embeddings").select("vec_id", "embedding", F.when(wrong, (label + 1) % 10).otherwise(label).alias("label"))
    return hard_negatives.mined(rows, F.pmod(vec_id, F.lit(100)) == 0)
