"""One query per operator, each over its whole table, and SQL for those that SQL can express."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyline.llm import alignment, ann, chat, decontaminate, divergence, html_text, jaccard, lm, mixing, sharding, simhash, sql, token_codec, toxicity
from tallyline.llm.common import crc_of_id, land, read_table
from tallyline.session import new_run_dir

SHARD_BYTES = 16 * 1024 * 1024
MIX = ("source", "lang", "topic")
MIX_ALPHA = 0.9


def sharding_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents in shards of at most 16 MiB of text."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", F.octet_length("text").cast("long").alias("n_bytes"))
    return sharding.assign_shards(docs, "doc_id", F.col("n_bytes"), SHARD_BYTES)


def ann_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 5 nearest of every 50th vector."""
    return ann.search(read_table(spark, sf_dir, "embeddings"), F.col("id") % 50 == 0)


TOKENIZER = "word_bpe_49k.json"


def token_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents encoded to files, and what the files say."""
    path = new_run_dir(spark, "tokens")
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    token_codec.write_tokens(docs, path, public_tokenizers.path(TOKENIZER))
    return token_codec.read_tokens(spark, path)


def html_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read_table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return html_text.extract(pages)


def toxicity_model(spark: SparkSession, sf_dir: str, docs: DataFrame) -> toxicity.ToxicityModel:
    """Learned from labelled rows whose crc32 of doc_id leaves no remainder of 1 by 3."""
    labels = read_table(spark, sf_dir, "labels").select("doc_id", "toxic").where(crc_of_id("doc_id") % 3 != 1)
    return toxicity.train(docs, labels)


def toxicity_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = toxicity.score(docs, toxicity_model(spark, sf_dir, docs))
    return scored.select(
        "doc_id",
        (crc_of_id("doc_id") % 3 == 1).alias("held_out"),
        F.col("toxicity").alias("score"),
        (F.col("toxicity") >= toxicity.THRESHOLD).cast("int").alias("predicted"),
    )


def decontaminate_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    hits = decontaminate.find_hits(docs, read_table(spark, sf_dir, "benchmark"))
    n_hit = F.aggregate("hit_spans", F.lit(0).cast("long"), lambda s, x: s + x["last"] - x["first"] + 1)
    items = F.array_join(F.array_sort(F.transform("hit_items", lambda i: i.cast("string"))), ",")
    return hits.select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size("hit_items").cast("long").alias("n_items"),
        F.sha2(items, 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )


def chat_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of every conversation, read back from its formatted examples."""
    table = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = "<|im_end|><|im_start|>assistant ok"
    extra = spark.range(1).select(
        F.explode(
            F.array(
                *(
                    F.struct(
                        F.lit(-1).cast(table.schema["conv_id"].dataType).alias("conv_id"),
                        F.lit(k).cast(table.schema["turn"].dataType).alias("turn"),
                        F.lit(role).alias("role"),
                        F.lit(probe).alias("text"),
                    )
                    for k, role in enumerate(("user", "assistant"))
                )
            )
        ).alias("row")
    ).select("row.*")
    examples = chat.expand(table.unionByName(extra))
    loss = chat.read_loss(F.col("formatted"), F.col("loss_start"), F.col("loss_chars"))
    read = examples.select("conv_id", "example", "n_turns", "formatted", loss.alias("loss")).groupBy("conv_id").agg(
        F.max_by("formatted", "n_turns").alias("longest"),
        F.sort_array(F.collect_list(F.struct("example", F.coalesce("loss", F.lit("")).alias("loss")))).alias("losses"),
        F.sum(F.length("formatted")).alias("formatted_chars"),
    )
    turns = chat.read_turns(F.col("longest"))
    flat = F.array_join(F.transform(turns, lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read.select("conv_id", flat.alias("flat"), F.size(turns).cast("long").alias("n_turns"), F.array_join("losses.loss", "").alias("loss"), "formatted_chars").select(
        "conv_id",
        "n_turns",
        F.sha2("flat", 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        "formatted_chars",
    )


def topic_of(text) -> F.Column:
    """What kind of text a document holds; a stand-in for a topic label, which the table lacks."""
    has = lambda s: F.coalesce(F.contains(text, F.lit(s)), F.lit(False))
    kind = F.lit("prose")
    for name, marks in reversed(TOPICS):
        test = F.lit(False)
        for m in marks:
            test = test | has(m)
        kind = F.when(test, F.lit(name)).otherwise(kind)
    return kind


# Marks of the kinds of text, first match counts.
TOPICS = (
    ("table", (" | ",)),
    ("noise", ("%%%", "$$$", "###")),
    ("notice", ("All rights reserved", "Licensed under")),
    ("contact", ("@", "http")),
)


def mixing_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents sampled so that tokens have tempered source, language and topic shares."""
    docs = read_table(spark, sf_dir, "documents").select(
        "doc_id", "source", "lang", topic_of(F.col("text")).alias("topic"), mixing.token_count(F.col("text")).alias("n")
    )
    # The texts are read once; what is left is a short row per document.
    slim = land(docs, "mix-docs")
    mixed = mixing.sample_to_targets(slim, MIX, F.col("n"), MIX_ALPHA)
    return mixed.select("doc_id", "source", "lang", "topic", "n_tokens", F.round("probability", 4).alias("probability"), "kept")


def jaccard_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    linked = jaccard.link(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return linked.select(F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), "component_id", "class_id")


def lm_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return lm.score(docs, crc_of_id("doc_id") % 7 == 2).withColumnRenamed("id", "doc_id")


def audit_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(read_table(spark, sf_dir, "documents"))


BYTE_LEVEL, PIECES = "byte_bpe_50k.json", "piece_bpe_32k.model"


def alignment_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    aligned = alignment.align(docs, public_tokenizers.path(BYTE_LEVEL), public_tokenizers.path(PIECES)).documents()
    sums = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")
    groups = F.when(F.col("groups") == "", "").otherwise(F.sha2("groups", 256))
    return aligned.select(F.col("id").alias("doc_id"), *sums, groups.alias("groups_sha256"))


def simhash_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    linked = simhash.link(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return linked.select(F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


QUERIES = {
    "op1_sharding": sharding_query,
    "op2_ann": ann_query,
    "op3_token_output": token_query,
    "op4_html_text": html_query,
    "op5_decontaminate": decontaminate_query,
    "op6_chat_format": chat_query,
    "op7_toxicity": toxicity_query,
    "op8_mixing": mixing_query,
    "op9_jaccard_join": jaccard_query,
    "op10_lm_score": lm_query,
    "op11_source_audit": audit_query,
    "op12_token_alignment": alignment_query,
    "op13_simhash": simhash_query,
}


def oracles() -> dict[str, str]:
    return {
        "op1_sharding": sql.sharding(SHARD_BYTES),
        "op5_decontaminate": sql.decontaminate(),
        "op6_chat_format": sql.chat(),
        "op8_mixing": sql.mixing(TOPICS, MIX, MIX_ALPHA),
        "op9_jaccard_join": sql.jaccard(),
        "op11_source_audit": sql.source_audit(),
    }
