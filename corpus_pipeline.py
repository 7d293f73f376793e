"""From raw documents to token files in five stages.

1. toxicity: documents that the model rejects go.
2. near duplicates: of each group of linked documents the smallest id stays.
3. decontamination: benchmark passages are cut out; documents that are mostly
   benchmark text go.
4. mixing: documents are sampled to tempered source, language and topic shares.
5. token output: what is left is written as token blocks and read back.

A stage takes the Parquet output of the one before. All but the last return the
columns of documents. Nulls, empty texts and repeated rows are handled as the
operators say; rows of null id are kept by stage 2, and of rows that share an
id one stays. Extra columns of any name and type pass through stages 1 to 4, also
those called like a result of an operator. Empty tables give empty results.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyline.llm import decontaminate, jaccard, mixing, queries, token_codec, toxicity
from tallyline.llm.common import MAX_BROADCAST_BYTES, free_name, land, read_table
from tallyline.session import new_run_dir, write_table

# Near duplicates share four fifths of their five-word shingles.
SHINGLE = 5
THRESHOLD = (80, 100)


def _aside(docs: DataFrame, *results: str) -> tuple[DataFrame, list]:
    """``docs`` with columns called like a result under other names, and the columns that restore it."""
    out, back = docs, []
    for c in docs.columns:
        name = c
        if c.lower() in results:
            name = free_name(out, c + "_")
            out = out.withColumnRenamed(c, name)
        back.append(F.col(f"`{name}`").alias(c))
    return out, back


def _ordered(kind: T.DataType) -> bool:
    """Whether values of a type can be compared."""
    if isinstance(kind, T.StructType):
        return all(_ordered(f.dataType) for f in kind)
    if isinstance(kind, T.ArrayType):
        return _ordered(kind.elementType)
    return not isinstance(kind, (T.MapType, T.VariantType))


def _greatest(docs: DataFrame) -> Column:
    """The greatest row: by the columns that can be compared, then by the others as JSON."""
    others = [f.name for f in docs.schema if not _ordered(f.dataType)]
    row = F.struct(*docs.columns)
    if not others:
        return F.max(row)
    first = [c for c in docs.columns if c not in others]
    return F.max_by(row, F.struct(*first, F.to_json(F.struct(*others)).alias("others")))


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = queries.toxicity_model(spark, sf_dir, docs)
    safe, back = _aside(docs, "toxicity", "toxic_terms", "toxic_at")
    return toxicity.score(safe, model).where(F.col("toxicity") < toxicity.THRESHOLD).select(*back)


def _few(ids: DataFrame) -> DataFrame:
    """Ids sent to every executor if there are few enough; else they are joined by a shuffle."""
    return F.broadcast(ids) if ids.count() * jaccard.RECORD <= MAX_BROADCAST_BYTES else ids


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    linked = jaccard.link(docs, shingle=SHINGLE, threshold=THRESHOLD)
    linked = land(linked.select("id", "component_id"), "linked")
    gone = linked.where("id <> component_id").select(F.col("id").alias("doc_id")).distinct()
    repeated = linked.where("id is not null").groupBy(F.col("id").alias("doc_id")).count().where("count > 1").select("doc_id")
    kept = docs.join(_few(gone), "doc_id", "left_anti").select(*docs.columns)
    if not repeated.take(1):
        return kept
    # Of rows that share an id the greatest stays.
    again = kept.join(_few(repeated), "doc_id", "left_semi").groupBy("doc_id").agg(_greatest(docs).alias("row")).select("row.*")
    return kept.join(_few(repeated), "doc_id", "left_anti").select(*docs.columns).unionByName(again)


def remove_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    clean = decontaminate.remove(docs, read_table(spark, sf_dir, "benchmark"))
    return clean.withColumn("n_chars", F.when(F.col("text").isNotNull(), F.length("text").cast("long")).otherwise(F.col("n_chars"))).select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    safe, back = _aside(docs, "n_tokens", "probability", "kept")
    topic = free_name(safe, "topic")
    tagged = safe.withColumn(topic, queries.topic_of(F.col("text")))
    mixed = mixing.sample_to_targets(tagged, ("source", "lang", topic), mixing.token_count(F.col("text")), queries.MIX_ALPHA)
    return mixed.where("kept").select(*back)


def write_token_files(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    path = new_run_dir(spark, "tokens")
    token_codec.write_tokens(docs, path, public_tokenizers.path(queries.TOKENIZER))
    return token_codec.read_tokens(spark, path)


STAGES = [
    ("toxicity", reject_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", remove_benchmark),
    ("mixing", mix_sources),
    ("token_output", write_token_files),
]

# Stages 1 and 2 learn a model and follow links; SQL has no means for that.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each result is written and read again."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = new_run_dir(spark, name)
        write_table(stage(spark, docs, sf_dir), path)
        docs = spark.read.parquet(path)
    return docs
