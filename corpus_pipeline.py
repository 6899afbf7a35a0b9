"""A corpus from raw documents, stage by stage; each stage reads what the one before it wrote.

Between stages the documents are Parquet in the cluster's shared folder, so an executor that
is lost costs a reread; a folder goes when the stage after it has been written, and what a stage decides by goes with it. Texts are moved
as little as can be: mixing decides about a document where it is read, and the other stages join
with the doc_ids that go, a table of one column, which Spark broadcasts where it is small. Only
where a doc_id stands for several rows, or is missing, the SHA-256 of the text tells rows apart;
no row is named by a short hash that isn't checked.

Defined results: null texts count as empty (and fail the quality rules). One doc_id can stand for
several texts, and rows without a doc_id are judged by their text alone. Of rows that repeat in
full, one stays after the exact dedup. An empty table gives an empty result. Extra columns come
along, whatever their names.
"""

from __future__ import annotations

from itertools import count

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.bpe import encode
from tessera.llm.common import discard, documents, only, stage, text_of
from tessera.llm.exact_dedup import exact_dedup, normalised
from tessera.llm.mixing import take
from tessera.llm.ngram_join import component_ids
from tessera.llm.quality import verdicts


def digest(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


def staying(docs: DataFrame, decided: DataFrame, text: Column) -> DataFrame:
    """The documents that stay by `decided` (doc_id, digest, stays); `text` is what the digests are of.

    A doc_id of which nothing stays tells its rows; other rows are told by their digest too.
    """
    gone, kept = decided.where("NOT stays"), decided.where("stays").select(F.col("doc_id").alias("_kept"))
    known = gone.where("doc_id IS NOT NULL")
    ids = stage(known.select("doc_id").distinct().join(kept, F.col("doc_id") == F.col("_kept"), "left_anti").toDF("_gone"), "ids-that-go")
    left = docs.join(ids, docs["doc_id"] == F.col("_gone"), "left_anti")
    partly = known.join(kept, F.col("doc_id") == F.col("_kept"), "left_semi").unionByName(gone.where("doc_id IS NULL"))
    rows = stage(partly.select(F.col("doc_id").alias("_id"), F.col("digest").alias("_digest")).distinct(), "rows-that-go")
    if rows.isEmpty():
        return left
    return left.join(rows, docs["doc_id"].eqNullSafe(F.col("_id")) & (digest(text) == F.col("_digest")), "left_anti")


def of_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    judged = verdicts(docs, labels, also={"digest": digest(text_of(docs))})
    return staying(docs, stage(judged.select("doc_id", "digest", F.col("kept").alias("stays")), "judged"), text_of(docs))


def one_of_equals(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts stays."""
    found = stage(exact_dedup(docs).select("doc_id", F.unhex("text_sha256").alias("digest"), F.col("kept").alias("stays")), "equals")
    text = normalised(text_of(docs))
    # Rows that share doc_id and text with one that stays: all stay at first, then one of them.
    repeats = found.groupBy("doc_id", "digest").agg(F.count(F.lit(1)).alias("n"), F.max("stays").alias("stays"))
    once = staying(docs, repeats.select("doc_id", "digest", "stays"), text)
    again = stage(repeats.where("stays AND n > 1").select(F.col("doc_id").alias("_id"), F.col("digest").alias("_digest")), "repeated-rows")
    if again.isEmpty():
        return once
    is_again = once["doc_id"].eqNullSafe(F.col("_id")) & (digest(text) == F.col("_digest"))
    single = once.withColumn("_d", digest(text)).join(again, once["doc_id"].eqNullSafe(F.col("_id")) & (F.col("_d") == F.col("_digest"))).dropDuplicates(["doc_id", "_d"])
    return once.join(again, is_again, "left_anti").unionByName(single.select(*docs.columns))


def one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of rows that are linked, directly or by others, the one with the smallest doc_id stays (none comes last), then by the text's digest."""
    shared = stage(docs.groupBy("doc_id").count().where("count > 1 OR doc_id IS NULL").select("doc_id"), "shared-ids")
    if shared.isEmpty():  # the rule: doc_ids tell rows apart
        found = component_ids(docs.select("doc_id", "text"))
        return staying(docs, found.select("doc_id", F.lit(None).cast("binary").alias("digest"), (F.col("doc_id") == F.col("component_id")).alias("stays")), docs["text"])
    found, names = named_components(docs)
    place = F.struct(F.col("doc_id").isNull(), "doc_id", "digest")
    placed = stage(found.join(names, "name").withColumn("place", place), "placed")
    first = placed.groupBy("component_id").agg(F.min("place").alias("first"))
    decided = placed.join(first, placed["component_id"].eqNullSafe(first["component_id"])).select("doc_id", "digest", F.col("place").eqNullSafe(F.col("first")).alias("stays"))
    return staying(docs, stage(decided, "decided"), text_of(docs))


def named_components(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(name, component_id) and (name, doc_id, digest), the names told apart by a check; another hash is tried until they are."""
    for seed in count():
        name = F.xxhash64(F.lit(seed), docs["doc_id"].isNull(), docs["doc_id"], text_of(docs))
        names = stage(docs.select(name.alias("name"), "doc_id", digest(text_of(docs)).alias("digest")).distinct(), "names")
        if names.groupBy("name").count().where("count > 1").isEmpty():
            found = component_ids(docs.select(name.alias("doc_id"), "text"))
            return found.select(F.col("doc_id").alias("name"), "component_id").distinct(), names
    raise AssertionError


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it."""
    return take(docs)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids (little-endian uint32) and decoded_sha256, of the text that the ids give back."""
    found = encode(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN, decoded=True)
    return found.select("doc_id", (F.octet_length("ids") / 4).cast("bigint").alias("n_tokens"), "ids", F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("quality rules", of_quality),
    ("exact dedup", one_of_equals),
    ("n-gram jaccard join", one_of_near_copies),
    ("mixing sources", mixed),
    ("byte-level bpe", encoded),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, step in STAGES[:-1]:
        written: list[DataFrame] = []
        with only(but=written):  # what a stage decides by goes when its documents are written
            written.append(stage(step(spark, docs, sf_dir), name.replace(" ", "-")))
        discard(docs)
        docs = written[0]
    return STAGES[-1][1](spark, docs, sf_dir)


#: Near copies, likelihoods and token ids are beyond SQL; the tests hold the pipeline against a brute-force version.
ORACLE_SQL = None
