"""Exact dedup by content-defined chunk recipes, in DataFrame functions only.

Each text, white space normalised, is cut where its content says so: at the first sentence
end after `MIN_CHUNK` characters, or at `MAX_CHUNK` characters where there is none. A cut
depends on nothing but the text since the cut before, so equal texts have equal chunks.

1. A chunk has a 64-bit hash, and its SHA-256 for the verification. Hashes that stand for more than
   one SHA-256 get a number beside them, one for each, so that an identifier means one chunk as far as
   SHA-256 tells chunks apart, however many collisions of the short hash are made on purpose. Both are
   aggregated within tasks first; no text is shuffled.
2. Another scan turns documents into recipes, their ordered lists of verified identifiers.
3. Documents are equal when their identifier lists are. From here on a row is an identifier
   list, however long the text. The SHA-256 of the text is a result beside it and decides nothing.

Hot groups: the count of a group is aggregated within tasks first, and the join that gives
members their group reads both sides from written tables, so Spark can split a hot key.

Defined results: a null text counts as empty, and empty texts are equal to each other.
Of equal texts the smallest doc_id stays; a null doc_id comes after all others. Where rows
repeat with the same doc_id, one of them stays. An empty table gives an empty result. Extra
columns of the input are ignored, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import SPACE, discard, documents, stage, text_of

MIN_CHUNK, MAX_CHUNK = 512, 4096
#: A chunk: up to a sentence end, or the longest allowed, or what is left.
CHUNK = rf"(?s).{{{MIN_CHUNK},{MAX_CHUNK}}}?(?<=[.!?;:] )|.{{1,{MAX_CHUNK}}}"


def normalised(text: Column) -> Column:
    """Runs of white space become one space. Only runs that aren't a single space already need work."""
    return F.regexp_replace(text, rf"{SPACE}{{2,}}|[\t-\r]", " ")


def chunks_of(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(CHUNK), F.lit(0))


def short_hash(chunk: Column, bits: int) -> Column:
    return F.shiftrightunsigned(F.xxhash64(chunk), 64 - bits)


#: The SHA-256 of a chunk as four numbers, which Spark aggregates without sorting.
CHECK = ["c0", "c1", "c2", "c3"]


def identified(chunk: Column, bits: int) -> Column:
    """hash of a chunk, and its SHA-256 as CHECK."""
    sha = F.sha2(chunk, 256)
    return F.struct(short_hash(chunk, bits).alias("hash"), *(F.conv(F.substring(sha, 16 * i + 1, 16), 16, -10).cast("bigint").alias(c) for i, c in enumerate(CHECK)))


def collisions(docs: DataFrame, bits: int = 64) -> DataFrame:
    """hash, CHECK, variant: the chunks whose hash stands for more than one."""
    chunks = docs.select(F.explode(chunks_of(normalised(text_of(docs)))).alias("chunk")).select(identified(F.col("chunk"), bits).alias("c")).select("c.*")
    spans = chunks.groupBy("hash").agg(*(f(c).alias(f"{f.__name__}_{c}") for c in CHECK for f in (F.min, F.max)))
    shared = stage(spans.where(" OR ".join(f"min_{c} <> max_{c}" for c in CHECK)).select("hash"), "chunk-collisions")
    if shared.isEmpty():
        discard(shared)
        return docs.sparkSession.createDataFrame([], ", ".join(f"{c} bigint" for c in ("hash", *CHECK)) + ", variant int")
    several = chunks.join(shared, "hash", "left_semi").distinct().groupBy("hash").agg(F.array_sort(F.collect_list(F.struct(*CHECK))).alias("kinds"))
    return stage(several.select("hash", F.posexplode("kinds").alias("variant", "k")).select("hash", "k.*", "variant"), "chunk-variants")


def recipes(docs: DataFrame, bits: int = 64) -> DataFrame:
    """row, doc_id, text_sha256, recipe (verified identifiers in order), one row per document."""
    doubtful = collisions(docs, bits)
    text = normalised(text_of(docs))
    cut = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", text.alias("text"))
    with_chunks = lambda f: cut.select("row", "doc_id", F.sha2("text", 256).alias("text_sha256"), F.transform(chunks_of(F.col("text")), f).alias("chunks"))
    if doubtful.isEmpty():
        rows = with_chunks(lambda c: F.struct(short_hash(c, bits).alias("hash"), F.lit(0).alias("variant")))
        return rows.withColumnRenamed("chunks", "recipe")
    rows = stage(with_chunks(lambda c: identified(c, bits)), "chunk-lists")
    pieces = rows.select("row", F.posexplode("chunks").alias("at", "c")).select("row", "at", "c.*").join(doubtful, ["hash", *CHECK], "left")
    lists = pieces.groupBy("row").agg(F.array_sort(F.collect_list(F.struct("at", "hash", F.coalesce("variant", F.lit(0)).alias("variant")))).alias("p"))
    recipe = F.transform("p", lambda p: F.struct(p["hash"].alias("hash"), p["variant"].alias("variant")))
    none = F.array().cast("array<struct<hash:bigint,variant:int>>")
    return rows.select("row", "doc_id", "text_sha256").join(lists.select("row", recipe.alias("recipe")), "row", "left").withColumn("recipe", F.coalesce("recipe", none))


def exact_dedup(docs: DataFrame, bits: int = 64) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256: one row for each row of `docs`.

    `bits` is the width of the chunk hash; a narrow one only makes more hashes doubtful.
    """
    found = stage(recipes(docs, bits), "recipes")
    rank = F.struct(F.col("doc_id").isNull().alias("last"), F.col("doc_id").alias("keep_id"), F.col("row").alias("keep_row"))
    # A hash of the list goes first, so that sorts seldom compare the lists themselves.
    found = found.withColumn("list_hash", F.xxhash64("recipe"))
    groups = found.groupBy("list_hash", "recipe").agg(F.count(F.lit(1)).alias("group_size"), F.min(rank).alias("first"))
    repeated = stage(groups.where("group_size > 1").select("list_hash", "recipe", "group_size", "first.keep_id", "first.keep_row"), "groups")
    joined = found.join(repeated, ["list_hash", "recipe"], "left")
    alone = F.col("group_size").isNull()
    return joined.select(
        "doc_id",
        F.when(alone, F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1).cast("bigint")).alias("group_size"),
        (alone | (F.col("row") == F.col("keep_row"))).alias("kept"),
        "text_sha256",
    )


def op1_exact_dedup(spark, sf_dir: str) -> DataFrame:
    return exact_dedup(documents(spark, sf_dir))


SQL = r"""
WITH n AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents),
     g AS (SELECT t, min(doc_id) AS keep_id, count(*) AS group_size FROM n GROUP BY t)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(t) AS text_sha256 FROM n JOIN g USING (t)
"""
