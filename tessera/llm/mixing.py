"""Mixing sources to target weights by Pareto order sampling.

A source whose target is r times its size gives floor(r) whole copies of every document for
certain, and a sample of its documents once more. For the sample, documents are ranked by

    random odds / inclusion odds,   random odds = u / (1 - u),   u from the md5 of the doc_id,

and taken from the smallest up until the words that are left of the target are used: the
document that crosses the mark is taken when at least half of it still fits. The inclusion
odds are those of the source's fraction, f / (1 - f), times the document's length over its
source's mean length, held between 1/4 and 4, so the sample has unequal probabilities and
its size in words is fixed to within half a document.

Finding the mark takes no sort of a whole source: the logarithms of the ranks fall into bins,
`BINS` for each octave, words are summed by bin, and only the bin that holds the mark is put in
order. Whatever the fraction, a bin has at most ln 2 / 4 / `BINS` of a source's documents, or
0.02 %, so a hot source is one sum and a small sort. The mark is a row for each source; every
document is then held against its source's mark where it is read, and no text is moved.

Targets: the sources in the order of their names (code points, null last) weigh 5, 2, 1,
repeating; a target ends at 3 times its source's size, and what is over goes to the others
by weight until no target is above. That is min(3 * size, level * weight) for one level,
which sums over the sorted sources give without iteration. That table has one row for each
source and is sorted in one task, which bounds the number of sources to some tens of millions.

Defined results: a null or empty text has size 0 and is taken 0 words. A null source is a
source. A source without words has target 0. Documents without a doc_id draw by their text.
Of equal ranks the smaller doc_id comes first, then the shorter text, then the smaller hash of
the text; rows that are equal in all that are interchangeable, and as many of them as fit are
taken. Empty table, empty result. Extra columns are ignored, or kept by `take`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tessera.llm.common import discard, documents, stage, text_of

WEIGHTS, CAP, BINS, SEED = (5.0, 2.0, 1.0), 3, 1024, "mix"
#: What ranks a document within its source.
RANK = "struct<key:double,unnamed:boolean,doc_id:bigint,size:bigint,hash:bigint>"


def n_words(text: Column) -> Column:
    return F.size(F.filter(F.split(F.translate(text, "\t\n\x0b\f\r", "     "), " "), lambda w: w != "")).cast("bigint")


def targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, cap: int = CAP) -> DataFrame:
    """`sizes` (source, source_size, ...) with its target. One row per source; windows over sources only."""
    nth = (F.row_number().over(Window.orderBy(F.col("source").isNull(), "source")) - 1) % len(weights)
    weight = F.element_at(F.array(*map(F.lit, weights)), nth + 1)
    table = sizes.withColumn("weight", F.when(F.col("source_size") > 0, weight).otherwise(0.0))
    table = table.withColumn("ratio", F.when(F.col("weight") > 0, cap * F.col("source_size") / F.col("weight")))
    by_ratio = Window.orderBy(F.col("ratio").isNull(), "ratio", F.col("source").isNull(), "source")
    table = table.withColumn("rank", F.row_number().over(by_ratio))
    upto, whole = Window.orderBy("rank").rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy()
    left = F.sum("source_size").over(whole) - cap * F.coalesce(F.sum("source_size").over(upto), F.lit(0))
    share = F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(upto), F.lit(0.0))
    table = table.withColumn("level", F.when(share > 0, left / share))
    level = F.min(F.when(F.col("level") <= F.col("ratio"), F.struct("rank", "level"))).over(whole)["level"]
    aim = F.least(F.lit(float(cap)) * F.col("source_size"), level * F.col("weight"))
    return table.withColumn("target", F.when(F.col("source_size") == 0, 0.0).otherwise(aim)).drop("weight", "ratio", "rank", "level")


def uniform(doc_id: Column, text: Column, seed: str = SEED) -> Column:
    """A number in (0, 1) from 40 bits of an md5, the same in every run."""
    bits = F.conv(F.substring(F.md5(F.concat(F.lit(seed + ":"), F.coalesce(doc_id.cast("string"), F.md5(text)))), 1, 10), 16, 10)
    return (bits.cast("double") + 0.5) / float(2**40)


def measured(docs: DataFrame, *keep: Column) -> DataFrame:
    """doc_id, source, size, u and hash of each document."""
    text = text_of(docs)
    return docs.select(
        docs["doc_id"].cast("bigint").alias("doc_id"), docs["source"].alias("source"), n_words(text).alias("size"), uniform(docs["doc_id"], text).alias("u"), F.xxhash64(text).alias("hash"), *keep
    )


def ranked(rows: DataFrame, aims: DataFrame, bins: int) -> DataFrame:
    """`rows` with their source's aims, their rank and its bin. Ranks go by random odds over inclusion odds."""
    lean = F.greatest(F.lit(0.25), F.least(F.lit(4.0), (F.col("size") + 1) / F.col("mean")))
    inclusion = F.when(F.col("fraction") > 0, F.col("fraction") / (1 - F.col("fraction"))).otherwise(1.0) * lean
    both = rows.join(aims, F.col("source").eqNullSafe(F.col("_source"))).withColumn("key", F.col("u") / (1 - F.col("u")) / inclusion)
    rank = F.struct("key", F.col("doc_id").isNull().alias("unnamed"), F.coalesce("doc_id", F.lit(0)).alias("doc_id"), "size", "hash").cast(RANK)
    return both.withColumn("rank", rank).withColumn("bin", F.floor(F.log2("key") * bins))


def aims_of(rows: DataFrame, weights: tuple[float, ...], cap: int) -> DataFrame:
    """By source: size, target, whole copies (certain), the fraction and words that are left (rest), mean size plus one."""
    totals = rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n_docs"))
    aims = targets(totals, weights, cap)
    ratio = F.col("target") / F.greatest(F.col("source_size"), F.lit(1))
    aims = aims.withColumn("certain", F.floor(ratio)).select(
        F.col("source").alias("_source"),
        "source_size",
        "target",
        "certain",
        (ratio - F.col("certain")).alias("fraction"),
        ((F.col("source_size") + F.col("n_docs")) / F.col("n_docs")).alias("mean"),
        (F.col("target") - F.col("certain") * F.col("source_size")).alias("rest"),
    )
    return stage(aims, "targets")


def marked(rows: DataFrame, aims: DataFrame, bins: int) -> DataFrame:
    """`aims` with the bin and the rank of each source's last document that is taken, and how many of that rank are, of how many."""
    placed = ranked(rows.select("doc_id", "source", "size", "u", "hash"), aims.where("fraction > 0"), bins)
    by_bin = placed.groupBy("_source", "bin").agg(F.sum("size").alias("words"), F.first("rest").alias("rest"))
    running = Window.partitionBy("_source").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    by_bin = by_bin.withColumn("earlier", F.coalesce(F.sum("words").over(running), F.lit(0)))
    last = by_bin.where("earlier <= rest").groupBy("_source").agg(F.max(F.struct("bin", "earlier")).alias("m"))
    last = stage(last.select(F.col("_source").alias("_s"), F.col("m.bin").alias("mark_bin"), "m.earlier"), "mark-bins")
    in_bin = placed.join(last, F.col("_source").eqNullSafe(F.col("_s")) & (F.col("bin") == F.col("mark_bin")))
    before = F.coalesce(F.sum("size").over(Window.partitionBy("_source").orderBy("rank").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    fits = in_bin.withColumn("fits", (F.col("earlier") + before + F.col("size") / 2 <= F.col("rest")).cast("bigint"))
    of_rank = fits.groupBy("_source", "rank").agg(F.sum("fits").alias("n_taken"), F.count(F.lit(1)).alias("n_rank"))
    mark = of_rank.where("n_taken > 0").groupBy("_source").agg(F.max(F.struct("rank", "n_taken", "n_rank")).alias("m"))
    mark = mark.select(F.col("_source").alias("_t"), F.col("m.rank").alias("mark"), "m.n_taken", "m.n_rank")
    found = aims.join(last.drop("earlier"), F.col("_source").eqNullSafe(F.col("_s")), "left").join(mark, F.col("_source").eqNullSafe(F.col("_t")), "left")
    return stage(found.drop("_s", "_t"), "marks")


def with_copies(rows: DataFrame, marks: DataFrame, bins: int) -> DataFrame:
    """`rows` with `copies`: how often the mix takes each."""
    placed = ranked(rows, marks, bins)
    below = (F.col("bin") < F.col("mark_bin")) | ((F.col("bin") == F.col("mark_bin")) & (F.col("rank") < F.col("mark")))
    at = (F.col("bin") == F.col("mark_bin")) & (F.col("rank") == F.col("mark"))
    copies = lambda sampled: F.when(F.col("size") > 0, F.col("certain") + F.coalesce(sampled, F.lit(False)).cast("int")).otherwise(0).cast("int")
    if marks.where("n_taken < n_rank").isEmpty():
        return placed.withColumn("copies", copies(below | at))
    # Equal rows at a mark, of which some are taken: they are counted off.
    partly = F.coalesce(at & (F.col("n_taken") < F.col("n_rank")), F.lit(False))
    nth = F.row_number().over(Window.partitionBy("_source").orderBy("rank"))
    some = placed.where(partly).withColumn("copies", copies(nth <= F.col("n_taken")))
    return placed.where(~partly).withColumn("copies", copies(below | at)).unionByName(some)


def mix(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, cap: int = CAP, bins: int = BINS) -> DataFrame:
    """doc_id, size, source_size, target, taken, copies: a row for each row of `docs`."""
    rows = stage(measured(docs), "sizes")
    placed = with_copies(rows, marked(rows, aims_of(rows, weights, cap), bins), bins)
    return placed.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "copies")


def take(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, cap: int = CAP, bins: int = BINS) -> DataFrame:
    """The rows of `docs`, each as often as the mix takes it. Texts stay where they are read."""
    rows = stage(measured(docs), "sizes")
    marks = marked(rows, aims_of(rows, weights, cap), bins)
    discard(rows)
    placed = with_copies(measured(docs, F.struct(*docs.columns).alias("_document")), marks, bins).where("copies > 0")
    return placed.withColumn("_copy", F.explode(F.sequence(F.lit(1), "copies"))).select("_document.*")


def op6_mix_sources(spark, sf_dir: str) -> DataFrame:
    return mix(documents(spark, sf_dir))


SQL = f"""
WITH r AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS size,
         (('0x' || substr(md5('{SEED}:' || doc_id), 1, 10))::BIGINT::DOUBLE + 0.5) / 1099511627776.0 AS u FROM documents),
t AS (SELECT source, sum(size)::BIGINT AS source_size, count(*) AS n_docs FROM r GROUP BY source),
w AS (SELECT *, CASE WHEN source_size > 0 THEN [5.0, 2.0, 1.0][(row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3 + 1]::DOUBLE ELSE 0.0 END AS weight FROM t),
q AS (SELECT *, CASE WHEN weight > 0 THEN {CAP} * source_size / weight END AS ratio FROM w),
o AS (SELECT *, row_number() OVER (ORDER BY ratio IS NULL, ratio, source IS NULL, source) AS rank FROM q),
l AS (SELECT *, (sum(source_size) OVER () - {CAP} * coalesce(sum(source_size) OVER (ORDER BY rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
     / (sum(weight) OVER () - coalesce(sum(weight) OVER (ORDER BY rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS level FROM o),
a AS (SELECT *, CASE WHEN source_size = 0 THEN 0.0 ELSE least({CAP}.0 * source_size, (SELECT arg_min(level, rank) FROM l WHERE level <= ratio) * weight)::DOUBLE END AS target FROM l),
c AS (SELECT source, source_size, target, floor(target / greatest(source_size, 1)) AS certain,
      target / greatest(source_size, 1) - floor(target / greatest(source_size, 1)) AS fraction,
      (source_size + n_docs) / n_docs AS mean, target - floor(target / greatest(source_size, 1)) * source_size AS rest FROM a),
k AS (SELECT r.doc_id, r.size, c.*, u / (1 - u) / (CASE WHEN fraction > 0 THEN fraction / (1 - fraction) ELSE 1.0 END
      * greatest(0.25::DOUBLE, least(4.0::DOUBLE, (size + 1) / mean))) AS key
      FROM r JOIN c ON r.source IS NOT DISTINCT FROM c.source),
b AS (SELECT *, coalesce(sum(size) OVER (PARTITION BY source ORDER BY key, doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM k),
n AS (SELECT *, CASE WHEN size > 0 THEN (certain + (CASE WHEN fraction > 0 AND before + size / 2 <= rest THEN 1 ELSE 0 END))::BIGINT ELSE 0 END AS n FROM b)
SELECT doc_id, size, source_size, target, n * size AS taken, n::INTEGER AS copies FROM n
"""
