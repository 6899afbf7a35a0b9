"""Quality rules: counts of a text, and a log-likelihood ratio of hashed n-grams.

The method: words and word pairs are hashed into `BUCKETS` buckets. Two multinomials over the
buckets are compared, that of a trusted target (documents labelled as good) and that of the
raw corpus (all documents), and a text's score is the sum of log(target / raw) over its
n-grams divided by their number. A document stays when its score is at least `THRESHOLD`.

The query and the pipeline use `verdicts`: a document is scored by what the others say. Its own
n-grams are taken out of both multinomials, so its being in the target changes nothing; and
each bucket is drawn towards ratio 1 by `PRIOR` pseudo-counts against the count that the
target would have there if it were like the raw corpus, so a bucket with little evidence says
little, however small the target. Equal texts (by their 64-bit hash) count once in both
multinomials, in the target when one of them is, so copies don't turn against themselves; all
are scored. `PRIOR` was chosen with labels left out of the target, at
`THRESHOLD`: of the good documents left out, under 1% are rejected with 2 to 3,000 labels. With
few labels fewer of the bad ones are found. `judge` is the plain ratio, with own counts.

Everything is DataFrame functions, none of which looks each character up in a map, as `translate` does. The raw counts cover every n-gram of every document, the
buckets are summed within tasks before they move, and the table of counts has `BUCKETS` rows
whatever the input, which bounds what is broadcast (1 MB or so). Weights are integers
(millionths of a nat), so that scores don't depend on the order of summation.

The target is fitted on at most `TARGET_DOCS` labelled documents, those with the smallest
hash of their doc_id; their ids and the hashes of their texts are broadcast too. The table of
texts that occur more than once isn't bounded: Spark broadcasts it where it is small, else both
sides are shuffled.

Defined results: a null text counts as empty: no words, all counts 0, base_failed. Repeated
rows are documents of their own. Without usable labels all scores are 0 and only the base
rules decide. A null doc_id keeps its row and is labelled by nothing. Lines are equal when
their characters are; 5-word windows when their 64-bit hashes are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import SPACE, documents, stage, text_of

BUCKETS, TARGET_DOCS, THRESHOLD, PRIOR = 1 << 16, 20_000, -0.15, 10
MIN_WORDS, MAX_REPEAT_PERCENT, WINDOW = 10, 20, 5
SYMBOLS = "#*$%&|<>"
BLANKS = "\t\n\x0b\f\r "
MICRO = 1_000_000


def with_words(docs: DataFrame, *keep: str | Column) -> DataFrame:
    """Numbered rows with the text and its words, each computed once."""
    rows = docs.select(F.monotonically_increasing_id().alias("row"), *keep, text_of(docs).alias("text"))
    return rows.withColumn("words", F.array_remove(F.split("text", f"{SPACE}+"), ""))


def grams(words: Column, buckets: int) -> Column:
    """Bucket numbers of the words and of the pairs of neighbours."""
    bucket = lambda *w: F.coalesce(F.pmod(F.xxhash64(*w), F.lit(buckets)), F.lit(0))  # noqa: E731; never null, which sorts faster
    singles = F.transform(words, lambda w: bucket(w))
    heads = F.slice(words, 1, F.greatest(F.size(words) - 1, F.lit(0)))
    pairs = F.transform(heads, lambda w, i: bucket(w, F.get(words, i + 1)))
    return F.concat(singles, pairs)


def base_counts(rows: DataFrame) -> DataFrame:
    """Adds n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words and base_failed to rows with words."""
    words, text = F.col("words"), F.col("text")
    lines = F.filter(F.split(text, "\n"), lambda x: F.ltrim(x, F.lit(BLANKS)) != "")
    starts = F.slice(words, 1, F.greatest(F.size(words) - WINDOW + 1, F.lit(0)))
    window = lambda w, i: F.xxhash64(w, *[F.get(words, i + k) for k in range(1, WINDOW)])
    rows = rows.withColumn("lines", lines).withColumn("windows", F.transform(starts, window))
    # Only texts with a repeated window sort theirs; a window is repeated when a neighbour in that order equals it.
    some = F.size("windows") > F.size(F.array_distinct("windows"))
    in_order = F.array_sort(F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    rows = rows.withColumn("in_order", F.when(some, in_order))
    same = lambda x, k: F.get("in_order", k)["h"] == x["h"]
    twice = F.filter("in_order", lambda x, k: F.coalesce(same(x, k + 1), F.lit(False)) | ((k > 0) & F.coalesce(same(x, k - 1), F.lit(False))))
    at = F.array_sort(F.transform(twice, lambda x: x["i"]))
    start = F.struct(F.lit(0).alias("n"), F.lit(-WINDOW).alias("last"))
    covered = F.aggregate(at, start, lambda a, i: F.struct((a["n"] + F.least(F.lit(WINDOW), i - a["last"])).alias("n"), i.alias("last")), lambda a: a["n"])
    counted = rows.select(
        *[c for c in rows.columns if c not in ("lines", "windows", "in_order")],
        F.size(words).cast("bigint").alias("n_words"),
        F.length(F.array_join(words, "")).cast("bigint").alias("word_chars"),
        F.regexp_count(text, F.lit(f"[{SYMBOLS}]")).cast("bigint").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("bigint").alias("n_dup_lines"),
        F.coalesce(covered, F.lit(0)).cast("bigint").alias("n_repeat_words"),
    )
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    return counted.withColumn("base_failed", failed)


def target_ids(labels: DataFrame, at_most: int) -> DataFrame:
    """doc_ids of good documents, `at_most` of them."""
    good = labels.where((F.col("quality") == 1) & F.col("doc_id").isNotNull()).select("doc_id").distinct()
    return good.orderBy(F.xxhash64("doc_id"), "doc_id").limit(at_most)


def weights(docs: DataFrame, labels: DataFrame, buckets: int = BUCKETS, at_most: int = TARGET_DOCS) -> DataFrame:
    """bucket, weight (millionths of a nat): `buckets` rows at most."""
    chosen = F.broadcast(target_ids(labels, at_most).select(F.col("doc_id").alias("_good")))
    rows = with_words(docs, "doc_id").join(chosen, F.col("doc_id") == F.col("_good"), "left")
    each = rows.select(F.col("_good").isNotNull().cast("bigint").alias("good"), F.explode(grams(F.col("words"), buckets)).alias("bucket"))
    counts = each.groupBy("bucket").agg(F.count(F.lit(1)).alias("raw"), F.sum("good").alias("good"))
    counts = stage(counts, "gram-counts")
    n_raw, n_good = counts.agg(F.sum("raw"), F.sum("good")).first()
    p_raw = F.col("raw") / F.lit(n_raw or 1)
    p_good = (F.col("good") + buckets * p_raw) / F.lit((n_good or 0) + buckets)
    return counts.select("bucket", F.round(F.log(p_good / p_raw) * MICRO).cast("bigint").alias("weight"))


def judge(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, buckets: int = BUCKETS, also: dict[str, Column] | None = None) -> DataFrame:
    """The counts, score (nats per n-gram) and kept, one row for each row of `docs`; `also` are further columns by name."""
    table, also = F.broadcast(weights(docs, labels, buckets)), also or {}
    rows = base_counts(with_words(docs, "doc_id", *(c.alias(n) for n, c in also.items()))).withColumn("grams", grams(F.col("words"), buckets)).drop("words", "text")
    names = ["row", "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", *also]
    each = rows.select(*names, F.size("grams").cast("bigint").alias("n_grams"), F.explode_outer("grams").alias("bucket"))
    scored = each.join(table, "bucket", "left").groupBy(*names, "n_grams").agg(F.coalesce(F.sum("weight"), F.lit(0)).alias("total"))
    passed = F.col("total") >= F.lit(round(threshold * MICRO)) * F.col("n_grams")
    return scored.select(
        *names[1:],
        (~F.col("base_failed") & passed).alias("kept"),
        (F.col("total") / F.greatest(F.col("n_grams"), F.lit(1)) / MICRO).alias("score"),
    )


def text_groups(docs: DataFrame, labels: DataFrame, at_most: int) -> DataFrame:
    """_hash, _copies, _good (1 when a copy is in the target) of texts that occur more than once or are in the target."""
    chosen = F.broadcast(target_ids(labels, at_most).select(F.col("doc_id").alias("_id")))
    rows = docs.select("doc_id", F.xxhash64(text_of(docs)).alias("_hash")).join(chosen, F.col("doc_id") == F.col("_id"), "left")
    groups = rows.groupBy("_hash").agg(F.count(F.lit(1)).alias("_copies"), F.max(F.col("_id").isNotNull().cast("bigint")).alias("_good"))
    return stage(groups.where("_copies > 1 OR _good = 1"), "text-groups")


def verdicts(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, buckets: int = BUCKETS, also: dict[str, Column] | None = None, at_most: int = TARGET_DOCS) -> DataFrame:
    """As `judge`, each document by the counts of the others."""
    also, groups, key = also or {}, text_groups(docs, labels, at_most), F.xxhash64(text_of(docs))
    targets = F.broadcast(groups.where("_good = 1").select(F.col("_hash").alias("_target")))
    marked = docs.join(targets, key == F.col("_target"), "left").withColumn("_good", F.col("_target").isNotNull().cast("bigint"))
    counted = marked.join(groups.where("_copies > 1").select("_hash", "_copies"), key == F.col("_hash"), "left")
    share = F.lit(1.0) / F.coalesce("_copies", F.lit(1))  # of a text in each of its copies; their sums are whole numbers
    each = with_words(counted, "_good", share.alias("share")).select("_good", "share", F.explode(grams(F.col("words"), buckets)).alias("bucket"))
    whole = lambda c: F.round(F.sum(c)).cast("bigint")
    counts = stage(each.groupBy("bucket").agg(whole(F.col("share")).alias("raw"), whole(F.col("share") * F.col("_good")).alias("good")), "gram-counts")
    n_raw, n_good = counts.agg(F.coalesce(F.sum("raw"), F.lit(0)), F.coalesce(F.sum("good"), F.lit(0))).first()

    rows = base_counts(with_words(marked, "doc_id", "_good", *(c.alias(n) for n, c in also.items())))
    rows = rows.withColumn("grams", F.sort_array(grams(F.col("words"), buckets))).drop("words", "text")
    last = lambda i: F.get("grams", i).isNotNull() & ~F.get("grams", i + 1).eqNullSafe(F.get("grams", i))
    rows = rows.withColumn("ends", F.filter(F.sequence(F.lit(0), F.size("grams")), last))  # where the run of a bucket ends
    names = ["row", "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", *also]
    runs = rows.select(*names, "_good", F.size("grams").cast("bigint").alias("n_grams"), "grams", "ends", F.posexplode_outer("ends").alias("at", "end"))
    own = F.col("end") - F.coalesce(F.get("ends", F.col("at") - 1), F.lit(-1))
    runs = runs.select(*names, "_good", "n_grams", F.get("grams", "end").alias("bucket"), own.cast("bigint").alias("own"))

    expected = (n_good - F.col("_good") * F.col("n_grams")) * (F.col("raw") - F.col("own")) / F.greatest(n_raw - F.col("n_grams"), F.lit(1))
    weight = F.round(F.log((F.col("good") - F.col("_good") * F.col("own") + PRIOR) / (expected + PRIOR)) * MICRO).cast("bigint")
    scored = runs.join(F.broadcast(counts), "bucket", "left").groupBy(*names, "n_grams").agg(F.coalesce(F.sum(F.col("own") * weight), F.lit(0)).alias("total"))
    passed = F.col("total") >= F.lit(round(threshold * MICRO)) * F.col("n_grams")
    return scored.select(
        *names[1:],
        (~F.col("base_failed") & passed).alias("kept"),
        (F.col("total") / F.greatest(F.col("n_grams"), F.lit(1)) / MICRO).alias("score"),
    )


def op4_quality_rules(spark, sf_dir: str) -> DataFrame:
    return verdicts(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))
