"""Secret scans: fixed patterns, and character Markov models compared by likelihood.

DataFrame functions only. The base kinds are regular expressions; where their matches lie is
worked out from the pieces that a split by the same expression leaves between them.

The method looks at every run of `RUN` characters or more of a key-like alphabet. Two
first-order Markov models over that alphabet give the log-likelihood ratio of the run,

    sum of log P(next | here, random strings) / P(next | here, ordinary identifiers),

and a run is reported, as kind `random`, when the ratio for each character is at least
`THRESHOLD` nats and the run doesn't touch a base span. The models are trained from labelled
samples: random strings are digests made here and the values of base spans; ordinary
identifiers are the words of `ORDINARY` characters or more outside base spans, alone and joined
with the next one as in identifiers (`JOINTS`). Both come from
at most `SAMPLE` documents, those with the smallest hash of their doc_id, and a random string
counts if it has at most `LONGEST` characters; what the driver reads is the table of transitions, whose size is the alphabet's square. Every run of every
text is then scored with it.

Defined results: a null text counts as empty, with no spans. Positions are code points, the
end exclusive. Repeated rows are scanned each. An empty table gives an empty result.
"""

from __future__ import annotations

from math import log

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import discard, documents, stage, text_of

KINDS = ("assign", "access", "hex", "random")
_EITHER = lambda word: "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)
NAMES = "|".join(("password", "passwd", "secret", "token", "api_?key"))
ASSIGN = rf"({_EITHER(NAMES)})[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
#: Runs are maximal, so their least length can stand in the pattern.
ACCESS, HEX = "AKIA[A-Z0-9]{16,}", "[0-9a-f]{24,}"
ASSIGN_LEAST = 6

ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
RUN, ORDINARY, THRESHOLD, SAMPLE, MADE, LONGEST = 16, 6, 0.8, 2_000, 2_000, 128
MICRO = 1_000_000
#: How identifiers are made of words.
JOINTS = ("", "_", "-", "/")
SPAN = "struct<start:int,kind:int,end:int,value:string>"


def scanned(items: Column, state: str, begin: Column, emit: str, step) -> Column:
    """What `step(state, item)`, a struct (state, emit), emits for each item, in order.

    An array that grows by one entry copies itself each time, so entries are gathered in blocks of
    about the root of their number, and the blocks put together at the end.
    """

    def blocks(all_items: Column) -> Column:
        size = F.greatest(F.lit(16), F.ceil(F.sqrt(F.size(all_items))).cast("int"))
        numbers = F.sequence(F.lit(0), F.floor((F.size(all_items) - 1) / size).cast("int"))
        return F.transform(numbers, lambda i: F.slice(all_items, i * size + 1, size))

    def gather(acc: Column, x: Column, step, kind: str) -> Column:
        return let(step(acc["state"], x), lambda r: F.struct(r["state"].alias("state"), F.concat(acc["out"], F.array(r["emit"].cast(kind))).alias("out")))

    def block(at: Column, part: Column) -> Column:
        inner = F.aggregate(part, empty(at, emit), lambda acc, x: gather(acc, x, step, emit))
        return let(inner, lambda r: F.struct(r["state"].alias("state"), r["out"].alias("emit")))

    empty = lambda at, kind: F.struct(at.cast(state).alias("state"), F.array().cast(f"array<{kind}>").alias("out"))
    put = lambda x: F.aggregate(blocks(x), empty(begin, f"array<{emit}>"), lambda acc, part: gather(acc, part, block, f"array<{emit}>"), lambda acc: F.flatten(acc["out"]))
    return let(items, lambda x: F.when(F.size(x) > 0, put(x)).otherwise(F.array().cast(f"array<{emit}>")))


def let(value: Column, body) -> Column:
    """`body(value)`, with the value computed once however often the body names it."""
    return F.transform(F.array(value), body)[0]


def matches(text: Column, pattern: str, kind: int, value_group: int = 0, least: int = 0) -> Column:
    """Spans (start, kind, end, value) of the non-overlapping matches, leftmost first."""
    whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    values = F.regexp_extract_all(text, F.lit(pattern), F.lit(value_group)) if value_group else whole
    between = F.transform(F.split(text, pattern, -1), lambda g: F.length(g))
    pieces = F.arrays_zip(F.transform(whole, lambda m: F.length(m)).alias("n"), values.alias("value"), between.alias("gap"))
    # One piece more than matches: what follows the last one.
    pieces = F.filter(pieces, lambda p: p["n"].isNotNull())

    def step(at: Column, p: Column) -> Column:
        start, end = at + p["gap"], at + p["gap"] + p["n"]
        span = F.struct(start.alias("start"), F.lit(kind).alias("kind"), end.alias("end"), p["value"].alias("value"))
        return F.struct(end.alias("state"), span.alias("emit"))

    spans = scanned(pieces, "int", F.lit(0), SPAN, step)
    if least:
        spans = F.filter(spans, lambda s: F.length(s["value"]) >= least)
    return F.when(F.regexp_like(text, F.lit(pattern)), spans).otherwise(F.array().cast(f"array<{SPAN}>"))


def with_base(docs: DataFrame) -> DataFrame:
    """doc_id, text, base: the base spans in order of start, then kind."""
    text = F.col("text")
    found = F.concat(matches(text, ASSIGN, 0, 2, ASSIGN_LEAST), matches(text, ACCESS, 1), matches(text, HEX, 2))
    return docs.select("doc_id", text_of(docs).alias("text")).withColumn("base", F.sort_array(found))


def outside(spans: Column, base: Column) -> Column:
    """The spans that touch no base span, by one pass over both in order.

    At a span's end, the base spans that start before it have been passed; the span touches one
    of them if the furthest of their ends lies behind its start.
    """
    ends = F.transform(spans, lambda s: F.struct(s["end"].alias("at"), F.lit(0).alias("base"), s["start"].alias("other"), s["value"].alias("value"), s["kind"].alias("kind")))
    starts = F.transform(base, lambda b: F.struct(b["start"].alias("at"), F.lit(1).alias("base"), b["end"].alias("other"), F.lit("").alias("value"), b["kind"].alias("kind")))

    def step(furthest: Column, e: Column) -> Column:
        free = (e["base"] == 0) & (furthest <= e["other"])
        span = F.struct(e["other"].alias("start"), e["kind"].alias("kind"), e["at"].alias("end"), e["value"].alias("value"))
        return F.struct(F.when(e["base"] == 1, F.greatest(furthest, e["other"])).otherwise(furthest).alias("state"), F.when(free, span).alias("emit"))

    free = scanned(F.sort_array(F.concat(ends, starts)), "int", F.lit(0), SPAN, step)
    return F.when(F.size(base) == 0, spans).otherwise(F.filter(free, lambda s: s.isNotNull()))


def pairs(value: Column) -> Column:
    """The numbers of neighbouring characters in the alphabet (from 1; 0 for others) as one number each."""
    numbers = F.transform(F.split(value, ""), lambda c: F.call_function("locate", c, F.lit(ALPHABET)))
    return F.zip_with(numbers, F.slice(numbers, 2, F.length(value)), lambda a, b: a * (len(ALPHABET) + 1) + b)


def transitions(strings: DataFrame) -> DataFrame:
    """pair, count of strings (value, n); the last character of a string has no pair."""
    each = strings.where(F.length("value") > 1).select("n", F.explode(pairs(F.col("value"))).alias("pair"))
    return each.where("pair IS NOT NULL").groupBy("pair").agg(F.sum("n").alias("count"))


def ordinary_strings(words: DataFrame) -> DataFrame:
    """Strings (value, n) that have the transitions of all words (word, next), alone and joined with the next by each of JOINTS.

    A word joined by a character keeps its own transitions and adds one before or after it, and in
    camel case each word is capitalised and one transition stands between the two. So each distinct
    word is taken once, by how often it stands alone and joined, and what is between by its two characters.
    """
    met = words.groupBy("word", "next").agg(F.count(F.lit(1)).alias("n"))
    joined = met.where("next IS NOT NULL")
    zero = F.lit(0).cast("bigint")
    ends = joined.select("word", zero.alias("alone"), F.col("n").alias("joined")).unionByName(joined.select(F.col("next").alias("word"), zero.alias("alone"), F.col("n").alias("joined")))
    of_word = met.select("word", F.col("n").alias("alone"), zero.alias("joined")).unionByName(ends).groupBy("word").agg(F.sum("alone").alias("alone"), F.sum("joined").alias("joined"))
    joints = [j for j in JOINTS if j]
    first, last = lambda c: F.substring(c, 1, 1), lambda c: F.substring(c, -1, 1)
    between = joined.groupBy(last(F.col("word")).alias("a"), first(F.col("next")).alias("b"), last(F.initcap("word")).alias("x"), first(F.initcap("next")).alias("y")).agg(F.sum("n").alias("n"))
    strings = of_word.select(F.explode(F.array(F.struct(F.col("word").alias("value"), (F.col("alone") + len(joints) * F.col("joined")).alias("n")), F.struct(F.initcap("word").alias("value"), F.col("joined").alias("n")))).alias("s"))
    around = [F.concat("x", "y"), *(F.concat("a", F.lit(j)) for j in joints), *(F.concat(F.lit(j), "b") for j in joints)]
    return strings.select("s.value", "s.n").where("n > 0").unionByName(between.select(F.explode(F.array(*around)).alias("value"), "n"))


def model(docs: DataFrame, sample: int = SAMPLE) -> list[int]:
    """Weight of each transition, in millionths of a nat, by `pair`."""
    ids = docs.select("doc_id").where("doc_id IS NOT NULL").distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    chosen = docs.join(F.broadcast(ids), "doc_id", "left_semi").select("doc_id", "text")  # at most `sample` ids
    tasks = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = with_base(chosen.repartition(tasks, F.xxhash64("doc_id", "text")))
    rest = F.regexp_replace("text", "|".join((ASSIGN, ACCESS, HEX)), " ")
    words = F.regexp_extract_all(rest, F.lit(f"[A-Za-z0-9_-]{{{ORDINARY},}}"), F.lit(0))
    keys = F.filter(F.array_distinct(F.transform("base", lambda b: b["value"])), lambda v: F.length(v) <= LONGEST)
    each = let(words, lambda w: F.arrays_zip(w.alias("word"), F.slice(w, 2, F.size(w)).alias("next")))
    found = stage(rows.select(each.alias("words"), keys.alias("keys")), "sample-strings")  # each text is looked through once
    ordinary = transitions(ordinary_strings(found.select(F.explode("words").alias("w")).select("w.word", "w.next")))
    digest = F.sha2(F.concat(F.lit("sample:"), F.col("id")), 256)
    made = docs.sparkSession.range(MADE).select(F.explode(F.array(digest, F.upper(digest), F.base64(F.unhex(digest)), F.base64(F.unhex(F.sha1(digest))))).alias("value"))
    random = transitions(found.select(F.explode("keys").alias("value")).unionByName(made).groupBy("value").agg(F.count(F.lit(1)).alias("n")))
    both = ordinary.withColumn("random", F.lit(False)).unionByName(random.withColumn("random", F.lit(True)))
    size = len(ALPHABET) + 1
    counts = {True: [0] * size**2, False: [0] * size**2}
    for r in both.collect():  # size ** 2 rows of each label at most
        counts[r["random"]][r["pair"]] = r["count"]
    discard(found)
    rates = {}
    for label, n in counts.items():
        rows_of = [n[i * size : (i + 1) * size] for i in range(size)]
        alone = [(sum(column) + 0.5) / (sum(n) + 0.5 * size) for column in zip(*rows_of, strict=True)]
        # Rare transitions are drawn towards how frequent the next character is.
        rates[label] = [log((x + size * p) / (sum(r) + size)) for r in rows_of for x, p in zip(r, alone, strict=True)]
    return [round((a - b) * MICRO) for a, b in zip(rates[True], rates[False], strict=True)]


def score(value: Column, weights: list[int]) -> Column:
    """Log-likelihood ratio of a string, in millionths of a nat for each character pair."""
    table = F.lit(weights)
    total = F.aggregate(pairs(value), F.lit(0).cast("bigint"), lambda acc, p: acc + F.coalesce(F.get(table, p).cast("bigint"), F.lit(0)))
    return total / (F.length(value) - 1)


def scan(docs: DataFrame, threshold: float = THRESHOLD, weights: list[int] | None = None) -> DataFrame:
    """doc_id and spans (start, kind, end, value) of all kinds, in order of start, then kind."""
    weights = weights if weights is not None else model(docs)
    rows = with_base(docs)
    runs = outside(matches(F.col("text"), f"[{ALPHABET.replace('-', '')}-]{{{RUN},}}", 3), F.col("base"))
    random = F.filter(runs, lambda s: score(s["value"], weights) >= threshold * MICRO)
    return rows.select("doc_id", "base", F.sort_array(F.concat("base", random)).alias("spans"))


def written(spans: Column) -> Column:
    kinds = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(kinds, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def found(docs: DataFrame) -> DataFrame:
    spans = scan(docs)
    count = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("bigint")
    return spans.select(
        "doc_id", *(count(k).alias(f"n_{KINDS[k]}") for k in range(3)), F.sha2(written(F.col("base")), 256).alias("base_sha256"), written(F.col("spans")).alias("spans")
    )


def op9_secret_scan(spark, sf_dir: str) -> DataFrame:
    return found(documents(spark, sf_dir))
