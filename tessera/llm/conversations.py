"""The prefix trie of conversations.

Every conversation is rebuilt as the contract says and becomes a path from the root; conversations
that start with the same turns share those nodes. A node is named by its smallest member and depth.

1. Turns become digests (SHA-256 of role and text) in the scan; no text moves after that. They are
   numbered within their conversation over all tasks (`tessera.operators.numbering`).
2. A prefix is named by the SHA-256 chain of its turns' digests. A long conversation is chained in
   blocks of `BLOCK` turns, and the chain of blocks in blocks again, so no task holds a conversation.
3. One aggregation by prefix digest gives the minima: the smallest conv_id with that prefix, its
   owner, and how many have it. What a conversation owns at one depth it owns at every deeper one,
   so its first owned depth is found by binary search: each round joins all conversations' middle
   depths with their digests and those with the minima. The rounds are as many as the longest
   conversation has bits.
4. The nodes that one conversation owns are a chain, from its first owned depth to its end; the chain
   hangs on a node of the chain that owns the depth before. Chains form a tree of their own.
5. Leaves and saved tokens are summed bottom-up over the tree of chains by doubling: in each round a
   chain takes in the sums of the chains twice as far below it, so the rounds are as many as the
   number of chains on the longest way has bits. Within a chain, sums run from the end to the top,
   in blocks as above.
6. The conversations that end at a node are sorted over all tasks; each task joins the numbers of
   what it holds of a node, at most `IDS` at a time, and the hash of a node reads these blocks in
   order as they stream by, so even a node at which a third of all conversations end is held nowhere.

The aggregations are by digest or (owner, depth) and combine within tasks first, so a first turn that
all conversations share costs a row a task.

Defined results: null role and text are empty; a null turn comes first; turns that tie in `turn` are
ordered by their digest; repeated rows are turns of their own. Rows with a null conv_id belong to no
conversation and are left out. An empty table gives an empty result, not even a root. conv_ids are
whole numbers; for negative ones `c % 100` is the remainder with the sign of c. Extra columns are
ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tessera.operators.numbering import numbered
from tessera.staging import Scratch

BLOCK, IDS, SHARED = 1024, 4096, 5
ROOT = b""


def turns_of(table: DataFrame, scratch: Scratch) -> DataFrame:
    """conv_id, pos (from 1), digest, n (code points of the text)."""
    role, text = F.coalesce(table["role"], F.lit("")), F.coalesce(table["text"], F.lit(""))
    rows = table.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("bigint").alias("conv_id"),
        "turn",
        F.unhex(F.sha2(F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text), 256)).alias("digest"),
        F.char_length(text).cast("bigint").alias("n"),
    )
    return numbered(rows, ["conv_id"], [F.col("turn").asc_nulls_first(), F.col("digest")], scratch, "pos").drop("turn")


def rebuilt(turns: DataFrame, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """(conv_id, depth, digest, n) of the rebuilt conversations' turns, and (conv_id, size), turnless ones included."""
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % (SHARED + 1)).cast("bigint")
    base = F.col("conv_id") - F.col("conv_id") % 100
    own = scratch.stage(turns.groupBy("conv_id").agg(F.max("pos").alias("own")), "conversations")
    there = own.select(F.col("conv_id").alias("base"), F.col("own").alias("has"))
    convs = own.withColumn("h", h).withColumn("base", base).join(there, "base", "left")
    convs = convs.withColumn("head", F.least("h", F.coalesce("has", F.lit(0)))).withColumn("size", F.col("head") + F.greatest(F.col("own") - F.col("h"), F.lit(0)))
    convs = scratch.stage(convs.select("conv_id", "base", "h", "head", "size"), "rebuilt-sizes")
    # At most SHARED turns of a base, and at most a hundred conversations on it.
    first = turns.where(F.col("pos") <= SHARED).select(F.col("conv_id").alias("base"), F.col("pos").alias("depth"), "digest", "n")
    heads = convs.where("head > 0").select("conv_id", "base", "head").join(first, "base").where("depth <= head").select("conv_id", "depth", "digest", "n")
    # Where the base has fewer turns than are taken from it, what follows moves up.
    short = convs.where("head < h").select("conv_id", (F.col("h") - F.col("head")).alias("less"))
    rest = turns.where(F.col("pos") > h).join(short, "conv_id", "left").select("conv_id", (F.col("pos") - F.coalesce("less", F.lit(0))).alias("depth"), "digest", "n")
    return scratch.stage(heads.unionByName(rest), "rebuilt"), convs.select("conv_id", "size")


def _chain(names: list[str]):
    """Digests chained in order of depth within each (conv_id, block), as rows stream by; the state goes from batch to batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state = None, b""
        for batch in batches:
            conv, block = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            out = []
            for c, b, digest in zip(conv, block, batch.column(3).to_pylist(), strict=True):
                if (c, b) != key:
                    key, state = (c, b), ROOT
                state = hashlib.sha256(state + digest).digest()
                out.append(state)
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(out, pa.binary()), *batch.columns[4:]], names)

    return run


def prefixes(turns: DataFrame, longest: int, scratch: Scratch) -> DataFrame:
    """conv_id, depth, digest (of the first `depth` turns), n (of the last of them), for depths from 1."""
    block = F.floor((F.col("depth") - 1) / BLOCK).cast("bigint")
    rows = turns.select("conv_id", block.alias("block"), "depth", "digest", "n").repartition("conv_id", "block").sortWithinPartitions("conv_id", "block", "depth")
    chained = scratch.stage(rows.mapInArrow(_chain(rows.columns), "conv_id bigint, block bigint, depth bigint, digest binary, n bigint"), "chains")
    if longest <= BLOCK:
        return chained.drop("block")
    whole = chained.where(F.col("depth") % BLOCK == 0).select("conv_id", (F.col("block") + 1).alias("depth"), "digest", F.lit(0).cast("bigint").alias("n"))
    before = prefixes(whole, longest // BLOCK, scratch).select("conv_id", F.col("depth").alias("block"), F.col("digest").alias("before"))
    joined = chained.join(before, ["conv_id", "block"], "left")  # at most BLOCK rows of a key
    digest = F.when(F.col("before").isNull(), F.col("digest")).otherwise(F.unhex(F.sha2(F.concat("before", "digest"), 256)))
    return scratch.stage(joined.select("conv_id", "depth", digest.alias("digest"), "n"), "prefixes")


def first_owned(convs: DataFrame, prefix: DataFrame, minima: DataFrame, longest: int, scratch: Scratch) -> DataFrame:
    """conv_id, size, first (size + 1 where it owns nothing), up (owner of the node at depth first - 1; null for the root's)."""
    prefix, owner = prefix.select("conv_id", "depth", "digest"), minima.select("digest", "owner")
    # The root is owned by the smallest conversation alone; every other one begins with depth 1.
    root = minima.where("depth = 0").first()["owner"]
    known = convs.select("conv_id", "size", F.when(F.col("conv_id") == root, 0).otherwise(1).cast("bigint").alias("low"), F.when(F.col("conv_id") == root, 0).otherwise(F.col("size") + 1).cast("bigint").alias("high"))
    for _ in range(longest.bit_length()):
        middle = F.floor((F.col("low") + F.col("high")) / 2).cast("bigint")
        probes = known.where("low < high").withColumn("depth", middle).join(prefix, ["conv_id", "depth"]).join(owner, "digest")
        owns = F.col("owner") == F.col("conv_id")
        moved = probes.select("conv_id", "size", F.when(owns, F.col("low")).otherwise(F.col("depth") + 1).alias("low"), F.when(owns, F.col("depth")).otherwise(F.col("high")).alias("high"))
        known = scratch.stage(moved.unionByName(known.where("low >= high")), "search")
    found = known.select("conv_id", "size", F.col("low").alias("first"))
    at = found.withColumn("depth", F.col("first") - 1)
    above = at.where("depth > 0").join(prefix, ["conv_id", "depth"]).join(owner, "digest").select("conv_id", "size", "first", F.col("owner").alias("up"))
    on_root = at.where("depth <= 0").select("conv_id", "size", "first", F.when(F.col("first") == 1, F.lit(root)).cast("bigint").alias("up"))
    return scratch.stage(above.unionByName(on_root), "chains-found")


def chain_sums(chains: DataFrame, scratch: Scratch) -> DataFrame:
    """conv_id, up, first, leaves, saved: the sums of each chain and of all chains that hang on it, directly or by others."""
    known = scratch.stage(chains.withColumn("above", F.col("up")), "sums")
    while not known.where("above IS NOT NULL").isEmpty():
        # `above` is 2**k chains up, and the sums are of the chains fewer than 2**k below.
        below = known.where("above IS NOT NULL").groupBy(F.col("above").alias("conv_id")).agg(F.sum("leaves").alias("l"), F.sum("saved").alias("s"))
        next_up = known.select(F.col("conv_id").alias("above"), F.col("above").alias("further"))
        going = known.where("above IS NOT NULL").join(next_up, "above").drop("above")
        taken = going.unionByName(known.where("above IS NULL").withColumnRenamed("above", "further")).join(below, "conv_id", "left")
        add = lambda c, more: (F.col(c) + F.coalesce(more, F.lit(0))).alias(c)
        known = scratch.stage(taken.select("conv_id", "up", "first", add("leaves", "l"), add("saved", "s"), F.col("further").alias("above")), "sums")
    return known.drop("above")


def from_the_end(nodes: DataFrame, columns: list[str], longest: int, scratch: Scratch) -> DataFrame:
    """Each of `columns` becomes its sum over this node and the deeper ones of its chain (owner), in blocks of depth."""
    block = F.floor(F.col("depth") / BLOCK).cast("bigint")
    nodes = nodes.withColumn("block", block)
    inside = Window.partitionBy("owner", "block").orderBy(F.col("depth").desc())  # at most BLOCK rows
    for c in columns:
        nodes = nodes.withColumn(c, F.sum(c).over(inside))
    if longest < BLOCK:
        return nodes.drop("block")
    nodes = scratch.stage(nodes, "block-sums")
    totals = nodes.groupBy("owner", "block").agg(*(F.min_by(c, "depth").alias(c) for c in columns))
    deeper = from_the_end(totals.withColumnRenamed("block", "depth"), columns, longest // BLOCK, scratch)
    later = deeper.select("owner", (F.col("depth") - 1).alias("block"), *(F.col(c).alias(f"_{c}") for c in columns))
    joined = nodes.join(later, ["owner", "block"], "left")
    return joined.select(*(F.col(c) + F.coalesce(f"_{c}", F.lit(0)) if c in columns else F.col(c) for c in nodes.columns if c != "block")).toDF(*(c for c in nodes.columns if c != "block"))


def _joined_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """owner, depth, first, ids: the decimal conv_ids of each run of a node, comma-joined, at most IDS together."""
    for batch in batches:
        owner, depth, conv = (batch.column(i).to_numpy() for i in range(3))
        if not len(conv):
            continue
        starts = np.concatenate([[0], np.flatnonzero((owner[1:] != owner[:-1]) | (depth[1:] != depth[:-1])) + 1])
        stops = np.append(starts[1:], len(conv))
        pieces = [(a, min(a + IDS, stop)) for start, stop in zip(starts.tolist(), stops.tolist(), strict=True) for a in range(start, stop, IDS)]
        at = [a for a, _ in pieces]
        text = [",".join(map(str, conv[a:b].tolist())) for a, b in pieces]
        yield pa.RecordBatch.from_arrays([pa.array(owner[at]), pa.array(depth[at]), pa.array(conv[at]), pa.array(text, pa.string())], ["owner", "depth", "first", "ids"])


def _hashed_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """owner, depth, ends_sha256 from the blocks of each node in order; only the hash's state is held."""
    key, state, names = None, None, ["owner", "depth", "ends_sha256"]
    pack = lambda rows: pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int64()), pa.array([r[2] for r in rows], pa.string())], names)
    for batch in batches:
        done = []
        for owner, depth, ids in zip(*(batch.column(i).to_pylist() for i in (0, 1, 3)), strict=True):
            if (owner, depth) == key:
                state.update(b"," + ids.encode())
                continue
            if key:
                done.append((*key, state.hexdigest()))
            key, state = (owner, depth), hashlib.sha256(ids.encode())
        yield pack(done)
    if key:
        yield pack([(*key, state.hexdigest())])


def ends_of(chains: DataFrame) -> DataFrame:
    """owner, depth, ends_sha256 of the nodes at which conversations end."""
    end = chains.select(F.when(F.col("first") <= F.col("size"), F.col("conv_id")).otherwise(F.col("up")).alias("owner"), F.col("size").alias("depth"), "conv_id")
    spread = end.repartitionByRange("owner", "depth", "conv_id").sortWithinPartitions("owner", "depth", "conv_id")
    blocks = spread.mapInArrow(_joined_ids, "owner bigint, depth bigint, first bigint, ids string")
    return blocks.repartition("owner", "depth").sortWithinPartitions("owner", "depth", "first").mapInArrow(_hashed_ids, "owner bigint, depth bigint, ends_sha256 string")


def trie(table: DataFrame) -> DataFrame:
    """conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256: a row for each node."""
    scratch = Scratch(table.sparkSession, "conversation-trie")
    turns, convs = rebuilt(turns_of(table, scratch), scratch)
    longest = convs.agg(F.max("size")).first()[0] or 0
    prefix = prefixes(turns, longest, scratch)
    rooted = prefix.unionByName(convs.select("conv_id", F.lit(0).cast("bigint").alias("depth"), F.lit(ROOT).alias("digest"), F.lit(0).cast("bigint").alias("n")))
    # All prefixes with a digest have one depth, and one n.
    minima = scratch.stage(rooted.groupBy("digest", "depth", "n").agg(F.min("conv_id").alias("owner"), F.count(F.lit(1)).alias("n_convs")), "minima")
    if minima.isEmpty():
        scratch.drop()
        return table.sparkSession.createDataFrame([], "conv_id bigint, depth bigint, parent_conv_id bigint, n_convs bigint, n_children bigint, n_leaves bigint, saved_tokens bigint, ends_sha256 string")
    found = first_owned(convs, prefix, minima, longest, scratch)
    chains = found.where("first <= size")
    saved = (F.col("n_convs") - 1) * F.col("n")
    nodes = minima.select("owner", "depth", "n_convs", saved.alias("saved"))
    own = nodes.groupBy("owner").agg(F.sum("saved").alias("saved"))
    hung = chains.where("first > 0").select(F.col("up").alias("owner"), (F.col("first") - 1).alias("depth")).groupBy("owner", "depth").agg(F.count(F.lit(1)).alias("kids"))
    last = chains.select(F.col("conv_id").alias("owner"), F.col("size").alias("depth")).join(hung, ["owner", "depth"], "left")
    leaf = last.select("owner", F.when(F.col("kids").isNull(), 1).otherwise(0).cast("bigint").alias("leaves"))
    totals = chain_sums(chains.select(F.col("conv_id").alias("owner"), "up", "first").join(own, "owner").join(leaf, "owner").select(F.col("owner").alias("conv_id"), "up", "first", "leaves", "saved"), scratch)
    no = F.lit(None).cast("bigint")
    marks = [
        chains.select(F.col("conv_id").alias("owner"), F.col("first").alias("depth"), F.col("up"), no.alias("last"), no.alias("kids"), no.alias("leaves"), no.alias("below")),
        chains.select(F.col("conv_id").alias("owner"), F.col("size").alias("depth"), no.alias("up"), F.lit(1).cast("bigint").alias("last"), no.alias("kids"), no.alias("leaves"), no.alias("below")),
        totals.where("first > 0").select(F.col("up").alias("owner"), (F.col("first") - 1).alias("depth"), no.alias("up"), no.alias("last"), F.lit(1).cast("bigint").alias("kids"), "leaves", F.col("saved").alias("below")),
    ]
    marks = marks[0].unionByName(marks[1]).unionByName(marks[2]).groupBy("owner", "depth").agg(F.max("up").alias("up"), F.max("last").alias("last"), F.sum("kids").alias("kids"), F.sum("leaves").alias("leaves"), F.sum("below").alias("below"))
    zero = lambda c: F.coalesce(c, F.lit(0))
    marked = nodes.join(marks, ["owner", "depth"], "left")
    children = zero("kids") + F.when(F.col("last").isNull(), 1).otherwise(0)
    marked = marked.select("owner", "depth", "up", "n_convs", children.alias("n_children"), (zero("leaves") + F.when(children == 0, 1).otherwise(0)).alias("n_leaves"), (F.col("saved") + zero("below")).alias("saved_tokens"))
    summed = from_the_end(marked, ["n_leaves", "saved_tokens"], longest, scratch)
    joined = summed.join(ends_of(found), ["owner", "depth"], "left")
    out = joined.select(
        F.col("owner").alias("conv_id"),
        "depth",
        F.when(F.col("depth") > 0, F.coalesce("up", "owner")).alias("parent_conv_id"),
        "n_convs",
        *(F.col(c).cast("bigint").alias(c) for c in ("n_children", "n_leaves", "saved_tokens")),
        F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"),
    )
    out = Scratch(table.sparkSession, "conversation-nodes").stage(out, "nodes")
    scratch.drop()
    return out


def op12_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


#: By brute force, every prefix spelled out. crc32 is worked out bit by bit, as DuckDB has none.
SQL = f"""
WITH t AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, d) AS pos, d, n FROM (
             SELECT conv_id, turn, length(coalesce(text, '')) AS n, sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS d
             FROM conversations WHERE conv_id IS NOT NULL)),
     o AS (SELECT conv_id, count(*) AS own, conv_id - conv_id % 100 AS base,
                  xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(1, length(conv_id::VARCHAR) + 1), lambda i: ord(substr(conv_id::VARCHAR, i, 1))::BIGINT)),
                      lambda c, b: list_reduce(list_prepend(xor(c, b), range(8)), lambda x, i: xor(x // 2, CASE WHEN x % 2 = 1 THEN 3988292384 ELSE 0 END)::BIGINT)), 4294967295) % {SHARED + 1} AS h
           FROM t GROUP BY conv_id),
     c AS (SELECT o.*, least(o.h, coalesce(b.own, 0)) AS head FROM o LEFT JOIN o b ON o.base = b.conv_id),
     r AS (SELECT c.conv_id, pos AS depth, d, n FROM c JOIN t ON t.conv_id = c.base WHERE pos <= h
           UNION ALL SELECT c.conv_id, pos - h + head, d, n FROM c JOIN t ON t.conv_id = c.conv_id WHERE pos > h),
     p AS (SELECT conv_id, depth, n, string_agg(d, '') OVER (PARTITION BY conv_id ORDER BY depth) AS k FROM r UNION ALL SELECT conv_id, 0, 0, '' FROM c),
     e AS (SELECT conv_id, max(depth) AS size, max_by(k, depth) AS k FROM p GROUP BY conv_id),
     nodes AS (SELECT k, depth, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(n) * (count(*) - 1) AS own FROM p GROUP BY k, depth),
     kids AS (SELECT left(k, 64 * (depth - 1)::BIGINT) AS k, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY 1),
     tree AS (SELECT nodes.*, coalesce(n_children, 0) AS n_children FROM nodes LEFT JOIN kids USING (k)),
     sums AS (SELECT left(k, 64 * a::BIGINT) AS k, sum(own) AS saved_tokens, count(*) FILTER (n_children = 0) AS n_leaves FROM tree, unnest(range(0, depth + 1)) AS u(a) GROUP BY 1),
     ends AS (SELECT k, string_agg(conv_id, ',' ORDER BY conv_id) AS ids FROM e GROUP BY k)
SELECT x.conv_id, x.depth::BIGINT AS depth, y.conv_id AS parent_conv_id, x.n_convs, x.n_children, n_leaves, saved_tokens::BIGINT AS saved_tokens, sha256(coalesce(ids, '')) AS ends_sha256
FROM tree x JOIN sums USING (k) LEFT JOIN ends USING (k) LEFT JOIN tree y ON x.depth > 0 AND y.k = left(x.k, 64 * (x.depth - 1)::BIGINT)
"""
