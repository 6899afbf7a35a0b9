"""The engine's queries over two snapshots derived from `documents`, and their SQL.

`source` plays the group and `doc_id` the key. The two views make every case occur: a group
that only the destination has (src7), one that only the source has (src5), one that exists
in the source but is empty (src13), and rows to insert, overwrite and delete.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions import paths
from tessera.operators import mirror as M
from tessera.plans.planner import plan_mirror, request
from tessera.sinks.table import mirror_table, read_table, table_snapshot
from tessera.sinks.tree import mirror_tree, write_tree
from tessera.sources.tree import read_tree
from tessera.staging import Scratch

LAYOUT = M.Layout(group="source", keys=("doc_id",))
TABLE = "doc_id bigint, payload bigint, source string"

VIEWS = """
WITH grp AS (SELECT DISTINCT source FROM documents WHERE source <> 'src7'),
     src AS (SELECT source, doc_id, n_chars AS payload FROM documents
             WHERE source NOT IN ('src7','src13') AND (doc_id // 20) % 10 <> 3),
     dst AS (SELECT source, doc_id,
                    CASE WHEN (doc_id // 20) % 10 = 6 THEN n_chars + 1 ELSE n_chars END AS payload
             FROM documents WHERE source <> 'src5' AND (doc_id // 20) % 10 <> 4)
"""
STALE = """FROM dst d WHERE source IN (SELECT source FROM grp)
  AND NOT EXISTS (SELECT 1 FROM src s WHERE s.source = d.source AND s.doc_id = d.doc_id)"""


def snapshots(spark: SparkSession, sf_dir: str) -> tuple[M.Snapshot, M.Snapshot]:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("source", "doc_id", "n_chars")
    part = F.expr("(doc_id div 20) % 10")
    src = docs.where(~F.col("source").isin("src7", "src13") & (part != 3)).withColumnRenamed("n_chars", "payload")
    dst = docs.where((F.col("source") != "src5") & (part != 4)).select(
        "source", "doc_id", F.when(part == 6, F.col("n_chars") + 1).otherwise(F.col("n_chars")).alias("payload")
    )
    return M.Snapshot.of(src, LAYOUT, docs.where("source <> 'src7'")), M.Snapshot.of(dst, LAYOUT)


def _planned(spark: SparkSession, d: str, *names: str, prune_orphans: bool = False):
    return plan_mirror(*snapshots(spark, d), names, prune_orphans=prune_orphans, check=False)


def _named(spark: SparkSession, d: str) -> DataFrame:
    src, _ = snapshots(spark, d)
    return M.select_groups(src, request(spark, ["src1", "src2"], "source")).entries


def _missing(spark: SparkSession, d: str) -> DataFrame:
    return M.missing_groups(request(spark, ["src1", "nope"], "source"), snapshots(spark, d)[0])


def _unlabelled(spark: SparkSession, d: str) -> DataFrame:
    labels = spark.read.parquet(f"{d}/labels.parquet").select("doc_id")
    return spark.read.parquet(f"{d}/documents.parquet").select("doc_id").join(labels, "doc_id", "left_anti")


def _table(spark: SparkSession, d: str) -> str:
    """The destination as a table, mirrored with all checks on; its path."""
    src, dst = snapshots(spark, d)
    path = Scratch(spark, "mirror-query").folder("table")
    dst.entries.write.partitionBy("source").parquet(path)
    mirror_table(src, path, TABLE)
    return path


def _table_groups(spark: SparkSession, d: str) -> DataFrame:
    table = table_snapshot(spark, _table(spark, d), TABLE, LAYOUT)
    counts = table.entries.groupBy("source").agg(F.count(F.lit(1)).alias("n_rows"))
    return M.ordered_groups(table).join(counts, "source", "left").fillna(0, ["n_rows"])


def _files(docs: DataFrame, text: Column) -> DataFrame:
    """A file for each document, in one of ten folders of its group."""
    path = paths.join(F.format_string("d%d", F.col("doc_id") % 10), F.format_string("%d.txt", F.col("doc_id")))
    return docs.select(F.col("source").alias("skill"), path.alias("rel_path"), F.lit(False).alias("is_dir"), F.encode(text, "UTF-8").alias("content"))


def _tree(spark: SparkSession, d: str) -> DataFrame:
    """Both snapshots as trees of files that hold the whole texts, mirrored; what the destination's tree has then."""
    docs, part = spark.read.parquet(f"{d}/documents.parquet"), F.expr("(doc_id div 20) % 10")
    root = re.sub("^file:/*", "/", Scratch(spark, "mirror-query").folder("trees"))
    text = F.coalesce("text", F.lit(""))
    write_tree(_files(docs.where(~F.col("source").isin("src7", "src13") & (part != 3)), text), f"{root}/src", ["src13"])
    write_tree(_files(docs.where((F.col("source") != "src5") & (part != 4)), F.when(part == 6, F.concat(text, F.lit("!"))).otherwise(text)), f"{root}/dst")
    mirror_tree(spark, f"{root}/src", f"{root}/dst")
    return read_tree(spark, f"{root}/dst", content=True, follow=False).entries.select("skill", "rel_path", "is_dir", F.sha2("content", 256).alias("sha256"))


Query = Callable[[SparkSession, str], DataFrame]
CATALOG: dict[str, tuple[Query, str]] = {
    "list_groups": (lambda s, d: M.ordered_groups(snapshots(s, d)[0]), VIEWS + "SELECT source FROM grp"),
    "select_named_groups": (_named, VIEWS + "SELECT * FROM src WHERE source IN ('src1','src2')"),
    "missing_named_groups": (
        _missing,
        VIEWS + "SELECT x AS source FROM (VALUES ('src1'),('nope')) t(x) WHERE x NOT IN (SELECT source FROM grp)",
    ),
    "stale_keys": (lambda s, d: _planned(s, d).stale(), VIEWS + "SELECT source, doc_id " + STALE),
    "prune_order": (
        lambda s, d: M.prune_order(_planned(s, d).stale(), LAYOUT),
        VIEWS + "SELECT source, doc_id, row_number() OVER (PARTITION BY source ORDER BY doc_id DESC) AS rn " + STALE,
    ),
    "orphan_groups_kept": (
        lambda s, d: M.kept_outside((p := _planned(s, d)).dst, p.selected),
        VIEWS + "SELECT * FROM dst WHERE source NOT IN (SELECT source FROM grp)",
    ),
    "action_plan": (
        lambda s, d: _planned(s, d).actions(),
        VIEWS
        + """SELECT coalesce(s.source, d.source) AS source, coalesce(s.doc_id, d.doc_id) AS doc_id,
       CASE WHEN coalesce(s.source, d.source) NOT IN (SELECT source FROM grp) THEN 'keep_orphan'
            WHEN s.doc_id IS NULL THEN 'delete' WHEN d.doc_id IS NULL THEN 'insert'
            ELSE 'overwrite' END AS action
FROM src s FULL OUTER JOIN dst d ON s.source = d.source AND s.doc_id = d.doc_id""",
    ),
    "copy_phase": (
        lambda s, d: M.copy_phase(*snapshots(s, d)),
        VIEWS
        + """SELECT * FROM src UNION ALL SELECT * FROM dst d
WHERE NOT EXISTS (SELECT 1 FROM src s WHERE s.source = d.source AND s.doc_id = d.doc_id)""",
    ),
    "mirror_all": (
        lambda s, d: _planned(s, d).result(),
        VIEWS + "SELECT * FROM src UNION ALL SELECT * FROM dst WHERE source NOT IN (SELECT source FROM grp)",
    ),
    "mirror_named": (
        lambda s, d: _planned(s, d, "src1", "src13").result(),
        VIEWS
        + """SELECT * FROM src WHERE source IN ('src1','src13')
UNION ALL SELECT * FROM dst WHERE source NOT IN ('src1','src13')""",
    ),
    "mirror_root": (lambda s, d: _planned(s, d, prune_orphans=True).result(), VIEWS + "SELECT * FROM src"),
    "mirror_table": (
        lambda s, d: read_table(s, _table(s, d), TABLE),
        VIEWS + "SELECT * FROM src UNION ALL SELECT * FROM dst WHERE source NOT IN (SELECT source FROM grp)",
    ),
    "table_groups": (
        _table_groups,
        VIEWS
        + """SELECT g.source, count(r.source) AS n_rows FROM (SELECT source FROM grp UNION SELECT source FROM dst) g
LEFT JOIN (SELECT source FROM src UNION ALL SELECT source FROM dst WHERE source NOT IN (SELECT source FROM grp)) r ON r.source = g.source
GROUP BY g.source""",
    ),
    "mirror_tree": (
        _tree,
        """
WITH f AS (SELECT source AS skill, doc_id % 10 AS folder, doc_id, coalesce(text, '') AS text FROM documents
           WHERE source NOT IN ('src7','src13') AND (doc_id // 20) % 10 <> 3
           UNION ALL SELECT source, doc_id % 10, doc_id, CASE WHEN (doc_id // 20) % 10 = 6 THEN coalesce(text, '') || '!' ELSE coalesce(text, '') END
           FROM documents WHERE source = 'src7' AND (doc_id // 20) % 10 <> 4)
SELECT skill, 'd' || folder || '/' || doc_id || '.txt' AS rel_path, false AS is_dir, sha256(text) AS sha256 FROM f
UNION ALL SELECT DISTINCT skill, 'd' || folder, true, NULL FROM f""",
    ),
    "status_report": (
        lambda s, d: _planned(s, d).status(),
        VIEWS
        + f"""SELECT g.source, coalesce(n_copied, 0) AS n_copied, coalesce(n_pruned, 0) AS n_pruned FROM grp g
LEFT JOIN (SELECT source, count(*) AS n_copied FROM src GROUP BY 1) c ON g.source = c.source
LEFT JOIN (SELECT source, count(*) AS n_pruned {STALE} GROUP BY 1) p ON g.source = p.source""",
    ),
    "unlabelled_documents": (
        _unlabelled,
        "SELECT doc_id FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)",
    ),
}
