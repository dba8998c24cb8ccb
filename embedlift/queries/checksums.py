"""Checksums of records: by group, as a tree, and as a way to find what two collections do not share."""

from __future__ import annotations

from pyspark.sql import functions as F

from embedlift.functions import variants as V
from embedlift.operators.checktree import ChecksumTree, difference, leaf_sums, rolled_up
from embedlift.operators.validate import content_checksum
from embedlift.queries import query
from embedlift.queries.stores import _DELTA_SQL, _delta
from embedlift.queries.tables import SRC_SQL, source_records, target_records
from embedlift.queries.validation import RECONCILE_SQL, SIDES
from embedlift.sinks.buckets import BucketedCollection
from embedlift.workspace import scratch_path

ROW_SQL = """('0x' || substr(md5(id || '|' || coalesce(lang, '') || '|' || coalesce(source, '') || '|' || coalesce(CAST(CAST(n_chars AS BIGINT) AS VARCHAR), '')
  || '|' || CAST(label AS VARCHAR) || '|' || coalesce(text, '') || '|' || array_to_string(list_transform(vec, lambda x: CAST(round(CAST(x AS DOUBLE) * 1000000) AS BIGINT)), ',')), 1, 8))::BIGINT"""


def row_hash():
    """A hash of all fields that SQL can compute as well."""
    field = lambda f, kind: F.coalesce(V.field(F.col("metadata"), f, kind).cast("string"), F.lit(""))
    numbers = F.array_join(F.transform("vector", lambda x: F.round(x.cast("double") * 1000000).cast("bigint").cast("string")), ",")
    n_chars = F.coalesce(V.field(F.col("metadata"), "n_chars", "double").cast("bigint").cast("string"), F.lit(""))
    digest = F.md5(F.concat_ws("|", "id", field("lang", "string"), field("source", "string"), n_chars, field("label", "int"), field("text", "string"), numbers))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint")


@query("checksum_tree_levels", f"""WITH {SRC_SQL}, hashed AS (SELECT md5(id) AS m, {ROW_SQL} AS h FROM src)
SELECT 'leaf' AS level, substr(m, 1, 3) AS node, count(*) AS n_records, CAST(sum(h) AS BIGINT) AS checksum FROM hashed GROUP BY 1, 2
UNION ALL SELECT 'part', substr(m, 1, 1), count(*), CAST(sum(h) AS BIGINT) FROM hashed GROUP BY 1, 2
UNION ALL SELECT 'root', '', count(*), CAST(sum(h) AS BIGINT) FROM hashed""")
def levels(spark, sf):
    leaves = leaf_sums(source_records(spark, sf), F.left(F.md5("id"), F.lit(1)), 3, row_hash())
    parts = rolled_up(leaves, "part")
    node = lambda df, level, name: df.select(F.lit(level).alias("level"), name.alias("node"), "n_records", F.col("checksum").cast("bigint").alias("checksum"))
    return node(leaves, "leaf", F.col("leaf")).unionByName(node(parts, "part", F.col("part"))).unionByName(node(rolled_up(parts), "root", F.lit("")))


@query("content_checksum_default", f"""{SIDES}, pair AS (
  SELECT coalesce(s.source, t.source, 'none') AS source, coalesce(s.label, t.label) AS label, s.id IS NOT NULL AS mine, t.id IS NOT NULL AS theirs,
         coalesce(s.vec = t.vec AND s.lang IS NOT DISTINCT FROM t.lang, false) AS same
  FROM src s FULL JOIN tgt t ON s.id = t.id)
SELECT source, label, count(*) FILTER (WHERE mine) AS n_source, count(*) FILTER (WHERE theirs) AS n_target, bool_and(same) AS equal FROM pair GROUP BY 1, 2""")
def default_checksums(spark, sf):
    """The default hash of all fields: groups of records have equal checksums where every record is the same, and nowhere else."""
    by = [F.coalesce(V.field(F.col("metadata"), "source", "string"), F.lit("none")).alias("source"), V.field(F.col("metadata"), "label", "int").alias("label")]
    mine, theirs = (content_checksum(df, by) for df in (source_records(spark, sf), target_records(spark, sf)))
    both = mine.withColumnsRenamed({"n_records": "n_source", "checksum": "mine"}).join(theirs.withColumnsRenamed({"n_records": "n_target", "checksum": "theirs"}), ["source", "label"], "full")
    count = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    return both.select("source", "label", count("n_source"), count("n_target"), F.col("mine").eqNullSafe(F.col("theirs")).alias("equal"))


def _tree(spark, records, label, buckets=64):
    store = BucketedCollection(spark, scratch_path(spark, label), buckets)
    store.upsert(records, unique=True)
    return ChecksumTree(store, digits=2)


@query("checksum_tree_diff", f"{RECONCILE_SQL}\nSELECT id, status FROM both_sides WHERE status <> 'matched'")
def unlike_records(spark, sf):
    """Two collections, compared by their trees."""
    return difference(_tree(spark, source_records(spark, sf), "tree-source"), _tree(spark, target_records(spark, sf), "tree-target")).records.select("id", "status")


@query("checksum_tree_versions", f"""WITH {SRC_SQL}, {_DELTA_SQL}
SELECT id, CASE WHEN id IN (SELECT id FROM src) THEN 'changed' ELSE 'extra_in_target' END AS status, true AS only_touched_buckets_hashed FROM delta""")
def changes_of_a_merge(spark, sf):
    """What a merge changed, from the trees of the versions before and after it; the second tree reads the merged buckets only."""
    tree = _tree(spark, source_records(spark, sf), "tree-versions", 256)
    before = tree.collection.version()
    delta = _delta(spark, sf)
    tree.nodes(before)
    tree.hashed.clear()
    after = tree.collection.upsert(delta, "delta", seq="seq")
    found = difference(tree, tree, before, after)
    touched = {r[0] for r in delta.select(tree.collection.bucket_of(F.col("id"))).distinct().collect()}
    return found.records.select("id", "status", F.lit(set(tree.hashed) == touched).alias("only_touched_buckets_hashed"))
