"""Checksums of a collection as a tree, so that comparing two collections reads only what differs.

The tree has three levels: the collection, its buckets, and leaves. A leaf holds the records of a
bucket whose ids have an MD5 that begins with the same hexadecimal digits: their number and the sum of
their content hashes. Sums add up, so every level is the sum of the one below and the order of rows
does not matter.

A bucket's folder never changes once it is written, so its leaves are computed once and kept beside
the collection. The tree of a new version takes over every bucket whose folder is the same and reads
the records of the others only. Two trees are compared from the top: equal buckets are not opened, of
unequal ones the leaves are, and records are read and reconciled in unequal leaves only.

The driver holds one entry per bucket. Records without an id are a leaf of their own; repeated ids
count as often as they occur; a collection without rows has no buckets and equals another such one.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import asdict, dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from embedlift.operators.validate import content_hash, reconcile
from embedlift.sinks.buckets import BucketedCollection
from embedlift.sinks.commitlog import Files

_SUMS = ("n_records", "checksum")


def leaf_of(record_id: Column, digits: int) -> Column:
    return F.left(F.coalesce(F.md5(record_id), F.lit("")), F.lit(digits))


def leaf_sums(df: DataFrame, part: Column, digits: int = 3, row_hash: Column | None = None) -> DataFrame:
    """``part, leaf, n_records, checksum`` of the records of ``df``."""
    hashed = content_hash() if row_hash is None else row_hash
    return df.groupBy(part.alias("part"), leaf_of(F.col("id"), digits).alias("leaf")).agg(
        F.count(F.lit(1)).alias("n_records"), F.sum(hashed.cast("decimal(38,0)")).alias("checksum"))


def rolled_up(sums: DataFrame, *by: str) -> DataFrame:
    """The sums of a level above."""
    return sums.groupBy(*by).agg(*[F.sum(c).cast("decimal(38,0)" if c == "checksum" else "bigint").alias(c) for c in _SUMS])


@dataclass(frozen=True)
class Node:
    """A bucket: the folder of its records, that of its leaves, and their sums."""

    folder: str
    leaves: str
    n_records: int
    checksum: int

    @property
    def sums(self) -> tuple[int, int]:
        return self.n_records, self.checksum


_NONE = Node("", "", 0, 0)


class ChecksumTree:
    """The trees of a collection's versions. ``name`` stands for ``row_hash``: trees of another hash need another name.

    ``hashed`` lists the buckets whose records were read by this object, for those who want to know what a tree costs.
    """

    def __init__(self, collection: BucketedCollection, digits: int = 3, row_hash: Column | None = None, name: str = "content"):
        if row_hash is not None and name == "content":
            raise ValueError("a hash of its own needs a name of its own")
        self.collection, self.digits, self.row_hash, self.name = collection, digits, row_hash, name
        self._root = f"{collection.root}/checksums-{name}-{digits}"
        self._files = Files(collection.spark, self._root)
        self.hashed: list[int] = []

    def nodes(self, version: int | None = None) -> dict[int, Node]:
        """The buckets of a version, computed where they are not known yet."""
        version = self.collection.version() if version is None else version
        file = f"{version:020d}.json"
        saved = self._files.read(file)
        if saved is None:
            folders = self.collection.log.at(version).buckets
            known = self._nearest(file)
            fresh = sorted(b for b, folder in folders.items() if known.get(b, _NONE).folder != folder)
            nodes = {b: known[b] for b in folders if b not in fresh} | self._computed(version, {b: folders[b] for b in fresh})
            # whoever comes second has the same sums in other folders
            self._files.put_if_absent(file, json.dumps({b: asdict(n) for b, n in nodes.items()}))
            saved = self._files.read(file)
        return {int(b): Node(**n) for b, n in json.loads(saved).items()}

    def _nearest(self, file: str) -> dict[int, Node]:
        """The tree saved last before a version, else the first one after it."""
        saved = [n for n in self._files.names() if n.endswith(".json") and not n.startswith(".")]
        if not saved:
            return {}
        before = [n for n in saved if n < file]
        return {int(b): Node(**n) for b, n in json.loads(self._files.read(before[-1] if before else saved[0])).items()}

    def _computed(self, version: int, folders: dict[int, str]) -> dict[int, Node]:
        if not folders:
            return {}
        self.hashed += folders
        target = f"leaves/{uuid.uuid4().hex}"
        part = self.collection.bucket_of(F.col("id"))
        sums = leaf_sums(self.collection.snapshot(version, list(folders)), part, self.digits, self.row_hash)
        (sums.repartition(F.col("part")).sortWithinPartitions("part", "leaf").write.partitionBy("part").parquet(f"{self._root}/{target}"))
        written = self.collection.spark.read.schema(sums.schema).parquet(f"{self._root}/{target}")
        found = {r.part: Node(folders[r.part], f"{target}/part={r.part}", r.n_records, int(r.checksum)) for r in rolled_up(written, "part").collect()}
        return {b: found.get(b, Node(folder, "", 0, 0)) for b, folder in folders.items()}   # a bucket of delete marks has no leaf

    def leaves(self, version: int | None = None, buckets: list[int] | None = None) -> DataFrame:
        """``part, leaf, n_records, checksum`` of some buckets; no others are opened."""
        nodes = self.nodes(version)
        paths = [f"{self._root}/{n.leaves}" for b, n in sorted(nodes.items()) if n.leaves and (buckets is None or b in buckets)]
        spark = self.collection.spark
        if not paths:
            return spark.createDataFrame([], "part int, leaf string, n_records bigint, checksum decimal(38,0)")
        return (spark.read.option("basePath", self._root).schema("leaf string, n_records bigint, checksum decimal(38,0)").parquet(*paths)
                .select(F.regexp_extract(F.col("_metadata.file_path"), r"/part=(\d+)/[^/]*$", 1).cast("int").alias("part"), "leaf", *_SUMS))

    def root(self, version: int | None = None) -> tuple[int, int]:
        """Number of records and checksum of a whole version; nothing but the saved tree is read."""
        nodes = self.nodes(version).values()
        return sum(n.n_records for n in nodes), sum(n.checksum for n in nodes)


@dataclass(frozen=True)
class Difference:
    """Unequal ``buckets``, unequal leaves (``part, leaf``), and ``records`` (``id, status, source_copies, target_copies``) that are not the same."""

    buckets: list[int]
    leaves: DataFrame
    records: DataFrame


def difference(source: ChecksumTree, target: ChecksumTree, source_version: int | None = None, target_version: int | None = None) -> Difference:
    """What two collections, or two versions of one, do not have in common."""
    layout = [(t.collection.buckets, t.digits, t.name) for t in (source, target)]
    if layout[0] != layout[1]:
        raise ValueError(f"trees of unlike layout: {layout}")
    sides = [(source, source.collection.version() if source_version is None else source_version),
             (target, target.collection.version() if target_version is None else target_version)]
    mine, theirs = (tree.nodes(version) for tree, version in sides)
    buckets = sorted(b for b in mine.keys() | theirs.keys() if mine.get(b, _NONE).sums != theirs.get(b, _NONE).sums)
    signed = [tree.leaves(version, buckets).select("part", "leaf", *[(F.col(c) * sign).cast("decimal(38,0)").alias(c) for c in _SUMS])
              for (tree, version), sign in zip(sides, (1, -1))]
    leaves = rolled_up(signed[0].unionByName(signed[1]), "part", "leaf").filter("n_records <> 0 or checksum <> 0").select("part", "leaf")
    rows = []
    for tree, version in sides:
        own = tree.collection.snapshot(version, buckets).withColumns({"part": tree.collection.bucket_of(F.col("id")), "leaf": leaf_of(F.col("id"), tree.digits)})
        rows.append(own.join(leaves, ["part", "leaf"], "left_semi").drop("part", "leaf"))
    # records are told apart by what the tree hashes
    return Difference(buckets, leaves, reconcile(*rows, content=source.row_hash).filter("status <> 'matched'"))
