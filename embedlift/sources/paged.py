"""Pull records page by page through a function the caller provides.

``fetch(shard, cursor, limit)`` returns ``(rows, next_cursor)`` where each row
is ``(id, vector, metadata_json)`` and a ``None`` cursor ends the shard. Each
shard (a namespace, a key range) is one Spark partition; pages of a shard are
followed by the cursor the fetch returned. Metadata that is no JSON fails the read.

:func:`paged_stream` follows the same cursors as a stream: the token that a page returned is the
offset of its shard, so a query that is started again goes on with the first page it has not
committed. Pages that were stored as they came are read by :func:`paged_records`, or pulled one by
one through :func:`stored_pages`.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

from embedlift.functions import variants as V

_SCHEMA = "id string, vector array<float>, metadata string"


def paged_source(spark: SparkSession, fetch: Callable, shards: Sequence, page_size: int = 1000) -> DataFrame:
    shard_list = list(shards)

    class Pages(DataSourceReader):
        def partitions(self):
            return [InputPartition(shard) for shard in shard_list]

        def read(self, partition):
            cursor = None
            while True:
                rows, cursor = fetch(partition.value, cursor, page_size)
                yield from rows
                if cursor is None:
                    return

    label = f"embedlift_pages_{uuid.uuid4().hex}"

    class PagedRecords(DataSource):
        @classmethod
        def name(cls):
            return label

        def schema(self):
            return _SCHEMA

        def reader(self, schema):
            return Pages()

    spark.dataSource.register(PagedRecords)
    return spark.read.format(label).load().withColumn("metadata", F.parse_json("metadata"))


_START, _END = "start", "end"


def _file_system(path: str):
    """The Arrow file system and the path in it; a plain path is local."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


class _Position:
    """The last offset that was planned, as numbered files in a folder: none is overwritten."""

    def __init__(self, folder: str):
        self.system, self.folder = _file_system(folder)
        self.number = 0

    def _files(self) -> list[str]:
        from pyarrow import fs

        found = self.system.get_file_info(fs.FileSelector(self.folder, allow_not_found=True))
        return sorted(f.path for f in found if f.base_name.endswith(".json"))

    def load(self) -> dict | None:
        files = self._files()
        if not files:
            return None
        self.number = int(files[-1].rsplit("/", 1)[1].partition(".")[0])
        with self.system.open_input_stream(files[-1]) as stream:
            return json.loads(stream.read())

    def save(self, offset: dict) -> None:
        old = self._files()
        self.number += 1
        self.system.create_dir(self.folder, recursive=True)
        name = f"{self.folder}/{self.number:020d}"
        with self.system.open_output_stream(name) as stream:
            stream.write(json.dumps(offset).encode())
        self.system.move(name, f"{name}.json")   # complete or not there
        for path in old:
            self.system.delete_file(path)


def paged_stream(spark: SparkSession, fetch: Callable, shards: Sequence, position: str, page_size: int = 1000,
                 pages_per_batch: int = 10, advance: Callable | None = None) -> DataFrame:
    """Records of all shards as a stream of at most ``pages_per_batch`` pages of each shard.

    The offset of a shard is the token of the page to read next. To plan a batch the driver follows
    the tokens with ``advance(shard, cursor, limit)``, which returns the next token (a listing
    without vectors and metadata, where the store has one); without it ``fetch`` is called and its
    rows are dropped. Each shard's pages of a batch are then fetched by one task. Tokens have to
    stay valid, and lead to the same page, until their batch is committed.

    ``position`` is a folder, one for each query like its checkpoint: the end of the batch planned
    last, from which a query that is started again plans on. The batch itself is in the checkpoint,
    so a batch that failed is repeated with the same tokens and a committed page is not read again.
    """
    shard_list = list(shards)

    def after(shard, cursor):
        return advance(shard, cursor, page_size) if advance else fetch(shard, cursor, page_size)[1]

    class Pages(DataSourceStreamReader):
        def __init__(self):
            self.at, self.saved = None, _Position(position)

        def initialOffset(self):
            return {str(i): _START for i in range(len(shard_list))}

        def latestOffset(self):
            if self.at is None:
                self.at = self.saved.load() or self.initialOffset()

            def ahead(i: int) -> str:
                token = self.at.get(str(i), _START)
                for _ in range(pages_per_batch):
                    if token == _END:
                        break
                    following = after(shard_list[i], None if token == _START else json.loads(token))
                    token = _END if following is None else json.dumps(following)
                return token

            with ThreadPoolExecutor(16) as pool:
                return {str(i): token for i, token in enumerate(pool.map(ahead, range(len(shard_list))))}

        def partitions(self, start, end):
            if self.at is None:
                self.saved.load()
            if end != self.at:
                self.saved.save(end)
            self.at = end
            return [InputPartition((i, start.get(str(i), _START), end[str(i)])) for i in range(len(shard_list))
                    if start.get(str(i), _START) != end[str(i)]]

        def read(self, partition):
            i, token, end = partition.value
            while token != end:
                rows, following = fetch(shard_list[i], None if token == _START else json.loads(token), page_size)
                yield from rows
                token = _END if following is None else json.dumps(following)

    label = f"embedlift_page_stream_{uuid.uuid4().hex}"

    class PagedStream(DataSource):
        @classmethod
        def name(cls):
            return label

        def schema(self):
            return _SCHEMA

        def streamReader(self, schema):
            return Pages()

    spark.dataSource.register(PagedStream)
    return spark.readStream.format(label).load().withColumn("metadata", F.parse_json("metadata"))


def write_pages(pages: DataFrame, path: str) -> None:
    """Store pages (``shard, page, next, rows``; ``rows`` a JSON list) as one small file each, under their token."""
    line = F.to_json(F.struct(F.col("next").cast("string").alias("next"), "rows"))
    (pages.select("shard", F.col("page").cast("string").alias("page"), line.alias("value"))
     .repartition("shard", "page").write.partitionBy("shard", "page").text(path))


def stored_pages(path: str, first: str) -> Callable:
    """A ``fetch`` over the files of :func:`write_pages`; the page size is the one they were written with."""
    def fetch(shard, cursor, limit):
        from pyarrow import fs

        system, root = _file_system(path)
        folder = f"{root}/shard={shard}/page={first if cursor is None else cursor}"
        for info in system.get_file_info(fs.FileSelector(folder)):
            if info.base_name.startswith("part-"):
                with system.open_input_stream(info.path) as stream:
                    page = json.loads(stream.read())
                rows = [(str(r.pop("id")), r.pop("vector", None), json.dumps(r)) for r in json.loads(page["rows"])]
                return rows, page.get("next")
        raise FileNotFoundError(folder)

    return fetch


def paged_records(pages: DataFrame) -> DataFrame:
    """Records of stored pages: ``shard, page, next, rows``.

    ``rows`` is a JSON list of objects with ``id``, ``vector`` and further members, which become the
    metadata; ``next`` is the token of the page that follows in the shard. A page that another one
    names and that is not there fails the read, so a copy that stopped half way is noticed.
    """
    there = pages.select("shard", F.col("page").alias("next"), F.lit(True).alias("_there"))
    whole = pages.join(there, ["shard", "next"], "left").withColumn("rows", F.when(
        F.col("next").isNotNull() & F.col("_there").isNull(),
        F.raise_error(F.concat(F.lit("page is missing: "), F.col("shard").cast("string"), F.lit("/"), F.col("next").cast("string"))).cast("string")).otherwise(F.col("rows")))
    items = whole.select(F.explode(F.try_variant_get(F.parse_json("rows"), "$", "array<variant>")).alias("item"))
    rest = F.map_filter(V.as_map(F.col("item")), lambda k, _: ~k.isin("id", "vector"))
    return items.select(V.scalar_text(F.variant_get("item", "$.id", "variant")).alias("id"),
                        F.variant_get("item", "$.vector", "array<float>").alias("vector"), V.to_object(rest).alias("metadata"))
