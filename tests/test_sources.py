import json
import os

import pytest
from pyspark.sql import functions as F

from embedlift.functions import variants as V
from embedlift.sources.batches import assign_batches, get_batch, number_in_order, range_bounds, resume_filter
from embedlift.sources.checks import check_source
from embedlift.sources.paged import paged_source
from embedlift.sources.records import (read_milvus, read_pinecone, read_qdrant, read_weaviate, records_with_rejects)


@pytest.fixture()
def stored(tmp_path):
    """Write JSON documents, one file each (or all as lines of one file)."""
    def put(*docs, lines=False):
        folder = tmp_path / "in"
        os.makedirs(folder, exist_ok=True)
        texts = [d if isinstance(d, str) else json.dumps(d, indent=None if lines else 1) for d in docs]
        if lines:
            (folder / "all.json").write_text("\n".join(texts))
        else:
            for i, text in enumerate(texts):
                (folder / f"{i}.json").write_text(text)
        return str(folder)
    return put


def rows(df):
    return {r["id"]: (r["vector"], r["m"]) for r in df.select("id", "vector", F.to_json("metadata").alias("m")).collect()}


def test_pinecone_pages_and_lines(spark, stored):
    page = {"vectors": [{"id": "a", "values": [1, 2.5], "metadata": {"x": 1, "t": ["p"]}}, {"id": "b", "values": [3]}, {"id": ""}],
            "namespace": "n", "pagination": {"next": "tok"}}
    got = read_pinecone(spark, stored(page), multiline=True)
    assert rows(got) == {"a": ([1.0, 2.5], '{"t":["p"],"x":1}'), "b": ([3.0], None)} and {r["namespace"] for r in got.collect()} == {"n"}


def test_pinecone_single_records_with_sparse_values(spark, stored):
    line = {"id": "a", "values": [1], "sparse_values": {"indices": [7], "values": [0.5]}, "metadata": {}}
    got = read_pinecone(spark, stored(line, lines=True)).first()
    assert got["sparse"]["indices"] == [7] and got["sparse"]["values"] == [0.5]


def test_qdrant(spark, stored):
    page = {"result": {"points": [{"id": 7, "vector": [1], "payload": {"a": {"b": 1}}}, {"id": "u-1", "vector": None, "payload": None}]}}
    assert rows(read_qdrant(spark, stored(page), multiline=True)) == {"7": ([1.0], '{"a":{"b":1}}'), "u-1": (None, None)}


def test_weaviate_page_rules(spark, stored):
    items = [{"_additional": {"id": "a", "vector": [1, "x", None, 2.5]}, "title": "T", "n": 3}, {"title": "no id"}, 17,
             {"_additional": {"id": "", "vector": []}}, {"_additional": {"id": "b"}}]
    path = stored({"data": {"Get": [{"Doc": items, "Other": [{"_additional": {"id": "o"}}]}]}})
    assert rows(read_weaviate(spark, path, "Doc", multiline=True)) == {
        "a": ([1.0, 0.0, 0.0, 2.5], '{"n":3,"title":"T"}'), "b": (None, "{}")}
    assert set(rows(read_weaviate(spark, path, multiline=True))) == {"a", "b", "o"}
    assert rows(read_weaviate(spark, path, "Absent", multiline=True)) == {}


def test_weaviate_errors_fail_the_read(spark, stored):
    path = stored({"data": {"Get": []}, "errors": [{"message": "boom"}]}, {"data": {"Get": [{"D": [{"_additional": {"id": "a"}}]}]}})
    with pytest.raises(Exception, match="boom"):
        read_weaviate(spark, path, "D", multiline=True).collect()


def test_weaviate_plain_objects(spark, stored):
    line = {"class": "D", "id": "a", "vector": [1], "properties": {"k": True}}
    assert rows(read_weaviate(spark, stored(line, lines=True))) == {"a": ([1.0], '{"k":true}')}


def test_milvus(spark, stored):
    line = {"id": 5, "embedding": [1, 2], "k": 1, "dyn": "x", "metadata_json": {"k": 9, "nested": {"d": 1}}}
    assert rows(read_milvus(spark, stored(line, lines=True))) == {"5": ([1.0, 2.0], '{"dyn":"x","k":1,"nested":{"d":1}}')}


def test_bad_json_goes_to_rejects(spark):
    df = spark.sql("""SELECT * FROM VALUES ('ok', '{"a": 1}'), ('bad', '{'), ('twice', '{"a": 1, "a": 2}'), ('null', NULL) AS t(id, metadata)""")
    good, rejects = records_with_rejects(df)
    assert sorted(r["id"] for r in good.collect()) == ["null", "ok"]
    assert sorted(r["record_id"] for r in rejects.collect()) == ["bad", "twice"]


def test_keyset_pages_cover_everything_once(spark):
    df = spark.range(25).select(F.lpad(F.col("id").cast("string"), 3, "0").alias("id"))
    seen, after = [], None
    while True:
        page = [r["id"] for r in get_batch(df, after, 10).collect()]
        if not page:
            break
        seen += page
        after = page[-1]
    assert seen == [f"{i:03d}" for i in range(25)]
    assert [r["id"] for r in resume_filter(df, "022").collect()] == ["023", "024"]


def test_batches_number_copies_of_one_id_too(spark):
    df = spark.range(1000).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(F.lpad(F.col("id").cast("string"), 5, "0")).alias("id"))
    got = assign_batches(df, 64, partitions=7).groupBy("batch_no").count().orderBy("batch_no").collect()
    assert [r["count"] for r in got] == [64] * 15 + [40]
    split = number_in_order(df, "id", name="n", partitions=7, hot_copies=100)
    assert sorted(r["n"] for r in split.collect()) == list(range(1000)) and split.columns == ["id", "n"]


def test_ranges_of_ids(spark):
    df = spark.range(1000).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(F.lpad(F.col("id").cast("string"), 5, "0")).alias("id"))
    bounds = range_bounds(df, 4, 10)
    assert bounds == sorted(bounds) and len(bounds) <= 3
    cuts = [None, *bounds, None]
    parts = [df.filter((F.col("id") > low) if low else F.lit(True)).filter((F.col("id") <= high) if high else F.lit(True)).count()
             for low, high in zip(cuts, cuts[1:])]
    assert sum(parts) == 1000 and all(parts)
    assert range_bounds(df.filter("false"), 4) == [] and range_bounds(df, 1) == []


def test_check_source(spark, records):
    df = records([("a", [1.0], "{}"), ("a", [1.0, 2.0], "{}"), (None, None, None), ("", [1.0], None)])
    got = check_source(df, "qdrant").first()
    assert (got["total_records"], got["missing_ids"], got["repeated_ids"], got["null_vectors"], got["min_dim"], got["max_dim"], got["ok"]) == (
        4, 2, 1, 1, 1, 2, False)
    assert check_source(df.filter("false"), "qdrant").first()["ok"]
    with pytest.raises(ValueError, match="unknown database type"):
        check_source(df, "redis")


def test_pages_follow_the_returned_cursor(spark):
    def fetch(shard, cursor, limit):
        tokens = {None: ([0, 1], "x9"), "x9": ([2], "a"), "a": ([], None)}
        numbers, following = tokens[cursor]
        return [(f"{shard}-{n}", [float(n)], '{"n": %d}' % n) for n in numbers], following

    got = paged_source(spark, fetch, ["s", "t"], 2)
    assert sorted(r["id"] for r in got.select("id", V.field(F.col("metadata"), "n", "int")).collect()) == [
        "s-0", "s-1", "s-2", "t-0", "t-1", "t-2"]


def test_page_stream_resumes_at_the_token_and_reads_no_committed_page_again(spark, scratch):
    import os

    from embedlift.sources.paged import paged_stream

    seen = f"{os.path.dirname(scratch)}/seen-{os.path.basename(scratch)}".removeprefix("file:")
    os.makedirs(seen)

    def fetch(shard, cursor, limit):
        at = 0 if cursor is None else cursor["at"]
        with open(f"{seen}/{shard}-{at}", "a") as log:
            log.write("x")
        rows = [(f"{shard}:{i}", [float(i)], '{"n": %d}' % i) for i in range(at, min(at + limit, 50))]
        return rows, {"at": at + limit} if at + limit < 50 else None

    def advance(shard, cursor, limit):
        at = 0 if cursor is None else cursor["at"]
        return {"at": at + limit} if at + limit < 50 else None

    def start(**trigger):
        stream = paged_stream(spark, fetch, ["a", "b"], f"{scratch}/position", page_size=10, pages_per_batch=2, advance=advance)
        return (stream.selectExpr("id", "vector[0] AS x").writeStream.format("parquet").option("path", f"{scratch}/out")
                .option("checkpointLocation", f"{scratch}/ck").trigger(**trigger).start())

    start(availableNow=True).awaitTermination()
    begun = spark.read.parquet(f"{scratch}/out").count()
    assert 0 < begun < 100 and begun % 40 == 0
    for _ in range(2):   # goes on, then finds nothing left
        query = start(processingTime="0 seconds")
        query.processAllAvailable()
        query.stop()
    rows = spark.read.parquet(f"{scratch}/out").collect()
    assert sorted(r["id"] for r in rows) == sorted(f"{s}:{i}" for s in "ab" for i in range(50))
    assert {name: open(f"{seen}/{name}").read() for name in os.listdir(seen)} == {f"{s}-{i}": "x" for s in "ab" for i in range(0, 50, 10)}


def test_page_stream_repeats_a_batch_that_failed_with_the_same_tokens(spark, scratch):
    import os

    import pytest

    from embedlift.sources.paged import paged_stream

    broken = f"{scratch}-broken".removeprefix("file:")
    os.makedirs(os.path.dirname(broken), exist_ok=True)
    open(broken, "w").close()

    def fetch(shard, cursor, limit):
        at = cursor or 0
        if at == 10 and os.path.exists(broken):
            raise OSError("connection lost")
        return [(f"{shard}:{i}", None, "{}") for i in range(at, at + 10)], at + 10 if at < 30 else None

    def start():
        stream = paged_stream(spark, fetch, ["a"], f"{scratch}/position", page_size=10, pages_per_batch=2, advance=lambda s, c, n: (c or 0) + 10 if (c or 0) < 30 else None)
        return (stream.select("id").writeStream.format("parquet").option("path", f"{scratch}/out").option("checkpointLocation", f"{scratch}/ck")
                .trigger(processingTime="0 seconds").start())

    with pytest.raises(Exception, match="connection lost"):
        start().processAllAvailable()
    os.remove(broken)
    query = start()
    query.processAllAvailable()
    query.stop()
    assert sorted(r["id"] for r in spark.read.parquet(f"{scratch}/out").collect()) == sorted(f"a:{i}" for i in range(40))
