"""Exact nearest neighbours of query vectors, and recall between two collections.

Distances are block products in numpy inside each task, and a task hands on
only its best ``k`` per query: pairs of vectors are never rows. Query vectors
are broadcast while they are few (their size is checked); beyond that both
sides are split into blocks that meet block by block.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from embedlift.operators.filters import payload_filter

_BROADCAST_BYTES = 64 << 20
_BLOCK_BYTES = 64 << 20
_SCORE_BYTES = 16 << 20
_SALTS = 16
_RANK_DECIMALS = 12
_HITS = "query_id string, id string, score double"
SMALLER_IS_NEARER = ("euclidean", "l2-squared", "manhattan", "hamming")


def _best_finder(metric: str, keep: int):
    """Closure with the block kernel; it is shipped to the workers as one object."""
    nearer_small = metric in SMALLER_IS_NEARER
    decimals, score_bytes = _RANK_DECIMALS, _SCORE_BYTES

    def matrix(vectors, dims):
        """Usable rows (right length, no nulls) as doubles, and their positions."""
        import numpy as np
        import pyarrow.compute as pc

        fits = pc.fill_null(pc.equal(pc.list_value_length(vectors), dims), False)
        at = np.flatnonzero(fits.to_numpy(zero_copy_only=False))
        flat = vectors.filter(fits).flatten().to_numpy(zero_copy_only=False).astype(np.float64)
        rows = flat.reshape(len(at), dims)
        whole = ~np.isnan(rows).any(axis=1)
        return rows[whole], at[whole]

    def scores(queries, rows):
        import numpy as np

        if metric == "dot":
            return queries @ rows.T
        if metric == "cosine":
            norms = np.linalg.norm(queries, axis=1)[:, None] * np.linalg.norm(rows, axis=1)[None, :]
            with np.errstate(invalid="ignore", divide="ignore"):
                return np.where(norms > 0, (queries @ rows.T) / norms, np.nan)
        if metric in ("euclidean", "l2-squared"):
            squared = np.stack([((rows - q) ** 2).sum(axis=1) for q in queries])
            return np.sqrt(squared) if metric == "euclidean" else squared
        if metric == "manhattan":
            return np.stack([np.abs(rows - q).sum(axis=1) for q in queries])
        return np.stack([(rows != q).sum(axis=1).astype(np.float64) for q in queries])

    def merge(best, queries, rows, ids):
        """Fold a block into the best lists: ``best[i]`` is (scores, ids) of query i.

        Scores exist for a slice of queries and rows at a time, ``_SCORE_BYTES`` of them.
        """
        for low in range(0, len(rows), 8192):
            part, names = rows[low:low + 8192], ids[low:low + 8192]
            step = max(1, score_bytes // (8 * len(part)))
            for first in range(0, len(queries), step):
                fold(best, first, queries[first:first + step], part, names)

    def fold(best, first, queries, rows, ids):
        import numpy as np

        found = np.round(scores(queries, rows), decimals)
        for i, line in enumerate(found, first):
            usable = np.flatnonzero(~np.isnan(line))
            key = line[usable] if nearer_small else -line[usable]
            if len(key) > keep:
                limit = np.partition(key, keep - 1)[keep - 1]
                chosen = key <= limit
                usable, key = usable[chosen], key[chosen]
            old_key, old_id = best[i]
            key, name = np.concatenate([old_key, key]), np.concatenate([old_id, ids[usable]])
            order = np.lexsort((name.astype(str), key))[:keep]
            best[i] = (key[order], name[order])

    def table(query_ids, best):
        import numpy as np
        import pyarrow as pa

        sizes = [len(key) for key, _ in best]
        keys = np.concatenate([key for key, _ in best]) if best else np.zeros(0)
        names = np.concatenate([name for _, name in best]) if best else np.zeros(0, dtype=object)
        return pa.table({
            "query_id": pa.array(np.repeat(np.asarray(query_ids, dtype=object), sizes), pa.string()),
            "id": pa.array(names, pa.string()),
            "score": pa.array(keys if nearer_small else -keys, pa.float64())})

    def start(n):
        import numpy as np

        return [(np.zeros(0), np.zeros(0, dtype=object)) for _ in range(n)]

    return matrix, merge, table, start


def _search_broadcast(rows: DataFrame, query_rows: list, dims: int, metric: str, keep: int) -> DataFrame:
    import numpy as np

    names = [r[0] for r in query_rows]
    block = np.array([r[1] for r in query_rows], dtype=np.float64).reshape(len(names), dims)
    shared = rows.sparkSession.sparkContext.broadcast((names, block))
    matrix, merge, table, start = _best_finder(metric, keep)

    def best_of_task(batches):
        import numpy as np

        query_ids, queries = shared.value
        best = start(len(query_ids))
        for batch in batches:
            found, at = matrix(batch.column("vector"), dims)
            if len(at):
                merge(best, queries, found, np.asarray(batch.column("id").to_pylist(), dtype=object)[at])
        yield from table(query_ids, best).to_batches()

    return rows.select("id", "vector").mapInArrow(best_of_task, _HITS)


def _search_blocks(rows: DataFrame, queries: DataFrame, n_rows: int, n_queries: int, dims: int, metric: str,
                   keep: int) -> DataFrame:
    """Every block of rows meets every block of queries in one bounded group."""
    per_block = max(1, _BLOCK_BYTES // (8 * dims))
    row_blocks = max(1, -(-n_rows // per_block))
    query_blocks = max(1, -(-n_queries // per_block))
    matrix, merge, table, start = _best_finder(metric, keep)

    def blocks(n: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    left = (rows.select("id", "vector", F.pmod(F.xxhash64("id"), F.lit(row_blocks)).cast("int").alias("rb"))
            .select("*", blocks(query_blocks).alias("qb")))
    right = (queries.select("query_id", "vector", F.pmod(F.xxhash64("query_id"), F.lit(query_blocks)).cast("int").alias("qb"))
             .select("*", blocks(row_blocks).alias("rb")))

    def best_of_block(block, asked):
        import numpy as np

        vectors, at = matrix(block.column("vector").combine_chunks(), dims)
        wanted, which = matrix(asked.column("vector").combine_chunks(), dims)
        names = [asked.column("query_id")[int(i)].as_py() for i in which]
        best = start(len(names))
        if len(at) and len(names):
            ids = np.asarray(block.column("id").to_pylist(), dtype=object)[at]
            merge(best, wanted, vectors, ids)
        return table(names, best)

    return (left.groupBy("rb", "qb").cogroup(right.groupBy("rb", "qb"))
            .applyInArrow(best_of_block, _HITS))


def rank_topk(hits: DataFrame, k: int, offset: int = 0, nearest_small: bool = False, salts: int = 1) -> DataFrame:
    """Ranks ``offset+1 .. offset+k`` of each query, ties by id.

    With ``salts`` the hits of a query are first cut down in so many parts.
    """
    order = F.col("score").asc() if nearest_small else F.col("score").desc()
    if salts > 1:
        part = Window.partitionBy("query_id", F.pmod(F.xxhash64("id"), F.lit(salts))).orderBy(order, "id")
        hits = hits.withColumn("_part_rank", F.row_number().over(part)).filter(F.col("_part_rank") <= k + offset).drop("_part_rank")
    ranked = hits.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy(order, "id")))
    ranked = ranked.filter(F.col("rank") <= k + offset)
    return ranked.filter(F.col("rank") > offset) if offset else ranked


def search(queries: DataFrame, collection: DataFrame, k: int = 10, offset: int = 0, metric: str = "cosine",
           conditions: list[tuple] | None = None, broadcast_bytes: int = _BROADCAST_BYTES) -> DataFrame:
    """The exact ``k`` nearest records of every query: ``query_id, id, score, rank``.

    ``queries`` has ``query_id`` and ``vector``; each is compared with the records of its own
    dimension. Vectors with nulls or (cosine) of norm zero are never hits.
    """
    rows = payload_filter(collection, conditions) if conditions else collection
    asked = queries.select(F.col("query_id").cast("string").alias("query_id"), "vector").filter(F.size("vector") > 0)
    sizes = asked.groupBy(F.size("vector").alias("d")).agg(F.count(F.lit(1)).alias("n")).orderBy("d").collect()
    hits = rows.sparkSession.createDataFrame([], _HITS)
    for dims, n in sizes:
        usable = asked.filter(F.size("vector") == dims)
        if n * dims * 8 <= broadcast_bytes:
            rows_of_queries = [(r[0], r[1]) for r in usable.collect() if None not in r[1]]
            found = _search_broadcast(rows, rows_of_queries, dims, metric, k + offset)
        else:
            found = _search_blocks(rows, usable, rows.count(), n, dims, metric, k + offset)
        hits = found if len(sizes) == 1 else hits.unionByName(found)
    return rank_topk(hits, k, offset, metric in SMALLER_IS_NEARER, _SALTS)


def recall_at_k(source_hits: DataFrame, target_hits: DataFrame, k: int = 10) -> DataFrame:
    """Share of each query's source hits that the target finds as well: ``query_id, recall``."""
    both = source_hits.select("query_id", "id", F.lit(1).alias("_s"), F.lit(0).alias("_t")).unionByName(
        target_hits.select("query_id", "id", F.lit(0).alias("_s"), F.lit(1).alias("_t")))
    per_id = both.groupBy("query_id", "id").agg(F.max("_s").alias("_s"), F.max("_t").alias("_t"))
    return (per_id.groupBy("query_id")
            .agg(F.sum(F.col("_s") * F.col("_t")).alias("common"), F.sum("_s").alias("expected"))
            .filter(F.col("expected") > 0)
            .select("query_id", "common", (F.col("common") / F.least(F.col("expected"), F.lit(k))).alias("recall")))
