"""Documents that contain benchmark items, with column functions only.

Texts are folded to words. A window of a document is as long, in words, as a benchmark
item. Windows are placed wherever a document shares one shingle of ``WORDS`` words with an
item, at the item's offset; a window of the asked similarity always shares one, so no window
is lost by that. Each window and each item has a 64-bit SimHash of its words. Two fingerprints
within ``RADIUS`` bits agree in one of ``RADIUS + 1`` blocks, so joining on (length, block
number, block) finds every item within the radius. A candidate is a leak if the exact
similarity of the shingles, weighted by how often each occurs (sum of the smaller weights over
sum of the larger ones), is at least ``SIMILARITY``.

Shuffled are only hits of shared shingles and, once, the texts beside the documents that have
some. The items' shingles are broadcast up to ``MOST_BROADCAST`` of them (counted first); a
larger benchmark is joined by shuffling shingle hashes.

Defined cases: null and empty texts and items without words match nothing; an item of fewer
than ``WORDS`` words is one shingle of its own length; a document shorter than an item is one
window; repeated rows give one leak, rows that share a doc_id share its leaks, and a null
doc_id is an id like any other. Equal items are all reported.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from embedlift.workspace import fits, write_once

WORDS = 5
SIMILARITY = 0.8
RADIUS = 15
MOST_BROADCAST = 1_000_000


def folded(text: Column) -> Column:
    """Words in lower case: runs of letters and digits."""
    return F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def _shingles(words: Column, k: int) -> Column:
    """Hash of each run of ``k`` words, in order; ``words`` is evaluated once."""
    def of(w: Column) -> Column:
        at = F.sequence(F.lit(0), F.size(w) - k)
        return F.when(F.size(w) >= k, F.transform(at, lambda i: F.xxhash64(*[F.get(w, i + j) for j in range(k)]))).otherwise(F.array().cast("array<bigint>"))

    return F.get(F.transform(F.array(words), of), F.lit(0))


def _bit(on: Column, b: Column) -> Column:
    return F.when(on, F.call_function("shiftleft", F.lit(1).cast("long"), b)).otherwise(F.lit(0).cast("long"))


def _sum_of_bits(hashes: Column, b: int) -> Column:
    """How often bits ``b`` and ``b + 32`` are set, in the lower and the upper half of one number."""
    return F.aggregate(hashes, F.lit(0).cast("long"), lambda a, h: a + F.shiftrightunsigned(h, b).bitwiseAND(F.lit((1 << 32) + 1)))


def _fingerprint(words: Column) -> Column:
    """The majority of each bit of the words' hashes."""
    def whole(hashes: Column) -> Column:
        n = F.size(hashes).cast("long")
        counts = F.array(*[_sum_of_bits(hashes, b) for b in range(32)])

        def voted(c: Column) -> Column:
            low = F.zip_with(c, F.sequence(F.lit(0), F.lit(31)), lambda x, b: _bit(x.bitwiseAND(F.lit((1 << 32) - 1)) * 2 > n, b))
            high = F.zip_with(c, F.sequence(F.lit(32), F.lit(63)), lambda x, b: _bit(F.shiftrightunsigned(x, 32) * 2 > n, b))
            return F.aggregate(F.concat(low, high), F.lit(0).cast("long"), lambda a, x: a.bitwiseOR(x))

        return F.get(F.transform(F.array(counts), voted), F.lit(0))

    return F.get(F.transform(F.array(F.transform(words, lambda w: F.xxhash64(w))), whole), F.lit(0))


def _blocks(mark: Column) -> Column:
    """The fingerprint cut into ``RADIUS + 1`` blocks, each as block number and value in one number."""
    width = 64 // (RADIUS + 1)
    return F.array(*[F.shiftrightunsigned(mark, i * width).bitwiseAND(F.lit((1 << width) - 1)) * (RADIUS + 1) + i for i in range(RADIUS + 1)])


def _weighted_similarity(a: Column, b: Column) -> Column:
    """Sum of the smaller weights over sum of the larger ones of all shingles of either side."""
    def weight(side: Column, v: Column) -> Column:
        return F.size(F.filter(side, lambda x: x == v))

    def single(side: Column) -> Column:
        return F.size(F.array_distinct(side)) == F.size(side)

    # where no shingle comes twice on one side, each shared one counts once; counting them takes time with the square of their number
    shared = F.when(single(a) | single(b), F.size(F.array_intersect(a, b))).otherwise(F.aggregate(F.array_intersect(a, b), F.lit(0), lambda s, v: s + F.least(weight(a, v), weight(b, v))))
    return shared.cast("double") / (F.size(a) + F.size(b) - shared)


def leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """``doc_id``, ``item_id``, ``similarity``, ``distance`` (bits) and ``at`` (first word) of the best window of every leak."""
    items = (benchmark.select(F.col(f"`{item_col}`").alias("item_id"), folded(F.col(f"`{item_text}`")).alias("words")).where("size(words) > 0")
             .withColumn("n", F.size("words")))
    sizes = sorted({min(WORDS, r.n) for r in items.select(F.least("n", F.lit(WORDS)).alias("n")).distinct().collect()})
    items = write_once(items.withColumn("shingles", F.coalesce(*[F.when(F.least("n", F.lit(WORDS)) == k, _shingles(F.col("words"), k)) for k in sizes or [WORDS]]))
                       .withColumn("mark", _fingerprint(F.col("words"))).drop("words"), "items")
    known = items.select("n", F.posexplode("shingles").alias("offset", "hash")).distinct()
    known = F.broadcast(known) if fits(known, MOST_BROADCAST) else known

    source = docs.select(F.col(f"`{id_col}`").alias("doc"), F.col(f"`{text_col}`").alias("text"))
    every = F.concat(*[F.transform(_shingles(folded(F.col("text")), k), lambda h, i: F.struct(i.alias("pos"), h.alias("hash"))) for k in sizes or [WORDS]]) if len(sizes) > 1 else None
    if every is None:
        found = source.select("doc", F.posexplode(_shingles(folded(F.col("text")), (sizes or [WORDS])[0])).alias("pos", "hash"))
    else:
        found = source.select("doc", F.explode(every).alias("s")).select("doc", "s.pos", "s.hash")
    hits = found.join(known, "hash").select("doc", "n", F.greatest(F.col("pos") - F.col("offset"), F.lit(0)).alias("at")).distinct()
    # a document's places together, so that its text is joined once
    places = hits.groupBy("doc").agg(F.collect_set(F.struct("n", "at")).alias("places"))
    texts = source.alias("d").join(places.alias("p"), F.col("d.doc").eqNullSafe(F.col("p.doc"))).select(F.col("d.doc").alias("doc"), folded(F.col("d.text")).alias("words"), "places")
    cut = F.transform("places", lambda p: F.struct(p["n"].alias("n"), p["at"].alias("at"), F.slice("words", F.greatest(F.lit(1), F.least(p["at"], F.size("words") - p["n"]) + 1), p["n"]).alias("words")))
    windows = texts.select("doc", F.inline(cut)).distinct()
    windows = windows.withColumn("shingles", F.coalesce(*[F.when(F.least("n", F.lit(WORDS), F.greatest(F.size("words"), F.lit(1))) == k, _shingles(F.col("words"), k)) for k in range(1, WORDS + 1)]))
    windows = windows.withColumn("mark", _fingerprint(F.col("words"))).drop("words")
    windows = windows.withColumn("block", F.explode(_blocks(F.col("mark"))))
    sought = items.select("item_id", "n", F.col("shingles").alias("theirs"), F.col("mark").alias("its"), F.explode(_blocks(F.col("mark"))).alias("block"))
    near = windows.join(sought, ["n", "block"]).withColumn("distance", F.bit_count(F.col("mark").bitwiseXOR(F.col("its")))).where(F.col("distance") <= RADIUS)
    # a pair meets in every block that agrees; it counts in the first of them
    first = F.array_min(F.transform(F.filter(F.sequence(F.lit(0), F.lit(RADIUS)), lambda i: F.get(_blocks(F.col("mark")), i) == F.get(_blocks(F.col("its")), i)), lambda i: i))
    near = near.where(F.col("block") % (RADIUS + 1) == first).withColumn("similarity", _weighted_similarity(F.col("shingles"), F.col("theirs"))).where(F.col("similarity") >= SIMILARITY)
    return near.groupBy(F.col("doc").alias(id_col), F.col("item_id").alias(item_col)).agg(
        F.max("similarity").alias("similarity"), F.min("distance").cast("int").alias("distance"), F.min_by("at", F.struct(-F.col("similarity"), "at")).alias("at"))


def decontaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without those that have a leak."""
    bad = leaks(docs, benchmark, id_col, text_col).select(F.col(id_col).alias("__leak")).distinct()
    return docs.join(bad, docs[id_col].eqNullSafe(bad["__leak"]), "left_anti")
