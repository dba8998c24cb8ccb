"""Near-duplicate documents by Order MinHash and banded alignment.

A document's words in windows of ``WORDS`` are its k-mers, each labelled with its occurrence
number in the document. Each of ``SKETCHES`` hash functions picks the ``PICKS`` labelled k-mers
with the smallest values and keeps them in text order; documents that agree in one such
sequence are candidates. Because order counts, the chance to agree follows edit similarity
rather than overlap of sets. Candidates are links if a banded alignment of their words edits at
most ``1 - SIMILARITY`` of the longer document, and classes are connected components.

Documents with the same words (in lower case, digits as they are) are one item from the start (hash and smallest id are
combined before the shuffle), so copies cost a row each and no pair. See ``blocks`` for how
groups of near copies are joined without all their pairs, and large buckets compared in full.

Recall: two documents whose k-mer sets have a Jaccard similarity of 0.8 agree in one sketch
with a probability near 0.8 ** PICKS, so all 16 sketches miss a pair in about 1 of 90,000 cases.

Defined cases: null and empty texts and texts without words are one class; a document with
fewer than ``WORDS`` words is one k-mer; a null doc_id belongs to a class but never leads it
unless the class has no other id (then class_id is null). Repeated rows each get a row.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from embedlift.llm.base import in_small_batches
from embedlift.llm.blocks import linked_in_full
from embedlift.llm.similar import hashed, texts_within, words_of
from embedlift.workspace import write_once

WORDS = 5
SIMILARITY = 0.8
SKETCHES = 16
PICKS = 3
#: Bins of words, compared one after the other before any alignment.
BINS = (256, 4096)
_ODD = np.random.default_rng(20240229).integers(1 << 62, size=SKETCHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_MIX = np.uint64(0xFF51AFD7ED558CCD)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * _MIX
    return x ^ (x >> np.uint64(29))


def labelled_kmers(words: np.ndarray) -> np.ndarray:
    """Hashes of the k-mers with their occurrence numbers, in text order."""
    k = min(WORDS, len(words))
    if not k:
        return words
    kmers = np.zeros(len(words) - k + 1, np.uint64)
    for i in range(k):
        kmers = _mixed(kmers * np.uint64(31) + words[i:len(words) - k + 1 + i])
    order = np.argsort(kmers, kind="stable")
    ordered = kmers[order]
    fresh = np.concatenate([[True], ordered[1:] != ordered[:-1]])
    if fresh.all():
        return _mixed(kmers)
    start = np.maximum.accumulate(np.where(fresh, np.arange(len(kmers)), 0))
    number = np.empty(len(kmers), np.uint64)
    number[order] = (np.arange(len(kmers)) - start).astype(np.uint64)
    return _mixed(kmers + number * np.uint64(0x9E3779B97F4A7C15))


def sketches(words: np.ndarray) -> np.ndarray:
    """One number per hash function: the picked k-mers in text order."""
    kmers = labelled_kmers(words)
    if not len(kmers):
        return np.empty(0, np.int64)
    picks = min(PICKS, len(kmers))
    out = np.empty(SKETCHES, np.uint64)
    step = max(1, (1 << 20) // len(kmers))
    for i in range(0, SKETCHES, step):
        values = _mixed(kmers[None, :] * _ODD[i:i + step, None])
        at = np.sort(np.argpartition(values, picks - 1, axis=1)[:, :picks], axis=1) if picks < len(kmers) else np.broadcast_to(np.arange(picks), (len(values), picks))
        mark = np.arange(i, i + len(values), dtype=np.uint64)
        for j in range(picks):
            mark = _mixed(mark * np.uint64(31) + kmers[at[:, j]])
        out[i:i + step] = mark
    return out.view(np.int64)


def _key(words: list[str]) -> bytes:
    return xxhash.xxh3_128_digest(" ".join(words).encode("utf-8", "surrogatepass"))


def _sketched(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in (b.slice(i, 1000) for b in batches for i in range(0, b.num_rows, 1000)):
        keys, marks = [], []
        for text in batch.column(1).to_pylist():
            words = words_of(text)
            keys.append(_key(words))
            marks.append(sketches(hashed(words)))
        yield pa.record_batch([batch.column(0), pa.array(keys, pa.binary()), pa.array(marks, pa.list_(pa.int64()))], names=["doc", "key", "marks"])


def _words(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Key and words, as 32-bit hashes, of each text."""
    for batch in batches:
        keys, texts = [], []
        for text in batch.column(0).to_pylist():
            words = words_of(text)
            keys.append(_key(words))
            texts.append(hashed(words).astype(np.uint32).tobytes())
        yield pa.record_batch([pa.array(keys, pa.binary()), pa.array(texts, pa.binary())], names=["key", "words"])


class Texts:
    """Which of a list of texts, as 32-bit hashes of words, are links (see ``blocks``)."""

    def __init__(self, items: pa.Array):
        self.words = [np.frombuffer(x.as_buffer(), np.uint32) for x in items]
        self.sizes = np.array([len(w) for w in self.words], np.int64)
        self.bins = [_narrow(np.stack([np.bincount(w % np.uint32(n), minlength=n) for w in self.words])) for n in BINS]

    def linked(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        longer = np.maximum(self.sizes[a], self.sizes[b])
        most = (longer - SIMILARITY * longer + 1e-9).astype(np.int64)
        left = np.flatnonzero(np.abs(self.sizes[a] - self.sizes[b]) <= most)
        # each edit takes one word, so links share the rest; what shares a bin counts as equal
        for bins in self.bins:
            at = [left[k:k + 1024] for k in range(0, len(left), 1024)]
            shared = [np.minimum(bins[a[i]], bins[b[i]]).sum(axis=1, dtype=np.int64) for i in at]
            left = left[np.concatenate(shared) >= (longer - most)[left]] if at else left
        out = np.zeros(len(a), bool)
        out[left] = texts_within(self.words, a[left], b[left], most[left])
        return out


def _narrow(counts: np.ndarray) -> np.ndarray:
    """The same numbers in one byte each, if they go into it."""
    return counts.astype(np.uint8 if counts.max(initial=0) < 256 else np.int32)


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``class_id`` (smallest id of the class) and ``class_size`` of every row."""
    source = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc"), F.col(f"`{text_col}`").alias("text"))
    found = in_small_batches(source.mapInArrow(_sketched, "doc long, key binary, marks array<long>"), "sketches")
    marks = found.select("key", F.explode("marks").alias("bucket")).distinct()
    shared = marks.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("bucket")
    candidates = write_once(marks.join(shared, "bucket").select("bucket", F.col("key").alias("id")), "sketch-buckets")
    # one row of the documents with a candidate's words gives them
    firsts = (found.join(candidates.select(F.col("id").alias("key")).distinct(), "key").groupBy("key").agg(F.min("doc").alias("doc")))
    words = in_small_batches(source.join(firsts, source["doc"].eqNullSafe(firsts["doc"]), "left_semi").select("text").mapInArrow(_words, "key binary, words binary").dropDuplicates(["key"]), "sketch-words")

    items = words.select(F.col("key").alias("id"), F.col("words").alias("item"), F.expr("length(words) div 4").alias("size"))
    groups = write_once(linked_in_full(candidates, items, Texts, SIMILARITY), "sketch-groups")
    counted = found.groupBy("key").agg(F.min("doc").alias("first"), F.count(F.lit(1)).alias("n"))
    classed = counted.join(groups.withColumnRenamed("id", "key"), "key", "left").withColumn("component", F.coalesce("component", "key"))
    classes = classed.groupBy("component").agg(F.min("first").alias("class_id"), F.sum("n").alias("class_size"))
    of_key = classed.select("key", "component").join(classes, "component").select("key", "class_id", "class_size")
    return found.select(F.col("doc").alias(id_col), "key").join(of_key, "key").select(id_col, "class_id", "class_size")
