"""A distinct-word table without moving each word: code words once, join the codes back by position.

Texts are cut into words by Spark tasks. A task keeps, for every block of about
``BLOCK_BYTES`` of text, the block's distinct words and the words of its texts as
numbers into them. Only these leave the task:

* dictionaries, split by a hash of the word, go to the word table's partitions; there
  each distinct word is coded once, and the codes return to the blocks that asked,
* word numbers go to the same place by block, where texts are put together again.

Both passes read ``docs`` on their own and name a block by a digest of its content, so a
source that reads differently the second time raises an error instead of mixing texts.
Pass a table (or a checkpoint), not an unordered computation. A frequent word is one entry
per block, so no word gathers rows; a block is bounded by ``BLOCK_BYTES`` plus one text.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from embedlift.llm.base import pack, unpack

BLOCK_BYTES = 32 << 20
#: Parts a block's dictionary is split into; the word table can use this many tasks.
PARTS = 256


@dataclass(frozen=True)
class Coding:
    """``split`` cuts a text into words; ``coder()`` gives, in each task, a function from word to bytes;
    ``joined(lists of word numbers, codes by number)`` gives the result columns of a block's texts."""

    split: Callable[[str], list[str]]
    coder: Callable[[], Callable[[str], bytes]]
    joined: Callable[[list[np.ndarray], list[bytes]], list[pa.Array]]


def coded(docs: DataFrame, coding: Coding, result: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``n_bytes`` (UTF-8) and the columns of ``result`` (DDL) for each row of ``docs``; a null text counts as empty."""
    source = docs.select(F.col(f"`{id_col}`").alias("id"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))
    names = StructType.fromDDL(result).names
    id_type = source.schema["id"].dataType.simpleString()

    def dictionaries(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, _, _, _, words in _blocks(batches, coding.split):
            part = np.fromiter((crc32(w.encode("utf-8", "surrogatepass")) % PARTS for w in words), np.int32, len(words))
            order = np.argsort(part, kind="stable")
            names, at = pa.array(words, pa.large_string()), np.searchsorted(part[order], np.arange(PARTS + 1))
            for p in range(PARTS):
                chosen = order[at[p]:at[p + 1]].astype(np.int32)
                if len(chosen):
                    data = pack(pa.record_batch({"at": pa.array(chosen), "word": names.take(pa.array(chosen))}))
                    yield pa.record_batch({"part": pa.array([p], pa.int32()), "block": pa.array([block], pa.binary()), "data": pa.array([data], pa.binary())})

    def codes(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code, known = coding.coder(), {}
        for batch in batches:
            for block, data in zip(batch.column("block").to_pylist(), batch.column("data").to_pylist()):
                asked, found = unpack(data), []
                for w in asked["word"].to_pylist():
                    if w not in known:
                        known[w] = code(w)
                    found.append(known[w])
                packed = pack(pa.record_batch({"at": asked["at"].combine_chunks(), "code": pa.array(found, pa.binary())}))
                yield pa.record_batch({"block": pa.array([block], pa.binary()), "data": pa.array([packed], pa.binary())})

    def numbers(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, ids, sizes, texts, _ in _blocks(batches, coding.split):
            flat = np.concatenate(texts) if texts else np.empty(0, np.int32)
            ends = np.cumsum([0, *map(len, texts)]).astype(np.int64)
            data = pack(pa.record_batch({"id": ids, "size": sizes, "words": pa.LargeListArray.from_arrays(pa.array(ends), pa.array(flat, pa.int32()))}))
            yield pa.record_batch({"block": pa.array([block], pa.binary()), "data": pa.array([data], pa.binary())})

    def put_together(texts: pa.Table, table: pa.Table) -> pa.Table:
        if not texts.num_rows:
            raise RuntimeError("the documents were read differently the second time; store them first")
        got = [unpack(d) for d in table["data"].to_pylist()]
        at = np.concatenate([g["at"].to_numpy() for g in got]) if got else np.empty(0, np.int64)
        found: list[bytes] = [b""] * len(at)
        for n, c in zip(at.tolist(), (c for g in got for c in g["code"].to_pylist())):
            found[n] = c
        out = []
        for data in texts["data"].to_pylist():
            t = unpack(data)
            lists = t["words"].combine_chunks() if t.num_rows else pa.array([], pa.large_list(pa.int32()))
            if t.num_rows:
                flat, ends = lists.values.to_numpy(), lists.offsets.to_numpy()
                if len(flat) and flat.max() >= len(found):
                    raise RuntimeError("the documents were read differently the second time; store them first")
                for begin, stop in slices(ends):
                    part = [flat[ends[i]:ends[i + 1]] for i in range(begin, stop)]
                    out.append(pa.RecordBatch.from_arrays([*(t[c].combine_chunks()[begin:stop] for c in ("id", "size")), *coding.joined(part, found)],
                                                          names=[id_col, "n_bytes", *names]))
        return pa.Table.from_batches(out)

    table = (source.mapInArrow(dictionaries, "part int, block binary, data binary").repartition("part")
             .mapInArrow(codes, "block binary, data binary"))
    texts = source.mapInArrow(numbers, "block binary, data binary")
    return texts.groupBy("block").cogroup(table.groupBy("block")).applyInArrow(put_together, f"`{id_col}` {id_type}, n_bytes long, {result}")


def slices(ends: np.ndarray, words: int = 1 << 18) -> Iterator[tuple[int, int]]:
    """Consecutive texts of about so many words together."""
    begin = 0
    while begin < len(ends) - 1:
        stop = max(begin + 1, int(np.searchsorted(ends, ends[begin] + words, "right")) - 1)
        yield begin, stop
        begin = stop


def _blocks(batches: Iterable[pa.RecordBatch], split: Callable[[str], list[str]]) -> Iterator[tuple[bytes, pa.Array, pa.Array, list[np.ndarray], list[str]]]:
    """Digest, ids, UTF-8 lengths, word numbers of each text, distinct words."""
    fresh = lambda: (hashlib.blake2b(digest_size=16), [], [], [], {}, 0)
    digest, ids, sizes, texts, known, size = fresh()
    kind = None
    for batch in batches:
        kind = batch.schema.field(0).type
        for i, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            raw = text.encode("utf-8", "surrogatepass")
            digest.update(f"{i} {len(raw)} ".encode())
            digest.update(raw)
            words = split(text)
            texts.append(np.fromiter((known.setdefault(w, len(known)) for w in words), np.int32, len(words)))
            ids.append(i)
            sizes.append(len(raw))
            size += len(raw)
            if size >= BLOCK_BYTES:
                yield digest.digest(), pa.array(ids, kind), pa.array(sizes, pa.int64()), texts, list(known)
                digest, ids, sizes, texts, known, size = fresh()
    if ids:
        yield digest.digest(), pa.array(ids, kind), pa.array(sizes, pa.int64()), texts, list(known)
