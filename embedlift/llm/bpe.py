"""Encode and decode with a tokenizer file of the tokenizers library over a distinct-word table.

Texts are cut at white space, which the pre-tokenizer drops, so the ids of a text are
the ids of its words in order. Each distinct word is encoded once by the library.
Decoding joins ids with the id-to-piece table, whose size the tokenizer file fixes, and
puts single spaces between pieces as the library does for a file without a decoder.

Defined cases: a null or empty text, or one of white space only, has no ids and decodes
to the empty string; null ids decode to null. Repeated rows and null doc_ids give one row
each. Two identical blocks of rows (same ids and texts throughout) give both their rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql.types import StringType, StructField, StructType

from embedlift.llm.base import without
from embedlift.llm.wordtable import Coding, coded, slices

#: str.split takes these for white space, the tokenizer does not.
_NOT_SPACE = re.compile("[\x1c-\x1f]")
_WORD = re.compile(r"[^ \t-\r]+")


@cache
def _tokenizer(path: str):
    from tokenizers import Tokenizer

    found = Tokenizer.from_file(path)
    if found.decoder is not None or found.model.end_of_word_suffix != "</w>":
        raise ValueError("only tokenizer files with word ends, without a decoder and with white space dropped are meant here")
    found.no_truncation()
    found.no_padding()
    return found


def words_of(text: str) -> list[str]:
    """Maximal runs without white space; every cut is at a character that the tokenizer drops."""
    return _WORD.findall(text) if _NOT_SPACE.search(text) else text.split()


def encoded(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id`` and ``ids`` (array<int>) of every row."""
    def coder():
        encode = _tokenizer(tokenizer).encode
        return lambda word: np.array(encode(word, add_special_tokens=False).ids, np.int32).tobytes()

    return coded(docs, Coding(words_of, coder, _joined), "ids array<int>", id_col, text_col).drop("n_bytes")


def _joined(texts: list[np.ndarray], codes: list[bytes]) -> list[pa.Array]:
    """The ids of each text: its words' ids, one after the other."""
    parts = [b"".join(map(codes.__getitem__, t.tolist())) for t in texts]
    ends = np.cumsum([0, *(len(p) // 4 for p in parts)]).astype(np.int32)
    return [pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(parts), np.int32)))]


def decoded(encodings: DataFrame, tokenizer: str, ids: str = "ids", into: str = "decoded") -> DataFrame:
    """``encodings`` with the text of ``ids``, special pieces included; an unknown id raises an error."""
    kept = without(encodings, [into])

    def texts(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = _pieces(tokenizer)
        for batch in batches:
            lists = batch.column(batch.schema.get_field_index(ids))
            for begin, stop in slices(lists.offsets.to_numpy()):
                part = batch.slice(begin, stop - begin)
                yield pa.RecordBatch.from_arrays([*part.columns, _texts(lists[begin:stop], pieces)], names=[*part.schema.names, into])

    return kept.mapInArrow(texts, StructType([*kept.schema.fields, StructField(into, StringType())]))


@cache
def _pieces(path: str) -> pa.Array:
    """The id-to-piece table: the piece at each id."""
    t = _tokenizer(path)
    return pa.array([t.id_to_token(i) for i in range(t.get_vocab_size())], pa.large_string())


def _texts(lists: pa.ListArray, pieces: pa.Array) -> pa.Array:
    ends = lists.offsets.to_numpy().astype(np.int64)
    words = pieces.take(lists.values[ends[0]:ends[-1]])
    joined = pc.binary_join(pa.LargeListArray.from_arrays(pa.array(ends - ends[0]), words), pa.scalar(" ", pa.large_string()))
    return pc.if_else(lists.is_valid(), joined.cast(pa.string()), pa.scalar(None, pa.string()))
