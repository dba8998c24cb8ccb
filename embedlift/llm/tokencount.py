"""Exact token counts at every prefix of a text, by dynamic programming over a BPE vocabulary.

Encoding a prefix of ``i`` characters ends with exactly one piece ``t``, and the rest of
it is the encoding of the prefix without ``t``; so ``count(i) = count(i - len(t)) + 1``.
The piece is the one that ends there and is not merged differently beside the last piece
before it. Pieces never join a character before a space mark, so words are independent:
the counts of each distinct word are computed once (in a distinct-word table) and a text's
counts are those of its words, added up.

A text's counts are stored as one signed byte per code point: by how much the count rises
(or falls, where a character completes a longer piece). ``counts_at`` and ``truncated``
answer budget questions from that without encoding again.

Defined cases: a null or empty text has no tokens; repeated rows and null doc_ids give one
row each; characters outside the vocabulary count one token per UTF-8 byte.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from embedlift.llm.wordtable import Coding, coded

_MARK = "▁"
_WORD = re.compile(f"{_MARK}+[^{_MARK}\n]*|[^{_MARK}\n]+|\n")


class PrefixCounter:
    """Counts for the words of one vocabulary: pieces with scores, bytes for everything else."""

    def __init__(self, model_file: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=model_file)
        plain = [i for i in range(model.get_piece_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))]
        self.score = {model.id_to_piece(i): model.get_score(i) for i in plain}
        if any(_MARK in p.lstrip(_MARK) or (len(p) > 1 and "\n" in p) for p in self.score) or model.encode("a  b", out_type=str) == model.encode("a b", out_type=str):
            raise ValueError("words of this vocabulary are not independent")
        self.sizes = sorted({len(p) for p in self.score})
        self.fits: dict[tuple[str, str], bool] = {}
        self.whole = {p: self._merged(p) == [p] for p in self.score}

    def _merged(self, text: str) -> list[str]:
        """The pieces of a short text: again and again, the best-scored neighbours become one, the leftmost first."""
        parts, score = list(text), self.score
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                s = score.get(parts[i] + parts[i + 1])
                if s is not None and (best is None or s > best):
                    best, at = s, i
            if at < 0:
                break
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def counts(self, word: str) -> list[int]:
        """Tokens of the first 1, 2, ... characters of a word."""
        n, score, fits, whole = len(word), self.score, self.fits, self.whole
        last: list[str | None] = [None] * (n + 1)  # None: a barrier that nothing merges with
        count = [0] * (n + 1)
        for i in range(1, n + 1):
            for size in self.sizes[:bisect_right(self.sizes, i)]:
                piece = word[i - size:i]
                if piece not in score or not whole[piece]:
                    continue
                before = last[i - size]
                if before is not None:
                    pair = (before, piece)
                    good = fits.get(pair)
                    if good is None:
                        if len(fits) > 1_000_000:
                            fits.clear()
                        good = fits[pair] = self._merged(before + piece) == [before, piece]
                    if not good:
                        continue
                last[i], count[i] = piece, count[i - size] + 1
                break
            else:
                last[i], count[i] = None, count[i - 1] + len(word[i - 1].encode("utf-8", "surrogatepass"))
        return count[1:]


@cache
def _counter(model_file: str) -> PrefixCounter:
    return PrefixCounter(model_file)


def words_of(text: str) -> list[str]:
    """Words with their leading space marks, as the library sees the text; line ends stand alone."""
    return _WORD.findall(_MARK + text.replace(" ", _MARK)) if text else []


def prefix_counts(docs: DataFrame, model_file: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``n_bytes`` (UTF-8), ``n_tokens`` and ``rises`` (one signed byte per code point) of every row."""
    def coder():
        counts = _counter(model_file).counts
        return lambda word: np.diff(np.array(counts(word)), prepend=0).astype(np.int8).tobytes()

    return coded(docs, Coding(words_of, coder, _joined), "n_tokens long, rises binary", id_col, text_col)


def _joined(texts: list[np.ndarray], codes: list[bytes]) -> list[pa.Array]:
    """Tokens and rises of each text: those of its words, one after the other."""
    rises = []
    for t in texts:
        marked = b"".join(map(codes.__getitem__, t.tolist()))
        # the mark before the text belongs to its first character
        rises.append((int.from_bytes(marked[:1], signed=True) + int.from_bytes(marked[1:2], signed=True)).to_bytes(1, signed=True) + marked[2:] if marked else b"")
    return [pa.array([int(np.frombuffer(r, np.int8).sum(dtype=np.int64)) for r in rises], pa.int64()), pa.array(rises, pa.binary())]


def counts_at(rises: bytes) -> np.ndarray:
    """Token counts of the prefixes of 0, 1, 2, ... code points."""
    return np.concatenate([[0], np.cumsum(np.frombuffer(rises, np.int8), dtype=np.int64)])


@F.arrow_udf(LongType())
def _fitting(rises: pa.Array, budgets: pa.Array) -> pa.Array:
    out = []
    for r, b in zip(rises.to_pylist(), budgets.to_pylist()):
        out.append(None if r is None or b is None else int(np.flatnonzero(counts_at(r) <= max(b, 0))[-1]))
    return pa.array(out, pa.int64())


def fitting_chars(rises: str, budget: int):
    """Column: code points of the longest prefix with at most ``budget`` tokens."""
    return _fitting(F.col(f"`{rises}`"), F.lit(budget).cast("long"))
