import random

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from embedlift.llm import bpe, tokencount
from llm.fixtures import awkward, frame

WORDS, PIECES = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(2)
    odd = ["".join(rng.choice("ab ▁\n. 1é日👍thein\x1c 'S<|>") for _ in range(80)) for _ in range(150)]
    return [*awkward(), *[(1000 + i, t, None, None, None) for i, t in enumerate(odd)]]


def test_ids_and_decoding_are_the_librarys(spark, texts):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(WORDS)
    got = sorted((r.doc_id is None, r.doc_id or 0, r.ids, r.decoded) for r in bpe.decoded(bpe.encoded(frame(spark, texts), WORDS), WORDS).collect())
    want = []
    for d, t, *_ in texts:
        ids = library.encode(t or "", add_special_tokens=False).ids
        want.append((d is None, d or 0, ids, library.decode(ids, skip_special_tokens=False)))
    assert got == sorted(want)


def test_counts_at_every_prefix_are_the_librarys(spark, texts):
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    rows = tokencount.prefix_counts(frame(spark, texts), PIECES).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0, r.n_bytes, r.n_tokens) for r in rows) == sorted(
        (d is None, d or 0, len((t or "").encode()), len(library.encode(t or ""))) for d, t, *_ in texts)
    by = {d: t or "" for d, t, *_ in texts}
    for r in rows:
        if r.doc_id is not None and (r.doc_id >= 1000 or r.doc_id in (1, 3, 8, 11)):
            text = by[r.doc_id]
            assert tokencount.counts_at(r.rises).tolist() == [len(library.encode(text[:p])) for p in range(len(text) + 1)]


def test_longest_prefix_within_a_budget(spark):
    counts = tokencount.prefix_counts(frame(spark, [(1, "the sun and the moon", None, None, None), (2, None, None, None, None)]), PIECES)
    for budget in (0, 1, 3, 100):
        for r in counts.select("doc_id", "rises", tokencount.fitting_chars("rises", budget).alias("n")).collect():
            at = tokencount.counts_at(r.rises)
            assert r.n == max(np.flatnonzero(at <= budget))


def test_empty_tables_and_clashing_columns(spark):
    docs = frame(spark, awkward()).withColumn("ids", F.lit(1)).withColumn("n_tokens", F.lit(1)).withColumn("block", F.lit(1))
    assert bpe.encoded(docs, WORDS).count() == len(awkward())
    assert bpe.encoded(docs.limit(0), WORDS).count() == 0
    assert tokencount.prefix_counts(docs.limit(0), PIECES).count() == 0
    assert bpe.decoded(spark.createDataFrame([(1, None)], "doc_id long, ids array<int>"), WORDS).first().decoded is None
