"""Small documents with every awkward case, and helpers."""

from __future__ import annotations

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def sentence(rng: random.Random, n: int) -> str:
    return " ".join("".join(rng.choice(("ra", "to", "mi", "le", "sun", "ver", "ka", "dol")) for _ in range(rng.randint(1, 4))) for _ in range(n))


def awkward() -> list[tuple]:
    """Null, empty, blank, odd white space, repeated rows, ties, a null id, a long word, a long text."""
    rng = random.Random(5)
    base = sentence(rng, 120)
    texts = [None, "", "   \n\t\n", "a", base, base, base + " more", "x" * 3000, "1\x1c2\x1d \x85  é ﬁ \U0001f44d <|endoftext|> it's",
             "\n".join([base[:90]] * 3), sentence(rng, 6000), "▁ ▁▁x  y\r\nz", "É" + base.upper()]
    rows = [(i, t, "en", "src0", len(t or "")) for i, t in enumerate(texts)]
    return [*rows, rows[4], (None, base, None, None, None), (None, None, None, None, None)]


def frame(spark, rows, schema: str = SCHEMA):
    return spark.createDataFrame(rows, schema)
