"""Documents scored by masked pseudo-likelihood: how well both sides predict each word.

A small network sees two words to the left and two to the right of a position and predicts the
word there; a document's score is the sum of the log-probabilities of all its words. Words are
the ``TOP`` most frequent of the corpus; others share ``RARE`` numbers by their ending, and each has the
probability of its number times its share of that number's words in the corpus. The shares come from the
table of all words, joined by word, so they grow with the corpus; a word that the corpus lacks counts as
one more word of its number. The
output is a softmax in two steps (row of a grid, then column given row), each normalised, so
probabilities of all words sum to one.

Texts are split once: a task keeps, for every block of about ``BLOCK_CHARS`` of text, the block's
distinct words with their counts and the texts as numbers into them. The distinct words alone are
counted and joined with the corpus's numbers and shares, which then return to their block. What is
written from that, two bytes a word, serves training and scoring.

Training covers every document in one pass (numpy). Distinct texts are dealt into blocks by a hash
of what they say, as many as ``BLOCK_WORDS`` asks for, and taken in the order of such a hash; copies
weigh as often as they occur. Each block trains from the same start, and parameters are averaged with
the number of words as weight, in whole numbers. So neither the split of the files into tasks nor the
order of rows changes the network. The sums run in tasks by parameter block; the driver collects one
averaged model, whose size is fixed by the constants here, and ``TOP`` words.

Defined cases: a null, empty or blank text has no words, score 0 and a null mean; repeated rows
weigh and score like any other; a null doc_id is kept; of words that are equally frequent the smaller
ones are in the vocabulary; extra columns of any name are not read. A very long text is split by pieces and is held as
numbers by one task. A corpus without words gives the start model.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from embedlift.workspace import write_once

TOP, RARE = 2047, 512
ROWS, COLUMNS = 40, 64
WIDTH = 16
SIDES = (-2, -1, 1, 2)
BATCH = 8192
RATE = 0.15
_PAD = TOP + RARE
_SIZE = ROWS * COLUMNS
_BLOCK = 4096
_ENDS = ".,;:!?\"'()"
_FAR = max(map(abs, SIDES))
assert _PAD < _SIZE
#: Characters of text coded together, words of a training block, characters split at once.
BLOCK_CHARS = 16 << 20
BLOCK_WORDS = 2_000_000
_PIECE = 1 << 20
_SPACE = re.compile(r"\s")
#: Averaging in whole numbers: a parameter (within -64 and 64) in units of 2**-20, a weight in units of 2**-34 of all words.
_UNIT, _WHOLE, _LARGEST = 1 << 20, 1 << 34, 64


class LocalNumbers(dict):
    """Numbers of words in the order in which they were first asked for."""

    def __missing__(self, word: str) -> int:
        number = self[word] = len(self)
        return number


@dataclass
class Network:
    """Word vectors per side, and the two output layers."""

    sides: np.ndarray
    row: np.ndarray
    row_bias: np.ndarray
    column: np.ndarray
    column_bias: np.ndarray

    @classmethod
    def start(cls, counts: np.ndarray) -> Network:
        """Small random vectors; biases give the words' frequencies."""
        rng = np.random.default_rng(11)
        grid = (counts + 0.5).reshape(ROWS, COLUMNS)
        normal = lambda *shape: rng.normal(0, 0.1, shape).astype(np.float32)
        return cls(normal(len(SIDES), _SIZE, WIDTH), normal(WIDTH, ROWS), np.log(grid.sum(1) / grid.sum()).astype(np.float32),
                   normal(WIDTH, COLUMNS), np.log(grid / grid.sum(1, keepdims=True)).astype(np.float32))

    def parts(self) -> list[np.ndarray]:
        return [self.sides, self.row, self.row_bias, self.column, self.column_bias]

    def flat(self) -> np.ndarray:
        return np.concatenate([p.ravel() for p in self.parts()])

    def filled(self, flat: np.ndarray) -> Network:
        out, at = [], 0
        for p in self.parts():
            out.append(flat[at:at + p.size].reshape(p.shape).astype(np.float32))
            at += p.size
        return Network(*out)

    def _outputs(self, around: np.ndarray, words: np.ndarray):
        """Hidden values, exponentials of the outputs for rows and columns, the sums of each, and the words' log-probabilities."""
        hidden = self.sides[0].take(around[:, 0], 0)
        for s in range(1, len(SIDES)):
            hidden += self.sides[s].take(around[:, s], 0)
        np.tanh(hidden, out=hidden)
        r, c, at = words // COLUMNS, words % COLUMNS, np.arange(len(words))
        x, y = hidden @ self.row, hidden @ self.column
        x += self.row_bias
        y += self.column_bias.take(r, 0)
        for out, weights, bias in ((x, self.row, self.row_bias), (y, self.column, self.column_bias)):
            if np.abs(weights).sum(0).max() + np.abs(bias).max() > 80:   # else no exponential leaves the range of its type
                out -= out.max(1, keepdims=True)
        logs = x[at, r] + y[at, c]
        np.exp(x, out=x)
        np.exp(y, out=y)
        sums = x @ np.ones(ROWS, np.float32), y @ np.ones(COLUMNS, np.float32)
        return hidden, x, y, sums, logs - np.log(sums[0]) - np.log(sums[1])

    def log_probabilities(self, around: np.ndarray, words: np.ndarray) -> np.ndarray:
        return self._outputs(around, words)[4]

    def forward(self, around: np.ndarray, words: np.ndarray):
        """Hidden values, probabilities of rows and columns, and the words' log-probabilities."""
        hidden, p, q, sums, logs = self._outputs(around, words)
        p /= sums[0][:, None]
        q /= sums[1][:, None]
        return hidden, p, q, logs

    def gradients(self, around: np.ndarray, words: np.ndarray, weights: np.ndarray | None = None) -> list[np.ndarray]:
        """Of the mean loss, in which a word counts by its weight."""
        hidden, p, q, _ = self.forward(around, words)
        r, c, at = words // COLUMNS, words % COLUMNS, np.arange(len(words))
        p[at, r] -= 1
        q[at, c] -= 1
        share = np.full((len(words), 1), 1 / len(words), np.float32) if weights is None else (weights / weights.sum())[:, None].astype(np.float32)
        p *= share
        q *= share
        back = (p @ self.row.T + q @ self.column.T) * (1 - hidden * hidden)
        sides = np.stack([_summed_by(around[:, s], back, _SIZE) for s in range(len(SIDES))])
        return [sides, hidden.T @ p, p.sum(0), hidden.T @ q, _summed_by(r, q, ROWS)]


def _summed_by(groups: np.ndarray, rows: np.ndarray, n: int) -> np.ndarray:
    """Sum of the rows of each of ``n`` groups."""
    order = np.argsort(groups.astype(np.uint16), kind="stable")
    ordered = groups[order]
    begin = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]]))
    out = np.zeros((n, rows.shape[1]), np.float32)
    out[ordered[begin]] = np.add.reduceat(rows[order], begin, axis=0)
    return out


def _beside(texts: list[np.ndarray]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The words beside each word of the texts (``_PAD`` beyond a text's ends) and the words, in batches."""
    gap = np.full(_FAR, _PAD, np.int16)
    stream = np.concatenate([gap, *(part for text in texts for part in (text, gap))])
    places = np.flatnonzero(stream != _PAD)
    for i in range(0, len(places), BATCH):
        at = places[i:i + BATCH]
        yield np.stack([stream[at + s] for s in SIDES]).T, stream[at]


def _pieces(text: str) -> Iterator[list[str]]:
    """The words of a text, some at a time."""
    begin = 0
    while len(text) - begin > _PIECE and (gap := _SPACE.search(text, begin + _PIECE)):
        yield text[begin:gap.start()].lower().split()
        begin = gap.start()
    yield text[begin:].lower().split()


def _coded(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each block one row: ids and lengths of its texts, distinct words (frequent ones first) with counts, and the texts as numbers into them."""
    made = 0

    def block() -> pa.RecordBatch:
        flat = np.concatenate(parts) if parts else np.empty(0, np.int32)
        names = LocalNumbers()
        bare = np.fromiter((names[w.strip(_ENDS) or w] for w in known), np.int32, len(known))
        counts = np.bincount(bare, np.bincount(flat, minlength=len(known)), len(names)).astype(np.int64)
        order = np.argsort(-counts, kind="stable")
        place = np.empty(len(names), np.uint32)
        place[order] = np.arange(len(names), dtype=np.uint32)
        # the upper halves are mostly zeros: side by side they compress to nothing
        codes = place[bare[flat]].astype("<u4").view("<u2").reshape(-1, 2).T.tobytes()
        one = lambda values: pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)
        return pa.record_batch({"block": pa.array([TaskContext.get().partitionId() << 32 | made], pa.int64()), "ids": one(pa.array(ids, kind)), "lengths": one(pa.array(lengths, pa.int64())),
                                "words": one(pa.array(list(names), pa.string()).take(pa.array(order))), "counts": one(pa.array(counts[order])), "codes": pa.array([codes], pa.binary())})

    ids, lengths, parts, known, size = [], [], [], LocalNumbers(), 0
    for batch in batches:
        kind = batch.schema.field(0).type
        for i, text in zip(*(c.to_pylist() for c in batch.columns)):
            found = [np.fromiter(map(known.__getitem__, words), np.int32, len(words)) for words in _pieces(text or "")]
            ids.append(i)
            lengths.append(sum(map(len, found)))
            parts += found
            size += len(text or "")
            if size >= BLOCK_CHARS:
                yield block()
                ids, lengths, parts, known, size, made = [], [], [], LocalNumbers(), 0, made + 1
    if ids:
        yield block()


def coded(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Blocks of ``docs``, see above."""
    source = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    kind = source.schema["id"].dataType.simpleString()
    return write_once(source.mapInArrow(_coded, f"block long, ids array<{kind}>, lengths array<long>, words array<string>, counts array<long>, codes binary"), "word-blocks")


def _rare_number(word: Column) -> Column:
    """The number of a word beyond the vocabulary, by its last three letters."""
    return (F.lit(TOP) + F.crc32(F.encode(F.right(word, F.lit(3)), "utf-8")) % RARE).cast("int")


@dataclass
class Words:
    """``counts`` of the vocabulary's words by number and of rare ones together; ``table`` has ``word``, ``number`` and ``log_share``
    of all words of the corpus, ``unseen`` has ``log_share`` of a new word by ``number``."""

    counts: np.ndarray
    total: int
    table: DataFrame
    unseen: DataFrame


def counted(blocks: DataFrame) -> Words:
    """All words of the corpus."""
    each = blocks.select(F.explode(F.arrays_zip("words", "counts")).alias("w")).select(F.col("w.words").alias("word"), F.col("w.counts").alias("n"))
    counts = write_once(each.groupBy("word").agg(F.sum("n").alias("n")), "words")
    top = counts.orderBy(F.desc("n"), "word").limit(TOP).collect()
    vocabulary = blocks.sparkSession.createDataFrame([(r.word, i) for i, r in enumerate(top)], "word string, number int")
    numbers = counts.join(F.broadcast(vocabulary), "word", "left").withColumn("number", F.coalesce("number", _rare_number(F.col("word"))))
    totals = write_once(numbers.where(F.col("number") >= TOP).groupBy("number").agg(F.sum("n").alias("total")), "word-totals")
    rest = totals.agg(F.sum("total")).first()[0] or 0
    table = numbers.join(F.broadcast(totals), "number", "left").select("word", "number", F.coalesce(F.log(F.col("n") / (F.col("total") + 1)), F.lit(0.0)).alias("log_share"))
    known = np.zeros(_SIZE)
    known[:len(top)] = [r.n for r in top]
    known[TOP:TOP + RARE] = rest / RARE
    return Words(known, sum(r.n for r in top) + rest, table, totals.select("number", (-F.log(F.col("total") + 1.0)).alias("new")))


def numbered(blocks: DataFrame, words: Words) -> DataFrame:
    """For each text ``id``, ``numbers`` (two bytes a word), ``n_words`` and ``within``, the log-shares of its rare words."""
    asked = blocks.select(F.col("block").alias("of"), F.posexplode("words").alias("pos", "word")).join(words.table, "word", "left").withColumn("number", F.coalesce("number", _rare_number(F.col("word"))))
    found = asked.join(F.broadcast(words.unseen), "number", "left").select("of", "pos", "number", F.coalesce("log_share", "new", F.lit(0.0)).alias("share"))

    def put_together(texts: pa.Table, known: pa.Table) -> pa.Table:
        at = known["pos"].to_numpy()
        number, share = np.empty(len(at), np.int16), np.empty(len(at))
        number[at], share[at] = known["number"].to_numpy(), known["share"].to_numpy()
        halves = np.frombuffer(texts["codes"][0].as_py(), "<u2").reshape(2, -1)
        codes = halves[0] | halves[1].astype(np.uint32) << 16
        numbers, shares, lengths = number[codes], share[codes], texts["lengths"][0].values
        ends = np.cumsum([0, *lengths.to_pylist()]).tolist()
        return pa.table([texts["ids"][0].values, pa.array([numbers[a:b].tobytes() for a, b in zip(ends, ends[1:])], pa.binary()), lengths,
                         pa.array([float(shares[a:b].sum()) for a, b in zip(ends, ends[1:])], pa.float64())], names=["id", "numbers", "n_words", "within"])

    kind = blocks.schema["ids"].dataType.elementType.simpleString()
    texts = blocks.select("block", "ids", "lengths", "codes").groupBy("block")
    return write_once(texts.cogroup(found.groupBy("of")).applyInArrow(put_together, f"id {kind}, numbers binary, n_words long, within double"), "numbered")


def fitted(texts: DataFrame, words: Words) -> Network:
    """A network trained on all of ``texts`` (see :func:`numbered`)."""
    start, total = Network.start(words.counts), words.total
    blocks = max(1, -(-total // BLOCK_WORDS))
    distinct = texts.where("n_words > 0").groupBy("numbers").agg(F.count(F.lit(1)).alias("copies"))
    dealt = distinct.repartitionById(blocks, F.pmod(F.xxhash64("numbers"), F.lit(blocks)).cast("int"))

    def trained(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [row for batch in batches for row in zip(*(c.to_pylist() for c in batch.columns))]
        if not rows:
            return
        rows.sort(key=lambda r: (xxhash.xxh3_64_intdigest(r[0]), r[0]))
        texts = [np.frombuffer(data, np.int16) for data, _ in rows]
        weights = np.repeat(np.array([n for _, n in rows], np.float64), [len(t) for t in texts])
        network = start.filled(start.flat())
        squares = [np.full_like(p, 1e-6) for p in network.parts()]
        for i, (around, asked) in enumerate(_beside(texts)):
            for p, g, s in zip(network.parts(), network.gradients(around, asked, weights[i * BATCH:(i + 1) * BATCH]), squares):
                s += g * g
                p -= RATE * g / np.sqrt(s)
        weight = round(weights.sum() / total * _WHOLE)
        flat = np.rint(np.clip(network.flat().astype(np.float64), -_LARGEST, _LARGEST) * _UNIT).astype(np.int64) * weight
        parts = [flat[i:i + _BLOCK].tobytes() for i in range(0, len(flat), _BLOCK)]
        yield pa.record_batch([pa.array(range(len(parts)), pa.int32()), pa.array(parts, pa.binary()), pa.array([weight] * len(parts), pa.int64())], names=["part", "data", "weight"])

    def summed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, list] = {}
        for batch in batches:
            for part, data, weight in zip(*(c.to_pylist() for c in batch.columns)):
                value = np.frombuffer(data, np.int64)
                sums[part] = [sums[part][0] + value, sums[part][1] + weight] if part in sums else [value, weight]
        yield pa.record_batch([pa.array(list(sums), pa.int32()), pa.array([v.tobytes() for v, _ in sums.values()], pa.binary()), pa.array([n for _, n in sums.values()], pa.int64())],
                              names=["part", "data", "weight"])

    schema = "part int, data binary, weight long"
    parts = sorted((r.part, r.weight, bytes(r.data)) for r in dealt.mapInArrow(trained, schema).repartition("part").mapInArrow(summed, schema).collect())
    return start.filled(np.concatenate([np.frombuffer(data, np.int64) / (weight * _UNIT) for _, weight, data in parts])) if parts else start


@dataclass
class Model:
    words: Words
    network: Network


def train(docs: DataFrame, text_col: str = "text") -> Model:
    """A model of all of ``docs``."""
    blocks = coded(docs.select(F.lit(0).alias("id"), F.col(f"`{text_col}`").alias("text")), "id")
    words = counted(blocks)
    return Model(words, fitted(numbered(blocks, words), words))


def scored(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``n_words``, ``score`` (sum of log-probabilities) and ``mean_score`` of every row."""
    return _scores(numbered(coded(docs, id_col, text_col), model.words), model.network, id_col)


def scored_by_itself(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` scored by a model of all of them, with texts split once."""
    blocks = coded(docs, id_col, text_col)
    words = counted(blocks)
    texts = numbered(blocks, words)
    return _scores(texts, fitted(texts, words), id_col)


def log_probabilities(network: Network, texts: list[np.ndarray]) -> list[np.ndarray]:
    """The log-probability of each word of each text of numbers."""
    values = np.concatenate([np.empty(0, np.float32), *(network.log_probabilities(around, words) for around, words in _beside(texts))])
    return np.split(values, np.cumsum([len(t) for t in texts])[:-1]) if texts else []


def _scores(texts: DataFrame, network: Network, id_col: str) -> DataFrame:
    kind = texts.schema["id"].dataType.simpleString()

    def scores(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (b.slice(i, 512) for b in batches for i in range(0, b.num_rows, 512)):
            found = log_probabilities(network, [np.frombuffer(data, np.int16) for data in batch.column("numbers").to_pylist()])
            values = np.array([v.sum(dtype=np.float64) for v in found]) + batch.column("within").to_numpy()
            yield pa.record_batch([batch.column("id"), batch.column("n_words"), pa.array(values)], names=["id", "n_words", "score"])

    rows = texts.select("id", "numbers", "n_words", "within").mapInArrow(scores, f"id {kind}, n_words long, score double")
    return rows.select(F.col("id").alias(id_col), "n_words", "score", F.when(F.col("n_words") > 0, F.col("score") / F.col("n_words")).alias("mean_score"))
