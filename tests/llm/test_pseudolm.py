import random

import numpy as np

from embedlift.llm import pseudolm
from llm.fixtures import awkward, frame


def chain(rng, n):
    """Words that follow from the one before."""
    out = [rng.randrange(40)]
    for _ in range(n - 1):
        out.append((out[-1] * 7 + rng.randrange(3)) % 40)
    return [f"word{i}" for i in out]


def test_probabilities_sum_to_one_and_gradients_are_right():
    rng = np.random.default_rng(0)
    network = pseudolm.Network.start(rng.random(pseudolm._SIZE))
    around, words = rng.integers(0, pseudolm._SIZE, (1, 4)), np.arange(pseudolm._SIZE)
    total = np.exp(network.forward(np.repeat(around, len(words), 0), words)[3].astype(np.float64)).sum()
    assert abs(total - 1) < 1e-3
    around, words = rng.integers(0, 50, (64, 4)), rng.integers(0, 50, 64)
    loss = lambda n: -n.forward(around, words)[3].astype(np.float64).mean()
    grads = network.gradients(around, words)
    for p, g in zip(network.parts(), grads):
        at = np.unravel_index(np.abs(g).argmax(), g.shape)
        old = p[at]
        p[at] = old + 1e-2
        up = loss(network)
        p[at] = old - 1e-2
        down = loss(network)
        p[at] = old
        assert abs((up - down) / 2e-2 - g[at]) < 0.05 * abs(g[at]) + 1e-5


def test_held_out_text_scores_above_shuffled_text(spark):
    rng = random.Random(1)
    rows = [(i, " ".join(chain(rng, 200)), None, None, None) for i in range(300)]
    model = pseudolm.train(frame(spark, rows).repartition(2))
    fresh = [chain(rng, 200) for _ in range(30)]
    mixed = [rng.sample(w, len(w)) for w in fresh]
    docs = frame(spark, [(i, " ".join(w), None, None, None) for i, w in enumerate(fresh + mixed)])
    score = {r.doc_id: r.mean_score for r in pseudolm.scored(docs, model).collect()}
    assert sum(score[i] > score[i + 30] for i in range(30)) >= 29
    assert np.mean([score[i] for i in range(30)]) > np.log(1 / 40) + 0.5


def test_a_rare_word_scores_by_its_share_of_its_number(spark):
    top = [f"top{i:04d}" for i in range(pseudolm.TOP)]
    rows = [" ".join(top * 10), "aaaending " * 6 + "bbbending bbbending."]
    docs = frame(spark, [(i, t, None, None, None) for i, t in enumerate(rows)])
    model = pseudolm.train(docs)
    asked = frame(spark, [(i, w, None, None, None) for i, w in enumerate(["aaaending", "bbbending", "cccending"])])
    score = {r.doc_id: r.score for r in pseudolm.scored(asked, model).collect()}
    assert abs(score[0] - score[1] - np.log(3)) < 1e-6 and abs(score[1] - score[2] - np.log(2)) < 1e-6


def test_awkward_rows(spark):
    docs = frame(spark, awkward())
    model = pseudolm.train(docs)
    rows = pseudolm.scored(docs, model).collect()
    assert len(rows) == len(awkward())
    by = {r.doc_id: r for r in rows if r.doc_id is not None}
    assert by[0].n_words == 0 and by[0].score == 0 and by[0].mean_score is None and by[2].n_words == 0
    assert by[4].score == by[5].score
    empty = docs.limit(0)
    assert pseudolm.scored(empty, pseudolm.train(empty)).count() == 0


def test_scores_are_those_of_each_word_alone_and_do_not_depend_on_the_partitions(spark, monkeypatch):
    """Every word looked up, surrounded and scored by itself in plain Python."""
    monkeypatch.setattr(pseudolm, "BLOCK_CHARS", 5000)
    monkeypatch.setattr(pseudolm, "_PIECE", 64)
    rng = random.Random(3)
    texts = [" ".join(chain(rng, rng.randrange(60))) + f" rare{rng.randrange(30)}, Rare{i}!" for i in range(120)]
    texts += [texts[0]] * 40 + [None, "", " \x1c  "]
    docs = frame(spark, [(i, t, None, None, None) for i, t in enumerate(texts)])
    blocks = pseudolm.coded(docs)
    words = pseudolm.counted(blocks)
    numbers = {r.word: (r.number, r.log_share) for r in words.table.collect()}
    network = pseudolm.fitted(pseudolm.numbered(blocks, words), words)
    found = {r.doc_id: r for r in pseudolm.scored_by_itself(docs.repartition(7)).collect()}
    far = [pseudolm._PAD] * 2
    for i, text in enumerate(texts):
        own = [numbers[w.strip(pseudolm._ENDS) or w] for w in (text or "").lower().split()]
        line = far + [n for n, _ in own] + far
        score = sum(share for _, share in own)
        for k in range(2, len(line) - 2):
            hidden = np.tanh(sum(network.sides[s][line[k + side]].astype(float) for s, side in enumerate(pseudolm.SIDES)))
            row, column = divmod(line[k], pseudolm.COLUMNS)
            x, y = hidden @ network.row + network.row_bias, hidden @ network.column + network.column_bias[row]
            score += x[row] - np.log(np.exp(x).sum()) + y[column] - np.log(np.exp(y).sum())
        assert found[i].n_words == len(own) and abs(found[i].score - score) < 1e-3 * max(1, len(own) / 10)
    again = {r.doc_id: r for r in pseudolm.scored_by_itself(docs.coalesce(1).orderBy(docs.doc_id.desc())).collect()}
    assert all(abs(again[i].score - found[i].score) < 1e-4 for i in found)


def test_copies_weigh_as_often_as_they_occur():
    rng = np.random.default_rng(2)
    network = pseudolm.Network.start(rng.random(pseudolm._SIZE))
    around, words = rng.integers(0, 50, (6, 4)), rng.integers(0, 50, 6)
    weights = np.array([1, 2, 3, 1, 1, 2])
    for p, q in zip(network.gradients(around, words, weights), network.gradients(np.repeat(around, weights, 0), np.repeat(words, weights))):
        assert np.allclose(p, q, atol=1e-6)
