"""The hidden Markov language model against a plain Baum-Welch, word by word."""

import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from keyloom.llm import hidden
from keyloom.llm.queries import QUERIES

SMALL = "/root/testdata/sf0.001"


def tokens(text):
    words = [w for w in re.split("[ \t-\r]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) if w]
    return [*words, None]


def trained_on(doc_id):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % 5 != 1


def plain(rows):
    """[(doc_id, text)] -> [(doc_id, held_out, n_tokens, n_known, N, base_score)] and the counts."""
    counts = Counter(w for i, t in rows if trained_on(i) for w in tokens(t))
    total, mass = sum(counts.values()), sum(counts.values()) + 0.5 * (len(counts) + 1)
    out = []
    for i, t in rows:
        own = tokens(t)
        base = sum(math.log10((counts[w] + 0.5) / mass) for w in own)
        out.append((i, not trained_on(i), len(own), sum(counts[w] > 0 for w in own), total, base))
    return out, counts


def forward_backward(codes, model):
    """(log-likelihood, starts, moves, {class: states}) of one list."""
    a = [model.start * model.emit[codes[0]]]
    for c in codes[1:]:
        a.append((a[-1] @ model.move) * model.emit[c])
    b = [np.ones(len(model.start))]
    for c in codes[:0:-1]:
        b.insert(0, model.move @ (model.emit[c] * b[0]))
    p = float(a[-1].sum())
    emit = Counter()
    for c, x, y in zip(codes, a, b, strict=True):
        emit[c] = emit[c] + x * y / p
    moves = sum((a[k][:, None] * model.move * (model.emit[codes[k + 1]] * b[k + 1])[None] / p for k in range(len(codes) - 1)), np.zeros_like(model.move))
    return math.log(p), a[0] * b[0] / p, moves, emit


def random_model(rng, states, classes):
    start, move, emit = rng.random(states), rng.random((states, states)), rng.random((classes, states))
    return hidden.Model(start / start.sum(), move / move.sum(axis=1, keepdims=True), emit / emit.sum(axis=0))


@pytest.mark.parametrize("piece", [1, 3, 7, 512])
def test_recursions(piece):
    rng = np.random.default_rng(piece)
    for states in (1, 2, 5):
        model = random_model(rng, states, 9)
        codes = [rng.integers(0, 9, n).astype(np.uint16) for n in (1, 2, 30, 7, 3, 6, 1, 41, 14)]
        want = [forward_backward(c, model) for c in codes]
        assert np.allclose(hidden.log_likelihood(codes, model, piece), [w[0] for w in want])
        starts, moves, emit, total = hidden.expected_counts(codes, model, 9, piece)
        assert np.allclose(starts, sum(w[1] for w in want)) and np.allclose(moves, sum(w[2] for w in want)) and np.isclose(total, sum(w[0] for w in want))
        table = np.zeros((9, states))
        for w in want:
            for c, x in w[3].items():
                table[c] += x
        assert np.allclose(emit, table)


def test_very_long_texts_neither_vanish_nor_overflow():
    rng = np.random.default_rng(2)
    model = random_model(rng, 4, 5)
    model = hidden.Model(model.start, model.move, model.emit * np.array([1e-9, 1, 1e-6, 1, 1])[:, None])
    codes = [rng.integers(0, 5, 30000).astype(np.uint16), np.zeros(3000, np.uint16)]
    got = hidden.log_likelihood(codes, model, 512)
    assert np.allclose(got, hidden.log_likelihood(codes, model, 1 << 20), rtol=1e-9) and np.isfinite(got).all()
    starts, moves, emit, _ = hidden.expected_counts(codes, model, 5, 512)
    assert np.isclose(starts.sum(), 2) and np.isclose(emit.sum(), 33000) and np.isclose(moves.sum(), 32998)


def brute_scores(rows, states, rounds):
    """Scores of the whole operator where every known word is a class of its own."""
    base_rows, counts = plain(rows)
    total, mass = sum(counts.values()), sum(counts.values()) + 0.5 * (len(counts) + 1)
    order = sorted((w for w in counts if w is not None), key=lambda w: (-counts[w], w.encode()))
    kind = {w: 2 + k for k, w in enumerate(order)} | {None: hidden.END if counts else hidden.UNKNOWN}
    once = sum(c == 1 for w, c in counts.items() if w is not None)
    new = (once + 0.5) / mass if counts else 1.0
    share = np.zeros(hidden.CLASSES)
    for w, c in counts.items():
        share[kind[w]] = (c + 0.5) / (total + 0.5 * len(counts)) * (1 - new)
    share[hidden.UNKNOWN] = new
    model = hidden.first_model(share, states)
    lists = [[kind.get(w, hidden.UNKNOWN) for w in tokens(t)] for _, t in rows]
    for _ in range(rounds):
        starts, moves, emit = np.ones(states), hidden.STAY_WEIGHT * hidden.sticky(states), np.zeros((hidden.CLASSES, states))
        for (i, _), codes in zip(rows, lists, strict=True):
            if trained_on(i):
                _, s, m, e = forward_backward(codes, model)
                starts, moves = starts + s, moves + m
                for c, x in e.items():
                    emit[c] += x * (1 - hidden.COMMON * share[c] / model.emit[c])
        emit[hidden.UNKNOWN] = 0
        flat = share.copy()
        flat[hidden.UNKNOWN] = 0
        emit += 1e-6 * flat[:, None]
        emit = (1 - hidden.COMMON) * (1 - new) * emit / emit.sum(axis=0) + hidden.COMMON * share[:, None]
        emit[hidden.UNKNOWN] = new
        model = hidden.Model(starts / starts.sum(), moves / moves.sum(axis=1, keepdims=True), emit)
    return [(*r, forward_backward(c, model)[0] / math.log(10)) for r, c in zip(base_rows, lists, strict=True)]


def same(got, want):
    assert len(got) == len(want)
    for g, w in zip(sorted(got, key=repr), sorted(want, key=repr), strict=True):
        assert g[:5] == w[:5] and np.allclose(g[5:], w[5:], rtol=1e-7), (g, w)


AWKWARD = [(i, ("Der Hund und die Katze " if i % 2 else "the dog and the cat ") * (1 + i % 5) + f"w{i % 9} end") for i in range(40)]
AWKWARD += [(None, "x\x0by"), (1, None), (2, ""), (3, " \n"), (3, " \n"), (4, "A b Ä"), (5, "never seen before"), (6, "the dog " * 900), (-7, "ß \t THE")]


def test_whole_operator(spark):
    table = spark.createDataFrame(AWKWARD, "doc_id long, text string")
    table = table.withColumns({c: F.lit(1) for c in ("chunk", "tokens", "word", "place", "n", "row", "bytes", "held_out", "base", "c", "class")})
    got = [tuple(r) for r in hidden.score_documents(table, states=3, rounds=3).collect()]
    # The long text has a probability below the smallest double in the plain version.
    short = [r for r in AWKWARD if len(r[1] or "") < 1000]
    table = spark.createDataFrame(short, "doc_id long, text string")
    same([tuple(r) for r in hidden.score_documents(table, states=3, rounds=3).collect()], brute_scores(short, 3, 3))
    assert sorted(map(repr, ((g[0], *g[1:4]) for g in got))) == sorted(map(repr, ((r[0], *r[1:4]) for r in plain(AWKWARD)[0])))


def test_small_chunks_give_the_same(spark, monkeypatch):
    table = spark.createDataFrame([r for r in AWKWARD if len(r[1] or "") < 1000], "doc_id long, text string")
    one = [tuple(r) for r in hidden.score_documents(table, states=2, rounds=2).collect()]
    monkeypatch.setattr(hidden, "CHUNK", 100)
    same([tuple(r) for r in hidden.score_documents(table, states=2, rounds=2).collect()], one)


def test_nothing_to_learn_from(spark):
    table = spark.createDataFrame(AWKWARD, "doc_id long, text string")
    assert hidden.score_documents(table.limit(0)).count() == 0
    unseen = [r for r in AWKWARD if not trained_on(r[0])]
    got = hidden.score_documents(spark.createDataFrame(unseen, "doc_id long, text string"), rounds=1).collect()
    assert len(got) == len(unseen) and all(r["train_tokens"] == r["n_known"] == 0 and r["base_score"] == 0 and abs(r["score"]) < 1e-9 for r in got)


def test_documents(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()]
    got = [tuple(r) for r in QUERIES["op12_hidden_markov_scoring"](spark, SMALL).collect()]
    same([g[:6] for g in got], plain(rows)[0])
    # Unseen texts are likelier under the model than under the base.
    held = [g for g in got if g[1]]
    assert sum(g[6] for g in held) > 0.95 * sum(g[5] for g in held)


def test_emissions_are_distributions_and_rounds_improve(spark):
    corpus = hidden.encoded(spark.read.parquet(f"{SMALL}/documents.parquet"))
    model, found = hidden.train(corpus, states=4, rounds=4)
    assert np.allclose(model.emit.sum(axis=0), 1) and np.allclose(model.move.sum(axis=1), 1) and np.isclose(model.start.sum(), 1)
    assert found == sorted(found) and found[-1] > found[0]
