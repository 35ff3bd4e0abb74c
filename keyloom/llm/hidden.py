"""A hidden Markov language model: Baum-Welch over all training rows, exact likelihood by the scaled forward recursion.

Tokens are words and one end per text, so the probabilities of all texts add up to 1. A state emits a class of words, and
a class its words by their smoothed counts:

    P(text) = P_hmm(classes of its tokens) * product of base(word) / base(class),   base(w) = (c + 0.5) / (N + 0.5 (V + 1))

(base(class) is the sum over its words.) Words never seen in training are one type, as in ``base``; the model gives it, in every
state, the share of training tokens whose word occurs once, which is how often a next word is new.

The ``OWN`` most frequent words are classes of their own, all others share ``SHARED`` classes by hash, new words
are one class. So the model is a table of STATES x classes, of a fixed size whatever the
vocabulary; counts, vocabulary and the score's word terms cover every word. Each iteration runs the forward-backward recursion over
all training texts in all tasks; expected counts are summed per class by a grouping, and only the summed table reaches the driver.

Texts are tokenized in chunks of about ``CHUNK`` bytes. A chunk's different words meet the corpus counts by a join on the
word, so neither tokens nor the vocabulary pass through one place; the chunk's texts become lists of classes, written
once. In a task, texts are cut into pieces of ``PIECE`` tokens that run side by side; the pieces of a longer text are tied
together by their transfer matrices, so a very long text needs no more steps than a short one.

Null and empty texts are the end alone. A null id counts as the empty text and is learned from. Rows with equal ids or
texts are rows of their own, in learning as well. With nothing to learn from, every text has log-probability 0 under
both models. A table without rows gives no rows. Other columns are ignored.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keyloom.llm.common import utf8, written

STATES = 8
ROUNDS = 6
OWN, SHARED = 6142, 2048
UNKNOWN, END = 0, 1  # classes; then OWN, then SHARED
CLASSES = 2 + OWN + SHARED
COMMON = 0.1  # share of the base distribution in each state's emissions
STAY, STAY_WEIGHT = 0.9, 20.0  # transitions start, and are smoothed, towards staying
CHUNK = 16 << 20
PIECE = 512
BATCH = 1 << 19  # tokens worked on at a time
SEED = 41


def held_out() -> Column:
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 5 == 1


# Tokens ----------------------------------------------------------------------------

TOKENS = "chunk long, doc_id long, held_out boolean, tokens binary, word binary, place int, n long"


def tokenized(docs: DataFrame) -> DataFrame:
    """Rows of two kinds, by chunks: texts (``tokens``: places in the chunk's word list, 4 bytes each) and the chunk's words
    (``word``; ``place``, 0 being the end; ``n``: how often in training texts).
    """
    schema = pa.schema(
        [("chunk", pa.int64()), ("doc_id", pa.int64()), ("held_out", pa.bool_()), ("tokens", pa.binary()), ("word", pa.binary()), ("place", pa.int32()), ("n", pa.int64())]
    )

    def texts(chunk: int, rows: list[tuple]) -> pa.RecordBatch:
        n = len(rows)
        ids, held, tokens = zip(*rows, strict=True)
        nothing = [pa.nulls(n, schema.field(c).type) for c in ("word", "place", "n")]
        return pa.RecordBatch.from_arrays([pa.array([chunk] * n, pa.int64()), pa.array(ids, pa.int64()), pa.array(held, pa.bool_()), pa.array(tokens, pa.binary()), *nothing], schema=schema)

    def words(chunk: int, places: dict, counts: np.ndarray) -> Iterator[pa.RecordBatch]:
        found = list(places)
        for at in range(0, len(found), 20000):
            part = found[at : at + 20000]
            nothing = [pa.nulls(len(part), schema.field(c).type) for c in ("doc_id", "held_out", "tokens")]
            own = [pa.array(part, pa.binary()), pa.array(np.arange(at, at + len(part), dtype=np.int32)), pa.array(counts[at : at + len(part)])]
            yield pa.RecordBatch.from_arrays([pa.array([chunk] * len(part), pa.int64()), *nothing, *own], schema=schema)

    def empty() -> tuple[defaultdict, np.ndarray]:
        places: defaultdict = defaultdict()
        places.default_factory = places.__len__  # a new word gets the next place
        places[None] = 0  # the end
        return places, np.zeros(0, np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (places, counts), chunk, rows, size, held = empty(), None, [], 0, 0

        def flush() -> pa.RecordBatch:
            nonlocal counts
            seen = [np.frombuffer(t, np.int32) for _, out, t in rows if not out]
            new = np.bincount(np.concatenate(seen), minlength=len(places)) if seen else np.zeros(len(places), np.int64)
            new[: len(counts)] += counts
            counts = new
            return texts(chunk, rows)

        for whole in batches:
            for at in range(0, len(whole), 64):
                for row in whole.slice(at, 64).to_pylist():
                    chunk = row["row"] if chunk is None else chunk
                    split = [*row["bytes"].lower().split(), None]
                    tokens = np.fromiter(map(places.__getitem__, split), np.int32, len(split)).tobytes()
                    rows.append((row["doc_id"], row["held_out"], tokens))
                    size, held = size + len(row["bytes"]), held + len(tokens)
                    if held > 4 << 20 or size > CHUNK:
                        yield flush()
                        rows, held = [], 0
                    if size > CHUNK:
                        yield from words(chunk, places, counts)
                        (places, counts), chunk, size = empty(), None, 0
        if rows:
            yield flush()
        if chunk is not None:
            yield from words(chunk, places, counts)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out().alias("held_out"), utf8().alias("bytes"))
    return rows.withColumn("row", F.monotonically_increasing_id()).mapInArrow(run, TOKENS)


# Chunk words with what the corpus says of them --------------------------------------


@dataclass(frozen=True)
class Corpus:
    """``texts``: rows of ``ENCODED``; ``tokens``: how many were learned from; ``base``: the classes' shares among the next tokens."""

    texts: DataFrame
    tokens: int
    base: np.ndarray


ENCODED = "doc_id long, held_out boolean, codes binary, n_tokens long, n_known long, base double, rest double"


def encoded(docs: DataFrame) -> Corpus:
    """Every text as its list of classes, with what its words say by themselves."""
    rows = written(tokenized(docs), "tokens")
    ends = rows.filter("place = 0").agg(F.sum("n")).first()[0] or 0
    listed = rows.filter("place > 0").select("chunk", "place", "word", "n")
    counts = written(listed.groupBy("word").agg(F.sum("n").alias("c")), "vocabulary")  # one row per different word
    known = counts.filter("c > 0")
    total = known.agg(F.sum("c"), F.count("*"), F.count_if(F.col("c") == 1)).first()
    tokens, types, once = ends + (total[0] or 0), int(ends > 0) + total[1], total[2]
    mass = tokens + 0.5 * (types + 1)
    top = known.orderBy(F.desc("c"), "word").limit(OWN).select("word").collect()  # at most OWN words
    own = counts.sparkSession.createDataFrame([(bytes(r[0]), 2 + k) for k, r in enumerate(top)], "word binary, own int")
    shared = F.lit(2 + OWN) + F.pmod(F.xxhash64("word"), F.lit(SHARED)).cast("int")
    kind = F.when(F.col("c") == 0, UNKNOWN).otherwise(F.coalesce("own", shared))
    classed = counts.join(F.broadcast(own), "word", "left").select("word", "c", kind.alias("class"))
    sums = classed.filter("c > 0").groupBy("class").agg(F.sum("c").alias("c"), F.count("*").alias("types")).collect()  # at most CLASSES
    base = np.zeros(CLASSES)
    base[UNKNOWN], base[END] = 0.5 / mass, (ends + 0.5) / mass if ends else 0
    for r in sums:
        base[r["class"]] = (r["c"] + 0.5 * r["types"]) / mass
    new = (once + 0.5) / mass if ends else 1.0
    shares = base * (1 - new) / max(1 - base[UNKNOWN], 1e-300)
    shares[UNKNOWN] = new
    met = listed.join(classed, "word").select("chunk", "place", "c", "class")  # a word is once in a chunk
    texts = rows.filter("place is null").select("chunk", "doc_id", "held_out", "tokens")
    both = met.unionByName(texts, allowMissingColumns=True).repartition("chunk").sortWithinPartitions("chunk", F.asc_nulls_last("place"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return encode(batches, base, mass, ends)

    return Corpus(written(both.mapInArrow(run, ENCODED), "encoded"), tokens, shares)


def encode(batches: Iterator[pa.RecordBatch], base: np.ndarray, mass: float, ends: int) -> Iterator[pa.RecordBatch]:
    """Texts as classes; a chunk's words come before its texts."""
    chunk, parts, table = None, [], None
    own = np.log10(np.where(base > 0, base, 1))
    for whole in batches:
        for at in range(0, len(whole), 2000):
            batch = whole.slice(at, 2000)
            chunks = batch.column("chunk").to_numpy()
            cut = np.flatnonzero(np.concatenate([[True], np.diff(chunks) != 0, [True]]))
            for a, b in zip(cut, cut[1:], strict=False):
                if chunks[a] != chunk:
                    chunk, parts, table = chunks[a], [(np.zeros(1, np.int64), np.array([ends]), np.array([END if ends else UNKNOWN]))], None
                rows = batch.slice(a, b - a)
                n = len(rows) - rows.column("place").null_count
                if n:
                    parts.append(tuple(rows.column(c).slice(0, n).to_numpy().astype(np.int64) for c in ("place", "c", "class")))
                if n == len(rows):
                    continue
                if table is None:
                    place, c, kind = map(np.concatenate, zip(*parts, strict=True))
                    order = np.argsort(place)
                    c, kind = c[order], kind[order]
                    word = np.log10((c + 0.5) / mass)
                    table = c > 0, kind.astype(np.uint16), word, word - own[kind]
                known, kind, word, rest = table
                rows = rows.slice(n)
                each = [np.frombuffer(t, np.int32) for t in rows.column("tokens").to_pylist()]
                columns = [rows.column("doc_id"), rows.column("held_out"), pa.array([kind[t].tobytes() for t in each], pa.binary())]
                columns += [pa.array([len(t) for t in each], pa.int64()), pa.array([int(known[t].sum()) for t in each], pa.int64())]
                columns += [pa.array([float(x[t].sum()) for t in each], pa.float64()) for x in (word, rest)]
                yield pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in ENCODED.split(", ")])


# The model ---------------------------------------------------------------------------


@dataclass(frozen=True)
class Model:
    """``start``: states of the first token; ``move``: from state to state; ``emit``: a row per class, a column per state."""

    start: np.ndarray
    move: np.ndarray
    emit: np.ndarray


def sticky(states: int) -> np.ndarray:
    if states == 1:
        return np.ones((1, 1))
    return np.full((states, states), (1 - STAY) / (states - 1)) + np.eye(states) * (STAY - (1 - STAY) / (states - 1))


def mixed(own: np.ndarray, base: np.ndarray) -> np.ndarray:
    """Emissions: a state's own distribution over the known classes and, with weight ``COMMON``, the base; new words alike."""
    emit = (1 - base[UNKNOWN]) * (1 - COMMON) * own / own.sum(axis=0)
    emit += COMMON * base[:, None]
    emit[UNKNOWN] = base[UNKNOWN]
    return emit


def refitted(model: Model, start: np.ndarray, move: np.ndarray, emit: np.ndarray, base: np.ndarray) -> Model:
    """The model after a round: of a token's expected count, a state's own distribution gets the share that was its own."""
    states = len(start)
    common = COMMON * base[:, None] / np.where(model.emit > 0, model.emit, 1)
    own = emit * (1 - common)
    own[UNKNOWN] = 0
    own += 1e-6 * known(base)[:, None]  # a state without tokens falls back to the base
    move = move + STAY_WEIGHT * sticky(states)
    return Model((start + 1) / (start + 1).sum(), move / move.sum(axis=1, keepdims=True), mixed(own, base))


def known(base: np.ndarray) -> np.ndarray:
    """The base without new words; if nothing is known, a stand-in that no token meets."""
    out = base.copy()
    out[UNKNOWN] = 0
    return out if out.any() else np.eye(len(base))[END]


def first_model(base: np.ndarray, states: int, seed: int = SEED) -> Model:
    """The base distribution, disturbed at random so that states can part."""
    noise = np.exp(0.5 * np.random.default_rng(seed).standard_normal((len(base), states)))
    return Model(np.full(states, 1 / states), sticky(states), mixed(known(base)[:, None] * noise, base))


class Pieces:
    """Token lists cut into pieces of ``PIECE``, longest first, so that step ``t`` concerns the first ``active[t]``."""

    def __init__(self, codes: list[np.ndarray], piece: int):
        self.flat = np.concatenate(codes).astype(np.int64)
        lengths = np.array([len(c) for c in codes])
        count = -(-lengths // piece)
        self.text = np.repeat(np.arange(len(codes)), count)
        number = np.arange(len(self.text)) - np.repeat(np.cumsum(count) - count, count)
        start = np.repeat(np.cumsum(lengths) - lengths, count) + number * piece
        size = np.minimum(piece, np.repeat(lengths, count) - number * piece)
        order = np.argsort(-size, kind="stable")
        self.place = np.empty_like(order)  # where a piece, counted text by text, stands
        self.place[order] = np.arange(len(order))
        self.text, self.number, self.start, self.size = (x[order] for x in (self.text, number, start, size))
        self.last = number[order] == np.repeat(count, count)[order] - 1
        self.active = np.searchsorted(-self.size, -np.arange(1, self.size.max() + 1), "right")
        self.follows = [self.place[np.flatnonzero(number == k)] for k in range(1, int(count.max()))]  # pieces by number
        self.before = np.where(self.number > 0, self.place[np.maximum(order - 1, 0)], -1)

    def codes(self, t: int) -> np.ndarray:
        return self.flat[self.start[: self.active[t]] + t]


def unit(x: np.ndarray) -> np.ndarray:
    return x / x.sum(axis=-1, keepdims=True)


def borders(pieces: Pieces, model: Model, backward: bool) -> tuple[np.ndarray, np.ndarray]:
    """What is expected before each piece's first token, and what the rest of its text says of the state after its last."""
    states = len(model.start)
    ahead = np.repeat(model.start[None], len(pieces.text), axis=0)
    behind = np.ones_like(ahead)
    several = np.flatnonzero(~pieces.last | (pieces.number > 0) if backward else ~pieces.last)
    if not len(several):
        return ahead, behind
    through = np.repeat(np.eye(states)[None], len(several), axis=0)  # transfer matrices
    step, emit, first = np.empty_like(through), np.empty((len(several), states)), pieces.start[several]
    for t in range(pieces.size[several[0]]):
        n = int(np.searchsorted(several, pieces.active[t]))
        np.take(model.emit, pieces.flat[first[:n] + t], axis=0, out=emit[:n], mode="clip")
        np.multiply(through[:n], emit[:n, None, :], out=step[:n])
        np.matmul(step[:n].reshape(-1, states), model.move, out=through[:n].reshape(-1, states))
        if t % 16 == 15:  # a class has a probability of 1e-18 or more, so 16 steps do not vanish
            through[:n] /= through[:n].sum(axis=(1, 2), keepdims=True)
    at = np.full(len(pieces.text), -1)
    at[several] = np.arange(len(several))
    for own in pieces.follows:
        before = pieces.before[own]
        ahead[own] = unit(np.einsum("pi,pij->pj", ahead[before], through[at[before]]))
    if backward:
        for own in reversed(pieces.follows):
            behind[pieces.before[own]] = unit(np.einsum("pij,pj->pi", through[at[own]], behind[own]))
    return ahead, behind


def log_likelihood(codes: list[np.ndarray], model: Model, piece: int = PIECE) -> np.ndarray:
    """Natural logarithm of each list's probability, by the scaled forward recursion."""
    pieces = Pieces(codes, piece)
    ahead, _ = borders(pieces, model, False)
    own, ones, joint = np.zeros(len(pieces.text)), np.ones(len(model.start)), np.empty_like(ahead)
    for t, n in enumerate(pieces.active):
        np.take(model.emit, pieces.codes(t), axis=0, out=joint[:n], mode="clip")
        joint[:n] *= ahead[:n]
        scale = joint[:n] @ ones
        own[:n] += np.log(scale)
        joint[:n] /= scale[:, None]
        np.matmul(joint[:n], model.move, out=ahead[:n])
    return np.bincount(pieces.text, own, len(codes))


def expected_counts(codes: list[np.ndarray], model: Model, classes: int, piece: int = PIECE) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
    """Expected starts, moves and emissions (the forward-backward recursion), and the log-likelihood."""
    pieces = Pieces(codes, piece)
    states, first = len(model.start), np.concatenate([[0], np.cumsum(pieces.active)])
    ones, back_move = np.ones(states), np.ascontiguousarray(model.move.T)
    ahead, behind = borders(pieces, model, True)
    # Per token, step after step: its class, the states expected before it, those given it, and its probability.
    kinds = np.concatenate([pieces.codes(t) for t in range(len(pieces.active))])
    expected, given, scale, tail = np.empty((first[-1], states)), np.empty((first[-1], states)), np.empty(first[-1]), np.empty_like(ahead)
    for t, n in enumerate(pieces.active):
        own = slice(first[t], first[t + 1])
        joint = given[own]
        np.take(model.emit, kinds[own], axis=0, out=joint, mode="clip")
        expected[own] = ahead[:n]
        joint *= ahead[:n]
        np.matmul(joint, ones, out=scale[own])
        joint /= scale[own, None]
        ends = int(pieces.active[t + 1]) if t + 1 < len(pieces.active) else 0
        tail[ends:n] = joint[ends:]
        np.matmul(joint, model.move, out=ahead[:n])
    moves, says = np.zeros((states, states)), np.empty_like(ahead)
    back = behind @ back_move
    for t in range(len(pieces.active) - 1, -1, -1):
        n, own = pieces.active[t], slice(first[t], first[t + 1])
        said = says[:n]
        np.take(model.emit, kinds[own], axis=0, out=said, mode="clip")
        said *= back[:n]
        said /= np.einsum("ij,ij->i", expected[own], said)[:, None]
        expected[own] *= said  # the states given the whole text
        if t:
            moves += given[first[t - 1] : first[t - 1] + n].T @ said
            np.matmul(said, back_move, out=back[:n])
    later = np.flatnonzero(pieces.number > 0)
    moves += tail[pieces.before[later]].T @ says[later]
    starts = expected[: first[1]][pieces.number == 0].sum(axis=0)
    emit = np.stack([np.bincount(kinds, expected[:, k], classes) for k in range(states)], axis=1)
    return starts, moves * model.move, emit, float(np.log(scale).sum())


def in_batches(batches: Iterator[pa.RecordBatch], size: int = BATCH) -> Iterator[tuple[pa.RecordBatch, list[np.ndarray]]]:
    """Rows of about ``size`` tokens, or one row that has more."""
    for whole in batches:
        ends = np.cumsum(whole.column("n_tokens").to_numpy())
        at = 0
        while at < len(whole):
            end = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + size, "right")))
            batch = whole.slice(at, end - at)
            yield batch, [np.frombuffer(c, np.uint16) for c in batch.column("codes").to_pylist()]
            at = end


def train(corpus: Corpus, states: int = STATES, rounds: int = ROUNDS) -> tuple[Model, list[float]]:
    """Baum-Welch: the model after ``rounds`` rounds over all training texts, and each round's log-likelihood before it."""
    model, found = first_model(corpus.base, states), []
    seen = corpus.texts.filter("not held_out").select("codes", "n_tokens")
    columns = [f"s{k}" for k in range(states)]
    # Rows of the summed table: classes, then the starts, then the moves out of each state, then the log-likelihood.
    schema = ", ".join(["item int", *(f"{c} double" for c in columns)])

    for _ in range(rounds):

        def run(batches: Iterator[pa.RecordBatch], model: Model = model) -> Iterator[pa.RecordBatch]:
            table = np.zeros((CLASSES + states + 2, states))
            for _, codes in in_batches(batches):
                starts, moves, emit, total = expected_counts(codes, model, CLASSES)
                table[:CLASSES] += emit
                table[CLASSES] += starts
                table[CLASSES + 1 : -1] += moves
                table[-1, 0] += total
            items = np.flatnonzero(table.any(axis=1))
            yield pa.RecordBatch.from_arrays([pa.array(items.astype(np.int32)), *(pa.array(table[items, k]) for k in range(states))], ["item", *columns])

        sums = seen.mapInArrow(run, schema).groupBy("item").agg(*[F.sum(c).alias(c) for c in columns]).collect()  # CLASSES + states + 2 rows at most
        table = np.zeros((CLASSES + states + 2, states))
        for r in sums:
            table[r["item"]] = r[1:]
        model = refitted(model, table[CLASSES], table[CLASSES + 1 : -1], table[:CLASSES], corpus.base)
        found.append(float(table[-1, 0]))
    return model, found


SCORED = "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double"


def scores(corpus: Corpus, model: Model) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [c.split()[0] for c in SCORED.split(", ")]
        for batch, codes in in_batches(batches):
            score = log_likelihood(codes, model) / np.log(10) + batch.column("rest").to_numpy()
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("doc_id", "held_out", "n_tokens", "n_known", "base")), pa.array(score)], names)

    return corpus.texts.mapInArrow(run, SCORED).withColumn("train_tokens", F.lit(corpus.tokens).cast("long"))


def score_documents(docs: DataFrame, states: int = STATES, rounds: int = ROUNDS) -> DataFrame:
    corpus = encoded(docs)
    model, _ = train(corpus, states, rounds)
    return scores(corpus, model).select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")
