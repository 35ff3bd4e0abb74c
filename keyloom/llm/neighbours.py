"""Approximate nearest neighbours by randomly rotated one-bit codes.

Index. Every vector is rotated by a fixed random rotation and stored as the signs of its coordinates (packed into
64-bit words) with two scalars: its length and the inner product ``own`` of its direction with its own code. Short
vectors are padded to ``LEAST_BITS`` coordinates before they are rotated, because the error falls with the
code's length.

Search. The rotated query is rounded to ``QUERY_BITS`` bits a coordinate, and its inner product with a code is the sum of the
bits that code words and the query's bit planes have in common. Divided by ``own`` it estimates the true inner product without
bias; the error stays below ``EPSILON`` standard deviations with very high probability. The best estimates of a query are
scored exactly and their k-th best score is a floor; a vector is reranked by its exact inner product only if its
estimate plus the bound reaches the floor.

Queries and codes meet in a grid: strips of about ``QUERY_STRIP`` queries and of about ``CODE_STRIP`` codes, one task's work
per pair of strips. Strips are dealt by a hash of the row, so that no vector, however often it occurs, makes one of them
large, and no query passes the driver. A pair of strips returns at most k rows per query. Every row is a candidate of every
query, so the work grows with queries times rows; codes only make a pair cheap.

Vectors that are null, empty, zero, or hold nulls or non-finite numbers take no part, nor do null ids. Vectors have an inner
product with vectors of their own length only, so each length is searched by itself. Rows whose id repeats are rows like
others: each is a candidate and, if asked for, a query. Equal scores go by id. Extra columns are ignored, an
empty table gives an empty result, and a query without candidates has no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keyloom.llm.common import written

EPSILON = 3.0
LEAST_BITS, QUERY_BITS = 256, 4
QUERY_STRIP, CODE_STRIP = 2048, 16384
SEED = 977


def code_bits(dim: int) -> int:
    """The length of a vector's code: whole 64-bit words."""
    return max(LEAST_BITS, -(-dim // 64) * 64)


def rotation(dim: int, seed: int = SEED) -> np.ndarray:
    """The columns of a random orthogonal matrix that meet a vector's own coordinates; the others meet the padding."""
    bits = code_bits(dim)
    q, r = np.linalg.qr(np.random.default_rng(seed).standard_normal((bits, bits)))
    return (q * np.sign(np.diag(r)))[:, :dim]


def usable(vectors: DataFrame) -> DataFrame:
    """(row, vec_id, dim, vector) of the vectors that take part; single precision stays as it is."""
    single = vectors.schema["embedding"].dataType == T.ArrayType(T.FloatType())
    vector = F.col("embedding").cast("array<float>" if single else "array<double>")
    each = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), vector.alias("vector"))
    fine = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    each = each.filter("vec_id is not null and size(vector) > 0").filter(fine).filter(F.exists("vector", lambda x: x != 0))
    return each.select(F.monotonically_increasing_id().alias("row"), "vec_id", F.size("vector").alias("dim"), "vector")


def matrix(column: pa.Array | pa.ChunkedArray, dim: int) -> np.ndarray:
    """Vectors of one length as double precision rows."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)


def directions(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Unit vectors and lengths; huge and tiny vectors neither overflow nor vanish."""
    big = np.abs(v).max(axis=1)
    length = np.linalg.norm(v / big[:, None], axis=1)
    return v / big[:, None] / length[:, None], length * big


def encode(vectors: DataFrame) -> DataFrame:
    """The index, written: one row per vector with its code and correction scalars."""
    schema = T.StructType(
        [*vectors.schema.fields, T.StructField("code", T.BinaryType()), T.StructField("length", T.DoubleType()), T.StructField("own", T.DoubleType())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turns = {}
        for whole in batches:
            dims = whole.column("dim").to_numpy()
            for dim in np.unique(dims).tolist():
                if dim not in turns:
                    turns = {dim: rotation(dim)}  # one at a time: lengths that mix in a batch are rare
                same = whole.filter(pa.array(dims == dim))
                for at in range(0, len(same), 4096):
                    batch = same.slice(at, 4096)
                    unit, length = directions(matrix(batch.column("vector"), dim))
                    turned = unit @ turns[dim].T
                    own = np.abs(turned).sum(axis=1) / np.sqrt(turned.shape[1])
                    codes = [c.tobytes() for c in np.packbits(turned > 0, axis=1)]
                    added = [pa.array(codes, pa.binary()), pa.array(length), pa.array(own)]
                    yield pa.RecordBatch.from_arrays([*batch.columns, *added], schema.names)

    return written(vectors.mapInArrow(run, schema), "codes")


class Codes:
    """The codes of one strip, ready to be compared with queries."""

    def __init__(self, strip: pa.Table, dim: int):
        self.bits = code_bits(dim)
        packed = np.frombuffer(b"".join(strip.column("code").to_pylist()), np.uint64).reshape(len(strip), -1)
        self.words = np.ascontiguousarray(packed.T)
        self.ones = np.bitwise_count(packed).sum(axis=1, dtype=np.int64).astype(np.float64)
        length, own = strip.column("length").to_numpy(), strip.column("own").to_numpy()
        self.scale = length / (own * np.sqrt(self.bits))
        self.slack = length * (np.sqrt(np.maximum(0, 1 - own**2)) / own * (EPSILON / np.sqrt(self.bits - 1)) + 1e-9)

    def estimates(self, turned: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For rotated unit queries: estimated inner products with every vector, and how far they may be too small."""
        low = turned.min(axis=1)
        step = (turned.max(axis=1) - low) / ((1 << QUERY_BITS) - 1)
        step[step == 0] = 1
        levels = np.rint((turned - low[:, None]) / step[:, None]).astype(np.uint8)
        rounded = low[:, None] + step[:, None] * levels
        common = np.zeros((len(turned), len(self.scale)), np.uint16 if self.bits < 4096 else np.uint32)
        both, count = np.empty(common.shape, np.uint64), np.empty(common.shape, np.uint8)
        for plane in reversed(range(QUERY_BITS)):
            query = np.packbits(levels >> plane & 1, axis=1).view(np.uint64)
            common <<= 1
            for word in range(len(self.words)):
                np.bitwise_and(query[:, word, None], self.words[word], out=both)
                np.bitwise_count(both, out=count)
                common += count
        guess = common * (2 * step[:, None])
        guess += (2 * low)[:, None] * self.ones
        guess -= rounded.sum(axis=1)[:, None]
        guess *= self.scale
        off = EPSILON * np.linalg.norm(turned - rounded, axis=1)
        return guess, off[:, None] * self.scale + self.slack


class Best:
    """The k best (score, smaller id first) per query seen so far."""

    def __init__(self, queries: int, k: int):
        self.k, self.floor = k, np.full(queries, -np.inf)
        self.q, self.score, self.id = np.zeros(0, np.int64), np.zeros(0), np.zeros(0, np.int64)

    def add(self, q: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        good = score >= self.floor[q]
        q, score, ids = (np.concatenate(x) for x in ((self.q, q[good]), (self.score, score[good]), (self.id, ids[good])))
        order = np.lexsort((ids, -score, q))
        q, score, ids = q[order], score[order], ids[order]
        rank = np.arange(len(q)) - np.searchsorted(q, q, "left")
        keep = rank < self.k
        self.q, self.score, self.id = q[keep], score[keep], ids[keep]
        last = rank == self.k - 1
        self.floor[q[last]] = score[last]


def exact(queries: np.ndarray, vectors: np.ndarray, qi: np.ndarray, ci: np.ndarray) -> np.ndarray:
    """Inner products of pairs in double precision, the same for equal pairs whatever stands beside them."""
    out = np.empty(len(qi))
    for at in range(0, len(qi), 1024):
        part = slice(at, at + 1024)
        out[part] = (queries[qi[part]] * vectors[ci[part]]).sum(axis=1)
    return out


def first_floor(guess: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs worth scoring first: the best estimate of each query in each of several stretches of the strip."""
    stretches = min(8 * k, guess.shape[1])
    edges = np.linspace(0, guess.shape[1], stretches + 1).astype(np.int64)
    best = np.empty((len(guess), stretches), np.int64)
    for i in range(stretches):
        best[:, i] = edges[i] + guess[:, edges[i] : edges[i + 1]].argmax(axis=1)
    return np.repeat(np.arange(len(guess)), stretches), best.reshape(-1)


FOUND = "query_row long, query_id long, vec_id long, score double"
FOUND_ARROW = pa.schema([("query_row", pa.int64()), ("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])


def search_strips(k: int):
    """The search of one strip of queries among one strip of codes: at most k rows per query."""

    def run(key: tuple, asked: pa.Table, strip: pa.Table) -> pa.Table:
        dim = key[0].as_py()
        if not (len(asked) and len(strip)):
            return FOUND_ARROW.empty_table()
        queries, vectors = matrix(asked.column("asked_vector"), dim), matrix(strip.column("vector"), dim)
        unit, norms = directions(queries)
        turned, codes, best = unit @ rotation(dim).T, Codes(strip, dim), Best(len(queries), k)
        names, rows, own = strip.column("vec_id").to_numpy(), strip.column("row").to_numpy(), asked.column("asked_row").to_numpy()

        def rerank(into: Best, qi: np.ndarray, ci: np.ndarray) -> None:
            other = rows[ci] != own[qi]
            into.add(qi[other], exact(queries, vectors, qi[other], ci[other]), names[ci[other]])

        for at in range(0, len(queries), 16):
            part = slice(at, at + 16)
            guess, slack = codes.estimates(turned[part])
            trial = Best(len(queries), k)
            qi, ci = first_floor(guess, k)
            rerank(trial, qi + at, ci)
            guess += slack
            guess *= norms[part, None]
            qi, ci = np.nonzero(~(guess < trial.floor[part, None]))
            rerank(best, qi + at, ci)
        found = [own[best.q], asked.column("asked_vec_id").to_numpy()[best.q], best.id, best.score]
        return pa.table(list(map(pa.array, found)), schema=FOUND_ARROW)

    return run


def in_grid(rows: DataFrame, lengths: DataFrame, own: str, other: str) -> DataFrame:
    """``rows`` with their own strip, once for every strip of the other side."""
    dealt = rows.join(lengths, "dim").withColumn(own, F.pmod(F.xxhash64("row"), f"{own}s"))
    return dealt.withColumn(other, F.explode(F.sequence(F.lit(0).cast("long"), F.col(f"{other}s") - 1))).drop(f"{own}s", f"{other}s")


def nearest(vectors: DataFrame, wanted: Column, k: int = 20, query_strip: int = QUERY_STRIP, code_strip: int = CODE_STRIP) -> DataFrame:
    """The k nearest (largest inner product) of every usable row whose ``vec_id`` meets ``wanted``, itself excepted."""
    codes = encode(usable(vectors))

    def strips(rows: Column, size: int) -> Column:
        return F.greatest(F.ceil(rows / size), F.lit(1))

    lengths = codes.groupBy("dim").agg(strips(F.count("*"), code_strip).alias("c_strips"), strips(F.count_if(wanted), query_strip).alias("q_strips"))
    lengths = written(lengths, "lengths")  # one row per length of vectors
    asked = in_grid(codes.filter(wanted).select("row", "vec_id", "dim", "vector"), lengths, "q_strip", "c_strip")
    asked = asked.select(*(F.col(name).alias(f"asked_{name}") for name in asked.columns))
    strip = in_grid(codes, lengths, "c_strip", "q_strip")
    cell = ("dim", "q_strip", "c_strip")
    pairs = asked.groupBy(*(f"asked_{name}" for name in cell)).cogroup(strip.groupBy(*cell))
    found = pairs.applyInArrow(search_strips(k), FOUND)
    order = Window.partitionBy("query_row").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
