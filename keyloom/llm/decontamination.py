"""Benchmark decontamination: a broadcast hash set of normalised benchmark n-grams, scanned over every document.

A word is a run of digits, letters a-z (A-Z lower-cased) and non-ASCII characters. A window is ``WINDOW``
consecutive words of a benchmark item, or the whole item if it has fewer (but any). Windows are kept as
rolling hashes of word numbers; a hash hit is verified word by word before it counts.

The set is broadcast in blocks of about ``BLOCK_BYTES`` of benchmark text (items are dealt by hash, none is split). A
benchmark beyond one block is scanned block after block, and what earlier blocks found is carried along in a
written table, so the broadcast never grows with the benchmark.

Nulls and texts without words have no windows and no hits. Repeated items count once by ``item_id``; a null
``item_id`` reads as the empty string. Other columns of either table do not matter. Texts are scanned whole. An empty
table gives an empty result, an empty benchmark no hits.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keyloom.llm.common import free_name, quoted, utf8, written

WINDOW = 13
BLOCK_BYTES = 2 << 20
# Upper case to lower case, everything that is in no word to a space.
FOLD = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256)
)
WORD = re.compile(rb"[^ ]+")
FOUND = "n_words long, n_hit long, items array<string>, spans array<struct<first:long,last:long>>"

NOTHING = (
    "named_struct('n_words', 0L, 'n_hit', 0L, 'items', cast(array() as array<string>),"
    " 'spans', cast(array() as array<struct<first:bigint,last:bigint>>))"
)


def words_of(text: bytes) -> list[bytes]:
    return text.translate(FOLD).split()


class WindowSet:
    """The windows of some benchmark items."""

    def __init__(self, items: list[tuple[str, bytes]], window: int = WINDOW):
        self.number: dict[bytes, int] = {}
        self.items: dict[tuple[int, ...], set[str]] = defaultdict(set)
        for item, text in items:
            ids = [self.number.setdefault(w, len(self.number) + 1) for w in words_of(text)]
            for at in range(max(1, len(ids) - window + 1) if ids else 0):
                self.items[tuple(ids[at : at + window])].add(item)
        rng = np.random.default_rng(20240613)
        self.factors = rng.integers(1, 1 << 63, window, dtype=np.uint64) | np.uint64(1)
        by_length: dict[int, list[tuple[int, ...]]] = defaultdict(list)
        for ids in self.items:
            by_length[len(ids)].append(ids)
        self.hashes = {
            n: np.unique(self.rolling(np.array(rows, np.uint64).reshape(-1), n)[::n]) for n, rows in by_length.items()
        }

    def state(self) -> tuple:
        """Plain values, which any worker can read."""
        return self.number, dict(self.items), self.factors, self.hashes

    @classmethod
    def of(cls, state: tuple) -> WindowSet:
        made = cls([])
        made.number, made.items, made.factors, made.hashes = state
        return made

    def rolling(self, ids: np.ndarray, n: int) -> np.ndarray:
        """The hash of each run of ``n`` word numbers."""
        out = np.zeros(len(ids) - n + 1, np.uint64)
        for j in range(n):
            out += ids[j : len(ids) - n + 1 + j] * self.factors[j]
        return out

    def scan(self, text: bytes) -> tuple[int, list[tuple[int, int]], set[str]]:
        """Number of words, hit runs of words (first, last) and the items with occurring windows."""
        words = words_of(text)
        ids = np.fromiter(map(self.number.get, words, [0] * len(words)), np.uint64, len(words))
        found: set[str] = set()
        hit = np.zeros(len(words) + 1, np.int64)
        for n, hashes in self.hashes.items():
            if np.count_nonzero(ids) < n:
                continue
            rolled = self.rolling(ids, n)
            place = np.minimum(np.searchsorted(hashes, rolled), len(hashes) - 1)
            for at in np.flatnonzero(hashes[place] == rolled):
                items = self.items.get(tuple(ids[at : at + n].tolist()))
                if items:
                    found |= items
                    hit[at] += 1
                    hit[at + n] -= 1
        return len(words), runs(np.cumsum(hit)[:-1] > 0) if found else [], found


def runs(mask: np.ndarray) -> list[tuple[int, int]]:
    edges = np.flatnonzero(np.diff(np.concatenate(([False], mask, [False])).astype(np.int8)))
    return [(int(a), int(b) - 1) for a, b in zip(edges[::2], edges[1::2], strict=True)]


def united(a: list[tuple[int, int]], b: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for first, last in sorted([*a, *b]):
        if out and first <= out[-1][1] + 1:
            out[-1] = (out[-1][0], max(last, out[-1][1]))
        else:
            out.append((first, last))
    return out


def looking_for(windows: Broadcast) -> Callable[..., Column]:
    """A function of (text bytes, what earlier blocks found) that adds what these windows hit."""

    def look(texts: pd.Series, before: pd.DataFrame) -> pd.DataFrame:
        own, rows = WindowSet.of(windows.value), []
        for data, items_before, spans_before in zip(texts, before["items"], before["spans"], strict=True):
            n, spans, found = own.scan(bytes(data))
            if len(spans_before):
                spans = united(spans, [(s["first"], s["last"]) for s in spans_before])
                found |= set(items_before)
            marked = [{"first": a, "last": b} for a, b in spans]
            rows.append((n, sum(b - a + 1 for a, b in spans), sorted(found), marked))
        return pd.DataFrame(rows, columns=["n_words", "n_hit", "items", "spans"])

    return F.pandas_udf(look, FOUND)


def scan(docs: DataFrame, benchmark: DataFrame, text: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``docs`` with one more column, the last: a struct of n_words, n_hit, items (sorted) and hit word runs."""
    spark = docs.sparkSession
    items = benchmark.select(
        F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), utf8().alias("bytes")
    )
    size = items.agg(F.sum(F.octet_length("bytes"))).first()[0] or 0
    blocks = -(-size // block_bytes) or 1
    name = free_name(docs, "contamination")
    out = docs
    for block in range(blocks):
        part = items.filter(F.pmod(F.xxhash64("item", "bytes"), F.lit(blocks)) == block)
        # One block of the benchmark: bounded by block_bytes, or one item.
        windows = WindowSet([(r["item"], bytes(r["bytes"])) for r in part.collect()])
        windows = spark.sparkContext.broadcast(windows.state())

        look = looking_for(windows)
        before = quoted(name) if block else F.expr(NOTHING)
        out = out.withColumn(name, look(utf8(text), before))
        if block + 1 < blocks:
            out = written(out, "scanned")
    return out


def contaminated(found: str) -> Column:
    """At least one word in twenty is hit, and at least one."""
    hit, words = F.col(f"`{found}`.n_hit"), F.col(f"`{found}`.n_words")
    return (hit > 0) & (hit * 20 >= words)


def cut(texts: pd.Series, spans: pd.Series) -> pd.Series:
    """The texts without their hit words."""
    out = []
    for data, runs_of in zip(texts, spans, strict=True):
        data, keep, at = bytes(data), [], 0
        if len(runs_of):
            places = [m.span() for m in WORD.finditer(data.translate(FOLD))]
            for s in runs_of:
                keep.append(data[at : places[s["first"]][0]])
                at = places[s["last"]][1]
        out.append(b"".join([*keep, data[at:]]))
    return pd.Series(out)


def decontaminate(docs: DataFrame, benchmark: DataFrame, text: str = "text", remove: str = "documents") -> DataFrame:
    """``docs`` without its contaminated documents, or (``remove="spans"``) without the hit words of all texts."""
    found = scan(docs, benchmark, text)
    name = found.columns[-1]
    if remove == "documents":
        return found.filter(~contaminated(name)).drop(name)
    clean = F.when(F.size(F.col(f"`{name}`.spans")) > 0, F.pandas_udf(cut, "binary")(utf8(text), F.col(f"`{name}`.spans")).cast("string"))
    return found.withColumn(text, F.coalesce(clean, quoted(text))).drop(name)
