"""Removal of long repeated byte strings through run-length Burrows-Wheeler indexes.

A byte goes if a ``LENGTH``-byte string that covers it also starts anywhere else, in the same document or in
another. The work is dealt out so that equal strings meet and no task holds the corpus:

1. Every ``LENGTH``-byte window has an anchor: its ``GRAM``-byte piece with the smallest hash, the leftmost of
   equals. Equal windows have equal anchors. Consecutive windows with one anchor make a segment, and each
   window is in exactly one segment. Segments of anchors that occur once hold no repeat.
2. Equal segments collapse to one with a count; a count of two marks all its windows.
3. The different segments of an anchor go to one task, which builds an index of a few megabytes of segments at a
   time: their Burrows-Wheeler transform in runs, text positions sampled at run ends, and the lengths of the
   matches that begin there. The segments are then streamed through the runs from their ends to their starts,
   which gives the longest match of every position with everything else in the index, and windows whose
   longest match reaches ``LENGTH`` are marked.
4. An anchor with more than ``MOST`` different segments is too much for one index; its windows are keyed by
   their whole content instead, which spreads them, and meet by that key.

A null text is empty. Equal documents are worked on once; with at least ``LENGTH`` bytes they go whole. Very
long texts are worked on in pieces of ``PIECE`` windows, which cut segments but no window. Repeated and null
ids are rows like any other, extra columns are ignored, an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keyloom.llm.common import byte_blocks, distinct_texts, mix64, text_key, utf8, written
from keyloom.session import shuffle_width

LENGTH, GRAM = 400, 48
MOST = 4096
INDEX_BYTES = 2 << 20
PIECE = 1 << 20
PLACE_BITS = 22  # a piece and its last window fit


def gram_hashes(data: np.ndarray, gram: int = GRAM) -> np.ndarray:
    """A hash of the ``gram`` bytes from each position on."""
    n, out, width, words = len(data), None, 1, data.astype(np.uint64) + np.uint64(1)
    at, left = 0, gram
    while left:
        if left & width:
            piece = words[at : at + n - gram + 1]
            out = piece.copy() if out is None else mix64(out * np.uint64(0x9E3779B97F4A7C15) + piece)
            at, left = at + width, left - width
        if left:
            words = mix64(words[:-width] * np.uint64(0xD6E8FEB86659FD93) + words[width:]) if width > 4 else (words[:-width] << np.uint64(8 * width)) ^ words[width:]
            width *= 2
    return mix64(out)


def anchors(data: np.ndarray, length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Segments of one piece of text: first window, number of windows, anchor hash."""
    windows, w = len(data) - length + 1, length - gram + 1
    hashes = gram_hashes(data, gram)
    place = np.uint64((1 << PLACE_BITS) - 1)
    value = (hashes & ~place) | np.arange(len(hashes), dtype=np.uint64)
    padded = np.full(-(-len(value) // w) * w, np.iinfo(np.uint64).max)
    padded[: len(value)] = value
    blocks = padded.reshape(-1, w)
    ahead = np.minimum.accumulate(blocks, axis=1).reshape(-1)
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    least = np.minimum(behind[:windows], ahead[w - 1 : w - 1 + windows]) & place
    starts = np.concatenate(([0], np.flatnonzero(least[1:] != least[:-1]) + 1))
    counts = np.diff(np.concatenate((starts, [windows])))
    return starts, counts, hashes[least[starts].astype(np.int64)].view(np.int64)


SEGMENTS = "t_key binary, start long, windows int, anchor long, segment binary"


def segments(texts: DataFrame) -> DataFrame:
    """(t_key, start, windows, anchor, segment): every window of every text once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column("t_key")
            for first, end, data, offsets in byte_blocks(batch.column("bytes")):
                row, start, count, anchor, digest = [], [], [], [], []
                raw = data.tobytes()
                for i in range(end - first):
                    a, b = int(offsets[i]), int(offsets[i + 1])
                    for at in range(a, b - LENGTH + 1, PIECE):
                        s, n, h = anchors(data[at : min(b, at + PIECE + LENGTH - 1)])
                        row.append(np.full(len(s), first + i))
                        start.append(s + (at - a))
                        count.append(n)
                        anchor.append(h)
                        ends = (s + n + (at + LENGTH - 1)).tolist()
                        digest += [hashlib.blake2b(raw[x:y], digest_size=16).digest() for x, y in zip((s + at).tolist(), ends, strict=True)]
                if row:
                    yield pa.RecordBatch.from_arrays(
                        [
                            keys.take(pa.array(np.concatenate(row))),
                            pa.array(np.concatenate(start), pa.int64()),
                            pa.array(np.concatenate(count), pa.int32()),
                            pa.array(np.concatenate(anchor), pa.int64()),
                            pa.array(digest, pa.binary()),
                        ],
                        ["t_key", "start", "windows", "anchor", "segment"],
                    )

    return texts.filter(F.octet_length("bytes") >= LENGTH).select("t_key", "bytes").mapInArrow(run, SEGMENTS)


class RunLengthIndex:
    """The Burrows-Wheeler transform of some strings in runs, with samples at run ends.

    Per run: its first row (``first``), its symbol, its length, the row that the step to the symbol before leads its
    first row to (``to``), and the length of the match there with the row above its first row (``above``) and
    below its last row (``below``). ``head`` and ``tail`` are the text positions sampled at its ends.
    """

    STEP = 7  # symbols of 9 bits in a word: byte + 1, and 0 beyond the end

    def __init__(self, strings: list[bytes]):
        lengths = np.array([len(s) for s in strings], np.int64)
        self.starts = np.concatenate(([0], np.cumsum(lengths + 1)))
        symbols = np.frombuffer(b"\0".join([*strings, b""]), np.uint8).astype(np.int64) + 1
        ends = self.starts[1:] - 1
        symbols[ends] = 0
        self.left = np.repeat(ends, lengths + 1) - np.arange(len(symbols))  # symbols up to the string's end
        self.words = self.packed(symbols)
        order = self.suffix_order()  # the strings' ends come first, in the strings' order
        before = np.where(order > 0, symbols[order - 1], 0)  # the transform; 0 where a string starts
        self.first = np.flatnonzero(np.concatenate(([True], (before[1:] != before[:-1]) | (before[1:] == 0))))
        self.symbols, self.run_lengths = before[self.first], np.diff(np.concatenate((self.first, [len(order)])))
        self.head, self.tail = order[self.first], order[self.first + self.run_lengths - 1]

        by_symbol = np.argsort(self.symbols, kind="stable")
        self.to = np.empty(len(self.first), np.int64)
        self.to[by_symbol] = np.cumsum(self.run_lengths[by_symbol]) - self.run_lengths[by_symbol]
        # The symbol before leads a run's first row right below the last row of the run before with that symbol.
        upper, lower = by_symbol[:-1], by_symbol[1:]
        meet = (self.symbols[upper] == self.symbols[lower]) & (self.symbols[lower] > 0)
        upper, lower = upper[meet], lower[meet]
        self.above, self.below = np.zeros(len(self.first), np.int64), np.zeros(len(self.first), np.int64)
        self.above[lower] = self.below[upper] = self.common(self.tail[upper] - 1, self.head[lower] - 1)

    def packed(self, symbols: np.ndarray) -> np.ndarray:
        padded = np.concatenate((symbols, np.zeros(self.STEP, np.int64)))
        words = np.zeros(len(symbols), np.int64)
        for j in range(self.STEP):
            words = words << 9 | padded[j : j + len(symbols)]
        beyond = 9 * np.maximum(0, self.STEP - self.left)
        return words >> beyond << beyond

    def suffix_order(self) -> np.ndarray:
        """All suffixes in order, equal ones by position; by doubling, over what is still undecided."""
        order = np.argsort(self.words, kind="stable")
        rank, depth, ties = np.empty(len(order), np.int64), self.STEP, np.arange(len(order))
        key = self.words[order]
        while True:
            # ties: places in the order that may still change; key: their sort keys.
            new = np.concatenate(([True], key[1:] != key[:-1])) if len(key) else np.zeros(0, bool)
            group = np.maximum.accumulate(np.where(new, ties, 0)) if len(key) else ties
            rank[order[ties]] = group
            alone = new & np.concatenate((new[1:], [True])) if len(key) else new
            ties = ties[~alone & (self.left[order[ties]] >= depth)]
            if not len(ties):
                return order
            at = order[ties]
            further = np.minimum(at + depth, len(order) - 1)
            key = rank[at] * (len(order) + 1) + np.where(self.left[at] > depth, rank[further] + 1, 0)
            sort = np.argsort(key, kind="stable")
            order[ties], key = at[sort], key[sort]
            depth *= 2

    def common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Lengths of the common prefixes of pairs of suffixes, each inside its string."""
        most, out = np.minimum(self.left[a], self.left[b]), np.zeros(len(a), np.int64)
        live = np.arange(len(a))
        while len(live):
            x, y = self.words[a[live] + out[live]], self.words[b[live] + out[live]]
            same = x == y
            out[live] += np.where(same, self.STEP, self.first_difference(x ^ y))
            live = live[same & (out[live] < most[live])]
        return np.minimum(out, most)

    def first_difference(self, differ: np.ndarray) -> np.ndarray:
        """How many leading symbols of two words agree."""
        out = np.zeros(len(differ), np.int64)
        for j in range(1, self.STEP):
            out += (differ >> 9 * (self.STEP - j)) == 0
        return out

    def matching_statistics(self) -> np.ndarray:
        """Per position of the text, the longest match of what follows with any other place.

        All strings go through the index at once, from their ends to their starts. Inside a run a match with the
        neighbouring row grows by one symbol, as both have the same symbol before; at run ends it is the sample.
        """
        out = np.zeros(len(self.left), np.int64)
        live = np.flatnonzero(np.diff(self.starts) > 1)
        row, place, until = live, self.starts[live + 1] - 1, self.starts[live]
        up, down = np.zeros(len(live), np.int64), np.zeros(len(live), np.int64)
        while len(row):
            run = np.searchsorted(self.first, row, "right") - 1
            inside = row - self.first[run]
            up = np.where(inside == 0, self.above[run], up + 1)
            down = np.where(inside == self.run_lengths[run] - 1, self.below[run], down + 1)
            row, place = self.to[run] + inside, place - 1
            out[place] = np.maximum(up, down)
            more = place > until
            if not more.all():
                row, place, until, up, down = row[more], place[more], until[more], up[more], down[more]
        return out


def repeated(strings: list[bytes], length: int = LENGTH) -> list[np.ndarray]:
    """Per string, which of its positions start a string of ``length`` bytes that starts elsewhere, too."""
    index = RunLengthIndex(strings)
    long = index.matching_statistics() >= length
    return [long[a:b] for a, b in zip(index.starts[:-1].tolist(), (index.starts[1:] - 1).tolist(), strict=True)]


MARKS = "anchor long, segment binary, marks array<struct<first:int,last:int>>"


def runs(mask: np.ndarray) -> list[dict]:
    edges = np.flatnonzero(np.diff(np.concatenate(([False], mask, [False])).astype(np.int8)))
    return [{"first": int(a), "last": int(b) - 1} for a, b in zip(edges[::2], edges[1::2], strict=True)]


def indexed_marks(rows: DataFrame, parts: int) -> DataFrame:
    """Marked windows of segments (anchor, segment, bytes), anchor by anchor."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[int, bytes, bytes]] = []
        size = 0

        def flush(rows):
            marks = [runs(m) for m in repeated([r[2] for r in rows])]
            found = [(r[0], r[1], m) for r, m in zip(rows, marks, strict=True) if m]
            kind = pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32())]))
            return pa.RecordBatch.from_arrays(
                [pa.array([f[0] for f in found], pa.int64()), pa.array([f[1] for f in found], pa.binary()), pa.array([f[2] for f in found], kind)],
                ["anchor", "segment", "marks"],
            )

        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("anchor", "segment", "bytes")), strict=True):
                if held and size >= INDEX_BYTES and row[0] != held[-1][0]:
                    yield flush(held)
                    held, size = [], 0
                held.append(row)
                size += len(row[2])
        if held:
            yield flush(held)

    dealt = rows.select("anchor", "segment", "bytes").repartition(parts, "anchor").sortWithinPartitions("anchor", "segment")
    return dealt.mapInArrow(run, MARKS)


WINDOWS = "anchor long, segment binary, at int, content binary"


def window_marks(rows: DataFrame) -> DataFrame:
    """The same for segments of anchors with very many segments, by the whole content of each window."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, len(whole), 64):
                batch = whole.slice(at, 64)
                out = []
                for anchor, segment, data in zip(*(batch.column(c).to_pylist() for c in ("anchor", "segment", "bytes")), strict=True):
                    out += [(anchor, segment, i, hashlib.blake2b(data[i : i + LENGTH], digest_size=16).digest()) for i in range(len(data) - LENGTH + 1)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*out, strict=True), (pa.int64(), pa.binary(), pa.int32(), pa.binary()), strict=True)],
                    ["anchor", "segment", "at", "content"],
                )

    each = written(rows.select("anchor", "segment", "bytes").mapInArrow(run, WINDOWS), "windows")
    twice = written(each.groupBy("content").agg(F.count("*").alias("n")).filter("n > 1").select("content"), "repeated")
    found = each.join(twice, "content", "left_semi")
    return found.groupBy("anchor", "segment").agg(
        F.sort_array(F.collect_list(F.struct(F.col("at").alias("first"), F.col("at").alias("last")))).alias("marks")
    )


def segment_bytes(places: DataFrame, texts: DataFrame) -> DataFrame:
    """(anchor, segment, bytes) of segments, cut from the texts they are in."""
    by_text = places.groupBy("t_key").agg(F.collect_list(F.struct("anchor", "segment", "start", "windows")).alias("_s"))
    held = texts.select("t_key", "bytes").join(by_text, "t_key")
    cuts = F.expr(f"transform(_s, s -> struct(s.anchor, s.segment, substring(bytes, int(s.start) + 1, s.windows + {LENGTH - 1}) as bytes))")
    return held.select(F.explode(cuts).alias("s")).select("s.anchor", "s.segment", "s.bytes")


def marks(texts: DataFrame, candidates: DataFrame) -> DataFrame:
    """(anchor, segment, marks): marked windows of all segments that share their anchor with another."""
    place = F.min(F.struct("t_key", "start", "windows")).alias("place")
    distinct = written(candidates.groupBy("anchor", "segment").agg(F.count("*").alias("n"), place), "segments_distinct")
    per_anchor = distinct.groupBy("anchor").agg(F.count("*").alias("different"))
    many = written(per_anchor.filter("different > 1"), "anchors_many")
    several = distinct.join(many, "anchor").select("anchor", "segment", "place.*", "different")
    several = written(several, "segments_several")
    total = several.agg(F.sum(F.col("windows") + LENGTH - 1)).first()[0] or 0
    parts = max(shuffle_width(texts.sparkSession), -(-total // (128 << 20)))
    whole = distinct.filter("n > 1").select(
        "anchor", "segment", F.array(F.struct(F.lit(0).alias("first"), (F.col("place.windows") - 1).alias("last"))).alias("marks")
    )
    few = segment_bytes(several.filter(F.col("different") <= MOST), texts)
    found = whole.unionByName(indexed_marks(few, parts))
    if not many.filter(F.col("different") > MOST).isEmpty():
        found = found.unionByName(window_marks(segment_bytes(several.filter(F.col("different") > MOST), texts)))
    return found


REMOVED = "n_removed long, n_spans long, kept binary"


def removed(texts: pd.Series, spans: pd.Series) -> pd.DataFrame:
    """What goes when the windows from ``first`` to ``last`` go, and what is left."""
    rows = []
    for data, own in zip(texts, spans, strict=True):
        data, gone, count, keep, at = bytes(data), 0, 0, [], 0
        for first, last in sorted((s["first"], s["last"]) for s in own):
            end = last + LENGTH
            if end <= at:
                continue
            if first > at or not count:
                count += 1
                keep.append(data[at:first])
            gone += end - max(first, at)
            at = end
        rows.append((gone, count, b"".join([*keep, data[at:]])))
    return pd.DataFrame(rows, columns=["n_removed", "n_spans", "kept"])


def remove_repeats(docs: DataFrame, text: str = "text") -> tuple[DataFrame, DataFrame]:
    """Per different text (``t_key``): n_bytes, n_removed, n_spans, kept_sha256; and its marked spans.

    The first frame is written; ``spans`` has (t_key, spans) with the marked windows of texts that have any.
    """
    texts = distinct_texts(docs, text)
    every = written(segments(texts), "segments")
    shared = written(every.groupBy("anchor").agg(F.count("*").alias("n")).filter("n > 1").select("anchor"), "anchors")
    candidates = written(every.join(shared, "anchor"), "segments_shared")
    found = written(marks(texts, candidates), "marks")
    spread = candidates.join(found, ["anchor", "segment"]).select("t_key", "start", F.explode("marks").alias("m"))
    spread = spread.select("t_key", F.struct((F.col("start") + F.col("m.first")).alias("first"), (F.col("start") + F.col("m.last")).alias("last")).alias("s"))
    spans = written(spread.groupBy("t_key").agg(F.collect_list("s").alias("spans")), "spans")
    joined = texts.join(spans, "t_key", "left")
    whole = (F.col("copies") > 1) & (F.octet_length("bytes") >= LENGTH)
    size = F.octet_length("bytes").cast("long")
    done = joined.filter(F.col("spans").isNotNull() & ~whole).select("t_key", size.alias("n_bytes"), F.pandas_udf(removed, REMOVED)("bytes", "spans").alias("r"))
    done = done.select("t_key", "n_bytes", "r.n_removed", "r.n_spans", F.sha2("r.kept", 256).alias("kept_sha256"))
    rest = joined.filter(F.col("spans").isNull() | whole).select(
        "t_key",
        size.alias("n_bytes"),
        F.when(whole, size).otherwise(0).cast("long").alias("n_removed"),
        whole.cast("long").alias("n_spans"),
        F.sha2(F.when(whole, F.lit(b"")).otherwise(F.col("bytes")), 256).alias("kept_sha256"),
    )
    return written(done.unionByName(rest), "kept"), spans


def per_document(docs: DataFrame, results: DataFrame, text: str = "text", id_column: str = "doc_id") -> DataFrame:
    rows = docs.select(F.col(id_column).alias("doc_id"), utf8(text).alias("_bytes"))
    keyed = rows.select("doc_id", text_key("_bytes").alias("t_key"))
    return keyed.join(results, "t_key").drop("t_key")
