"""N-gram Jaccard join by parity sketches.

A document is the set of its different shingles: runs of ``SHINGLE`` words (A-Z lower-cased, split at blanks, tabs
and line breaks), or its whole word sequence if it has fewer words. Two documents link when their sets'
similarity is at least ``PERCENT`` per cent; the components of the links are the result.

Sets of similarity J or more differ in at most a third of either's size n (J = 0.75), call that D.

1. Sketch. Shingle hashes fall into the segments of a size band (about 1.5 shingles in a segment for the largest
   sets of a band) and a segment is the XOR of its hashes. A shingle in one set only changes one segment, so
   linked documents differ in at most D segments: the number of different segments never exceeds the
   symmetric difference. Sets at a band's upper end are sketched for the next band, too, for their larger
   partners. Small sets have a segment for each shingle.
2. Pigeonhole. Of a document's non-empty segments (at least D + 1 + S, else shingles serve as segments) the D + 1 + S
   first in one fixed order are its keys; linked documents share at least S + 1 of them, for the smaller one's S. Documents
   with a common key are candidates. The order is that of the hashes, but common segments come last: those that a
   mergeable count over all texts (``COMMON`` counters a task) has seen in more than ``HOT`` documents. So documents that share
   most of their text with very many others, but hold enough segments of their own, do not meet at all. Whatever the
   count misses costs time, not links: any order does. A key shared by more than ``HOT`` documents is dropped from
   those that hold no more such keys than the S of their smallest possible partner: linked partners share another key with them.
3. Verify. In each key's group, all members are compared with the first one, by size, then by a one-bit parity
   sketch of ``BITS`` bits (its Hamming distance is at most the symmetric difference, too), then exactly.
   That is linear in the group. What is verified is joined into components. A document's set goes out once
   for every ``PARTNERS`` of its pairs, so that no task gets all pairs of one document.
4. Rest. Only in groups that still hold members of different components, pairs from different components are
   compared, again by size and sketch inside the join, by their number of common keys, then exactly. Groups of two
   are not expanded, but their keys are counted. Pairs within a component need no check,
   so large groups of near copies are never expanded into pairs, and no link between components is lost.

Equal texts are one node (the upper 64 bits of their SHA-256; two texts that share them stop the job).
Null texts and texts without words have empty sets and link with nothing, not even with each other. Repeated
and null ids are allowed: a component's name is its smallest id, null only if all are. Extra columns are ignored.
Texts are shingled whole, whatever their length. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from keyloom.llm.common import bucketed, byte_blocks, free_name, mix64, numbered, quoted, utf8, written

SHINGLE, PERCENT = 5, 75
#: Sets below ``SMALL`` have a segment per shingle; bands above grow by ``BAND``.
SMALL, BAND, FILL = 64, 16, 1.5
HOT, BITS = 512, 1024
COMMON, PARTNERS = 1 << 16, 64

_rng = np.random.default_rng(5 * 75)
BYTE_CODE = _rng.integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
BYTE_CODE[65:91] = BYTE_CODE[97:123]
BLANK = np.zeros(256, bool)
BLANK[[32, 9, 10, 11, 12, 13]] = True
PLACE_CODE = _rng.integers(0, 1 << 63, SHINGLE + 1, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
BASE = np.uint64(0x9E3779B97F4A7C15)
BASE_INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A hash of every word of some concatenated texts, and the text each is in."""
    if not len(data):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    inside = ~BLANK[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    starts = np.flatnonzero(inside & np.concatenate(([True], ~inside[:-1] | edge[1:-1])))
    ends = np.flatnonzero(inside & np.concatenate((~inside[1:] | edge[1:-1], [True])))
    powers = np.cumprod(np.concatenate(([np.uint64(1)], np.full(len(data) - 1, BASE))), dtype=np.uint64)
    sums = np.concatenate(([np.uint64(0)], np.cumsum(BYTE_CODE[data] * powers, dtype=np.uint64)))
    back = np.cumprod(np.concatenate(([np.uint64(1)], np.full(len(data) - 1, BASE_INVERSE))), dtype=np.uint64)
    return mix64((sums[ends + 1] - sums[starts]) * back[starts]), np.searchsorted(offsets, starts, "right") - 1


def shingle_sets(data: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
    """The sorted different shingle hashes of each text."""
    words, row = word_hashes(data, offsets)
    rows = len(offsets) - 1
    first = np.searchsorted(row, np.arange(rows + 1))
    runs = max(0, len(words) - SHINGLE + 1)
    mixed = np.zeros(runs, np.uint64)
    for j in range(SHINGLE):
        mixed += words[j : j + runs] * PLACE_CODE[j]
    mixed = mix64(mixed)
    out = []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        if b - a >= SHINGLE:
            out.append(np.unique(mixed[a : b - SHINGLE + 1]))
        elif b > a:  # the whole sequence; its length keeps it apart from longer ones
            whole = words[a:b] * PLACE_CODE[: b - a]
            length = np.array([b - a], np.uint64) * PLACE_CODE[SHINGLE:]
            out.append(mix64(np.bitwise_xor.reduce(whole, keepdims=True) ^ length))
        else:
            out.append(mixed[:0])
    return out


def bands(n: int) -> list[int]:
    """The size bands a set of ``n`` is sketched for: its own, and the next if a partner may be in it."""
    own, upper = 0, SMALL
    while n >= upper:
        own, upper = own + 1, upper * BAND
    return [own, own + 1] if n * 100 // PERCENT >= upper else [own]


def segment_keys(hashes: np.ndarray, band: int, by_shingle: bool = False) -> np.ndarray:
    """The non-empty segments of a sorted set, as even 64-bit keys in key order."""
    if band and not by_shingle:
        count = np.uint64(int(SMALL * BAND**band / FILL))
        place = ((hashes >> np.uint64(32)) * count) >> np.uint64(32)  # grows with the hash
        starts = np.flatnonzero(np.concatenate(([True], place[1:] != place[:-1])))
        parts = np.bitwise_xor.reduceat(hashes, starts) ^ mix64(place[starts])
    else:
        parts = hashes
    return np.sort(mix64(parts ^ np.uint64(0xA5A5 + 977 * band)) & ~np.uint64(1))


def difference(n: int) -> int:
    """The most shingles by which a set of ``n`` can differ from a linked one."""
    return n * (100 - PERCENT) // PERCENT


def spare(n: int) -> int:
    """How many more keys than necessary a set of ``n`` has; it grows with ``n``."""
    return max(0, min(2 + n // 32, n - difference(n) - 1))


def least_spare(n: Column) -> Column:
    """``spare`` of the smallest set that a set of ``n`` can link with."""
    m = F.ceil(n * PERCENT / 100)
    least = F.least(2 + F.floor(m / 32), m - F.floor(m * (100 - PERCENT) / PERCENT) - 1)
    return F.greatest(least, F.lit(0))


def sketch(hashes: np.ndarray) -> np.ndarray:
    """One bit per shingle, XORed: 64-bit words."""
    bits = np.bincount((hashes & np.uint64(BITS - 1)).astype(np.int64), minlength=BITS) & 1
    return np.packbits(bits.astype(np.uint8)).view(np.int64)


class Counter:
    """How often keys were seen, in at most ``COMMON`` counters at rest: counts may be too low, never too high."""

    def __init__(self):
        self.keys, self.counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.new, self.size = [], 0

    def add(self, keys: np.ndarray) -> None:
        self.new.append(keys)
        self.size += len(keys)
        if self.size > 16 * COMMON:
            self.settle()

    def settle(self) -> None:
        new = np.sort(np.concatenate([self.keys[:0], *self.new]))
        starts = np.flatnonzero(np.concatenate(([True], new[1:] != new[:-1]))[: len(new)])
        keys, counts = new[starts], np.diff(np.append(starts, len(new)))
        at = np.searchsorted(keys, self.keys)
        known = np.append(keys, np.uint64(1))[at] == self.keys  # keys are even, so the number at the end is none
        counts[at[known]] += self.counts[known]
        keys, counts = np.concatenate((keys, self.keys[~known])), np.concatenate((counts, self.counts[~known]))
        if len(keys) > COMMON:
            counts -= np.partition(counts, -COMMON - 1)[-COMMON - 1]
            keys, counts = keys[counts > 0], counts[counts > 0]
        self.keys, self.counts, self.new, self.size = keys, counts, [], 0


def common_keys(docs: DataFrame, text: str, by_shingle: bool) -> np.ndarray:
    """At most ``COMMON`` segments that more than ``HOT`` texts hold, sorted. A task counts a text once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter, seen = Counter(), set()
        for batch in batches:
            fresh = []
            for i, one in enumerate(batch.column("node").to_pylist()):
                if one not in seen:
                    seen.add(one)
                    fresh.append(i)
            for _, _, data, offsets in byte_blocks(batch.column("bytes").take(pa.array(fresh, pa.int64()))):
                for own in shingle_sets(data, offsets):
                    for band in bands(len(own)) if len(own) else []:
                        counter.add(segment_keys(own, band, by_shingle))
        counter.settle()
        yield pa.RecordBatch.from_arrays([pa.array(counter.keys.view(np.int64)), pa.array(counter.counts)], ["key", "n"])

    counts = docs.select(node(text), utf8(text).alias("bytes")).mapInArrow(run, "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))
    most = counts.filter(F.col("n") > HOT).orderBy(F.desc("n"), "key").limit(COMMON)
    return np.sort(np.array([r["key"] for r in most.collect()], np.int64).view(np.uint64))


def in_order(found: np.ndarray, common: np.ndarray) -> tuple[np.ndarray, int]:
    """Sorted keys with the common ones last, and the number of the others."""
    if not len(common):
        return found, len(found)
    late = common[np.minimum(np.searchsorted(common, found), len(common) - 1)] == found
    return np.concatenate((found[~late], found[late])), len(found) - int(late.sum())


KEYS = "key long, node long, common boolean, sketch array<long>"
#: In place of a key, an odd number holds a node's set size and how many hot keys it may drop.
SPARE_BITS, TOO_FEW = 20, (1 << 20) - 1


def keys_of(docs: DataFrame, text: str, by_shingle: bool) -> DataFrame:
    """(key, node, common, sketch): the keys of every text, and one odd number per text that holds its size, with its sketch.

    Repeats of a text inside a batch are skipped, so that copies do not multiply the keys.
    """
    held_common = docs.sparkSession.sparkContext.broadcast(common_keys(docs, text, by_shingle))  # at most COMMON numbers

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common = held_common.value
        for batch in batches:
            nodes, firsts = np.unique(batch.column("node").to_numpy(), return_index=True)
            firsts.sort()
            batch = batch.take(pa.array(firsts))
            nodes = batch.column("node").to_numpy()
            for first, end, data, offsets in byte_blocks(batch.column("bytes")):
                keys, late, counts, sketches = [], [], [], []
                for own in shingle_sets(data, offsets):
                    n, wanted, enough, held = len(own), difference(len(own)) + 1 + spare(len(own)), True, 1
                    for band in bands(n) if n else []:
                        found, others = in_order(segment_keys(own, band, by_shingle), common)
                        enough &= len(found) >= wanted
                        keys.append(found[:wanted].view(np.int64))
                        late.append(np.arange(len(keys[-1])) >= others)
                        held += len(keys[-1])
                    keys.append(np.array([(n << SPARE_BITS | (min(spare(n), TOO_FEW - 1) if enough else TOO_FEW)) << 1 | 1]))
                    late.append(np.zeros(1, bool))
                    counts.append(held)
                    sketches.append(sketch(own))
                last = np.cumsum(counts) - 1
                sized = np.zeros(last[-1] + 1, bool)
                sized[last] = True
                places = np.concatenate(([0], np.cumsum(np.where(sized, BITS // 64, 0)))).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.concatenate(keys)),
                        pa.array(np.repeat(nodes[first:end], counts), pa.int64()),
                        pa.array(np.concatenate(late)),
                        pa.ListArray.from_arrays(pa.array(places), pa.array(np.concatenate(sketches)), mask=pa.array(~sized)),
                    ],
                    ["key", "node", "common", "sketch"],
                )

    return docs.select(node(text), utf8(text).alias("bytes")).mapInArrow(run, KEYS)


def node(text: str) -> Column:
    """The upper 64 bits of a text's SHA-256."""
    return node_of(F.sha2(utf8(text), 256)).alias("node")


def node_of(digest: Column) -> Column:
    high, low = F.conv(F.substring(digest, 1, 8), 16, 10).cast("long"), F.conv(F.substring(digest, 9, 8), 16, 10).cast("long")
    return F.shiftleft(high, 32).bitwiseOR(low)


def groups(docs: DataFrame, text: str, by_shingle: bool) -> DataFrame:
    """(key, node, sketch, hot): rows of keys that several nodes share, and the sizes' rows; written.

    Common keys are known to be hot, so their rows need not meet and are dealt by node.
    """
    rows = keys_of(docs, text, by_shingle)
    size_row = F.col("key").bitwiseAND(F.lit(1)) == 1
    alone = size_row | F.col("common")
    apart = rows.withColumn("_of", F.when(alone, F.col("node")).otherwise(0))
    whole = Window.partitionBy("key", "_of")
    seen = apart.select("*", F.min("node").over(whole).alias("_low"), F.max("node").over(whole).alias("_high"), F.count("*").over(whole).alias("_n"))
    kept = seen.filter(alone | (F.col("_low") != F.col("_high")))
    return written(kept.select("key", "node", "sketch", (F.col("common") | (F.col("_n") > HOT)).alias("hot")), "groups")


SETS = "node long, shingles array<long>"
#: Bits of the filter that spares most other texts the shuffle: 64 in each of so many broadcast rows.
FILTER_ROWS = 1 << 18


def only(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """Rows whose node may be wanted: a filter of fixed size, so the broadcast is bounded. Others may slip through."""
    spot = F.pmod(F.xxhash64("node"), F.lit(FILTER_ROWS * 64))
    mark = F.expr("shiftleft(1L, int(_spot % 64))")
    bits = wanted.select(spot.alias("_spot")).groupBy(F.shiftright("_spot", 6).alias("_row")).agg(F.bit_or(mark).alias("_bits"))
    spotted = docs.withColumn("_spot", spot).withColumn("_row", F.shiftright("_spot", 6))
    return spotted.join(F.broadcast(bits), "_row").filter(F.col("_bits").bitwiseAND(mark) != 0).select(*docs.columns)


def sets_of(docs: DataFrame, text: str, wanted: DataFrame) -> DataFrame:
    """The shingle sets of the wanted nodes, each once, bucketed by node."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes = batch.column("node")
            for first, end, data, offsets in byte_blocks(batch.column("bytes")):
                found = shingle_sets(data, offsets)
                yield pa.RecordBatch.from_arrays(
                    [nodes.slice(first, end - first), pa.array([x.view(np.int64) for x in found], pa.list_(pa.int64()))], ["node", "shingles"]
                )

    wanted = written(wanted.distinct(), "wanted")
    texts = only(docs.select(node(text), utf8(text).alias("bytes")), wanted).join(wanted, "node", "left_semi")
    once = texts.groupBy("node").agg(F.first("bytes").alias("bytes"))
    return bucketed(once.mapInArrow(run, SETS), "node", "sets")[0]


def may_link(a: str, b: str) -> Column:
    """What sizes and sketches allow: neither the size ratio nor the Hamming distance rules the link out."""
    n, m = F.col(f"{a}.n"), F.col(f"{b}.n")
    sizes = (n * 100 >= m * PERCENT) & (m * 100 >= n * PERCENT)
    # Word by word, not by a higher-order function: this is compiled into the join's loop.
    words = [F.bit_count(F.col(f"{a}.sketch")[i].bitwiseXOR(F.col(f"{b}.sketch")[i])) for i in range(BITS // 64)]
    apart = reduce(Column.__add__, words)
    # |A xor B| = |A| + |B| - 2 |A and B|, and |A and B| >= J / (1 + J) (|A| + |B|)
    return sizes & (apart * (100 + PERCENT) <= (n + m) * (100 - PERCENT))


def near(pairs: DataFrame, sizes: DataFrame) -> DataFrame:
    """The pairs (a, b) that sizes and sketches let through; written.

    ``enough`` says whether the number of common keys (``shared``) does so, too. Without it and without ``alone``, the
    number of keys that only these two hold, a pair is left out.
    """
    small = sizes.select("node", F.struct("n", "sketch", "spare", "hot").alias("s"))
    both = pairs.join(small.withColumnsRenamed({"node": "a", "s": "_x"}), "a").join(small.withColumnsRenamed({"node": "b", "s": "_y"}), "b")
    both = both.withColumn("enough", F.col("shared") >= least_shared("_x", "_y"))
    return written(both.filter(may_link("_x", "_y") & (F.col("enough") | (F.col("alone") > 0))).select("a", "b", "alone", "enough"), "near")


def least_shared(a: str, b: str) -> Column:
    """How many keys a linked pair has in common at least, without the hot ones that either may have dropped."""
    spare_ones = F.least(f"{a}.spare", f"{b}.spare") - F.least(f"{a}.hot", f"{b}.hot")
    return F.greatest(spare_ones, F.lit(0)) + 1


def nodes_of(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node")))


def copies(pairs: DataFrame, side: str, other: str) -> tuple[DataFrame, DataFrame]:
    """``pairs`` with the number of the copy of one side's set they are dealt to, and how many copies each node needs."""
    needed = pairs.groupBy(side).agg(F.ceil(F.count("*") / PARTNERS).alias("_n"))
    dealt = pairs.join(needed, side).withColumn(f"_{side}", F.pmod(F.xxhash64(other), "_n")).drop("_n")
    return dealt, needed


def repeated(sets: DataFrame, needed: DataFrame, side: str, name: str) -> DataFrame:
    """The sets of one side, once for each of their copies."""
    one = sets.join(needed.withColumnRenamed(side, "node"), "node")
    return one.select(F.col("node").alias(side), F.explode(F.sequence(F.lit(0).cast("long"), F.col("_n") - 1)).alias(f"_{side}"), F.col("shingles").alias(name))


def verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) whose sets are similar enough; written."""
    dealt, needed_a = copies(pairs, "a", "b")
    dealt, needed_b = copies(dealt, "b", "a")
    both = F.size(F.array_intersect("_x", "_y"))
    similar = both * 100 >= (F.size("_x") + F.size("_y") - both) * PERCENT
    joined = dealt.join(repeated(sets, needed_b, "b", "_y"), ["b", "_b"]).join(repeated(sets, needed_a, "a", "_x"), ["a", "_a"])
    return written(joined.filter(similar).select("a", "b"), "links")


def apart(pairs: DataFrame, label: DataFrame) -> DataFrame:
    """The pairs that are not in one component yet."""
    one, two = label.select(F.col("node").alias("a"), F.col("component").alias("_x")), label.select(F.col("node").alias("b"), F.col("component").alias("_y"))
    joined = pairs.join(one, "a", "left").join(two, "b", "left")
    return joined.filter(F.coalesce("_x", "a") != F.coalesce("_y", "b")).select("a", "b")


def components(links: DataFrame) -> DataFrame:
    """(node, component) of every node with a link, by smallest neighbours and pointer jumping; written."""
    both = written(links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))), "edges")
    label = written(both.groupBy(F.col("a").alias("node")).agg(F.least(F.col("a"), F.min("b")).alias("component")), "labels")
    while True:
        around = both.join(label.select(F.col("node").alias("b"), "component"), "b").groupBy(F.col("a").alias("node")).agg(F.min("component").alias("_near"))
        step = label.join(around, "node").select("node", "component", F.least("component", "_near").alias("_new"))
        to = label.select(F.col("node").alias("_new"), F.col("component").alias("_jump"))
        jumped = step.join(to, "_new").select("node", F.least("_new", "_jump").alias("component"), (F.least("_new", "_jump") < F.col("component")).alias("_moved"))
        jumped = written(jumped, "labels")
        label = jumped.select("node", "component")
        if jumped.filter("_moved").isEmpty():
            return label


def node_components(docs: DataFrame, text: str = "text", by_shingle: bool = False) -> tuple[DataFrame, DataFrame]:
    """(node, n) of every different text, and (node, component) of those that link with another."""
    rows = groups(docs, text, by_shingle)
    size_row = F.col("key").bitwiseAND(F.lit(1)) == 1
    held = F.shiftrightunsigned("key", 1)
    sizes = rows.filter(size_row).dropDuplicates(["node"])
    sizes = sizes.select("node", F.shiftright(held, SPARE_BITS).alias("n"), held.bitwiseAND(F.lit(TOO_FEW)).alias("spare"), "sketch")
    if not by_shingle and not sizes.filter(F.col("spare") == TOO_FEW).isEmpty():
        return node_components(docs, text, True)  # a set with too few segments: shingles as segments, for all
    keys = rows.filter(~size_row).select("key", "node", "hot").dropDuplicates(["key", "node"])
    hot = keys.filter("hot").groupBy("node").agg(F.count("*").alias("hot"))
    sizes = written(sizes.join(hot, "node", "left").withColumn("hot", F.coalesce("hot", F.lit(0))), "sizes")
    light = sizes.filter((F.col("hot") > 0) & (F.col("hot") <= least_spare(F.col("n")))).select("node")
    kept = keys.filter("not hot").unionByName(keys.filter("hot").join(light, "node", "left_anti"))
    kept = written(kept.select("key", "node"), "kept_keys")
    first = kept.groupBy("key").agg(F.min("node").alias("a"), F.count("*").alias("_n"))
    stars = kept.select("key", F.col("node").alias("b")).join(first, "key").filter("a < b")
    # Here ``shared`` lacks the keys that a smaller node than a holds: whoever has not enough of them comes up again.
    tried = near(stars.groupBy("a", "b").agg(F.count("*").alias("shared"), F.count_if(F.col("_n") == 2).alias("alone")), sizes)
    stars = tried.filter("enough").select("a", "b")
    sets = sets_of(docs, text, nodes_of(stars))
    # One pair per member first; the rest of its pairs only where that has not joined them already.
    links = verified(stars.groupBy("b").agg(F.min("a").alias("a")).select("a", "b"), sets)
    label = components(links)
    others = written(apart(stars, label), "others")
    if not others.isEmpty():
        links = links.unionByName(verified(others, sets))
        label = components(links)
    placed = kept.select("key", "node").join(label, "node", "left").withColumn("component", F.coalesce("component", "node"))
    split = placed.groupBy("key").agg(F.min("component").alias("_x"), F.max("component").alias("_y"), F.count("*").alias("_n"))
    split = written(split.filter("_x < _y and _n > 2").select("key"), "split_keys")
    if split.isEmpty():
        return sizes.select("node", "n"), label
    open_rows = placed.join(split, "key").join(sizes.select("node", F.struct("n", "sketch").alias("s")), "node")
    open_rows = written(open_rows, "open_rows")
    left = open_rows.select("key", F.col("node").alias("a"), F.col("component").alias("_ca"), F.col("s").alias("_x"))
    right = open_rows.select("key", F.col("node").alias("b"), F.col("component").alias("_cb"), F.col("s").alias("_y"))
    cross = left.join(right, (left["key"] == right["key"]) & (F.col("a") < F.col("b")) & (F.col("_ca") != F.col("_cb")) & may_link("_x", "_y"))
    # All common keys of members of different components: those of these groups, and those that only the two hold.
    # Whoever shares none of these groups was counted in full by the stars; what the stars let through is verified.
    cross = cross.groupBy("a", "b").agg(F.count("*").alias("_here")).join(tried, ["a", "b"], "left").filter("not coalesce(enough, false)")
    cross = cross.select("a", "b", (F.col("_here") + F.coalesce("alone", F.lit(0))).alias("shared"), F.lit(0).alias("alone"))
    cross = near(cross, sizes).select("a", "b")
    more = verified(cross, sets_of(docs, text, nodes_of(cross)))
    return sizes.select("node", "n"), label if more.isEmpty() else components(links.unionByName(more))


def link_documents(docs: DataFrame, text: str = "text", id_column: str = "doc_id") -> DataFrame:
    """Per row of ``docs``: its id, ``n_shingles`` and ``component_id``, the smallest id that links reach from it."""
    sizes, label = node_components(docs, text)
    digest = F.sha2(utf8(text), 256)
    rows = docs.select(quoted(id_column).alias("doc_id"), digest.alias("_digest"))
    rows = rows.withColumn("node", node_of(F.col("_digest")))
    texts = rows.groupBy("node").agg(F.min("doc_id").alias("_least"), F.min("_digest").alias("_d0"), F.max("_digest").alias("_d1"))
    alone = F.when(F.col("_d0") == F.col("_d1"), F.col("_least")).otherwise(F.raise_error(F.lit("two texts share 64 bits of their digest")))
    texts = texts.withColumn("_least", alone).drop("_d0", "_d1").join(sizes, "node").join(label, "node", "left")
    texts = written(texts.withColumn("component", F.coalesce("component", "node")), "texts_placed")
    names = texts.groupBy("component").agg(F.min("_least").alias("component_id"))
    named = written(texts.join(names, "component").select("node", F.col("n").alias("n_shingles"), "component_id"), "named")
    joined = rows.join(named, "node")
    empty = F.col("n_shingles") == 0
    return joined.select("doc_id", "n_shingles", F.when(empty, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))


def keep_one(docs: DataFrame, text: str = "text", id_column: str = "doc_id") -> DataFrame:
    """``docs`` with one row of each component: that with the smallest id (null last), then by row.

    Rows without words are components of their own and all stay.
    """
    rows, row = numbered(docs, "to_link")
    linked = link_documents(rows, text, row)  # a component's name is its smallest row number
    names = rows.select(quoted(row).alias("_r"), quoted(id_column).alias("_id"))
    named = linked.join(names, F.col("doc_id") == F.col("_r"))
    best = named.groupBy("component_id").agg(F.min(F.struct(F.col("_id").isNull().alias("last"), "_id", "_r")).alias("_b"))
    stay = free_name(rows, "_stay")
    return rows.join(best.select(F.col("_b._r").alias(stay)), quoted(row) == F.col(stay), "left_semi").select(*map(quoted, docs.columns))
