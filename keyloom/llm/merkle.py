"""A Merkle manifest of a dataset whose parents keep the hash state before each child slot.

A digest in hex text fills one block of SHA-256, so a parent of up to ``FANOUT`` children is a chain of states, one
block each. The manifest keeps, for every child slot, the state its parent had before that child. To see what a changed
leaf makes of the root, ``fold`` resumes each parent's state with the new child and hashes only the siblings to its right.

Trees: one per source, its leaves by document id, then one over the sources' roots (null source first, bytewise).
Nodes are worked on in blocks of ``FANOUT ** DEPTH`` neighbours, which are whole subtrees, so one pass builds ``DEPTH``
levels of all trees at once and a hot source is spread over many tasks. The tops of the blocks are the leaves of the next
pass. The manifest holds one row per block: ``tree``, ``block``, ``n`` (its leaves), ``nodes`` (32 bytes per node, level
by level), ``states`` (32 bytes per node: its parent's state before it) and ``top``. Its folder survives the session.

Nulls count as ``-`` in a leaf (also a null id, which sorts first); an empty text is not null. Texts are hashed whole
by built-in functions. Rows with equal ids are leaves of their own, in order of their digests; equal rows give equal
digests, in any order. A table without rows gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keyloom.llm.common import placed, quoted, whole_groups, written

FANOUT = 3
DEPTH = 7
SPAN = FANOUT**DEPTH
ROWS = 20_000  # rows a task works on at a time

# SHA-256 over many messages at once, with states that can be stored -----------------


def primes(n: int) -> list[int]:
    found: list[int] = []
    k = 2
    while len(found) < n:
        if all(k % p for p in found):
            found.append(k)
        k += 1
    return found


def cube_root(x: int) -> int:
    r = 1 << -(-x.bit_length() // 3)
    while r**3 > x:
        r = (2 * r + x // r**2) // 3
    return r


# The standard's constants: fractions of the square and cube roots of the first primes, in 32 bits.
START = np.array([isqrt(p << 64) & 0xFFFFFFFF for p in primes(8)], np.uint32)[:, None]
ROUND = np.array([cube_root(p << 96) & 0xFFFFFFFF for p in primes(64)], np.uint32)


def turned(x: np.ndarray, *by: int) -> np.ndarray:
    """XOR of right rotations."""
    out = (x >> np.uint32(by[0])) | (x << np.uint32(32 - by[0]))
    for k in by[1:]:
        out ^= (x >> np.uint32(k)) | (x << np.uint32(32 - k))
    return out


def compress(state: np.ndarray, block: np.ndarray) -> np.ndarray:
    """States (8 x n words) after one more block (16 x n words, or 16 x 1 for the same block everywhere)."""
    w = list(block)
    for t in range(16, 64):
        far, near = w[t - 15], w[t - 2]
        w.append(w[t - 16] + (turned(far, 7, 18) ^ (far >> np.uint32(3))) + w[t - 7] + (turned(near, 17, 19) ^ (near >> np.uint32(10))))
    a, b, c, d, e, f, g, h = state
    for t in range(64):
        one = h + turned(e, 6, 11, 25) + (g ^ (e & (f ^ g))) + ROUND[t] + w[t]
        two = turned(a, 2, 13, 22) + ((a & b) | (c & (a | b)))
        a, b, c, d, e, f, g, h = one + two, a, b, c, d + one, e, f, g
    return state + np.stack([np.broadcast_to(x, state.shape[1]) for x in (a, b, c, d, e, f, g, h)])


def in_parts(state: np.ndarray, block: np.ndarray, size: int = 4096) -> np.ndarray:
    """``compress`` on slices that fit a processor's cache."""
    if state.shape[1] <= size:
        return compress(state, block)
    cut = range(0, state.shape[1], size)
    return np.concatenate([compress(state[:, k : k + size], block if block.shape[1] == 1 else block[:, k : k + size]) for k in cut], axis=1)


def hex_block(digests: np.ndarray) -> np.ndarray:
    """The lowercase hex text of digests (8 x n words) as blocks (16 x n words)."""
    halves = np.empty((16, digests.shape[1]), np.uint32)
    halves[0::2], halves[1::2] = digests >> np.uint32(16), digests & np.uint32(0xFFFF)
    x = (halves | (halves << np.uint32(8))) & np.uint32(0x00FF00FF)
    x = (x | (x << np.uint32(4))) & np.uint32(0x0F0F0F0F)
    letters = ((x + np.uint32(0x06060606)) >> np.uint32(4)) & np.uint32(0x01010101)
    return x + np.uint32(0x30303030) + letters * np.uint32(0x27)


def ending(children: int) -> np.ndarray:
    """The last block of a message of so many digests in hex."""
    block = np.zeros((16, 1), np.uint32)
    block[0], block[15] = 0x80000000, children * 512
    return block


ENDINGS = [ending(k) for k in range(FANOUT + 1)]


def finished(state: np.ndarray, children: np.ndarray) -> np.ndarray:
    """Digests from the states after all children."""
    out = state.copy()
    for k in range(1, FANOUT + 1):
        own = np.flatnonzero(children == k)
        if len(own):
            out[:, own] = in_parts(state[:, own], ENDINGS[k])
    return out


def words(raw: bytes | np.ndarray) -> np.ndarray:
    """32-byte values one after the other as 8 x n words."""
    return np.frombuffer(raw, ">u4").astype(np.uint32).reshape(-1, 8).T.copy()


def raw(values: np.ndarray) -> np.ndarray:
    """8 x n words as n x 32 bytes."""
    return np.ascontiguousarray(values.T.astype(">u4")).view(np.uint8).reshape(-1, 32)


# Blocks ------------------------------------------------------------------------------


def level_sizes(n: np.ndarray, later: np.ndarray) -> np.ndarray:
    """Nodes per level of blocks of ``n`` leaves; 0 above the top.

    The first block of a tree ends at one node (if it is not the only one, it is full and ends there, too);
    later blocks have all levels, so that their tops are of equal height.
    """
    sizes = np.zeros((len(n), DEPTH + 1), np.int64)
    sizes[:, 0] = n
    for level in range(DEPTH):
        here = sizes[:, level]
        sizes[:, level + 1] = np.where((here > 1) | (later & (here > 0)), -(-here // FANOUT), 0)
    return sizes


def build_blocks(leaves: np.ndarray, n: np.ndarray, later: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All nodes (8 x total words, block by block, level by level), the states before them, and each block's first node."""
    sizes = level_sizes(n, later)
    base = np.concatenate([[0], np.cumsum(sizes.sum(axis=1))])
    start = base[:-1, None] + np.cumsum(sizes, axis=1) - sizes
    nodes, states = np.zeros((8, base[-1]), np.uint32), np.zeros((8, base[-1]), np.uint32)

    def spread(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        block = np.repeat(np.arange(len(counts)), counts)
        return block, np.arange(len(block)) - np.repeat(np.cumsum(counts) - counts, counts)

    block, i = spread(sizes[:, 0])
    nodes[:, start[block, 0] + i] = leaves
    for level in range(DEPTH):
        block, i = spread(sizes[:, level + 1])
        if not len(block):
            break
        first = start[block, level] + FANOUT * i
        children = np.minimum(FANOUT, sizes[block, level] - FANOUT * i)
        state = np.repeat(START, len(block), axis=1)
        for slot in range(FANOUT):
            own = np.flatnonzero(children > slot)
            states[:, first[own] + slot] = state[:, own]
            state[:, own] = in_parts(state[:, own], hex_block(nodes[:, first[own] + slot]))
        nodes[:, start[block, level + 1] + i] = finished(state, children)
    return nodes, states, base


KEY = ["tree", "block"]
BLOCK = "tree long, block long, n long, nodes binary, states binary, top binary"


def blocks_of(nodes: DataFrame) -> DataFrame:
    """One row per block from (tree, pos, digest)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, KEY, ROWS):
            tree, block = (table.column(c).to_numpy() for c in KEY)
            first = np.flatnonzero(np.concatenate([[True], (np.diff(tree) != 0) | (np.diff(block) != 0)]))
            n = np.diff(np.append(first, len(tree)))
            nodes, states, base = build_blocks(words(b"".join(table.column("digest").to_pylist())), n, block[first] > 0)
            nodes, states = raw(nodes), raw(states)
            cut = [slice(a, b) for a, b in zip(base, base[1:], strict=False)]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(tree[first]),
                    pa.array(block[first]),
                    pa.array(n),
                    pa.array([nodes[c].tobytes() for c in cut], pa.binary()),
                    pa.array([states[c].tobytes() for c in cut], pa.binary()),
                    pa.array([nodes[c.stop - 1].tobytes() for c in cut], pa.binary()),
                ],
                ["tree", "block", "n", "nodes", "states", "top"],
            )

    keyed = nodes.select("tree", F.floor(F.col("pos") / SPAN).cast("long").alias("block"), "pos", "digest")
    return keyed.repartition(*KEY).sortWithinPartitions(*KEY, "pos").mapInArrow(run, BLOCK)


def build_layers(nodes: DataFrame, label: str) -> list[DataFrame]:
    """Blocks of all trees, lowest first, up to one block per tree."""
    layers = []
    while True:
        layers.append(written(blocks_of(nodes), label))
        if not (layers[-1].agg(F.max("block")).first()[0] or 0):
            return layers
        nodes = layers[-1].select("tree", F.col("block").alias("pos"), F.col("top").alias("digest"))


@dataclass(frozen=True)
class Manifest:
    """``leaves``: the rows with their tree and place; ``layers``: the blocks of the sources' trees, lowest first;
    ``subroots``: the sources' roots and their places; ``above``: the blocks of the tree over them.
    """

    leaves: DataFrame
    layers: list[DataFrame]
    subroots: DataFrame
    above: list[DataFrame]


def field(name: str) -> Column:
    value = quoted(name).cast("string")
    return F.when(value.isNull(), "-").otherwise(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value))


def leaf_of(*fields: Column) -> Column:
    return F.unhex(F.sha2(F.concat(*fields).cast("binary"), 256))


FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def tampered(docs: DataFrame) -> DataFrame:
    """``leaf`` of each row and ``given``, the leaf of what it has become: every second id's text loses its line breaks."""
    gone = F.translate(quoted("text"), "\n", "")
    other = F.when(gone.isNull(), "-").otherwise(F.concat(F.octet_length(gone).cast("string"), F.lit(":"), gone))
    whole = [field(c) for c in FIELDS]
    hit = F.coalesce(F.crc32(quoted("doc_id").cast("string").cast("binary")) % 2 == 0, F.lit(False))
    leaf = leaf_of(*whole)
    given = F.when(hit & quoted("text").contains("\n"), leaf_of(*whole[:-1], other))
    return docs.select("doc_id", "source", leaf.alias("leaf"), given.alias("given"))


def build(leaves: DataFrame) -> Manifest:
    """The manifest of rows (doc_id, source, leaf); other columns of theirs stay in its ``leaves``."""
    stored = written(leaves.withColumn("row", F.monotonically_increasing_id()), "leaves")
    rows = placed(stored, ["source"], [F.col("doc_id"), F.col("leaf"), F.col("row")], "leaf_places")
    rows = rows.withColumnRenamed("run", "tree")
    layers = build_layers(rows.select("tree", "pos", F.col("leaf").alias("digest")), "tree")
    # Trees are numbered in the order of their sources, so their roots are leaves in that order.
    tops = placed(layers[-1].select(F.lit(0).alias("all"), "tree", "top"), ["all"], [F.col("tree")], "subroots")
    tops = tops.select("tree", "pos", "top")
    above = build_layers(tops.select(F.lit(0).cast("long").alias("tree"), "pos", F.col("top").alias("digest")), "above")
    return Manifest(rows, layers, tops, above)


# Paths from a node to the root, and what they say of a changed leaf -------------------

STEP = np.dtype([("children", "u1"), ("slot", "u1"), ("state", "u1", 32), ("others", "u1", (FANOUT - 1, 32))])


def steps_in_block(blocks: dict[str, np.ndarray | list], block: np.ndarray, i: np.ndarray) -> np.ndarray:
    """(DEPTH, rows) steps of leaf ``i`` of each row's block; no children where the block has ended."""
    n, later = blocks["n"], blocks["later"]
    sizes = level_sizes(n, later)
    base = np.cumsum(sizes.sum(axis=1)) - sizes.sum(axis=1)
    start = base[:, None] + np.cumsum(sizes, axis=1) - sizes
    nodes = np.frombuffer(b"".join(blocks["nodes"]), np.uint8).reshape(-1, 32)
    states = np.frombuffer(b"".join(blocks["states"]), np.uint8).reshape(-1, 32)
    out = np.zeros((DEPTH, len(i)), STEP)
    for level in range(DEPTH):
        own = np.flatnonzero(sizes[block, level + 1] > 0)
        b, k, step = block[own], i[own], out[level]
        slot = k % FANOUT
        at = start[b, level] + k
        step["children"][own] = children = np.minimum(FANOUT, sizes[b, level] - k + slot)
        step["slot"][own], step["state"][own] = slot, states[at]
        for other in range(FANOUT - 1):
            there = np.flatnonzero(other < children - 1)
            sibling = at[there] - slot[there] + other + (other >= slot[there])
            step["others"][own[there], other] = nodes[sibling]
        i = i // FANOUT
    return out


def fold_steps(digests: np.ndarray, steps: np.ndarray) -> np.ndarray:
    """What nodes (8 x n words) give after a row of steps: the stored state, the node, and what stands to its right."""
    out = digests.copy()
    own = np.flatnonzero(steps["children"] > 0)
    if not len(own):
        return out
    step = steps[own]
    state = in_parts(words(np.ascontiguousarray(step["state"])), hex_block(out[:, own]))
    for other in range(FANOUT - 1):
        right = np.flatnonzero((other >= step["slot"]) & (other < step["children"] - 1))
        if len(right):
            state[:, right] = in_parts(state[:, right], hex_block(words(np.ascontiguousarray(step["others"][right, other]))))
    out[:, own] = finished(state, step["children"])
    return out


def siblings_hex(steps: np.ndarray) -> bytes:
    return b"".join(bytes(s["others"][k]).hex().encode() for s in steps for k in range(max(0, int(s["children"]) - 1)))


def stream(blocks: DataFrame, paths: DataFrame, rows: DataFrame | None) -> DataFrame:
    """Each block, with its path to the root, before its rows, blocks side by side."""
    heads = blocks.join(paths, KEY).select(*KEY, F.lit(-1).cast("long").alias("pos"), "n", "nodes", "states", "path", "subroot", "root")
    if rows is not None:
        heads = heads.unionByName(rows, allowMissingColumns=True)
    return heads.repartition(*KEY).sortWithinPartitions(*KEY, "pos")


def heads_of(table: pa.Table) -> tuple[np.ndarray, dict]:
    head = np.flatnonzero(table.column("pos").to_numpy() < 0)
    some = table.take(pa.array(head))
    blocks = {c: some.column(c).to_pylist() for c in ("nodes", "states", "path", "subroot", "root")}
    return head, blocks | {"n": some.column("n").to_numpy().astype(np.int64), "later": some.column("block").to_numpy() > 0}


PATH = "tree long, block long, path binary, subroot binary, root binary"


def paths_below(blocks: DataFrame, paths: DataFrame) -> DataFrame:
    """The paths of a layer's leaves, which are the blocks of the layer below."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, KEY, 8):
            head, held = heads_of(table)
            block = np.repeat(np.arange(len(head)), held["n"])
            i = np.arange(len(block)) - np.repeat(np.cumsum(held["n"]) - held["n"], held["n"])
            steps = steps_in_block(held, block, i)
            path = [steps[steps["children"][:, r] > 0, r].tobytes() + held["path"][b] for r, b in enumerate(block)]
            tree = np.repeat(table.column("tree").to_numpy()[head], held["n"])
            columns = [pa.array(tree), pa.array(i + SPAN * np.repeat(table.column("block").to_numpy()[head], held["n"])), pa.array(path, pa.binary())]
            columns += [pa.array([held[c][b] for b in block], pa.binary()) for c in ("subroot", "root")]
            yield pa.RecordBatch.from_arrays(columns, ["tree", "block", "path", "subroot", "root"])

    return stream(blocks, paths, None).mapInArrow(run, PATH)


def paths_of(manifest: Manifest) -> DataFrame:
    """The path of every block of the lowest layer."""
    root = F.col("top").alias("root")
    paths = manifest.above[-1].select(*KEY, F.lit(b"").alias("path"), F.lit(None).cast("binary").alias("subroot"), root)
    for blocks in reversed(manifest.above):
        paths = paths_below(blocks, paths)
    paths = paths.select(F.col("block").alias("pos"), "path", "root")
    paths = manifest.subroots.join(paths, "pos").select("tree", F.lit(0).cast("long").alias("block"), "path", F.col("top").alias("subroot"), "root")
    for blocks in reversed(manifest.layers[1:]):
        paths = paths_below(blocks, paths)
    return paths


FOLDED = "doc_id long, leaf binary, subroot binary, root binary, proof binary, folded binary"


def fold(manifest: Manifest) -> DataFrame:
    """Per leaf: ``subroot``, ``root``, ``proof`` (SHA-256 of its siblings' hex, upwards) and ``folded``.

    ``folded`` is the root that ``given``, where it is not null, makes in the leaf's place.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, KEY, ROWS):
            head, held = heads_of(table)
            is_row = table.column("pos").to_numpy() >= 0
            block = (np.cumsum(~is_row) - 1)[is_row]
            rows = table.filter(pa.array(is_row))
            steps = steps_in_block(held, block, rows.column("pos").to_numpy() % SPAN)
            leaf, given = rows.column("leaf").to_pylist(), rows.column("given").to_pylist()
            folded = words(b"".join(g or x for g, x in zip(given, leaf, strict=True)))
            for level in range(DEPTH):
                folded = fold_steps(folded, steps[level])
            upper = [np.frombuffer(p, STEP) for p in held["path"]]
            longest = max(map(len, upper), default=0)
            padded = np.zeros((longest, len(upper)), STEP)
            for k, path in enumerate(upper):
                padded[: len(path), k] = path
            for level in range(longest):
                folded = fold_steps(folded, padded[level][block])
            rest = [siblings_hex(p) for p in upper]
            proof = [hashlib.sha256(siblings_hex(steps[:, r]) + rest[b]).digest() for r, b in enumerate(block)]
            columns = [rows.column("doc_id").combine_chunks(), pa.array(leaf, pa.binary())]
            columns += [pa.array([held[c][b] for b in block], pa.binary()) for c in ("subroot", "root")]
            columns += [pa.array(proof, pa.binary()), pa.array([x.tobytes() for x in raw(folded)], pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "leaf", "subroot", "root", "proof", "folded"])

    rows = manifest.leaves.select(
        "tree", F.floor(F.col("pos") / SPAN).cast("long").alias("block"), "pos", F.col("doc_id").cast("long").alias("doc_id"), "leaf", "given"
    )
    return stream(manifest.layers[0], paths_of(manifest), rows).mapInArrow(run, FOLDED)


def verified(docs: DataFrame) -> DataFrame:
    """The proof of each row, and whether it still holds after ``tampered``."""
    found = fold(build(tampered(docs)))

    def text(name: str) -> Column:
        return F.lower(F.hex(name))

    return found.select(
        "doc_id",
        text("leaf").alias("leaf"),
        text("subroot").alias("subroot"),
        text("root").alias("root"),
        text("proof").alias("proof_sha256"),
        text("folded").alias("folded_root"),
        (F.col("folded") == F.col("root")).alias("verified"),
    )
