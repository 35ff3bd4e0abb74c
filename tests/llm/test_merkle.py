"""The Merkle manifest against plain SHA-256 and a plain tree."""

import hashlib
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from keyloom.llm import merkle
from keyloom.llm.queries import QUERIES

SMALL = "/root/testdata/sf0.001"


def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    def field(v):
        return "-" if v is None else f"{len(str(v).encode())}:{v}"

    return digest(*map(field, row))


def climb(nodes):
    """All levels of a tree."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([digest(*levels[-1][i : i + 3]) for i in range(0, len(levels[-1]), 3)])
    return levels


def path(levels, i):
    """(siblings to the left, siblings to the right) per level."""
    out = []
    for nodes in levels[:-1]:
        first = i - i % 3
        out.append((nodes[first:i], nodes[i + 1 : first + 3]))
        i //= 3
    return out


def brute(rows):
    """[(doc_id, source, lang, n_chars, text)] -> the contract's rows."""
    sources = sorted({r[1] for r in rows}, key=lambda s: (s is not None, (s or "").encode()))
    own = {s: sorted((r for r in rows if r[1] == s), key=lambda r: (r[0] is not None, r[0] or 0, leaf(r))) for s in sources}
    trees = {s: climb([leaf(r) for r in own[s]]) for s in sources}
    top = climb([trees[s][-1][0] for s in sources])
    out = []
    for k, s in enumerate(sources):
        for i, r in enumerate(own[s]):
            steps = path(trees[s], i) + path(top, k)
            hit = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0
            at = leaf((*r[:4], r[4] and r[4].replace("\n", ""))) if hit else leaf(r)
            for a, b in steps:
                at = digest(*a, at, *b)
            proof = digest(*(x for a, b in steps for x in (*a, *b)))
            root = top[-1][0]
            out.append((r[0], leaf(r), trees[s][-1][0], root, proof, at, at == root))
    return out


def test_midstates_give_sha256():
    rng = np.random.default_rng(1)
    for children in (1, 2, 3):
        own = rng.integers(0, 256, (5, children, 32), np.uint8)
        state = np.repeat(merkle.START, 5, axis=1)
        for slot in range(children):
            state = merkle.compress(state, merkle.hex_block(merkle.words(np.ascontiguousarray(own[:, slot]))))
        got = merkle.raw(merkle.finished(state, np.full(5, children)))
        want = [hashlib.sha256(b"".join(bytes(x).hex().encode() for x in row)).digest() for row in own]
        assert [bytes(x) for x in got] == want


def ordered(rows):
    return sorted(rows, key=repr)


def test_documents(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SMALL}/documents.parquet").select(*merkle.FIELDS).collect()]
    got = [tuple(r) for r in QUERIES["op13_merkle_manifest"](spark, SMALL).collect()]
    assert ordered(got) == ordered(brute(rows))


@pytest.mark.parametrize("depth", [2, 7])
def test_awkward_rows(spark, monkeypatch, depth):
    """Many levels, single leaves, null fields and ids, repeated ids and rows, long texts, columns of the operator's own names."""
    monkeypatch.setattr(merkle, "DEPTH", depth)
    monkeypatch.setattr(merkle, "SPAN", 3**depth)
    rows = [(i, "hot", "en", i, f"a\nb{i}") for i in range(90)]
    rows += [(i, f"s{i % 13:02}", None, None, None if i % 3 else "") for i in range(100, 140)]
    rows += [(7, None, "x", -5, "é\n" * 50000), (7, "hot", "en", 7, "other\n"), (7, "hot", "en", 7, "a\nb7"), (None, None, None, None, None), (None, None, None, 1, "\n"), (8, "ß", "de", 1, "\n"), (-4, "z", "", 0, "-")]
    table = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")
    clashing = ["leaf", "given", "row", "tree", "pos", "run", "block", "part", "at", "lead", "root"]
    table = table.withColumns({c: F.lit(1) for c in clashing})
    assert ordered(tuple(r) for r in merkle.verified(table).collect()) == ordered(brute(rows))


def test_no_rows(spark):
    table = spark.createDataFrame([], "doc_id long, source string, lang string, n_chars long, text string")
    assert merkle.verified(table).count() == 0


def test_manifest_is_all_a_fold_needs(spark):
    """The right siblings and the stored states suffice: no left sibling's digest is read."""
    leaves = spark.createDataFrame([(i, "s", bytes([i]) * 32, bytes([99]) * 32 if i == 5 else None) for i in range(30)], "doc_id long, source string, leaf binary, given binary")
    manifest = merkle.build(leaves)
    found = {r["doc_id"]: r["folded"] for r in merkle.fold(manifest).collect()}
    other = merkle.build(leaves.withColumn("leaf", F.coalesce("given", "leaf")))
    assert bytes(found[5]) == bytes(merkle.paths_of(other).first()["root"])
