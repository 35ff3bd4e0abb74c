"""Links where very many texts share most of their shingles, and a text that has very many pairs."""

import brute
import numpy as np
import pytest

from keyloom.llm import similar


def template_texts(count, own=100, near=12):
    """(doc_id, text): texts that share 120 words with all others and have ``own`` words of their own, and a few near copies."""
    rng = np.random.default_rng(3)
    template = [f"t{i}" for i in range(120)]
    rows = [[*template, *(f"d{g}w{i}" for i in range(own))] for g in range(count)]
    rows += [[*rows[g][:-3], "x", "y"] for g in range(near)]
    return [(i, " ".join(rows[j])) for i, j in enumerate(rng.permutation(len(rows)))]


@pytest.mark.parametrize("hot, own", [(300, 100), (20, 20)])
def test_texts_on_one_template(spark, monkeypatch, hot, own):
    """Own words many enough to keep the template's out of the keys, or too few."""
    monkeypatch.setattr(similar, "HOT", hot)
    rows = template_texts(600 if hot > 100 else 80, own)
    given = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = [tuple(r) for r in similar.link_documents(given).collect()]
    assert sorted(got) == sorted((i, *x) for (i, _), x in zip(rows, brute.linked(rows), strict=True))
    if own == 100:  # nothing of the template is left to meet in, so only near copies share keys
        keys = similar.groups(given, "text", False).filter("key & 1 = 0")
        assert keys.filter("hot").count() == 0
        assert 0 < keys.select("node").distinct().count() <= 2 * 12


def test_counter_finds_frequent_keys(monkeypatch):
    monkeypatch.setattr(similar, "COMMON", 50)
    rng = np.random.default_rng(1)
    counter, frequent = similar.Counter(), np.arange(2, 22, 2, dtype=np.uint64)
    for _ in range(400):
        counter.add(np.sort(np.concatenate((frequent, rng.integers(1 << 20, 1 << 40, 30, dtype=np.uint64) * np.uint64(2)))))
    counter.settle()
    counts = dict(zip(counter.keys.tolist(), counter.counts.tolist(), strict=True))
    assert len(counts) <= 50
    assert all(400 - 400 * 40 / 50 <= counts[key] <= 400 for key in frequent.tolist())


def test_one_text_in_very_many_pairs(spark, monkeypatch):
    """A set goes out in copies, and the links are those of brute force."""
    monkeypatch.setattr(similar, "PARTNERS", 4)
    words = [f"w{i}" for i in range(40)]
    rows = [(0, " ".join(words))] + [(i, " ".join([*words, *(f"o{i}n{j}" for j in range(i % 14))])) for i in range(1, 90)]
    got = [tuple(r) for r in similar.link_documents(spark.createDataFrame(rows, "doc_id long, text string")).collect()]
    assert sorted(got) == sorted((i, *x) for (i, _), x in zip(rows, brute.linked(rows), strict=True))


def test_spare_keys():
    assert [similar.spare(n) for n in range(9)] == [0, 0, 1, 1, 2, 2, 2, 2, 2]
    spares = [similar.spare(n) for n in range(5000)]
    assert spares == sorted(spares)
    for n in range(1, 3000):  # the smallest partner of a set of n
        assert similar.difference(n) + 1 + similar.spare(n) <= n


def test_least_spare(spark):
    rows = spark.range(1, 3000).withColumn("least", similar.least_spare(similar.F.col("id"))).collect()
    assert all(r["least"] == similar.spare(-(-r["id"] * 75 // 100)) for r in rows)
