"""Links between short near copies whose shingles also stand alone in unrelated texts."""

import brute
import numpy as np

from keyloom.llm import similar


def short_copies(groups=250):
    """(doc_id, text): per group a text of 9 to 16 words, a near copy, and up to three texts with a single shingle of both."""
    rng = np.random.default_rng(9)
    rows = []
    for g in range(groups):
        size = 9 + g % 8
        words = [f"g{g}w{i}" for i in range(size)]
        rows += [" ".join(words), " ".join(words[:-1] if g % 2 else [*words, f"g{g}more"])]
        for k, at in enumerate(rng.permutation(size - 5)[: g % 4]):
            lead, tail = ([f"g{g}other{k}{side}{i}" for i in range(8)] for side in "ab")
            rows.append(" ".join([*lead, *words[at : at + 5], *tail]))
    return [(i, rows[j]) for i, j in enumerate(rng.permutation(len(rows)))]


def test_links_of_short_near_copies(spark):
    rows = short_copies()
    got = [tuple(r) for r in similar.link_documents(spark.createDataFrame(rows, "doc_id long, text string")).collect()]
    want = [(i, *x) for (i, _), x in zip(rows, brute.linked(rows), strict=True)]
    assert sum(c != i for i, _, c in want) == 250
    assert sorted(got) == sorted(want)
