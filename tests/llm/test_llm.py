"""The training-data operators against plain versions, on the smallest tables and on awkward rows."""

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F

from keyloom.llm import chat, decontamination, licenses, mixing, neighbours, repeats, sharding, similar, toxicity
from keyloom.llm.queries import ORACLE, QUERIES

SMALL = "/root/testdata/sf0.001"
PASSAGE = " ".join(f"word{i}" for i in range(80))
AWKWARD = [
    (1, None, "a"),
    (2, "", "a"),
    (None, "x", None),
    (None, PASSAGE, None),
    (3, PASSAGE, "b"),
    (3, PASSAGE, "b"),
    (4, PASSAGE + " tail", "b"),
    (5, "one two", "c"),
    (6, "ONE\ttwo", "c"),
    (7, "a" * 900, "c"),
    (8, PASSAGE * 40, "d"),
    (9, "lead " + PASSAGE * 39, "d"),
    (10, " \n\t", "d"),
]


@pytest.fixture(scope="module")
def docs(spark):
    """Rows with nulls, empty, long and repeated texts, and columns named like the operators' own."""
    extra = {"shard": F.lit("s"), "contamination": F.lit(1), "_row": F.lit(2), "toxicity": F.lit(3), "node": F.lit(4)}
    return spark.createDataFrame(AWKWARD, "doc_id long, text string, source string").withColumns(extra)


@pytest.fixture(scope="module")
def nothing(docs):
    return docs.filter("doc_id = 99")


@pytest.fixture(scope="module")
def small(spark):
    rows = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()
    return [(r[0], r[1]) for r in rows]


def ordered(rows):
    return sorted(rows, key=repr)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_its_sql(spark, name):
    import oracle

    ok, message = oracle.compare(oracle.connect(SMALL), QUERIES[name](spark, SMALL), ORACLE[name])
    assert ok, message


def test_links(spark, docs, nothing, small):
    got = [tuple(r) for r in similar.link_documents(docs).collect()]
    want = [(i, *x) for (i, _, _), x in zip(AWKWARD, brute.linked([(i, t) for i, t, _ in AWKWARD]), strict=True)]
    # Without words, a row is its own component.
    want = [(i, n, i if n == 0 else c) for i, n, c in want]
    assert ordered(got) == ordered(want)
    assert similar.link_documents(nothing).count() == 0
    got = [tuple(r) for r in QUERIES["op9_ngram_jaccard_join"](spark, SMALL).collect()]
    assert ordered(got) == ordered([(i, *x) for (i, _), x in zip(small, brute.linked(small), strict=True)])


def test_one_of_each_group_stays(docs):
    kept = similar.keep_one(docs)
    assert kept.columns == docs.columns
    assert ordered(r["doc_id"] for r in kept.collect()) == ordered([1, 2, None, 3, 5, 7, 10])  # 8 and 9 repeat the words of 3


def test_repeats(spark, docs, nothing, small):
    results, _ = repeats.remove_repeats(docs)
    columns = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    got = [tuple(r) for r in repeats.per_document(docs, results).select(*columns).collect()]
    assert ordered(got) == ordered(brute.without_repeats([(i, t) for i, t, _ in AWKWARD]))
    results, _ = repeats.remove_repeats(nothing)
    assert repeats.per_document(nothing, results).count() == 0
    got = [tuple(r) for r in QUERIES["op4_suffix_array_dedup"](spark, SMALL).collect()]
    assert ordered(got) == ordered(brute.without_repeats(small))


def test_windows_of_hot_anchors_give_the_same(docs, monkeypatch):
    results, _ = repeats.remove_repeats(docs)
    monkeypatch.setattr(repeats, "MOST", 1)
    others, _ = repeats.remove_repeats(docs)
    assert ordered(map(tuple, others.collect())) == ordered(map(tuple, results.collect()))


def test_matching_statistics():
    rng = np.random.default_rng(3)
    for _ in range(60):
        strings = [bytes(rng.choice(list(b"ab\x00\xff"), rng.integers(1, 40))) for _ in range(6)]
        for length in (3, 8):
            seen = [s[i : i + length] for s in strings for i in range(len(s) - length + 1)]
            for s, mask in zip(strings, repeats.repeated(strings, length), strict=True):
                assert mask.tolist() == [i + length <= len(s) and seen.count(s[i : i + length]) > 1 for i in range(len(s))]


def test_streaming_through_the_runs_gives_whole_match_lengths():
    def match(a, b):
        return next((i for i, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b)))

    rng = np.random.default_rng(5)
    for alphabet in (b"ab", b"\x00\xffa") * 60:
        strings = [bytes(rng.choice(list(alphabet), rng.choice([0, 1, 3, 9, 14]))) for _ in range(rng.integers(1, 7))]
        index = repeats.RunLengthIndex(strings)
        got = index.matching_statistics()
        places = [(k, i) for k, s in enumerate(strings) for i in range(len(s))]
        for k, i in places:
            others = (match(strings[k][i:], strings[q][j:]) for q, j in places if (q, j) != (k, i))
            assert got[index.starts[k] + i] == max(others, default=0)
    copies = repeats.RunLengthIndex([b"abcdefgh" * 100] * 50)
    assert len(copies.first) < len(copies.left) // 90 and copies.run_lengths.sum() == len(copies.left)  # the runs are few


def test_conversations(spark):
    odd = ["\\", "<turn>", "\\</turn>\\\\", "<text>x", None, "", "a</turn>" * 300, "<tur"]
    rows = [(7, t, r, x) for t, x in enumerate(odd) for r in ("user", "assistant", None, "</turn>")] + [(None, None, "user", "q")] * 2
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    said = sorted(((t, r or "", x or "") for _, t, r, x in rows[:-2]))
    for part in (256, 3):
        got = {r[0]: tuple(r)[1:5] for r in chat.digests(chat.format_conversations(table, part=part)).collect()}
        assert got == {7: brute.spoken([(r, x) for _, r, x in said]), None: brute.spoken([("user", "q")] * 2)}
    assert chat.format_conversations(table.filter("turn = 99")).count() == 0


def test_templates_fold_and_stay_in_their_sandbox():
    made = chat.Template("{% if flag %}{{ 'a' ~ 1 }}{% else %}b{% endif %}{% for message in messages %}{{ text }}{% endfor %}", ("<x>",), {"flag": True})
    assert made.tree[0] == chat.Emit(chat.Const("a1")) and made.turn("user", "t", 0, True) == ("a1t", [])
    for bad in ("{{ text.__class__ }}", "{{ open('x') }}", "{{ other }}", "{% import os %}", "{% if 1 %}"):
        with pytest.raises(chat.TemplateError):
            chat.Template("{% for message in messages %}" + bad + "{% endfor %}", ("<x>",))


def test_shards(docs, nothing):
    sized = docs.withColumn("size", sharding.record_size())
    placed, versions = sharding.assign(sized, ["doc_id", "text"], "size", shards=3, slots=64)
    rows = placed.select("shard_", "slot").collect()
    assert len(rows) == len(AWKWARD) and versions.count() == 128
    for k in {r[0] for r in rows}:
        assert sorted(r[1] for r in rows if r[0] == k) == list(range(sum(r[0] == k for r in rows)))
    assert sharding.assign(nothing.withColumn("size", sharding.record_size()), ["doc_id"], "size")[0].count() == 0
    # Slots in many parts and in one: places are gapless either way, and shards are the same.
    big = docs.sparkSession.range(3000).select("id", (F.col("id") % 7).alias("_slot"), F.lit("x").alias("slot_part"), F.when(F.col("id") % 3 > 0, F.col("id")).alias("k"))
    big = big.withColumn("size", F.lit(20).cast("long"))
    one, many = (sharding.assign(big, ["k"], "size", shards=5, slots=32, parts=p)[0].select("id", "shard", "slot").collect() for p in (1, 8))
    assert {(r[0], r[1]) for r in one} == {(r[0], r[1]) for r in many} and len(many) == 3000
    for rows in (one, many):
        for k in range(5):
            assert sorted(r[2] for r in rows if r[1] == k) == list(range(sum(r[1] == k for r in rows)))


def test_mix(spark, docs, nothing):
    labels = spark.createDataFrame([(3, 1, 0), (3, 0, 0), (None, 1, 1)], "doc_id long, quality int, toxic int")
    rows = mixing.sized(docs, labels)
    mixed = mixing.mix(rows, F.col("_weight"), F.col("_hash")).collect()
    sizes = {}
    for r in mixed:
        sizes[r["source"]] = sizes.get(r["source"], 0) + r["size"]
    want = brute.shares(sizes)
    assert len(mixed) == len(AWKWARD) and all(abs(r["target"] - want[r["source"]]) < 1e-6 and r["copies"] <= 2 for r in mixed)
    assert mixing.mix_documents(docs, labels).columns == docs.columns
    assert mixing.mix_documents(nothing, labels).count() == 0


def test_decontamination_in_blocks(spark, docs, nothing):
    items = [(1, PASSAGE), (1, "one two"), (2, None), (None, "a b c"), (3, " ".join(f"word{i}" for i in range(20, 45)))]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    name = decontamination.scan(docs, benchmark).columns[-1]
    one, many = (ordered(decontamination.scan(docs, benchmark, block_bytes=b).select("doc_id", f"{name}.*").collect()) for b in (1 << 20, 200))
    assert one == many
    hit = {r["doc_id"]: (r["n_hit"], list(r["items"])) for r in one}
    assert hit[4] == (80, ["1", "3"]) and hit[6] == (2, ["1"]) and hit[7] == (0, []) and hit[1] == (0, [])
    assert decontamination.decontaminate(nothing, benchmark).columns == docs.columns
    clean = {r["doc_id"]: r["text"] for r in decontamination.decontaminate(docs, benchmark, remove="spans").collect()}
    assert clean[4].strip() == "tail" and clean[1] is None and clean[7] == "a" * 900


def found_neighbours(table, **sizes):
    got = neighbours.nearest(table, F.col("vec_id") % 20 == 0, **sizes).collect()
    return sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in got)


def test_neighbours(spark):
    rng = np.random.default_rng(5)
    rows = [(i, rng.standard_normal(8).tolist()) for i in range(300)] + [(300 + i, [1.0] * 8) for i in range(60)]
    odd = [(900, None), (920, []), (940, [0.0] * 8), (960, [float("nan")] * 8), (980, [None] * 8), (None, [1.0] * 8)]
    table = spark.createDataFrame(rows + odd, "vec_id long, embedding array<double>")
    vectors = dict(rows)
    want = brute.nearest(vectors, [q for q in sorted(vectors) if q % 20 == 0])
    clash = ("row", "dim", "vector", "code", "q_strip", "c_strips", "score")
    for given in (table, table.withColumns({name: F.lit("x") for name in clash})):
        assert [g[:3] for g in found_neighbours(given, query_strip=7, code_strip=50)] == [w[:3] for w in want]
    assert [g[:3] for g in found_neighbours(table)] == [w[:3] for w in want]
    assert found_neighbours(table.filter("vec_id = 99999")) == []
    assert found_neighbours(table.filter("vec_id = 20")) == []  # no other vector


def test_neighbours_of_repeated_ids_and_other_lengths(spark):
    rows = [(0, [1.0, 0.0]), (1, [3.0, 1.0]), (1, [2.0, 5.0]), (2, [2.0, 5.0]), (20, [1.0, 1.0, 1.0]), (21, [2.0, 0.0, 1.0]), (40, [7.0])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert found_neighbours(table) == [(0, 1, 1, 3.0), (0, 2, 1, 2.0), (0, 3, 2, 2.0), (20, 1, 21, 3.0)]
    twice = spark.createDataFrame([(0, [1.0]), (0, [2.0])], "vec_id long, embedding array<double>")
    assert found_neighbours(twice) == [(0, 1, 0, 2.0), (0, 1, 0, 2.0)]


@pytest.mark.parametrize("folder", ["sf0.01", "sf0.1"])
def test_neighbours_of_the_given_vectors(spark, folder):
    """Recall of the registered query against brute force over all rows, and exact scores in the asked order."""
    given = spark.read.parquet(f"/root/testdata/{folder}/embeddings.parquet").toPandas()
    ids, vectors = given["vec_id"].to_numpy(), np.array(given["embedding"].tolist(), np.float64)
    place = {int(x): i for i, x in enumerate(ids)}
    got = [tuple(r) for r in QUERIES["op7_approximate_nearest_neighbours"](spark, f"/root/testdata/{folder}").orderBy("query_id", "rank").collect()]
    asked = [int(x) for x in np.sort(ids) if x % 20 == 0]
    assert [g[:2] for g in got] == [(q, r) for q in asked for r in range(1, 21)]
    assert all(abs(score - vectors[place[q]] @ vectors[place[v]]) < 1e-12 for q, _, v, score in got)
    assert got == sorted(got, key=lambda g: (g[0], -g[3], g[2]))
    hits = 0
    for q in asked:
        scores = vectors @ vectors[place[q]]
        scores[place[q]] = -np.inf
        hits += len({int(ids[i]) for i in np.lexsort((ids, -scores))[:20]} & {g[2] for g in got if g[0] == q})
    assert hits >= 0.99 * 20 * len(asked)


def test_licenses(spark, docs, nothing):
    text = "intro words here " * 30 + "Released under the MIT license. " + "more words there " * 30 + "Licensed under the Apache License, version 2.0!"
    found = licenses.scan(docs.limit(0).select("doc_id", "text").unionAll(spark.createDataFrame([(1, text), (1, text), (2, None), (3, "")], "doc_id long, text string")))
    assert ordered((r["doc_id"], r["license"], r["containment"]) for r in found.collect()) == [(1, "Apache-2.0", 1.0), (1, "MIT", 1.0)]
    assert licenses.scan(nothing).count() == 0
    assert 1 - (1 - licenses.SIMILARITY) ** licenses.BANDS >= licenses.CERTAINTY


def test_whole_license_texts(spark):
    rng = np.random.default_rng(11)

    def terms(n):
        return [f"term{k}" for k in rng.integers(0, 5000, n)]

    long, other = terms(700), terms(300)
    stated = [("LONG", " ".join(long)), ("LONG", " ".join(long)), ("OTHER", " ".join(other)), ("OTHER", "a short notice of the other license"), ("NONE", None), ("NONE", " .")]
    table = spark.createDataFrame(stated, "license string, template string")
    half = long[:350] + terms(350)
    most = long[:560] + terms(140)
    moved = long[400:] + terms(90) + long[:400]
    texts = [long, terms(200) + most, half, moved, terms(3000), other[:150] + long + terms(20) + other[150:], "x a short notice of the other license y".split()]
    docs = spark.createDataFrame([(i, " ".join(t), "s", 1) for i, t in enumerate(texts)] + [(7, None, "s", 1), (8, "", "s", 1)], "doc_id long, text string, section string, share int")

    def runs(tokens):
        return [" ".join(tokens[i : i + 3]) for i in range(max(1, len(tokens) - 2))]

    def shares(tokens, template):
        every, n = runs(template), -(-len(runs(template)) // licenses.SECTION)
        cuts = [set(every[len(every) * k // n : len(every) * (k + 1) // n]) for k in range(n)]
        starts = range(0, len(runs(tokens)), licenses.STEP)
        near = [set(runs(tokens[max(0, at - reach) :][: 2 * reach + licenses.WINDOW + licenses.SHINGLE])) for at in starts]
        return sum(max(len(c & some) for some in near) for c in cuts) / sum(map(len, cuts))

    want, reach = [], 64  # the longest section: 698 shingles in 11 of them
    for i, tokens in enumerate(texts):
        for name, forms in (("LONG", [long]), ("OTHER", [other, "a short notice of the other license".split()])):
            share = max(shares(tokens, f) for f in forms)
            if share >= licenses.CONTAINMENT:
                want.append((i, name, round(share, 9)))
    assert {(i, n) for i, n, _ in want} == {(0, "LONG"), (1, "LONG"), (3, "LONG"), (5, "LONG"), (5, "OTHER"), (6, "OTHER")}
    for block in (licenses.MAX_TEMPLATE_KEYS, 6000):  # one block, and several passes
        found = licenses.scan(docs, table, block_keys=block).collect()
        assert sorted((r["doc_id"], r["license"], round(r["containment"], 9)) for r in found) == want
        assert all(r["n_windows"] > 0 for r in found)
    assert licenses.scan(docs, table.limit(0)).count() == 0


def test_toxicity_words():
    assert toxicity.whole_words(None) == toxicity.whole_words(" _-. ") == set()
    assert toxicity.whole_words("Ab_c1 ab\x7fÉté") == {"ab", "c1", "été"}
    for text in ("One two_two\tthree-3 x", "ß·Ünder “quoted” words"):
        assert toxicity.whole_words(text) == toxicity.whole_words((text + " ") * (toxicity.LONG // len(text) + 1))
    assert toxicity.stems({"abcd", "abcde", "abcdef"}, 4) == {"abcd-"}


def test_toxicity_on_held_out_rows(spark, docs, nothing):
    rows = []
    for i in range(600):
        bad = i % 5 == 0
        rest = " ".join(f"w{(i * 7 + k * k) % 50}" for k in range(20))
        rows.append((i, rest + (" vile hateful" if bad else " kind") if i % 4 else rest + (" vile" if bad else ""), int(bad), float(i % 3 > 0)))
    table = spark.createDataFrame(rows, "doc_id long, text string, toxic int, quality double")
    seen = table.filter("doc_id < 400")
    labels = seen.select("doc_id", "toxic", "quality")
    chain = toxicity.fit_chain(seen, labels)
    scored = chain.score(table.filter("doc_id >= 400"))
    found = {r["doc_id"]: r["bad"] for r in scored.select("doc_id", chain.rejects(scored).alias("bad")).collect()}
    wrong = [i for i, bad in found.items() if bad != (i % 5 == 0)]
    assert len(found) == 200 and len(wrong) <= 4
    # Every row has a result, whatever its text and its other columns; no text is never rejected.
    scored = chain.score(docs)
    assert scored.columns[:-1] == docs.columns and scored.count() == docs.count()
    assert scored.filter(chain.rejects(scored)).filter("coalesce(text, '') = ''").isEmpty()
    # No label, one kind of label, null and repeated labels, no document.
    for known in (labels.limit(0), labels.filter("toxic = 0"), labels.unionByName(labels).unionByName(labels.selectExpr("doc_id", "null as toxic", "quality"))):
        chain = toxicity.fit_chain(seen, known)
        scored = chain.score(nothing)
        assert scored.filter(chain.rejects(scored)).count() == 0


def test_best_threshold(spark):
    rows = [(k / 40, int(k > 22) ^ int(k % 9 == 0)) for k in range(41)]
    got = toxicity.best_threshold(spark.createDataFrame(rows, "p double, _y int"), "p")

    def f1(t):
        hit = sum(y for p, y in rows if p >= t)
        return 2 * hit / (sum(y for _, y in rows) + sum(p >= t for p, _ in rows))

    assert f1(got) == max(f1(k / 100) for k in range(5, 96))
