"""Every stage of the corpus pipeline against a plain version, each on its own input."""

import math
import re
from collections import Counter, defaultdict

import brute
import pytest
from pyspark.sql import functions as F
from test_short_copies import short_copies

import corpus_pipeline
from keyloom.llm import licenses, mixing, sharding, toxicity
from keyloom.llm.common import written
from keyloom.llm.queries import QUERIES

SMALL = "/root/testdata/sf0.001"


def test_near_duplicates_stage_keeps_one_of_short_near_copies(spark):
    rows = short_copies()
    kept = corpus_pipeline.keep_one_of_near_copies(spark, spark.createDataFrame(rows, "doc_id long, text string"), "")
    want = [(i, t) for (i, t), (_, c) in zip(rows, brute.linked(rows), strict=True) if i == c]
    assert sorted(map(tuple, kept.collect())) == want


COLUMNS = "doc_id long, text string, source string"


@pytest.fixture(scope="module")
def inputs(spark):
    """The documents of sf0.001, and a small fixture with nulls, empty texts and benchmark passages."""
    item = spark.read.parquet(f"{SMALL}/benchmark.parquet").filter("text is not null").orderBy("item_id").first()["text"]
    words = [" ".join(f"d{i}w{j}" for j in range(20 + 3 * i)) for i in range(40)]
    rows = [(i, w, "abc"[i % 3]) for i, w in enumerate(words)]
    rows += [(100, words[7] + " more", "a"), (101, f"{words[8]} {item}", "b"), (102, item.upper(), None), (103, None, "a"), (104, "", None), (105, "one two", "c")]
    return [spark.read.parquet(f"{SMALL}/documents.parquet"), spark.createDataFrame(rows, COLUMNS)]


def plain(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


def test_toxicity_stage_drops_what_the_chain_rejects(spark, inputs):
    """The model has no plain version: given its probabilities, what stays is worked out row by row."""
    docs, labels = inputs[0], spark.read.parquet(f"{SMALL}/labels.parquet")
    chain = toxicity.fit_chain(docs, labels)
    least = next(k.threshold for k in chain.links if k.name == "toxic")
    scored = chain.score(docs).select("doc_id", "text", "toxicity.toxic").collect()
    stay = [(i, t) for i, t, p in scored if not t or p < least]
    assert len(scored) == docs.count()
    assert plain(corpus_pipeline.drop_toxic(spark, docs, SMALL), "doc_id", "text") == sorted(stay, key=repr)


def test_toxicity_stage_on_unseen_rows(spark, folder):
    rows = []
    for i in range(600):
        rest = " ".join(f"w{(i * 7 + k * k) % 50}" for k in range(20))
        rows.append((i, rest + (" vile hateful" if i % 5 == 0 else " kind"), int(i % 5 == 0), float(i % 3 > 0)))
    table = spark.createDataFrame(rows, "doc_id long, text string, toxic int, quality double")
    table.filter("doc_id < 400").select("doc_id", "toxic", "quality").write.parquet(f"{folder}/labels.parquet")
    left = {r["doc_id"] for r in corpus_pipeline.drop_toxic(spark, table.select("doc_id", "text"), folder).collect()}
    assert left == {i for i in range(600) if i % 5}


def test_near_duplicates_stage(spark, inputs):
    for docs in inputs:
        rows = plain(docs, "doc_id", "text")
        stay = [(i, t) for (i, t), (n, c) in zip(rows, brute.linked(rows), strict=True) if n == 0 or i == c]
        assert plain(corpus_pipeline.keep_one_of_near_copies(spark, docs, SMALL), "doc_id", "text") == stay


def words_of(text):
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def test_decontamination_stage(spark, inputs):
    items = [words_of(r["text"]) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    windows = {tuple(w[i : i + 13]) for w in items if w for i in range(max(1, len(w) - 12))}
    sizes = {len(w) for w in windows}

    def clean(text):
        words = words_of(text)
        hit = {k for n in sizes for i in range(len(words) - n + 1) if tuple(words[i : i + n]) in windows for k in range(i, i + n)}
        return not hit or 20 * len(hit) < len(words)

    for docs in inputs:
        rows = plain(docs, "doc_id", "text")
        stay = [(i, t) for i, t in rows if clean(t)]
        assert len(stay) < len(rows)
        assert plain(corpus_pipeline.drop_benchmark_copies(spark, docs, SMALL), "doc_id", "text") == stay


def mixed(spark, docs):
    """[(doc_id, source, words, copies)] by sorting each source in one place; and the targets."""
    labels = {}
    for r in spark.read.parquet(f"{SMALL}/labels.parquet").filter("doc_id is not null and quality is not null").collect():
        labels[r["doc_id"]] = max(labels.get(r["doc_id"], 0), r["quality"])
    sources = defaultdict(list)
    for i, text, source, h in docs.select("doc_id", "text", "source", F.xxhash64("doc_id", "source", "text")).collect():
        u = ((h % (1 << 64) >> 11) + 0.5) / (1 << 53)
        weight = {1: 2.0, 0: 0.5, None: 1.0}[labels.get(i)]
        sources[source].append((-math.log(u) / weight, i, len([w for w in re.split("[ \t-\r]+", text or "") if w])))
    sizes = {s: sum(n for *_, n in rows) for s, rows in sources.items()}
    target, out = brute.shares(sizes), []
    for s, rows in sources.items():
        epochs = int(target[s] // sizes[s])
        budget, end = target[s] - epochs * sizes[s], 0
        for _, i, n in sorted(rows):
            start, end = end, end + n
            out.append((i, s, n, epochs + int(start < budget and end - budget <= budget - start)))
    return out, target


def test_mixing_stage_and_its_sums(spark, inputs):
    for docs in inputs:
        want, target = mixed(spark, docs)
        rows = mixing.mix(mixing.sized(docs, spark.read.parquet(f"{SMALL}/labels.parquet")), F.col("_weight"), F.col("_hash"))
        got = [tuple(r) for r in rows.select("doc_id", "source", "size", "copies").collect()]
        # Rows without words add nothing to the sums.
        assert sorted((r for r in got if r[2]), key=repr) == sorted((r for r in want if r[2]), key=repr)
        for s, goal in target.items():
            assert abs(sum(n * c for _, x, n, c in got if x == s) - goal) <= max(n for _, x, n, _ in got if x == s) / 2 + 1e-6
        times = Counter(r["doc_id"] for r in corpus_pipeline.mix_sources(spark, docs, SMALL).collect())
        assert all(times[i] == c for i, _, n, c in want if n)
    rows = [tuple(r) for r in QUERIES["op8_mixing"](spark, SMALL).select("doc_id", "source", "size", "taken").collect()]
    want, _ = mixed(spark, inputs[0])
    assert sorted(rows, key=repr) == sorted(((i, s, n, n * c) for i, s, n, c in want), key=repr)


def dealt(sizes, shards, slots):
    """{virtual slot: bytes} -> {virtual slot: shard}: the largest stay up to the mean, the others go to the emptiest."""
    mean, loads, to, pool = sum(sizes.values()) / shards, [0] * shards, {}, []
    for k in range(shards):
        seen = 0
        for v in sorted(range(k, slots, shards), key=lambda v: (-sizes.get(v, 0), v)):
            seen += sizes.get(v, 0)
            if seen <= mean or not sizes.get(v, 0):
                to[v], loads[k] = k, loads[k] + sizes.get(v, 0)
            else:
                pool.append(v)
    for v in sorted(pool, key=lambda v: (-sizes[v], v)):
        to[v] = loads.index(min(loads))
        loads[to[v]] += sizes[v]
    return to


def check_shards(rows):
    """[(size, shard, slot, virtual slot)]: the map of a plain version, slots from 0, and near-equal bytes."""
    sizes = Counter()
    for size, _, _, v in rows:
        sizes[v] += size
    to = dealt(sizes, sharding.SHARDS, sharding.SLOTS)
    assert [r[1] for r in rows] == [to[r[3]] for r in rows]
    loads = Counter({k: 0 for k in range(sharding.SHARDS)})
    for k in range(sharding.SHARDS):
        mine = sorted((r for r in rows if r[1] == k), key=lambda r: r[2])
        assert [r[2] for r in mine] == list(range(len(mine))) and [r[3] for r in mine] == sorted(r[3] for r in mine)
        loads[k] = sum(r[0] for r in mine)
    assert max(loads.values()) <= sum(sizes.values()) / sharding.SHARDS + max(sizes.values())


def test_sharding_stage_and_its_loads(spark, inputs):
    for docs in inputs:
        placed = corpus_pipeline.deal_into_shards(spark, docs, SMALL)
        assert plain(placed, *docs.columns) == plain(docs, *docs.columns)
        check_shards([tuple(r) for r in placed.select("size", "shard", "slot", "virtual_slot").collect()])
    check_shards([tuple(r) for r in QUERIES["op2_sharding"](spark, SMALL).select("size", "shard", "slot", "virtual_slot").collect()])


def stated(text, templates, reach):
    """{license: containment} of a text, around each window that shares a shingle with the template."""

    def runs(words):
        return [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []

    words, out = [w for w in re.split("[^a-z0-9]+", (text or "").lower()) if w], {}
    every = runs(words)
    for name, template in templates:
        known = set(runs([w for w in re.split("[^a-z0-9]+", template.lower()) if w]))
        for at in range(0, len(every), licenses.STEP):
            if known & set(every[at : at + licenses.WINDOW]):
                first = max(at - reach, 0)
                share = len(known & set(runs(words[first : first + 2 * reach + licenses.WINDOW + 3]))) / len(known)
                if share >= licenses.CONTAINMENT:
                    out[name] = max(out.get(name, 0), share)
    return out


def test_license_containment(spark, inputs):
    reach = max(len([w for w in re.split("[^a-z0-9]+", t.lower()) if w]) - 2 for _, t in licenses.TEMPLATES)
    want = [(i, name, c) for i, t in plain(inputs[0], "doc_id", "text") for name, c in stated(t, licenses.TEMPLATES, reach).items()]
    assert want
    assert plain(licenses.scan(inputs[0]), "doc_id", "license", "containment") == sorted(want, key=repr)


def test_run_is_its_stages_in_a_row(spark):
    out = corpus_pipeline.run(spark, SMALL)
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES:
        docs = written(stage(spark, docs, SMALL), "expected")
    columns = [c for c in docs.columns if c not in ("slot", "virtual_slot", "shard")]
    assert out.columns == docs.columns and out.count() > 0
    assert plain(out, *columns) == plain(docs, *columns)
    check_shards([tuple(r) for r in out.select("size", "shard", "slot", "virtual_slot").collect()])
