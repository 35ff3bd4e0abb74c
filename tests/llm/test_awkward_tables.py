"""Empty tables, clashing columns and awkward rows, for the queries themselves."""

import hashlib

import brute
import pytest
from pyspark.sql import functions as F

from keyloom.llm import archive, repeats
from keyloom.llm.queries import QUERIES

SMALL = "/root/testdata/sf0.001"
NAMES = ("documents", "embeddings", "pages", "benchmark", "labels", "conversations")
CLASHING = (
    "row", "pos", "run", "part", "at", "lead", "tree", "block", "leaf", "given", "size", "shard", "slot", "digest", "payload", "header", "length",
    "first", "kind", "copy", "bytes", "tid", "t_key", "copies", "chunk", "tokens", "word", "place", "n", "c", "class", "codes", "rank", "score",
)


@pytest.fixture(scope="module")
def empty(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("empty"))
    for name in NAMES:
        spark.read.parquet(f"{SMALL}/{name}.parquet").limit(0).write.parquet(f"{folder}/{name}.parquet")
    return folder


@pytest.fixture(scope="module")
def clashing(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("clashing"))
    for name in NAMES:
        rows = spark.read.parquet(f"{SMALL}/{name}.parquet")
        extra = {c: F.lit("x") for c in CLASHING if c not in rows.columns}
        rows.withColumns(extra).write.parquet(f"{folder}/{name}.parquet")
    return folder


@pytest.mark.parametrize("name", sorted(n for n in QUERIES if n != "pipeline"))
def test_empty_tables(spark, empty, name):
    assert QUERIES[name](spark, empty).count() == (1 if name.startswith("op1_") else 0)


@pytest.mark.parametrize("name", [n for n in sorted(QUERIES) if n.split("_")[0] in ("op2", "op5", "op8", "op10", "op11", "op13")])
def test_clashing_columns(spark, clashing, name):
    plain, other = (sorted(map(repr, QUERIES[name](spark, folder).collect())) for folder in (SMALL, clashing))
    assert plain == other


def test_repeats_on_the_correctness_tables(spark):
    folder = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
    got = [tuple(r) for r in QUERIES["op4_suffix_array_dedup"](spark, folder).collect()]
    assert sorted(got) == sorted(brute.without_repeats(rows)) and repeats.LENGTH == 400


PAGES = [(1, "u1", "p" * 100), (2, None, "p" * 100), (2, "u3", "p" * 100), (None, "u4", "p" * 100), (5, "u\r\n5", None), (6, "", ""), (7, "u7", "p" * 99), (8, "u8", "p" * 99), (9, "u9", "é" * 200000)]


@pytest.fixture(scope="module")
def written(spark):
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string").withColumns({"digest": F.lit(1), "row": F.lit(2)})
    return archive.write_archive(pages, captured="2024-03-01T08:00:00Z")


def test_awkward_pages(written):
    got = sorted(map(repr, (tuple(r) for r in archive.parsed(archive.read_archive(*written)).collect())))
    want = []
    for page_id, url, html in PAGES:
        payload = (html or "").encode()
        again = len(payload) == 100 and page_id != 1
        address = (url or "").replace("\r\n", "  ") or None
        want.append((page_id, address, len(payload), hashlib.sha256(payload).hexdigest(), "revisit" if again else "response", 1 if again else None))
    assert got == sorted(map(repr, want))


def test_records_have_the_mandatory_fields(written):
    heads = [bytes(r["header"]).decode() for r in written[0].collect()]
    assert len(heads) == len(PAGES)
    for head in heads:
        fields = dict(line.split(": ", 1) for line in head.split("\r\n")[1:] if line)
        assert head.startswith("WARC/1.1\r\n") and {"WARC-Type", "WARC-Record-ID", "WARC-Date", "Content-Length"} <= set(fields)
        assert fields["WARC-Date"] == "2024-03-01T08:00:00Z" and ("WARC-Profile" in fields) == (fields["WARC-Type"] == "revisit")


def test_a_damaged_payload_is_noticed(written):
    headers, payloads, path = written
    broken = payloads.withColumn("payload", F.when(F.octet_length("payload") == 100, F.lit(b"q" * 100)).otherwise(F.col("payload")))
    with pytest.raises(Exception, match="does not match its digest"):
        archive.read_archive(headers, broken, path).collect()
