import hashlib

from fleetpulse.llm import fixity
from tests.llm import cases

LEAF = "file bigint, offset bigint, length bigint, digest string"


def archive(files=3, records=400):
    return [(f, i * 700, 600 + i % 90, hashlib.sha256(f"{f}:{i}".encode()).hexdigest()) for f in range(files) for i in range(records)]


def faults(spark, left, right, **options):
    left, right = (spark.createDataFrame(x, LEAF) for x in (left, right))
    return sorted(map(tuple, fixity.audit(left, right, **options).collect()))


def test_finds_every_fault_and_no_other(spark):
    left = archive()
    right = list(left)
    right[5] = (*left[5][:3], "other")
    right[399] = (*left[399][:2], 1, left[399][3])
    del right[700]
    right.append((2, 10_000_000, 5, "late"))
    right.append((9, 0, 5, "file of its own"))
    expected = [
        (0, left[5][1], "damaged"), (0, left[399][1], "damaged"), (1, left[700][1], "missing"),
        (2, 10_000_000, "extra"), (9, 0, "extra"),
    ]
    assert faults(spark, left, right) == sorted(expected)
    assert faults(spark, left, right, segment=2048, fanout=2) == sorted(expected)


def test_equal_and_empty_replicas(spark):
    assert faults(spark, archive(1, 50), archive(1, 50)[::-1]) == []
    assert faults(spark, [], []) == []
    assert len(faults(spark, archive(1, 3), [])) == 3


def test_nulls_and_repeats(spark):
    rows = [(None, 1, 1, "a"), (1, None, 1, "a"), (1, 0, 1, None), (1, 5, 2, "x"), (1, 5, 2, "x"), (1, 5, 3, "y")]
    assert faults(spark, rows, rows[::-1]) == []
    assert faults(spark, rows, rows[:4] + rows[5:]) == [(1, 5, "damaged")]
    assert faults(spark, rows, rows[:2] + [(1, 0, 1, "")] + rows[3:]) == []


def test_layout_of_records(spark):
    from pyspark.sql import functions as F

    pages = cases.edge(spark).withColumn("url", F.col("source"))
    record = fixity.record_bytes("doc_id", "url", "text")
    rows = pages.select("doc_id", F.octet_length(record).cast("bigint").alias("length"), F.sha2(record, 256).alias("digest"))
    laid = fixity.layout(rows, ["doc_id", "digest"], per_file=7).collect()
    by_file = {}
    for r in laid:
        by_file.setdefault(r["file"], []).append(r)
    assert sorted(map(len, by_file.values())) == [6, 7, 7]
    for records in by_file.values():
        at = 0
        for r in sorted(records, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
    assert fixity.layout(rows.limit(0), ["doc_id", "digest"]).collect() == []


def test_record_is_a_warc_record(spark):
    row = spark.createDataFrame([(7, "http://a/", "<p>é")], "page_id bigint, url string, html string")
    raw = bytes(row.select(fixity.record_bytes("page_id", "url", "html")).first()[0])
    head, _, rest = raw.partition(b"\r\n\r\n")
    assert head.startswith(b"WARC/1.1\r\n") and b"Content-Length: 5" in head
    assert rest == "<p>é".encode() + b"\r\n\r\n"
