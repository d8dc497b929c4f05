"""Merkle fixity audit of WARC archives: find what differs between two replicas.

A record's leaf is the SHA-256 of its bytes. Records of a file meet in segments of its offsets,
segments in ordered ranges of ``FANOUT`` times the size, up to one root per file. Replicas are
compared from the roots down, and only children of ranges that differ are looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetpulse.operators.distribute import number_rows
from fleetpulse.session import write_once

SEGMENT_BYTES = 1 << 16  # offsets covered by the lowest range of a tree
FANOUT = 16
FILE_RECORDS = 1000  # records of an archive file


def record_bytes(record_id: str, url: str, payload: str, date: str = "1970-01-01T00:00:00Z") -> Column:
    """A WARC resource record: header, payload, two line ends. Null values are empty ones."""
    body = F.coalesce(F.col(payload), F.lit("")).cast("binary")
    head = F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: resource\r\nWARC-Record-ID: <urn:page:"),
        F.coalesce(F.col(record_id).cast("string"), F.lit("")),
        F.lit(">\r\nWARC-Target-URI: "),
        F.coalesce(F.col(url), F.lit("")),
        F.lit(f"\r\nWARC-Date: {date}\r\nContent-Type: text/html\r\nContent-Length: "),
        F.octet_length(body).cast("string"),
        F.lit("\r\n\r\n"),
    )
    return F.concat(head.cast("binary"), body, F.lit("\r\n\r\n").cast("binary"))


def layout(records: DataFrame, order: list[str], per_file: int = FILE_RECORDS) -> DataFrame:
    """``records`` (with a length) in files of ``per_file`` records: adds file, offset.

    Records are ordered by ``order``; the numbers come from ranges of rows, so no task sees them
    all. Equal rows are records of their own.
    """
    numbered = number_rows(records, [], order, "_number")
    inside = Window.partitionBy("file").orderBy("_number").rowsBetween(Window.unboundedPreceding, -1)
    return (
        numbered.withColumn("file", F.floor((F.col("_number") - 1) / per_file))
        .withColumn("offset", F.coalesce(F.sum("length").over(inside), F.lit(0).cast("bigint")))
        .drop("_number")
    )


def leaves(records: DataFrame) -> DataFrame:
    """(file, offset, print): one leaf per offset, from rows (file, offset, length, digest).

    Several records that claim one offset make one leaf, whatever their order.
    """
    one = F.concat_ws(":", F.col("length"), F.coalesce("digest", F.lit("")))
    grouped = records.where("file is not null and offset is not null").groupBy("file", "offset")
    several = F.concat_ws("|", F.count(one), F.min(one), F.max(one), F.bit_xor(F.xxhash64(one)))
    return grouped.agg(F.sha2(several, 256).alias("print"))


def _parents(nodes: DataFrame, place: Column) -> DataFrame:
    """One level up: a hash of the ordered prints below each place."""
    ordered = F.array_sort(F.collect_list(F.struct("at", "print")))
    text = F.concat_ws("|", F.transform(ordered, lambda x: F.concat_ws(":", x["at"], x["print"])))
    return nodes.groupBy("file", place.alias("up")).agg(F.sha2(text, 256).alias("print")).withColumnRenamed("up", "at")


def tree(records: DataFrame, levels: int, segment: int = SEGMENT_BYTES, fanout: int = FANOUT) -> list[DataFrame]:
    """Nodes (file, at, print) of each level: leaves at their offset, segments, ranges, roots.

    A node of a level lies at its offset divided by the level's range. A segment has at most as
    many leaves as bytes, a range ``fanout`` children.
    """
    made = [write_once(leaves(records).withColumnRenamed("offset", "at"), "leaves")]
    size = segment
    for _ in range(levels):
        made.append(write_once(_parents(made[-1], F.floor(F.col("at") / size)), "ranges"))
        size = fanout
    return made


def level_count(replicas: list[DataFrame], segment: int = SEGMENT_BYTES, fanout: int = FANOUT) -> int:
    """Levels above the leaves until one range covers the longest file of all replicas."""
    ends = [r.agg(F.max("offset")).first()[0] or 0 for r in replicas]
    levels, reach = 1, segment
    while reach <= max(ends):
        levels, reach = levels + 1, reach * fanout
    return levels


def audit(
    left: DataFrame, right: DataFrame, segment: int = SEGMENT_BYTES, fanout: int = FANOUT
) -> DataFrame:
    """(file, offset, fault) of every difference: damaged, missing or extra in ``right``.

    Both sides are (file, offset, length, digest) rows. Rows without a file or offset belong to
    no archive and are passed over; a null digest is a digest of its own. Equal replicas, empty
    ones too, give no rows.
    """
    levels = level_count([left, right], segment, fanout)
    trees = [tree(side, levels, segment, fanout) for side in (left, right)]
    suspects = None
    for level in range(levels, -1, -1):
        a, b = (t[level] for t in trees)
        if suspects is not None:
            size = segment if level == 0 else fanout
            parent = F.floor(F.col("at") / size)
            a, b = (
                n.withColumn("up", parent).join(suspects, ["file", "up"], "left_semi").drop("up") for n in (a, b)
            )
        pairs = a.join(b.withColumnRenamed("print", "other"), ["file", "at"], "full_outer")
        differ = pairs.where(~F.col("print").eqNullSafe(F.col("other")))
        if level:
            suspects = write_once(differ.select("file", F.col("at").alias("up")), "suspects")
    fault = F.when(F.col("other").isNull(), "missing").when(F.col("print").isNull(), "extra").otherwise("damaged")
    return differ.select("file", F.col("at").alias("offset"), fault.alias("fault"))


def audited(records: DataFrame, right: DataFrame) -> DataFrame:
    """``records`` (of the first replica) with their state: intact, damaged or missing."""
    faults = audit(records.select("file", "offset", "length", "digest"), right)
    return records.join(faults.where("fault <> 'extra'"), ["file", "offset"], "left").withColumn(
        "state", F.coalesce("fault", F.lit("intact"))
    ).drop("fault")
