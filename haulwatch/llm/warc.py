"""WARC records and their Merkle fixity audit: DataFrame functions only.

Pages are laid out as WARC/1.0 response records in archives of a bounded number of records. A record's leaf is the SHA-256 of
its offset range and its bytes; FANOUT consecutive nodes of an archive, in the order of their offsets, hash into one node of
the next level, up to one root. The levels are tables keyed by (archive, level, position), so that a node is one row and
building a level shuffles hashes only. Two replicas are compared at their roots; below a root that differs, only the children
of nodes that differ are read, level by level, down to the records.

Records of one archive are numbered by url, key and content. A null url is an empty one; a null page has an empty body. A
record that one replica lacks shows as missing; an archive that one lacks shows with all its records. An empty table has no
archives. Repeated pages are records of their own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from haulwatch.llm.storage import checkpointed

FANOUT = 16
RECORDS = 1024
DATE = "1970-01-01T00:00:00Z"


def to_records(pages: DataFrame, url: str = "url", body: str = "html", key: str = "page_id", records: int = RECORDS, date: str = DATE) -> DataFrame:
    """One row per page: archive, key, url, record (binary), size (its bytes), leaf (its SHA-256).

    Pages are dealt to archives by a digest of their key and url; an archive holds about as many as given."""
    n = max(1, -(-pages.count() // records))
    name = F.coalesce(pages[key].cast("string"), F.lit(""))
    # line ends would end the header early
    address = F.regexp_replace(F.coalesce(pages[url].cast("string"), F.lit("")), "[\\x00-\\x20\\x7F]", "%20")
    text = F.coalesce(pages[body], F.lit(""))
    crlf = "\r\n"
    header = F.concat(
        F.lit(f"WARC/1.0{crlf}WARC-Type: response{crlf}WARC-Target-URI: "), address,
        F.lit(f"{crlf}WARC-Date: {date}{crlf}WARC-Record-ID: <urn:key:"), F.sha2(F.concat_ws(" ", name, address), 256),
        F.lit(f">{crlf}Content-Type: text/html; charset=utf-8{crlf}Content-Length: "), F.octet_length(text).cast("string"), F.lit(crlf * 2),
    )
    dealt = F.conv(F.substring(F.sha2(F.concat_ws(" ", name, address), 256), 1, 8), 16, 10).cast("long") % n
    rows = pages.select(dealt.alias("archive"), pages[key].alias("key"), address.alias("url"), F.concat(header, text, F.lit(crlf * 2)).cast("binary").alias("record"))
    return rows.withColumns({"size": F.octet_length("record").cast("long"), "leaf": F.sha2("record", 256)})


def index(records: DataFrame) -> DataFrame:
    """Position and offsets (start, end) of each record within its archive, which is of a bounded size; record and size go."""
    order = Window.partitionBy("archive").orderBy("url", "key", "leaf")
    end = F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, 0))
    rows = records.drop("record").withColumns({"position": (F.row_number().over(order) - 1).cast("long"), "end": end})
    return rows.withColumn("start", F.col("end") - F.col("size")).drop("size")


def leaves(indexed: DataFrame, leaf: str = "leaf") -> DataFrame:
    """The tree's lowest level: a hash over the offset range and the record's hash."""
    digest = F.sha2(F.concat_ws(":", F.col("start").cast("string"), F.col("end").cast("string"), leaf), 256)
    return indexed.select("archive", F.lit(0).alias("level"), "position", digest.alias("hash"), "start", "end")


def level_above(nodes: DataFrame, fanout: int = FANOUT) -> DataFrame:
    """At most fanout nodes, in order, make one; it covers their offsets."""
    up = nodes.groupBy("archive", (F.col("level") + 1).alias("level"), F.floor(F.col("position") / fanout).alias("position"))
    children = F.array_sort(F.collect_list(F.struct(nodes["position"].alias("at"), "hash")))
    digest = F.sha2(F.array_join(F.transform(children, lambda c: c["hash"]), ""), 256)
    return up.agg(digest.alias("hash"), F.min("start").alias("start"), F.max("end").alias("end")).select("archive", "level", "position", "hash", "start", "end")


def height(indexed: DataFrame, fanout: int = FANOUT) -> int:
    """Levels above the leaves of the largest archive."""
    n, levels = 1 + (indexed.agg(F.max("position")).first()[0] or 0), 0
    while n > 1:
        n, levels = -(-n // fanout), levels + 1
    return levels


def merkle_levels(lowest: DataFrame, levels: int, fanout: int = FANOUT) -> list[DataFrame]:
    """The levels from the leaves to the roots, each written to the shared folder; trees of less height are carried up as
    single nodes."""
    tree = [lowest]
    for _ in range(levels):
        tree.append(checkpointed(level_above(tree[-1], fanout)))
    return tree


def audit(mine: list[DataFrame], other: list[DataFrame], fanout: int = FANOUT) -> DataFrame:
    """Records on which two replicas differ: archive, position, start, end (of mine, or of the other if mine lacks it) and
    status (corrupt, missing, added). Both trees have the same number of levels."""
    suspects = None
    for a, b in zip(reversed(mine), reversed(other), strict=True):
        if suspects is not None:  # only children of nodes that differ
            parent = F.floor(F.col("position") / fanout)
            a, b = (t.withColumn("parent", parent).join(suspects, ["archive", "parent"], "left_semi").drop("parent") for t in (a, b))
        a = a.select("archive", "position", "hash", "start", "end")
        b = b.select("archive", "position", F.col("hash").alias("other_hash"), F.col("start").alias("other_start"), F.col("end").alias("other_end"))
        differing = a.join(b, ["archive", "position"], "full").where(~F.col("hash").eqNullSafe(F.col("other_hash")))
        suspects = differing.select("archive", F.col("position").alias("parent"))
    status: Column = F.when(F.col("other_hash").isNull(), "missing").when(F.col("hash").isNull(), "added").otherwise("corrupt")
    return differing.select("archive", "position", F.coalesce("start", "other_start").alias("start"), F.coalesce("end", "other_end").alias("end"), status.alias("status"))
