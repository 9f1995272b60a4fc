"""WARC fixity audit of two replicas with Merkle trees over ordered offset ranges.

A replica is a table of records in files of a bounded number of records. Each
replica is read, hashed and laid out by itself: a leaf is the SHA-256 of a
record, and a node covers a range of ``FANOUT`` consecutive children and hashes
their offsets, lengths and hashes in order; the root covers the file. Offsets in
a node count from where its range begins, so a record that grew or shrank costs
one path to the root and not all that lies behind it. Replicas agree where their
roots agree. Where they differ, only children of mismatching nodes are compared,
level by level, down to the records.

All of it is DataFrame operations: hashes are taken next to the scan, and only
(file, slot, hash) rows are shuffled by an audit, never record bytes. Groups are
bounded by the fan-out and the records of a file.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.stage import Scratch, ranked

FANOUT = 16
FILE_RECORDS = 256


def with_record(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """(page_id, url, record): a WARC resource record of each page. Null fields count as empty."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    record = F.concat(
        F.lit("WARC/1.0\r\nWARC-Type: resource\r\nWARC-Date: 1970-01-01T00:00:00Z\r\nWARC-Target-URI: "), text(url),
        F.lit("\r\nWARC-Record-ID: <urn:page:"), text(page_id),
        F.lit(">\r\nContent-Type: text/html\r\nContent-Length: "), F.octet_length(text(html)).cast("string"),
        F.lit("\r\n\r\n"), text(html), F.lit("\r\n\r\n"))
    return pages.select(F.col(page_id).alias("page_id"), F.col(url).alias("url"), record.alias("record"))


def sha(c):
    return F.sha2(F.col(c).cast("binary") if isinstance(c, str) else c.cast("binary"), 256)


def archive(pages: DataFrame, scratch: Scratch, file_records: int = FILE_RECORDS) -> DataFrame:
    """Write every page as a record, in files of ``file_records`` in the order of (page_id, url,
    SHA-256 of the record): (file, place, page_id, record). Read back from the written table."""
    records = with_record(pages).withColumn("_sha", sha("record"))
    order = [F.col("page_id").asc_nulls_first(), F.col("url").asc_nulls_first(), F.col("_sha")]
    return ranked(records, order, scratch, "archive", compression="zstd").select(
        F.floor(F.col("_rank") / file_records).alias("file"), F.pmod("_rank", F.lit(file_records)).alias("place"), "page_id", "record")


#: A record that a damaged replica has too much.
STRAY = "WARC/1.0\r\nWARC-Type: metadata\r\nContent-Length: 0\r\n\r\n\r\n\r\n"


def damaged_copy(replica: DataFrame) -> DataFrame:
    """What a second replica may hold, by a fixed rule on page_id, so that an audit has something to
    find: of 200 records one has another first byte, one lost its last byte, one is gone, and one is
    followed by a record that the first replica hasn't."""
    k = F.pmod(F.crc32(F.coalesce(F.col("page_id").cast("string"), F.lit("")).cast("binary")), F.lit(200))
    held = (F.when(k == 0, F.array(F.expr("concat('X', substring(record, 2))"))).when(k == 1, F.array(F.expr("left(record, length(record) - 1)")))
            .when(k == 2, F.array().cast("array<string>")).when(k == 3, F.array(F.col("record"), F.lit(STRAY))).otherwise(F.array("record")))
    return replica.select("file", "place", "page_id", F.posexplode(held).alias("_n", "record")).select(
        "file", (2 * F.col("place") + F.col("_n")).alias("place"), "page_id", "record")


def index(replica: DataFrame, side: str) -> DataFrame:
    """(side, file, slot, page_id, offset, length, hash) of a replica's records; offset counts the bytes
    before a record in its file, in the order of (place, page_id, hash)."""
    leaves = replica.where(F.col("record").isNotNull()).select(
        "file", "place", "page_id", F.octet_length("record").cast("long").alias("length"), sha("record").alias("hash"))
    in_file = Window.partitionBy("file").orderBy("place", F.col("page_id").asc_nulls_first(), "hash")
    return leaves.select(
        F.lit(side).alias("side"), "file", (F.row_number().over(in_file) - 1).cast("long").alias("slot"), "page_id",
        F.coalesce(F.sum("length").over(in_file.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("offset"), "length", "hash")


def trees(leaves: DataFrame, scratch: Scratch, file_records: int = FILE_RECORDS, fanout: int = FANOUT) -> list[DataFrame]:
    """Levels of the trees of both sides, leaves first, each written once: (side, file, node, start, length,
    hash). The last level has one node per file, also where a replica has more records than planned."""
    level = leaves.select("side", "file", F.col("slot").alias("node"), F.col("offset").alias("start"), "length", "hash")
    out, width = [level], file_records
    while width > 1 or len(out) == 1:
        width = -(-width // fanout)
        parent = F.lit(0).cast("long") if width == 1 else F.floor(F.col("node") / fanout)
        text = F.concat_ws(",", F.transform("kids", lambda k: F.concat_ws(
            ":", (k["start"] - F.col("first")).cast("string"), k["length"].cast("string"), k["hash"])))
        level = scratch.save(
            level.groupBy("side", "file", parent.alias("parent"))
            .agg(F.min("start").alias("first"), F.sum("length").alias("bytes"),
                 F.array_sort(F.collect_list(F.struct("node", "start", "length", "hash"))).alias("kids"))
            .select("side", "file", F.col("parent").alias("node"), F.col("first").alias("start"), F.col("bytes").alias("length"),
                    sha(text).alias("hash")), "nodes")
        out.append(level)
    return out


def compared(levels: list[DataFrame], fanout: int = FANOUT) -> list[DataFrame]:
    """Nodes compared at each level from the root down: (file, node, hash_a, hash_b, bad). Below the root they
    are nothing but children of nodes that mismatch one level above."""
    found: list[DataFrame] = []
    for depth, level in enumerate(reversed(levels)):
        if found:
            parents = found[-1].where("bad").select(F.col("file").alias("pf"), F.col("node").alias("pn"))
            parent = F.lit(0) if depth == 1 else F.floor(F.col("node") / fanout)
            level = level.join(parents, (F.col("file") == F.col("pf")) & (parent == F.col("pn")), "left_semi")
        of = lambda side: F.max(F.when(F.col("side") == side, F.col("hash")))
        found.append(level.groupBy("file", "node").agg(of("a").alias("hash_a"), of("b").alias("hash_b"))
                     .withColumn("bad", ~F.col("hash_a").eqNullSafe(F.col("hash_b"))))
    return found


def located(leaves: DataFrame, bad: DataFrame) -> DataFrame:
    """(file, offset, page_id, kind) of the records at mismatching leaves. A file's records of one page_id are
    paired in order: of a pair, equal hashes are ``moved`` and others ``changed``; without a partner a record
    is ``missing`` (offset in the first replica) or ``added`` (offset in the second)."""
    where = bad.select(F.col("file").alias("bf"), F.col("node").alias("bn"))
    nth = F.row_number().over(Window.partitionBy("side", "file", "page_id").orderBy("slot"))
    at = leaves.join(where, (F.col("file") == F.col("bf")) & (F.col("slot") == F.col("bn")), "left_semi").withColumn("nth", nth)
    of = lambda side, c: F.max(F.when(F.col("side") == side, F.col(c)))
    pairs = at.groupBy("file", "page_id", "nth").agg(of("a", "hash").alias("ha"), of("b", "hash").alias("hb"),
                                                     of("a", "offset").alias("oa"), of("b", "offset").alias("ob"))
    kind = (F.when(F.col("hb").isNull(), "missing").when(F.col("ha").isNull(), "added")
            .when(F.col("ha") == F.col("hb"), "moved").otherwise("changed"))
    return pairs.select("file", F.coalesce("oa", "ob").alias("offset"), "page_id", kind.alias("kind"))


def audit(first: DataFrame, second: DataFrame, file_records: int = FILE_RECORDS, fanout: int = FANOUT) -> DataFrame:
    """One row per file of either replica: file, n_records and n_bytes of the first, n_records_b and n_bytes_b of
    the second, root_a, root_b, n_compared (nodes compared on the descent), n_damaged, n_moved and damaged
    (``offset:kind`` of each missing, added or changed record, by offset).

    A replica has rows (file, place, page_id, record), ``place`` giving the order in a file; other columns are
    ignored, whatever their names. A null record is a lost one. A file that one replica lacks has a null root
    there and 0 records. Null or repeated page_ids are paired in order. Rows of equal place are put in order
    of page_id (null first) and hash, and equal rows are records of their own. Empty texts are records of no
    bytes; records may be as long as a string of Spark can be and are hashed where they are read. Two empty
    replicas give no rows. A record that moved in bytes alone, with its neighbours, isn't counted as moved; one
    that also has another number in its file is.
    """
    scratch = Scratch(first.sparkSession, "warc")
    leaves = scratch.save(index(first, "a").unionByName(index(second, "b")), "leaves")
    levels = trees(leaves, scratch, file_records, fanout)
    seen = [scratch.save(x, "compared") if i else x for i, x in enumerate(compared(levels, fanout))]
    work = seen[0].select("file")
    for x in seen[1:]:
        work = work.union(x.select("file"))
    work = work.groupBy("file").agg(F.count("*").alias("n_compared"))
    hurt = F.col("kind") != "moved"
    found = located(leaves, seen[-1].where("bad")).groupBy("file").agg(
        F.count_if(hurt).alias("n_damaged"), F.count_if(~hurt).alias("n_moved"),
        F.concat_ws(",", F.transform(F.array_sort(F.collect_list(F.when(hurt, F.struct("offset", "kind")))),
                                     lambda x: F.concat_ws(":", x["offset"].cast("string"), x["kind"]))).alias("damaged"))
    side = lambda s, c, out: F.coalesce(c(F.when(F.col("side") == s, F.col("length"))), F.lit(0)).alias(out)
    files = leaves.groupBy("file").agg(side("a", F.count, "n_records"), side("a", F.sum, "n_bytes"),
                                       side("b", F.count, "n_records_b"), side("b", F.sum, "n_bytes_b"))
    return (files.join(seen[0].select("file", F.col("hash_a").alias("root_a"), F.col("hash_b").alias("root_b")), "file")
            .join(work, "file").join(found, "file", "left")
            .select("file", "n_records", "n_bytes", "n_records_b", "n_bytes_b", "root_a", "root_b", "n_compared",
                    F.coalesce("n_damaged", F.lit(0)).alias("n_damaged"), F.coalesce("n_moved", F.lit(0)).alias("n_moved"),
                    F.coalesce("damaged", F.lit("")).alias("damaged")))


def fixity_audit(pages: DataFrame, second=damaged_copy) -> DataFrame:
    """Write all pages as an archive, write a second replica as ``second`` makes it of the first, read both back
    and audit one against the other. Null page_ids, urls and htmls count as empty in a record; extra columns of
    ``pages`` are ignored; an empty table gives no rows."""
    scratch = Scratch(pages.sparkSession, "warc")
    replica = archive(pages, scratch)
    return audit(replica, scratch.save(second(replica), "replica", compression="zstd"))
