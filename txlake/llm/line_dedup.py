"""Lines that many documents share, kept in one document only, by range-partitioned hashes, in DataFrame functions only.

A line's key is the line without the white space ``[\\x20\\x09-\\x0D]`` at both ends, A-Z lower-cased; lines end at
``\\n``. Keys of at least ``LEAST_CHARS`` code points that at least ``LEAST_DOCUMENTS`` documents hold lose their lines
everywhere but in the largest doc_id that holds them.

One scan writes 128-bit hashes of the keys with document and position; text goes nowhere. The hashes are
range-partitioned, sorted inside a partition by hash, document (largest first) and position, and streamed: the rows of
a key's first document are its first occurrences and stay, those behind go if the stream comes to a third document.
A key with more than ``1 / (SHARE * partitions)`` of all lines would make one range too long. Such keys, of which there
can be ``SHARE * partitions`` at most, are counted by partial sums instead; their documents' numbers and largest ids are
broadcast, and their rows are judged where they are.

The result for a document is a keep bitmap, compressed to its runs of kept lines; a document without one keeps all.

Defined cases: a null or empty text has one empty line; rows that repeat a doc_id are one document when documents of a
key are counted, and each keeps its own lines; rows without a doc_id count as one document, smaller than all others;
an empty table gives an empty result; extra columns are ignored by ``keep_bitmaps`` and ``digests`` and kept by
``without_shared_lines``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from txlake.session import scratch_path

from .common import width

LEAST_CHARS = 20
LEAST_DOCUMENTS = 3
SHARE = 16
#: Keys with fewer lines than this are never judged apart.
SMALL = 1_000
SPACE = " \t\n\x0b\x0c\r"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def lines_of(text: Column) -> Column:
    return F.split(F.coalesce(text.cast("string"), F.lit("")), "\n", -1)


def row_key(text: Column) -> Column:
    """Tells rows with the same doc_id apart; rows equal in both lose the same lines."""
    return F.xxhash64(text.cast("string"))


def keyed_lines(docs: DataFrame, least_chars: int = LEAST_CHARS) -> DataFrame:
    """doc_id, row, n_lines, at, h1, h2 for every line with a long enough key."""
    lines = lines_of(F.col("text"))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), row_key(F.col("text")).alias("row"), F.size(lines).alias("n_lines"), lines.alias("lines"))
    each = rows.select("doc_id", "row", "n_lines", F.posexplode("lines").alias("at", "line"))
    each = each.withColumn("key", F.btrim("line", F.lit(SPACE))).where(F.length("key") >= least_chars)
    plain = F.octet_length("key") == F.length("key")
    folded = F.when(plain, F.lower("key")).otherwise(F.translate("key", UPPER, UPPER.lower()))
    return each.select("doc_id", "row", "n_lines", "at", F.xxhash64(folded).alias("h1"), F.xxhash64(F.lit(1), folded).alias("h2"))


def crowded(lines: DataFrame, limit: int) -> DataFrame:
    """h1, h2 of the keys with more than ``limit`` lines."""
    return lines.groupBy("h1", "h2").count().where(F.col("count") > limit).select("h1", "h2")


def streamed(lines: DataFrame, least_documents: int) -> DataFrame:
    """The lines that go, by a stream over each range of hashes, sorted by document and position."""
    key = Window.partitionBy("h1", "h2")
    stream = key.orderBy(F.desc_nulls_last("doc_id"), "row", "at")
    first = F.row_number().over(stream) == 1
    same = F.lag("doc_id").over(stream).eqNullSafe(F.col("doc_id"))
    begins = lines.repartitionByRange("h1", "h2").withColumn("begins", F.when(first | ~same, 1).otherwise(0))
    begins = begins.withColumn("document", F.sum("begins").over(stream.rowsBetween(Window.unboundedPreceding, 0)))
    judged = begins.withColumn("documents", F.max("document").over(key))
    return judged.where((F.col("document") > 1) & (F.col("documents") >= least_documents)).select("doc_id", "row", "n_lines", "at")


def counted(lines: DataFrame, keys: DataFrame, least_documents: int) -> DataFrame:
    """The lines of ``keys`` that go, by partial counts; ``keys`` are at most ``SHARE * partitions``."""
    own = lines.join(F.broadcast(keys), ["h1", "h2"])
    facts = own.select("h1", "h2", "doc_id").distinct().groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("documents"), F.max("doc_id").alias("last"))
    facts = facts.where(F.col("documents") >= least_documents).select("h1", "h2", "last")
    return lines.join(F.broadcast(facts), ["h1", "h2"]).where(~F.col("doc_id").eqNullSafe(F.col("last"))).select("doc_id", "row", "n_lines", "at")


def keep_bitmaps(docs: DataFrame, least_chars: int = LEAST_CHARS, least_documents: int = LEAST_DOCUMENTS, small: int = SMALL) -> DataFrame:
    """doc_id, row, n_dropped, keep (array of struct<start, length>: the runs of kept lines) of documents that lose lines."""
    spark = docs.sparkSession
    path = scratch_path(spark, "lines")
    keyed_lines(docs, least_chars).write.parquet(path)
    lines = spark.read.parquet(path)
    limit = max(small, lines.count() // (SHARE * width(docs)))
    path = scratch_path(spark, "crowded")
    crowded(lines, limit).write.parquet(path)
    keys = spark.read.parquet(path)
    rest = lines.join(F.broadcast(keys), ["h1", "h2"], "left_anti")
    gone = streamed(rest, least_documents).unionByName(counted(lines, keys, least_documents))

    held = gone.groupBy("doc_id", "row").agg(F.sort_array(F.collect_set("at")).alias("gone"), F.max("n_lines").alias("n_lines"))
    starts = F.concat(F.array(F.lit(0)), F.transform("gone", lambda x: x + 1))
    runs = F.zip_with(starts, F.concat("gone", F.array("n_lines")), lambda a, b: F.struct(a.alias("start"), (b - a).alias("length")))
    return held.select("doc_id", "row", F.size("gone").cast("long").alias("n_dropped"), F.filter(runs, lambda r: r["length"] > 0).alias("keep"))


def kept_text(text: Column, keep: Column) -> Column:
    """The kept lines of ``text``, joined; the text is split once."""
    joined = F.transform(F.array(lines_of(text)), lambda lines: F.array_join(F.flatten(F.transform(keep, lambda r: F.slice(lines, r["start"] + 1, r["length"]))), "\n"))
    return F.when(keep.isNull(), F.coalesce(text.cast("string"), F.lit(""))).otherwise(joined[0])


def with_bitmaps(rows: DataFrame, bitmaps: DataFrame) -> DataFrame:
    """``rows`` with ``__n_dropped`` and ``__keep``, null for rows that keep all."""
    found = bitmaps.select(*[F.col(c).alias(f"__{c}") for c in ("doc_id", "row", "n_dropped", "keep")])
    on = F.col("doc_id").cast("long").eqNullSafe(F.col("__doc_id")) & (row_key(F.col("text")) == F.col("__row"))
    return rows.join(found, on, "left").drop("__doc_id", "__row")


def without_shared_lines(docs: DataFrame) -> DataFrame:
    """``docs`` with the kept lines as ``text``; documents that lose nothing stay as they are."""
    kept = F.when(F.col("__keep").isNull(), F.col("text")).otherwise(kept_text(F.col("text"), F.col("__keep")))
    return with_bitmaps(docs, keep_bitmaps(docs)).withColumn("text", kept).drop("__keep", "__n_dropped")


def digests(docs: DataFrame) -> DataFrame:
    """doc_id, n_lines (before dropping), n_dropped, kept_sha256 of every row."""
    joined = with_bitmaps(docs.select("doc_id", "text"), keep_bitmaps(docs))
    return joined.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.size(lines_of(F.col("text"))).cast("long").alias("n_lines"),
        F.coalesce("__n_dropped", F.lit(0)).cast("long").alias("n_dropped"),
        F.sha2(kept_text(F.col("text"), F.col("__keep")), 256).alias("kept_sha256"),
    )
