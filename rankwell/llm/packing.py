"""Conflict-constrained best-fit packing of documents into bins of a fixed number of words.

A document longer than a bin is cut into full pieces, each a bin of its own, and a rest. The rests and the
shorter documents are packed by decreasing size: the open bins are ordered by what is left in them, the
search starts at the smallest residual that holds the item and goes on to the next larger ones until the
bin is compatible; if none is, a new bin opens. A bin carries a bitmap of the sources and one of the
duplicate clusters in it, and takes neither a second document of a source nor a second copy of a cluster.

At scale: items are dealt at random into shards of about ``SHARD_ITEMS``; bins belong to one shard, so the
constraint is local, a source with a third of all rows is a third of every shard and no task depends on a
key. Bitmaps number a shard's own sources and repeated clusters, so they are exact and small. Only sizes
and keys are shuffled, never texts; ``bin_texts`` gathers the texts where they are wanted.

Every word of every document is in exactly one piece. Defined cases: null and empty texts and texts without
words get one row with length 0 and no bin; a null source conflicts with nothing; null ids and repeated
rows are packed row by row (copies of a row are a cluster, so they share no bin); an empty table gives an
empty result; other columns are ignored.
"""

from __future__ import annotations

from bisect import bisect_left, insort

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankwell.llm.frames import cut_lineage, fresh, read
from rankwell.llm.quality_rules import words_of

CAPACITY = 2048
SHARD_ITEMS = 8192


def best_fit(sizes: list[int], sources: list, clusters: list, capacity: int) -> list[int]:
    """The bin of each item; items come by decreasing size."""
    source_bit: dict = {}
    seen: set = set()
    repeated = {c for c in clusters if c in seen or seen.add(c)}
    cluster_bit: dict = {}
    left: list[tuple[int, int]] = []  # (residual, bin), ordered
    in_source: list[int] = []
    in_cluster: list[int] = []
    out = []
    for size, source, cluster in zip(sizes, sources, clusters):
        s = 0 if source is None else 1 << source_bit.setdefault(source, len(source_bit))
        c = 1 << cluster_bit.setdefault(cluster, len(cluster_bit)) if cluster in repeated else 0
        at = bisect_left(left, (size, -1))
        while at < len(left) and (in_source[left[at][1]] & s or in_cluster[left[at][1]] & c):
            at += 1
        if at < len(left):
            residual, found = left.pop(at)
        else:
            residual, found = capacity, len(in_source)
            in_source.append(0)
            in_cluster.append(0)
        in_source[found] |= s
        in_cluster[found] |= c
        if residual > size:
            insort(left, (residual - size, found))
        out.append(found)
    return out


def _pack(capacity: int):
    names = ["doc_id", "piece", "start", "length", "bin_id"]

    def shard_rows(rows: list[tuple]) -> pa.RecordBatch:
        """rows: (shard, size, doc_id, row, words, source, cluster)"""
        base = rows[0][0] << 32
        bins = best_fit([r[1] for r in rows if r[1]], [r[5] for r in rows if r[1]], [r[6] for r in rows if r[1]], capacity)
        opened = max(bins, default=-1) + 1
        taken = iter(bins)
        out = []
        for _, size, doc, _, words, _, _ in rows:
            full = words // capacity
            for piece in range(full):
                out.append((doc, piece, piece * capacity, capacity, base + opened))
                opened += 1
            if size:
                out.append((doc, full, full * capacity, size, base + next(taken)))
            elif not words:
                out.append((doc, 0, 0, 0, None))
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], names=names)

    def run(batches):
        rows: list[tuple] = []
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if rows and row[0] != rows[0][0]:
                    yield shard_rows(rows)
                    rows = []
                rows.append(row)
        if rows:
            yield shard_rows(rows)
    return run


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str | None = "source",
         cluster_col: str | None = None, capacity: int = CAPACITY, shard_items: int = SHARD_ITEMS) -> DataFrame:
    """One row per piece: doc_id, piece, start, length (words) and bin_id.

    Without ``cluster_col`` a cluster is the texts with equal words, A-Z lower-cased.
    """
    words = fresh(docs, "words")
    cluster = F.col(cluster_col).cast("string") if cluster_col else F.md5(F.lower(F.array_join(words, " ")).cast("binary"))
    source = F.col(source_col).cast("string") if source_col else F.lit(None).cast("string")
    items = cut_lineage(docs.withColumn(words, words_of(F.coalesce(F.col(text_col), F.lit("")))).select(
        F.col(id_col).cast("long").alias("doc_id"), F.size(words).cast("long").alias("n_words"), source.alias("source"), cluster.alias("cluster")))
    shards = max(1, -(-items.count() // shard_items))
    size = F.col("n_words") % capacity
    dealt = items.withColumn("row", F.monotonically_increasing_id()).select(
        F.pmod(F.xxhash64("row"), F.lit(shards)).alias("shard"), size.alias("size"), "doc_id", "row", "n_words", "source", "cluster")
    return (dealt.repartition(shards, "shard").sortWithinPartitions("shard", F.desc("size"), "doc_id", "row")
            .mapInArrow(_pack(capacity), "doc_id long, piece long, start long, length long, bin_id long"))


def bin_texts(docs: DataFrame, packed: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """bin_id, n_words and text (its pieces joined by an empty line) of every bin; ids must be unique."""
    words = words_of(F.coalesce(F.col(text_col), F.lit("")))
    pieces = packed.filter("bin_id is not null").join(docs.select(F.col(id_col).alias("doc_id"), words.alias("words")), "doc_id").select(
        "bin_id", "doc_id", "length", F.array_join(F.slice("words", F.col("start") + 1, F.col("length")), " ").alias("text"))
    return pieces.groupBy("bin_id").agg(F.sum("length").alias("n_words"), F.array_sort(F.collect_list(F.struct("doc_id", "text"))).alias("p")).select(
        "bin_id", "n_words", F.array_join(F.transform("p", lambda x: x["text"]), "\n\n").alias("text"))


def op8_packing(spark, sf_dir: str) -> DataFrame:
    return pack(read(spark, sf_dir, "documents"))
