"""Removal of long word sequences that already occur in an earlier document (seed and extend).

Rule: a window is ``min_words`` consecutive words of one document. A word is removed when some window that
covers it has the same words as a window of a document with a smaller id. Windows are judged on the input.

Method. Every window contains a *seed*: the smallest hash among its ``SEED_WORDS``-word sequences
(winnowing). Consecutive windows with one seed form a *run*, on average half as many windows as there are
sequences in a window, so the seeds are a small, content-chosen part of all positions.

1. Join on seeds, whole extents first: a run is keyed by its seed and a 128-bit hash of all the words that
   its windows cover, i.e. the seed extended both ways as far as any window around it reaches. The smallest
   document of a key owns it; the windows of the same run anywhere else are repeats as a whole.
2. A seed with a single key needs no more work. Where one seed occurs in several extents, the match ends
   somewhere inside: the windows of the owned runs (one document for each distinct extent) are compared one
   by one, again by the smallest document that has the window.
3. The maximal repeats of a document are the unions of its overlapping repeated windows; their words go.

Every step is a ``min`` by key, combined before the shuffle, whose result ("you own this") goes back to the
one owning document. A passage that a third of all documents share therefore never meets in one task, and no
pairs of documents are formed. Documents travel compressed.

Defined cases: null text has no words; texts shorter than a window keep all; a null id is never "smaller",
and such a row keeps all its words; rows that repeat an id are one document with several texts, each
judged and returned; an empty table gives an empty result; other columns are ignored, or passed on by ``cut_repeats``.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankwell.llm import words as W
from rankwell.llm.frames import cut_lineage, map_batches, read

SEED_WORDS = 10


def _runs(hashes: np.ndarray, min_words: int):
    """Starts and ends (exclusive) of the runs of windows, their seeds and 128-bit extents."""
    k = min(SEED_WORDS, min_words)
    one = W.Spans(hashes, 1)
    seed = W.sliding_min(one.windows(k), min_words - k + 1)
    cut = np.flatnonzero(seed[1:] != seed[:-1]) + 1
    start = np.concatenate(([0], cut))
    end = np.concatenate((cut, [len(seed)]))
    two = W.Spans(hashes, 2)
    last = end + (min_words - 1)
    return start, end, seed[start], one.hash(start, last), two.hash(start, last), one, two


def _long(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


def _seeds(min_words: int):
    def emit(batch: pa.RecordBatch):
        docs, out = [], []
        for doc, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if data is None or len(data) < 2 * min_words - 1:
                continue
            hashes = W.word_hashes(data)
            if len(hashes) < min_words:
                continue
            _, _, seed, f1, f2, _, _ = _runs(hashes, min_words)
            key = np.stack((f1, f2, seed))
            docs.append(np.full(key.shape[1], doc, dtype=np.int64))
            out.append(key)
        if out:
            doc, key = np.concatenate(docs), np.concatenate(out, axis=1)
            yield pa.RecordBatch.from_arrays([pa.array(doc), _long(key[2]), _long(key[0]), _long(key[1])],
                                             names=["doc", "seed", "f1", "f2"])
    return emit


def _pack(batch: pa.RecordBatch):
    z = zstandard.ZstdCompressor(level=1)
    packed = [None if t is None else z.compress(t) for t in batch.column(1).to_pylist()]
    yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(packed, pa.binary()), batch.column(2)], names=["doc", "packed", "tag"])


def _member(x: np.ndarray, values: list | None) -> np.ndarray:
    if not values:
        return np.zeros(len(x), dtype=bool)
    return np.isin(x.view(np.int64), np.array(values, dtype=np.int64))


def _extend(min_words: int):
    """With a document's claims: its repeated windows so far, and the windows that need a comparison."""
    def emit(batch: pa.RecordBatch):
        z = zstandard.ZstdDecompressor()
        rows = []
        for doc, packed, tag, owned, single in zip(*(c.to_pylist() for c in batch.columns)):
            if packed is None:
                continue
            hashes = W.word_hashes(z.decompress(packed))
            if len(hashes) < min_words:
                continue
            start, end, _, f1, _, one, two = _runs(hashes, min_words)
            mine = _member(f1, owned)
            open_ = mine & ~_member(f1, single)
            if mine.all() and not open_.any():
                continue
            repeated = np.stack((start[~mine], end[~mine]), axis=1).ravel()
            at = np.concatenate([np.arange(a, b) for a, b in zip(start[open_], end[open_])] or [np.zeros(0, np.int64)])
            w1, w2 = one.hash(at, at + min_words), two.hash(at, at + min_words)
            rows.append((doc, tag, repeated.astype(np.int32), at.astype(np.int32), w1.view(np.int64), w2.view(np.int64)))
        if rows:
            cols = list(zip(*rows))
            yield pa.RecordBatch.from_arrays(
                [pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.list_(pa.int32())),
                 pa.array(cols[3], pa.list_(pa.int32())), pa.array(cols[4], pa.list_(pa.int64())), pa.array(cols[5], pa.list_(pa.int64()))],
                names=["doc", "tag", "repeated", "at", "w1", "w2"])
    return emit


def _merge(min_words: int):
    """The word ranges [start, end) that go: the unions of the repeated windows."""
    def emit(batch: pa.RecordBatch):
        out = []
        for doc, tag, repeated, at, w1, kept in zip(*(c.to_pylist() for c in batch.columns)):
            r = np.array(repeated, dtype=np.int64).reshape(-1, 2)
            at = np.array(at, dtype=np.int64)
            at = at[~_member(np.array(w1, dtype=np.int64), kept)]
            lo = np.concatenate((r[:, 0], at))
            hi = np.concatenate((r[:, 1] - 1, at)) + min_words
            if not len(lo):
                continue
            order = np.argsort(lo, kind="stable")
            lo, hi = lo[order], np.maximum.accumulate(hi[order])
            first = np.concatenate(([True], lo[1:] > hi[:-1]))
            ends = np.concatenate((hi[:-1][first[1:]], hi[-1:]))
            out.append((doc, tag, np.stack((lo[first], ends), axis=1).ravel().astype(np.int32)))
        if out:
            cols = list(zip(*out))
            yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.list_(pa.int32()))],
                                             names=["doc", "tag", "ranges"])
    return emit


def repeat_ranges(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = 50) -> DataFrame:
    """(doc, tag, ranges): for each document with repeats, the word ranges that go, flattened [s0, e0, s1, e1, ...].

    ``tag`` is the hash of the text, which tells rows that repeat an id apart.
    """
    data = F.col(text_col).cast("binary")
    base = docs.select(F.col(id_col).cast("long").alias("doc"), data.alias("data"), F.xxhash64(data).alias("tag")).filter(
        F.col("doc").isNotNull())
    runs = map_batches(base, _seeds(min_words), "doc long, seed long, f1 long, f2 long")
    owners = runs.groupBy("seed", "f1", "f2").agg(F.min("doc").alias("doc"))
    # A seed with one extent: the owner keeps the run whole. (min and max say so without a list.)
    single = owners.groupBy("seed").agg(F.count(F.lit(1)).alias("n"), F.min("doc").alias("doc"), F.min("f1").alias("f1")).filter("n = 1")
    claims = owners.select("doc", "f1", F.lit(0).alias("kind")).unionByName(single.select("doc", "f1", F.lit(1).alias("kind")))
    claims = claims.groupBy("doc").agg(F.collect_list(F.when(F.col("kind") == 0, F.col("f1"))).alias("owned"),
                                       F.collect_list(F.when(F.col("kind") == 1, F.col("f1"))).alias("single"))
    packed = map_batches(base, _pack, "doc long, packed binary, tag long")
    state = cut_lineage(map_batches(packed.join(claims, "doc", "left"), _extend(min_words),
                                    "doc long, tag long, repeated array<int>, at array<int>, w1 array<long>, w2 array<long>"))
    windows = state.select("doc", F.explode(F.arrays_zip("w1", "w2")).alias("w")).select("doc", "w.w1", "w.w2")
    kept = windows.groupBy("w1", "w2").agg(F.min("doc").alias("doc")).groupBy("doc").agg(F.collect_list("w1").alias("kept"))
    ranges = map_batches(state.select("doc", "tag", "repeated", "at", "w1").join(kept, "doc", "left"), _merge(min_words),
                         "doc long, tag long, ranges array<int>")
    return ranges.dropDuplicates(["doc", "tag"])


def _cut(text_at: int, ranges_at: int, joined: bool):
    """Replaces the text column: words joined by one space, or the original text without the ranges."""
    def emit(batch: pa.RecordBatch):
        texts, sizes, gone = [], [], []
        for data, ranges in zip(batch.column(text_at).to_pylist(), batch.column(ranges_at).to_pylist()):
            if data is None:
                texts.append(None if not joined else b"")
                sizes.append(0)
                gone.append(0)
                continue
            pieces = list(zip(ranges[0::2], ranges[1::2])) if ranges else []
            if joined:
                words = data.split()
                sizes.append(len(words))
                for a, b in reversed(pieces):
                    del words[a:b]
                texts.append(b" ".join(words))
            else:
                start, _ = W.bounds(data)
                sizes.append(len(start))
                offset = np.concatenate((start, [len(data)]))
                kept, at = [], 0
                for a, b in pieces:
                    kept.append(data[at:offset[a]])
                    at = offset[b]
                texts.append(b"".join([*kept, data[at:]]) if pieces else data)
            gone.append(sum(b - a for a, b in pieces))
        columns = [c for i, c in enumerate(batch.columns) if i not in (text_at, ranges_at)]
        names = [c for i, c in enumerate(batch.schema.names) if i not in (text_at, ranges_at)]
        yield pa.RecordBatch.from_arrays([*columns, pa.array(texts, pa.binary()), batch.column(ranges_at), pa.array(sizes, pa.int64()),
                                          pa.array(gone, pa.int64())], names=[*names, "__text", "__ranges", "__words", "__removed"])
    return emit


def _with_ranges(docs: DataFrame, columns: list[str], id_col: str, text_col: str, min_words: int, joined: bool) -> DataFrame:
    ranges = repeat_ranges(docs, id_col, text_col, min_words)
    # The frame's columns are the caller's, then __doc, __tag and __data; the caller's are only passed on by place.
    names = [f"c{i}" for i in range(len(columns))]
    data = F.col(text_col).cast("binary")
    frame = docs.select(*[F.col(c).alias(n) for c, n in zip(columns, names)], F.col(id_col).cast("long").alias("__doc"), F.xxhash64(data).alias("__tag"),
                        data.alias("__data"))
    ranges = ranges.select(F.col("doc").alias("__doc"), F.col("tag").alias("__tag"), F.col("ranges").alias("__ranges"))
    frame = frame.join(ranges, ["__doc", "__tag"], "left").select(*names, "__data", "__ranges")
    fields = ", ".join(f"{n} {docs.schema[c].dataType.simpleString()}" for c, n in zip(columns, names))
    return map_batches(frame, _cut(len(columns), len(columns) + 1, joined),
                       f"{fields}, __text binary, __ranges array<int>, __words long, __removed long")


def substring_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = 50) -> DataFrame:
    """Per row of ``docs``: doc_id, n_words, n_removed, kept_text (kept words joined by one space) and
    removed (word ranges as an array of [start, end) structs)."""
    out = _with_ranges(docs.select(id_col, text_col), [id_col], id_col, text_col, min_words, True)
    r = F.coalesce(F.col("__ranges"), F.array().cast("array<int>"))
    pairs = F.transform(F.sequence(F.lit(0), (F.size(r) / 2).cast("int") - 1),
                        lambda i: F.struct(F.get(r, 2 * i).alias("start"), F.get(r, 2 * i + 1).alias("end")))
    return out.select(F.col("c0").alias("doc_id"), F.col("__words").alias("n_words"), F.col("__removed").alias("n_removed"),
                      F.col("__text").cast("string").alias("kept_text"),
                      F.when(F.size(r) > 0, pairs).otherwise(F.array().cast("array<struct<start:int,end:int>>")).alias("removed"))


def cut_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = 50) -> DataFrame:
    """``docs`` with the repeats cut out of the text (its other white space stays) and all other columns as they are."""
    others = [c for c in docs.columns if c != text_col]
    out = _with_ranges(docs, others, id_col, text_col, min_words, False)
    at = {c: F.col(f"c{i}") for i, c in enumerate(others)} | {text_col: F.col("__text").cast("string")}
    return out.select(*[at[c].alias(c) for c in docs.columns])


def op1_substring_dedup(spark, sf_dir: str) -> DataFrame:
    out = substring_dedup(read(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))


ORACLE_SQL = """
WITH w AS MATERIALIZED (
  SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS ws FROM documents),
hashed AS MATERIALIZED (
  SELECT doc_id, list_transform(range(1, len(ws) - 48), lambda i: hash(list_slice(ws, i, i + 49))) AS hs FROM w WHERE len(ws) >= 50),
win AS MATERIALIZED (SELECT doc_id, unnest(hs) AS h, unnest(range(1, len(hs) + 1)) AS i FROM hashed),
owner AS MATERIALIZED (SELECT h, min(doc_id) AS first_doc FROM win GROUP BY h),
gone AS MATERIALIZED (
  SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS pos FROM (SELECT win.doc_id, win.i FROM win JOIN owner ON win.h = owner.h WHERE first_doc < doc_id)),
word AS MATERIALIZED (SELECT doc_id, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS pos FROM w WHERE len(ws) > 0),
kept AS MATERIALIZED (
  SELECT word.doc_id, string_agg(word.word, ' ' ORDER BY word.pos) AS text, count(*) AS n
  FROM word LEFT JOIN gone ON gone.doc_id = word.doc_id AND gone.pos = word.pos WHERE gone.pos IS NULL GROUP BY word.doc_id)
SELECT w.doc_id, len(ws) AS n_words, len(ws) - coalesce(kept.n, 0) AS n_removed, sha256(coalesce(kept.text, '')) AS kept_sha256
FROM w LEFT JOIN kept ON kept.doc_id = w.doc_id
"""
