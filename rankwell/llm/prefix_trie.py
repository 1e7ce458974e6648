"""Prefix trie of conversations with subtree totals, rolled up band by band.

A node is a distinct sequence of the first d turns (role, text). Its key is a 128-bit hash of that sequence, so a
conversation's path is one row (conversation, depth, key) per turn and the root; nodes are these rows grouped by key.

Subtree totals (depth-band rollup). The trie is cut into bands of ``band`` levels. Inside a band every node adds its own
values to its ancestors in this band, at most ``band`` of them, all bands at once. The band roots (depths that are a
multiple of ``band``) with these partial totals are again a tree, ``band`` times flatter, which is rolled up in the same
way; then each completed band root adds its total to its ancestors in the band above. So there are about
``2 * log(depth) / log(band)`` rounds, and no node is ever repeated more than ``band`` times a round.

Long and common conversations. Turns are sorted by (conversation, turn) over range partitions, which also split a single
conversation; positions and prefix hashes are running values in a partition, and what a conversation carries into the next
partition is at most one row per partition (Horner's rule lets it be added later). Nodes with very many members, children
or equal conversations are met by aggregates with partial sums; the root's and others' children get their parent's id
by a join that treats large parents apart. The ids of the conversations that end at a node are sorted over range partitions,
joined to strings of ``CHUNK`` ids and only these strings are hashed one after the other, as SHA-256 needs them.

Defined cases: a null turn comes first; turns of equal number are taken in the order of their hashes; null roles and texts
are empty; a row without a conversation id belongs to none and is dropped; repeated rows are turns of their own; empty tables
give an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankwell.llm.frames import attach, cut_lineage, read
from rankwell.llm.words import mix
from rankwell.operators.ordering import rank_within

BAND = 8
CHUNK = 1024
_U = np.uint64
_BASE = (0x9E3779B97F4A7C15, 0xD1342543DE82EF95)
_INVERSE = tuple(pow(b, -1, 2**64) for b in _BASE)
_DEPTH = (0xA0761D6478BD642F, 0xE7037ED1A0B428DB)
_LANES = 2
ROOT = bytes(16)


def _powers(base: int, exponents: np.ndarray) -> np.ndarray:
    """``base ** exponents`` modulo 2**64."""
    out = np.ones(len(exponents), dtype=np.uint64)
    left = exponents.astype(np.uint64)
    while left.any():
        out = np.where(left & _U(1), out * _U(base), out)
        base = base * base % 2**64
        left = left >> _U(1)
    return out


def turn_rows(rows: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    """conv, turn, two hashes of (role, text) and the text's bytes."""
    role = F.coalesce(F.col(role_col).cast("string"), F.lit(""))
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return rows.filter(F.col(conv_col).isNotNull()).select(
        F.col(conv_col).cast("long").alias("conv"), F.col(turn_col).cast("long").alias("turn"),
        F.xxhash64(F.lit(1), role, text).alias("t0"), F.xxhash64(F.lit(2), text, role).alias("t1"),
        F.octet_length(text).cast("long").alias("bytes"))


# --- paths: running positions and prefix hashes

def _prefixes(batches):
    """Rows (part, conv, t0, t1, bytes), sorted by conversation and position, with the conversation's rank in this
    partition and the prefix hashes of its turns in this partition."""
    carried: tuple[int, int, list[int]] | None = None  # conversation, rank and hashes of the row before
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        conv = batch.column(1).to_numpy()
        at = np.arange(n)
        new = np.concatenate(([True], conv[1:] != conv[:-1]))
        start = np.maximum.accumulate(np.where(new, at, 0))
        rank = at - start + 1
        goes_on = carried is not None and carried[0] == conv[0]
        first = start == 0
        hashes = []
        for lane in range(_LANES):
            t = batch.column(2 + lane).to_numpy().view(np.uint64)
            sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(t * _powers(_INVERSE[lane], at), dtype=np.uint64)))
            p = (sums[at + 1] - sums[start]) * _powers(_BASE[lane], at)
            if goes_on:
                p = np.where(first, p + _U(carried[2][lane]) * _powers(_BASE[lane], rank), p)
            hashes.append(p)
        if goes_on:
            rank = np.where(first, rank + carried[1], rank)
        carried = (int(conv[-1]), int(rank[-1]), [int(p[-1]) for p in hashes])
        yield pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array(rank.astype(np.int64)), *[pa.array(p.view(np.int64)) for p in hashes]],
            names=["part", "conv", "t0", "t1", "bytes", "rank", "p0", "p1"])


def _keys(depth: np.ndarray, hashes: list[np.ndarray]) -> pa.Array:
    """16 bytes per prefix; depth 0 is the root."""
    lanes = [np.where(depth == 0, _U(0), mix(p + depth.astype(np.uint64) * _U(_DEPTH[lane]))) for lane, p in enumerate(hashes)]
    both = np.ascontiguousarray(np.column_stack(lanes))
    return pa.Array.from_buffers(pa.binary(16), len(depth), [None, pa.py_buffer(both)]).cast(pa.binary())


def _path(carries: dict[int, tuple[int, int, list[int]]]):
    """The whole conversation's depth, key and parent key of each row; carries: by partition, what its first conversation brings along."""
    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            part, conv, rank = (batch.column(i).to_numpy() for i in (0, 1, 5))
            depth = rank.copy()
            now, before = [], []
            brought = [(carries[p], (part == p) & (conv == carries[p][0])) for p in np.unique(part).tolist() if p in carries]
            for lane in range(_LANES):
                p = batch.column(6 + lane).to_numpy().view(np.uint64).copy()
                for (_, _, hashes), rows in brought:
                    p[rows] += _U(hashes[lane]) * _powers(_BASE[lane], rank[rows])
                now.append(p)
                before.append((p - batch.column(2 + lane).to_numpy().view(np.uint64)) * _U(_INVERSE[lane]))
            for (_, earlier, _), rows in brought:
                depth[rows] += earlier
            yield pa.RecordBatch.from_arrays([batch.column(1), pa.array(depth), _keys(depth, now), _keys(depth - 1, before), batch.column(4)],
                                             names=["conv", "depth", "key", "parent", "bytes"])
    return run


def _carries(rows: DataFrame) -> dict[int, tuple[int, int, list[int]]]:
    """For the partitions that begin inside a conversation: the conversation, and its rank and hashes so far.

    At most one conversation goes on from a partition to the next, so these are at most two rows per partition."""
    spans = rows.groupBy("conv").agg(F.min("part").alias("low"), F.max("part").alias("high")).filter("low < high")
    pieces = rows.join(F.broadcast(spans.select("conv")), "conv").groupBy("conv", "part").agg(F.max(F.struct("rank", "p0", "p1")).alias("last"))
    out: dict[int, tuple[int, int, list[int]]] = {}
    conv, rank, hashes = None, 0, [0] * _LANES
    for r in sorted(pieces.collect(), key=lambda r: (r["conv"], r["part"])):
        if r["conv"] != conv:
            conv, rank, hashes = r["conv"], 0, [0] * _LANES
        else:
            out[r["part"]] = (conv, rank, list(hashes))
        ends = [r["last"]["p0"], r["last"]["p1"]]
        hashes = [(h * pow(b, r["last"]["rank"], 2**64) + (p % 2**64)) % 2**64 for h, b, p in zip(hashes, _BASE, ends)]
        rank += r["last"]["rank"]
    return out


def paths(turns: DataFrame, order: list[str]) -> DataFrame:
    """(conv, depth, key, parent, bytes) of every turn of ``turns`` (conv, t0, t1, bytes and the ``order`` columns)."""
    p = int(turns.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    dealt = turns.repartitionByRange(p, "conv", *order).sortWithinPartitions("conv", *order).select(
        F.spark_partition_id().cast("long").alias("part"), "conv", "t0", "t1", "bytes")
    running = cut_lineage(dealt.mapInArrow(_prefixes, "part long, conv long, t0 long, t1 long, bytes long, rank long, p0 long, p1 long"))
    return running.mapInArrow(_path(_carries(running)), "conv long, depth long, key binary, parent binary, bytes long")


# --- subtree totals

def _summed(df: DataFrame) -> DataFrame:
    return df.groupBy("key").agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))


def rollup(steps: DataFrame, own: DataFrame, band: int) -> DataFrame:
    """(key, leaves, saved) summed over each node's subtree.

    ``steps``: (conv, depth, key), every conversation's path. ``own``: (conv, depth, key, leaves, saved), each node once with a
    conversation that passes it."""
    level = F.floor(F.col("depth") / band).cast("long").alias("band")
    both = steps.select("conv", level, "depth", "key", F.lit(None).cast("long").alias("leaves"), F.lit(None).cast("long").alias("saved")).unionByName(
        own.select("conv", level, "depth", "key", "leaves", "saved"))
    # One conversation's rows of one band: at most ``band`` steps and as many nodes.
    pieces = both.groupBy("conv", "band").agg(F.collect_list(F.struct("depth", "key", "leaves", "saved")).alias("rows")).filter(
        F.exists("rows", lambda r: r["leaves"].isNotNull()))

    def below(step, name):
        return F.aggregate("rows", F.lit(0).cast("long"), lambda total, r: total + F.when(r["depth"] >= step["depth"], F.coalesce(r[name], F.lit(0))).otherwise(0))

    ancestors = F.transform(F.filter("rows", lambda r: r["leaves"].isNull()), lambda s: F.struct(
        s["key"].alias("key"), below(s, "leaves").alias("leaves"), below(s, "saved").alias("saved")))
    inside = cut_lineage(_summed(pieces.select(F.explode(ancestors).alias("a")).select("a.*")))
    if own.filter(F.col("depth") >= band).isEmpty():
        return inside
    tops = own.filter(F.col("depth") % band == 0).select("conv", F.floor(F.col("depth") / band).cast("long").alias("depth"), "key")
    tops = cut_lineage(tops.join(inside, "key").select("conv", "depth", "key", "leaves", "saved"))
    top_steps = steps.filter(F.col("depth") % band == 0).select("conv", F.floor(F.col("depth") / band).cast("long").alias("depth"), "key")
    complete = rollup(cut_lineage(top_steps), tops, band)
    down = tops.filter("depth > 0").select("conv", (F.col("depth") - 1).alias("band"), "key").join(complete, "key").drop("key")
    handed = steps.select("conv", level, "key").join(down, ["conv", "band"]).select("key", "leaves", "saved")
    return cut_lineage(_summed(inside.unionByName(handed)))


# --- conversations that end at a node

def _chunks(batches):
    """Rows (key, conv) sorted by both -> (key, first, ids joined by commas), at most CHUNK ids each."""
    def rows(out):
        return pa.RecordBatch.from_arrays([pa.array([x[0] for x in out], pa.binary()), pa.array([x[1] for x in out], pa.int64()),
                                           pa.array([",".join(map(str, x[2])) for x in out], pa.string())], names=["key", "first", "ids"])
    key, ids, out = None, [], []
    for batch in batches:
        for k, c in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if ids and (k != key or len(ids) == CHUNK):
                out.append((key, ids[0], ids))
                ids = []
                if len(out) == CHUNK:
                    yield rows(out)
                    out = []
            key = k
            ids.append(c)
    if ids:
        out.append((key, ids[0], ids))
    if out:
        yield rows(out)


def _digests(batches):
    """Rows (key, first, ids) sorted by both -> (key, SHA-256 of all ids joined by commas)."""
    key, state = None, None
    for batch in batches:
        keys, digests = [], []
        for k, ids in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist()):
            if state is not None and k == key:
                state.update(b"," + ids.encode())
                continue
            if state is not None:
                keys.append(key)
                digests.append(state.hexdigest())
            key, state = k, hashlib.sha256(ids.encode())
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(digests, pa.string())], names=["key", "digest"])
    if state is not None:
        yield pa.RecordBatch.from_arrays([pa.array([key], pa.binary()), pa.array([state.hexdigest()], pa.string())], names=["key", "digest"])


def end_digests(ends: DataFrame) -> DataFrame:
    """(key, digest) of ends (key, conv)."""
    p = int(ends.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    chunks = ends.repartitionByRange(p, "key", "conv").sortWithinPartitions("key", "conv").select("key", "conv").mapInArrow(
        _chunks, "key binary, first long, ids string")
    return chunks.repartition("key").sortWithinPartitions("key", "first").mapInArrow(_digests, "key binary, digest string")


# --- the operator

def prefix_trie(turns: DataFrame, order: list[str], convs: DataFrame, band: int = BAND) -> DataFrame:
    """The nodes of the trie of ``turns`` (conv, t0, t1, bytes, order columns); ``convs`` (conv) also names turnless ones."""
    root = convs.select("conv", F.lit(0).cast("long").alias("depth"), F.lit(ROOT).alias("key"), F.lit(None).cast("binary").alias("parent"), F.lit(0).cast("long").alias("bytes"))
    steps = cut_lineage(paths(turns, order).unionByName(root))
    nodes = cut_lineage(steps.groupBy("key").agg(F.min("conv").alias("conv"), F.count(F.lit(1)).alias("n_convs"), F.max("depth").alias("depth"),
                                                 F.max("parent").alias("parent"), F.max("bytes").alias("bytes")))
    children = cut_lineage(nodes.filter("parent is not null").groupBy(F.col("parent").alias("key")).agg(F.count(F.lit(1)).alias("n_children")))
    own = cut_lineage(nodes.join(children, "key", "left").select(
        "conv", "depth", "key", F.when(F.col("n_children").isNull(), 1).otherwise(0).cast("long").alias("leaves"),
        ((F.col("n_convs") - 1) * F.col("bytes")).alias("saved")))
    totals = rollup(steps.select("conv", "depth", "key"), own, band)
    last = steps.groupBy("conv").agg(F.max(F.struct("depth", "key")).alias("last")).select(F.col("last.key").alias("key"), "conv")
    digests = end_digests(last)
    parents = children.join(nodes.select("key", "conv"), "key").select(
        F.col("key").alias("parent"), F.col("conv").alias("parent_conv_id"), F.col("n_children").alias("rows_of_parent"))
    out = attach(nodes, cut_lineage(parents), "parent", "rows_of_parent", nodes.count())
    out = out.join(children, "key", "left").join(totals, "key").join(digests, "key", "left")
    return out.select(F.col("conv").alias("conv_id"), "depth", "parent_conv_id", "n_convs", F.coalesce("n_children", F.lit(0).cast("long")).alias("n_children"),
                      F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"),
                      F.coalesce("digest", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"))


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """((conv, source, position, ...), convs): the first h turns of conversation c - c % 5, then c's own turns after its first h."""
    ranked = cut_lineage(rank_within(turns, ["conv"], ["turn", "t0", "t1"], out="position").select(
        "conv", (F.col("position") - 1).alias("position"), "t0", "t1", "bytes"))
    h = (F.crc32(F.col("conv").cast("string")) % 9)
    convs = cut_lineage(ranked.select("conv").distinct())
    wanted = convs.select("conv", (F.col("conv") - F.col("conv") % 5).alias("base"), h.alias("h"))
    heads = ranked.filter("position < 8").select(F.col("conv").alias("base"), "position", "t0", "t1", "bytes")
    shared = wanted.join(heads, "base").filter("position < h").select("conv", F.lit(0).alias("source"), "position", "t0", "t1", "bytes")
    own = ranked.filter(F.col("position") >= h).select("conv", F.lit(1).alias("source"), "position", "t0", "t1", "bytes")
    return shared.unionByName(own), convs


def conversation_trie(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text",
                      band: int = BAND) -> DataFrame:
    """The prefix trie of conversations as they are."""
    turns = cut_lineage(turn_rows(rows, conv_col, turn_col, role_col, text_col))
    return prefix_trie(turns, ["turn", "t0", "t1"], turns.select("conv").distinct(), band)


def op13_prefix_trie(spark, sf_dir: str, band: int = BAND) -> DataFrame:
    turns, convs = rebuilt(cut_lineage(turn_rows(read(spark, sf_dir, "conversations"), "conv_id", "turn", "role", "text")))
    return prefix_trie(turns, ["source", "position"], convs, band)


ORACLE_SQL = """
WITH c AS MATERIALIZED (
  SELECT conv_id, list({'r': coalesce(role, ''), 'x': coalesce(text, '')} ORDER BY turn NULLS FIRST, role, text) AS ts FROM conversations
  WHERE conv_id IS NOT NULL GROUP BY conv_id),
h AS MATERIALIZED (
  SELECT conv_id, ts, xor(list_reduce(list_concat([4294967295::BIGINT], list_transform(string_split(conv_id::VARCHAR, ''), lambda z: ascii(z)::BIGINT)),
    lambda a, b: list_reduce(list_concat([xor(a, b)], [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]),
      lambda x, i: CASE WHEN x % 2 = 1 THEN xor(x >> 1, 3988292384::BIGINT) ELSE x >> 1 END)), 4294967295::BIGINT) % 9 AS h FROM c),
r AS MATERIALIZED (
  SELECT h.conv_id, list_concat(coalesce(list_slice(b.ts, 1, h.h), []), list_slice(h.ts, h.h + 1, len(h.ts))) AS ts
  FROM h LEFT JOIN c b ON b.conv_id = h.conv_id - h.conv_id % 5),
p AS MATERIALIZED (
  SELECT conv_id, d, list_slice(ts, 1, d) AS k, CASE WHEN d > 0 THEN strlen(ts[d].x) ELSE 0 END AS b, len(ts) = d AS ends
  FROM (SELECT conv_id, ts, unnest(range(0, len(ts) + 1)) AS d FROM r)),
n AS MATERIALIZED (
  SELECT d, k, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(b) AS b,
    sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE ends), '')) AS ends_sha256 FROM p GROUP BY d, k),
w AS MATERIALIZED (SELECT p.conv_id AS member, p.d, n.conv_id FROM p JOIN n ON n.d = p.d AND n.k = p.k),
u AS MATERIALIZED (
  SELECT n.conv_id, n.d, n.n_convs, n.b, n.ends_sha256, w.conv_id AS parent FROM n LEFT JOIN w ON w.member = n.conv_id AND w.d = n.d - 1),
kids AS MATERIALIZED (SELECT parent AS conv_id, d - 1 AS d, count(*) AS n_children FROM u WHERE d > 0 GROUP BY ALL),
v AS MATERIALIZED (SELECT u.*, coalesce(n_children, 0) AS n_children FROM u LEFT JOIN kids USING (conv_id, d)),
s AS MATERIALIZED (
  SELECT w.conv_id, w.d, sum(CASE WHEN v.n_children = 0 THEN 1 ELSE 0 END)::BIGINT AS n_leaves, sum((v.n_convs - 1) * v.b)::BIGINT AS saved_tokens
  FROM v JOIN w ON w.member = v.conv_id AND w.d <= v.d GROUP BY ALL)
SELECT v.conv_id, v.d AS depth, v.parent AS parent_conv_id, v.n_convs, v.n_children, s.n_leaves, s.saved_tokens, v.ends_sha256
FROM v JOIN s USING (conv_id, d)
"""
