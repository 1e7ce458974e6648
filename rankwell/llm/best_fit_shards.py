"""Best-fit-decreasing bin packing of indivisible groups into shards.

Documents with equal texts are a group and stay together. A document's size is its UTF-8 bytes plus 1. Groups enter
by decreasing size; each goes to the shard with the tightest remaining capacity that holds it, found as the successor
of the group's size in a balanced tree of remaining capacities.

At scale no task sees all groups, and yet the shards come out as if one had packed them:

* A group larger than an even share of what is left gets a shard of its own; the others share the rest evenly.
* Groups of more than 1/FINE of a shard (at most ``shards * FINE`` of them, because their sizes add up to the total)
  are packed first, in one task.
* The smaller groups are dealt by their hash into cells of about ``CELL`` groups. A cell has its part of every
  shard's remaining capacity and packs its groups into that. Capacity and groups of a cell have the same total, and
  a group that fits nowhere is larger than any remaining capacity, so fewer than ``shards`` groups of a cell
  are left over. These and the remaining capacities go to the next level, where FAN cells are one, until one cell is
  left; its last groups go to the shards with most room. Shards of one total thus differ by about 1/FINE at most.

With ``capacity`` the shards are of that fixed size and as few as this packing needs: it starts with the least
possible number and adds shards for what found no place.

Only hashes and sizes are shuffled, never texts. Defined cases: a null text has no bytes and is equal to an empty one;
repeated rows and rows with a null id are placed row by row; equal sizes are taken in the order of their hashes; an
empty table gives an empty result; other columns are ignored (``with_shard`` keeps them). A group larger than
``capacity`` is alone in a shard that exceeds it.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankwell.llm.frames import attach, cut_lineage, fresh, read
from rankwell.operators.ordering import rank_within

SHARDS = 16
FINE = 1024
CELL = 65536
FAN = 1024


class CapacityTree:
    """A balanced search tree (treap) of distinct integers with insert, remove and successor in logarithmic time."""

    def __init__(self):
        self._root = None
        self._state = 0x9E3779B97F4A7C15

    def _split(self, node, key):
        """(keys below key, keys from key on); a node is [key, priority, left, right]."""
        if node is None:
            return None, None
        if node[0] < key:
            node[3], right = self._split(node[3], key)
            return node, right
        left, node[2] = self._split(node[2], key)
        return left, node

    def _merge(self, a, b):
        if a is None or b is None:
            return a or b
        if a[1] > b[1]:
            a[3] = self._merge(a[3], b)
            return a
        b[2] = self._merge(a, b[2])
        return b

    def insert(self, key: int) -> None:
        self._state = (self._state * 6364136223846793005 + 1442695040888963407) & 0xFFFFFFFFFFFFFFFF
        left, right = self._split(self._root, key)
        self._root = self._merge(self._merge(left, [key, self._state, None, None]), right)

    def remove(self, key: int) -> None:
        left, rest = self._split(self._root, key)
        _, right = self._split(rest, key + 1)
        self._root = self._merge(left, right)

    def successor(self, key: int) -> int | None:
        """The smallest member not below ``key``."""
        node, best = self._root, None
        while node is not None:
            if node[0] >= key:
                best, node = node[0], node[2]
            else:
                node = node[3]
        return best


def best_fit(sizes: list[int], room: list[int]) -> tuple[list[int | None], list[int]]:
    """(the bin of each item or None, what is left in the bins); items come by decreasing size."""
    n = len(room)
    room = list(room)
    tree = CapacityTree()
    for b, left in enumerate(room):
        tree.insert(left * n + b)
    out: list[int | None] = []
    for size in sizes:
        found = tree.successor(size * n)
        if found is None:
            out.append(None)
            continue
        left, b = divmod(found, n)
        tree.remove(found)
        room[b] = left - size
        tree.insert(room[b] * n + b)
        out.append(b)
    return out, room


def even_capacities(total: int, largest: list[int], shards: int) -> list[int]:
    """Capacities that add up to ``total``: groups above an even share of the rest have a shard each, the rest is even."""
    own: list[int] = []
    for size in sorted(largest, reverse=True)[:shards - 1]:
        if size * (shards - len(own)) <= total - sum(own):
            break
        own.append(size)
    return own + split_evenly(total - sum(own), [1] * (shards - len(own)))


def split_evenly(total: int, parts: list[int]) -> list[int]:
    """``total`` in whole numbers in proportion to ``parts``."""
    whole = sum(parts)
    if whole == 0:
        return [0] * len(parts)
    out = [total * p // whole for p in parts]
    short = total - sum(out)
    for i in sorted(range(len(parts)), key=lambda i: (-(total * parts[i] % whole), i))[:short]:
        out[i] += 1
    return out


def level_room(loads: list[int], total: int) -> list[int]:
    """What each shard takes of ``total`` so that the fullest are as low as can be (filled like water)."""
    low, high = min(loads), max(loads) + total
    while low < high:  # the highest level that needs no more than the total
        level = (low + high + 1) // 2
        if sum(max(0, level - x) for x in loads) <= total:
            low = level
        else:
            high = level - 1
    room = [max(0, low - x) for x in loads]
    below = [i for i, x in enumerate(loads) if x <= low]
    for i in below[:total - sum(room)]:
        room[i] += 1
    return room


_PLACED = "cell long, key string, bytes long, shard int"


def _cell(room_of, last: bool):
    """Packs one cell: its groups, and rows without a key that hold its remaining capacities. ``room_of`` gives the
    capacities of a first-level cell from its bytes; ``last``: what fits nowhere goes to the shard with most room."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        items = pdf[pdf["key"].notna()].sort_values(["bytes", "key"], ascending=[False, True])
        sizes = [int(x) for x in items["bytes"]]
        if room_of:
            room = room_of(sum(sizes))
        else:
            room = [int(x) for x in pdf[pdf["key"].isna()].groupby("shard")["bytes"].sum().sort_index()]
        bins, room = best_fit(sizes, room)
        for i, b in enumerate(bins):
            if b is None and last:
                b = max(range(len(room)), key=lambda s: (room[s], -s))
                bins[i], room[b] = b, room[b] - sizes[i]
        cell = int(pdf["cell"].iloc[0])
        groups = pd.DataFrame({"cell": cell, "key": items["key"].to_numpy(), "bytes": sizes, "shard": pd.array(bins, dtype="Int32")})
        rest = pd.DataFrame({"cell": cell, "key": None, "bytes": room, "shard": pd.array(range(len(room)), dtype="Int32")})
        return pd.concat([groups, rest], ignore_index=True)

    return run


def _total(rows: DataFrame) -> int:
    return rows.agg(F.coalesce(F.sum("bytes"), F.lit(0))).first()[0]


def _pack(groups: DataFrame, total: int, room: list[int], everything: bool) -> tuple[DataFrame, int]:
    """((key, shard), bytes that found no place: none with ``everything``)."""
    n = len(room)
    units = groups.withColumn("shard", F.lit(None).cast("int"))
    large = F.col("bytes") * (n * FINE) > total

    def packed(rows: DataFrame, room_of, last: bool) -> tuple[DataFrame, DataFrame]:
        out = cut_lineage(rows.groupBy("cell").applyInPandas(_cell(room_of, last), _PLACED))
        return out.filter("key is not null and shard is not null").select("key", "bytes", "shard"), out.filter("key is null or shard is null")

    first = units.filter(large).withColumn("cell", F.lit(0).cast("long")).select("cell", "key", "bytes", "shard")
    done, rest = packed(first, lambda own: room, everything)
    lost = _total(rest.filter("key is not null"))
    loads = {r[0]: r[1] for r in done.groupBy("shard").agg(F.sum("bytes")).collect()}
    loads = [loads.get(b, 0) for b in range(n)]
    small = units.filter(~large)
    size, count = small.agg(F.coalesce(F.sum("bytes"), F.lit(0)), F.count(F.lit(1))).first()
    if not count:
        return done.select("key", "shard"), lost
    room = level_room(loads, size) if everything else [max(0, c - x) for c, x in zip(room, loads)]
    cells = -(-count // max(CELL, 64 * n))
    level = small.select(F.pmod(F.xxhash64("key"), F.lit(cells)).alias("cell"), "key", "bytes", "shard")

    def room_of(own: int) -> list[int]:
        return split_evenly(own * sum(room) // size, room)

    tables = [done]
    while True:
        done, rest = packed(level, room_of, everything and cells == 1)
        tables.append(done)
        if cells == 1:
            break
        cells = -(-cells // FAN)
        level, room_of = rest.withColumn("cell", F.floor(F.col("cell") / FAN).cast("long")), None
    placed = tables[0]
    for t in tables[1:]:
        placed = placed.unionByName(t)
    return placed.select("key", "shard"), lost + _total(rest.filter("key is not null"))


def _keyed(text: F.Column) -> F.Column:
    return F.sha2(text, 256)


def _assign(base: DataFrame, shards: int, capacity: int | None) -> tuple[DataFrame, int]:
    """((key, n_rows, shard) of the groups of ``base`` (key, size), rows of base)."""
    groups = cut_lineage(base.groupBy("key").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("n_rows")))
    total, rows = groups.agg(F.coalesce(F.sum("bytes"), F.lit(0)), F.coalesce(F.sum("n_rows"), F.lit(0))).first()
    units = groups.select("key", "bytes")

    def largest(n: int) -> list[int]:
        return [r[0] for r in units.orderBy(F.desc("bytes")).limit(n).select("bytes").collect()]

    if not capacity:
        placed, _ = _pack(units, total, even_capacities(total, largest(shards), shards), True)
    else:
        # Groups above the capacity are fewer than total / capacity, as the shards are.
        own = [b for b in largest(1 + total // capacity) if b > capacity]
        shards = max(1, len(own) + -(-(total - sum(own)) // capacity))
        while True:
            placed, lost = _pack(units, total, own + [capacity] * (shards - len(own)), False)
            if not lost:
                break
            shards += -(-lost // capacity)
    return groups.join(placed, "key").select("key", "n_rows", "shard"), rows


def best_fit_shards(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shards: int = SHARDS,
                    capacity: int | None = None) -> DataFrame:
    """Per row of ``docs``: doc_id, size, text_crc32, shard and slot (the row's number in its shard, from 0)."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    base = cut_lineage(docs.select(F.col(id_col).cast("long").alias("doc_id"), (F.octet_length(text) + F.lit(1)).cast("long").alias("size"),
                                   F.crc32(text).alias("text_crc32"), _keyed(text).alias("key")))
    groups, rows = _assign(base, shards, capacity)
    out = attach(base, cut_lineage(groups), "key", "n_rows", rows)
    out = rank_within(out, ["shard"], ["doc_id", "key"], out="slot")
    return out.select("doc_id", "size", "text_crc32", "shard", (F.col("slot") - 1).alias("slot"))


def with_shard(docs: DataFrame, text_col: str = "text", shards: int = SHARDS, capacity: int | None = None) -> DataFrame:
    """``docs`` with the column ``shard`` (under a free name if it is taken), to be written with ``partitionBy``."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    key, name = fresh(docs, "shard_key"), fresh(docs, "shard")
    groups, rows = _assign(cut_lineage(docs.select(_keyed(text).alias("key"), (F.octet_length(text) + F.lit(1)).cast("long").alias("size"))),
                           shards, capacity)
    named = cut_lineage(groups.select(F.col("key").alias(key), "n_rows", F.col("shard").alias(name)))
    return attach(docs.withColumn(key, _keyed(text)), named, key, "n_rows", rows).drop(key)


def op11_best_fit_shards(spark, sf_dir: str) -> DataFrame:
    found = best_fit_shards(read(spark, sf_dir, "documents"))
    return found.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
