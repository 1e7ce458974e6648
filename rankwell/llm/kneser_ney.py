"""Quality by perplexity: interpolated modified Kneser-Ney model of byte sequences, one for each language.

Text is its UTF-8 bytes with white space collapsed, after ``ORDER - 1`` zero bytes, so every shorter sequence is the end of
some ``ORDER``-gram and a gram is exactly one 64-bit integer.

* Training counts come from trusted text: all documents with a trusted label. A caller may bound them by ``TRUSTED_DOCS``,
  then about equally many of each language (those with the smallest hash times the trusted documents of their
  language, so a rare language keeps all of its own).
* Order ``ORDER`` has raw counts, lower orders have continuation counts (the number of different bytes in front), each a
  group-by of the order above. Modified Kneser-Ney gives each language and order three discounts from its
  counts of counts; every context's discounted mass goes to the next lower order, down to the uniform one.
* Scoring covers every document whole. Documents are dealt into blocks; the texts of a block meet in
  one task, and its distinct grams are joined with the sharded probability tables, unseen grams
  fall back by joins with the contexts' masses, and the log-probabilities return to their block, where they
  come before its documents in one sorted stream. Texts travel compressed, once for each.
* A language's threshold comes from the quantiles of the scores (mean negative log2 probability per byte) of its trusted
  documents, each scored by a model of the half of them it is not in: the third quartile plus ``SPREAD``
  interquartile ranges. No share of junk moves it. A document above it, plus an allowance of ``NOISE / sqrt(bytes)``
  for short texts, is rejected. A language without such scores (one trusted document) takes the quantiles of all its documents.

No table is keyed by language alone except those with one row per language of the trusted documents. Memory per task is
one block's table and one batch.

Defined cases: null texts and texts without words have no score and are rejected; documents in a language
(or with a null language) that has no trusted text have no score and are kept; a null id is scored like any other (but is
never trusted); rows that repeat an id are judged row by row; empty tables give an empty result; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rankwell.llm.frames import cut_lineage, forget, map_batches, read
from rankwell.session import release

ORDER = 5
#: The most trusted documents that are used; None: all.
TRUSTED_DOCS: int | None = None
BLOCK_BYTES = 64 << 20
SPREAD = 3.0
NOISE = 8.0
_PIECE = 6_000_000
_ROWS = 1_000_000


def grams(data: bytes | None) -> np.ndarray:
    """The ``ORDER``-gram that ends at each byte."""
    if not data:
        return np.zeros(0, dtype=np.int64)
    text = b" ".join(data.split())
    if not text:
        return np.zeros(0, dtype=np.int64)
    raw = np.frombuffer(bytes(ORDER - 1) + text, dtype=np.uint8).astype(np.int64)
    out = raw[:len(text)].copy()
    for j in range(1, ORDER):
        out <<= 8
        out |= raw[j:j + len(text)]
    return out


def _low(gram: Column, k: int) -> Column:
    """The last k bytes of a gram."""
    return gram.bitwiseAND(F.lit((1 << 8 * k) - 1))


def _counts(batch: pa.RecordBatch):
    """(block, gram, n) with n summed over pieces of the batch; columns block, data."""
    found: dict[int, list[np.ndarray]] = {}
    size = 0

    def flush():
        for block, parts in found.items():
            gram, n = np.unique(np.concatenate(parts), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(gram), block)), pa.array(gram), pa.array(n.astype(np.int64))], names=["block", "gram", "n"])
        found.clear()

    for block, data in zip(*(c.to_pylist() for c in batch.columns)):
        part = grams(data)
        if len(part):
            found.setdefault(block, []).append(part)
            size += len(part)
            if size > _PIECE:
                yield from flush()
                size = 0
    yield from flush()


def _block_grams(batches):
    """The distinct grams of each block, from its packed texts (columns block, packed) one after the other."""
    z = zstandard.ZstdDecompressor()
    now, held, parts, size = None, np.zeros(0, np.int64), [], 0

    def rows(block, gram):
        for lo in range(0, len(gram), _ROWS):
            part = gram[lo:lo + _ROWS]
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(part), block)), pa.array(part)], names=["block", "gram"])

    for batch in batches:
        for block, packed in zip(batch.column(0).to_pylist(), batch.column(1)):
            if block != now:
                yield from rows(now, np.unique(np.concatenate([held, *parts])))
                now, held, parts, size = block, np.zeros(0, np.int64), [], 0
            part = grams(z.decompress(packed.as_py())) if packed.is_valid else held[:0]
            parts.append(part)
            size += len(part)
            if size > _PIECE:
                held, parts, size = np.unique(np.concatenate([held, *parts])), [], 0
    yield from rows(now, np.unique(np.concatenate([held, *parts])))


def _gram_counts(rows: DataFrame) -> DataFrame:
    return map_batches(rows, _counts, "block long, gram long, n long")


def count_grams(rows: DataFrame, halves: DataFrame) -> DataFrame:
    """(lang, gram, c) of the halves in ``rows`` (lang, data) and, added up, of the languages ``of`` which they are halves."""
    half = cut_lineage(_gram_counts(rows.select("lang", "data")).groupBy(F.col("block").alias("lang"), "gram").agg(F.sum("n").alias("c")))
    whole = half.join(halves, "lang").groupBy(F.col("of").alias("lang"), "gram").agg(F.sum("c").alias("c"))
    out = cut_lineage(half.unionByName(whole))
    release(half)
    return out


def train(raw: DataFrame) -> tuple[list[DataFrame], list[DataFrame]]:
    """From raw counts (lang, gram, c): for each order 1..ORDER the tables (lang, gram, p) and (lang, context, gamma)."""
    counts = [raw]
    for k in range(ORDER - 1, 0, -1):
        counts.insert(0, cut_lineage(counts[0].groupBy("lang", _low(F.col("gram"), k).alias("gram")).agg(F.count(F.lit(1)).alias("c"))))
    tables, masses = [], []
    for k, table in enumerate(counts, 1):
        of = lambda i: F.count_if(F.col("c") == i).cast("double")
        kinds = table.groupBy("lang").agg(of(1).alias("k1"), of(2).alias("k2"), of(3).alias("k3"), of(4).alias("k4"))
        y = F.col("k1") / F.greatest(F.col("k1") + 2 * F.col("k2"), F.lit(1.0))
        discount = lambda i: F.greatest(F.lit(0.1), F.least(F.lit(i - 0.1), F.when(
            F.col(f"k{i}") > 0, i - (i + 1) * y * F.col(f"k{i + 1}") / F.col(f"k{i}")).otherwise(0.5 * i)))
        discounts = kinds.select("lang", discount(1).alias("d1"), discount(2).alias("d2"), discount(3).alias("d3"))
        context = F.shiftright("gram", 8)
        inside = table.groupBy("lang", context.alias("context")).agg(
            F.sum("c").alias("total"), F.count_if(F.col("c") == 1).alias("n1"), F.count_if(F.col("c") == 2).alias("n2"), F.count_if(F.col("c") > 2).alias("n3"))
        inside = cut_lineage(inside.join(F.broadcast(discounts), "lang").select(
            "lang", "context", "total", ((F.col("d1") * F.col("n1") + F.col("d2") * F.col("n2") + F.col("d3") * F.col("n3")) / F.col("total")).alias("gamma")))
        masses.append(inside)
        d = F.when(F.col("c") == 1, F.col("d1")).when(F.col("c") == 2, F.col("d2")).otherwise(F.col("d3"))
        rows_k = table.withColumn("context", context).join(inside, ["lang", "context"]).join(F.broadcast(discounts), "lang")
        if k == 1:
            lower = rows_k.withColumn("below", F.lit(1 / 256))
        else:
            below = tables[-1].select("lang", F.col("gram").alias("end"), F.col("p").alias("below"))
            lower = rows_k.withColumn("end", _low(F.col("gram"), k - 1)).join(below, ["lang", "end"])
        tables.append(cut_lineage(lower.select("lang", "gram", ((F.col("c") - d) / F.col("total") + F.col("gamma") * F.col("below")).alias("p"))))
        release(table)
    forget(raw.sparkSession, *counts)
    return tables, masses


def probabilities(wanted: DataFrame, tables: list[DataFrame], masses: list[DataFrame]) -> DataFrame:
    """(lang, gram, logp) for the distinct (lang, gram) of ``wanted`` whose language has a model.

    From the shortest order up: each order sees the distinct ends of the wanted grams only, which are few for short ones."""
    wanted = wanted.join(cut_lineage(tables[0].select("lang").distinct()), "lang", "left_semi")
    lower = None
    for k in range(1, ORDER + 1):
        rows = wanted.select("lang", _low(F.col("gram"), k).alias("gram"))
        if k < ORDER:
            rows = rows.distinct()
        rows = rows.join(tables[k - 1].select("lang", "gram", "p"), ["lang", "gram"], "left").withColumn("context", F.shiftright("gram", 8))
        rows = rows.join(masses[k - 1].select("lang", "context", "gamma"), ["lang", "context"], "left")
        below = F.lit(1 / 256)
        if lower is not None:
            rows = rows.withColumn("end", _low(F.col("gram"), k - 1)).join(lower.withColumnRenamed("gram", "end"), ["lang", "end"])
            below = F.col("below")
        lower = rows.select("lang", "gram", F.coalesce("p", F.coalesce("gamma", F.lit(1.0)) * below).alias("below"))
    return lower.select("lang", "gram", F.log2("below").alias("logp"))


def _score(batches):
    """Blocks in order, each one's grams (kind 0) before its documents (kind 1)."""
    z = zstandard.ZstdDecompressor()
    now, gram, logp, ready = None, [], [], False
    for batch in batches:
        block, kind = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        edges = np.flatnonzero((block[1:] != block[:-1]) | (kind[1:] != kind[:-1])) + 1
        for lo, hi in zip([0, *edges], [*edges, len(block)]):
            if block[lo] != now:
                now, gram, logp, ready = block[lo], [], [], False
            part = batch.slice(lo, hi - lo)
            if kind[lo] == 0:
                for packed in part.column(3):
                    both = np.frombuffer(z.decompress(packed.as_py()), dtype=np.int64).reshape(2, -1)
                    gram.append(both[0])
                    logp.append(both[1].view(np.float64))
                continue
            if not ready:
                keys = np.concatenate(gram) if gram else np.zeros(0, np.int64)
                values = np.concatenate(logp) if logp else np.zeros(0)
                order = np.argsort(keys)
                keys, values, ready = keys[order], values[order], True
            scores, sizes = [], []
            for packed in part.column(3).to_pylist():
                g = grams(None if packed is None else z.decompress(packed))
                sizes.append(len(g))
                scores.append(-float(values[np.searchsorted(keys, g)].mean()) if len(g) and len(keys) else None)
            yield pa.RecordBatch.from_arrays([part.column(2), part.column(4), pa.array(sizes, pa.int64()), pa.array(scores, pa.float64())],
                                             names=["doc_id", "lang", "n_bytes", "score"])


def _pack_grams(batch: pa.RecordBatch):
    """A batch's grams and log-probabilities of a block as one compressed value."""
    z = zstandard.ZstdCompressor(level=1)
    block, gram, logp = (c.to_numpy() for c in batch.columns)
    order = np.lexsort((gram, block))
    block, gram, logp = block[order], gram[order], logp[order]
    edges = np.flatnonzero(block[1:] != block[:-1]) + 1
    spans = list(zip([0, *edges], [*edges, len(block)]))
    packed = [z.compress(np.concatenate((gram[lo:hi], logp[lo:hi].view(np.int64))).tobytes()) for lo, hi in spans]
    yield pa.RecordBatch.from_arrays([pa.array([block[lo] for lo, _ in spans], pa.int64()), pa.array(packed, pa.binary())], names=["block", "packed"])


def _pack(batch: pa.RecordBatch):
    z = zstandard.ZstdCompressor(level=1)
    packed = [None if t is None else z.compress(t) for t in batch.column(3).to_pylist()]
    yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(packed, pa.binary())], names=["doc_id", "lang", "block", "packed"])


def _sample(base: DataFrame, labels: DataFrame, trusted: str) -> DataFrame:
    """(doc_id, lang, fold) of the trusted documents; of at most ``TRUSTED_DOCS`` if that is set, dealt over their languages."""
    ids = labels.filter(trusted).filter(F.col("doc_id").isNotNull()).select("doc_id").distinct()
    rows = cut_lineage(base.select("doc_id", "lang").filter(F.col("lang") != F.xxhash64(F.lit(""))).join(ids, "doc_id").distinct())
    fold = F.pmod(F.xxhash64("doc_id", F.lit("fold")), F.lit(2)).alias("fold")
    if TRUSTED_DOCS is None:
        return cut_lineage(rows.select("doc_id", "lang", fold))
    # Languages beyond the largest ones count as if they had one document.
    sizes = rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "lang").limit(TRUSTED_DOCS)
    place = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 40)) / (1 << 40) * F.coalesce("n", F.lit(1))
    chosen = rows.join(F.broadcast(sizes), "lang", "left").withColumn("place", place).orderBy("place", "doc_id", "lang").limit(TRUSTED_DOCS)
    return cut_lineage(chosen.select("doc_id", "lang", fold))


def perplexity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
               trusted: str = "quality = 1") -> DataFrame:
    """Per row of ``docs``: doc_id, lang, n_bytes, score (bits per byte), held false; and a row with held true for each trusted
    row, scored by the other half's model."""
    lang = F.xxhash64(F.coalesce(F.col(lang_col).cast("string"), F.lit("")))
    base = docs.select(F.col(id_col).cast("long").alias("doc_id"), lang.alias("lang"), F.col(text_col).cast("binary").alias("data"))
    sample = _sample(base, labels, trusted)
    known = cut_lineage(base.join(sample, ["doc_id", "lang"]))
    # The join's shuffle files, which hold the texts, are not needed any more.
    forget(docs.sparkSession)
    # A half of a language's trusted documents is a language of its own to the model.
    half = lambda fold: F.xxhash64("lang", F.lit("half"), fold)
    halves = cut_lineage(sample.select("lang").distinct().select(
        F.col("lang").alias("of"), F.explode(F.array(*[half(F.lit(i).cast("long")) for i in (0, 1)])).alias("lang")))
    tables, masses = train(count_grams(known.select(half(F.col("fold")).alias("lang"), "data"), halves))

    size = docs.agg(F.coalesce(F.sum(F.octet_length(text_col)), F.lit(0)).alias("n")).first()["n"]
    blocks = max(1, -(-size // BLOCK_BYTES))
    # A block holds one language (pmod of a long: the salt is a long); which of its blocks a document is in depends on the id only.
    salt = F.pmod(F.xxhash64("doc_id", F.octet_length("data")), F.lit(blocks))
    held = known.select("doc_id", half(1 - F.col("fold")).alias("lang"), "data")
    dealt = base.unionByName(held).withColumn("block", F.xxhash64("lang", salt))
    # A block says its language: only the block goes through the shuffle with each gram.
    langs = base.select("lang").unionByName(halves.select("lang")).distinct()
    of_block = cut_lineage(langs.select("lang", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))).alias("salt"))
                           .select("lang", F.xxhash64("lang", "salt").alias("block")))
    # The texts come to their block, which takes less room than a row for each gram of each batch.
    packed = map_batches(dealt.select("doc_id", "lang", "block", "data"), _pack, "doc_id long, lang long, block long, packed binary")
    of_text = packed.select("block", "packed").repartition("block").sortWithinPartitions("block").mapInArrow(_block_grams, "block long, gram long")
    wanted = cut_lineage(of_text).join(of_block, "block")
    forget(docs.sparkSession)
    logp = cut_lineage(probabilities(wanted.select("lang", "gram").distinct(), tables, masses))
    forget(docs.sparkSession, *tables, *masses)
    known_rows = map_batches(wanted.join(logp, ["lang", "gram"]).select("block", "gram", "logp"), _pack_grams, "block long, packed binary").select(
        "block", F.lit(0).alias("kind"), F.lit(None).cast("long").alias("doc_id"), "packed", F.lit(None).cast("long").alias("lang"))
    doc_rows = packed.select(
        "block", F.lit(1).alias("kind"), "doc_id", "packed", "lang")
    stream = known_rows.unionByName(doc_rows).repartition("block").sortWithinPartitions("block", "kind")
    scored = stream.mapInArrow(_score, "doc_id long, lang long, n_bytes long, score double").join(halves, "lang", "left")
    return scored.select("doc_id", F.coalesce("of", "lang").alias("lang"), "n_bytes", "score", F.col("of").isNotNull().alias("held"))


def perplexity_filter(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
                      trusted: str = "quality = 1") -> DataFrame:
    """Per row of ``docs``: doc_id, n_bytes, score, threshold and kept."""
    scored = cut_lineage(perplexity(docs, labels, id_col, text_col, lang_col, trusted))
    of = lambda rows: F.percentile_approx(F.when(rows, F.col("score")), [0.25, 0.75], 10_000)
    quartile = scored.filter("score is not null").groupBy("lang").agg(F.coalesce(of(F.col("held")), of(~F.col("held"))).alias("q"))
    # Only languages of trusted documents have scores.
    limits = cut_lineage(quartile.select("lang", (F.get("q", F.lit(1)) + SPREAD * (F.get("q", F.lit(1)) - F.get("q", F.lit(0)))).alias("threshold")))
    out = scored.filter("not held").join(limits, "lang", "left")
    above = F.col("score") > F.col("threshold") + NOISE / F.sqrt(F.greatest("n_bytes", F.lit(1)))
    kept = (F.col("n_bytes") > 0) & ~F.coalesce(above, F.lit(False))
    return out.select("doc_id", "n_bytes", "score", "threshold", kept.alias("kept"))


def op7_kneser_ney(spark, sf_dir: str) -> DataFrame:
    return perplexity_filter(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))
