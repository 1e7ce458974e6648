"""SentencePiece encoding and decoding with a weighted finite-state transducer.

The model file is compiled into three transducers, which are composed with each input:
* the normaliser: a dummy space in front, spaces (and U+2581) to U+2581; other characters stay (models whose normaliser
  has a character map are refused);
* the pieces: one arc for each piece, from any state to the state of that piece. The file is a byte-pair
  model, whose encodings are not the best-scoring segmentations, so a transducer with free arcs and scores as
  weights would give wrong results. A sequence of pieces is the byte-pair encoding of a text exactly when
  each neighbouring pair is the encoding of its own text (merges near a boundary depend on nothing beyond
  the two pieces). So an arc may follow another only if the pair is its own encoding, which is
  the transition of the transducer, computed when first met and remembered;
* byte fallback: a character that is no piece becomes an arc with its UTF-8 bytes.
Weights are tropical (the piece's negated score; a path's weight is their sum, and the smallest path is
taken). No piece has U+2581 behind another character, so an input falls into units (U+2581 and what
follows) whose shortest paths are found separately and remembered in a bounded cache of two generations.

Documents are encoded where they are read, one row each: no shuffle, memory bounded by one batch and the
caches. The file's path is a parameter; its bytes are broadcast (about 0.5 MB, whatever the corpus).

Decoding joins the pieces, turns byte pieces back to characters (invalid sequences to U+FFFD each byte), U+2581 to
spaces and drops the dummy space. Encoding and decoding give the text back but for U+2581, which becomes a space.

Defined cases: null text gives null ids, empty text no ids; very long texts and units are linear in their
length; null ids, repeated rows and an empty table are fine; other columns are ignored.
"""

from __future__ import annotations

import re
import struct
from collections.abc import Iterator
from heapq import heappop, heappush
from math import inf

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankwell.llm.frames import map_batches, read

DEFAULT_MODEL = "/opt/tokenizers/piece_bpe_32k.model"
SPACE = "▁"
#: Fixed values of the model format: field numbers and piece types.
PIECE, TRAINER, NORMALISER = 1, 2, 3
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
BPE = 2
CACHE_UNITS = 500_000
CACHE_PAIRS = 2_000_000
#: Longest unit that the cache keeps (characters).
CACHE_LENGTH = 64
UNIT = re.compile(f"{SPACE}+[^{SPACE}]*|[^{SPACE}]+")


def _fields(data: bytes) -> Iterator[tuple[int, int | float | bytes]]:
    """The fields of a protocol buffer message."""
    at = 0

    def varint() -> int:
        nonlocal at
        shift = value = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(data):
        tag = varint()
        kind = tag & 7
        if kind == 0:
            yield tag >> 3, varint()
        elif kind == 2:
            size = varint()
            yield tag >> 3, data[at:at + size]
            at += size
        elif kind == 5:
            yield tag >> 3, struct.unpack_from("<f", data, at)[0]
            at += 4
        else:
            yield tag >> 3, data[at:at + 8]
            at += 8


class Transducer:
    """A compiled model."""

    def __init__(self, model: bytes):
        self.pieces: list[str] = []
        self.kinds: list[int] = []
        self.scores: list[float] = []
        trainer: dict = {}
        normaliser: dict = {}
        for field, value in _fields(model):
            if field == PIECE:
                piece = dict(_fields(value))
                self.pieces.append(piece[1].decode())
                self.scores.append(piece.get(2, 0.0))
                self.kinds.append(piece.get(3, NORMAL))
            elif field == TRAINER:
                trainer = dict(_fields(value))
            elif field == NORMALISER:
                normaliser = dict(_fields(value))
        if trainer.get(3) != BPE or normaliser.get(2) or normaliser.get(4, 1) or not normaliser.get(3, 1) or not normaliser.get(5, 1):
            raise ValueError("only byte-pair models with the identity normaliser, a dummy prefix and escaped spaces are compiled")
        if any(k in (USER_DEFINED, UNUSED) for k in self.kinds):
            raise ValueError("user-defined and unused pieces are not compiled")
        self.ids = {p: i for i, p in enumerate(self.pieces) if self.kinds[i] == NORMAL}
        if any(SPACE in p.lstrip(SPACE) for p in self.ids):
            raise ValueError("a piece has a space inside")
        self.bytes = {int(p[3:5], 16): i for i, p in enumerate(self.pieces) if self.kinds[i] == BYTE}
        # Arcs as a prefix tree: character -> (piece or -1, next). A piece that is not its own encoding has no arc.
        self.arcs: dict[str, list] = {}
        for text, piece in self.ids.items():
            if len(text) > 1 and self.merged(list(text)) != [text]:
                continue
            node = self.arcs
            for c in text[:-1]:
                node = node.setdefault(c, [-1, {}])[1]
            node.setdefault(text[-1], [-1, {}])[0] = piece
        if any(c not in self.ids for c in self.arcs):
            raise ValueError("a character of a piece is no piece")
        self._special = np.array([k != NORMAL for k in self.kinds])
        self._pairs: dict[int, bool] = {}
        self._units: dict[str, bytes] = {}
        self._older: dict[str, bytes] = {}

    # -- transitions

    def merged(self, symbols: list[str]) -> list[str]:
        """Byte-pair merges of a short symbol sequence: the best score first, the leftmost among equals."""
        left, right = list(range(-1, len(symbols) - 1)), list(range(1, len(symbols) + 1))
        symbols = list(symbols)
        heap: list[tuple[float, int, int, str]] = []

        def offer(a: int, b: int) -> None:
            if a >= 0 and b < len(symbols):
                found = self.ids.get(symbols[a] + symbols[b])
                if found is not None:
                    heappush(heap, (-self.scores[found], a, b, symbols[a] + symbols[b]))

        for i in range(len(symbols) - 1):
            offer(i, i + 1)
        while heap:
            _, a, b, text = heappop(heap)
            if not symbols[a] or not symbols[b] or symbols[a] + symbols[b] != text or right[a] != b:
                continue
            symbols[a], symbols[b] = text, ""
            right[a] = right[b]
            if right[a] < len(symbols):
                left[right[a]] = a
            offer(left[a], a)
            offer(a, right[a])
        return [s for s in symbols if s]

    def follows(self, a: int, b: int) -> bool:
        """Whether piece b may follow piece a."""
        key = a << 32 | b
        found = self._pairs.get(key)
        if found is None:
            if len(self._pairs) > CACHE_PAIRS:
                self._pairs.clear()
            x, y = self.pieces[a], self.pieces[b]
            found = self._pairs[key] = self.merged(list(x + y)) == [x, y]
        return found

    # -- composition and shortest path

    def shortest_path(self, unit: str) -> list[int]:
        """Piece ids of the smallest path through the composition of a normalised unit and the transducer.

        One state a position is enough: a path that keeps to the pairs is the encoding of what it has read, so no two
        pieces can end a prefix.  The weights still settle it if the scores of a model tie."""
        n, pairs, scores, root = len(unit), self._pairs, self.scores, self.arcs
        # state[i]: the piece that ends at i (-1: the start or a fallback character, -2: none), where it starts, and its weight
        state, begin, weight = [-2] * (n + 1), [0] * (n + 1), [inf] * (n + 1)
        state[0], weight[0] = -1, 0.0
        for i in range(n):
            last = state[i]
            if last == -2:
                continue
            arcs, here = root, weight[i]
            if unit[i] not in root:
                state[i + 1], begin[i + 1], weight[i + 1] = -1, i, here
                continue
            key = last << 32
            for j in range(i, n):
                arc = arcs.get(unit[j])
                if arc is None:
                    break
                piece, arcs = arc
                if piece >= 0:
                    if last >= 0:
                        ok = pairs.get(key | piece)
                        if ok is None:
                            ok = self.follows(last, piece)
                    else:
                        ok = True
                    if ok:
                        there = here - scores[piece]
                        if there < weight[j + 1]:
                            state[j + 1], begin[j + 1], weight[j + 1] = piece, i, there
                if not arcs:
                    break
        out: list[int] = []
        at = n
        while at:
            start = begin[at]
            out += [state[at]] if state[at] >= 0 else [self.bytes[b] for b in reversed(unit[start:at].encode())]
            at = start
        return out[::-1]

    def encode(self, text: str) -> np.ndarray:
        if not text:
            return np.zeros(0, dtype=np.int32)
        found = UNIT.findall(SPACE + text.replace(" ", SPACE))
        parts = list(map(self._units.get, found))
        if None in parts:
            parts = [self._path(u) if p is None else p for u, p in zip(found, parts)]
        return np.frombuffer(b"".join(parts), dtype=np.int32)

    def _path(self, unit: str) -> bytes:
        """The shortest path of a unit as 32-bit ids, remembered."""
        ids = self._units.get(unit) or self._older.get(unit)
        if ids is None:
            ids = np.array(self.shortest_path(unit), dtype=np.int32).tobytes()
        if len(unit) <= CACHE_LENGTH:
            if len(self._units) >= CACHE_UNITS:  # two generations: what is in use survives
                self._older, self._units = self._units, {}
            self._units[unit] = ids
        return ids

    def decode(self, ids) -> str:
        ids = np.asarray(ids, dtype=np.int32)
        special = self._special[ids]
        values, pieces = ids.tolist(), self.pieces
        edges = [0, *(np.flatnonzero(special[1:] != special[:-1]) + 1).tolist(), len(values)]
        parts: list[str] = []
        for lo, hi in zip(edges, edges[1:]):  # runs of pieces, and of ids that are no pieces
            if lo < hi:
                parts += self._no_pieces(values[lo:hi]) if special[lo] else map(pieces.__getitem__, values[lo:hi])
        text = "".join(parts).replace(SPACE, " ")
        return text[1:] if text.startswith(" ") else text

    def _no_pieces(self, ids: list[int]) -> Iterator[str]:
        """The texts of neighbouring bytes, unknown and control ids."""
        raw = bytearray()
        for i in ids:
            if self.kinds[i] == BYTE:
                raw.append(int(self.pieces[i][3:5], 16))
                continue
            if raw:
                yield _characters(bytes(raw))
                raw.clear()
            if self.kinds[i] == UNKNOWN:
                yield " ⁇ "
        if raw:
            yield _characters(bytes(raw))


def _characters(raw: bytes) -> str:
    """UTF-8 characters; each byte that belongs to none is U+FFFD."""
    out, at = [], 0
    while at < len(raw):
        size = 1 if raw[at] < 0x80 else 2 if raw[at] >> 5 == 6 else 3 if raw[at] >> 4 == 14 else 4 if raw[at] >> 3 == 30 else 1
        try:
            out.append(raw[at:at + size].decode())
            at += size
        except UnicodeDecodeError:
            out.append("�")
            at += 1
    return "".join(out)


_compiled: dict[int, Transducer] = {}


def _transducer(model: bytes) -> Transducer:
    """The worker's compiled model (workers live for many tasks)."""
    key = hash(model)
    if key not in _compiled:
        _compiled.clear()
        _compiled[key] = Transducer(model)
    return _compiled[key]


def _load(spark, path: str):
    """The model's bytes as a broadcast; any path that Spark can read."""
    if "://" not in path:
        path = f"file://{path}"
    data = bytes(spark.read.format("binaryFile").load(path).select("content").first()["content"])
    return spark.sparkContext.broadcast(data)


def _lists(values: list[np.ndarray | None]) -> pa.Array:
    sizes = np.array([0 if v is None else len(v) for v in values])
    offsets = np.concatenate(([0], np.cumsum(sizes))).astype(np.int32)
    flat = np.concatenate([v for v in values if v is not None] or [np.zeros(0, np.int32)])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat.astype(np.int32)), mask=pa.array([v is None for v in values]))


def encode(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", model: str = DEFAULT_MODEL) -> DataFrame:
    """Per row of ``docs``: doc_id and ids, an array of int."""
    shared = _load(docs.sparkSession, model)

    def emit(batch: pa.RecordBatch):
        fst = _transducer(shared.value)
        for lo in range(0, batch.num_rows, 256):
            part = batch.slice(lo, 256)
            ids = [None if t is None else fst.encode(t) for t in part.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([part.column(0), _lists(ids)], names=["doc_id", "ids"])

    kind = docs.schema[id_col].dataType.simpleString()
    return map_batches(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")), emit, f"doc_id {kind}, ids array<int>")


def decode(encoded: DataFrame, id_col: str = "doc_id", ids_col: str = "ids", model: str = DEFAULT_MODEL) -> DataFrame:
    """Per row of ``encoded``: doc_id and text."""
    shared = _load(encoded.sparkSession, model)

    def emit(batch: pa.RecordBatch):
        fst = _transducer(shared.value)
        texts = [None if i is None else fst.decode(i) for i in batch.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["doc_id", "text"])

    kind = encoded.schema[id_col].dataType.simpleString()
    return map_batches(encoded.select(F.col(id_col).alias("doc_id"), F.col(ids_col).alias("ids")), emit, f"doc_id {kind}, text string")


def round_trip(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", model: str = DEFAULT_MODEL) -> DataFrame:
    """Per row of ``docs``: doc_id, ids, and round_trip: whether decoding the ids gives the text back, U+2581 being a
    space (null for a null text).  The ids are decoded where they were made, so nothing is sent twice."""
    shared = _load(docs.sparkSession, model)

    def emit(batch: pa.RecordBatch):
        fst = _transducer(shared.value)
        for lo in range(0, batch.num_rows, 256):
            part = batch.slice(lo, 256)
            texts = part.column(1).to_pylist()
            ids = [None if t is None else fst.encode(t) for t in texts]
            same = [None if t is None else fst.decode(i) == t.replace(SPACE, " ") for t, i in zip(texts, ids)]
            yield pa.RecordBatch.from_arrays([part.column(0), _lists(ids), pa.array(same, pa.bool_())],
                                             names=["doc_id", "ids", "round_trip"])

    kind = docs.schema[id_col].dataType.simpleString()
    return map_batches(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")), emit,
                       f"doc_id {kind}, ids array<int>, round_trip boolean")


def op4_sentencepiece(spark, sf_dir: str) -> DataFrame:
    out = round_trip(read(spark, sf_dir, "documents"))
    return out.select("doc_id", F.size("ids").cast("long").alias("n_ids"), "ids", "round_trip")
