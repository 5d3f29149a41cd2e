"""SentencePiece encoding and decoding with a streaming Viterbi search.

The search walks a text once and keeps, for every position of a window, the last piece of the best
segmentation up to there. A piece is at most ``longest`` characters, so every later path passes
one of the last ``longest`` positions; as soon as their backpointer paths meet in one boundary, all
ids before it are final, are committed and leave the window.

For a BPE model the best segmentation is the one the merges produce. It has a local rule: a
sequence of pieces is the merge result of its text exactly if every two neighbours are the merge
result of theirs. The search therefore extends a path only by pieces that agree with its last
piece in this sense, which leaves one survivor per position. Ids equal those of the library.

No piece holds a space mark after another character, or one of the ``breaks`` next to anything
else. All paths converge there, so a text is a sequence of units, and frequent units are looked up
instead of searched again.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from typing import NamedTuple

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from railmill.llm.tokens import ranges

MARK = "▁"
# Pieces a broadcast vocabulary may hold, about 200 bytes each.
MAX_PIECES = 1_000_000
_NONE, _NEVER = -1, float("-inf")
CACHED_UNITS = 1 << 18
CACHED_PAIRS = 1 << 20


class Vocabulary(NamedTuple):
    """A SentencePiece BPE model with byte fallback: pieces by id, merge scores, first byte's id."""

    pieces: list[str]
    scores: list[float]
    special: frozenset[int]  # control and unknown pieces
    byte_ids: dict[int, int]  # id -> byte


def load_vocabulary(path: str) -> Vocabulary:
    """Reads a model file on the driver. Only BPE with identity normalisation is understood."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    size = model.vocab_size()
    if size > MAX_PIECES:
        raise ValueError(f"{size} pieces; a broadcast vocabulary may hold {MAX_PIECES}")
    pieces = [model.id_to_piece(i) for i in range(size)]
    special = frozenset(i for i in range(size) if model.is_control(i) or model.is_unknown(i))
    byte_ids = {i: int(pieces[i][3:5], 16) for i in range(size) if model.is_byte(i)}
    return Vocabulary(pieces, [model.get_score(i) for i in range(size)], special, byte_ids)


class _Units(dict):
    """Unit -> ids as int32 bytes. Two generations of bounded size stand for the recent ones."""

    def __init__(self, search):
        super().__init__()
        self.search, self.old = search, {}

    def __missing__(self, unit: str) -> bytes:
        if (ids := self.old.get(unit)) is None:
            ids = np.array(self.search(unit), dtype="<i4").tobytes()
        if len(unit) <= 64:
            if len(self) >= CACHED_UNITS:
                self.old = dict(self)
                self.clear()
            self[unit] = ids
        return ids


class Encoder:
    def __init__(self, vocabulary: Vocabulary):
        normal = {
            p: i
            for i, p in enumerate(vocabulary.pieces)
            if i not in vocabulary.special and i not in vocabulary.byte_ids
        }
        self.ids = normal
        self.score = {p: vocabulary.scores[i] for p, i in normal.items()}
        self.byte_id = {b: i for i, b in vocabulary.byte_ids.items()}
        self.longest = max(map(len, normal), default=1)
        if any(MARK in p.lstrip(MARK) for p in normal):
            raise ValueError("the vocabulary has pieces across spaces")
        joined = {c for p in normal if len(p) > 1 for c in p}
        breaks = "".join(c for c in "\n\r\t" if c not in joined)
        self.units = re.compile(f"[{breaks}]|{MARK}*[^{MARK}{breaks}]+|{MARK}+" if breaks else f"{MARK}*[^{MARK}]+|{MARK}+")
        self.pieces = vocabulary.pieces
        self.matches = ahocorasick.Automaton()
        for piece, i in normal.items():
            self.matches.add_word(piece, (i, len(piece)))
        self.matches.make_automaton()
        self.pairs: dict[int, bool] = {}
        self.cache = _Units(self.search)

    def merged(self, text: str) -> list[str]:
        """The pieces that merging leaves of a short text: best score first, then leftmost."""
        parts, score = list(text), self.score.get
        # a pair that is no piece never wins
        gains = [score(x + y, _NEVER) for x, y in zip(parts, parts[1:])]
        while gains and (best := max(gains)) > _NEVER:
            at = gains.index(best)
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
            del gains[at]
            if at:
                gains[at - 1] = score(parts[at - 1] + parts[at], _NEVER)
            if at < len(gains):
                gains[at] = score(parts[at] + parts[at + 1], _NEVER)
        return parts

    def agree(self, key: int, left: int, right: int) -> bool:
        """Whether the two pieces are what merging makes of their text; ``left`` may be missing."""
        parts = [self.pieces[i] for i in (left, right) if i != _NONE]
        found = self.merged("".join(parts)) == parts
        if len(self.pairs) >= CACHED_PAIRS:
            self.pairs.clear()
        self.pairs[key] = found
        return found

    def search(self, unit: str) -> list[int]:
        """Streaming Viterbi over one unit.

        ``last[i]`` and ``width[i]`` are the last piece of the survivor at position ``base + i`` and
        its length. A character no piece has stands for itself; nothing merges with it.
        """
        out: list[int] = []
        base, at, last, width = 0, 0, [_NONE], [0]
        known, room = self.pairs.get, 4 * self.longest
        for end, (piece, size) in self.matches.iter(unit):
            if end < at:
                continue  # this position has its survivor
            while at < end:
                last.append(_NONE)
                width.append(1)
                at += 1
            left = last[end + 1 - size - base]
            key = left << 24 | piece
            good = known(key)
            if good is None:
                good = self.agree(key, left, piece)
            if good:
                last.append(piece)
                width.append(size)
                at += 1
                if len(last) > room and not at & 15:
                    boundary = self._converged(width)
                    if boundary:
                        self._commit(unit, base, last[: boundary + 1], width, out)
                        last, width, base = last[boundary:], width[boundary:], base + boundary
        missing = len(unit) - at
        self._commit(unit, base, last + [_NONE] * missing, width + [1] * missing, out)
        return out

    def _converged(self, width: list[int]) -> int:
        """The boundary all survivors at the window's end share; 0 if only its start."""
        high = len(width) - 1
        live = set(range(high - self.longest + 1, high + 1))
        while len(live) > 1:
            at = max(live)
            live.remove(at)
            live.add(at - width[at])
        return live.pop()

    def _commit(self, unit: str, base: int, last: list[int], width: list[int], out: list[int]) -> None:
        at, path = len(last) - 1, []
        while at > 0:
            if last[at] == _NONE:
                path.extend(self.byte_id[b] for b in reversed(unit[base + at - 1].encode()))
            else:
                path.append(last[at])
            at -= width[at]
        out.extend(reversed(path))

    def encode(self, text: str) -> bytes:
        """Ids as little-endian int32; a non-empty text gets a space mark in front."""
        if not text:
            return b""
        cache = self.cache
        return b"".join([cache[u] for u in self.units.findall(MARK + text.replace(" ", MARK))])


class Decoder:
    def __init__(self, vocabulary: Vocabulary):
        parts = [
            b"" if i in vocabulary.special else bytes([vocabulary.byte_ids[i]]) if i in vocabulary.byte_ids
            else p.replace(MARK, " ").encode()
            for i, p in enumerate(vocabulary.pieces)
        ]
        self.length = np.array([len(p) for p in parts], dtype=np.int64)
        self.start = np.cumsum(self.length) - self.length
        self.data = np.frombuffer(b"".join(parts), dtype=np.uint8)

    def decode(self, ids: np.ndarray) -> str:
        """The text of the ids without the leading space; bytes that are no UTF-8 become U+FFFD.

        Control and unknown pieces, and ids the vocabulary lacks, give nothing.
        """
        ids = ids[(ids >= 0) & (ids < len(self.length))]
        data = self.data[ranges(self.start[ids], self.length[ids])].tobytes()
        return (data[1:] if data[:1] == b" " else data).decode(errors="replace")


def _shared(spark: SparkSession, vocabulary: Vocabulary):
    return spark.sparkContext.broadcast(vocabulary)


_workers: dict[int, tuple[Encoder, Decoder]] = {}


def _coders(shared) -> tuple[Encoder, Decoder]:
    """Coders of this worker process; their caches serve later tasks too."""
    vocabulary = shared.value
    key = hash((len(vocabulary.pieces), tuple(vocabulary.pieces[-64:])))
    if key not in _workers:
        _workers.clear()
        _workers[key] = Encoder(vocabulary), Decoder(vocabulary)
    return _workers[key]


def _lists(parts: list[bytes | None]) -> pa.Array:
    """Id bytes per row as a list column; None stays null."""
    sizes = np.array([len(p or b"") // 4 for p in parts], dtype=np.int64)
    offsets = np.concatenate(([0], np.cumsum(sizes))).astype(np.int32)
    values = pa.array(np.frombuffer(b"".join(p or b"" for p in parts), dtype="<i4"))
    nulls = pa.array([p is None for p in parts])
    return pa.ListArray.from_arrays(pa.array(offsets), values, mask=nulls)


_STEP = 256


def encode_documents(docs: DataFrame, vocabulary: Vocabulary, text: str = "text", ids: str = "ids") -> DataFrame:
    """``docs`` with ``ids``: the piece ids of the whole text. Null gives null, empty an empty list.

    A column already called ``ids`` is replaced; others and repeated rows stay. Nothing is shuffled.
    """
    shared = _shared(docs.sparkSession, vocabulary)
    kept = [c for c in docs.columns if c != ids]
    at = kept.index(text)

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, _ = _coders(shared)
        for batch in batches:
            for first in range(0, batch.num_rows, _STEP):
                part = batch.slice(first, _STEP)
                found = [None if t is None else encoder.encode(t) for t in part.column(at).to_pylist()]
                yield pa.RecordBatch.from_arrays([*part.columns, _lists(found)], names=[*kept, ids])

    schema = docs.select(*[f"`{c}`" for c in kept]).schema.add(ids, T.ArrayType(T.IntegerType()))
    return docs.select(*[f"`{c}`" for c in kept]).mapInArrow(encoded, schema)


def decode_documents(docs: DataFrame, vocabulary: Vocabulary, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """``docs`` with the text of ``ids`` in column ``text``. Null ids give null, no ids an empty text."""
    shared = _shared(docs.sparkSession, vocabulary)
    kept = [c for c in docs.columns if c != text]
    at = kept.index(ids)

    def decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, decoder = _coders(shared)
        for batch in batches:
            for first in range(0, batch.num_rows, _STEP):
                part = batch.slice(first, _STEP)
                texts = [
                    decoder.decode(x.values.to_numpy(zero_copy_only=False)) if x.is_valid else None for x in part.column(at)
                ]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(texts, pa.string())], names=[*kept, text])

    schema = docs.select(*[f"`{c}`" for c in kept]).schema.add(text, "string")
    return docs.select(*[f"`{c}`" for c in kept]).mapInArrow(decoded, schema)


def round_trip(docs: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """Per row of ``docs(doc_id, text, ...)``: doc_id, n_ids, ids_sha256, restored.

    Encodes and decodes in one pass, so ids stay in the worker. ``ids_sha256`` is the digest of
    the ids as little-endian int32; ``restored`` tells whether decoding gave the text back (always,
    unless the text itself holds the space mark U+2581). A null text counts as empty.
    """
    shared = _shared(docs.sparkSession, vocabulary)

    def checked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, decoder = _coders(shared)
        for batch in batches:
            number, digest, same = [], [], []
            for text in batch.column("text"):
                text = text.as_py() or ""
                ids = encoder.encode(text)
                number.append(len(ids) // 4)
                digest.append(hashlib.sha256(ids).hexdigest())
                same.append(decoder.decode(np.frombuffer(ids, dtype="<i4")) == text)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(number, pa.int64()), pa.array(digest, pa.string()), pa.array(same, pa.bool_())],
                names=["doc_id", "n_ids", "ids_sha256", "restored"],
            )

    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return texts.mapInArrow(checked, "doc_id long, n_ids long, ids_sha256 string, restored boolean")
