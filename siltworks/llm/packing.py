"""Packing of tokenized documents into fixed-length sequences, as vector bins.

A sequence has three limits at once: tokens, segments (pieces) and tokens that
bear loss.  A partition is packed in one pass, so there is no shuffle, and a
lost task repeats itself exactly.  Whole sequences are cut off long documents;
what is left of them goes to a bounded pool.  The open sequence takes from the
pool the piece whose demand has the largest dot product with the room that is
left, both as shares of the limits.  When nothing fits whole, a piece is cut
to fill the sequence.  The last sequence of a partition is cut at powers of
two, so that nothing is padded.
"""

from __future__ import annotations

import re
import struct
import sys
import types
import zlib
from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType

#: Distinct words whose ids a Python worker keeps.
_WORDS = 1_000_000
#: Letters with one Unicode form and a lower case of one character, then common marks: two pre-tokens.
_PLAIN = re.compile("([A-Za-zÀ-ÖØ-öø-ÿ]+)([.,;:!?]*)")
SCHEMA = "start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, loss_tokens long"


def _kept() -> types.ModuleType:
    """What a Python worker keeps from task to task."""
    return sys.modules.setdefault("_siltworks_worker", types.ModuleType("_siltworks_worker"))


def word_ids(tokenizer_path: str):
    """A function from UTF-8 bytes to little-endian uint32 ids, without special tokens.

    Where the tokenizer lower-cases, splits at white space and drops it, a
    text's ids are its words' ids in a row, so each distinct word is tokenized
    once.  With any other tokenizer each text is tokenized whole.
    """
    from tokenizers import Tokenizer

    class Words(dict):
        def __missing__(self, word: bytes) -> bytes:
            text = word.decode()
            plain = _PLAIN.fullmatch(text) if len(word) <= 64 else None
            if plain and (plain[2] or not text.islower()):
                found = self[plain[1].lower().encode()] + (self[plain[2].encode()] if plain[2] else b"")
            else:
                ids = tokenizer.encode(text, add_special_tokens=False).ids
                found = struct.pack(f"<{len(ids)}I", *ids)
            if len(word) <= 64:
                if len(self) >= _WORDS:
                    self.clear()
                self[word] = found
            return found

    kept = _kept().__dict__
    if ("words", tokenizer_path) not in kept:
        tokenizer = Tokenizer.from_file(tokenizer_path)
        kept["words", tokenizer_path] = Words(), _by_words(tokenizer), tokenizer
    words, apart, tokenizer = kept["words", tokenizer_path]
    if apart:
        return lambda text: b"".join(map(words.__getitem__, text.split()))
    return lambda text: struct.pack(f"<{len(ids := tokenizer.encode(text.decode(), add_special_tokens=False).ids)}I", *ids)


def _by_words(tokenizer) -> bool:
    """Whether a tokenizer treats words apart, in any case and between any ASCII white space, and letters and marks apart."""
    encode = lambda text: tokenizer.encode(text, add_special_tokens=False).ids
    words = ["Hello", "wORLD,", "don't", "ÉTÉ", "12", "(x)", "the"]
    alone = [i for w in words for i in encode(w)]
    whole = all(encode(f"{edge}{space.join(words)}{edge}") == alone for edge in ("", " ", "\n") for space in (" ", "\n", "\t ", "\r\n", "\x0b\x0c"))
    return whole and encode("Été,") == encode("été") + encode(",")


class Packer:
    """Packs documents as they come; ``out`` gets (key, start, length, crc, tokens, sequence, offset, loss, ids).

    A piece is (key, its ids, start, prompt, tokens): what it holds of its
    document's ids, from which on, how many of those bear no loss, and how many
    there are.
    """

    def __init__(self, first_sequence: int, capacity: int, max_segments: int, max_loss: int, pool: int) -> None:
        self.limits = np.array([capacity, max_segments, max_loss], float)
        self.sequence, self.pool_size = first_sequence, pool
        self.pool: list[tuple] = []
        self.out: list[tuple] = []
        self.open: list[tuple] = []
        self.room = self.limits.copy()

    def add(self, key, ids: bytes, prompt: int = 0) -> None:
        """A document's ids; its first ``prompt`` ids bear no loss."""
        tokens, at, cap = len(ids) // 4, 0, int(min(self.limits[0], self.limits[2]))
        while tokens - at >= cap:
            self._emit([(key, ids[4 * at : 4 * (at + cap)], at, prompt, tokens)])
            at += cap
        if at < tokens:
            self.pool.append((key, ids[4 * at :], at, prompt, tokens))
        if len(self.pool) >= self.pool_size:
            self._drain(self.pool_size // 2)

    def finish(self) -> None:
        self._drain(0)
        left, self.open = deque(self.open), []
        total = sum(map(self._length, left))
        while total:
            size, part = 1 << (total.bit_length() - 1), []
            total -= size
            while size:
                piece, rest = self._cut(left.popleft(), size)
                part.append(piece)
                if rest:
                    left.appendleft(rest)
                size -= self._length(piece)
            self._emit(part)

    @staticmethod
    def _length(piece: tuple) -> int:
        return len(piece[1]) // 4

    @staticmethod
    def _cut(piece: tuple, size: int) -> tuple[tuple, tuple | None]:
        """A piece's first ``size`` ids, and the rest."""
        key, ids, start, prompt, tokens = piece
        if len(ids) <= 4 * size:
            return piece, None
        return (key, ids[: 4 * size], start, prompt, tokens), (key, ids[4 * size :], start + size, prompt, tokens)

    def _need(self, piece: tuple) -> tuple[int, int, int]:
        _, ids, start, prompt, _ = piece
        n = len(ids) // 4
        return n, 1, max(0, start + n - max(start, prompt))

    def _emit(self, pieces: list[tuple]) -> None:
        offset = 0
        for p in pieces:
            key, ids, start, _, tokens = p
            n, _, loss = self._need(p)
            self.out.append((key, start, n, zlib.crc32(ids), tokens, self.sequence, offset, loss, ids))
            offset += n
        self.sequence += 1

    def _close(self) -> None:
        self._emit(self.open)
        self.open, self.room = [], self.limits.copy()

    def _place(self, piece: tuple) -> None:
        self.open.append(piece)
        self.room -= self._need(piece)
        if (self.room < 1).any():
            self._close()

    def _drain(self, keep: int) -> None:
        """Place pieces until ``keep`` are left in the pool."""
        pool, need = self.pool, np.array([self._need(p) for p in self.pool], float).reshape(-1, 3)
        alive, left = np.ones(len(pool), bool), len(pool)
        while left > keep:
            fits = alive & (need <= self.room).all(1)
            if fits.any():
                score = np.where(fits, need / self.limits @ (self.room / self.limits), -1.0)
                i = int(score.argmax())
                alive[i], left = False, left - 1
                self._place(pool[i])
                continue
            i = int(np.where(alive, need[:, 0], -1).argmax())
            _, _, start, prompt, _ = pool[i]
            piece, pool[i] = self._cut(pool[i], int(min(self.room[0], max(0, prompt - start) + self.room[2])))
            self._place(piece)
            need[i] = self._need(pool[i])
        self.pool = [p for p, a in zip(pool, alive, strict=True) if a]


def pack(
    docs: DataFrame,
    tokenizer_path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    prompt: Column | None = None,
    end_id: int = 2,
    capacity: int = 4096,
    max_segments: int | None = None,
    max_loss: int | None = None,
    pool: int = 256,
    with_ids: bool = False,
) -> DataFrame:
    """Pieces of documents with their places: ``(id, start, length, ids_crc32, doc_tokens, sequence_id, offset, loss_tokens)``.

    A document is the ids of ``prompt`` (no loss; for instruction data), those
    of its text and ``end_id``.  A null text or prompt is empty, so every row
    has at least one id.  Repeated rows, and rows without an id, are packed as
    often as they come; of pieces with equal scores the first that came goes
    first.  An empty table gives no pieces.  Other columns are not read.  A
    sequence holds at most ``capacity`` tokens, ``max_segments`` pieces and
    ``max_loss`` tokens that bear loss; both are ``capacity`` where not given,
    so that texts of one token still fill a sequence.  The last sequences of a
    partition are cut at powers of two.  ``sequence_id`` is the partition's
    number times 2**40 plus a count.  ``with_ids`` adds ``ids``, a piece's token
    ids, of which the last ``loss_tokens`` bear loss: this is training data.
    Memory per task: an Arrow batch with its pieces, a long text's ids, and
    ``pool`` pieces of at most ``capacity`` ids.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("binary"), (F.lit(None) if prompt is None else prompt).cast("string").cast("binary").alias("p"))
    schema = rows.select("id").schema
    for field in SCHEMA.split(", "):
        schema = schema.add(*field.split())
    if with_ids:
        schema = schema.add("ids", ArrayType(IntegerType()))
    end = struct.pack("<I", end_id)
    max_loss, max_segments = max_loss or capacity, max_segments or capacity

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = word_ids(tokenizer_path)
        packer = Packer(TaskContext.get().partitionId() << 40, capacity, max_segments, max_loss, pool)
        kind = None
        for b in batches:
            kind = b.column(0).type
            for key, text, ahead in zip(b.column(0).to_pylist(), b.column(1), b.column(2), strict=True):
                first = ids(ahead.as_py() or b"")
                packer.add(key, first + ids(text.as_py() or b"") + end, len(first) // 4)
            yield _batch(packer, kind)
        packer.finish()
        if kind is not None:
            yield _batch(packer, kind)

    def _batch(packer: Packer, kind: pa.DataType) -> pa.RecordBatch:
        *cols, ids = list(zip(*packer.out, strict=True)) or [()] * 9
        packer.out = []
        arrays = [pa.array(c, t) for c, t in zip(cols, [kind] + [pa.int64()] * 7, strict=True)]
        if with_ids:
            arrays.append(pa.array([np.frombuffer(x, "<i4") for x in ids], pa.list_(pa.int32())))
        return pa.RecordBatch.from_arrays(arrays, schema.names)

    return rows.mapInArrow(run, schema)
