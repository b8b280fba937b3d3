"""Benchmark decontamination: BM25 retrieval with block-max bounds, then verification.

The benchmark is the indexed side and every passage of every document is a
query.  An item's impacts are divided by the score that the item's own text
would get, so a passage scores the share of the item that it covers, from 0 to
1.  Passages are two cells of words next to each other, so an item lies whole
in at least one.  As in WAND, a passage is first held against the sum of its
terms' largest impacts, then against the sums of their largest impacts in each
block of items; exact scores are made only from the postings of blocks that may still reach the
threshold, so no item at or over it is lost.  A retrieved pair counts as a leak
if five-word shingles of both the item's question and its answer are in the
passage.  A question of fewer words, and an item of two to four words, has to
be there as a sequence of its own length; a single word is a leak only where it
is the whole passage.

Items go by length into classes with cells of 64, 128, 256 ... words.  An index
holds at most ``block_items`` items of at most ``block_words`` words together
(a longer item alone); a larger benchmark is worked through in such blocks, one
after the other.  Document frequencies and the mean length are those of the
whole benchmark, so a score is the same however the benchmark is cut.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from .store import cut, discard

_WORD = re.compile(r"\w+")
#: Items whose largest impacts are kept as one bound, and sums of bounds that are made at a time.
_BLOCK, _WORK = 8, 1 << 23
_SHINGLE = 5


def words_of(text: str | None) -> list[str]:
    return _WORD.findall((text or "").lower())


def question_and_answer(text: str) -> tuple[list[str], list[str]]:
    """An item's words up to its first question mark and after; without one, the first two thirds and the rest."""
    ask, mark, reply = text.partition("?")
    question, answer = words_of(ask), words_of(reply)
    if not (mark and question and answer):
        words = words_of(text)
        k = -(-2 * len(words) // 3)
        question, answer = words[:k], words[k:]
    return question, answer


def shingles(words: list[str], width: int = _SHINGLE) -> set[tuple[str, ...]]:
    return {tuple(words[i : i + width]) for i in range(max(1, len(words) - width + 1))} if words else set()


def _width(part: list[str], item: list[str]) -> int:
    """Words in a part's shingles: a short part is one sequence; an item that is a single word is no sequence."""
    return min(_SHINGLE, len(part)) if len(item) > 1 else _SHINGLE


def _spread(first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The numbers first, first + 1, ... of each of several ranges, one after the other."""
    return np.repeat(first - np.cumsum(size) + size, size) + np.arange(size.sum())


class Statistics:
    """What BM25 knows of the whole benchmark: how many items, their mean length, and how many hold each word (of those asked for)."""

    def __init__(self, items: int, mean: float, held_by: dict[str, int]) -> None:
        self.items, self.mean, self.held_by = items, mean, held_by

    @classmethod
    def of(cls, texts: list[str | None]) -> Statistics:
        words = [w for w in map(words_of, texts) if w]
        return cls(len(words), sum(map(len, words)) / max(1, len(words)), Counter(chain.from_iterable(map(set, words))))


class Index:
    """An inverted index of items ``(key, text)`` with at most ``cell`` words each; postings of a word stand in the order of items.

    Consecutive items form blocks.  A word's postings in one block are a run,
    of which the largest impact is kept.
    """

    def __init__(self, items: list[tuple], cell: int, whole: Statistics, k1: float = 1.2, b: float = 0.75) -> None:
        self.cell, self.keys = cell, [k for k, _ in items]
        words = [words_of(t) for _, t in items]
        self.vocabulary: dict[str, int] = {w: i for i, w in enumerate(sorted(set(chain.from_iterable(words))))}
        v = len(self.vocabulary)
        df = np.fromiter((whole.held_by[w] for w in self.vocabulary), np.float64, v)
        idf = np.log1p((whole.items - df + 0.5) / (df + 0.5))
        term, item, impact = [], [], []
        for i, ws in enumerate(words):
            t, count = np.unique([self.vocabulary[x] for x in ws], return_counts=True)
            x = idf[t] * count * (k1 + 1) / (count + k1 * (1 - b + b * len(ws) / whole.mean))
            term.append(t), item.append(np.full(len(t), i)), impact.append(x / x.sum())
        terms, items_, impacts = (np.concatenate(c) for c in (term, item, impact))
        order = np.lexsort((items_, terms))
        terms, self.items, self.impacts = terms[order], items_[order], impacts[order]
        run = terms * (len(items) // _BLOCK + 1) + self.items // _BLOCK
        self.run_at = np.flatnonzero(np.r_[True, run[1:] != run[:-1]])  # first posting of each run
        self.run_size = np.diff(np.r_[self.run_at, len(run)])
        self.run_block = self.items[self.run_at] // _BLOCK
        self.run_most = np.maximum.reduceat(self.impacts, self.run_at)
        self.runs = np.bincount(terms[self.run_at], minlength=v)  # of each word
        self.first_run = np.cumsum(self.runs) - self.runs
        self.most = np.maximum.reduceat(self.run_most, self.first_run)
        self.parts = []
        for (_, text), own in zip(items, words, strict=True):
            question, answer = question_and_answer(text)
            if len(answer) < _SHINGLE:  # too short to be told from chance: with what stands before it
                answer = own[-_SHINGLE:]
            self.parts.append(tuple((w := _width(part, own), shingles(part, w)) for part in (question, answer)))

    def search(self, texts: list[list[str]], least: float) -> Iterator[tuple[int, int, int, float]]:
        """(text, first word, item, score) of every passage and item that score ``least`` or more."""
        get, cell, v, least = self.vocabulary.get, self.cell, len(self.vocabulary), least - 1e-9
        sizes = np.array([max(1, -(-len(t) // cell) - 1) for t in texts])  # passages of each text
        first = np.cumsum([0, *sizes])
        ids = np.fromiter(map(get, chain.from_iterable(texts), repeat(-1)), np.int64, sum(map(len, texts)))
        lengths = np.array([len(t) for t in texts])
        text = np.repeat(np.arange(len(texts)), lengths)
        at = (np.arange(len(ids)) - np.repeat(np.cumsum(lengths) - lengths, lengths)) // cell
        text, at, ids = text[ids >= 0], at[ids >= 0], ids[ids >= 0]
        left, right = at > 0, at < sizes[text]  # a cell is the second of one passage and the first of the next
        key = np.concatenate([((first[text] + at - 1) * v + ids)[left], ((first[text] + at) * v + ids)[right]])
        key = np.unique(key)
        passage, term = key // v, key % v
        own = (np.bincount(passage, self.most[term], first[-1]) >= least)[passage]
        passage, term = passage[own], term[own]
        blocks = int(self.run_block.max()) + 1
        for s, e, starts in self._runs(passage, max(blocks, int(self.runs.max()))):
            number = np.repeat(np.arange(len(starts)), np.diff([*starts, e - s]))
            n = self.runs[term[s:e]]
            run = _spread(self.first_run[term[s:e]], n)  # runs of the passages' words
            pair = np.repeat(number, n) * blocks + self.run_block[run]  # passage and block
            own = (np.bincount(pair, self.run_most[run], len(starts) * blocks) >= least)[pair]
            run, number = run[own], pair[own] // blocks
            n = self.run_size[run]
            posting = _spread(self.run_at[run], n)
            pair, where = np.unique(np.repeat(number, n) * len(self.keys) + self.items[posting], return_inverse=True)
            score = np.bincount(where, self.impacts[posting], len(pair))
            for x, y in zip(pair[score >= least].tolist(), score[score >= least].tolist(), strict=True):
                p = int(passage[s + starts[x // len(self.keys)]])
                t = int(np.searchsorted(first, p, "right")) - 1
                yield t, (p - int(first[t])) * cell, x % len(self.keys), y

    @staticmethod
    def _runs(passage: np.ndarray, width: int) -> Iterator[tuple[int, int, np.ndarray]]:
        """Sorted passages in runs of whole ones, of bounded rows times width: (from, to, starts of the passages)."""
        starts = np.flatnonzero(np.r_[True, passage[1:] != passage[:-1]]) if len(passage) else passage
        ends = np.append(starts[1:], len(passage))
        step, lo = max(1, _WORK // width), 0
        while lo < len(starts):
            hi = max(lo + 1, int(np.searchsorted(ends, starts[lo] + step, "right")))
            yield int(starts[lo]), int(ends[hi - 1]), starts[lo:hi] - starts[lo]
            lo = hi

    def leaks(self, texts: list[list[str]], least: float, overlap: float) -> dict[tuple[int, int], tuple]:
        """(text, item) to the best passage's (score, question overlap, answer overlap, first word)."""
        found: dict[tuple[int, int], tuple] = {}
        for text, start, i, score in self.search(texts, least):
            words = texts[text][start : start + 2 * self.cell]
            asked, answered = (len(part & shingles(words, width)) / max(1, len(part)) for width, part in self.parts[i])
            if asked >= overlap and answered >= overlap:
                found[text, i] = max(found.get((text, i), (-1.0,)), (score, asked, answered, -start))
        return found


def _words(items: DataFrame) -> DataFrame:
    """``(word, n)``: the distinct words of each row of ``items(text)``, and with a null word the number of all its words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [words_of(t) for t in b.column(0).to_pylist()]
            found = [(w, 1) for ws in rows for w in set(ws)] + [(None, len(ws)) for ws in rows if ws]
            yield pa.RecordBatch.from_arrays([pa.array([w for w, _ in found], pa.string()), pa.array([n for _, n in found], pa.int64())], ["word", "n"])

    return items.mapInArrow(run, "word string, n long")


def indexes(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text", block_items: int = 2048, block_words: int = 1 << 20) -> Iterator[list[Index]]:
    """Lists of indexes, each list over one bounded block of the benchmark, made as they are asked for.

    Items without a word are no items.  The driver gets a block's items and the
    frequencies of the words in them.
    """
    items = benchmark.select(F.col(id_col).alias("key"), F.col(text_col).cast("string").alias("text"))
    counted = _words(items.select("text")).groupBy("word").agg(F.sum("n").alias("n"), F.count("*").alias("items"))
    counted = cut(counted, "words")
    count, total = counted.where("word IS NULL").agg(F.coalesce(F.sum("items"), F.lit(0)), F.coalesce(F.sum("n"), F.lit(0))).first()
    blocks = max(1, -(-count // block_items), -(-total // block_words))
    for k in range(blocks) if count else ():
        own = items.where(F.pmod(F.xxhash64("key", "text"), F.lit(blocks)) == k)
        held = counted if blocks == 1 else counted.join(_words(own.select("text")).select("word").distinct(), "word", "left_semi")
        whole = Statistics(count, total / count, dict(held.where("word IS NOT NULL").select("word", "n").collect()))
        classes: dict[int, list[tuple]] = {}
        for key, text in sorted(map(tuple, own.collect()), key=lambda r: (r[0] is None, r[0], r[1] or "")):
            if n := len(words_of(text)):
                classes.setdefault(max(64, 1 << (n - 1).bit_length()), []).append((key, text))
        if classes:
            yield [Index(some, cell, whole) for cell, some in sorted(classes.items())]
    discard(counted)


def _in_chunks(texts: list[str | None], most: int = 1 << 22) -> Iterator[tuple[int, list[list[str]]]]:
    """The texts' words, in runs of about ``most`` characters: (number of the first, words of each)."""
    at = size = 0
    run: list[list[str]] = []
    for i, t in enumerate(texts):
        run.append(words_of(t))
        size += len(t or "")
        if size >= most or i + 1 == len(texts):
            yield at, run
            at, size, run = i + 1, 0, []


def find(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: float = 0.5, overlap: float = 0.8, **kw) -> DataFrame:
    """A row for each document row and item that leaks into it: ``(id, item_id, score, question_overlap, answer_overlap, first_word)``.

    The best passage speaks for a pair, of equal ones the first.  Null and empty
    texts have no words and no leaks; repeated documents and items each give
    their rows; an empty benchmark or table gives none.  Only ids and texts are
    read, so other columns can't clash.  Memory holds a run of texts of about
    four million characters (a longer text alone) and one block's index.  There
    is no shuffle.  With several blocks each one's findings are written, so that
    driver and executors hold one index at a time.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    item = benchmark.select(F.col(kw.get("id_col", "item_id")).alias("item_id")).schema
    schema = rows.select("id").schema.add(item[0])
    for name, kind in (("score", "double"), ("question_overlap", "double"), ("answer_overlap", "double"), ("first_word", "long")):
        schema = schema.add(name, kind)
    kinds = to_arrow_schema(schema)

    def against(block: list[Index]) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                ids, found = b.column(0).to_pylist(), []
                for at, texts in _in_chunks(b.column(1).to_pylist()):
                    for index in block:
                        for (i, k), (score, asked, answered, start) in index.leaks(texts, least, overlap).items():
                            found.append({"id": ids[at + i], "item_id": index.keys[k], "score": score, "question_overlap": asked, "answer_overlap": answered, "first_word": -start})
                if found:
                    yield pa.RecordBatch.from_pylist(found, kinds)

        return rows.mapInArrow(run, schema)

    out = last = None
    for block in indexes(benchmark, **kw):
        if last is not None:
            part = cut(last, "leaks")
            out = part if out is None else out.union(part)
        last = against(block)
    if last is None:
        return docs.sparkSession.createDataFrame([], schema)
    return last if out is None else out.union(last)


def clean(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", least: float = 0.5, overlap: float = 0.8, **kw) -> DataFrame:
    """The rows of ``docs`` into which no item leaks, with all their columns.

    Rows without a word stay, and so do all rows where the benchmark has no
    item.  Repeated rows are judged alike.  One block is one pass; with several
    what is left after each is written, so that one index is held at a time.
    """
    at_col, before = docs.columns.index(text_col), None

    def against(rows: DataFrame, block: list[Index]) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                keep = np.ones(b.num_rows, bool)
                for at, texts in _in_chunks(b.column(at_col).to_pylist()):
                    for index in block:
                        for i, _ in index.leaks(texts, least, overlap):
                            keep[at + i] = False
                yield b.filter(pa.array(keep))

        return rows.mapInArrow(run, rows.schema)

    pending = None
    for block in indexes(benchmark, **kw):
        if pending is not None:
            docs = cut(against(docs, pending), "clean")
            if before is not None:
                discard(before)
            before = docs
        pending = block
    return docs if pending is None else against(docs, pending)
