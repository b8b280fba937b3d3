"""Language identification in two steps: the family, then the language in it.

Features are hashed byte trigrams of the lower-cased letters of a whole text.
A linear support vector machine for each family against the rest picks the
family; within it, one-versus-one machines vote on the language.  The machines
are fitted by dual coordinate descent on a bounded sample of labelled rows.
At prediction a text costs one lookup a byte, with no matter how long it is
held against the sums of its trigrams' weights.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Families of common languages by ISO 639-1 code.  A language not named here is a family of its own.
FAMILIES = {
    "Germanic": ["en", "de", "nl", "sv", "da", "no", "is", "af"],
    "Romance": ["fr", "es", "it", "pt", "ro", "ca", "gl"],
    "Slavic": ["ru", "uk", "be", "bg", "mk", "sr", "hr", "sl", "cs", "sk", "pl"],
    "Uralic": ["fi", "et", "hu"],
}
_BITS = 13
#: Bytes other than ASCII letters and parts of longer code points become spaces.
_LETTERS = bytes(c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
#: Bytes of text worked on at a time, times classifiers.
_WORK = 1 << 23


def family_of(lang: str) -> str:
    return next((f for f, members in FAMILIES.items() if lang in members), lang)


def has_letter(text: str | None) -> bool:
    return text is not None and any(map(str.isalpha, text))


def letters_of(text: str) -> np.ndarray:
    """A text's bytes: lower-cased letters, all else a space, with a space before and two after."""
    return np.frombuffer(b" " + text.lower().encode().translate(_LETTERS) + b"  ", np.uint8)


def trigrams(b: np.ndarray) -> np.ndarray:
    """Bucket of each trigram of bytes."""
    b = b.astype(np.uint32)
    code = (b[:-2] << np.uint32(16)) | (b[1:-1] << np.uint32(8)) | b[2:]
    return (code * np.uint32(2654435761)) >> np.uint32(32 - _BITS)


def blocks(b: np.ndarray, size: int) -> Iterator[np.ndarray]:
    """Bytes in blocks of ``size`` trigrams: each carries two bytes over, so the blocks' trigrams are those of the whole."""
    return (b[at : at + size + 2] for at in range(0, len(b) - 2, size))


def counts(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Buckets and shares of a text's trigrams, added up in blocks."""
    total = np.zeros(1 << _BITS, np.int64)
    for part in blocks(letters_of(text), 1 << 20):
        total += np.bincount(trigrams(part), minlength=1 << _BITS)
    where = np.flatnonzero(total)
    return where, total[where] / total.sum()


def svm(where: list[np.ndarray], x: list[np.ndarray], y: np.ndarray, size: int, c: float = 1.0, epochs: int = 20) -> np.ndarray:
    """Weights of a linear support vector machine on rows of values x at places where, with y of +1 and -1."""
    norm = np.array([float(v @ v) for v in x]) + 1e-12
    cost = c * np.where(y > 0, len(y) / (2 * max(1, (y > 0).sum())), len(y) / (2 * max(1, (y < 0).sum())))
    w, alpha, rng = np.zeros(size, np.float32), np.zeros(len(y)), np.random.default_rng(0)
    for _ in range(epochs):
        most = 0.0
        for i in rng.permutation(len(y)):
            slope = y[i] * float(x[i] @ w[where[i]]) - 1
            now = min(max(alpha[i] - slope / norm[i], 0.0), cost[i])
            if abs(step := now - alpha[i]) > 1e-9:
                w[where[i]] += np.float32(step * y[i]) * x[i]
                alpha[i], most = now, max(most, abs(step) / cost[i])
        if most < 1e-3:
            break
    return w


class Model:
    """Families, languages and the weights of all machines, as columns of one matrix."""

    def __init__(self, rows: list[tuple[str, np.ndarray, np.ndarray]]) -> None:
        """rows: language, buckets and shares of each labelled text."""
        langs = sorted({r[0] for r in rows})
        self.families = {f: [x for x in langs if family_of(x) == f] for f in sorted({family_of(x) for x in langs})}
        size = 1 << _BITS
        total, squares = np.zeros(size), np.zeros(size)
        for _, where, share in rows:
            total[where] += share
            squares[where] += share.astype(np.float64) ** 2
        n = max(1, len(rows))
        scale = (1 / (np.sqrt(np.maximum(squares / n - (total / n) ** 2, 0)) + 1e-4)).astype(np.float32)
        unit = float(np.mean([np.linalg.norm(share * scale[where]) for _, where, share in rows])) if rows else 1.0
        at = [np.append(where, size) for _, where, _ in rows]
        x = [np.append(share * scale[where] / (unit or 1.0), 1).astype(np.float32) for _, where, share in rows]  # with a one for the bias
        lang = np.array([r[0] for r in rows])
        family = np.array([family_of(r[0]) for r in rows])
        columns = []
        if len(self.families) > 1:
            names = list(self.families)
            for f in names if len(names) > 2 else names[:1]:
                columns.append(svm(at, x, np.where(family == f, 1.0, -1.0), size + 1))
        self.pairs: dict[str, list[tuple[int, int, int]]] = {}
        for f, members in self.families.items():
            self.pairs[f] = []
            for (i, a), (j, b) in combinations(enumerate(members), 2):
                own = np.flatnonzero((lang == a) | (lang == b))
                self.pairs[f].append((i, j, len(columns)))
                columns.append(svm([at[k] for k in own], [x[k] for k in own], np.where(lang[own] == a, 1.0, -1.0), size + 1))
        w = np.array(columns, np.float32).reshape(-1, size + 1).T
        self.bias = w[-1].copy()
        self.weights = np.ascontiguousarray(w[:-1] * (scale[:, None] / (unit or 1.0)))

    def margins(self, texts: list[str], block: int | None = None) -> np.ndarray:
        """The machines' outputs for each text; texts are joined, and long ones cut into blocks of trigrams, for the lookup only."""
        k = self.weights.shape[1]
        sums, sizes = np.zeros((len(texts), k)), np.zeros(len(texts))
        block = block or max(1 << 16, _WORK // max(1, k))
        pending: list[np.ndarray] = []
        owners: list[int] = []

        def flush() -> None:
            if pending:
                starts = np.cumsum([0, *map(len, pending[:-1])])
                found = np.add.reduceat(self.weights[np.concatenate(pending)], starts, axis=0, dtype=np.float64)
                np.add.at(sums, owners, found)
                pending.clear(), owners.clear()

        held = 0
        for i, text in enumerate(texts):
            for part in blocks(letters_of(text), block):
                pending.append(trigrams(part))
                owners.append(i)
                sizes[i] += len(pending[-1])
                held += len(pending[-1])
                if held >= block:
                    flush()
                    held = 0
        flush()
        return sums / np.maximum(sizes, 1)[:, None] + self.bias

    def predict(self, texts: list[str]) -> list[tuple[str, float]]:
        if not self.families:
            return [("und", 0.0)] * len(texts)
        names, sure = list(self.families), lambda m: float(1 / (1 + np.exp(-2 * np.clip(m, -50, 50))))
        out = []
        for m in self.margins(texts):
            score, family = 1.0, names[0]
            if len(names) > 1:
                own = m[: len(names)] if len(names) > 2 else np.array([m[0], -m[0]])
                family, score = names[int(own.argmax())], sure(own.max())
            members = self.families[family]
            votes, sums = np.zeros(len(members)), np.zeros(len(members))
            for i, j, c in self.pairs[family]:
                votes[i if m[c] >= 0 else j] += 1
                sums[i] += m[c]
                sums[j] -= m[c]
            best = int(np.lexsort((-sums, -votes))[0])
            if len(members) > 1:
                score *= sure(sums[best] / (len(members) - 1))
            out.append((members[best], score))
        return out


def held_out(id_col: str = "doc_id", folds: int = 3, fold: int = 1) -> Column:
    """Whether a row is kept from learning; rows without an id are not."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % folds == fold, F.lit(False))


def fit(docs: DataFrame, learn: Column, lang_col: str = "lang", text_col: str = "text", id_col: str = "doc_id", per_language: int = 800) -> Model:
    """A model from about ``per_language`` rows of each language (all, where there are fewer).

    The rows are drawn by a hash of their id, with a rate for each language, so
    the draw is the same however the table is split.  Trigram counts are made
    on the executors, from whole texts; the driver gets at most 64 KB a row,
    ``per_language`` times as much a language, and keeps them sparse.
    """
    rows = docs.where(learn & F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    sizes = dict(rows.groupBy(lang_col).count().collect())
    if not sizes:
        return Model([])
    rate = F.create_map(*(F.lit(x) for kv in sizes.items() for x in (kv[0], min(1.0, per_language / kv[1]))))
    draw = F.pmod(F.xxhash64(F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.lit(17)), F.lit(1_000_000)) / 1_000_000
    drawn = rows.where(draw < rate[F.col(lang_col)]).select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [(lang, *counts(t)) for lang, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True) if has_letter(t)]
            cols = list(zip(*found, strict=True)) or [(), (), ()]
            kinds = (pa.string(), pa.list_(pa.int32()), pa.list_(pa.float32()))
            yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(cols, kinds, strict=True)], ["lang", "buckets", "shares"])

    got = drawn.mapInArrow(run, "lang string, buckets array<int>, shares array<float>").toArrow()
    got = got.combine_chunks()
    rows = [(lang, np.array(w.values), np.array(s.values)) for lang, w, s in zip(got["lang"].to_pylist(), got["buckets"], got["shares"], strict=True)]
    return Model(sorted(rows, key=lambda r: (r[0], r[1].tobytes(), r[2].tobytes())))


def identify(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, lang_pred, score)`` for each row, from its whole text alone.

    A null text, one without a letter, and any text under a model that saw no
    rows, gives ``und`` with score 0.  Repeated rows get equal answers; a tie of
    votes goes to the larger sum of margins, then to the first in the alphabet.
    Long texts are read whole, in blocks; other columns are not read.  An empty
    table gives an empty result.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column(1).to_pylist()
            known = [i for i, t in enumerate(texts) if has_letter(t)]
            lang, score = ["und"] * len(texts), [0.0] * len(texts)
            for i, (a, s) in zip(known, model.predict([texts[i] for i in known]), strict=True):
                lang[i], score[i] = a, s
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(lang, pa.string()), pa.array(score, pa.float64())], ["id", "lang_pred", "score"])

    return rows.mapInArrow(run, rows.select("id").schema.add("lang_pred", "string").add("score", "double"))
