"""Language identification with interpolated Kneser-Ney character models.

Four-grams of the normalised training text of every language are counted on all training rows, and
combined per task and per block of grams. The model keeps every counted gram, so it grows with the
distinct grams of the corpus, by the same rule at every size. Each order lives in sorted arrays of gram hashes with log
probabilities and back-off weights. A text gets the language with the least cross-entropy per
character; the score is calibrated on all training rows, with a rejection level per language.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgersieve.llm.words import mix, row_offsets, slices
from ledgersieve.operators.ranking import weighted_positions
from ledgersieve.sources.cut import cut

ORDER = 4
BLOCKS = 16
DISCOUNT = 0.75
# How sharply the score may fall with the distance of the languages.
SHARPNESS = (1.0, 2.0, 5.0, 10.0, 20.0, 50.0)
REJECT_SHARE = 0.001
UNKNOWN = "und"
_U = np.uint64
_SPACE = 32
_letter_table: np.ndarray | None = None


def _letters() -> np.ndarray:
    """Lower-case form of every letter, and a space for all else."""
    global _letter_table
    if _letter_table is None:
        table = np.full(sys.maxunicode + 1, _SPACE, np.uint32)
        for code in range(sys.maxunicode + 1):
            char = chr(code)
            if char.isalpha():
                lowered = char.lower()
                table[code] = ord(lowered) if len(lowered) == 1 else code
        _letter_table = table
    return _letter_table


def normalised(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of the texts, other runs folded into one space; every text with a letter ends and starts with one."""
    texts = [t or "" for t in texts]
    bounds = row_offsets(np.array([len(t) for t in texts], np.int64) + 1)
    codes = np.frombuffer(" ".join([*texts, ""]).encode("utf-32-le", "surrogatepass"), np.uint32)
    codes = _letters()[codes]
    gap = codes == _SPACE
    drop = gap.copy()
    drop[1:] &= gap[:-1]
    drop[bounds[:-1]] = gap[bounds[:-1]]
    kept = ~drop
    ends = np.concatenate([[0], np.cumsum(kept)])[bounds]
    return codes[kept], ends


def grams(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """The four-gram that ends at each character, oldest character highest, and the bounds of the texts.

    A character is 16 bits; those beyond are folded into them. A text starts after spaces.
    """
    codes, bounds = normalised(texts)
    small = (codes ^ (codes >> np.uint32(16)) * np.uint32(0x9E37)).astype(np.uint16).astype(np.uint64)
    position = np.arange(len(small)) - np.repeat(bounds[:-1], np.diff(bounds))
    out = small.copy()
    for back in range(1, ORDER):
        older = np.full(len(small), _SPACE, np.uint64)
        older[back:] = small[: len(small) - back]
        older[position < back] = _SPACE
        out |= older << _U(16 * back)
    return out, bounds


@dataclass
class Level:
    """One order: sorted hashes of seen grams with log probabilities, and of contexts with log back-off weights."""

    grams: np.ndarray
    logp: np.ndarray
    contexts: np.ndarray
    backoff: np.ndarray


def _sorted(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    hashed = mix(keys)
    order = np.argsort(hashed)
    return hashed[order], values[order].astype(np.float32)


def _find(keys: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Position of each wanted key in a sorted array, or -1."""
    if not len(keys):
        return np.full(len(wanted), -1)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return np.where(keys[at] == wanted, at, -1)


class KneserNey:
    """Interpolated Kneser-Ney over character grams given with their counts."""

    def __init__(self, codes: np.ndarray, counts: np.ndarray, discount: float = DISCOUNT):
        last = np.unique(codes & _U(0xFFFF))
        self.floor = -np.log(len(last) + 1)
        self.levels: list[Level] = []
        tables = [(codes, counts.astype(np.float64))]
        for order in range(ORDER - 1, 0, -1):  # lower orders count the distinct grams that extend them
            shorter, kinds = np.unique(tables[-1][0] & _U((1 << 16 * order) - 1), return_counts=True)
            tables.append((shorter, kinds.astype(np.float64)))
        for gram, count in reversed(tables):
            context, inverse = np.unique(gram >> _U(16), return_inverse=True)
            total = np.bincount(inverse, count)
            kinds = np.bincount(inverse)
            lower = np.exp(self._log(gram)) if self.levels else np.full(len(gram), np.exp(self.floor))
            weight = discount * kinds / total
            p = np.maximum(count - discount, 0) / total[inverse] + weight[inverse] * lower
            self.levels.append(Level(*_sorted(gram, np.log(p)), *_sorted(context, np.log(weight))))

    def _log(self, gram: np.ndarray) -> np.ndarray:
        """Log probability of the last character of each gram, by the levels there are."""
        value = np.full(len(gram), self.floor)
        for n, level in enumerate(self.levels, 1):
            whole = gram & _U((1 << 16 * n) - 1) if n < ORDER else gram
            context = _find(level.contexts, mix(whole >> _U(16)))
            value = np.where(context >= 0, value + level.backoff[context] if len(level.backoff) else value, value)
            seen = _find(level.grams, mix(whole))
            value = np.where(seen >= 0, level.logp[seen] if len(level.logp) else value, value)
        return value

    def log(self, gram: np.ndarray) -> np.ndarray:
        return self._log(gram).astype(np.float32)


@dataclass
class Model:
    """Language models, the sharpness of the score, and the cross-entropy beyond which a text is rejected."""

    languages: list[str]
    models: list[KneserNey]
    sharpness: float = 10.0
    limits: np.ndarray | None = None

    def entropies(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Cross-entropy per character of each text under each language, and the number of letters and spaces."""
        codes, bounds = grams(texts)
        out = np.zeros((len(texts), len(self.models)))
        counts = np.diff(bounds)
        full = np.flatnonzero(counts)
        if len(full):
            kinds, inverse = np.unique(codes, return_inverse=True)
            for k, model in enumerate(self.models):
                sums = np.add.reduceat(model.log(kinds)[inverse], bounds[full], dtype=np.float64)
                out[full, k] = -sums / counts[full]
        return out, counts

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray, np.ndarray]:
        entropy, counts = self.entropies(texts)
        if not self.models:
            return [UNKNOWN] * len(texts), np.zeros(len(texts)), np.ones(len(texts), bool)
        best = entropy.argmin(axis=1)
        least = entropy[np.arange(len(texts)), best]
        odds = np.exp(-self.sharpness * (entropy - least[:, None]))
        score = 1 / odds.sum(axis=1)
        rejected = (counts == 0) | (least > self.limits[best])
        score = np.where(counts == 0, 0.0, np.where(rejected, score / 2, score))
        names = [self.languages[b] if n else UNKNOWN for b, n in zip(best, counts)]
        return names, score, rejected


def count_grams(training: DataFrame) -> DataFrame:
    """(lang, block, grams, counts): four-gram counts of all rows of `training` (text, lang)."""
    schema = "lang string, block int, grams binary, counts binary"

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs = np.array(batch["lang"].to_pylist(), object)
            texts = batch["text"].to_pylist()
            rows = []
            for lang in sorted(set(langs.tolist())):
                own = pa.table({"text": pa.array([texts[i] for i in np.flatnonzero(langs == lang)], pa.string())})
                parts = [np.unique(grams(own["text"].slice(a, b - a).to_pylist())[0], return_counts=True)
                         for a, b in slices(own, "text", 1 << 23)]
                rows += [(lang, *x) for x in _blocks(parts)]
            yield _count_rows(rows)

    def add(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        parts = [(np.frombuffer(g, np.uint64), np.frombuffer(c, np.int64))
                 for g, c in zip(table["grams"].to_pylist(), table["counts"].to_pylist())]
        gram, count = _merge(parts)
        return pa.Table.from_batches([_count_rows([(key[0].as_py(), key[1].as_py(), gram, count)])])

    return training.select("text", "lang").mapInArrow(count, schema).groupBy("lang", "block").applyInArrow(add, schema)


def _merge(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    codes, counts = (np.concatenate(x) for x in zip(*parts))
    kinds, inverse = np.unique(codes, return_inverse=True)
    return kinds, np.bincount(inverse, counts, len(kinds)).astype(np.int64)


def _blocks(parts) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    gram, count = _merge(parts)
    block = (mix(gram) >> _U(32)) % _U(BLOCKS)
    for k in range(BLOCKS):
        if (block == k).any():
            yield k, gram[block == k], count[block == k]


def _count_rows(rows) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [[]] * 4
    return pa.RecordBatch.from_arrays(
        [pa.array(columns[0], pa.string()), pa.array(columns[1], pa.int32()),
         pa.array([x.tobytes() for x in columns[2]], pa.binary()), pa.array([x.tobytes() for x in columns[3]], pa.binary())],
        names=["lang", "block", "grams", "counts"])


def fit(training: DataFrame) -> Model:
    """Models of all languages in `training` (text, lang); rows without a language or text are left out."""
    training = training.where(F.col("lang").isNotNull() & (F.length("text") > 0))
    counted: dict[str, list] = {}
    for row in count_grams(training).toLocalIterator():
        counted.setdefault(row["lang"], []).append(
            (np.frombuffer(row["grams"], np.uint64), np.frombuffer(row["counts"], np.int64)))
    languages = sorted(counted)
    model = Model(languages, [KneserNey(*_merge(counted.pop(k))) for k in languages])
    return _calibrate(model, training)


def _calibrate(model: Model, training: DataFrame) -> Model:
    """The sharpness under which all training texts are most likely, and the level that all but a few of them stay below.

    A task sends one number per sharpness and, per text, its language and its cross-entropy under it.
    """
    model.limits = np.full(len(model.languages), np.inf)
    if not model.languages:
        return model
    shared = training.sparkSession.sparkContext.broadcast(model)
    place = {language: k for k, language in enumerate(model.languages)}

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            for a, b in slices(batch, "text", 1 << 23):
                entropy, counts = known.entropies(batch["text"].slice(a, b - a).to_pylist())
                true = np.array([place.get(x, -1) for x in batch["lang"].slice(a, b - a).to_pylist()], int)[counts > 0]  # -1 has no letter
                entropy = entropy[counts > 0]
                own = entropy[np.arange(len(true)), true]
                gap = entropy - entropy.min(axis=1, keepdims=True)
                loss = [_loss(gap, true, x) for x in SHARPNESS]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([*true, *[None] * len(loss)], pa.int32()), pa.array([*own, *[None] * len(loss)], pa.float64()),
                     pa.array([*[None] * len(true), *range(len(loss))], pa.int32()), pa.array([*[None] * len(true), *loss], pa.int64())],
                    names=["language", "entropy", "sharpness", "loss"])

    measured = cut(training.select("text", "lang").mapInArrow(
        measure, "language int, entropy double, sharpness int, loss bigint"), "entropies")
    total = {r["sharpness"]: r["loss"] for r in measured.where("sharpness IS NOT NULL").groupBy("sharpness").agg(F.sum("loss").alias("loss")).collect()}
    model.sharpness = SHARPNESS[min(range(len(SHARPNESS)), key=lambda i: total.get(i, 0))]
    for k, level in _levels(measured.where("language IS NOT NULL"), 1 - REJECT_SHARE).items():
        model.limits[k] = level * 1.1
    return model


def _loss(gap: np.ndarray, true: np.ndarray, sharpness: float) -> int:
    """Negative log likelihood of the true languages, in millionths: whole numbers add up alike in any order."""
    odds = np.exp(-sharpness * gap)
    each = -np.log(odds[np.arange(len(true)), true] / odds.sum(axis=1) + 1e-9)
    return int(np.rint(each * 1e6).astype(np.int64).sum())


def _levels(own: DataFrame, quantile: float) -> dict[int, float]:
    """The exact quantile of `entropy` per language, interpolated between the two ranks beside it."""
    counted = own.groupBy("language", "entropy").agg(F.count("*").alias("n"))
    rows = {r["language"]: r["n"] for r in own.groupBy("language").agg(F.count("*").alias("n")).collect()}  # one row per language
    ranks = [(k, int(np.floor((n - 1) * quantile))) for k, n in rows.items()]
    ranks += [(k, int(np.ceil((n - 1) * quantile))) for k, n in rows.items()]
    wanted = F.broadcast(own.sparkSession.createDataFrame(sorted(set(ranks)), "language int, rank bigint"))
    placed = weighted_positions(counted, ["language"], ["entropy"], "n")
    at = placed.join(wanted, "language").where((F.col("position") <= F.col("rank")) & (F.col("rank") < F.col("position") + F.col("n")))
    value = {(r["language"], r["rank"]): r["entropy"] for r in at.collect()}  # two rows per language
    levels = {}
    for k, n in rows.items():
        share = (n - 1) * quantile
        low, high = value[k, int(np.floor(share))], value[k, int(np.ceil(share))]
        levels[k] = low + (high - low) * (share - np.floor(share))
    return levels


def identify(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of `docs`: id, lang_pred, score (0 to 1), rejected.

    A text that is NULL or has no letter is `und` with score 0. A rejected text keeps its nearest
    language with half the score. Repeated rows get equal results. Other columns are not read. An
    empty table gives an empty table; without any training text every row is `und`.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # all distinct grams of the training texts and their contexts

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            for a, b in slices(batch, "text", 1 << 23):
                names, values, rejected = known.predict(batch["text"].slice(a, b - a).to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [batch["id"].slice(a, b - a), pa.array(names, pa.string()), pa.array(values, pa.float64()),
                     pa.array(rejected, pa.bool_())], names=[id_col, "lang_pred", "score", "rejected"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(
        score, f"`{id_col}` {kind}, lang_pred string, score double, rejected boolean")
