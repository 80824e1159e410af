"""Draw documents that look like a target, by importance weights over hashed word runs.

A document becomes its words with one space between them, and is scanned once: the running CRC-32 is
stored after every word. The CRC of any run of words follows from two stored values: the earlier one
is shifted by the run's length (multiplication by a power of x over GF(2)) and cancelled from the
later one. Runs are counted by CRC modulo the number of buckets, in the corpus and in the target; a
bucket's gain is the log ratio of both; a document's weight is the sum of its runs' gains; and
documents are drawn by weight plus seeded Gumbel noise, which is sampling without replacement.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from ledgersieve.llm.alnum import SPACED
from ledgersieve.llm.words import ranges, row_offsets, slices
from ledgersieve.operators.ranking import weighted_positions
from ledgersieve.operators.skew import unroll
from ledgersieve.sources.cut import cut

BUCKETS = 10_000
_POLY = 0xEDB88320
_U32 = np.uint32


def _byte_table() -> np.ndarray:
    """The CRC register after each byte value, from an empty register."""
    table = np.arange(256, dtype=_U32)
    for _ in range(8):
        table = np.where(table & 1, (table >> _U32(1)) ^ _U32(_POLY), table >> _U32(1))
    return table


_BYTE = _byte_table()


def _shift_tables() -> np.ndarray:
    """[k, b, v]: the register v << 8b after 2^k zero bytes; linear over GF(2), so four look-ups shift a register."""
    place = np.arange(256, dtype=_U32)[None, :] << (8 * np.arange(4, dtype=_U32))[:, None]
    tables = [(place >> _U32(8)) ^ _BYTE[place & _U32(255)]]
    for _ in range(31):
        tables.append(_apply(tables[-1], tables[-1]))
    return np.stack(tables)


def _apply(table: np.ndarray, register: np.ndarray) -> np.ndarray:
    return (table[0][register & _U32(255)] ^ table[1][(register >> _U32(8)) & _U32(255)]
            ^ table[2][(register >> _U32(16)) & _U32(255)] ^ table[3][register >> _U32(24)])


_SHIFTS = _shift_tables()


def shifted(crc: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Each register after `length` zero bytes."""
    crc, length = crc.copy(), length.astype(np.int64)
    for k in range(int(length.max(initial=0)).bit_length()):
        at = np.flatnonzero(length >> k & 1)
        crc[at] = _apply(_SHIFTS[k], crc[at])
    return crc


def substring_crc(later: np.ndarray, earlier: np.ndarray, length: np.ndarray) -> np.ndarray:
    """CRC-32 of the `length` bytes between two running CRC-32s of one text."""
    return later ^ shifted(earlier, length)


def running_crcs(text: bytes) -> tuple[list[int], list[int]]:
    """The running CRC-32 after each word of a text of words and spaces, words joined by one space, and its place there."""
    crcs, places = [], []
    crc, place, gap = 0, -1, b""
    for word in text.split():
        crc = zlib.crc32(gap + word, crc)
        place += 1 + len(word)
        crcs.append(crc)
        places.append(place)
        gap = b" "
    return crcs, places


def _after_space(crc: np.ndarray) -> np.ndarray:
    """The running CRC-32 one space later."""
    register = ~crc
    return ~((register >> _U32(8)) ^ _BYTE[(register ^ _U32(32)) & _U32(255)])


def run_crcs(texts: list[bytes], least: int, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """CRC-32 of every run of `least` to `most` words, text by text, and the runs and the words of each text."""
    crcs, ends, counts = [], [], []
    for text in texts:
        some, places = running_crcs(text.translate(SPACED))
        crcs += some
        ends += places
        counts.append(len(some))
    counts = np.array(counts, np.int64)
    crc, end = np.array(crcs, _U32), np.array(ends, np.int64)
    first = row_offsets(counts)[:-1]
    starts = np.zeros(len(crc), np.int64)
    before = np.zeros(len(crc), _U32)  # the running CRC-32 where the word begins; 0 at the beginning of a text
    starts[1:], before[1:] = end[:-1] + 1, _after_space(crc[:-1])
    begins = first[counts > 0]
    starts[begins], before[begins] = 0, 0
    found, owner = [], []
    for n in range(least, most + 1):
        runs = np.maximum(counts - n + 1, 0)
        at = ranges(first, runs)
        last = at + n - 1
        found.append(substring_crc(crc[last], before[at], end[last] - starts[at]))
        owner.append(np.repeat(np.arange(len(counts)), runs))
    owners = np.concatenate(owner)
    order = np.argsort(owners, kind="stable")
    return np.concatenate(found)[order], np.bincount(owners, minlength=len(counts)), counts


def _bytes_of(texts: pa.Array) -> list[bytes]:
    return [(t or "").encode() for t in texts.to_pylist()]


def count_buckets(docs: DataFrame, least: int = 1, most: int = 1, buckets: int = BUCKETS, text_col: str = "text") -> np.ndarray:
    """Runs per bucket over all texts. At most `buckets` rows per task are shuffled, and `buckets` reach the driver."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for a, b in slices(batch, "text"):
                crcs, _, _ = run_crcs(_bytes_of(batch["text"].slice(a, b - a)), least, most)
                total += np.bincount(crcs % _U32(buckets), minlength=buckets)
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(total[held])], names=["bucket", "n"])

    counted = docs.select(F.col(text_col).alias("text")).mapInArrow(count, "bucket bigint, n bigint")
    total = np.zeros(buckets, np.int64)
    for bucket, n in counted.groupBy("bucket").agg(F.sum("n")).collect():
        total[bucket] = n
    return total


def bucket_gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Per bucket floor(1000 * ln of the smoothed share in the target over that in the corpus)."""
    buckets = len(corpus)
    all_corpus, all_target = float(corpus.sum()) + buckets, float(target.sum()) + buckets
    return np.array([
        math.floor(1000 * math.log((t + 1) * all_corpus / ((s + 1) * all_target)))
        for s, t in zip(corpus.astype(float).tolist(), target.astype(float).tolist())], np.int64)


def noise(seed: int, key: Column) -> Column:
    """floor(-1000 * ln(-ln(u))) with u from the first 32 bits of sha256("seed:key")."""
    text = F.concat_ws(":", F.lit(str(seed)), F.coalesce(key.cast("string"), F.lit("")))
    u = (F.conv(F.substring(F.sha2(text, 256), 1, 8), 16, 10).cast("double") + 0.5) / F.lit(float(1 << 32))
    return F.floor(F.lit(-1000.0) * F.log(-F.log(u)))


def scores(
    docs: DataFrame, gains: np.ndarray, least: int = 1, most: int = 1, seed: int = 2024,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """One row per row of `docs`: id, text_hash, n_words, n_features, weight, score. A NULL text has no words."""
    buckets = len(gains)
    id_type = docs.schema[id_col].dataType
    long = LongType()
    schema = StructType([
        StructField(id_col, id_type), *[StructField(c, long) for c in ("text_hash", "n_words", "n_features", "weight")]])
    names = [f.name for f in schema]

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in slices(batch, "text"):
                part = batch.slice(a, b - a)
                crcs, counts, words = run_crcs(_bytes_of(part["text"]), least, most)
                ends = row_offsets(counts)
                summed = row_offsets(gains[crcs % _U32(buckets)])
                yield pa.RecordBatch.from_arrays([
                    part["id"], part["text_hash"], pa.array(words, pa.int64()), pa.array(counts, pa.int64()),
                    pa.array(summed[ends[1:]] - summed[ends[:-1]])], names=names)

    own = docs.select(
        F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.xxhash64(text_col).alias("text_hash"))
    weighed = own.mapInArrow(weigh, schema)
    return weighed.withColumn("score", F.col("weight") + noise(seed, F.col(id_col)))


def resample(
    docs: DataFrame, target: DataFrame, percent: int = 10, least_words: int = 20, least: int = 1, most: int = 1,
    buckets: int = BUCKETS, seed: int = 2024, id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """One row per row of `docs`: id, text_hash, n_words, n_features, weight, score, rank.

    Features are all runs of `least` to `most` words. Of the N rows with at least `least_words` words
    the floor(percent * N / 100) of highest score are drawn; ties go to the smaller id, a NULL id
    last, then to the smaller text hash. `rank` is 1, 2, 3, … in that order and NULL for rows that
    are not drawn. A NULL or empty text has no features and weight 0. Rows that share an id share
    their noise. Other columns are not read, whatever their names. An empty table gives an empty
    table, an empty target gains that are alike up to the corpus counts.
    """
    gains = bucket_gains(
        count_buckets(docs, least, most, buckets, text_col), count_buckets(target, least, most, buckets, text_col))
    # Stored: every text is read once for the counts and once for the weights, not again for the ranks.
    scored = cut(scores(docs, gains, least, most, seed, id_col, text_col), "scored")
    return ranked(scored, percent, least_words, id_col)


def ranked(scored: DataFrame, percent: int, least_words: int, id_col: str) -> DataFrame:
    """`scored` with `rank`. Rows are folded first, so that any number of equal rows is one row of the sort."""
    long_enough = F.coalesce(F.col("n_words") >= least_words, F.lit(False))
    drawn = scored.where(long_enough).count() * percent // 100
    columns = scored.columns
    order = ["_fall", id_col, "text_hash", *[c for c in columns if c not in (id_col, "text_hash")]]
    folded = scored.where(long_enough).withColumn("_fall", -F.col("score")).groupBy(*order).agg(F.count("*").alias("_n"))
    placed = weighted_positions(folded, [], order, "_n", "_before")
    placed = unroll(placed, F.col("_before"), F.col("_n"), "_rank", spread=True)
    rank = F.when(F.col("_rank") <= drawn, F.col("_rank")).alias("rank")
    return placed.select(*columns, rank).unionByName(
        scored.where(~long_enough).select(*columns, F.lit(None).cast("bigint").alias("rank")))


def drawn_documents(docs: DataFrame, ranking: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The drawn rows of `docs` with all their columns. Of equal ids and texts as many stay as were drawn."""
    per_key = ranking.groupBy(F.col(id_col).alias("_id"), F.col("text_hash").alias("_hash")).agg(
        F.count("rank").alias("_drawn"), F.count("*").alias("_all"))
    per_key = cut(per_key.where("_drawn > 0"), "drawn")
    text_hash = F.xxhash64(F.col(text_col))

    def holds(key: DataFrame) -> Column:
        return docs[id_col].eqNullSafe(key["_id"]) & (text_hash == key["_hash"])

    whole = per_key.where("_drawn = _all")
    parts = [docs.join(whole, holds(whole), "left_semi")]
    # Only the key at the limit can be drawn in part.
    for row in per_key.where("_drawn < _all").collect():
        same = docs.where(docs[id_col].eqNullSafe(F.lit(row["_id"])) & (text_hash == row["_hash"]))
        parts.append(same.limit(row["_drawn"]))
    return reduce(DataFrame.unionAll, parts)
