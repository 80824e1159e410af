"""Drop lines that many documents share.

Lines are exploded under a 128-bit hash of their normalised key, distinct documents are counted per
hash with a map-side combine, keys over the threshold are joined back, and every document is put
together again by line position. A key that a third of all documents hold is one row per task in
the count, and its rows in the join are spread by Spark's own skew handling.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from ledgersieve.llm.words import SPACE_BYTES
from ledgersieve.sources.cut import cut

_DROP = "__repeated_keys"
_SIGN = 1 << 63


def _key(line: bytes, min_chars: int) -> bytes | None:
    """Digest of a line's key, or None when the key is too short to count."""
    key = line.strip(SPACE_BYTES)
    if len(key) < min_chars:
        return None
    if not key.isascii() and len(key.decode()) < min_chars:
        return None
    return xxhash.xxh3_128_digest(key.lower())  # bytes.lower() changes A-Z only


def _halves(digest: bytes) -> tuple[int, int]:
    return int.from_bytes(digest[:8], "little") - _SIGN, int.from_bytes(digest[8:], "little") - _SIGN


def line_dedup(
    docs: DataFrame, min_chars: int = 20, min_docs: int = 3, id_col: str = "doc_id", text_col: str = "text",
    stats: bool = True,
) -> DataFrame:
    """`docs` with repeated lines removed from its text; `stats` adds n_lines and n_dropped.

    Keys of at least `min_chars` code points held by at least `min_docs` documents lose all their
    lines except in the largest id that holds them. NULL and empty texts are one empty line and come
    back as the empty text. Rows that share an id count as one document. A row without an id is not
    counted and is never the one that keeps a line. All other columns pass through unchanged,
    whatever their names; with `stats`, input columns n_lines and n_dropped give way to the counts. An
    empty table gives an empty table.
    """
    if stats:
        docs = docs.drop("n_lines", "n_dropped")

    def explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts, first, second = [], [], [], []
            for key, text_hash, text in zip(*(batch[c].to_pylist() for c in ("id", "text_hash", "text"))):
                for digest in {_key(line, min_chars) for line in (text or "").encode().split(b"\n")} - {None}:
                    a, b = _halves(digest)
                    ids.append(key)
                    texts.append(text_hash)
                    first.append(a)
                    second.append(b)
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, batch["id"].type), *[pa.array(x, pa.int64()) for x in (texts, first, second)]],
                names=["id", "text_hash", "h1", "h2"])

    def rebuild(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, lines_of, dropped_of = [], [], []
            for text, keys in zip(batch[text_col].to_pylist(), batch[_DROP].to_pylist()):
                lines = (text or "").encode().split(b"\n")
                kept = lines
                if keys:
                    gone = {(k["h1"], k["h2"]) for k in keys}
                    kept = [x for x in lines if (d := _key(x, min_chars)) is None or _halves(d) not in gone]
                texts.append(b"\n".join(kept).decode())
                lines_of.append(len(lines))
                dropped_of.append(len(lines) - len(kept))
            columns = [pa.array(texts, pa.string()) if c == text_col else batch[c] for c in passed]
            if stats:
                columns += [pa.array(lines_of, pa.int64()), pa.array(dropped_of, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=[f.name for f in schema])

    passed = docs.columns
    id_type = docs.schema[id_col].dataType
    text_hash = F.xxhash64(F.col(text_col))
    pairs = docs.select(F.col(id_col).alias("id"), text_hash.alias("text_hash"), F.col(text_col).alias("text")).mapInArrow(
        explode, StructType([StructField("id", id_type), *[StructField(c, LongType()) for c in ("text_hash", "h1", "h2")]]))
    # Stored, so that Spark knows its size, and can split the rows of a hot key in the join.
    common = cut(
        pairs.groupBy("h1", "h2").agg(F.count_distinct("id").alias("n"), F.max("id").alias("keeper"))
        .where(F.col("n") >= min_docs), "lines")
    # By id and text, so that a list is no longer than one text, however many rows share an id or have none.
    repeated = (
        pairs.join(common, ["h1", "h2"]).where(~F.col("id").eqNullSafe(F.col("keeper")))
        .groupBy("id", "text_hash").agg(F.collect_set(F.struct("h1", "h2")).alias(_DROP))
        .withColumnsRenamed({"id": "__repeated_id", "text_hash": "__repeated_text"})
    )
    schema = StructType([*docs.schema.fields])
    if stats:
        schema = StructType([*schema.fields, StructField("n_lines", LongType()), StructField("n_dropped", LongType())])
    same = docs[id_col].eqNullSafe(repeated["__repeated_id"]) & (text_hash == repeated["__repeated_text"])
    joined = docs.join(repeated, same, "left").drop("__repeated_id", "__repeated_text")
    return joined.mapInArrow(rebuild, schema)
