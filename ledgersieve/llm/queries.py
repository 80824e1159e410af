"""One query per operator, over whole tables."""

from __future__ import annotations

import re

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgersieve.llm import line_dedup as lines
from ledgersieve.llm import (
    decontam_lsa, html_mss, langid, license_markup, outlier_rules, packing, quality_mil, resampling, rlz_dedup,
    secret_ledger, simhash, whitening,
)
from ledgersieve.llm.license_templates import TEMPLATES
from ledgersieve.sources.cut import new_folder


def _docs(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet").select(*(columns or ("doc_id", "text")))


def _remainder(n: int):
    """crc32 of the id as text, modulo n."""
    return F.crc32(F.col("doc_id").cast("string")) % n


def op1_quality_mil(spark, sf_dir):
    docs = _docs(spark, sf_dir)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").where(_remainder(5) != 0)
    model = quality_mil.fit(docs, labels.select(F.col("doc_id").alias("id"), F.col("quality").alias("label")))
    return quality_mil.score(docs, model).select(
        "doc_id", (_remainder(5) == 0).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op2_html_mss(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html")
    found = html_mss.extract(pages, html_mss.fit(pages))
    return found.select("page_id", "url", "text", F.length("text").cast("bigint").alias("n_chars"))


def op3_rlz_dedup(spark, sf_dir):
    parsed = rlz_dedup.rlz_dedup(_docs(spark, sf_dir))
    return parsed.select("doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


def op4_line_dedup(spark, sf_dir):
    kept = lines.line_dedup(_docs(spark, sf_dir))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def op5_packing(spark, sf_dir):
    pieces = packing.pack(_docs(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"))
    return pieces.select(
        "doc_id", "start", "length", F.crc32("input_ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset",
        "sequence_tokens", "step_id")


def op6_langid(spark, sf_dir):
    docs = _docs(spark, sf_dir, "doc_id", "text", "lang")
    model = langid.fit(docs.where(_remainder(4) != 2).withColumnRenamed("doc_id", "id"))
    return langid.identify(docs, model).select(
        "doc_id", (_remainder(4) == 2).alias("held_out"), "lang_pred", "score", "rejected")


def op7_simhash(spark, sf_dir):
    found = simhash.near_duplicates(_docs(spark, sf_dir))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id")


def op8_decontam_lsa(spark, sf_dir):
    hits = decontam_lsa.find_items(_docs(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return hits.withColumnRenamed("id", "doc_id").drop("text_hash")


def op9_outlier_rules(spark, sf_dir):
    judged = outlier_rules.quality_rules(_docs(spark, sf_dir, "doc_id", "text", "lang", "source"))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "distance")


def op10_secret_ledger(spark, sf_dir):
    found = secret_ledger.scan(_docs(spark, sf_dir), new_folder(spark, "secret-ledger"))
    kinds = {k: f"size(filter(findings, x -> x.kind = '{k}'))" for k in secret_ledger.BASE}
    listed = "array_join(transform({0}, x -> concat_ws(':', x.kind, x.start, x.end)), ',')"
    base = f"filter(findings, x -> x.kind in {secret_ledger.BASE})"
    return found.selectExpr(
        "doc_id", *[f"cast({e} as bigint) as n_{k}" for k, e in kinds.items()],
        f"sha2({listed.format(base)}, 256) as base_sha256", f"{listed.format('findings')} as spans")


def op11_license_markup(spark, sf_dir):
    found = license_markup.scan(_docs(spark, sf_dir))
    starts = "transform(phrases, x -> x.start)"
    return found.selectExpr(
        "doc_id", "n_words", "cast(size(phrases) as bigint) as n_base", f"array_min({starts}) as first_word",
        f"array_max({starts}) as last_word",
        "array_join(array_sort(array_distinct(transform(phrases, x -> x.label))), ',') as base_labels",
        "array_join(labels, ',') as labels", "score")


def op12_cholesky_whitening(spark, sf_dir):
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding")
    rows, model = whitening.whiten(vectors)
    explained = F.array(*[F.lit(float(x)) for x in model.explained])
    return rows.select("vec_id", "deviation", F.posexplode("whitened").alias("place", "whitened")).select(
        "vec_id", (F.col("place") + 1).alias("component"), F.lit(model.n).cast("bigint").alias("n"), "deviation",
        "whitened", F.element_at(explained, F.col("place") + 1).alias("explained"),
        F.lit(model.identity_error).alias("identity_error"))


def op13_target_resampling(spark, sf_dir):
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("text")
    return resampling.resample(_docs(spark, sf_dir), benchmark).select("doc_id", "n_features", "weight", "score", "rank")


QUERIES = {
    "op1_quality_mil": op1_quality_mil,
    "op2_html_mss": op2_html_mss,
    "op3_rlz_dedup": op3_rlz_dedup,
    "op4_line_dedup": op4_line_dedup,
    "op5_packing": op5_packing,
    "op6_langid": op6_langid,
    "op7_simhash": op7_simhash,
    "op8_decontam_lsa": op8_decontam_lsa,
    "op9_outlier_rules": op9_outlier_rules,
    "op10_secret_ledger": op10_secret_ledger,
    "op11_license_markup": op11_license_markup,
    "op12_cholesky_whitening": op12_cholesky_whitening,
    "op13_target_resampling": op13_target_resampling,
}


def _template_pattern(markup: str) -> str:
    """License markup as a pattern over lowered words that each end in a space, for the SQL form only."""
    def plain(text: str) -> str:
        return "".join(w + " " for w in re.findall("[0-9a-z]+", text.lower()))

    pattern = ""
    for part in re.split(r"(\[\[|\]\]|\{\{.*?\}\})", markup):
        if part in ("[[", "]]"):
            pattern += "(?:" if part == "[[" else ")?"
        elif part.startswith("{{"):
            inside = part[2:-2]
            span = re.fullmatch(r"(\d+)-(\d+)", inside)
            pattern += f"(?:[^ ]+ ){{{span[1]},{span[2]}}}" if span else f"(?:{'|'.join(map(plain, inside.split('|')))})"
        else:
            pattern += plain(part)
    return pattern


_WORDS = r"""list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '')"""
_ALNUM = r"""regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"""

ORACLE = {
    "op3_rlz_dedup": f"""
        WITH words AS (SELECT doc_id, {_WORDS} AS w FROM documents),
        windows AS (
            SELECT doc_id, pos, list_aggregate(w[pos:pos + 12], 'string_agg', ' ') AS win
            FROM words, LATERAL (SELECT unnest(range(1, len(w) - 11)) AS pos) AS p),
        copied AS (
            SELECT doc_id, pos
            FROM (SELECT doc_id, pos, min(doc_id) OVER (PARTITION BY win) AS earliest FROM windows) AS e
            WHERE earliest < doc_id),
        gone AS (SELECT DISTINCT doc_id, pos + step AS pos FROM copied, range(13) AS r(step)),
        removed AS (SELECT doc_id, list(pos) AS gone FROM gone GROUP BY doc_id),
        kept AS (
            SELECT doc_id, len(w) AS n_words, coalesce(len(gone), 0) AS n_removed,
                   CASE WHEN gone IS NULL THEN w
                        ELSE list_filter(w, lambda x, i: NOT list_contains(gone, i)) END AS left_words
            FROM words LEFT JOIN removed USING (doc_id))
        SELECT doc_id, n_words, n_removed,
               sha256(coalesce(list_aggregate(left_words, 'string_agg', ' '), '')) AS kept_sha256
        FROM kept""",
    "op4_line_dedup": """
        WITH lines AS (
            SELECT doc_id, pos, line,
                   translate(trim(line, E' \\t\\n\\x0b\\x0c\\r'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
            FROM (SELECT doc_id, string_split(coalesce(text, ''), E'\\n') AS parts FROM documents) AS d,
                 LATERAL (SELECT unnest(parts) AS line, generate_subscripts(parts, 1) AS pos) AS l),
        shared AS (
            SELECT key, max(doc_id) AS keeper FROM lines WHERE length(key) >= 20
            GROUP BY key HAVING count(DISTINCT doc_id) >= 3)
        SELECT doc_id, count(*) AS n_lines,
               count(*) FILTER (WHERE keeper IS NOT NULL AND keeper <> doc_id) AS n_dropped,
               sha256(coalesce(string_agg(line, E'\\n' ORDER BY pos)
                      FILTER (WHERE keeper IS NULL OR keeper = doc_id), '')) AS kept_sha256
        FROM lines LEFT JOIN shared USING (key) GROUP BY doc_id""",
    "op11_license_markup": f"""
        WITH words AS (SELECT doc_id, {_ALNUM} AS w FROM documents),
        joined AS (SELECT doc_id, w, array_to_string(list_transform(w, lambda x: x || ' '), '') AS line FROM words),
        phrases AS (
            SELECT unnest(['mit license', 'apache license', 'general public license']) AS phrase,
                   unnest(['mit', 'apache', 'gpl']) AS label),
        places AS (
            SELECT doc_id, label, unnest(list_filter(range(len(w)), lambda i:
                       array_to_string(w[i + 1 : i + len(string_split(phrase, ' '))], ' ') = phrase)) AS place
            FROM joined, phrases WHERE contains(line, phrase)),
        based AS (
            SELECT doc_id, count(*) AS n_base, min(place) AS first_word, max(place) AS last_word,
                   string_agg(DISTINCT label, ',' ORDER BY label) AS base_labels
            FROM places GROUP BY doc_id),
        templates AS (SELECT unnest($labels$) AS label, unnest($patterns$) AS pattern),
        accepted AS (
            SELECT doc_id, label FROM joined, templates WHERE regexp_matches(line, '(?:^| )' || pattern)),
        labelled AS (
            SELECT doc_id, string_agg(DISTINCT label, ',' ORDER BY label) AS labels
            FROM (SELECT doc_id, label FROM accepted UNION ALL SELECT doc_id, label FROM places) AS found GROUP BY doc_id)
        SELECT doc_id, len(w) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
               coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
               CASE WHEN doc_id IN (SELECT doc_id FROM accepted) THEN 1.0::DOUBLE
                    WHEN n_base > 0 THEN 0.5::DOUBLE ELSE 0.0::DOUBLE END AS score
        FROM joined LEFT JOIN based USING (doc_id) LEFT JOIN labelled USING (doc_id)""".replace(
            "$labels$", repr([label for label, _, _ in TEMPLATES])).replace(
            "$patterns$", repr([_template_pattern(markup) for _, _, markup in TEMPLATES])),
    "op13_target_resampling": f"""
        WITH words AS (SELECT doc_id, {_ALNUM} AS w FROM documents),
        wanted AS (SELECT unnest({_ALNUM}) AS word FROM benchmark),
        had AS (SELECT doc_id, unnest(w) AS word FROM words),
        -- CRC-32 of each distinct word, byte by byte.
        steps AS (
            SELECT list(entry ORDER BY n) AS t FROM (
                SELECT n, list_reduce([n, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, k:
                           CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS entry
                FROM (SELECT unnest(range(256)) AS n) AS numbers) AS entries),
        hashed AS (
            SELECT word, xor(4294967295, list_reduce(
                       list_prepend(4294967295::BIGINT, list_transform(range(length(hx) // 2), lambda i:
                           ('0x' || hx[2 * i + 1 : 2 * i + 2])::BIGINT)),
                       lambda c, b: xor(t[(xor(c, b) & 255) + 1], c >> 8))) % 10000 AS bucket
            FROM (SELECT word, hex(encode(word)) AS hx FROM (SELECT word FROM had UNION SELECT word FROM wanted) AS u) AS x, steps),
        s AS (SELECT bucket, count(*) AS s FROM had JOIN hashed USING (word) GROUP BY bucket),
        t AS (SELECT bucket, count(*) AS t FROM wanted JOIN hashed USING (word) GROUP BY bucket),
        gains AS (
            SELECT bucket, floor(1000 * ln((coalesce(t, 0) + 1)::DOUBLE * ((SELECT count(*) FROM had) + 10000)
                       / ((s + 1)::DOUBLE * ((SELECT count(*) FROM wanted) + 10000))))::BIGINT AS gain
            FROM s LEFT JOIN t USING (bucket)),
        weights AS (
            SELECT doc_id, count(*) AS n_features, sum(gain)::BIGINT AS weight
            FROM had JOIN hashed USING (word) JOIN gains USING (bucket) GROUP BY doc_id),
        scored AS (
            SELECT doc_id, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
                   coalesce(weight, 0) + floor(-1000 * ln(-ln(
                       (('0x' || sha256('2024:' || doc_id)[1:8])::BIGINT + 0.5::DOUBLE) / 4294967296::DOUBLE)))::BIGINT AS score
            FROM words LEFT JOIN weights USING (doc_id)),
        placed AS (
            SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS place, count(*) OVER () AS n
            FROM scored WHERE n_features >= 20)
        SELECT doc_id, n_features, weight, score, CASE WHEN place <= n * 10 // 100 THEN place END AS rank
        FROM scored LEFT JOIN placed USING (doc_id)""",
}
