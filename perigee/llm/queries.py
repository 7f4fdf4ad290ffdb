"""Registered queries of the operators, and their SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from perigee.llm import (
    clustering,
    decontaminate,
    extraction,
    hmm,
    language,
    line_hashing,
    packing,
    pii,
    quality,
    repetition,
    resampling,
    simhash,
    winnowing,
)
from perigee.llm.shared import read, remainder

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


def op1_line_hashing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The clauses to remove: those of later passages."""
    return line_hashing.removed_passages(read(spark, sf_dir, "documents"))


def op2_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that lose clauses, and which."""
    removed = winnowing.removed_passages(winnowing.repeated_passages(read(spark, sf_dir, "documents")))
    return removed.select(
        "doc_id", F.size("units").cast("bigint").alias("n_removed"), F.array_join("units", ",").alias("removed_units")
    )


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.hits(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        decontaminate.hit_words().alias("n_hit"),
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.size("spans") > 0).alias("contaminated"),
    )


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    fold = remainder(F.col("doc_id"), 3)
    found = quality.scored(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"), fold != 1)
    return found.select(
        "doc_id", (fold == 1).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )


def op5_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, fold = read(spark, sf_dir, "documents"), remainder(F.col("doc_id"), 4)
    found = language.predicted(docs, language.fit(docs, fold != 2))
    return found.select("doc_id", (fold == 2).alias("held_out"), "lang_pred", "score", "rejected")


def op6_hmm(spark: SparkSession, sf_dir: str) -> DataFrame:
    fold = remainder(F.col("doc_id"), 5)
    found = hmm.scored(read(spark, sf_dir, "documents"), fold != 1)
    return found.select(
        "doc_id", (fold == 1).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score"
    )


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.found(read(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s["plain"])

    def joined(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def number(kind: str):
        return F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    return found.select(
        "doc_id",
        *map(number, pii.KINDS),
        F.sha2(joined(base), 256).alias("base_sha256"),
        joined(F.col("spans")).alias("spans"),
    )


def op8_repetition(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = repetition.counts(read(spark, sf_dir, "documents"))
    return found.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        repetition.base_failed().alias("base_failed"),
        repetition.passes().alias("kept"),
        "n_covered",
        "longest_repeat",
    )


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(read(spark, sf_dir, "documents"))


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read(spark, sf_dir, "documents"), TOKENIZER, with_ids=False).drop("loss_tokens")


def op11_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = resampling.resample(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_features", "weight", "score", "rank")


def op12_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extraction.extracted(read(spark, sf_dir, "pages"))


def op13_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clustering.clustered(read(spark, sf_dir, "embeddings"))


_QUERIES = [
    op1_line_hashing,
    op2_winnowing,
    op3_decontamination,
    op4_quality,
    op5_language,
    op6_hmm,
    op7_pii,
    op8_repetition,
    op9_simhash,
    op10_packing,
    op11_resampling,
    op12_extraction,
    op13_clustering,
]

_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_NORMAL = "trim(regexp_replace(" + _LOWER + r", '[ \t\n\x0B\f\r]+', ' ', 'g'))"

_ASCII_SPACE = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"

# What each text is cut into and has a word, in the order of their places from 0.
def _pieces(cut: str, normal: str) -> str:
    return f"""
    parts AS (SELECT doc_id, regexp_extract_all(text, '(?s:.*?){cut}|(?s:.+)') AS p FROM documents),
    pieces AS (
      SELECT doc_id, unnest(p) AS piece, generate_subscripts(p, 1) - 1 AS part FROM parts),
    placed AS (
      SELECT doc_id, part, length(trim(piece, {_ASCII_SPACE})) AS size, {normal} AS normal,
        coalesce(sum(length(piece)) OVER (PARTITION BY doc_id ORDER BY part
          ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
        + length(piece) - length(ltrim(piece, {_ASCII_SPACE})) AS start
      FROM pieces),
    worded AS (
      SELECT doc_id, start::BIGINT AS start, (start + size)::BIGINT AS "end", normal,
        row_number() OVER (PARTITION BY doc_id ORDER BY part) - 1 AS unit,
        CASE WHEN strlen(normal) > 2 * length(normal)
             THEN greatest(len(string_split(normal, ' ')), len(regexp_extract_all(normal, '{line_hashing.UNSPACED}')))
             ELSE len(string_split(normal, ' ')) END AS words
      FROM placed WHERE normal <> '')"""


_CLAUSES = _pieces(line_hashing.CLAUSE, _NORMAL.format("piece"))
_COLLAPSED = r"trim(regexp_replace(lower(piece), '[ \t\n\x0B\f\r]+', ' ', 'g'))"
_SENTENCES = _pieces(winnowing.SENTENCE, f"regexp_replace({_COLLAPSED}, '{winnowing._WIDE}$', '')")

SQL = {
    "op1_line_hashing": f"""
        WITH {_CLAUSES}, known AS (
          SELECT *, first_value(struct_pack(d := doc_id, u := unit)) OVER (PARTITION BY normal ORDER BY doc_id, unit) AS f
          FROM worded),
        ranked AS (
          SELECT *, unit - row_number() OVER (PARTITION BY doc_id ORDER BY unit) AS run
          FROM known WHERE f.d <> doc_id OR f.u <> unit),
        held AS (SELECT *, sum(words) OVER (PARTITION BY doc_id, run) AS held FROM ranked)
        SELECT doc_id, unit, start, "end", f.d AS first_doc_id
        FROM held WHERE held >= {line_hashing.PASSAGE_WORDS}""",
    "op2_winnowing": f"""
        WITH {_SENTENCES}, runs AS (
          SELECT doc_id, unit, normal || chr(10) || lead(normal, 1) OVER (PARTITION BY doc_id ORDER BY unit) AS run
          FROM worded),
        later AS (
          SELECT DISTINCT doc_id, unnest([unit, unit + 1]) AS unit FROM (
            SELECT *, row_number() OVER (PARTITION BY run ORDER BY doc_id, unit) AS n FROM runs WHERE run IS NOT NULL)
          WHERE n > 1),
        ranked AS (
          SELECT doc_id, unit, strlen(normal) AS bytes, unit - row_number() OVER (PARTITION BY doc_id ORDER BY unit) AS run
          FROM later JOIN worded USING (doc_id, unit)),
        held AS (SELECT *, sum(bytes) OVER (PARTITION BY doc_id, run) AS held FROM ranked)
        SELECT doc_id, count(*) AS n_removed, string_agg(unit::VARCHAR, ',' ORDER BY unit) AS removed_units
        FROM held WHERE held >= {winnowing.PASSAGE_BYTES} GROUP BY doc_id""",
    "op3_decontamination": f"""
        WITH d AS (
          SELECT doc_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w
          FROM documents),
        i AS (
          SELECT item_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w
          FROM benchmark),
        windows AS (
          SELECT DISTINCT item_id, least(len(w), 10) AS size,
            array_to_string(w[pos : pos + least(len(w), 10) - 1], ' ') AS words
          FROM (SELECT *, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS pos FROM i WHERE len(w) > 0)),
        grams AS (
          SELECT doc_id, pos, size, array_to_string(w[pos : pos + size - 1], ' ') AS words
          FROM (SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS pos
                FROM d, (SELECT DISTINCT size FROM windows) WHERE len(w) >= size)),
        found AS (SELECT doc_id, pos, size, item_id FROM grams JOIN windows USING (size, words)),
        hit AS (SELECT doc_id, count(DISTINCT word) AS n
                FROM (SELECT doc_id, unnest(range(pos, pos + size)) AS word FROM found) GROUP BY doc_id),
        items AS (SELECT doc_id, count(*) AS n, string_agg(item, ',' ORDER BY item) AS list
                  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM found) GROUP BY doc_id)
        SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(hit.n, 0) AS n_hit, coalesce(items.n, 0) AS n_items,
          sha256(coalesce(list, '')) AS items_sha256, coalesce(hit.n, 0) > 0 AS contaminated
        FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN items USING (doc_id)""",
}


_WORDS = "regexp_extract_all(" + _LOWER.format("coalesce(text, '')") + r", '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

# The polynomial of crc32, reflected, is 3988292384.
SQL["op11_resampling"] = f"""
    WITH bits AS MATERIALIZED (
      SELECT list(list_reduce(range(8),
          lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, b) ORDER BY b) AS t
      FROM range(256) AS r(b)),
    d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
    own AS (SELECT doc_id, word, count(*) AS n FROM (SELECT doc_id, unnest(w) AS word FROM d) GROUP BY ALL),
    wanted AS (SELECT word, count(*) AS n FROM (SELECT unnest({_WORDS}) AS word FROM benchmark) GROUP BY ALL),
    hashed AS MATERIALIZED (
      SELECT word, xor(list_reduce(list_transform(range(0, length(hex(encode(word))), 2),
          lambda k: ('0x' || substr(hex(encode(word)), k + 1, 2))::BIGINT),
          lambda c, b: xor(c >> 8, t[xor(c, b) % 256 + 1]), 4294967295::BIGINT), 4294967295) % 10000 AS bucket
      FROM (SELECT word FROM own UNION SELECT word FROM wanted), bits),
    source AS (SELECT bucket, sum(n)::BIGINT AS s FROM own JOIN hashed USING (word) GROUP BY bucket),
    target AS (SELECT bucket, sum(n)::BIGINT AS t FROM wanted JOIN hashed USING (word) GROUP BY bucket),
    sums AS (SELECT coalesce((SELECT sum(s) FROM source), 0)::BIGINT AS all_s,
                    coalesce((SELECT sum(t) FROM target), 0)::BIGINT AS all_t),
    gains AS (
      SELECT bucket, floor(1000 * ln((coalesce(t, 0) + 1)::DOUBLE * (all_s + 10000)
                                     / ((coalesce(s, 0) + 1)::DOUBLE * (all_t + 10000))))::BIGINT AS gain
      FROM source FULL JOIN target USING (bucket), sums),
    weights AS (SELECT doc_id, sum(n * gain)::BIGINT AS weight FROM own JOIN hashed USING (word) JOIN gains USING (bucket)
                GROUP BY doc_id),
    scored AS (
      SELECT doc_id, len(w)::BIGINT AS n_features, coalesce(weight, 0) AS weight, coalesce(weight, 0) + floor(-1000
          * ln(-ln((('0x' || substr(sha256('2024:' || doc_id), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296)))::BIGINT AS score
      FROM d LEFT JOIN weights USING (doc_id)),
    ranked AS (
      SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS place, count(*) OVER () AS n
      FROM scored WHERE n_features >= 20)
    SELECT doc_id, n_features, weight, score, CASE WHEN place <= 10 * n // 100 THEN place END AS rank
    FROM scored LEFT JOIN ranked USING (doc_id)"""


def _clustering_sql(k: int = clustering.CLUSTERS, rounds: int = clustering.ROUNDS) -> str:
    """Each round as two tables: all vectors with their nearest centroid, and the centroids after it."""
    steps = []
    for r in range(rounds + 1):
        steps.append(f"""
    near{r} AS MATERIALIZED (
      SELECT vec_id, v, arg_min(c, (apart, c)) AS c, min(apart) AS distance FROM (
        SELECT vec_id, v, c, list_sum(list_transform(list_zip(v, m), lambda p: (p[1] - p[2]) * (p[1] - p[2])))::BIGINT AS apart
        FROM vectors, centroids{r}) GROUP BY vec_id, v)""")
        if r < rounds:
            steps.append(f"""
    centroids{r + 1} AS MATERIALIZED (
      SELECT c, coalesce(any_value(moved), any_value(m)) AS m FROM centroids{r} LEFT JOIN (
        SELECT c, list(((total - ((total % n) + n) % n) // n)::BIGINT ORDER BY place) AS moved FROM (
          SELECT c, place, sum(x)::BIGINT AS total, count(*) AS n
          FROM (SELECT c, unnest(v) AS x, generate_subscripts(v, 1) AS place FROM near{r}) GROUP BY c, place)
        GROUP BY c) USING (c) GROUP BY c)""")
    return f"""
    WITH vectors AS MATERIALIZED (
      SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v FROM embeddings
      WHERE len(embedding) = {clustering.DIMENSIONS}
        AND len(list_filter(embedding, lambda x: isfinite(x))) = {clustering.DIMENSIONS}),
    centroids0 AS MATERIALIZED (
      SELECT row_number() OVER (ORDER BY sha256('{clustering.SEED}:' || vec_id)) - 1 AS c, v AS m FROM vectors
      ORDER BY sha256('{clustering.SEED}:' || vec_id) LIMIT {k}),{",".join(steps)}
    SELECT vec_id, c::INT AS cluster, distance, (sum(distance) OVER (PARTITION BY c))::BIGINT AS cluster_inertia,
      (sum(distance) OVER ())::BIGINT AS inertia, sha256(array_to_string(m, ',')) AS centroid_sha256
    FROM near{rounds} JOIN centroids{rounds} USING (c)"""


SQL["op13_clustering"] = _clustering_sql()


def queries() -> dict:
    return {f.__name__: f for f in _QUERIES}
