"""Registered queries of this package and their SQL, with production parameters over whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from barweave.llm import (
    decontaminate,
    exact_dedup,
    language_id,
    line_dedup,
    mixing,
    near_dedup,
    packing,
    periodic,
    resampling,
    secrets,
    substring_dedup,
    token_files,
    toxicity,
)
from barweave.llm.common import id_fold, table

#: crc32 in SQL: the table of its 256 steps from the polynomial, and the checksum of a text's bytes.
_CRC_TABLE = """
crc_table AS (
  SELECT list(list_reduce([b] || range(8), lambda c, i:
           CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END) ORDER BY b) AS t
  FROM (SELECT unnest(range(256)) AS b)
)
"""


def _crc_sql(text: str) -> str:
    data = f"hex(encode({text}))"
    steps = (
        f"list_transform(range(1, length({data}) // 2 + 1),"
        f" lambda i: CAST('0x' || substr({data}, 2 * i - 1, 2) AS BIGINT))"
    )
    step = "lambda c, b: xor(t[(xor(c, b) & 255) + 1], c >> 8)"
    return f"xor(list_reduce([4294967295] || {steps}, {step}), 4294967295)"


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(function):
    QUERIES[function.__name__] = function
    return function


@query
def op1_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return decontaminate.contaminated(docs, table(spark, folder, "benchmark"))


@query
def op2_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact_dedup.exact_groups(table(spark, folder, "documents"))


ORACLE["op2_exact_dedup"] = """
SELECT doc_id,
       max(doc_id) OVER (PARTITION BY coalesce(text, '')) AS keep_id,
       count(*) OVER (PARTITION BY coalesce(text, '')) AS group_size,
       doc_id = max(doc_id) OVER (PARTITION BY coalesce(text, '')) AS kept,
       sha256(coalesce(text, '')) AS text_sha256
FROM documents
"""


@query
def op3_token_files(spark: SparkSession, folder: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.json")
    return token_files.token_table(table(spark, folder, "documents"), path, end_id=2)


@query
def op4_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return substring_dedup.dedup_substrings(table(spark, folder, "documents")).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"
    )


@query
def op5_pack(spark: SparkSession, folder: str) -> DataFrame:
    path = public_tokenizers.path("word_bpe_49k.json")
    return packing.packed(table(spark, folder, "documents"), path, end_id=0)


@query
def op6_secrets(spark: SparkSession, folder: str) -> DataFrame:
    found = secrets.find_secrets(table(spark, folder, "documents"))

    def joined(spans):
        return F.array_join(
            F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ","
        )

    def of_kind(kind):
        return F.filter("spans", lambda s: s["kind"] == kind)

    base = F.filter("spans", lambda s: s["kind"] != "random")
    return found.select(
        "doc_id",
        *[
            F.size(of_kind(kind)).cast("long").alias(f"n_{kind}")
            for kind in secrets.KINDS
        ],
        F.sha2(joined(base), 256).alias("base_sha256"),
        joined(F.col("spans")).alias("spans"),
    )


@query
def op7_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    labels = table(spark, folder, "labels").where(~toxicity.held_out())
    model = toxicity.fit(docs, labels)
    scored = docs.withColumn("score", toxicity.score_column(docs, model))
    return scored.select(
        "doc_id",
        toxicity.held_out().alias("held_out"),
        "score",
        (F.col("score") >= toxicity.LEVEL).cast("int").alias("predicted"),
    )


@query
def op8_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return near_dedup.near_groups(table(spark, folder, "documents"))


@query
def op9_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = line_dedup.dedup_lines(table(spark, folder, "documents"))
    return found.select(
        "doc_id", "n_lines", "n_removed", "n_runs", F.sha2("kept_text", 256).alias("kept_sha256")
    )


ORACLE["op9_line_dedup"] = r"""
WITH cut AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents),
lines AS (
  SELECT doc_id, unnest(parts) AS line, unnest(range(len(parts))) AS i, len(parts) AS n_lines
  FROM cut
),
solid AS (
  SELECT doc_id, line, i, row_number() OVER (PARTITION BY doc_id ORDER BY i) AS n,
         lead(line) OVER (PARTITION BY doc_id ORDER BY i) AS following
  FROM lines WHERE regexp_matches(line, '\S')
),
later AS (
  SELECT doc_id, n FROM (
    SELECT doc_id, n,
           row_number() OVER (PARTITION BY line, following ORDER BY doc_id, n) AS k
    FROM solid WHERE following IS NOT NULL
  ) WHERE k > 1
),
later_single AS (
  SELECT doc_id, n FROM (
    SELECT doc_id, n, row_number() OVER (PARTITION BY line ORDER BY doc_id, n) AS k
    FROM solid WHERE len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) >= 20
  ) WHERE k > 1
),
gone AS (
  SELECT doc_id, n FROM later UNION SELECT doc_id, n + 1 FROM later
  UNION SELECT doc_id, n FROM later_single
),
runs AS (
  SELECT doc_id, min(i) AS a, max(i) AS b FROM (
    SELECT s.doc_id, s.i, s.n - row_number() OVER (PARTITION BY s.doc_id ORDER BY s.n) AS run
    FROM gone JOIN solid s ON s.doc_id = gone.doc_id AND s.n = gone.n
  ) GROUP BY doc_id, run
),
counted AS (
  SELECT doc_id, sum(b - a + 1) AS removed, count(*) AS runs FROM runs GROUP BY doc_id
),
kept AS (
  SELECT l.doc_id, string_agg(l.line, chr(10) ORDER BY l.i) AS text
  FROM lines l LEFT JOIN runs r ON r.doc_id = l.doc_id AND l.i BETWEEN r.a AND r.b
  WHERE r.doc_id IS NULL GROUP BY l.doc_id
)
SELECT c.doc_id, CAST(len(c.parts) AS BIGINT) AS n_lines,
       CAST(coalesce(n.removed, 0) AS BIGINT) AS n_removed,
       CAST(coalesce(n.runs, 0) AS BIGINT) AS n_runs,
       sha256(coalesce(k.text, '')) AS kept_sha256
FROM cut c LEFT JOIN counted n ON n.doc_id = c.doc_id LEFT JOIN kept k ON k.doc_id = c.doc_id
"""


@query
def op10_language(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text", "lang")
    held_out = id_fold("doc_id", 3) == 1
    model = language_id.fit(docs.where(~held_out))
    guessed = language_id.predict(docs.select("doc_id", "text"), *model)
    return guessed.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")



def _planted_runs(docs: DataFrame) -> DataFrame:
    """(doc_id, text) in which one document in ten, by the crc32 of its id, repeats its words from
    some place on with some period, which the same checksum decides. Other texts stay."""
    h = F.crc32(F.col("doc_id").cast("string"))
    # The filter takes away the empty part that a leading separator makes.
    words = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "")
    rows = docs.select(
        "doc_id", "text", F.floor(h / 10).alias("g"), F.when(h % 10 == 0, words).alias("words")
    )
    rows = rows.withColumn("n", F.size("words").cast("long"))
    rows = rows.withColumn("a", F.when(F.col("n") > 0, F.col("g") % F.col("n")))
    rows = rows.withColumn("p", F.expr("1 + (n - a) div (3 + g % 8)"))
    planted = F.expr(
        "concat(slice(words, 1, int(a)), slice(flatten(array_repeat(slice(words, int(a + 1), int(p)),"
        " int((n - a + p - 1) div p))), 1, int(n - a)))"
    )
    planted = F.when(F.col("a").isNotNull(), F.array_join(planted, " "))
    return rows.select("doc_id", F.coalesce(planted, "text").alias("text"))


def _better_run(left: Column, right: Column) -> Column:
    """-1 if the left run holds more periods, or as many and begins earlier, or has the lesser one."""
    a, b = left["length"] * right["period"], right["length"] * left["period"]
    first = (a > b) | (
        (a == b)
        & (
            (left["start"] < right["start"])
            | ((left["start"] == right["start"]) & (left["period"] < right["period"]))
        )
    )
    return F.when(first, -1).otherwise(1)


@query
def op11_periodic(spark: SparkSession, folder: str) -> DataFrame:
    found = periodic.periodic_runs(_planted_runs(table(spark, folder, "documents")))
    lines = F.transform(
        "runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))
    )
    return found.withColumn("best", F.get(F.array_sort("runs", _better_run), F.lit(0))).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        F.col("best.start").alias("start"),
        F.col("best.length").alias("length"),
        F.col("best.period").alias("period"),
        F.expr("(1000 * best.length) div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


ORACLE["op11_periodic"] = rf"""
WITH {_CRC_TABLE},
texts AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws,
         {_crc_sql("CAST(doc_id AS VARCHAR)")} AS h
  FROM documents, crc_table
),
planted AS (
  SELECT doc_id, n, a, 1 + (n - a) // (3 + g % 8) AS p FROM (
    SELECT doc_id, len(ws) AS n, h // 10 AS g, (h // 10) % len(ws) AS a
    FROM texts WHERE h % 10 = 0 AND len(ws) > 0)
),
plain AS (SELECT doc_id, unnest(ws) AS w, unnest(range(len(ws))) AS i FROM texts),
words AS (
  SELECT o.doc_id, o.i, s.w FROM plain o LEFT JOIN planted USING (doc_id)
  JOIN plain s ON s.doc_id = o.doc_id AND s.i = CASE WHEN o.i >= a THEN a + (o.i - a) % p ELSE o.i END
),
by2 AS (SELECT doc_id, i, w, hash(w, lead(w) OVER (PARTITION BY doc_id ORDER BY i)) AS h FROM words),
by4 AS (SELECT doc_id, i, hash(h, lead(h, 2) OVER (PARTITION BY doc_id ORDER BY i)) AS h FROM by2),
by8 AS (SELECT doc_id, i, hash(h, lead(h, 4) OVER (PARTITION BY doc_id ORDER BY i)) AS h FROM by4),
by16 AS (SELECT doc_id, i, hash(h, lead(h, 8) OVER (PARTITION BY doc_id ORDER BY i)) AS h FROM by8),
-- A run of period 16 or more repeats 17 runs of 16 words or more a period later.
lags AS (
  SELECT a.doc_id, b.i - a.i AS q FROM by16 a JOIN by16 b ON a.doc_id = b.doc_id AND a.h = b.h
  WHERE b.i - a.i >= 16 GROUP BY ALL HAVING count(*) >= 17
  UNION ALL
  SELECT doc_id, unnest(range(1, 16)) FROM texts
),
equal AS (
  SELECT a.doc_id, q, a.i, a.i - row_number() OVER (PARTITION BY a.doc_id, q ORDER BY a.i) AS stretch
  FROM lags JOIN words a ON a.doc_id = lags.doc_id
  JOIN words b ON b.doc_id = a.doc_id AND b.i = a.i + q AND b.w = a.w
),
runs AS (
  SELECT doc_id, start, length, min(q) AS period FROM (
    SELECT doc_id, q, min(i) AS start, count(*) + q AS length FROM equal GROUP BY doc_id, q, stretch)
  WHERE length >= greatest(24, 3 * q) GROUP BY ALL
),
best AS (
  SELECT * FROM runs QUALIFY row_number() OVER (
    PARTITION BY doc_id ORDER BY length / period DESC, start, period) = 1
),
listed AS (
  SELECT doc_id, count(*) AS n, string_agg(
    start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS lines
  FROM runs GROUP BY doc_id
),
kept AS (
  SELECT doc_id, string_agg(w, ' ' ORDER BY i) AS text FROM words
  WHERE NOT EXISTS (SELECT 1 FROM runs r WHERE r.doc_id = words.doc_id
                    AND words.i >= r.start + r.period AND words.i < r.start + r.length)
  GROUP BY doc_id
)
SELECT t.doc_id, CAST(coalesce(l.n, 0) AS BIGINT) AS n_runs, CAST(b.start AS BIGINT) AS start,
       CAST(b.length AS BIGINT) AS length, CAST(b.period AS BIGINT) AS period,
       CAST(1000 * b.length // b.period AS BIGINT) AS exponent_milli,
       sha256(coalesce(l.lines, '')) AS runs_sha256, sha256(coalesce(k.text, '')) AS collapsed_sha256
FROM texts t LEFT JOIN listed l USING (doc_id) LEFT JOIN best b USING (doc_id) LEFT JOIN kept k USING (doc_id)
"""


@query
def op12_mix(spark: SparkSession, folder: str) -> DataFrame:
    mixture = mixing.mix(table(spark, folder, "documents"))
    return mixture.documents.select(
        F.col("id").alias("doc_id"), "size", "source_size", "target", "taken"
    )


ORACLE["op12_mix"] = r"""
WITH sized AS (
  SELECT doc_id, source,
         CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
         substr(sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 16) AS place
  FROM documents
),
sources AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         row_number() OVER (ORDER BY source NULLS LAST) - 1 AS i
  FROM sized GROUP BY source
),
weighed AS (
  SELECT source, source_size, CASE i % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight, i
  FROM sources
),
ordered AS (
  SELECT *, row_number() OVER (ORDER BY 3 * source_size / weight, i) AS n,
         sum(source_size) OVER () - 3 * coalesce(sum(source_size) OVER (
           ORDER BY 3 * source_size / weight, i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS words,
         sum(weight) OVER () - coalesce(sum(weight) OVER (
           ORDER BY 3 * source_size / weight, i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS weights
  FROM weighed
),
level AS (
  SELECT words, weights FROM ordered WHERE weight * words <= 3 * source_size * weights ORDER BY n LIMIT 1
),
targets AS (
  SELECT source, source_size, i,
         CASE WHEN weight * words > 3 * source_size * weights THEN CAST(3 * source_size AS DOUBLE)
              ELSE CAST(weight * words AS DOUBLE) / CAST(weights AS DOUBLE) END AS target
  FROM weighed, (SELECT CAST(words AS HUGEINT) AS words, CAST(weights AS HUGEINT) AS weights FROM level)
),
blocks AS (
  SELECT *, greatest(1, least(1024, CAST(floor(target / 64) AS BIGINT))) AS block FROM targets
),
amounts AS (
  SELECT *, CAST(floor(target / source_size) AS BIGINT) AS turns,
         least(source_size, block * CAST(floor(
           (target - floor(target / source_size) * source_size) / block + 0.5) AS BIGINT)) AS rest
  FROM blocks
),
laid AS (
  SELECT s.doc_id, s.size, a.source_size, a.target, a.turns, a.rest,
         coalesce(sum(s.size) OVER (PARTITION BY a.i ORDER BY s.place, CAST(s.doc_id AS VARCHAR) NULLS FIRST,
           s.size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS begin
  FROM sized s JOIN amounts a ON a.source IS NOT DISTINCT FROM s.source
)
SELECT doc_id, size, source_size, target,
       CAST(CASE WHEN size = 0 THEN 0
            ELSE turns * size + greatest(0, least(begin + size, rest) - begin) END AS BIGINT) AS taken
FROM laid
"""


@query
def op13_resample(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return resampling.resample(docs, table(spark, folder, "benchmark"))


ORACLE["op13_resample"] = rf"""
WITH {_CRC_TABLE},
texts AS (
  SELECT 'd' AS kind, doc_id AS id, text FROM documents
  UNION ALL SELECT 'b', item_id, text FROM benchmark
),
cut AS (
  SELECT kind, id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws
  FROM texts
),
words AS (SELECT kind, id, unnest(ws) AS w, unnest(range(len(ws))) AS i FROM cut),
grams AS (
  SELECT kind, id, unnest([w, w || ' ' || lead(w) OVER o, w || ' ' || lead(w) OVER o || ' ' || lead(w, 2) OVER o]) AS f
  FROM words WINDOW o AS (PARTITION BY kind, id ORDER BY i)
),
bucket AS (
  SELECT f, {_crc_sql("f")} % 10000 AS b FROM (SELECT DISTINCT f FROM grams WHERE f IS NOT NULL), crc_table
),
found AS (SELECT kind, id, b FROM grams JOIN bucket USING (f)),
counts AS (
  SELECT b, count(*) FILTER (kind = 'd') AS s, count(*) FILTER (kind = 'b') AS t FROM found GROUP BY b
),
sums AS (SELECT sum(s) AS s_all, sum(t) AS t_all FROM counts),
gains AS (
  SELECT b, CAST(floor(1000 * ln(CAST((t + 1) * (s_all + 10000) AS DOUBLE)
                                 / CAST((s + 1) * (t_all + 10000) AS DOUBLE))) AS BIGINT) AS gain
  FROM counts, sums
),
weighed AS (
  SELECT id, count(*) AS n, sum(gain) AS weight FROM found JOIN gains USING (b) WHERE kind = 'd' GROUP BY id
),
scored AS (
  SELECT id, len(ws) AS n_words, coalesce(n, 0) AS n_features, coalesce(weight, 0) AS weight,
         coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln(
           (CAST('0x' || substr(sha256('42:' || coalesce(CAST(id AS VARCHAR), '')), 1, 8) AS BIGINT) + 0.5)
           / 4294967296.0::DOUBLE))) AS BIGINT) AS score
  FROM cut LEFT JOIN weighed USING (id) WHERE kind = 'd'
),
ranked AS (
  SELECT id, row_number() OVER (ORDER BY score DESC, id) AS rank,
         5 * count(*) OVER () // 100 AS drawn
  FROM scored WHERE n_words >= 20
)
SELECT s.id AS doc_id, CAST(n_features AS BIGINT) AS n_features, CAST(weight AS BIGINT) AS weight,
       CAST(score AS BIGINT) AS score, CAST(CASE WHEN rank <= drawn THEN rank END AS BIGINT) AS rank
FROM scored s LEFT JOIN ranked r ON r.id = s.id
"""
