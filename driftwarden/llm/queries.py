"""One query per operator over the given tables, with the SQL that has to agree where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from driftwarden.llm.common import read
from driftwarden.llm.context_tree import scored_texts
from driftwarden.llm.decontamination import contaminated
from driftwarden.llm.licenses import COMMON, TEMPLATES, THRESHOLD, TOKEN, license_files
from driftwarden.llm.lines import repeated_lines
from driftwarden.llm.mixing import mixed
from driftwarden.llm.near import near_documents
from driftwarden.llm.periodic import periodic_runs, run_digests, with_planted_runs
from driftwarden.llm.personal import personal_data
from driftwarden.llm.quality import quality_documents
from driftwarden.llm.sharding import shard_documents
from driftwarden.llm.spelling import planted_words, spelling_variants
from driftwarden.llm.toxicity import toxic_documents
from driftwarden.llm.vectors import near_vectors

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(run: Query) -> Query:
        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql
        return run

    return register


@query("op5_sharding")
def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_documents(read(spark, sf_dir, "documents"), 40)


@query("op6_quality")
def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_documents(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


@query("op7_toxicity")
def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxic_documents(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


MIX_SQL = r"""WITH sized AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size FROM {docs}),
sources AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source),
weighted AS (
  SELECT *, CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight
  FROM sources),
placed AS (
  SELECT *, CAST(source_size AS DOUBLE) / weight AS per, 2.0::DOUBLE * source_size AS stop,
         row_number() OVER (ORDER BY CAST(source_size AS DOUBLE) / weight, source NULLS LAST) AS place FROM weighted),
levels AS (
  SELECT *, (1.5::DOUBLE * CAST(sum(source_size) OVER () AS DOUBLE)
             - 2.0::DOUBLE * CAST(coalesce(sum(source_size) OVER (ORDER BY place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS DOUBLE))
            / CAST(sum(weight) OVER (ORDER BY place ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS DOUBLE) AS unit
  FROM placed),
targets AS (
  SELECT source, source_size,
         least(stop, coalesce(max(CASE WHEN unit * weight <= stop THEN unit END) OVER () * weight, stop)) AS target
  FROM levels),
rated AS (
  SELECT s.doc_id, s.size, t.source_size, t.target,
         CASE WHEN t.source_size = 0 THEN 0 ELSE t.target / t.source_size END AS rate,
         CAST(('0x' || substr(md5('mix:' || coalesce(CAST(s.doc_id AS VARCHAR), '')), 1, 13)) AS BIGINT)
           / 4503599627370496.0::DOUBLE AS u
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
       CAST(size * (floor(rate) + CASE WHEN u < rate - floor(rate) THEN 1 ELSE 0 END) AS BIGINT) AS taken FROM rated"""


@query("op8_mixing", MIX_SQL.replace("{docs}", "documents"))
def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = mixed(read(spark, sf_dir, "documents"))
    return out.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


@query("op10_decontamination")
def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


@query("op9_jaccard_join")
def op9_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_documents(read(spark, sf_dir, "documents")).drop("raw")


@query("op1_personal_data")
def op1_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_data(read(spark, sf_dir, "documents"))


@query("op3_vectors")
def op3_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(read(spark, sf_dir, "embeddings"))


_VALUES = ", ".join(f"({i}, '{n}', '{t}')" for i, (n, t) in enumerate(TEMPLATES))
_COMMON = ", ".join(f"'{w}'" for w in COMMON)
LICENSE_SQL = rf"""WITH files AS (
  SELECT doc_id, coalesce(source, 'none') || '/' || coalesce(lang, 'none') || '/' || CAST(doc_id // 1000 AS VARCHAR)
         || '/' || CAST(doc_id AS VARCHAR) AS path,
         string_split(coalesce(text, ''), chr(10)) AS held FROM documents),
cells AS (
  SELECT doc_id, generate_subscripts(held, 1) AS line, unnest(held) AS t FROM files),
lines AS (
  SELECT doc_id, line, trim(t) <> '' AS filled, regexp_extract_all(lower(t), '{TOKEN}') AS tokens FROM cells),
words AS (SELECT DISTINCT doc_id, unnest(tokens) AS token FROM lines),
template AS (SELECT * FROM (VALUES {_VALUES}) t(template, license, text)),
template_words AS (
  SELECT template, license, token, count(*) AS tf
  FROM (SELECT template, license, unnest(regexp_extract_all(lower(text), '{TOKEN}')) AS token FROM template) GROUP BY ALL),
total AS (SELECT count(*) AS n FROM files),
idf AS (SELECT token, ln((SELECT n + 1 FROM total)::DOUBLE / (count(*) + 1)) + 1 AS idf FROM words GROUP BY token),
raw AS (
  SELECT template, license, token, tf * coalesce(idf, ln((SELECT n + 1 FROM total)::DOUBLE) + 1) AS w
  FROM template_words LEFT JOIN idf USING (token)),
weights AS (SELECT template, license, token, w / sqrt(sum(w * w) OVER (PARTITION BY template)) AS w FROM raw),
anchors AS (
  SELECT list(DISTINCT token) AS held FROM template_words WHERE regexp_matches(token, '^[a-z]+$') AND token NOT IN ({_COMMON})),
marked AS (
  SELECT *, list_has_any(tokens, (SELECT held FROM anchors)) AS hot,
         max(CASE WHEN filled THEN line END) OVER (PARTITION BY doc_id) AS n_lines FROM lines),
hot_files AS (SELECT * FROM marked WHERE doc_id IN (SELECT doc_id FROM marked WHERE hot)),
islands AS (
  SELECT *, line - row_number() OVER (PARTITION BY doc_id ORDER BY line) AS island FROM hot_files WHERE filled),
units AS (
  SELECT doc_id, line AS start, line, 0 AS kind, n_lines, tokens FROM hot_files WHERE hot
  UNION ALL
  SELECT doc_id, min(line), max(CASE WHEN hot THEN line END), 1, any_value(n_lines), flatten(list(tokens))
  FROM islands GROUP BY doc_id, island HAVING count(*) > 1 AND bool_or(hot)
  UNION ALL
  SELECT doc_id, 1, max(CASE WHEN hot THEN line END), 2, any_value(n_lines), flatten(list(tokens))
  FROM hot_files WHERE doc_id IN (SELECT doc_id FROM islands GROUP BY doc_id HAVING count(DISTINCT island) > 1) GROUP BY doc_id),
terms AS (
  SELECT doc_id, start, line, kind, n_lines, token, count(*) AS tf
  FROM (SELECT doc_id, start, line, kind, n_lines, unnest(tokens) AS token FROM units) GROUP BY ALL),
weighted AS (SELECT doc_id, start, line, kind, n_lines, token, tf * idf AS x FROM terms JOIN idf USING (token)),
norms AS (SELECT doc_id, start, line, kind, sqrt(sum(x * x)) AS norm FROM weighted GROUP BY ALL),
dots AS (
  SELECT doc_id, start, line, kind, n_lines, template, license, sum(x * w) AS dot
  FROM weighted JOIN weights USING (token) GROUP BY ALL),
scored AS (SELECT d.*, round(dot / norm, 6) AS score FROM dots d JOIN norms n USING (doc_id, start, line, kind)),
passed AS (
  SELECT * FROM scored WHERE score >= {THRESHOLD}
  QUALIFY row_number() OVER (PARTITION BY doc_id, start, line, kind ORDER BY score DESC, template) = 1),
notices AS (
  SELECT * FROM passed p WHERE NOT EXISTS (
    SELECT 1 FROM passed i WHERE i.doc_id = p.doc_id AND i.kind < p.kind AND i.line BETWEEN p.start AND p.line AND i.score >= p.score)),
own AS (
  SELECT doc_id, license, score, bool_or(line = n_lines) OVER (PARTITION BY doc_id) AS closes FROM notices
  QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, line) = 1),
known AS (
  SELECT f.doc_id, path, regexp_replace(path, '/?[^/]*$', '') AS dir, license, score, closes
  FROM files f LEFT JOIN own o ON f.doc_id = o.doc_id),
votes AS (SELECT dir, license, count(*) AS n, max(score) AS score FROM known WHERE closes GROUP BY ALL),
speaking AS (SELECT * FROM votes QUALIFY row_number() OVER (PARTITION BY dir ORDER BY n DESC, license) = 1),
nearest AS (
  SELECT k.dir, s.dir AS ancestor, s.license, s.score
  FROM (SELECT DISTINCT dir FROM known WHERE license IS NULL) k JOIN speaking s
    ON k.dir = s.dir OR s.dir = '' OR starts_with(k.dir, s.dir || '/')
  QUALIFY row_number() OVER (PARTITION BY k.dir ORDER BY len(s.dir) DESC) = 1)
SELECT doc_id, path, coalesce(k.license, n.license) AS license, coalesce(k.score, n.score) AS score,
       CASE WHEN k.license IS NOT NULL THEN 'own' WHEN n.license IS NOT NULL THEN 'inherited' END AS origin,
       CASE WHEN k.license IS NULL THEN n.ancestor END AS directory
FROM known k LEFT JOIN nearest n ON k.dir = n.dir"""


@query("op4_licenses", LICENSE_SQL)
def op4_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Documents carry no path: source, language and blocks of ids stand for the folders of a tree.
    folder = [F.col("source"), F.col("lang"), F.floor(F.col("doc_id") / 1000).cast("string")]
    path = F.concat_ws("/", *[F.coalesce(c, F.lit("none")) for c in folder], F.col("doc_id").cast("string"))
    return license_files(read(spark, sf_dir, "documents").withColumn("path", path))


@query("op2_line_dedup")
def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_lines(read(spark, sf_dir, "documents"))


@query("op11_context_tree")
def op11_context_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scored_texts(read(spark, sf_dir, "documents"))


@query("op12_spelling_variants")
def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(planted_words(read(spark, sf_dir, "documents")))


@query("op13_periodic_runs")
def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_digests(periodic_runs(with_planted_runs(read(spark, sf_dir, "documents"))))
