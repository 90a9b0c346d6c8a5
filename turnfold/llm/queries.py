"""The registered queries of the operators: production parameters, whole
tables, full results."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..session import scratch_path
from . import alignment, brown, collocations, covertree, idfile, langid, minhash, mixing, packing, personal, quality_fm, quality_rules, secret_scan
from .frames import table, written


def op1_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_path(spark, "token-ids")
    idfile.write_documents(table(spark, sf_dir, "documents"), folder)
    return idfile.read_documents(spark, folder)


def op2_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.classes(table(spark, sf_dir, "documents"), words=3, percent=85)


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_quality_fm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_fm.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(table(spark, sf_dir, "documents"))


def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    scanned = secret_scan.scan(table(spark, sf_dir, "documents").select("doc_id", "text"))
    kept = written(scanned.drop("text"), "secret-scan")
    return secret_scan.digest(secret_scan.with_spans(kept, secret_scan.discovery_bounds(kept)))


def op7_similar_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return covertree.similar(table(spark, sf_dir, "embeddings"))


def op8_pack_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"))


def op9_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    copies = mixing.copy_counts(table(spark, sf_dir, "documents"))
    return copies.selectExpr("doc_id", "size", "source_size", "target", "size * copies AS taken", "copies")


def op10_brown_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return brown.score_documents(table(spark, sf_dir, "documents"))


def op11_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal.digest(personal.find(table(spark, sf_dir, "documents")))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align_documents(table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (
    op1_token_ids, op2_near_duplicates, op3_quality_rules, op4_quality_fm, op5_language_id, op6_secret_scan,
    op7_similar_vectors, op8_pack_sequences, op9_mix_sources,
    op10_brown_scores, op11_personal_data, op12_collocations, op13_token_alignment)}

ORACLE: dict[str, str] = {
    "op9_mix_sources": """
WITH sized AS (
  SELECT doc_id, source, coalesce(md5(text), '<null>') AS body, CAST(coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) AS BIGINT) AS size
  FROM documents),
per AS (SELECT source, sum(size) AS source_size, count(*) AS n_docs FROM sized GROUP BY source),
placed AS (SELECT *, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS place FROM per),
weighed AS (SELECT *, CASE place WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS weight,
                   3.0::DOUBLE * source_size AS cap FROM placed),
levels AS (SELECT *, (sum(source_size) OVER ()::DOUBLE
                      - coalesce(sum(cap) OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0))
                     / sum(weight) OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
           FROM weighed),
final AS (SELECT *, arg_min(CASE WHEN level * weight <= cap THEN level END,
                            CASE WHEN level * weight <= cap THEN cap / weight END) OVER () AS last_level FROM levels),
targets AS (SELECT source, source_size, n_docs, least(cap, coalesce(last_level * weight, cap)) AS target FROM final),
dealt AS (SELECT s.doc_id, s.size, s.body, s.source, t.source_size, t.target,
                 CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0.0 END AS rate,
                 CAST(floor(('0x' || substr(md5('17|' || s.doc_id || '|' || s.body), 1, 13))::BIGINT / 4503599627370496.0::DOUBLE
                            * greatest(1, ceil(t.n_docs / 256.0))) AS BIGINT) AS stratum
          FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source),
drawn AS (SELECT *, ('0x' || substr(md5('17|' || coalesce(source, '<null>') || '|' || stratum), 1, 13))::BIGINT / 4503599627370496.0::DOUBLE AS u,
                 row_number() OVER (PARTITION BY source, stratum ORDER BY size, doc_id, body) AS i, rate - floor(rate) AS part
          FROM dealt),
counted AS (SELECT *, CAST(floor(rate) + floor(u + i * part) - floor(u + (i - 1) * part) AS INTEGER) AS copies FROM drawn)
SELECT doc_id, size, CAST(source_size AS BIGINT) AS source_size, target, CAST(size * copies AS BIGINT) AS taken, CAST(copies AS INTEGER) AS copies
FROM counted""",
    "op12_collocations": """
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(regexp_split_to_array(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '[.,;:!?\\x0A-\\x0D]')) AS piece
  FROM documents),
parts AS (SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS words FROM pieces),
places AS (SELECT lang, words, unnest(range(1, len(words) + 1)) AS i FROM parts),
runs AS (SELECT lang, words[i:i + k - 1] AS phrase FROM places, (SELECT unnest(range(1, 6)) AS k) AS sizes WHERE i + k - 1 <= len(words)),
counts AS (SELECT lang, phrase, count(*) AS f FROM runs GROUP BY lang, phrase),
totals AS (SELECT lang, sum(f) AS n FROM counts WHERE len(phrase) = 1 GROUP BY lang),
frequent AS (SELECT * FROM counts WHERE f >= 100),
held AS (SELECT DISTINCT lang, unnest([phrase[:len(phrase) - 1], phrase[2:]]) AS phrase, f FROM frequent WHERE len(phrase) > 2),
candidates AS (SELECT * FROM frequent ANTI JOIN held USING (lang, phrase, f) WHERE len(phrase) > 1),
cuts AS (SELECT lang, phrase, f, unnest(range(1, len(phrase))) AS cut FROM candidates),
scores AS (
  SELECT c.lang, c.phrase, c.f AS a, c.cut, x.f AS l, y.f AS r, CAST(t.n AS BIGINT) AS n,
         CAST((1000 * c.f::HUGEINT * t.n::HUGEINT) // (x.f::HUGEINT * y.f::HUGEINT) AS BIGINT) AS score
  FROM cuts c JOIN counts x ON x.lang = c.lang AND x.phrase = c.phrase[:cut]
  JOIN counts y ON y.lang = c.lang AND y.phrase = c.phrase[cut + 1:] JOIN totals t ON t.lang = c.lang),
lowest AS (SELECT * FROM scores QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, array_to_string(phrase, ' ')) AS rank,
       array_to_string(phrase, ' ') AS phrase, a, l, r, n, score
FROM lowest QUALIFY rank <= 2000""",
}
