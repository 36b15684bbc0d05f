"""The operators over their whole tables, with production parameters, and SQL
for the same results where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from facetforge.llm import (
    byte_bpe,
    credential_links,
    decision_lists,
    imatch,
    language_id,
    licence_scan,
    line_dedup,
    order_minhash,
    page_templates,
    periodic_runs,
    sharding,
    source_mixing,
    token_links,
)
from facetforge.llm.common import plain_text
from facetforge.storage import materialise


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_dedup.dedup_lines(docs).select(
        "doc_id", "n_lines", "n_dropped", F.sha2(F.col("text"), 256).alias("kept_sha256")
    )


OP1_SQL = """
WITH lines AS (
  SELECT doc_id, unnest(s) AS line, unnest(range(len(s))) AS place
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS s FROM documents)
), keyed AS (
  SELECT doc_id, line, place, translate(
    trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM lines
), repeated AS (
  SELECT key, max(doc_id) AS keeper FROM keyed WHERE length(key) >= 20
  GROUP BY key HAVING count(DISTINCT doc_id) >= 3
)
SELECT doc_id, count(*) AS n_lines,
  count(*) FILTER (WHERE keeper <> doc_id) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY place)
    FILTER (WHERE keeper IS NULL OR keeper = doc_id), '')) AS kept_sha256
FROM keyed LEFT JOIN repeated USING (key) GROUP BY doc_id
"""


def op2_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return source_mixing.mix_sources(docs).select(
        "doc_id",
        "size",
        "source_size",
        "target",
        (F.col("size") * F.col("copies")).alias("taken"),
    )


OP2_SQL = r"""
WITH sized AS (
  SELECT doc_id, source,
    len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size
  FROM documents
), sources AS (
  SELECT source, sum(size)::BIGINT AS source_size,
    [3, 1, 2][((row_number() OVER (ORDER BY encode(source) NULLS LAST) - 1) % 3)::INT + 1] AS weight
  FROM sized GROUP BY source
), filled AS (
  SELECT *, coalesce(sum(source_size) OVER earlier, 0)::BIGINT AS capped,
    (sum(weight) OVER () - coalesce(sum(weight) OVER earlier, 0))::BIGINT AS free,
    (sum(source_size) OVER ())::BIGINT AS total,
    row_number() OVER (ORDER BY source_size / weight, encode(source) NULLS LAST) AS place
  FROM sources
  WINDOW earlier AS (ORDER BY source_size / weight, encode(source) NULLS LAST
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), levels AS (
  SELECT *, (1.5::DOUBLE * total - 2.0::DOUBLE * capped) / free AS level FROM filled
), common_level AS (
  SELECT arg_min(level, place) AS level FROM levels
  WHERE level * weight <= 2.0::DOUBLE * source_size
), targets AS (
  SELECT source, source_size,
    least(c.level * weight, 2.0::DOUBLE * source_size) AS target
  FROM sources, common_level c
), rates AS (
  SELECT doc_id, size, source_size, target,
    CASE WHEN source_size > 0 THEN least(target / source_size, 2.0::DOUBLE) ELSE 0 END AS rate,
    ('0x' || substr(md5('7:' || doc_id), 1, 13))::BIGINT / 4503599627370496::DOUBLE AS draw
  FROM sized JOIN targets ON sized.source IS NOT DISTINCT FROM targets.source
)
SELECT doc_id, size, source_size, target,
  (size * (floor(rate) + CASE WHEN draw < rate - floor(rate) THEN 1 ELSE 0 END))::BIGINT AS taken
FROM rates
"""


def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return byte_bpe.round_trip(docs).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


def op4_imatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return imatch.compare_with_edited(docs, imatch.band_lexicon(docs))


def op5_decision_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = _table(spark, sf_dir, "labels").select("doc_id", "quality")
    statistics = materialise(decision_lists.text_statistics(docs).drop("text"), "statistics")
    labelled = decision_lists.label_poor(statistics, labels)
    rules = decision_lists.learn_decision_list(labelled, F.col("poor"))
    return decision_lists.judge(statistics, rules).select(
        "doc_id", *decision_lists.STATISTICS, "base_failed", "kept", "rule"
    )


def op6_page_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return page_templates.extract_main_text(pages).select("page_id", "url", "text", "n_chars")


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    # A row without id is in neither part of the split; it teaches nothing.
    part = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3
    model = language_id.fit_languages(docs.filter(part != 1))
    return language_id.identify_languages(docs.select("doc_id", "text"), model).select(
        "doc_id", F.coalesce(part == 1, F.lit(False)).alias("held_out"), "lang_pred", "score"
    )


def op8_licence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    hits = F.col("hits")
    return licence_scan.scan_licences(docs).select(
        "doc_id",
        F.size(hits).cast("long").alias("n_hits"),
        F.array_join(F.array_sort(F.array_distinct(hits["licence"])), ",").alias("licences"),
        F.coalesce(F.array_max(hits["dice"]), F.lit(0.0)).alias("best_dice"),
    )


OP8_SQL = """
WITH texts AS (
  SELECT doc_id, coalesce(text, '') AS text,
    string_split_regex(coalesce(text, ''), '\n[ \t\r]*\n') AS paragraphs FROM documents
), units AS (
  SELECT doc_id, unnest(list_concat(
    string_split(text, chr(10)),
    [x for x in paragraphs if contains(x, chr(10))],
    CASE WHEN len(paragraphs) > 1 THEN [text] ELSE [] END)) AS unit
  FROM texts
), listed AS (
  SELECT row_number() OVER () AS unit_id, doc_id,
    [x for x in string_split(trim(lower(regexp_replace(unit, '[^A-Za-z0-9]+', ' ', 'g'))), ' ')
      if x <> ''] AS w
  FROM units
), bigrams AS (
  SELECT unit_id, doc_id, list_distinct([w[i] || ' ' || w[i + 1]
    for i in range(1, len(w))]) AS b FROM listed WHERE len(w) >= 2
), notices AS (
  SELECT licence, [x for x in string_split(trim(lower(
    regexp_replace(notice, '[^A-Za-z0-9]+', ' ', 'g'))), ' ') if x <> ''] AS w
  FROM (VALUES {templates}) AS t(licence, notice)
), templates AS (
  SELECT licence, list_distinct([w[i] || ' ' || w[i + 1]
    for i in range(1, len(w))]) AS t FROM notices
), scored AS (
  SELECT doc_id, unit_id, licence,
    2.0::DOUBLE * len(list_intersect(b, t)) / (len(b) + len(t)) AS dice
  FROM bigrams JOIN templates
    ON len(b) BETWEEN len(t) * 0.66 AND len(t) / 0.66
), hits AS (
  SELECT doc_id, unit_id, max(dice) AS dice,
    min(licence) FILTER (WHERE dice = best) AS licence
  FROM (SELECT *, max(dice) OVER (PARTITION BY unit_id) AS best FROM scored)
  WHERE dice >= 0.8 GROUP BY doc_id, unit_id
)
SELECT d.doc_id, count(h.doc_id) AS n_hits,
  coalesce(string_agg(DISTINCT h.licence, ',' ORDER BY h.licence), '') AS licences,
  coalesce(max(h.dice), 0.0::DOUBLE) AS best_dice
FROM documents d LEFT JOIN hits h ON h.doc_id = d.doc_id GROUP BY d.doc_id
""".replace("{templates}", licence_scan.templates_sql())


def op9_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return order_minhash.near_duplicates(docs).select("doc_id", "class_id", "class_size", "kept")


def op10_credential_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    found = credential_links.find_secrets(docs)

    def listed(spans):
        return F.array_join(
            F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ","
        )

    def count(kind):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")

    base = F.filter("spans", lambda s: s["kind"].isin(*credential_links.BASE_KINDS))
    return found.select(
        "doc_id",
        *[count(kind).alias(f"n_{kind}") for kind in credential_links.BASE_KINDS],
        F.sha2(listed(base), 256).alias("base_sha256"),
        listed(F.col("spans")).alias("spans"),
    )


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    found = periodic_runs.find_runs(docs, digests=True, edit=("doc_id", periodic_runs.plant_tail))
    return found.select(
        "doc_id",
        "n_runs",
        "start",
        "length",
        "period",
        "exponent_milli",
        F.col("runs").alias("runs_sha256"),
        F.col("collapsed").alias("collapsed_sha256"),
    )


def op12_token_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return token_links.link_tokens(docs, digests=True).select(
        "doc_id",
        "n_a",
        "n_b",
        "n_groups",
        "n_links",
        "n_best",
        "count_sum",
        F.col("groups").alias("groups_sha256"),
    )


def op13_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    text = plain_text("text")
    return sharding.shard_documents(docs).select(
        "doc_id",
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.lit(sharding.LAW).alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


QUERIES = {
    "op1_line_dedup": op1_line_dedup,
    "op2_source_mixing": op2_source_mixing,
    "op3_byte_bpe": op3_byte_bpe,
    "op4_imatch": op4_imatch,
    "op5_decision_lists": op5_decision_lists,
    "op6_page_templates": op6_page_templates,
    "op7_language_id": op7_language_id,
    "op8_licence_scan": op8_licence_scan,
    "op9_order_minhash": op9_order_minhash,
    "op10_credential_links": op10_credential_links,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_token_links": op12_token_links,
    "op13_sharding": op13_sharding,
}

SQL = {
    "op1_line_dedup": OP1_SQL,
    "op2_source_mixing": OP2_SQL,
    "op8_licence_scan": OP8_SQL,
}
