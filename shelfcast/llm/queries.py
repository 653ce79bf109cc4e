"""The queries of the subpackage and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfcast.llm import (
    licenses,
    manifest,
    mixing,
    neardup,
    packing,
    phrases,
    pii,
    quality,
    secrets,
    sharding,
    subword,
    url_lists,
    whitening,
)
from shelfcast.llm.oracles import licenses_sql, manifest_sql
from shelfcast.llm.text import read_documents, sha256, whole


def op1_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    compared = phrases.compare_with_next(read_documents(spark, sf_dir))
    named = ("edited_sha256", "fingerprint", "edited_fingerprint")
    return compared.withColumns({name: F.lower(F.hex(name)) for name in named})


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.judge(read_documents(spark, sf_dir).select("doc_id", "text"))
    return judged.drop("text")


FIRST_DAY = "2020-01-01"
# Days on which captures and list changes may fall.
DAYS = 1600


def _drawn(text, limit: int):
    """A number below the limit that depends on the text alone."""
    return F.conv(F.substring(F.md5(text), 1, 6), 16, 10).cast("int") % limit


def _after_first(days):
    return F.date_add(F.lit(FIRST_DAY).cast("date"), days)


def captures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages with a day of fetching, which the tables lack: drawn from the page's id."""
    pages = spark.read.schema("page_id bigint, url string").parquet(f"{sf_dir}/pages.parquet")
    fetched = _after_first(_drawn(F.concat(F.lit("fetch:"), F.col("page_id").cast("string")), DAYS))
    return pages.withColumn("fetched", fetched)


def list_changes(pages: DataFrame) -> DataFrame:
    """A deny list of every host and an allow list of its sections, each on and off twice."""
    host = url_lists.host_of(F.col("url"))
    section = F.concat(host, url_lists.path_start(F.col("url"), 1))
    entries = pages.select(
        F.explode(
            F.array(
                F.struct(F.lit(url_lists.DENY).alias("list"), host.alias("entry")),
                F.struct(F.lit(url_lists.ALLOW).alias("list"), section.alias("entry")),
            )
        ).alias("e")
    )
    days, changes = [_drawn(F.concat_ws(":", "list", "entry"), 600)], []
    for step in range(1, 4):
        more = _drawn(F.concat_ws(":", F.lit(str(step)), "list", "entry"), 400)
        days.append(days[-1] + more)
    for step, day in enumerate(days):
        action = url_lists.REMOVE if step % 2 else url_lists.ADD
        changes.append(F.struct(F.lit(action).alias("action"), _after_first(day).alias("day")))
    distinct = entries.select("e.list", "e.entry").distinct()
    return distinct.select("list", "entry", F.explode(F.array(*changes)).alias("c")).select(
        "list", "entry", "c.action", "c.day"
    )


def op3_url_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = captures(spark, sf_dir)
    return url_lists.judge(pages, list_changes(pages))


def op4_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = neardup.near_duplicates(read_documents(spark, sf_dir), words=3, percent=85)
    return found.drop(neardup.TEXT_HASH)


def model_path(name: str = "piece_bpe_32k.model") -> str:
    """Vocabulary of the queries. The operators take any path."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op5_subword(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_documents(spark, sf_dir).select("doc_id", "text")
    digests = subword.digests(subword.encode(docs, model_path()))
    return digests.select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "agreed")


def op6_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    planned = mixing.plan(read_documents(spark, sf_dir))
    return planned.select("doc_id", "size", "source_size", "target", "taken")


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    def count(number: int):
        return F.size(F.filter("base", lambda s: s["kind"] == number)).cast("long")

    found = pii.personal_data(read_documents(spark, sf_dir))
    return found.select(
        "doc_id",
        *[count(number).alias(f"n_{kind}") for number, kind in enumerate(pii.KINDS)],
        sha256(pii.as_text(F.col("base"))).alias("base_sha256"),
        pii.as_text(F.col("spans")).alias("spans"),
    )


def op8_shard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(read_documents(spark, sf_dir)).select(
        "doc_id",
        "size",
        F.crc32(whole(F.col("text")).cast("binary")).alias("text_crc32"),
        F.lit(sharding.LAW).alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op9_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    def count(number: int):
        return F.size(F.filter("base", lambda s: s[1] == number)).cast("long")

    found = secrets.scan(read_documents(spark, sf_dir).select("doc_id", "text"))
    return found.select(
        "doc_id",
        *[count(number).alias(f"n_{kind}") for number, kind in enumerate(secrets.KINDS[:3])],
        sha256(secrets.as_text(F.col("base"))).alias("base_sha256"),
        secrets.as_text(F.col("spans")).alias("spans"),
    )


def op10_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(read_documents(spark, sf_dir))


def op11_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    proved = manifest.manifest(read_documents(spark, sf_dir))
    end = manifest.folded(F.coalesce("tampered", "leaf"), F.col("proof"))
    return proved.select(
        "doc_id",
        "leaf",
        "subroot",
        "root",
        manifest.proof_digest(F.col("proof")).alias("proof_sha256"),
        end.alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))


def op12_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_documents(spark, sf_dir)
    return packing.pack(docs, model_path("byte_bpe_50k.json"), with_ids=False)


EMBEDDINGS = "vec_id bigint, embedding array<float>"


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.read.schema(EMBEDDINGS).parquet(f"{sf_dir}/embeddings.parquet")
    return whitening.components_of(*whitening.whiten(rows))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_phrases": op1_phrases,
        "op2_quality": op2_quality,
        "op3_url_lists": op3_url_lists,
        "op4_neardup": op4_neardup,
        "op5_subword": op5_subword,
        "op6_mix": op6_mix,
        "op7_pii": op7_pii,
        "op8_shard": op8_shard,
        "op9_secrets": op9_secrets,
        "op10_licenses": op10_licenses,
        "op11_manifest": op11_manifest,
        "op12_packing": op12_packing,
        "op13_whitening": op13_whitening,
    }


OP2_SQL = """
WITH worded AS (
  SELECT doc_id, COALESCE(text, '') AS text,
         regexp_extract_all(COALESCE(text, ''), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
windows AS (
  SELECT doc_id, i, array_to_string(w[i:i + 7], ' ') AS words
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 6)) AS i FROM worded) p),
repeated AS (
  SELECT doc_id, i FROM (
    SELECT doc_id, i, COUNT(*) OVER (PARTITION BY doc_id, words) AS times FROM windows) t
  WHERE times > 1),
covered AS (
  SELECT doc_id, COUNT(DISTINCT i + step) AS n
  FROM repeated, range(0, 8) s(step) GROUP BY doc_id),
lined AS (
  SELECT doc_id, text, w, CAST(len(w) AS BIGINT) AS n_words,
         [x FOR x IN string_split(text, chr(10)) IF regexp_matches(x, '[^\x20\x09-\x0D]')] AS l
  FROM worded),
measured AS (
  SELECT doc_id, w, n_words,
         CAST(length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g')) AS BIGINT) AS word_chars,
         CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(len(l) AS BIGINT) AS n_lines,
         CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines,
         COALESCE(n, 0) AS n_repeat_words
  FROM lined LEFT JOIN covered USING (doc_id)),
based AS (
  SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM measured)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT (base_failed OR 10 * n_symbols > n_words
            OR 10 * len([x FOR x IN w IF regexp_matches(x, '[A-Z]')
                         AND NOT regexp_matches(x, '[a-z]')]) > 3 * n_words
            OR 10 * len([x FOR x IN w IF NOT regexp_matches(x, '[A-Za-z]|[^\x00-\x7F]')])
               > 3 * n_words
            OR 5 * len([i FOR i IN range(1, n_words) IF w[i] = w[i + 1]]) > n_words
            OR 2 * n_dup_lines > n_lines
            OR word_chars < 2 * n_words OR word_chars > 15 * n_words) AS kept
FROM based"""

def _drawn_sql(text: str, limit: int) -> str:
    return f"(CAST('0x' || substr(md5({text}), 1, 6) AS INT) % {limit})"


_SCHEME = "^[A-Za-z][A-Za-z0-9+.-]*://"

OP3_SQL = f"""
WITH captured AS (
  SELECT page_id, url,
         DATE '{FIRST_DAY}' + {_drawn_sql("'fetch:' || CAST(page_id AS VARCHAR)", DAYS)} AS fetched,
         lower(regexp_extract(url, '{_SCHEME}(?:[^/?#@]*@)?([^/?#:]*)', 1)) AS host,
         regexp_extract(url, '{_SCHEME}[^/?#]*(/[^/?#]+)', 1) AS p1,
         regexp_extract(url, '{_SCHEME}[^/?#]*(/[^/?#]+/[^/?#]+)', 1) AS p2
  FROM pages),
entries AS (
  SELECT DISTINCT 'deny' AS list, host AS entry FROM captured
  UNION SELECT DISTINCT 'allow', host || p1 FROM captured),
dated AS (
  SELECT list, entry, {_drawn_sql("list || ':' || entry", 600)} AS d0,
         {_drawn_sql("'1:' || list || ':' || entry", 400)} AS g1,
         {_drawn_sql("'2:' || list || ':' || entry", 400)} AS g2,
         {_drawn_sql("'3:' || list || ':' || entry", 400)} AS g3
  FROM entries),
changes AS (
  SELECT list, entry, d0 AS day, 1 AS added FROM dated
  UNION ALL SELECT list, entry, d0 + g1, 0 FROM dated
  UNION ALL SELECT list, entry, d0 + g1 + g2, 1 FROM dated
  UNION ALL SELECT list, entry, d0 + g1 + g2 + g3, 0 FROM dated),
daily AS (SELECT list, entry, day, MAX(added) AS added FROM changes GROUP BY ALL),
held AS (
  SELECT *, LEAD(day) OVER (PARTITION BY list, entry ORDER BY day) AS until FROM daily),
asked AS (
  SELECT page_id, url, fetched, host, unnest(list_distinct([x FOR x IN list_concat(
           [array_to_string(string_split(host, '.')[i:], '.')
            FOR i IN range(1, greatest(len(string_split(host, '.')), 2))],
           [CASE WHEN p1 <> '' THEN host || p1 END, CASE WHEN p2 <> '' THEN host || p2 END])
         IF x IS NOT NULL])) AS entry
  FROM captured WHERE host <> ''),
hits AS (
  SELECT a.page_id, a.url, a.fetched, h.list, h.entry
  FROM asked a JOIN held h ON a.entry = h.entry AND h.added = 1
   AND a.fetched >= DATE '{FIRST_DAY}' + h.day
   AND (h.until IS NULL OR a.fetched < DATE '{FIRST_DAY}' + h.until)),
found AS (
  SELECT page_id, url, COUNT(*) AS n_active,
         string_agg(list || ':' || entry, ',' ORDER BY list || ':' || entry) AS active,
         arg_max(list, length(entry) * 2 + CASE WHEN list = 'allow' THEN 1 ELSE 0 END) AS verdict
  FROM hits GROUP BY page_id, url)
SELECT c.page_id, c.url, c.fetched, COALESCE(n_active, 0) AS n_active,
       COALESCE(active, '') AS active, COALESCE(verdict, 'none') AS verdict,
       COALESCE(verdict, 'none') = 'deny' AS blocked
FROM captured c LEFT JOIN found f ON c.page_id = f.page_id AND c.url IS NOT DISTINCT FROM f.url"""

OP4_SQL = """
WITH RECURSIVE worded AS (
  SELECT doc_id, regexp_extract_all(
           translate(COALESCE(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x20\x09-\x0D]+') AS w
  FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, unnest(CASE
           WHEN len(w) = 0 THEN []
           WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
           ELSE [w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] FOR i IN range(1, len(w) - 1)]
         END) AS s
  FROM worded),
sizes AS (SELECT doc_id, COUNT(*) AS n FROM shingles GROUP BY doc_id),
common AS (
  SELECT a.doc_id AS x, b.doc_id AS y, COUNT(*) AS c
  FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id),
links AS (
  SELECT x, y FROM common JOIN sizes p ON x = p.doc_id JOIN sizes q ON y = q.doc_id
  WHERE 100 * c >= 85 * (p.n + q.n - c)),
reached AS (
  SELECT x AS doc_id, x AS r FROM links
  UNION
  SELECT reached.doc_id, y FROM reached JOIN links ON r = x),
component AS (SELECT doc_id, MIN(r) AS c FROM reached GROUP BY doc_id)
SELECT d.doc_id, COALESCE(n, 0) AS n_shingles, COALESCE(c, d.doc_id) AS component_id,
       COALESCE(c, d.doc_id) = d.doc_id AS kept
FROM documents d LEFT JOIN sizes USING (doc_id) LEFT JOIN component USING (doc_id)"""

OP6_SQL = """
WITH sized AS (
  SELECT doc_id, source, md5('0:' || COALESCE(CAST(doc_id AS VARCHAR), '')) AS k,
         CAST(COALESCE(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) AS BIGINT) AS size
  FROM documents),
sources AS (
  SELECT source, CAST(SUM(size) AS BIGINT) AS source_size,
         CASE (ROW_NUMBER() OVER (ORDER BY source NULLS LAST) - 1) % 3
           WHEN 0 THEN 3 WHEN 1 THEN 1 ELSE 2 END AS w
  FROM sized GROUP BY source),
running AS (
  SELECT *, COALESCE(SUM(source_size) OVER p, 0) AS full_size, COALESCE(SUM(w) OVER p, 0) AS full_w,
         SUM(source_size) OVER () AS all_size, SUM(w) OVER () AS all_w,
         2 * source_size / CAST(w AS DOUBLE) AS ratio
  FROM sources
  WINDOW p AS (ORDER BY 2 * source_size / CAST(w AS DOUBLE), source NULLS LAST
               ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
leveled AS (
  SELECT *, CAST(1.5 * all_size - 2 * full_size AS DOUBLE) / (all_w - full_w) AS level FROM running),
goals AS (
  SELECT source, source_size,
         LEAST(CAST(2 * source_size AS DOUBLE),
               (SELECT MAX(level) FROM leveled WHERE level < ratio) * w) AS target
  FROM leveled),
queue AS (
  SELECT s.doc_id, s.size, g.source_size, g.target,
         SUM(s.size) OVER (PARTITION BY s.source ORDER BY k, s.size
                           ROWS UNBOUNDED PRECEDING) - s.size AS begins
  FROM sized s JOIN goals g ON s.source IS NOT DISTINCT FROM g.source)
SELECT doc_id, size, source_size, target,
       CAST(GREATEST(0, LEAST(size, FLOOR(target) - begins))
            + GREATEST(0, LEAST(size, FLOOR(target) - source_size - begins)) AS BIGINT) AS taken
FROM queue"""


def oracle_sql() -> dict[str, str]:
    return {
        "op2_quality": OP2_SQL,
        "op3_url_lists": OP3_SQL,
        "op4_neardup": OP4_SQL,
        "op6_mix": OP6_SQL,
        "op10_licenses": licenses_sql(),
        "op11_manifest": manifest_sql(),
    }
