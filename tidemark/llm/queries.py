"""The registered query of each operator, with production parameters over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import bpe, edits, html, infill, lexical, mixing, pieces, quality, rules, simhash, tokens, urls, warc
from tidemark.plans.storage import scratch_dir, store


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = mixing.mix(_table(spark, sf_dir, "documents"), scratch_dir(spark), ["doc_id"])
    taken = (F.col("copies") * F.col("size")).alias("taken")
    return found.select("_row.doc_id", "size", "source_size", "target", taken)


def op2_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages")
    found = html.extract(pages, html.train(pages))
    return found.withColumn("n_chars", F.length("text").cast("long"))


def op3_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_dir(spark)
    manifest = store(tokens.write_shards(_table(spark, sf_dir, "documents"), f"{folder}/shards"), folder, "manifest")
    starts = tokens.shard_starts(manifest, folder)
    read = tokens.read_shards(manifest, with_ids=False).join(starts, "path")
    return read.select("doc_id", (F.col("start") + F.col("local_start")).alias("start"), "n_tokens", "ids_crc32")


def good_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("good"))


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The source of a document is its host, its language the path in it."""
    found = quality.classify(_table(spark, sf_dir, "documents"), good_labels(spark, sf_dir), scratch_dir(spark), keep=["doc_id"])
    return found.select("_row.doc_id", "evidence", "host_posterior", "path_posterior", "posterior", "kept")


def op5_edits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edits.fingerprint_edits(_table(spark, sf_dir, "documents"), scratch_dir(spark))


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_dir(spark)
    index = store(warc.write_archives(_table(spark, sf_dir, "pages"), f"{folder}/archives"), folder, "index")
    return warc.read_archives(warc.frames_of(index), with_payload=False).drop("url")


def op7_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The labels of the document with the page's number serve as the page's outcome: bad if of low quality or toxic."""
    bad = ((F.col("quality") == 0) | (F.col("toxic") == 1)).cast("int").alias("bad")
    outcomes = _table(spark, sf_dir, "labels").select(F.col("doc_id").alias("page_id"), bad)
    found = urls.judge(_table(spark, sf_dir, "pages"), outcomes, scratch_dir(spark))
    return found.select("page_id", "host", "path", "rule", "verdict")


def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = bpe.encode_documents(_table(spark, sf_dir, "documents"))
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ",").cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


def trusted_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents labelled good and not toxic."""
    return _table(spark, sf_dir, "labels").where("quality = 1 and not coalesce(toxic, 0) = 1").select("doc_id")


def op9_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = rules.judge(_table(spark, sf_dir, "documents"), trusted_documents(spark, sf_dir), scratch_dir(spark), keep=["doc_id"])
    return found.select("_row.doc_id", *found.columns[1:])


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(_table(spark, sf_dir, "documents"), scratch_dir(spark))
    return found.select("doc_id", simhash.hex_print(F.col("fp")).alias("fingerprint"), "component_id")


def op11_infill(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = infill.fill_in_middle(_table(spark, sf_dir, "documents"), keep=["doc_id"])
    text = infill.restored(F.col("output"), F.col("form"))
    return found.select(
        "_row.doc_id",
        "n",
        "form",
        "prefix_chars",
        "middle_chars",
        F.sha2(F.col("output").cast("binary"), 256).alias("output_sha256"),
        F.sha2(text.cast("binary"), 256).alias("restored_sha256"),
    )


def op12_lexical(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_dir(spark)
    index, n = lexical.build_index(_table(spark, sf_dir, "documents"), folder)
    return lexical.search(index, n, _table(spark, sf_dir, "benchmark"), folder)


def op13_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = pieces.encode_documents(_table(spark, sf_dir, "documents"), scratch_dir(spark))
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " ").cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


QUERIES = {"op1_mixing": op1_mixing, "op2_html": op2_html, "op3_tokens": op3_tokens, "op4_quality": op4_quality, "op5_edits": op5_edits, "op6_warc": op6_warc, "op7_urls": op7_urls, "op8_bpe": op8_bpe, "op9_rules": op9_rules, "op10_simhash": op10_simhash, "op11_infill": op11_infill, "op12_lexical": op12_lexical, "op13_pieces": op13_pieces}
# Which url's host has been seen with which outcomes, shrunk level by level as in ``urls.reputations``.
_STRENGTH = """
  SELECT 1 / greatest(0.001, least(0.5, CASE WHEN g < 2 OR k = 0 OR k = n OR n - q / n - (g - 1) <= 0 THEN 0.5
      ELSE ((s - k * k / n) / (k / n * (1 - k / n)) - (g - 1)) / (n - q / n - (g - 1)) END)) - 1 AS w
  FROM (SELECT sum(k) k, sum(n) n, sum(n * n) q, count(*)::DOUBLE g, sum(k * k / n) s FROM {level})
"""
_POSTERIOR = """
  SELECT {key}, m, m * (1 - m) / (total + 1) AS v
  FROM (SELECT *, (k + prior * w) / (n + w) AS m, n + w AS total FROM {level} JOIN ({parent}) USING ({on}) CROSS JOIN {level}_w)
"""
_OP7 = f"""
WITH parsed AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages
), cut AS (
  SELECT page_id, translate(regexp_extract(rest, '^([^/?#]*)([^?#]*)', 1), '{urls.UPPER}', '{urls.LOWER}') AS host,
    regexp_extract(rest, '^([^/?#]*)([^?#]*)', 2) AS path
  FROM parsed
), page AS (
  SELECT *, regexp_extract(host, '([^.]*[.])?[^.]*$', 0) AS domain, regexp_extract(host, '[^.]*$', 0) AS suffix FROM cut
), hosts AS (
  SELECT host, any_value(domain) AS domain, any_value(suffix) AS suffix, count(*)::DOUBLE AS n,
    sum(CASE WHEN quality = 0 OR toxic = 1 THEN 1 ELSE 0 END)::DOUBLE AS k
  FROM page JOIN labels ON doc_id = page_id WHERE quality = 0 OR toxic = 1 OR (quality IS NOT NULL AND toxic IS NOT NULL)
  GROUP BY host
), domains AS (
  SELECT domain, any_value(suffix) AS suffix, sum(n) AS n, sum(k) AS k FROM hosts GROUP BY domain
), suffixes AS (
  SELECT suffix, 1 AS one, sum(n) AS n, sum(k) AS k FROM domains GROUP BY suffix
), hosts_w AS ({_STRENGTH.format(level="hosts")}), domains_w AS ({_STRENGTH.format(level="domains")}),
suffixes_w AS ({_STRENGTH.format(level="suffixes")}),
s AS ({_POSTERIOR.format(key="suffix", level="suffixes", parent="SELECT 1 AS one, sum(k) / sum(n) AS prior FROM suffixes", on="one")}),
d AS ({_POSTERIOR.format(key="domain", level="domains", parent="SELECT suffix, m AS prior FROM s", on="suffix")}),
h AS ({_POSTERIOR.format(key="host", level="hosts", parent="SELECT domain, m AS prior FROM d", on="domain")}),
rated AS (
  SELECT page.*, coalesce(h.m, d.m, s.m) - 1.645 * sqrt(coalesce(h.v, d.v, s.v)) AS bound,
    CASE WHEN ('.' || host) LIKE '%.example.net' AND path LIKE '/en/%' THEN 'example.net/en/'
      WHEN ('.' || host) LIKE '%.example.com' AND path LIKE '/de/%' THEN 'example.com/de/'
      WHEN ('.' || host) LIKE '%.org' AND path LIKE '/fr/%' THEN 'org/fr/'
      WHEN ('.' || host) LIKE '%.net' AND path LIKE '/%' THEN 'net/' END AS rule
  FROM page LEFT JOIN h USING (host) LEFT JOIN d USING (domain) LEFT JOIN s USING (suffix)
)
SELECT page_id, host, path, rule, CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' WHEN rule IS NOT NULL THEN 'allow'
  WHEN coalesce(bound, 0) > 0.5 THEN 'block' ELSE 'allow' END AS verdict
FROM rated
"""

_OP1 = r"""
WITH sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size FROM documents
), per AS (
  SELECT source, sum(size)::BIGINT AS source_size, 3.0 * sum(size)::DOUBLE AS most,
    CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0 ELSE 1.0 END AS weight
  FROM sized GROUP BY source
), levels AS (
  SELECT *, (sum(source_size::DOUBLE) OVER () - coalesce(sum(most::DOUBLE) OVER w, 0)) / (sum(weight) OVER () - coalesce(sum(weight) OVER w, 0))
      AS level, row_number() OVER (ORDER BY most / weight, source NULLS LAST) AS place
  FROM per WINDOW w AS (ORDER BY most / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), water AS (
  SELECT level FROM levels WHERE level < most / weight ORDER BY place LIMIT 1
), targets AS (
  SELECT source, source_size, least(most, coalesce((SELECT level FROM water) * weight, most))::DOUBLE AS target,
    ('0x' || substr(md5('mix|' || coalesce('=' || source, 'null')), 1, 8))::BIGINT::DOUBLE / 4294967296 AS u
  FROM levels
), ranked AS (
  SELECT sized.*, source_size, target, u, (row_number() OVER (PARTITION BY sized.source ORDER BY size DESC, doc_id))::DOUBLE AS place,
    CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS rate
  FROM sized JOIN targets ON sized.source IS NOT DISTINCT FROM targets.source
)
SELECT doc_id, size, source_size, target, ((floor(place * rate + u) - floor((place - 1) * rate + u)) * size)::BIGINT AS taken FROM ranked
"""

_OP11 = r"""
WITH unit AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') AS units,
    sha256('7:' || coalesce(doc_id::VARCHAR, '')) AS digest
  FROM documents
), drawn AS (
  SELECT doc_id, text, units, len(units)::BIGINT AS n, list_transform([1, 9, 17, 25], lambda k: ('0x' || substr(digest, k, 8))::BIGINT) AS h FROM unit
), cut AS (
  SELECT *, least(h[1] % (n + 1), h[2] % (n + 1)) AS a, greatest(h[1] % (n + 1), h[2] % (n + 1)) AS b,
    CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h[3] % 100 >= 100 THEN 'plain'
      WHEN h[4] % 100 < 50 THEN 'spm' ELSE 'psm' END AS form
  FROM drawn
), part AS (
  SELECT *, coalesce(array_to_string(units[1:a], ''), '') AS p, coalesce(array_to_string(units[a + 1:b], ''), '') AS m,
    coalesce(array_to_string(units[b + 1:n], ''), '') AS s
  FROM cut
)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(p)::BIGINT END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(m)::BIGINT END AS middle_chars,
  sha256(CASE form WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m WHEN 'spm' THEN '<S>' || s || '<P>' || p || '<M>' || m ELSE text END) AS output_sha256,
  sha256(text) AS restored_sha256
FROM part
"""

_OP12 = rf"""
WITH doc AS (
  SELECT row_number() OVER () AS row, doc_id, regexp_extract_all(translate(coalesce(text, ''), '{lexical.UPPER}', '{lexical.LOWER}'), '{lexical.TERM}') AS terms
  FROM documents
), total AS (
  SELECT count(*)::BIGINT AS docs, sum(len(terms))::BIGINT AS length FROM doc WHERE len(terms) > 0
), item AS (
  SELECT row_number() OVER () AS item, item_id,
    list_distinct(regexp_extract_all(translate(coalesce(text, ''), '{lexical.UPPER}', '{lexical.LOWER}'), '{lexical.TERM}')) AS terms
  FROM benchmark
), posting AS (
  SELECT row, any_value(doc_id) AS doc_id, term, count(*)::BIGINT AS tf, any_value(n) AS n
  FROM (SELECT row, doc_id, len(terms)::BIGINT AS n, unnest(terms) AS term FROM doc) GROUP BY row, term
), weight AS (
  SELECT term, floor(1000 * ln((2.0::DOUBLE * (SELECT docs FROM total) + 2) / (2 * count(*) + 1)))::BIGINT AS w FROM posting GROUP BY term
), scored AS (
  SELECT item, any_value(item_id) AS item_id, row, any_value(doc_id) AS doc_id,
    sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * (SELECT docs FROM total)) // (SELECT length FROM total)))))::BIGINT AS score
  FROM (SELECT item, item_id, unnest(terms) AS term FROM item) JOIN weight USING (term) JOIN posting USING (term) GROUP BY item, row
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id NULLS LAST)::INTEGER AS rank FROM scored WHERE score > 0
)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 50
"""

SQL: dict[str, str] = {"op1_mixing": _OP1, "op7_urls": _OP7, "op11_infill": _OP11, "op12_lexical": _OP12}
