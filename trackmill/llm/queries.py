"""The registered queries: thin applications of the operators to whole tables."""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trackmill.llm import (
    attention_lm,
    chunk_prints,
    collocations,
    decontaminate,
    exact_dedup,
    html_text,
    license_scan,
    mixing,
    simhash,
    token_files,
    toxicity,
    url_filter,
    vector_codes,
)
from trackmill.llm.common import UPPER, table

Runner = Callable[[SparkSession, str], DataFrame]


class LlmQuery(NamedTuple):
    run: Runner
    sql: str | None


REGISTRY: dict[str, LlmQuery] = {}


def llm_query(name: str, sql: str | None = None) -> Callable[[Runner], Runner]:
    def register(run: Runner) -> Runner:
        REGISTRY[name] = LlmQuery(run, sql)
        return run

    return register


LOWERED = f"translate(coalesce(text, ''), '{UPPER}', '{UPPER.lower()}')"


@llm_query("op1_exact_dedup", f"""
WITH hashed AS (SELECT doc_id, {LOWERED} AS t FROM documents),
digested AS (SELECT doc_id, sha256(t) AS text_sha256 FROM hashed)
SELECT doc_id, MAX(doc_id) OVER g AS keep_id, COUNT(*) OVER g AS group_size,
       doc_id = MAX(doc_id) OVER g AS kept, text_sha256
FROM digested WINDOW g AS (PARTITION BY text_sha256)""")
def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = exact_dedup.exact_groups(table(spark, sf_dir, "documents"), keep="largest")
    return groups.select(
        F.col("id").alias("doc_id"), "keep_id", "group_size", "kept", F.col("sha256").alias("text_sha256")
    )


@llm_query("op2_license_scan")
def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    scanned = license_scan.scan_licenses(table(spark, sf_dir, "documents"))
    return license_scan.licence_summary(scanned).withColumnRenamed("id", "doc_id")


@llm_query("op3_decontaminate")
def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per document and test item that it holds, with its nearest place."""
    leaks = decontaminate.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    nearest = F.min(F.struct("distance", "first_word", "last_word"))
    return (
        leaks.groupBy(F.col("id").alias("doc_id"), "item_id", "n_item_words")
        .agg(F.count("*").alias("n_places"), nearest.alias("nearest"))
        .select("doc_id", "item_id", "n_places", "n_item_words", "nearest.*")
    )


@llm_query("op4_fair_mix", r"""
WITH sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
         md5(coalesce(CAST(doc_id AS VARCHAR), '')) AS shuffle
  FROM documents),
sources AS (
  SELECT source, SUM(size) AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS place
  FROM sized GROUP BY source),
limits AS (
  SELECT *, CASE place % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight, source_size * 3 AS most FROM sources),
shares AS (
  SELECT *,
         CAST(SUM(source_size) OVER () - coalesce(SUM(most) OVER (
           ORDER BY CAST(most AS DOUBLE) / weight, source NULLS LAST
           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS DOUBLE) AS left_over,
         CAST(SUM(weight) OVER (
           ORDER BY CAST(most AS DOUBLE) / weight, source NULLS LAST
           ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS DOUBLE) AS weights_left
  FROM limits),
judged AS (SELECT *, CAST(most AS DOUBLE) <= CAST(weight AS DOUBLE) * left_over / weights_left AS held FROM shares),
rate AS (SELECT left_over, weights_left FROM judged WHERE NOT held ORDER BY weights_left DESC LIMIT 1),
targets AS (
  SELECT source, source_size,
         CASE WHEN held THEN CAST(most AS DOUBLE)
              ELSE CAST(weight AS DOUBLE) * (SELECT left_over FROM rate) / (SELECT weights_left FROM rate) END AS target
  FROM judged),
placed AS (
  SELECT d.doc_id, d.source, size, source_size, target,
         row_number() OVER (ORDER BY d.source NULLS LAST, shuffle, doc_id) AS place,
         SUM(size) OVER (PARTITION BY d.source ORDER BY shuffle, doc_id ROWS UNBOUNDED PRECEDING) AS own_words
  FROM sized d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source),
passings AS (
  SELECT *, CASE WHEN target > 0 THEN CAST(passing * source_size + own_words AS DOUBLE) / target ELSE 0 END AS finish
  FROM placed, (VALUES (0), (1), (2)) p(passing) WHERE size > 0 OR passing = 0),
queued AS (
  SELECT *, SUM(size) OVER (ORDER BY finish, source NULLS LAST, place ROWS UNBOUNDED PRECEDING) AS used FROM passings)
SELECT doc_id, size, CAST(MAX(source_size) AS BIGINT) AS source_size, MAX(target) AS target,
       CAST(SUM(CASE WHEN used <= (SELECT SUM(size) FROM sized) THEN size ELSE 0 END) AS BIGINT) AS taken
FROM queued GROUP BY place, doc_id, size""")
def op4_fair_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    mix = mixing.fair_mix(table(spark, sf_dir, "documents"))
    return mix.select(F.col("id").alias("doc_id"), "size", "source_size", "target", "taken")


@llm_query("op5_token_files")
def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = token_files.token_files(table(spark, sf_dir, "documents"))
    return found.withColumnRenamed("id", "doc_id")


@llm_query("op8_simhash")
def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = simhash.near_groups(table(spark, sf_dir, "documents"))
    digits = F.lower(F.lpad(F.hex("fingerprint"), 16, "0"))
    return groups.select(F.col("id").alias("doc_id"), digits.alias("fingerprint"), "component_id")


@llm_query("op6_html_text")
def op6_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract_main_text(table(spark, sf_dir, "pages")).withColumnRenamed("id", "page_id")


@llm_query("op9_toxicity")
def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    scored = toxicity.score_documents(docs, model)
    return scored.select(
        F.col("id").alias("doc_id"), "held_out", "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )


def _rank_sql(name: str, edges: str, seeds: str) -> str:
    """One table expression per step of the propagation; the last is ``name``."""
    kept, followed = 1 - url_filter.FOLLOWED, url_filter.FOLLOWED
    parts = [
        f"{name}_own AS (SELECT host, {seeds} / CAST(n AS DOUBLE) * {kept!r}::DOUBLE AS own FROM counts WHERE {seeds} > 0)",
        f"{name}_shares AS (SELECT src, dst, n / SUM(n) OVER (PARTITION BY src) AS share FROM {edges})",
        f"{name}_0 AS (SELECT host, own AS rank FROM {name}_own)",
    ]
    for step in range(url_filter.STEPS):
        parts.append(f"""{name}_{step + 1} AS MATERIALIZED (SELECT host, SUM(part) AS rank FROM (
          SELECT dst AS host, rank * share * {followed!r}::DOUBLE AS part FROM {name}_{step} JOIN {name}_shares ON host = src
          UNION ALL SELECT host, own FROM {name}_own) GROUP BY host)""")
    return ",\n".join([*parts, f"{name} AS (SELECT * FROM {name}_{url_filter.STEPS})"])


def _rule_sql(column: str) -> str:
    """The longest rule's ``column`` that fits, as a chain of cases."""
    longest = sorted(url_filter.RULES, key=lambda r: -len(r.host + r.path))
    cases = [
        f"WHEN (host = '{r.host}' OR suffix(host, '.{r.host}')) AND starts_with(path, '{r.path}') "
        f"THEN '{r.host + r.path if column == 'rule' else r.verdict}'"
        for r in longest
    ]
    return f"CASE {' '.join(cases)} END"


def _host_sql(url: str) -> str:
    return f"translate(regexp_extract({url}, '{url_filter.URL}', 1), '{UPPER}', '{UPPER.lower()}')"


URL_FILTER_SQL = f"""
WITH named AS (
  SELECT page_id, {_host_sql("coalesce(url, '')")} AS host,
         regexp_extract(coalesce(url, ''), '{url_filter.URL}', 2) AS path, coalesce(html, '') AS html
  FROM pages),
ruled AS (SELECT *, {_rule_sql('rule')} AS rule, {_rule_sql('verdict')} AS fit FROM named),
counts AS (
  SELECT host, COUNT(*) AS n, COUNT(*) FILTER (fit = 'allow') AS allowed, COUNT(*) FILTER (fit = 'block') AS blocked
  FROM ruled WHERE host <> '' GROUP BY host),
links AS (
  SELECT host AS src, UNNEST(list_distinct(regexp_extract_all(html, '{url_filter.LINK.replace("'", "''")}', 1))) AS link
  FROM named WHERE host <> ''),
targets AS (SELECT src, {_host_sql("'http:' || regexp_replace(link, '(?i)^https?:', '')")} AS dst FROM links),
edges AS (SELECT src, dst, COUNT(*) AS n FROM targets WHERE dst <> '' AND dst <> src GROUP BY src, dst),
turned AS (SELECT dst AS src, src AS dst, n FROM edges),
{_rank_sql('trust', 'edges', 'allowed')},
{_rank_sql('distrust', 'turned', 'blocked')}
SELECT page_id, r.host, path, rule,
  coalesce(fit, CASE WHEN coalesce(d.rank, 0) >= {url_filter.LEAST_DISTRUST * (1 - url_filter.FOLLOWED)!r}::DOUBLE
    AND coalesce(d.rank, 0) > coalesce(t.rank, 0) THEN 'block' ELSE 'allow' END) AS verdict
FROM ruled r LEFT JOIN trust t ON r.host = t.host LEFT JOIN distrust d ON r.host = d.host"""


@llm_query("op10_url_filter", URL_FILTER_SQL)
def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    # The fixed threshold, which the SQL names too.
    judged = url_filter.judge_urls(table(spark, sf_dir, "pages"), least_distrust=url_filter.LEAST_DISTRUST)
    return judged.select(F.col("id").alias("page_id"), "host", "path", "rule", "verdict")


@llm_query("op7_attention_lm")
def op7_attention_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return attention_lm.score_texts(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


def _codebook_round_sql(turn: int) -> str:
    """Nearest entries by the codebooks of a round, as ``distance * 256 + entry``."""
    return f"""near_{turn} AS MATERIALIZED (
  SELECT rid, p, MIN(square * 256 + e) AS best FROM (
    SELECT c.rid, c.p, b.e, SUM((c.x - b.x) * (c.x - b.x)) AS square
    FROM components c JOIN books_{turn} b ON c.p = b.p AND c.i = b.i GROUP BY c.rid, c.p, b.e) GROUP BY rid, p)"""


def _codebook_move_sql(turn: int) -> str:
    return f"""books_{turn + 1} AS MATERIALIZED (
  SELECT b.p, b.e, b.i, coalesce(m.x, b.x) AS x FROM books_{turn} b LEFT JOIN (
    SELECT c.p, CAST(best % 256 AS BIGINT) AS e, c.i,
           CAST((SUM(x) - ((SUM(x) % COUNT(*)) + COUNT(*)) % COUNT(*)) // COUNT(*) AS BIGINT) AS x
    FROM components c JOIN near_{turn} n ON c.rid = n.rid AND c.p = n.p GROUP BY ALL) m
  ON b.p = m.p AND b.e = m.e AND b.i = m.i)"""


_TURNS = vector_codes.ROUNDS
VECTOR_CODES_SQL = f"""
WITH kept AS (
  SELECT row_number() OVER (ORDER BY vec_id NULLS LAST, embedding) AS rid, vec_id, label, embedding,
         len(embedding) // {vector_codes.PARTS} AS width
  FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
components AS MATERIALIZED (
  SELECT rid, (place - 1) // width AS p, (place - 1) % width AS i,
         CAST(floor(CAST(embedding[place] AS DOUBLE) * {vector_codes.SCALE}) AS BIGINT) AS x
  FROM (SELECT *, UNNEST(generate_series(1, len(embedding))) AS place FROM kept)),
books_0 AS MATERIALIZED (SELECT p, rid - 1 AS e, i, x FROM components WHERE rid <= {vector_codes.ENTRIES}),
{", ".join(_codebook_round_sql(t) + ", " + _codebook_move_sql(t) for t in range(_TURNS))},
{_codebook_round_sql(_TURNS)},
coded AS (
  SELECT rid, string_agg(printf('%02x', CAST(best % 256 AS INTEGER)), '' ORDER BY p) AS code,
         CAST(SUM(best // 256) AS BIGINT) AS error
  FROM near_{_TURNS} GROUP BY rid)
SELECT vec_id, code, error, CAST(SUM(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
  (SELECT sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY p, e, i)) FROM books_{_TURNS}) AS codebooks_sha256
FROM kept JOIN coded USING (rid)"""


@llm_query("op13_vector_codes", VECTOR_CODES_SQL)
def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded, codebooks = vector_codes.vector_codes(table(spark, sf_dir, "embeddings"))
    digest = F.lit(vector_codes.codebook_digest(codebooks))
    return coded.select(
        F.col("id").alias("vec_id"), "code", "error", "label_error", digest.alias("codebooks_sha256")
    )


@llm_query("op12_chunk_prints")
def op12_chunk_prints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunk_prints.chunk_prints(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


# DuckDB cuts and joins lists of words; sums of whole numbers are exact there.
COLLOCATIONS_SQL = f"""
WITH pieces AS (
  SELECT coalesce(lang, '{collocations.ABSENT}') AS lang,
         regexp_extract_all(UNNEST(regexp_split_to_array({LOWERED}, '[.,;:!?\\x0A-\\x0D]')), '[^\\x20\\x09]+') AS words
  FROM documents),
places AS (SELECT lang, words, UNNEST(generate_series(1, len(words))) AS place FROM pieces),
counts AS MATERIALIZED (
  SELECT lang, size, array_to_string(list_slice(words, place, place + size - 1), ' ') AS phrase, COUNT(*) AS a
  FROM places, (SELECT UNNEST(generate_series(1, {collocations.MOST_WORDS})) AS size) s
  WHERE place + size - 1 <= len(words) GROUP BY ALL),
totals AS (SELECT lang, CAST(SUM(a) AS BIGINT) AS n FROM counts WHERE size = 1 GROUP BY lang),
candidates AS MATERIALIZED (
  SELECT *, string_split(phrase, ' ') AS words FROM counts WHERE size > 1 AND a >= {collocations.LEAST_COUNT}),
cuts AS (SELECT *, UNNEST(generate_series(1, size - 1)) AS k FROM candidates),
scored AS (
  SELECT c.lang, c.phrase, c.a, k, h.a AS l, t.a AS r,
         CAST((CAST({collocations.SCORE} AS HUGEINT) * c.a * c.a) // (CAST(h.a AS HUGEINT) * t.a) AS BIGINT) AS score
  FROM cuts c JOIN counts h ON c.lang = h.lang AND h.phrase = array_to_string(list_slice(c.words, 1, k), ' ')
    JOIN counts t ON c.lang = t.lang AND t.phrase = array_to_string(list_slice(c.words, k + 1, c.size), ' ')),
lowest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
held AS (
  SELECT DISTINCT c.lang, c.phrase FROM candidates c JOIN (
    SELECT lang, size, a, array_to_string(list_slice(words, i, j), ' ') AS phrase FROM candidates,
      (SELECT UNNEST(generate_series(1, {collocations.MOST_WORDS})) AS i) x,
      (SELECT UNNEST(generate_series(1, {collocations.MOST_WORDS})) AS j) y WHERE i <= j AND j <= size) o ON c.lang = o.lang AND c.phrase = o.phrase AND o.size > c.size
  WHERE 100 * o.a >= {collocations.HELD_PERCENT} * c.a),
ranked AS (
  SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank, phrase, a, l, r, score
  FROM lowest ANTI JOIN held USING (lang, phrase))
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN totals USING (lang) WHERE rank <= {collocations.TOP}"""


@llm_query("op11_collocations", COLLOCATIONS_SQL)
def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))
