"""The text operators as named queries over the given tables, with their SQL where it can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from smeltery.llm import (
    centroids, conversation_repair, decontaminate, exact_dedup, jaccard_join, language_id, line_dedup, mixing, pii,
    token_rollup, toxicity, url_filter, warc,
)
from smeltery.llm.common import UPPER, table
from smeltery.workspace import new_folder

Run = Callable[[SparkSession, str], DataFrame]

RUNS: dict[str, Run] = {}
ORACLES: dict[str, str] = {}

_LOWER = f"translate({{}}, '{UPPER}', '{UPPER.lower()}')"


def query(oracle: str | None = None) -> Callable[[Run], Run]:
    def add(run: Run) -> Run:
        RUNS[run.__name__] = run
        if oracle:
            ORACLES[run.__name__] = oracle
        return run

    return add


@query()
def op1_ngram_jaccard_join(spark, sf):
    return jaccard_join.jaccard_components(table(spark, sf, "documents").select("doc_id", "text"))


@query()
def op2_pii(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text")
    return pii.find(docs, pii.fit(docs))


@query(f"""
WITH d AS (SELECT doc_id, sha256({_LOWER.format("coalesce(text, '')")}) AS text_sha256 FROM documents)
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       doc_id = max(doc_id) OVER g AS kept, text_sha256
FROM d WINDOW g AS (PARTITION BY text_sha256)""")
def op3_exact_dedup(spark, sf):
    return exact_dedup.exact_duplicates(table(spark, sf, "documents").select("doc_id", "text"))


@query()
def op4_toxicity(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text")
    return toxicity.score_texts(docs, toxicity.fit(docs, table(spark, sf, "labels")))


@query()
def op5_line_dedup(spark, sf):
    """Per document its lines, how many stay, and the digest of what stays."""
    left = line_dedup.deduplicated(table(spark, sf, "documents").select("doc_id", "text"))
    return left.select("doc_id", "n_lines", "n_kept", F.sha2("text", 256).alias("kept_sha256"))


#: The rules to apply.
URL_RULES = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"),
             ("com", "/fr/", "allow"), ("com", "/de/", "block")]


@query(f"""
WITH rules(rhost, rpath, rverdict) AS (VALUES {', '.join(map(str, URL_RULES))}),
u AS (SELECT page_id, {_LOWER.format("regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1)")} AS host,
             regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path FROM pages),
fit AS (SELECT page_id, host, path, rhost || rpath AS rule, rverdict,
               row_number() OVER (PARTITION BY page_id ORDER BY length(rhost || rpath) DESC NULLS LAST) AS place
        FROM u LEFT JOIN rules ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath))
SELECT page_id, host, path, rule, coalesce(rverdict, 'allow') AS verdict FROM fit WHERE place = 1""")
def op6_url_filter(spark, sf):
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return url_filter.judge_urls(table(spark, sf, "pages").select("page_id", "url"), rules).drop("url")


@query()
def op7_mixing(spark, sf):
    return mixing.mix_by_source(table(spark, sf, "documents").select("doc_id", "text", "source"))


@query()
def op8_token_counts(spark, sf):
    rollup = token_rollup.TokenRollup(spark, new_folder(spark, "token-rollup"))
    return token_rollup.corpus_changes(spark, table(spark, sf, "documents"), rollup)


@query()
def op9_decontamination(spark, sf):
    return decontaminate.judged(table(spark, sf, "documents").select("doc_id", "text"), table(spark, sf, "benchmark"))


@query("""
WITH p AS (SELECT page_id, coalesce(html, '') AS body, sha1(coalesce(html, '')) AS hex FROM pages),
f AS (SELECT *, min(page_id) OVER (PARTITION BY hex) AS first FROM p)
SELECT page_id, strlen(body) AS payload_bytes,
       array_to_string(list_transform(range(32), lambda k: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + CAST(
           (CAST('0x' || substr(hex, CAST(1 + 5 * (k // 4) AS INTEGER), 5) AS BIGINT) >> CAST(5 * (3 - k % 4) AS BIGINT)) & 31
           AS INTEGER), 1)), '') AS payload_digest,
       CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first THEN first END AS refers_to
FROM f""")
def op10_warc(spark, sf):
    return warc.pages_through_warc(spark, table(spark, sf, "pages"), split_bytes=2 << 20)


def _rounds_sql() -> str:
    """Three rounds of assignment and integer means, and the last assignment, as common table expressions."""
    gap = "list_sum(list_transform(list_zip(k.v, c.v), lambda z: (z[1] - z[2]) * (z[1] - z[2])))"
    steps = []
    for r in range(4):
        steps.append(f"""a{r} AS (SELECT rid, vec_id, v, best.cluster AS cluster, best.d AS distance FROM (
  SELECT k.rid, any_value(k.vec_id) AS vec_id, any_value(k.v) AS v, min({{'d': CAST({gap} AS BIGINT), 'cluster': c.cluster}}) AS best
  FROM kept k CROSS JOIN c{r} c GROUP BY k.rid))""")
        if r < 3:
            steps.append(f"""m{r} AS (SELECT cluster, list((s - ((s % n) + n) % n) // n ORDER BY p) AS v FROM (
  SELECT cluster, p, sum(v[p]) AS s, count(*) AS n FROM a{r}, range(1, 65) g(p) GROUP BY cluster, p) GROUP BY cluster)""")
            steps.append(f"""c{r + 1} AS (SELECT c.cluster, CAST(coalesce(m.v, c.v) AS HUGEINT[]) AS v
  FROM c{r} c LEFT JOIN m{r} m ON m.cluster = c.cluster)""")
    return ",\n".join(steps)


@query(f"""
WITH kept AS (
  SELECT row_number() OVER () AS rid, vec_id,
         CAST(list_transform(embedding, lambda x: floor(64 * CAST(x AS DOUBLE))) AS HUGEINT[]) AS v
  FROM embeddings WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64),
c0 AS (SELECT row_number() OVER (ORDER BY sha256('1:' || CAST(vec_id AS VARCHAR)), v) - 1 AS cluster, v
       FROM kept QUALIFY cluster < 16),
{_rounds_sql()}
SELECT vec_id, CAST(cluster AS INTEGER) AS cluster, distance,
       CAST(sum(distance) OVER (PARTITION BY cluster) AS BIGINT) AS cluster_inertia,
       CAST(sum(distance) OVER () AS BIGINT) AS inertia,
       sha256(array_to_string(c3.v, ',')) AS centroid_sha256
FROM a3 JOIN c3 USING (cluster)""")
def op11_centroid_clustering(spark, sf):
    return centroids.cluster(table(spark, sf, "embeddings").select("vec_id", "embedding"))


@query()
def op12_language_id(spark, sf):
    """A row without doc_id is neither learned from nor, as its fold is unknown, counted as seen."""
    docs = table(spark, sf, "documents").select("doc_id", "text", "lang")
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4
    held_out = F.coalesce(fold == 2, F.lit(True))
    model = language_id.fit(docs, ~held_out)
    return language_id.predict(docs.select("doc_id", held_out.alias("held_out"), "text"), model).drop("text")


# Repair in SQL: states are 0 start, 1 after system, 2 after user, 3 after assistant; up to two rows are inserted at a place.
_NEXT_STATE = "CASE {0} WHEN 2 THEN 3 ELSE 2 END"
_AFTER = {0: "state", 1: _NEXT_STATE.format("state"), 2: _NEXT_STATE.format(f"({_NEXT_STATE.format('state')})")}
_ROLE_AFTER = "CASE {0} WHEN 2 THEN 'assistant' ELSE 'user' END"


def _inserted_sql(source: str, more: str) -> str:
    """``source`` with none, one and two rows inserted."""
    parts = []
    for n, after in _AFTER.items():
        lines = [f"{_ROLE_AFTER.format(f'({_AFTER[i]})')} || ':'" for i in range(n)]
        parts.append(f"SELECT c, i{more}, {after} AS state, cost + {2 * n} AS cost, audit || '{'I' * n}' AS audit, "
                     f"list_concat(lines, CAST([{', '.join(lines)}] AS VARCHAR[])) AS lines FROM {source}")
    return " UNION ALL ".join(parts)


_EDITS = """SELECT c, i + 1 AS i, n, state, cost + 3 AS cost, audit || 'D' AS audit, lines FROM ready
  UNION ALL SELECT c, i + 1, n, CASE initial WHEN 's' THEN 1 WHEN 'u' THEN 2 ELSE 3 END, cost + CAST(fault = 'truncated' AS INTEGER),
    audit || 'K', list_append(lines, role || ':' || text) FROM ready
  WHERE fault IN ('', 'truncated') AND (initial = 's' AND state = 0 OR initial = 'u' AND state <> 2 OR initial = 'a' AND state = 2)
  UNION ALL SELECT c, i + 1, n, CASE state WHEN 2 THEN 3 ELSE 2 END, cost + 2 + CAST(fault = 'truncated' AS INTEGER), audit || 'R',
    list_append(lines, CASE state WHEN 2 THEN 'assistant' ELSE 'user' END || ':' || text) FROM ready WHERE fault IN ('', 'truncated')"""


@query(f"""
WITH RECURSIVE crc AS (
  SELECT list(v ORDER BY b) AS t FROM (SELECT b, list_reduce(list_prepend(CAST(b AS UBIGINT), CAST(range(8) AS UBIGINT[])),
    lambda v, k: CASE WHEN v & 1 = 1 THEN xor(v >> 1, CAST(3988292384 AS UBIGINT)) ELSE v >> 1 END) AS v FROM range(256) r(b))),
keyed AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS k FROM conversations),
drawn AS (
  SELECT keyed.*, xor(list_reduce(list_prepend(CAST(4294967295 AS UBIGINT),
           list_transform(string_split(k, ''), lambda x: CAST(ascii(x) AS UBIGINT))),
           lambda v, b: xor(v >> 8, t[CAST(xor(v, b) & 255 AS INTEGER) + 1])), CAST(4294967295 AS UBIGINT)) % 20 AS draw
  FROM keyed, crc),
damaged AS (
  SELECT conv_id, turn, CASE WHEN draw = 4 THEN 'user' ELSE role END AS role,
         CASE draw WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM drawn, range(CASE WHEN draw = 3 THEN 2 ELSE 1 END) WHERE draw <> 0),
placed AS (
  SELECT *, dense_rank() OVER (ORDER BY conv_id NULLS FIRST) AS c,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text)) AS i,
         rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS trimmed FROM damaged),
rows AS MATERIALIZED (
  SELECT *, substr(role, 1, 1) AS initial, count(*) OVER (PARTITION BY c) AS n,
         CASE WHEN trimmed = '' THEN 'blank' WHEN row_number() OVER (PARTITION BY c, role, text ORDER BY i) > 1 THEN 'duplicate'
              WHEN right(trimmed, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault,
         lag(substr(role, 1, 1)) OVER (PARTITION BY c ORDER BY i) AS last FROM placed),
walk AS (
  SELECT c, CAST(0 AS BIGINT) AS i, any_value(n) AS n, 0 AS state, CAST(0 AS BIGINT) AS cost, '' AS audit, CAST([] AS VARCHAR[]) AS lines
  FROM rows GROUP BY c
  UNION ALL
  SELECT c, i, n, state, b.cost, b.audit, b.lines FROM (
    SELECT c, i, any_value(n) AS n, state, min({{'cost': cost, 'audit': audit, 'lines': lines}}) AS b
    FROM (WITH here AS (SELECT w.*, r.initial, r.fault, r.role, r.text FROM walk w JOIN rows r ON r.c = w.c AND r.i = w.i + 1),
          ready AS ({_inserted_sql("here", ", n, initial, fault, role, text")})
          {_EDITS}) GROUP BY c, i, state)),
ended AS (
  SELECT c, min({{'cost': cost, 'audit': audit, 'lines': lines}}) AS b
  FROM (WITH here AS (SELECT * FROM walk WHERE i = n) {_inserted_sql("here", "")}) WHERE state IN (0, 3) GROUP BY c),
figures AS (
  SELECT c, any_value(conv_id) AS conv_id, CAST(coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS BIGINT) AS gaps,
         count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
         count(*) FILTER (fault = 'truncated') AS truncated,
         count(*) FILTER (last || initial NOT IN ('su', 'ua', 'au')) AS illegal FROM rows GROUP BY c)
SELECT o.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, CAST(coalesce(b.cost, 0) AS BIGINT) AS cost,
       coalesce(b.audit, '') AS audit, sha256(coalesce(array_to_string(b.lines, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o
LEFT JOIN figures f ON f.conv_id IS NOT DISTINCT FROM o.conv_id LEFT JOIN ended e ON e.c = f.c""")
def op13_conversation_repair(spark, sf):
    return conversation_repair.repaired_after_damage(table(spark, sf, "conversations"))
