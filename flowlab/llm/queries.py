"""The training-data operators applied to the driver's tables, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowlab.llm import ann, bpe, chat, decontam, filter_audit, jaccard, langid, lines, packing, repair, secrets, token_counts, urls
from flowlab.llm.common import stage, table

#: The URL rules of op5.
URL_RULES = [("com", "/en/", "block"), ("example.com", "/en/7", "allow"), ("net", "/de/", "allow"), ("example.net", "/de/8", "block"), ("org", "/es/", "block")]


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return langid.identify(docs.select("doc_id", "text", langid.held_out(F.col("doc_id")).alias("held_out")), langid.fit(docs)).drop("text")


def op2_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = chat.rotate_perspectives(table(spark, sf_dir, "conversations"))
    spans = F.array_join(F.transform("mask", lambda m: F.concat_ws(":", m["start"], m["end"])), ",")
    return out.withColumn("mask", spans)


def op3_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    paths = stage(secrets.addressed(docs), "paths")
    # two generations of rules: the second run scans for what the first one did not know
    first = stage(secrets.scan(docs, secrets.pending_blobs(paths, None, secrets.BASE), secrets.BASE), "ledger")
    second = stage(secrets.scan(docs, secrets.pending_blobs(paths, first)), "ledger")
    base = tuple(r.kind for r in secrets.BASE)
    found = secrets.findings_by_path(paths, first.unionByName(second))
    return found.select(
        "doc_id",
        *[F.size(secrets.of_kinds(F.col("findings"), (k,))).cast("long").alias(f"n_{k}") for k in base],
        F.sha2(secrets.listed(F.col("findings"), base), 256).alias("base_sha256"),
        secrets.listed(F.col("findings")).alias("spans"),
    )


def op4_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op5_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return urls.judge_urls(table(spark, sf_dir, "pages").select("page_id", "url"), rules).select("page_id", "host", "path", "rule", "verdict")


def op6_byte_level_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_documents(table(spark, sf_dir, "documents").select("doc_id", "text"), with_ids=False)


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.answers(token_counts.length_histogram(table(spark, sf_dir, "documents")))


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = lines.dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_lines", F.array_join("removed", ",").alias("removed"), F.sha2("text", 256).alias("text_sha256"))


def op9_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(table(spark, sf_dir, "embeddings"))


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contaminations(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(filter_audit.failing(table(spark, sf_dir, "documents")), table(spark, sf_dir, "labels"))


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    rows = repair.damage(said)
    planned = stage(repair.plans(rows, said), "plans")
    digests = repair.digests(rows, planned).withColumnRenamed("conv_id", "d_conv")
    return planned.join(digests, F.col("conv_id").eqNullSafe(F.col("d_conv"))).drop("d_conv")


def op13_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(stage(packing.pieces(table(spark, sf_dir, "documents")), "pieces"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    every = (
        op1_language_id, op2_chat_formatting, op3_secret_scans, op4_ngram_jaccard_join, op5_url_filters,
        op6_byte_level_bpe, op7_token_counts, op8_line_dedup, op9_nearest_neighbours, op10_decontamination,
        op11_filter_audit, op12_conversation_repair, op13_best_fit_packing,
    )
    return {f.__name__: f for f in every}


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _secrets_sql() -> str:
    parts = []
    for i, r in enumerate(secrets.RULES):
        pattern = _quoted(r.pattern)
        parts.append(
            f"SELECT row, {i} AS ord, '{r.kind}' AS kind, {r.least} AS least, regexp_extract_all(txt, {pattern}, 0) AS m, "
            f"regexp_extract_all(txt, {pattern}, {r.group}) AS g, regexp_split_to_array(txt, {pattern}) AS p FROM d"
        )
    return f"""
    WITH d AS (SELECT row_number() OVER () AS row, doc_id, coalesce(text, '') AS txt FROM documents),
    f AS ({" UNION ALL ".join(parts)}),
    e AS (SELECT row, ord, kind, least, m, g, p, unnest(range(1, len(m) + 1)) AS i FROM f WHERE len(m) > 0),
    s AS (SELECT row, ord, kind, CAST(list_sum(list_transform(p[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(m[1:i - 1], lambda x: length(x))), 0) AS BIGINT) AS a, length(m[i]) AS n
          FROM e WHERE length(g[i]) >= least),
    t AS (SELECT row, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access, count(*) FILTER (kind = 'hex') AS n_hex,
                 string_agg(kind || ':' || a || ':' || (a + n), ',' ORDER BY a, ord) FILTER (ord < {len(secrets.BASE)}) AS base,
                 string_agg(kind || ':' || a || ':' || (a + n), ',' ORDER BY a, ord) AS spans FROM s GROUP BY row)
    SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
           sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans FROM d LEFT JOIN t USING (row)"""


def _urls_sql() -> str:
    rules = ", ".join(f"({_quoted(h)}, {_quoted(p)}, {_quoted(v)})" for h, p, v in URL_RULES)
    return f"""
    WITH rules(rhost, rpath, verdict) AS (VALUES {rules}),
    r AS (SELECT row_number() OVER () AS row, page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) END AS rest FROM pages),
    h AS (SELECT row, page_id, coalesce(translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
                 coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path FROM r),
    m AS (SELECT row, arg_max(rhost || rpath, length(rhost || rpath)) AS rule, arg_max(verdict, length(rhost || rpath)) AS verdict
          FROM h JOIN rules ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath) GROUP BY row)
    SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM h LEFT JOIN m USING (row)"""


CHAT_SQL = f"""
WITH t AS (SELECT conv_id, turn, CASE WHEN trim(coalesce(role, '')) = '' THEN 'unknown' ELSE role END AS speaker, coalesce(text, '') AS said FROM conversations),
p AS (SELECT DISTINCT conv_id, speaker AS perspective FROM t WHERE speaker <> 'system'),
r AS (SELECT t.conv_id, perspective, turn, speaker, said, speaker = perspective AS own,
             CASE WHEN speaker = perspective THEN '<|assistant|>' WHEN speaker = 'system' THEN '<|system|>' ELSE '<|user ' || speaker || '|>' END || chr(10) AS head
      FROM t JOIN p ON t.conv_id IS NOT DISTINCT FROM p.conv_id),
o AS (SELECT *, row_number() OVER w - 1 AS seq, coalesce(sum(length(head) + length(said) + 9) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS pos
      FROM r WINDOW w AS (PARTITION BY conv_id, perspective ORDER BY turn NULLS FIRST, speaker, md5(said)))
SELECT conv_id, perspective, CAST(seq // {chat.PART_TURNS} AS INTEGER) AS part, CAST(count(*) AS INTEGER) AS n_turns,
       string_agg(head || said || chr(10) || '<|end|>' || chr(10), '' ORDER BY seq) AS text, CAST(min(pos) AS BIGINT) AS start_char,
       coalesce(string_agg((pos + length(head)) || ':' || (pos + length(head) + length(said)), ',' ORDER BY seq) FILTER (own), '') AS mask,
       CAST(coalesce(sum(length(said)) FILTER (own), 0) AS BIGINT) AS mask_chars
FROM o GROUP BY conv_id, perspective, seq // {chat.PART_TURNS}"""


AUDIT_SQL = r"""
WITH d AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS txt FROM documents),
w AS (SELECT *, regexp_extract_all(txt, '[^\x20\x09-\x0D]+') AS ws, min(doc_id) OVER (PARTITION BY txt) AS least FROM d),
f AS (SELECT doc_id, part, CASE WHEN len(ws) < 100 THEN 'A' ELSE '' END || CASE WHEN 100 * len(list_distinct(ws)) < 80 * len(ws) THEN 'B' ELSE '' END
             || CASE WHEN 100 * length(regexp_replace(txt, '[^A-Z]', '', 'g')) > 10 * length(txt) THEN 'C' ELSE '' END
             || CASE WHEN regexp_matches(txt, '[#$%&*|]') THEN 'D' ELSE '' END || CASE WHEN doc_id > least THEN 'E' ELSE '' END AS fails FROM w),
l AS (SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id),
c AS (SELECT part, fails, count(*) AS n, count(*) FILTER (good) AS n_good, count(*) FILTER (toxic) AS n_toxic FROM f LEFT JOIN l USING (doc_id) GROUP BY ALL),
a(x) AS (VALUES ('A'), ('B'), ('C'), ('D'), ('E')),
o AS (SELECT a.x || b.x || c.x || d.x || e.x AS filter_order FROM a, a b, a c, a d, a e WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
s AS (SELECT filter_order, CAST(step AS INTEGER) AS step, filter_order[step] AS letter, filter_order[:step - 1] AS before FROM o, range(1, 6) r(step)),
j AS (SELECT part, filter_order, step, fails, n, n_good, n_toxic, contains(fails, letter) AS own, fails = letter AS only_own, len(list_intersect(string_split(before, ''), string_split(fails, ''))) > 0 AND before <> '' AND fails <> '' AS gone FROM c, s)
SELECT part, filter_order, step, CAST(coalesce(sum(n) FILTER (NOT own AND NOT gone), 0) AS BIGINT) AS kept, CAST(coalesce(sum(n) FILTER (own AND NOT gone), 0) AS BIGINT) AS removed,
       CAST(coalesce(sum(n) FILTER (own AND gone), 0) AS BIGINT) AS redundant, CAST(coalesce(sum(n) FILTER (only_own), 0) AS BIGINT) AS unique_fails,
       CAST(coalesce(sum(n_good) FILTER (own AND NOT gone), 0) AS BIGINT) AS good_lost, CAST(coalesce(sum(n_toxic) FILTER (own AND NOT gone), 0) AS BIGINT) AS toxic_lost,
       CAST(coalesce(sum(n * 120 // greatest(length(fails), 1)) FILTER (own), 0) AS BIGINT) AS shapley
FROM j GROUP BY part, filter_order, step"""


def oracle_sql() -> dict[str, str]:
    return {"op2_chat_formatting": CHAT_SQL, "op3_secret_scans": _secrets_sql(), "op5_url_filters": _urls_sql(), "op11_filter_audit": AUDIT_SQL}
