"""Queries on lineitem as a table of labelled flows: harmonise, clean, audit, split."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from flowlab.functions import labels
from flowlab.functions.fingerprint import fingerprint_md5
from flowlab.operators import clean, feeds, filters, heavy, joins, quality, schema, sets, splits
from flowlab.plans.base import F3, F4, KEY, SQL_L, Book, events, lineitem, long_sql, md5_bucket_sql, table
from flowlab.sources.shared import shared_dir

book = Book()
LONG4 = long_sql(F4, "l_returnflag")
B20, SHARE42 = md5_bucket_sql("l_suppkey", 20), md5_bucket_sql("l_rowkey", 1_000_000, "42")


# -- harmonise and clean ------------------------------------------------------------------------------------------------

SPEC = schema.SourceSpec("flows", {"l_quantity": "Flow Duration", "l_extendedprice": "Flow Bytes/s", "l_discount": "Total Fwd Packets", "event": "Label"}, ("l_tax",))
CORE = ["Flow Duration", "Flow Bytes/s", "Total Fwd Packets", "Idle Min"]


@book.add("""SELECT l_quantity AS "Flow Duration", l_extendedprice AS "Flow Bytes/s", l_discount AS "Total Fwd Packets", CAST(NULL AS DOUBLE) AS "Idle Min",
 CASE l_returnflag WHEN 'N' THEN 'BENIGN' WHEN 'A' THEN 'Bot' ELSE 'R' END AS "Label", CAST(CASE WHEN l_returnflag = 'N' THEN 0 ELSE 1 END AS INTEGER) AS is_attack, 'flows' AS source FROM lineitem""")
def harmonise(spark, d):
    raw = F.when(F.col("l_returnflag") == "N", " Benign ").when(F.col("l_returnflag") == "A", "bot").otherwise(F.col("l_returnflag"))
    df = lineitem(spark, d).withColumn(" event", raw)
    return schema.harmonise(df, SPEC, CORE)


@book.add("""SELECT "Label", source, count(*) AS n, round(avg("Flow Duration"), 6) AS mean_duration FROM (
 SELECT l_quantity AS "Flow Duration", CASE l_returnflag WHEN 'N' THEN 'BENIGN' ELSE l_returnflag END AS "Label", 'a' AS source FROM lineitem WHERE l_linestatus = 'F'
 UNION ALL SELECT l_quantity + 1, CASE l_returnflag WHEN 'N' THEN 'BENIGN' ELSE l_returnflag END, 'b' FROM lineitem WHERE l_linestatus = 'O' AND l_returnflag = 'N') GROUP BY ALL""")
def corpus_build(spark, d):
    df = lineitem(spark, d).withColumn("Label", F.when(F.col("l_returnflag") == "N", "normal").otherwise(F.col("l_returnflag")))
    a = df.filter("l_linestatus = 'F'").withColumn(" Flow Duration", F.col("l_quantity"))
    b = df.filter("l_linestatus = 'O'").withColumn("dur", F.col("l_quantity") + 1)
    parts = [(a, schema.SourceSpec("a")), (b, schema.SourceSpec("b", {"dur": "Flow Duration"}, (), ("BENIGN",)))]
    return schema.corpus_build(parts, CORE).groupBy("Label", "source").agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("Flow Duration"), 6).alias("mean_duration"))


COLUMNS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]
EXTRA = " UNION ALL ".join(f"SELECT '{c}', 'extra', count({c}) FROM lineitem" for c in COLUMNS)


@book.add(f"""SELECT a AS "column", b AS status, CAST(c AS BIGINT) AS filled FROM (VALUES ('Flow Bytes/s', 'missing', 0), ('Total Fwd Packets', 'missing', 0), ('Idle Min', 'missing', 0)) AS v(a, b, c)
 UNION ALL SELECT 'Flow Duration', 'covered', count(l_quantity) FROM lineitem UNION ALL {EXTRA}""")
def schema_coverage(spark, d):
    return schema.schema_coverage(table(spark, d, "lineitem"), schema.SourceSpec("x", {"l_quantity": "Flow Duration"}), CORE)


@book.add("""SELECT event_type AS raw, CASE upper(event_type) WHEN 'ERROR' THEN 'error' ELSE event_type END AS label, CASE WHEN event_type = 'view' THEN 'BENIGN' ELSE event_type END AS class, count(*) AS n,
 CAST(CASE WHEN event_type = 'view' THEN 0 ELSE 1 END AS INTEGER) AS is_attack, CAST(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END AS INTEGER) AS is_error FROM events GROUP BY event_type""")
def normalise_label(spark, d):
    mapped = labels.normalise_label(F.col("event_type"), {"VIEW": "BENIGN"})
    df = events(spark, d).select(F.col("event_type").alias("raw"), labels.normalise_label(F.concat(F.lit(" "), F.col("event_type"), F.lit(" "))).alias("label"), mapped.alias("class"))
    return df.groupBy("raw", "label", "class").agg(F.count(F.lit(1)).alias("n")).select("*", labels.is_attack(F.col("class")).alias("is_attack"), labels.one_vs_rest(F.col("raw"), "error").alias("is_error"))


@book.add("""SELECT CASE event_type WHEN 'error' THEN 'DoS' WHEN 'view' THEN 'Unknown' WHEN 'click' THEN 'Brute Force' ELSE event_type END AS family, count(*) AS n FROM events GROUP BY ALL""")
def attack_family_rollup(spark, d):
    raw = F.when(F.col("event_type") == "error", "DoS Hulk").when(F.col("event_type") == "view", " ").when(F.col("event_type") == "click", "SSH-Patator").otherwise(F.col("event_type"))
    return events(spark, d).groupBy(labels.attack_family(raw).alias("family")).agg(F.count(F.lit(1)).alias("n"))


@book.add("""SELECT l_rowkey, CASE WHEN l_rowkey % 7 <> 0 THEN ln(1 + greatest(l_quantity - 10, 1.0)) END AS l_quantity, CASE WHEN l_rowkey % 7 <> 0 AND l_rowkey % 5 <> 0 THEN l_extendedprice END AS l_extendedprice, l_discount FROM """ + SQL_L)
def clean_features(spark, d):
    text = F.when(F.col(KEY) % 7 == 0, "Label").otherwise((F.col("l_quantity") - 10).cast("string"))
    price = F.when(F.col(KEY) % 7 == 0, F.lit(float("nan"))).when(F.col(KEY) % 5 == 0, F.lit(float("inf"))).otherwise(F.col("l_extendedprice"))
    df = lineitem(spark, d).select(KEY, text.alias("l_quantity"), price.alias("l_extendedprice"), "l_discount")
    cast = clean.cast_features_double(df, ["l_quantity", "l_extendedprice", "l_discount"])
    return clean.log1p_with_floor(clean.nullify_nonfinite(cast, ["l_quantity", "l_extendedprice"]), {"l_quantity": 1.0})


@book.add(f"""WITH x AS (SELECT l_rowkey, CASE WHEN l_rowkey % 7 <> 0 THEN l_quantity END AS q FROM {SQL_L}), m AS (SELECT quantile_disc(q, 0.5) AS med FROM x)
 SELECT l_rowkey, coalesce(q, med) AS q FROM x, m""")
def median_impute(spark, d):
    df = lineitem(spark, d).select(KEY, F.when(F.col(KEY) % 7 != 0, F.col("l_quantity")).alias("q"))
    return clean.median_impute_apply(df, clean.median_impute_fit(df, ["q"], 100_000), ["q"])


@book.add(f"""SELECT 'l_quantity' AS feature, count(*) FILTER (l_rowkey % 7 = 0) AS nulls FROM {SQL_L} UNION ALL SELECT 'l_tax', count(*) FILTER (l_tax IS NULL) FROM lineitem""")
def null_counts(spark, d):
    return clean.null_counts(lineitem(spark, d).withColumn("l_quantity", F.when(F.col(KEY) % 7 != 0, F.col("l_quantity"))), ["l_quantity", "l_tax"])


# -- filters, joins, sets -----------------------------------------------------------------------------------------------


@book.add("SELECT l_returnflag, count(*) AS n FROM lineitem WHERE l_returnflag IN ('A', 'R') GROUP BY ALL")
def filter_label_in(spark, d):
    df = filters.nonblank_label(lineitem(spark, d), "l_returnflag")
    return filters.label_in(df, "l_returnflag", [" a", "r"]).groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("n"))


@book.add("SELECT l_orderkey, l_linenumber, l_shipdate FROM lineitem WHERE l_shipdate >= TIMESTAMP '1998-01-01' AND l_shipdate < TIMESTAMP '1998-02-01'")
def filter_time_range(spark, d):
    df = lineitem(spark, d).withColumn("l_shipdate", F.col("l_shipdate").cast("timestamp"))
    return filters.date_range(df, "l_shipdate", "1998-01-01", "1998-01-31").select("l_orderkey", "l_linenumber", "l_shipdate")


@book.add("SELECT event_id, user_id, event_type FROM events WHERE contains(CAST(user_id AS VARCHAR), '14') OR contains(event_type, 'err')")
def filter_text_contains(spark, d):
    a = filters.text_contains(events(spark, d).withColumn("e", F.upper("event_type")), ["user_id"], "14")
    b = filters.text_contains(events(spark, d).withColumn("e", F.upper("event_type")), ["e"], "Err")
    return a.unionByName(b).select("event_id", "user_id", "event_type").distinct()


@book.add("SELECT user_id, count(*) AS n FROM events GROUP BY user_id HAVING bool_or(event_type = 'error') OR bool_or(event_type = 'signup')")
def filter_array_overlap(spark, d):
    per = events(spark, d).groupBy("user_id").agg(F.count(F.lit(1)).alias("n"), F.collect_set("event_type").alias("types"))
    return filters.array_overlap(per, "types", ["error", "signup"]).select("user_id", "n")


@book.add("SELECT l_orderkey, l_linenumber, l_returnflag FROM lineitem WHERE l_returnflag = 'A'")
def filter_source_file(spark, d):
    """Of a table in three folders the rows of one, by the path they were read from."""
    path = f"{shared_dir(spark).rstrip('/')}/flowlab/files-{uuid.uuid4().hex}"
    plain = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag")
    plain.withColumn("day", F.col("l_returnflag")).write.partitionBy("day").parquet(path)
    return filters.source_path(spark.read.schema(plain.schema).parquet(path), ["day=A/"]).drop("day")


@book.add("""WITH w AS (SELECT l_returnflag AS label, least(50.0, sum(count(*)) OVER () / (count(*) OVER () * count(*))) AS w FROM lineitem GROUP BY 1)
 SELECT l_returnflag, count(*) AS n, round(sum(round(w, 6)), 4) AS weight FROM lineitem JOIN w ON label = l_returnflag GROUP BY 1""")
def join_broadcast_weights(spark, d):
    df = lineitem(spark, d)
    weights = quality.class_weights(df, "l_returnflag").select(F.col("label").alias("l_returnflag"), "weight")
    return joins.attach(df, weights, ["l_returnflag"], {"weight": 1.0}).groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("weight"), 4).alias("weight"))


@book.add("""WITH a AS (SELECT l_suppkey, count(*) AS left_n FROM lineitem WHERE l_linestatus = 'F' GROUP BY 1), b AS (SELECT l_suppkey, count(*) AS right_n FROM lineitem WHERE l_returnflag = 'N' AND l_suppkey % 3 = 0 GROUP BY 1)
 SELECT coalesce(a.l_suppkey, b.l_suppkey) AS l_suppkey, coalesce(left_n, 0) AS left_n, coalesce(right_n, 0) AS right_n FROM a FULL JOIN b ON a.l_suppkey = b.l_suppkey""")
def join_full_outer_counts(spark, d):
    df = lineitem(spark, d)
    return joins.full_outer_counts(df.filter("l_linestatus = 'F'"), df.filter("l_returnflag = 'N' AND l_suppkey % 3 = 0"), "l_suppkey")


SPLIT = f"(SELECT *, CASE WHEN {SHARE42} / 1000000 < 0.7 THEN 'train' ELSE 'test' END AS split FROM {SQL_L})"


@book.add(f"""WITH s AS {SPLIT} SELECT l_rowkey FROM s t WHERE split = 'test' AND EXISTS (SELECT 1 FROM s r WHERE r.split = 'train' AND r.l_quantity = t.l_quantity AND r.l_discount = t.l_discount AND r.l_tax = t.l_tax)""")
def join_inner_multi_key(spark, d):
    df = splits.split_random(lineitem(spark, d), KEY)
    return joins.shared_vectors(df.filter("split = 'test'"), df.filter("split = 'train'"), F3).select(KEY)


@book.add(f"""WITH s AS {SPLIT} SELECT l_rowkey FROM s t WHERE split = 'test' AND NOT EXISTS (SELECT 1 FROM s r WHERE r.split = 'train' AND r.l_quantity = t.l_quantity AND r.l_discount = t.l_discount AND r.l_tax = t.l_tax)""")
def join_left_anti_deleak(spark, d):
    df = splits.split_random(lineitem(spark, d), KEY)
    return joins.shared_vectors(df.filter("split = 'test'"), df.filter("split = 'train'"), F3, "left_anti").select(KEY)


@book.add("SELECT event_id, user_id FROM events WHERE user_id % 17 = 0")
def join_membership_exact(spark, d):
    df = events(spark, d)
    return joins.keys_in(df, df.select("user_id").filter("user_id % 17 = 0"), "user_id").select("event_id", "user_id")


@book.add("SELECT event_id, user_id FROM events WHERE user_id % 17 = 0")
def join_membership_bloom(spark, d):
    """A filter of hashes lets through a superset, which the exact join confirms."""
    df = events(spark, d)
    keys = df.select("user_id").filter("user_id % 17 = 0").distinct()
    return joins.keys_in(joins.likely_in(df, keys, "user_id"), keys, "user_id").select("event_id", "user_id")


@book.add("SELECT l_quantity, l_discount, l_tax FROM lineitem WHERE l_returnflag = 'A' INTERSECT SELECT l_quantity, l_discount, l_tax FROM lineitem WHERE l_returnflag = 'R'")
def intersect_vectors(spark, d):
    df = lineitem(spark, d)
    return sets.intersect_vectors(df.filter("l_returnflag = 'A'"), df.filter("l_returnflag = 'R'"), F3)


@book.add("""WITH a AS (SELECT DISTINCT event_type FROM events WHERE event_type <> 'view'), b AS (SELECT DISTINCT event_type FROM events WHERE event_type <> 'error')
 SELECT coalesce(a.event_type, b.event_type) AS event_type, CASE WHEN a.event_type IS NULL THEN 'right only' WHEN b.event_type IS NULL THEN 'left only' ELSE 'both' END AS status FROM a FULL JOIN b ON a.event_type = b.event_type""")
def set_compare_labels(spark, d):
    df = events(spark, d)
    return sets.compare_labels(df.filter("event_type <> 'view'"), df.filter("event_type <> 'error'"), "event_type")


@book.add("SELECT source, count(*) AS n, count(extra) AS extras FROM (SELECT 'a' AS source, NULL AS extra FROM lineitem UNION ALL SELECT 'b', l_tax FROM lineitem) GROUP BY source")
def union_by_name(spark, d):
    df = lineitem(spark, d)
    both = sets.union_all([df.select(F.lit("a").alias("source"), "l_quantity"), df.select(F.lit("b").alias("source"), "l_quantity", F.col("l_tax").alias("extra"))])
    return both.groupBy("source").agg(F.count(F.lit(1)).alias("n"), F.count("extra").alias("extras"))


# -- audits -------------------------------------------------------------------------------------------------------------


@book.add("SELECT l_returnflag AS label, count(*) AS n, round(100 * count(*) / sum(count(*)) OVER (), 6) AS pct FROM lineitem GROUP BY 1")
def label_distribution(spark, d):
    return quality.label_distribution(lineitem(spark, d), "l_returnflag")


@book.add("SELECT count(*) FILTER (l_returnflag = 'N') AS benign, count(*) FILTER (l_returnflag <> 'N') AS attack, round(count(*) FILTER (l_returnflag = 'N') / count(*) FILTER (l_returnflag <> 'N'), 6) AS ratio FROM lineitem")
def imbalance_summary(spark, d):
    return quality.imbalance_summary(lineitem(spark, d), "l_returnflag", "N")


@book.add("SELECT l_linestatus AS source, l_returnflag AS label, count(*) AS n FROM lineitem GROUP BY ROLLUP (l_linestatus, l_returnflag)")
def file_label_frequency(spark, d):
    return quality.file_label_frequency(lineitem(spark, d), "l_linestatus", "l_returnflag")


@book.add("""SELECT label, n, dataset, regexp_matches(label, '^e') AS marked FROM (SELECT l_returnflag AS label, count(*) AS n, 'flows' AS dataset FROM lineitem GROUP BY 1 UNION ALL SELECT event_type, count(*), 'events' FROM events GROUP BY 1)""")
def label_scan_many(spark, d):
    parts = {"flows": lineitem(spark, d).select(F.col("l_returnflag").alias("x")), "events": events(spark, d).select(F.col("event_type").alias("x"))}
    return quality.label_scan_many(parts, "x", "^e")


@book.add(f"""SELECT k AS source, feature, count(value) AS n, round(avg(value), 6) AS mean, round(stddev_pop(value), 6) AS std, min(value) AS min, round(quantile_cont(value, 0.25), 6) AS p25, round(quantile_cont(value, 0.5), 6) AS median,
 round(quantile_cont(value, 0.75), 6) AS p75, round(quantile_cont(value, 0.95), 6) AS p95, max(value) AS max FROM ({LONG4}) GROUP BY ALL""")
def feature_summary(spark, d):
    return quality.feature_summary(lineitem(spark, d), F4, "l_returnflag")


@book.add(f"""WITH m AS (SELECT feature, avg(value) FILTER (k = 'A') AS l, avg(value) FILTER (k = 'N') AS r FROM ({LONG4}) GROUP BY 1)
 SELECT feature, round(l, 6) AS left_mean, round(r, 6) AS right_mean, round(l / r, 6) AS ratio, 'ok' AS tag FROM m""")
def scale_ratio_report(spark, d):
    return quality.scale_ratio_report(lineitem(spark, d), F4, "l_returnflag", "A", "N")


CONST = "(SELECT *, CASE WHEN l_returnflag = 'A' THEN 1.0 ELSE l_tax END AS c FROM lineitem)"
SCAN = f"""SELECT k AS label, feature, round(stddev_pop(value), 6) AS std, round(avg(value), 6) AS mean, round(count(*) FILTER (value = 0) / count(*), 6) AS zero_share FROM ({long_sql(["l_tax", "c"], "l_returnflag", CONST)}) GROUP BY ALL"""


@book.add(f"SELECT *, coalesce(std <= 1e-9, true) AS constant FROM ({SCAN})")
def zero_variance_scan(spark, d):
    df = lineitem(spark, d).withColumn("c", F.when(F.col("l_returnflag") == "A", 1.0).otherwise(F.col("l_tax")))
    return quality.zero_variance_scan(df, ["l_tax", "c"], "l_returnflag")


@book.add(f"""WITH z AS (SELECT * FROM ({SCAN}) WHERE std <= 1e-9), a AS (SELECT DISTINCT feature FROM z WHERE label = 'A'), b AS (SELECT DISTINCT feature FROM z WHERE label = 'R')
 SELECT coalesce(a.feature, b.feature) AS feature, CASE WHEN a.feature IS NULL THEN 'right only' WHEN b.feature IS NULL THEN 'left only' ELSE 'shared' END AS verdict FROM a FULL JOIN b ON a.feature = b.feature""")
def set_compare_columns(spark, d):
    scan = zero_variance_scan(spark, d)
    return quality.constant_compare(scan.filter("label = 'A'"), scan.filter("label = 'R'"))


NEG = "(SELECT *, l_quantity - 25 AS q, l_discount - 0.05 AS disc FROM lineitem)"


@book.add(f"""SELECT k AS label, feature, count(*) FILTER (value < 0) AS negatives, count(*) AS n, round(100 * count(*) FILTER (value < 0) / count(*), 6) AS pct FROM ({long_sql(["q", "disc"], "l_returnflag", NEG)}) GROUP BY ALL""")
def negative_value_audit(spark, d):
    df = lineitem(spark, d).withColumns({"q": F.col("l_quantity") - 25, "disc": F.col("l_discount") - 0.05, "l_tax": -F.col("l_tax")})
    return quality.negative_value_audit(df, ["q", "disc", "l_tax"], "l_returnflag", ("l_tax",))


@book.add(f"SELECT count(*) AS n, count(*) FILTER (q < 0 OR disc < 0) AS any_negative, count(*) FILTER (q < 0 AND disc < 0) AS all_negative, count(*) FILTER (q < 0 AND l_tax >= 0 AND disc >= 0) AS recomputable FROM {NEG}")
def negative_summary(spark, d):
    df = lineitem(spark, d).withColumns({"q": F.col("l_quantity") - 25, "disc": F.col("l_discount") - 0.05})
    return quality.negative_summary(df, ["q", "disc"], "q", ["l_tax", "disc"])


GROUPS = "(SELECT l_quantity, l_discount, l_tax, count(*) AS n FROM lineitem GROUP BY ALL)"


@book.add(f"SELECT CAST(sum(n) AS BIGINT) AS total_rows, count(*) AS distinct_vectors, CAST(coalesce(sum(n) FILTER (n > 1), 0) AS BIGINT) AS rows_in_groups, max(n) AS largest_group, CAST(sum(n - 1) AS BIGINT) AS excess FROM {GROUPS}")
def duplicate_stats(spark, d):
    return quality.duplicate_stats(lineitem(spark, d), F3)


@book.add("""SELECT label, CAST(sum(n) AS BIGINT) AS n, count(*) AS distinct_vectors, round(1 - count(*) / sum(n), 6) AS duplicate_rate FROM (SELECT l_returnflag AS label, count(*) AS n FROM lineitem GROUP BY l_returnflag, l_quantity, l_discount, l_tax) GROUP BY 1""")
def duplicate_rate_per_label(spark, d):
    return quality.duplicate_rate_per_label(lineitem(spark, d), F3, "l_returnflag")


@book.add("""SELECT l_quantity, l_discount, l_tax, CAST(sum(c) AS BIGINT) AS n, count(*) AS n_labels, string_agg(label || ':' || c, ',' ORDER BY label) AS labels FROM (SELECT l_quantity, l_discount, l_tax, l_returnflag AS label, count(*) AS c FROM lineitem GROUP BY ALL)
 GROUP BY 1, 2, 3 ORDER BY n DESC, 1, 2, 3 LIMIT 10""")
def top_duplicate_groups(spark, d):
    return quality.top_duplicate_groups(lineitem(spark, d), F3, "l_returnflag")


@book.add("SELECT lo, hi, count(*) AS groups, CAST(sum(n) AS BIGINT) AS n FROM (SELECT min(l_returnflag) AS lo, max(l_returnflag) AS hi, count(*) AS n FROM lineitem GROUP BY l_quantity, l_discount, l_tax) WHERE lo <> hi GROUP BY ALL")
def conflicting_label_groups(spark, d):
    return quality.conflicting_groups(lineitem(spark, d), F3, "l_returnflag").groupBy("lo", "hi").agg(F.count(F.lit(1)).alias("groups"), F.sum("n").alias("n"))


@book.add("SELECT l_returnflag AS label, count(*) AS n, round(least(50.0, sum(count(*)) OVER () / (count(*) OVER () * count(*))), 6) AS weight FROM lineitem GROUP BY 1")
def class_weights(spark, d):
    return quality.class_weights(lineitem(spark, d), "l_returnflag")


@book.add("SELECT l_returnflag AS label, count(*) AS n, count(*) FILTER (l_discount = 0.05 AND l_tax = 0.02) AS on_constants, round(count(*) FILTER (l_discount = 0.05 AND l_tax = 0.02) / count(*), 6) AS share FROM lineitem GROUP BY 1")
def source_share_proxy(spark, d):
    return quality.source_share_proxy(lineitem(spark, d), "l_returnflag", {"l_discount": 0.05, "l_tax": 0.02})


@book.add("""SELECT count(*) AS groups, min(n) AS smallest, quantile_cont(n, 0.5) AS median, round(avg(n), 6) AS mean, max(n) AS largest, count(*) FILTER (n >= 100) AS large_groups, count(*) FILTER (n = 1) AS singletons FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_partkey)""")
def group_size_stats(spark, d):
    return quality.group_size_stats(lineitem(spark, d), "l_partkey")


@book.add("SELECT l_quantity AS value, count(*) AS n FROM lineitem GROUP BY 1 ORDER BY n DESC, 1 LIMIT 10")
def value_counts_topk(spark, d):
    return quality.value_counts_topk(lineitem(spark, d), "l_quantity", 10)


@book.add("SELECT l_partkey AS value, count(*) AS n FROM lineitem GROUP BY 1 HAVING count(*) >= (SELECT min(n) FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_partkey ORDER BY n DESC LIMIT 20))")
def frequent_values(spark, d):
    """Every part that occurs as often as the twentieth most frequent one, from summaries of few counters."""
    return heavy.frequent(lineitem(spark, d), "l_partkey", 20, 64)


@book.add("SELECT l_returnflag AS label, count(*) AS n, quantile_cont(l_suppkey, 0.5) AS median_key, count(DISTINCT l_suppkey) AS distinct_keys, round(avg(CASE WHEN l_suppkey IN (8, 44) THEN 1.0 ELSE 0.0 END), 6) AS usual_share FROM lineitem GROUP BY 1")
def key_profile_per_label(spark, d):
    return quality.key_profile_per_label(lineitem(spark, d), "l_suppkey", "l_returnflag", (8, 44))


@book.add(f"SELECT k AS label, feature, round(avg(value), 6) AS mean, round(stddev_samp(value), 6) AS std FROM ({LONG4}) GROUP BY ALL")
def feature_stats_per_label(spark, d):
    return quality.feature_stats_per_label(lineitem(spark, d), F4, "l_returnflag")


@book.add("SELECT CAST(l_shipdate AS DATE) AS day, count(*) AS n FROM lineitem GROUP BY 1")
def rows_per_day(spark, d):
    return quality.rows_per_day(lineitem(spark, d), "l_shipdate")


@book.add("SELECT count(*) AS n, count(*) FILTER ((l_linestatus = 'F') <> (l_returnflag <> 'N')) AS mismatches FROM lineitem")
def quality_label_consistency(spark, d):
    return quality.label_consistency(lineitem(spark, d), F.col("l_linestatus") == "F", F.col("l_returnflag") != "N")


@book.add("SELECT 'rows' AS rule, CAST(60000 AS DOUBLE) AS expected, CAST(count(*) AS DOUBLE) AS actual, count(*) = 60000 AS passed FROM lineitem UNION ALL SELECT 'nulls', 0.0, CAST(count(*) FILTER (l_tax IS NULL) AS DOUBLE), count(*) FILTER (l_tax IS NULL) = 0 FROM lineitem")
def validate_row_counts(spark, d):
    return quality.expect(lineitem(spark, d), {"rows": (F.count(F.lit(1)), 60000), "nulls": (F.count_if(F.col("l_tax").isNull()), 0)})


@book.add("SELECT l_returnflag AS label, count(*) AS n FROM lineitem GROUP BY 1 ORDER BY n, 1 LIMIT 2")
def rarest_labels(spark, d):
    return quality.rarest(lineitem(spark, d), "l_returnflag", 2)


# -- fingerprints, dedup, splits, samples -------------------------------------------------------------------------------


@book.add(f"""SELECT l_rowkey, md5(concat_ws('|', coalesce(CAST(CAST(l_quantity AS DECIMAL(18,4)) AS VARCHAR), '~'), coalesce(CAST(CAST(l_tax AS DECIMAL(18,4)) AS VARCHAR), '~'), CASE WHEN l_rowkey % 3 = 0 THEN '~' ELSE CAST(CAST(l_discount AS DECIMAL(18,4)) AS VARCHAR) END)) AS fp FROM {SQL_L}""")
def fingerprint_md5_rows(spark, d):
    df = lineitem(spark, d).withColumn("l_discount", F.when(F.col(KEY) % 3 != 0, F.col("l_discount")))
    return df.select(KEY, fingerprint_md5(["l_quantity", "l_tax", "l_discount"]).alias("fp"))


@book.add(f"SELECT min(l_rowkey) AS l_rowkey, l_quantity, l_discount, l_tax FROM {SQL_L} GROUP BY 2, 3, 4")
def dedup_exact(spark, d):
    return splits.dedup_exact(lineitem(spark, d).select(KEY, *F3), F3, KEY)


@book.add("SELECT count(*) AS n FROM (SELECT DISTINCT l_quantity, l_discount, l_tax, l_returnflag FROM lineitem)")
def dedup_key_subset(spark, d):
    return splits.dedup_any(lineitem(spark, d), [*F3, "l_returnflag"]).agg(F.count(F.lit(1)).alias("n"))


SHARDED = f"""(SELECT *, CASE WHEN count(*) OVER (PARTITION BY l_suppkey) > 600 THEN 'hv_' || l_suppkey || '_s' || {md5_bucket_sql("l_rowkey", 20)} ELSE 'g_' || l_suppkey END AS group_id FROM {SQL_L})"""


@book.add(f"SELECT group_id, count(*) AS n FROM {SHARDED} GROUP BY 1")
def group_key_sharded(spark, d):
    return splits.group_key_sharded(lineitem(spark, d), "l_suppkey", KEY, 600, 20).groupBy("group_id").agg(F.count(F.lit(1)).alias("n"))


@book.add("""WITH g AS (SELECT CAST(l_partkey AS VARCHAR) AS k, count(*) AS n FROM lineitem GROUP BY 1), r AS (SELECT k, n, coalesce(sum(n) OVER (ORDER BY md5('42' || k), k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before, sum(n) OVER () AS total FROM g)
 SELECT CAST(k AS BIGINT) AS l_partkey, CASE WHEN before < 0.8 * total THEN 'train' ELSE 'test' END AS split, n FROM r""")
def split_grouped(spark, d):
    return splits.split_grouped(lineitem(spark, d), "l_partkey").groupBy("l_partkey", "split").agg(F.count(F.lit(1)).alias("n"))


@book.add(f"SELECT l_suppkey, CASE WHEN {B20} < 14 THEN 'train' ELSE 'test' END AS split, count(*) AS n FROM lineitem GROUP BY ALL")
def split_port_bucket(spark, d):
    return splits.split_bucket(lineitem(spark, d), "l_suppkey").groupBy("l_suppkey", "split").agg(F.count(F.lit(1)).alias("n"))


@book.add(f"SELECT l_rowkey, split FROM {SPLIT}")
def split_random(spark, d):
    return splits.split_random(lineitem(spark, d), KEY).select(KEY, "split")


@book.add(f"""SELECT l_rowkey, CASE WHEN row_number() OVER (PARTITION BY l_returnflag ORDER BY substr(md5('42' || l_rowkey), 1, 2), md5('42' || l_rowkey), l_rowkey) <= ceil(0.2 * count(*) OVER (PARTITION BY l_returnflag)) THEN 'test' ELSE 'train' END AS split FROM {SQL_L}""")
def split_stratified(spark, d):
    return splits.split_stratified(lineitem(spark, d), "l_returnflag", KEY).select(KEY, "split")


@book.add(f"""WITH m AS (SELECT quantile_cont(epoch(l_shipdate), 0.5) AS m FROM lineitem), s AS (SELECT *, CASE WHEN epoch(l_shipdate) < m THEN 'early' ELSE 'late' END AS split FROM {SQL_L}, m)
 SELECT l_rowkey, split FROM s t WHERE split = 'early' OR NOT EXISTS (SELECT 1 FROM s r WHERE r.split = 'early' AND r.l_quantity = t.l_quantity AND r.l_discount = t.l_discount AND r.l_tax = t.l_tax)""")
def split_temporal_median(spark, d):
    df = lineitem(spark, d).withColumn("l_shipdate", F.col("l_shipdate").cast("timestamp"))
    return splits.split_temporal_median(df, "l_shipdate", F3).select(KEY, "split")


@book.add(f"""WITH s AS {SPLIT}, tr AS (SELECT DISTINCT l_quantity, l_discount, l_tax FROM s WHERE split = 'train'), te AS (SELECT l_quantity, l_discount, l_tax, count(*) AS n FROM s WHERE split = 'test' GROUP BY ALL), j AS (SELECT n FROM te JOIN tr USING (l_quantity, l_discount, l_tax))
 SELECT (SELECT count(*) FROM (SELECT l_suppkey FROM s WHERE split = 'test' INTERSECT SELECT l_suppkey FROM s WHERE split = 'train')) AS shared_groups, (SELECT count(*) FROM j) AS shared_vectors, (SELECT CAST(coalesce(sum(n), 0) AS BIGINT) FROM j) AS leaked_rows,
 (SELECT count(*) FROM s WHERE split = 'test') AS n_test, round(100 * (SELECT sum(n) FROM j) / (SELECT count(*) FROM s WHERE split = 'test'), 6) AS leaked_pct""")
def split_overlap_check(spark, d):
    df = splits.split_random(lineitem(spark, d), KEY)
    return splits.overlap_check(df.filter("split = 'train'"), df.filter("split = 'test'"), F3, "l_suppkey")


@book.add(f"""WITH s AS {SPLIT}, tr AS (SELECT DISTINCT l_quantity, l_discount, l_tax, true AS seen FROM s WHERE split = 'train')
 SELECT l_returnflag AS label, count(*) AS n, count(seen) AS contaminated, round(100 * count(seen) / count(*), 6) AS pct FROM (SELECT * FROM s WHERE split = 'test') LEFT JOIN tr USING (l_quantity, l_discount, l_tax) GROUP BY 1""")
def cross_set_overlap_by_label(spark, d):
    df = splits.split_random(lineitem(spark, d), KEY)
    return splits.cross_set_overlap(df.filter("split = 'test'"), df.filter("split = 'train'"), F3, "l_returnflag")


@book.add(f"SELECT l_rowkey FROM {SQL_L} WHERE {md5_bucket_sql('l_rowkey', 1_000_000, '7')} / 1000000 < 0.1")
def sample_fraction(spark, d):
    return splits.sample_fraction(lineitem(spark, d), KEY, 0.1).select(KEY)


@book.add(f"""WITH c AS (SELECT count(*) FILTER (l_linenumber = 7) AS t, count(*) AS n FROM lineitem) SELECT l_rowkey, CAST(l_linenumber = 7 AS INTEGER) AS y FROM {SQL_L}, c WHERE l_linenumber = 7 OR {md5_bucket_sql('l_rowkey', 1_000_000, '7')} / 1000000 < least(1.0, t / (n - t))""")
def sample_balanced(spark, d):
    df = lineitem(spark, d).withColumn("line", F.col("l_linenumber").cast("string"))
    return splits.sample_balanced(df, "line", "7", KEY).select(KEY, (F.col("line") == "7").cast("int").alias("y"))


@book.add(f"""WITH t(flag, want) AS (VALUES ('A', 50000), ('R', 3000)), c AS (SELECT l_returnflag, count(*) AS n FROM lineitem GROUP BY 1), x AS (SELECT l_rowkey, l_returnflag, want / n AS times, {md5_bucket_sql('l_rowkey', 1_000_000, 'copies')} / 1000000 AS h FROM {SQL_L} JOIN t ON flag = l_returnflag JOIN c USING (l_returnflag))
 SELECT l_returnflag, CAST(sum(CAST(floor(times) AS BIGINT) + CASE WHEN h < times - floor(times) THEN 1 ELSE 0 END) AS BIGINT) AS n FROM x GROUP BY 1""")
def sample_to_targets(spark, d):
    return splits.sample_to_targets(lineitem(spark, d), "l_returnflag", KEY, {"A": 50000, "R": 3000}).groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("n"))


@book.add(f"""WITH c AS (SELECT count(*) AS n FROM lineitem WHERE l_returnflag = 'N') SELECT l_rowkey FROM {SQL_L}, c WHERE l_returnflag <> 'N' OR {md5_bucket_sql('l_rowkey', 1_000_000, 'down')} / 1000000 < 5000 / n""")
def downsample_class(spark, d):
    return splits.downsample_class(lineitem(spark, d), "l_returnflag", "N", 5000, KEY).select(KEY)


@book.add(f"SELECT l_rowkey FROM {SQL_L} JOIN (SELECT l_quantity, l_discount, l_tax FROM lineitem GROUP BY ALL HAVING min(l_returnflag) = max(l_returnflag)) USING (l_quantity, l_discount, l_tax)")
def denoise_conflicts(spark, d):
    return splits.denoise_conflicts(lineitem(spark, d), F3, "l_returnflag").select(KEY)


@book.add(f"SELECT l_rowkey, row_number() OVER (ORDER BY md5('42' || l_rowkey), l_rowkey) AS position FROM {SQL_L}")
def sort_global_shuffle(spark, d):
    """Every row with its place in the random order."""
    return splits.positions(lineitem(spark, d), KEY).select(KEY, "position")


@book.add("SELECT round(sum(CASE WHEN l_quantity = 10 THEN 0.0 ELSE l_quantity END), 6) AS total, count(*) AS n FROM lineitem")
def column_project_for_stream(spark, d):
    from flowlab.sources.tables import project_for_stream

    df = lineitem(spark, d).withColumn("l_quantity", F.when(F.col("l_quantity") == 10, F.lit(float("nan"))).otherwise(F.col("l_quantity")))
    return project_for_stream(df, ["l_quantity", "l_orderkey", "l_returnflag"]).agg(F.round(F.sum("l_quantity"), 6).alias("total"), F.count(F.lit(1)).alias("n"))


@book.add("SELECT event_id, ts FROM events WHERE ts >= TIMESTAMP '2024-01-10 00:00:00' - INTERVAL 72 HOUR")
def sink_ttl(spark, d):
    return feeds.retention(events(spark, d), "ts", "2024-01-10 00:00:00", 72).select("event_id", "ts")
