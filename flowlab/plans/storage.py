"""Round trips through sources and sinks: a table is written to the shared folder in each form and read back."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from flowlab.functions import labels
from flowlab.operators import feeds, graph, joins, metrics, quality, sets
from flowlab.plans import graphs
from flowlab.plans.alerts import GRADED, graded, is_error, predicted
from flowlab.plans.base import F3, F4, KEY, SQL_L, SQL_S, Book, events, lineitem
from flowlab.plans.learned import finished, stream
from flowlab.sources import alerts as alert_store
from flowlab.sources import keyed, ledger, sinks, tables
from flowlab.sources.shared import shared_dir, stage, unstage
from flowlab.streaming import detection, late

book = Book()
PLAIN = "SELECT l_orderkey, l_linenumber, l_quantity, l_returnflag FROM lineitem"


def folder(spark) -> str:
    return f"{shared_dir(spark).rstrip('/')}/flowlab/trip-{uuid.uuid4().hex}"


def plain(spark, d) -> DataFrame:
    return lineitem(spark, d).select("l_orderkey", "l_linenumber", "l_quantity", "l_returnflag")


# -- sources ------------------------------------------------------------------------------------------------------------


@book.add(PLAIN)
def scan_csv_dir(spark, d):
    path = folder(spark)
    plain(spark, d).write.option("header", True).csv(path)
    return tables.scan_csv_dir(spark, path, plain(spark, d).schema)


@book.add("SELECT CAST(user_id AS VARCHAR) AS src, event_type AS attack_cat, CAST(event_id AS VARCHAR) AS label FROM events WHERE event_id % 10 > 0")
def scan_csv_positional(spark, d):
    """Rows of 49 positions; every tenth is cut short and skipped."""
    path = folder(spark)
    cells = [F.col("user_id").cast("string"), *[F.lit("-")] * 46, F.col("event_type"), F.col("event_id").cast("string")]
    whole = F.concat_ws(",", F.concat(F.lit("﻿"), cells[0]), *cells[1:])
    events(spark, d).select(F.when(F.col("event_id") % 10 == 0, F.lit("short,row")).otherwise(whole).alias("value")).write.text(path)
    return tables.scan_csv_positional(spark, path).select("src", "attack_cat", "label")


@book.add("SELECT l_returnflag, count(*) AS n, count(extra) AS extras FROM (SELECT l_returnflag, NULL AS extra FROM lineitem WHERE l_returnflag <> 'N' UNION ALL SELECT l_returnflag, l_tax FROM lineitem WHERE l_returnflag = 'N') GROUP BY 1")
def scan_multi_union(spark, d):
    a, b = folder(spark), folder(spark)
    lineitem(spark, d).filter("l_returnflag <> 'N'").select("l_returnflag").write.parquet(a)
    lineitem(spark, d).filter("l_returnflag = 'N'").select("l_returnflag", F.col("l_tax").alias("extra")).write.parquet(b)
    return tables.scan_many(spark, [a, b]).groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("n"), F.count("extra").alias("extras"))


@book.add("SELECT l_returnflag || '.day' AS day, count(*) AS n FROM lineitem GROUP BY 1")
def scan_with_source_file(spark, d):
    """Day files in folders; rows are tagged by where they were read from."""
    path = folder(spark)
    plain(spark, d).withColumn("day", F.col("l_returnflag")).write.partitionBy("day").parquet(path)
    tagged = tables.with_source_file(spark.read.parquet(path).withColumn("in", F.regexp_extract(F.col("_metadata.file_path"), "day=([^/]+)/", 1)))
    return tagged.filter(F.col("source_file") != "").groupBy(F.concat("in", F.lit(".day")).alias("day")).agg(F.count(F.lit(1)).alias("n"))


@book.add("SELECT DISTINCT CAST(user_id AS VARCHAR) AS key FROM events WHERE user_id % 17 = 0")
def scan_blocklist_text(spark, d):
    path = folder(spark)
    line = F.when(F.col("user_id") % 17 == 0, F.concat(F.lit(" "), F.col("user_id").cast("string"))).when(F.col("user_id") % 2 == 0, F.lit("# comment")).otherwise("")
    events(spark, d).select(line.alias("value")).write.text(path)
    return tables.scan_blocklist(spark, path)


@book.add("SELECT user_id, event_type, count(*) AS n FROM events GROUP BY ALL")
def scan_stream_json_dir(spark, d):
    path = folder(spark)
    events(spark, d).select("user_id", "event_type", "value").write.json(path)
    rows = finished(spark, tables.scan_stream_json(spark, path, "user_id bigint, event_type string, value double"))
    return rows.groupBy("user_id", "event_type").agg(F.count(F.lit(1)).alias("n"))


@book.add("SELECT count(*) AS n, CAST(sum(event_id) AS BIGINT) AS ids FROM events")
def stream_incremental_pull(spark, d):
    """Two runs over a growing table: the second sees only what is new."""
    path, out = folder(spark), folder(spark)
    e = events(spark, d).select("event_id", "value")
    for part in (0, 1):
        e.filter(F.col("event_id") % 2 == part).write.mode("append").parquet(path)
        rows = tables.incremental(spark, path, e.schema)
        detection.start(rows, lambda b, n: b.write.mode("overwrite").parquet(f"{out}/rows/batch_id={n}"), f"{out}/checkpoint").awaitTermination()
    return spark.read.option("recursiveFileLookup", True).schema(e.schema).parquet(f"{out}/rows").agg(F.count(F.lit(1)).alias("n"), F.sum("event_id").alias("ids"))


LATE = """(SELECT *, event_id % 10 = 0 AS held, date_trunc('hour', ts) + INTERVAL 1 HOUR <= (SELECT max(ts) FILTER (event_id % 10 > 0) FROM events) - INTERVAL 1 DAY AS closed FROM events)"""


@book.add(f"""SELECT CASE WHEN held AND closed THEN 'late' ELSE 'on time' END AS kind, CAST(date_trunc('day', ts) AS DATE) AS day, count(*) AS n, count(DISTINCT event_id) AS events FROM {LATE} GROUP BY ALL
 UNION ALL SELECT 'dropped by the engine', NULL, 0, 0""")
def stream_late_drop(spark, d):
    """Every tenth event comes in a second file, after a watermark of a day has closed most windows: late rows are set apart, the others reach the
    windowed count of a further stream, and that drops none."""
    root = folder(spark)
    e = events(spark, d).select("event_id", "ts")
    for held in (False, True):
        e.filter((F.col("event_id") % 10 == 0) == held).coalesce(1).write.mode("append").parquet(f"{root}/in")
    rows = spark.readStream.schema(e.schema).option("maxFilesPerTrigger", 1).parquet(f"{root}/in")
    detection.start(rows, late.part(root, "ts", 86_400, 3_600), f"{root}/checkpoint").awaitTermination()
    counter = late.DropCounter()
    spark.streams.addListener(counter)
    on_time = spark.readStream.schema(e.schema).option("recursiveFileLookup", True).parquet(f"{root}/on_time")
    windows = on_time.withWatermark("ts", "1 day").groupBy(F.window("ts", "1 hour")).agg(F.count(F.lit(1)).alias("n"), F.approx_count_distinct("event_id").alias("about"))
    query = detection.start(windows, lambda b, n: b.write.mode("overwrite").parquet(f"{root}/windows/batch_id={n}"), f"{root}/counts", "update")
    query.awaitTermination()
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    spark.streams.removeListener(counter)
    kept, gone = late.both(spark, root, "event_id bigint, ts timestamp")
    by_day = lambda df, kind: df.groupBy(F.lit(kind).alias("kind"), F.to_date("ts").alias("day")).agg(F.count(F.lit(1)).alias("n"), F.count_distinct("event_id").alias("events"))
    engine = spark.range(1).select(F.lit("dropped by the engine").alias("kind"), F.lit(None).cast("date").alias("day"), F.lit(counter.dropped(query.id)).cast("bigint").alias("n"), F.lit(0).cast("bigint").alias("events"))
    return by_day(kept, "on time").unionByName(by_day(gone, "late")).unionByName(engine)


def alert_table(spark, d):
    """Graded events as a stored alert table, a file for each day."""
    path = folder(spark)
    g = graded(spark, d).select("event_id", "severity", "ts", F.to_date("ts").alias("day"))
    for n, r in enumerate(g.select("day").distinct().orderBy("day").collect()):  # a few weeks
        alert_store.append(g.filter(F.col("day") == r["day"]).drop("day").coalesce(1), path, "ts", n)
    return path


@book.add(f"SELECT event_id, severity, true AS few_files FROM {GRADED} ORDER BY ts DESC, event_id LIMIT 25")
def scan_alert_store(spark, d):
    """The newest alerts of a stored table, of which at most three files are opened."""
    newest, opened = alert_store.recent(spark, alert_table(spark, d), "ts", "event_id", 25)
    return newest.select("event_id", "severity", F.lit(opened <= 3).alias("few_files"))


@book.add("SELECT event_type, count(*) AS n, CAST(sum(event_id) AS BIGINT) AS ids, round(sum(value), 6) AS total FROM events GROUP BY 1")
def scan_file_glob_incremental(spark, d):
    """A corpus built from files as they come, through a crash between writing and entering a step."""
    root = folder(spark)
    e = events(spark, d).select("event_id", "event_type", "value")
    read = lambda s, paths: s.read.schema(e.schema).parquet(*paths)
    for part in (0, 1):
        e.filter(F.col("event_id") % 2 == part).repartition(5, "event_id").write.mode("append").parquet(f"{root}/in")

        def crash(n):
            if n == 1:
                raise InterruptedError

        try:
            ledger.append_new(spark, f"{root}/in", f"{root}/corpus", read, "*.parquet", 2, crash)
        except InterruptedError:
            ledger.append_new(spark, f"{root}/in", f"{root}/corpus", read, "*.parquet", 2)
    return ledger.corpus(spark, f"{root}/corpus").groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.sum("event_id").alias("ids"), F.round(F.sum("value"), 6).alias("total"))


# -- sinks --------------------------------------------------------------------------------------------------------------


@book.add(PLAIN)
def sink_parquet(spark, d):
    path = folder(spark)
    sinks.write_counted(plain(spark, d), path, ["l_returnflag"])
    return spark.read.schema(plain(spark, d).schema).parquet(path)


@book.add("SELECT l_returnflag AS label, count(*) AS n FROM lineitem GROUP BY 1")
def sink_delimited_single(spark, d):
    path = folder(spark)
    sinks.write_delimited(quality.label_distribution(lineitem(spark, d), "l_returnflag").select("label", "n"), path)
    return spark.read.option("header", True).option("sep", "\t").schema("label string, n bigint").csv(path)


@book.add("SELECT quantile_disc(l_quantity, 0.5) AS l_quantity, quantile_disc(l_tax, 0.5) AS l_tax FROM lineitem")
def sink_one_row_artifact(spark, d):
    from flowlab.operators.clean import median_impute_fit

    path = folder(spark)
    sinks.write_one_row(spark, median_impute_fit(lineitem(spark, d), ["l_quantity", "l_tax"], 100_000).first().asDict(), path)
    return spark.read.schema("l_quantity double, l_tax double").json(path)


@book.add(f"SELECT round(quantile_cont(p, 0.9), 6) AS medium, round(quantile_cont(p, 0.95), 6) AS high, round(quantile_cont(p, 0.99), 6) AS critical, 'view' AS fitted_on FROM {SQL_S} WHERE event_type = 'view'")
def sink_thresholds(spark, d):
    path = folder(spark)
    fitted = metrics.severity_ladder(events(spark, d).filter("event_type = 'view'"), "p", 0.1).first().asDict()
    sinks.write_one_row(spark, fitted | {"fitted_on": "view"}, path)
    return spark.read.schema("medium double, high double, critical double, fitted_on string").json(path)


@book.add(f"SELECT event_id, 'ml' AS type FROM {SQL_S} WHERE p >= 0.4")
def sink_alerts_foreach_batch(spark, d):
    path = folder(spark)
    sink = sinks.alert_sink(f"{path}/alerts", "ml", lambda b: b.filter("p >= 0.4"))
    detection.start(stream(spark, d).select("event_id", "p"), sink, f"{path}/checkpoint").awaitTermination()
    return spark.read.option("recursiveFileLookup", True).schema("event_id bigint, type string").parquet(f"{path}/alerts")


@book.add("SELECT event_type AS key, max(event_id) AS version, arg_max(value, event_id) AS threshold FROM events GROUP BY 1")
def sink_upsert_state(spark, d):
    path = folder(spark)
    states = events(spark, d).select(F.col("event_type").alias("key"), F.col("event_id").alias("version"), F.col("value").alias("threshold"))
    for part in (1, 0):
        keyed.upsert_state(states.filter(F.col("version") % 2 == part), path, ["key"], "version")
    return keyed.latest_state(spark, path, ["key"], "version")


@book.add("SELECT user_id, max(event_id) AS version, arg_max(value, event_id) AS value, arg_max(event_type, event_id) AS event_type FROM events WHERE user_id % 3 < 2 GROUP BY 1")
def sink_upsert_batches(spark, d):
    """Micro-batches of a stream's last state of each user, of which one comes again after a later one and one touches few users."""
    path = folder(spark)
    rows = events(spark, d).filter("user_id % 3 < 2").select("user_id", F.col("event_id").alias("version"), "value", "event_type")
    parts = [rows.filter("version % 2 = 0"), rows.filter("version % 2 = 1 AND user_id % 3 = 0"), rows.filter("version % 2 = 1 AND user_id % 3 = 1")]
    for n, i in enumerate((0, 1, 2)):
        keyed.upsert_state(parts[i], path, ["user_id"], "version", n, 16)
    keyed.upsert_state(parts[1].withColumn("version", F.col("version") + 10**9), path, ["user_id"], "version", 1, 16)  # an earlier number: left out
    return keyed.latest_state(spark, path, ["user_id"], "version")


@book.add(f"""SELECT 'nodes' AS name, ip AS a, CAST(NULL AS BIGINT) AS b, total_flows AS n, CAST(NULL AS VARCHAR) AS community FROM {graphs.NODES} UNION ALL SELECT 'edges', src, dst, weight, s.community FROM {graphs.EDGES} JOIN {graphs.PARTS} s ON s.ip = src
 UNION ALL SELECT 'communities', NULL, NULL, size, community FROM {graphs.STATS}""")
def sink_graph_tables(spark, d):
    edges = stage(graphs.edges(spark, d), "edges")  # orders and their lines meet once
    nodes = graph.build_nodes(edges)
    parts = graphs.placed(nodes)
    root = folder(spark)
    for size in (5, None):  # an earlier version, and the one that is read
        sinks.write_graph({"nodes": nodes.limit(size) if size else nodes, "edges": graph.endpoint_communities(edges, parts), "communities": graph.community_stats(nodes, edges, parts)}, root)
    unstage(edges)
    none, rows = F.lit(None).cast("bigint"), lambda n: sinks.read_graph(spark, root, n).withColumn("name", F.lit(n))
    return sets.union_all([
        rows("nodes").select("name", F.col("ip").alias("a"), none.alias("b"), F.col("total_flows").alias("n"), F.lit(None).cast("string").alias("community")),
        rows("edges").select("name", F.col("src").alias("a"), F.col("dst").alias("b"), F.col("weight").alias("n"), F.col("src_community").alias("community")),
        rows("communities").select("name", none.alias("a"), none.alias("b"), F.col("size").alias("n"), "community"),
    ])


@book.add(f"SELECT src_ip AS source, event_type AS attack FROM {GRADED} WHERE p >= 0.8")
def sink_alert_csv(spark, d):
    path = folder(spark)
    flat = feeds.alert_export(graded(spark, d).filter("p >= 0.8"), {"source": ["src_ip"], "attack": ["attack_type", "event_type"]})
    flat.write.option("header", True).csv(path)
    return tables.scan_csv_dir(spark, path, flat.schema)


@book.add("SELECT count(*) AS n FROM events WHERE ts >= TIMESTAMP '2024-01-10 00:00:00' - INTERVAL 72 HOUR")
def sink_expired_rewrite(spark, d):
    path = folder(spark)
    sinks.write_dated(events(spark, d).select("event_id", "ts"), path, "ts")
    sinks.expire(spark, path, "ts", "2024-01-10 00:00:00", 72)
    return spark.read.parquet(path).agg(F.count(F.lit(1)).alias("n"))


@book.add("SELECT event_id, CAST(ts AS DATE) AS day FROM events WHERE ts >= TIMESTAMP '2024-01-12 13:30:00' - INTERVAL 100 HOUR")
def sink_expired_days(spark, d):
    """A time to live that ends within a day, applied twice as time goes on."""
    path = folder(spark)
    sinks.write_dated(events(spark, d).select("event_id", "ts"), path, "ts")
    for now in ("2024-01-10 06:00:00", "2024-01-12 13:30:00"):
        sinks.expire(spark, path, "ts", now, 100)
    return spark.read.parquet(path).select("event_id", "day")


# -- smaller operators of the inventory ---------------------------------------------------------------------------------


@book.add(f"SELECT l_rowkey FROM {SQL_L} WHERE l_quantity - 25 < 0 AND l_discount - 0.05 < 0")
def filter_negative_features(spark, d):
    df = lineitem(spark, d).withColumns({"l_quantity": F.col("l_quantity") - 25, "l_discount": F.col("l_discount") - 0.05})
    return df.filter(quality.all_negative(["l_quantity", "l_discount"])).select(KEY)


@book.add(f"SELECT l_rowkey FROM {SQL_L} WHERE l_quantity - 25 < 0 AND l_tax >= 0 AND l_discount - 0.05 >= 0")
def filter_recomputable(spark, d):
    df = lineitem(spark, d).withColumns({"l_quantity": F.col("l_quantity") - 25, "l_discount": F.col("l_discount") - 0.05})
    return df.filter(quality.recomputable("l_quantity", ["l_tax", "l_discount"])).select(KEY)


@book.add("SELECT count(*) AS n FROM (SELECT * FROM lineitem LIMIT 500)")
def limit_rows(spark, d):
    return lineitem(spark, d).limit(500).agg(F.count(F.lit(1)).alias("n"))


@book.add("SELECT DISTINCT l_quantity, l_discount, l_tax FROM lineitem")
def distinct_vectors(spark, d):
    return lineitem(spark, d).select(*F3).distinct()


@book.add("""SELECT event_type AS label, count(*) AS support, count(*) FILTER (event_id % 4 > 0 OR event_type = 'view') AS correct, upper(event_type) AS name FROM events GROUP BY 1""")
def join_left_counts(spark, d):
    p = predicted(spark, d)
    support = p.groupBy(F.col("event_type").alias("label")).agg(F.count(F.lit(1)).alias("support"))
    correct = p.filter("event_type = pred").groupBy(F.col("event_type").alias("label")).agg(F.count(F.lit(1)).alias("correct"))
    return joins.left_counts(support, correct, support.select("label", F.upper("label").alias("name")), "label")


@book.add("SELECT event_id, CASE event_id % 3 WHEN 0 THEN 'BENIGN' WHEN 1 THEN 'Bot' END AS predicted FROM events")
def join_stream_static_model_map(spark, d):
    """Predicted indexes of a stream to labels; unseen indexes are null."""
    labels = spark.createDataFrame([(0, "BENIGN"), (1, "Bot")], "idx bigint, predicted string")
    rows = stream(spark, d).select("event_id", (F.col("event_id") % 3).alias("idx"))
    return finished(spark, rows.join(joins.sized(labels), "idx", "left").select("event_id", "predicted"))


@book.add("SELECT event_type AS value, count(*) AS n FROM events WHERE event_type <> 'view' GROUP BY 1")
def attacks_by_type(spark, d):
    return feeds.counts_by(events(spark, d).filter("event_type <> 'view'"), "event_type")


@book.add("""SELECT cluster, label, n FROM (SELECT CAST(user_id % 10 AS INTEGER) AS cluster, event_type AS label, count(*) AS n, row_number() OVER (PARTITION BY user_id % 10 ORDER BY count(*) DESC, event_type) AS r FROM events GROUP BY 1, 2, user_id % 10) WHERE r = 1""")
def win_row_number_dominant(spark, d):
    counts = events(spark, d).groupBy((F.col("user_id") % 10).cast("int").alias("cluster"), F.col("event_type").alias("label")).agg(F.count(F.lit(1)).alias("n"))
    return counts.withColumn("r", F.row_number().over(Window.partitionBy("cluster").orderBy(F.desc("n"), "label"))).filter("r = 1").drop("r")


@book.add("SELECT day, family, abs(n - lag(n) OVER (PARTITION BY family ORDER BY day)) AS step FROM (SELECT date_trunc('day', ts) AS day, event_type AS family, count(*) AS n FROM events GROUP BY ALL)")
def win_diff_abs(spark, d):
    daily = feeds.timeline(events(spark, d), "ts", "event_type", "day")
    return daily.select(F.col("bucket").alias("day"), F.col("value").alias("family"), F.abs(F.col("n") - F.lag("n").over(Window.partitionBy("value").orderBy("bucket"))).alias("step"))


@book.add(f"SELECT src_community, attack_edges, bytes FROM (SELECT community AS src_community, attack_edges, bytes FROM {graphs.STATS})")
def community_attack_stats(spark, d):
    return graphs.stats(spark, d).select(F.col("community").alias("src_community"), "attack_edges", "bytes")


@book.add("""WITH c AS (SELECT user_id, date_trunc('day', ts) AS w, count(*) AS k FROM events GROUP BY ALL) SELECT user_id, w AS window_start, CASE WHEN k >= 6 THEN 'Critical' WHEN k >= 4 THEN 'High' ELSE 'Medium' END AS severity
 FROM c WHERE k >= 2 AND w + INTERVAL 1 DAY <= (SELECT max(ts) - INTERVAL 30 SECOND FROM events)""")
def stream_spike_severity(spark, d):
    """Severity of the spikes of a stream, each window once its watermark has passed."""
    df = detection.spikes(stream(spark, d), "user_id", "ts", "value", "event_type", "1 day", 2, 4, 6)
    return finished(spark, df.select("user_id", "window_start", "severity"))


@book.add("SELECT event_id, date_trunc('second', ts) AS event_ts FROM events")
def stream_event_time(spark, d):
    text = stream(spark, d).select("event_id", F.concat(F.lit(" "), F.date_format("ts", "yyyy-MM-dd HH:mm:ss")).alias("event_time"))
    return finished(spark, detection.event_time(text).select("event_id", "event_ts"))


@book.add("""WITH c AS (SELECT user_id, date_trunc('day', ts) AS w, count(*) AS k FROM events GROUP BY ALL) SELECT user_id, w AS window_start, k AS connection_count FROM c WHERE k >= 5""")
def stream_update_mode(spark, d):
    """Windows as they grow, kept by key: the newest version of each."""
    df = detection.spikes(stream(spark, d), "user_id", "ts", "value", "event_type", "1 day", 5, 7, 9)
    rows = finished(spark, df, "update")
    return rows.groupBy("user_id", "window_start").agg(F.max("connection_count").alias("connection_count"))


@book.add("""SELECT event_id, CAST(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END AS INTEGER) AS label, true AS only_new_files FROM events WHERE event_type IN ('error', 'view') AND ts > (SELECT max(ts) - INTERVAL 5 DAY FROM events)""")
def feedback_poll(spark, d):
    """Verdicts of a stored table that are new since the last poll, each once: only files that reach beyond it are opened."""
    path = folder(spark)
    said = F.when(is_error(), "confirmed").when(F.col("event_type") == "view", "benign")
    v = events(spark, d).select("event_id", "ts", labels.verdict(said).alias("label"), F.to_date("ts").alias("day"))
    days = [r["day"] for r in v.select("day").distinct().orderBy("day").collect()]  # a few weeks
    for n, day in enumerate([*days, days[-1]]):  # the last day is stored twice
        alert_store.append(v.filter(F.col("day") == day).drop("day").coalesce(1), path, "ts", n)
    last = v.agg(F.max("ts") - F.expr("INTERVAL 5 DAYS")).first()[0]
    new, opened = alert_store.since(spark, path, "ts", last)
    return new.filter(F.col("label").isNotNull()).dropDuplicates(["event_id"]).select("event_id", "label", F.lit(opened <= 7).alias("only_new_files"))


@book.add(f"SELECT l_rowkey, unnest([{', '.join(repr(f) for f in F4)}]) AS feature, unnest([{', '.join(F4)}]) AS value FROM {SQL_L}")
def wide_to_long(spark, d):
    return lineitem(spark, d).select(KEY, *F4).unpivot([KEY], F4, "feature", "value")
