"""Exact token counts from a length histogram.

Documents are aggregated by encoded length, so what is left grows with the number of distinct lengths, not of documents.
Suffix sums over the histogram answer totals, quantiles and truncated totals for every context limit.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from flowlab.llm.bpe import token_lengths
from flowlab.llm.common import stage

#: Lengths in one band of the two-step suffix sums.
BAND = 1024
#: Context limits and quantiles that `answers` gives.
LIMITS = [128, 512, 1000, 2048, 4096, 8192, 32_768, 131_072]
SHARES = [0.01, 0.1, 0.25, 0.5, 0.75, 0.9, 0.99, 0.999]


def length_histogram(docs: DataFrame, text: str = "text", path: str | None = None) -> DataFrame:
    """(n_tokens, n_docs): how many documents have each encoded length. Null and empty texts have length 0, repeated rows
    count each, texts of any length are encoded whole, other columns are not read, and an empty table has no rows. It is written once, so
    that whatever reads it twice does not encode twice."""
    return stage(token_lengths(docs.select(F.col(f"`{text}`").alias("text")), path=path).groupBy("n_tokens").agg(F.count(F.lit(1)).alias("n_docs")), "histogram")


def suffix_sums(histogram: DataFrame) -> DataFrame:
    """For each length: n_tokens, n_docs, docs_over (documents that are longer), tokens_over (their tokens), total_docs,
    total_tokens, truncated_total (tokens left if every document is cut to n_tokens) and rank_from, rank_to (the ranks, from
    1, that documents of this length take in order of length).

    A limit between two lengths is answered from the row of the next smaller one (see `truncated_totals`). An empty
    histogram gives an empty result. Sums are taken inside bands of BAND lengths, then over bands.
    """
    h = histogram.select("n_tokens", "n_docs", (F.col("n_tokens") * F.col("n_docs")).alias("tokens"), F.floor(F.col("n_tokens") / BAND).alias("band"))
    inside = Window.partitionBy("band").orderBy(F.desc("n_tokens")).rowsBetween(Window.unboundedPreceding, -1)
    part = h.withColumn("d_in", F.coalesce(F.sum("n_docs").over(inside), F.lit(0))).withColumn("t_in", F.coalesce(F.sum("tokens").over(inside), F.lit(0)))
    bands = h.groupBy("band").agg(F.sum("n_docs").alias("d"), F.sum("tokens").alias("t"))
    # one row per 1024 lengths: about a thousand for texts of a million tokens
    above = Window.partitionBy(F.lit(0)).orderBy(F.desc("band")).rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy(F.lit(0))
    bases = bands.select(
        F.col("band").alias("b"), F.coalesce(F.sum("d").over(above), F.lit(0)).alias("d_base"), F.coalesce(F.sum("t").over(above), F.lit(0)).alias("t_base"),
        F.sum("d").over(everything).alias("total_docs"), F.sum("t").over(everything).alias("total_tokens"),
    )
    docs_over, tokens_over = F.col("d_in") + F.col("d_base"), F.col("t_in") + F.col("t_base")
    rank_to = F.col("total_docs") - docs_over
    return part.join(bases, F.col("band") == F.col("b")).select(
        "n_tokens", "n_docs", docs_over.alias("docs_over"), tokens_over.alias("tokens_over"), "total_docs", "total_tokens",
        (F.col("total_tokens") - tokens_over + docs_over * F.col("n_tokens")).alias("truncated_total"),
        (rank_to - F.col("n_docs") + 1).alias("rank_from"), rank_to.alias("rank_to"),
    )


def answers(histogram: DataFrame, limits: list[int] = LIMITS, shares: list[float] = SHARES) -> DataFrame:
    """`suffix_sums` with kind `length`, then a row for each context limit (kind `limit`: at and n_tokens are the limit, n_docs
    the documents of just that length) and for each quantile (kind `quantile`: at is the share, the rest the row of the
    length of the document with rank ceil(share * documents), at least 1). Limits above every length are answered too; an
    empty histogram gives no rows."""
    sums = stage(suffix_sums(histogram), "sums")
    rest = [c for c in sums.columns if c != "n_tokens"]
    limit = truncated_totals(sums, limits).select(
        F.lit("limit").alias("kind"), F.col("context").cast("double").alias("at"), F.col("context").cast("bigint").alias("n_tokens"),
        "n_docs", "docs_over", "tokens_over", F.col("all_docs").alias("total_docs"), F.col("all_tokens").alias("total_tokens"), "truncated_total",
        (F.col("all_docs") - F.col("docs_over") - F.col("n_docs") + 1).alias("rank_from"), (F.col("all_docs") - F.col("docs_over")).alias("rank_to"),
    )
    quantile = quantiles(sums, shares).withColumnRenamed("n_tokens", "q").join(sums, F.col("q") == F.col("n_tokens"))
    quantile = quantile.select(F.lit("quantile").alias("kind"), F.col("share").alias("at"), "n_tokens", *rest)
    return sums.select(F.lit("length").alias("kind"), F.lit(None).cast("double").alias("at"), "n_tokens", *rest).unionByName(limit).unionByName(quantile)


def truncated_totals(sums: DataFrame, limits: list[int]) -> DataFrame:
    """(context, n_docs, docs_over, tokens_over, truncated_total, all_docs, all_tokens) for each of the given context limits, from `suffix_sums`."""
    below = _per_value(sums, limits, "context", F.col("n_tokens") <= F.col("context"))
    over, tokens = F.coalesce("docs_over", "all_docs"), F.coalesce("tokens_over", "all_tokens")
    return below.select(
        "context", F.when(F.col("n_tokens") == F.col("context"), F.col("n_docs")).otherwise(F.lit(0)).alias("n_docs"),
        over.alias("docs_over"), tokens.alias("tokens_over"), (F.col("all_tokens") - tokens + over * F.col("context")).alias("truncated_total"), "all_docs", "all_tokens",
    )


def quantiles(sums: DataFrame, shares: list[float]) -> DataFrame:
    """(share, n_tokens): the length of the document with rank ceil(share * documents), at least 1."""
    rank = F.greatest(F.ceil(F.col("share") * F.col("total_docs")), F.lit(1))
    return _per_value(sums, shares, "share", (F.col("rank_from") <= rank) & (rank <= F.col("rank_to"))).select("share", "n_tokens")


def _per_value(sums: DataFrame, values: list, name: str, fits) -> DataFrame:
    """For each value the row with the greatest length that fits, and the number and tokens of all documents."""
    spread = sums.withColumn(name, F.explode(F.array(*[F.lit(v) for v in values])))
    row = F.struct("n_tokens", "n_docs", "docs_over", "tokens_over")
    return spread.groupBy(name).agg(F.max(F.when(fits, row)).alias("r"), F.max("total_docs").alias("all_docs"), F.max("total_tokens").alias("all_tokens")).select(name, "r.*", "all_docs", "all_tokens")
