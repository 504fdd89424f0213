"""The scoring stream as one pipeline: scale, gate, prefilter, specialist, graded verdict. Batch and stream share it."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowlab.functions.scores import safe_prefilter
from flowlab.operators import policy


def probability(df: DataFrame, model, out: str, keep: list[str]) -> DataFrame:
    """The kept columns and `out`: a column of that name if the model makes one, else its probability of class 1."""
    done = model.transform(df)
    p = F.col(out) if out in done.columns else vector_to_array("probability")[1]
    return done.select(*[F.col(f"`{c}`") for c in keep], p.alias(out))


def scored_alerts(flows: DataFrame, models: dict[str, PipelineModel], keep: list[str], th: policy.Thresholds = policy.Thresholds(), hint: str | None = None, most_shift: float = 0.0) -> DataFrame:
    """Alerts among flows with the kept columns and the fields of `policy.classify_flow`.

    models: `scaler` (left out if features need none), `gate`, and `specialist` or none. Rows that cannot reach the threshold, even
    if an adapted policy moved the score by `most_shift`, go before the specialist is asked."""
    ready = models["scaler"].transform(flows) if "scaler" in models else flows
    kept = [*keep, *([hint] if hint and hint not in keep else [])]
    first = probability(ready, models["gate"], "p_attack", [*ready.columns])
    first = first.filter(F.col("p_attack") >= (safe_prefilter(th.attack, most_shift) if most_shift else th.attack))
    if "specialist" in models:
        both = probability(first, models["specialist"], "p_bot", [*kept, "p_attack"])
    else:
        both = first.select(*kept, "p_attack", F.lit(None).cast("double").alias("p_bot"))
    named = both.withColumn("_hint", F.col(f"`{hint}`") if hint else F.lit(None).cast("string"))
    verdict = policy.classify_flow(F.col("p_attack"), F.col("p_bot"), F.col("_hint"), th)
    return named.withColumn("_v", verdict).filter("_v.alert").select(*[F.col(f"`{c}`") for c in keep], "p_attack", "_v.*").drop("alert")
