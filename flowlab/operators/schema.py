"""Harmonising differently named sources into one canonical flow table."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowlab.functions.labels import is_attack, normalise_label

# The numeric features of a flow, in order.
FEATURES = [
    "Destination Port", "Flow Duration", "Total Fwd Packets", "Total Backward Packets", "Total Length of Fwd Packets", "Total Length of Bwd Packets",
    "Fwd Packet Length Max", "Fwd Packet Length Min", "Fwd Packet Length Mean", "Fwd Packet Length Std",
    "Bwd Packet Length Max", "Bwd Packet Length Min", "Bwd Packet Length Mean", "Bwd Packet Length Std",
    "Flow Bytes/s", "Flow Packets/s", "Flow IAT Mean", "Flow IAT Std", "Flow IAT Max", "Flow IAT Min",
    "Fwd IAT Total", "Fwd IAT Mean", "Fwd IAT Std", "Fwd IAT Max", "Fwd IAT Min", "Bwd IAT Total", "Bwd IAT Mean", "Bwd IAT Std", "Bwd IAT Max", "Bwd IAT Min",
    "Fwd PSH Flags", "Bwd PSH Flags", "Fwd URG Flags", "Bwd URG Flags", "Fwd Header Length", "Bwd Header Length", "Fwd Packets/s", "Bwd Packets/s",
    "Min Packet Length", "Max Packet Length", "Packet Length Mean", "Packet Length Std", "Packet Length Variance",
    "FIN Flag Count", "SYN Flag Count", "RST Flag Count", "PSH Flag Count", "ACK Flag Count", "URG Flag Count", "CWE Flag Count", "ECE Flag Count",
    "Down/Up Ratio", "Average Packet Size", "Avg Fwd Segment Size", "Avg Bwd Segment Size",
    "Fwd Avg Bytes/Bulk", "Fwd Avg Packets/Bulk", "Fwd Avg Bulk Rate", "Bwd Avg Bytes/Bulk", "Bwd Avg Packets/Bulk", "Bwd Avg Bulk Rate",
    "Subflow Fwd Packets", "Subflow Fwd Bytes", "Subflow Bwd Packets", "Subflow Bwd Bytes", "Init_Win_bytes_forward", "Init_Win_bytes_backward",
    "act_data_pkt_fwd", "min_seg_size_forward", "Active Mean", "Active Std", "Active Max", "Active Min", "Idle Mean", "Idle Std", "Idle Max", "Idle Min",
]
LABEL = "Label"
CANONICAL = T.StructType([*[T.StructField(f, T.DoubleType()) for f in FEATURES], T.StructField(LABEL, T.StringType())])


@dataclass(frozen=True)
class SourceSpec:
    """How one source differs: renames to canonical names, columns to drop, the labels to keep (canonical; all if empty)."""

    name: str
    rename: Mapping[str, str] = field(default_factory=dict)
    drop: tuple[str, ...] = ()
    keep_labels: tuple[str, ...] = ()


def strip_column_names(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.strip() for c in df.columns])


def clean_column_names(df: DataFrame) -> DataFrame:
    """Trimmed, inner spaces as underscores, repeated names numbered _2, _3 ..."""
    seen: dict[str, int] = {}
    names = []
    for c in df.columns:
        base = "_".join(c.split())
        seen[base] = seen.get(base, 0) + 1
        names.append(base if seen[base] == 1 else f"{base}_{seen[base]}")
    return df.toDF(*names)


def rename_by_map(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    return df.withColumnsRenamed({k: v for k, v in mapping.items() if k in df.columns})


def drop_columns(df: DataFrame, names: Iterable[str]) -> DataFrame:
    return df.drop(*names)


def fix_positional_duplicate(df: DataFrame, name: str) -> DataFrame:
    """Spark names a repeated header by appending its position: keep the first of `name12`, `name34` as `name`."""
    found = sorted((c for c in df.columns if c.startswith(name) and c[len(name) :].isdigit()), key=lambda c: int(c[len(name) :]))
    if not found or name in df.columns:
        return df.drop(*found) if name in df.columns else df
    return df.withColumnRenamed(found[0], name).drop(*found[1:])


def select_canonical(df: DataFrame, features: list[str], label: str = LABEL, with_target: bool = True) -> DataFrame:
    """Exactly the features (missing ones null) and the label, as one projection."""
    have = set(df.columns)
    columns = [(F.col(f"`{f}`") if f in have else F.lit(None)).cast("double").alias(f) if f not in have else F.col(f"`{f}`").try_cast("double").alias(f) for f in features]
    columns.append(F.col(f"`{label}`").alias(label))
    return df.select(*columns, is_attack(F.col(f"`{label}`")).alias("is_attack")) if with_target else df.select(*columns)


def harmonise(df: DataFrame, spec: SourceSpec, features: list[str], label: str = LABEL) -> DataFrame:
    """One source in canonical form, its label normalised, tagged with the source's name."""
    df = drop_columns(rename_by_map(strip_column_names(df), spec.rename), spec.drop)
    df = df.withColumn(label, normalise_label(F.col(f"`{label}`"))).filter(F.coalesce(F.col(f"`{label}`"), F.lit("")) != "")
    out = select_canonical(df, features, label)
    if spec.keep_labels:
        out = out.filter(F.upper(F.trim(F.col(f"`{label}`"))).isin(*[k.upper() for k in spec.keep_labels]))
    return out.withColumn("source", F.lit(spec.name))


def corpus_build(parts: Iterable[tuple[DataFrame, SourceSpec]], features: list[str], label: str = LABEL) -> DataFrame:
    """All sources in canonical form, one below the other."""
    frames = [harmonise(df, spec, features, label) for df, spec in parts]
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def count_report(df: DataFrame, label: str, expected: Mapping[str, int]) -> DataFrame:
    """(label, expected, actual, passed) for every expected label."""
    counts = df.groupBy(F.col(f"`{label}`").alias("_label")).agg(F.count(F.lit(1)).alias("n"))
    want = df.sparkSession.createDataFrame(list(expected.items()), "label string, expected bigint")
    actual = F.coalesce("n", F.lit(0).cast("bigint"))
    return want.join(counts, F.col("label") == F.col("_label"), "left").select("label", "expected", actual.alias("actual"), (actual == F.col("expected")).alias("passed"))


def assert_counts(df: DataFrame, label: str, expected: Mapping[str, int]) -> DataFrame:
    """df, if every expected label has its count; else an error that names those that have not."""
    wrong = count_report(df, label, expected).filter(~F.col("passed")).limit(20).collect()
    if wrong:
        raise ValueError("counts differ: " + ", ".join(f"{r['label']} {r['actual']} instead of {r['expected']}" for r in wrong))
    return df


def schema_coverage(df: DataFrame, spec: SourceSpec, features: list[str]) -> DataFrame:
    """(column, status, filled): every canonical column a source lacks, has, or has besides, with its non-null values."""
    named = rename_by_map(strip_column_names(df), spec.rename).drop(*spec.drop)
    counts = named.agg(*[F.count(F.col(f"`{c}`")).alias(c) for c in named.columns])
    status = {c: "covered" if c in features else "extra" for c in named.columns} | {f: "missing" for f in features if f not in named.columns}
    rows = [F.struct(F.lit(c).alias("column"), F.lit(s).alias("status"), (F.lit(0).cast("long") if s == "missing" else F.col(f"`{c}`")).alias("filled")) for c, s in status.items()]
    return counts.select(F.inline(F.array(*rows)))
