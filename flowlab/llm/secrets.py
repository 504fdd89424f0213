"""Secret scans over an incremental ledger of content-addressed versions.

Every historical version of a text is addressed by its SHA-256. The ledger says which rule versions each blob has been scanned
with and what they found; a run scans only pairs of blob and rule version that the ledger lacks, appends its rows, and
joins findings back to every path that holds the blob. All of it is DataFrame operations.

Addresses are compared before any text moves. While a text is addressed, a plain hint of every rule (a fragment that each
of its matches holds) is looked for in place: a blob without the hint of a pending rule is done with it, and only texts that
are both unseen and hinted at are brought together, one for each blob (as long as the unseen ones are few enough to be sent to every task; a first scan of
a large corpus moves every hinted text once).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowlab.llm.common import exclusive_sums, shelved, stage
from flowlab.llm.skew import join_weighted


@dataclass(frozen=True)
class Rule:
    """A pattern whose leftmost non-overlapping matches are findings if they pass: `least` characters in `group`."""

    kind: str
    version: int
    pattern: str
    group: int = 0
    least: int = 1
    #: A pattern that is found in every text in which a match passes.
    hint: str = ""

    @property
    def id(self) -> str:
        return f"{self.kind}:{self.version}"


#: The base kinds, in their order.
BASE = (
    Rule("assign", 1, r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6,
         r"""([Dd]|[Tt]|[Nn]|[Yy])["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=-]{6}"""),
    Rule("access", 1, r"AKIA[A-Z0-9]+", 0, 20, "AKIA"),
    Rule("hex", 1, r"[0-9a-f]{24,}", 0, 24, "[0-9a-f]{24}"),  # a run of at least 24 starts where the whole run starts
)
#: What later rule versions add.
ADDED = (
    Rule("pem", 2, r"-----BEGIN [A-Z ]*PRIVATE KEY-----", hint="PRIVATE KEY-----"),
    Rule("jwt", 2, r"eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", 0, 24, r"eyJ[A-Za-z0-9_-]+\."),
)
RULES = BASE + ADDED

#: Wanted blobs that may be sent to every task, as 8 bytes each.
SENT = 500_000
LEDGER = "blob string, scanned array<string>, findings array<struct<rule:string,start:bigint,end:bigint>>"


def _spans(text: Column, rule: Rule) -> Column:
    """array<struct<rule,start,end>> in code points. What split() leaves between matches tells where they start."""
    found = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0))
    checked = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(rule.group))
    between = F.transform(F.slice(F.split(text, rule.pattern, -1), 1, F.size(found)), lambda p: F.length(p))
    lengths = F.transform(found, lambda m: F.length(m))
    # a match begins after all earlier gaps and matches and its own gap
    before = exclusive_sums(F.zip_with(between, lengths, lambda a, b: a + b))
    starts = F.zip_with(before, between, lambda a, b: a + b)
    spans = F.zip_with(starts, lengths, lambda s, n: F.struct(F.lit(rule.id).alias("rule"), s.alias("start"), (s + n).alias("end")))
    long_enough = F.transform(checked, lambda g: F.length(g) >= rule.least)
    kept = F.filter(F.arrays_zip(spans.alias("s"), long_enough.alias("k")), lambda z: z["k"])
    return F.when(F.size(found) > 0, F.transform(kept, lambda z: z["s"])).otherwise(F.array().cast("array<struct<rule:string,start:bigint,end:bigint>>"))


def blob_of(text: Column) -> Column:
    """The content address of a text; a null text is the empty text."""
    return F.sha2(F.coalesce(text, F.lit("")), 256)


def addressed(versions: DataFrame, text: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The columns of versions (but text) with blob, and hinted array<string>, the ids of the rules whose hint is in the
    text. versions: a row for each path and historical version, or just for each path. Columns named blob or hinted are replaced."""
    away, back = shelved(versions, ("blob", "hinted", text))
    t = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    hints = F.array_compact(F.array(*[F.when(t.rlike(r.hint), F.lit(r.id)) for r in rules]))
    return versions.select(*away, blob_of(F.col(f"`{text}`")).alias("blob"), hints.alias("hinted")).select(*back, "blob", "hinted")


def pending_blobs(paths: DataFrame, ledger: DataFrame | None = None, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(blob, hinted, pending): each distinct blob of addressed paths for which the ledger lacks a rule version, with the ids of
    those. Copies meet in map-side aggregation. No text is read."""
    # array_intersect keeps what this call asks for
    wanted = F.array(*[F.lit(r.id) for r in rules])
    blobs = paths.groupBy("blob").agg(F.first("hinted").alias("hinted"))
    if ledger is None:
        return blobs.withColumn("pending", wanted)
    seen = ledger.groupBy(F.col("blob").alias("s_blob")).agg(F.array_distinct(F.flatten(F.collect_list("scanned"))).alias("seen"))
    pending = F.array_except(wanted, F.coalesce("seen", F.array().cast("array<string>")))
    return blobs.join(seen, F.col("blob") == F.col("s_blob"), "left").select("blob", "hinted", pending.alias("pending")).filter(F.size("pending") > 0)


def _texts_due(versions: DataFrame, wanted: DataFrame, might: Column, text: str = "text") -> DataFrame:
    """(blob, text) of the rows whose blob is wanted, copies included. Up to SENT wanted blobs go to every task as 64-bit hashes, so that no other text
    moves; beyond them all texts with a hint meet the wanted blobs by shuffle."""
    hinted = versions.filter(might).select(blob_of(F.col(f"`{text}`")).alias("blob"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    if wanted.limit(SENT + 1).count() > SENT:
        return hinted
    hashes = wanted.select(F.xxhash64("w_blob").alias("w_hash")).distinct()
    return hinted.join(F.broadcast(hashes), F.xxhash64("blob") == F.col("w_hash"), "left_semi")


def scan(versions: DataFrame, pending: DataFrame, rules: tuple[Rule, ...] = RULES, text: str = "text") -> DataFrame:
    """Ledger rows for the pending pairs. A blob without findings has a row too: it need not be scanned again. Pending blobs come first: texts are
    brought together, one for each blob, only of blobs that are pending and hold a hint of a pending rule."""
    none = F.array().cast("array<struct<rule:string,start:bigint,end:bigint>>")
    due = stage(pending.withColumn("due", F.array_intersect("pending", "hinted")), "pending")
    ids = {r["id"] for r in due.select(F.explode("due").alias("id")).distinct().collect()}  # at most a row for each rule
    might = F.coalesce(F.col(f"`{text}`"), F.lit("")).rlike("|".join(f"(?:{r.hint})" for r in rules if r.id in ids)) if ids else F.lit(False)
    wanted = due.filter(F.size("due") > 0).select(F.col("blob").alias("w_blob"), "pending", "due")
    texts = _texts_due(versions, wanted, might, text).groupBy("blob").agg(F.first("text").alias("text"))
    met = texts.join(wanted, F.col("blob") == F.col("w_blob"))
    found = [F.when(F.array_contains("due", r.id), _spans(F.col("text"), r)).otherwise(none).alias(f"f{i}") for i, r in enumerate(rules)]
    read = met.select("blob", "pending", *found).select("blob", F.col("pending").alias("scanned"), F.concat(*[F.col(f"f{i}") for i in range(len(rules))]).alias("findings"))
    return read.unionByName(due.filter(F.size("due") == 0).select("blob", F.col("pending").alias("scanned"), none.alias("findings")))


def findings_by_path(paths: DataFrame, ledger: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The columns of addressed paths (but hinted) with findings array<struct<start,order,kind,end>>, ordered by start, then
    by the rules' order.

    Null texts count as empty and have no findings. Repeated rows and copies each get the findings of their blob. A column
    named findings is replaced. An empty table gives an empty result. Findings of rule versions not in
    `rules` are left out; a ledger that holds a pair twice gives its findings once. A blob that very many paths hold is not one task.
    """
    order = F.create_map(*[x for i, r in enumerate(rules) for x in (F.lit(r.id), F.lit(i))])
    kind = F.create_map(*[x for r in rules for x in (F.lit(r.id), F.lit(r.kind))])
    # only blobs with findings are joined
    found = (
        ledger.filter(F.size("findings") > 0)
        .groupBy("blob")
        .agg(F.array_distinct(F.flatten(F.collect_list("findings"))).alias("all"))
        .select(
            F.col("blob").alias("l_blob"),
            F.sort_array(
                F.transform(
                    F.filter("all", lambda f: order[f["rule"]].isNotNull()),
                    lambda f: F.struct(f["start"].alias("start"), order[f["rule"]].alias("order"), kind[f["rule"]].alias("kind"), f["end"].alias("end")),
                )
            ).alias("l_findings"),
        )
    )
    away, back = shelved(paths, ("blob", "hinted", "findings"))
    slim = paths.select(*away, "blob")
    copies = slim.groupBy(F.col("blob").alias("c_blob")).agg(F.count(F.lit(1)).alias("l_paths"))
    right = stage(found.join(copies, F.col("l_blob") == F.col("c_blob")).drop("c_blob"), "findings")
    empty = F.array().cast("array<struct<start:bigint,order:int,kind:string,end:bigint>>")
    joined = join_weighted(slim, right, F.col("blob") == F.col("l_blob"), "l_paths", "left")
    return joined.select(*back, "blob", F.coalesce("l_findings", empty).alias("findings"))


def of_kinds(findings: Column, kinds: tuple[str, ...]) -> Column:
    return F.filter(findings, lambda f: f["kind"].isin(*kinds))


def listed(findings: Column, kinds: tuple[str, ...] | None = None) -> Column:
    """kind:start:end of each finding (of the named kinds), comma-joined."""
    if kinds:
        findings = of_kinds(findings, kinds)
    return F.array_join(F.transform(findings, lambda f: F.concat_ws(":", f["kind"], f["start"], f["end"])), ",")
