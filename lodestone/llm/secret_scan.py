"""Secret scans over an incremental blob ledger.

Every version of every path is addressed by the SHA-256 of its content. A ledger row says which rule versions have seen
a blob and what they found; a scan reads only blobs that lack a current rule version, and only with the rules they lack.
Findings join back to all paths by blob. The ledger is a Parquet table in a folder of the caller's, which every run appends
to. Built-in expressions only.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import fresh_path, let, stored


@dataclass(frozen=True)
class Rule:
    """Matches of ``pattern`` are spans if ``group`` has ``least`` characters or more.

    ``least`` is applied after matching, so a match that is too short still uses up its characters.
    """

    kind: str
    pattern: str
    group: int = 0
    least: int = 0

    @property
    def version(self) -> str:
        return f"{self.kind}@{hashlib.sha256(repr((self.pattern, self.group, self.least)).encode()).hexdigest()[:12]}"


#: The first three are the contract's. Their order is the order of kinds that start at one place.
BASE_RULES = (
    Rule("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    # A run of [A-Z0-9] or [0-9a-f] is matched whole or not at all, so its length may stand in the pattern.
    Rule("access", r"AKIA[A-Z0-9]{16,}"),
    Rule("hex", r"[0-9a-f]{24,}"),
)
MORE_RULES = (
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("pem", r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----"),
)
RULES = BASE_RULES + MORE_RULES

FINDINGS = "array<struct<version:string,start:int,end:int>>"


def running_sum(lengths: Column) -> Column:
    """Inclusive prefix sums of a non-empty array, in as many passes as its size has binary digits."""
    passes = F.slice(F.sequence(F.lit(0), F.lit(30)), F.lit(1), F.length(F.bin(F.size(lengths) - 1)))
    return F.aggregate(passes, lengths, lambda acc, p: F.transform(acc, lambda x, k: x + F.coalesce(F.get(acc, k - F.call_function("shiftleft", F.lit(1), p)), F.lit(0))))


def spans(text: Column, rule: Rule) -> Column:
    """Leftmost non-overlapping spans in code points: gaps between matches and matches add up to places."""

    def placed(parts: Column) -> Column:
        found, groups = parts["found"], parts["groups"]
        steps = F.transform(found, lambda x, k: F.length(x) + F.length(F.get(parts["gaps"], k)))
        long_enough = F.filter(F.sequence(F.lit(0), F.size(found) - 1), lambda k: F.length(F.get(groups, k)) >= rule.least)

        def span(ends: Column, k: Column) -> Column:
            end = F.get(ends, k)
            return F.struct(F.lit(rule.version).alias("version"), (end - F.length(F.get(found, k))).alias("start"), end.alias("end"))

        return let(steps, lambda x: let(running_sum(x), lambda ends: F.transform(long_enough, lambda k: span(ends, k))))

    whole = F.regexp_extract_all(text, F.lit(f"({rule.pattern})"), F.lit(1))
    group = F.regexp_extract_all(text, F.lit(f"({rule.pattern})"), F.lit(rule.group + 1)) if rule.group else whole
    parts = F.struct(F.split(text, rule.pattern, -1).alias("gaps"), whole.alias("found"), group.alias("groups"))
    return F.when(text.rlike(rule.pattern), let(parts, placed)).otherwise(F.array().cast(FINDINGS))


def blob_id(content: Column) -> Column:
    return F.unhex(F.sha2(content, 256))


def scan_unseen(versions: DataFrame, ledger: DataFrame | None = None, rules: tuple[Rule, ...] = RULES, content_column: str = "text") -> DataFrame:
    """New ledger rows (blob_id, rule_versions, findings) for the blob and rule-version pairs that the ledger lacks.

    One row per blob; null content is the empty blob. With nothing unseen the result is empty.
    """
    content = F.coalesce(F.col(content_column).cast("string"), F.lit(""))
    blobs = versions.select(blob_id(content).alias("blob_id"), content.alias("content")).dropDuplicates(["blob_id"])
    every = F.array(*[F.lit(r.version) for r in rules])
    if ledger is None:
        due = blobs.withColumn("rule_versions", every)
    else:
        seen = ledger.groupBy("blob_id").agg(F.array_distinct(F.flatten(F.collect_list("rule_versions"))).alias("seen"))
        due = blobs.join(seen, "blob_id", "left").withColumn("rule_versions", F.coalesce(F.array_except(every, "seen"), every)).where(F.size("rule_versions") > 0)
    none = F.array().cast(FINDINGS)
    found = [
        spans(F.col("content"), r) if ledger is None else F.when(F.array_contains("rule_versions", r.version), spans(F.col("content"), r)).otherwise(none) for r in rules
    ]
    return due.select("blob_id", "rule_versions", F.concat(*found).alias("findings"))


LEDGER = f"blob_id binary, rule_versions array<string>, findings {FINDINGS}"


def read_ledger(spark: SparkSession, path: str) -> DataFrame | None:
    """The ledger in the folder ``path``; None where no run has written one."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    there = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(at)
    return spark.read.schema(LEDGER).parquet(path) if there else None


def scan_versions(
    versions: DataFrame, ledger_path: str | None = None, rules: tuple[Rule, ...] = RULES, id_columns: tuple[str, ...] = ("doc_id",), content_column: str = "text"
) -> tuple[DataFrame, str]:
    """(findings per version of a path, the ledger's folder).

    The blob and rule-version pairs that the ledger in ``ledger_path`` lacks are scanned and appended to it; that folder
    stays. Without a path the ledger is a new one in the shared folder, which goes with the session. An append that fails
    leaves no rows, so a run can be repeated; two runs on one ledger at a time may both scan a pair, which changes nothing.

    Findings: ``id_columns`` (a path, or a path and a version), blob_id, spans array<struct<kind, start, end>> ordered by
    start, then by the rules' order. Every input row has a result, repeated ones too; a row without text or secrets has an
    empty array, null ids included. An empty table gives an empty result; other columns are not read.
    """
    spark = versions.sparkSession
    path = ledger_path or fresh_path(spark, "secret-ledger")
    scan_unseen(versions, read_ledger(spark, path), rules, content_column).write.mode("append").parquet(path)
    known = spark.read.schema(LEDGER).parquet(path)
    current = {r.version: k for k, r in enumerate(rules)}
    kinds = F.array(*[F.lit(r.kind) for r in rules])
    place = F.array(*[F.lit(v) for v in current])

    def listed(findings: Column) -> Column:
        valid = F.filter(findings, lambda x: F.array_contains(place, x["version"]))
        ranked = F.transform(valid, lambda x: F.struct(x["start"].alias("start"), (F.array_position(place, x["version"]) - 1).cast("int").alias("rank"), x["end"].alias("end")))
        # Pairs scanned twice: equal neighbours. (array_distinct compares structs all with all.)
        once = let(F.sort_array(ranked), lambda all_: F.filter(all_, lambda x, k: (k == 0) | (x != F.get(all_, k - 1))))
        return F.transform(once, lambda x: F.struct(F.get(kinds, x["rank"]).alias("kind"), x["start"].alias("start"), x["end"].alias("end")))

    some = known.where(F.size("findings") > 0).groupBy("blob_id").agg(F.flatten(F.collect_list("findings")).alias("findings"))
    # Written, so that the join shuffles both sides and can split a blob that a third of all paths have.
    by_blob = stored(some.select("blob_id", listed(F.col("findings")).alias("spans")), "secret-findings")
    content = F.coalesce(F.col(content_column).cast("string"), F.lit(""))
    paths = versions.select(*id_columns, blob_id(content).alias("blob_id"))
    joined = paths.join(by_blob, "blob_id", "left")
    empty = F.array().cast("array<struct<kind:string,start:int,end:int>>")
    return joined.select(*id_columns, "blob_id", F.coalesce("spans", empty).alias("spans")), path


def span_text(found: Column) -> Column:
    return F.concat_ws(",", F.transform(found, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))))


def secret_digest(findings: DataFrame) -> DataFrame:
    """The contract's columns from ``scan_versions``' findings."""
    base = F.filter("spans", lambda x: x["kind"].isin(*[r.kind for r in BASE_RULES]))
    count = lambda kind: F.size(F.filter("spans", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return findings.select("doc_id", *[count(r.kind) for r in BASE_RULES], F.sha2(span_text(base), 256).alias("base_sha256"), span_text(F.col("spans")).alias("spans"))
