"""Secret scans with an incremental ledger of blobs, native expressions only.

Every version of every path is addressed by the SHA-256 of its text (its *blob*). The ledger, a Parquet folder, has one
row for each increment and blob: the (rule, rule version) pairs that were scanned then, and the spans they found. An
increment takes the distinct blobs of its input, looks up which pairs the ledger already has for them, scans only those
that are missing, and appends a row; a new version of a rule is a new pair, all others stay as they are. Findings are
joined back to all paths by blob, with the spans of each rule's current version.

Equal texts meet by a combined aggregate, so a blob that a third of all paths has is one row from the start, and is
scanned once; the join back is a plain one on the blob, which adaptive execution splits. An increment that failed has
left nothing in the ledger; one that runs again finds its pairs there and adds nothing. Two increments at once may
scan a blob twice, which changes no result.

Spans count code points, end exclusive; per rule they are leftmost and do not overlap. Null texts count as empty and
have no spans. Null paths are paths; repeated rows are repeated in the result. Spans are in the order of their start,
then of the rules. Other columns are kept by ``paths``; result columns replace columns of the same names.
"""

from __future__ import annotations

import uuid
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pitpanel.llm.common import shared_folder


class Rule(NamedTuple):
    """A kind of secret: matches of ``pattern`` (any letter case if ``fold``) whose group ``group`` has ``least`` characters.

    Raise ``version`` with any other change. ``hints``: texts without any of them, A-Z as a-z, have no match."""

    kind: str
    version: int
    pattern: str
    group: int = 0
    least: int = 1
    fold: bool = False
    hints: tuple[str, ...] = ()


#: The three base kinds come first and in this order; then tokens whose issuers gave them a form of their own.
RULES = (
    Rule("assign", 1, r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6, True),
    Rule("access", 1, r"AKIA[A-Z0-9]+", 0, 20, hints=("AKIA",)),
    Rule("hex", 1, r"[0-9a-f]{24,}", 0, 24),
    Rule("private_key", 1, r"-----BEGIN [A-Z ]{0,20}PRIVATE KEY-----", hints=("PRIVATE KEY",)),
    Rule("forge_token", 1, r"(ghp|gho|ghu|ghs|ghr|glpat|github_pat)[_-][A-Za-z0-9_-]{20,}", hints=("gh", "gl", "github")),
    Rule("chat_token", 1, r"xox[abeoprs]-[A-Za-z0-9-]{10,}", hints=("xox",)),
    Rule("payment_key", 1, r"[rsp]k_(live|test)_[A-Za-z0-9]{16,}", hints=("_live_", "_test_")),
    Rule("web_token", 1, r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", hints=("eyJ",)),
    Rule("url_login", 1, r"://[^\x00-\x20/:@]{1,64}:[^\x00-\x20/:@]{1,128}@", hints=("://",)),
    Rule("cloud_key", 1, r"AIza[A-Za-z0-9_-]{35}", hints=("AIza",)),
)
BASE_KINDS = ("assign", "access", "hex")
_SPAN = "struct<start:int,rank:int,kind:string,stop:int>"
#: Hits whose places are summed up at once; the sums of such runs are summed in turn.
RUN = 256


def folded(pattern: str) -> str:
    """The pattern for ASCII letters in either case: each letter outside classes and escapes becomes a class of two."""
    out, at, inside = [], 0, False
    while at < len(pattern):
        char = pattern[at]
        if char == "\\":
            size = 4 if pattern[at + 1] == "x" else 2
            out.append(pattern[at : at + size])
            at += size
            continue
        inside = char == "[" or (inside and char != "]")
        out.append(f"[{char.upper()}{char.lower()}]" if not inside and char.isalpha() and char.isascii() else char)
        at += 1
    return "".join(out)


def pattern(rule: Rule) -> str:
    return folded(rule.pattern) if rule.fold else rule.pattern


def pairs(rules=RULES) -> list[str]:
    return [f"{r.kind}@{r.version}" for r in rules]


def _running(sizes: Column, fields) -> Column:
    """For array<struct<gap,hit,..>> the flat array of ``fields(start, element)``; start is the sum of all before, plus the gap.

    Sums go by runs of RUN elements, so that growing an array inside a fold stays cheap on texts with very many hits."""
    runs = F.transform(F.sequence(F.lit(0), F.floor((F.size(sizes) - 1) / RUN).cast("int")), lambda k: F.slice(sizes, k * RUN + 1, RUN))
    length = lambda run: F.aggregate(run, F.lit(0), lambda acc, x: acc + x["gap"] + x["hit"])
    begins = F.aggregate(
        runs, F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("out")),
        lambda acc, run: F.struct((acc["at"] + length(run)).alias("at"), F.concat(acc["out"], F.array(acc["at"])).alias("out")))["out"]

    def placed(run, begin):
        start = F.struct(begin.alias("at"), F.array().cast(f"array<{_SPAN}>").alias("out"))
        return F.aggregate(run, start, lambda acc, x: F.struct(
            (acc["at"] + x["gap"] + x["hit"]).alias("at"), F.concat(acc["out"], F.array(fields(acc["at"] + x["gap"], x))).alias("out")))["out"]

    return F.flatten(F.zip_with(runs, begins, placed))


def spans(text: Column, rule: Rule, rank: int) -> Column:
    """Array of (start, rank, kind, stop) of the rule's matches."""
    regex, nothing = F.lit(pattern(rule)), F.array().cast(f"array<{_SPAN}>")
    lengths = lambda group: F.transform(F.regexp_extract_all(text, regex, F.lit(group)), F.length)
    gaps = F.transform(F.split(text, pattern(rule), -1), F.length)
    hits = F.filter(F.arrays_zip(gaps.alias("gap"), lengths(0).alias("hit"), lengths(rule.group).alias("kept")), lambda x: x["hit"].isNotNull())
    found = _running(hits, lambda start, x: F.struct(
        start.alias("start"), F.lit(rank).alias("rank"),
        F.when(x["kept"] >= rule.least, rule.kind).alias("kind"), (start + x["hit"]).alias("stop")))
    gate = text.rlike(pattern(rule))
    if rule.hints:
        hinted = F.lit(False)
        for hint in rule.hints:
            hinted = hinted | text.contains(hint)
        gate = hinted & gate
    return F.when(gate, F.filter(found, lambda s: s["kind"].isNotNull())).otherwise(nothing)


def _versioned(version: int):
    return lambda s: F.struct(s["kind"].alias("kind"), F.lit(version).alias("version"), s["start"].alias("start"), s["stop"].alias("stop"))


def blob(text: Column) -> Column:
    return F.sha2(F.coalesce(text, F.lit("")), 256)


class Ledger:
    """The Parquet folder ``folder``; its increments are subfolders that appear whole or not at all."""

    def __init__(self, spark: SparkSession, folder: str | None = None) -> None:
        self.spark = spark
        self.folder = (folder or shared_folder(spark, "secrets")).rstrip("/")

    def rows(self) -> DataFrame | None:
        """blob, scanned (array of pairs), spans (array of kind, version, start, stop), increment; None before the first."""
        context = self.spark.sparkContext
        path = context._jvm.org.apache.hadoop.fs.Path(self.folder)
        files = path.getFileSystem(context._jsc.hadoopConfiguration())
        if not files.exists(path):
            return None
        done = [str(f.getPath()) for f in files.listStatus(path) if files.exists(f.getPath().suffix("/_SUCCESS"))]
        return self.spark.read.option("basePath", self.folder).parquet(*done) if done else None

    def scan(self, docs: DataFrame, text: str = "text", rules=RULES) -> None:
        """Scan the blobs of ``docs`` for the pairs that the ledger lacks."""
        body = F.coalesce(F.col(text), F.lit(""))
        blobs = docs.select(blob(F.col(text)).alias("blob"), body.alias("body")).groupBy("blob").agg(F.first("body").alias("body"))
        wanted = F.array(*[F.lit(p) for p in pairs(rules)])
        known = self.rows()
        if known is None:
            todo = blobs.withColumn("todo", wanted)
        else:
            seen = known.groupBy("blob").agg(F.array_distinct(F.flatten(F.collect_list("scanned"))).alias("seen"))
            todo = blobs.join(seen, "blob", "left").withColumn("todo", F.array_except(wanted, F.coalesce("seen", F.array().cast("array<string>"))))
            todo = todo.where(F.size("todo") > 0)
        found = [
            F.transform(
                F.when(F.array_contains("todo", name), spans(F.col("body"), rule, rank)).otherwise(F.array().cast(f"array<{_SPAN}>")),
                _versioned(rule.version))
            for rank, (rule, name) in enumerate(zip(rules, pairs(rules)))
        ]
        todo.select("blob", F.col("todo").alias("scanned"), F.concat(*found).alias("spans")).write.parquet(f"{self.folder}/increment={uuid.uuid4().hex}")

    def findings(self, rules=RULES) -> DataFrame:
        """(blob, secrets) of all blobs with findings of the given rules: array of (start, rank, kind, stop), sorted."""
        rank = F.create_map(*[F.lit(x) for k, name in enumerate(pairs(rules)) for x in (name, k)])
        known = self.rows()
        if known is None:
            raise ValueError(f"nothing was scanned yet into {self.folder}")
        current = known.select("blob", F.transform("spans", lambda s: F.struct(
            s["start"].alias("start"), rank[F.concat(s["kind"], F.lit("@"), s["version"].cast("string"))].alias("rank"), s["kind"].alias("kind"), s["stop"].alias("stop"))).alias("spans"))
        current = current.select("blob", F.filter("spans", lambda s: s["rank"].isNotNull()).alias("spans")).where(F.size("spans") > 0)
        return current.groupBy("blob").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("spans")))).alias("secrets"))

    def paths(self, docs: DataFrame, text: str = "text", rules=RULES) -> DataFrame:
        """``docs`` plus ``blob`` and ``secrets`` (array of start, rank, kind, stop; empty if none)."""
        own = [c for c in docs.columns if c not in ("blob", "secrets")]
        named = docs.select(*[F.col(f"`{c}`") for c in own], blob(F.col(text)).alias("blob"))
        both = named.join(self.findings(rules), "blob", "left")
        return both.select(*[F.col(f"`{c}`") for c in own], "blob", F.coalesce("secrets", F.array().cast(f"array<{_SPAN}>")).alias("secrets"))


def digest(found: DataFrame, identifier: str = "doc_id") -> DataFrame:
    """One row of figures for each row of ``paths``."""
    secrets = F.col("secrets")
    base = F.filter(secrets, lambda s: s["kind"].isin(*BASE_KINDS))
    count = lambda kind: F.size(F.filter(secrets, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    joined = lambda of: F.array_join(F.transform(of, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["stop"].cast("string"))), ",")
    return found.select(identifier, *[count(kind) for kind in BASE_KINDS], F.sha2(joined(base), 256).alias("base_sha256"), joined(secrets).alias("spans"))
