"""Secret scans with an incremental blob ledger.

Every historical version of a file is addressed by its content. The ledger
says which rule versions have seen which blob; only unseen pairs of blob and
rule version are scanned, once however many paths hold the blob, and findings
are joined back to all paths.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from abode.llm.common import col, released, stage

FOUND = "array<struct<start:int,place:int,kind:string,end:int>>"
#: Findings as the ledger keeps them: with the rule version, and without its place, which may change.
LEDGER_FOUND = "array<struct<start:int,rule:string,kind:string,end:int>>"


@dataclass(frozen=True)
class Rule:
    """A kind of secret. ``worth`` tells from a text whether the pattern can match at all."""

    kind: str
    version: int
    pattern: re.Pattern
    least: int
    group: int = 0
    worth: Callable[[str], bool] = lambda text: True

    @property
    def key(self) -> str:
        return f"{self.kind}@{self.version}"

    def find(self, text: str) -> Iterator[tuple[int, int]]:
        """Leftmost non-overlapping matches whose group has ``least`` characters or more."""
        if self.worth(text):
            for match in self.pattern.finditer(text):
                if len(match[self.group]) >= self.least:
                    yield match.span()


_HEX = bytes(ord("0") if chr(b) in "0123456789abcdef" else ord(" ") for b in range(256))


def _names_secret(text: str) -> bool:
    low = text.lower()
    return "passw" in low or "secret" in low or "token" in low or "key" in low


def _long_hex(text: str) -> bool:
    return b"0" * 32 in text.encode("utf-8", "surrogatepass").translate(_HEX)


#: The three base kinds (fixed patterns) and the kinds the scan adds.
BASE_RULES = (
    Rule("assign", 1, re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A), 8, 2, _names_secret),
    Rule("access", 1, re.compile(r"AKIA[A-Z0-9]+"), 16, 0, lambda text: "AKIA" in text),
    Rule("hex", 1, re.compile(r"[0-9a-f]{32,}"), 32, 0, _long_hex),
)
ADDED_RULES = (
    Rule("pem", 1, re.compile(r"-----BEGIN (?:[A-Z]+ )*PRIVATE KEY-----"), 1, 0, lambda text: "PRIVATE KEY-----" in text),
    Rule("github", 1, re.compile(r"gh[pousr]_[A-Za-z0-9]{36,}"), 40, 0, lambda text: "gh" in text and "_" in text),
)
RULES = (*BASE_RULES, *ADDED_RULES)


def scan_history(versions: DataFrame, keys: Sequence[str], text_col: str = "text", rules: Sequence[Rule] = RULES,
                 ledger: str | None = None) -> DataFrame:
    """Findings of every row of ``versions``, which has one row for each version of a file.

    Returns the key columns (path, version, or what names a row), ``blob`` (sha-256
    of the text) and ``found``: all spans as start, place of the rule, kind and
    end in code points, ordered by start and then by rule.

    ``ledger`` is the folder of a Parquet ledger: one row per blob and scan with
    the rule versions it was scanned by and what each of them found. A run reads it,
    scans only pairs it doesn't hold, and appends those; findings of rule versions
    that are not in ``rules`` stay in the ledger and are not returned. Without a folder the
    run starts from an empty ledger and keeps none. A run that fails before it
    appends is repeated as a whole.

    Null text: the empty blob. Repeated rows and copies: scanned once, each gets
    the findings. Empty table: no rows.
    """
    spark = versions.sparkSession
    text = F.coalesce(col(text_col), F.lit(""))
    held = versions.select(*[col(k) for k in keys], F.xxhash64(*[col(k) for k in keys]).alias("holder"), F.sha2(text, 256).alias("blob"))
    held = stage(held)
    unseen = held.groupBy("blob").agg(F.min("holder").alias("holder")).withColumn("rule", F.explode(F.array(*[F.lit(r.key) for r in rules])))
    known = _ledger(spark, ledger)
    if known is not None:
        unseen = unseen.join(known.select("blob", F.explode("rules").alias("rule")).distinct(), ["blob", "rule"], "left_anti")
    todo = unseen.groupBy("blob", "holder").agg(F.collect_list("rule").alias("rules"))
    texts = versions.select(F.xxhash64(*[col(k) for k in keys]).alias("holder"), F.sha2(text, 256).alias("blob"), text.alias("text"))
    scanned = texts.join(todo, ["holder", "blob"]).select("blob", "rules", "text")
    by_key = {rule.key: rule for rule in rules}

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("start", pa.int32()), ("rule", pa.string()), ("kind", pa.string()), ("end", pa.int32())]))
        for batch in batches:
            found = []
            for wanted, text in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                spans = [(start, rule.key, rule.kind, end) for rule in map(by_key.get, wanted) for start, end in rule.find(text)]
                found.append([dict(zip(("start", "rule", "kind", "end"), s)) for s in sorted(spans)])
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found, kind)], names=["blob", "rules", "found"])

    entries = scanned.mapInArrow(released(scan), f"blob string, rules array<string>, found {LEDGER_FOUND}")
    if ledger is not None:
        entries.write.mode("append").parquet(ledger)
        entries = _ledger(spark, ledger)
    current = F.array(*[F.lit(r.key) for r in rules])
    valid = F.transform(F.filter("found", lambda s: F.array_contains(current, s["rule"])), lambda s: F.struct(
        s["start"].alias("start"), (F.array_position(current, s["rule"]) - 1).cast("int").alias("place"), s["kind"].alias("kind"), s["end"].alias("end")))
    spans = (entries.filter(F.size("found") > 0).select("blob", valid.alias("found")).filter(F.size("found") > 0)
             .groupBy("blob").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("found")))).alias("found")))
    return (held.join(spans, "blob", "left")
            .select(*[col(k) for k in keys], "blob", F.coalesce("found", F.array().cast(FOUND)).alias("found")))


def _ledger(spark, folder: str | None) -> DataFrame | None:
    """The ledger, or None where no folder is named or nothing was written yet."""
    if folder is None:
        return None
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    return spark.read.parquet(folder) if files.exists(path) else None
