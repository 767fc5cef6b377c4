"""Secret scans over an incremental blob ledger, with DataFrame functions alone.

Every version of every path is a blob, addressed by the SHA-256 of its content. The ledger holds, for each blob, the
rule versions that have scanned it and their spans. A scan takes each distinct blob once, runs only the rules whose
version the ledger hasn't for it, and joins findings back to all paths that hold the blob.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larkspan.llm.common import scratch, whole_text

LEDGER = "blob binary, scans map<string, array<struct<start: int, end: int>>>"


def either(word: str) -> str:
    """A pattern for an ASCII word in either case, letter by letter: engines differ in what else ignoring case lets in."""
    return "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in word)



@dataclass(frozen=True)
class Rule:
    """A regular expression's matches, leftmost and non-overlapping; those whose group is shorter than `least` are dropped.

    Every match holds one of the strings in `holds`, if there are any: a byte search then spares most texts the pattern.
    """

    kind: str
    pattern: str
    version: int = 1
    group: int = 0
    least: int = 0
    holds: tuple[str, ...] = ()

    @property
    def key(self) -> str:
        return f"{self.kind}@{self.version}"


# The contract's kinds, in its order.
BASE_RULES = (
    Rule("assign", f"({'|'.join(map(either, ('password', 'passwd', 'secret', 'token', 'api_?key')))})" + r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", group=2, least=6, holds=(":", "=")),
    Rule("access", r"AKIA[A-Z0-9]+", least=20, holds=("AKIA",)),
    Rule("hex", r"[0-9a-f]{24,}"),
)
#: What the scan finds beyond these.
MORE_RULES = (
    Rule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----", holds=("-----BEGIN ",)),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", holds=("eyJ",)),
    Rule("forge", r"gh[oprsu]_[A-Za-z0-9]{36,}", holds=("gh",)),
    Rule("chat", r"xox[abeprs]-[A-Za-z0-9-]{10,}", holds=("xox",)),
)
RULES = BASE_RULES + MORE_RULES


def spans(text: Column, rule: Rule) -> Column:
    """Spans of a rule in code points, end exclusive. The pieces between the matches tell where each begins."""
    pattern = F.lit(rule.pattern)
    hits = F.regexp_extract_all(text, pattern, F.lit(0))
    kept = F.transform(F.regexp_extract_all(text, pattern, F.lit(rule.group)), lambda g: F.length(g) >= rule.least)
    lens = F.transform(F.arrays_zip(F.split(text, rule.pattern, -1).alias("piece"), hits.alias("hit"), kept.alias("kept")), lambda x: F.struct(F.length(x["piece"]).alias("gap"), F.length(x["hit"]).alias("own"), x["kept"].alias("kept")))
    none = F.array().cast("array<struct<start: int, end: int>>")

    def step(acc: Column, x: Column) -> Column:
        start = acc["at"] + x["gap"]
        end = start + F.coalesce(x["own"], F.lit(0))
        span = F.array(F.struct(start.alias("start"), end.alias("end")))
        return F.struct(end.alias("at"), F.when(F.coalesce(x["kept"], F.lit(False)), F.concat(acc["spans"], span)).otherwise(acc["spans"]).alias("spans"))

    found = F.aggregate(lens, F.struct(F.lit(0).alias("at"), none.alias("spans")), step, lambda acc: acc["spans"])
    may = text.rlike(rule.pattern)
    if rule.holds:
        may = reduce(Column.__or__, (F.contains(text, F.lit(h)) for h in rule.holds)) & may
    return F.when(may, found).otherwise(none)


def address(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


def scan(versions: DataFrame, ledger: DataFrame | None = None, rules: tuple[Rule, ...] = RULES, text: str = "text") -> DataFrame:
    """The ledger's new rows: for each distinct blob of `versions` with rules it hasn't seen, the spans of those rules.

    A null text is the empty blob. An empty table gives no row.
    """
    blobs = versions.select(whole_text(text).alias("text")).select(address(F.col("text")).alias("blob"), "text").groupBy("blob").agg(F.first("text").alias("text"))
    if ledger is None:
        seen = F.array().cast("array<string>")
    else:
        known = ledger.groupBy("blob").agg(F.array_distinct(F.flatten(F.collect_list(F.map_keys("scans")))).alias("seen"))
        blobs = blobs.join(known, "blob", "left")
        seen = F.coalesce(F.col("seen"), F.array().cast("array<string>"))
        blobs = blobs.where(F.size(F.array_except(F.array(*(F.lit(r.key) for r in rules)), seen)) > 0)
    new = F.array(*(F.struct(F.lit(r.key).alias("key"), F.when(~F.array_contains(seen, r.key) if ledger is not None else F.lit(True), spans(F.col("text"), r)).alias("value")) for r in rules))
    return blobs.select("blob", F.map_from_entries(F.filter(new, lambda x: x["value"].isNotNull())).alias("scans"))


def merged(ledger: DataFrame) -> DataFrame:
    """A row for each blob, with the spans of all rule versions."""
    entries = F.array_distinct(F.flatten(F.collect_list(F.map_entries("scans"))))
    return ledger.groupBy("blob").agg(F.map_from_entries(entries).alias("scans"))


def update_ledger(versions: DataFrame, path: str, rules: tuple[Rule, ...] = RULES, text: str = "text") -> DataFrame:
    """Scans what the ledger stored at `path` hasn't, adds that to it, and returns the ledger. A path without files is an empty ledger."""
    spark = versions.sparkSession
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    there = place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)
    scan(versions, spark.read.schema(LEDGER).parquet(path) if there else None, rules, text).write.mode("append").parquet(path)
    return spark.read.schema(LEDGER).parquet(path)


def findings(versions: DataFrame, path: str, ledger: DataFrame, rules: tuple[Rule, ...] = RULES, text: str = "text") -> DataFrame:
    """One row for each row of `versions`: the path and its array of struct(start, rank, kind, end), by start and then by rule order."""
    def tagged(i: int, rule: Rule) -> Column:
        own = F.coalesce(F.element_at("scans", rule.key), F.array().cast("array<struct<start: int, end: int>>"))
        return F.transform(own, lambda s: F.struct(s["start"].alias("start"), F.lit(i).alias("rank"), F.lit(rule.kind).alias("kind"), s["end"].alias("end")))

    parts = [tagged(i, r) for i, r in enumerate(rules)]
    found = merged(ledger).select("blob", F.array_sort(F.flatten(F.array(*parts))).alias("found")).where(F.size("found") > 0)
    paths = versions.select(F.col(path).alias("path"), address(whole_text(text)).alias("blob"))
    none = F.array().cast("array<struct<start: int, rank: int, kind: string, end: int>>")
    return paths.join(found, "blob", "left").select("path", F.coalesce("found", none).alias("found"))


def written(found: Column) -> Column:
    return F.array_join(F.transform(found, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")


def scan_documents(docs: DataFrame, ledger: str | None = None) -> DataFrame:
    """One row per row of `docs`: doc_id, n_assign, n_access, n_hex, base_sha256, spans. Repeated texts are scanned once.

    ledger: a path where the ledger is kept from scan to scan; a new one in the shared folder if none is given. Null and
    empty texts have no spans; texts of any length are scanned whole. Repeated rows give repeated results, an empty table
    an empty one; other columns are ignored, whatever their names.
    """
    # the ledger is a table of its own: a join from tables is one whose hot blobs adaptive execution can split
    rows = findings(docs, "doc_id", update_ledger(docs, ledger or scratch(docs.sparkSession, "ledger")))
    base = F.filter("found", lambda x: x["rank"] < len(BASE_RULES))

    def count(rule: Rule) -> Column:
        return F.size(F.filter("found", lambda x: x["kind"] == rule.kind)).cast("bigint").alias(f"n_{rule.kind}")

    return rows.select(F.col("path").alias("doc_id"), *map(count, BASE_RULES), F.sha2(written(base), 256).alias("base_sha256"), written(F.col("found")).alias("spans"))


def _oracle_spans(rule: Rule) -> str:
    pattern = rule.pattern.replace("'", "''")
    return f"""list_filter(list_transform(range(1, len(regexp_extract_all(text, '{pattern}')) + 1), lambda i: {{
        's': list_sum(list_transform(string_split_regex(text, '{pattern}')[1:i], lambda p: length(p))) + coalesce(list_sum(list_transform(regexp_extract_all(text, '{pattern}')[1:i - 1], lambda p: length(p))), 0),
        'n': length(regexp_extract_all(text, '{pattern}')[i]), 'g': length(regexp_extract_all(text, '{pattern}', {rule.group})[i])}}), lambda x: x.g >= {rule.least})"""


def oracle() -> str:
    cols = ",\n".join(f"{_oracle_spans(r)} AS s_{r.kind}" for r in RULES)
    tagged = " || ".join(f"list_transform(s_{r.kind}, lambda x: {{'s': x.s::BIGINT, 'r': {i}, 'k': '{r.kind}', 'e': (x.s + x.n)::BIGINT}})" for i, r in enumerate(RULES))
    counts = ", ".join(f"len(s_{r.kind})::BIGINT AS n_{r.kind}" for r in BASE_RULES)
    show = "coalesce(array_to_string(list_transform({}, lambda x: x.k || ':' || x.s || ':' || x.e), ','), '')"
    return f"""WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
s AS (SELECT doc_id, {cols} FROM d),
t AS (SELECT doc_id, {counts}, list_sort({tagged}) AS f FROM s)
SELECT doc_id, {", ".join(f"n_{r.kind}" for r in BASE_RULES)}, sha256({show.format(f"list_filter(f, lambda x: x.r < {len(BASE_RULES)})")}) AS base_sha256, {show.format("f")} AS spans FROM t"""
