r"""Secret scans over an incremental blob ledger, on DataFrame functions alone.

Every version of every path is addressed by the SHA-256 of its content. The ledger holds
one row for each pair of a blob and a rule version already scanned, with what it found; a run scans only the pairs the ledger lacks, each blob once however many paths hold
it, appends them, and joins the ledger's findings back to all paths. A rule's version is a
digest of its definition, so an edited rule is scanned anew and the others are not. Pairs
that stand in the ledger twice (a run repeated, two runs at once) count once.

Skew: a blob that a third of all paths hold is combined on the map side, so each task
sends it once and it is scanned once; the way back to the paths is dealt over as many salts
as the blob's share of all paths asks for, so no task gets all paths of a blob.

Three base kinds always stay: assign (group 2 of 8 characters or more), access (16 or
more) and hex (32 or more). The method adds key headers, tokens with a fixed prefix and
signed web tokens.

Defined cases: null texts count as empty and hold no findings; paths may be null or
repeated and give one row each; an empty table gives an empty result; an absent ledger
is an empty one.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.llm.common import discard, give_back, materialise, regex_spans, scratch_path, table, whole_text
from gridloom.llm.pii import sql_spans


@dataclass(frozen=True)
class Rule:
    name: str
    pattern: str
    least: int = 0
    value_pattern: str = ""
    hint: str = ""

    @property
    def version(self) -> str:
        return hashlib.sha256(repr((self.name, self.pattern, self.least, self.value_pattern)).encode()).hexdigest()[:16]


_WORDS = "password|passwd|secret|token|api_?key"
_BEGIN, _END = (rf"-----{word} (?:[A-Z]{{1,16}} ){{0,3}}PRIVATE KEY-----" for word in ("BEGIN", "END"))
# Patterns. A private key runs to its END line, or without one to the end of its lines.
RULES = (
    Rule("assign", rf"(?i:{_WORDS})[\"']?\x20*+[:=]\x20*+[\"']?[A-Za-z0-9+/_.=-]++", 8, rf"^(?i:{_WORDS})[\"']?\x20*+[:=]\x20*+[\"']?", rf"(?i:{_WORDS})"),
    Rule("access", r"AKIA[A-Z0-9]++", 16, "", "AKIA"),
    Rule("hex", r"(?:(?<![0-9a-f])|\G)[0-9a-f]++", 32, "", "[0-9a-f]{32}"),
    Rule("private_key", rf"{_BEGIN}(?:[^-]*+(?:-[^-]++)*+{_END}|[A-Za-z0-9+/=\s]*+)", 0, "", "-----BEGIN"),
    Rule("prefixed", r"(?<![A-Za-z0-9_])(?:gh[pousr]_[A-Za-z0-9]{36}|xox[abprs]-[A-Za-z0-9-]{10,}+|sk_live_[A-Za-z0-9]{16,}+)", 0, "", "gh[pousr]_|xox[abprs]-|sk_live_"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}+\.eyJ[A-Za-z0-9_-]{8,}+\.[A-Za-z0-9_-]{8,}+", 0, "", "eyJ"),
)
BASE = ("assign", "access", "hex")
FINDINGS = "array<struct<start:int,end:int,kind:string,rank:int>>"
LEDGER = f"blob binary, rule_version string, findings {FINDINGS}"


def pair(rule: Rule) -> str:
    """A rule's name in the ledger."""
    return f"{rule.name}:{rule.version}"


def scan_rule(text: Column, rule: Rule, rank: int) -> Column:
    """The findings of one rule in order of their starts; a match that is too short is dropped and not tried again."""
    found = regex_spans(text, rule.pattern, text.rlike(rule.hint) if rule.hint else None)
    value = (lambda m: F.regexp_replace(m, rule.value_pattern, "")) if rule.value_pattern else (lambda m: m)
    kept = F.filter(found, lambda s: F.length(value(s["match"])) >= rule.least) if rule.least else found
    return F.transform(kept, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), F.lit(rule.name).alias("kind"), F.lit(rank).alias("rank"))).cast(FINDINGS)


def address(versions: DataFrame, path_col: str, text_col: str) -> DataFrame:
    """versions with each text's content address, and a hash that deals out the paths of one blob."""
    text = whole_text(F.col(text_col))
    return versions.withColumn("__sc_text", text).withColumn("__sc_blob", F.unhex(F.sha2(text, 256))).withColumn("__sc_deal", F.xxhash64(F.col(path_col)))


def scan_unseen(addressed: DataFrame, ledger: DataFrame | None = None, rules: Sequence[Rule] = RULES) -> DataFrame:
    """One row for each blob: its paths' number, the pairs that the ledger (none: an empty one) lacks, and what these find."""
    blobs = addressed.groupBy("__sc_blob", "__sc_text").agg(F.count(F.lit(1)).alias("__sc_n"))
    wanted = F.array(*[F.lit(pair(r)) for r in rules])
    if ledger is None:
        blobs = blobs.withColumn("__sc_todo", wanted)
    else:
        seen = ledger.groupBy(F.col("blob").alias("__sc_blob")).agg(F.collect_set("rule_version").alias("__sc_seen"))
        blobs = blobs.join(seen, "__sc_blob", "left").withColumn("__sc_todo", F.array_except(wanted, F.coalesce("__sc_seen", F.array().cast("array<string>")))).drop("__sc_seen")
    text = F.when(F.col("__sc_n") > 0, F.col("__sc_text"))  # ties the scan to the combined row: no filter on findings moves it below
    parts = [F.when(F.array_contains("__sc_todo", pair(r)), scan_rule(text, r, i)).otherwise(F.array().cast(FINDINGS)) for i, r in enumerate(rules)]
    return blobs.withColumn("__sc_found", F.concat(*parts)).drop("__sc_text")


def ledger_rows(scanned: DataFrame) -> DataFrame:
    """What a run adds to the ledger: blob, rule_version and that rule's findings; pairs without findings too."""
    pairs = scanned.select(F.col("__sc_blob").alias("blob"), F.explode("__sc_todo").alias("rule_version"), "__sc_found")
    return pairs.select("blob", "rule_version", F.filter("__sc_found", lambda s: s["kind"] == F.substring_index("rule_version", ":", 1)).alias("findings"))


def read_ledger(spark: SparkSession, ledger_path: str) -> DataFrame:
    """The ledger at a path; an absent one is empty."""
    spark.createDataFrame([], LEDGER).write.mode("append").parquet(ledger_path)
    return spark.read.schema(LEDGER).parquet(ledger_path)


def known(ledger: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """The findings of each blob by the rules as they are now, each once however often the ledger has its pair."""
    rank = F.array_position(F.array(*[F.lit(r.name) for r in rules]), F.col("f.kind")).cast("int") - 1
    some = ledger.filter(F.col("rule_version").isin([pair(r) for r in rules]) & (F.size("findings") > 0)).select("blob", F.explode("findings").alias("f"))
    once = F.collect_set(F.struct(F.col("f.start").alias("start"), F.col("f.end").alias("end"), F.col("f.kind").alias("kind"), rank.alias("rank")))
    return some.groupBy(F.col("blob").alias("__sc_blob")).agg(F.array_sort(once).cast(FINDINGS).alias("__sc_found"))


def to_paths(addressed: DataFrame, found: DataFrame) -> DataFrame:
    """Every row of addressed with the findings of its blob; blobs without findings don't travel. found: blob, its paths' number, findings."""
    some = materialise(found.filter(F.size("__sc_found") > 0).select("__sc_blob", "__sc_n", "__sc_found"), "findings")
    rows = give_back(addressed.drop("__sc_text"), some, ["__sc_blob"], "__sc_n", "__sc_deal").drop("__sc_n", "__sc_deal", "__gb_salt")
    return rows.withColumn("__sc_found", F.coalesce("__sc_found", F.array().cast(FINDINGS)))


def update(versions: DataFrame, ledger_path: str, path_col: str = "path", text_col: str = "text", rules: Sequence[Rule] = RULES) -> DataFrame:
    """Scans what the ledger at ledger_path lacks, appends it there and returns (path, blob, findings) for all versions."""
    spark = versions.sparkSession
    addressed = address(versions, path_col, text_col)
    scanned = materialise(scan_unseen(addressed, read_ledger(spark, ledger_path), rules), "scanned")
    ledger_rows(scanned.filter(F.size("__sc_todo") > 0)).write.mode("append").parquet(ledger_path)
    found = known(spark.read.schema(LEDGER).parquet(ledger_path), rules).join(scanned.select("__sc_blob", "__sc_n"), "__sc_blob")
    rows = to_paths(addressed, found)
    discard(scanned)
    return rows.select(path_col, F.lower(F.hex("__sc_blob")).alias("blob"), F.col("__sc_found").alias("findings"))


def joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def by_start(spans: Column) -> Column:
    return F.array_sort(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["rank"].alias("rank"), s["end"].alias("end"), s["kind"].alias("kind"))))


def count_of(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def op6_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Through a ledger of the run's own in the shared folder, which starts empty."""
    rows = update(table(spark, sf_dir, "documents").select("doc_id", "text"), scratch_path(spark, "ledger"), "doc_id")
    s = F.col("findings")
    return rows.select(
        "doc_id",
        *[count_of(s, k).alias(f"n_{k}") for k in BASE],
        F.sha2(joined(by_start(F.filter(s, lambda x: x["rank"] < len(BASE)))), 256).alias("base_sha256"),
        joined(by_start(s)).alias("spans"),
        "blob",
    )


# The same in SQL, with the plain patterns. A ledger that starts empty changes nothing in a result. Case is spelt out: folding would take in letters beyond ASCII.
_EITHER = "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in _WORDS)
_PLAIN = {
    "assign": rf"(?:{_EITHER})[\"'']?\x20*[:=]\x20*[\"'']?[A-Za-z0-9+/_.=-]+", "access": "AKIA[A-Z0-9]+", "hex": "[0-9a-f]+", "private_key": rf"{_BEGIN}(?:[^-]*(?:-[^-]+)*{_END}|[A-Za-z0-9+/=\s]*)",
    "prefixed": r"\b(?:gh[pousr]_[A-Za-z0-9]{36}|xox[abprs]-[A-Za-z0-9-]{10,}|sk_live_[A-Za-z0-9]{16,})", "jwt": r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}",
}


def _oracle() -> str:
    parts = []
    for rank, r in enumerate(RULES):
        value = rf"regexp_replace(x, '^(?:{_EITHER})[\"'']?\x20*[:=]\x20*[\"'']?', '')" if r.name == "assign" else "x"
        parts.append(f"SELECT rn, {rank} AS rank, '{r.name}' AS kind, start, stop FROM ({sql_spans(r.name, _PLAIN[r.name], 'd')}) WHERE length({value}) >= {r.least}")
    spell = "string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, rank)"
    return f"""WITH d AS (SELECT row_number() OVER () AS rn, doc_id, coalesce(text, '') AS t FROM documents), s AS ({' UNION ALL '.join(parts)}),
        a AS (SELECT rn, {', '.join(f"count(*) FILTER (kind = '{k}') AS n_{k}" for k in BASE)}, {spell} FILTER (rank < {len(BASE)}) AS base, {spell} AS spans FROM s GROUP BY rn)
        SELECT doc_id, {', '.join(f"coalesce(n_{k}, 0) AS n_{k}" for k in BASE)}, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans, sha256(t) AS blob FROM d LEFT JOIN a USING (rn)"""


ORACLE = _oracle()
