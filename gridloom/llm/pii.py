r"""Personal data: expressions propose spans, checksums confirm them, nearby words adjust the score.

Everything is row-local and built from SQL functions: the plan is one scan and one
projection, so no key can be hot and nothing is shuffled.

Four base kinds always stay once their check passes: email, ip (parts at most 255), card
(16 to 19 digits passing Luhn) and phone (8 to 15 digits). The method adds iban (its
country's length and mod-97, at every start, whatever follows it) and ssn (number ranges); an added span needs a score of ``threshold``. Scores start from
the kind, gain from a checksum and from context words of the kind within 48 characters,
and lose from words that name something else (order numbers, versions).

Patterns equal the plain ones but are written so that the engine never retries inside a
run it has already rejected: a run may start at its first character, or right behind the
match before it (``\G``).

Defined cases: null texts count as empty, and give no spans; ids may be null or repeated;
extra columns pass through.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.llm.common import SPAN, let, regex_spans, running, running_total, table, whole_text

THRESHOLD = 0.5
BASE = ("email", "ip", "card", "phone")


@dataclass(frozen=True)
class Kind:
    name: str
    pattern: str
    prior: float
    checksum: float
    context: str


# Characters of an IBAN by country, from the registry.
IBAN_LENGTHS = {
    "AD": 24, "AE": 23, "AL": 28, "AT": 20, "AZ": 28, "BA": 20, "BE": 16, "BG": 22, "BH": 22, "BI": 27, "BR": 29, "BY": 28, "CH": 21, "CR": 22, "CY": 28, "CZ": 24, "DE": 22, "DJ": 27,
    "DK": 18, "DO": 28, "EE": 20, "EG": 29, "ES": 24, "FI": 18, "FK": 18, "FO": 18, "FR": 27, "GB": 22, "GE": 22, "GI": 23, "GL": 18, "GR": 27, "GT": 28, "HN": 28, "HR": 21, "HU": 28,
    "IE": 22, "IL": 23, "IQ": 23, "IS": 26, "IT": 27, "JO": 30, "KW": 30, "KZ": 20, "LB": 28, "LC": 32, "LI": 21, "LT": 20, "LU": 20, "LV": 21, "LY": 25, "MC": 27, "MD": 24, "ME": 22,
    "MK": 19, "MN": 20, "MR": 27, "MT": 31, "MU": 30, "NI": 28, "NL": 18, "NO": 15, "OM": 23, "PK": 24, "PL": 28, "PS": 29, "PT": 25, "QA": 29, "RO": 24, "RS": 22, "RU": 33, "SA": 24,
    "SC": 31, "SD": 18, "SE": 24, "SI": 19, "SK": 24, "SM": 27, "SO": 23, "ST": 25, "SV": 28, "TL": 23, "TN": 24, "TR": 26, "UA": 29, "VA": 22, "VG": 24, "XK": 20, "YE": 30,
}
_BY_LENGTH = "|".join(f"(?:{'|'.join(c for c, m in IBAN_LENGTHS.items() if m == n)})[0-9]{{2}}(?:\\x20?[A-Z0-9]){{{n - 4}}}" for n in sorted(set(IBAN_LENGTHS.values())))
# Takes one character and looks ahead to the rest, so that no rejected candidate hides another.
WHOLE_IBAN = rf"(?<![A-Za-z0-9_])(?=({_BY_LENGTH})(?![A-Za-z0-9_]))[A-Z]"

# Patterns and context words.
KINDS = (
    Kind("email", r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", 0.8, 0.0, "e-?mail|mail|contact|write|reach"),
    Kind("ip", r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", 0.5, 0.2, "ip|host|server|address|addr|client|login"),
    Kind("card", r"[0-9](?:[\x20-]?[0-9])++", 0.3, 0.4, "card|visa|credit|debit|mastercard|amex|pay|payment"),
    Kind("phone", r"\+[0-9][\x20().0-9-]+[0-9]", 0.5, 0.0, "call|phone|tel|telephone|mobile|fax|cell|whatsapp"),
    Kind("iban", WHOLE_IBAN, 0.3, 0.5, "iban|account|bank|transfer|konto|compte|cuenta"),
    Kind("ssn", r"(?<![A-Za-z0-9_])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![A-Za-z0-9_])", 0.4, 0.1, "ssn|social security|social|taxpayer"),
)
AGAINST = "order|invoice|version|build|isbn|part|serial|ticket"
SPANS = "array<struct<kind:string,start:int,end:int,score:double,rank:int>>"


def digits_of(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """From the right every second digit doubles; the sum must be a multiple of ten."""
    steps = F.transform(F.split(F.reverse(digits), ""), lambda d, i: let(d.cast("int") * (1 + i % 2), lambda v: F.when(v > 9, v - 9).otherwise(v)))
    return F.aggregate(steps, F.lit(0), lambda a, v: a + F.coalesce(v, F.lit(0))) % 10 == 0


def mod97(match: Column) -> Column:
    """The first four characters move to the end, letters count from 10; the remainder by 97 must be 1."""
    compact = F.replace(match, F.lit(" "), F.lit(""))
    values = F.transform(F.split(F.concat(F.substr(compact, F.lit(5)), F.left(compact, F.lit(4))), ""), lambda c: F.when(c.rlike("[A-Z]"), F.ascii(c) - 55).otherwise(F.ascii(c) - 48))
    return F.aggregate(values, F.lit(0), lambda a, v: F.when(v > 9, a * 100 + v).otherwise(a * 10 + v) % 97) == 1


def confirmed(kind: str, match: Column) -> Column:
    """The validator of a kind; each looks at the length first, so the digits of a long run are never walked."""
    if kind == "ip":
        return F.forall(F.split(match, r"\."), lambda p: (F.length(F.ltrim(p, F.lit("0"))) <= 3) & (F.right(F.concat(F.lit("000"), p), F.lit(3)).cast("int") <= 255))
    if kind == "card":
        return let(digits_of(match), lambda d: F.when(F.length(d).between(16, 19), luhn(d)).otherwise(False))
    if kind == "phone":
        return F.length(digits_of(match)).between(8, 15)
    if kind == "iban":
        return mod97(match)
    if kind == "ssn":
        return ~match.rlike(r"^(000|666|9..)") & ~match.rlike(r"^...-00-") & ~match.rlike(r"0000$")
    return F.lit(True)


def whole_word(words: str) -> str:
    return f"(^|[^a-z])({words})([^a-z]|$)"


def score(kind: Kind, span: Column) -> Column:
    near = F.lower(F.concat_ws(" ", span["before"], span["after"]))
    raw = F.lit(kind.prior + kind.checksum) + F.when(near.rlike(whole_word(kind.context)), 0.2).otherwise(0.0) - F.when(near.rlike(whole_word(AGAINST)), 0.15).otherwise(0.0)
    return F.round(F.least(F.lit(1.0), F.greatest(F.lit(0.0), raw)), 3)


def hint(kind: str, text: Column) -> Column | None:
    """A cheap test that every text with a match passes."""
    return {"email": F.contains(text, F.lit("@")), "phone": F.contains(text, F.lit("+")), "ip": F.contains(text, F.lit(".")) & text.rlike("[0-9]"), "card": text.rlike("[0-9]"), "iban": text.rlike("[A-Z]{2}[0-9]{2}"), "ssn": text.rlike("[0-9]-[0-9]")}.get(kind)


def candidates(text: Column, kind: Kind) -> Column:
    """What a kind's pattern proposes, with the text on both sides up to the next proposal."""
    return whole_ibans(text) if kind.name == "iban" else regex_spans(text, kind.pattern, hint(kind.name, text))


def spans_of(text: Column, kind: Kind, rank: int, threshold: float) -> Column:
    """The confirmed spans of one kind, in order of their starts."""
    found = F.filter(candidates(text, kind), lambda s: confirmed(kind.name, s["match"]))
    if kind.name == "ssn":  # not the middle of a longer number
        found = F.filter(found, lambda s: ~s["before"].endswith("-") & ~s["after"].startswith("-"))
    out = F.transform(found, lambda s: F.struct(F.lit(kind.name).alias("kind"), s["start"].alias("start"), s["end"].alias("end"), score(kind, s).alias("score"), F.lit(rank).alias("rank")))
    return (out if kind.name in BASE else F.filter(out, lambda s: s["score"] >= threshold)).cast(SPANS)


def whole_ibans(text: Column) -> Column:
    """Account numbers of their country's length from every start; the pattern takes one character and looks at the rest."""
    def rows(p: Column) -> Column:
        steps = F.transform(F.slice(p["gaps"], F.lit(1), F.size(p["found"])), lambda g, i: F.length(g) + F.when(i == 0, 0).otherwise(1))
        return let(running_total(steps), lambda starts: F.transform(p["found"], lambda m, i: let(F.element_at(p["gaps"], i + 2), lambda after: F.struct(
            F.element_at(starts, i + 1).alias("start"), (F.element_at(starts, i + 1) + F.length(m)).alias("end"), m.alias("match"),
            F.right(F.element_at(p["gaps"], i + 1), F.lit(48)).alias("before"), F.left(F.substr(after, F.length(m)), F.lit(48)).alias("after")))))

    pair = F.struct(F.split(text, WHOLE_IBAN, -1).alias("gaps"), F.regexp_extract_all(text, F.lit(WHOLE_IBAN), F.lit(1)).alias("found"))
    return F.when(hint("iban", text), let(pair, rows)).otherwise(F.array().cast(SPAN))


def find(docs: DataFrame, text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """docs with __pii_spans: kind, start, end, score of every span, by kind as listed and then by start."""
    text = whole_text(F.col(text_col))
    return docs.withColumn("__pii_spans", F.concat(*[spans_of(text, k, i, threshold) for i, k in enumerate(KINDS)]))


def joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def count_of(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def redact(docs: DataFrame, text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """Every span gives way to its kind in brackets; overlapping spans become one, named by the first.

    A null text stays null. Other columns stay as they are. Work grows with the spans and the text,
    not with their product: the text is taken apart in runs of spans.
    """
    text = F.col(text_col)
    by_start = F.array_sort(F.transform(F.col("__pii_spans"), lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))))

    def merged(spans: Column) -> Column:
        reach = running(F.transform(spans, lambda s: s["end"]), lambda a, x: F.greatest(a, x), F.lit(0))
        return let(reach, lambda ends: let(
            F.array_compact(F.transform(spans, lambda s, i: F.when((i == 0) | (s["start"] >= F.get(ends, i - 1)), i))),
            lambda firsts: F.transform(firsts, lambda at, k: F.struct(F.get(spans, at)["start"].alias("start"), F.get(ends, F.coalesce(F.get(firsts, k + 1), F.size(spans)) - 1).alias("end"), F.get(spans, at)["kind"].alias("kind")))))

    def end_of(spans: Column, i: Column) -> Column:
        return F.when(i < 0, 0).otherwise(F.get(spans, i)["end"])

    def rebuilt(spans: Column) -> Column:
        width = F.greatest(F.lit(64), F.sqrt(F.size(spans)).cast("int"))
        firsts = F.sequence(F.lit(0), F.size(spans) - 1, width)

        def run(first: Column) -> Column:
            own, at = F.slice(spans, first + 1, width), end_of(spans, first - 1)
            return let(F.struct(own.alias("own"), at.alias("at"), F.substr(text, at + 1, F.element_at(own, -1)["end"] - at).alias("text")), lambda r: F.array_join(
                F.transform(r["own"], lambda s, i: let(F.when(i == 0, r["at"]).otherwise(end_of(r["own"], i - 1)), lambda before: F.concat(
                    F.substr(r["text"], before - r["at"] + 1, s["start"] - before), F.lit("["), F.upper(s["kind"]), F.lit("]")))), ""))

        return F.concat(F.array_join(F.transform(firsts, run), ""), F.substr(text, F.element_at(spans, -1)["end"] + 1))

    clean = F.when(F.size("__pii_spans") == 0, text).otherwise(let(by_start, lambda spans: let(merged(spans), rebuilt)))
    return find(docs, text_col, threshold).withColumn(text_col, clean).select(*docs.columns)


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find(table(spark, sf_dir, "documents").select("doc_id", "text"))
    s = F.col("__pii_spans")
    base = F.filter(s, lambda x: x["rank"] < len(BASE))
    return found.select(
        "doc_id",
        *[count_of(s, k).alias(f"n_{k}") for k in BASE],
        F.sha2(joined(base), 256).alias("base_sha256"),
        joined(s).alias("spans"),
        F.array_max(F.transform(s, lambda x: x["score"])).alias("top_score"),
    )


# The same in SQL, with the plain patterns: for ASCII words a word boundary is what the look-arounds say.
_PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)", "card": r"[0-9](?:[\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "iban": r"\b[A-Z]{2}[0-9]{2}", "ssn": r"\b[0-9]{3}-[0-9]{2}-[0-9]{4}\b",
}
_DIGITS = "regexp_replace(x, '[^0-9]', '', 'g')"
_CHECKS = {
    "email": "true",
    "ip": "len(list_filter(string_split(x, '.'), lambda p: CAST(p AS HUGEINT) > 255)) = 0",
    "card": f"length({_DIGITS}) BETWEEN 16 AND 19 AND list_sum(list_transform(range(1, length({_DIGITS}) + 1), lambda i: CAST(substr(reverse({_DIGITS}), i, 1) AS INT) * (1 + (i - 1) % 2) - CASE WHEN CAST(substr(reverse({_DIGITS}), i, 1) AS INT) * (1 + (i - 1) % 2) > 9 THEN 9 ELSE 0 END)) % 10 = 0",
    "phone": f"length({_DIGITS}) BETWEEN 8 AND 15",
    "iban": "list_reduce(list_transform(string_split(substr(replace(x, ' ', ''), 5) || left(replace(x, ' ', ''), 4), ''), lambda c: CASE WHEN c >= 'A' THEN ascii(c) - 55 ELSE ascii(c) - 48 END), lambda a, v: CASE WHEN v > 9 THEN a * 100 + v ELSE a * 10 + v END % 97, 0) = 1",
    "ssn": "NOT regexp_matches(x, '^(000|666|9..)') AND NOT regexp_matches(x, '^...-00-') AND NOT regexp_matches(x, '0000$') AND right(before, 1) <> '-' AND left(after, 1) <> '-'",
}


def sql_spans(name: str, pattern: str, source: str) -> str:
    """(rn, start, stop, x, before, after) of a pattern's matches in source (rn, t)."""
    return f"""SELECT rn, start, start + length(x) AS stop, x, before, after FROM (SELECT rn, m[i] AS x, right(g[i], 48) AS before, left(g[i + 1], 48) AS after,
        CAST(list_sum(list_transform(g[1:i], lambda s: length(s))) + coalesce(list_sum(list_transform(m[1:i - 1], lambda s: length(s))), 0) AS BIGINT) AS start
        FROM (SELECT rn, g, m, unnest(range(1, len(m) + 1)) AS i FROM (SELECT rn, string_split_regex(t, '{pattern}') AS g, regexp_extract_all(t, '{pattern}') AS m FROM {source})))"""


def sql_ibans(pattern: str, source: str) -> str:
    """The same for account numbers: from every start of the pattern, what has its country's length; sides reach to the next such start."""
    wide = max(IBAN_LENGTHS.values()) * 2
    return f"""SELECT rn, start, start + length(x) AS stop, x, right(substr(t, before_at + 1, start - before_at), 48) AS before, left(substr(t, start + length(x) + 1, greatest(after_at - start - length(x), 0)), 48) AS after
        FROM (SELECT *, coalesce(lag(start) OVER w + 1, 0) AS before_at, coalesce(lead(start) OVER w, length(t)) AS after_at
        FROM (SELECT rn, start, t, regexp_extract(substr(t, start + 1, {wide}), '^(?:{_BY_LENGTH})\\b') AS x FROM ({sql_spans("iban", pattern, source)}) JOIN {source} USING (rn)) WHERE x <> '' WINDOW w AS (PARTITION BY rn ORDER BY start))"""


def _oracle() -> str:
    parts = []
    for rank, k in enumerate(KINDS):
        near = "lower(concat_ws(' ', before, after))"
        points = f"round(least(1.0::DOUBLE, greatest(0.0::DOUBLE, {k.prior + k.checksum!r}::DOUBLE + CASE WHEN regexp_matches({near}, '{whole_word(k.context)}') THEN 0.2::DOUBLE ELSE 0 END - CASE WHEN regexp_matches({near}, '{whole_word(AGAINST)}') THEN 0.15::DOUBLE ELSE 0 END)), 3)"
        proposed = sql_ibans(_PLAIN["iban"], "d") if k.name == "iban" else sql_spans(k.name, _PLAIN[k.name], "d")
        rows = f"SELECT rn, {rank} AS rank, '{k.name}' AS kind, start, stop, {points} AS score FROM ({proposed}) WHERE {_CHECKS[k.name]}"
        parts.append(rows if k.name in BASE else f"SELECT * FROM ({rows}) WHERE score >= {THRESHOLD}")
    spell = "string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY rank, start)"
    counts = ", ".join(f"coalesce(n_{k}, 0) AS n_{k}" for k in BASE)
    return f"""WITH d AS (SELECT row_number() OVER () AS rn, doc_id, coalesce(text, '') AS t FROM documents), s AS ({' UNION ALL '.join(parts)}),
        a AS (SELECT rn, {', '.join(f"count(*) FILTER (kind = '{k}') AS n_{k}" for k in BASE)}, {spell} FILTER (rank < {len(BASE)}) AS base, {spell} AS spans, max(score) AS top_score FROM s GROUP BY rn)
        SELECT doc_id, {counts}, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans, top_score FROM d LEFT JOIN a USING (rn)"""


ORACLE = _oracle()
