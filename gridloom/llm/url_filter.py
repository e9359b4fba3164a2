"""URL filters: fixed rules first, then a path-template tree for each host.

A url's path becomes a template of as many segments as it has. Segments that look variable
(numbers, long hex, ids with digits) are wildcards at once; a literal segment also becomes
one where its place below a parent template holds ``FAN_OUT`` or more different literals and
this one has under ``RARE`` of the place's rows. Every node of the tree (host, template
prefix) counts the pages that rules label allow or block. Children of one parent whose block
rates are neighbours and don't differ by ``Z`` standard errors are merged and share their
counts. A branch whose rate doesn't differ from its parent's either takes the parent's purity;
others keep their own, smoothed by the parent's: (blocked + ALPHA * parent) / (labelled + ALPHA).
Above the hosts stand the same templates over all hosts, and the overall rate above those,
so a host without labels is judged by what its kind of path is elsewhere. A template with
purity of ``REJECT`` or more is blocked.

The tree grows by one depth in each round, over the distinct (host, segments) whose place still
has ``FAN_OUT`` of them: below fewer, no place can be crowded, so their templates are finished
at once and nothing is cut. Rounds are as many as such places are deep; each is a written table.

Rules are one row of lists, hashed by host, that every row looks its host's endings up in;
the longest rule that fits wins, of equally long ones the last by name and verdict.

Counts are sums over (host, template) that combine on the map side, so a host with a third
of all pages is one short row from each task; the ways back, from places to their segments
and from the tree to the pages, are dealt over salts that follow the groups' sizes.

Defined cases: a null url or one without :// has empty host and path, an empty template and
the overall verdict; page ids may be null or repeated; an empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gridloom.llm.common import discard, give_back, let, materialise, table

FAN_OUT, RARE, ALPHA, Z, REJECT, MOST_RULES = 20, 0.05, 2.0, 1.96, 0.5, 10_000


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return f"{self.host}{self.path}"


# The rules.
RULES = (
    Rule("allow", "org", "/"),
    Rule("block", "example.org", "/es/"),
    Rule("block", "example.org", "/en/1"),
    Rule("allow", "com", "/fr/"),
    Rule("block", "com", "/de/"),
)


def host_of(url: Column) -> Column:
    raw = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(raw, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def apply_rules(pages: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """Adds __uf_rule and __uf_label from the longest rule that fits."""
    if len(rules) > MOST_RULES:
        raise ValueError(f"{len(rules)} rules; one row takes {MOST_RULES} at most")
    size = 1 << max(1, len(rules)).bit_length()
    buckets: list[list[tuple]] = [[] for _ in range(size)]
    for r in rules:
        buckets[zlib.crc32(r.host.encode()) % size].append((r.host, r.path, r.verdict, r.text))
    known = pages.sparkSession.createDataFrame([(buckets,)], "__uf_rules array<array<struct<host:string,path:string,verdict:string,text:string>>>")
    most = max((r.host.count(".") + 1 for r in rules), default=1)

    def hits(labels: Column) -> Column:
        endings = F.transform(F.sequence(F.greatest(F.size(labels) - most, F.lit(0)), F.size(labels) - 1), lambda i: F.array_join(F.slice(labels, i + 1, F.size(labels) - i), "."))
        fitting = F.transform(endings, lambda h: F.filter(F.get("__uf_rules", F.pmod(F.crc32(h.cast("binary")), F.lit(size)).cast("int")), lambda r: (r["host"] == h) & F.startswith(F.col("__uf_path"), r["path"])))
        return F.array_max(F.transform(F.flatten(fitting), lambda r: F.struct(F.length(r["text"]).alias("n"), r["text"].alias("text"), r["verdict"].alias("verdict"))))

    best = pages.crossJoin(F.broadcast(known)).withColumn("__uf_best", let(F.split("__uf_host", r"\."), hits))  # a side of one row
    return best.withColumn("__uf_rule", F.col("__uf_best.text")).withColumn("__uf_label", F.col("__uf_best.verdict")).drop("__uf_best", "__uf_rules")


def segments(path: Column) -> Column:
    return F.transform(
        F.filter(F.split(path, "/"), lambda s: s != ""),
        lambda s: F.when(s.rlike(r"^[0-9]+(\.[a-z0-9]+)?\z"), "{n}").when(s.rlike(r"^[0-9a-f-]{12,}\z"), "{h}").when(s.rlike("[0-9]{2,}"), "{v}").otherwise(s),
    )


def generalise(urls: DataFrame) -> DataFrame:
    """Templates of distinct (host, segments), with wildcards for rare literals of crowded places, one depth after the other."""
    spark, place = urls.sparkSession, ["__uf_host", "__uf_t"]
    level = materialise(urls.withColumn("__uf_t", F.lit("")).withColumn("__uf_over", F.size("__uf_segs") == 0), "templates")
    levels, depth = [level], 0
    literal = ~F.col("__uf_seg").startswith("{")
    while not (live := level.filter(~F.col("__uf_over"))).isEmpty():
        here = live.withColumn("__uf_seg", F.element_at("__uf_segs", depth + 1))
        kids = materialise(here.groupBy(*place, "__uf_seg").agg(F.sum("__uf_n").alias("__uf_kid"), F.count(F.lit(1)).alias("__uf_urls")), "segments")
        places = materialise(kids.groupBy(*place).agg(
            F.count(F.lit(1)).alias("__uf_kids"), F.sum("__uf_urls").alias("__uf_below"), F.count_if(literal).alias("__uf_fan"), F.sum(F.when(literal, F.col("__uf_kid"))).alias("__uf_all")), "places")
        rare = literal & (F.col("__uf_fan") >= FAN_OUT) & (F.col("__uf_kid") < RARE * F.col("__uf_all"))
        named = give_back(kids, places, place, "__uf_kids", "__uf_seg", "inner")
        named = materialise(named.select(*place, "__uf_seg", "__uf_urls", F.when(rare, "{*}").otherwise(F.col("__uf_seg")).alias("__uf_name"), (F.col("__uf_below") < FAN_OUT).alias("__uf_few")), "names")
        rest = F.array_join(F.slice("__uf_segs", depth + 1, F.size("__uf_segs")), "/")
        longer = F.concat("__uf_t", F.lit("/"), F.when(F.col("__uf_few"), rest).otherwise(F.col("__uf_name")))
        depth += 1
        out = give_back(here, named, [*place, "__uf_seg"], "__uf_urls", "__uf_segs", "inner")
        level = materialise(out.select(*[c for c in urls.columns], longer.alias("__uf_t"), (F.col("__uf_few") | (F.size("__uf_segs") == depth)).alias("__uf_over")), "templates")
        levels.append(level)
        discard(kids, places, named)
    return spark.read.schema(level.schema).parquet(*[x._scratch_path for x in levels]).filter("__uf_over").drop("__uf_over")


def smoothed(blocked: Column, labelled: Column, parent: Column) -> Column:
    """A node's purity, or its parent's where the two can't be told apart."""
    rate = blocked / F.nullif(labelled, F.lit(0))
    error = F.sqrt(F.greatest(parent * (1 - parent), F.lit(0.01)) / F.nullif(labelled, F.lit(0)))
    merged = (labelled == 0) | (F.abs(rate - parent) < Z * error)
    return F.when(F.coalesce(merged, F.lit(True)), parent).otherwise((blocked + ALPHA * parent) / (labelled + ALPHA))


def alike(own: DataFrame) -> DataFrame:
    """own with the counts of each node's branch in __uf_b and __uf_l: of its like siblings together.

    Siblings are as few as a place has names left: under FAN_OUT, or 1 / RARE, besides four kinds of wildcards.
    """
    rate, l = F.col("__uf_blocked") / F.nullif(F.col("__uf_labelled"), F.lit(0)), F.col("__uf_labelled")
    by_rate = Window.partitionBy("__uf_host", "__uf_parent").orderBy(F.col("__uf_rate").asc_nulls_last(), "__uf_labelled", "__uf_node")
    b0, l0 = F.lag("__uf_blocked").over(by_rate), F.lag("__uf_labelled").over(by_rate)
    both = (F.col("__uf_blocked") + b0) / F.nullif(l + l0, F.lit(0))
    error = F.sqrt(F.greatest(both * (1 - both), F.lit(0.01)) * (1 / F.nullif(l, F.lit(0)) + 1 / F.nullif(l0, F.lit(0))))
    apart = F.coalesce(F.abs(F.col("__uf_rate") - b0 / F.nullif(l0, F.lit(0))) >= Z * error, F.lit(False))
    rows = own.withColumn("__uf_rate", rate).withColumn("__uf_apart", apart.cast("int")).withColumn("__uf_branch", F.sum("__uf_apart").over(by_rate.rowsBetween(Window.unboundedPreceding, 0)))
    branch = Window.partitionBy("__uf_host", "__uf_parent", "__uf_branch")
    some = F.col("__uf_labelled") > 0  # a branch without labels is like none
    return rows.withColumn("__uf_b", F.when(some, F.sum("__uf_blocked").over(branch)).otherwise(0)).withColumn("__uf_l", F.when(some, F.sum("__uf_labelled").over(branch)).otherwise(0))


def tree(counts: DataFrame) -> DataFrame:
    """The purity of every (host, template). counts: a written table of host, template, blocked, labelled."""
    sums = counts.agg(F.sum("__uf_blocked").alias("b"), F.sum("__uf_labelled").alias("l")).first()
    overall = F.lit(((sums["b"] or 0) + 1) / ((sums["l"] or 0) + 2))  # one number
    parts = F.filter(F.split("__uf_t", "/"), lambda s: s != "")

    def prefix(p: Column, d: Column) -> Column:
        return F.unhex(F.sha2(F.array_join(F.slice(p, F.lit(1), d), "/"), 256))

    nodes = let(parts, lambda p: F.transform(F.sequence(F.lit(0), F.size(p)), lambda d: F.struct(d.alias("__uf_d"), prefix(p, d).alias("__uf_node"), F.when(d > 0, prefix(p, d - 1)).alias("__uf_parent"))))
    chain = materialise(counts.withColumn("__uf_at", F.explode(nodes)).select("*", "__uf_at.*").drop("__uf_at"), "chains")
    own = chain.groupBy("__uf_host", "__uf_node", "__uf_parent").agg(F.sum("__uf_blocked").alias("__uf_blocked"), F.sum("__uf_labelled").alias("__uf_labelled"), F.count(F.lit(1)).alias("__uf_uses"))
    own = materialise(alike(own).select("__uf_host", "__uf_node", "__uf_blocked", "__uf_labelled", "__uf_b", "__uf_l", "__uf_uses"), "nodes")
    wide = materialise(own.groupBy("__uf_node").agg(F.sum("__uf_blocked").alias("__uf_wb"), F.sum("__uf_labelled").alias("__uf_wl"), F.sum("__uf_uses").alias("__uf_all")), "everywhere")
    # Down from the root: over all hosts first, then in the host. A template's chain is as long as its path is deep.
    links = chain.select("__uf_host", "__uf_t", "__uf_d", "__uf_node")
    both = give_back(links, own.select("__uf_host", "__uf_node", "__uf_b", "__uf_l", "__uf_uses"), ["__uf_host", "__uf_node"], "__uf_uses", "__uf_t", "inner").drop("__gb_salt")
    both = give_back(both.withColumn("__uf_deal", F.xxhash64("__uf_host", "__uf_t")), wide, ["__uf_node"], "__uf_all", "__uf_deal", "inner")
    rows = both.groupBy("__uf_host", "__uf_t").agg(F.array_sort(F.collect_list(F.struct("__uf_d", "__uf_wb", "__uf_wl", "__uf_b", "__uf_l"))).alias("c"))
    everywhere = F.aggregate("c", overall, lambda p, x: smoothed(x["__uf_wb"], x["__uf_wl"], p))
    purity = F.aggregate("c", everywhere, lambda p, x: smoothed(x["__uf_b"], x["__uf_l"], p))
    return rows.select("__uf_host", "__uf_t", F.round(purity, 6).alias("__uf_purity"))


def judge(pages: DataFrame, url_col: str = "url", id_col: str = "page_id", rules: Sequence[Rule] = RULES) -> DataFrame:
    """pages with __uf_host, __uf_path, __uf_rule, __uf_template, __uf_purity and __uf_verdict."""
    url = F.col(url_col).cast("string")
    rows = apply_rules(pages.withColumn("__uf_host", host_of(url)).withColumn("__uf_path", path_of(url)), rules).withColumn("__uf_segs", segments(F.col("__uf_path")))
    urls = rows.groupBy("__uf_host", "__uf_segs").agg(F.count(F.lit(1)).alias("__uf_n"), F.count_if(F.col("__uf_label") == "block").alias("__uf_blocked"), F.count("__uf_label").alias("__uf_labelled"))
    named = generalise(urls)
    counts = materialise(named.groupBy("__uf_host", "__uf_t").agg(F.sum("__uf_blocked").alias("__uf_blocked"), F.sum("__uf_labelled").alias("__uf_labelled"), F.count(F.lit(1)).alias("__uf_urls")), "template-counts")
    purity = materialise(tree(counts.drop("__uf_urls")).join(counts.select("__uf_host", "__uf_t", "__uf_urls"), ["__uf_host", "__uf_t"]), "template-purity")
    known = give_back(named.select("__uf_host", "__uf_segs", "__uf_t", "__uf_n"), purity, ["__uf_host", "__uf_t"], "__uf_urls", "__uf_segs", "inner").drop("__gb_salt", "__uf_urls")
    rows = give_back(rows, materialise(known, "judged"), ["__uf_host", "__uf_segs"], "__uf_n", id_col, "inner").drop("__uf_n", "__uf_segs", "__gb_salt")
    return rows.withColumnRenamed("__uf_t", "__uf_template").withColumn("__uf_verdict", F.coalesce("__uf_label", F.when(F.col("__uf_purity") >= REJECT, "block").otherwise("allow")))


def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = judge(table(spark, sf_dir, "pages").select("page_id", "url"))
    return rows.select("page_id", *[F.col(f"__uf_{c}").alias(c) for c in ("host", "path", "rule", "verdict", "template", "purity")])


def _oracle() -> str:
    fit = " ".join(f"WHEN (host = '{r.host}' OR ends_with(host, '.{r.host}')) AND starts_with(path, '{r.path}') THEN {{}}" for r in sorted(RULES, key=lambda r: (-len(r.text), r.text)))
    chosen = sorted(RULES, key=lambda r: (-len(r.text), r.text))
    case = lambda value: f"CASE {fit.format(*[repr(value(r)) for r in chosen])} END"
    step = lambda b, l: f"""CASE WHEN x.{l} = 0 OR abs(x.{b} / x.{l} - a.p) < {Z} * sqrt(greatest(a.p * (1 - a.p), 0.01::DOUBLE) / x.{l}) THEN a.p ELSE (x.{b} + {ALPHA}::DOUBLE * a.p) / (x.{l} + {ALPHA}::DOUBLE) END"""
    fold = lambda start, b, l: f"list_reduce(list_prepend({{'d': 0, 'p': {start}, 'wb': 0.0::DOUBLE, 'wl': 0.0::DOUBLE, 'b': 0.0::DOUBLE, 'l': 0.0::DOUBLE}}, c), lambda a, x: {{'d': 0, 'p': {step(b, l)}, 'wb': 0.0::DOUBLE, 'wl': 0.0::DOUBLE, 'b': 0.0::DOUBLE, 'l': 0.0::DOUBLE}}).p"
    return rf"""WITH RECURSIVE h AS (SELECT page_id, translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
        regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path FROM pages),
    p AS (SELECT *, {case(lambda r: r.text)} AS rule, {case(lambda r: r.verdict)} AS label, list_transform(list_filter(string_split(path, '/'), lambda s: s <> ''),
        lambda s: CASE WHEN regexp_matches(s, '^[0-9]+(\.[a-z0-9]+)?\z') THEN '{{n}}' WHEN regexp_matches(s, '^[0-9a-f-]{{12,}}\z') THEN '{{h}}' WHEN regexp_matches(s, '[0-9]{{2,}}') THEN '{{v}}' ELSE s END) AS segs FROM h),
    u AS (SELECT host, segs, CAST(count(*) AS DOUBLE) AS n, CAST(count(*) FILTER (label = 'block') AS DOUBLE) AS b, CAST(count(label) AS DOUBLE) AS l FROM p GROUP BY host, segs),
    g AS (SELECT host, segs, n, b, l, '' AS t, 0 AS d, len(segs) = 0 AS done FROM u UNION ALL
        SELECT host, segs, n, b, l, t || '/' || CASE WHEN below < {FAN_OUT} THEN array_to_string(segs[d + 1:], '/') WHEN named AND fan >= {FAN_OUT} AND kid < {RARE}::DOUBLE * every THEN '{{*}}' ELSE seg END, d + 1, below < {FAN_OUT} OR len(segs) = d + 1
        FROM (SELECT *, count(*) OVER (PARTITION BY host, t) AS below, count(DISTINCT CASE WHEN named THEN seg END) OVER (PARTITION BY host, t) AS fan, sum(n) OVER (PARTITION BY host, t, seg) AS kid, sum(CASE WHEN named THEN n END) OVER (PARTITION BY host, t) AS every
            FROM (SELECT *, segs[d + 1] AS seg, NOT starts_with(segs[d + 1], '{{') AS named FROM g WHERE NOT done))),
    c AS (SELECT host, t, sum(b) AS b, sum(l) AS l FROM g WHERE done GROUP BY host, t),
    o AS (SELECT (coalesce(sum(b), 0) + 1) / (coalesce(sum(l), 0) + 2) AS overall FROM c),
    i AS (SELECT host, t, b, l, d, array_to_string(parts[1:d], '/') AS node, d = 0 AS root, CASE WHEN d > 0 THEN array_to_string(parts[1:d - 1], '/') ELSE '' END AS parent
        FROM (SELECT *, unnest(range(0, len(parts) + 1)) AS d FROM (SELECT *, list_filter(string_split(t, '/'), lambda s: s <> '') AS parts FROM c))),
    w AS (SELECT host, d, node, root, parent, sum(b) AS b, sum(l) AS l, sum(b) / nullif(sum(l), 0) AS rate FROM i GROUP BY host, d, node, root, parent),
    q AS (SELECT *, coalesce(abs(rate - b0 / nullif(l0, 0)) >= {Z} * sqrt(greatest((b + b0) / nullif(l + l0, 0) * (1 - (b + b0) / nullif(l + l0, 0)), 0.01::DOUBLE) * (1 / nullif(l, 0) + 1 / nullif(l0, 0))), false) AS apart
        FROM (SELECT *, lag(b) OVER r AS b0, lag(l) OVER r AS l0 FROM w WINDOW r AS (PARTITION BY host, root, d, parent ORDER BY rate NULLS LAST, l, sha256(node)))),
    v AS (SELECT *, sum(CAST(apart AS INT)) OVER (PARTITION BY host, root, d, parent ORDER BY rate NULLS LAST, l, sha256(node) ROWS UNBOUNDED PRECEDING) AS branch FROM q),
    m AS (SELECT host, d, node, CASE WHEN l > 0 THEN sum(b) OVER s ELSE 0 END AS b, CASE WHEN l > 0 THEN sum(l) OVER s ELSE 0 END AS l FROM v WINDOW s AS (PARTITION BY host, root, d, parent, branch)),
    e AS (SELECT d, node, sum(b) AS wb, sum(l) AS wl FROM w GROUP BY d, node),
    k AS (SELECT i.host, i.t, list({{'d': i.d, 'p': 0.0::DOUBLE, 'wb': wb, 'wl': wl, 'b': m.b, 'l': m.l}} ORDER BY i.d) AS c FROM i JOIN m ON i.host = m.host AND i.d = m.d AND i.node = m.node JOIN e ON i.d = e.d AND i.node = e.node GROUP BY i.host, i.t),
    f AS (SELECT host, t, round({fold('everywhere', 'b', 'l')}, 6) AS purity FROM (SELECT *, {fold('overall', 'wb', 'wl')} AS everywhere FROM k, o))
    SELECT page_id, p.host, path, rule, coalesce(label, CASE WHEN purity >= {REJECT} THEN 'block' ELSE 'allow' END) AS verdict, g.t AS template, purity
    FROM p JOIN g ON p.host = g.host AND p.segs = g.segs AND g.done JOIN f ON f.host = g.host AND f.t = g.t"""


ORACLE = _oracle()
