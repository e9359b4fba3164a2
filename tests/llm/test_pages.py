import hashlib
import re

import pytest
from pyspark.sql import functions as F

from gridloom.llm import url_filter as uf
from gridloom.llm import warc
from gridloom.llm.common import scratch_path

URLS = [None, "", "no scheme", "http://", "http://A.Example.ORG/es/x?q#f", "https://example.org/en/144", "https://notexample.org/en/144", "https://x.com/de/1", "https://x.com/fr/1#a", "https://com/fr/", "http://org", "http://x.org?y/z", "ftp://ÄB.Org/p", "a://b://c/d", "http://x.com:80/de/1", "http://h/\nline/2", "https://x.net/de/77", "https://x.net/de/78"]


def plain_rule(url):
    host = path = ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        cut = re.search(r"[/?#]", rest)
        host, tail = (rest[: cut.start()], rest[cut.start() :]) if cut else (rest, "")
        host = re.sub("[A-Z]", lambda m: m[0].lower(), host)
        path = re.split(r"[?#]", tail)[0]
    fit = [(len(r.text), r) for r in uf.RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    best = max(fit, key=lambda x: x[0])[1] if fit else None
    return host, path, best.text if best else None, best.verdict if best else None


def test_rules_equal_the_plain_loop(spark):
    df = spark.createDataFrame(list(enumerate(URLS)) + [(None, "http://x.org/"), (4, URLS[4])], "page_id long, url string")
    rows = uf.judge(df).collect()
    assert len(rows) == len(URLS) + 2
    for r in rows:
        host, path, rule, verdict = plain_rule(r.url)
        assert (r["__uf_host"], r["__uf_path"], r["__uf_rule"]) == (host, path, rule)
        assert r["__uf_verdict"] == (verdict or r["__uf_verdict"]) and r["__uf_verdict"] in ("allow", "block")


def test_templates_generalise_and_learn(spark):
    rows = [(i, f"http://h{i % 3}.com/de/{i}") for i in range(60)] + [(100 + i, f"http://h{i % 3}.com/fr/{i}") for i in range(60)] + [(200 + i, f"http://quiet.net/{'de' if i % 2 else 'fr'}/{i}") for i in range(20)] + [(300 + i, f"http://shop.net/item-{chr(97 + i % 26)}{chr(97 + i // 26)}") for i in range(60)]
    out = uf.judge(spark.createDataFrame(rows, "page_id long, url string")).collect()
    quiet = {r["__uf_template"]: r["__uf_verdict"] for r in out if r["__uf_host"] == "quiet.net"}
    assert quiet == {"/de/{n}": "block", "/fr/{n}": "allow"}
    assert {r["__uf_template"] for r in out if r["__uf_host"] == "shop.net"} == {"/{*}"}


def test_url_cases(spark):
    empty = spark.createDataFrame([], "page_id long, url string")
    assert uf.judge(empty).count() == 0
    hot = spark.range(2000).select(F.col("id").alias("page_id"), F.lit("http://one.net/a").alias("url"), F.lit(1).alias("host"))
    assert uf.judge(hot).filter("__uf_template = '/a'").count() == 2000
    with pytest.raises(ValueError):
        uf.apply_rules(empty, [uf.RULES[0]] * 10_001)


def test_ten_thousand_rules_and_deep_paths(spark):
    rules = [uf.Rule("block" if i % 2 else "allow", f"h{i}.com", f"/p{i % 7}") for i in range(9_999)] + [uf.Rule("allow", "com", "/")]
    df = spark.createDataFrame([(i, f"https://www.h{i}.com/p{i % 7 if i % 3 else 9}/x") for i in range(0, 9_999, 13)] + [(-1, "https://" + "a." * 3000 + "h1.com/p1")], "page_id long, url string")
    for r in uf.judge(df, rules=rules).collect():
        i = r.page_id if r.page_id >= 0 else 1
        fits = r.page_id < 0 or i % 3
        assert r["__uf_rule"] == (f"h{i}.com/p{i % 7}" if fits else "com/") and r["__uf_verdict"] == ("block" if fits and i % 2 else "allow")
    deep = [(i, f"http://deep.net/a/b/c/{'good' if i % 2 else 'bad'}/p{'' if i < 400 else '/q' * 60}/{i}") for i in range(800)]
    rules = [uf.Rule("block", "deep.net", "/a/b/c/bad"), uf.Rule("allow", "deep.net", "/a/b/c/good/p/1"), uf.Rule("allow", "deep.net", "/a/b/c/good/p/3")]
    out = {r["__uf_template"]: (r["__uf_purity"], r["__uf_verdict"]) for r in uf.judge(spark.createDataFrame(deep, "page_id long, url string"), rules=rules).collect()}
    assert len(out) == 4 and all((v[1] == "block") == ("/bad/" in t) and abs(v[0] - ("/bad/" in t)) < 0.1 for t, v in out.items()), out


def test_like_siblings_share_their_counts(spark):
    own = [("h", "/" + n, "/", b, 10, 1) for n, b in (("a", 0), ("b", 1), ("c", 0), ("d", 9), ("e", 10))] + [("h", "/f", "/", 0, 0, 1), ("i", "/a", "/", 10, 10, 1)]
    rows = uf.alike(spark.createDataFrame(own, "__uf_host string, __uf_node string, __uf_parent string, __uf_blocked long, __uf_labelled long, __uf_uses long")).collect()
    got = {(r["__uf_host"], r["__uf_node"]): (r["__uf_b"], r["__uf_l"]) for r in rows}
    assert got == {("h", "/a"): (1, 30), ("h", "/b"): (1, 30), ("h", "/c"): (1, 30), ("h", "/d"): (19, 20), ("h", "/e"): (19, 20), ("h", "/f"): (0, 0), ("i", "/a"): (10, 10)}


def test_sql_says_the_same_of_hard_urls(spark, tmp_path):
    import duckdb
    import random

    rng = random.Random(5)
    words = ["de", "fr", "es", "en", "shop", "item", *(f"{a}{b}" for a in "abcdefgh" for b in "xyz")]
    urls = [*URLS, "http://x.org/" + "/".join("t" * k for k in range(1, 40)), "http://x.com/{*}/{n}/a", "http://y.com/0123456789ab/12.html/12\n"]
    urls += [f"http://{rng.choice(['www.', '', 'm.'])}{rng.choice('pqr')}.{rng.choice(['com', 'example.org', 'net'])}/" + "/".join(rng.choice([rng.choice(words), rng.choice(words[:4]), str(rng.randrange(999))]) for _ in range(rng.randrange(7))) for _ in range(3000)]
    rows = [(i, u) for i, u in enumerate(urls)]
    spark.createDataFrame(rows, "page_id long, url string").coalesce(1).write.parquet(str(tmp_path / "pages.parquet"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM read_parquet('{tmp_path}/pages.parquet/*.parquet')")
    got = uf.op7_url_filter(spark, str(tmp_path)).toPandas()
    want = con.execute(uf.ORACLE).df()[list(got.columns)]
    plain = lambda d: sorted(tuple("-" if v is None or v != v else str(v) for v in r) for r in d.astype(object).itertuples(index=False))
    assert plain(got) == plain(want) and got.template.str.contains("{*}", regex=False).any() and got.purity.nunique() > 20


def pages(spark):
    big = "<p>" + "x" * 200 + "é</p>"
    rows = [(5, "http://a.b.com/1", big), (3, "http://a.b.com/2?q=1", big), (9, None, big), (1, "http://z.org/", "small"), (2, "http://z.org/", "small"), (None, "http://n.org/\r\nX: y", "y" * 150), (7, "http://n.org/é", "y" * 150), (8, "", None), (3, "http://a.b.com/2?q=1", big)]
    rows += [(100 + i, f"http://host{i % 7}.com/p{i}", f"<html>{i // 2}" + "z" * 120) for i in range(300)]
    return rows, spark.createDataFrame(rows, "page_id long, url string, html string").repartition(4)


def test_archives_round_trip(spark):
    rows, df = pages(spark)
    folder = scratch_path(spark, "warc")
    captures = warc.write_archives(df.withColumn("digest", F.lit(1)), folder)
    shards = warc.write_index(captures, folder, block=8)
    keys = df.select(warc.surt(F.col("url")).alias("surt"), F.coalesce("page_id", F.lit(warc.NO_ID)).alias("page_id")).distinct()
    got = sorted((str(r.page_id), str(r.url), r.payload_bytes, r.payload_digest, r.record_type, str(r.refers_to)) for r in warc.lookup(keys, folder, shards).collect())
    want, seen = [], set()
    least = {}
    for i, _, h in rows:
        if i is not None:
            least[h] = min(least.get(h, i), i)
    for i, u, h in rows:
        data = (h or "").encode()
        first = least.get(h)
        response = len(data) < 100 or (i == first and (i, h) not in seen)
        seen.add((i, h))
        want.append((str(i), str(u), len(data), hashlib.sha256(data).hexdigest(), "response" if response else "revisit", str(None if response else first)))
    assert got == sorted(want)


def test_lookups_find_single_keys_and_nothing_else(spark):
    _, df = pages(spark)
    folder = scratch_path(spark, "warc")
    shards = warc.write_index(warc.write_archives(df, folder), folder, block=4)
    assert len(warc.find(folder, shards, ("com,b,a)/1", 5))) == 1 and len(warc.find(folder, shards, ("com,b,a)/2?q=1", 3))) == 2
    assert warc.find(folder, shards, ("com,b,a)/1", 6)) == [] and warc.find(folder, shards, ("", -(1 << 63))) == [] and warc.find(folder, [], ("x", 1)) == []


def test_a_plain_reader_follows_revisits(spark):
    import gzip
    import os

    rows, df = pages(spark)
    folder = scratch_path(spark, "warc")
    captures = warc.write_archives(df, folder).collect()
    records = {}
    for name in {c.file for c in captures}:
        with open(os.path.join(folder.removeprefix("file://"), name), "rb") as f:
            data = gzip.decompress(f.read())  # the members one after the other
        while data:
            head, data = data.split(b"\r\n\r\n", 1)
            version, *lines = head.decode().split("\r\n")
            fields = dict(x.split(": ", 1) for x in lines)
            n = int(fields["Content-Length"])
            assert version == "WARC/1.1" and data[n : n + 4] == b"\r\n\r\n" and fields["WARC-Record-ID"] not in records
            records[fields["WARC-Record-ID"]] = (fields, data[:n])
            data = data[n + 4 :]
    assert len(records) == len(rows)
    revisits = [f for f, _ in records.values() if f["WARC-Type"] == "revisit"]
    assert len(revisits) > 100
    for f in revisits:
        first, _ = records[f["WARC-Refers-To"]]
        assert first["WARC-Type"] == "response" and first["WARC-Payload-Digest"] == f["WARC-Payload-Digest"]
        assert f.get("WARC-Refers-To-Target-URI") == first.get("WARC-Target-URI") and f["WARC-Refers-To-Date"] == first["WARC-Date"] and "X-" not in "".join(f)
    for page in (None, 0, 7, -5, (1 << 63) - 1):
        assert warc.page_of(warc.record_id(page, "u", "d", 2)) == page


def test_stores_that_tasks_cannot_write_to_are_refused(spark):
    _, df = pages(spark)
    with pytest.raises(ValueError, match="viewfs"):
        warc.write_archives(df, "viewfs://store/x")


def test_damage_is_noticed_and_empty_tables_work(spark):
    import zlib

    good = warc.record(1, "http://x/", hashlib.sha256(b"abc").hexdigest(), 3, None, b"abc")
    assert warc.parse(good)[:3] == (1, "http://x/", 3)
    bad = zlib.compressobj(6, zlib.DEFLATED, 31)
    raw = zlib.decompress(good, 31).replace(b"abc", b"abd")
    with pytest.raises(ValueError, match="damaged"):
        warc.parse(bad.compress(raw) + bad.flush())
    df = spark.createDataFrame([], "page_id long, url string, html string")
    folder = scratch_path(spark, "warc")
    assert warc.write_index(warc.write_archives(df, folder), folder) == []
