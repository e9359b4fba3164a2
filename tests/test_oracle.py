"""Every core query against its SQL in an independent engine, over the smallest tables."""

import glob
import math
import os

import pytest

from gridloom.plans import oracle, queries

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="the driver's tables aren't here")


@pytest.fixture(scope="module")
def duck():
    import duckdb

    con = duckdb.connect()
    for f in glob.glob(f"{DATA}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM read_parquet('{f}')")
    return con


def rows(df):
    df = df[sorted(df.columns)].astype(object)
    plain = lambda v: "null" if v is None or (isinstance(v, float) and math.isnan(v)) or str(v) == "<NA>" else repr(float(v)) if isinstance(v, float) else str(v)
    return sorted(tuple(map(plain, r)) for r in df.itertuples(index=False))


@pytest.mark.parametrize("name", [n for n in queries.NAMES if n in oracle.oracle_sql()])
def test_query_equals_its_sql(spark, duck, name):
    got, want = queries.queries()[name](spark, DATA).toPandas(), duck.execute(oracle.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want)


def test_entry(spark):
    import __spark_entry__

    out = __spark_entry__.entry(spark)
    assert out.count() > 0 and out.columns[0] == "rank"
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def against_sql(spark, folder, name, tables):
    """A query and its SQL over tables given as rows of (key, text)."""
    import duckdb

    con = duckdb.connect()
    for table, (key, texts) in tables.items():
        spark.createDataFrame(texts, f"{key} long, text string").coalesce(1).write.parquet(f"{folder}/{table}.parquet")
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{folder}/{table}.parquet/*.parquet')")
    got, want = rows(queries.queries()[name](spark, str(folder)).toPandas()), rows(con.execute(oracle.oracle_sql()[name]).df())
    assert got == want
    return got


def test_numerals_have_the_digits_of_their_exact_value(spark, tmp_path):
    texts = ["909955422195631400000 and 9223372036854775807, 9007199254740993", "0.0000005 0.0078125 0.0234375 123456789012.34567 0.9999999", "9" * 400 + " " + "0" * 400 + "5", None, ""]
    documents = [*enumerate(texts), (7, "1 and 1.0"), (7, "1.00 and 2")]  # a key may come twice
    got = against_sql(spark, tmp_path, "numeral_extract", {"documents": ("doc_id", documents)})
    assert {("0", "909955422195631390720"), ("1", "0."), ("1", "0.007812"), ("1", "123456789012.345673"), ("2", "inf"), ("2", "5")} <= set(got)
    assert [n for k, n in got if k == "7"] == ["1", "2"]


def test_numerals_are_verified_by_their_exact_value(spark, tmp_path):
    documents = [(1, "909955422195631400000 and 18446744073709551616"), (2, "0.0000005 0.0078125 7"), (2, "7.0 8"), (3, "8")]
    allowed = [(1, "18446744073709551616.0 and 0.007812"), (1, "0.0000001")]
    got = against_sql(spark, tmp_path, "numeral_verify", {"documents": ("doc_id", documents), "benchmark": ("item_id", allowed)})
    assert got == [("1", "7"), ("1", "909955422195631390720"), ("2", "8")]
