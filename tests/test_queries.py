"""Every library query against its SQL twin, on the smallest tables."""

import os

import duckdb
import pytest

from foliospark.plans import registry

DIR = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def norm(v):
    if isinstance(v, float):
        return f"{v:.9g}"
    return "null" if v is None else str(v)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{DIR}/{t}.parquet')")
    return con


@pytest.mark.skipif(not os.path.isdir(DIR), reason="no test tables")
@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query(spark, duck, name):
    df = registry.QUERIES[name](spark, DIR)
    rows, cols = df.collect(), sorted(df.columns)
    assert rows
    if name not in registry.ORACLE_SQL:
        return
    cur = duck.execute(registry.ORACLE_SQL[name])
    names = [d[0] for d in cur.description]
    assert sorted(names) == cols
    got = sorted(tuple(norm(r[c]) for c in cols) for r in rows)
    assert got == sorted(tuple(norm(r[names.index(c)]) for c in cols) for r in cur.fetchall())


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def lineitems(path, keys):
    """lineitem and part with rows of (l_orderkey, l_linenumber, l_partkey, l_suppkey)."""
    import pyarrow as pa
    import pyarrow.parquet as pq

    order, line, part, supplier = (list(c) for c in zip(*keys, strict=True))
    pq.write_table(pa.table({"l_orderkey": order, "l_partkey": part, "l_suppkey": supplier, "l_linenumber": pa.array(line, pa.int32()), "l_quantity": [7.0] * len(keys), "l_extendedprice": [1.0] * len(keys)}), path / "lineitem.parquet")
    parts = sorted(set(part))
    pq.write_table(pa.table({"p_partkey": parts, "p_name": [f"part (no) \\{k}" for k in parts], "p_type": ["SMALL"] * len(parts), "p_brand": ["Brand"] * len(parts)}), path / "part.parquet")


def like_sql(spark, path, name):
    con = duckdb.connect()
    for t in ("lineitem", "part"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}/{t}.parquet')")
    cur = con.execute(registry.ORACLE_SQL[name])
    names = [d[0] for d in cur.description]
    got = [tuple(norm(r[c]) for c in names) for r in registry.QUERIES[name](spark, str(path)).collect()]
    assert sorted(got) == sorted(tuple(map(norm, r)) for r in cur.fetchall())
    return got


def test_block_classes_of_large_supplier_keys(spark, tmp_path):
    lineitems(tmp_path, [(1, 1, 1, 19021), (1, 2, 1, 20010), (1, 3, 1, 1978), (2, 1, 1, 202009), (2, 2, 1, 1900 * 19)])
    got = like_sql(spark, tmp_path, "block_classes")
    assert sorted(r[2] for r in got) == ["content"] * 4 + ["noise"]


def test_noise_patterns(spark):
    from foliospark.operators import layout

    texts = ["19021 Department", "2019 Vol. 5", "2019 12", "2019", "1978 Department"]
    b = spark.createDataFrame([(1, t, t, 100.0, 100.0, 200.0, 120.0) for t in texts], "doc_id int, block_id string, text string, x0 double, y0 double, x1 double, y1 double")
    of = lambda **a: {r.block_id for r in layout.classify(b, **a).collect() if r.category == "noise"}
    assert of() == set(texts[:4]) and of(noise=layout.NOISE_OF_YEARS) == set(texts[1:4])
