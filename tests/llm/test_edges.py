"""Every operator on awkward tables: nulls in any column, repeated rows, clashing names, long texts, no rows."""

import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from foliospark.llm import bpe, common, hnsw, licenses, minhash, packing, preference, quality, secrets, simhash, suffixes, tokens

from .test_operators import DOC, words

#: Names that operators use for columns of their own.
CLASHES = ("fp", "rep", "node", "component", "component_id", "spans", "k", "rank", "part", "n", "start", "host", "m", "base_failed", "kept", "ids", "license", "score", "origin", "dir", "path", "unit", "term", "band", "_m", "_id", "_gone_id", "_bad_host")
BY_DOC = {
    "op1": lambda d: minhash.repeated(d),
    "op2": lambda d: simhash.classes(d),
    "op3": lambda d: quality.judge(d),
    "op4": lambda d: secrets.digest(d),
    "op8": lambda d: packing.pack(d),
    "op9": lambda d: bpe.encode(d),
    "op10": lambda d: suffixes.removed(d),
}
STAGES = dict(corpus_pipeline.STAGES[:-1])


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(41)
    a, b = words(rng, 60, 10**6), words(rng, 45, 10**6)
    texts = [a, a, b + " password: abcdefgh1", "", None, " \n\t", "x", a + "\n" + b, "é" * 40, "ab " * 300]
    return [(i, t, "en", ("s", None, "t")[i % 3], None if t is None else len(t)) for i, t in enumerate(texts)]


def clashing(df):
    return df.select("*", *(F.lit(7).alias(c) for c in CLASHES))


def plain(df):
    return sorted(tuple(bytes(v) if isinstance(v, bytearray) else v for v in r) for r in df.collect())


@pytest.mark.parametrize("name", BY_DOC)
def test_clashing_columns_change_nothing(spark, rows, name):
    docs = spark.createDataFrame(rows, DOC)
    f, key = BY_DOC[name], lambda r: tuple(map(str, r))
    wide, narrow = f(clashing(docs)), f(docs)
    assert wide.columns == narrow.columns and sorted(map(key, wide.collect())) == sorted(map(key, narrow.collect()))


@pytest.mark.parametrize("name", BY_DOC)
def test_repeated_rows_and_null_ids(spark, rows, name):
    docs = spark.createDataFrame(rows, DOC)
    more = docs.union(docs).union(spark.createDataFrame([(None, "one two three " * 30, None, None, None)], DOC))
    once, twice = (Counter(r.doc_id for r in BY_DOC[name](d).collect()) for d in (docs, more))
    if name == "op1":  # a row for each place, however often its text's row is there
        assert twice == once
    elif name != "op8":  # a row for each row
        assert all(twice[i] == 2 * once[i] for i in range(len(rows))) and twice[None] == 1
    else:
        total = lambda d: sum(r.length for r in packing.pack(d).collect())
        assert total(docs.union(docs)) == 2 * total(docs)


@pytest.mark.parametrize("name", STAGES)
def test_stages_keep_every_column(spark, rows, name):
    docs = clashing(spark.createDataFrame(rows, DOC)).withColumn("_spans", F.lit(7))
    out = STAGES[name](spark, docs, "")
    assert out.columns == docs.columns and all(r[c] == 7 for r in out.collect() for c in (*CLASHES, "_spans"))


def test_pipeline_of_no_rows(spark, rows):
    docs = spark.createDataFrame(rows, DOC).where("false")
    for _, stage in corpus_pipeline.STAGES:
        docs = common.cut(stage(spark, docs, ""))
    assert docs.count() == 0


def test_texts_beyond_one_step(spark):
    """5 MB in one text, beside short ones that must come out as they do alone."""
    rng = random.Random(42)
    long, short = words(rng, 750_000, 10**5), words(rng, 200, 10**5) + " AKIA" + "A1" * 10
    assert len(long) > 4 << 20
    docs = spark.createDataFrame([(0, long + " token=" + "z" * 30, "en", "s", 1), (1, short, "en", "s", 1)], DOC)
    for name in ("op2", "op3", "op4", "op9"):
        f = BY_DOC[name]
        both, alone = f(docs).where("doc_id = 1").collect(), f(docs.where("doc_id = 1")).collect()
        assert [tuple(r)[:2] for r in both] == [tuple(r)[:2] for r in alone]
    assert secrets.digest(docs).where("doc_id = 0").first().n_assign == 1
    ids = np.frombuffer(b"".join(bytes(r.ids) for r in sorted(packing.pack(docs, keep_ids=True).where("doc_id = 0").collect(), key=lambda r: r.start)), "<u4")
    assert ids.tolist() == [*np.frombuffer(tokens.Encoder(packing.default_tokenizer()).encode(long + " token=" + "z" * 30), "<u4").tolist(), 1]


def test_conversations_files_and_vectors(spark):
    turns = spark.createDataFrame([(1, 0, None, None), (1, 1, "assistant", "a"), (None, 0, "user", "x"), (1, 1, "assistant", "a"), (2, None, "assistant", "b")], "conv_id long, turn long, role string, text string")
    wide = turns.select("*", *(F.lit(7).alias(c) for c in ("first", "last", "o", "opening", "head", "side", "pair_id", "t", "c", "r")))
    f = lambda d: plain(preference.format_pairs(preference.pairs_from(d)))
    assert f(wide) == f(turns) and len(f(turns)) == 2 and f(turns.where("false")) == []
    files = spark.createDataFrame([("a/LICENSE", None), (None, None), ("b", ""), ("", "Released under the MIT License.")], "path string, text string")
    assert {r.path: r.license for r in licenses.scan(files).collect()} == {"a/LICENSE": None, None: None, "b": None, "": "MIT"}
    vectors = spark.createDataFrame([(None, [1.0, 2.0]), (20, [1.0, 2.0]), (20, [1.0, 2.0]), (3, []), (40, None)], "vec_id long, e array<double>").withColumn("v", F.lit(1))
    own = hnsw.valid(vectors, "vec_id", "e")
    assert hnsw.nearest(own, own.where("vec_id % 20 = 0")).count() == 0 and own.count() == 2


def test_shared_folder_is_asked_for_on_a_cluster(spark, monkeypatch):
    class Far:
        class conf:
            get = staticmethod(lambda *a: None)

        class sparkContext:
            master = "spark://x:7077"

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        common.shared_dir(Far)
    df = common.cut(spark.range(3))
    assert df.count() == 3
    common.drop_cut(df)
    common.cut(spark.range(3))
    common.drop_cuts(spark)
    import glob

    assert not glob.glob(f"{common.shared_dir(spark)}/cut-{spark.sparkContext.applicationId}-*")
