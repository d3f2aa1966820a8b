"""The registered queries against SQL, and the pipeline stage by stage against brute force."""

import os

import brute
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from test_tables_llm import check_packing
from tidegate.llm import language, mixing
from tidegate.llm.queries import QUERIES, SQL
from tools.parity import TABLES, canonical

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables not present")


@pytest.mark.parametrize("name", list(QUERIES))
def test_queries(spark, name):
    duckdb = pytest.importorskip("duckdb")
    df = QUERIES[name](spark, FOLDER)
    got, names = canonical(df.columns, [tuple(r) for r in df.collect()])
    assert got
    if name in SQL:
        con = duckdb.connect()
        for t in TABLES:
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
        rel = con.execute(SQL[name])
        want, want_names = canonical([d[0] for d in rel.description], rel.fetchall())
        assert names == want_names and got == want


def test_stages(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    extra = spark.createDataFrame([(9001, "12 34", "en", "src0", 5), (9002, None, None, None, None), (9003, "", "fr", None, 0)], docs.schema)
    docs = docs.union(extra).withColumn("score", F.lit("clash")).withColumn("kept", F.lit("clash"))
    named = [f for _, f in corpus_pipeline.STAGES]
    columns = list(corpus_pipeline.COLUMNS)

    one = named[0](spark, docs, FOLDER).cache()
    assert one.columns == columns
    texts = {r.doc_id: r.text for r in docs.collect()}
    model = language.learn(docs.filter(language.fold(3) != 1))
    stays = {i for i, t in texts.items() for lang, score in [language.infer(model, [t])] if lang != ["und"] and score[0] >= 0.3}
    assert {r.doc_id for r in one.collect()} == stays and not stays & {9001, 9002, 9003}

    two = named[1](spark, one, FOLDER).cache()
    near = brute.near_duplicates({r.doc_id: r.text for r in one.collect()}, 5)
    assert two.columns == columns and {r.doc_id for r in two.collect()} == {i for i, (_, c) in near.items() if i == c}

    three = named[2](spark, two, FOLDER).cache()
    cut = brute.remove_repeated({r.doc_id: r.text for r in two.collect()}, 50)
    before = {r.doc_id: r.text for r in two.collect()}
    assert three.columns == columns
    for r in three.collect():
        n, gone, _ = cut[r.doc_id]
        assert len(brute.words(r.text)) == n - gone and (gone or r.text == before[r.doc_id])

    four = named[3](spark, three, FOLDER).cache()
    taken = {r.doc_id: r for r in mixing.mix(three).collect()}
    times = {}
    for r in four.collect():
        times[r.doc_id] = times.get(r.doc_id, 0) + 1
    assert four.columns == columns
    assert times == {i: int(r.taken / r.size + 0.5) for i, r in taken.items() if r["size"] and r.taken * 2 >= r["size"]}

    five = named[4](spark, four.dropDuplicates(["doc_id"]), FOLDER)
    used, least = check_packing(five.collect(), {r.doc_id: r.text for r in four.collect()}, 1024)
    assert used <= least * 1.05 + 2


def test_rows_of_one_id_keep_their_own_text(spark):
    passage, other = [" ".join(f"{c}{i}" for i in range(60)) for c in "ab"]
    rows = [(1, passage), (2, f"head\t {passage}  tail"), (2, other), (2, f"x \n{passage}"), (3, "\x0b few\r\nwords ")]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    got = corpus_pipeline.remove_repeated_passages(spark, docs, FOLDER).collect()
    want = [(1, passage), (2, "head tail"), (2, other), (2, "x"), (3, "\x0b few\r\nwords ")]
    assert sorted((r.doc_id, r.text) for r in got) == sorted(want)
    assert all(r.n_chars == len(r.text) for r in got)


def test_near_duplicates_of_rows_that_share_an_id(spark):
    """An id with a copy of another text and a text of its own loses the copy only; of repeated rows one stays."""
    base = [f"w{i}" for i in range(80)]
    a, near_a = " ".join(base), " ".join([*base[:79], "other"])
    b, c = (" ".join(f"{x}{i}" for i in range(60)) for x in "bc")
    near_c = f"{c} more"
    rows = [(1, a), (2, near_a), (2, b), (3, c), (3, c), (3, near_c), (4, c), (5, None), (5, " \n"), (6, "x"), (6, "x"), (6, ""), (None, a), (None, a)]
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    got = [(r.doc_id, r.text) for r in corpus_pipeline.drop_near_duplicates(spark, docs.withColumn("mark", F.lit("clash")), FOLDER).collect()]
    three = [x for x in got if x[0] == 3]
    assert len(three) == 1 and three[0][1] in (c, near_c)
    want = [(1, a), (2, b), (5, None), (5, " \n"), (6, "x"), (6, ""), (None, a), (None, a)]
    assert sorted((x for x in got if x[0] != 3), key=str) == sorted(want, key=str)


def test_run_is_the_stages(spark):
    rows = corpus_pipeline.run(spark, FOLDER)
    assert rows.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    assert rows.count() == rows.select("sequence_id", "offset").distinct().count() > 0
