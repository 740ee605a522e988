"""The derived corpus moves texts once."""

import datetime as dt

from comparo.sources import fixtures as fx


def tables(spark, folder):
    spark.createDataFrame([(i, f"word{i} x", "brand", 10.0 * i) for i in range(6)],
                          "p_partkey long, p_name string, p_brand string, p_retailprice double").write.parquet(f"{folder}/part.parquet")
    spark.createDataFrame([(i, dt.datetime(2001, 1, 1 + i)) for i in range(3)],
                          "o_orderkey long, o_orderdate timestamp").write.parquet(f"{folder}/orders.parquet")
    spark.createDataFrame([(i % 3, i) for i in range(6)],
                          "l_orderkey long, l_partkey long").write.parquet(f"{folder}/lineitem.parquet")
    # a repeated id: its description is there twice, with each vector
    spark.createDataFrame([(i, f"text {i}") for i in range(8)],
                          "doc_id long, text string").write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(0, [1.0]), (1, [2.0]), (1, [3.0])],
                          "vec_id long, embedding array<float>").write.parquet(f"{folder}/embeddings.parquet")


def test_rows_meet_their_vectors_before_their_texts(spark, tmp_path):
    tables(spark, str(tmp_path))
    corpus = fx.corpus(spark, str(tmp_path))
    joins = [line for line in corpus._jdf.queryExecution().optimizedPlan().toString().split("\n") if "Join LeftOuter" in line]
    assert "text_key" in joins[0] and "embedding_key" in joins[1]
    got = sorted((r.dk, r.desc_index, r.document.split("Description: ")[1], r.embedding) for r in corpus.collect())
    want = [(k, d, f"text {(2 * k + d - 1) % 8}", v) for k in range(6) for d in (1, 2)
            for v in ({0: [[1.0]], 1: [[2.0], [3.0]], 2: [None]}[(2 * k + d - 1) % 3])]
    assert got == sorted(want, key=lambda r: (r[0], r[1], r[2], r[3] or []))


def test_an_upsert_works_its_new_rows_out_once(spark, tmp_path):
    from comparo.registry import QUERIES
    tables(spark, str(tmp_path))
    out = QUERIES["upsert_corpus"](spark, str(tmp_path))
    scans = [x for x in out._jdf.queryExecution().optimizedPlan().toString().split("\n") if "Relation [doc_id" in x]
    assert len(scans) == 1 and out.count() > 0  # the stored rows' texts


def test_descriptions_are_taken_from_a_corpus_without_vectors(spark, tmp_path):
    from comparo.registry import QUERIES
    tables(spark, str(tmp_path))
    out = QUERIES["extract_description"](spark, str(tmp_path))
    (folder,) = {f.rsplit("/", 1)[0] for f in out.inputFiles() if "/corpus-" in f}
    assert "embedding" not in spark.read.parquet(folder).columns
    assert out.where("description LIKE 'text %'").count() > 0
