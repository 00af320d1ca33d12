import pathlib

import corpus_pipeline
import duckdb
import pytest
from cases import documents, sentence
from check import TABLES, canonical
from pyspark.sql import functions as F

from millrace.llm import queries
from millrace.session import scratch_root


def write(spark, folder, rows):
    docs = documents(spark, rows).select("doc_id", "text", "lang", F.lit("s").alias("source"), F.length("text").alias("n_chars"))
    docs.write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(i, 1, 0) for i, _ in rows if i % 2 == 0], "doc_id long, quality int, toxic int").write.parquet(
        f"{folder}/labels.parquet")
    spark.createDataFrame([(1, sentence(2, 60))], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")


def test_stages(spark, tmp_path):
    clean = [(k, sentence(k + 10, 120)) for k in range(60)]
    near = clean[0][1].split()
    near[50] = "changed"
    rows = [*clean, (100, clean[0][1]), (101, " ".join(near)), (102, f"{sentence(300, 80)} {sentence(2, 60)}"),
            (103, sentence(2, 60)), (104, ""), (105, None)]
    write(spark, tmp_path, rows)
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    columns, ids = docs.columns, []
    for number, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, str(tmp_path)).write.parquet(f"{tmp_path}/out{number}")
        docs = spark.read.parquet(f"{tmp_path}/out{number}")
        ids.append({r.doc_id for r in docs.select("doc_id").collect()})
        assert number == len(corpus_pipeline.STAGES) - 1 or docs.columns == columns
    wanted = set(range(60)) | {102}
    assert wanted <= ids[0] and not ids[0] & {104, 105}
    assert wanted <= ids[1] and not ids[1] & {100, 101}
    assert wanted <= ids[2] and 103 not in ids[2]
    assert wanted <= ids[3] and ids[4] == ids[3]
    text = spark.read.parquet(f"{tmp_path}/out2").filter("doc_id = 102").first()
    assert sentence(2, 60) not in text.text and text.n_chars == len(text.text)


def test_stages_leave_only_the_ids_that_their_results_read(spark, tmp_path):
    write(spark, tmp_path, [(k, sentence(k % 8 + 10, 60)) for k in range(30)])
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    staged = pathlib.Path(scratch_root(spark).removeprefix("file:")) / "staged" / spark.sparkContext.applicationId
    for stage, names in ((corpus_pipeline.drop_poor, ["poor"]), (corpus_pipeline.drop_near_copies, ["kept"]),
                         (corpus_pipeline.mix_domains, [])):
        before = set(staged.iterdir()) if staged.exists() else set()
        found = stage(spark, docs, str(tmp_path))
        assert [p.name.split("-")[0] for p in set(staged.iterdir()) - before] == names
        assert found.count() <= 30


def test_registration():
    names = queries.queries()
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))
    assert set(queries.oracle_sql()) <= set(names)
    assert corpus_pipeline.ORACLE_SQL is None and len(corpus_pipeline.STAGES) == 5


@pytest.mark.parametrize("name", sorted(queries.queries()))
def test_queries_on_the_supplied_tables(spark, name):
    sf = "/root/testdata/sf0.001"
    found = queries.queries()[name](spark, sf)
    rows = canonical(found.columns, [tuple(r) for r in found.collect()])
    assert rows and len(set(found.columns)) == len(found.columns)
    if name in queries.oracle_sql():
        db = duckdb.connect()
        for table in TABLES:
            db.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{sf}/{table}.parquet')")
        result = db.execute(queries.oracle_sql()[name])
        assert rows == canonical([c[0] for c in result.description], result.fetchall())
