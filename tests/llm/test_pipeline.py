import corpus_pipeline
import pytest
from pyspark.sql import functions as F

from millrace.llm import exact, neardup, quality, secrets


@pytest.fixture(scope="module")
def made(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    out = [docs]
    for name, apply in corpus_pipeline.STAGES:
        path = f"{corpus_pipeline.stage(apply(spark, out[-1], sf), 'test').inputFiles()[0].rsplit('/', 1)[0]}"
        out.append(spark.read.parquet(path))
    return out


def ids(df):
    return {r["doc_id"] for r in df.select("doc_id").collect()}


def test_columns(made):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality rules", "exact dedup", "MinHash near-dedup", "secret scans", "best-fit packing"]
    assert all(df.dtypes == made[0].dtypes for df in made[1:5])


def test_quality(made):
    kept = quality.judge(made[0]).filter("kept")
    assert ids(made[1]) == ids(kept) and made[1].count() < made[0].count()


def test_exact(made):
    assert ids(made[2]) == ids(exact.mark_copies(made[1]).filter("kept"))
    assert made[2].select("text").distinct().count() == made[2].count()


def test_near(made):
    assert ids(made[3]) == ids(neardup.classes(made[2]).filter("class_id = doc_id"))


def test_secrets(made, spark):
    forest, known = secrets.trained(made[3])
    assert ids(made[4]) == ids(made[3])
    assert secrets.scan(made[4], forest, known).filter("is_secret").count() == 0
    found = secrets.scan(made[3], forest, known).filter("is_secret").select("doc_id")
    assert ids(made[4].filter(F.col("text").contains(secrets.MASK))) == ids(found)


def test_packing(made):
    assert ids(made[5]) == ids(made[4])
    used = made[5].groupBy("sequence_id").agg(F.sum("length").alias("n"), F.max(F.col("offset") + F.col("length")).alias("end"))
    assert used.filter("n != end or n > 1024").count() == 0


def test_run(spark, sf, made):
    got = corpus_pipeline.run(spark, sf)
    assert got.count() == made[5].count() and ids(got) == ids(made[5])
