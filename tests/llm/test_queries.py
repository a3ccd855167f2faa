import pytest

from adloom.llm import queries


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_runs(spark, data, name):
    df = queries.QUERIES[name](spark, data)
    rows = df.collect()
    if name in ("p1_found", "p7_found", "p10_scores"):
        assert rows
    if name == "p8_ids":
        assert len(rows) == spark.read.parquet(f"{data}/documents.parquet").count()
