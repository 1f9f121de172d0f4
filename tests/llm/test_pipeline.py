"""The stages on awkward rows, and the registered queries against their SQL."""

import os

import pytest
from pyspark.sql import functions as F
from helpers import awkward, frame

import compare
import corpus_pipeline
from perron.llm.queries import ORACLE, QUERIES

FOLDER = os.environ.get("PERRON_TEST_SF_DIR", "/root/testdata/sf0.01")


@pytest.mark.parametrize("rows", [awkward(), []], ids=["awkward", "empty"])
def test_stages(spark, tmp_path, rows):
    docs = frame(spark, rows).withColumns({"a.b": F.lit(1), "__mix_key": F.lit("x"), "c0": F.lit(2.0), "text.raw": F.lit("y")})
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    at, counts = spark.read.parquet(str(tmp_path / "documents.parquet")), []
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, at, str(tmp_path)).write.parquet(str(tmp_path / name))
        at = spark.read.parquet(str(tmp_path / name))
        if name != "sequence_packing":
            assert at.columns == docs.columns
        counts.append(at.count())
    assert counts[0] >= counts[1] >= counts[2]
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == counts[-1]
    assert bool(counts[-1]) == bool(rows)


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no check tables")
@pytest.mark.parametrize("name", ORACLE)
def test_query(spark, name):
    assert compare.compare(name, QUERIES[name](spark, FOLDER), compare.connect(FOLDER), ORACLE[name]) is None


def test_every_operator_has_a_query():
    assert [int(n[2:].split("_")[0]) for n in sorted(QUERIES, key=lambda n: int(n[2:].split("_")[0]))] == list(range(1, 14))
