"""The pipeline on native-format Parquet with string ids (the production input contract)."""

import tempfile

import pytest
from pyspark.sql import functions as F

from driver_data import SF001
from riskmart import pipeline
from riskmart.snapshots import read_published
from riskmart.sources import fixtures
from riskmart.sources.readers import WrongSourceError, read_sources
from riskmart.sources.schemas import column_names

ID_COLS = {"customer_id": "c-", "contract_id": "k-", "payment_id": "p-", "event_id": "e-", "proposal_id": "q-",
           "collection_id": "p-"}


def test_pipeline_from_native_files_with_string_ids(spark):
    src = tempfile.mkdtemp(prefix="riskmart-native-")
    for name, df in fixtures.fixture_sources(spark, SF001).items():
        for col, prefix in ID_COLS.items():
            if col in df.columns:
                df = df.withColumn(col, F.concat(F.lit(prefix), F.col(col).cast("string")))
        df.select(*column_names(name)).write.parquet(f"{src}/{name}.parquet")
    out = tempfile.mkdtemp(prefix="riskmart-native-out-")
    res = pipeline.run(spark, out, src_dir=src, as_of=fixtures.AS_OF)
    assert all(r["failures"] == 0 for r in res.checks.collect())
    score = read_published(spark, out, "marts", "fct_credit_score")
    assert dict(score.dtypes)["customer_id"] == "string"
    # scores do not depend on the id type (percentile ranks ignore the tie-break key)
    ref_out = tempfile.mkdtemp(prefix="riskmart-native-ref-")
    pipeline.run(spark, ref_out, sources=fixtures.fixture_sources(spark, SF001), as_of=fixtures.AS_OF, gate=False)
    ref = read_published(spark, ref_out, "marts", "fct_credit_score").select(
        F.concat(F.lit("c-"), F.col("customer_id").cast("string")).alias("customer_id"), "credit_score", "risk_tier")
    diff = score.select("customer_id", "credit_score", "risk_tier").exceptAll(ref)
    assert diff.count() == 0 and score.count() == ref.count()
    segs = read_published(spark, out, "marts", "fct_risk_segments")
    assert segs.select("r_score", "f_score", "m_score").agg(F.min("r_score"), F.max("m_score")).first() == (1, 4)


def test_wrongly_typed_and_incomplete_files_are_refused(spark):
    src = tempfile.mkdtemp(prefix="riskmart-wrong-")
    people = fixtures.fixture_sources(spark, SF001)["customers"].select(*column_names("customers"))
    people.withColumn("income_declared", F.lit("a lot")).drop("city").write.parquet(f"{src}/customers.parquet")
    with pytest.raises(WrongSourceError, match="city is missing.*income_declared is string|income_declared is string.*city"):
        read_sources(spark, src, ["customers"])
    people.withColumn("birth_date", F.col("birth_date").cast("timestamp")).write.parquet(f"{src}/ok/customers.parquet")
    assert read_sources(spark, f"{src}/ok", ["customers"])["customers"].columns == column_names("customers")
