"""What parsing a line costs, seen in plans, and values of odd shapes."""

import json

import pytest
from pyspark.sql import functions as F

from entitymart.plans.catalog import bootstrap
from entitymart.sources.dump import decode, triage


def optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_triage_binds_no_targets_in_arrays(spark):
    """Targets of the rules are columns: the step that classifies holds no look into a variant."""
    rows = triage(spark.createDataFrame([("f", "{}")], "file string, value string"))
    plan = optimized(rows.select("verdict", "status"))
    assert not [step for step in plan.splitlines() if "variant_get" in step and "AS verdict" in step]


@pytest.mark.parametrize("text, want", [
    ('{"id":"Q1","type":"item"},', "Q1"), ('{"id":"Q1","type":"item"}', "Q1"), ('  {"id":"Q1","type":"item"}, ', "Q1"), ('{"id":"Q1","type":"item"},,', "Q1"),
    ('{"id":"Q1"', None), (",", None), ("{},", None),
])
def test_ends_of_lines(spark, text, want):
    row = decode(spark.createDataFrame([("f", text)], "file string, value string")).select("kind", "entity.id", "entity.broken").first()
    assert row.kind == "entity" and (row.id if row.broken is None else None) == want


def snak(value):
    return {"mainsnak": {"snaktype": "value", "datavalue": {"value": value}}}


NONE = {"mainsnak": {"snaktype": "novalue"}}


@pytest.mark.parametrize("claims, want", [
    ({"P577": [NONE, snak("x"), snak({"time": "+1999-05-00T00:00:00Z", "precision": 10}), snak({"time": "+2001-01-02T00:00:00Z"})]}, ("1999-05-01", None, None)),
    ({"P577": [snak({"time": "++1999-05-01T00:00:00Z"})]}, (None, None, None)),
    ({"P577": [snak({"time": "1999-05-01"})]}, ("1999-05-01", None, None)),
    ({"P577": [], "P264": [NONE, snak({"id": ""}), snak({"id": "QL1"}), snak({"id": "QL2"})]}, (None, "QL1", None)),
    ({"P2047": [NONE, snak("5"), snak({"amount": "+7", "unit": "Q7727"}), snak({"amount": "++8", "unit": "x/Q11574"}), snak({"amount": "9"})]}, (None, None, 8)),
    ({"P2047": [snak({"amount": "1.5"}), snak({"amount": 12})]}, (None, None, 12)),
])
def test_first_good_claim_counts(spark, claims, want):
    line = json.dumps({"id": "Q1", "type": "item", "claims": {"P31": [snak({"id": "Q482994"})]} | claims})
    found = bootstrap(spark.createDataFrame([("f", line)], "file string, value string")).found
    assert tuple(found.select(F.col("release_date").cast("string"), "record_label_qid", "duration_seconds").first()) == want
