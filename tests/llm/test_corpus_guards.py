"""Partition independence of the corpus queries that have SQL, and the native plan of op2."""

from __future__ import annotations

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.join(ROOT, "tools"))
sys.path.insert(0, ROOT)

from plan_audit import plan_text, summarise  # noqa: E402
from riskweave.llm import quality  # noqa: E402
from riskweave.llm.oracle import LLM_ORACLE  # noqa: E402
from riskweave.llm.queries import llm_queries  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(LLM_ORACLE))
def test_rows_do_not_depend_on_the_number_of_partitions(spark, name):
    seen = []
    old = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for n in ("1", "7"):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            seen.append(sorted(map(repr, llm_queries()[name](spark, SF).collect())))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert seen[0] == seen[1] and seen[0]


def test_quality_rules_have_no_python_in_their_plans(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    # the counted table is written first, so the query's own plan begins at its files
    for df in (quality.base_counts(docs, "doc_id", "source", "text"), llm_queries()["op2_quality_rules"](spark, SF)):
        s = summarise(plan_text(df))
        assert s["python"] == 0 and s["cartesian"] == 0
