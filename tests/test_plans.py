"""Plan guards over every registered query: no pair explosions, no Python in the
hot path, no gathering of whole groups, and pushed-down scans."""

import re

import pytest

import __spark_entry__ as entry
from conftest import SF_SMALL
from trackcast import catalog, sinks

FORBIDDEN = {
    "CartesianProduct": "cross join",
    "BroadcastNestedLoopJoin": "nested-loop join",
    "BatchEvalPython": "row-at-a-time Python UDF",
    "ArrowEvalPython": "Python UDF",
    "collect_list": "whole group gathered",
    "collect_set": "whole group gathered",
}

QUERIES = {k: q for k, q in entry.queries().items() if k in catalog.queries()}


def plan_text(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_plan_has_no_forbidden_operator(spark, name, monkeypatch):
    """The query's plan and those of the tables that it writes on the way."""
    plans, write = [], sinks.write_table
    monkeypatch.setattr(sinks, "write_table", lambda df, *a, **k: (plans.append(plan_text(df)), write(df, *a, **k))[1])
    plans.append(plan_text(QUERIES[name](spark, SF_SMALL)))
    found = [why for op, why in FORBIDDEN.items() if any(op in text for text in plans)]
    assert not found, f"{name}: {found}"


@pytest.mark.parametrize("name", ["lookup_exact", "lookup_artist", "lookup_title"])
def test_one_level_is_looked_up_by_its_own_keys(spark, name):
    assert "Expand" not in plan_text(QUERIES[name](spark, SF_SMALL))


def test_a_level_of_the_statistics_reads_its_own_files(spark):
    text = plan_text(QUERIES["score_from_averages"](spark, SF_SMALL))
    for level in ("exact", "artist", "title"):
        assert re.search(rf"PartitionFilters: \[[^\]]*level[^\]]*= {level}", text)


def test_scans_are_pruned_and_filtered(spark):
    text = plan_text(QUERIES["training_matrix"](spark, SF_SMALL))
    schemas = [re.findall(r"(\w+):", s) for s in re.findall(r"ReadSchema: struct<([^>]*)>", text)]
    lineitem = [s for s in schemas if "l_suppkey" in s]
    assert lineitem and all(len(s) <= 6 for s in lineitem), lineitem
    assert "EqualTo(l_returnflag,R)" in text and "EqualTo(l_returnflag,A)" in text


def test_top_terms_is_bounded_topk(spark):
    text = plan_text(QUERIES["top_terms"](spark, SF_SMALL))
    assert "TakeOrderedAndProject" in text
