"""Physical-plan guards for the registered queries (smallest tables)."""

import contextlib
import io
import re

import pytest

import __spark_entry__ as E
from conftest import SF_SMALL

# The training-data queries have plan tests of their own, beside their operators.
# Parameter grids fit a model a dozen times and return the driver's few rows.
GRIDS = {"als_grid", "als_best_params"}
QUERIES = sorted(q for q in E.queries() if not q.startswith("op") and q != "pipeline" and q not in GRIDS)
TOP_K = ["itemcf_similarity_top10", "user_recent_ratings", "candidate_products", "top_k_per_user"]


def _plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


@pytest.mark.parametrize("name", QUERIES)
def test_no_cross_join_and_no_row_udf(spark, name):
    plan = _plan(E.queries()[name](spark, SF_SMALL))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython"):
        assert bad not in plan, f"{name}: {bad}"


@pytest.mark.parametrize("name", TOP_K)
def test_top_k_is_limited_before_the_shuffle(spark, name):
    plan = _plan(E.queries()[name](spark, SF_SMALL))
    assert "WindowGroupLimit" in plan


def test_statistics_scan_is_pruned(spark):
    plan = _plan(E.queries()["rate_more_products"](spark, SF_SMALL))
    schemas = re.findall(r"ReadSchema: (struct<[^\n]*>)", plan)
    assert schemas and all("l_extendedprice" not in s and "o_totalprice" not in s for s in schemas)
