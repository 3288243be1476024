"""tools/plan_report.py reads AQE's final plan after a query has run."""

import contextlib
import io
import os
import sys

from .conftest import ROOT, SF_SMALL

sys.path.insert(0, os.path.join(ROOT, "tools"))


def _final_plan(df) -> str:
    df.collect()
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def test_summarise_final_plan(spark):
    from plan_report import summarise

    import __spark_entry__ as E

    plan = _final_plan(E.queries()["distinct_rollup_lineitem"](spark, SF_SMALL))
    assert "isFinalPlan=true" in plan
    s = summarise(plan)
    assert len(s["exchanges"]) == 2  # (keys, id) then keys: the two-level distinct count
    assert s["codegen_stages"] >= 1
    assert s["python"] == []
    assert [sc["read"] for sc in s["scans"]] == [
        "struct<l_orderkey:bigint,l_returnflag:string,l_linestatus:string>"
    ]


def test_summarise_reports_join_strategy(spark):
    from plan_report import summarise

    import __spark_entry__ as E

    s = summarise(_final_plan(E.queries()["null_default"](spark, SF_SMALL)))
    assert len(s["joins"]) == 1
    assert s["joins"][0].split()[0] in ("BroadcastHashJoin", "SortMergeJoin", "ShuffledHashJoin")
    assert len(s["scans"]) == 2
