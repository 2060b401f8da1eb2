"""Shapes no registered query may have."""

from __future__ import annotations

import re

import pytest

import __spark_entry__ as entry_point

SF_DIR = "/root/testdata/sf0.01"
# These fit models or stream before they return; their result plans are scans.
SLOW = ("con6", "ml4", "ml5", "ml6", "ml8", "ml9", "ml11", "ml12")
# One range by its counted size, hence one task.
SMALL = ("met5_met6_document_length",)
NAMES = sorted(name for name in entry_point.queries() if not name.startswith(SLOW))


@pytest.mark.parametrize("name", NAMES)
def test_plan(spark, name):
    frame = entry_point.queries()[name](spark, SF_DIR)
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan
    if not name.startswith(("src4", "src5")):
        assert "Python" not in plan and "InPandas" not in plan
    # A window that is not partitioned puts every row into one task.
    for line in plan.splitlines():
        if name not in SMALL and re.search(r"\bWindow \[", line):
            assert not re.search(r"windowspecdefinition\((?!__range)[^,()]+ (ASC|DESC)", line), line
