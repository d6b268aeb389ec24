from __future__ import annotations

import json

from samples import AS_OF

from skyledger.operators import audit
from skyledger.schemas import AUDIT_COLUMNS, RUN_SUMMARY_DDL, column_names


def reasons(spark, *labels):
    return spark.createDataFrame([(label,) for label in labels], "quarantine_reason string")


def test_breakdown_is_a_json_object(spark):
    rows = reasons(spark, "api_error", None, "null_city", "api_error", None)
    text = audit.breakdown_json(rows).first()[0]
    assert json.loads(text) == {"api_error": 2, "null_city": 1}


def test_run_summary_counts_once(spark):
    rows = reasons(spark, *["api_error"] * 2, *[None] * 8)
    summary = audit.run_summary(rows, AS_OF)
    assert summary.columns == column_names(RUN_SUMMARY_DDL)
    assert [tuple(r)[1:] for r in summary.collect()] == [(10, 8, 2, '{"api_error":2}')]
    assert str(summary.first().run_timestamp) == AS_OF


def test_audit_row(spark):
    log = audit.audit_row(reasons(spark, "a", None, None), AS_OF)
    assert log.columns == AUDIT_COLUMNS
    assert tuple(log.first())[1:] == (3, 2, 1)


def test_nothing_read_gives_zeros(spark):
    assert tuple(audit.run_summary(reasons(spark), AS_OF).first())[1:] == (0, 0, 0, "{}")
    assert tuple(audit.audit_row(reasons(spark), AS_OF).first())[1:] == (0, 0, 0)
