"""Golden stage and rule counts (FIXTURES.md section 4) at sf0.001 and sf0.01."""

import pytest

from conftest import SF0001, SF001
from notifyq.operators.clean import clean_metrics
from notifyq.operators.validate import rule_counts, validation_report
from notifyq.plans.queries import make_run

GOLDEN = {
    SF0001: dict(dup=10, bad_ts=14, reached=976, bad_seen=9, valid=664, rejected=312,
                 rules={"notification_id_missing": 11, "source_user_id_missing": 12,
                        "event_type_domain": 41, "email_quiet_hours": 98,
                        "follow_high_priority": 43, "sent_app_version_too_old": 15,
                        "comment_id_required": 1, "post_id_required": 13},
                 mean=15347.01, p95=42499.05, sla=85.16),
    SF001: dict(dup=97, bad_ts=148, reached=9755, bad_seen=92, valid=6591, rejected=3164,
                rules={"notification_id_missing": 102, "email_quiet_hours": 1042,
                       "follow_high_priority": 500, "latency_negative": 77},
                mean=14723.60, p95=43805.25, sla=86.97),
}


@pytest.mark.parametrize("sf", [SF0001, SF001])
def test_golden_counts(spark, sf):
    g = GOLDEN[sf]
    run = make_run(spark, sf)
    m = clean_metrics(run.tagged).first()
    assert (m.duplicates, m.bad_timestamps, m.rows_out, m.bad_seen) == (g["dup"], g["bad_ts"], g["reached"], g["bad_seen"])
    r = validation_report(run.tagged).first()
    assert (r.valid, r.rejected) == (g["valid"], g["rejected"])
    counts = {x.rule: x.violations for x in rule_counts(run.tagged).collect()}
    for k, v in g["rules"].items():
        assert counts[k] == v, k
    assert counts["event_id_missing"] == 0 and counts["user_id_missing"] == 0
    kv = run.kpi_values.first()
    assert round(kv.avg_latency_ms, 2) == g["mean"]
    assert round(kv.p95_latency_ms, 2) == g["p95"]
    assert round(kv.sla_compliance_pct, 2) == g["sla"]
    assert kv.completeness_pct == 100.0


def test_valid_plus_rejected_is_input(spark):
    run = make_run(spark, SF0001)
    assert run.valid.count() + run.rejected.count() == run.raw.count()


def test_approximate_p95_is_opt_in_and_close(spark):
    from dataclasses import replace

    run = make_run(spark, SF0001)
    exact = run.kpi_values.first().p95_latency_ms
    approx = replace(run, approximate_p95=True).kpi_values.first().p95_latency_ms
    assert exact == 42499.05 or round(exact, 2) == 42499.05
    assert abs(approx - exact) / exact < 0.01
