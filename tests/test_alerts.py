import json

from millrace.operators import alerts, directory, served
from millrace.tenancy import Tenant
import pytest

LOW = "company_id string, factory_id string, facility string, eff int"


def test_summaries_of_a_hot_tenant(spark, rows, collect):
    df = rows([("A", "A1", "f", i) for i in range(500)] + [("B", "B1", "g", 7)], LOW)
    got = {r["factory_id"]: r for r in collect(alerts.tenant_summaries(df, "low_efficiency", ["eff", "facility"]))}
    assert got["A1"]["row_count"] == 500
    assert [r["eff"] for r in json.loads(got["A1"]["detail_json"])] == list(range(10))
    assert json.loads(got["B1"]["detail_json"]) == [{"eff": 7, "facility": "g"}]


def test_every_anomaly_is_an_event(rows):
    df = rows([("A", "A1", "f", i) for i in range(500)] + [("B", "B1", "g", 7)], LOW)
    assert alerts.alert_events(df, "low_efficiency", ["facility", "eff"]).count() == 501


def test_market_alert_and_recipients(rows, collect):
    subs = rows(
        [("A", "A1", True, "own@a"), ("A", "ALL_FACTORIES", True, "all@a"), ("B", "ALL_FACTORIES", False, "off@b")],
        "company_id string, factory_id string, enabled boolean, notify_email string",
    )
    tenants = rows([("A", "A1"), ("A", "A2"), ("B", "B1")], "company_id string, factory_id string")
    got = {r["factory_id"]: r["notify_email"] for r in collect(alerts.recipients(tenants, subs))}
    assert got == {"A1": "own@a", "A2": "all@a", "B1": None}
    spikes = rows([("M", "x", 3), ("M", "x", 1)], "company_id string, factory_id string, v int")
    out = alerts.market_alert(spikes, "price_spike", ["v"], ["v"], subs)
    assert {(r.factory_id, r.detail_json) for r in out.collect()} == {
        ("A1", '[{"v":1},{"v":3}]'), ("ALL_FACTORIES", '[{"v":1},{"v":3}]'),
    }
    plan = out._jdf.queryExecution().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
    assert alerts.market_alert(spikes.limit(0), "price_spike", ["v"], ["v"], subs).isEmpty()


def test_inbox(rows):
    inbox = rows(
        [(i, "A", "A1", i % 2 == 0, i) for i in range(120)] + [(500, "B", "B1", False, 500)],
        "id int, company_id string, factory_id string, seen boolean, created_at int",
    )
    mine = Tenant("A", "A1")
    assert [r.id for r in alerts.inbox(inbox, mine).take(2)] == [119, 118]
    assert alerts.inbox(inbox, mine).count() == 50 and alerts.inbox(inbox, mine, unseen_only=True).count() == 50
    assert alerts.inbox_counts(inbox).first().asDict() == {"total": 121, "unseen": 61}
    assert alerts.mark_seen(inbox, mine).filter("NOT seen").count() == 1
    assert alerts.mark_seen(inbox, mine, alert_id=1).filter("NOT seen").count() == 60


def test_places_and_ownership(rows):
    df = rows([("Cairo",), ("Multiple",), ("Atlantis",), (None,)], "governorate string")
    ok, bad = directory.known_places(df, "governorate")
    assert (ok.count(), bad.count()) == (2, 2)


def test_price_alert_limit(rows):
    df = rows([], "date date, steel_price_egypt_egp double, price_change_pct double, is_price_spike int")
    with pytest.raises(ValueError):
        served.price_alert_rows(df, 0)
