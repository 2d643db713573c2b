"""Two forms of the same computation must agree: the one-scan parameter
switches vs. their per-member union, and the fully lazy pipeline vs. the
layered one."""

from lapsewise.operators import bi as B
from lapsewise.plans.pipeline import lazy_model, materialize

from .conftest import SF001


def same(a, b):
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_one_scan_switches_equal_union_form(spark):
    m = materialize(spark, SF001)
    bi = B.bi_policies(m.policies, m["channels"], m["products"])
    assert same(B.lapse_by_policy_segment_all(bi),
                B.each_choice(B.lapse_by_policy_segment, bi, B.POLICY_SEGMENTS))
    assert same(B.lapse_by_customer_segment_all(m.customers),
                B.each_choice(B.lapse_by_customer_segment, m.customers, B.CUSTOMER_SEGMENTS))
    assert same(B.product_measure_all(bi), B.each_choice(B.product_measure, bi, B.PRODUCT_MEASURES))


def test_lazy_pipeline_equals_layered(spark):
    lazy = lazy_model(spark, SF001)
    layered = materialize(spark, SF001)
    assert same(lazy.policies, layered.policies)
    assert same(lazy.customers, layered.customers)


def test_dashboard_bundles_run(spark):
    m = materialize(spark, SF001)
    bi = B.bi_policies(m.policies, m["channels"], m["products"])
    from lapsewise.plans.queries import AS_OF
    sizes = {}
    for name in ("Executive", "Retention", "Financial"):
        tables = B.dashboard_tables(name, bi, m.policies, m.customers, m.events, AS_OF)
        assert len(tables) == 5
        sizes[name] = {k: v.count() for k, v in tables.items()}
        assert all(n > 0 for n in sizes[name].values()), sizes[name]
    assert sizes["Executive"]["kpis"] == 4 and sizes["Financial"]["kpis"] == 4 and sizes["Retention"]["kpis"] == 4
