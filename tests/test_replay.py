"""Spark results against a record-by-record Python replay of the rules."""

import pytest

from rivulet.plans import catalog as C, fixtures as FX

from replay import replay_dims, replay_visitor

SF = ["/root/testdata/sf0.001", "/root/testdata/sf0.01"]


@pytest.mark.parametrize("sf", SF)
def test_visitor_fix_equals_replay(spark, sf):
    lines = [tuple(r) for r in FX.log_lines(spark, sf).collect()]
    want = replay_visitor(lines)
    got = {r.seq: (r.mid, r.is_new_in, r.visit_date, r.first_visit, r.is_new)
           for r in C.visitor_fix(spark, sf).collect()}
    assert got == want


@pytest.mark.parametrize("sf", SF)
def test_dim_current_equals_replay(spark, sf):
    cfg = [tuple(r) for r in FX.config_lines(spark, sf).collect()]
    chg = [tuple(r) for r in FX.change_lines(spark, sf).collect()]
    want = replay_dims(cfg, chg)
    got = sorted(tuple(r) for r in C.dim_current(spark, sf).collect())
    assert got == want
