"""The parameter sweep: rows prepared once, fits side by side, the same models and winner as one after another."""

from __future__ import annotations

import uuid

import pytest

from helpers import SF_SMALL
from churnlens.operators import model as M
from churnlens.plans import model_queries as MQ
from churnlens.plans.workspace import Workspace
from churnlens.session import NAMESPACE_CONF
from churnlens.sources import io as IO

GRID = [M.GBTParams(2, 2, 0.3), M.GBTParams(3, 3, 0.2), M.GBTParams(4, 2, 0.1)]


@pytest.fixture()
def fresh(spark):
    """A scratch namespace of its own: nothing is fitted or stored yet."""
    before = spark.conf.get(NAMESPACE_CONF, None)
    spark.conf.set(NAMESPACE_CONF, "sweep-" + uuid.uuid4().hex[:8])
    yield Workspace(spark, SF_SMALL, materialize=True)
    spark.conf.set(NAMESPACE_CONF, before) if before else spark.conf.unset(NAMESPACE_CONF)
    MQ._CACHE.clear()


def test_parallel_sweep_equals_fits_one_after_another(spark, fresh, monkeypatch):
    MQ._CACHE.clear()
    calls = []
    prepare = M.prepare
    monkeypatch.setattr(M, "prepare", lambda train: calls.append(1) or prepare(train))
    winner = MQ.sweep(fresh, GRID, parallel=3).first()
    assert calls == [1]
    runs = {r["run_name"]: r for r in spark.read.parquet(IO.runs_path(spark, fresh.data_version)).collect()}
    assert set(runs) == {p.run_name for p in GRID}
    frames = MQ.split_frames(fresh)
    for p in GRID:   # the same pipeline fitted alone, from raw rows
        alone = M.evaluate(M.fit(frames["train"], p), frames["validation"]).first()
        assert [runs[p.run_name][m] for m in ("accuracy", "f1_score")] == [alone["accuracy"], alone["f1_score"]]
    best = sorted(runs.values(), key=lambda r: (-r["f1_score"], -r["accuracy"], r["run_name"]))[0]["f1_score"]
    assert runs[winner["run_name"]]["f1_score"] == best
    assert [r["is_default"] for r in M.versions(spark).where("is_default").collect()] == [True]


def test_sweep_again_loads_what_is_fitted(spark, fresh, monkeypatch):
    MQ._CACHE.clear()
    MQ.sweep(fresh, GRID[:2])
    MQ._CACHE.clear()
    monkeypatch.setattr(M, "fit", lambda *a: pytest.fail("fitted again"))
    MQ.sweep(fresh, GRID[:2])
    assert spark.read.parquet(IO.runs_path(spark, fresh.data_version)).count() == 4
