"""Chained-equation rounds write only their own columns; a matrix of preparations writes its input once."""

import numpy as np

from adlytics import session
from adlytics.catalog import q_train
from adlytics.operators import missing as M
from adlytics.operators import train as L
from adlytics.plans import prep as PP


def test_rounds_write_only_their_columns(spark, monkeypatch):
    rng = np.random.default_rng(2)
    rows = [(i, *(float(x) if (i + j) % 5 else None for j, x in enumerate(rng.normal(0, 1, 3))), *([i % 2] * 20)) for i in range(80)]
    df = spark.createDataFrame(rows, "id long, a double, b double, c double, " + ", ".join(f"f{j} int" for j in range(20)))
    widths, cut = [], session.cut_lineage
    monkeypatch.setattr(session, "cut_lineage", lambda d: widths.append(len(d.columns)) or cut(d))
    out, _ = M.mice_fit_transform(df, ["a", "b", "c"], "id", max_iter=3)
    assert widths and max(widths) <= 9                   # values, flags and the round before
    got = {r.id: r for r in out.collect()}
    assert out.columns == df.columns and len(got) == 80
    for r in rows:
        assert all(x is None or got[r[0]][j] == x for j, x in enumerate(r)) and None not in got[r[0]]


def test_preparations_share_their_input(spark, monkeypatch):
    df = spark.createDataFrame([(1, 0, 1.0, 1)], "doc_id long, y int, X1 double, X4 int")
    seen = []
    monkeypatch.setattr(PP, "fit_prep", lambda d, *a, written=False, **kw: seen.append((id(d), written)) or (d, None))
    assert PP.smoke_report(df, "doc_id", "y", ["X1"], []).filter("passed").count() == 6
    assert len(set(seen)) == 1 and seen[0][1]
    seen.clear()
    monkeypatch.setattr(q_train.T, "doc_wide", lambda *a: df)
    assert q_train.l19(spark, "").filter("status = 'ok'").count() == 6
    assert len(set(seen)) == 1 and seen[0][1]
