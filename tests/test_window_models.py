"""Models per window against single fits, and their place in the walk-forward."""

import datetime as dt

import numpy as np
import pandas as pd
import pytest

from tapewire.operators import boosting as bo, window_models as wm
from tapewire.operators.timeseries import PRICE_FEATURES

FIRST = dt.date(2020, 1, 1)


def drawn(tickers=9, days=120, ahead=5):
    rng = np.random.default_rng(6)
    rows = []
    for t in range(tickers):
        for d in range(days):
            x = np.round(rng.normal(size=len(PRICE_FEATURES)), 3).tolist()
            end = FIRST + dt.timedelta(d + ahead) if d + ahead < days else None
            gain = float(x[0] + rng.normal(0, 0.2)) if end else None
            rows.append((f"t{t}", FIRST + dt.timedelta(d), *x, gain, end))
    return rows


def frames(spark, rows):
    columns = ", ".join(f"{c} double" for c in PRICE_FEATURES)
    features = spark.createDataFrame(rows, f"ticker string, dt date, {columns}, forward_return double, target_end_date date")
    cuts = [FIRST + dt.timedelta(d) for d in (3, 60, 100)]
    return features, spark.createDataFrame([(i + 1, c) for i, c in enumerate(cuts)], "window_id long, cutoff date"), cuts


def test_scores_equal_single_fits(spark, monkeypatch):
    monkeypatch.setattr(wm, "LEAST_ROWS", 100)
    monkeypatch.setattr(wm, "LEAST_JUDGED", 20)
    rows = drawn()
    features, cutoffs, cuts = frames(spark, rows)
    model = bo.Boost(20, 0.1, 3, 5, l2=1.0)
    got = wm.window_scores(features, cutoffs, model).toPandas()
    assert sorted(got["window_id"].unique()) == [2, 3]  # the first window knows no target yet
    table = pd.DataFrame(rows, columns=["ticker", "dt", *PRICE_FEATURES, "ret", "end"])
    by_day = table.groupby("dt")
    for c in PRICE_FEATURES:
        table[c] = (table[c] - by_day[c].transform("mean")) / by_day[c].transform("std")
    table["pct"] = by_day["ret"].rank(pct=True)
    for window, cutoff in enumerate(cuts[1:], 2):
        known = table[table["end"].notna() & (table["end"].apply(lambda e: e is not None and e <= cutoff))].copy()
        known["key"] = known["ticker"] + " " + known["dt"].astype(str)
        known = known.sort_values("key")
        days = sorted(known["dt"].unique())
        split = days[int(len(days) * 0.8)]
        mine = got[got["window_id"] == window].set_index("ticker")
        assert set(mine["n_rows"]) == {len(known)}

        def fitted(part):
            return bo.fit(part[PRICE_FEATURES].to_numpy(), part["pct"].to_numpy(), np.ones(len(part)), model)

        late = known[known["dt"] > split].copy()
        late["score"] = bo.staged(fitted(known[known["dt"] <= split]), late[PRICE_FEATURES].to_numpy(), [20])[:, 0]
        ics = [g["score"].rank().corr(g["ret"].rank()) for _, g in late.groupby("dt")]
        assert np.allclose(mine["ic"], np.mean(ics), atol=1e-9) and np.mean(ics) > 0.5
        latest = table[table["dt"] == cutoff].set_index("ticker")
        want = bo.staged(fitted(known), latest[PRICE_FEATURES].to_numpy(), [20])[:, 0]
        assert np.allclose(mine.loc[latest.index, "score"], want, atol=1e-9)


def test_small_panels_have_no_model(spark):
    features, cutoffs, _ = frames(spark, drawn(days=30))
    assert wm.window_scores(features, cutoffs, bo.Boost(2)).count() == 0
    assert wm.window_scores(features.limit(0), cutoffs, bo.Boost(2)).count() == 0


def test_a_bounded_window_is_fitted_on_fewer_rows(spark, monkeypatch):
    monkeypatch.setattr(wm, "LEAST_ROWS", 100)
    monkeypatch.setattr(wm, "LEAST_JUDGED", 20)
    features, cutoffs, _ = frames(spark, drawn())
    got = wm.window_scores(features, cutoffs, bo.Boost(5, 0.1, 2), window_rows=60)
    assert got.groupBy("window_id").count().count() == 2 and got.where("n_rows > 60").count() == got.count()


@pytest.mark.parametrize("l2", [0.0, 3.0])
def test_shrinkage_of_leaves(l2):
    x, y = np.array([[0.0], [0.0], [1.0], [1.0]]), np.array([0.0, 2.0, 4.0, 6.0])
    model = bo.fit(x, y, np.ones(4), bo.Boost(1, 1.0, 1, l2=l2))
    want = 3 + np.array([-4.0, 4.0]) / (2 + l2)
    assert np.allclose(bo.staged(model, np.array([[0.0], [1.0]]), [1])[:, 0], want)
