"""The scoring query scales every feature that its model reads."""

from __future__ import annotations

from seriesmill.operators import scale
from seriesmill.registry import learning

SF = "/root/testdata/sf0.001"


def test_all_features_are_scaled(spark, monkeypatch):
    fitted = []

    def noted(rows, names):
        fitted.extend(names)
        return kept(rows, names)

    kept = scale.fit_scaler
    monkeypatch.setattr(scale, "fit_scaler", noted)
    rows = learning.score_series(spark, SF).collect()
    assert {"l_quantity_roll_mean_5", "l_tax_delta", *learning.LINES.sensors} == set(fitted)
    assert sum(r.n for r in rows) > 0
