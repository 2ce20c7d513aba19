"""Steps that several parts of a query read are computed once."""

from __future__ import annotations

from collections import Counter

import pytest

from linkwatch.plans import catalog

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ["export_health", "lifecycle_problems", "csv_roundtrip"])
def test_lifecycle_is_computed_once(spark, monkeypatch, name):
    calls, own, stored = Counter(), catalog.L.lifecycle, catalog.landed

    def lifecycle(*args):
        calls["lifecycle"] += 1
        return own(*args)

    def landed(frame, step):
        calls[step] += 1
        return stored(frame, step)

    monkeypatch.setattr(catalog.L, "lifecycle", lifecycle)
    monkeypatch.setattr(catalog, "landed", landed)
    df = catalog.QUERIES[name](spark, FOLDER)
    assert calls["lifecycle"] == 1 and calls["transitions"] == 1
    assert calls["dead-letters"] == (name != "lifecycle_problems")
    assert df.count()
