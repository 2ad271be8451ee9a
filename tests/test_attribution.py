"""The attribution queries explain every row of every series."""

from __future__ import annotations

from pathlib import Path

import pytest

from airpanel.catalog import modelling
from airpanel.catalog.base import Tables
from airpanel.schemas import SERIES

DATA = "/root/testdata/sf0.01"

pytestmark = pytest.mark.skipif(not Path(DATA).exists(), reason="test tables are absent")


def test_attributions_take_every_row(spark, monkeypatch):
    seen = {}
    for name in ("linear_attribution", "tree_attribution"):
        def counted(rows, *args, _real=getattr(modelling.explain, name), _name=name, **options):
            seen[_name] = rows.count()
            return _real(rows, *args, **options)

        monkeypatch.setattr(modelling.explain, name, counted)
    t = Tables(spark, DATA)
    rows = modelling.long_rows(t, [24])
    found, _ = modelling.l2(t).collect(), modelling.l3_attribution(t)
    assert rows.count() > 1500 and seen["linear_attribution"] == rows.count()
    assert seen["tree_attribution"] == modelling.long_rows(t).count()
    assert {r[SERIES] for r in found} == {r[SERIES] for r in rows.select(SERIES).distinct().collect()}
