"""``build_layers`` with ``only_wanted``: what it writes, and that the layers are the same."""

from __future__ import annotations

import pytest

from lakeward import config as C
from lakeward.plans.build import build_layers
from lakeward.sources.batches import read_batches
from lakeward.sources.layout import read_layer


@pytest.mark.parametrize("wanted,written", [
    ((C.LATEST, C.GOLD_CUSTOMER), {C.LATEST, C.GOLD_CUSTOMER}),
    ((C.GOLD_DAILY, C.GOLD_CUSTOMER), {C.LATEST, C.GOLD_DAILY, C.GOLD_CUSTOMER}),
    ((C.BRONZE, C.LATEST), {C.BRONZE, C.LATEST}),
    (C.LAYERS, set(C.LAYERS)),
])
def test_only_wanted_layers_are_written(spark, golden_dir, tmp_path, wanted, written):
    raw = read_batches(spark, str(golden_dir / "*.csv"))
    paths = build_layers(spark, raw, str(tmp_path / "some"), wanted=wanted, only_wanted=True)
    assert set(paths) == written
    whole = build_layers(spark, raw, str(tmp_path / "all"))
    for layer, path in paths.items():
        rows, same = read_layer(spark, path), read_layer(spark, whole[layer])
        assert rows.schema == same.schema and rows.count() > 0
        assert rows.exceptAll(same).count() == 0 and same.exceptAll(rows).count() == 0


def test_upstream_layers_are_written_unless_told(spark, golden_dir, tmp_path):
    raw = read_batches(spark, str(golden_dir / "*.csv"))
    assert set(build_layers(spark, raw, str(tmp_path), wanted=(C.LATEST,))) == {C.BRONZE, C.SILVER, C.LATEST}
