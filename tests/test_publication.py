"""Versions of the warehouse: what readers see during, after and between builds."""

from __future__ import annotations

import os

import pytest

from lakeward import config as C
from lakeward.plans import build as build_module
from lakeward.plans.build import build_all, build_layers
from lakeward.plans.validate import validate
from lakeward.sources import layout as W
from tests.conftest import GOLDEN_HEADER, write_csv


def bronze_ids(spark, root) -> set[str]:
    return {r["event_id"] for r in W.read_layers(spark, root)[C.BRONZE].collect()}


def test_a_build_that_dies_between_layers_leaves_the_old_version(spark, golden_dir, tmp_path, monkeypatch):
    root, pattern = str(tmp_path / "wh"), str(golden_dir / "*.csv")
    build_all(spark, pattern, root)
    before = W.current_root(spark, root)
    write_csv(golden_dir, "late.csv", GOLDEN_HEADER, ["evt-9,ord-9,cust-9,east,created,1.00,2026-04-22 18:00:00,2026-04-22 18:01:00"])
    write = W.write_layer

    def dies(df, path):
        if C.GOLD_DAILY in path:
            raise RuntimeError("executor lost")
        write(df, path)

    monkeypatch.setattr(W, "write_layer", dies)
    with pytest.raises(RuntimeError):
        build_all(spark, pattern, root)
    monkeypatch.undo()
    assert W.current_root(spark, root) == before and "evt-9" not in bronze_ids(spark, root)
    assert W.missing_layers(spark, root) == []
    assert validate(spark, root).bronze_rows == 11
    build_all(spark, pattern, root)
    assert "evt-9" in bronze_ids(spark, root) and W.current_root(spark, root) != before


def test_old_versions_go_and_open_readers_keep_theirs(spark, golden_dir, tmp_path):
    root, pattern = str(tmp_path / "wh"), str(golden_dir / "*.csv")
    build_all(spark, pattern, root)
    first = W.read_layers(spark, root)
    build_all(spark, pattern, root)
    assert first[C.BRONZE].count() == 11  # the version it resolved is still there
    build_all(spark, pattern, root)
    kept = W.publications(spark, root)[: W.KEPT_VERSIONS]
    assert sorted(os.listdir(os.path.join(root, W.VERSIONS))) == sorted(kept)
    assert bronze_ids(spark, root) == {f"evt-10{i:02d}" for i in range(1, 11)}


def test_a_partial_version_lacks_its_layers_only(spark, golden_dir, tmp_path):
    root = str(tmp_path / "wh")
    raw = build_module.B.read_batches(spark, str(golden_dir / "*.csv"))
    build_layers(spark, raw, root, wanted=(C.SILVER,))
    assert W.missing_layers(spark, root) == [W.layer_paths(root)[x] for x in (C.LATEST, C.GOLD_DAILY, C.GOLD_CUSTOMER)]


def test_plain_roots_are_read_as_they_stand(spark, golden_dir, tmp_path):
    root = str(tmp_path / "wh")
    raw = build_module.B.read_batches(spark, str(golden_dir / "*.csv"))
    W.write_layer(raw, W.layer_paths(root)[C.BRONZE])
    assert W.current_root(spark, root) == root and W.read_layer(spark, W.current_paths(spark, root)[C.BRONZE]).count() == 11


def test_relative_paths_leave_the_version_out(spark, tmp_path):
    version = W.new_version(str(tmp_path))
    assert W.relative_paths(str(tmp_path), W.layer_paths(version)) == C.LAYER_DIRS
    assert W.relative_paths(str(tmp_path), W.layer_paths(str(tmp_path))) == C.LAYER_DIRS
