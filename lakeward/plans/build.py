"""Full rebuild: contract gate, then five layers, each written and read back.

Writing each layer and reading it back cuts the lineage (a lost executor
recomputes from the last written layer, not from the raw CSV), and lets the
next step's filters and column pruning reach a Parquet scan. Shuffles: one
for dedupe (``event_id``), one for latest state (``order_id``), and the two
small partial/final aggregations of gold. The first two go in a few passes over shares of the keys
where the layer above is large, and shuffle files are deleted with each write: so the disk holds
the layers and one pass's shuffle.

All layers of a run, and the ledger of its input files, go to a version of their own that is
published once it is whole (``sources.layout``).
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Collection, Sequence
from contextlib import nullcontext
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession

from lakeward import config as C
from lakeward.config import DEFAULT, Settings
from lakeward.operators import contract as CT
from lakeward.operators import layers as L
from lakeward.operators import quality as Q
from lakeward.sources import batches as B
from lakeward.sources import layout as W


# layer -> the layer it is made from
UPSTREAM: dict[str, str] = {C.SILVER: C.BRONZE, C.LATEST: C.SILVER, C.GOLD_DAILY: C.LATEST, C.GOLD_CUSTOMER: C.LATEST}
# layers whose rows are sorted by key before the shuffle, with that key
SORTED: dict[str, str] = {C.SILVER: "event_id", C.LATEST: "order_id"}


def build_layers(spark: SparkSession, raw: DataFrame, output_root: str, settings: Settings = DEFAULT,
                 wanted: Collection[str] = C.LAYERS, ledger: DataFrame | None = None,
                 observed: dict[str, object] | None = None, only_wanted: bool = False) -> dict[str, str]:
    """Bronze -> silver -> latest -> gold from an already-gated raw frame: the wanted
    layers and those they are made from, published together. Returns layer -> path.
    ``observed`` gets the metrics of each layer that its write sees anyway. With ``only_wanted`` a layer that
    isn't wanted and that one other is made from is derived as that one is written."""
    needed = set(wanted)
    for layer in reversed(C.LAYERS):
        if layer in needed and layer in UPSTREAM:
            needed.add(UPSTREAM[layer])
    uses = Counter(UPSTREAM[layer] for layer in needed if layer in UPSTREAM)
    written = {layer for layer in needed if not only_wanted or layer in wanted or uses[layer] > 1}
    made = {
        C.BRONZE: lambda df: L.bronze(df, settings),
        C.SILVER: lambda df: L.silver(df, settings),
        C.LATEST: L.latest_state,
        C.GOLD_DAILY: lambda df: L.daily_region_sales(df, settings),
        C.GOLD_CUSTOMER: lambda df: L.customer_metrics(df, settings),
    }
    version = W.new_version(output_root)
    paths = {layer: path for layer, path in W.layer_paths(version).items() if layer in written}
    buckets = 0
    derived: dict[str, DataFrame] = {}
    for layer in C.LAYERS:
        if layer in needed:
            above = UPSTREAM.get(layer)
            source = raw if above is None else W.read_layer(spark, paths[above]) if above in paths else derived[above]
            if layer not in paths:
                derived[layer] = made[layer](source)
                continue
            bucketed = layer == C.SILVER and settings.silver_buckets
            # Buckets are written at once, one file each.
            passes = W.passes_for(spark, paths[above]) if layer in SORTED and above in paths and not bucketed else 1
            found = []
            for number in range(passes):
                frame, seen = made[layer](W.share_of(source, SORTED.get(layer, ""), number, passes)), Observation(layer)
                if observed is not None:
                    frame = frame.observe(seen, *Q.observable(layer, settings))
                with W.small_splits(spark) if layer in SORTED else nullcontext():
                    if bucketed:
                        buckets = W.buckets_for(source.count(), settings.silver_buckets)
                        W.write_bucketed(frame, paths[layer], W.BUCKET_KEY, buckets)
                    elif number:
                        W.add_to_layer(frame, paths[layer])
                    else:
                        W.write_layer(frame, paths[layer])
                if observed is not None:
                    found.append(seen.get)
            if observed is not None:
                observed.update(Q.together(found))
    if ledger is not None:
        W.write_layer(ledger, f"{version}/{W.LEDGER}")
    W.publish(spark, output_root, version, buckets)
    return paths


@dataclass(frozen=True)
class BuildReport:
    paths: dict[str, str]
    contract: CT.ContractSummary
    observed: dict[str, object] = field(default_factory=dict)


def build_with_report(spark: SparkSession, input_paths: str | Sequence[str], output_root: str,
                      settings: Settings = DEFAULT, observe: bool = True) -> BuildReport:
    """``build_all`` with the contract's summary and the metrics observed while the layers were written."""
    ledger = W.read_ledger(spark, output_root)
    hs = B.headers(spark, input_paths, ledger)
    if not hs:
        raise FileNotFoundError(f"no input files match {input_paths}")
    found = CT.file_profiles(spark, hs, settings.multiline_csv, ledger)
    contract = CT.passed(CT.summarise(spark, hs, found, settings.contract))
    raw = B.read_columns(spark, CT.with_line_breaks(hs, found), C.RAW_COLUMNS, settings.multiline_csv)
    observed: dict[str, object] = {}
    paths = build_layers(spark, raw, output_root, settings, ledger=CT.ledger_rows(spark, hs, found), observed=observed if observe else None)
    W.drop_old_versions(spark, output_root)
    return BuildReport(paths, contract, observed)


def build_all(spark: SparkSession, input_paths: str | Sequence[str], output_root: str,
              settings: Settings = DEFAULT) -> dict[str, str]:
    """Contract gate on the raw batches, then an idempotent full rebuild of
    every layer in a new version. Returns layer -> path. Files that the last version's ledger
    knows unchanged aren't parsed for the contract again; the last two versions stay."""
    return build_with_report(spark, input_paths, output_root, settings, observe=False).paths
