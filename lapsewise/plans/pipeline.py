"""raw → clean → features, with every stage written as a Parquet layer.

Each stage reads the previous stage's layer, so lineage is cut at every stage
boundary (a lost executor recomputes at most one stage) and later queries scan
only the columns they use.  Layers live under the cluster-shared folder named
by ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import threading
from concurrent.futures import ThreadPoolExecutor
import time
import uuid

from pyspark.sql import DataFrame, SparkSession

from ..functions import constants as K
from ..session import shared_dir
from ..sources import adapter
from ..sources.io import read_layer, write_layer
from ..sources.measured import read_checks, write_measured
from . import cleaning
from .features import build_customer_features, build_policy_features, passes_through

CLEAN_TABLES = ("customers", "agents", "channels", "products", "dates", "policies", "policy_events",
                "premium_payments")

LAYER_TABLES = {"features/policies": "policy_features", "features/customers": "customer_features"}

_RUN = uuid.uuid4().hex[:12]
_LOCK = threading.RLock()
_MODELS: dict[tuple, "Model"] = {}


class Model:
    """The cleaned and feature tables of one input directory."""

    def __init__(self, spark: SparkSession, tables: dict[str, DataFrame], as_of: dt.date,
                 timings: dict[str, float] | None = None, checks: DataFrame | None = None):
        self.checks = checks  # what the layers' writes have measured; None without layers
        self.spark = spark
        self.tables = tables
        self.as_of = as_of
        self.timings = timings or {}

    def __getitem__(self, name: str) -> DataFrame:
        return self.tables[name]

    @property
    def policies(self) -> DataFrame:
        return self.tables["policy_features"]

    @property
    def customers(self) -> DataFrame:
        return self.tables["customer_features"]

    @property
    def events(self) -> DataFrame:
        return self.tables["policy_events"]


def lazy_model(spark: SparkSession, sf_dir: str, as_of: dt.date = K.FIXTURE_AS_OF) -> Model:
    """The whole pipeline as one lazy plan (no layers) — for tests and
    explain(); production runs use ``materialize``."""
    raw = adapter.raw_tables(spark, sf_dir)
    clean = cleaning.clean_all(raw, as_of)
    pf = build_policy_features(clean["policies"], clean["premium_payments"], clean["policy_events"],
                               clean["dates"], as_of, fit_on=raw["premium_payments"])
    cf = build_customer_features(clean["customers"], pf, clean["policy_events"])
    return Model(spark, {**clean, "policy_features": pf, "customer_features": cf}, as_of)


def run_pipeline(spark: SparkSession, raw: dict[str, DataFrame], root: str, as_of: dt.date,
                 concurrent_jobs: int = 4) -> Model:
    """Clean and feature stages, each written to ``root``, measured as it is
    written, and read back.

    Stages that do not depend on each other are submitted as concurrent Spark
    jobs (``concurrent_jobs`` driver threads), so small stages share the
    executors instead of running one after another."""
    timings: dict[str, float] = {}
    flags, rules = cleaning.flag_rules(as_of), cleaning.clean_rules()

    def stage(name: str, df: DataFrame) -> DataFrame:
        t0 = time.perf_counter()
        spark.sparkContext.setJobDescription(f"lapsewise stage {name}")  # labels the jobs in event logs
        kind, _, table = name.partition("/")
        clean = kind == "clean"
        write_measured(df, root, name, table=table if clean else LAYER_TABLES[name],
                       flags=flags.get(table) if clean else None, rules=rules.get(table) if clean else None)
        timings[name] = round(time.perf_counter() - t0, 3)
        return read_layer(spark, root, name)

    def stages(plans: dict[str, "callable"]) -> dict[str, DataFrame]:
        """Build and write independent stages; plans map name → builder."""
        if concurrent_jobs <= 1 or len(plans) == 1:
            return {n: stage(n, build()) for n, build in plans.items()}

        def run(n, b):
            spark.sparkContext.setJobDescription(f"lapsewise stage {n}")  # the builders' size checks too
            return stage(n, b())

        with ThreadPoolExecutor(max_workers=concurrent_jobs) as pool:
            futures = {n: pool.submit(run, n, b) for n, b in plans.items()}
            return {n: f.result() for n, f in futures.items()}

    # base cleaning keeps every policy row, so the orphan checks of events and
    # payments read only the raw policy keys; the policies table itself is
    # written once, after its status refresh.  The policies are dealt by their
    # key once, for the refresh and both summaries of their features; a feature
    # row is a cleaned row with more columns, so the cleaned table is read off it
    # (raw policies with columns that the features drop or make are written first)
    keys = raw["policies"].select("policy_id")
    first = stages({
        "clean/policy_events": lambda: cleaning.clean_events(raw["policy_events"], keys),
        "clean/premium_payments": lambda: cleaning.clean_payments(raw["premium_payments"], keys),
        "clean/customers": lambda: cleaning.clean_customers(raw["customers"]),
        "clean/agents": lambda: cleaning.clean_agents(raw["agents"]),
        "clean/dates": lambda: cleaning.clean_dates(raw["dates"]),
        "clean/channels": lambda: raw["channels"],
        "clean/products": lambda: raw["products"],
    })
    t = {k.split("/", 1)[1]: v for k, v in first.items()}
    base = cleaning.clean_policies_base(raw["policies"], as_of)
    refreshed = cleaning.refresh_policy_status(base, t["policy_events"])
    kept = passes_through(refreshed.columns)
    if not kept:
        refreshed = t["policies"] = stage("clean/policies", refreshed)
    pf = stage("features/policies", build_policy_features(refreshed, t["premium_payments"],
                                                          t["policy_events"], t["dates"], as_of))
    if kept:
        t["policies"] = stage("clean/policies", pf.select(*refreshed.columns))
    cf = stage("features/customers", build_customer_features(t["customers"], pf, t["policy_events"]))
    checks = read_checks(spark, root, [*first, "clean/policies", *LAYER_TABLES])
    return Model(spark, {**t, "policy_features": pf, "customer_features": cf}, as_of, timings, checks)


def run_from_csv(spark: SparkSession, csv_paths: dict[str, str], root: str, as_of: dt.date = K.REFERENCE_AS_OF,
                 schemas: dict | None = None, quarantine: bool = False) -> Model:
    """The pipeline over the eight raw CSV files (header row, declared
    schemas — no inference pass), layers written under ``root``.
    ``csv_paths`` maps customers, policies, products, channels, agents,
    dates, policy_events and premium_payments to files or folders.  With
    ``quarantine`` rows that don't fit their schema are set apart under
    ``landed/`` (``landing.quarantined``) and the others go on; without it
    they have nulls where a value doesn't parse."""
    from ..sources import schemas as raw_schemas
    from ..sources.io import read_raw
    from ..sources.landing import land_csv

    declared = {**raw_schemas.RAW, **(schemas or {})}
    if quarantine:
        raw = {name: land_csv(spark, path, declared[name], root, f"landed/{name}") for name, path in csv_paths.items()}
    else:
        raw = {name: read_raw(spark, path, declared[name]) for name, path in csv_paths.items()}
    return run_pipeline(spark, raw, root, as_of)


def layer_root(spark: SparkSession, sf_dir: str, as_of: dt.date | None = None) -> str:
    tag = hashlib.sha1(f"{sf_dir}|{as_of}".encode()).hexdigest()[:10]
    return f"{shared_dir(spark)}/lapsewise-layers/{_RUN}/{tag}"


_RAW: dict[tuple, dict[str, DataFrame]] = {}


# raw tables whose derivation shuffles (the events' previous status is a
# per-policy window); they are landed once.  The other raw tables are
# row-wise projections of the inputs: landing them would only copy the
# largest tables, so they stay lazy and every reader scans the inputs.
LANDED = ("policy_events",)


def materialize_raw(spark: SparkSession, sf_dir: str, landed: tuple[str, ...] = LANDED) -> dict[str, DataFrame]:
    """The raw domain tables of ``sf_dir``: the ``landed`` ones written once
    per session and input and read back, the rest lazy projections."""
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"), landed)
    with _LOCK:
        tables = _RAW.get(key)
        if tables is None:
            root = layer_root(spark, sf_dir) + "/raw"
            tables = adapter.raw_tables(spark, sf_dir)
            for name in landed:
                write_layer(tables[name], root, name)
                tables[name] = read_layer(spark, root, name)
            _RAW[key] = tables
        return tables


def materialize(spark: SparkSession, sf_dir: str, as_of: dt.date = K.FIXTURE_AS_OF) -> Model:
    """The layered model of ``sf_dir``, built once per session and input."""
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"), as_of)
    with _LOCK:
        model = _MODELS.get(key)
        if model is None:
            raw = materialize_raw(spark, sf_dir)
            model = run_pipeline(spark, raw, layer_root(spark, sf_dir, as_of), as_of)
            _MODELS[key] = model
        return model


def write_bi_extracts(model: Model, root: str, fmt: str = "csv") -> dict[str, str]:
    """S6–S8 sinks: the three extracts the dashboards read (policies with
    channel and product attributes, customers, premium composition), written
    with a header row for the BI tool.  Returns name → path."""
    from ..operators import bi as B
    from ..operators import kpi as Q

    extracts = {
        "policies": B.bi_policies(model.policies, model["channels"], model["products"]),
        "customers": B.bi_customers(model.customers),
        "premium_distribution": Q.premium_composition(model.policies),
    }
    out = {}
    for name, df in extracts.items():
        writer = df.write.mode("overwrite").format(fmt)
        if fmt == "csv":
            writer = writer.option("header", True)
        path = f"{root.rstrip('/')}/bi/{name}"
        writer.save(path)
        out[name] = path
    return out
