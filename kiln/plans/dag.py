"""The gold-layer DAG: 32 models wired by name, built lazily or materialised.

``GoldLayer(raw)`` exposes every model as a lazy DataFrame (``layer["dim_product"]``).
``materialize(...)`` writes models in dependency order as parquet tables in a
shared folder (by default under ``spark.checkpoint.dir``) and re-reads them, so
downstream models start from real files: lineage is cut, a lost executor only
recomputes the current model, and the planner sees true table sizes when it
chooses broadcast vs shuffle joins.
"""

from __future__ import annotations

import datetime as _dt
import threading
import time
import uuid
from dataclasses import dataclass
from typing import Callable

from pyspark.sql import DataFrame, SparkSession

from ..operators.mapping import Taxonomy
from ..functions import casts
from ..operators.sizing import SizeBook
from ..operators.sizing import max_broadcast_bytes as configured_max_broadcast_bytes
from ..operators.sizing import max_broadcast_rows as configured_max_broadcast_rows
from ..sources.sinks import folder_writer
from . import dims, facts, marts, quality, staging

STAGING, DIM, FACT, MART, DQ = "staging", "dimension", "fact", "mart", "data_quality"
# staging and data-quality models are views (evaluated when read); the rest are written tables
VIEW_LAYERS = {STAGING, DQ}


@dataclass(frozen=True)
class ModelSpec:
    name: str
    inputs: tuple[str, ...]
    fn: Callable[..., DataFrame]
    layer: str
    keys: tuple[str, ...] = ()        # written tables are sorted by these within files (min/max pruning)


def _stg(name, raw, fn, with_tax=True, reals=False):
    inputs = (raw, "stg_taxonomy_lookup") if with_tax else (raw,)
    return ModelSpec(name, (*inputs, "@real") if reals else inputs, fn, STAGING)


MODELS: list[ModelSpec] = [
    _stg("stg_taxonomy_lookup", "taxonomy_lookup_raw", staging.stg_taxonomy_lookup, with_tax=False),
    _stg("stg_products", "products_raw", staging.stg_products),
    _stg("stg_product_hierarchy", "product_hierarchy_raw", staging.stg_product_hierarchy),
    _stg("stg_customers", "customers_raw", staging.stg_customers),
    _stg("stg_sales_orders", "sales_orders_raw", staging.stg_sales_orders, reals=True),
    _stg("stg_retail_pos", "retail_pos_raw", staging.stg_retail_pos, reals=True),
    _stg("stg_marketing_campaigns", "marketing_campaigns_raw", staging.stg_marketing_campaigns, reals=True),
    _stg("stg_marketing_performance", "marketing_performance_raw", staging.stg_marketing_performance, reals=True),
    _stg("stg_inventory_snapshots", "inventory_snapshots_raw", staging.stg_inventory_snapshots),
    _stg("stg_warehouse_locations", "warehouse_locations_raw", staging.stg_warehouse_locations),
    _stg("stg_suppliers", "suppliers_raw", staging.stg_suppliers),
    _stg("stg_purchase_orders", "purchase_orders_raw", staging.stg_purchase_orders, reals=True),
    _stg("stg_shipments", "shipments_raw", staging.stg_shipments, reals=True),
    _stg("stg_shipment_events", "shipment_events_raw", staging.stg_shipment_events, with_tax=False),
    _stg("stg_carrier_performance", "carrier_performance_raw", staging.stg_carrier_performance),
    ModelSpec("dim_product", ("stg_products", "stg_product_hierarchy"), dims.dim_product, DIM, ("product_sku",)),
    ModelSpec("dim_customer", ("stg_customers",), dims.dim_customer, DIM, ("customer_id",)),
    ModelSpec("dim_supplier", ("stg_suppliers",), dims.dim_supplier, DIM, ("supplier_id",)),
    ModelSpec("dim_warehouse", ("stg_warehouse_locations",), dims.dim_warehouse, DIM, ("warehouse_id",)),
    ModelSpec("dim_carrier", ("stg_carrier_performance",), dims.dim_carrier, DIM, ("carrier_id",)),
    ModelSpec("fct_sales_orders", ("stg_sales_orders", "dim_customer", "dim_product"), facts.fct_sales_orders,
              FACT, ("order_id",)),
    ModelSpec("fct_retail_pos", ("stg_retail_pos", "dim_customer", "dim_product"), facts.fct_retail_pos, FACT,
              ("product_sku",)),
    ModelSpec("fct_inventory_snapshots", ("stg_inventory_snapshots", "dim_product", "dim_warehouse"),
              facts.fct_inventory_snapshots, FACT, ("product_sku",)),
    ModelSpec("fct_purchase_orders", ("stg_purchase_orders", "dim_supplier", "dim_product", "dim_warehouse",
                                      "@as_of"), facts.fct_purchase_orders, FACT, ("product_sku",)),
    ModelSpec("fct_shipments", ("stg_shipments", "dim_customer", "dim_product", "dim_warehouse", "dim_carrier",
                                "fct_sales_orders"), facts.fct_shipments, FACT, ("shipment_id",)),
    ModelSpec("fct_marketing_performance", ("stg_marketing_performance", "stg_marketing_campaigns", "dim_product"),
              facts.fct_marketing_performance, FACT, ("campaign_id",)),
    ModelSpec("mart_campaign_summary", ("fct_marketing_performance",), marts.mart_campaign_summary, MART),
    ModelSpec("mart_inventory_weeks_of_supply", ("fct_inventory_snapshots", "fct_retail_pos"),
              marts.mart_inventory_weeks_of_supply, MART, ("product_sku",)),
    ModelSpec("mart_product_performance", ("dim_product", "fct_sales_orders", "fct_retail_pos",
                                           "fct_inventory_snapshots", "fct_purchase_orders", "mart_campaign_summary",
                                           "mart_inventory_weeks_of_supply"),
              marts.mart_product_performance, MART, ("product_sku",)),
    ModelSpec("dq_orphan_records", ("fct_sales_orders", "fct_purchase_orders", "fct_shipments",
                                    "fct_marketing_performance", "stg_marketing_campaigns", "stg_product_hierarchy",
                                    "dim_product"), quality.dq_orphan_records, DQ),
    ModelSpec("dq_date_violations", ("fct_sales_orders", "fct_purchase_orders", "fct_shipments",
                                     "stg_product_hierarchy", "stg_shipment_events", "@stage"),
              quality.dq_date_violations, DQ),
    ModelSpec("dq_value_violations", ("fct_inventory_snapshots", "fct_retail_pos", "fct_marketing_performance",
                                      "fct_sales_orders", "fct_shipments"), quality.dq_value_violations, DQ),
]

SPECS = {m.name: m for m in MODELS}
# lookup-style join sides: broadcast when measured small, shuffle-joined otherwise
SIZED_SIDES = {m.name for m in MODELS if m.layer == DIM} | {"stg_marketing_campaigns"}
MODEL_NAMES = [m.name for m in MODELS]


def dependencies(name: str) -> list[str]:
    """All models ``name`` depends on, in build order (itself last)."""
    seen: list[str] = []

    def visit(n):
        if n in seen or n not in SPECS:
            return
        for i in SPECS[n].inputs:
            visit(i)
        seen.append(n)
    visit(name)
    return seen


def raw_inputs(name: str) -> list[str]:
    """The raw extracts that ``name`` (a model or an extract) is derived from."""
    if name not in SPECS:
        return [name]
    found = [i for n in dependencies(name) for i in SPECS[n].inputs if i not in SPECS and not i.startswith("@")]
    return list(dict.fromkeys(found))


def read_by_one_fact(names) -> set[str]:
    """The raw extracts that nothing but one fact (through its staging view) reads when ``names`` are asked for."""
    models = {d for n in names if n in SPECS for d in dependencies(n)}
    readers: dict[str, list[str]] = {}
    for m in models:
        for i in SPECS[m].inputs:
            readers.setdefault(i, []).append(m)
    found = set()
    for view in models - set(names):
        raw = SPECS[view].inputs[0]
        if (SPECS[view].layer == STAGING and raw not in names and len(readers.get(view, [])) == 1
                and SPECS[readers[view][0]].layer == FACT):
            found.add(raw)
    return found


def shared_folder(spark: SparkSession) -> str:
    """Folder for written tables: the cluster's ``spark.checkpoint.dir`` (never a machine-local temp)."""
    from ..session import ensure_checkpoint_dir
    conf = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    return (conf or ensure_checkpoint_dir(spark)).rstrip("/")


class GoldLayer:
    """Lazy access to every model of the gold layer over one set of raw extracts."""

    def __init__(self, raw: dict[str, DataFrame], as_of: str | None = None,
                 max_broadcast_rows: int | None = None, strict_reals: bool = False,
                 on_duplicate_mapping: str = "fan_out"):
        """``strict_reals``: text that is not a plain number becomes NULL instead of its numeric prefix.

        ``on_duplicate_mapping``: "fan_out" joins every active mapping of a key, as the source does; "raise" stops
        with a ``ValueError`` naming keys that have several.
        """
        self.raw = dict(raw)
        self.spark = next(iter(raw.values())).sparkSession
        # overdue is judged against this instant; default: now (UTC)
        self.as_of = as_of or _dt.datetime.now(_dt.timezone.utc).strftime("%Y-%m-%d %H:%M:%S")
        self._built: dict[str, DataFrame] = {}
        self._written: set[str] = set()
        self._landed: set[str] = set()
        self._steps = 0
        self._lock = threading.RLock()
        #: one folder per layer: everything it writes is replaced in place and goes with ``cleanup``
        self.run_folder = f"{shared_folder(self.spark)}/kiln-{uuid.uuid4().hex[:12]}"
        self.sizes = SizeBook(max_broadcast_rows if max_broadcast_rows is not None
                              else configured_max_broadcast_rows(self.spark),
                              configured_max_broadcast_bytes(self.spark), stage=self.stage)
        self._taxonomy: Taxonomy | None = None
        self.real = casts.strict_real if strict_reals else casts.alpha_reject_real
        self.on_duplicate_mapping = on_duplicate_mapping

    def _input(self, consumer: ModelSpec, name: str):
        """An input as the consumer should join it: taxonomy slices and dimensions size-checked."""
        if name == "@as_of":
            return self.as_of
        if name == "@real":
            return self.real
        if name == "@stage":
            return self.stage
        df = self[name]
        if name == "stg_taxonomy_lookup" and consumer.layer == STAGING:
            if self._taxonomy is None or self._taxonomy.df is not df:
                self._taxonomy = Taxonomy(df, self.sizes.max_rows, self.sizes.max_bytes,
                                          on_duplicate=self.on_duplicate_mapping)
            return self._taxonomy
        if name in SIZED_SIDES and (consumer.layer == FACT or (consumer.layer == DQ and SPECS[name].layer == DIM)):
            return self.sizes.side(name, df)
        return df

    def stage(self, df: DataFrame, name: str) -> DataFrame:
        """Write a step of a model under the run folder and read it back."""
        with self._lock:
            self._steps += 1
            path = f"{self.run_folder}/steps/{self._steps:03d}-{name}"
        folder_writer(df).save(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def __getitem__(self, name: str) -> DataFrame:
        with self._lock:
            if name in self._built:
                return self._built[name]
            if name in self.raw:
                return self.raw[name]
            spec = SPECS[name]
            df = spec.fn(*[self._input(spec, i) for i in spec.inputs])
            self._built[name] = df
            return df

    def _replaced(self, name: str, df: DataFrame) -> None:
        """``name`` now reads a file: models built on its old lineage are built anew when asked for."""
        with self._lock:
            for m in [m for m in self._built if m not in self._written and name in (*dependencies(m), *raw_inputs(m))]:
                del self._built[m]
            if name in SPECS:
                self._built[name] = df
                self._written.add(name)
                self.sizes.counts.pop(name, None)
            else:
                self.raw[name] = df
                self._landed.add(name)
            if name == "stg_taxonomy_lookup":
                self._taxonomy = None

    def ensure(self, *names: str) -> GoldLayer:
        """Write what these models (or raw extracts) need: their raw extracts, the mapping table and table models.

        An extract that a single fact reads is not landed: it would be written, read back once and dropped.
        """
        needed = list(dict.fromkeys(r for n in names for r in raw_inputs(n)))
        once = read_by_one_fact(names)
        landed = [r for r in needed if r not in once]
        if landed:
            self.land_raw(landed)
        models = [n for n in names if n in SPECS]
        if models:
            self.materialize(models, views=["stg_taxonomy_lookup"])
        return self

    def is_view(self, name: str) -> bool:
        return name in SPECS and SPECS[name].layer in VIEW_LAYERS

    def tables(self, names=None) -> dict[str, DataFrame]:
        return {n: self[n] for n in (names or MODEL_NAMES)}

    def materialize(self, names=None, folder: str | None = None, fmt: str = "parquet",
                    on_written: Callable[[str, float], None] | None = None, views=False,
                    threads: int = 1) -> str:
        """Write table models (and the tables they need) in build order; later models read the files.

        Views (staging, data quality) stay lazy over the written tables unless ``views`` is True
        or names them (e.g. the data-quality reports, written once for monitoring).
        Models already written by this layer are not written again. With ``threads`` > 1,
        models whose inputs are all written are submitted together as concurrent Spark jobs
        (like a build tool's thread setting), so small stages of one model overlap another's.
        """
        want = names or MODEL_NAMES
        order: list[str] = []
        for n in want:
            for d in dependencies(n):
                if d not in order:
                    order.append(d)
        todo = [n for n in order if n not in self._written and (
            SPECS[n].layer not in VIEW_LAYERS or views is True or (not isinstance(views, bool) and n in set(views)))]
        base = folder or f"{self.run_folder}/tables"

        def write(n: str) -> None:
            t0 = time.perf_counter()
            path = f"{base}/{n}"
            df = self[n]
            if SPECS[n].keys:
                df = df.sortWithinPartitions(*SPECS[n].keys)
            folder_writer(df, fmt).save(path)
            self._replaced(n, self.spark.read.format(fmt).load(path))
            if on_written:
                on_written(n, time.perf_counter() - t0)

        if threads <= 1:
            for n in todo:
                write(n)
            return base
        from concurrent.futures import ThreadPoolExecutor
        pending = list(todo)
        with ThreadPoolExecutor(max_workers=threads) as pool:
            while pending:
                # a model is ready once every table it reads (directly or through views) is written
                ready = [n for n in pending
                         if all(d in self._written or d not in pending for d in dependencies(n)[:-1])]
                for n in ready:
                    self[n]  # build the lazy plan on this thread (shared caches are filled in order)
                list(pool.map(write, ready))
                pending = [n for n in pending if n not in ready]
        return base

    def land_raw(self, names=None, folder: str | None = None, fmt: str = "parquet") -> str:
        """Write raw extracts (default: all) once and read them back, so every model plans from file scans."""
        base = folder or f"{self.run_folder}/raw"
        for name in names or list(self.raw):
            if name in self._landed:
                continue
            path = f"{base}/{name}"
            self.raw[name].write.mode("overwrite").format(fmt).save(path)
            self._replaced(name, self.spark.read.format(fmt).load(path))
        return base

    def cleanup(self) -> None:
        """Delete everything this layer wrote under its run folder; its DataFrames must not be used any more."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.run_folder)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)

    def register_views(self, names=None) -> None:
        """Expose models as temp views for ad-hoc SQL (``spark.sql('select ... from dim_product')``)."""
        for n, df in self.tables(names).items():
            df.createOrReplaceTempView(n)
