"""The full trip warehouse: raw -> curated -> marts, dimensions, fact, summaries, audit.

``Warehouse`` defines every table lazily from one raw feed: a table is planned when it is
asked for and runs when it is read or written. ``build_warehouse`` is the load job, in
three parts that can also be run on their own: ``load_curated`` (raw files), ``load_marts``
and ``load_star`` (from a curated path or catalog table). Each layer is written and read
back, which cuts lineage (a lost executor never re-runs upstream layers) and gives the
optimizer real file sizes for its joins downstream.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator, Mapping
from dataclasses import dataclass, field, replace
from functools import cached_property

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cabstar.operators import dims as D
from cabstar.operators.audit import LoadInfo, dim_ingestion_batch, load_counts, utc_now
from cabstar.operators.cleanse import cleanse
from cabstar.operators.fact import build_fact_trip, numbering_places, validate_batch_id
from cabstar.operators.lineage import BUCKET_SECONDS
from cabstar.operators.marts import MARTS, build_mart, build_marts_combined, split_marts
from cabstar.operators.summaries import SUMMARIES, build_summaries_combined, build_summary, split_summaries
from cabstar.plans.contract import DECLARED
from cabstar.sources import reference as ref
from cabstar.sources.raw import scan_curated
from cabstar.sources.sinks import materialize, read_table, scratch_scope, write_table, write_tables

PERIOD = ["pickup_year", "pickup_month"]

# table name -> partition columns (one naming scheme for files, catalog and checks)
TABLE_PARTITIONS: dict[str, list[str]] = {
    "silver": PERIOD,
    "gold_daily_revenue": PERIOD,
    "gold_vendor_revenue": PERIOD,
    "gold_payment_type_analysis": PERIOD,
    "gold_passenger_analysis": PERIOD,
    "dim_date": [],
    "dim_time": [],
    "dim_vendor": [],
    "dim_payment_type": [],
    "dim_rate_code": [],
    "dim_location": [],
    "dim_passenger_count": [],
    "dim_trip_flags": [],
    "dim_trip_quality": [],
    "dim_ingestion_batch": [],
    "fact_trip": PERIOD,
    "fact_daily_trip_summary": ["pickup_year"],
    "fact_vendor_daily_summary": PERIOD,
    "fact_payment_daily_summary": PERIOD,
    "fact_location_daily_summary": PERIOD,
}

SUMMARY_TABLES = {
    "daily": "fact_daily_trip_summary",
    "vendor": "fact_vendor_daily_summary",
    "payment": "fact_payment_daily_summary",
    "location": "fact_location_daily_summary",
}
MART_TABLES = {name: f"gold_{name}" for name in MARTS}


class LazyTables(Mapping):
    """Tables by name, each planned when it is first asked for."""

    def __init__(self, builders: dict[str, Callable[[], DataFrame]]):
        self._builders, self._built = builders, {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._built:
            self._built[name] = self._builders[name]()
        return self._built[name]

    def __iter__(self) -> Iterator[str]:
        return iter(self._builders)

    def __len__(self) -> int:
        return len(self._builders)


@dataclass
class Warehouse:
    raw: DataFrame
    info: LoadInfo
    zones: DataFrame | None = None
    date_range: tuple[str, str] | None = None  # None: whole years spanned by the trips
    bucket_seconds: int = BUCKET_SECONDS
    overrides: dict[str, DataFrame] = field(default_factory=dict)

    @property
    def spark(self) -> SparkSession:
        return self.raw.sparkSession

    def _lazy(self, builders: dict[str, Callable[[], DataFrame]], stored_as: dict[str, str] | None = None) -> LazyTables:
        """The builders by name, each replaced by an override of the table's stored name."""
        stored_as = stored_as or {n: n for n in builders}
        given = self.overrides
        return LazyTables({n: (lambda n=n: given[stored_as[n]]) if stored_as[n] in given else b for n, b in builders.items()})

    # -- curated layer ------------------------------------------------------------------
    @cached_property
    def silver(self) -> DataFrame:
        return self.overrides["silver"] if "silver" in self.overrides else cleanse(self.raw)

    @cached_property
    def marts(self) -> LazyTables:
        return self._lazy({n: (lambda n=n: build_mart(self.silver, n)) for n in MARTS}, MART_TABLES)

    # -- star schema --------------------------------------------------------------------
    @cached_property
    def fact(self) -> DataFrame:
        if "fact_trip" in self.overrides:
            return self.overrides["fact_trip"]
        curated = self.silver
        if "silver" not in self.overrides and "source_file_name" in self.raw.columns:
            # the same trips, shuffled once for both the duplicates and the row numbers
            curated = cleanse(self.raw, placed_by=numbering_places(self.bucket_seconds))
        return build_fact_trip(curated, self.info.batch_id, self.bucket_seconds)

    @cached_property
    def codes(self) -> DataFrame:
        return self.overrides["_codes"] if "_codes" in self.overrides else D.fact_codes(self.fact)

    def _calendar(self) -> DataFrame:
        if self.date_range:
            return D.dim_date(D.literal_bounds(self.spark, *self.date_range))
        return D.dim_date(D.calendar_bounds(self.fact))

    @cached_property
    def dims(self) -> LazyTables:
        spark = self.spark
        return self._lazy(
            {
                "dim_date": self._calendar,
                "dim_time": lambda: D.dim_time(spark),
                "dim_vendor": lambda: D.code_dim(self.codes, "vendor"),
                "dim_payment_type": lambda: D.code_dim(self.codes, "payment_type"),
                "dim_rate_code": lambda: D.code_dim(self.codes, "rate_code"),
                "dim_location": lambda: D.dim_location(self.codes, self.zones),
                "dim_passenger_count": lambda: D.dim_passenger_count(self.codes),
                "dim_trip_flags": lambda: ref.dim_trip_flags(spark),
                "dim_trip_quality": lambda: ref.dim_trip_quality(spark),
                "dim_ingestion_batch": lambda: dim_ingestion_batch(load_counts(self.silver), self.info),
            }
        )

    @cached_property
    def summaries(self) -> LazyTables:
        return self._lazy({n: (lambda n=n: build_summary(self.fact, n)) for n in SUMMARIES}, SUMMARY_TABLES)

    def tables(self) -> LazyTables:
        """All 21 tables by name, in load order."""
        builders: dict[str, Callable[[], DataFrame]] = {"bronze": lambda: self.raw, "silver": lambda: self.silver}
        builders |= {MART_TABLES[n]: (lambda n=n: self.marts[n]) for n in MARTS}
        builders |= {n: (lambda n=n: self.dims[n]) for n in self.dims}
        builders["fact_trip"] = lambda: self.fact
        builders |= {SUMMARY_TABLES[n]: (lambda n=n: self.summaries[n]) for n in SUMMARIES}
        return LazyTables(builders)


Periods = list[tuple[int, int]]


def _in_periods(df: DataFrame, periods: Periods | None) -> DataFrame:
    """Rows of the given (year, month) partitions; None: all."""
    if periods is None:
        return df
    years = F.col("pickup_year").isin(sorted({y for y, _ in periods}))
    months = F.struct(*PERIOD).isin([F.struct(F.lit(y), F.lit(m)) for y, m in periods]) if periods else F.lit(False)
    return df.where(years & months)


def _existing(spark: SparkSession, path: str) -> DataFrame | None:
    """The table stored at ``path``; None only if nothing is there."""
    try:
        return read_table(spark, path)
    except AnalysisException as e:
        if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def _path(base_path: str, name: str) -> str:
    return f"{base_path.rstrip('/')}/{name}"


def _persist(
    spark: SparkSession, base_path: str, name: str, df: DataFrame, periods: Periods | None = None
) -> DataFrame:
    """Write a table that stands for the given periods (None: for all), and read it back."""
    write_table(df, _path(base_path, name), TABLE_PARTITIONS[name] or None, replaces=_replaced(name, periods))
    return read_table(spark, _path(base_path, name), df.schema)


def _replaced(name: str, periods: Periods | None) -> list[tuple] | None:
    """Partitions of a table that the periods stand for; None: all."""
    if periods is None or not TABLE_PARTITIONS[name]:
        return None
    return sorted({p[: len(TABLE_PARTITIONS[name])] for p in periods})


def load_curated(raw: DataFrame, base_path: str) -> Periods:
    """Cleanse raw files into the curated table; return the (year, month) partitions it changed.

    A file's rows replace what is stored of that file, in whatever months they lie, also
    where the file no longer has any; rows of other files stay. Feeds without
    ``source_file_name`` replace whole months.
    """
    spark = raw.sparkSession
    new = materialize(cleanse(raw), "curated")
    stored = _existing(spark, _path(base_path, "silver"))
    periods = new.select(*PERIOD).distinct()
    if stored is not None and "source_file_name" in new.columns:
        files = materialize(raw.select("source_file_name").distinct(), "curated-files")  # also those without a valid row
        periods = periods.union(stored.join(files, "source_file_name", "left_semi").select(*PERIOD)).distinct()
        others = stored.join(files, "source_file_name", "left_anti")
        # read in full before the same partitions are overwritten
        kept = materialize(others.join(periods, PERIOD, "left_semi"), "curated-kept")
        new = new.unionByName(kept, allowMissingColumns=True)
    changed = [(r["pickup_year"], r["pickup_month"]) for r in periods.collect()]  # a row a month
    _persist(spark, base_path, "silver", new, sorted(changed))
    return sorted(changed)


def load_marts(
    spark: SparkSession, base_path: str, curated: str | None = None, periods: Periods | None = None
) -> dict[str, DataFrame]:
    """Rebuild the marts of all or the given months from a curated path or catalog table."""
    silver = _in_periods(scan_curated(spark, curated or _path(base_path, "silver"), DECLARED["silver"]), periods)
    rows = materialize(build_marts_combined(silver), "marts")
    return _write_all(spark, {MART_TABLES[n]: df for n, df in split_marts(rows).items()}, base_path, periods)


def load_star(
    spark: SparkSession,
    base_path: str,
    info: LoadInfo,
    curated: str | None = None,
    zones: DataFrame | None = None,
    date_range: tuple[str, str] | None = None,
    bucket_seconds: int = BUCKET_SECONDS,
    periods: Periods | None = None,
    lap: Callable[[str], None] = lambda label: None,
) -> dict[str, DataFrame]:
    """Rebuild fact, dimensions, summaries and audit from a curated path or catalog table.

    With ``periods`` only those months of the fact are replaced. Their rows are numbered
    among all rows of their files, so a file that reaches into other months keeps the
    numbers of a full load. Dimensions are rebuilt from the whole fact, so members of
    earlier loads stay; the daily summary is rebuilt for whole years, its partitions. The
    audit row is written last, with the times at which the load began and ended.
    """
    info = check_batch(spark, base_path, info)
    silver = scan_curated(spark, curated or _path(base_path, "silver"), DECLARED["silver"])
    source = silver
    if periods is not None and "source_file_name" in silver.columns:
        files = _in_periods(silver, periods).select("source_file_name").distinct()
        source = silver.join(files, "source_file_name", "left_semi")
    done = {"fact_trip": _persist(spark, base_path, "fact_trip",
                                  _in_periods(build_fact_trip(source, info.batch_id, bucket_seconds), periods), periods)}
    lap("fact")
    fact = done["fact_trip"]
    given = {"silver": _in_periods(silver, periods), **done, "_codes": materialize(D.fact_codes(fact), "codes")}
    w = Warehouse(silver, info, zones, date_range, bucket_seconds, overrides=given)
    dims = {name: w.dims[name].coalesce(1) for name in w.dims if name != "dim_ingestion_batch"}
    done |= _write_all(spark, dims, base_path)
    lap("dimensions")

    scope = _in_periods(fact, periods)
    rows = materialize(build_summaries_combined(scope), "summaries")
    tables = {SUMMARY_TABLES[n]: df for n, df in split_summaries(rows).items()}
    if periods is not None:
        years = sorted({y for y, _ in periods})
        tables[SUMMARY_TABLES["daily"]] = build_summary(fact.where(F.col("pickup_year").isin(years)), "daily")
    done |= _write_all(spark, tables, base_path, periods)
    lap("summaries")
    audit = dim_ingestion_batch(load_counts(given["silver"]), replace(info, load_completed_utc=utc_now()))
    done |= _write_all(spark, {"dim_ingestion_batch": audit.coalesce(1)}, base_path)
    return done


def check_batch(spark: SparkSession, base_path: str, info: LoadInfo) -> LoadInfo:
    """Refuse a batch id that isn't numeric or is in the audit table; stamp begin and path."""
    validate_batch_id(info.batch_id)
    audit = _existing(spark, _path(base_path, "dim_ingestion_batch"))
    if audit is not None and audit.where(F.col("batch_id") == info.batch_id).limit(1).count():
        raise ValueError(f"batch {info.batch_id} was already loaded; choose a new batch id")
    return replace(
        info,
        load_started_utc=info.load_started_utc or utc_now(),
        target_base_path=info.target_base_path or base_path.rstrip("/"),
    )


def build_warehouse(
    raw: DataFrame,
    base_path: str,
    info: LoadInfo,
    zones: DataFrame | None = None,
    date_range: tuple[str, str] | None = None,
    bucket_seconds: int = BUCKET_SECONDS,
    timings: dict[str, float] | None = None,
    scope_years: list[int] | None = None,
    scope_months: Periods | None = None,
) -> Warehouse:
    """Load every layer to ``base_path/<table>`` and return a Warehouse over the files.

    The batch id is checked before anything is written. Without a scope, marts, fact and
    summaries are rebuilt from all curated trips, under the new batch id. ``scope_years`` or
    ``scope_months`` make a period load: only those months and all months that the files of
    this load touch (stray dates included) are rebuilt; the rest stays as it is, and the
    result equals one full load but for batch ids. ``timings`` (optional) receives the
    wall-clock seconds of each layer.
    """
    spark = raw.sparkSession
    clock = {"t": time.perf_counter()}

    def lap(label: str) -> None:
        now = time.perf_counter()
        if timings is not None:
            timings[label] = now - clock["t"]
        clock["t"] = now

    info = check_batch(spark, base_path, info)
    with scratch_scope(spark):
        done = _load_layers(raw, base_path, info, zones, date_range, bucket_seconds, scope_years, scope_months, lap)
    return Warehouse(raw, info, zones, date_range, bucket_seconds, overrides=done)


def _load_layers(raw, base_path, info, zones, date_range, bucket_seconds, scope_years, scope_months, lap):
    spark = raw.sparkSession
    changed = load_curated(raw, base_path)
    periods = None
    if scope_years is not None or scope_months is not None:
        asked = {tuple(p) for p in scope_months or []}
        if scope_years:
            silver = read_table(spark, _path(base_path, "silver"), DECLARED["silver"]).where(F.col("pickup_year").isin(scope_years))
            asked |= {(r["pickup_year"], r["pickup_month"]) for r in silver.select(*PERIOD).distinct().collect()}
        periods = sorted(asked | set(changed))
    lap("cleanse")
    done = {"silver": read_table(spark, _path(base_path, "silver"), DECLARED["silver"])}
    done |= load_marts(spark, base_path, periods=periods)
    lap("marts")
    done |= load_star(spark, base_path, info, None, zones, date_range, bucket_seconds, periods, lap)
    return done


def _write_all(
    spark: SparkSession, tables: dict[str, DataFrame], base_path: str, periods: Periods | None = None
) -> dict[str, DataFrame]:
    """Write independent tables concurrently and return their read-back frames."""
    mode = lambda name: "append" if name == "dim_ingestion_batch" else "overwrite"
    jobs = [
        (df, _path(base_path, name), TABLE_PARTITIONS[name] or None, mode(name), _replaced(name, periods))
        for name, df in tables.items()
    ]
    write_tables(jobs)
    return {name: read_table(spark, _path(base_path, name), df.schema) for name, df in tables.items()}
