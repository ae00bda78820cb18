"""What a daily run of the features looks back on, kept from run to run.

A run leaves a state behind, one partition per run date, of a size that depends on the
number of series only:

* **rows**: of each source the newest landed rows after the state's *zone* date, and before
  it as many as the features of the days after it need (``PRICE_ROWS`` price dates, twelve
  values of the monthly index however old they are, and so on);
* **seeds**: each key's features on its last day up to the zone, which days without a value
  of their own carry forward, however long a series has been silent.

The next run opens the state and the snapshots landed since, and computes the days after the
zone anew, so what these revise counts.  A snapshot that changes a value on or before the zone
is beyond the state: then the whole landed history is read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from panelwatch import schemas as S
from panelwatch.operators.series import _join_same, latest_row
from panelwatch.plans.features import CARRIED, ZONE
from panelwatch.session import settle
from panelwatch.sources import landing as L

AS_OF = "as_of"
ZONE_DAYS = 45
#: Rows of a source, before the zone, that the features of one day need.
PRICE_ROWS = GEO_ROWS = DXY_VALUES = S.Z_WINDOW
MACRO_ROWS = 20
CPI_VALUES = 12

ROWS = "source string, series_key string, name string, date date, value double, run date, zone date"
SEEDS = "series_key string, " + ", ".join(f"`{c}` double" for c in (*S.FEATURES, *CARRIED)) + f", `{ZONE}` date"
#: Sources with their schema, the columns of a row, the column of the series' name, and the value columns.
SOURCES = {
    "prices": (S.PRICES_RAW, ["series_key", "date", "ticker"], "ticker", ["close"]),
    "macro": (S.MACRO_RAW, ["series_key", "date", "series"], "series", ["value"]),
    "geo": (StructType(S.GEO_RAW.fields[:4]), ["series_key", "date"], None, ["GPR_AI", "GPR_OIL"]),
}
IDENTITY = ["source", "series_key", "name", "date"]


def _cells(df: DataFrame, source: str, run: Column) -> DataFrame:
    """The values of a source's rows, one per row of (IDENTITY, value, run)."""
    _, _, name, values = SOURCES[source]
    df = L.no_nan(df)
    cells = F.array(*[F.struct((F.col(name) if name else F.lit(v)).alias("name"), F.col(v).cast("double").alias("value")) for v in values])
    out = df.select(F.lit(source).alias("source"), F.col("series_key").cast("string").alias("series_key"), F.col("date").cast("date").alias("date"), run.alias("run"), F.explode(cells).alias("c"))
    return out.select("source", "series_key", "c.name", "date", "c.value", "run")


def _newest(cells: DataFrame) -> DataFrame:
    """The value landed last, null or not, of each series and date."""
    newest = cells.groupBy(*IDENTITY).agg(F.max_by(F.struct("value", "run"), F.col("run")).alias("__v"))
    return newest.select(*IDENTITY, "__v.value", "__v.run")


def _union(frames: Sequence[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def whole_history(spark: SparkSession, root: str, as_of: str) -> DataFrame:
    """All landed values, the newest of each series and date."""
    frames = []
    for source, (schema, ids, _, _) in SOURCES.items():
        frames.append(_cells(L.read_history(spark, root, source, schema, ids, as_of), source, F.to_date(F.lit(as_of))))
    return _union(frames)


def landed_since(spark: SparkSession, root: str, after: str, until: str) -> DataFrame:
    """The values of the snapshots landed after one run date up to another; no other is opened or listed."""
    frames = []
    for source, (schema, _, _, _) in SOURCES.items():
        runs = [r for r in L.partitions(spark, f"{root}/{source}", L.RUN) if after < r <= until]
        frames.append(_cells(L.read_runs(spark, root, source, schema, runs), source, F.col(L.RUN)))
    return _newest(_union(frames))


def newest_state(spark: SparkSession, path: str, before: str) -> str | None:
    """The run date of the last state that an earlier run than ``before`` left complete (seeds are written last)."""
    runs = [r for r in L.partitions(spark, f"{path}/seeds", AS_OF) if r < before]
    return max(runs, default=None)


def read_state(spark: SparkSession, path: str, as_of: str) -> tuple[DataFrame, DataFrame]:
    """The rows and the seeds that the run of ``as_of`` left."""
    part = lambda name, schema: spark.read.schema(schema).parquet(f"{path}/{name}/{AS_OF}={as_of}")
    return part("rows", ROWS), part("seeds", SEEDS)


def beyond(new: DataFrame, old: DataFrame, seeds: DataFrame) -> bool:
    """Whether a newly landed row on or before its key's zone is not what the state has."""
    zones = seeds.select("series_key", ZONE)
    early = _join_same(new, zones, ["series_key"]).filter(F.col("date") <= F.col(ZONE)).drop(ZONE)
    known = _join_same(early, old.select(*IDENTITY, F.struct("value").alias("__old")), IDENTITY, "left")
    changed = F.col("__old").isNull() | ~F.col("value").eqNullSafe(F.col("__old.value"))
    return not known.filter(changed).isEmpty()


def history(spark: SparkSession, root: str, path: str, as_of: str, since: str | None) -> tuple[DataFrame, DataFrame | None]:
    """The settled values a run needs, and the seeds of its state; without a usable state all values, and none."""
    at = newest_state(spark, path, as_of) if since else None
    if at is not None:
        old, seeds = read_state(spark, path, at)
        zone = seeds.agg(F.max(ZONE)).first()[0]
        new = settle(landed_since(spark, root, at, as_of))
        if zone is not None and str(zone) < since and not beyond(new, old, seeds):
            return settle(_newest(old.select(*new.columns).unionByName(new))), seeds
    return settle(whole_history(spark, root, as_of)), None


def sources_of(values: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Long prices, macro series and the index, as they were landed."""
    of = lambda s: values.filter(F.col("source") == s)
    prices = of("prices").select("series_key", "date", F.col("name").alias("ticker"), F.col("value").alias("close"))
    macro = of("macro").select("series_key", "date", F.col("name").alias("series"), "value")
    return prices, macro, L.widen(of("geo"), ["GPR_AI", "GPR_OIL"], "name", "value")


def _rank(rows: Column, *by: str) -> Column:
    """Number of dates from the newest back, among the rows for which ``rows`` is true."""
    return F.dense_rank().over(W.partitionBy("source", "series_key", *by, rows).orderBy(F.desc("date")))


def kept_rows(values: DataFrame, zone: Column) -> DataFrame:
    """The values that later runs may look back on."""
    late = F.col("date") > zone
    early = values.filter(~late)
    is_ = lambda source, name=None: (F.col("source") == source) & (F.lit(True) if name is None else F.col("name").eqNullSafe(F.lit(name)))
    there = F.col("value").isNotNull()
    ranked = early.withColumns({"__row": _rank(F.lit(True)), "__value": _rank(there, "name")})
    deep = {"prices": PRICE_ROWS, "geo": GEO_ROWS, "macro": MACRO_ROWS}
    keep = F.lit(False)
    for source, n in deep.items():
        keep = keep | (is_(source) & (F.col("__row") <= n))
    for name, n in {"cpi": CPI_VALUES, "dxy": DXY_VALUES}.items():
        keep = keep | (is_("macro", name) & there & (F.col("__value") <= n))
    ranked = ranked.withColumn("__keep", keep)
    # Brent falls back to the macro series on price dates: its values there, and the last one before.
    w = W.partitionBy("series_key")
    first = F.min(F.when(is_("prices") & F.col("__keep"), F.col("date"))).over(w)
    both = W.partitionBy("series_key", "date")
    on_price = F.max(is_("prices")).over(both) & F.max(is_("macro", "brent") & there).over(both)
    ranked = ranked.withColumns({"__first": first, "__both": on_price})
    last = F.max(F.when(F.col("__both") & (F.col("date") < F.col("__first")), F.col("date"))).over(w)
    ranked = ranked.withColumn("__last", last)
    brent = is_("macro", "brent") & (F.col("date") >= F.col("__first"))
    before = (is_("prices") | is_("macro", "brent")) & (F.col("date") == F.col("__last"))
    kept = ranked.filter(F.col("__keep") | F.coalesce(brent, F.lit(False)) | F.coalesce(before, F.lit(False)))
    return values.filter(late).unionByName(kept.select(*values.columns))


def write_state(values: DataFrame, built: DataFrame, path: str, as_of: str, zone_days: int = ZONE_DAYS) -> None:
    """Leave the state of a run: ``values`` it saw, ``built`` features with what they carry; the seeds last."""
    zone = F.date_sub(F.to_date(F.lit(as_of)), zone_days)
    put = lambda df, name: df.write.mode("overwrite").parquet(f"{path}/{name}/{AS_OF}={as_of}")
    put(kept_rows(values, zone).withColumn("zone", zone), "rows")
    last = latest_row(built.filter(F.col("date") <= zone).select("series_key", "date", *S.FEATURES, *CARRIED), ["series_key"])
    put(last.drop("date").withColumn(ZONE, zone), "seeds")
