"""CSV sources and sinks for entity-by-year panels (SRC1-SRC4, SNK1, PRJ1-PRJ9).

Everything is lazy: headers are renamed with ``toDF`` (metadata only),
values are conformed in one ``select`` with ``try_cast`` (bad text -> NULL,
never an error under ANSI mode, never NaN), and column pruning reaches the
CSV scan because unwanted columns are never selected.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from ..functions.transforms import log1p, log1p_under_coverage, pretty_name

# Vocabulary of the second panel edition -> first-edition names.
EDITION2_RENAMES = {
    "alcohol_consumption": "alcohol",
    "incidents_hiv": "hiv_aids",
    "gdp_per_capita": "gdp",
    "population_mln": "population",
    "thinness_ten_nineteen_years": "thinness_1_19_years",
    "thinness_five_nine_years": "thinness_5_9_years",
}

# Country names the code lookup misses, with their ISO3 codes.
ISO3_OVERRIDES = {
    "Bolivia (Plurinational State of)": "BOL",
    "Democratic Republic of the Congo": "COD",
    "Iran (Islamic Republic of)": "IRN",
    "Micronesia (Federated States of)": "FSM",
    "Republic of Korea": "KOR",
    "Swaziland": "SWZ",
    "The former Yugoslav republic of Macedonia": "MKD",
    "Turkey": "TUR",
    "Venezuela (Bolivarian Republic of)": "VEN",
}

# Default per-column transforms of the life-expectancy panel.
LOG1P_COLUMNS = ("infant_deaths", "under_five_deaths", "hiv_aids", "measles", "thinness_1_19_years",
                 "thinness_5_9_years", "gdp", "percentage_expenditure", "alcohol", "population")
UNDER_COVERAGE_COLUMNS = ("hepatitis_b", "polio", "diphtheria")

_DELIMS = re.compile(r"[\s/\-]+")
_MULTI = re.compile(r"_+")


def default_transforms() -> dict[str, Callable[[Column], Column]]:
    tf: dict[str, Callable[[Column], Column]] = {c: log1p for c in LOG1P_COLUMNS}
    tf.update({c: log1p_under_coverage for c in UNDER_COVERAGE_COLUMNS})
    return tf


def normalize_name(name: object) -> str:
    """PRJ1: strip, lower, runs of blanks / ``/`` / ``-`` -> ``_``, collapse ``__``."""
    s = str(name).strip().lower()
    return _MULTI.sub("_", _DELIMS.sub("_", s))


def normalize_headers(df: DataFrame, renames: Mapping[str, str] | None = None) -> DataFrame:
    """PRJ1/PRJ2: normalised names, then an optional rename map (no job runs)."""
    names = [normalize_name(c) for c in df.columns]
    if renames:
        names = [renames.get(n, n) for n in names]
    return df.toDF(*names)


def conform(df: DataFrame, identifiers: Sequence[str] = ("country", "year"), time: str = "year",
            status: str | None = "status") -> DataFrame:
    """PRJ3-PRJ5 in one projection.

    * time text -> timestamp of Jan 1 (``time_ts``) and int ``time`` (bad -> NULL);
    * status text -> 1 if ``developed`` else 0 (missing -> 0);
    * every other non-identifier column -> double via ``try_cast``; NaN -> NULL.
    """
    out = []
    for c in df.columns:
        col = F.col(f"`{c}`")
        if c == time:
            ts = F.try_to_timestamp(F.trim(col.cast("string")), F.lit("yyyy"))
            out += [F.year(ts).alias(c), ts.alias(f"{c}_ts")]
        elif status and c == status:
            out.append(F.coalesce(F.lower(F.trim(col.cast("string"))) == F.lit("developed"), F.lit(False))
                       .cast("int").alias(c))
        elif c in identifiers:
            out.append(col)
        else:
            d = F.expr(f"try_cast(`{c}` AS DOUBLE)") if not isinstance(df.schema[c].dataType, NumericType) \
                else col.cast("double")
            out.append(F.nanvl(d, F.lit(None).cast("double")).alias(c))
    return df.select(*out)


def read_csv(spark: SparkSession, path: str, sep: str = ",", encoding: str = "UTF-8") -> DataFrame:
    """All-string read (no schema inference pass over the data)."""
    return spark.read.option("header", True).option("sep", sep).option("encoding", encoding).csv(path)


def read_panel(spark: SparkSession, path: str, target: str = "life_expectancy", drop_missing_target: bool = True,
               renames: Mapping[str, str] | None = None) -> DataFrame:
    """SRC1: comma CSV -> normalised, conformed panel (entity ``country``, time ``year``)."""
    df = conform(normalize_headers(read_csv(spark, path), renames))
    return df.filter(F.col(target).isNotNull()) if drop_missing_target and target in df.columns else df


def status_from_dummies(df: DataFrame, developed: str = "economy_status_developed",
                        developing: str = "economy_status_developing", name: str = "status") -> DataFrame:
    """PRJ6: status = 1 where developed == 1, 0 where developing == 1 (else developed == 1 test)."""
    st = F.when(F.col(developed) == 1, 1).when(F.col(developing) == 1, 0).otherwise(
        (F.col(developed) == 1).cast("int"))
    return df.withColumn(name, st.cast("int")).drop(developed, developing)


def read_panel_edition2(spark: SparkSession, path: str, edition1: DataFrame | None = None,
                        backfill_columns: Sequence[str] = ("percentage_expenditure", "total_expenditure"),
                        drop_remaining_nan: bool = False) -> DataFrame:
    """SRC2: second edition: renames, status from dummies, population millions -> units,
    optional left join of first-edition columns by (country, year) (JOI3)."""
    raw = normalize_headers(read_csv(spark, path), EDITION2_RENAMES)
    df = conform(status_from_dummies(raw.withColumns({
        "economy_status_developed": F.expr("try_cast(economy_status_developed AS DOUBLE)"),
        "economy_status_developing": F.expr("try_cast(economy_status_developing AS DOUBLE)")})),
        identifiers=("country", "year", "region", "status"), status=None)
    if "population" in df.columns:
        df = df.withColumn("population", F.col("population") * 1e6)  # PRJ7
    if edition1 is not None:
        extra = [c for c in backfill_columns if c in edition1.columns and c not in df.columns]
        right = edition1.select("country", "year", *extra).dropna(subset=["country", "year"])
        df = df.join(right, ["country", "year"], "left")
    return df.dropna() if drop_remaining_nan else df


def read_wide_series(spark: SparkSession, path: str, prefixes: Sequence[str], years: Sequence[int] | None = None,
                     id_columns: Sequence[str] = ("iso3", "country", "hdicode", "region")) -> DataFrame:
    """SRC3: Latin-1 wide CSV; only id columns and wanted ``prefix_YYYY`` columns are selected.

    Exact ``^prefix_YYYY$`` matching (R21): a short prefix never hides a longer one.
    """
    raw = read_csv(spark, path, encoding="ISO-8859-1")
    raw = raw.toDF(*[c.lower() for c in raw.columns])
    pat = re.compile(r"^(.*)_(\d{4})$")
    keep = [c for c in raw.columns if c in id_columns]
    wanted = set(prefixes)
    for c in raw.columns:
        m = pat.match(c)
        if m and m.group(1) in wanted and (years is None or int(m.group(2)) in set(years)):
            keep.append(c)
    return raw.select(*keep)


def read_semicolon_comma_decimal(spark: SparkSession, path: str, numeric: Sequence[str] | None = None) -> DataFrame:
    """SRC4: ``sep=';'`` and ``,`` decimals; numbers via ``try_cast(replace(',', '.'))``."""
    raw = read_csv(spark, path, sep=";")
    cols = list(numeric) if numeric is not None else []
    return raw.withColumns({c: F.expr(f"try_cast(replace(`{c}`, ',', '.') AS DOUBLE)") for c in cols})


def write_panel(df: DataFrame, path: str, partition_by: Sequence[str] = ("year",), fmt: str = "parquet") -> None:
    """SNK1: partitioned write (year partitions make later year filters prune files)."""
    df.write.mode("overwrite").partitionBy(*partition_by).format(fmt).save(path)


def pretty(df: DataFrame, labels: Mapping[str, str] | None = None) -> DataFrame:
    """PRJ8: rename all columns to labels; unknown names get a title-cased label."""
    labels = labels or {}
    return df.toDF(*[labels.get(c, pretty_name(c)) for c in df.columns])


def select_present(df: DataFrame, columns: Sequence[str], target: str | None = None) -> DataFrame:
    """PRJ9: keep requested columns that exist; a missing target is an error."""
    if target is not None and target in columns and target not in df.columns:
        raise KeyError(f"target {target!r} not in frame")
    return df.select(*[c for c in columns if c in df.columns])
