"""Weather documents: required-path checks and the 25-column flatten."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from civicspark import constants as C
from civicspark import schemas
from civicspark.functions import scalars as X


def _get(doc: Column, path: str, typ: str = "variant") -> Column:
    return F.try_variant_get(doc, path, typ)


def _present(doc: Column, path: str) -> Column:
    """Key present (a JSON null counts as present)."""
    return _get(doc, path).isNotNull()


def _present_not_null(doc: Column, path: str) -> Column:
    v = _get(doc, path)
    return v.isNotNull() & ~F.is_variant_null(v)


def _absent_or_not_null(doc: Column, path: str) -> Column:
    v = _get(doc, path)
    return v.isNull() | ~F.is_variant_null(v)


# Required paths, in document order.  Leaves need only be present; containers
# that are dereferenced further and epoch seconds must also be non-null;
# optional containers may be absent but not an explicit null.
def required_checks(doc: Column) -> list[tuple[str, Column]]:
    checks = [
        ("coord.lat", _present(doc, "$.coord.lat")),
        ("coord.lon", _present(doc, "$.coord.lon")),
        ("sys", _present_not_null(doc, "$.sys")),
        ("weather[0].main", _present(doc, "$.weather[0].main")),
        ("weather[0].description", _present(doc, "$.weather[0].description")),
        ("weather[0].icon", _present(doc, "$.weather[0].icon")),
    ]
    checks += [(f"main.{k}", _present(doc, f"$.main.{k}"))
               for k in ("temp", "feels_like", "temp_min", "temp_max", "pressure", "humidity")]
    checks += [
        ("wind", _present_not_null(doc, "$.wind")),
        ("clouds", _present_not_null(doc, "$.clouds")),
        ("rain", _absent_or_not_null(doc, "$.rain")),
        ("snow", _absent_or_not_null(doc, "$.snow")),
        ("dt", _present_not_null(doc, "$.dt")),
        ("sys.sunrise", _present_not_null(doc, "$.sys.sunrise")),
        ("sys.sunset", _present_not_null(doc, "$.sys.sunset")),
    ]
    return checks


def issues(doc_col: str = "doc") -> Column:
    """Array of failed required paths (empty when the document is loadable)."""
    doc = F.col(doc_col)
    return F.filter(
        F.array(*[F.when(~ok, F.lit(name)) for name, ok in required_checks(doc)]),
        lambda x: x.isNotNull())


def _number(doc: Column, num: Column, path: str) -> Column:
    """JSON number at ``path`` as double: the typed parse (exact float
    semantics, keeps -0.0), else the VARIANT cast (text-encoded numbers)."""
    typed = num
    for part in path.removeprefix("$.").replace("['", ".").replace("']", "").split("."):
        typed = typed[part]
    return F.coalesce(typed, _get(doc, path, "double"))


def _epoch(secs: Column) -> Column:
    return F.timestamp_add("MICROSECOND", F.round(secs * 1_000_000).cast("long"), X.epoch_ntz())


def flat_columns(doc_col: str = "doc", borough_col: str = "borough",
                 num_col: str = "num") -> list[Column]:
    d, n = F.col(doc_col), F.col(num_col)

    def opt_text(path, default):
        return F.when(_present(d, path), _get(d, path, "string")).otherwise(F.lit(default))

    dbl = lambda p: _number(d, n, p)
    return [
        F.col(borough_col).cast("string").alias("borough"),
        opt_text("$.name", "").alias("city_name"),
        dbl("$.coord.lat").alias("lat"),
        dbl("$.coord.lon").alias("lon"),
        opt_text("$.sys.country", "").alias("country"),
        _get(d, "$.weather[0].main", "string").alias("weather_main"),
        _get(d, "$.weather[0].description", "string").alias("weather_description"),
        _get(d, "$.weather[0].icon", "string").alias("weather_icon"),
        dbl("$.main.temp").alias("temp_celsius"),
        dbl("$.main.feels_like").alias("feels_like_celsius"),
        dbl("$.main.temp_min").alias("temp_min_celsius"),
        dbl("$.main.temp_max").alias("temp_max_celsius"),
        dbl("$.main.pressure").alias("pressure_hpa"),
        dbl("$.main.humidity").alias("humidity_pct"),
        dbl("$.visibility").alias("visibility_meters"),
        dbl("$.wind.speed").alias("wind_speed_ms"),
        dbl("$.wind.deg").alias("wind_direction_deg"),
        dbl("$.clouds.all").alias("cloudiness_pct"),
        dbl("$.rain['1h']").alias("rain_1h_mm"),
        dbl("$.snow['1h']").alias("snow_1h_mm"),
        _epoch(dbl("$.dt")).alias("observation_timestamp"),
        _epoch(dbl("$.sys.sunrise")).alias("sunrise_timestamp"),
        _epoch(dbl("$.sys.sunset")).alias("sunset_timestamp"),
    ]


def flatten(parsed: DataFrame, ingested_at, on_error: str = "fail",
            doc_col: str = "doc", borough_col: str = "borough"):
    """Parsed documents -> ``weather_raw`` rows.

    ``on_error='fail'``: any document missing a required path fails the job
    (nothing is committed).  ``on_error='quarantine'``: returns
    ``(rows, rejected)`` where ``rejected`` keeps the document and its issues.
    """
    if on_error not in ("fail", "quarantine"):
        raise ValueError("on_error must be 'fail' or 'quarantine'")
    checked = parsed.withColumn("_issues", issues(doc_col))
    lineage = [X.as_of_literal(ingested_at).alias("_ingested_at"),
               F.lit(C.SOURCE_WEATHER).alias("_source")]
    names = [c.name for c in schemas.WEATHER_RAW]
    if on_error == "fail":
        # a Generate node, which no pruning removes: a count() or a read of a few columns
        # fails on a broken document as the load does
        msg = F.concat(F.lit("weather document misses required path(s): "),
                       F.array_join("_issues", ","))
        sound = F.when(F.size("_issues") > 0, F.raise_error(msg).cast("array<boolean>")).otherwise(F.array(F.lit(True)))
        checked = parsed.withColumn("_issues", issues(doc_col)).select(*parsed.columns, F.explode(sound).alias("_sound"))
        return checked.select(*flat_columns(doc_col, borough_col), *lineage).select(*names)
    good = checked.filter(F.size("_issues") == 0)
    bad = checked.filter(F.size("_issues") > 0)
    return good.select(*flat_columns(doc_col, borough_col), *lineage).select(*names), bad
