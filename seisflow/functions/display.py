"""Display-oriented scalar helpers."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from seisflow.functions.scalars import col_of, ts_text

__all__ = [
    "MAP_BANDS", "CHART_BANDS", "severity_band", "marker_radius", "popup_text", "fixed",
    "forecast_popup", "forecast_markers", "forecast_colour", "forecast_bucket", "FORECAST_BUCKETS",
]

# Magnitude colour bands, (upper bound, colour) in ascending order; the
# last colour applies at or above the last bound.
MAP_BANDS = ((2.0, "green"), (4.0, "blue"), (6.0, "orange"), (None, "red"))
CHART_BANDS = ((1.0, "green"), (3.0, "blue"), (5.0, "orange"), (None, "red"))

# Forecast buckets, right-closed (lower, upper, label).
FORECAST_BUCKETS = ((4.0, 5.0, "4.0-4.9"), (5.0, 6.0, "5.0-5.9"), (6.0, None, "6.0+"))


def severity_band(c="magnitude", bands=MAP_BANDS) -> Column:
    """Half-open bands ``x < bound``; null magnitude → null colour."""
    c = col_of(c)
    expr = None
    for bound, colour in bands:
        cond = c < bound if bound is not None else c.isNotNull()
        expr = F.when(cond, colour) if expr is None else expr.when(cond, colour)
    return expr


def marker_radius(c="magnitude", factor: float = 1.5) -> Column:
    """Marker size proportional to magnitude."""
    return col_of(c) * factor


def fixed(c, digits: int = 2) -> Column:
    """Fixed-decimal text, like Python's ``f"{x:.2f}"``."""
    return F.format_string(f"%.{digits}f", col_of(c))


# Popup labels, in the order they are shown, and the word for a missing field.
EVENT_LABELS = ("Magnitude", "Location", "Depth", "Time")
FORECAST_LABELS = ("Predicted Magnitude", "Confidence", "Zone")
MISSING = "unknown"


def _shown(c: Column) -> Column:
    return F.coalesce(c.cast("string"), F.lit(MISSING))


def _labelled(label: str) -> Column:
    return F.lit(f"<strong>{label}:</strong> ")


def popup_text(magnitude="magnitude", place="place", depth="depth", time="time") -> Column:
    """The event popup text (HTML fragment); a missing field reads ``unknown``, so the text is never null."""
    m, p, d, t = (_labelled(x) for x in EVENT_LABELS)
    return F.concat(m, _shown(col_of(magnitude)), F.lit("<br>"), p, _shown(col_of(place)), F.lit("<br>"),
                    d, _shown(col_of(depth)), F.lit(" km<br>"), t, _shown(ts_text(time)), F.lit("<br>"))


def forecast_popup(pred="predicted_magnitude", confidence="confidence", zone="zone") -> Column:
    """The forecast popup text, magnitude with one decimal."""
    m, c, z = (_labelled(x) for x in FORECAST_LABELS)
    text = F.when(col_of(pred).isNotNull(), fixed(pred, 1))
    return F.concat(m, _shown(text), F.lit("<br>"), c, _shown(col_of(confidence)), F.lit("<br>"), z, _shown(col_of(zone)))


def forecast_markers(forecast):
    """One marker row per forecast point."""
    return forecast.select("latitude", "longitude", F.lit(8).alias("radius"), forecast_colour().alias("color"), forecast_popup().alias("popup"))


def forecast_colour(confidence="confidence", pred="predicted_magnitude") -> Column:
    """Colour by confidence and by predicted magnitude (≥ 6, ≥ 5, else)."""
    # Colour names by confidence and magnitude.
    conf, p = col_of(confidence), col_of(pred)
    high = F.when(p >= 6.0, "red").when(p >= 5.0, "orange").otherwise("yellow")
    medium = F.when(p >= 6.0, "lightred").when(p >= 5.0, "lightorange").otherwise("lightyellow")
    return F.when(conf == "High", high).otherwise(medium)


def forecast_bucket(pred="predicted_magnitude", buckets=FORECAST_BUCKETS) -> Column:
    """Right-closed interval label; values outside every bucket (e.g. exactly 4.0) → null."""
    p = col_of(pred)
    expr = None
    for lo, hi, label in buckets:
        cond = (p > lo) if hi is None else ((p > lo) & (p <= hi))
        expr = F.when(cond, label) if expr is None else expr.when(cond, label)
    return expr
