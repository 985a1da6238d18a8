"""Scalar expressions on columns: angles, clipping, digitising, ratios, identifiers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def azimuth(dx: Column, dy: Column) -> Column:
    """Compass direction in degrees, 0 is north."""
    return F.degrees(F.atan2(dx, dy))


def heading(dx: Column, dy: Column) -> Column:
    """Mathematical direction in degrees, 0 is east."""
    return F.degrees(F.atan2(dy, dx))


def turned(a: Column, b: Column) -> Column:
    """a - b, brought to -180 <= x < 180."""
    return F.pmod(a - b + 180.0, F.lit(360.0)) - 180.0


def turn_class(delta: Column, straight: float = 25.0, most: float = 120.0, u_turn: float = 170.0) -> Column:
    """straight, left, right or u_turn; null for what lies between a turn and a U-turn."""
    return (
        F.when(F.abs(delta) <= straight, "straight")
        .when((delta > straight) & (delta <= most), "left")
        .when((delta >= -most) & (delta < -straight), "right")
        .when(F.abs(delta) >= u_turn, "u_turn")
    )


def turn_class_through(delta: Column, straight: float = 25.0, limit: float = 170.0) -> Column:
    """The wider form for paths through junctions: everything else counts as straight."""
    return (
        F.when((delta > straight) & (delta < limit), "left")
        .when((delta < -straight) & (delta > -limit), "right")
        .when(F.abs(delta) >= limit, "u_turn")
        .otherwise("straight")
    )


def clip(x: Column, low: Column | float | None, high: Column | float | None) -> Column:
    """x within bounds; null stays null (greatest and least would skip it)."""
    out = x
    if low is not None:
        out = F.greatest(F.lit(low) if not isinstance(low, Column) else low, out)
    if high is not None:
        out = F.least(F.lit(high) if not isinstance(high, Column) else high, out)
    return F.when(x.isNotNull(), out)


def digitize(x: Column, bounds: Column) -> Column:
    """How many of the ascending bounds are <= x."""
    return F.size(F.filter(bounds, lambda b: b <= x))


def lane_of(x: Column, bounds: Column) -> tuple[Column, Column]:
    """(lane index from 0, whether x lies outside); x on the last bound is outside."""
    n, i = F.size(bounds), digitize(x, bounds)
    return F.greatest(F.lit(1), F.least(n - 1, i)) - 1, (i == 0) | (i == n)


def rtsm(temporal: Column, spatial: Column, t_limit: Column, s_limit: Column, invalid: bool = True) -> Column:
    """Relative distance below both speed thresholds, 0 (free) to 1 (standing).

    With ``invalid``, -1 thresholds give -1 and a speed of -1 gives 1; without, a worst
    case of 0 or less gives 0.
    """
    worst = t_limit + s_limit
    below = F.greatest(F.lit(0.0), t_limit - temporal) + F.greatest(F.lit(0.0), s_limit - spatial)
    value = clip(F.try_divide(below, worst), 0.0, 1.0)
    if not invalid:
        return F.when(worst <= 0, 0.0).otherwise(value)
    return F.when((t_limit == -1) | (s_limit == -1), -1.0).when(worst == 0, 0.0).when((temporal == -1) | (spatial == -1), 1.0).otherwise(value)


def vehicle_length(kind: Column, car: float = 5.0, other: float = 12.5) -> Column:
    return F.when(kind.isin("Car", "Taxi"), car).otherwise(other)


def truthy(x: Column) -> Column:
    """Booleans that come as text."""
    return F.coalesce(F.lower(F.trim(x.cast("string"))).isin("true", "yes", "1"), F.lit(False))


def numbers_in(x: Column) -> Column:
    """All integers in a text such as '[12, 7]' or '12', as strings."""
    return F.regexp_extract_all(x.cast("string"), F.lit("(\\d+)"), F.lit(1))


def group_id(ids: Column) -> Column:
    """A short stable name for a set of integer ids."""
    return F.left(F.sha1(F.array_join(F.array_sort(ids), ",").cast("binary")), F.lit(12))


def halved_lanes(lanes: Column, oneway: Column) -> Column:
    """Lanes of one direction when the number counts both."""
    return F.when(~oneway, F.greatest(F.lit(1), F.ceil(lanes / 2))).otherwise(lanes)


def bucket(t: Column, width: float) -> Column:
    return F.floor(t / width) * width


def effective_speed(spatial: Column, empirical: Column, fallback: float = 10.0) -> Column:
    return F.coalesce(F.nullif(spatial, F.lit(-1.0)), F.nullif(empirical, F.lit(-1.0)), F.lit(fallback))


def zone(ds: Column, dd: Column, reach: float = 50.0, side: float = 1.6) -> Column:
    """One of six zones around a vehicle; null outside, and for its own place in lane."""
    name = (
        F.when((F.abs(dd) <= side) & (ds > 0), "proceeding").when((F.abs(dd) <= side) & (ds < 0), "following")
        .when((dd > side) & (ds >= 0), "left_front").when((dd > side) & (ds < 0), "left_back")
        .when((dd < -side) & (ds >= 0), "right_front").when((dd < -side) & (ds < 0), "right_back")
    )
    return F.when(F.abs(ds) <= reach, name)


def speeds_in_ms(kmh: Column) -> Column:
    return kmh / 3.6


def one_of(value: Column, options: Sequence[str]) -> Column:
    """Pick an option by an integer's remainder."""
    return F.element_at(F.lit(list(options)), F.pmod(value, F.lit(len(options))).cast("int") + 1)


def milliseconds(t: Column) -> Column:
    """Whole milliseconds of seconds, cut off towards zero."""
    return (t * 1000).cast("bigint")


def first_element(x: Column) -> Column:
    """The first of a list of tags; null if there is none."""
    return F.try_element_at(x, F.lit(1))


def is_signal(tags: Column) -> Column:
    """Whether a node's tags (a map) make it a traffic signal, of a road or of a crossing."""
    text = lambda k: F.coalesce(tags[k], F.lit(""))
    return text("highway").contains("traffic_signals") | text("crossing").contains("traffic_signals") | F.lower(text("crossing:signals")).isin("yes", "true", "1")


def is_tagged(x: Column) -> Column:
    """Whether a tag says anything: not null, and no word for nothing."""
    return F.coalesce(~F.lower(F.trim(x)).isin("none", "nan", "no", "", "null", "<na>"), F.lit(False))


def is_named(x: Column) -> Column:
    """Whether an id is there: not null, blank or 'nan'."""
    return F.coalesce(~F.lower(F.trim(x)).isin("", "nan"), F.lit(False))
