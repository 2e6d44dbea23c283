"""Weather stations: which are usable, which are valid on a day, which is nearest to a place.

Stations are frames with columns ``id, departement, list_pos, lat, lon,
poste_ouvert, date_debut, date_fin``; see ``join_station_info`` to get there
from a station list and station information read apart.
"""

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fairweather.functions.dates import parse_validity
from fairweather.functions.geo import degree_distance
from fairweather.functions.text import department_key
from fairweather.session import Scratch

PLACE_DAY = ["latitude", "longitude", "departement", "day"]

# The search grid: cells of 0.01 degrees (about a kilometre), doubled ten times
# to about ten degrees, and on top one cell for a whole department.
FINEST_CELL = 0.01
LEVELS = 11
WHOLE = LEVELS


def join_station_info(stations: DataFrame, information: DataFrame) -> DataFrame:
    """Add validity to a station list; stations without information are left out."""
    return stations.join(information, "id")


def filter_open_stations(stations: DataFrame) -> DataFrame:
    """Drop stations that are marked closed; an unknown state counts as open."""
    return stations.where(F.coalesce(F.col("poste_ouvert"), F.lit(True)))


def filter_usable_stations(stations: DataFrame) -> DataFrame:
    """Drop stations without an id or without finite coordinates."""
    has_id = F.col("id").isNotNull() & ~F.col("id").isin("", "0")
    placed = [
        F.col(c).isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf")) for c in ("lat", "lon")
    ]
    return stations.where(has_id & placed[0] & placed[1])


def stations_by_department(
    stations: DataFrame, department: str | int, parameter: str | None = None
) -> DataFrame:
    """Stations of a department, optionally only those that measure a parameter.

    Which ones do is known from lists that were landed by parameter: the column
    ``parametre`` of ``read_station_list(…, by_parameter=True)``, null in the
    lists of all stations. Both filters are on columns of the layout, so only the
    folders that they name are read.
    """
    code = department_key(F.lit(str(department)))
    chosen = stations.where(department_key(F.col("departement")) == code)
    if "parametre" in stations.columns:
        return chosen.where(F.col("parametre").eqNullSafe(F.lit(parameter)))
    if parameter is not None:
        raise ValueError("the stations do not tell their parameters: read lists that were landed by parameter")
    return chosen


def station_validity(stations: DataFrame, as_of: dt.datetime) -> DataFrame:
    """Usable open stations with ``valid_from`` and ``valid_to``; unreadable validity drops out."""
    valid_from, valid_to = parse_validity(F.col("date_debut"), F.col("date_fin"), as_of)
    return (
        filter_usable_stations(filter_open_stations(stations))
        .select(
            "id",
            department_key(F.col("departement")).alias("departement"),
            "list_pos",
            "lat",
            "lon",
            valid_from.alias("valid_from"),
            valid_to.alias("valid_to"),
        )
        .where(F.col("valid_from") <= F.col("valid_to"))
    )


def _valid_days() -> tuple[Column, Column]:
    """First and last valid day. It is judged at midnight: a station that opens at 06:00 is not valid that day."""
    opens = F.col("valid_from").cast("date")
    later = F.col("valid_from") > opens.cast("timestamp_ntz")
    return F.when(later, F.date_add(opens, 1)).otherwise(opens), F.col("valid_to").cast("date")


def station_valid_on_day(days: DataFrame, stations: DataFrame, as_of: dt.datetime) -> DataFrame:
    """The days on which each station is valid: ``departement, station_id, first_day, last_day``.

    Validity is clipped to the days asked for in the station's department; a
    station that is valid on none between the first and the last of them is left
    out. One row per listed station, however many days are asked for.
    """
    asked = (
        days.where(F.col("day").isNotNull())
        .groupBy("departement")
        .agg(F.min("day").alias("first_asked"), F.max("day").alias("last_asked"))
    )
    opens, closes = _valid_days()
    return (
        station_validity(stations, as_of)
        .join(asked, "departement")
        .select(
            "departement",
            F.col("id").alias("station_id"),
            F.greatest("first_asked", opens).alias("first_day"),
            F.least("last_asked", closes).alias("last_day"),
        )
        .where(F.col("first_day") <= F.col("last_day"))
    )


def _cell_size(level: str) -> str:
    return f"({FINEST_CELL}D * shiftleft(1L, {level}))"


def _own_cells(latitude: str, longitude: str) -> str:
    """SQL for the cell of a point at level ``l.level``."""
    size = _cell_size("l.level")
    return f"""
        l.level AS level,
        CASE WHEN l.level = {WHOLE} THEN 0 ELSE floor({latitude} / {size}) END AS cell_x,
        CASE WHEN l.level = {WHOLE} THEN 0 ELSE floor({longitude} / {size}) END AS cell_y"""


def _cells_within(coordinate: str) -> str:
    """SQL for the cells, at the row's level, that meet a coordinate plus or minus the reach."""
    size = _cell_size("level")
    low, high = f"floor(({coordinate} - reach) / {size})", f"floor(({coordinate} + reach) / {size})"
    return f"CASE WHEN level = {WHOLE} THEN array(0L) ELSE sequence({low}, {high}) END"


def _first_listed(stations: DataFrame) -> DataFrame:
    """Stations with the days they are valid on, as numbers.

    Of stations with one position and validity only the first in the list can win.
    """
    opens, closes = _valid_days()
    same = ["departement", "lat", "lon", "opens", "closes"]
    first = F.min(F.struct("list_pos", "id")).alias("first")
    return (
        stations.withColumns({"opens": F.unix_date(opens), "closes": F.unix_date(closes)})
        .where("opens <= closes")
        .groupBy(*same)
        .agg(first)
        .select(*same, "first.list_pos", "first.id")
    )


_CELL = "departement, level, cell_x, cell_y"

# The stations, or what was made of them in smaller cells, in the cells of some levels.
_BOXES = """
SELECT departement, first_day, last_day, south, north, west, east, {own_cells}
FROM {{boxes}} LATERAL VIEW explode(sequence({first}, {last})) l AS level
"""

# The periods in which a cell has a valid station on every day, as long as they
# go, with the box around the stations of each. Stations that are valid one after
# the other make one period together.
_COVERED = f"""
SELECT {_CELL}, min(first_day) AS first_day, max(last_day) AS last_day,
       min(south) AS south, max(north) AS north, min(west) AS west, max(east) AS east
FROM (
    SELECT *, sum(starts) OVER (
        PARTITION BY {_CELL} ORDER BY first_day, last_day ROWS UNBOUNDED PRECEDING
    ) AS period
    FROM (
        SELECT *, CASE WHEN first_day <= 1 + max(last_day) OVER (
            PARTITION BY {_CELL} ORDER BY first_day, last_day ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING
        ) THEN 0 ELSE 1 END AS starts
        FROM {{boxes}}
    )
)
GROUP BY {_CELL}, period
"""

# Small cells are covered by stations, large ones by the periods of cells of this level.
MIDDLE = 5


def station_coverage(stations: DataFrame) -> DataFrame:
    """The search tree: for every cell of every level the periods in which it is covered.

    ``stations`` are as from ``_first_listed``. Columns: ``departement, level,
    cell_x, cell_y, first_day, last_day`` (days as numbers) and the box ``south,
    north, west, east`` of the stations of the period. Large cells are made of
    the periods of smaller ones, so that no task sorts all stations of a
    department.
    """
    sql = stations.sparkSession.sql
    points = stations.selectExpr(
        "departement", "opens AS first_day", "closes AS last_day",
        "lat AS south", "lat AS north", "lon AS west", "lon AS east",
    )
    own = _own_cells("south", "west")
    small = sql(_COVERED, boxes=sql(_BOXES.format(own_cells=own, first=0, last=MIDDLE), boxes=points))
    middle = small.where(F.col("level") == MIDDLE).drop("level", "cell_x", "cell_y")
    # a cell lies in one cell of each higher level: any of its points tells which
    large = sql(_COVERED, boxes=sql(_BOXES.format(own_cells=own, first=MIDDLE + 1, last=WHOLE), boxes=middle))
    return small.unionByName(large)


_STATION_CELLS = f"""
SELECT s.*, {_own_cells("s.lat", "s.lon")}
FROM {{stations}} s LATERAL VIEW explode(sequence(0, {WHOLE})) l AS level
"""


def _square(expression: str) -> str:
    return f"({expression} * {expression})"


# Distance from a place to the far side of a box.
_FAR_LAT = "greatest(abs(latitude - south), abs(latitude - north))"
_FAR_LON = "greatest(abs(longitude - west), abs(longitude - east))"
_FAR = f"sqrt({_square(_FAR_LAT)} + {_square(_FAR_LON)})"

# A place looks up its own cell at each level, where it is covered in the place's
# period: on each day of a covered period some station lies in the box, and none
# of them is farther than the far corner.
_LOOKED_UP = f"""
SELECT place, latitude, longitude, departement, p.first_day, p.last_day, level,
       c.first_day AS covered_from, c.last_day AS covered_to, {_FAR} AS far
FROM (
    SELECT p.*, {_own_cells("p.latitude", "p.longitude")}
    FROM {{places}} p LATERAL VIEW explode(sequence(0, {WHOLE})) l AS level
) p JOIN {{coverage}} c USING (departement, level, cell_x, cell_y)
WHERE c.first_day <= p.last_day AND c.last_day >= p.first_day
"""

# A distance within which there surely is a station all the time, null if no cell is
# covered all the time; and the one that would do for some of the days.
_BOUNDS = """
SELECT place, latitude, longitude, departement, first_day, last_day,
       min(CASE WHEN covered_from <= first_day AND covered_to >= last_day THEN far END) AS reach,
       min(far) AS hope
FROM {looked_up}
GROUP BY place, latitude, longitude, departement, first_day, last_day
"""
# A place whose reach is larger than this many times the hope is searched day by day.
LOOSE = 2

# The cells that meet the square of the reach around a place, at the level whose
# cells are at least that large: at most four by four. The margin is above
# rounding, so that no station on the edge is missed.
_SEARCHED = f"""
SELECT l.*, x.cell_x, y.cell_y
FROM (
    SELECT *, CAST(least(greatest(ceil(log2(reach / {FINEST_CELL}D)), 0), {WHOLE}) AS INT) AS level
    FROM (SELECT place, latitude, longitude, departement, first_day, last_day, reach * 1.000001D + 1e-9D AS reach FROM {{reaches}})
) l
LATERAL VIEW explode({_cells_within("latitude")}) x AS cell_x
LATERAL VIEW explode({_cells_within("longitude")}) y AS cell_y
"""

# How many levels a search goes down before it looks at stations.
DOWN = 2

# Covered periods of cells below, by the cell that a search starts from.
_BELOW = f"""
SELECT departement, level AS own_level, cell_x AS own_x, cell_y AS own_y,
       first_day AS covered_from, last_day AS covered_to, south, north, west, east,
       {_own_cells("south", "west").replace("l.level", "up")}
FROM {{coverage}} LATERAL VIEW explode(CASE
    WHEN level = 0 THEN sequence(0, {DOWN}) WHEN level + {DOWN} <= {WHOLE} THEN array(level + {DOWN}) END) l AS up
"""

_NEAR_LAT = "greatest(south - latitude, latitude - north, 0D)"
_NEAR_LON = "greatest(west - longitude, longitude - east, 0D)"

# Of the cells below those that are covered on some day of the period and whose
# stations can lie within the reach.
_ENTERED = f"""
SELECT DISTINCT place, latitude, longitude, departement, first_day, last_day, reach,
       own_level AS level, own_x AS cell_x, own_y AS cell_y
FROM {{searched}} JOIN {{below}} USING (departement, level, cell_x, cell_y)
WHERE covered_from <= last_day AND covered_to >= first_day
  AND {_square(_NEAR_LAT)} + {_square(_NEAR_LON)} <= {_square("reach")}
"""

# Of the stations in these cells those that can be nearest on some day: none that is
# not valid in the period or beyond the reach, and never one at an infinite or
# undefined distance.
_CANDIDATES = """
SELECT place, first_day, last_day, distance, list_pos, id, opens, closes
FROM {met}
WHERE opens <= last_day AND closes >= first_day AND distance < double('infinity') AND distance <= reach
"""

_BEST = """
SELECT /* columns */, min(CASE
           WHEN unix_date(d.day) BETWEEN c.opens AND c.closes
           THEN struct(c.distance, c.list_pos, c.id) END).id AS station_id
FROM {dated} d LEFT JOIN {candidates} c ON d.place = c.place AND unix_date(d.day) BETWEEN c.first_day AND c.last_day
GROUP BY d.place, /* columns */
"""


def _reaches(dated: DataFrame, coverage: DataFrame, scratch: Scratch) -> DataFrame:
    """How far to search: ``place, latitude, longitude, departement, first_day, last_day, reach``.

    A place and year is one row where a reach for all its days is about as good
    as that for its best day, and otherwise one row for each day. Places that have
    no station on a day have no row for it.
    """
    sql = dated.sparkSession.sql
    place = ["place", "latitude", "longitude", "departement"]
    day = F.unix_date("day")
    asked = dated.where(F.col("place").isNotNull())
    places = asked.groupBy(*place).agg(F.min(day).alias("first_day"), F.max(day).alias("last_day"))
    bounds = scratch.materialize(
        sql(_BOUNDS, looked_up=sql(_LOOKED_UP, places=places, coverage=coverage)), "bounds"
    )
    tight = F.coalesce(F.col("reach") <= LOOSE * F.col("hope"), F.lit(False))
    days = asked.join(bounds.where(~tight).select("place"), "place").select(
        *place, day.alias("first_day"), day.alias("last_day")
    )
    by_day = sql(_BOUNDS, looked_up=sql(_LOOKED_UP, places=days.distinct(), coverage=coverage))
    return bounds.where(tight).unionByName(by_day).drop("hope")


def nearest_station(
    keys: DataFrame, stations: DataFrame, as_of: dt.datetime, scratch: Scratch | None = None
) -> DataFrame:
    """The nearest station of the department that is usable, open and valid on the day.

    ``keys`` has distinct ``latitude, longitude, departement, day`` (department
    keys as from ``department_key``, ``day`` a date or null) and may have more
    columns. Returns them with ``station_id``, null where there is none.
    Distance is Euclidean in degrees; at equal distance the station listed
    first wins. The keys are read several times: pass a written table
    (``session.materialize``) if they are costly to make.

    Stations are searched once per place and year through a tree of cells, not
    once per day and not by pairing each key with its whole department. The
    cells know when they are covered by valid stations, whichever these are, so
    a distance within which there is a station every day is found even where no
    station is valid all the time. Where that distance is large for some days
    only, these days are searched apart. The tree and the distances are written
    to the scratch folder, where they stay unless ``scratch`` removes them. A place and year has at most 366 keys, so the last
    join has no hot key; the joins on cells may, and adaptive execution splits
    those: nothing downstream needs their partitioning.
    """
    sql, scratch = keys.sparkSession.sql, scratch or Scratch(keys.sparkSession)
    listed = _first_listed(station_validity(stations, as_of))
    coverage = scratch.materialize(station_coverage(listed), "coverage")
    # One text for place and year: a key of doubles would be normalised, and
    # shuffled, anew for every join and aggregation.
    place = F.concat_ws("_", "latitude", "longitude", F.year("day").cast("string"), "departement")
    dated = keys.withColumn("place", F.when(F.col("day").isNotNull(), place))
    searched = sql(_SEARCHED, reaches=_reaches(dated, coverage, scratch))
    entered = sql(_ENTERED, searched=searched, below=sql(_BELOW, coverage=coverage))
    met = entered.join(sql(_STATION_CELLS, stations=listed), _CELL.split(", ")).withColumn(
        "distance", degree_distance(F.col("latitude"), F.col("longitude"), F.col("lat"), F.col("lon"))
    )
    candidates = sql(_CANDIDATES, met=met)
    columns = ", ".join(f"d.`{name}`" for name in keys.columns)
    return sql(_BEST.replace("/* columns */", columns), dated=dated, candidates=candidates)
