"""The station search against a plain loop over all stations, and its edge cases."""

import datetime as dt
import math
import random

import pytest

from fairweather.operators import stations as st

AS_OF = dt.datetime(2026, 12, 1)
KEYS = "latitude double, longitude double, departement string, day date"
STATIONS = (
    "id string, departement string, list_pos bigint, lat double, lon double, "
    "poste_ouvert boolean, date_debut string, date_fin string"
)
DAY = dt.date(2024, 6, 1)


def search(spark, keys, stations):
    found = st.nearest_station(
        spark.createDataFrame(keys, KEYS), spark.createDataFrame(stations, STATIONS), AS_OF
    )
    return {tuple(r)[:4]: r.station_id for r in found.collect()}


def station(id, lat, lon, *, dept="31", pos=0, is_open=True, start="2000-01-01 00:00:00", end=""):
    return (id, dept, pos, lat, lon, is_open, start, end)


def by_looping(keys, stations):
    def stamp(text):
        return dt.datetime.strptime(text, "%Y-%m-%d %H:%M:%S")

    result = {}
    for lat, lon, dept, day in keys:
        best, least = None, math.inf
        for id, s_dept, _, s_lat, s_lon, is_open, start, end in sorted(stations, key=lambda s: s[2]):
            if s_dept != dept or is_open is False or s_lat is None or s_lon is None or day is None:
                continue
            midnight = dt.datetime.combine(day, dt.time())
            if not stamp(start) <= midnight <= (stamp(end) if end else AS_OF):
                continue
            distance = math.sqrt((lat - s_lat) ** 2 + (lon - s_lon) ** 2)
            if distance < least:
                best, least = id, distance
        result[(lat, lon, dept, day)] = best
    return result


@pytest.mark.parametrize("seed", range(4))
def test_search_equals_a_loop_over_all_stations(spark, seed):
    rng = random.Random(seed)
    # clusters of very different density, on a grid so that exact ties occur,
    # on both sides of the zero meridian and the equator
    spread = [0.02, 0.3, 4.0, 30.0][seed]

    def point():
        centre = rng.choice([(0.0, 0.0), (43.6, 1.4), (-21.1, 55.5)])
        step = spread / 8
        return tuple(round(c + step * rng.randint(-8, 8), 6) for c in centre)

    def day(first=1990, last=2030):
        return dt.date(rng.randint(first, last), rng.randint(1, 12), rng.randint(1, 28))

    stations = []
    for i in range(150):
        opened = day(1990, 2026)
        closed = f"{opened + dt.timedelta(days=rng.choice([20, 200, 2000, 9000]))} 00:00:00"
        stations.append((
            f"s{i}", rng.choice(["1", "2", "2A"]), i, *point(), rng.choice([True, True, None, False]),
            f"{opened} {rng.choice(['00:00:00', '06:00:00'])}", rng.choice([closed, closed, "", None]),
        ))
    keys = {(*point(), rng.choice(["1", "2", "2A", "3"]), rng.choice([day(), day(), None])) for _ in range(600)}
    assert search(spark, sorted(keys, key=repr), stations) == by_looping(keys, stations)


def test_at_equal_distance_the_first_listed_wins(spark):
    stations = [station("late", 1.0, 2.0, pos=7), station("early", 1.0, 4.0, pos=3)]
    assert search(spark, [(1.0, 3.0, "31", DAY)], stations) == {(1.0, 3.0, "31", DAY): "early"}


@pytest.mark.parametrize(
    ("other", "wins"),
    [
        (station("x", 1.0, 1.0, start="2024-06-01 06:00:00"), False),  # opens later that day
        (station("x", 1.0, 1.0, start="2024-06-01 00:00:00"), True),
        (station("x", 1.0, 1.0, end="2024-06-01 00:00:00"), True),
        (station("x", 1.0, 1.0, end="2024-05-31 23:59:59"), False),
        (station("x", 1.0, 1.0, is_open=False), False),
        (station("x", 1.0, 1.0, is_open=None), True),
        (station("", 1.0, 1.0), False),
        (station(None, 1.0, 1.0), False),
        (station("x", float("nan"), 1.0), False),
        (station("x", 1.0, None), False),
        (station("x", 1.0, 1.0, start=None), False),
        (station("x", 1.0, 1.0, start="2024"), False),
        (station("x", 1.0, 1.0, end="later"), False),
        (station("x", 1.0, 1.0, dept="32"), False),
        (station("x", 1.0, 1.0, dept="031"), True),
    ],
)
def test_which_station_can_win(spark, other, wins):
    key = (1.0, 1.0, "31", DAY)
    assert search(spark, [key], [station("far", 9.0, 9.0, pos=9), other])[key] == ("x" if wins else "far")


def test_days_after_as_of_need_a_later_end(spark):
    future = dt.date(2030, 1, 1)
    key = (1.0, 1.0, "31", future)
    stations = [station("open", 1.0, 1.0), station("planned", 2.0, 2.0, end="2031-01-01 00:00:00")]
    assert search(spark, [key], stations)[key] == "planned"
    assert search(spark, [key], stations[:1])[key] is None


def test_places_without_a_finite_position_have_no_station(spark):
    keys = [(float("inf"), 1.0, "31", DAY), (1e300, 1.0, "31", DAY)]
    found = search(spark, keys, [station("s", 1.0, 1.0)])
    # the square of 1e300 is infinite
    assert set(found.values()) == {None}
    nan = st.nearest_station(
        spark.createDataFrame([(float("nan"), 1.0, "31", DAY)], KEYS),
        spark.createDataFrame([station("s", 1.0, 1.0)], STATIONS),
        AS_OF,
    ).collect()
    assert [r.station_id for r in nan] == [None]


def test_keys_keep_their_other_columns(spark):
    keys = spark.createDataFrame([(1.0, 1.0, "31", DAY, 5), (2.0, 1.0, "31", None, 6)], f"{KEYS}, n int")
    found = st.nearest_station(keys, spark.createDataFrame([station("s", 1.0, 1.0)], STATIONS), AS_OF)
    assert found.columns == [*keys.columns, "station_id"]
    assert sorted((r.n, r.station_id) for r in found.collect()) == [(5, "s"), (6, None)]


def test_valid_stations_of_a_day(spark):
    stations = [
        station("a", 1.0, 1.0), station("b", 1.0, 1.0, start="2024-06-01 06:00:00"),
        station("c", 1.0, 1.0, end="2024-06-01 00:00:00"), station("d", 1.0, 1.0, dept="1"),
    ]
    later = DAY + dt.timedelta(days=3)
    days = spark.createDataFrame([("31", DAY), ("31", later), ("1", None)], "departement string, day date")
    valid = st.station_valid_on_day(days, spark.createDataFrame(stations, STATIONS), AS_OF)
    assert sorted(tuple(r) for r in valid.collect()) == [
        ("31", "a", DAY, later), ("31", "b", DAY + dt.timedelta(days=1), later), ("31", "c", DAY, DAY),
    ]


def test_stations_by_department(spark):
    stations = spark.createDataFrame(
        [("a", "01", None), ("b", "1", None), ("a", "1", "rr"), ("c", "2A", "rr"), ("c", "2A", None)],
        "id string, departement string, parametre string",
    )
    assert sorted(r.id for r in st.stations_by_department(stations, 1).collect()) == ["a", "b"]
    assert [r.id for r in st.stations_by_department(stations, 1, "rr").collect()] == ["a"]
    assert [r.id for r in st.stations_by_department(stations, "2A").collect()] == ["c"]
    assert st.stations_by_department(stations, "2A", "vent").count() == 0
    untold = stations.drop("parametre")
    assert st.stations_by_department(untold, 1).count() == 3
    with pytest.raises(ValueError, match="landed by parameter"):
        st.stations_by_department(untold, 1, "rr")


def count_candidates(spark, monkeypatch, keys, stations):
    """Pairs of a place and a station that the search compares by day."""
    monkeypatch.setattr(st, "_BEST", "SELECT c.*, 0 AS station_id FROM {candidates} c JOIN (SELECT DISTINCT place FROM {dated}) USING (place)")
    found = st.nearest_station(spark.createDataFrame(keys, KEYS), spark.createDataFrame(stations, STATIONS), AS_OF)
    return found.count()


@pytest.mark.parametrize("case", ["as_of year", "first year", "part-year stations"])
def test_the_search_is_bounded_on_every_day(spark, monkeypatch, case):
    draw = random.Random(1)
    spots = [(round(draw.uniform(0, 9), 3), round(draw.uniform(0, 9), 3)) for _ in range(200)]
    day = {"as_of year": dt.date(2026, 3, 1), "first year": dt.date(2000, 9, 1)}.get(case, dt.date(2024, 6, 1))
    starts = {"first year": "2000-05-01 00:00:00", "part-year stations": "2024-02-01 00:00:00"}
    ends = {"part-year stations": "2024-09-01 00:00:00"}
    stations = [
        station(f"s{n}", *spot, pos=n, start=starts.get(case, "1990-01-01 00:00:00"), end=ends.get(case, ""))
        for n, spot in enumerate(spots)
    ]
    places = [(round(draw.uniform(0, 9), 3), round(draw.uniform(0, 9), 3), "31") for _ in range(100)]
    days = [day, day + dt.timedelta(days=40), dt.date(day.year, 1, 5)]
    keys = [(*place, d) for place in places for d in days]
    quiet = [(*place, dt.date(2010, 3, 1)) for place in places]
    always = [station(f"s{n}", *spot, pos=n) for n, spot in enumerate(spots)]
    assert count_candidates(spark, monkeypatch, keys, stations) <= 4 * count_candidates(spark, monkeypatch, quiet, always)


def part_year(draw, n, spot=(0.0, 0.0)):
    """Stations in one square degree, each valid for a part of 2024."""
    found = []
    for i in range(n):
        first = dt.date(2024, 1, 20) + dt.timedelta(days=draw.randint(0, 60))
        last = dt.date(2024, 9, 1) + dt.timedelta(days=draw.randint(0, 60))
        place = (round(spot[0] + draw.random(), 3), round(spot[1] + draw.random(), 3))
        found.append(station(f"s{i}", *place, pos=i, start=f"{first} 00:00:00", end=f"{last} 00:00:00"))
    return found


@pytest.mark.parametrize("days", [(150, 200, 210), (3, 150, 200), (3, 100, 350)])
def test_one_far_station_that_is_always_valid_widens_nothing(spark, monkeypatch, days):
    draw = random.Random(7)
    near, far = part_year(draw, 200), station("far", 7.0, 7.0, pos=999)
    places = [(round(draw.random(), 3), round(draw.random(), 3), "31") for _ in range(150)]
    keys = [(*place, dt.date(2024, 1, 1) + dt.timedelta(days=d)) for place in places for d in days]
    assert search(spark, keys, [*near, far]) == by_looping(keys, [*near, far])
    alone = count_candidates(spark, monkeypatch, keys, near)
    together = count_candidates(spark, monkeypatch, keys, [*near, far])
    # days on which only the far station is valid have it as their one candidate
    quiet = sum(1 for d in days if d < 15 or d > 320) * len(places)
    assert together <= 4 * alone + quiet
    assert together < 0.2 * len(keys) * len(near)


def test_stations_that_follow_each_other_bound_the_distance_together(spark, monkeypatch):
    draw = random.Random(8)
    spots = [(round(draw.uniform(0, 9), 3), round(draw.uniform(0, 9), 3)) for _ in range(200)]
    halves = [("2023-01-01 00:00:00", "2024-06-30 00:00:00"), ("2024-07-01 00:00:00", "")]
    stations = [
        station(f"s{n}-{h}", *spot, pos=2 * n + h, start=start, end=end)
        for n, spot in enumerate(spots)
        for h, (start, end) in enumerate(halves)
    ]
    always = [station(f"s{n}", *spot, pos=n) for n, spot in enumerate(spots)]
    keys = [(*spot, "31", dt.date(2024, month, 1)) for spot in spots[:50] for month in (2, 6, 7, 11)]
    assert search(spark, keys, stations) == by_looping(keys, stations)
    assert count_candidates(spark, monkeypatch, keys, stations) <= 2 * count_candidates(spark, monkeypatch, keys, always)


def test_covered_periods_join_what_touches(spark):
    stations = [
        station("a", 1.0, 1.0, start="2024-01-01 00:00:00", end="2024-01-10 00:00:00"),
        station("b", 1.001, 1.002, start="2024-01-11 00:00:00", end="2024-01-20 00:00:00"),
        station("c", 1.002, 1.001, start="2024-02-01 00:00:00", end="2024-02-02 12:00:00"),
        station("d", 1.0, 1.0, start="2024-02-02 06:00:00", end="2024-02-02 23:00:00"),  # valid on no day
        station("e", 1.003, 1.0, start="2024-01-15 00:00:00", end="2024-01-16 00:00:00"),
    ]
    listed = st._first_listed(st.station_validity(spark.createDataFrame(stations, STATIONS), AS_OF))
    covered = st.station_coverage(listed).collect()
    day = dt.date(2024, 1, 1).toordinal() - dt.date(1970, 1, 1).toordinal()
    for level in range(st.WHOLE + 1):
        rows = sorted((r.first_day - day, r.last_day - day, r.south, r.north, r.west, r.east) for r in covered if r.level == level)
        assert rows == [(0, 19, 1.0, 1.003, 1.0, 1.002), (31, 32, 1.002, 1.002, 1.001, 1.001)]


def test_the_search_never_pairs_everything(spark):
    keys = spark.createDataFrame([(1.0, 1.0, "31", DAY)], KEYS)
    stations = spark.createDataFrame([station("s", 1.0, 1.0)], STATIONS)
    plan = st.nearest_station(keys, stations, AS_OF)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
