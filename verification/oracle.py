"""SQL with the expected result of each query, for DuckDB over the same tables."""

from __future__ import annotations

from pedalgrid.schemas import FILE_PATTERNS, LEDGER_SOURCES
from verification.warehouse import SHAPES

NY = "AT TIME ZONE 'America/New_York'"


def _valid(clock: str) -> str:
    return f"((({clock}) {NY}) {NY} = ({clock}))"


def _late(clock: str) -> str:
    """The later instant of a wall clock that is shown twice."""
    early = f"least(({clock}) {NY}, (({clock}) {NY}) - CASE WHEN ((({clock}) {NY}) - INTERVAL 1 HOUR) {NY} = ({clock}) THEN INTERVAL 1 HOUR ELSE INTERVAL 0 HOUR END)"
    return f"CASE WHEN ({early} + INTERVAL 1 HOUR) {NY} = ({clock}) THEN {early} + INTERVAL 1 HOUR ELSE {early} END"


# Named subqueries in dependency order: name -> (needs, body).
PARTS: dict[str, tuple[tuple[str, ...], str]] = {
    "rides": (
        (),
        """
        SELECT event_id, CAST(event_id AS VARCHAR) AS ride_id, event_type, CAST(value AS DECIMAL(12,2)) AS v, user_id,
               CASE WHEN event_type = 'click' THEN date_trunc('second', s0) ELSE s0 END AS started,
               CASE WHEN event_type = 'click' THEN date_trunc('second', e0) ELSE e0 END AS ended,
               CASE WHEN CAST(value AS DECIMAL(12,2)) BETWEEN 0.5 AND 1 THEN NULL ELSE CAST(user_id AS VARCHAR) END AS station,
               CASE WHEN event_type IN ('purchase', 'signup') THEN 'member' ELSE 'casual' END AS member_casual
        FROM (SELECT *, s0 + to_milliseconds(CAST(round(value * 300000) AS BIGINT)) AS e0
              FROM (SELECT *, date_trunc('milliseconds', ts + INTERVAL 60 DAY) AS s0 FROM events))""",
    ),
    "timed": (
        ("rides",),
        f"""
        SELECT *, CASE WHEN v BETWEEN 100 AND 105 THEN NULL
                       WHEN {_valid('started')} AND {_valid('ended')}
                       THEN epoch_ms(ended {NY}) - epoch_ms(started {NY}) END AS duration_ms
        FROM rides""",
    ),
    "tagged": (
        ("timed",),
        """
        SELECT *, CASE WHEN station IS NULL THEN 'dropped_no_station'
                       WHEN duration_ms IS NULL THEN 'dropped_bad_timestamp'
                       WHEN duration_ms < 60000 THEN 'dropped_too_short'
                       WHEN duration_ms > 86400000 THEN 'dropped_too_long'
                       ELSE 'kept' END AS decision
        FROM timed""",
    ),
    "autumn": (
        ("rides",),
        f"""
        SELECT r.ride_id, r.station, s, e, {_late('s')} AS u, {_late('e')} AS v
        FROM rides r JOIN (SELECT event_id, TIMESTAMP '2024-11-03 00:00:00' + to_seconds(event_id % 10800) AS s,
                                  TIMESTAMP '2024-11-03 00:00:00' + to_seconds(event_id % 10800 + CAST(floor(value * 60 + 0.5) AS BIGINT)) AS e
                           FROM events) USING (event_id)""",
    ),
    "stations": (
        (),
        """
        SELECT CAST(s_suppkey AS VARCHAR) AS station, s_name, s_acctbal, r_name AS borough
        FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
    ),
    "t1": (
        ("tagged", "stations"),
        """
        SELECT ride_id, CAST(started AS DATE) AS date, coalesce(borough, 'Other') AS borough, event_type AS rideable_type,
               member_casual, CAST(((duration_ms + 300) // 600) * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(10,2)) AS minutes, station
        FROM tagged LEFT JOIN stations USING (station) WHERE decision = 'kept'""",
    ),
    "t2_rides": (
        ("t1",),
        """
        SELECT date, borough, count(*) AS total_rides, count(*) FILTER (member_casual = 'member') AS member_rides,
               CAST(((2 * CAST(sum(minutes) * 100 AS BIGINT) + count(*)) // (2 * count(*))) * CAST(0.01 AS DECIMAL(3,2))
                    AS DECIMAL(10,2)) AS avg_duration_min
        FROM t1 GROUP BY date, borough""",
    ),
    "permits": (
        (),
        f"""
        SELECT *, CASE WHEN NOT blank_start AND {_valid('clock')} THEN CAST(clock AS DATE) END AS date,
               CASE WHEN blank_start OR blank_borough THEN 'dropped_empty'
                    WHEN NOT {_valid('clock')} THEN 'dropped_bad_timestamp' ELSE 'kept' END AS decision
        FROM (SELECT o_orderkey, c_acctbal > 9500 AS blank_start, c_acctbal < 0 AS blank_borough,
                     TIMESTAMP '2024-03-01 00:15:00' + to_days(CAST(o_orderkey % 28 AS INTEGER))
                         + to_hours(CAST(o_custkey % 24 AS INTEGER)) AS clock,
                     CASE WHEN c_acctbal < 0 THEN '' ELSE r_name END AS borough,
                     CASE WHEN o_orderstatus = 'P' THEN '' ELSE o_orderpriority END AS type
              FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
                   JOIN region ON n_regionkey = r_regionkey)""",
    ),
    "t2_events": (
        ("permits",),
        """
        SELECT date, borough, count(*) AS event_count,
               coalesce(string_agg(DISTINCT nullif(type, ''), ';' ORDER BY nullif(type, '')), '') AS event_types
        FROM permits WHERE decision = 'kept' GROUP BY date, borough""",
    ),
    "weather_long": (
        (),
        """
        SELECT event_id, CAST(ts + INTERVAL 60 DAY AS DATE) AS date, value,
               CASE event_type WHEN 'view' THEN 'TMAX' WHEN 'click' THEN 'TMIN' WHEN 'error' THEN 'PRCP'
                               WHEN 'signup' THEN 'SNOW' ELSE 'WSPD' END AS datatype
        FROM events
        WHERE NOT (event_type IN ('view', 'click') AND day(ts + INTERVAL 60 DAY) = 30)
          AND NOT (event_type = 'click' AND day(ts + INTERVAL 60 DAY) IN (3, 10, 17, 24))""",
    ),
    "pivoted": (
        ("weather_long",),
        """
        SELECT date, max_by(value, event_id) FILTER (datatype = 'TMAX') AS tmax,
               max_by(value, event_id) FILTER (datatype = 'TMIN') AS tmin,
               max_by(value, event_id) FILTER (datatype = 'PRCP') AS prcp,
               max_by(value, event_id) FILTER (datatype = 'SNOW') AS snow
        FROM weather_long WHERE datatype <> 'WSPD' GROUP BY date""",
    ),
    "weather": (
        ("pivoted",),
        """
        SELECT date,
               CAST(coalesce((CAST(tmax AS DECIMAL(12,4)) + CAST(tmin AS DECIMAL(12,4))) * CAST(0.5 AS DECIMAL(2,1)),
                             CAST(tmax AS DECIMAL(12,4)), CAST(tmin AS DECIMAL(12,4))) AS DECIMAL(12,2)) AS temp,
               CAST(coalesce(prcp, 0) AS DECIMAL(12,2)) AS precip, CAST(coalesce(snow, 0) AS DECIMAL(12,2)) AS snow
        FROM pivoted""",
    ),
    "t2": (
        ("t2_rides", "t2_events", "weather"),
        """
        SELECT r.date, r.borough, total_rides, member_rides, avg_duration_min, temp, coalesce(precip, 0) AS precip,
               coalesce(snow, 0) AS snow, coalesce(event_count, 0) AS event_count, coalesce(event_types, '') AS event_types
        FROM t2_rides r LEFT JOIN weather w ON r.date = w.date
             LEFT JOIN t2_events e ON r.date = e.date AND r.borough = e.borough""",
    ),
    "t3a": (
        ("t2",),
        """
        SELECT borough,
               CAST(((200 * CAST(sum(total_rides) AS BIGINT) + count(*)) // (2 * count(*))) * CAST(0.01 AS DECIMAL(3,2))
                    AS DECIMAL(14,2)) AS mean,
               CAST(round(sqrt(CAST(sum(total_rides * total_rides) * count(*) - sum(total_rides) * sum(total_rides) AS DOUBLE))
                    / count(*), 2) AS DECIMAL(14,2)) AS stddev,
               list_sort(list(total_rides))[CAST(floor(CAST(0.2 AS DOUBLE) * (count(*) - 1)) AS INT) + 1] AS q20,
               list_sort(list(total_rides))[CAST(floor(CAST(0.4 AS DOUBLE) * (count(*) - 1)) AS INT) + 1] AS q40,
               list_sort(list(total_rides))[CAST(floor(CAST(0.6 AS DOUBLE) * (count(*) - 1)) AS INT) + 1] AS q60,
               list_sort(list(total_rides))[CAST(floor(CAST(0.8 AS DOUBLE) * (count(*) - 1)) AS INT) + 1] AS q80
        FROM t2 GROUP BY borough""",
    ),
    "t3c": (
        ("t2",),
        """
        SELECT borough, list_sort(list(event_count))[CAST(floor(CAST(0.33 AS DOUBLE) * (count(*) - 1)) AS INT) + 1] AS p33,
               list_sort(list(event_count))[CAST(floor(CAST(0.66 AS DOUBLE) * (count(*) - 1)) AS INT) + 1] AS p66
        FROM t2 WHERE event_count > 0 GROUP BY borough""",
    ),
    # Plain normal equations about the means, solved with Cramer's rule; an unused predictor gets an identity row.
    "means": (
        ("t2",),
        """
        SELECT *, CAST(temp AS DOUBLE) - avg(CAST(temp AS DOUBLE)) OVER b AS x1,
               CAST(precip AS DOUBLE) - avg(CAST(precip AS DOUBLE)) OVER b AS x2,
               CAST(snow AS DOUBLE) - avg(CAST(snow AS DOUBLE)) OVER b AS x3, total_rides - avg(total_rides) OVER b AS y
        FROM t2 WHERE temp IS NOT NULL WINDOW b AS (PARTITION BY borough)""",
    ),
    "cov": (
        ("means",),
        """
        SELECT borough, count(*) AS n, avg(CAST(temp AS DOUBLE)) AS m1, avg(CAST(precip AS DOUBLE)) AS m2,
               avg(CAST(snow AS DOUBLE)) AS m3, avg(total_rides) AS my,
               CAST(round(avg(total_rides), 2) AS DOUBLE) AS my2,
               sum(x1 * x1) > 1e-9 AS u1, sum(x2 * x2) > 1e-9 AS u2, sum(x3 * x3) > 1e-9 AS u3,
               sum(x1 * x1) AS s11, sum(x2 * x2) AS s22, sum(x3 * x3) AS s33, sum(x1 * x2) AS s12, sum(x1 * x3) AS s13,
               sum(x2 * x3) AS s23, sum(x1 * y) AS s1y, sum(x2 * y) AS s2y, sum(x3 * y) AS s3y, sum(y * y) AS syy
        FROM means GROUP BY borough""",
    ),
    "active": (
        ("cov",),
        """
        SELECT borough, n, m1, m2, m3, my, my2, u1, u2, u3, syy, s1y, s2y, s3y,
               CASE WHEN u1 THEN s11 ELSE 1 END AS a11, CASE WHEN u2 THEN s22 ELSE 1 END AS a22,
               CASE WHEN u3 THEN s33 ELSE 1 END AS a33, CASE WHEN u1 AND u2 THEN s12 ELSE 0 END AS a12,
               CASE WHEN u1 AND u3 THEN s13 ELSE 0 END AS a13, CASE WHEN u2 AND u3 THEN s23 ELSE 0 END AS a23,
               CASE WHEN u1 THEN s1y ELSE 0 END AS h1, CASE WHEN u2 THEN s2y ELSE 0 END AS h2,
               CASE WHEN u3 THEN s3y ELSE 0 END AS h3
        FROM cov""",
    ),
    "solved": (
        ("active",),
        """
        SELECT *, (h1 * (a22 * a33 - a23 * a23) - a12 * (h2 * a33 - a23 * h3) + a13 * (h2 * a23 - a22 * h3)) / det AS b1,
               (a11 * (h2 * a33 - a23 * h3) - h1 * (a12 * a33 - a23 * a13) + a13 * (a12 * h3 - h2 * a13)) / det AS b2,
               (a11 * (a22 * h3 - h2 * a23) - a12 * (a12 * h3 - h2 * a13) + h1 * (a12 * a23 - a22 * a13)) / det AS b3,
               CASE WHEN n < 4 THEN 'fallback_too_few_samples' WHEN det / (a11 * a22 * a33) < 1e-12 THEN 'fallback_singular'
                    ELSE 'fitted' END AS branch
        FROM (SELECT *, a11 * (a22 * a33 - a23 * a23) - a12 * (a12 * a33 - a23 * a13) + a13 * (a12 * a23 - a22 * a13) AS det
              FROM active)""",
    ),
    "t3b": (
        ("solved",),
        """
        SELECT borough,
               CAST(CASE WHEN branch = 'fitted' THEN round(my - b1 * m1 - b2 * m2 - b3 * m3, 4) ELSE my2 END AS DECIMAL(16,4)) AS beta0,
               CAST(CASE WHEN branch = 'fitted' THEN round(b1, 4) ELSE 0 END AS DECIMAL(16,4)) AS beta1_temp,
               CAST(CASE WHEN branch = 'fitted' THEN round(b2, 4) ELSE 0 END AS DECIMAL(16,4)) AS beta2_precip,
               CAST(CASE WHEN branch = 'fitted' THEN round(b3, 4) ELSE 0 END AS DECIMAL(16,4)) AS beta3_snow,
               CASE WHEN branch = 'fitted'
                    THEN round(sqrt(greatest(syy - b1 * s1y - b2 * s2y - b3 * s3y, 0) / n), 2) ELSE 0 END AS rmse
        FROM solved""",
    ),
    "stat": (
        ("t2", "t3a", "t3b", "t3c"),
        """
        SELECT t2.*, mean, stddev, q20, q40, q60, q80, p33, p66,
               CAST(round(greatest(beta0 + beta1_temp * temp + beta2_precip * precip + beta3_snow * snow, 0), 0) AS BIGINT)
                   AS forecast, beta0
        FROM t2 LEFT JOIN t3a USING (borough) LEFT JOIN t3b USING (borough) LEFT JOIN t3c USING (borough)""",
    ),
    "w": (
        ("stat",),
        """
        SELECT date, borough, total_rides, member_rides, CAST(avg_duration_min AS DOUBLE) AS avg_duration_min,
               CAST(temp AS DOUBLE) AS temp, CAST(precip AS DOUBLE) AS precip, CAST(snow AS DOUBLE) AS snow, event_types,
               CASE WHEN beta0 IS NOT NULL AND temp IS NOT NULL THEN forecast END AS expected_rides,
               CASE WHEN event_count = 0 THEN 'none' WHEN p33 IS NULL OR event_count <= p33 THEN 'low'
                    WHEN event_count <= p66 THEN 'medium' ELSE 'high' END AS event_intensity,
               coalesce(abs(total_rides - mean) > 2 * stddev, false) AS anomaly,
               CASE WHEN q20 IS NULL THEN 'average' WHEN total_rides <= q20 THEN 'low' WHEN total_rides <= q40 THEN 'below_average'
                    WHEN total_rides <= q60 THEN 'average' WHEN total_rides <= q80 THEN 'above_average' ELSE 'high' END
                   AS demand_level
        FROM stat""",
    ),
    "edges": (
        (),
        "SELECT * FROM (VALUES "
        + ", ".join(
            f"({order}, '{name}', {a[0]}::DOUBLE, {a[1]}::DOUBLE, {b[0]}::DOUBLE, {b[1]}::DOUBLE)"
            for order, (name, kind, coordinates) in enumerate(SHAPES)
            for part in (coordinates if kind == "MultiPolygon" else [coordinates])
            for ring in part
            for a, b in zip(ring, ring[1:])
        )
        + ") AS e(poly, name, x1, y1, x2, y2)",
    ),
    "points": (
        (),
        "SELECT vec_id AS point_id, CAST(embedding[1] AS DOUBLE) AS px, CAST(embedding[2] AS DOUBLE) AS py FROM embeddings",
    ),
    # The ray goes right; an edge counts if its crossing with the point's height lies beyond the point.
    "inside": (
        ("edges", "points"),
        """
        SELECT point_id, min_by(name, poly) AS name
        FROM (SELECT point_id, poly, name FROM points CROSS JOIN edges GROUP BY ALL
              HAVING count(*) FILTER ((y1 > py) <> (y2 > py) AND px < x1 + (py - y1) * (x2 - x1) / (y2 - y1)) % 2 = 1)
        GROUP BY point_id""",
    ),
    "located": (
        ("points", "inside"),
        """
        SELECT point_id, px AS longitude, py AS latitude, coalesce(name, 'Other') AS borough
        FROM points LEFT JOIN inside USING (point_id)""",
    ),
    "first_rides": (
        ("rides",),
        """
        SELECT station AS start_station_id, 'Station ' || min_by(user_id, event_id) || ', ' || min_by(event_type, event_id) AS station_name,
               CAST(min_by(v, event_id) AS DOUBLE) / 1000 AS py, -CAST(min_by(v, event_id) AS DOUBLE) / 1000 AS px
        FROM rides WHERE station IS NOT NULL AND event_type <> 'error' GROUP BY station""",
    ),
    "placed": (
        ("first_rides", "edges"),
        """
        SELECT start_station_id, station_name, round(py, 6) AS latitude, round(px, 6) AS longitude, coalesce(name, 'Other') AS borough
        FROM first_rides LEFT JOIN (
            SELECT start_station_id, min_by(name, poly) AS name
            FROM (SELECT start_station_id, poly, name FROM first_rides CROSS JOIN edges GROUP BY ALL
                  HAVING count(*) FILTER ((y1 > py) <> (y2 > py) AND px < x1 + (py - y1) * (x2 - x1) / (y2 - y1)) % 2 = 1)
            GROUP BY start_station_id) USING (start_station_id)""",
    ),
    "files": (
        (),
        """
        SELECT doc_id, source, 'doc_' || lpad(CAST(doc_id AS VARCHAR), 12, '0') AS filename, lang, n_chars, text FROM documents""",
    ),
    "landed": (
        ("files",),
        """
        SELECT source, filename, '2024-01-01' AS run_date, '/raw/' || source || '/2024-01-01/' || filename AS path,
               n_chars * quality AS size_bytes, CAST(NULL AS VARCHAR) AS sha256, CAST(NULL AS BIGINT) AS record_count,
               CASE WHEN toxic = 1 THEN 'previous' WHEN lang = 'en' THEN 'current' END AS dataset_id,
               '2024-01-01T00:00:00Z' AS downloaded_at
        FROM files JOIN labels USING (doc_id)""",
    ),
    "run": (
        ("files",),
        """
        SELECT source, filename, '2024-02-01' AS run_date, '/raw/' || source || '/2024-02-01/' || filename AS path,
               strlen(text) AS size_bytes, CAST(NULL AS VARCHAR) AS sha256, CAST(NULL AS BIGINT) AS record_count,
               'current' AS dataset_id, '2024-02-01T02:00:00Z' AS downloaded_at
        FROM files""",
    ),
    "pending": (
        ("files", "landed"),
        """
        SELECT f.source, f.filename, 'current' AS dataset_id
        FROM files f LEFT JOIN landed l USING (source, filename)
        WHERE l.filename IS NULL OR l.size_bytes <= 0 OR l.dataset_id <> 'current'""",
    ),
    "part_files": (
        (),
        "SELECT o_orderkey, strftime(o_orderdate, '%Y%m') || '-part_' || o_orderstatus || '.csv' AS filename FROM orders",
    ),
}


# The regression without every third day: the same steps under other names.
_STEPS = ("means", "cov", "active", "solved", "t3b")
for _name in _STEPS:
    _needs, _body = PARTS[_name]
    for _step in _STEPS:
        _body = _body.replace(f"FROM {_step}", f"FROM {_step}_some")
    _some = _body.replace("FROM t2 WHERE", "FROM t2 WHERE day(date) % 3 <> 2 AND")
    PARTS[f"{_name}_some"] = (tuple(n if n == "t2" else f"{n}_some" for n in _needs), _some)


def sql(body: str, *needs: str) -> str:
    ordered: list[str] = []

    def add(name: str) -> None:
        for dependency in PARTS[name][0]:
            add(dependency)
        if name not in ordered:
            ordered.append(name)

    for name in needs:
        add(name)
    prefix = ", ".join(f"{name} AS ({PARTS[name][1]})" for name in ordered)
    return f"WITH {prefix} {body}" if prefix else body


def _doubles(*names: str) -> str:
    return ", ".join(f"CAST({n} AS DOUBLE) AS {n}" for n in names)


T2_COLUMNS = (
    f"date, borough, total_rides, member_rides, {_doubles('avg_duration_min', 'temp', 'precip', 'snow')}, event_count, event_types"
)
T1_COLUMNS = (
    "ride_id, date, borough, rideable_type, member_casual, CAST(minutes AS DOUBLE) AS ride_duration_min,"
    " station AS start_station_id"
)
RIDE_LABELS = (
    "(VALUES ('dropped_short_row'), ('dropped_no_station'), ('dropped_bad_timestamp'), ('dropped_too_short'),"
    " ('dropped_too_long'), ('kept')) AS l(decision)"
)
EVENT_LABELS = "(VALUES ('dropped_short_row'), ('dropped_empty'), ('dropped_bad_timestamp'), ('kept')) AS l(decision)"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"

_Q = "list_sort(list(minutes))[CAST(floor(CAST({} AS DOUBLE) * (count(*) - 1)) AS INT) + 1]"
_X = ("temp", "precip", "snow")


def _moment(a: str, b: str | None = None) -> str:
    factor = f"CAST({a} AS DECIMAL(9,2))" if b is None else f"CAST({a} AS DECIMAL(9,2)) * CAST({b} AS DECIMAL(9,2))"
    return f"CAST(sum({factor}) AS DOUBLE) AS {f's_{a}' if b is None else f's_{a}_{b}'}"


_KNOWN = "list_extract(['" + "', '".join(LEDGER_SOURCES) + "'], CAST(substr(source, 4) AS INT) % 4 + 1)"

_GOOD = "SELECT filename FROM pending JOIN files USING (filename) WHERE strlen(text) = n_chars"


def _texts(kind: str, *names: str) -> str:
    """Decimals as text of a given type, and the name of the type."""
    return ", ".join(f"CAST(CAST({n} AS {kind}) AS VARCHAR) AS {n}, '{kind}' AS {n}_type" for n in names)


ORACLE: dict[str, str] = {
    "rides_tagged": sql("SELECT ride_id, duration_ms, decision FROM tagged", "tagged"),
    "rides_autumn": sql(
        "SELECT ride_id, ms AS duration_ms, CASE WHEN station IS NULL THEN 'dropped_no_station' WHEN ms < 60000 THEN 'dropped_too_short'"
        " WHEN ms > 86400000 THEN 'dropped_too_long' ELSE 'kept' END AS decision"
        " FROM (SELECT ride_id, station, epoch_ms(v) - epoch_ms(u) AS ms FROM autumn)",
        "autumn",
    ),
    "fractions": (
        "SELECT CAST(event_id AS VARCHAR) AS ride_id, CASE WHEN event_id % 97 <> 0 AND event_id % 1300 <= 999"
        " THEN 3600000 + event_id % 1300 END AS duration_ms FROM events"
    ),
    "quality_counts": sql(
        f"SELECT l.decision, count(ride_id) AS n FROM {RIDE_LABELS} LEFT JOIN tagged t ON t.decision = l.decision GROUP BY 1",
        "tagged",
    ),
    "assign_borough": sql(
        "SELECT ride_id, coalesce(borough, 'Other') AS borough FROM rides LEFT JOIN stations USING (station)", "rides", "stations"
    ),
    "clean_rides": sql(f"SELECT {T1_COLUMNS} FROM t1", "t1"),
    "daily_rides": sql(
        f"SELECT date, borough, total_rides, member_rides, {_doubles('avg_duration_min')} FROM t2_rides", "t2_rides"
    ),
    "events_tagged": sql(
        "SELECT CAST(o_orderkey AS VARCHAR) AS event_id, date, borough, type, decision FROM permits", "permits"
    ),
    "event_quality_counts": sql(
        f"SELECT l.decision, count(o_orderkey) AS n FROM {EVENT_LABELS} LEFT JOIN permits p ON p.decision = l.decision GROUP BY 1",
        "permits",
    ),
    "daily_events": sql("SELECT date, borough, event_count, event_types FROM t2_events", "t2_events"),
    "json_inline": sql("SELECT date, datatype, value, event_id FROM weather_long", "weather_long"),
    "weather_pivot": sql("SELECT date, tmax, tmin, prcp, snow FROM pivoted", "pivoted"),
    "temp_fallback": sql(f"SELECT date, {_doubles('temp', 'precip', 'snow')} FROM weather", "weather"),
    "daily_join": sql(f"SELECT {T2_COLUMNS} FROM t2", "t2"),
    "borough_stats": sql(f"SELECT borough, {_doubles('mean', 'stddev', 'q20', 'q40', 'q60', 'q80')} FROM t3a", "t3a"),
    "quantile_floor": sql(
        "SELECT borough, "
        + ", ".join(f"CAST({_Q.format(q)} AS DOUBLE) AS q{int(q * 100)}" for q in (0.2, 0.4, 0.6, 0.8))
        + " FROM t1 GROUP BY borough",
        "t1",
    ),
    "event_thresholds": sql("SELECT borough, p33, p66 FROM t3c", "t3c"),
    "ols_moments": sql(
        "SELECT borough, count(*) AS n, "
        + ", ".join(_moment(a) for a in _X)
        + ", "
        + ", ".join(_moment(a, a) for a in _X)
        + ", "
        + ", ".join(_moment(a, b) for a, b in (("temp", "precip"), ("temp", "snow"), ("precip", "snow")))
        + ", CAST(sum(total_rides) AS DOUBLE) AS s_y, "
        + ", ".join(f"CAST(sum(CAST({a} AS DECIMAL(9,2)) * total_rides) AS DOUBLE) AS s_{a}_y" for a in _X)
        + ", CAST(sum(total_rides * total_rides) AS DOUBLE) AS s_y_y FROM t2 WHERE temp IS NOT NULL GROUP BY borough",
        "t2",
    ),
    "ols_fit": sql(
        f"SELECT borough, {_doubles('beta0', 'beta1_temp', 'beta2_precip', 'beta3_snow', 'rmse')} FROM t3b", "t3b"
    ),
    "ols_counters": sql(
        "SELECT 'skipped_no_weather' AS counter, count(*) AS n FROM t2 WHERE temp IS NULL "
        "UNION ALL SELECT 'fallback_too_few_samples', count(*) FROM solved WHERE branch = 'fallback_too_few_samples' "
        "UNION ALL SELECT 'fallback_singular', count(*) FROM solved WHERE branch = 'fallback_singular' "
        "UNION ALL SELECT 'dropped_temp_zero_variance', count(*) FROM solved WHERE branch = 'fitted' AND NOT u1 "
        "UNION ALL SELECT 'dropped_precip_zero_variance', count(*) FROM solved WHERE branch = 'fitted' AND NOT u2 "
        "UNION ALL SELECT 'dropped_snow_zero_variance', count(*) FROM solved WHERE branch = 'fitted' AND NOT u3",
        "t2",
        "solved",
    ),
    "expected_rides": sql("SELECT date, borough, expected_rides FROM w", "w"),
    "event_intensity": sql("SELECT date, borough, event_intensity FROM w", "w"),
    "anomaly_flag": sql("SELECT date, borough, anomaly FROM w", "w"),
    "demand_level": sql("SELECT date, borough, demand_level FROM w", "w"),
    "enriched_w": sql("SELECT * FROM w", "w"),
    "incremental_w": sql(
        "SELECT *, (SELECT count(DISTINCT date) FROM t1 WHERE day(date) % 3 = 2) AS rewritten, CAST(0 AS BIGINT) AS other FROM w", "w", "t1"
    ),
    "ols_from_state": sql(
        f"SELECT borough, {_doubles('beta0', 'beta1_temp', 'beta2_precip', 'beta3_snow', 'rmse')} FROM t3b", "t3b"
    ),
    "ols_withdrawn": sql(
        f"SELECT borough, {_doubles('beta0', 'beta1_temp', 'beta2_precip', 'beta3_snow', 'rmse')} FROM t3b_some", "t3b_some"
    ),
    "unique_stations": sql(
        "SELECT station AS start_station_id, 'Station ' || min_by(user_id, event_id) || ', ' || min_by(event_type, event_id)"
        " AS station_name, CAST(min_by(v, event_id) AS DOUBLE) AS latitude, -CAST(min_by(v, event_id) AS DOUBLE) AS longitude"
        " FROM rides WHERE station IS NOT NULL AND event_type <> 'error' GROUP BY station",
        "rides",
    ),
    "point_in_polygon": sql("SELECT * FROM located", "located"),
    "point_in_cells": sql("SELECT * FROM located", "located"),
    "repeated_points": sql(
        "SELECT longitude, latitude, borough FROM located UNION ALL SELECT longitude, latitude, borough FROM located", "located"
    ),
    "polygons_file": sql("SELECT * FROM located", "located"),
    "build_stations": sql(
        "SELECT s.*, (SELECT count(*) FILTER (borough = 'Other') FROM placed) AS outside FROM placed s",
        "placed",
    ),
    "borough_counts": sql("SELECT borough, count(*) AS stations FROM located GROUP BY borough", "located"),
    "unmatched_points": sql(
        "SELECT count(*) FILTER (borough = 'Other') AS outside, count(*) AS stations FROM located", "located"
    ),
    "expected_files": sql(
        "SELECT source, printf(pattern, strftime(m, '%Y%m')) AS filename, strftime(m, '%Y%m') AS month, CAST(m AS DATE) AS month_start,"
        " last_day(m) AS month_end FROM (SELECT unnest(generate_series(date_trunc('month', min(o_orderdate)),"
        " date_trunc('month', max(o_orderdate)), INTERVAL 1 MONTH)) AS m FROM orders), (VALUES "
        + ", ".join(f"('{s}', '{p}')" for s, p in FILE_PATTERNS.items())
        + ") AS p(source, pattern)"
    ),
    "pending_files": sql("SELECT * FROM pending", "pending"),
    "ledger_upsert": sql(
        "SELECT * FROM landed l WHERE NOT EXISTS (SELECT 1 FROM run r WHERE r.source = l.source AND r.filename = l.filename)"
        " UNION ALL SELECT * FROM run",
        "landed",
        "run",
    ),
    "current_paths": sql(
        "SELECT source, filename, max_by(path, run_date) AS path FROM (SELECT * FROM landed UNION ALL SELECT * FROM run)"
        " WHERE source = 'src7' GROUP BY source, filename",
        "landed",
        "run",
    ),
    "ledger_snapshots": sql(
        "SELECT "
        + _KNOWN
        + " AS source, * EXCLUDE (source) FROM (SELECT * FROM landed WHERE filename NOT IN (SELECT filename FROM run) UNION ALL SELECT * FROM run)"
        " WHERE source <> 'src7'",
        "landed",
        "run",
    ),
    "ledger_commits": sql(
        "SELECT "
        + _KNOWN
        + " AS source, * EXCLUDE (source) FROM (SELECT * FROM landed WHERE filename NOT IN (SELECT filename FROM run) UNION ALL SELECT * FROM run)"
        " WHERE source <> 'src7'",
        "landed",
        "run",
    ),
    "landed_twice": sql("SELECT date, borough, event_count, event_types FROM t2_events", "t2_events"),
    "size_reconcile": (
        "SELECT source, CAST(doc_id AS VARCHAR) AS filename, strlen(text) AS size_bytes, n_chars AS source_bytes"
        " FROM documents WHERE strlen(text) <> n_chars"
    ),
    "ingest_summary": (
        "SELECT coalesce(event_type, 'TOTAL') AS source, count(*) FILTER (value >= 10) AS new_files,"
        " count(*) FILTER (value < 10) AS skipped_files,"
        " CAST(sum(CAST(CAST(value AS DECIMAL(12,2)) * 100 AS BIGINT)) AS BIGINT) AS bytes_pulled,"
        " count(*) FILTER (value < 0.2) AS errors, 2 * count(*) FILTER (value >= 300) AS retries"
        " FROM events GROUP BY ROLLUP (event_type)"
    ),
    "ingest_plan": sql(
        "SELECT coalesce(f.source, 'TOTAL') AS source, count(p.filename) AS new_files, count(*) - count(p.filename) AS skipped_files,"
        " CAST(0 AS BIGINT) AS bytes_pulled, CAST(0 AS BIGINT) AS errors, CAST(0 AS BIGINT) AS retries"
        " FROM files f LEFT JOIN pending p ON f.source = p.source AND f.filename = p.filename GROUP BY ROLLUP (f.source)",
        "files",
        "pending",
    ),
    "ingest_mismatched": sql(
        "SELECT source, filename, strlen(text) AS size_bytes, n_chars AS source_bytes FROM files JOIN pending USING (source, filename)"
        " WHERE strlen(text) <> n_chars",
        "files",
        "pending",
    ),
    "ingest_ledger": sql(
        f"SELECT * FROM landed WHERE filename NOT IN ({_GOOD}) UNION ALL SELECT r.source, r.filename, r.run_date, r.path, r.size_bytes,"
        " sha256(f.text) AS sha256, len(string_split(f.text, chr(10))) AS record_count, r.dataset_id, r.downloaded_at"
        f" FROM run r JOIN files f USING (filename) WHERE r.filename IN ({_GOOD})",
        "landed",
        "run",
        "pending",
    ),
    "ingest_totals": sql(
        "SELECT coalesce(f.source, 'TOTAL') AS source, count(*) FILTER (p.filename IS NOT NULL AND strlen(text) = n_chars) AS new_files,"
        " count(*) FILTER (p.filename IS NULL) AS skipped_files,"
        " CAST(coalesce(sum(strlen(text)) FILTER (p.filename IS NOT NULL AND strlen(text) = n_chars), 0) AS BIGINT) AS bytes_pulled,"
        " count(*) FILTER (p.filename IS NOT NULL AND strlen(text) <> n_chars) AS errors, count(p.filename) AS retries,"
        f" (SELECT count(*) FROM landed) + (SELECT count(*) FROM ({_GOOD}) g(filename) WHERE filename NOT IN (SELECT filename FROM landed)) AS entries"
        " FROM files f LEFT JOIN pending p ON f.source = p.source AND f.filename = p.filename GROUP BY ROLLUP (f.source)",
        "files",
        "landed",
        "pending",
    ),
    "fingerprint_files": (
        "SELECT page_id % 16 AS g, CAST(sum(strlen(html) + 1) AS BIGINT) AS size_bytes,"
        " sha256(string_agg(html || chr(10), '' ORDER BY page_id)) AS sha256 FROM pages GROUP BY 1"
    ),
    "ledger_size": sql("SELECT count(*) AS entries FROM landed", "landed"),
    "fingerprint": "SELECT page_id, strlen(html) AS size_bytes, sha256(html) AS sha256 FROM pages",
    "records_per_file": sql("SELECT filename, count(*) AS record_count FROM part_files GROUP BY filename", "part_files"),
    "latest_dataset": sql(
        "SELECT source, filename, size_bytes FROM landed WHERE source = 'src7' ORDER BY filename DESC LIMIT 1", "landed"
    ),
    "sample_parts": sql(
        "SELECT o_orderkey, filename FROM part_files WHERE filename IN"
        " (SELECT min(filename) FROM part_files GROUP BY substr(filename, 1, 6))",
        "part_files",
    ),
    "month_slice": (
        "SELECT o_orderkey, o_orderdate, o_totalprice FROM orders"
        " WHERE o_orderdate >= TIMESTAMP '1998-06-01' AND o_orderdate < TIMESTAMP '1998-07-01'"
    ),
    "event_page": "SELECT ts, event_id, event_type FROM events ORDER BY ts, event_id LIMIT 50 OFFSET 100",
    "event_page_deep": (
        "SELECT ts, event_id, event_type FROM (SELECT ts, event_id, event_type, row_number() OVER (ORDER BY ts, event_id) AS r, count(*) OVER () AS n"
        " FROM events) WHERE r > n - 100 AND r <= n - 50"
    ),
    "spot_check": sql(f"SELECT {T2_COLUMNS} FROM t2 WHERE date = DATE '2024-03-15' AND borough = 'ASIA'", "t2"),
    "preview": sql(
        f"SELECT date, borough, total_rides, member_rides, {_doubles('avg_duration_min')} FROM t2_rides"
        " ORDER BY date, borough LIMIT 10",
        "t2_rides",
    ),
    "compare_counts": sql(
        "SELECT decision, coalesce(n_a, 0) AS n_a, coalesce(n_b, 0) AS n_b, coalesce(n_a, 0) - coalesce(n_b, 0) AS diff"
        " FROM (SELECT decision, count(*) AS n_a FROM tagged GROUP BY 1)"
        " FULL JOIN (SELECT decision, count(*) AS n_b FROM permits GROUP BY 1) USING (decision)",
        "tagged",
        "permits",
    ),
    "compare_tables": (
        "SELECT CAST(sum(coalesce(a, 0)) AS BIGINT) AS rows_a, CAST(sum(coalesce(b, 0)) AS BIGINT) AS rows_b,"
        " CAST(sum(greatest(coalesce(a, 0) - coalesce(b, 0), 0)) AS BIGINT) AS only_a,"
        " CAST(sum(greatest(coalesce(b, 0) - coalesce(a, 0), 0)) AS BIGINT) AS only_b"
        " FROM (SELECT o_custkey AS k, count(*) AS a FROM orders GROUP BY 1)"
        " FULL JOIN (SELECT c_custkey AS k, count(*) AS b FROM customer GROUP BY 1) USING (k)"
    ),
    "table_parity": sql(
        "SELECT count(*) AS rows_a, count(*) AS rows_b, CAST(0 AS BIGINT) AS only_a, CAST(0 AS BIGINT) AS only_b FROM t2_rides",
        "t2_rides",
    ),
    "parity_fingerprint": (
        "WITH a AS (SELECT o_orderkey, o_orderstatus, o_totalprice, o_orderdate FROM orders),"
        " b AS (SELECT o_orderkey, CASE WHEN o_orderkey % 991 <> 0 THEN o_orderstatus END AS o_orderstatus,"
        " CASE WHEN o_orderkey % 997 = 0 THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice, o_orderdate"
        " FROM orders, range(3) AS r(copy) WHERE copy = 0 OR o_orderkey % 1009 = 0)"
        " SELECT (SELECT count(*) FROM a) AS rows_a, (SELECT count(*) FROM b) AS rows_b,"
        " (SELECT count(*) FROM (SELECT * FROM a EXCEPT ALL SELECT * FROM b)) AS only_a,"
        " (SELECT count(*) FROM (SELECT * FROM b EXCEPT ALL SELECT * FROM a)) AS only_b"
    ),
    "check_grain": (
        "SELECT CAST(sum(n) AS BIGINT) AS n_rows, count(*) AS n_keys, count(*) FILTER (n > 1) AS repeated_keys"
        " FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber)"
    ),
    "row_counts": " UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS n FROM {t}" for t in TABLES.split()),
    "divisible_events": "SELECT count(*) AS n FROM events WHERE event_id % 7 = 0",
    "csv_roundtrip": sql("SELECT ride_id, duration_ms, decision FROM tagged", "tagged"),
    "rides_month": sql("SELECT ride_id, decision FROM tagged WHERE strftime(started, '%Y%m') = '202403'", "tagged"),
    "rides_sample": sql("SELECT ride_id, decision FROM tagged WHERE event_id % 3 = 2", "tagged"),
    "events_roundtrip": sql(
        "SELECT CAST(o_orderkey AS VARCHAR) AS event_id, date, borough, type, decision FROM permits", "permits"
    ),
    "weather_files": sql("SELECT date, tmax, tmin, prcp, snow FROM pivoted", "pivoted"),
    "export_roundtrip": sql(
        "SELECT layout, row_number() OVER (PARTITION BY layout ORDER BY date, borough) AS place, date, borough, total_rides,"
        " CAST(temp AS DOUBLE) AS temp FROM t2 CROSS JOIN (VALUES ('parts'), ('single')) AS l(layout)",
        "t2",
    ),
    "tsv_roundtrip": sql(f"SELECT {T2_COLUMNS} FROM t2", "t2"),
    "stations_roundtrip": sql(
        "SELECT station AS start_station_id, s_name AS station_name, s_acctbal AS latitude, -s_acctbal AS longitude, borough"
        " FROM stations",
        "stations",
    ),
    "stage_counters": sql(
        "SELECT CAST(0 AS BIGINT) AS dropped_short_row, count(*) FILTER (decision = 'dropped_no_station') AS dropped_no_station,"
        " count(*) FILTER (decision = 'dropped_bad_timestamp') AS dropped_bad_timestamp,"
        " count(*) FILTER (decision = 'dropped_too_short') AS dropped_too_short,"
        " count(*) FILTER (decision = 'dropped_too_long') AS dropped_too_long, count(*) FILTER (decision = 'kept') AS kept,"
        " count(*) FILTER (decision = 'kept') AS t1_rows FROM tagged",
        "tagged",
    ),
    "exact_counters": sql(
        "SELECT CAST(0 AS BIGINT) AS dropped_short_row, count(*) FILTER (decision = 'dropped_no_station') AS dropped_no_station,"
        " count(*) FILTER (decision = 'dropped_bad_timestamp') AS dropped_bad_timestamp,"
        " count(*) FILTER (decision = 'dropped_too_short') AS dropped_too_short,"
        " count(*) FILTER (decision = 'dropped_too_long') AS dropped_too_long, count(*) FILTER (decision = 'kept') AS kept,"
        " count(*) FILTER (decision = 'kept') AS t1_rows FROM tagged",
        "tagged",
    ),
    "exact_t2": sql(
        f"SELECT date, borough, total_rides, member_rides, {_texts('decimal(8,2)', 'avg_duration_min')},"
        f" {_texts('decimal(18,2)', 'temp', 'precip', 'snow')}, event_count, event_types FROM t2",
        "t2",
    ),
    "exact_fit": sql(
        f"SELECT borough, {_texts('decimal(18,4)', 'beta0', 'beta1_temp', 'beta2_precip', 'beta3_snow')}, {_texts('decimal(18,2)', 'rmse')} FROM t3b", "t3b"
    ),
    "exact_stats": sql(f"SELECT borough, {_texts('decimal(18,2)', 'mean', 'stddev', 'q20', 'q40', 'q60', 'q80')} FROM t3a", "t3a"),
    "text_functions": (
        "SELECT doc_id, length(trim(text, ' ')) AS trimmed, substr(text, 1, 10) AS first10, starts_with(text, 'T') AS prefixed,"
        " ends_with(CASE WHEN ends_with(text, '.') THEN text[:-2] ELSE text END, '.') AS suffixed,"
        " length(string_split(text, ' ')) AS n_words,"
        " sha256(string_split(text, ' ')[1] || chr(9) || lang || chr(9) || source) AS joined_sha FROM documents"
    ),
    "number_functions": (
        "SELECT event_id, printf('%.2f', value) AS two, printf('%.4f', value) AS four,"
        " TRY_CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, TRY_CAST(event_type AS BIGINT) AS not_a_number,"
        " abs(value - 100) AS distance, sqrt(greatest(value - 100, 0)) AS root, CAST(floor(value / 7) AS BIGINT) AS sevenths,"
        " CAST(least(greatest(floor(value), 0), 200) AS BIGINT) AS clamped,"
        " CASE WHEN value > 50 THEN 'much' ELSE 'little' END AS amount, event_id % 7 AS modulo FROM events"
    ),
    "date_functions": (
        "SELECT o_orderkey, strftime(o_orderdate, '%Y%m') AS month, CAST(date_trunc('month', o_orderdate) AS DATE) AS first_day,"
        " last_day(o_orderdate) AS last_day, strftime(o_orderdate, '%Y-%m') AS padded FROM orders"
    ),
}
