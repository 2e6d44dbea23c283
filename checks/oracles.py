"""DuckDB SQL for every registered query, over the provided tables only.

Written apart from the Spark side: the station search, for one, is a ranking of
all valid stations here and a grid search there.
"""

# Named subqueries; each may use the ones before it.
_STEPS = {
    "fx_customer": """
        SELECT c.*, n.n_name, n.n_regionkey,
               CASE WHEN c_custkey % 10 = 0 THEN NULL
                    ELSE CAST(10000 + c_nationkey AS VARCHAR) END AS pc
        FROM customer c JOIN nation n ON c_nationkey = n_nationkey""",
    "fx_declarations": """
        SELECT o_orderkey AS event_id,
               o_orderpriority AS festival_nom,
               'SALLE ' || c_mktsegment AS lieu_nom,
               CASE WHEN o_orderkey % 50 = 0 THEN 'null'
                    WHEN o_orderkey % 51 = 0 THEN NULL
                    ELSE '  ' || c_name || ' ' END AS lieu_adresse,
               pc AS lieu_code_postal,
               n_name AS lieu_ville,
               CASE WHEN o_orderkey % 53 = 0 THEN NULL
                    ELSE CAST(n_regionkey AS VARCHAR) END AS lieu_departement_code,
               CASE WHEN o_orderkey % 54 = 0 THEN 'bad-date'
                    WHEN o_orderkey % 55 = 0 THEN NULL
                    ELSE strftime(o_orderdate, '%d-%m-%Y') END AS declaration_date_representation
        FROM orders JOIN fx_customer ON o_custkey = c_custkey""",
    "fx_gazetteer": """
        SELECT concat_ws(', ', c_name, pc, n_name) AS full_address,
               CASE WHEN c_custkey % 20 = 0 THEN 'not-found' ELSE 'ok' END AS result_status,
               format('{:d}.{:02d}', ((c_custkey * 37) % 1000) // 100, (c_custkey * 37) % 100) AS latitude,
               format('{:d}.{:02d}', ((c_custkey * 91) % 1000) // 100, (c_custkey * 91) % 100) AS longitude
        FROM fx_customer""",
    "fx_stations": """
        SELECT lpad(CAST(s_suppkey AS VARCHAR), 8, '0') AS id,
               CAST(n_regionkey AS VARCHAR) AS departement,
               s_suppkey AS list_pos,
               CAST((s_suppkey * 53) % 1000 AS DOUBLE) / 100 AS lat,
               CASE WHEN s_suppkey % 13 = 0 THEN NULL
                    ELSE CAST((s_suppkey * 29) % 1000 AS DOUBLE) / 100 END AS lon,
               CASE WHEN s_suppkey % 7 = 0 THEN FALSE
                    WHEN s_suppkey % 5 = 0 THEN NULL ELSE TRUE END AS poste_ouvert,
               strftime(DATE '1995-01-01' + CAST((s_suppkey * 97) % 900 AS INTEGER), '%Y-%m-%d')
                   || CASE WHEN s_suppkey % 2 = 0 THEN ' 00:00:00' ELSE ' 06:00:00' END AS date_debut,
               CASE WHEN s_suppkey % 3 = 0 THEN ''
                    WHEN s_suppkey % 4 = 0 THEN NULL
                    ELSE strftime(DATE '1995-01-01' + CAST((s_suppkey * 97) % 900 + 1500 AS INTEGER),
                                  '%Y-%m-%d') || ' 00:00:00' END AS date_fin
        FROM supplier JOIN nation ON s_nationkey = n_nationkey""",
    "fx_weather": """
        SELECT lpad(CAST(l_suppkey AS VARCHAR), 8, '0') AS poste,
               strftime(l_shipdate, '%Y%m%d') AS jour,
               CAST(CAST(max(l_quantity) AS INTEGER) AS VARCHAR) || ',5' AS rr,
               '1' AS "QRR",
               CASE WHEN l_suppkey % 4 = 0 THEN 'NA'
                    ELSE CAST(count(*) AS VARCHAR) || ',25' END AS tn,
               CAST(NULL AS VARCHAR) AS vide
        FROM lineitem GROUP BY l_suppkey, l_shipdate""",
    "weather_values": """
        SELECT poste, jour,
               CAST(replace(rr, ',', '.') AS DOUBLE) AS rr,
               CAST(replace("QRR", ',', '.') AS DOUBLE) AS "QRR",
               CASE WHEN tn = 'NA' THEN NULL ELSE CAST(replace(tn, ',', '.') AS DOUBLE) END AS tn,
               CAST(NULL AS DOUBLE) AS vide
        FROM fx_weather""",
    "valid_address": """
        SELECT *, concat_ws(', ', trim(lieu_adresse), trim(lieu_code_postal), trim(lieu_ville)) AS full_address
        FROM fx_declarations
        WHERE lieu_adresse IS NOT NULL AND lieu_adresse <> 'null'
          AND lieu_ville IS NOT NULL AND lieu_ville <> 'null'""",
    "answers": """
        SELECT full_address, result_status,
               CASE WHEN good THEN lat END AS latitude, CASE WHEN good THEN lon END AS longitude
        FROM (SELECT *, result_status = 'ok' AND lat <> 0 AND lon <> 0 AS good
              FROM (SELECT *, TRY_CAST(latitude AS DOUBLE) AS lat, TRY_CAST(longitude AS DOUBLE) AS lon
                    FROM fx_gazetteer))""",
    "with_coordinates": """
        SELECT d.*, a.latitude, a.longitude
        FROM valid_address d LEFT JOIN answers a USING (full_address)""",
    "located": """
        SELECT event_id, lieu_departement_code, latitude, longitude,
               declaration_date_representation AS day_representation,
               CAST(CASE WHEN regexp_full_match(declaration_date_representation, '[0-9]{2}-[0-9]{2}-[0-9]{4}')
                    THEN try_strptime(declaration_date_representation, '%d-%m-%Y') END AS DATE) AS day,
               lieu_departement_code AS departement,
               festival_nom, lieu_nom, lieu_adresse, lieu_code_postal, lieu_ville
        FROM with_coordinates
        WHERE latitude IS NOT NULL AND longitude IS NOT NULL AND lieu_departement_code IS NOT NULL""",
    "usable": """
        SELECT id, departement, list_pos, lat, lon,
               CAST(date_debut AS TIMESTAMP) AS valid_from,
               CASE WHEN date_fin IS NULL OR date_fin = '' THEN TIMESTAMP '2026-12-01 00:00:00'
                    ELSE CAST(date_fin AS TIMESTAMP) END AS valid_to
        FROM fx_stations
        WHERE (poste_ouvert IS NULL OR poste_ouvert) AND id <> '' AND lat IS NOT NULL AND lon IS NOT NULL""",
    "place_days": "SELECT DISTINCT latitude, longitude, departement, day FROM located",
    "ranked": """
        SELECT k.*, s.id AS station_id,
               row_number() OVER (
                   PARTITION BY k.latitude, k.longitude, k.departement, k.day
                   ORDER BY sqrt((k.latitude - s.lat) * (k.latitude - s.lat)
                                 + (k.longitude - s.lon) * (k.longitude - s.lon)), s.list_pos) AS rank
        FROM place_days k JOIN usable s
          ON s.departement = k.departement AND s.valid_from <= k.day AND s.valid_to >= k.day""",
    "nearest": """
        SELECT k.latitude, k.longitude, k.departement, k.day, r.station_id
        FROM place_days k LEFT JOIN (SELECT * FROM ranked WHERE rank = 1) r
          ON r.latitude = k.latitude AND r.longitude = k.longitude
         AND r.departement = k.departement AND r.day = k.day""",
    "observed": """
        SELECT n.latitude, n.longitude, n.departement, n.day, n.station_id,
               w.poste, w.jour, w.rr, w.tn, w.vide
        FROM nearest n JOIN weather_values w
          ON w.poste = n.station_id AND w.jour = strftime(n.day, '%Y%m%d')""",
    "enriched": """
        SELECT e.*, o.poste, o.jour, o.rr, o.tn, o.vide, CAST(o.station_id AS BIGINT) AS station_id
        FROM located e LEFT JOIN observed o
          ON o.latitude = e.latitude AND o.longitude = e.longitude
         AND o.departement = e.departement AND o.day = e.day""",
    "addresses": "SELECT DISTINCT full_address FROM valid_address WHERE full_address <> ''",
    "geocoded": """
        SELECT full_address, latitude, longitude
        FROM addresses LEFT JOIN answers USING (full_address)""",
    # events of one to three days, a row per day
    "event_days": """
        SELECT *, CAST(day + CAST(i AS INTEGER) AS DATE) AS weather_day
        FROM located, LATERAL (SELECT unnest(range(CASE WHEN day IS NULL THEN 1 ELSE 1 + event_id % 3 END)) AS i)""",
    "event_day_ranked": """
        SELECT k.*, s.id AS station_id,
               row_number() OVER (
                   PARTITION BY k.latitude, k.longitude, k.departement, k.weather_day
                   ORDER BY sqrt((k.latitude - s.lat) * (k.latitude - s.lat)
                                 + (k.longitude - s.lon) * (k.longitude - s.lon)), s.list_pos) AS rank
        FROM (SELECT DISTINCT latitude, longitude, departement, weather_day FROM event_days) k
        JOIN usable s ON s.departement = k.departement
         AND s.valid_from <= k.weather_day AND s.valid_to >= k.weather_day""",
    "event_day_observed": """
        SELECT r.*, w.rr, w.tn
        FROM event_day_ranked r JOIN weather_values w
          ON w.poste = r.station_id AND w.jour = strftime(r.weather_day, '%Y%m%d')
        WHERE r.rank = 1""",
}


def _with_steps(select: str) -> str:
    """Put the steps a query needs, and those they need, in front of it."""
    needed: set[str] = set()
    text = select
    for name in reversed(_STEPS):
        if name in text:
            needed.add(name)
            text += _STEPS[name]
    steps = [f"{name} AS ({_STEPS[name]}\n)" for name in _STEPS if name in needed]
    return f"WITH {', '.join(steps)}\n{select}" if steps else select


_DECLARATION_COLUMNS = """CAST(event_id AS VARCHAR) AS event_id, festival_nom, lieu_nom, lieu_adresse,
    lieu_code_postal, lieu_ville, lieu_departement_code, declaration_date_representation"""

_QUERIES = {
    "read_declarations": f"SELECT {_DECLARATION_COLUMNS} FROM fx_declarations",
    "apply_declared_types": """
        SELECT event_id, festival_nom, CAST(lieu_departement_code AS INTEGER) AS lieu_departement_code,
               CASE WHEN event_id % 11 = 0 THEN NULL
                    ELSE CAST(event_id % 90000 AS INTEGER) END AS festival_code_postal,
               CASE WHEN event_id % 7 = 0 THEN NULL
                    ELSE CAST(event_id + 10000000000000 AS BIGINT) END AS lieu_siret,
               CASE event_id % 3 WHEN 0 THEN TRUE WHEN 1 THEN FALSE END AS declaration_gestionnaires_multiples
        FROM fx_declarations""",
    "read_geocode_results": "SELECT *, '0.9' AS result_score FROM fx_gazetteer",
    "read_station_list": """
        SELECT id, departement, row_number() OVER (PARTITION BY departement ORDER BY list_pos) - 1 AS list_pos,
               lat, lon, poste_ouvert
        FROM fx_stations""",
    "read_station_info": "SELECT id, date_debut, date_fin FROM fx_stations WHERE list_pos % 11 <> 0",
    "read_weather_csv": "SELECT * FROM fx_weather",
    "filter_equals": """
        SELECT event_id, lieu_ville FROM fx_declarations
        WHERE festival_nom = '1-URGENT' AND CAST(lieu_departement_code AS DOUBLE) = 1""",
    "project_columns": "SELECT event_id, lieu_nom, lieu_ville FROM fx_declarations",
    "project_required": """
        SELECT event_id, lieu_ville, lieu_adresse, lieu_code_postal, lieu_departement_code,
               declaration_date_representation FROM fx_declarations""",
    "filter_valid_address": """
        SELECT event_id, lieu_adresse, lieu_code_postal, lieu_ville FROM valid_address""",
    "filter_located": "SELECT event_id, latitude, longitude, lieu_departement_code FROM located",
    "filter_open_stations": """
        SELECT id, poste_ouvert FROM fx_stations WHERE poste_ouvert IS NULL OR poste_ouvert""",
    "filter_usable_stations": """
        SELECT id, lat, lon FROM fx_stations
        WHERE id IS NOT NULL AND id NOT IN ('', '0') AND lat IS NOT NULL AND lon IS NOT NULL""",
    "filter_geocode_ok": "SELECT * FROM answers",
    "stations_by_department": """
        SELECT id, departement, row_number() OVER (ORDER BY list_pos) - 1 AS list_pos, lat, lon
        FROM fx_stations WHERE departement = '2' AND list_pos % 2 = 0""",
    "weather_for_day": "SELECT * FROM fx_weather WHERE poste = '00000001' AND jour = '19970131'",
    "rename_day": "SELECT event_id, declaration_date_representation AS day_representation FROM fx_declarations",
    "clean_keys": """
        SELECT event_id, lieu_nom AS name FROM fx_declarations
        WHERE event_id % 17 <> 0 AND event_id % 19 <> 0""",
    "join_coordinates": "SELECT event_id, lieu_adresse, latitude, longitude FROM with_coordinates",
    "join_geocode_by_position": """
        SELECT c_custkey // 1000 AS batch_id, c_custkey % 1000 AS pos, c_name,
               CASE WHEN answered THEN latitude END AS latitude, CASE WHEN answered THEN 1.5::DOUBLE END AS longitude
        FROM (SELECT *, CAST((c_custkey * 37) % 1000 AS DOUBLE) / 100 AS latitude,
                     c_custkey % 1000 < 990 AND c_custkey % 7 <> 0
                         AND (c_custkey * 37) % 1000 <> 0 AS answered
              FROM customer)""",
    "nearest_station": """
        SELECT latitude, longitude, departement, strftime(day, '%Y-%m-%d') AS day, station_id FROM nearest""",
    "station_valid_on_day": """
        SELECT d.departement, s.id AS station_id, strftime(min(d.day), '%Y-%m-%d') AS first_day,
               strftime(max(d.day), '%Y-%m-%d') AS last_day
        FROM (SELECT departement, unnest(generate_series(min(day), max(day), INTERVAL 1 DAY)) AS day
              FROM (SELECT lieu_departement_code AS departement,
                           CAST(try_strptime(declaration_date_representation, '%d-%m-%Y') AS DATE) AS day
                    FROM fx_declarations)
              WHERE day IS NOT NULL GROUP BY departement) d
        JOIN usable s ON s.departement = d.departement AND d.day BETWEEN s.valid_from AND s.valid_to
        GROUP BY d.departement, s.id""",
    "weather_lookup": """
        SELECT n.station_id, strftime(n.day, '%Y-%m-%d') AS day, w.*
        FROM (SELECT DISTINCT station_id, day FROM nearest) n JOIN fx_weather w
          ON w.poste = n.station_id AND w.jour = strftime(n.day, '%Y%m%d')""",
    "join_weather_back": """
        SELECT event_id, latitude, longitude, lieu_departement_code, day_representation, rr, tn,
               CASE WHEN station_id IS NULL THEN NULL ELSE poste END AS station_id
        FROM enriched""",
    "no_weather_fallback": """
        SELECT event_id, latitude, longitude, CAST(NULL AS BIGINT) AS station_id FROM located""",
    "distinct_addresses": "SELECT full_address FROM addresses",
    "distinct_combinations": """
        SELECT DISTINCT latitude, longitude, lieu_departement_code, day_representation FROM located""",
    "distinct_festival_names": "SELECT DISTINCT festival_nom FROM fx_declarations",
    "geocode_completeness": """
        SELECT count(*) AS total_keys, count(*) FILTER (WHERE latitude IS NULL) AS missing_keys
        FROM geocoded""",
    "null_column_profile": """
        SELECT unnest(['poste', 'jour', 'rr', 'QRR', 'tn', 'vide']) AS column_name,
               unnest(counts) AS non_null, unnest(list_transform(counts, lambda n: n = 0)) AS all_null
        FROM (SELECT [count(poste), count(jour), count(rr), count("QRR"), count(nullif(tn, 'NA')), count(vide)]
                  AS counts FROM fx_weather)""",
    "missing_examples": """
        SELECT full_address FROM geocoded WHERE latitude IS NULL ORDER BY full_address LIMIT 10""",
    "preview": "SELECT * FROM fx_declarations ORDER BY event_id LIMIT 20",
    "first_station_info": """
        SELECT id, CASE WHEN list_pos % 11 = 0 THEN NULL ELSE date_debut END AS date_debut,
               CASE WHEN list_pos % 11 = 0 THEN NULL ELSE date_fin END AS date_fin FROM fx_stations""",
    "union_weather": """
        SELECT poste, jour,
               CASE WHEN CAST(poste AS BIGINT) % 2 = 1 THEN rr END AS rr,
               CASE WHEN CAST(poste AS BIGINT) % 2 = 0 THEN tn END AS tn
        FROM fx_weather""",
    "address_key": """
        SELECT event_id, array_to_string(list_filter(
                   [trim(lieu_adresse), trim(lieu_code_postal), trim(lieu_ville)],
                   lambda x: x IS NOT NULL), ', ') AS full_address
        FROM fx_declarations""",
    "combination_key": """
        SELECT event_id, CAST(latitude AS VARCHAR) || '_' || CAST(longitude AS VARCHAR) || '_'
                   || lieu_departement_code || coalesce('_' || day_representation, '') AS station_key
        FROM located""",
    "parse_day": """
        SELECT event_id, CASE WHEN event_id % 54 = 0 OR event_id % 55 = 0 THEN NULL
                              ELSE strftime(o_orderdate, '%Y-%m-%d') END AS day
        FROM fx_declarations JOIN orders ON o_orderkey = event_id""",
    "format_day": """
        SELECT o_orderkey AS event_id, strftime(o_orderdate, '%Y-%m-%d') AS day,
               strftime(o_orderdate, '%Y-%m-%dT00:00:00Z') AS first_second,
               strftime(o_orderdate, '%Y-%m-%dT23:59:59Z') AS last_second
        FROM orders""",
    "parse_validity": """
        SELECT id, date_debut AS valid_from, coalesce(nullif(date_fin, ''), '2026-12-01 00:00:00') AS valid_to
        FROM fx_stations""",
    "degree_distance": """
        SELECT id, sqrt((lat - 5.25) * (lat - 5.25) + (lon - 4.75) * (lon - 4.75)) AS distance
        FROM fx_stations""",
    "parse_decimal_comma": "SELECT poste, jour, rr FROM weather_values",
    # 19 tokens, then as many ordinary cells
    "null_tokens": """
        SELECT event_id, CASE WHEN event_id % 38 < 19 THEN NULL ELSE lieu_nom END AS cell
        FROM fx_declarations""",
    "unwrap_station_json": "SELECT departement, id, lat, lon, poste_ouvert FROM fx_stations",
    "parse_weather": "SELECT * FROM weather_values",
    "drop_null_columns": 'SELECT poste, jour, rr, "QRR", tn FROM weather_values',
    "drop_quality_columns": "SELECT poste, jour, rr, tn, vide FROM fx_weather",
    "tag_weather": """
        SELECT concat_ws('_', CAST(latitude AS VARCHAR), CAST(longitude AS VARCHAR), departement,
                         strftime(day, '%d-%m-%Y')) AS station_key,
               CAST(station_id AS BIGINT) AS station_id, jour, rr, tn
        FROM observed""",
    "skip_empty_weather": """
        SELECT k.latitude, k.longitude, k.departement, strftime(k.day, '%Y-%m-%d') AS day, o.station_id
        FROM place_days k LEFT JOIN observed o
          ON o.latitude = k.latitude AND o.longitude = k.longitude
         AND o.departement = k.departement AND o.day = k.day""",
    "batch_keys": "SELECT count(*) AS total_keys, TRUE AS within_limit FROM addresses",
    "lookup_in_batches": """
        SELECT full_address,
               CASE WHEN n % 20 <> 0 THEN CAST((n * 37) % 1000 AS DOUBLE) / 100 END AS latitude,
               CASE WHEN n % 20 <> 0 THEN CAST((n * 91) % 1000 AS DOUBLE) / 100 END AS longitude
        FROM (SELECT full_address, CAST(regexp_extract(full_address, '#([0-9]+)', 1) AS BIGINT) AS n
              FROM addresses)""",
    "geocode_addresses": "SELECT full_address, latitude, longitude FROM geocoded",
    "require_complete_geocoding": """
        SELECT count(*) AS total_keys, count(*) FILTER (WHERE latitude IS NULL) AS missing_keys,
               TRUE AS refused
        FROM geocoded""",
    "write_parquet": "SELECT * FROM fx_declarations",
    # a CSV writer drops white space at the edges of a field
    "write_csv": """
        SELECT CAST(event_id AS VARCHAR) AS event_id, trim(lieu_adresse) AS lieu_adresse, full_address
        FROM valid_address""",
    "write_unique_names": "SELECT DISTINCT festival_nom FROM fx_declarations",
    "export_address_batches": "SELECT count(*) AS addresses, TRUE AS within_limit FROM addresses",
    "enrich_events_with_weather": """
        SELECT event_id, festival_nom, lieu_nom, lieu_adresse, lieu_code_postal, lieu_ville,
               lieu_departement_code, day_representation, latitude, longitude,
               poste, jour, rr, tn, vide, station_id
        FROM enriched""",
    "extract_declarations": """
        SELECT CAST(event_id AS VARCHAR) AS event_id, festival_nom, lieu_ville,
               declaration_date_representation
        FROM fx_declarations WHERE lieu_departement_code = '3'""",
    "prepare_addresses": """
        SELECT full_address, count(*) AS declarations FROM valid_address
        WHERE full_address <> '' GROUP BY full_address""",
    "station_day_weather": """
        SELECT w.poste, w.jour, w.rr, w.tn FROM weather_values w
        WHERE EXISTS (SELECT 1 FROM nearest n
                      WHERE n.station_id = w.poste AND strftime(n.day, '%Y%m%d') = w.jour)""",
    "weather_per_event_day": """
        SELECT e.event_id, strftime(e.weather_day, '%Y-%m-%d') AS weather_day, e.latitude, e.longitude,
               o.rr, o.tn, CAST(o.station_id AS BIGINT) AS station_id
        FROM event_days e LEFT JOIN event_day_observed o
          ON o.latitude = e.latitude AND o.longitude = e.longitude
         AND o.departement = e.departement AND o.weather_day = e.weather_day""",
}

ORACLES = {name: _with_steps(text.strip()) for name, text in _QUERIES.items()}
