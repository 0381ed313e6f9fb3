"""Equivalent DuckDB SQL of every query, written independently of the engine."""

from __future__ import annotations

_ORDER = (
    "l_orderkey, l_linenumber, l_suppkey, l_extendedprice, l_quantity, l_discount, l_tax, "
    "l_shipdate, l_returnflag"
)
_ORDER_DESC = ", ".join(f"{c} DESC" for c in _ORDER.split(", "))

_VIEWS = f"""
WITH raw AS (
  SELECT
    CASE WHEN l_linestatus = 'O' THEN 'sale' ELSE 'rent' END AS page_operation,
    CASE WHEN l_tax <> 0.0 THEN CASE WHEN l_linestatus = 'O' THEN 'sale' ELSE 'rent' END END
      AS own_operation,
    r_name AS district,
    CASE WHEN l_quantity = 49.0 THEN '' ELSE n_name END AS neighborhood,
    n_name, r_name,
    CAST(date_trunc('month', l_shipdate) AS DATE) AS snapshot_date,
    CAST(l_partkey AS VARCHAR) AS propertyCode,
    CASE WHEN l_quantity <> 48.0
      THEN CAST(39.4 AS DOUBLE) + (l_partkey % 1000) / CAST(10000 AS DOUBLE) END AS latitude,
    CAST(-0.4 AS DOUBLE) + (l_partkey % 97) / CAST(10000 AS DOUBLE) AS longitude,
    CAST(l_partkey % 1500 AS VARCHAR) AS distance,
    s_name AS address,
    p_type AS propertyType,
    CASE WHEN l_linestatus = 'O' THEN l_extendedprice * 5 ELSE l_extendedprice / 50 END AS price,
    CASE WHEN l_quantity <> 50.0 THEN
      (CASE WHEN l_linestatus = 'O' THEN l_extendedprice * 5 ELSE l_extendedprice / 50 END)
      / CAST(p_size * 4 AS DOUBLE) END AS priceByArea,
    CAST(p_size * 4 AS DOUBLE) AS size,
    CASE WHEN l_linenumber <> 6 THEN CAST(l_linenumber AS VARCHAR) END AS floor,
    l_discount > CAST(0.05 AS DOUBLE) AS exterior,
    CAST(p_size % 6 AS INTEGER) AS rooms,
    CASE WHEN l_discount <> 0.0 THEN CAST(l_linenumber % 4 AS INTEGER) END AS bathrooms,
    l_returnflag AS status,
    l_tax = CAST(0.08 AS DOUBLE) AS newDevelopment,
    l_returnflag <> 'A' AS hasLift,
    CASE WHEN l_linenumber = 2 THEN '{{"hasParkingSpace":true}}' END AS parkingSpace,
    {_ORDER}
  FROM lineitem
  JOIN part ON l_partkey = p_partkey
  JOIN supplier ON l_suppkey = s_suppkey
  JOIN nation ON s_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey
),
valid AS (
  SELECT *, COALESCE(own_operation, page_operation) AS operation FROM raw
  WHERE priceByArea IS NOT NULL AND neighborhood <> ''
    AND (bathrooms IS NULL OR bathrooms > 0)
    AND (COALESCE(own_operation, page_operation) <> 'sale'
         OR (priceByArea > 1000 AND priceByArea < 10000))
),
scoped AS (SELECT * FROM valid WHERE district IN ('AFRICA', 'ASIA', 'EUROPE')),
rel AS (
  SELECT * FROM scoped
  WHERE hasLift AND floor IS DISTINCT FROM '1' AND size > 120 AND rooms >= 2 AND bathrooms >= 2
),
d1 AS (
  SELECT * FROM scoped QUALIFY row_number() OVER (
    PARTITION BY operation, snapshot_date, propertyCode ORDER BY {_ORDER}) = 1
),
rel1 AS (
  SELECT * FROM rel QUALIFY row_number() OVER (
    PARTITION BY operation, snapshot_date, propertyCode ORDER BY {_ORDER}) = 1
),
d2 AS (
  SELECT * FROM scoped QUALIFY row_number() OVER (
    PARTITION BY operation, propertyCode ORDER BY snapshot_date DESC, {_ORDER_DESC}) = 1
),
recent AS (
  SELECT * FROM scoped
  WHERE snapshot_date >= (SELECT max(snapshot_date) - INTERVAL 3 MONTH FROM scoped)
),
recent2 AS (
  SELECT * FROM recent QUALIFY row_number() OVER (
    PARTITION BY operation, propertyCode ORDER BY snapshot_date DESC, {_ORDER_DESC}) = 1
),
recent1 AS (
  SELECT * FROM d1
  WHERE snapshot_date >= (SELECT max(snapshot_date) - INTERVAL 3 MONTH FROM d1)
),
recent_rel1 AS (
  SELECT * FROM rel1
  WHERE snapshot_date >= (SELECT max(snapshot_date) - INTERVAL 3 MONTH FROM rel1)
),
explored AS (
  SELECT * FROM valid
  WHERE bathrooms > 0 AND district IN ('AFRICA', 'ASIA', 'EUROPE')
    AND ((operation = 'sale' AND priceByArea > 1000 AND priceByArea < 10000)
         OR operation = 'rent')
),
explored_rel AS (
  SELECT * FROM explored
  WHERE hasLift AND floor IS DISTINCT FROM '1' AND size > 120 AND rooms >= 2 AND bathrooms >= 2
  QUALIFY row_number() OVER (
    PARTITION BY propertyCode ORDER BY operation DESC, snapshot_date DESC, {_ORDER_DESC}) = 1
),
keys AS (
  SELECT 'bronze/'
    || CASE WHEN l_linenumber = 7 THEN 'auction' WHEN l_linestatus = 'O' THEN 'sale'
            ELSE 'rent' END
    || '_' || CASE WHEN l_linenumber = 6 THEN strftime(l_shipdate, '%Y13%d')
                   ELSE strftime(l_shipdate, '%Y%m%d') END
    || '_120000_' || CASE WHEN l_linenumber = 5 THEN '' ELSE CAST(l_orderkey AS VARCHAR) END
    || '.json' AS key,
    CASE WHEN l_linenumber NOT IN (5, 6, 7) THEN
      CASE WHEN l_linestatus = 'O' THEN 'sale' ELSE 'rent' END END AS operation,
    CASE WHEN l_linenumber NOT IN (5, 6, 7) THEN CAST(l_shipdate AS DATE) END AS snapshot_date,
    CASE WHEN l_linenumber NOT IN (5, 6, 7) THEN l_orderkey END AS page
  FROM lineitem
),
snaps AS (
  SELECT operation, snapshot_date, count(*) AS pages FROM keys
  WHERE operation IS NOT NULL GROUP BY ALL
),
numbered AS (
  SELECT *, l_orderkey // 2000 AS block,
    row_number() OVER (PARTITION BY page_operation, snapshot_date, l_orderkey // 2000
      ORDER BY {_ORDER}) - 1 AS position
  FROM raw
),
paged AS (
  SELECT *, page_operation || '_' || strftime(snapshot_date, '%Y%m%d') || '_120000_'
      || CAST(block * 100000 + position // 50 AS VARCHAR) || '.json' AS page_file,
    (block + position // 50) % 7 = 3 AS cut_off,
    position % 50 AS page_pos
  FROM numbered
),
runs AS (
  SELECT event_type AS function_name, ts, event_id, value * 1000 / 1000 AS duration_seconds,
    user_id % 29 <> 0 AS succeeded,
    row_number() OVER (PARTITION BY event_type ORDER BY ts DESC, user_id % 29 = 0 DESC,
      value DESC NULLS LAST, CASE WHEN user_id % 29 = 0 THEN 1 ELSE 0 END) AS recency
  FROM events
  WHERE (user_id % 29 = 0 OR user_id % 31 <> 0)
    AND ts >= (SELECT max(ts) - INTERVAL 30 DAY FROM events)
  QUALIFY recency <= 5
),
functions(function_name) AS (
  VALUES ('click'), ('error'), ('purchase'), ('refund'), ('signup'), ('view')
),
success AS (
  SELECT function_name, count(recency) AS invocations_checked,
    CASE WHEN bool_or(recency = 1 AND NOT succeeded) THEN 'red'
         WHEN count(recency) = 0 OR bool_or(recency > 1 AND NOT succeeded) THEN 'yellow'
         ELSE 'green' END AS status
  FROM functions LEFT JOIN runs USING (function_name) GROUP BY function_name
),
duration AS (
  SELECT function_name, count(recency) AS invocations_checked,
    max(duration_seconds) AS max_duration_seconds,
    CASE WHEN max(duration_seconds) > 120 THEN 'red'
         WHEN count(recency) = 0 OR max(duration_seconds) >= 60 THEN 'yellow'
         ELSE 'green' END AS status
  FROM functions LEFT JOIN runs USING (function_name) GROUP BY function_name
),
clock AS (SELECT CAST(max(o_orderdate) AS DATE) - 1 AS today FROM orders),
months AS (
  SELECT CAST(date_trunc('month', today) - to_months(CAST(i AS INTEGER)) AS DATE) AS month
  FROM clock, range(1, 6) AS r(i)
),
sets(credential_set, label) AS (
  VALUES ('F', 'filled'), ('O', 'open'), ('P', 'pending'), ('X', 'unused')
),
monthly AS (
  SELECT credential_set, label, strftime(month, '%Y-%m') AS month,
    CAST(count(o_orderkey) AS DOUBLE) AS requests
  FROM sets CROSS JOIN months
  LEFT JOIN orders ON o_orderstatus = credential_set
    AND date_trunc('month', o_orderdate) = months.month
  GROUP BY ALL
),
quota AS (
  SELECT credential_set, label,
    CASE WHEN max(requests) >= 75 THEN 'red' WHEN max(requests) >= 60 THEN 'yellow'
         ELSE 'green' END AS status, CAST(100 AS INTEGER) AS quota
  FROM monthly GROUP BY ALL
),
costs AS (
  SELECT CAST(o_orderdate AS DATE) AS day, o_orderpriority AS service,
    CAST(o_totalprice AS DECIMAL(18, 2)) AS amount FROM orders
),
mtd AS (
  SELECT CASE WHEN included >= 1e8 THEN 'red' WHEN included >= 2e7 THEN 'yellow'
              ELSE 'green' END AS status, * FROM (
    SELECT
      CAST(COALESCE(sum(amount) FILTER (service <> '5-LOW'), 0) AS DOUBLE) AS included,
      CAST(COALESCE(sum(amount) FILTER (service = '5-LOW'), 0) AS DOUBLE) AS excluded,
      COALESCE(max(service) FILTER (service = '5-LOW'), '') AS excluded_services
    FROM costs, clock WHERE day >= date_trunc('month', today) AND day < today)
),
monthly_cost AS (
  SELECT strftime(day, '%Y-%m') AS month, service, CAST(sum(amount) AS DOUBLE) AS amount
  FROM costs, clock
  WHERE day >= date_trunc('month', today) - INTERVAL 5 MONTH
    AND day < date_trunc('month', today) AND service <> '5-LOW'
  GROUP BY ALL
)
"""

_LISTING = (
    "operation, district, neighborhood, strftime(snapshot_date, '%Y-%m-%d') AS snapshot_date, "
    "propertyCode, price, priceByArea, size, floor, rooms, bathrooms, hasLift"
)
_DAY = "strftime(snapshot_date, '%Y-%m-%d') AS snapshot_date"


def _r(expression: str, name: str, digits: int = 4) -> str:
    return f"round({expression} + 1e-9, {digits}) AS {name}"


_MEANS = ", ".join(
    (
        "count(propertyCode) AS count_listings",
        _r("avg(priceByArea)", "mean_priceByArea"),
        _r("avg(size)", "mean_size"),
        _r("avg(price)", "mean_price"),
    )
)


def _price_series(source: str, keys: str) -> str:
    return f"SELECT {keys}, {_DAY}, {_MEANS} FROM {source} GROUP BY {keys}, snapshot_date"


def _raw_ratio(source: str, keys: str, min_count: int) -> str:
    """The literal form: aggregate each side, then join."""

    def side(operation: str) -> str:
        return (
            f"(SELECT {keys}, count(propertyCode) AS n, avg(priceByArea) AS ppa, "
            f"avg(size) AS size, avg(price) AS price FROM {source} "
            f"WHERE operation = '{operation}' GROUP BY {keys})"
        )

    return (
        f"SELECT {keys}, s.ppa AS sale_ppa, r.ppa AS rent_ppa, s.ppa / r.ppa AS ratio, "
        "s.n AS count_listings_sale, r.n AS count_listings_rent, s.size AS sale_size, "
        "r.size AS rent_size, s.price AS sale_price, r.price AS rent_price "
        f"FROM {side('sale')} s JOIN {side('rent')} r USING ({keys}) "
        f"WHERE s.n >= {min_count} AND r.n >= {min_count}"
    )


def _ratio(source: str, keys: str = "district, neighborhood", min_count: int = 5) -> str:
    shown = keys.replace("snapshot_date", _DAY)
    return (
        f"SELECT {shown}, {_r('sale_ppa', 'mean_priceByArea_sale')}, "
        f"{_r('rent_ppa', 'mean_priceByArea_rent')}, "
        f"{_r('ratio', 'mean_sales_price_by_rent_ratio')}, "
        "count_listings_sale, count_listings_rent "
        f"FROM ({_raw_ratio(source, keys, min_count)})"
    )


def _wide_ratio(source: str) -> str:
    return (
        f"SELECT district, neighborhood, {_r('sale_ppa', 'mean_priceByArea_sale')}, "
        f"{_r('rent_ppa', 'mean_priceByArea_rent')}, "
        f"{_r('ratio', 'mean_sales_price_by_rent_ratio')}, "
        f"{_r('sale_size', 'mean_size_sale')}, {_r('rent_size', 'mean_size_rent')}, "
        "count_listings_sale, count_listings_rent, "
        f"{_r('sale_price', 'mean_price_sale')}, {_r('rent_price', 'mean_price_rent')} "
        f"FROM ({_raw_ratio(source, 'district, neighborhood', 5)})"
    )


def _raw_box(source: str, min_count: int = 1) -> str:
    return (
        "SELECT operation, district, neighborhood, count(priceByArea) AS count, "
        "min(priceByArea) AS min, quantile_cont(priceByArea, 0.25) AS q1, "
        "quantile_cont(priceByArea, 0.5) AS median, quantile_cont(priceByArea, 0.75) AS q3, "
        f"max(priceByArea) AS max FROM {source} "
        f"GROUP BY operation, district, neighborhood HAVING count(priceByArea) >= {min_count}"
    )


def _box(source: str, min_count: int = 1) -> str:
    values = ", ".join(_r(c, c) for c in ("min", "q1", "median", "q3", "max"))
    return (
        f"SELECT operation, district, neighborhood, count, {values} "
        f"FROM ({_raw_box(source, min_count)})"
    )


def _weighted_median(boxes: str) -> str:
    return (
        "SELECT operation, min(median) AS wm FROM (SELECT operation, median, "
        "sum(count) OVER (PARTITION BY operation ORDER BY median "
        "ROWS UNBOUNDED PRECEDING) AS running, "
        f"sum(count) OVER (PARTITION BY operation) AS total FROM ({boxes})) "
        "WHERE running * 2 >= total GROUP BY operation"
    )


def _yield(ratio: str) -> str:
    return (
        "SELECT 12 / (sum(ratio * (count_listings_sale + count_listings_rent)) "
        f"/ sum(count_listings_sale + count_listings_rent)) * 100 FROM ({ratio})"
    )


def _total(ratio: str) -> str:
    return f"SELECT CAST(sum(count_listings_sale + count_listings_rent) AS BIGINT) FROM ({ratio})"


def _summary(boxes: str, ratio: str) -> str:
    median = "(SELECT wm FROM ({}) WHERE operation = '{}')"
    medians = _weighted_median(boxes)
    return (
        f"SELECT {_r(median.format(medians, 'rent'), 'median_rent_per_m2_month')}, "
        f"{_r(median.format(medians, 'sale'), 'median_sale_per_m2')}, "
        f"{_r('(' + _yield(ratio) + ')', 'implied_gross_yield_percent')}, "
        f"({_total(ratio)}) AS total_listing_count, "
        "'2026-01-01T12:00:00+00:00' AS last_updated"
    )


def _line(dataset: str, keys: str, y: str, rounded: bool = True) -> str:
    value = _r(y, "y") if rounded else f"{y} AS y"
    return (
        f"SELECT {keys}, row_number() OVER (PARTITION BY {keys} ORDER BY snapshot_date) - 1 "
        f"AS pos, {_DAY.replace('AS snapshot_date', 'AS x')}, {value} FROM ({dataset})"
    )


def _cells(keys: str) -> str:
    return (
        f"SELECT {keys}, snapshot_date, count(propertyCode) AS n, avg(priceByArea) AS ppa "
        f"FROM d1 GROUP BY {keys}, snapshot_date"
    )


_PLACE = "operation, district, neighborhood"

_SIZE_HIST = (
    "SELECT operation, CAST(floor(size / 10) * 10 AS BIGINT) AS bin_start_m2, "
    "CAST(floor(size / 10) * 10 + 10 AS BIGINT) AS bin_end_m2, count(*) AS count_listings "
    "FROM d2 GROUP BY ALL"
)
_ROOMS = "SELECT operation, rooms, count(*) AS count_listings FROM d2 GROUP BY ALL"
_PRICE_HIST = (
    "SELECT operation, floor(priceByArea / w) * w AS bin_start_price_m2, "
    "floor(priceByArea / w) * w + w AS bin_end_price_m2, count(*) AS count_listings "
    "FROM (SELECT *, CASE operation WHEN 'rent' THEN CAST(1 AS DOUBLE) "
    "ELSE CAST(250 AS DOUBLE) END AS w FROM d2) GROUP BY ALL"
)
_GRID = (
    "SELECT operation, district, neighborhood, "
    "round_even(latitude * 1000, 0) / 1000 AS lat, round_even(longitude * 1000, 0) / 1000 AS lon, "
    "count(*) AS count_listings FROM recent2 "
    "WHERE latitude IS NOT NULL AND longitude IS NOT NULL GROUP BY ALL"
)
_LATLON = f"{_r('latitude', 'latitude', 6)}, {_r('longitude', 'longitude', 6)}"
_LOCATED = "FROM recent2 WHERE latitude IS NOT NULL AND longitude IS NOT NULL"


def _bars(dataset: str, position: str, label: str) -> str:
    return (
        f"SELECT operation, row_number() OVER (PARTITION BY operation ORDER BY {position}) - 1 "
        f"AS pos, {label} AS x, count_listings AS y FROM ({dataset})"
    )


_NUMERIC = ("latitude", "longitude", "price", "priceByArea", "size", "rooms", "bathrooms")
_CORRELATED = (*_NUMERIC, "exterior", "newDevelopment", "hasLift")


def _describe() -> str:
    def of(c: str, x: str) -> str:
        return (
            f"SELECT operation, '{c}' AS \"column\", count({x}) AS count, {_r(f'avg({x})', 'mean')}, "
            f"{_r(f'stddev_samp({x})', 'std')}, {_r(f'CAST(min({x}) AS DOUBLE)', 'min')}, "
            f"{_r(f'quantile_cont({x}, 0.25)', 'q1')}, {_r(f'quantile_cont({x}, 0.5)', 'median')}, "
            f"{_r(f'quantile_cont({x}, 0.75)', 'q3')}, {_r(f'CAST(max({x}) AS DOUBLE)', 'max')} "
            "FROM valid GROUP BY operation"
        )

    numbers = {c: c for c in _NUMERIC} | {"distance": "TRY_CAST(distance AS DOUBLE)"}
    return " UNION ALL ".join(of(c, x) for c, x in numbers.items())


def _correlations() -> str:
    def number(c: str) -> str:
        return f"CAST({c} AS DOUBLE)" if c in _NUMERIC else f"CAST(CAST({c} AS INTEGER) AS DOUBLE)"

    return " UNION ALL ".join(
        f"SELECT '{a}' AS \"column\", '{b}' AS later_column, abs(corr({number(a)}, {number(b)})) AS r FROM valid"
        for i, a in enumerate(_CORRELATED)
        for b in _CORRELATED[i + 1 :]
    )


_GOLD_KEYS = ("operation", "district", "neighborhood", "snapshot_date")


def _gold_records(wanted: tuple[str, ...] = ("general", "relevant", "data_basis")) -> str:
    """All records in one shape, each dataset from its own definition."""
    place_ts = f"{_PLACE}, snapshot_date"
    ratio_ts = "district, neighborhood, snapshot_date"
    means = ("n", "ppa", "size", "price")
    ratio = ("sale_ppa", "rent_ppa", "ratio", "count_listings_sale", "count_listings_rent")
    box = ("count", "min", "q1", "median", "q3", "max")

    def means_of(keys: str) -> str:
        return (
            f"SELECT {keys}, count(propertyCode) AS n, avg(priceByArea) AS ppa, "
            f"avg(size) AS size, avg(price) AS price FROM d1 GROUP BY {keys}"
        )

    def trends(listings: str, recent: str) -> dict[str, tuple[str, str, tuple[str, ...]]]:
        return {
            "rent_vs_sale_ratio": (
                _raw_ratio(listings, "district, neighborhood", 5), "district, neighborhood", ratio
            ),
            "rent_vs_sale_ratio_time_series": (_raw_ratio(listings, ratio_ts, 5), ratio_ts, ratio),
            "boxplot_by_neighborhood": (_raw_box(listings), _PLACE, box),
            "boxplot_by_neighborhood_last_3m": (_raw_box(recent, 5), _PLACE, box),
        }

    blocks = {
        "general": {
            "price_time_series_neighborhood": (means_of(place_ts), place_ts, means),
            "price_time_series_district": (
                means_of("operation, district, snapshot_date"), "operation, district, snapshot_date", means
            ),
            **trends("d1", "recent1"),
        },
        "relevant": trends("rel1", "recent_rel1"),
        "data_basis": {
            "weekly_listing_volume": (_cells("operation"), "operation, snapshot_date", ("n",)),
            "size_histogram_10sqm": (
                _SIZE_HIST, "operation", ("bin_start_m2", "bin_end_m2", "count_listings")
            ),
            "rooms_distribution": (_ROOMS, "operation", ("rooms", "count_listings")),
            "price_per_area_histogram": (
                _PRICE_HIST, "operation", ("bin_start_price_m2", "bin_end_price_m2", "count_listings")
            ),
            "listing_location_grid_last_3m": (_GRID, _PLACE, ("lat", "lon", "count_listings")),
            "listing_locations_last_3m": (
                f"SELECT * {_LOCATED}", _PLACE, ("latitude", "longitude")
            ),
        },
    }

    def records(block: str, name: str, sql: str, keys: str, values: tuple[str, ...]) -> str:
        present = keys.split(", ")
        shown = [
            ("NULL::VARCHAR" if k not in present else _DAY.split(" AS ")[0] if k == "snapshot_date" else k)
            + f" AS {k}"
            for k in _GOLD_KEYS
        ]
        numbers = [
            _r(f"CAST({values[i]} AS DOUBLE)", f"v{i}") if i < len(values) else f"NULL::DOUBLE AS v{i}"
            for i in range(6)
        ]
        return (
            f"SELECT '{block}' AS block, '{name}' AS dataset, {', '.join(shown)}, "
            f"{', '.join(numbers)} FROM ({sql})"
        )

    return " UNION ALL ".join(
        records(block, name, *definition)
        for block in wanted
        for name, definition in blocks[block].items()
    )


_STATUSES = (
    "SELECT status FROM success UNION ALL SELECT status FROM duration "
    "UNION ALL SELECT status FROM quota UNION ALL SELECT status FROM mtd"
)


def _worst(source: str) -> str:
    return (
        "SELECT CASE min(CASE status WHEN 'red' THEN 0 WHEN 'yellow' THEN 1 ELSE 2 END) "
        f"WHEN 0 THEN 'red' WHEN 1 THEN 'yellow' ELSE 'green' END AS status FROM ({source})"
    )


def _pages_profile() -> str:
    counts = (
        "count(DISTINCT page_file) FILTER (NOT cut_off) AS files_scanned, "
        "count(DISTINCT page_file) FILTER (cut_off) AS files_failed, "
        "count(*) FILTER (NOT cut_off) AS total_elements, "
        "count(*) FILTER (NOT cut_off AND priceByArea IS NULL) AS null_price_by_area, "
        "count(*) FILTER (NOT cut_off AND neighborhood = '') AS missing_neighborhood, "
        "count(*) FILTER (NOT cut_off AND own_operation IS NULL) AS missing_operation"
    )
    percent = ", ".join(
        _r(f"{c} * 100.0::DOUBLE / total_elements", f"{c}_pct")
        for c in ("null_price_by_area", "missing_neighborhood", "missing_operation")
    )
    return f"SELECT *, {percent} FROM (SELECT {counts} FROM paged)"


_STORED = """(SELECT * FROM paged WHERE priceByArea IS NOT NULL
  AND neighborhood <> '' AND (bathrooms IS NULL OR bathrooms > 0)
  AND (page_operation <> 'sale' OR (priceByArea > 1000 AND priceByArea < 10000)))"""

_RATIO_RAW = _raw_ratio("d1", "district, neighborhood", 5)

_BODIES: dict[str, str] = {
    "bronze_key_decode": f"SELECT key, operation, {_DAY}, page FROM keys",
    "bronze_skipped_keys": (
        "SELECT key, count(*) AS n FROM keys WHERE operation IS NULL GROUP BY key"
    ),
    "bronze_page_scan": (
        f"SELECT page_file, page_pos, page_operation, {_DAY}, own_operation AS operation, "
        "propertyCode, neighborhood, priceByArea, CAST(bathrooms AS DOUBLE) AS bathrooms, "
        "hasLift, parkingSpace FROM paged"
    ),
    "bronze_quality_profile": _pages_profile(),
    "bronze_failed_pages": "SELECT DISTINCT page_file FROM paged WHERE cut_off",
    "silver_clean": (
        "SELECT operation, r_name AS province, n_name AS municipality, district, neighborhood, "
        "latitude, longitude, distance, address, propertyCode, propertyType, price, priceByArea, "
        "size, floor, exterior, rooms, bathrooms, status, newDevelopment, hasLift, parkingSpace, "
        f"{_DAY} FROM valid"
    ),
    "silver_from_pages": (
        f"SELECT page_operation AS operation, {_DAY}, count(*) AS n_rows, "
        "CAST(sum(page_pos) AS BIGINT) AS sum_pos, count(*) AS n_operation "
        f"FROM {_STORED} GROUP BY page_operation, snapshot_date"
    ),
    "silver_history_roundtrip": (
        f"SELECT page_operation AS operation, {_DAY}, count(*) AS n_rows, "
        f"count(DISTINCT propertyCode) AS n_properties, {_r('sum(price)', 'sum_price', 2)}, "
        f"CAST(sum(rooms) AS BIGINT) AS sum_rooms FROM {_STORED} "
        "GROUP BY page_operation, snapshot_date"
    ),
    "silver_incremental": (
        f"SELECT page_operation AS operation, {_DAY}, count(*) AS n_rows FROM {_STORED} "
        "WHERE page_operation = 'sale' GROUP BY page_operation, snapshot_date"
    ),
    "csv_roundtrip": (
        "SELECT operation, r_name AS province, n_name AS municipality, district, neighborhood, "
        "latitude, longitude, distance, address, propertyCode, propertyType, price, priceByArea, "
        "size, floor, exterior, rooms, bathrooms, status, newDevelopment, hasLift, parkingSpace, "
        f"{_DAY} FROM valid"
    ),
    "silver_job_run": (
        "SELECT CASE WHEN snapshot_date = max(snapshot_date) OVER (PARTITION BY operation) "
        "THEN 'latest' ELSE 'backfill' END AS run, operation, "
        f"{_DAY}, n_rows AS n_reported, CAST(2 AS BIGINT) AS skipped, n_rows, n_properties, "
        f"{_r('sum_price', 'sum_price', 2)} FROM (SELECT page_operation AS operation, snapshot_date, "
        "count(*) AS n_rows, count(DISTINCT propertyCode) AS n_properties, sum(price) AS sum_price "
        f"FROM {_STORED} GROUP BY page_operation, snapshot_date)"
    ),
    "silver_ledger": (
        f"SELECT operation, {_DAY}, pages, n_rows FROM (SELECT page_operation AS operation, snapshot_date, "
        "count(DISTINCT page_file) AS pages FROM paged GROUP BY ALL) JOIN (SELECT page_operation AS operation, "
        f"snapshot_date, count(*) AS n_rows FROM {_STORED} GROUP BY ALL) USING (operation, snapshot_date)"
    ),
    "silver_empty_snapshot": (
        "SELECT operation, strftime(snapshot_date, '%Y-%m-%d') AS snapshot_date, pages, "
        "CASE WHEN operation = 'sale' THEN 0 END AS run, CASE WHEN operation = 'sale' THEN true END AS snapshots_found, "
        "n_rows FROM (SELECT page_operation AS operation, snapshot_date, CAST(sum(pages) AS BIGINT) AS pages FROM ("
        "SELECT page_operation, snapshot_date, block, (count(*) + 49) // 50 AS pages FROM ("
        "SELECT *, l_orderkey // 2000 AS block FROM raw WHERE page_operation = 'sale' OR l_quantity IN (49, 50)) "
        "GROUP BY ALL) GROUP BY ALL) LEFT JOIN (SELECT page_operation AS operation, snapshot_date, count(*) AS n_rows "
        f"FROM {_STORED} WHERE page_operation = 'sale' GROUP BY ALL) USING (operation, snapshot_date)"
    ),
    "silver_refused_table": (
        "SELECT missing, true AS refused, (SELECT count(*) FROM valid) AS n_rows "
        "FROM (VALUES ('operation'), ('snapshot_date')) AS m(missing)"
    ),
    "gold_of_no_listing": (
        "SELECT block, dataset, (SELECT count(*) FROM valid WHERE district = 'ATLANTIS') AS n_records FROM ("
        "SELECT unnest(['general', 'relevant']) AS block, unnest([['rent_vs_sale_ratio', 'rent_vs_sale_ratio_time_series', "
        "'boxplot_by_neighborhood', 'boxplot_by_neighborhood_last_3m', 'price_time_series_neighborhood', "
        "'price_time_series_district'], ['rent_vs_sale_ratio', 'rent_vs_sale_ratio_time_series', "
        "'boxplot_by_neighborhood', 'boxplot_by_neighborhood_last_3m']]) AS names UNION ALL SELECT 'data_basis', "
        "['weekly_listing_volume', 'size_histogram_10sqm', 'rooms_distribution', 'price_per_area_histogram', "
        "'listing_location_grid_last_3m', 'listing_locations_last_3m']), unnest(names) AS n(dataset)"
    ),
    "gold_from_state": _gold_records(),
    "latest_rows_state": (
        f"SELECT operation, propertyCode, {_DAY}, size, rooms, {_r('priceByArea', 'priceByArea')}, "
        "district, neighborhood FROM d2"
    ),
    "boxplot_merged": _box("d1"),
    "boxplot_merged_last_3m": _box("recent1", 5),
    "locations_in_box": (
        f"SELECT operation, district, neighborhood, {_LATLON} {_LOCATED} "
        "AND latitude BETWEEN CAST(39.42 AS DOUBLE) AND CAST(39.46 AS DOUBLE) "
        "AND longitude BETWEEN CAST(-0.397 AS DOUBLE) AND CAST(-0.392 AS DOUBLE)"
    ),
    "sampled_listings": (
        "SELECT l_orderkey, l_linenumber, propertyCode, operation FROM valid "
        "ORDER BY sha256('7|' || l_orderkey || '|' || l_linenumber || '|' || propertyCode) LIMIT 500"
    ),
    "silver_snapshots": f"SELECT operation, {_DAY}, pages FROM snaps",
    "latest_snapshot": (
        f"SELECT operation, {_DAY}, pages FROM snaps s WHERE snapshot_date = "
        "(SELECT max(snapshot_date) FROM snaps t WHERE t.operation = s.operation)"
    ),
    "snapshot_on_date": (
        f"SELECT operation, {_DAY}, pages FROM snaps WHERE snapshot_date = DATE '1998-06-15'"
    ),
    "snapshot_dates": f"SELECT DISTINCT {_DAY} FROM snaps",
    "unwritten_snapshots": (
        f"SELECT operation, {_DAY}, pages FROM snaps WHERE snapshot_date NOT IN "
        "(SELECT CAST(o_orderdate AS DATE) FROM orders WHERE o_orderstatus = 'P')"
    ),
    "scope_filter": f"SELECT {_LISTING} FROM scoped",
    "relevant_filter": (
        f"SELECT {_LISTING} FROM valid WHERE hasLift AND floor IS DISTINCT FROM '1' "
        "AND size > 120 AND rooms >= 2 AND bathrooms >= 2"
    ),
    "rolling_window": (
        f"SELECT {_LISTING} FROM valid WHERE snapshot_date >= "
        "(SELECT max(snapshot_date) - INTERVAL 3 MONTH FROM valid)"
    ),
    "coordinate_filter": (
        f"SELECT {_LISTING} FROM valid WHERE latitude IS NOT NULL AND longitude IS NOT NULL"
    ),
    "exploration_clean": f"SELECT {_LISTING} FROM explored",
    "dashboard_scope": (
        "SELECT operation, district, neighborhood, "
        f"{_DAY}, n AS count_listings FROM ({_cells(_PLACE)}) "
        "WHERE district IN ('AFRICA', 'ASIA') AND neighborhood IN ('NATION_12', 'NATION_15') "
        f"UNION ALL SELECT operation, district, NULL, {_DAY}, n "
        f"FROM ({_cells('operation, district')}) WHERE district IN ('AFRICA', 'ASIA')"
    ),
    "dedup_snapshot": (
        f"SELECT {_LISTING} FROM (SELECT * FROM valid QUALIFY row_number() OVER (PARTITION BY "
        f"operation, snapshot_date, propertyCode ORDER BY {_ORDER}) = 1)"
    ),
    "latest_by_property": (
        f"SELECT {_LISTING} FROM (SELECT * FROM valid QUALIFY row_number() OVER (PARTITION BY "
        f"operation, propertyCode ORDER BY snapshot_date DESC, {_ORDER_DESC}) = 1)"
    ),
    "dedup_global": (
        f"SELECT {_LISTING} FROM (SELECT * FROM valid QUALIFY row_number() OVER (PARTITION BY "
        f"propertyCode ORDER BY operation DESC, snapshot_date DESC, {_ORDER_DESC}) = 1)"
    ),
    "price_ts_neighborhood": _price_series("d1", _PLACE),
    "price_ts_district": _price_series("d1", "operation, district"),
    "weekly_volume": (
        f"SELECT operation, {_DAY}, count(propertyCode) AS count_listings FROM d1 "
        "GROUP BY operation, snapshot_date"
    ),
    "ratio_all": _ratio("d1"),
    "ratio_all_relevant": _ratio("rel1"),
    "ratio_ts": _ratio("d1", "district, neighborhood, snapshot_date"),
    "ratio_ts_relevant": _ratio("rel1", "district, neighborhood, snapshot_date", 1),
    "boxplot_all": _box("d1"),
    "boxplot_all_relevant": _box("rel1"),
    "boxplot_last_3m": _box("recent1", 5),
    "boxplot_last_3m_relevant": _box("recent_rel1", 5),
    "size_hist": _SIZE_HIST,
    "rooms_dist": _ROOMS,
    "price_hist": _PRICE_HIST,
    "location_grid": (
        f"SELECT operation, district, neighborhood, {_r('lat', 'latitude', 6)}, "
        f"{_r('lon', 'longitude', 6)}, count_listings FROM ({_GRID})"
    ),
    "listing_locations": (
        f"SELECT operation, district, neighborhood, {_LATLON} {_LOCATED}"
    ),
    "gold_document": _gold_records(),
    "gold_tables_general": _gold_records(("general",)),
    "gold_tables_relevant": _gold_records(("relevant",)),
    "gold_tables_data_basis": _gold_records(("data_basis",)),
    "download_volume": (
        f"SELECT operation, {_DAY}, count(propertyCode) AS count_listings FROM explored "
        "GROUP BY operation, snapshot_date"
    ),
    "monthly_volume": (
        f"SELECT operation, {_r('avg(n)', 'weekly_mean')}, {_r('avg(n) * 5', 'monthly_mean')} "
        "FROM (SELECT operation, snapshot_date, count(propertyCode) AS n FROM explored "
        "GROUP BY operation, snapshot_date) GROUP BY operation"
    ),
    "neighborhood_stats": (
        f"SELECT district, neighborhood, operation, {_MEANS} FROM explored GROUP BY ALL"
    ),
    "ratio_wide": _wide_ratio("explored"),
    "ratio_wide_relevant": _wide_ratio("explored_rel"),
    "ordered_means": (
        f"SELECT operation, neighborhood, {_r('avg(priceByArea)', 'mean_priceByArea')} "
        "FROM explored GROUP BY operation, neighborhood"
    ),
    "describe_by_operation": _describe(),
    "zero_rooms_by_type": (
        "SELECT propertyType, count(propertyCode) AS count_listings FROM valid "
        "WHERE rooms = 0 GROUP BY propertyType"
    ),
    "zero_bathrooms_by_neighborhood": (
        "SELECT neighborhood, count(propertyCode) AS count_listings FROM raw "
        "WHERE bathrooms = 0 GROUP BY neighborhood"
    ),
    "correlation_pairs": (
        f"SELECT \"column\", later_column, {_r('r', 'abs_correlation')} FROM ({_correlations()})"
    ),
    "redundant_columns": (
        f"SELECT DISTINCT later_column AS \"column\" FROM ({_correlations()}) WHERE r > 0.5"
    ),
    # price per area is the one column that correlates above 0.5 with an earlier one
    "drop_redundant": "SELECT propertyCode, "
    + ", ".join(
        f"CAST({c} AS DOUBLE) AS {c}" if c in _NUMERIC else f"CAST(CAST({c} AS INTEGER) AS DOUBLE) AS {c}"
        for c in _CORRELATED
        if c != "priceByArea"
    )
    + " FROM valid",
    "first_listings": (
        f"SELECT {_LISTING} FROM (SELECT * FROM valid ORDER BY {_ORDER} LIMIT 3)"
    ),
    "max_price": "SELECT max(priceByArea) AS max_priceByArea FROM valid",
    "scope_districts": (
        f"SELECT DISTINCT district FROM ({_RATIO_RAW}) "
        f"UNION SELECT DISTINCT district FROM ({_raw_box('recent1', 5)})"
    ),
    "scope_neighborhoods": (
        "SELECT DISTINCT neighborhood FROM d1 WHERE district IN ('ASIA', 'EUROPE')"
    ),
    "weighted_median_kpi": (
        f"SELECT operation, {_r('wm', 'weighted_median')} FROM ({_weighted_median(_raw_box('d1'))})"
    ),
    "preferred_boxes": _box("recent1", 5),
    "preferred_boxes_fallback": _box("d1"),
    "gross_yield": (
        f"SELECT {_r('(' + _yield(_RATIO_RAW) + ')', 'implied_gross_yield_percent')}"
    ),
    "listing_total": f"SELECT ({_total(_RATIO_RAW)}) AS total_listing_count",
    "kpi_summary": _summary(_raw_box("recent1", 5), _RATIO_RAW),
    "dashboard_figures": _summary(
        f"SELECT * FROM ({_raw_box('recent_rel1', 5)}) UNION ALL "
        f"SELECT * FROM ({_raw_box('rel1')}) "
        f"WHERE NOT EXISTS (SELECT 1 FROM ({_raw_box('recent_rel1', 5)}))",
        _raw_ratio("rel1", "district, neighborhood", 5),
    ),
    "series_neighborhood": (
        f"SELECT * FROM ({_line(_cells(_PLACE), _PLACE, 'ppa')}) WHERE operation = 'sale'"
    ),
    "series_district": _line(_cells("operation, district"), "operation, district", "ppa"),
    "series_counts_neighborhood": _line(_cells(_PLACE), _PLACE, "n", False),
    "series_counts_district": _line(
        _cells("operation, district"), "operation, district", "n", False
    ),
    "series_ratio": _line(
        _raw_ratio("d1", "district, neighborhood, snapshot_date", 5),
        "district, neighborhood",
        "ratio",
    ),
    "series_volume": _line(_cells("operation"), "operation", "n", False),
    "bars_size": _bars(
        _SIZE_HIST,
        "bin_start_m2",
        "CAST(bin_start_m2 AS VARCHAR) || '-' || CAST(bin_end_m2 AS VARCHAR)",
    ),
    "bars_rooms": _bars(_ROOMS, "rooms", "CAST(rooms AS VARCHAR)"),
    "bars_price": _bars(
        _PRICE_HIST,
        "bin_start_price_m2",
        "CAST(CAST(bin_start_price_m2 AS BIGINT) AS VARCHAR) || '-' "
        "|| CAST(CAST(bin_end_price_m2 AS BIGINT) AS VARCHAR)",
    ),
    "ratio_points": (
        f"SELECT {_r('rent_ppa', 'x')}, {_r('sale_ppa', 'y')}, "
        f"neighborhood || ' (' || district || ')' AS label FROM ({_RATIO_RAW})"
    ),
    "map_points": (
        f"SELECT neighborhood AS series, {_LATLON}, "
        f"neighborhood || ' (' || operation || ')' AS label {_LOCATED}"
    ),
    "grid_points": (
        f"SELECT district AS series, {_r('lat', 'latitude', 6)}, {_r('lon', 'longitude', 6)}, "
        "count_listings, neighborhood || ' (' || operation || '): ' "
        f"|| CAST(count_listings AS VARCHAR) || ' listing(s)' AS label FROM ({_GRID})"
    ),
    "recent_invocations": (
        "SELECT function_name, recency, "
        "strftime(ts, '%Y-%m-%dT%H:%M:%S') || CASE WHEN microsecond(ts) % 1000000 = 0 THEN '' "
        "ELSE strftime(ts, '.%f') END AS ts, succeeded, "
        f"{_r('duration_seconds', 'duration_seconds')} FROM runs"
    ),
    "execution_success": (
        "SELECT function_name, status, invocations_checked, (invocations_checked = 0 "
        "OR (invocations_checked < 5 AND status = 'green')) AS insufficient_history FROM success"
    ),
    "execution_duration": (
        "SELECT function_name, status, invocations_checked, "
        f"{_r('max_duration_seconds', 'max_duration_seconds')}, "
        "invocations_checked < 5 AS insufficient_history FROM duration"
    ),
    "invocation_series": (
        "SELECT function_name, row_number() OVER (PARTITION BY function_name ORDER BY ts) - 1 "
        "AS pos, strftime(ts, '%Y-%m-%dT%H:%M:%S') || CASE WHEN microsecond(ts) % 1000000 = 0 "
        "THEN '' ELSE strftime(ts, '.%f') END AS ts, succeeded, "
        f"{_r('duration_seconds', 'duration_seconds')} FROM runs"
    ),
    "monthly_requests": "SELECT credential_set, month, requests FROM monthly",
    "api_quota": "SELECT credential_set, status, label, quota FROM quota",
    "quota_series": (
        "SELECT credential_set, label, row_number() OVER (PARTITION BY credential_set "
        "ORDER BY month) - 1 AS pos, month, requests FROM monthly"
    ),
    "request_accounting": (
        "SELECT CASE l_linestatus WHEN 'O' THEN 'sale_requests' ELSE 'rent_requests' END "
        "AS credential_set, strftime(date_trunc('month', l_shipdate), '%Y-%m-%d') AS month, "
        "CAST(count(*) AS DOUBLE) AS requests FROM lineitem WHERE l_linenumber <> 7 GROUP BY ALL"
    ),
    "cost_mtd": (
        "SELECT status, included AS included_total, excluded AS excluded_total, "
        "excluded_services FROM mtd"
    ),
    "cost_mtd_first_of_month": (
        "SELECT CASE WHEN included >= 1e8 THEN 'red' WHEN included >= 2e7 THEN 'yellow' "
        "ELSE 'green' END AS status, included AS included_total, excluded AS excluded_total, "
        "excluded_services FROM (SELECT "
        "CAST(sum(amount) FILTER (service <> '5-LOW') AS DOUBLE) AS included, "
        "CAST(sum(amount) FILTER (service = '5-LOW') AS DOUBLE) AS excluded, "
        "max(service) FILTER (service = '5-LOW') AS excluded_services FROM costs, clock "
        "WHERE day >= date_trunc('month', today) - INTERVAL 1 MONTH "
        "AND day < date_trunc('month', today))"
    ),
    "cost_history": "SELECT month, service, amount FROM monthly_cost",
    "cost_matrix": "SELECT month, "
    + ", ".join(
        f"COALESCE(sum(amount) FILTER (service = '{s}'), 0) AS \"{s}\""
        for s in ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED")
    )
    + " FROM monthly_cost GROUP BY month",
    "overall_status": _worst(_STATUSES),
    "stage_status": (
        "SELECT stage, function_name, COALESCE(CASE min(CASE status WHEN 'red' THEN 0 "
        "WHEN 'yellow' THEN 1 WHEN 'green' THEN 2 END) WHEN 0 THEN 'red' WHEN 1 THEN 'yellow' "
        "WHEN 2 THEN 'green' END, 'unknown') AS status "
        "FROM (VALUES ('bronze', 'click'), ('silver', 'view'), ('gold', 'absent')) "
        "AS stages(stage, function_name) LEFT JOIN (SELECT function_name, status FROM success "
        "UNION ALL SELECT function_name, status FROM duration) USING (function_name) "
        "GROUP BY stage, function_name"
    ),
    "health_document_statuses": (
        f"SELECT ({_worst(_STATUSES)}) AS overall_status, "
        f"({_worst('SELECT status FROM success')}) AS execution_success, "
        f"({_worst('SELECT status FROM duration')}) AS execution_duration, "
        f"({_worst('SELECT status FROM quota')}) AS api_quota, "
        "(SELECT status FROM mtd) AS aws_cost"
    ),
}


def oracle_sql() -> dict[str, str]:
    return {name: f"{_VIEWS}{body}" for name, body in _BODIES.items()}
