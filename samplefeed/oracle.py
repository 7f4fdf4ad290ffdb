"""SQL side of the sample feed: the expected tables straight from lineitem, no JSON involved."""

# flat: what the messages must decode to. dated: + approach_date. clean: rows without a missing
# column, + is_train (keyed split), prediction and class texts of the fixed scorer (max diameter - 3 > 0).
CTES = """
WITH flat AS (
  SELECT
    CASE WHEN l_orderkey % 211 = 0 THEN NULL
         ELSE 'neo-' || l_orderkey || '-' || l_linenumber END AS name,
    CASE WHEN l_orderkey % 211 = 0 OR l_orderkey % 53 = 0 THEN NULL
         WHEN l_orderkey % 61 = 0 THEN strftime(l_shipdate, '%Y-%-m-%-d')
         ELSE strftime(l_shipdate, '%Y-%m-%d') END AS close_approach_date,
    CASE WHEN l_orderkey % 211 = 0 OR l_orderkey % 101 = 0 THEN NULL
         ELSE l_extendedprice / 20000.0::DOUBLE END AS estimated_diameter_km_max,
    CASE WHEN l_orderkey % 211 = 0 OR l_orderkey % 101 = 0 THEN NULL
         ELSE l_extendedprice / 20000.0::DOUBLE / 2.236::DOUBLE END AS estimated_diameter_km_min,
    CASE WHEN l_orderkey % 211 = 0 OR l_orderkey % 53 = 0 OR l_orderkey % 89 = 0 THEN NULL
         WHEN l_orderkey % 83 = 0 THEN 'nan'::DOUBLE
         WHEN l_orderkey % 79 = 0 THEN 'inf'::DOUBLE
         WHEN l_orderkey % 73 = 0 THEN '-inf'::DOUBLE
         WHEN l_orderkey % 71 = 0 THEN 'inf'::DOUBLE
         ELSE l_quantity END AS relative_velocity_km_s,
    CASE WHEN l_orderkey % 211 = 0 OR l_orderkey % 53 = 0 THEN NULL
         ELSE l_partkey * 25.5::DOUBLE + l_quantity END AS miss_distance_km,
    CASE WHEN l_orderkey % 211 <> 0 AND l_orderkey % 97 <> 0
              AND ((l_extendedprice > 60000) <> (l_orderkey % 23 = 0))
         THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS is_potentially_hazardous_asteroid
  FROM lineitem),
dated AS (
  SELECT *, CASE WHEN length(close_approach_date) = 10
                 THEN try_cast(close_approach_date AS DATE) END AS approach_date
  FROM flat),
clean AS (
  SELECT *,
    ('0x' || substr(md5(name), 1, 8))::BIGINT % 100 < 80 AS is_train,
    CASE WHEN estimated_diameter_km_max - 3.0::DOUBLE > 0 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS prediction,
    CASE WHEN is_potentially_hazardous_asteroid = 1 THEN 'Hazardous' ELSE 'Not Hazardous' END AS real_value,
    CASE WHEN estimated_diameter_km_max - 3.0::DOUBLE > 0 THEN 'Hazardous' ELSE 'Not Hazardous' END AS predicted_value
  FROM dated
  WHERE name IS NOT NULL AND approach_date IS NOT NULL AND estimated_diameter_km_max IS NOT NULL
    AND coalesce(isfinite(relative_velocity_km_s), false) AND miss_distance_km IS NOT NULL)
"""
