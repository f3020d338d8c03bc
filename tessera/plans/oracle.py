"""DuckDB statements that compute the same result as each catalogue query.

Column names and types match the Spark side (``year()`` is BIGINT in
DuckDB, hence the INT casts; ``CASE ... 1/0`` is INTEGER; ``count`` is
BIGINT).  Floating aggregates are rounded on both sides.
"""


def _correlation_matrix() -> str:
    """One SELECT a pair; a value that is constant where both are there gives null."""
    columns = {"l_quantity": "l_quantity", "l_extendedprice": "l_extendedprice", "l_discount": "l_discount", "l_tax": "l_tax",
               "l_linenumber": "nullif(l_linenumber, 3)", "net_price": "l_extendedprice * (1 - l_discount)", "one": "1.5::DOUBLE"}
    pairs = [f"""SELECT '{x}' AS x, '{y}' AS y, CASE WHEN max(a) FILTER (b IS NOT NULL) > min(a) FILTER (b IS NOT NULL)
       AND max(b) FILTER (a IS NOT NULL) > min(b) FILTER (a IS NOT NULL) THEN round(corr(a, b), 6) END AS r
FROM (SELECT ({a})::DOUBLE AS a, ({b})::DOUBLE AS b FROM lineitem)""" for x, a in columns.items() for y, b in columns.items()]
    return "\nUNION ALL ".join(pairs)


ORACLE_SQL = {
    "feature_table": """
WITH base AS (
  SELECT o.o_orderkey, o.o_totalprice, CAST(year(o.o_orderdate) AS INT) AS year, c.c_nationkey AS nation,
         CASE lower(o.o_orderpriority) WHEN '4-not specified' THEN 'unspecified' ELSE lower(o.o_orderpriority) END AS priority,
         CASE WHEN o.o_orderstatus = 'F' THEN 1 ELSE 0 END AS st_f,
         CASE WHEN o.o_orderstatus = 'O' THEN 1 ELSE 0 END AS st_o
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
  WHERE o.o_orderstatus <> 'P'),
inc AS (SELECT c_nationkey AS nation, CAST(CAST(round(avg(c_acctbal), 6) AS FLOAT) AS DECIMAL(10,2)) AS average_income
        FROM customer GROUP BY c_nationkey),
hou AS (SELECT s_nationkey AS nation, round(avg(s_acctbal), 4) AS average_price FROM supplier GROUP BY s_nationkey)
SELECT b.year, b.nation, b.o_orderkey, b.o_totalprice, b.priority, b.st_f, b.st_o, i.average_income, h.average_price
FROM base b LEFT JOIN inc i ON b.nation = i.nation LEFT JOIN hou h ON b.nation = h.nation""",
    "snapshot_scan": """
SELECT o_orderkey, o_totalprice, o_orderstatus, CAST(year(o_orderdate) AS INT) AS year FROM orders""",
    "schema_unify": """
SELECT o_orderkey, o_orderstatus,
       CASE WHEN year(o_orderdate) >= 1998 THEN o_orderpriority END AS o_orderpriority
FROM orders""",
    "keyed_object_scan": "SELECT c_name, c_custkey, c_nationkey, c_acctbal FROM customer",
    "csv_scan": "SELECT p_partkey, p_brand, p_size FROM part",
    "parquet_scan": "SELECT c_custkey, c_mktsegment, c_acctbal FROM customer",
    "partitioned_scan": """
SELECT o_orderkey, o_totalprice, CAST(year(o_orderdate) AS INT) AS year, o_orderstatus FROM orders""",
    "paged_records": "SELECT conv_id, turn, role, text FROM conversations",
    "source_registry": """
SELECT 'orders' AS source, count(*) AS n_rows FROM orders
UNION ALL SELECT 'lineitem', count(*) FROM lineitem""",
    "document_collection": """
SELECT CAST(c_custkey AS VARCHAR) AS _id, c_name, c_mktsegment FROM customer""",
    "table_profile": "SELECT count(*) AS n_rows, CAST(6 AS INT) AS n_cols FROM orders",
    "rename_drop": "SELECT p_partkey AS id, p_brand AS brand, p_partkey AS _id FROM part",
    "constant_column": "SELECT o_orderkey, o_orderstatus, CAST(2020 AS INT) AS year FROM orders",
    "filter_equal": """
SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus = 'F' AND o_orderpriority = '1-URGENT'""",
    "filter_not_equal_null": """
SELECT p_partkey, k FROM (SELECT p_partkey, nullif(p_type, 'PROMO') AS k FROM part) t WHERE k <> 'SMALL'""",
    "corrupt_filter": """
SELECT event_id, CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT) AS k
FROM events WHERE event_type <> 'error'""",
    "surrogate_key": """
SELECT p_partkey, concat(lower(regexp_replace(p_name, '\\s', '_', 'g')), CAST(p_size AS VARCHAR)) AS _id FROM part""",
    "mixed_concat_key": """
SELECT s_suppkey, concat(CAST(s_suppkey AS VARCHAR), CAST(s_nationkey AS VARCHAR), '2020') AS _id FROM supplier""",
    "separated_key": """
SELECT s_suppkey, concat_ws('|', CAST(s_suppkey AS VARCHAR), CAST(s_nationkey AS VARCHAR), '2020') AS _id
FROM supplier""",
    "canonicalise": """
SELECT c_custkey,
       CASE lower(CASE c_mktsegment WHEN 'BUILDING' THEN 'The Building' ELSE c_mktsegment END)
         WHEN 'machinery' THEN 'machines' WHEN 'household' THEN 'home'
         ELSE lower(CASE c_mktsegment WHEN 'BUILDING' THEN 'The Building' ELSE c_mktsegment END) END AS segment
FROM customer""",
    "casts": """
SELECT l_orderkey, CAST(CAST(l_extendedprice AS FLOAT) AS DECIMAL(10,2)) AS price,
       CAST(CAST(l_quantity > 25 AS INT) AS DOUBLE) AS big FROM lineitem""",
    "year_from_name": """
SELECT c_custkey, CAST(nullif(regexp_extract(c_name, '[0-9]{4}', 0), '') AS INT) AS digits FROM customer""",
    "left_join": """
SELECT c.c_custkey, n.n_name
FROM (SELECT c_custkey, CASE WHEN c_nationkey = 8 AND c_custkey % 2 = 1 THEN -1 ELSE nullif(c_nationkey, 7) END AS k
      FROM customer) c
LEFT JOIN nation n ON c.k = n.n_nationkey""",
    "left_join_two_keys_null": """
SELECT o.o_orderkey, d.n
FROM (SELECT o_orderkey, nullif(o_orderstatus, 'P') AS st, o_orderpriority AS pr FROM orders) o
LEFT JOIN (SELECT nullif(o_orderstatus, 'P') AS st, o_orderpriority AS pr, count(*) AS n FROM orders GROUP BY 1, 2) d
  ON o.st = d.st AND o.pr = d.pr""",
    "picked_files": """
SELECT c_custkey, c_nationkey, c_mktsegment FROM customer WHERE c_custkey % 3 <> 0""",
    "star_join_two_keys": """
WITH o AS (SELECT o_orderkey, year(o_orderdate) AS yr, o_orderpriority AS pr, o_orderstatus, o_totalprice FROM orders),
top AS (SELECT yr, pr, max(o_totalprice) AS top_price FROM o WHERE o_orderstatus = 'P' GROUP BY yr, pr),
done AS (SELECT yr, pr, count(*) AS n_done FROM o WHERE o_orderstatus = 'F' GROUP BY yr, pr),
fact AS (SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 0 THEN yr + 100 ELSE yr END AS yr, pr FROM o)
SELECT o_orderkey, top_price, n_done FROM fact LEFT JOIN top USING (yr, pr) LEFT JOIN done USING (yr, pr)""",
    "left_join_fanout": """
SELECT n.n_nationkey, s.s_suppkey FROM nation n LEFT JOIN supplier s ON n.n_nationkey = s.s_nationkey""",
    "union_positional": """
SELECT c_custkey AS id, c_acctbal AS bal FROM customer UNION ALL SELECT s_suppkey, s_acctbal FROM supplier""",
    "union_by_name": """
SELECT c_custkey AS id, c_name AS name, c_mktsegment AS segment FROM customer
UNION ALL SELECT s_suppkey AS id, s_name AS name, CAST(NULL AS VARCHAR) AS segment FROM supplier""",
    "distinct_values": "SELECT DISTINCT p_type FROM part",
    "keyed_dedup": """
SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                               ORDER BY l_shipdate DESC, l_partkey, l_suppkey, l_extendedprice) AS rn
  FROM lineitem) t WHERE rn = 1""",
    "first_order_per_customer": """
SELECT o_custkey, o_orderkey, o_totalprice FROM (
  SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS rn
  FROM orders) t WHERE rn = 1""",
    "drop_duplicates_count": "SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem",
    "group_mean_decimal": """
SELECT CAST(year(l_shipdate) AS INT) AS year, l_returnflag, l_linestatus,
       CAST(CAST(round(avg(l_extendedprice), 6) AS FLOAT) AS DECIMAL(10,2)) AS average_price
FROM lineitem GROUP BY 1, 2, 3""",
    "global_means": """
SELECT round(avg(l_quantity), 4) AS l_quantity, round(avg(l_extendedprice), 4) AS l_extendedprice,
       round(avg(l_tax), 6) AS l_tax FROM lineitem""",
    "mean_impute": """
SELECT p_partkey, round(coalesce(CAST(nullif(p_size, 11) AS DOUBLE),
                                 avg(CAST(nullif(p_size, 11) AS DOUBLE)) OVER ()), 6) AS p_size FROM part""",
    "one_hot": """
SELECT p_partkey, CASE WHEN p_type = 'PROMO' THEN 1 ELSE 0 END AS promo,
       CASE WHEN p_type = 'SMALL' THEN 1 ELSE 0 END AS small FROM part""",
    "one_hot_discovered": """
SELECT p_partkey,
       CASE WHEN p_type = 'ECONOMY' THEN 1 ELSE 0 END AS "ECONOMY",
       CASE WHEN p_type = 'LARGE' THEN 1 ELSE 0 END AS "LARGE",
       CASE WHEN p_type = 'MEDIUM' THEN 1 ELSE 0 END AS "MEDIUM",
       CASE WHEN p_type = 'PROMO' THEN 1 ELSE 0 END AS "PROMO",
       CASE WHEN p_type = 'SMALL' THEN 1 ELSE 0 END AS "SMALL",
       CASE WHEN p_type = 'STANDARD' THEN 1 ELSE 0 END AS "STANDARD"
FROM part""",
    "correlation_ranking": """
SELECT 'l_quantity' AS feature, round(corr(l_quantity, l_extendedprice * (1 - l_discount)), 6) AS r FROM lineitem
UNION ALL SELECT 'l_extendedprice', round(corr(l_extendedprice, l_extendedprice * (1 - l_discount)), 6) FROM lineitem
UNION ALL SELECT 'l_discount', round(corr(l_discount, l_extendedprice * (1 - l_discount)), 6) FROM lineitem""",
    "feature_selection": """
SELECT feature FROM (SELECT 'p_partkey' AS feature, corr(p_partkey, p_retailprice) AS r FROM part
                     UNION ALL SELECT 'p_size', corr(p_size, p_retailprice) FROM part) t
WHERE abs(r) > 0.1""",
    "key_split": """
SELECT p_partkey, CASE WHEN p_partkey % 10 < 8 THEN 'train' ELSE 'validation' END AS part_name FROM part""",
    "linear_regression": """
SELECT round(regr_slope(l_extendedprice * (1 - l_discount), l_extendedprice), 4) AS slope,
       round(regr_intercept(l_extendedprice * (1 - l_discount), l_extendedprice), 2) AS intercept FROM lineitem""",
    "rmse": """
SELECT round(sqrt(avg(power(l_extendedprice * 0.95 - l_extendedprice * (1 - l_discount), 2))), 4) AS rmse
FROM lineitem""",
    "vector_features": """
SELECT l_orderkey, [coalesce(l_quantity, avg(l_quantity) OVER ()), coalesce(l_extendedprice, avg(l_extendedprice) OVER ()),
                    coalesce(l_discount, avg(l_discount) OVER ()), coalesce(l_tax, avg(l_tax) OVER ()),
                    coalesce(l_linenumber, avg(l_linenumber) OVER ())]::DOUBLE[] AS features FROM lineitem""",
    "incremental_ingest": """
SELECT user_id, event_id, event_type FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events) t
WHERE rn = 1""",
    "correlation_matrix": _correlation_matrix(),
    "elastic_net_grid": """
WITH RECURSIVE lines AS (
  SELECT l_quantity AS a, l_extendedprice AS b, l_discount AS c, l_extendedprice * (1 - l_discount) / 100000 AS y FROM lineitem),
m AS (
  SELECT corr(a, b) AS ab, corr(a, c) AS ac, corr(b, c) AS bc, corr(a, y) AS ay, corr(b, y) AS bY, corr(c, y) AS cy,
         stddev_pop(a) AS sa, stddev_pop(b) AS sb, stddev_pop(c) AS sc, stddev_pop(y) AS sy,
         avg(a) AS ma, avg(b) AS mb, avg(c) AS mc, avg(y) AS my FROM lines),
grid AS (
  SELECT reg_param, elastic_net, reg_param * elastic_net / sy AS l1, reg_param * (1 - elastic_net) / sy AS l2, m.*
  FROM (SELECT unnest([0.1, 0.01, 0.001])::DOUBLE AS reg_param), (SELECT unnest([0.0, 0.5, 1.0])::DOUBLE AS elastic_net), m),
walk AS (
  SELECT reg_param, elastic_net, 0 AS step, 0.0::DOUBLE AS wa, 0.0::DOUBLE AS wb, 0.0::DOUBLE AS wc FROM grid
  UNION ALL
  SELECT t.reg_param, t.elastic_net, step + 1, na, nb,
         sign(g.cy - g.ac * na - g.bc * nb) * greatest(abs(g.cy - g.ac * na - g.bc * nb) - g.l1, 0) / (1 + g.l2)
  FROM (SELECT s.*, sign(g.bY - g.ab * na - g.bc * wc) * greatest(abs(g.bY - g.ab * na - g.bc * wc) - g.l1, 0) / (1 + g.l2) AS nb
        FROM (SELECT w.*, sign(g.ay - g.ab * wb - g.ac * wc) * greatest(abs(g.ay - g.ab * wb - g.ac * wc) - g.l1, 0) / (1 + g.l2) AS na
              FROM walk w JOIN grid g USING (reg_param, elastic_net) WHERE step < 600) s
        JOIN grid g USING (reg_param, elastic_net)) t
  JOIN grid g USING (reg_param, elastic_net)),
done AS (
  SELECT g.*, wa * sy / sa AS ka, wb * sy / sb AS kb, wc * sy / sc AS kc FROM walk JOIN grid g USING (reg_param, elastic_net) WHERE step = 600)
SELECT reg_param, elastic_net, unnest(['intercept', 'l_quantity', 'l_extendedprice', 'l_discount']) AS term,
       round(unnest([my - ka * ma - kb * mb - kc * mc, ka, kb, kc]), 7) + 0.0 AS value FROM done""",
    "model_registry": "SELECT * FROM (VALUES ('LR', 9::BIGINT, 0::BIGINT, true), ('RF', 2::BIGINT, 0::BIGINT, true)) t(family, fits, added, same)",
    "random_split": """
SELECT l_orderkey, l_quantity, l_extendedprice, l_discount, l_tax, l_linenumber,
       CASE WHEN ('0x' || substr(md5(concat_ws(':', '42', copy, line)), 1, 13))::BIGINT / 4503599627370496.0 < 0.8
            THEN 'train' ELSE 'validation' END AS part_name
FROM (SELECT *, row_number() OVER (PARTITION BY line) AS copy
      FROM (SELECT *, concat_ws(chr(31), l_orderkey, l_quantity, l_extendedprice, l_discount, l_tax, l_linenumber) AS line
            FROM lineitem))""",
    "first_wins_schema": """
SELECT o_orderkey, CASE WHEN year(o_orderdate) >= 1998 THEN o_orderpriority END AS o_orderpriority,
       CAST(year(o_orderdate) AS INT) AS year, 'o_orderkey bigint,price bigint,o_orderpriority string' AS schema FROM orders""",
    "csv_inferred": """
SELECT l_orderkey::BIGINT AS l_orderkey, l_linenumber::BIGINT AS l_linenumber, l_extendedprice, l_returnflag, l_shipdate::DATE AS l_shipdate,
       'int,int,double,string,timestamp' AS types FROM lineitem""",
    "versioned_table": """
SELECT o_orderkey, CASE WHEN year(o_orderdate) = 1997 THEN o_totalprice + 1000 ELSE o_totalprice END AS o_totalprice,
       CAST(year(o_orderdate) AS INT) AS year, o_orderstatus, 3::BIGINT AS version, true AS refused FROM orders""",
    "offset_pages": """
SELECT conv_id::VARCHAR AS conv_id, turn::VARCHAR AS turn, role, text,
       CASE WHEN role = 'system' AND conv_id > 50 THEN '{"note":' || length(text) || '}' END AS _extra FROM conversations""",
    "skewed_join": """
SELECT f.k, count(*) AS n, sum(d.cents)::BIGINT AS cents
FROM (SELECT CASE WHEN l_orderkey % 3 = 0 THEN -1 WHEN l_orderkey % 50 = 1 THEN -2 ELSE l_suppkey END AS k FROM lineitem) f
LEFT JOIN (SELECT CASE WHEN s_suppkey % 3 = 0 THEN -1 ELSE s_suppkey END AS k, round(s_acctbal * 100)::BIGINT AS cents FROM supplier) d
  ON f.k = d.k GROUP BY f.k""",
}
ORACLE_SQL["canonicalise_rules"] = ORACLE_SQL["canonicalise"]
