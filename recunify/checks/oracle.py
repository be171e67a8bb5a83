"""DuckDB oracle SQL for every registered query.

Written from the operators' semantics in plain SQL (row_number windows,
NOT EXISTS, per-column passes joined back), so that it checks the Spark
operators by an independent formulation.  Views ``events orders
lineitem part customer nation region ...`` are pre-registered by the
driver; the stand-in views are CTEs below.
"""

from __future__ import annotations

CONTACTS = """contacts AS (
  SELECT user_id AS contact_id,
         event_type AS source_type,
         'ch' || CAST(event_id % 7 AS VARCHAR) AS source,
         CASE WHEN event_id % 3 = 0 THEN '' WHEN event_id % 5 = 0 THEN NULL ELSE props END AS attr_a,
         CASE WHEN event_id % 4 = 0 THEN NULL WHEN event_id % 7 = 0 THEN ''
              ELSE CAST(CAST(floor(value) AS INTEGER) AS VARCHAR) END AS attr_b,
         strftime(ts, '%Y-%m-%d') AS update_day,
         strftime(ts, '%H_%M_%S') AS update_time,
         event_id
  FROM events)"""

TIERED = CONTACTS + """,
tiered AS (
  SELECT *, CASE WHEN substr(source_type, 1, 6) = 'signup' OR substr(source_type, 1, 5) = 'error' THEN 1
                 WHEN substr(source_type, 1, 4) = 'view' OR substr(source_type, 1, 5) = 'click' THEN 2
                 WHEN substr(source_type, 1, 8) = 'purchase' THEN 3 END AS tier
  FROM contacts)"""


def _blank(c: str) -> str:
    return f"({c} IS NULL OR {c} = '')"


SQL: dict[str, str] = {}

SQL["scan_prefix"] = f"""WITH {CONTACTS}
SELECT * FROM contacts WHERE substr(source_type, 1, 2) = 'pu'"""

SQL["tier_union"] = f"""WITH {CONTACTS}
SELECT *, 1 AS tier FROM contacts WHERE substr(source_type, 1, 3) = 'sig'
UNION ALL SELECT *, 2 AS tier FROM contacts WHERE substr(source_type, 1, 4) = 'view'
UNION ALL SELECT *, 2 AS tier FROM contacts WHERE substr(source_type, 1, 3) = 'cli'
UNION ALL SELECT *, 3 AS tier FROM contacts WHERE substr(source_type, 1, 3) = 'pur'"""

SQL["fill_any"] = f"""WITH {CONTACTS},
a AS (SELECT contact_id, attr_a FROM (
        SELECT contact_id, attr_a,
               row_number() OVER (PARTITION BY contact_id ORDER BY attr_a DESC NULLS LAST) AS rn
        FROM contacts) WHERE rn = 1),
b AS (SELECT contact_id, attr_b FROM (
        SELECT contact_id, attr_b,
               row_number() OVER (PARTITION BY contact_id ORDER BY attr_b DESC NULLS LAST) AS rn
        FROM contacts) WHERE rn = 1)
SELECT a.contact_id, a.attr_a, b.attr_b FROM a JOIN b ON a.contact_id = b.contact_id"""

SQL["fill_latest"] = f"""WITH {CONTACTS}
SELECT contact_id, attr_a FROM (
  SELECT contact_id, attr_a,
         row_number() OVER (PARTITION BY contact_id
                            ORDER BY CASE WHEN {_blank('attr_a')} THEN 0 ELSE 1 END DESC,
                                     update_day DESC NULLS LAST, update_time DESC NULLS LAST,
                                     event_id DESC NULLS LAST) AS rn
  FROM contacts) WHERE rn = 1"""

SQL["fill_priority"] = f"""WITH {TIERED},
per_tier AS (
  SELECT contact_id, tier, attr_b FROM (
    SELECT contact_id, tier, attr_b,
           row_number() OVER (PARTITION BY contact_id, tier ORDER BY attr_b DESC NULLS LAST) AS rn
    FROM tiered WHERE tier IS NOT NULL) WHERE rn = 1)
SELECT contact_id, attr_b FROM (
  SELECT contact_id, attr_b,
         row_number() OVER (PARTITION BY contact_id
                            ORDER BY CASE WHEN {_blank('attr_b')} THEN 0 ELSE 1 END DESC, tier DESC) AS rn
  FROM per_tier) WHERE rn = 1"""

SQL["provenance"] = f"""WITH {CONTACTS}
SELECT contact_id,
       coalesce(string_agg(DISTINCT source, ',' ORDER BY source), '') AS source,
       coalesce(string_agg(DISTINCT source_type, ',' ORDER BY source_type), '') AS source_type
FROM contacts GROUP BY contact_id"""


def _tier_pick(col: str) -> str:
    # tier 1 keeps the largest value; tiers 2 and 3 the latest non-empty one
    return f"""{col}_t AS (
  SELECT contact_id, tier, {col} FROM (
    SELECT contact_id, tier, {col},
           row_number() OVER (PARTITION BY contact_id, tier
                              ORDER BY CASE WHEN tier = 1 THEN {col} END DESC NULLS LAST,
                                       CASE WHEN {_blank(col)} THEN 0 ELSE 1 END DESC,
                                       update_day DESC NULLS LAST, update_time DESC NULLS LAST,
                                       event_id DESC NULLS LAST) AS rn
    FROM tt) WHERE rn = 1),
{col}_f AS (
  SELECT contact_id, {col} FROM (
    SELECT contact_id, {col},
           row_number() OVER (PARTITION BY contact_id
                              ORDER BY CASE WHEN {_blank(col)} THEN 0 ELSE 1 END DESC, tier DESC) AS rn
    FROM {col}_t) WHERE rn = 1)"""


SQL["golden_record"] = f"""WITH {TIERED},
tt AS (SELECT * FROM tiered WHERE tier IS NOT NULL AND contact_id IS NOT NULL),
{_tier_pick('attr_a')},
{_tier_pick('attr_b')},
prov_tier AS (
  SELECT contact_id, tier,
         coalesce(string_agg(DISTINCT source, ',' ORDER BY source), '') AS source,
         coalesce(string_agg(DISTINCT source_type, ',' ORDER BY source_type), '') AS source_type
  FROM tt GROUP BY contact_id, tier),
prov AS (
  SELECT contact_id,
         coalesce(string_agg(DISTINCT source, ',' ORDER BY source), '') AS source,
         coalesce(string_agg(DISTINCT source_type, ',' ORDER BY source_type), '') AS source_type
  FROM prov_tier GROUP BY contact_id)
SELECT a.contact_id, a.attr_a, b.attr_b, p.source, p.source_type
FROM attr_a_f a JOIN attr_b_f b ON a.contact_id = b.contact_id
JOIN prov p ON a.contact_id = p.contact_id"""

SQL["latest_dedup"] = f"""WITH {CONTACTS}
SELECT contact_id, source_type, source, attr_a, attr_b, update_day, update_time, event_id FROM (
  SELECT *, row_number() OVER (PARTITION BY source_type, contact_id
                               ORDER BY update_day DESC NULLS LAST, update_time DESC NULLS LAST,
                                        event_id DESC NULLS LAST) AS rn
  FROM contacts
  WHERE update_day >= strftime(DATE '2024-01-31' - INTERVAL 20 DAY, '%Y-%m-%d')) WHERE rn = 1"""

SQL["hot_rows"] = f"""WITH {CONTACTS}
SELECT * FROM contacts WHERE update_day >= strftime(DATE '2024-01-31' - INTERVAL 14 DAY, '%Y-%m-%d')"""

SQL["cold_rows"] = f"""WITH {CONTACTS}
SELECT * FROM contacts WHERE update_day < strftime(DATE '2024-01-31' - INTERVAL 14 DAY, '%Y-%m-%d')"""

SQL["drop_blank"] = f"""WITH {CONTACTS}
SELECT * FROM contacts WHERE NOT (attr_a IS NULL OR trim(attr_a) = '')"""

SQL["partition_manifest"] = f"""WITH {CONTACTS}
SELECT 'ALTER TABLE dw.contacts ADD IF NOT EXISTS PARTITION (source_type=''' || source_type
       || ''',update_day=''' || update_day || ''');' AS partition
FROM (SELECT DISTINCT source_type, update_day FROM contacts)"""

SQL["partition_manifest_odd"] = f"""WITH {CONTACTS},
named AS (SELECT CASE source_type WHEN 'error' THEN NULL WHEN 'signup' THEN '' WHEN 'view' THEN 'it''s \\ a view'
                 ELSE source_type END AS s, update_day FROM contacts)
SELECT DISTINCT 'ALTER TABLE dw.contacts ADD IF NOT EXISTS PARTITION (source_type='''
       || CASE WHEN s IS NULL OR s = '' THEN '__HIVE_DEFAULT_PARTITION__'
               ELSE replace(replace(s, '\\', '\\\\'), '''', '\\''') END
       || ''',update_day=''' || update_day || ''');' AS partition
FROM named"""

OUTCOMES = """outcomes AS (
  SELECT o_custkey AS mobile, o_orderstatus AS category, o_orderkey AS project,
         o_orderpriority AS title,
         CASE WHEN trim(o_orderpriority) = '1-URGENT' THEN 'customer_filter_child'
              WHEN trim(o_orderpriority) = '2-HIGH' THEN 'customer_filter_success'
              WHEN trim(o_orderpriority) = '4-NOT SPECIFIED' THEN 'customer_filter_age'
              WHEN trim(o_orderpriority) = '5-LOW' THEN 'customer_filter_refuse' END AS source,
         strftime(o_orderdate, '%Y-%m-%d') AS update_day
  FROM orders)"""

CALLS = """calls AS (
  SELECT o.o_custkey AS mobile, o.o_orderstatus AS category, l.l_suppkey AS project,
         l.l_orderkey AS order_key,
         CAST(CAST(trunc(l.l_quantity) AS INTEGER) AS VARCHAR) AS duration_time,
         strftime(l.l_shipdate, '%Y-%m-%d') AS update_day
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey)"""

CLOSED = """closed AS (
  SELECT o_custkey AS mobile, o_orderstatus AS category FROM orders WHERE o_orderpriority = '3-MEDIUM')"""

CUSTOMERS = """customers AS (
  SELECT c_custkey AS mobile, c_name AS user_name,
         CASE WHEN c_custkey % 4 = 0 THEN ' ' WHEN c_custkey % 5 = 0 THEN NULL ELSE c_mktsegment END AS city_short
  FROM customer)"""

SQL["history_keys"] = f"""WITH {OUTCOMES}
SELECT mobile FROM outcomes
WHERE source = 'customer_filter_age' AND update_day < '2001-01-01' AND update_day >= '2000-10-01'
GROUP BY mobile"""

HISTORY = """history AS (
  SELECT l_partkey AS mobile,
         CASE l_returnflag WHEN 'R' THEN 'customer_filter_child' WHEN 'A' THEN 'customer_filter_success'
              ELSE CASE l_linestatus WHEN 'O' THEN 'customer_filter_age' ELSE 'customer_filter_refuse' END END AS source,
         CASE l_linenumber WHEN 1 THEN 'OPERATOR_customer' ELSE 'BEHAVIOR_visit' END AS source_type,
         strftime(l_shipdate, '%Y-%m-%d') AS update_day
  FROM lineitem)"""

SQL["anti_history"] = f"""WITH {HISTORY}, {CUSTOMERS}
SELECT * FROM customers c
WHERE NOT EXISTS (SELECT 1 FROM history h
                  WHERE h.mobile = c.mobile AND h.source = 'customer_filter_refuse'
                    AND h.source_type = 'OPERATOR_customer' AND h.update_day < '2002-01-01')"""

SQL["two_groups"] = f"""WITH {OUTCOMES},
r2 AS (SELECT category, mobile FROM (
         SELECT category, mobile,
                dense_rank() OVER (PARTITION BY category, mobile ORDER BY title ASC NULLS FIRST) AS dr
         FROM outcomes) WHERE dr = 2)
SELECT o.* FROM outcomes o
WHERE EXISTS (SELECT 1 FROM r2 WHERE r2.category = o.category AND r2.mobile = o.mobile)"""

SQL["two_groups_repeat"] = f"""WITH {OUTCOMES},
r2 AS (SELECT category, mobile FROM (
         SELECT category, mobile,
                dense_rank() OVER (PARTITION BY category, mobile ORDER BY title ASC NULLS FIRST) AS dr
         FROM outcomes) WHERE dr = 2)
SELECT o.mobile, o.category, o.project, o.title, o.source, o.update_day, count(*) AS copies
FROM outcomes o JOIN r2 ON r2.category = o.category AND r2.mobile = o.mobile
GROUP BY o.mobile, o.category, o.project, o.title, o.source, o.update_day"""

SQL["reason_code"] = f"""WITH {OUTCOMES}
SELECT mobile, category, project, title,
       CASE WHEN trim(title) = '1-URGENT' THEN 'customer_filter_child'
            WHEN trim(title) = '2-HIGH' THEN 'customer_filter_success'
            WHEN trim(title) = '4-NOT SPECIFIED' THEN 'customer_filter_age'
            WHEN trim(title) = '5-LOW' THEN 'customer_filter_refuse' END AS source,
       update_day
FROM outcomes
WHERE update_day BETWEEN '1998-10-05' AND '1998-10-31'
  AND title IN ('1-URGENT', '2-HIGH', '3-MEDIUM')"""

SQL["short_calls"] = f"""WITH {CALLS}
SELECT * FROM calls
WHERE update_day BETWEEN '1999-01-01' AND '1999-01-14' AND TRY_CAST(duration_time AS INTEGER) <= 5
  AND length(CAST(mobile AS VARCHAR)) = 3"""

SQL["suppression_candidates"] = f"""WITH {OUTCOMES}, {CALLS}, {HISTORY},
known AS (SELECT DISTINCT mobile, source, update_day FROM history
          WHERE source_type = 'OPERATOR_customer' AND update_day < '2000-06-30'),
fresh AS (
  SELECT * FROM outcomes o
  WHERE update_day BETWEEN '2000-05-01' AND '2000-06-30'
    AND source IN ('customer_filter_child', 'customer_filter_success', 'customer_filter_age')
    AND NOT EXISTS (SELECT 1 FROM known k WHERE k.mobile = o.mobile AND k.source = o.source)),
seen_twice AS (
  SELECT category, mobile FROM fresh WHERE source = 'customer_filter_age'
  GROUP BY category, mobile
  HAVING count(DISTINCT project) + max(CASE WHEN project IS NULL THEN 1 ELSE 0 END) >= 2),
short AS (SELECT * FROM calls WHERE update_day BETWEEN '2000-06-16' AND '2000-06-30'
          AND TRY_CAST(duration_time AS INTEGER) <= 5),
called_twice AS (
  SELECT mobile FROM short GROUP BY mobile
  HAVING count(DISTINCT project) + max(CASE WHEN project IS NULL THEN 1 ELSE 0 END) >= 2)
SELECT mobile, category, project, title, source, update_day AS event_day,
       'OPERATOR_customer' AS source_type, '2000-06-30' AS update_day, '20_00_00' AS update_time
FROM fresh f
WHERE source <> 'customer_filter_age'
   OR EXISTS (SELECT 1 FROM seen_twice s WHERE s.category = f.category AND s.mobile = f.mobile)
UNION ALL
SELECT mobile, category, project, '', 'customer_filter_refuse', update_day,
       'OPERATOR_customer', '2000-06-30', '20_00_00'
FROM short c
WHERE mobile IN (SELECT mobile FROM called_twice)
  AND NOT EXISTS (SELECT 1 FROM known k WHERE k.mobile = c.mobile AND k.source = 'customer_filter_refuse'
                  AND k.update_day >= '2000-04-01')"""

# one CTE per suppression reason; a NULL category applies to every category
SUPPRESSION_ALL = f"""{OUTCOMES}, {CLOSED},
wrong_age AS (SELECT mobile, CAST(NULL AS VARCHAR) AS category FROM outcomes WHERE source = 'customer_filter_age'),
enrolled AS (SELECT mobile, CAST(NULL AS VARCHAR) AS category FROM outcomes
             WHERE source = 'customer_filter_success' AND update_day >= '2001-02-02'),
refused AS (SELECT mobile, CAST(NULL AS VARCHAR) AS category FROM outcomes o
            WHERE source = 'customer_filter_refuse' AND update_day >= '2001-05-03'
              AND NOT EXISTS (SELECT 1 FROM closed d WHERE d.mobile = o.mobile)),
childless AS (SELECT mobile, category FROM outcomes o
              WHERE source = 'customer_filter_child'
                AND NOT EXISTS (SELECT 1 FROM closed d WHERE d.mobile = o.mobile AND d.category = o.category)),
suppressed AS (SELECT * FROM wrong_age UNION ALL SELECT * FROM enrolled
               UNION ALL SELECT * FROM refused UNION ALL SELECT * FROM childless)"""

SQL["active_suppression"] = f"""WITH {SUPPRESSION_ALL}
SELECT mobile FROM suppressed WHERE category IS NULL OR category = 'P'"""

GOLDEN_PARTS = """golden AS (
  SELECT p_partkey AS mobile, p_type AS source_type,
         CASE WHEN p_partkey % 4 = 0 THEN '' ELSE CAST(p_size AS VARCHAR) END AS age,
         CASE WHEN p_partkey % 3 = 0 THEN NULL ELSE CAST(p_size % 18 AS VARCHAR) END AS child_age,
         CASE WHEN p_partkey % 5 = 0 THEN CAST(p_size % 15 AS VARCHAR) ELSE '' END AS child_deduced_age,
         CASE WHEN p_partkey % 2 = 0 THEN CAST(p_size - 2 AS VARCHAR) ELSE '' END AS age_start,
         CASE WHEN p_partkey % 2 = 0 THEN CAST(p_size + 2 AS VARCHAR) ELSE '' END AS age_end,
         CASE WHEN p_partkey % 7 = 0 THEN ' ' WHEN p_partkey % 11 = 0 THEN NULL ELSE p_brand END AS city_short
  FROM part)"""

RULES = """rules AS (
  SELECT * FROM (VALUES ('S%', '5', '8', '30', '33', 'seg', 't1'), ('P%', '1', '3', '', '', 'seg', 't1'),
                        ('E%', '', '', '', '', 'seg', 't2'), ('M%', '', '', '15', '18', 'seg', 't2'),
                        ('L%', '4', '', '', '', 'seg', 't3'), ('L%', 'x', ' 3 ', '', '', 'seg', 't4'),
                        ('%M_LL', '2', '9', '', '', 'seg2', 't1'), ('%O%', '', '', '20', '30', 'seg2', 't1'))
         AS r(source, minage, maxage, minparentage, maxparentage, targetdatabase, targettable))"""

TARGET_CATEGORIES = """target_categories AS (
  SELECT * FROM (VALUES ('t1', 'F'), ('t2', 'O'), ('t3', 'P'), ('t4', 'F')) AS t(targettable, category))"""


def _set(c: str) -> str:
    return f"({c} IS NOT NULL AND trim({c}) <> '' AND regexp_matches({c}, '^[0-9]+$'))"


def _bound(c: str) -> str:
    return f"CASE WHEN {_set(c)} THEN TRY_CAST({c} AS INTEGER) END"


def _bt(x: str, lo: str, hi: str) -> str:
    return f"{x} BETWEEN {lo} AND {hi}"


_AGE, _CH, _DE = "TRY_CAST(g.age AS INTEGER)", "TRY_CAST(g.child_age AS INTEGER)", \
    "TRY_CAST(g.child_deduced_age AS INTEGER)"
_ST, _EN = "TRY_CAST(g.age_start AS INTEGER)", "TRY_CAST(g.age_end AS INTEGER)"
_BOTH = " OR ".join([_bt(_CH, "r.mn", "r.mx"), _bt(_DE, "r.mn", "r.mx"),
                     _bt(_AGE, "r.pmn", "r.pmx"), _bt(_CH, "r.pmn", "r.pmx"), _bt(_DE, "r.pmn", "r.pmx"),
                     _bt("r.mn", _ST, _EN), _bt("r.mx", _ST, _EN),
                     _bt("r.pmn", _ST, _EN), _bt("r.pmx", _ST, _EN)])
_PARENTS = " OR ".join([_bt(_AGE, "r.pmn", "r.pmx"), _bt(_CH, "r.pmn", "r.pmx"), _bt(_DE, "r.pmn", "r.pmx"),
                        _bt("r.pmn", _ST, _EN), _bt("r.pmx", _ST, _EN)])
_KIDS = " OR ".join([_bt(_AGE, "r.mn", "r.mx"), _bt(_CH, "r.mn", "r.mx"), _bt(_DE, "r.mn", "r.mx"),
                     _bt("r.mn", _ST, _EN), _bt("r.mx", _ST, _EN)])

SEGMENTS = f"""{GOLDEN_PARTS}, {RULES},
r AS (SELECT targetdatabase, targettable, source,
             ({_set('minage')} OR {_set('maxage')}) AS kids,
             ({_set('minparentage')} OR {_set('maxparentage')}) AS parents,
             {_bound('minage')} AS mn, {_bound('maxage')} AS mx,
             {_bound('minparentage')} AS pmn, {_bound('maxparentage')} AS pmx
      FROM rules),
segs AS (
  SELECT DISTINCT r.targetdatabase, r.targettable, g.*
  FROM golden g JOIN r
    ON g.source_type LIKE r.source
   AND CASE WHEN r.parents AND r.kids THEN ({_BOTH})
            WHEN r.parents THEN ({_PARENTS})
            WHEN r.kids THEN ({_KIDS})
            ELSE TRUE END)"""

SQL["segment_rules"] = f"WITH {SEGMENTS}\nSELECT * FROM segs"
SQL["segment_rules_join"] = SQL["segment_rules"]

SUPPRESSED = f"""{SEGMENTS}, {TARGET_CATEGORIES}, {SUPPRESSION_ALL},
kept AS (
  SELECT s.* FROM segs s LEFT JOIN target_categories tc ON s.targettable = tc.targettable
  WHERE NOT EXISTS (SELECT 1 FROM suppressed x
                    WHERE x.mobile = s.mobile AND (x.category IS NULL OR x.category = tc.category)))"""

SQL["suppress_segment"] = f"WITH {SUPPRESSED}\nSELECT * FROM kept"

SQL["publish_segments"] = f"""WITH {SUPPRESSED},
dim AS (SELECT CAST(n_nationkey AS VARCHAR) AS tel, max(n_name) AS city FROM nation GROUP BY 1)
SELECT k.targetdatabase, k.targettable, k.mobile, k.source_type, k.age, k.child_age, k.child_deduced_age,
       k.age_start, k.age_end,
       CASE WHEN k.city_short IS NULL OR trim(k.city_short) = '' THEN d.city ELSE k.city_short END AS city_short
FROM kept k LEFT JOIN dim d ON substr(CAST(k.mobile AS VARCHAR), 1, 2) = d.tel
WHERE NOT ((CASE WHEN k.city_short IS NULL OR trim(k.city_short) = '' THEN d.city ELSE k.city_short END) IS NULL
           OR trim(CASE WHEN k.city_short IS NULL OR trim(k.city_short) = '' THEN d.city ELSE k.city_short END) = '')"""

SQL["prefix_fill"] = f"""WITH {CUSTOMERS},
dim AS (SELECT 'Customer#0000' || lpad(CAST(n_nationkey AS VARCHAR), 2, '0') AS tel, max(n_name) AS city
        FROM nation GROUP BY 1)
SELECT c.mobile, c.user_name,
       CASE WHEN c.city_short IS NULL OR trim(c.city_short) = '' THEN d.city ELSE c.city_short END AS city_short
FROM customers c LEFT JOIN dim d ON substr(c.user_name, 1, 15) = d.tel"""

SQL["targets"] = """SELECT DISTINCT p_brand AS targetdatabase, p_type AS targettable FROM part
WHERE regexp_matches(p_type, 'A|P') AND p_type NOT IN ('LARGE')"""

META = """tables AS (
  SELECT 'dw_cust' AS databasename, 'cust_' || CAST(c_custkey AS VARCHAR) AS tablename,
         c_name AS tbcomment, 'parquet' AS storage, 'dw_cust' AS databasepath,
         'cust_' || CAST(c_custkey AS VARCHAR) AS dbtablepath,
         'dw_cust.cust_' || CAST(c_custkey AS VARCHAR) AS dbtable
  FROM customer),
cols AS (
  SELECT 'dw_cust.cust_' || CAST(o_custkey AS VARCHAR) AS dbtable,
         CASE o_orderkey % 7 WHEN 0 THEN 'mobile' WHEN 1 THEN 'source' WHEN 2 THEN 'source_type'
              ELSE 'o_' || CAST(o_orderkey AS VARCHAR) END AS dswhcolname,
         'o_' || CAST(o_orderkey AS VARCHAR) AS buiscolname, 'string' AS buiscoltype,
         o_orderpriority AS buiscolcomment, CAST(o_orderkey AS VARCHAR) AS buiscolrank
  FROM orders)"""

SQL["table_catalog"] = f"""WITH {META}
SELECT t.*, c.dswhcolname, c.buiscolname, c.buiscoltype, c.buiscolcomment, c.buiscolrank
FROM tables t JOIN cols c ON t.dbtable = c.dbtable"""

SQL["render_ddl"] = f"""WITH {META},
ddl_cols AS (
  SELECT dbtable,
         string_agg(buiscolname || ' ' || buiscoltype || ' COMMENT ''' || buiscolcomment || '''',
                    ',' || chr(10) ORDER BY CAST(buiscolrank AS INTEGER)) AS cols
  FROM cols GROUP BY dbtable)
SELECT t.dbtable,
       'CREATE EXTERNAL TABLE IF NOT EXISTS ' || t.databasename || '.' || t.tablename || '(' || chr(10)
       || d.cols || chr(10) || ')COMMENT ''' || t.tbcomment || '''' || chr(10)
       || 'STORED AS ' || t.storage || chr(10)
       || 'LOCATION ''/warehouse/' || t.databasepath || '/' || t.dbtablepath || '''' AS ddl
FROM tables t JOIN ddl_cols d ON t.dbtable = d.dbtable"""

SQL["seed_columns"] = f"""WITH {META}
SELECT t.dbtable, c.dswhcolname, c.buiscolname, c.buiscoltype, c.buiscolcomment, c.buiscolrank
FROM tables t CROSS JOIN (SELECT * FROM cols WHERE dbtable = 'dw_cust.cust_0') c
WHERE t.tablename <> 'cust_1'"""

SQL["seed_columns_written"] = SQL["seed_columns"]

SQL["ingest_report"] = f"""WITH {CONTACTS}
SELECT '20240115' AS day, source_type, count(*) AS counts, count(DISTINCT contact_id) AS distinct_num,
       '[ingest notice]' || chr(10) || 'day: 20240115' || chr(10) || 'source: ' || source_type || chr(10)
       || 'rows: ' || CAST(count(*) AS VARCHAR) || chr(10)
       || 'distinct: ' || CAST(count(DISTINCT contact_id) AS VARCHAR) AS message
FROM contacts WHERE update_day = '2024-01-15' GROUP BY source_type"""

SQL["range_text"] = """WITH p AS (
  SELECT p_partkey, CAST(p_size AS VARCHAR) || '-' || CAST(p_size + 3 AS VARCHAR) || 'yrs' AS age_text FROM part)
SELECT p_partkey, age_text,
       CASE WHEN age_text <> '' THEN string_split(regexp_replace(age_text, '[^0-9]+', '-', 'g'), '-')[1] END AS age_start,
       CASE WHEN age_text <> '' THEN string_split(regexp_replace(age_text, '[^0-9]+', '-', 'g'), '-')[2] END AS age_end
FROM p"""

SQL["align_layout"] = """SELECT user_id AS mobile, '' AS user_name, event_type AS source_type,
       strftime(ts, '%Y-%m-%d') AS update_day FROM events
UNION ALL
SELECT c_custkey AS mobile, c_name AS user_name, 'customer' AS source_type, '2024-01-01' AS update_day
FROM customer"""

SQL["archive_cold"] = f"""WITH {CONTACTS}
SELECT contact_id AS mobile, '' AS user_name, '' AS age, '' AS age_start, '' AS age_end,
       source, source_type, update_day, update_time
FROM contacts WHERE source_type IN ('view', 'click') AND update_day < '2024-01-17'
UNION ALL
SELECT contact_id AS mobile, '' AS user_name, attr_b AS age,
       CASE WHEN attr_b <> '' THEN attr_b ELSE substr(update_day, 9, 2) END,
       CASE WHEN attr_b <> '' THEN CASE WHEN event_id % 2 <> 0 THEN CAST(contact_id AS VARCHAR) END ELSE '99' END,
       source, source_type, update_day, update_time
FROM contacts WHERE source_type IN ('signup', 'error', 'purchase') AND update_day < '2024-01-17'"""

SQL["overwrite_full"] = f"""WITH {CONTACTS}
SELECT * FROM contacts WHERE source_type = 'click'"""

SQL["overwrite_partitions"] = f"""WITH {CONTACTS},
halves AS (
  SELECT * REPLACE (CASE WHEN substr(update_time, 1, 2) < '12' THEN '00_00_00' ELSE '12_00_00' END AS update_time)
  FROM contacts),
newer AS (SELECT * FROM halves WHERE source_type IN ('click', 'view') AND update_day >= '2024-01-20'
          AND NOT (attr_a IS NULL OR trim(attr_a) = ''))
SELECT * FROM newer
UNION ALL
SELECT * FROM halves h
WHERE NOT EXISTS (SELECT 1 FROM newer n WHERE n.source_type = h.source_type AND n.update_day = h.update_day
                  AND n.update_time = h.update_time)"""

SQL["manifest_written"] = f"""WITH {CONTACTS}
SELECT DISTINCT 'ALTER TABLE dw.contacts ADD IF NOT EXISTS PARTITION (source_type=''' || source_type || ''');' AS partition
FROM contacts"""

SQL["stage_round_trip"] = SQL["golden_record"]

SQL["outcome_feed"] = f"""WITH {OUTCOMES}
SELECT mobile, '' AS user_name, category, project, title,
       CASE WHEN trim(title) = '1-URGENT' THEN 'customer_filter_child'
            WHEN trim(title) = '2-HIGH' THEN 'customer_filter_success'
            WHEN trim(title) = '4-NOT SPECIFIED' THEN 'customer_filter_age'
            WHEN trim(title) = '5-LOW' THEN 'customer_filter_refuse' END AS source,
       'OPERATOR_customer' AS source_type, update_day, '20_00_00' AS update_time
FROM outcomes
WHERE update_day BETWEEN '1998-10-01' AND '1998-10-07' AND title IN ('1-URGENT', '2-HIGH')"""

SQL["column_map"] = f"""WITH {META}
SELECT dswhcolname, CASE WHEN CAST(buiscolrank AS INTEGER) % 7 = 3 THEN 'mobile' ELSE buiscolname END AS buiscolname,
       buiscolrank
FROM cols
WHERE dbtable = 'dw_cust.cust_1' AND dswhcolname NOT IN ('mobile', 'source', 'source_type')"""

SQL["golden_mapped"] = ("SELECT contact_id, attr_a AS first_attr, attr_b AS second_attr, source, source_type FROM ("
                        + SQL["golden_record"] + ")")

SQL["latest_dedup_mapped"] = ("SELECT contact_id, source_type, attr_a, attr_b, update_day FROM ("
                              + SQL["latest_dedup"] + ")")

SQL["created_tables"] = """
SELECT 'nation_' || CAST(c_nationkey AS VARCHAR) AS tablename,
       CAST(row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) AS INTEGER) AS place,
       'c_' || CAST(c_custkey AS VARCHAR) AS name,
       CASE c_custkey % 3 WHEN 0 THEN 'int' WHEN 1 THEN 'string' ELSE 'double' END AS type,
       coalesce(c_mktsegment, '') AS comment
FROM customer WHERE c_nationkey IN (SELECT n_nationkey FROM nation)"""

# ---------------------------------------------------------------- time and ranges

SQL["status_at_call"] = f"""WITH {CALLS}, {HISTORY},
states AS (
  SELECT mobile, CAST(update_day AS DATE) AS from_day, update_day AS since, source, source_type FROM history
  QUALIFY row_number() OVER (PARTITION BY mobile, update_day ORDER BY source DESC, source_type DESC) = 1),
timed AS (SELECT *, CAST(update_day AS DATE) AS call_day FROM calls)
SELECT t.mobile, t.category, t.project, t.order_key, t.duration_time, t.update_day, s.since, s.source, s.source_type
FROM timed t ASOF LEFT JOIN states s ON t.mobile = s.mobile AND t.call_day >= s.from_day"""

_GAPS = """gaps AS (
  SELECT user_id AS contact_id, event_type AS source_type, ts AS contact_time,
         (epoch_us(ts) - epoch_us(lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id))) / 1000000.0 AS gap_seconds, event_id
  FROM events),
numbered AS (
  SELECT contact_id, source_type, contact_time, gap_seconds,
         sum(CASE WHEN gap_seconds <= 43200 THEN 0 ELSE 1 END)
           OVER (PARTITION BY contact_id ORDER BY contact_time, event_id) AS session
  FROM gaps)"""

SQL["contact_gaps"] = f"""WITH {_GAPS}
SELECT contact_id, source_type, contact_time, CAST(gap_seconds AS DOUBLE) AS gap_seconds, CAST(session AS BIGINT) AS session
FROM numbered"""

SQL["contact_sessions"] = f"""WITH {_GAPS}
SELECT contact_id, CAST(session AS BIGINT) AS session, min(contact_time) AS first_time, max(contact_time) AS last_time,
       count(*) AS n_rows, CAST(max(CASE WHEN gap_seconds <= 43200 THEN gap_seconds END) AS DOUBLE) AS longest_gap
FROM numbered GROUP BY contact_id, session"""

SQL["calls_in_last_days"] = f"""WITH {CALLS},
dated AS (SELECT *, CAST(update_day AS DATE) AS call_day, TRY_CAST(duration_time AS BIGINT) AS s FROM calls)
SELECT mobile, category, project, order_key, duration_time, update_day,
       count(*) OVER a AS n_14, CAST(sum(s) OVER a AS BIGINT) AS seconds_14,
       count(*) OVER b AS n_60, CAST(sum(s) OVER b AS BIGINT) AS seconds_60
FROM dated
WINDOW a AS (PARTITION BY mobile ORDER BY call_day RANGE BETWEEN INTERVAL 14 DAY PRECEDING AND CURRENT ROW),
       b AS (PARTITION BY mobile ORDER BY call_day RANGE BETWEEN INTERVAL 60 DAY PRECEDING AND CURRENT ROW)"""

SQL["overlapping_ranges"] = f"""WITH {GOLDEN_PARTS},
ranges AS (SELECT mobile, source_type, TRY_CAST(age_start AS INTEGER) AS age_from, TRY_CAST(age_end AS INTEGER) AS age_to
           FROM golden),
rules AS (SELECT s_suppkey AS rule_id, CASE WHEN s_suppkey % 10 <> 0 THEN CAST(s_suppkey % 50 AS INTEGER) END AS rule_from,
                 CASE WHEN s_suppkey % 15 <> 0
                      THEN CAST(s_suppkey % 50 + CASE WHEN s_suppkey % 7 = 0 THEN 30 ELSE s_suppkey % 5 - 1 END AS INTEGER) END
                   AS rule_to
          FROM supplier)
SELECT * FROM ranges JOIN rules
  ON (rule_from IS NULL OR rule_from <= age_to) AND (rule_to IS NULL OR rule_to >= age_from)
 AND (rule_from IS NULL OR rule_to IS NULL OR rule_from <= rule_to)
WHERE age_from IS NOT NULL AND age_to IS NOT NULL"""

# ---------------------------------------------------------------- distinct keys

_DISTINCT = f"""WITH {CONTACTS},
spans AS (SELECT * FROM (VALUES ('2024-01-01', '2024-01-30'), ('2024-01-08', '2024-01-21'), ('2024-01-15', '2024-01-15'))
          AS t(since, until)),
exact AS (SELECT source_type, since, until, count(DISTINCT contact_id) AS n_keys
          FROM contacts JOIN spans ON update_day BETWEEN since AND until GROUP BY source_type, since, until)"""

SQL["distinct_by_bitmaps"] = f"""{_DISTINCT} SELECT * FROM exact"""

SQL["distinct_by_sketches"] = f"""{_DISTINCT} SELECT *, true AS within_5_percent FROM exact"""

SQL["ingest_summary"] = f"""WITH {CONTACTS},
c AS (SELECT * REPLACE (CASE WHEN source_type <> 'error' THEN source_type END AS source_type) FROM contacts)
SELECT CASE grouping(update_day) * 2 + grouping(source_type) WHEN 0 THEN 'day_source' WHEN 1 THEN 'day'
       WHEN 2 THEN 'source' ELSE 'total' END AS level,
       update_day, source_type, count(*) AS counts, count(DISTINCT contact_id) AS distinct_num
FROM c GROUP BY GROUPING SETS ((update_day, source_type), (update_day), (source_type), ())"""

# ---------------------------------------------------------------- changes, maps, state

_TWO_GOLDEN = f"""WITH {CONTACTS},
older AS (SELECT contact_id, source_type, attr_b FROM contacts WHERE update_day < '2024-01-20'),
newer AS (SELECT contact_id, source_type, attr_b FROM contacts WHERE update_day >= '2024-01-05')"""

SQL["golden_changes"] = f"""{_TWO_GOLDEN}
SELECT *, 'add' AS op, count(*) AS copies FROM (SELECT * FROM newer EXCEPT ALL SELECT * FROM older) GROUP BY ALL
UNION ALL
SELECT *, 'drop' AS op, count(*) AS copies FROM (SELECT * FROM older EXCEPT ALL SELECT * FROM newer) GROUP BY ALL"""

SQL["golden_common"] = f"""{_TWO_GOLDEN}
SELECT *, count(*) AS copies FROM (SELECT * FROM newer INTERSECT ALL SELECT * FROM older) GROUP BY ALL"""

SQL["merged_attributes"] = f"""WITH {CONTACTS},
entries AS (SELECT contact_id, update_day, update_time, event_id, 'attr_a' AS name, attr_a AS value FROM contacts
            UNION ALL SELECT contact_id, update_day, update_time, event_id, 'attr_b', attr_b FROM contacts
            UNION ALL SELECT contact_id, update_day, update_time, event_id, 'name_' || CAST(event_id % 200 AS VARCHAR), source_type
            FROM contacts)
SELECT contact_id, name, value FROM entries
QUALIFY row_number() OVER (PARTITION BY contact_id, name
                           ORDER BY CASE WHEN {_blank('value')} THEN 0 ELSE 1 END DESC, update_day DESC, update_time DESC,
                                    event_id DESC) = 1"""

SQL["streamed_latest"] = SQL["latest_dedup"]
