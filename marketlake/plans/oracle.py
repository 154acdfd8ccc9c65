"""Shared SQL fragments for the DuckDB twins of the registered queries.

Each twin is independent SQL over the driver views (region nation customer
supplier part orders lineitem events documents embeddings pages benchmark
labels conversations).  Shared stand-ins are written once as CTE text.
"""

from __future__ import annotations

INDEX_LINES = """
index_lines AS (
  SELECT o.o_orderkey,
    CASE
      WHEN o.o_orderpriority = '1-URGENT' THEN concat_ws('|', CAST(o.o_custkey AS VARCHAR), c.c_name,
           o.o_orderstatus, strftime(o.o_orderdate, '%Y%m%d'),
           'edgar/data/' || CAST(o.o_custkey AS VARCHAR) || '/' || lpad(CAST(o.o_orderkey AS VARCHAR), 10, '0') || '.txt')
      WHEN o.o_orderpriority = '2-HIGH' THEN concat_ws('|', CAST(o.o_custkey AS VARCHAR), c.c_name,
           o.o_orderstatus, strftime(o.o_orderdate, '%Y-%m-%d'),
           'edgar/data/' || CAST(o.o_custkey AS VARCHAR) || '/' || lpad(CAST(o.o_orderkey AS VARCHAR), 10, '0') || '.txt')
      WHEN o.o_orderpriority = '3-MEDIUM' THEN
        CASE WHEN o.o_orderstatus = 'F' THEN 'CIK|Company Name|Form Type|Date Filed|Filename'
             WHEN o.o_orderstatus = 'O' THEN '--------------------------------------------------'
             ELSE concat_ws('|', CAST(o.o_custkey AS VARCHAR), c.c_name, o.o_orderstatus,
                  strftime(o.o_orderdate, '%Y-%m-%d'),
                  'edgar/data/' || CAST(o.o_custkey AS VARCHAR) || '/' || lpad(CAST(o.o_orderkey AS VARCHAR), 10, '0') || '.txt',
                  'extra') END
      WHEN o.o_orderpriority = '4-NOT SPECIFIED' THEN
        CASE WHEN o.o_orderstatus = 'F' THEN concat_ws('|', CAST(o.o_custkey AS VARCHAR), c.c_name,
                  o.o_orderstatus, 'invalid-date',
                  'edgar/data/' || CAST(o.o_custkey AS VARCHAR) || '/' || lpad(CAST(o.o_orderkey AS VARCHAR), 10, '0') || '.txt')
             WHEN o.o_orderstatus = 'O' THEN concat_ws('|', CAST(o.o_custkey AS VARCHAR), c.c_name,
                  o.o_orderstatus, CAST(year(o.o_orderdate) AS VARCHAR) || '-13-45',
                  'edgar/data/' || CAST(o.o_custkey AS VARCHAR) || '/' || lpad(CAST(o.o_orderkey AS VARCHAR), 10, '0') || '.txt')
             ELSE concat_ws('|', CAST(o.o_custkey AS VARCHAR), c.c_name, o.o_orderstatus,
                  strftime(o.o_orderdate, '%Y-%m-%d'), 'other/' || CAST(o.o_custkey AS VARCHAR) || '.txt') END
      ELSE concat_ws('|', ' 000' || CAST(o.o_custkey AS VARCHAR) || ' ', ' ' || c.c_name || '  ',
           o.o_orderstatus, ' ' || strftime(o.o_orderdate, '%Y%m%d'),
           'edgar/data/' || CAST(o.o_custkey AS VARCHAR) || '/' || lpad(CAST(o.o_orderkey AS VARCHAR), 10, '0') || '.txt')
    END AS value
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
)"""

# parsed index; columns cik company_name form_type filing_date filename accession_number
INDEX_PARSED = INDEX_LINES + """,
index_split AS (
  SELECT o_orderkey, trim(value) AS line, string_split(trim(value), '|') AS p FROM index_lines
),
index_fields AS (
  SELECT o_orderkey, line, p, trim(p[1]) AS cik_raw, trim(p[5]) AS filename, trim(p[4]) AS d
  FROM index_split
  WHERE line <> '' AND NOT starts_with(line, '---')
    AND upper(line) <> 'CIK|COMPANY NAME|FORM TYPE|DATE FILED|FILENAME'
    AND len(p) = 5
),
index_parsed AS (
  SELECT o_orderkey,
    CASE WHEN length(CASE WHEN ltrim(cik_raw, '0') = '' THEN '0' ELSE ltrim(cik_raw, '0') END) >= 10
         THEN CASE WHEN ltrim(cik_raw, '0') = '' THEN '0' ELSE ltrim(cik_raw, '0') END
         ELSE lpad(CASE WHEN ltrim(cik_raw, '0') = '' THEN '0' ELSE ltrim(cik_raw, '0') END, 10, '0') END AS cik,
    trim(p[2]) AS company_name,
    trim(p[3]) AS form_type,
    CAST(CASE WHEN regexp_matches(d, '^[0-9]{8}$') THEN try_strptime(d, '%Y%m%d')
              WHEN length(d) = 10 AND substr(d, 5, 1) = '-' AND substr(d, 8, 1) = '-'
              THEN try_strptime(d, '%Y-%m-%d') END AS DATE) AS filing_date,
    filename,
    CASE WHEN len(string_split(filename, '/')) >= 4
         THEN nullif(regexp_replace(string_split(filename, '/')[-1], '\\.txt$', ''), '') END AS accession_number
  FROM index_fields
  WHERE regexp_matches(cik_raw, '^[0-9]+$') AND starts_with(filename, 'edgar/data/')
),
filings AS (
  SELECT *, CAST(year(filing_date) AS INTEGER) AS year, 'QTR' || CAST(quarter(filing_date) AS VARCHAR) AS quarter
  FROM index_parsed WHERE filing_date IS NOT NULL AND accession_number IS NOT NULL
)"""

CATEGORY_TREE = """
categories AS (
  SELECT CAST(0 AS BIGINT) AS category_id, 'World' AS name, CAST(0 AS BIGINT) AS parent_id
  UNION ALL SELECT CAST(r_regionkey + 1 AS BIGINT), r_name, CAST(0 AS BIGINT) FROM region
  UNION ALL SELECT CAST(n_nationkey + 100 AS BIGINT), n_name, CAST(n_regionkey + 1 AS BIGINT) FROM nation
  UNION ALL SELECT CAST(s_suppkey + 1000 AS BIGINT), s_name, CAST(s_nationkey + 100 AS BIGINT) FROM supplier
)"""

