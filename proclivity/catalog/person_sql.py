"""The person table in plain SQL, as a CTE prefix for the SQL counterparts."""

PERSONS = """
past AS (
  SELECT o_orderkey, o_custkey, o_orderstatus,
         CAST(o_totalprice AS DECIMAL(18,2)) AS amt,
         (2001 - year(o_orderdate)) * 12 + 6 - month(o_orderdate) AS ago,
         o_orderpriority IN ('1-URGENT', '2-HIGH') AS card,
         CAST(year(o_orderdate) * 10000 + month(o_orderdate) * 100 + day(o_orderdate) AS BIGINT)
           * 1000000000 + o_orderkey AS seq
  FROM orders WHERE o_orderdate < TIMESTAMP '2001-06-01'
),
gift AS (
  SELECT o_custkey AS gk, count(*) AS n, count(*) FILTER (card) AS n_card,
         count(*) FILTER (ago <= 36) AS n_rec, count(*) FILTER (ago <= 36 AND card) AS n_rec_card,
         CAST(sum(amt) AS DOUBLE) AS amount,
         CAST(sum(amt) FILTER (ago <= 36) AS DOUBLE) AS rec_amount,
         CAST(sum(amt) FILTER (ago <= 36 AND card) AS DOUBLE) AS rec_card_amount,
         CAST(max(amt) AS DOUBLE) AS max_amt, CAST(min(amt) AS DOUBLE) AS min_amt,
         max(ago) AS first_ago, min(ago) AS last_ago,
         CAST(arg_max(amt, seq) AS DOUBLE) AS last_amt, arg_max(o_orderstatus, seq) AS last_status
  FROM past GROUP BY o_custkey
),
promo AS (
  SELECT o_custkey AS pk, count(*) AS n_line, count(*) FILTER (l_returnflag = 'R') AS n_ret,
         count(*) FILTER (l_shipdate >= TIMESTAMP '2000-06-01') AS n_year,
         count(*) FILTER (l_shipdate >= TIMESTAMP '2000-06-01' AND l_returnflag = 'R') AS n_year_ret
  FROM lineitem JOIN past ON l_orderkey = o_orderkey GROUP BY o_custkey
),
later AS (SELECT DISTINCT o_custkey AS lk FROM orders WHERE o_orderdate >= TIMESTAMP '2001-06-01'),
base AS (
  SELECT c_custkey AS c, * FROM customer
  LEFT JOIN gift ON gk = c_custkey LEFT JOIN promo ON pk = c_custkey
  LEFT JOIN later ON lk = c_custkey
),
persons AS MATERIALIZED (
  SELECT c AS CONTROL_NUMBER,
    CASE WHEN lk IS NULL THEN 0 ELSE 1 END AS TARGET_B,
    CASE WHEN c % 3 = 0 THEN 'U' ELSE 'H' END AS HOME_OWNER,
    CASE WHEN c % 17 = 0 THEN NULL WHEN c % 13 = 0 THEN '?' ELSE substr(c_mktsegment, 1, 1) END
      AS URBANICITY,
    CASE WHEN c % 19 = 0 THEN '?' ELSE CAST(1 + c_nationkey % 4 AS VARCHAR) END AS SES,
    CASE WHEN c % 23 = 0 THEN NULL WHEN c % 2 = 0 THEN 'F' ELSE 'M' END AS DONOR_GENDER,
    last_status AS RECENCY_STATUS_96NK,
    CASE WHEN c % 4 = 0 THEN NULL ELSE CAST((c * 7) % 110 AS DOUBLE) END AS DONOR_AGE,
    CASE WHEN c % 29 = 0 THEN CAST(-1 AS DOUBLE) WHEN c % 7 = 0 THEN NULL
         ELSE CAST(c % 4 AS DOUBLE) END AS CHILDREN,
    CASE WHEN c % 5 = 0 THEN NULL ELSE CAST(1 + c_nationkey % 7 AS DOUBLE) END AS INCOME_GROUP,
    CASE WHEN amount < 2000000 OR c % 6 = 0 THEN NULL ELSE CAST(c % 10 AS DOUBLE) END
      AS WEALTH_RATING,
    CASE WHEN c % 31 = 0 THEN NULL ELSE CAST(last_ago AS DOUBLE) END AS MONTHS_SINCE_LAST_PROM_RESP,
    c_acctbal AS MEDIAN_HOUSEHOLD_INCOME,
    c_acctbal * CAST(0.5 AS DOUBLE) AS PER_CAPITA_INCOME,
    CAST((c * 7919) % 6000 AS DOUBLE) AS MEDIAN_HOME_VALUE,
    CAST((c * 31) % 101 AS DOUBLE) AS PCT_ATTRIBUTE1,
    CAST((c * 37) % 101 AS DOUBLE) AS PCT_ATTRIBUTE2,
    CAST((c * 41) % 101 AS DOUBLE) AS PCT_ATTRIBUTE3,
    CAST((c * 43) % 101 AS DOUBLE) AS PCT_ATTRIBUTE4,
    CAST((c * 47) % 101 AS DOUBLE) AS PCT_OWNER_OCCUPIED,
    CAST(c % 2 AS DOUBLE) AS PEP_STAR,
    CASE WHEN c % 10 = 0 THEN CAST(1 + c % 7 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END
      AS RECENT_STAR_STATUS,
    least(CAST(4 AS DOUBLE), greatest(CAST(1 AS DOUBLE), CAST(n_rec AS DOUBLE)))
      AS FREQUENCY_STATUS_97NK,
    CAST(n_year AS DOUBLE) AS NUMBER_PROM_12, CAST(n_year_ret AS DOUBLE) AS CARD_PROM_12,
    CAST(n_line AS DOUBLE) AS LIFETIME_PROM, CAST(n_ret AS DOUBLE) AS LIFETIME_CARD_PROM,
    CAST(n_card AS DOUBLE) AS FILE_CARD_GIFT,
    amount AS LIFETIME_GIFT_AMOUNT, CAST(n AS DOUBLE) AS LIFETIME_GIFT_COUNT,
    max_amt AS LIFETIME_MAX_GIFT_AMT, min_amt AS LIFETIME_MIN_GIFT_AMT,
    last_amt AS LAST_GIFT_AMT,
    CAST(first_ago AS DOUBLE) AS MONTHS_SINCE_FIRST_GIFT,
    CAST(last_ago AS DOUBLE) AS MONTHS_SINCE_LAST_GIFT,
    rec_amount / CAST(nullif(n_rec, 0) AS DOUBLE) AS RECENT_AVG_GIFT_AMT,
    CASE WHEN c % 37 = 0 THEN CAST(-5 AS DOUBLE)
         ELSE rec_card_amount / CAST(nullif(n_rec_card, 0) AS DOUBLE) END
      AS RECENT_AVG_CARD_GIFT_AMT,
    CAST(n_rec AS DOUBLE) AS RECENT_RESPONSE_COUNT,
    CAST(n_rec_card AS DOUBLE) AS RECENT_CARD_RESPONSE_COUNT,
    CASE WHEN c % 41 = 0 THEN CAST(1.5 AS DOUBLE)
         ELSE CAST(n_rec AS DOUBLE) / CAST(nullif(n, 0) AS DOUBLE) END AS RECENT_RESPONSE_PROP,
    CAST(n_rec_card AS DOUBLE) / CAST(nullif(n, 0) AS DOUBLE) AS RECENT_CARD_RESPONSE_PROP
  FROM base
)"""

SCORES = """
scores AS (
  SELECT CONTROL_NUMBER, TARGET_B,
         round(CAST((CONTROL_NUMBER * 37) % 101 AS DOUBLE) / 101, 4) AS score
  FROM persons
)"""


def with_persons(body: str, *ctes: str) -> str:
    """``body`` under the person CTE and any further CTE texts."""
    return "WITH " + ",\n".join([PERSONS, *ctes]) + "\n" + body


def with_scores(body: str, *ctes: str) -> str:
    """``body`` under the person and score CTEs and any further CTE texts."""
    return with_persons(body, SCORES, *ctes)
