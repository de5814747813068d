"""DuckDB SQL for every registered query (the correctness oracle).

Written independently of the DataFrame code: plain SQL over the base tables,
with the two fixture relations as CTEs (FIXTURES.md text).  Accounts, account
sets, dates, bounds, crosswalk and years stand here as literals of their own;
nothing is imported from the job.  Money is summed as DECIMAL and cast to
DOUBLE only in the final projection, as on the Spark side.
"""

from __future__ import annotations

from types import SimpleNamespace

# --- fixed values -----------------------------------------------------------
ACCOUNTS = (
    "400001", "400002", "400003", "400004", "400005", "400006", "400007", "400009", "400090", "400097", "400098",
    "400099", "401001", "401002", "401003", "401004", "410001", "411001", "430001", "430002", "430003", "430006",
    "430009", "430011", "502001", "502006", "503001", "510002", "510003", "510004", "510005", "510006",
)
COMPOSITES = (
    ("total_gci", ("400001", "400002", "400003", "400004", "400005", "400006", "400007", "400009", "400090", "400097",
                   "400098", "400099", "401001", "401002", "401003", "401004", "410001", "411001")),
    ("total_referral", ("510002", "510004", "510005")),
    ("commission_expense", ("502001", "510003", "510006")),
    ("aep", ("502006",)),
)
COHORTS = (
    ("Total Principal Cohorts", None),
    ("2018 and Prior", "original_start_date < DATE '2019-01-01'"),
    ("Jan 2019 to Aug 2019", "original_start_date > DATE '2019-01-01' AND original_start_date < DATE '2019-09-01'"),
    ("Sept 2019 to Aug 2020", "original_start_date > DATE '2019-09-01' AND original_start_date < DATE '2020-09-01'"),
)
NULL_LABEL = "tmp"
CROSSWALK = (("ASIA", "MKT_0"), ("ASIA", "MKT_1"), ("EUROPE", "MKT_2"), ("AFRICA", "MKT_0"), ("MIDDLE EAST", "MKT_1"),
             ("AMERICA", "MKT_0"), ("NATION_1", "MKT_1"))
# ---------------------------------------------------------------------------

# The two windows; a begin after 2020-08-31 moves the side extracts' begin to
# 2018-01-01.  Years: all that the rows can have, and the compared pair.
MAIN = SimpleNamespace(begin="2019-01-01", end="2020-12-31", side_begin="2019-01-01", years=(2019, 2020), pair=(2019, 2020),
                       split="AMERICA", excluded=("PARENT_2",), crosswalk=CROSSWALK)
LATE = SimpleNamespace(begin="2020-09-01", end="2020-12-31", side_begin="2018-01-01", years=(2018, 2019, 2020), pair=(2019, 2020),
                       split="AMERICA", excluded=("PARENT_2",), crosswalk=CROSSWALK)


def account_column(account: str) -> str:
    return "acct_" + account


LEDGER_LINES_SQL = """
SELECT
  CASE WHEN o.o_orderkey % 11 = 0 THEN NULL ELSE o.o_orderkey END AS deal_id,
  CASE WHEN o.o_orderkey % 22 = 0 THEN NULL ELSE o.o_orderkey END AS deal_line_id,
  CASE WHEN o.o_custkey % 13 = 0 THEN NULL WHEN o.o_custkey % 8 = 5 THEN CONCAT('T', CAST(o.o_custkey % 3 AS STRING)) ELSE CONCAT('T', CAST(CAST(FLOOR(o.o_custkey / 30) AS BIGINT) AS STRING)) END AS team_id,
  r.r_name AS market_region,
  CASE WHEN o.o_orderkey % 17 = 0 THEN NULL ELSE CONCAT(n.n_name, ', ', r.r_name) END AS location_name,
  CASE WHEN o.o_orderkey % 19 = 0 THEN NULL ELSE c.c_mktsegment END AS department_name,
  l.l_returnflag AS side_represented,
  CASE WHEN o.o_orderkey % 23 = 0 THEN NULL ELSE o.o_orderpriority END AS listing_type,
  CAST(o.o_orderdate + INTERVAL 20 YEAR AS DATE) AS close_date,
  LAST_DAY(CAST(o.o_orderdate + INTERVAL 20 YEAR AS DATE)) AS ending_period,
  CAST(o.o_totalprice AS DECIMAL(18,2)) AS final_close_price,
  CONCAT('V', CAST(o.o_custkey % 50 AS STRING)) AS vendor_agent_id,
  CONCAT('C', CAST(o.o_custkey % 7 AS STRING)) AS company_agent_id,
  a.account_number,
  CASE WHEN a.account_number = '502001' AND l.l_orderkey % 3 = 0 THEN 'AEP' ELSE 'STD' END AS item_type_name,
  CASE l.l_partkey % 12 WHEN 0 THEN '470' WHEN 1 THEN '469' WHEN 2 THEN '111' WHEN 3 THEN '86' WHEN 4 THEN '799' ELSE '1' END AS item_id,
  CASE WHEN l.l_partkey % 12 < 5 THEN 'flat fee' ELSE 'other' END AS item_name,
  CASE WHEN (l.l_orderkey + l.l_partkey) % 101 = 0 THEN NULL
       WHEN a.account_number >= '500000' OR a.account_number LIKE '4010%' THEN -CAST(l.l_extendedprice AS DECIMAL(18,2))
       ELSE CAST(l.l_extendedprice AS DECIMAL(18,2)) END AS amount
FROM lineitem l
JOIN orders o ON o.o_orderkey = l.l_orderkey
JOIN customer c ON c.c_custkey = o.o_custkey
JOIN nation n ON n.n_nationkey = c.c_nationkey
JOIN region r ON r.r_regionkey = n.n_regionkey
JOIN (VALUES (-1,'439901'),(0,'400001'),(1,'400002'),(2,'400003'),(3,'400004'),(4,'400005'),(5,'400006'),
             (6,'400007'),(7,'400009'),(8,'401001'),(9,'410001'),(10,'411001'),(11,'502001'),
             (12,'502006'),(13,'503001'),(14,'510002'),(15,'510003'),(16,'510004'),(17,'510005'),
             (18,'510006'),(19,'400090'),(20,'400097'),(21,'400098'),(22,'400099'),(23,'401002'),
             (24,'401003'),(25,'401004'),(26,'430001'),(27,'430002'),(28,'430003'),(29,'430006'),
             (30,'430009'),(31,'430011')) AS a(slot, account_number)
  ON a.slot = CASE WHEN l.l_partkey % 97 = 5 THEN -1 ELSE (l.l_partkey + l.l_linenumber) % 32 END
"""

PRINCIPAL_ROSTER_SQL = """
SELECT
  CONCAT('A', CAST(s.s_suppkey AS STRING)) AS agent_id,
  CASE WHEN s.s_suppkey % 31 = 30 THEN NULL ELSE CONCAT('T', CAST(CAST(FLOOR(s.s_suppkey / 2) AS BIGINT) AS STRING)) END AS team_id,
  s.s_name AS account_team_name,
  CASE WHEN s.s_suppkey % 9 = 8 THEN NULL ELSE CONCAT('PARENT_', CAST(s.s_suppkey % 9 AS STRING)) END AS parent_account_name,
  CONCAT('Agent ', s.s_name) AS agent_name,
  CASE WHEN s.s_suppkey % 6 = 5 THEN 'Agent' ELSE 'Principal' END AS agent_role,
  CASE WHEN s.s_suppkey % 7 = 6 THEN NULL ELSE CONCAT('Manager ', CAST(s.s_suppkey % 7 AS STRING)) END AS sales_manager_name,
  CASE WHEN s.s_suppkey % 10 = 7 THEN 'N' ELSE 'Y' END AS primary_principal_flag,
  CONCAT('MKT_', CAST(s.s_suppkey % 3 AS STRING)) AS market,
  CONCAT('SUB_', CAST(s.s_suppkey % 5 AS STRING)) AS sub_market,
  CONCAT('Office ', CAST(s.s_suppkey % 11 AS STRING)) AS office,
  CASE WHEN s.s_suppkey % 4 = 3 THEN 'Inactive' ELSE 'Active' END AS contact_status,
  CASE WHEN s.s_suppkey % 14 = 13 THEN NULL
       WHEN s.s_suppkey % 8 = 0 THEN DATE '2019-01-01'
       WHEN s.s_suppkey % 8 = 1 THEN DATE '2019-09-01'
       WHEN s.s_suppkey % 8 = 2 THEN DATE '2019-05-15'
       WHEN s.s_suppkey % 8 = 3 THEN DATE '2020-02-10'
       WHEN s.s_suppkey % 8 = 4 THEN DATE '2020-10-01'
       ELSE DATE '2017-03-01' END AS original_start_date,
  CAST(s.s_suppkey % 4 AS INTEGER) AS number_of_agents,
  DATE '2018-01-01' + CAST(s.s_suppkey % 365 AS INTEGER) AS contract_start_date,
  CASE WHEN s.s_suppkey % 3 = 2 THEN NULL ELSE DATE '2018-01-01' + CAST(s.s_suppkey % 365 + 730 AS INTEGER) END AS contract_end_date,
  DATE '2018-01-01' + CAST(s.s_suppkey % 365 + 900 AS INTEGER) AS ica_expiration_date,
  CASE WHEN s.s_suppkey % 5 = 0 THEN DATE '2021-01-31' ELSE NULL END AS separation_date,
  CASE WHEN s.s_suppkey % 5 = 0 THEN 'Y' ELSE 'N' END AS separated_flag,
  CAST(s.s_acctbal AS DECIMAL(18,2)) AS opportunity_gci,
  CASE WHEN s.s_suppkey % 8 = 7 THEN NULL ELSE CAST(s.s_suppkey % 100 AS DECIMAL(18,2)) END AS total_split,
  CAST(s.s_suppkey % 90 AS DECIMAL(18,2)) AS base_split,
  CASE WHEN s.s_suppkey % 2 = 0 THEN 'Flat' ELSE 'Percent' END AS resource_fee_type,
  CASE WHEN s.s_suppkey % 6 = 4 THEN NULL ELSE CONCAT('Option ', CAST(s.s_suppkey % 6 AS STRING)) END AS resource_fee_option,
  CAST(s.s_suppkey % 20 AS DECIMAL(18,2)) AS resource_fee_pct,
  CAST(s.s_acctbal AS DECIMAL(18,2)) AS resource_fee_cap,
  CASE WHEN s.s_suppkey % 12 = 11 THEN NULL ELSE CAST(s.s_suppkey % 500 AS DECIMAL(18,2)) END AS actual_resource_fee,
  CAST(s.s_suppkey % 400 AS DECIMAL(18,2)) AS policy_resource_fee,
  CONCAT('AMA', CAST(s.s_suppkey AS STRING)) AS ama_id,
  CONCAT('C', CAST(s.s_suppkey AS STRING)) AS contact_id,
  CONCAT('ACC', CAST(s.s_suppkey AS STRING)) AS account_id
FROM supplier s
"""

ACCTS = [account_column(a) for a in ACCOUNTS]
DL_LEADING = ["market_region", "side_represented", "deal_id", "listing_type", "location_name", "department_name",
              "team_id", "close_date", "ending_period", "final_close_price"]
DL_MEASURES = ["total_gci", "gci_less_referral", "commission_expense", "company_dollar", "aep",
               "company_dollar_plus_aep"]
DL_COLS = DL_LEADING + DL_MEASURES + ACCTS + ["vendor_agent_id", "company_agent_id"]
DL_MONEY = ["final_close_price"] + DL_MEASURES + ACCTS
AEP_KEYS = ["deal_id", "team_id", "ending_period", "market_region", "side_represented", "listing_type"]
FEE_NS = ["deal_id", "team_id", "ending_period", "market_region", "location_name", "side_represented", "listing_type"]
ROSTER_MONEY = ["opportunity_gci", "total_split", "base_split", "resource_fee_pct", "resource_fee_cap", "actual_resource_fee",
                "policy_resource_fee"]
ROSTER_COLS = ["agent_id", "team_id", "account_team_name", "parent_account_name", "agent_name", "agent_role",
               "sales_manager_name", "market", "sub_market", "office", "contact_status", "original_start_date",
               "number_of_agents", "contract_start_date", "contract_end_date", "ica_expiration_date", "separation_date",
               "separated_flag", "opportunity_gci", "total_split", "base_split", "resource_fee_type", "resource_fee_option",
               "resource_fee_pct", "resource_fee_cap", "actual_resource_fee", "policy_resource_fee", "ama_id", "contact_id",
               "account_id"]
SLIM_MONEY = ["total_split", "base_split", "resource_fee_pct", "resource_fee_cap", "actual_resource_fee", "policy_resource_fee"]
SLIM_COLS = ["roster_team_id", "account_team_name", "original_start_date", "market", "separation_date", "number_of_agents",
             "total_split", "base_split", "resource_fee_type", "resource_fee_option", "resource_fee_pct", "resource_fee_cap",
             "actual_resource_fee", "policy_resource_fee"]
SPLIT_COLS = ["agent_split", "company_split", "net_company_dollar", "aep_total", "ncd_and_aep_total", "ending_year"]
PY_KEYS = ["team_id", "account_team_name", "ending_year", "market_region", "location_name", "listing_type", "market",
           "original_start_date"]
PV_INDEX = ["team_id", "account_team_name", "market_region", "location_name", "listing_type", "market",
            "original_start_date"]
PIVOTED = ["deal_count", "ncd_margin", "gci_less_referral", "commission_expense", "net_company_dollar", "aep_total"]
MONEY_VALUES = ["gci_less_referral", "commission_expense", "net_company_dollar", "aep_total"]
GROUP = ["cohort", "market_region", "market", "location_name", "team_id", "account_team_name", "listing_type"]


def _d(day) -> str:
    return f"DATE '{day}'"


def _q(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _region(cfg: SimpleNamespace) -> str:
    return f"CASE WHEN market_region = {_q(cfg.split)} THEN split_part(location_name, ',', 1) ELSE market_region END"


DEAL_KEY = "CAST(CAST(COALESCE(deal_id, deal_line_id) AS BIGINT) AS VARCHAR)"


def _nse(a: str, b: str, cols) -> str:
    return " AND ".join(f"{a}.{c} IS NOT DISTINCT FROM {b}.{c}" for c in cols)


def _out(cols, money=(), casts=None) -> str:
    casts = casts or {}
    parts = []
    for c in cols:
        if c in casts:
            parts.append(f"CAST({c} AS {casts[c]}) AS {c}")
        elif c in money:
            parts.append(f"CAST({c} AS DOUBLE) AS {c}")
        else:
            parts.append(c)
    return ", ".join(parts)


def _ratio(n: str, d: str) -> str:
    return f"CAST({n} AS DOUBLE) / NULLIF(CAST({d} AS DOUBLE), 0)"


def ctes(cfg: SimpleNamespace) -> str:
    years, pair = cfg.years, cfg.pair
    comp = ",\n    ".join(
        f"SUM(CASE WHEN account_number IN ({', '.join(_q(a) for a in accts)}) THEN amount ELSE 0 END) AS {name}"
        for name, accts in COMPOSITES)
    single = ",\n    ".join(
        f"SUM(CASE WHEN account_number = {_q(a)} THEN amount ELSE 0 END) AS {account_column(a)}" for a in ACCOUNTS)
    xwalk = ", ".join(f"({_q(r)}, {_q(m)})" for r, m in cfg.crosswalk)
    rc_cols = DL_COLS + ["aep_adjusted"]
    dd_fill = {c: f"COALESCE({c}, 0) AS {c}" for c in DL_MONEY + ["number_of_agents"] + SLIM_MONEY}
    dd_cols = ", ".join(dd_fill.get(c, c) for c in SLIM_COLS + DL_COLS) + ", aep_adjusted, " + ", ".join(SPLIT_COLS)
    pivot = ",\n    ".join(
        f"MAX(CASE WHEN ending_year = '{y}' THEN {v} END) AS {v}_{y}" for v in PIVOTED for y in years)
    flags = ", ".join(
        f"CASE WHEN gci_less_referral_{y} IS NOT NULL THEN 1 ELSE 0 END AS num_producing_principals_{y}"
        for y in years)
    members = "\n  UNION ALL ".join(
        f"SELECT {_q(name)} AS cohort, * FROM pdata" + (f" WHERE {bounds}" if bounds else "") for name, bounds in COHORTS)
    sums = []
    for y in pair:
        sums.append(f"CAST(COALESCE(SUM(num_producing_principals_{y}), 0) AS BIGINT) AS num_producing_principals_{y}")
    for y in pair:
        sums.append(f"CAST(COALESCE(SUM(deal_count_{y}), 0) AS BIGINT) AS unit_total_{y}")
    for v in MONEY_VALUES:
        for y in pair:
            sums.append(f"COALESCE(SUM({v}_{y}), 0) AS {v}_{y}")
    fee_adjust = ", ".join(
        f"CASE WHEN f_acct = {_q(a)} AND f_fee IS NOT NULL THEN {account_column(a)} - f_fee "
        f"ELSE {account_column(a)} END AS {account_column(a)}" if account_column(a) in ACCTS else account_column(a)
        for a in ACCOUNTS)
    fba_cols = ", ".join(c for c in DL_LEADING + DL_MEASURES) + ", " + fee_adjust + \
        ", vendor_agent_id, company_agent_id, aep_adjusted"
    fee_keys = FEE_NS + ["department_name"]
    fil_cols = ", ".join(
        (f"COALESCE(b.{c}, t.{c}) AS {c}" if c in fee_keys else
         f"b.{c} + t.flat_fees_isolated AS {c}" if c == account_column("430011") else f"b.{c}")
        for c in rc_cols) + ", t.flat_fees_isolated"
    order = ", ".join(f"COALESCE({c}, 'tmp')" for c in ["market", "location_name", "team_id", "account_team_name",
                                                        "listing_type"])
    return f"""
ledger_lines AS ({LEDGER_LINES_SQL}),
principal_roster AS ({PRINCIPAL_ROSTER_SQL}),
lw AS (SELECT * FROM ledger_lines WHERE ending_period BETWEEN {_d(cfg.begin)} AND {_d(cfg.end)}),
dl_raw AS (
  SELECT {_region(cfg)} AS market_region, {DEAL_KEY} AS deal_id, team_id, side_represented, listing_type,
    location_name, department_name, ending_period, close_date, final_close_price, vendor_agent_id, company_agent_id,
    {comp},
    {single}
  FROM lw
  GROUP BY 1, 2, team_id, side_represented, listing_type, location_name, department_name, ending_period,
    close_date, final_close_price, vendor_agent_id, company_agent_id),
dl AS (
  SELECT {', '.join(DL_LEADING)}, total_gci, total_referral + total_gci AS gci_less_referral, commission_expense,
    total_referral + total_gci + commission_expense AS company_dollar, aep,
    total_referral + total_gci + commission_expense + aep AS company_dollar_plus_aep,
    {', '.join(ACCTS)}, vendor_agent_id, company_agent_id
  FROM dl_raw),
aep_l AS (
  SELECT {DEAL_KEY} AS deal_id, team_id, ending_period, amount, {_region(cfg)} AS market_region, location_name,
    side_represented, listing_type, department_name
  FROM ledger_lines
  WHERE ending_period BETWEEN {_d(cfg.side_begin)} AND DATE '2020-08-31'
    AND item_type_name = 'AEP' AND account_number = '502001'),
fee_l AS (
  SELECT {DEAL_KEY} AS deal_id, team_id, ending_period, amount, {_region(cfg)} AS market_region, location_name,
    side_represented, listing_type, account_number, item_id, item_name, department_name
  FROM ledger_lines
  WHERE item_id IN ('470', '469', '111', '86', '799')
    AND ending_period BETWEEN {_d(cfg.side_begin)} AND DATE '2020-07-31'),
ros AS (
  SELECT {', '.join(ROSTER_COLS)} FROM principal_roster
  WHERE agent_role = 'Principal' AND primary_principal_flag = 'Y'
    AND original_start_date IS NOT NULL
    AND parent_account_name NOT IN ({', '.join(_q(x) for x in cfg.excluded)})),
ros_agents AS (
  SELECT * REPLACE (CASE WHEN number_of_agents = 0 THEN 1 ELSE number_of_agents END AS number_of_agents) FROM ros),
rs AS (
  SELECT team_id AS roster_team_id, {', '.join(SLIM_COLS[1:])}
  FROM ros_agents WHERE team_id IS NOT NULL),
aep_t AS (SELECT {', '.join(AEP_KEYS)}, SUM(amount) AS aep_adjusted FROM aep_l GROUP BY ALL),
j1 AS (
  SELECT {', '.join(f'COALESCE(d.{c}, a.{c}) AS {c}' if c in AEP_KEYS else f'd.{c}' for c in DL_COLS)},
    a.aep_adjusted
  FROM dl d FULL OUTER JOIN aep_t a ON {_nse('d', 'a', AEP_KEYS)}),
rc AS (
  SELECT {', '.join('CASE WHEN aep_adjusted IS NOT NULL THEN commission_expense - aep_adjusted ELSE commission_expense END AS commission_expense' if c == 'commission_expense' else c for c in DL_COLS)},
    aep_adjusted
  FROM j1),
sp AS (
  SELECT {', '.join(DL_COLS)}, COALESCE(aep_adjusted, 0) AS aep_adjusted,
    COALESCE({_ratio('commission_expense', 'gci_less_referral')}, 0.0) AS agent_split,
    COALESCE(1.0 + {_ratio('commission_expense', 'gci_less_referral')}, 0.0) AS company_split,
    COALESCE(gci_less_referral + commission_expense, 0) AS net_company_dollar,
    COALESCE(aep + COALESCE(aep_adjusted, 0), 0) AS aep_total,
    COALESCE(gci_less_referral + commission_expense + aep + COALESCE(aep_adjusted, 0), 0) AS ncd_and_aep_total,
    CAST(year(ending_period) AS VARCHAR) AS ending_year
  FROM rc),
dd AS (SELECT {dd_cols} FROM sp LEFT JOIN rs ON sp.team_id = rs.roster_team_id),
py AS (
  SELECT roster_team_id AS team_id, account_team_name, ending_year, market_region, location_name, listing_type,
    market, original_start_date,
    CAST(COUNT(DISTINCT deal_id) + MAX(CASE WHEN deal_id IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS deal_count,
    SUM(commission_expense) AS commission_expense, SUM(gci_less_referral) AS gci_less_referral,
    SUM(net_company_dollar) AS net_company_dollar, SUM(aep_total) AS aep_total,
    COALESCE({_ratio('SUM(net_company_dollar)', 'SUM(gci_less_referral)')}, 0.0) AS ncd_margin
  FROM dd GROUP BY roster_team_id, account_team_name, ending_year, market_region, location_name, listing_type,
    market, original_start_date),
pv AS (
  SELECT {', '.join(PV_INDEX)},
    {pivot}
  FROM py GROUP BY {', '.join(PV_INDEX)}),
ms AS (
  SELECT * FROM pv
  WHERE EXISTS (SELECT 1 FROM (VALUES {xwalk}) AS x(r, m) WHERE x.r = pv.market_region AND x.m = pv.market)),
pdata AS (SELECT *, {flags} FROM ms),
cm AS (
  {members}),
ct AS (
  SELECT {', '.join(GROUP)},
    {', '.join(sums)}
  FROM cm GROUP BY {', '.join(GROUP)}),
cpos AS (
  SELECT *, CAST(ROW_NUMBER() OVER (PARTITION BY market_region, cohort ORDER BY {order}) AS INTEGER) AS position
  FROM ct),
cps AS (
  SELECT c.*, {', '.join(f't.gci_less_referral_{y} AS total_gci_at_position_{y}' for y in pair)},
    {', '.join(f"CASE WHEN c.cohort = 'Total Principal Cohorts' THEN 1.0 ELSE {_ratio(f'c.gci_less_referral_{y}', f't.gci_less_referral_{y}')} END AS pct_gci_less_referral_{y}" for y in pair)}
  FROM cpos c LEFT JOIN (SELECT * FROM cpos WHERE cohort = 'Total Principal Cohorts') t
    ON c.market_region = t.market_region AND c.position = t.position),
mkt AS (
  SELECT market_region, {', '.join(f'SUM(gci_less_referral_{y}) AS market_gci_less_referral_{y}' for y in pair)}
  FROM ct WHERE cohort = 'Total Principal Cohorts' GROUP BY market_region),
cms AS (
  SELECT c.*, {', '.join(f'm.market_gci_less_referral_{y}' for y in pair)},
    {', '.join(f"{_ratio(f'c.gci_less_referral_{y}', f'm.market_gci_less_referral_{y}')} AS pct_gci_less_referral_{y}" for y in pair)}
  FROM ct c LEFT JOIN mkt m ON c.market_region = m.market_region),
fs AS (
  SELECT {', '.join(fee_keys)}, account_number, SUM(COALESCE(amount, 0)) AS flat_fees_isolated
  FROM fee_l GROUP BY ALL),
ft AS (SELECT {', '.join(fee_keys)}, SUM(flat_fees_isolated) AS flat_fees_isolated FROM fs GROUP BY ALL),
fj AS (
  SELECT r.*, f.account_number AS f_acct, f.flat_fees_isolated AS f_fee
  FROM rc r LEFT JOIN fs f ON {_nse('r', 'f', FEE_NS)} AND r.department_name = f.department_name),
fba AS (SELECT {fba_cols} FROM fj),
fil AS (
  SELECT {fil_cols}
  FROM fba b FULL OUTER JOIN ft t ON {_nse('b', 't', FEE_NS)} AND b.department_name = t.department_name)
"""


# The deal ledger by the second chart, its accounts as literals.
SECOND_CHART_LEDGER = """
SELECT market_region, side_represented, deal_id, listing_type, location_name, department_name, team_id, close_date, ending_period,
  CAST(final_close_price AS DOUBLE) AS final_close_price, CAST(gci AS DOUBLE) AS total_gci, CAST(referral + gci AS DOUBLE) AS gci_less_referral,
  CAST(commission AS DOUBLE) AS commission_expense, CAST(referral + gci + commission AS DOUBLE) AS company_dollar, CAST(aep AS DOUBLE) AS aep,
  CAST(referral + gci + commission + aep AS DOUBLE) AS company_dollar_plus_aep, CAST(a1 AS DOUBLE) AS acct_439901, CAST(a2 AS DOUBLE) AS acct_400001,
  CAST(a3 AS DOUBLE) AS acct_400099, CAST(a4 AS DOUBLE) AS acct_510002, CAST(a5 AS DOUBLE) AS acct_502001, CAST(a6 AS DOUBLE) AS acct_503001,
  CAST(a7 AS DOUBLE) AS acct_502006, CAST(a8 AS DOUBLE) AS acct_430003, vendor_agent_id, company_agent_id
FROM (
  SELECT {region} AS market_region, {key} AS deal_id, team_id, side_represented, listing_type, location_name, department_name, ending_period, close_date,
    final_close_price, vendor_agent_id, company_agent_id,
    SUM(CASE WHEN account_number IN ('439901', '400001', '400099') THEN amount ELSE 0 END) AS gci,
    SUM(CASE WHEN account_number = '510002' THEN amount ELSE 0 END) AS referral,
    SUM(CASE WHEN account_number IN ('502001', '503001') THEN amount ELSE 0 END) AS commission,
    SUM(CASE WHEN account_number = '502006' THEN amount ELSE 0 END) AS aep,
    SUM(CASE WHEN account_number = '439901' THEN amount ELSE 0 END) AS a1, SUM(CASE WHEN account_number = '400001' THEN amount ELSE 0 END) AS a2,
    SUM(CASE WHEN account_number = '400099' THEN amount ELSE 0 END) AS a3, SUM(CASE WHEN account_number = '510002' THEN amount ELSE 0 END) AS a4,
    SUM(CASE WHEN account_number = '502001' THEN amount ELSE 0 END) AS a5, SUM(CASE WHEN account_number = '503001' THEN amount ELSE 0 END) AS a6,
    SUM(CASE WHEN account_number = '502006' THEN amount ELSE 0 END) AS a7, SUM(CASE WHEN account_number = '430003' THEN amount ELSE 0 END) AS a8
  FROM lw GROUP BY 1, 2, team_id, side_represented, listing_type, location_name, department_name, ending_period, close_date, final_close_price,
    vendor_agent_id, company_agent_id)
"""


def _with(cfg: SimpleNamespace, select: str) -> str:
    return f"WITH {ctes(cfg)}\n{select}"


def oracle_queries(main: SimpleNamespace = MAIN) -> dict[str, str]:
    """SQL by query name; ``main`` may be another case than the fixture's."""
    m, pair = main, main.pair
    rc_cols = DL_COLS + ["aep_adjusted"]
    rc_money = DL_MONEY + ["aep_adjusted"]
    sp_cols = rc_cols + SPLIT_COLS
    sp_money = rc_money + ["net_company_dollar", "aep_total", "ncd_and_aep_total"]
    dd_cols = SLIM_COLS + sp_cols
    dd_money = sp_money + SLIM_MONEY
    py_cols = PY_KEYS + ["commission_expense", "gci_less_referral", "net_company_dollar", "aep_total", "deal_count",
                         "ncd_margin"]
    def pv_cols(c):
        return PV_INDEX + [f"{v}_{y}" for v in PIVOTED for y in c.years]

    def pv_money(c):
        return [f"{v}_{y}" for v in MONEY_VALUES for y in c.years]

    def pdata_cols(c):
        return pv_cols(c) + [f"num_producing_principals_{y}" for y in c.years]

    ct_money = [f"{v}_{y}" for v in MONEY_VALUES for y in pair]
    ct_sums = ([f"num_producing_principals_{y}" for y in pair] + [f"unit_total_{y}" for y in pair]
               + ct_money)
    mix_cols = (["cohort", "market", "location_name", "team_id", "account_team_name", "listing_type"] + ct_sums
                + [f"ncd_margin_{y}" for y in pair] + ["ncd_variance"] + [f"pct_gci_less_referral_{y}" for y in pair]
                + ["market_region"])
    margins = ", ".join(f"{_ratio(f'net_company_dollar_{y}', f'gci_less_referral_{y}')} AS ncd_margin_{y}"
                        for y in pair)
    variance = (f"{_ratio(f'net_company_dollar_{pair[-1]}', f'gci_less_referral_{pair[-1]}')} - "
                f"{_ratio(f'net_company_dollar_{pair[0]}', f'gci_less_referral_{pair[0]}')} AS ncd_variance")
    fee_keys = FEE_NS + ["department_name"]
    fl_cols = ["deal_id", "team_id", "ending_period", "amount", "market_region", "location_name", "side_represented",
               "listing_type", "account_number", "item_id", "item_name", "department_name"]
    aep_cols = ["deal_id", "team_id", "ending_period", "amount", "market_region", "location_name",
                "side_represented", "listing_type", "department_name"]
    q = {
        "deal_ledger": _with(m, f"SELECT {_out(DL_COLS, DL_MONEY)} FROM dl"),
        "aep_lines": _with(m, f"SELECT {_out(aep_cols, ['amount'])} FROM aep_l"),
        "aep_lines_reset": _with(LATE, f"SELECT {_out(aep_cols, ['amount'])} FROM aep_l"),
        "fee_lines": _with(m, f"SELECT {_out(fl_cols, ['amount'])} FROM fee_l"),
        "fee_lines_reset": _with(LATE, f"SELECT {_out(fl_cols, ['amount'])} FROM fee_l"),
        "principal_roster": _with(m, f"SELECT {_out(ROSTER_COLS, ROSTER_MONEY)} FROM ros"),
        "normalized_region": _with(m, f"""SELECT market_region, location_name, {_region(m)} AS normalized_region,
            COUNT(*) AS n_lines FROM ledger_lines GROUP BY market_region, location_name"""),
        "deal_key": _with(m, f"""SELECT deal_id, deal_line_id, {DEAL_KEY} AS deal_key, COUNT(*) AS n_lines
            FROM ledger_lines GROUP BY deal_id, deal_line_id"""),
        "roster_agents": _with(m, f"SELECT {_out(ROSTER_COLS, ROSTER_MONEY)} FROM ros_agents"),
        "roster_slim": _with(m, f"SELECT {_out(SLIM_COLS, SLIM_MONEY)} FROM rs"),
        "aep_totals": _with(m, f"SELECT {_out(AEP_KEYS + ['aep_adjusted'], ['aep_adjusted'])} FROM aep_t"),
        "deal_aep_outer": _with(m, f"SELECT {_out(rc_cols, rc_money)} FROM j1"),
        "deal_aep_outer_late": _with(LATE, f"SELECT {_out(rc_cols, rc_money)} FROM j1"),
        "deal_aep_reclass": _with(m, f"SELECT {_out(rc_cols, rc_money)} FROM rc"),
        "deal_splits": _with(m, f"SELECT {_out(sp_cols, sp_money)} FROM sp"),
        "deal_splits_late": _with(LATE, f"SELECT {_out(sp_cols, sp_money)} FROM sp"),
        "deal_data": _with(m, f"SELECT {_out(dd_cols, dd_money)} FROM dd"),
        "deal_data_late": _with(LATE, f"SELECT {_out(dd_cols, dd_money)} FROM dd"),
        "principal_year": _with(m, f"SELECT {_out(py_cols, MONEY_VALUES)} FROM py"),
        "principal_pivot": _with(m, f"SELECT {_out(pv_cols(m), pv_money(m))} FROM pv"),
        "principal_pivot_late": _with(LATE, f"SELECT {_out(pv_cols(LATE), pv_money(LATE))} FROM pv"),
        "market_scope": _with(m, f"SELECT {_out(pv_cols(m), pv_money(m))} FROM ms"),
        "principal_data": _with(m, f"SELECT {_out(pdata_cols(m), pv_money(m))} FROM pdata"),
        "principal_data_late": _with(LATE, f"SELECT {_out(pdata_cols(LATE), pv_money(LATE))} FROM pdata"),
        "cohort_members": _with(m, f"SELECT cohort, {_out(pdata_cols(m), pv_money(m))} FROM cm"),
        "cohort_totals": _with(m, f"SELECT {_out(GROUP + ct_sums, ct_money)} FROM ct"),
        "cohort_share_positional": _with(m, "SELECT " + _out(
            GROUP + ["position"] + [f"gci_less_referral_{y}" for y in pair]
            + [f"total_gci_at_position_{y}" for y in pair] + [f"pct_gci_less_referral_{y}" for y in pair],
            [f"gci_less_referral_{y}" for y in pair] + [f"total_gci_at_position_{y}" for y in pair]) + " FROM cps"),
        "cohort_share": _with(m, "SELECT " + _out(
            GROUP + [f"gci_less_referral_{y}" for y in pair]
            + [f"market_gci_less_referral_{y}" for y in pair] + [f"pct_gci_less_referral_{y}" for y in pair],
            [f"gci_less_referral_{y}" for y in pair] + [f"market_gci_less_referral_{y}" for y in pair])
            + " FROM cms"),
        "cohort_mix": _with(m, f"SELECT {_out(mix_cols, ct_money)} FROM (SELECT *, {margins}, {variance} FROM cps)"),
        "cohort_mix_late": _with(LATE, f"SELECT {_out(mix_cols, ct_money)} FROM (SELECT *, {margins}, {variance} FROM cps)"),
        "fee_sums": _with(m, f"SELECT {_out(fee_keys + ['account_number', 'flat_fees_isolated'], ['flat_fees_isolated'])} FROM fs"),
        "fee_totals": _with(m, f"SELECT {_out(fee_keys + ['flat_fees_isolated'], ['flat_fees_isolated'])} FROM ft"),
        "fee_unmapped_accounts": _with(m, f"""SELECT account_number, COUNT(*) AS n_sums,
            CAST(SUM(flat_fees_isolated) AS DOUBLE) AS flat_fees_isolated FROM fs
            WHERE account_number IS NULL OR account_number NOT IN ({', '.join(_q(a) for a in ACCOUNTS)})
            GROUP BY account_number"""),
        "fee_by_account": _with(m, f"SELECT {_out(rc_cols, rc_money)} FROM fba"),
        "fee_isolated_ledger": _with(m, f"SELECT {_out(rc_cols + ['flat_fees_isolated'], rc_money + ['flat_fees_isolated'])} FROM fil"),
    }

    def labelled(sql, columns):
        """The keys of a published summary carry a label for NULL, as text."""
        return f"SELECT * REPLACE ({', '.join(f'COALESCE(CAST({c} AS VARCHAR), {_q(NULL_LABEL)}) AS {c}' for c in columns)}) FROM ({sql})"

    q["published_deal_data"] = q["deal_data"]
    q["published_principal_data"] = labelled(q["principal_data"], PV_INDEX)
    q["published_principal_mix_data"] = labelled(q["cohort_mix"], GROUP)
    q["published_rows"] = " UNION ALL ".join(f"SELECT {_q(name)} AS output, COUNT(*) AS n_rows FROM ({q[source]})" for name, source in (
        ("deal_data", "deal_data"), ("principal_data", "principal_data"), ("principal_mix_data", "cohort_mix")))
    q["deal_ledger_incremental"] = q["deal_ledger"]
    q["deal_data_incremental"] = q["deal_data"]
    for name in ("deal_aep_outer", "deal_data", "principal_data"):
        q[f"{name}_colocated"] = q[name]
    # Lines with text ids: 'n/a' in every 29th deal, '?' in every 37th line id, amounts times 10^15 and periods left out here and there.
    text = f"""WITH {ctes(m)}, texts AS (
      SELECT * REPLACE (
        CASE WHEN deal_id % 29 = 0 THEN 'n/a' WHEN deal_id IS NOT NULL THEN deal_id || '.0' END AS deal_id,
        CASE WHEN deal_line_id % 37 = 0 THEN '?' ELSE deal_line_id::VARCHAR END AS deal_line_id,
        CASE WHEN abs(amount) % 211 < 1 THEN amount::DECIMAL(38,2) * 1000000000000000::DECIMAL(16,0) ELSE amount::DECIMAL(38,2) END AS amount,
        CASE WHEN final_close_price % 97 < 1 THEN NULL ELSE ending_period END AS ending_period)
      FROM ledger_lines
    ), judged AS (
      SELECT *, CASE WHEN deal_id = 'n/a' OR (deal_id IS NULL AND deal_line_id = '?') THEN 'deal id is not a number'
        WHEN ending_period IS NULL THEN 'no ending period' WHEN abs(amount) >= 10000000000000000 THEN 'amount too large' END AS reason
      FROM texts)"""
    q["rejected_lines"] = text + """
      SELECT reason, deal_id, deal_line_id, account_number, ending_period, CAST(amount AS DOUBLE) AS amount FROM judged WHERE reason IS NOT NULL"""
    q["deal_ledger_accepted"] = _with(m, f"SELECT {_out(DL_COLS, DL_MONEY)} FROM dl").replace(f"ledger_lines AS ({LEDGER_LINES_SQL})", f"""ledger_lines AS (
      SELECT * FROM ({LEDGER_LINES_SQL}) WHERE NOT coalesce(deal_id % 29 = 0, deal_line_id % 37 = 0, FALSE) AND NOT final_close_price % 97 < 1
        AND NOT coalesce(abs(amount) % 211 < 1, FALSE))""")
    q["deal_ledger_second_chart"] = _with(m, SECOND_CHART_LEDGER.format(region=_region(m), key=DEAL_KEY))
    q["accounts_outside_chart"] = _with(m, """SELECT account_number, COUNT(*) AS n_lines, CAST(SUM(amount) AS DOUBLE) AS amount FROM ledger_lines
        WHERE account_number NOT IN ('439901', '400001', '400099', '510002', '502001', '503001', '502006', '430003') GROUP BY account_number""")
    return q
