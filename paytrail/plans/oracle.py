"""The same queries as DuckDB SQL over the driver's tables, written independently.

Named pieces below are the compensation tables; ``_sql`` puts the pieces a query needs,
and those they need, in front of it.
"""

from __future__ import annotations

import re

_PIECES = {
    "txn": """
        SELECT l_orderkey * 10 + l_linenumber AS transaction_id, l_orderkey AS policy_id,
               l_suppkey AS agent_id, l_partkey,
               CASE l_returnflag WHEN 'A' THEN 'New Business' WHEN 'N' THEN 'Renewal'
                                 WHEN 'R' THEN 'Override' END AS transaction_type,
               CAST(l_shipdate AS DATE) AS transaction_date,
               strftime(l_shipdate, '%Y-%m') AS pay_period,
               CAST(l_extendedprice AS DECIMAL(12,2)) AS premium_amount,
               CAST(l_discount AS DECIMAL(4,2)) AS commission_rate,
               CAST(round(CAST(l_extendedprice AS DECIMAL(12,2)) * CAST(l_discount AS DECIMAL(4,2)), 2)
                    AS DECIMAL(18,2)) AS commission_amount,
               l_linestatus, CAST(l_quantity AS INTEGER) AS quantity
        FROM lineitem""",
    "good": "SELECT * FROM txn WHERE commission_amount > 0",
    "cb": """
        SELECT transaction_id AS chargeback_id, transaction_id AS original_transaction_id,
               policy_id, agent_id, transaction_date + 4 * quantity AS chargeback_date,
               strftime(transaction_date + 4 * quantity, '%Y-%m') AS pay_period,
               -abs(commission_amount) AS chargeback_amount
        FROM good
        WHERE transaction_type = 'New Business' AND l_linestatus = 'F' AND 4 * quantity <= 90""",
    "due": """
        SELECT agent_id, pay_period,
               CAST(last_day(CAST(pay_period || '-01' AS DATE)) + 5 AS DATE) AS payment_date,
               coalesce(g, 0) AS gross_commission, coalesce(c, 0) AS chargeback_deductions,
               CAST(coalesce(g, 0) + coalesce(c, 0) AS DECIMAL(18,2)) AS net_payment_amount,
               CASE WHEN coalesce(g, 0) + coalesce(c, 0) < -500 THEN 'Held' ELSE 'Paid' END
                   AS payment_status
        FROM (SELECT agent_id, pay_period, CAST(sum(commission_amount) AS DECIMAL(18,2)) AS g
              FROM txn GROUP BY ALL)
        FULL JOIN (SELECT agent_id, pay_period, CAST(sum(chargeback_amount) AS DECIMAL(18,2)) AS c
                   FROM cb GROUP BY ALL) USING (agent_id, pay_period)""",
    "pay": """
        SELECT * EXCLUDE (net_payment_amount, h), 'PAY-' || agent_id || '-' || pay_period AS payment_id,
               CAST(net_payment_amount + CASE h WHEN 0 THEN 75.25 WHEN 1 THEN 0.75 ELSE 0 END
                    AS DECIMAL(18,2)) AS net_payment_amount
        FROM (SELECT *, (agent_id * 31 + CAST(substr(pay_period, 6, 2) AS INTEGER) * 7
                         + CAST(substr(pay_period, 1, 4) AS INTEGER)) % 50 AS h FROM due)
        WHERE h <> 2""",
    "agent": """
        SELECT s_suppkey AS agent_id, s_name AS first_name, CAST(NULL AS VARCHAR) AS last_name,
               CAST(s_nationkey AS BIGINT) AS agency_id,
               DATE '1998-01-01' + CAST((s_suppkey * 37) % 1200 AS INTEGER) AS hire_date,
               CASE WHEN s_suppkey % 12 = 11 THEN DATE '2000-01-01' END AS termination_date,
               CASE WHEN s_suppkey % 12 = 11 THEN 'Terminated' WHEN s_acctbal < 0 THEN 'Suspended'
                    ELSE 'Active' END AS agent_status,
               nullif(min(s_suppkey) OVER (PARTITION BY s_nationkey), s_suppkey) AS upline_agent_id
        FROM supplier""",
    "agency": """
        SELECT CAST(n_nationkey AS BIGINT) AS agency_id, n_name AS agency_name, r_name AS region
        FROM nation JOIN region ON n_regionkey = r_regionkey""",
    "change": """
        SELECT s_suppkey AS agent_id,
               ['Bronze', 'Silver', 'Gold', 'Platinum'][CAST((s_suppkey + i) % 4 + 1 AS INTEGER)] AS tier,
               CASE i WHEN 0 THEN CASE WHEN s_suppkey % 10 = 9 THEN DATE '1996-01-01' ELSE DATE '1995-01-01' END
                      WHEN 1 THEN DATE '1997-01-01' + CAST(s_suppkey % 365 AS INTEGER)
                      ELSE DATE '1999-07-01' + CAST(s_suppkey % 181 AS INTEGER) END AS d
        FROM supplier, (SELECT unnest([0, 1, 2]) AS i)
        WHERE i <= s_suppkey % 3 AND s_suppkey % 25 <> 24""",
    "tiers": """
        SELECT agent_id, tier, d AS effective_start_date, n AS effective_end_date, n IS NULL AS is_current
        FROM (SELECT *, lead(d) OVER (PARTITION BY agent_id ORDER BY d) AS n FROM change)""",
    "dim": """
        SELECT tiers.*, first_name, last_name, agency_id, hire_date, termination_date, agent_status,
               upline_agent_id,
               agent_id || '_' || row_number() OVER (PARTITION BY agent_id ORDER BY effective_start_date)
                   AS agent_sk
        FROM tiers JOIN agent USING (agent_id)""",
    "now": "SELECT *, concat_ws(' ', first_name, last_name) AS agent_name FROM dim WHERE is_current",
    "product": """
        SELECT DISTINCT p_type AS product_id,
               CAST(CASE p_type WHEN 'ECONOMY' THEN 0.10 WHEN 'LARGE' THEN 0.12 WHEN 'MEDIUM' THEN 0.15
                    WHEN 'PROMO' THEN 0.20 WHEN 'SMALL' THEN 0.55 WHEN 'STANDARD' THEN 0.70 END
                    AS DECIMAL(9,4)) AS base_commission_rate
        FROM part""",
    "plan": """
        SELECT product_id || '-' || y || '-' || t || '-' || k AS plan_id, product_id, t AS agent_tier,
               k AS transaction_type,
               CAST(round(base_commission_rate * m * r * CAST(1 + 0.02 * y AS DECIMAL(6,2)), 4)
                    AS DECIMAL(9,4)) AS commission_rate,
               DATE '1995-01-01' + 365 * y AS effective_start_date,
               CASE WHEN y < 6 THEN DATE '1995-01-01' + 365 * (y + 1) - 1 END AS effective_end_date
        FROM product, (SELECT CAST(unnest(range(7)) AS INTEGER) AS y),
             (VALUES ('Bronze', 0.80), ('Silver', 1.00), ('Gold', 1.15), ('Platinum', 1.30)) AS tm(t, m),
             (VALUES ('New Business', 1.0), ('Renewal', 0.5)) AS kr(k, r)""",
    "rawpol": """
        SELECT o_orderkey AS policy_id,
               p || '-' || lpad(CAST(o_orderkey AS VARCHAR), 7, '0') AS policy_number,
               o_custkey AS customer_id, p AS product_id,
               o_custkey % (SELECT count(*) FROM supplier) AS agent_id,
               CAST(o_orderdate AS DATE) AS issue_date,
               CASE WHEN o_orderstatus = 'F'
                    THEN CAST(o_orderdate AS DATE) + CAST(o_orderkey % 400 AS INTEGER) END AS cancel_date,
               CAST(CASE WHEN o_orderkey % 200 <> 0 THEN CAST(o_totalprice AS DECIMAL(12,2)) END
                    + load_seq - 1 AS DECIMAL(18,2)) AS annual_premium,
               CASE o_orderstatus WHEN 'F' THEN 'Cancelled' WHEN 'O' THEN 'Active'
                                  WHEN 'P' THEN 'Renewed' END AS policy_status,
               1 + o_orderkey % 2 AS num_renewals, load_seq
        FROM (SELECT *, ['ECONOMY', 'LARGE', 'MEDIUM', 'PROMO', 'SMALL', 'STANDARD']
                        [CAST(o_orderkey % 6 + 1 AS INTEGER)] AS p FROM orders),
             (VALUES (1), (2)) AS deliveries(load_seq)
        WHERE load_seq = 1 OR o_orderkey % 500 = 7""",
    "newest": """
        SELECT * FROM rawpol
        QUALIFY row_number() OVER (PARTITION BY policy_id ORDER BY load_seq DESC) = 1""",
    "policy": "SELECT * FROM newest WHERE annual_premium IS NOT NULL",
    "priced": """
        SELECT p.*, base_commission_rate, coalesce(t, 'Bronze') AS tier_at_issue,
               CAST(coalesce(nullif(commission_rate, 0), base_commission_rate) AS DECIMAL(9,4)) AS rate
        FROM (SELECT *, (SELECT first(tier ORDER BY effective_start_date, effective_end_date NULLS LAST)
                         FROM tiers
                         WHERE tiers.agent_id = policy.agent_id AND effective_start_date <= issue_date
                           AND (effective_end_date IS NULL OR issue_date <= effective_end_date)) AS t
              FROM policy) AS p
        JOIN product USING (product_id)
        LEFT JOIN plan ON plan.product_id = p.product_id AND agent_tier = coalesce(t, 'Bronze')
             AND transaction_type = 'New Business' AND issue_date >= effective_start_date
             AND (effective_end_date IS NULL OR issue_date <= effective_end_date)""",
    "nb": """
        SELECT 'NB-' || policy_id AS transaction_id, policy_id, agent_id, product_id,
               'New Business' AS transaction_type, issue_date AS transaction_date,
               annual_premium AS premium_amount, rate AS commission_rate,
               CAST(round(annual_premium * rate, 2) AS DECIMAL(18,2)) AS commission_amount
        FROM priced""",
    "schedule": """
        SELECT *, issue_date + 365 * r AS renewal_date
        FROM policy, (VALUES (1), (2)) AS n(r)
        WHERE policy_status = 'Renewed' AND r <= num_renewals
          AND issue_date + 365 * r <= DATE '2001-12-31'""",
    "renewed": """
        SELECT p.*, coalesce(t, tier_at_issue) AS renewal_tier,
               CAST(coalesce(nullif(commission_rate, 0), base_commission_rate * 0.5) AS DECIMAL(9,4)) AS renewal_rate
        FROM (SELECT s.*, base_commission_rate, tier_at_issue,
                     (SELECT first(tier ORDER BY effective_start_date, effective_end_date NULLS LAST)
                      FROM tiers
                      WHERE tiers.agent_id = s.agent_id AND effective_start_date <= s.renewal_date
                        AND (effective_end_date IS NULL OR s.renewal_date <= effective_end_date)) AS t
              FROM schedule AS s JOIN priced USING (policy_id)) AS p
        LEFT JOIN plan ON plan.product_id = p.product_id AND agent_tier = coalesce(t, tier_at_issue)
             AND transaction_type = 'Renewal' AND renewal_date >= effective_start_date
             AND (effective_end_date IS NULL OR renewal_date <= effective_end_date)""",
    "rn": """
        SELECT 'RN-' || policy_id || '-' || r AS transaction_id, policy_id, agent_id, product_id,
               'Renewal' AS transaction_type, renewal_date AS transaction_date,
               annual_premium AS premium_amount, renewal_rate AS commission_rate,
               CAST(round(annual_premium * renewal_rate, 2) AS DECIMAL(18,2)) AS commission_amount
        FROM renewed""",
    "ov": """
        SELECT 'OV-' || transaction_id AS transaction_id, policy_id, upline_agent_id AS agent_id,
               product_id, 'Override' AS transaction_type, transaction_date, premium_amount,
               CAST(0.10 AS DECIMAL(9,4)) AS commission_rate,
               CAST(round(commission_amount * 0.10, 2) AS DECIMAL(18,2)) AS commission_amount
        FROM (SELECT * FROM nb UNION ALL SELECT * FROM rn) AS sold
        JOIN agent ON agent.agent_id = sold.agent_id AND upline_agent_id IS NOT NULL""",
    "tier_on_day": """
        SELECT agent_id, transaction_date,
               first(tier ORDER BY effective_start_date, effective_end_date NULLS LAST) AS tier
        FROM (SELECT DISTINCT agent_id, transaction_date FROM txn) JOIN tiers USING (agent_id)
        WHERE effective_start_date <= transaction_date
          AND (effective_end_date IS NULL OR transaction_date <= effective_end_date)
        GROUP BY agent_id, transaction_date""",
    "summary": """
        SELECT *, gross_commission + chargeback_deductions AS net_commission
        FROM (SELECT agent_id, pay_period, nb AS new_business_commission, rn AS renewal_commission,
                     ov AS override_commission, CAST(nb + rn + ov AS DECIMAL(18,2)) AS gross_commission,
                     CAST(coalesce(c, 0) AS DECIMAL(18,2)) AS chargeback_deductions,
                     agent_name, agency_id, tier, agent_status
              FROM (SELECT agent_id, pay_period,
                           CAST(coalesce(sum(commission_amount) FILTER (transaction_type = 'New Business'), 0) AS DECIMAL(18,2)) AS nb,
                           CAST(coalesce(sum(commission_amount) FILTER (transaction_type = 'Renewal'), 0) AS DECIMAL(18,2)) AS rn,
                           CAST(coalesce(sum(commission_amount) FILTER (transaction_type = 'Override'), 0) AS DECIMAL(18,2)) AS ov
                    FROM good GROUP BY ALL)
              LEFT JOIN (SELECT agent_id, pay_period, sum(chargeback_amount) AS c FROM cb GROUP BY ALL)
                   USING (agent_id, pay_period)
              LEFT JOIN now USING (agent_id))""",
    "recon": """
        SELECT agent_id, pay_period, agent_name, net_commission AS calculated_net_commission,
               net_payment_amount AS recorded_net_payment, payment_status,
               coalesce(net_payment_amount, 0) - coalesce(net_commission, 0) AS variance,
               CASE WHEN net_commission IS NULL THEN 'PAID_WITHOUT_CALCULATION'
                    WHEN net_payment_amount IS NULL THEN 'CALCULATED_BUT_NOT_PAID'
                    WHEN abs(coalesce(net_payment_amount, 0) - coalesce(net_commission, 0)) > 1.00 THEN 'BREAK'
                    ELSE 'MATCHED' END AS reconciliation_status
        FROM (SELECT agent_id, pay_period, agent_name, net_commission FROM summary)
        FULL JOIN (SELECT agent_id, pay_period, net_payment_amount, payment_status FROM pay)
             USING (agent_id, pay_period)""",
    "custdim": """
        SELECT c_custkey, CASE WHEN c_custkey % 13 <> 5 THEN c_mktsegment END AS c_mktsegment,
               CAST(c_acctbal AS DECIMAL(18,2)) AS c_acctbal, DATE '1995-01-01' AS s,
               CASE WHEN c_custkey % 17 = 3 THEN DATE '1996-06-30' END AS e, c_custkey % 17 <> 3 AS c
        FROM customer""",
    "custupd": """
        SELECT c_custkey, CASE WHEN c_custkey % 10 = 0 THEN c_mktsegment || '-NEW'
                               WHEN c_custkey % 30 <> 1 THEN c_mktsegment END AS c_mktsegment,
               CAST(c_acctbal AS DECIMAL(18,2)) AS c_acctbal FROM customer WHERE c_custkey % 10 <= 1
        UNION ALL
        SELECT c_custkey + 10000000, c_mktsegment, CAST(c_acctbal AS DECIMAL(18,2))
        FROM customer WHERE c_custkey % 50 = 0""",
    "custchanged": """
        SELECT u.c_custkey FROM custupd AS u JOIN custdim AS d ON u.c_custkey = d.c_custkey AND d.c
        WHERE u.c_mktsegment IS DISTINCT FROM d.c_mktsegment OR u.c_acctbal IS DISTINCT FROM d.c_acctbal""",
    "custnew": """
        SELECT u.* FROM custupd AS u WHERE c_custkey NOT IN (SELECT c_custkey FROM custdim WHERE c)""",
}


def _sql(body: str) -> str:
    """Prepend the pieces the body refers to, dependencies first."""
    ordered: list[str] = []

    def need(text: str) -> None:
        for name in re.findall(r"(?:FROM|JOIN)\s+(\w+)", text):
            if name in _PIECES and name not in ordered:
                need(_PIECES[name])
                ordered.append(name)

    need(body)
    pieces = ",\n".join(f"{name} AS ({_PIECES[name]})" for name in ordered)
    return f"WITH {pieces}\n{body}" if ordered else body


def _money(*names: str) -> str:
    return ", ".join(f"CAST({n} AS DOUBLE) AS {n}" for n in names)


def _day(*names: str) -> str:
    return ", ".join(f"CAST({n} AS VARCHAR) AS {n}" for n in names)


_TXN = (
    "transaction_id, policy_id, agent_id, transaction_type, "
    + _day("transaction_date")
    + ", pay_period, "
    + _money("premium_amount", "commission_rate", "commission_amount")
)
_CALC = (
    "transaction_id, policy_id, agent_id, product_id, transaction_type, "
    + _day("transaction_date")
    + ", "
    + _money("premium_amount", "commission_rate", "commission_amount")
)
_POLICY = (
    "policy_id, policy_number, customer_id, product_id, agent_id, policy_status, num_renewals, "
    "CAST(load_seq AS BIGINT) AS load_seq, "
    + _day("issue_date", "cancel_date")
    + ", "
    + _money("annual_premium")
)
_PERIOD = _day("effective_start_date", "effective_end_date")
_PAY = (
    "agent_id, pay_period, payment_status, "
    + _day("payment_date")
    + ", "
    + _money("gross_commission", "chargeback_deductions", "net_payment_amount")
)
_MONTHLY = """
    SELECT pay_period AS month, transaction_type, '0042' AS product_id, count(*) AS transactions,
           CAST(CAST(sum(commission_amount) AS DECIMAL(18,2)) AS DOUBLE) AS commission
    FROM txn GROUP BY pay_period, transaction_type"""
_PAYMENT_RUN = """
    SELECT pay_period, agency_id, agency_name, region, count(payment_id) AS num_payments,
           CAST(CAST(sum(gross_commission) AS DECIMAL(18,2)) AS DOUBLE) AS total_gross_commission,
           CAST(CAST(sum(chargeback_deductions) AS DECIMAL(18,2)) AS DOUBLE) AS total_chargeback_deductions,
           CAST(CAST(sum(net_payment_amount) AS DECIMAL(18,2)) AS DOUBLE) AS total_net_paid,
           CAST(sum(CASE WHEN payment_status = 'Held' THEN 1 ELSE 0 END) AS BIGINT) AS num_held,
           CAST(sum(CASE WHEN payment_status = 'Failed' THEN 1 ELSE 0 END) AS BIGINT) AS num_failed
    FROM pay LEFT JOIN now USING (agent_id) LEFT JOIN agency USING (agency_id)
    GROUP BY pay_period, agency_id, agency_name, region"""

_EXPOSURE = f"""
    SELECT agent_id, agent_name, agency_id, tier, {_money("new_business_commission", "total_chargeback_amount")},
           new_business_count, coalesce(k, 0) AS chargeback_count,
           CASE WHEN new_business_commission > 0
                THEN CAST(total_chargeback_amount AS DOUBLE) / CAST(new_business_commission AS DOUBLE)
                ELSE 0.0 END AS chargeback_rate,
           new_business_commission > 0 AND total_chargeback_amount > new_business_commission * 0.25 AS is_high_risk
    FROM (SELECT agent_id, n AS new_business_commission, nk AS new_business_count, k,
                 CAST(coalesce(c, 0) AS DECIMAL(18,2)) AS total_chargeback_amount
          FROM (SELECT agent_id, CAST(sum(commission_amount) AS DECIMAL(18,2)) AS n, count(transaction_id) AS nk
                FROM good WHERE transaction_type = 'New Business' GROUP BY agent_id)
          LEFT JOIN (SELECT agent_id, sum(abs(chargeback_amount)) AS c, count(chargeback_id) AS k
                     FROM cb GROUP BY agent_id) USING (agent_id))
    LEFT JOIN now USING (agent_id)"""

_LEADERBOARD = f"""
    SELECT agent_id, agent_name, agency_id, tier,
           {_money("trailing_12mo_gross_commission", "trailing_12mo_net_commission", "trailing_12mo_chargebacks")},
           rank() OVER (ORDER BY trailing_12mo_net_commission DESC) AS rank
    FROM (SELECT agent_id, agent_name, agency_id, tier,
                 CAST(sum(gross_commission) AS DECIMAL(18,2)) AS trailing_12mo_gross_commission,
                 CAST(sum(net_commission) AS DECIMAL(18,2)) AS trailing_12mo_net_commission,
                 CAST(sum(chargeback_deductions) AS DECIMAL(18,2)) AS trailing_12mo_chargebacks
          FROM summary
          WHERE pay_period >= (SELECT strftime(CAST(max(pay_period) || '-01' AS DATE) - INTERVAL 11 MONTH, '%Y-%m')
                               FROM summary)
          GROUP BY ALL)"""
_RECON = f"""
    SELECT agent_id, pay_period, agent_name, payment_status, reconciliation_status,
           {_money("calculated_net_commission", "recorded_net_payment", "variance")}
    FROM recon"""
_LANDED = {
    "agencies": "agency",
    "agents": "agent",
    "agent_tier_history": "tiers",
    "products": "product",
    "commission_plans": "plan",
    "policies": "rawpol",
    "commission_transactions": "txn",
    "chargebacks": "cb",
    "payments": "pay",
}
_STORED = {
    "silver": {
        "dim_agency": "agency",
        "dim_agent": "dim",
        "dim_product": "product",
        "dim_commission_plan": "plan",
        "dim_policy": "policy",
        "fact_commission_transactions": "good",
        "fact_chargebacks": "cb",
        "fact_payments": "pay",
    },
    "quarantine": {
        "dim_policy": "newest WHERE annual_premium IS NULL",
        "fact_commission_transactions": "txn WHERE commission_amount <= 0 OR commission_amount IS NULL",
        "fact_payments": "pay WHERE pay_period IS NULL",
    },
}


def _staged_rows() -> str:
    """Rows per layer and table; what gold holds is counted on the SQL of its marts."""
    gold = {
        "agent_commission_summary": "summary",
        "payment_run_summary": f"({_PAYMENT_RUN})",
        "chargeback_exposure": f"({_EXPOSURE})",
        "agent_leaderboard": f"({_LEADERBOARD})",
        "reconciliation_report": "recon",
    }
    landed = [
        f"SELECT 'bronze' AS layer, '{name}' AS table_name, count(*) AS n_rows, count(*) AS landed FROM {source}"
        for name, source in _LANDED.items()
    ]
    stored = [
        f"SELECT '{layer}' AS layer, '{name}' AS table_name, count(*) AS n_rows, CAST(NULL AS BIGINT) AS landed FROM {source}"
        for layer, tables in {**_STORED, "gold": gold}.items()
        for name, source in tables.items()
    ]
    return " UNION ALL ".join(landed + stored)


_TIER_AS_OF = f"""
    SELECT transaction_id, agent_id, {_day("transaction_date")}, tier
    FROM txn LEFT JOIN tier_on_day USING (agent_id, transaction_date)"""
_EVOLVED = """
    SELECT CAST(o_orderkey AS VARCHAR) AS payment_id, CAST(o_custkey AS VARCHAR) AS agent_id,
           strftime(o_orderdate, '%Y-%m') AS pay_period, strftime(o_orderdate, '%Y-%m-%d') AS payment_date,
           CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DOUBLE) AS gross_commission,
           CASE WHEN year(o_orderdate) >= 1995 THEN CAST(0 AS DOUBLE) END AS chargeback_deductions,
           CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DOUBLE) AS net_payment_amount,
           o_orderstatus AS payment_status, CASE WHEN year(o_orderdate) >= 1995 THEN 'ACH' END AS payment_method
    FROM orders"""
_SCD2_TYPED = (
    "c_custkey, c_mktsegment, CAST(c_acctbal AS DOUBLE) AS c_acctbal, "
    "CAST(s AS VARCHAR) AS effective_start_date, CAST(e AS VARCHAR) AS effective_end_date, c AS is_current"
)
_SCD2 = f"""
    SELECT {_SCD2_TYPED} FROM (
        SELECT d.c_custkey, c_mktsegment, c_acctbal, s,
               CASE WHEN c AND n.c_custkey IS NOT NULL THEN DATE '1998-12-31' ELSE e END AS e,
               c AND n.c_custkey IS NULL AS c
        FROM custdim AS d LEFT JOIN custchanged AS n ON n.c_custkey = d.c_custkey
        UNION ALL
        SELECT u.*, DATE '1999-01-01', NULL, true FROM custupd AS u JOIN custchanged USING (c_custkey)
        UNION ALL
        SELECT *, DATE '1999-01-01', NULL, true FROM custnew)"""


def _check(table: str, name: str, frame: str, failing: str) -> str:
    return f"""
    SELECT '{table}' AS table_name, '{name}' AS check_name, 'error' AS severity,
           CAST(({failing}) AS BIGINT) AS failing_rows,
           (SELECT count(*) FROM {frame}) AS total_rows, ({failing}) = 0 AS passed"""


def _null(frame: str, column: str) -> str:
    return f"SELECT count(*) FROM {frame} WHERE {column} IS NULL"


def _repeated(frame: str, column: str) -> str:
    return (
        f"SELECT coalesce(sum(n), 0) FROM (SELECT count(*) AS n FROM {frame} "
        f"WHERE {column} IS NOT NULL GROUP BY {column} HAVING count(*) > 1)"
    )


def _bad(frame: str, condition: str) -> str:
    return f"SELECT count(*) FROM {frame} WHERE {condition}"


def _fact_checks(frame: str) -> list[tuple[str, str]]:
    return [
        ("transaction_id_not_null", _null(frame, "transaction_id")),
        ("transaction_id_unique", _repeated(frame, "transaction_id")),
        ("agent_id_not_null", _null(frame, "agent_id")),
        ("commission_amount_positive", _bad(frame, "commission_amount <= 0")),
        ("transaction_type_valid", _bad(frame, "transaction_type NOT IN ('New Business', 'Renewal', 'Override')")),
    ]


_LOG = " UNION ALL ".join(
    _check("fact_commission_transactions", name, frame, failing)
    for frame in ("txn", "good")
    for name, failing in _fact_checks(frame)
)
_REPORT = " UNION ALL ".join(
    _check(table, name, frame, failing)
    for table, frame, checks in [
        ("dim_agency", "agency", [
            ("agency_id_not_null", _null("agency", "agency_id")),
            ("agency_id_unique", _repeated("agency", "agency_id")),
        ]),
        ("dim_agent", "dim", [
            ("agent_id_not_null", _null("dim", "agent_id")),
            ("agent_sk_unique", _repeated("dim", "agent_sk")),
            ("one_current_row_per_agent",
             "SELECT count(*) FROM (SELECT agent_id FROM dim WHERE is_current "
             "GROUP BY agent_id HAVING count(*) > 1)"),
        ]),
        ("dim_product", "product", [
            ("product_id_not_null", _null("product", "product_id")),
            ("product_id_unique", _repeated("product", "product_id")),
        ]),
        ("dim_commission_plan", "plan", [("plan_id_not_null", _null("plan", "plan_id"))]),
        ("dim_policy", "policy", [
            ("policy_id_not_null", _null("policy", "policy_id")),
            ("policy_id_unique", _repeated("policy", "policy_id")),
            ("premium_positive", _bad("policy", "annual_premium <= 0")),
        ]),
        ("fact_commission_transactions", "good", _fact_checks("good")),
        ("fact_chargebacks", "cb", [
            ("chargeback_id_not_null", _null("cb", "chargeback_id")),
            ("chargeback_id_unique", _repeated("cb", "chargeback_id")),
            ("chargeback_amount_negative", _bad("cb", "chargeback_amount >= 0")),
        ]),
        ("fact_payments", "pay", [
            ("payment_id_not_null", _null("pay", "payment_id")),
            ("payment_id_unique", _repeated("pay", "payment_id")),
            ("payment_status_valid",
             _bad("pay", "payment_status NOT IN ('Paid', 'Held', 'Scheduled', 'Failed')")),
        ]),
    ]
    for name, failing in checks
)

_INTEGRITY = " UNION ALL ".join(
    [
        _check("chargebacks", "chargeback_has_transaction", "cb",
               "SELECT count(*) FROM cb WHERE original_transaction_id NOT IN (SELECT transaction_id FROM txn)"),
        _check("chargebacks", "chargeback_within_window", "cb",
               "SELECT count(*) FROM cb JOIN newest USING (policy_id) WHERE chargeback_date - issue_date > 90"),
        _check("chargebacks", "chargeback_is_negative", "cb", _bad("cb", "chargeback_amount >= 0")),
        _check("overrides", "override_goes_to_an_upline", "txn WHERE transaction_type = 'Override'",
               "SELECT count(*) FROM txn WHERE transaction_type = 'Override' AND agent_id NOT IN "
               "(SELECT upline_agent_id FROM agent WHERE upline_agent_id IS NOT NULL)"),
        _check("production", "negative_commission_is_rare", "txn WHERE transaction_type <> 'Override'",
               "SELECT count(*) FROM txn WHERE transaction_type <> 'Override' AND commission_amount < 0"),
    ]
)

_BODIES = {
    "commission_integrity": _INTEGRITY,
    "latest_snapshot": """
        SELECT event_id, user_id, event_type, value, CAST(CAST(ts AS DATE) AS VARCHAR) AS load_date
        FROM events WHERE CAST(ts AS DATE) = (SELECT max(CAST(ts AS DATE)) FROM events)""",
    "clean_transactions": f"SELECT {_TXN} FROM txn WHERE commission_amount > 0",
    "quarantined_transactions": f"""
        SELECT {_TXN} FROM txn WHERE commission_amount <= 0 OR commission_amount IS NULL""",
    "clean_policies": f"SELECT {_POLICY} FROM newest WHERE annual_premium IS NOT NULL",
    "quarantined_policies": f"SELECT {_POLICY} FROM newest WHERE annual_premium IS NULL",
    "dedup_latest": """
        SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber,
               CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS l_shipdate,
               l_partkey, l_suppkey, l_extendedprice, l_returnflag
        FROM lineitem
        QUALIFY row_number() OVER (
            PARTITION BY l_orderkey, l_linenumber
            ORDER BY CAST(l_shipdate AS DATE) DESC NULLS LAST, l_partkey DESC NULLS LAST,
                     l_suppkey DESC NULLS LAST, l_extendedprice DESC NULLS LAST,
                     l_returnflag DESC NULLS LAST) = 1""",
    "pay_periods": """
        SELECT m AS from_timestamp, m AS from_date, m AS from_text, m AS from_period, count(*) AS lines
        FROM (SELECT strftime(l_shipdate, '%Y-%m') AS m FROM lineitem) GROUP BY m""",
    "stated_periods": """
        SELECT CASE WHEN kind IN (3, 4) THEN m END AS period, kind, count(*) AS lines
        FROM (SELECT strftime(l_shipdate, '%Y-%m') AS m, l_orderkey % 6 AS kind FROM lineitem) GROUP BY ALL""",
    "extract_evolved": _EVOLVED,
    "incremental_evolved": _EVOLVED,
    "extract_reordered": """
        SELECT CAST(o_orderkey AS VARCHAR) AS payment_id, CAST(o_custkey AS VARCHAR) AS agent_id,
               strftime(o_orderdate, '%Y-%m') AS pay_period, strftime(o_orderdate, '%Y-%m-%d') AS payment_date,
               CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DOUBLE) AS gross_commission,
               CAST(0 AS DOUBLE) AS chargeback_deductions,
               CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DOUBLE) AS net_payment_amount,
               o_orderstatus AS payment_status, 'ACH' AS payment_method
        FROM orders""",
    "dim_agency": "SELECT * FROM agency",
    "dim_agent_scd2": f"""
        SELECT agent_id, first_name, last_name, agency_id, agent_status, upline_agent_id,
               'TX' AS license_state, tier, is_current, agent_sk, {_PERIOD},
               {_day("hire_date", "termination_date")}
        FROM dim""",
    "current_dimension": f"""
        SELECT agent_id, tier, is_current, {_PERIOD} FROM tiers WHERE effective_end_date IS NULL""",
    "dim_product": f"SELECT product_id, {_money('base_commission_rate')} FROM product",
    "dim_commission_plan": f"""
        SELECT plan_id, product_id, agent_tier, transaction_type, {_money("commission_rate")}, {_PERIOD}
        FROM plan""",
    "fact_chargebacks": f"""
        SELECT chargeback_id, original_transaction_id, policy_id, agent_id, pay_period,
               {_day("chargeback_date")}, {_money("chargeback_amount")} FROM cb""",
    "fact_payments": f"SELECT payment_id, {_PAY} FROM pay",
    "build_history": f"SELECT agent_id, tier, is_current, {_PERIOD} FROM tiers",
    "tier_as_of": _TIER_AS_OF,
    "tier_as_of_unbroadcast": _TIER_AS_OF,
    "tier_as_of_boundary": f"""
        {_TIER_AS_OF} WHERE EXISTS (
            SELECT 1 FROM tiers WHERE tiers.agent_id = txn.agent_id
                                  AND effective_end_date = txn.transaction_date)""",
    "as_of_inner": f"""
        SELECT transaction_id, agent_id, {_day("transaction_date")}, tier
        FROM txn JOIN tier_on_day USING (agent_id, transaction_date)""",
    "upsert": """
        SELECT o_orderkey, CASE WHEN o_orderkey % 10 = 0 THEN 'X' ELSE o_orderstatus END AS o_orderstatus,
               CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DOUBLE) AS o_totalprice
        FROM orders
        UNION ALL
        SELECT o_orderkey + 1000000000, o_orderstatus, CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DOUBLE)
        FROM orders WHERE o_orderkey % 100 = 1""",
    "scd2_changed_keys": "SELECT c_custkey FROM custchanged",
    "scd2_new_keys": "SELECT c_custkey, c_mktsegment FROM custnew",
    "scd2_seed": f"""
        SELECT {_SCD2_TYPED} FROM (
            SELECT *, DATE '1999-01-01' AS s, CAST(NULL AS DATE) AS e, true AS c FROM custupd)""",
    "scd2_merge": _SCD2,
    "scd2_merge_unbroadcast": _SCD2,
    "rate_lookup": f"""
        SELECT policy_id, product_id, tier_at_issue, {_money("base_commission_rate")},
               CAST(rate AS DOUBLE) AS new_business_rate FROM priced""",
    "new_business_commission": f"SELECT {_CALC} FROM nb",
    "renewal_schedule": f"""
        SELECT policy_id, CAST(r AS BIGINT) AS renewal_number, {_day("renewal_date")} FROM schedule""",
    "renewal_commission": f"SELECT {_CALC} FROM rn",
    "override_commission": f"SELECT {_CALC} FROM ov",
    "all_commission": f"""
        SELECT {_CALC} FROM (SELECT * FROM nb UNION ALL SELECT * FROM rn UNION ALL SELECT * FROM ov)""",
    "sales_unbroadcast": f"SELECT {_CALC} FROM (SELECT * FROM nb UNION ALL SELECT * FROM rn)",
    "override_unbroadcast": """
        SELECT 'OV-' || transaction_id AS transaction_id, upline_agent_id AS agent_id,
               p_type AS product_id,
               CAST(CAST(round(commission_amount * 0.10, 2) AS DECIMAL(18,2)) AS DOUBLE) AS commission_amount
        FROM txn JOIN agent USING (agent_id) LEFT JOIN part ON p_partkey = l_partkey
        WHERE upline_agent_id IS NOT NULL AND transaction_type IN ('New Business', 'Renewal')""",
    "chargeback_from_cancellation": f"""
        SELECT 'CB-' || policy_id AS chargeback_id, 'NB-' || policy_id AS original_transaction_id,
               policy_id, agent_id, CAST(cancel_date AS VARCHAR) AS chargeback_date,
               CAST(-abs(CAST(round(annual_premium * rate, 2) AS DECIMAL(18,2))) AS DOUBLE)
                   AS chargeback_amount
        FROM priced WHERE policy_status = 'Cancelled' AND cancel_date - issue_date <= 90""",
    "payment_run": f"SELECT {_PAY} FROM due",
    "eligible_agents": "SELECT agent_id, agent_status FROM agent WHERE agent_status <> 'Terminated'",
    "sale_window": """
        SELECT agent_id, CAST(CASE WHEN a < b THEN a ELSE DATE '2000-06-01' END AS VARCHAR) AS sale_window_start,
               CAST(CASE WHEN a < b THEN b ELSE DATE '2001-08-01' END AS VARCHAR) AS sale_window_end
        FROM (SELECT agent_id, greatest(DATE '2000-06-01', hire_date) AS a,
                     least(DATE '2001-08-01', coalesce(termination_date, DATE '2001-08-01')) AS b
              FROM agent)""",
    "sequence_ids": """
        SELECT o_orderkey, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS o_orderdate,
               'POL' || lpad(CAST(n AS VARCHAR), 7, '0') AS policy_id,
               'AUTO-' || lpad(CAST(n AS VARCHAR), 7, '0') AS policy_number
        FROM (SELECT *, row_number() OVER (ORDER BY CAST(o_orderdate AS DATE), o_orderkey) AS n FROM orders)""",
    "dq_not_null": f"""
        SELECT policy_id, CAST(load_seq AS BIGINT) AS load_seq, {_money("annual_premium")}
        FROM rawpol WHERE annual_premium IS NULL""",
    "dq_unique": f"""
        SELECT transaction_id, agent_id, {_money("commission_amount")} FROM txn
        WHERE transaction_id IN (SELECT transaction_id FROM txn GROUP BY 1 HAVING count(*) > 1)""",
    "dq_positive": f"""
        SELECT transaction_id, agent_id, {_money("commission_amount")} FROM txn
        WHERE commission_amount <= 0""",
    "dq_in_set": """
        SELECT transaction_id, transaction_type FROM txn
        WHERE transaction_type NOT IN ('New Business', 'Renewal')""",
    "dq_custom": """
        SELECT agent_id FROM tiers WHERE effective_end_date IS NOT NULL
        GROUP BY agent_id HAVING count(*) > 1""",
    "ref_integrity": """
        SELECT transaction_id, policy_id, agent_id FROM txn
        WHERE policy_id IS NOT NULL AND policy_id NOT IN (SELECT policy_id FROM policy)""",
    "dq_report": _REPORT,
    "dq_gate": f"""
        SELECT *, '2002-01-02T00:00:00' AS run_timestamp FROM ({_REPORT})
        WHERE table_name = 'fact_commission_transactions' AND NOT passed""",
    "dq_log_gate": f"SELECT * FROM ({_LOG}) WHERE NOT passed",
    "published_table": "SELECT o_orderkey, o_custkey, o_orderstatus FROM orders",
    "agent_commission_summary": f"""
        SELECT agent_id, pay_period, agent_name, agency_id, tier, agent_status,
               {_money("new_business_commission", "renewal_commission", "override_commission",
                       "gross_commission", "chargeback_deductions", "net_commission")}
        FROM summary""",
    "payment_run_summary": _PAYMENT_RUN,
    "chargeback_exposure": _EXPOSURE,
    "stored_payment_run": f"""
        SELECT row_number() OVER (ORDER BY pay_period NULLS FIRST, agency_id NULLS FIRST) AS place,
               pay_period, agency_id, total_net_paid, true AS in_order
        FROM ({_PAYMENT_RUN})""",
    "stored_exposure": f"""
        SELECT row_number() OVER (ORDER BY chargeback_rate DESC NULLS LAST, agent_id NULLS FIRST) AS place,
               agent_id, chargeback_rate, true AS in_order
        FROM ({_EXPOSURE})""",
    "agent_leaderboard": _LEADERBOARD,
    "agent_leaderboard_distributed": _LEADERBOARD,
    "reconciliation_report": _RECON,
    "reconciliation_unbroadcast": _RECON,
    "staged_rows": _staged_rows(),
    "staged_reconciliation": f"SELECT * REPLACE (CAST(agent_id AS VARCHAR) AS agent_id) FROM ({_RECON})",
    "reconciliation_headline": """
        SELECT count(*) FILTER (reconciliation_status = 'MATCHED') AS matched_periods,
               count(*) AS total_periods,
               count(*) FILTER (reconciliation_status <> 'MATCHED') AS break_periods
        FROM recon""",
    "extract_roundtrip": _MONTHLY,
    "incremental_ingest": _MONTHLY,
    "snapshot_roundtrip": """
        SELECT 'AGY' || lpad(CAST(c_custkey AS VARCHAR), 8, '0') AS agency_id, c_name AS agency_name,
               'Franchise' AS agency_type, c_mktsegment AS region
        FROM customer""",
    "ingest_lineage": """
        SELECT strftime(l_shipdate, '%Y-%m') AS folder, count(*) AS lines FROM lineitem GROUP BY 1""",
    "scd2_merged_table": f"SELECT * FROM ({_SCD2}) WHERE effective_end_date IS DISTINCT FROM '1996-06-30'",
    "merged_table": """
        SELECT o_orderkey, o_custkey, CASE WHEN o_orderkey % 7 = 0 THEN 'X' ELSE o_orderstatus END AS o_orderstatus
        FROM orders
        UNION ALL
        SELECT o_orderkey + 1000000000, o_custkey, o_orderstatus FROM orders WHERE o_orderkey % 50 = 1""",
}

ORACLE = {name: _sql(body) for name, body in _BODIES.items()}
