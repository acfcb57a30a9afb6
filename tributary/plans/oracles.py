"""The SQL each query is checked against, in DuckDB's dialect over the given tables.

``VIEWS`` restates the entity views and the shared tables in plain SQL; ``CHECKS`` holds
one statement per query key. A statement gets exactly the views it mentions, as CTEs.
"""

from __future__ import annotations

import re

from ..schemas import CONTRACTS, SERVING

VIEWS = {
    # ------------------------------------------------------------ source entities
    "card_bronze": """
        SELECT CAST(event_id AS VARCHAR) AS txn_id, ts AS txn_ts, event_type AS txn_type,
               CAST(value AS DECIMAL(18,2)) AS amount, 'MYR' AS currency,
               'C' || lpad(CAST(user_id AS VARCHAR), 8, '0') AS name_orig,
               CASE WHEN event_id % 4 = 0 THEN 'M' || lpad(CAST(event_id % 50 AS VARCHAR), 8, '0')
                    ELSE 'C' || lpad(CAST(user_id * 7 + event_id % 5 AS VARCHAR), 8, '0') END AS name_dest,
               event_type = 'error' AS is_fraud, event_type = 'error' AND value > 30 AS is_flagged_fraud,
               CAST(event_id % 1000 AS DECIMAL(18,2)) AS oldbalance,
               CAST(event_id % 1000 AS DECIMAL(18,2)) + CASE event_type WHEN 'purchase' THEN -CAST(value AS DECIMAL(18,2))
                    WHEN 'click' THEN 0 ELSE CAST(value AS DECIMAL(18,2)) END AS newbalance
        FROM events""",
    "trans": """
        SELECT CAST(o_orderkey AS VARCHAR) AS trans_id, CAST(o_custkey // 2 AS VARCHAR) AS account_id, o_orderdate AS date,
               CASE o_orderstatus WHEN 'P' THEN 'PRIJEM' WHEN 'O' THEN 'VYDAJ' ELSE 'VYBER' END AS type,
               CAST(o_totalprice AS DECIMAL(18,2)) AS amount, CAST(o_totalprice AS DECIMAL(18,2)) AS balance,
               CASE WHEN length(CAST(o_orderkey AS VARCHAR)) >= 4 THEN right(CAST(o_orderkey AS VARCHAR), 4) END AS partner_account,
               'CZK' AS currency
        FROM orders""",
    "application": """
        SELECT CAST(c_custkey AS VARCHAR) || CASE WHEN c_mktsegment = 'MACHINERY' THEN '-N' ELSE '' END AS sk_id_curr,
               CASE WHEN c_custkey % 12 = 1 THEN 1 ELSE 0 END AS target,
               CAST(c_acctbal AS DECIMAL(18,2)) AS amt_income_total, c_mktsegment AS name_income_type,
               TIMESTAMP '2024-01-01' + to_days(CAST(c_custkey % 180 AS INTEGER)) AS created_at,
               c_custkey % 50 = 0 AS is_deleted, 'unitless' AS currency
        FROM customer""",
    "previous_application": """
        SELECT CAST(o_orderkey AS VARCHAR) AS sk_id_prev, CAST(o_custkey AS VARCHAR) AS sk_id_curr,
               CASE o_orderstatus WHEN 'F' THEN 'Approved' WHEN 'O' THEN 'Refused' ELSE 'Canceled' END AS name_contract_status,
               CAST(CAST(o_orderdate AS DATE) - DATE '2002-01-01' AS BIGINT) AS days_decision
        FROM orders""",
    "installments_bronze": """
        SELECT CAST(l_orderkey AS VARCHAR) AS sk_id_prev, l_linenumber AS num_instalment_number,
               CAST(o_custkey AS VARCHAR) AS sk_id_curr,
               (CAST(o_orderdate AS DATE) - DATE '2002-01-01') + 60 AS days_instalment,
               CASE WHEN unpaid THEN NULL ELSE CAST(l_shipdate AS DATE) - DATE '2002-01-01' END AS days_entry_payment,
               price AS amt_instalment,
               CASE WHEN unpaid THEN NULL
                    ELSE CAST(price * CASE WHEN l_discount > 0.05 THEN 0.9 ELSE 1.0 END AS DECIMAL(18,2)) END AS amt_payment,
               l_shipdate AS updated_at, l_partkey, l_suppkey
        FROM (SELECT *, CAST(l_extendedprice AS DECIMAL(18,2)) AS price,
                     l_returnflag = 'N' AND l_linestatus = 'O' AND l_quantity < 10 AS unpaid
              FROM lineitem JOIN orders ON l_orderkey = o_orderkey)""",
    "installments_latest": """
        SELECT * EXCLUDE (rn), sk_id_curr NOT IN (SELECT sk_id_curr FROM application) AS orphan
        FROM (SELECT *, row_number() OVER (PARTITION BY sk_id_prev, num_instalment_number
                     ORDER BY updated_at DESC, l_partkey DESC, l_suppkey DESC, amt_instalment DESC) AS rn
              FROM installments_bronze) WHERE rn = 1""",
    "installments": "SELECT * FROM installments_latest WHERE NOT orphan",
    "card_balance_bronze": """
        SELECT CAST(l_orderkey AS VARCHAR) AS sk_id_prev, -l_linenumber AS months_balance, CAST(o_custkey AS VARCHAR) AS sk_id_curr,
               greatest(0, CAST(l_shipdate AS DATE) - CAST(o_orderdate AS DATE) - 60) AS sk_dpd,
               CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * (CAST(l_discount AS DECIMAL(4,2)) - 0.02) AS DECIMAL(18,2)) AS amt_balance,
               CAST(CASE WHEN l_quantity < 5 THEN 0 ELSE l_quantity * 1000 END AS DECIMAL(18,2)) AS amt_credit_limit_actual,
               l_shipdate AS updated_at, l_partkey, l_suppkey
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_returnflag = 'R'""",
    "card_balance": """
        SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY sk_id_prev, months_balance
                     ORDER BY updated_at DESC, l_partkey DESC, l_suppkey DESC, amt_balance DESC, amt_credit_limit_actual DESC) AS rn
              FROM card_balance_bronze) WHERE rn = 1 AND sk_id_curr IN (SELECT sk_id_curr FROM application)""",
    "pos_balance_bronze": """
        SELECT CAST(l_orderkey AS VARCHAR) AS sk_id_prev, -l_linenumber AS months_balance, CAST(o_custkey AS VARCHAR) AS sk_id_curr,
               greatest(0, CAST(l_shipdate AS DATE) - CAST(o_orderdate AS DATE) - 90) AS sk_dpd,
               l_shipdate AS updated_at, l_partkey, l_suppkey
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_returnflag = 'A'""",
    "pos_balance": """
        SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY sk_id_prev, months_balance
                     ORDER BY updated_at DESC, l_partkey DESC, l_suppkey DESC) AS rn
              FROM pos_balance_bronze) WHERE rn = 1 AND sk_id_curr IN (SELECT sk_id_curr FROM application)""",
    "client": """
        SELECT CAST(c_custkey AS VARCHAR) AS client_id, CAST(c_nationkey AS VARCHAR) AS district_id,
               CASE WHEN c_custkey % 97 = 0 THEN '7003' WHEN c_custkey % 89 = 0 THEN '70031X'
                    ELSE printf('%02d%02d%02d', c_custkey % 100, c_custkey % 13 + 1 + CASE WHEN c_custkey % 2 = 0 THEN 50 ELSE 0 END,
                                c_custkey % 31 + 1) END AS birth_number
        FROM customer""",
    "client_decoded": """
        SELECT client_id, district_id, born AS birth_date,
               CASE WHEN born IS NOT NULL THEN CASE WHEN mm > 50 THEN 'F' ELSE 'M' END END AS gender,
               CASE WHEN mm IS NULL THEN 'expected 6 digits' WHEN month NOT BETWEEN 1 AND 12 THEN 'month out of range'
                    WHEN born IS NULL THEN 'impossible calendar date' END AS error
        FROM (SELECT *, CASE WHEN month BETWEEN 1 AND 12
                        THEN TRY_CAST('19' || substr(birth_number, 1, 2) || '-' || lpad(CAST(month AS VARCHAR), 2, '0') || '-'
                                      || substr(birth_number, 5, 2) AS DATE) END AS born
              FROM (SELECT *, CASE WHEN mm > 50 THEN mm - 50 ELSE mm END AS month
                    FROM (SELECT *, CASE WHEN regexp_full_match(birth_number, '[0-9]{6}')
                                    THEN CAST(substr(birth_number, 3, 2) AS INTEGER) END AS mm FROM client)))""",
    "disp": """
        SELECT client_id || '-' || account_id AS disp_id, client_id, account_id, type FROM (
            SELECT CAST(c_custkey AS VARCHAR) AS client_id, CAST(c_custkey // 2 AS VARCHAR) AS account_id,
                   CASE WHEN c_custkey % 2 = 0 THEN 'OWNER' ELSE 'DISPONENT' END AS type FROM customer
            UNION ALL
            SELECT CAST(c_custkey AS VARCHAR), 'S' || CAST(c_custkey AS VARCHAR), 'OWNER' FROM customer
            WHERE c_mktsegment = 'HOUSEHOLD')""",
    "crm_case": """
        SELECT CAST(event_id AS VARCHAR) AS case_id, CAST(user_id AS VARCHAR) AS client_id, ts AS opened_at,
               CASE WHEN event_type = 'signup' THEN 'Fraud Follow-up' ELSE 'General Inquiry' END AS case_type
        FROM events WHERE event_type IN ('signup', 'view')""",
    "campaign_keyless": """
        SELECT c_custkey AS campaign_row, c_mktsegment AS job,
               CASE c_custkey % 3 WHEN 0 THEN 'single' WHEN 1 THEN 'married' ELSE 'divorced' END AS marital,
               CASE c_custkey % 4 WHEN 0 THEN 'primary' WHEN 1 THEN 'secondary' WHEN 2 THEN 'tertiary' ELSE 'unknown' END AS education,
               c_custkey % 10 = 1 AS credit_in_default, CAST(c_acctbal AS DECIMAL(18,2)) AS balance,
               CASE c_custkey % 4 WHEN 0 THEN 'success' WHEN 1 THEN 'failure' ELSE 'unknown' END AS poutcome,
               c_custkey % 9 = 2 AS subscribed, 'EUR' AS currency,
               TIMESTAMP '1998-01-01' + to_days(CAST(c_custkey % 730 AS INTEGER)) AS created_at
        FROM customer""",
    "change_log": """
        SELECT event_id AS seq, CASE event_type WHEN 'signup' THEN 'I' WHEN 'error' THEN 'D' ELSE 'U' END AS op,
               CAST(user_id AS VARCHAR) AS pk_value, ts AS changed_at, event_type AS label, value AS amount,
               strftime(ts, '%Y-%m-%d') AS dt
        FROM events""",
    "last_change": "SELECT * FROM change_log QUALIFY row_number() OVER (PARTITION BY pk_value ORDER BY seq DESC) = 1",
    "fx": """
        SELECT * FROM (VALUES ('MYR', 1.0000::DECIMAL(10,4), DATE '2026-07-05'), ('CZK', 0.2050, DATE '2026-07-05'),
                              ('EUR', 5.0000, DATE '2026-07-05'), ('unitless', NULL, DATE '2026-07-05'))
               AS t(currency_code, rate_to_myr, rate_as_of)""",
    # ------------------------------------------------------------ identity
    "card_ids": """
        SELECT DISTINCT name_id FROM (SELECT name_orig AS name_id FROM card_bronze UNION ALL SELECT name_dest FROM card_bronze)
        WHERE name_id LIKE 'C%'""",
    "anchor_pool": "SELECT 'CUST_' || sk_id_curr AS customer_id FROM application",
    "anchor_rank": """
        SELECT customer_id, row_number() OVER (ORDER BY md5('pool:berka|' || customer_id), customer_id) AS pos FROM anchor_pool""",
    "core_ids": """
        SELECT client_id AS k, CAST('0x' || substr(md5('overlap:berka|' || client_id), 1, 8) AS BIGINT) < 2147483648 AS taken,
               CAST('0x' || substr(md5('pick:berka|' || client_id), 1, 15) AS BIGINT) % (SELECT count(*) FROM anchor_pool) + 1 AS pos
        FROM client""",
    "core_map": """
        SELECT CASE WHEN taken THEN customer_id ELSE 'CUST_BK_' || k END AS customer_id, k
        FROM core_ids LEFT JOIN anchor_rank ON taken AND core_ids.pos = anchor_rank.pos""",
    "wide_pool": """
        SELECT customer_id FROM anchor_pool UNION ALL SELECT 'CUST_BK_' || k FROM core_ids WHERE NOT taken""",
    "wide_rank": """
        SELECT customer_id, row_number() OVER (ORDER BY md5('pool:paysim|' || customer_id), customer_id) AS pos FROM wide_pool""",
    "card_keys": """
        SELECT name_id AS k, CAST('0x' || substr(md5('overlap:paysim|' || name_id), 1, 8) AS BIGINT) < 1717986918 AS taken,
               CAST('0x' || substr(md5('pick:paysim|' || name_id), 1, 15) AS BIGINT) % (SELECT count(*) FROM wide_pool) + 1 AS pos
        FROM card_ids""",
    "xwalk": """
        SELECT 'CUST_' || sk_id_curr AS customer_id, 'home_credit' AS source_system, sk_id_curr AS native_key,
               3 AS source_priority_rank FROM application
        UNION ALL SELECT customer_id, 'berka', k, 1 FROM core_map
        UNION ALL
        SELECT CASE WHEN taken THEN customer_id ELSE 'CUST_PS_' || k END, 'paysim', k, 4
        FROM card_keys LEFT JOIN wide_rank ON taken AND card_keys.pos = wide_rank.pos""",
    "core_x": "SELECT native_key AS client_id, customer_id FROM xwalk WHERE source_system = 'berka'",
    "loan_x": "SELECT native_key AS sk_id_curr, customer_id FROM xwalk WHERE source_system = 'home_credit'",
    "card_x": "SELECT native_key AS name_orig, customer_id FROM xwalk WHERE source_system = 'paysim'",
    "old_core_x": "SELECT * FROM core_x WHERE customer_id NOT LIKE 'CUST!_BK!_%' ESCAPE '!'",
    "customers": "SELECT DISTINCT customer_id FROM xwalk",
    "linked": """
        SELECT campaign_row, customer_id FROM
            (SELECT campaign_row, row_number() OVER (
                ORDER BY md5('linkage:population|' || CAST(campaign_row AS VARCHAR)), campaign_row) AS pos FROM campaign_keyless)
            JOIN (SELECT customer_id, row_number() OVER (
                ORDER BY md5('linkage:customers|' || customer_id), customer_id) AS pos FROM customers) USING (pos)""",
    "campaign": "SELECT * FROM campaign_keyless JOIN linked USING (campaign_row)",
    # ------------------------------------------------------------ star
    "fact_txn": """
        SELECT txn_id, customer_id, txn_ts, txn_type, amount, currency, is_fraud, 'paysim' AS source_system,
               amount AS amount_myr
        FROM card_bronze LEFT JOIN card_x USING (name_orig)
        UNION ALL
        SELECT trans_id, customer_id, date, t.type, amount, currency, false, 'berka', amount * 0.205
        FROM trans t LEFT JOIN (SELECT * FROM disp WHERE type = 'OWNER') d USING (account_id) LEFT JOIN core_x USING (client_id)""",
    "fact_card_fraud": "SELECT * FROM fact_txn WHERE is_fraud",
    "fact_loan": "SELECT * FROM application LEFT JOIN loan_x USING (sk_id_curr)",
    "fact_crm_case": "SELECT case_id, customer_id, case_type, opened_at FROM crm_case LEFT JOIN core_x USING (client_id)",
    "bridge": "SELECT customer_id, account_id, type AS relation_type FROM disp LEFT JOIN core_x USING (client_id)",
    "balances": """
        SELECT account_id, balance AS current_balance, currency, balance * 0.205 AS current_balance_myr FROM trans
        QUALIFY row_number() OVER (PARTITION BY account_id ORDER BY date DESC, trans_id DESC) = 1""",
    "inst_agg": """
        SELECT sk_id_curr, count(*) AS installment_count,
               round(avg(CASE WHEN days_entry_payment IS NULL OR days_entry_payment > days_instalment THEN 1.0 ELSE 0 END), 9) AS late_payment_rate,
               round(avg(CASE WHEN amt_payment IS NULL OR amt_payment < amt_instalment THEN 1.0 ELSE 0 END), 9) AS underpayment_rate,
               round(avg(days_entry_payment - days_instalment) FILTER (days_entry_payment > days_instalment), 9) AS avg_days_late
        FROM installments GROUP BY sk_id_curr""",
    "card_agg": """
        SELECT sk_id_curr, count(*) FILTER (sk_dpd > 0) AS cc_months_dpd,
               round(CAST(sum(CAST(u AS DECIMAL(28,12))) AS DOUBLE) / count(u), 9) AS cc_avg_utilization,
               CAST(max(sk_dpd) AS BIGINT) AS cc_max_dpd
        FROM (SELECT *, CASE WHEN amt_credit_limit_actual = 0 THEN NULL
                             ELSE greatest(0, CAST(amt_balance AS DOUBLE) / CAST(amt_credit_limit_actual AS DOUBLE)) END AS u
              FROM card_balance) GROUP BY sk_id_curr""",
    "pos_agg": """
        SELECT sk_id_curr, count(*) FILTER (sk_dpd > 0) AS pos_months_dpd, CAST(max(sk_dpd) AS BIGINT) AS pos_max_dpd
        FROM pos_balance GROUP BY sk_id_curr""",
    "repayment": """
        SELECT customer_id, installment_count, late_payment_rate, underpayment_rate, avg_days_late, cc_months_dpd,
               cc_avg_utilization, pos_months_dpd,
               CASE WHEN cc_max_dpd IS NULL AND pos_max_dpd IS NULL THEN NULL
                    ELSE greatest(coalesce(cc_max_dpd, 0), coalesce(pos_max_dpd, 0)) END AS max_dpd
        FROM inst_agg FULL JOIN card_agg USING (sk_id_curr) FULL JOIN pos_agg USING (sk_id_curr) JOIN loan_x USING (sk_id_curr)""",
    "limits": """
        SELECT (SELECT quantile_disc(amt_income_total, 0.25) FROM fact_loan) AS income_p25,
               (SELECT quantile_disc(amt_income_total, 0.75) FROM fact_loan) AS income_p75,
               (SELECT quantile_disc(current_balance_myr, 0.5) FROM balances) AS balance_p50""",
    "banded": """
        SELECT *, CASE WHEN amt_income_total < (SELECT income_p25 FROM limits) THEN 'LOW'
                       WHEN amt_income_total > (SELECT income_p75 FROM limits) THEN 'HIGH' ELSE 'MEDIUM' END AS income_band
        FROM fact_loan""",
    "activity": """
        SELECT customer_id, max(txn_ts) AS last_txn_ts FROM fact_txn WHERE customer_id IS NOT NULL GROUP BY customer_id""",
    "overview": """
        SELECT customer_id, coalesce(n, 0) AS txn_count, coalesce(loans, 0) AS loan_count,
               CAST(coalesce(subscribed, false) AS BIGINT) AS has_term_deposit,
               coalesce(CAST(round(v, 2) AS DOUBLE), 0.0) AS total_txn_value,
               CAST(coalesce(n, 0) > 0 AS BIGINT) + CAST(coalesce(loans, 0) > 0 AS BIGINT)
                   + CAST(coalesce(subscribed, false) AS BIGINT) AS product_count
        FROM customers
        LEFT JOIN (SELECT customer_id, count(*) AS n, sum(amount_myr) AS v FROM fact_txn GROUP BY customer_id) USING (customer_id)
        LEFT JOIN (SELECT customer_id, count(*) AS loans FROM fact_loan GROUP BY customer_id) USING (customer_id)
        LEFT JOIN campaign USING (customer_id)""",
    "followup": """
        SELECT f.txn_id, f.customer_id, f.txn_ts, c.opened_at AS crm_last_touched,
               coalesce(c.opened_at >= f.txn_ts AND c.opened_at <= f.txn_ts + INTERVAL 48 HOUR, false) AS within_sla
        FROM fact_card_fraud f LEFT JOIN
             (SELECT customer_id, min(opened_at) AS opened_at FROM fact_crm_case WHERE case_type = 'Fraud Follow-up'
              GROUP BY customer_id) c ON f.customer_id = c.customer_id""",
    "targets": """
        SELECT b.customer_id, b.account_id, CAST(round(a.current_balance_myr, 6) AS DOUBLE) AS current_balance, last_txn_ts,
               poutcome AS prior_campaign_outcome, subscribed AS subscribed_term_deposit
        FROM bridge b JOIN balances a USING (account_id) LEFT JOIN activity USING (customer_id) LEFT JOIN campaign USING (customer_id)
        WHERE b.customer_id IS NOT NULL AND a.current_balance_myr >= (SELECT balance_p50 FROM limits)
          AND NOT EXISTS (SELECT 1 FROM fact_loan l WHERE l.customer_id = b.customer_id)
          AND NOT EXISTS (SELECT 1 FROM fact_txn t WHERE t.customer_id = b.customer_id AND t.source_system = 'paysim')""",
    "contacts": """
        SELECT CASE WHEN created_at < TIMESTAMP '1999-01-01' THEN 'cold' ELSE 'hot' END AS tier, job, education,
               poutcome AS prior_campaign_outcome, CAST(year(created_at) AS INTEGER) AS contact_year,
               CAST(week(created_at) AS INTEGER) AS contact_week, count(*) AS contact_count,
               round(CAST(sum(balance) AS DOUBLE) / count(balance), 6) AS avg_yearly_balance,
               count(*) FILTER (subscribed) AS subscribed_count
        FROM campaign_keyless GROUP BY ALL""",
    "damaged": """
        SELECT * FROM (VALUES ('2024-01-05', 'no success marker'), ('2024-01-09', 'checksum mismatch'), ('2024-01-13', 'schema drift'),
                              ('2024-01-17', 'schema drift'), ('2024-01-21', 'row count mismatch'), ('2024-01-25', 'no manifest'))
               AS t(dt, verdict)""",
    "content": """
        SELECT source_system, txn_type, count(*) AS txn_count, CAST(round(sum(amount), 2) AS DOUBLE) AS amount
        FROM fact_txn GROUP BY ALL""",
}

_EVENT_COLUMNS = "SELECT event_id, ts, user_id, value FROM events"
_OLD_CASES = """SELECT case_id, client_id, opened_at, case_type, coalesce(customer_id, '-1') AS customer_id
    FROM crm_case LEFT JOIN old_core_x USING (client_id)"""
_IDLE = "CAST(DATE '{d}' - CAST(last_txn_ts AS DATE) AS BIGINT)"

CHECKS = {
    # ------------------------------------------------------------ sources and sinks
    "incremental_pull_interval": _EVENT_COLUMNS + " WHERE ts > TIMESTAMP '2024-01-09 23:55:00' AND ts < TIMESTAMP '2024-01-11'",
    "incremental_pull_watermark": _EVENT_COLUMNS + """
        WHERE ts > (SELECT max(ts) FROM events WHERE ts < TIMESTAMP '2024-01-20') - INTERVAL 5 MINUTE""",
    "incremental_pull_full": "SELECT count(*) AS rows_pulled, max(o_orderdate) AS new_watermark FROM orders",
    "incremental_pull_projected": """
        SELECT event_id, user_id, ts FROM events
        WHERE event_type <> 'view' AND ts > TIMESTAMP '2024-01-05' AND ts < TIMESTAMP '2024-01-25'""",
    "cdc_poll": """
        SELECT seq, op, pk_value, changed_at FROM change_log
        WHERE seq > (SELECT max(event_id) FROM events WHERE ts < TIMESTAMP '2024-01-25')""",
    "initial_snapshot": """
        SELECT CAST(c_custkey AS VARCHAR) AS customer_key, c_mktsegment AS label, c_acctbal AS amount,
               true AS first_wrote, false AS second_wrote FROM customer""",
    "landing_scan": "SELECT dt, seq, op, pk_value, label, amount FROM change_log",
    "landing_write": """
        SELECT 'campaign' AS source, 'changes' AS table_name, dt, true AS has_success, count(*) AS row_count,
               min(seq) AS min_seq, max(seq) AS max_seq FROM change_log GROUP BY dt""",
    "delimited_scan": "SELECT * FROM customer",
    "bronze_append": """
        SELECT dt, count(*) AS row_count, count(DISTINCT copy) AS loads, CAST(round(sum(CAST(a AS DECIMAL(18,2))), 2) AS DOUBLE) AS amount
        FROM (SELECT dt, 1 AS copy, amount AS a FROM change_log
              UNION ALL SELECT dt, 2, amount + 1 FROM change_log WHERE dt = '2024-01-15') GROUP BY dt""",
    "scd1_overwrite": "SELECT * FROM customer",
    "partitioned_fact_write": """
        SELECT CAST(year(txn_ts) AS INTEGER) AS txn_year, CAST(month(txn_ts) AS INTEGER) AS txn_month, count(*) AS txn_count,
               CAST(round(sum(amount), 2) AS DOUBLE) AS amount FROM fact_txn GROUP BY ALL""",
    "upsert_single_key": """
        SELECT coalesce(l.pk_value, b.k) AS pk_value, coalesce(l.label, b.c_mktsegment) AS label,
               coalesce(l.amount, b.c_acctbal) AS amount, coalesce(l.changed_at, TIMESTAMP '2023-01-01') AS updated_at
        FROM (SELECT CAST(c_custkey AS VARCHAR) AS k, * FROM customer) b
        FULL JOIN (SELECT * FROM change_log QUALIFY row_number() OVER (PARTITION BY pk_value ORDER BY changed_at DESC) = 1) l
             ON b.k = l.pk_value""",
    "upsert_composite_key": """
        SELECT l_orderkey, l_linenumber, l_returnflag, l_extendedprice, l_partkey, l_shipdate AS updated_at FROM lineitem
        QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
            ORDER BY l_returnflag = 'R' DESC, l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_extendedprice DESC) = 1""",
    "quarantine_write": """
        SELECT CASE WHEN orphan THEN 'quarantined' ELSE 'clean' END AS outcome, CASE WHEN orphan THEN 'orphan' END AS reason,
               count(*) AS row_count, CAST(round(sum(amt_instalment), 2) AS DOUBLE) AS amount
        FROM installments_latest GROUP BY orphan""",
    "control_state_latest": """
        SELECT event_type AS key, CAST(event_id AS VARCHAR) AS value, ts AS written_at FROM events
        QUALIFY row_number() OVER (PARTITION BY event_type ORDER BY ts DESC, CAST(event_id AS VARCHAR) DESC) = 1""",
    "serving_view_typed": """
        SELECT customer_id, sk_id_curr, target, CAST(amt_income_total AS DOUBLE) AS amt_income_total, name_income_type, created_at
        FROM fact_loan""",
    # ------------------------------------------------------------ promotion
    "partition_verdicts": """
        SELECT dt, coalesce(any_value(verdict), 'promoted') AS verdict,
               count(*) FILTER (NOT (dt = '2024-01-21' AND op = 'D')) AS row_count
        FROM change_log LEFT JOIN damaged USING (dt) GROUP BY dt""",
    "payload_checksum": "SELECT DISTINCT dt, dt <> '2024-01-09' AS payload_intact FROM change_log",
    "rowcount_reconcile": """
        SELECT dt, promised AS rows_promised, found AS rows_found, promised = found AS reconciled
        FROM (SELECT dt, CASE WHEN dt <> '2024-01-25' THEN count(*) END AS promised,
                     count(*) FILTER (NOT (dt = '2024-01-21' AND op = 'D')) AS found FROM change_log GROUP BY dt)""",
    "schema_drift": """
        SELECT column_name, change, (SELECT count(*) FROM orders) AS rows_held_back
        FROM (VALUES ('o_orderpriority', 'removed'), ('o_channel', 'added'), ('o_totalprice', 'retyped')) AS t(column_name, change)""",
    "promote_landing": "SELECT seq, op, pk_value, label, amount, dt FROM change_log WHERE dt NOT IN (SELECT dt FROM damaged)",
    "pending_partitions": "SELECT dt, verdict <> 'no success marker' AS has_success FROM damaged",
    "redelivered_skip": """
        SELECT 'promoted' AS verdict, count(DISTINCT dt) AS drops, count(*) AS row_count FROM change_log
        UNION ALL SELECT 'redelivered', 2, 2 * count(*) FROM change_log WHERE dt = '2024-01-03'""",
    "redelivered_same_run": """
        SELECT dt, 'promoted' AS verdict, count(*) AS row_count FROM change_log GROUP BY dt
        UNION ALL SELECT '2024-02-02', 'redelivered', count(*) FROM change_log WHERE dt = '2024-01-03'""",
    "promote_bad_values": """
        SELECT dt, CASE dt WHEN '2024-01-05' THEN 'bad values' ELSE 'promoted' END AS verdict, count(*) AS row_count
        FROM change_log GROUP BY dt""",
    "promote_parquet_verdicts": """
        SELECT dt, CASE WHEN dt IN ('2024-01-05', '2024-01-08') THEN 'schema drift' ELSE 'promoted' END AS verdict,
               count(*) FILTER (dt NOT IN ('2024-01-05', '2024-01-08')) AS row_count
        FROM change_log GROUP BY dt""",
    "cdc_exactly_once": """
        SELECT 'campaign' AS source, 'changes' AS table_name, seq, op, pk_value, changed_at FROM change_log
        WHERE changed_at >= TIMESTAMP '2024-01-20'""",
    "extract_to_bronze": """
        SELECT event_id, ts, user_id, value, '2024-01-15' AS dt FROM events WHERE ts < TIMESTAMP '2024-01-15'
        UNION ALL SELECT event_id, ts, user_id, value, '2024-01-16' FROM events
        WHERE ts > (SELECT max(ts) FROM events WHERE ts < TIMESTAMP '2024-01-15') - INTERVAL 5 MINUTE""",
    "dq_suffix_leak": """
        SELECT 'card_txn' AS table_name, 'name_orig_masked' AS column_name, 0 AS leaked_values
        UNION ALL SELECT 'card_txn', 'hidden', 0
        UNION ALL SELECT 'card_txn_weak', 'hidden', 0
        UNION ALL SELECT 'card_txn_weak', 'name_orig_masked', count(DISTINCT right(name_orig, 6)) FROM card_bronze""",
    "promote_changes": "SELECT seq, op, pk_value, label, amount FROM change_log",
    "manifest_reconcile": """
        SELECT dt, CASE dt WHEN '2024-01-09' THEN 'paging not reconciled' WHEN '2024-01-21' THEN 'row count mismatch'
                   ELSE 'promoted' END AS verdict, count(*) AS row_count
        FROM change_log GROUP BY dt""",
    "promote_api_payload": """
        SELECT seq, op, pk_value, label, amount, dt FROM change_log WHERE dt NOT IN ('2024-01-09', '2024-01-21')""",
    "fileset_complete": """
        SELECT 's' || CAST(user_id % 10 AS VARCHAR) AS source, strftime(ts, '%Y-%m-%d') AS dt,
               count(DISTINCT event_type) FILTER (event_type IN ('signup', 'view', 'error')) AS tables_present,
               count(DISTINCT event_type) FILTER (event_type IN ('signup', 'view', 'error')) = 3 AS complete
        FROM events GROUP BY 1, 2""",
    # ------------------------------------------------------------ conforming
    "conform_project": """
        SELECT c_custkey AS client_id, c_name AS name, c_nationkey AS district_id, c_mktsegment AS segment FROM customer""",
    "conform_prune": """
        SELECT sk_id_curr, target, CAST(amt_income_total AS DOUBLE) AS amt_income_total, name_income_type, currency FROM application""",
    "conform_trans": """
        SELECT trans_id, account_id, date, type, CAST(amount AS DOUBLE) AS amount, CAST(balance AS DOUBLE) AS balance,
               partner_account, currency FROM trans""",
    "conform_card_txn": """
        SELECT txn_id, txn_ts, txn_type, CAST(amount AS DOUBLE) AS amount, currency, right(name_orig, 4) AS name_orig_masked,
               is_fraud, is_flagged_fraud, txn_ts AS created_at, txn_ts AS updated_at FROM card_bronze""",
    "conform_campaign": """
        SELECT campaign_row, job, marital, education, credit_in_default, CAST(balance AS DOUBLE) AS avg_yearly_balance,
               poutcome AS prior_campaign_outcome, subscribed AS subscribed_term_deposit, currency, created_at FROM campaign_keyless""",
    "mask_last4": """
        SELECT c_custkey, CAST(c_custkey AS VARCHAR) AS account_no, right(c_name, 4) AS c_name,
               CASE WHEN length(CAST(c_custkey AS VARCHAR)) >= 4 THEN right(CAST(c_custkey AS VARCHAR), 4) END AS account_no_last4
        FROM customer""",
    "birth_number_decode": "SELECT client_id, birth_date, gender, error FROM client_decoded",
    "birth_number_quarantine": "SELECT client_id, district_id, error AS reason FROM client_decoded WHERE error IS NOT NULL",
    "orphan_clean": "SELECT * FROM previous_application WHERE sk_id_curr IN (SELECT sk_id_curr FROM application)",
    "orphan_rejects": """
        SELECT *, 'orphan' AS reason FROM previous_application WHERE sk_id_curr NOT IN (SELECT sk_id_curr FROM application)""",
    "resolve_surrogate_ids": """
        SELECT case_id, opened_at, case_type, c.client_id FROM crm_case
        LEFT JOIN (SELECT CAST(c_custkey AS VARCHAR) AS client_id FROM customer) c USING (client_id)""",
    "flatten_nested_json": """
        SELECT CAST(event_id AS VARCHAR) AS transaction_id, CAST(user_id AS VARCHAR) AS account_id, event_type AS description,
               value AS amount, 'MYR' AS currency, CAST(regexp_extract(props, '[0-9]+') AS BIGINT) AS k FROM events""",
    "dedup_latest": """
        SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_shipdate AS updated_at FROM lineitem
        QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
            ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_extendedprice DESC) = 1""",
    "cdc_latest_state": "SELECT pk_value, seq, op, changed_at, label, amount FROM last_change WHERE op <> 'D'",
    "cdc_baseline_overlay": """
        SELECT CAST(c_custkey AS VARCHAR) AS customer_key, c_mktsegment AS label, c_acctbal AS amount FROM customer
        WHERE CAST(c_custkey AS VARCHAR) NOT IN (SELECT pk_value FROM change_log)
        UNION ALL SELECT pk_value, label, amount FROM last_change WHERE op <> 'D'""",
    "conform_table_spec": """
        SELECT 'trans' AS table_name, count(*) AS row_count, count(partner_account) AS masked_values, CAST(0 AS BIGINT) AS unmasked_values FROM trans
        UNION ALL SELECT 'previous', count(*), 0, 0 FROM previous_application""",
    "active_rows": """
        SELECT sk_id_curr, CAST(amt_income_total AS DOUBLE) AS amt_income_total, is_deleted FROM application WHERE NOT is_deleted""",
    # ------------------------------------------------------------ identity
    "build_crosswalk": "SELECT * FROM xwalk",
    "customer_identifiers": "SELECT * FROM card_ids",
    "crosswalk_summary": """
        SELECT 'rows:' || source_system AS metric, count(*) AS value FROM xwalk GROUP BY source_system
        UNION ALL SELECT 'customers', count(DISTINCT customer_id) FROM xwalk
        UNION ALL SELECT 'multi_source_customers', count(*) FROM
            (SELECT customer_id FROM xwalk GROUP BY customer_id HAVING count(DISTINCT source_system) > 1)""",
    "resolve_identity": "SELECT case_id, client_id, opened_at, case_type, customer_id FROM crm_case LEFT JOIN core_x USING (client_id)",
    "resolve_identity_private": """
        SELECT txn_id, txn_type, right(name_orig, 4) AS name_orig_masked, customer_id FROM card_bronze LEFT JOIN card_x USING (name_orig)""",
    "dim_customer": """
        SELECT customer_id, source_priority_rank, birth_date, gender, district_id FROM customers LEFT JOIN (
            SELECT * FROM (
                SELECT customer_id, 1 AS source_priority_rank, x.client_id AS native_key, birth_date, gender, district_id
                FROM core_x x LEFT JOIN (SELECT * FROM client_decoded WHERE error IS NULL) USING (client_id)
                UNION ALL SELECT customer_id, 3, sk_id_curr, NULL, NULL, NULL FROM loan_x)
            QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY source_priority_rank, native_key) = 1) USING (customer_id)""",
    "bridge_customer_account": "SELECT * FROM bridge",
    "sampled_linkage": "SELECT * FROM linked",
    "unknown_member": f"SELECT customer_id, count(*) AS cases FROM ({_OLD_CASES}) GROUP BY customer_id",
    "relink_unknown": "SELECT case_id, client_id, coalesce(customer_id, '-1') AS customer_id FROM crm_case LEFT JOIN core_x USING (client_id)",
    "erase_customers": """
        WITH gone AS (SELECT DISTINCT customer_id FROM fact_loan WHERE target = 1),
        left_accounts AS (SELECT account_id FROM bridge LEFT JOIN gone USING (customer_id)
                          GROUP BY account_id HAVING count(*) FILTER (gone.customer_id IS NULL) = 0),
        tables AS (SELECT 'dim_customer_xwalk' AS table_name, customer_id FROM xwalk UNION ALL SELECT 'dim_customer', customer_id FROM customers
                   UNION ALL SELECT 'fact_txn', customer_id FROM fact_txn UNION ALL SELECT 'fact_card_fraud', customer_id FROM fact_card_fraud
                   UNION ALL SELECT 'fact_loan_application', customer_id FROM fact_loan
                   UNION ALL SELECT 'fact_previous_application', customer_id FROM previous_application LEFT JOIN loan_x USING (sk_id_curr)
                   UNION ALL SELECT 'fact_crm_case', customer_id FROM fact_crm_case UNION ALL SELECT 'dim_campaign_response', customer_id FROM campaign
                   UNION ALL SELECT 'fact_repayment_behavior', customer_id FROM repayment
                   UNION ALL SELECT 'bridge_customer_account', customer_id FROM bridge)
        SELECT table_name, count(*) AS rows_before,
               count(*) FILTER (customer_id IS NULL OR customer_id NOT IN (SELECT customer_id FROM gone)) AS rows_after,
               CAST(0 AS BIGINT) AS rows_of_erased FROM tables GROUP BY table_name
        UNION ALL
        SELECT 'fact_account_balance', count(*), count(*) FILTER (account_id NOT IN (SELECT account_id FROM left_accounts)), 0 FROM balances""",
    "relink_facts": """
        SELECT source_system || '|' || txn_id AS row_id, coalesce(customer_id, '-1') AS customer_id FROM fact_txn
        UNION ALL SELECT 'case|' || case_id, coalesce(customer_id, '-1') FROM fact_crm_case""",
    # ------------------------------------------------------------ dimensions and facts
    "dim_date": """
        SELECT CAST(d AS DATE) AS date_key, CAST(year(d) AS INTEGER) AS year, CAST(month(d) AS INTEGER) AS month,
               CAST(day(d) AS INTEGER) AS day, monthname(d) AS month_name, dayname(d) AS day_of_week
        FROM (SELECT unnest(generate_series((SELECT CAST(min(o_orderdate) AS DATE) FROM orders),
                                            (SELECT CAST(max(ts) AS DATE) FROM events), INTERVAL 1 DAY)) AS d)""",
    "dim_fx_rate": """
        SELECT currency_code, CAST(rate_to_myr AS DOUBLE) AS rate_to_myr, rate_as_of,
               CASE currency_code WHEN 'MYR' THEN (SELECT count(*) FROM card_bronze) WHEN 'CZK' THEN (SELECT count(*) FROM trans)
                    WHEN 'EUR' THEN (SELECT count(*) FROM campaign_keyless) ELSE (SELECT count(*) FROM application) END AS tagged_rows
        FROM fx""",
    "to_reporting_currency": """
        SELECT row_id, CAST(amount AS DOUBLE) AS amount, currency, CAST(amount * rate_to_myr AS DOUBLE) AS amount_myr
        FROM (SELECT 'c' || CAST(campaign_row AS VARCHAR) AS row_id, balance AS amount, currency FROM campaign_keyless
              UNION ALL SELECT 't' || trans_id, amount, currency FROM trans
              UNION ALL SELECT 'a' || sk_id_curr, amt_income_total, currency FROM application)
        LEFT JOIN fx ON currency = currency_code""",
    "fact_account_balance": """
        SELECT account_id, CAST(current_balance AS DOUBLE) AS current_balance, currency,
               CAST(current_balance_myr AS DOUBLE) AS current_balance_myr FROM balances""",
    "dim_campaign_response": """
        SELECT customer_id, job, marital, education, credit_in_default, CAST(balance AS DOUBLE) AS avg_yearly_balance,
               poutcome AS prior_campaign_outcome, subscribed AS subscribed_term_deposit FROM campaign""",
    "fact_txn": """
        SELECT txn_id, customer_id, txn_ts, txn_type, CAST(amount AS DOUBLE) AS amount, currency, is_fraud, source_system,
               CAST(amount_myr AS DOUBLE) AS amount_myr, CAST(year(txn_ts) AS INTEGER) AS txn_year,
               CAST(month(txn_ts) AS INTEGER) AS txn_month FROM fact_txn""",
    "fact_card_fraud": """
        SELECT txn_id, customer_id, txn_ts, txn_type, CAST(amount AS DOUBLE) AS amount, currency, CAST(amount_myr AS DOUBLE) AS amount_myr,
               CAST(year(txn_ts) AS INTEGER) AS txn_year, CAST(month(txn_ts) AS INTEGER) AS txn_month FROM fact_card_fraud""",
    "fact_loan_application": """
        SELECT customer_id, sk_id_curr, target, CAST(amt_income_total AS DOUBLE) AS amt_income_total, name_income_type, created_at
        FROM fact_loan""",
    "fact_previous_application": """
        SELECT sk_id_prev, customer_id, sk_id_curr, name_contract_status, days_decision
        FROM previous_application LEFT JOIN loan_x USING (sk_id_curr)""",
    "fact_crm_case": "SELECT * FROM fact_crm_case",
    "installment_behavior": "SELECT * FROM inst_agg",
    "card_utilization": "SELECT * FROM card_agg",
    "pos_dpd": "SELECT * FROM pos_agg",
    "fact_repayment_behavior": "SELECT * FROM repayment",
    # ------------------------------------------------------------ marts
    "customer_360": "SELECT * FROM overview",
    "fraud_daily": """
        SELECT CAST(txn_ts AS DATE) AS txn_date, txn_type, count(*) AS fraud_txn_count,
               CAST(round(sum(amount), 2) AS DOUBLE) AS fraud_txn_value FROM fact_card_fraud GROUP BY ALL""",
    "fraud_mom": """
        WITH monthly AS (
            SELECT CAST(date_trunc('month', txn_ts) AS DATE) AS txn_month, txn_type, count(*) AS n, sum(amount) AS v
            FROM fact_card_fraud GROUP BY ALL)
        SELECT txn_month, txn_type, coalesce(m.n, 0) AS fraud_txn_count, CAST(round(coalesce(m.v, 0), 2) AS DOUBLE) AS fraud_txn_value,
               coalesce(p.n, 0) AS prior_count, CAST(round(coalesce(p.v, 0), 2) AS DOUBLE) AS prior_value,
               coalesce(m.n, 0) - coalesce(p.n, 0) AS count_delta,
               CAST(round(coalesce(m.v, 0) - coalesce(p.v, 0), 2) AS DOUBLE) AS value_delta
        FROM monthly m FULL JOIN (SELECT CAST(txn_month + INTERVAL 1 MONTH AS DATE) AS txn_month, txn_type, n, v FROM monthly
                                  WHERE txn_month < (SELECT max(txn_month) FROM monthly)) p USING (txn_month, txn_type)""",
    "fraud_followup_events": "SELECT * FROM followup",
    "fraud_followup": """
        SELECT count(*) AS fraud_event_count, count(*) FILTER (within_sla) AS within_sla_count,
               round(CAST(count(*) FILTER (within_sla) * 100 AS DOUBLE) / count(*), 9) AS within_sla_pct FROM followup""",
    "loan_funnel": """
        WITH apps AS (SELECT sk_id_curr, strftime(created_at, '%Y-%m') AS app_month FROM fact_loan),
        approvals AS (
            SELECT app_month, round(CAST(count(*) FILTER (name_contract_status = 'Approved') * 100 AS DOUBLE) / count(*), 9) AS approval_rate_pct,
                   round(CAST(sum(abs(days_decision)) AS DOUBLE) / count(days_decision), 9) AS avg_days_to_decision
            FROM previous_application JOIN apps USING (sk_id_curr) GROUP BY app_month)
        SELECT app_month, application_count, approval_rate_pct, avg_days_to_decision
        FROM (SELECT app_month, count(*) AS application_count FROM apps GROUP BY app_month) LEFT JOIN approvals USING (app_month)""",
    "segment_thresholds": """
        SELECT CAST(income_p25 AS DOUBLE) AS income_p25, CAST(income_p75 AS DOUBLE) AS income_p75,
               CAST(balance_p50 AS DOUBLE) AS balance_p50 FROM limits""",
    "risk_segment": """
        SELECT customer_id, income_band, name_income_type, count(*) FILTER (target = 1) AS is_default,
               count(*) FILTER (credit_in_default IS NOT NULL AND (target = 1) <> credit_in_default) AS default_signal_disagreement
        FROM banded LEFT JOIN (SELECT customer_id, credit_in_default FROM campaign) USING (customer_id)
        GROUP BY customer_id, income_band, name_income_type""",
    "default_rate_by_segment": """
        SELECT income_band, name_income_type, count(*) AS applications, round(avg(target), 9) AS default_rate FROM banded GROUP BY ALL""",
    "active_high_risk": f"""
        SELECT customer_id, sk_id_curr, income_band, name_income_type, last_txn_ts FROM banded JOIN activity USING (customer_id)
        WHERE target = 1 AND {_IDLE.format(d='2024-01-31')} BETWEEN 0 AND 89""",
    "cross_sell": "SELECT * FROM targets",
    "cross_sell_ranked": f"""
        SELECT *, CASE prior_campaign_outcome WHEN 'success' THEN 1 WHEN 'unknown' THEN 2 WHEN 'failure' THEN 3 ELSE 4 END AS response_rank
        FROM targets WHERE {_IDLE.format(d='2001-08-01')} BETWEEN 0 AND 89""",
    "dormancy": f"""
        SELECT customer_id, '2024-01' AS as_of_month, last_txn_ts, {_IDLE.format(d='2024-01-31')} AS days_since_last_txn
        FROM customers LEFT JOIN activity USING (customer_id)
        WHERE last_txn_ts IS NULL OR {_IDLE.format(d='2024-01-31')} >= 90""",
    "daily_flows": """
        SELECT txn_date, CAST(round(i, 2) AS DOUBLE) AS total_in, CAST(round(o, 2) AS DOUBLE) AS total_out,
               CAST(round(i - o, 2) AS DOUBLE) AS net_flow,
               (SELECT CAST(round(sum(current_balance_myr), 2) AS DOUBLE) FROM balances) AS total_deposits_snapshot
        FROM (SELECT CAST(txn_ts AS DATE) AS txn_date, sum(CASE WHEN txn_type = 'PRIJEM' THEN amount_myr ELSE 0 END) AS i,
                     sum(CASE WHEN txn_type = 'PRIJEM' THEN 0 ELSE amount_myr END) AS o FROM fact_txn GROUP BY 1)""",
    "daily_flows_pivot": """
        SELECT txn_date, CAST(round(i, 2) AS DOUBLE) AS total_in, CAST(round(o, 2) AS DOUBLE) AS total_out,
               CAST(round(coalesce(i, 0) - coalesce(o, 0), 2) AS DOUBLE) AS net_flow
        FROM (SELECT CAST(txn_ts AS DATE) AS txn_date, sum(amount_myr) FILTER (txn_type = 'PRIJEM') AS i,
                     sum(amount_myr) FILTER (txn_type <> 'PRIJEM') AS o FROM fact_txn GROUP BY 1)""",
    "spending_distribution": """
        SELECT txn_type, coalesce(income_band, 'NONE') AS segment, strftime(txn_ts, '%Y-%m') AS txn_month, count(*) AS txn_count,
               CAST(round(sum(amount_myr), 2) AS DOUBLE) AS txn_value
        FROM fact_txn LEFT JOIN (SELECT customer_id, income_band FROM banded) USING (customer_id) GROUP BY 1, 2, 3""",
    "source_health": """
        SELECT table_name, b AS bronze_row_count, s AS silver_row_count, CAST(mark AS VARCHAR) AS last_watermark, s <= b AS reconciled,
               'success' AS stage_status, 'run-1' AS run_id
        FROM (SELECT 'installments' AS table_name, count(*) AS b, (SELECT count(*) FROM installments) AS s, max(updated_at) AS mark
              FROM installments_bronze
              UNION ALL SELECT 'card_balance', count(*), (SELECT count(*) FROM card_balance), max(updated_at) FROM card_balance_bronze
              UNION ALL SELECT 'campaign', count(*), (SELECT count(*) FROM campaign), max(created_at) FROM campaign_keyless)""",
    "repayment_risk": "SELECT r.*, target AS target_default FROM repayment r JOIN fact_loan USING (customer_id)",
    "repayment_signal": """
        SELECT target AS target_default, count(*) AS customers,
               round(CAST(sum(CAST(late_payment_rate AS DECIMAL(28,9))) AS DOUBLE) / count(late_payment_rate), 6) AS late_payment_rate,
               round(CAST(sum(CAST(underpayment_rate AS DECIMAL(28,9))) AS DOUBLE) / count(underpayment_rate), 6) AS underpayment_rate,
               round(CAST(sum(CAST(cc_avg_utilization AS DECIMAL(28,9))) AS DOUBLE) / count(cc_avg_utilization), 6) AS cc_avg_utilization,
               round(CAST(sum(max_dpd) AS DOUBLE) / count(max_dpd), 6) AS max_dpd
        FROM repayment JOIN fact_loan USING (customer_id) GROUP BY target""",
    "cold_tier_aggregate": "SELECT * EXCLUDE (tier) FROM contacts WHERE tier = 'cold'",
    "hot_cold_union": "SELECT * FROM contacts",
    "topk_customers": "SELECT * FROM overview ORDER BY total_txn_value DESC, customer_id LIMIT 20",
    # ------------------------------------------------------------ quality
    "dq_currency_tags": """
        SELECT 'card_txn' AS table_name, 'amount' AS money_column, CAST(0 AS BIGINT) AS untagged UNION ALL SELECT 'card_txn', 'newbalance', 0
        UNION ALL SELECT 'trans', 'amount', count(*) FROM trans WHERE type = 'VYBER'
        UNION ALL SELECT 'trans', 'balance', count(*) FROM trans WHERE type = 'VYBER'
        UNION ALL SELECT 'application', 'amt_income_total', 0
        UNION ALL SELECT 'baseline', 'amount', count(*) FROM customer""",
    "dq_not_null": """
        SELECT 'installments' AS table_name, column_name, nulls FROM (
            SELECT unnest(['sk_id_prev', 'sk_id_curr', 'days_entry_payment', 'amt_payment']) AS column_name,
                   unnest([count(*) - count(sk_id_prev), count(*) - count(sk_id_curr), count(*) - count(days_entry_payment),
                           count(*) - count(amt_payment)]) AS nulls FROM installments_bronze)
        UNION ALL SELECT 'fact_txn', column_name, nulls FROM (
            SELECT unnest(['txn_id', 'customer_id', 'amount_myr']) AS column_name,
                   unnest([count(*) - count(txn_id), count(*) - count(customer_id), count(*) - count(amount_myr)]) AS nulls FROM fact_txn)""",
    "dq_unique": """
        SELECT 'lineitem' AS table_name, 'l_orderkey,l_linenumber' AS key_columns, count(*) AS duplicate_keys,
               CAST(coalesce(sum(n - 1), 0) AS BIGINT) AS surplus_rows
        FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1)
        UNION ALL SELECT 'fact_txn', 'source_system,txn_id', count(*), CAST(coalesce(sum(n - 1), 0) AS BIGINT)
        FROM (SELECT count(*) AS n FROM fact_txn GROUP BY source_system, txn_id HAVING count(*) > 1)
        UNION ALL SELECT 'bridge', 'account_id', count(*), CAST(coalesce(sum(n - 1), 0) AS BIGINT)
        FROM (SELECT count(*) AS n FROM bridge GROUP BY account_id HAVING count(*) > 1)""",
    "dq_reconcile": """
        SELECT *, silver_row_count <= bronze_row_count AS reconciled FROM (
            SELECT 'installments' AS table_name, (SELECT count(*) FROM installments_bronze) AS bronze_row_count,
                   (SELECT count(*) FROM installments) AS silver_row_count
            UNION ALL SELECT 'pos_balance', (SELECT count(*) FROM pos_balance_bronze), (SELECT count(*) FROM pos_balance))""",
    "dq_null_rate": """
        SELECT 'installments' AS table_name, column_name, round(rate, 9) AS null_rate,
               CASE WHEN round(rate, 9) > 0.5 THEN 'BLOCK' WHEN round(rate, 9) > 0.01 THEN 'WARN' ELSE 'OK' END AS verdict
        FROM (SELECT unnest(['sk_id_prev', 'days_entry_payment', 'amt_payment', 'amt_instalment']) AS column_name,
                     unnest([1 - count(sk_id_prev) / count(*), CAST(count(*) - count(days_entry_payment) AS DOUBLE) / count(*),
                             CAST(count(*) - count(amt_payment) AS DOUBLE) / count(*), 1 - count(amt_instalment) / count(*)]) AS rate
              FROM installments_bronze)""",
    "dq_null_rate_scoped": """
        SELECT 'card_txn' AS table_name, unnest(['dest_balance', 'amount']) AS column_name,
               unnest([1 - count(newbalance) / count(*), 1 - count(amount) / count(*)]) AS null_rate, 'OK' AS verdict
        FROM card_bronze WHERE name_dest NOT LIKE 'M%'""",
    "dq_balance_reconcile": """
        SELECT txn_type AS type, count(*) AS rows_checked,
               count(*) FILTER (oldbalance + CASE WHEN txn_type = 'purchase' THEN -amount ELSE amount END <> newbalance) AS mismatches
        FROM card_bronze GROUP BY txn_type""",
    "dq_encoding": """
        SELECT unnest(['text', 'lang', 'source']) AS column_name, count(*) AS rows_checked,
               unnest([count(*) FILTER (contains(text, chr(65533))), count(*) FILTER (contains(lang, chr(65533))),
                       count(*) FILTER (contains(source, chr(65533)))]) AS bad_values FROM documents""",
    "dq_linkage_coverage": """
        SELECT count(*) AS customers, count(campaign_row) AS linked, round(CAST(count(campaign_row) AS DOUBLE) / count(*), 9) AS coverage
        FROM customers LEFT JOIN linked USING (customer_id)""",
    "dq_disagreement": """
        SELECT count(*) AS compared, count(*) FILTER ((target = 1) <> credit_in_default) AS disagreements,
               round(CAST(count(*) FILTER ((target = 1) <> credit_in_default) AS DOUBLE) / count(*), 9) AS disagreement_rate
        FROM fact_loan JOIN campaign USING (customer_id)""",
    "dq_unknown_growth": f"""
        SELECT *, CASE WHEN unknown_rows > previous_unknown THEN 'WARN' ELSE 'OK' END AS verdict FROM (
            SELECT *, lag(unknown_rows) OVER (PARTITION BY case_type ORDER BY run_date) AS previous_unknown FROM (
                SELECT CAST(opened_at AS DATE) AS run_date, case_type, count(*) FILTER (customer_id = '-1') AS unknown_rows
                FROM ({_OLD_CASES}) GROUP BY ALL))""",
    "dq_grain": """
        SELECT table_name, row_count, key_count, round(CAST(row_count AS DOUBLE) / key_count, 9) AS fan_out FROM (
            SELECT 'fact_txn' AS table_name, count(*) AS row_count, count(DISTINCT (source_system, txn_id)) AS key_count FROM fact_txn
            UNION ALL SELECT 'crosswalk', count(*), count(DISTINCT (source_system, customer_id)) FROM xwalk
            UNION ALL SELECT 'bridge', count(*), count(DISTINCT customer_id) FROM bridge
            UNION ALL SELECT 'repayment', count(*), count(DISTINCT customer_id) FROM repayment)""",
    "dq_no_raw_identifier": """
        SELECT 'card_txn' AS table_name, unnest(['txn_type', 'name_orig_masked', 'currency']) AS column_name,
               unnest([count(*) FILTER (txn_type IN (SELECT name_orig FROM card_bronze)),
                       count(*) FILTER (right(name_orig, 4) IN (SELECT name_orig FROM card_bronze)),
                       count(*) FILTER (currency IN (SELECT name_orig FROM card_bronze))]) AS leaked_values FROM card_bronze""",
    # ------------------------------------------------------------ maintenance
    "compact_table": "SELECT *, true AS rewritten, false AS rewritten_again FROM content",
    "cluster_table": "SELECT * FROM content",
    "cluster_table_multi": "SELECT * FROM content",
    "compact_bronze": """
        SELECT dt, lpad(CAST(CAST(substr(dt, 9, 2) AS INTEGER) AS VARCHAR), 8, '0') || 'e001' AS load_id, count(*) AS row_count,
               CAST(sum(seq) AS BIGINT) AS seq_sum FROM change_log GROUP BY dt""",
    "expire_landing": """
        SELECT DISTINCT dt FROM change_log WHERE dt >= '2024-01-24' OR dt IN (SELECT dt FROM damaged)""",
    # ------------------------------------------------------------ preparation
    "date_rebase": """
        SELECT o_orderkey, CAST(o_orderdate AS DATE) AS order_date,
               CAST(o_orderdate AS DATE) + CAST(DATE '2026-07-05' - (SELECT CAST(max(o_orderdate) AS DATE) FROM orders) AS INTEGER) AS rebased_date
        FROM orders""",
    "step_to_timestamp": "SELECT event_id, TIMESTAMP '2026-06-01' + to_hours(event_id % 744 + 1) AS txn_ts FROM events",
    "stable_row_id": """
        SELECT event_id, substr(d, 1, 8) || '-' || substr(d, 9, 4) || '-5' || substr(d, 14, 3) || '-'
               || substr('89ab', CAST('0x' || substr(d, 17, 1) AS INTEGER) % 4 + 1, 1) || substr(d, 18, 3) || '-' || substr(d, 21, 12) AS row_id
        FROM (SELECT event_id, sha1(unhex('6ba7b8109dad11d180b400c04fd430c8') || encode('events|' || CAST(event_id AS VARCHAR))) AS d FROM events)""",
    "audit_stamp": """
        SELECT o_orderkey, o_totalprice, TIMESTAMP '2026-07-05' AS created_at, TIMESTAMP '2026-07-05' AS updated_at,
               false AS is_deleted, 'CZK' AS currency FROM orders""",
    "hash_sample": """
        SELECT o_orderkey, o_custkey FROM orders
        ORDER BY md5('prepare.orders|' || CAST(o_orderkey AS VARCHAR)), o_orderkey LIMIT 1000""",
    "capped_group_sample": """
        SELECT account_id, trans_id FROM trans
        QUALIFY row_number() OVER (PARTITION BY account_id ORDER BY md5('prepare.trans|' || trans_id), trans_id) <= 3""",
    "coordinated_sample": """
        WITH kept AS (SELECT account_id FROM (SELECT DISTINCT account_id FROM disp)
                      ORDER BY md5('prepare.account|' || account_id), account_id LIMIT 50)
        SELECT 'account' AS table_name, account_id AS key FROM kept
        UNION ALL SELECT 'disp', disp_id FROM disp WHERE account_id IN (SELECT account_id FROM kept)
        UNION ALL SELECT 'client', client_id FROM client
                  WHERE client_id IN (SELECT client_id FROM disp WHERE account_id IN (SELECT account_id FROM kept))
        UNION ALL SELECT 'trans', trans_id FROM trans WHERE account_id IN (SELECT account_id FROM kept)""",
    "primary_link": """
        SELECT client_id, account_id, type, CASE WHEN row_number() OVER (
                   PARTITION BY client_id ORDER BY type = 'OWNER' DESC, account_id) = 1 THEN 'primary' ELSE 'secondary' END AS link
        FROM disp""",
    # ------------------------------------------------------------ streaming
    "stream_promote": "SELECT seq, op, pk_value, label, amount FROM change_log",
    "stream_dedup": "SELECT seq, op, pk_value FROM change_log",
    "stream_latest_state": "SELECT pk_value, seq, op, label, amount FROM last_change WHERE op <> 'D'",
    "stream_fraud_window": """
        SELECT date_trunc('hour', txn_ts) AS window_start, count(*) AS txn_count, count(*) FILTER (is_fraud) AS fraud_count
        FROM card_bronze GROUP BY 1
        HAVING date_trunc('hour', txn_ts) + INTERVAL 1 HOUR <= (SELECT max(ts) FROM events) - INTERVAL 5 MINUTE""",
}


def _mentioned(sql: str) -> set[str]:
    return set(re.findall(r"[a-z_0-9]+", sql)) & set(VIEWS)


def _needed(sql: str) -> list[str]:
    found: set[str] = set()
    waiting = _mentioned(sql)
    while waiting:
        found |= waiting
        waiting = set().union(*[_mentioned(VIEWS[v]) for v in waiting]) - found
    return [v for v in VIEWS if v in found]

# Gold tables under the names of their contracts, by the statement that yields each.
GOLD = {name: CHECKS["build_crosswalk" if name == "dim_customer_xwalk" else name] for name in SERVING} | {
    "dim_fx_rate": "SELECT currency_code, rate_to_myr, rate_as_of, 'rate' AS note FROM fx"
}
CHECKS["seed_fx_rates"] = CHECKS["dim_fx_rate"]
CHECKS["incremental_facts"] = CHECKS["fact_txn"]
CHECKS["stream_windows_with_late"] = """
    SELECT date_trunc('hour', txn_ts) AS window_start, CAST(count(*) AS BIGINT) AS txn_count, count(*) FILTER (is_fraud) AS fraud_count
    FROM card_bronze GROUP BY 1"""
CHECKS["serving_views_all"] = " UNION ALL ".join(
    f"SELECT '{name}' AS table_name, '{c}' AS column_name, count(*) AS row_count, count({c}) AS non_null FROM ({GOLD[name]})"
    for name, view in SERVING.items() for c in view.names
)
CHECKS["dq_contracts"] = " UNION ALL ".join(
    [
        f"SELECT '{name}' AS table_name, 'not_null:{c}' AS clause, count(*) FILTER ({c} IS NULL) AS broken_rows FROM ({GOLD[name]})"
        for name in SERVING for c in CONTRACTS[name].required
    ]
    + [
        f"SELECT '{name}', 'unique:{key}', CAST(coalesce(sum(n - 1), 0) AS BIGINT) FROM (SELECT count(*) AS n FROM ({GOLD[name]}) GROUP BY {key})"
        for name in SERVING if (key := ",".join(CONTRACTS[name].key))
    ]
)



def statement(key: str) -> str:
    body = CHECKS[key].strip()
    views = [f"{name} AS ({VIEWS[name].strip()})" for name in _needed(body)]
    if body.startswith("WITH "):
        body = body[len("WITH "):]
        return "WITH " + ",\n".join([*views, body])
    return ("WITH " + ",\n".join(views) + "\n" if views else "") + body


def statements() -> dict[str, str]:
    return {key: statement(key) for key in CHECKS}
