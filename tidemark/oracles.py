"""SQL of the ledger queries, in DuckDB's dialect, on the same benchmark tables."""

from __future__ import annotations

from tidemark.plans.registry import METRICS
from tidemark.plans.warehouse import FUNNEL
from tidemark.sources.ledger import ZERO_ADDRESS as ZERO

#: Views that queries share: name -> SQL. Each may use those before it.
VIEWS = {
    "ev": """SELECT ['celo','xdc','fuse'][user_id % 3 + 1] AS network, CAST([42220,50,122][user_id % 3 + 1] AS BIGINT) AS chain_id, event_id AS block_number, ts AS block_timestamp, '0x' || event_id AS tx_hash, event_id % 7 AS log_index,
        '0xW' || user_id || '-' || (k % 10) AS wallet, CAST(round(value * 100) AS BIGINT) AS cents, event_type, k, ts + INTERVAL 1 HOUR AS ingested_at FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events)""",
    "cl": "SELECT network, chain_id, block_number, block_timestamp, tx_hash, log_index, CASE WHEN k % 10 = 9 THEN '0xother' ELSE '0xubi' END AS contract_address, lower(wallet) AS claimer_address, CAST(cents AS VARCHAR) AS amount_raw, cents, ingested_at FROM ev WHERE event_type IN ('view','click') AND block_timestamp < DATE '2024-01-31'",
    "inv": f"""SELECT network, chain_id, block_number, block_timestamp, tx_hash, log_index, CASE event_type WHEN 'signup' THEN 'InviteeJoined' ELSE 'InviterBounty' END AS event_name, '0xinvites' AS contract_address,
        CASE k // 10 WHEN 0 THEN '{ZERO}' WHEN 1 THEN '0xinvites' ELSE '0xref' || (k // 10) END AS inviter_address, lower(wallet) AS invitee_address, CASE WHEN k % 5 = 4 THEN 'x' ELSE CAST(k % 5 AS VARCHAR) END AS inviter_level,
        CAST(cents AS VARCHAR) || repeat('0', 16) AS bounty_paid, k % 2 = 0 AS earned_level, cents, ingested_at FROM ev WHERE event_type IN ('signup','purchase') AND block_timestamp < DATE '2024-01-31'""",
    "su": f"""SELECT network, chain_id, block_number, block_timestamp, tx_hash, log_index, invitee_address AS user_address, CASE WHEN inviter_address IN ('{ZERO}', contract_address) THEN NULL ELSE inviter_address END AS inviter_address,
        CASE WHEN inviter_address = '{ZERO}' THEN 'no_code' WHEN inviter_address = contract_address THEN 'campaign' ELSE 'referral' END AS signup_type, TRY_CAST(inviter_level AS BIGINT) AS inviter_level, ingested_at FROM inv WHERE event_name = 'InviteeJoined'""",
    "po": """SELECT network, chain_id, block_number, block_timestamp, tx_hash, log_index, invitee_address, CASE WHEN inviter_address = contract_address THEN NULL ELSE inviter_address END AS inviter_address,
        CASE WHEN inviter_address = contract_address THEN 'campaign' ELSE 'referral' END AS payout_origin, 50000 AS invitee_cents, CASE WHEN inviter_address = contract_address THEN NULL ELSE cents END AS inviter_cents,
        CASE WHEN inviter_address = contract_address THEN 50000 ELSE cents + 50000 END AS total_cents, TRY_CAST(inviter_level AS BIGINT) AS inviter_level, earned_level, ingested_at FROM inv WHERE event_name = 'InviterBounty'""",
    "li": """SELECT s.*, p.bounty_tx_hash, p.bounty_timestamp, p.total_cents,
        (SELECT min(c.block_timestamp) FROM cl c WHERE c.claimer_address = s.invitee_address AND c.network = s.signup_network AND c.block_timestamp > s.signup_timestamp) AS first_claim_timestamp,
        (SELECT max(c.block_timestamp) FROM cl c WHERE c.claimer_address = s.invitee_address AND c.network = s.signup_network AND c.block_timestamp > s.signup_timestamp) AS latest_claim_timestamp,
        (SELECT count(*) FROM cl c WHERE c.claimer_address = s.invitee_address AND c.network = s.signup_network AND c.block_timestamp > s.signup_timestamp) AS same,
        (SELECT count(*) FROM cl c WHERE c.claimer_address = s.invitee_address AND c.block_timestamp > s.signup_timestamp) AS every_network,
        (SELECT count(*) FROM cl c WHERE c.claimer_address = s.invitee_address AND c.network = s.signup_network AND c.block_timestamp > p.bounty_timestamp AND c.block_timestamp <= p.bounty_timestamp + INTERVAL 7 DAY) AS d7,
        (SELECT count(*) FROM cl c WHERE c.claimer_address = s.invitee_address AND c.network = s.signup_network AND c.block_timestamp > p.bounty_timestamp AND c.block_timestamp <= p.bounty_timestamp + INTERVAL 30 DAY) AS d30
        FROM (SELECT user_address AS invitee_address, inviter_address, signup_type, network AS signup_network, chain_id AS signup_chain_id, tx_hash AS signup_tx_hash, block_timestamp AS signup_timestamp FROM su WHERE signup_type IN ('referral','campaign')
              QUALIFY row_number() OVER (PARTITION BY user_address ORDER BY block_timestamp, block_number, log_index) = 1) s
        LEFT JOIN (SELECT invitee_address, tx_hash AS bounty_tx_hash, block_timestamp AS bounty_timestamp, total_cents FROM po QUALIFY row_number() OVER (PARTITION BY invitee_address ORDER BY block_timestamp, block_number, log_index) = 1) p USING (invitee_address)""",
    "epr": "SELECT CAST(block_timestamp AS DATE) AS day, floor(CAST(sum(cents) AS DOUBLE) / count(*) * 100) / 10000 AS price FROM ev WHERE event_type = 'purchase' AND day(block_timestamp) % 4 <> 0 GROUP BY 1",
    "tr": f"""SELECT '0x' || o_orderkey AS tx_hash, o_orderdate AS ts, CAST(o_orderdate AS DATE) AS day, CASE WHEN l_linenumber = 1 AND o_orderpriority = '1-URGENT' THEN 'otp' WHEN l_linenumber = 1 AND o_orderpriority = '2-HIGH' THEN 'claim' ELSE 'c' || (o_custkey % 120) END AS sender,
        CASE WHEN l_suppkey % 20 = 0 THEN '{ZERO}' ELSE 'c' || l_suppkey END AS recipient, CAST(round(l_extendedprice * 100) AS BIGINT) AS cents FROM orders JOIN lineitem ON o_orderkey = l_orderkey""",
    "wd": "SELECT '0x' || o_orderkey AS tx_hash, o_orderdate AS ts, CAST(o_orderdate AS DATE) AS day, CAST(round(o_totalprice * 100) AS BIGINT) AS cents FROM orders WHERE o_orderpriority = '1-URGENT'",
    "co": "SELECT 'c' || s_suppkey AS address FROM supplier WHERE s_suppkey % 10 = 3",
    "wl": "SELECT 'c' || c_custkey AS account, CAST(DATE '1995-01-01' + CAST(c_custkey * 7 % 2405 AS INTEGER) AS TIMESTAMP) AS ts FROM customer WHERE c_mktsegment IN ('BUILDING','FURNITURE')",
    "lpr": "SELECT CAST(l_shipdate AS DATE) AS day, floor(CAST(sum(CAST(round(l_discount * 100) AS BIGINT)) AS DOUBLE) / count(*) * 100) / 10000 AS price FROM lineitem WHERE day(l_shipdate) % 7 <> 0 GROUP BY 1",
    "fo": """SELECT ts, CAST(ts AS DATE) AS day, recipient, cents FROM (SELECT o_orderdate + to_hours(o_orderkey % 24) AS ts, CASE WHEN o_custkey % 2 = 0 THEN 'c7' ELSE 'c8' END AS sender, '0xw' || (o_custkey % 150) || '-' || (o_orderkey % 10) AS recipient,
        CASE WHEN o_orderkey % 11 = 0 THEN 0 ELSE CAST(round(o_totalprice * 100) AS BIGINT) END AS cents, o_orderstatus <> 'F' AS success, CASE o_orderpriority WHEN '1-URGENT' THEN NULL WHEN '2-HIGH' THEN 'delegatecall' WHEN '5-LOW' THEN 'staticcall' ELSE 'call' END AS call_type FROM orders)
        WHERE sender = 'c7' AND cents > 0 AND success AND (call_type NOT IN ('delegatecall','staticcall') OR call_type IS NULL)""",
    "fv": "SELECT f.*, CAST(cents AS HUGEINT) * CAST(round(coalesce(price, 0) * 10000) AS BIGINT) AS usd6 FROM fo f LEFT JOIN lpr USING (day)",
    "lc": "SELECT o_orderdate AS ts, '0xw' || (o_custkey % 150) || '-' || (o_orderkey % 7) AS claimer, CASE WHEN o_orderkey % 5 = 0 THEN '0xother' ELSE '0xubi' END AS contract_address FROM orders WHERE o_orderstatus <> 'P'",
    "mf0": """SELECT CAST(block_timestamp AS DATE) AS date, * FROM ev WHERE block_timestamp < DATE '2024-01-31'""",
    "mf1": """SELECT date, network, 'dau' AS m, CAST(count(DISTINCT wallet) AS DOUBLE) AS value FROM mf0 WHERE event_type IN ('view','click') GROUP BY ALL
        UNION ALL SELECT date, network, 'new_claimers', CAST(count(*) AS DOUBLE) FROM (SELECT network, wallet, min(date) AS date FROM mf0 WHERE event_type IN ('view','click') GROUP BY ALL) GROUP BY ALL
        UNION ALL SELECT date, network, 'gd_claimed_1d', CAST(sum(cents) AS DOUBLE) / 100 FROM mf0 WHERE event_type IN ('view','click') GROUP BY ALL
        UNION ALL SELECT date, network, 'p2p_gd_amount', CAST(sum(cents) AS DOUBLE) / 100 FROM mf0 WHERE event_type IN ('view','click') AND day(date) % 3 <> 0 GROUP BY ALL
        UNION ALL SELECT date, network, 'gd_price', floor(CAST(sum(cents) AS DOUBLE) / count(*) * 100) / 10000 FROM mf0 WHERE event_type = 'purchase' AND day(date) % 4 <> 0 GROUP BY ALL
        UNION ALL SELECT date, network, 'gd_in_circulation', CAST(sum(cents) AS DOUBLE) FROM mf0 WHERE event_type = 'error' AND day(date) % 6 <> 0 GROUP BY ALL""",
    "mf": """SELECT date, upper(network) AS chain, network || '_' || m AS metric_key, value FROM mf1 WHERE network <> 'fuse' OR m = 'gd_in_circulation'
        UNION ALL SELECT date, 'XDC', 'xdc_reserve_liquidity_usd', CAST(sum(cents) AS DOUBLE) / 100 FROM mf0 WHERE event_type = 'signup' AND day(date) % 5 <> 0 GROUP BY ALL
        UNION ALL SELECT date, 'ETH', 'eth_gd_total_supply', CAST(sum(cents) AS DOUBLE) / 100 FROM mf0 WHERE event_type = 'view' AND day(date) % 9 <> 0 GROUP BY ALL
        UNION ALL SELECT date, 'ETH', 'eth_gd_frozen_supply', CAST(sum(cents) AS DOUBLE) / 100 FROM mf0 WHERE event_type = 'error' AND day(date) % 8 <> 0 GROUP BY ALL""",
    "val": "SELECT date, max(value) FILTER (metric_key = 'xdc_gd_price') AS xp, max(value) FILTER (metric_key = 'celo_gd_price') AS cp, max(value) FILTER (metric_key = 'xdc_reserve_liquidity_usd') AS liq, max(value) FILTER (metric_key = 'xdc_gd_in_circulation') AS xc, max(value) FILTER (metric_key = 'celo_gd_in_circulation') AS cc, max(value) FILTER (metric_key = 'fuse_gd_in_circulation') AS fc, max(value) FILTER (metric_key = 'eth_gd_total_supply') - max(value) FILTER (metric_key = 'eth_gd_frozen_supply') AS ec, max(value) FILTER (metric_key = 'xdc_gd_claimed_1d') AS xm, max(value) FILTER (metric_key = 'xdc_dau') AS xd, max(value) FILTER (metric_key = 'xdc_new_claimers') AS xn, max(value) FILTER (metric_key = 'xdc_p2p_gd_amount') AS xa FROM mf GROUP BY date",
    "f_usd": "SELECT date, 'XDC' AS chain, m AS metric_key, CAST(round(CAST(v AS DECIMAL(24,4)) * CAST(xp AS DECIMAL(12,4)), 2) AS DOUBLE) AS value FROM (SELECT date, 'xdc_usd_claimed_1d' AS m, xm AS v, xp FROM val UNION ALL SELECT date, 'xdc_p2p_usd_amount', xa, xp FROM val) WHERE v IS NOT NULL AND xp <> 0",
    "f_sup": "SELECT date, 'ETH' AS chain, 'eth_gd_in_circulation' AS metric_key, ec AS value FROM val WHERE ec IS NOT NULL UNION ALL SELECT date, 'AGG', 'agg_gd_in_circulation', ec + fc + cc + xc FROM val WHERE ec + fc + cc + xc IS NOT NULL",
    "f_res": """SELECT date, 'XDC' AS chain, 'gd_price_spread' AS metric_key, xp - cp AS value FROM val WHERE xp - cp IS NOT NULL UNION ALL SELECT date, 'XDC', 'xdc_reserve_backing_ratio', liq / xc FROM val WHERE liq IS NOT NULL AND xc > 0
        UNION ALL SELECT date, 'XDC', 'xdc_daily_gd_minted', xm FROM val WHERE xm IS NOT NULL UNION ALL SELECT a.date, 'XDC', 'xdc_reserve_growth_abs', a.liq - b.liq FROM val a JOIN val b ON a.date = b.date + INTERVAL 1 DAY WHERE a.liq - b.liq IS NOT NULL""",
    "f_ret": "SELECT date, 'XDC' AS chain, 'xdc_returning_claimers' AS metric_key, greatest(0.0, xd - xn) AS value FROM val WHERE xd IS NOT NULL AND xn IS NOT NULL",
}


def sql(body: str, *views: str, more: dict[str, str] | None = None) -> str:
    """The query after all shared views up to the last that it names, and views of its own."""
    names = list(VIEWS)
    last = max((names.index(v) for v in views), default=-1)
    used = {n: VIEWS[n] for n in names[: last + 1]} | (more or {})
    return ("WITH " + ",\n".join(f"{n} AS ({q})" for n, q in used.items()) + "\n" if used else "") + body


_ROUND = "CASE " + " ".join("WHEN metric_key IN ({}) THEN CAST(round(CAST(value AS DECIMAL(38,10)), {}) AS DOUBLE)".format(", ".join(f"'{m.key}'" for m in METRICS.values() if m.decimals == dp), dp) for dp in (0, 2, 8)) + " ELSE CAST(round(CAST(value AS DECIMAL(38,10)), 2) AS DOUBLE) END"
_BUILD = "SELECT date, chain, metric_key, {v} AS value, source FROM (SELECT *, 'SAMPLE' AS source FROM mf UNION ALL SELECT *, 'COMPUTED' FROM f_ret UNION ALL SELECT *, 'COMPUTED' FROM f_usd UNION ALL SELECT *, 'COMPUTED' FROM f_sup UNION ALL SELECT *, 'COMPUTED' FROM f_res)".format(v=_ROUND)
_BASES = {}
for _m in METRICS.values():
    if _m.aggregate:
        _BASES.setdefault(_m.key.split("_", 1)[1], _m.decimals)
_IN = ", ".join(f"'{b}'" for b in _BASES)
_ZERO = ", ".join(f"'{b}'" for b, dp in _BASES.items() if dp == 0)
_EXPECTED = ", ".join(f"('{c}', '{m.key}')" for m in METRICS.values() for c in m.chains)
_PRICE = lambda: "CAST(round(price * 10000) AS BIGINT)"

SQL = {
    "stg_claims": sql("SELECT network, chain_id, block_number, block_timestamp, tx_hash, log_index, contract_address, claimer_address, amount_raw, cents / 100.0 AS amount_g, ingested_at FROM cl", "cl"),
    "stg_invites": sql("SELECT network, chain_id, block_number, block_timestamp, tx_hash, log_index, event_name, contract_address, inviter_address, invitee_address, inviter_level, bounty_paid, earned_level, ingested_at FROM inv", "inv"),
    "claimer_activity": sql("SELECT claimer_address, network, min(chain_id) AS chain_id, min(block_timestamp) AS first_claim_timestamp, max(block_timestamp) AS latest_claim_timestamp, count(*) AS total_claims, CAST(sum(cents) AS DOUBLE) / 100 AS total_amount_g, count(DISTINCT CAST(block_timestamp AS DATE)) AS active_days FROM cl GROUP BY ALL", "cl"),
    "invite_signups": sql("SELECT * FROM su", "su"),
    "invite_payouts": sql("SELECT network, chain_id, block_number, block_timestamp, tx_hash, log_index, invitee_address, inviter_address, payout_origin, invitee_cents / 100.0 AS invitee_amount_g, inviter_cents / 100.0 AS inviter_amount_g, total_cents / 100.0 AS total_amount_g, inviter_level, earned_level, ingested_at FROM po", "po"),
    "invitee_lifecycle": sql("SELECT invitee_address, inviter_address, signup_type, signup_network, signup_chain_id, signup_tx_hash, signup_timestamp, first_claim_timestamp, latest_claim_timestamp, same AS total_claims_on_invite_network, every_network AS total_claims_all_networks, bounty_tx_hash, bounty_timestamp, total_cents / 100.0 AS bounty_total_amount_g, CASE WHEN bounty_tx_hash IS NOT NULL THEN d7 END AS post_payout_claims_7d, CASE WHEN bounty_tx_hash IS NOT NULL THEN d30 END AS post_payout_claims_30d FROM li", "li"),
    "daily_claim_activity": sql("""SELECT metric_date, network, daily_claims, daily_unique_claimers, c / 100 AS daily_total_g_claimed, c / 100 / daily_claims AS avg_claim_amount_g, CAST(sum(daily_claims) OVER w AS BIGINT) AS cumulative_claims, CAST(sum(daily_unique_claimers) OVER w AS BIGINT) AS cumulative_unique_claimers_approx, CAST(sum(s) OVER w AS DOUBLE) / 100 AS cumulative_total_g_claimed
        FROM (SELECT CAST(block_timestamp AS DATE) AS metric_date, network, count(*) AS daily_claims, count(DISTINCT claimer_address) AS daily_unique_claimers, sum(cents) AS s, CAST(sum(cents) AS DOUBLE) AS c FROM cl GROUP BY ALL) WINDOW w AS (PARTITION BY network ORDER BY metric_date)""", "cl"),
    "cumulative_claimers_exact": sql("SELECT network, metric_date, CAST(sum(n) OVER (PARTITION BY network ORDER BY metric_date) AS BIGINT) AS cumulative_unique_claimers FROM (SELECT network, metric_date, count(*) AS n FROM (SELECT network, claimer_address, min(CAST(block_timestamp AS DATE)) AS metric_date FROM cl GROUP BY ALL) GROUP BY ALL)", "cl"),
    "daily_invite_metrics": sql("""SELECT metric_date, network, {d}, {a}, daily_unique_invitees_paid, daily_unique_inviters_paid, {c}, {ca} FROM (SELECT metric_date, network,
        coalesce(total_signups, 0) AS daily_total_signups, coalesce(referral_signups, 0) AS daily_referral_signups, coalesce(campaign_signups, 0) AS daily_campaign_signups, coalesce(no_code_signups, 0) AS daily_no_code_signups, coalesce(unique_inviters_joined, 0) AS daily_unique_inviters_joined, coalesce(unique_referral_invitees, 0) AS daily_unique_referral_invitees, coalesce(unique_campaign_invitees, 0) AS daily_unique_campaign_invitees,
        coalesce(total_bounties, 0) AS daily_total_bounties, coalesce(referral_bounties, 0) AS daily_referral_bounties, coalesce(campaign_bounties, 0) AS daily_campaign_bounties, coalesce(x, 0) AS total_expenditure_g, coalesce(y, 0) AS paid_to_invitees_g, coalesce(z, 0) AS paid_to_inviters_g, coalesce(campaign_bounties, 0) * 100000 AS notional_campaign_retained_g, coalesce(unique_invitees_paid, 0) AS daily_unique_invitees_paid, coalesce(unique_inviters_paid, 0) AS daily_unique_inviters_paid
        FROM (SELECT CAST(block_timestamp AS DATE) AS metric_date, network, count(*) AS total_signups, CAST(count_if(signup_type = 'referral') AS BIGINT) AS referral_signups, CAST(count_if(signup_type = 'campaign') AS BIGINT) AS campaign_signups, CAST(count_if(signup_type = 'no_code') AS BIGINT) AS no_code_signups, count(DISTINCT CASE WHEN signup_type = 'no_code' THEN user_address END) AS unique_inviters_joined, count(DISTINCT CASE WHEN signup_type = 'referral' THEN user_address END) AS unique_referral_invitees, count(DISTINCT CASE WHEN signup_type = 'campaign' THEN user_address END) AS unique_campaign_invitees FROM su GROUP BY ALL)
        FULL JOIN (SELECT CAST(block_timestamp AS DATE) AS metric_date, network, count(*) AS total_bounties, CAST(count_if(payout_origin = 'referral') AS BIGINT) AS referral_bounties, CAST(count_if(payout_origin = 'campaign') AS BIGINT) AS campaign_bounties, sum(total_cents) AS x, sum(invitee_cents) AS y, sum(coalesce(inviter_cents, 0)) AS z, count(DISTINCT invitee_address) AS unique_invitees_paid, count(DISTINCT CASE WHEN payout_origin = 'referral' THEN inviter_address END) AS unique_inviters_paid FROM po GROUP BY ALL) USING (metric_date, network)) WINDOW w AS (PARTITION BY network ORDER BY metric_date)""".format(
        d=", ".join(f"daily_{c}" for c in ("total_signups", "referral_signups", "campaign_signups", "no_code_signups", "unique_inviters_joined", "unique_referral_invitees", "unique_campaign_invitees", "total_bounties", "referral_bounties", "campaign_bounties")),
        a=", ".join(f"CAST({c} AS DOUBLE) / 100 AS daily_{c}" for c in ("total_expenditure_g", "paid_to_invitees_g", "paid_to_inviters_g", "notional_campaign_retained_g")),
        c=", ".join(f"CAST(sum(daily_{c}) OVER w AS BIGINT) AS cumulative_{c}" for c in ("total_signups", "referral_signups", "campaign_signups", "no_code_signups", "total_bounties")),
        ca=", ".join(f"CAST(sum({c}) OVER w AS DOUBLE) / 100 AS cumulative_{c}" for c in ("total_expenditure_g", "paid_to_invitees_g", "paid_to_inviters_g"))), "po"),
    "invite_funnel": sql("SELECT TIMESTAMP '2024-01-31' AS snapshot_timestamp, 'invite_funnel' AS funnel_name, stage_order, stage_label, user_count, round(user_count * 100.0 / max(user_count) OVER (), 2) AS pct_of_top FROM (" + " UNION ALL ".join(
        f"SELECT {i + 1} AS stage_order, '{x}' AS stage_label, CAST(count_if({c}) AS BIGINT) AS user_count FROM li" for i, (x, c) in enumerate(zip(FUNNEL, ("true", "same >= 1", "same >= 2", "same >= 3", "same >= 3 AND date_sub('day', signup_timestamp, TIMESTAMP '2024-01-31') >= 7", "bounty_tx_hash IS NOT NULL"), strict=True))) + ")", "li"),
    "active_claimers": sql("""SELECT day, count(DISTINCT claimer_address) AS dau, (SELECT count(DISTINCT u.claimer_address) FROM d u WHERE u.day BETWEEN d.day - 6 AND d.day) AS wau, (SELECT count(DISTINCT u.claimer_address) FROM d u WHERE u.day BETWEEN d.day - 29 AND d.day) AS mau
        FROM d WHERE day >= DATE '2024-01-31' - 20 GROUP BY day""", "cl", more={"d": "SELECT DISTINCT CAST(block_timestamp AS DATE) AS day, claimer_address FROM cl WHERE contract_address = '0xubi'"}),
    "daily_claimers": sql("SELECT period_date, count(DISTINCT claimer_address) AS unique_claimers, count(DISTINCT CASE WHEN n THEN claimer_address END) AS new_claimers, count(DISTINCT CASE WHEN NOT n THEN claimer_address END) AS returning_claimers FROM (SELECT CAST(block_timestamp AS DATE) AS period_date, claimer_address, CAST(block_timestamp AS DATE) = first_day AS n FROM cl JOIN (SELECT claimer_address, min(CAST(block_timestamp AS DATE)) AS first_day FROM cl WHERE contract_address = '0xubi' GROUP BY 1) USING (claimer_address) WHERE block_timestamp >= DATE '2024-01-31' - 25) GROUP BY 1", "cl"),
    "ubi_daily_summary": sql("""SELECT date, (g0 + sum(g) OVER a) / 100 AS total_gd_all_time, (u0 + sum(u) OVER a) / 1000000 AS total_usd_all_time, CAST(sum(g) OVER m AS DOUBLE) / 100 AS gd_30d, CAST(sum(u) OVER m AS DOUBLE) / 1000000 AS usd_30d, CAST(sum(g) OVER m AS DOUBLE) / 100 / nullif(u30, 0) AS gd_per_user_30d, CAST(sum(g) OVER s AS DOUBLE) / 100 AS gd_7d, CAST(sum(u) OVER s AS DOUBLE) / 1000000 AS usd_7d, CAST(sum(g) OVER s AS DOUBLE) / 100 / nullif(u7, 0) AS gd_per_user_7d, CAST(g AS DOUBLE) / 100 AS gd_1d, CAST(u AS DOUBLE) / 1000000 AS usd_1d, coalesce(med, 0) AS gd_per_user_1d
        FROM (SELECT s.date, coalesce(d.g, 0) AS g, coalesce(d.u, 0) AS u, d.med, 0.0 AS g0, 0.0 AS u0,
            (SELECT count(DISTINCT claimer_address) FROM cl WHERE contract_address = '0xubi' AND CAST(block_timestamp AS DATE) BETWEEN s.date - 6 AND s.date) AS u7, (SELECT count(DISTINCT claimer_address) FROM cl WHERE contract_address = '0xubi' AND CAST(block_timestamp AS DATE) BETWEEN s.date - 29 AND s.date) AS u30
            FROM (SELECT CAST(unnest(generate_series(DATE '2024-01-31' - 10 - 29, DATE '2024-01-30', INTERVAL 1 DAY)) AS DATE) AS date) s
            LEFT JOIN (SELECT x.day AS date, sum(c) AS g, sum(CAST(c AS HUGEINT) * coalesce(CAST(round(price * 10000) AS BIGINT), 0)) AS u, quantile_disc(c, 0.5) / 100.0 AS med FROM (SELECT CAST(block_timestamp AS DATE) AS day, claimer_address, sum(cents) AS c FROM cl WHERE contract_address = '0xubi' GROUP BY ALL) x LEFT JOIN epr ON epr.day = x.day GROUP BY 1) d USING (date))
        WINDOW a AS (ORDER BY date ROWS UNBOUNDED PRECEDING), m AS (ORDER BY date ROWS 29 PRECEDING), s AS (ORDER BY date ROWS 6 PRECEDING) QUALIFY date >= DATE '2024-01-31' - 10""", "epr"),
    "verified_users": sql("SELECT count(DISTINCT account) AS total_verified_users, min(ts) AS first_verification, max(ts) AS latest_verification, count(DISTINCT CASE WHEN ts >= TIMESTAMP '2001-08-01 12:00:00' - INTERVAL 30 DAY THEN account END) AS new_last_30d, count(DISTINCT CASE WHEN ts >= TIMESTAMP '2001-08-01 12:00:00' - INTERVAL 90 DAY THEN account END) AS new_last_90d FROM wl", "wl"),
    "faucet_total": sql("SELECT count(*) AS total_topups, count(DISTINCT recipient) AS unique_wallets, CAST(sum(cents) AS DOUBLE) / 100 AS total_distributed, CAST(sum(usd6) AS DOUBLE) / 1000000 AS total_usd_value, min(ts) AS first_topup, max(ts) AS last_topup, date_sub('day', min(ts), max(ts)) AS days_active FROM fv", "fv"),
    "faucet_monthly": sql("SELECT CAST(date_trunc('month', ts) AS DATE) AS month, count(*) AS topups, count(DISTINCT recipient) AS unique_wallets, CAST(sum(cents) AS DOUBLE) / 100 AS distributed, CAST(sum(usd6) AS DOUBLE) / 1000000 AS usd_value, CAST(sum(cents) AS DOUBLE) / 100 / count(*) AS avg_per_topup FROM fv WHERE ts < TIMESTAMP '2001-08-01' GROUP BY 1", "fv"),
    "faucet_daily": sql("SELECT day, count(*) AS topups, count(DISTINCT recipient) AS unique_wallets, CAST(sum(cents) AS DOUBLE) / 100 AS distributed, CAST(sum(CASE WHEN day >= TIMESTAMP '2001-08-01 12:00:00' - INTERVAL 90 DAY THEN usd6 ELSE 0 END) AS DOUBLE) / 1000000 AS usd_value FROM fv WHERE ts >= TIMESTAMP '2001-08-01 12:00:00' - INTERVAL 90 DAY GROUP BY 1", "fv"),
    "faucet_runrate": sql("""SELECT count(*) AS days_measured, CAST(sum(t) AS BIGINT) AS total_topups_30d, CAST(sum(w) AS BIGINT) AS total_unique_wallets_30d, CAST(sum(c) AS DOUBLE) / 100 AS total_30d, CAST(sum(u) AS DOUBLE) / 1000000 AS total_usd_30d, CAST(sum(t) AS DOUBLE) / count(*) AS avg_daily_topups, CAST(sum(w) AS DOUBLE) / count(*) AS avg_daily_wallets, CAST(sum(c) AS DOUBLE) / 100 / count(*) AS avg_daily, CAST(sum(u) AS DOUBLE) / 1000000 / count(*) AS avg_daily_usd, CAST(sum(u) AS DOUBLE) / 1000000 / count(*) * 30 AS projected_monthly_usd_cost
        FROM (SELECT day, count(*) AS t, count(DISTINCT recipient) AS w, sum(cents) AS c, sum(CASE WHEN day >= TIMESTAMP '2001-08-01 12:00:00' - INTERVAL 30 DAY THEN usd6 ELSE 0 END) AS u FROM fv WHERE ts >= TIMESTAMP '2001-08-01 12:00:00' - INTERVAL 30 DAY GROUP BY 1)""", "fv"),
    "faucet_vs_claimers": sql("SELECT count(*) AS total_faucet_recipients, count(u.w) AS also_claimed, round(100.0 * count(u.w) / count(*), 1) AS pct_who_claim, count(*) - count(u.w) AS faucet_only_no_claim FROM (SELECT DISTINCT recipient AS w FROM fo WHERE ts >= TIMESTAMP '2001-08-01 12:00:00' - INTERVAL 30 DAY) f LEFT JOIN (SELECT DISTINCT claimer AS w FROM lc WHERE ts >= TIMESTAMP '2001-08-01 12:00:00' - INTERVAL 30 DAY AND contract_address = '0xubi') u ON f.w = u.w", "lc"),
    "activity_share": sql("""SELECT *, faucet_txs + claim_txs + transfer_txs AS own_txs, round(100.0 * (faucet_txs + claim_txs + transfer_txs) / chain_transactions, 2) AS pct_own FROM (SELECT (SELECT count(*) FROM lineitem WHERE l_shipdate >= TIMESTAMP '2001-08-01 12:00:00' - INTERVAL 30 DAY AND l_returnflag <> 'R') AS chain_transactions, (SELECT count(*) FROM fo WHERE ts >= TIMESTAMP '2001-08-01 12:00:00' - INTERVAL 30 DAY) AS faucet_txs,
        (SELECT count(*) FROM lc WHERE ts >= TIMESTAMP '2001-08-01 12:00:00' - INTERVAL 30 DAY AND contract_address = '0xubi') AS claim_txs, (SELECT count(*) FROM tr WHERE ts >= TIMESTAMP '2001-08-01 12:00:00' - INTERVAL 30 DAY) AS transfer_txs, (SELECT round(count(*) * 1.0 / count(DISTINCT claimer), 1) FROM lc WHERE ts >= TIMESTAMP '2001-08-01 12:00:00' - INTERVAL 30 DAY AND contract_address = '0xubi') AS avg_claims_per_user)""", "lc"),
    "p2p_transfers": sql("""SELECT date, p.price AS daily_price_usd, coalesce(dt, 0) + coalesce(ot, 0) AS total_tx_count, CAST(coalesce(dg, 0) + coalesce(og, 0) AS DOUBLE) / 100 AS total_amount_gd, CAST((coalesce(dg, 0) + coalesce(og, 0)) * CAST(round(p.price * 10000) AS BIGINT) AS DOUBLE) / 1000000 AS total_amount_usd, coalesce(ds, 0) AS unique_senders, coalesce(dr, 0) + coalesce(r.n, 0) AS unique_receivers, coalesce(u.n, 0) AS unique_users
        FROM (SELECT day AS date, count(*) AS dt, sum(cents) AS dg, count(DISTINCT sender) AS ds, count(DISTINCT recipient) AS dr FROM dp GROUP BY 1) FULL JOIN (SELECT day AS date, count(*) AS ot, sum(cents) AS og FROM ww GROUP BY 1) USING (date) LEFT JOIN (SELECT w.day AS date, count(DISTINCT recipient) AS n FROM ww w JOIN tr USING (tx_hash) GROUP BY 1) r USING (date)
        LEFT JOIN (SELECT date, count(DISTINCT a) AS n FROM (SELECT day AS date, sender AS a FROM dp UNION ALL SELECT day, recipient FROM dp UNION ALL SELECT w.day, recipient FROM ww w JOIN tr USING (tx_hash)) GROUP BY 1) u USING (date) LEFT JOIN (SELECT day AS date, price FROM lpr) p USING (date)""", "lpr", more={
            "ww": "SELECT * FROM wd WHERE day >= DATE '2001-08-02' - 60 AND day < DATE '2001-08-02'",
            "dp": "SELECT * FROM tr t WHERE sender <> recipient AND day >= DATE '2001-08-02' - 60 AND day < DATE '2001-08-02' AND sender NOT IN (SELECT address FROM co) AND recipient NOT IN (SELECT address FROM co) AND tx_hash NOT IN (SELECT tx_hash FROM wd)"}),
    "lifetime_claim_p2p": sql(f"""SELECT CAST(greatest(p1, c1) AS DATE) AS end_date, n AS p2p_lifetime_tx_count, gd AS p2p_lifetime_gd_amount, s AS p2p_lifetime_unique_senders, r AS p2p_lifetime_unique_receivers, (SELECT count(DISTINCT a) FROM (SELECT sender AS a FROM pp UNION ALL SELECT recipient FROM pp)) AS p2p_lifetime_unique_users, cl_n AS lifetime_unique_claimers, cl_t AS lifetime_unique_claim_txs, cl_g AS lifetime_claimed_gd_amount, cl_y AS last365d_unique_claimers, CAST(least(p0, c0) AS DATE) AS start_date
        FROM (SELECT count(*) AS n, CAST(sum(cents) AS DOUBLE) / 100 AS gd, count(DISTINCT sender) AS s, count(DISTINCT recipient) AS r, min(ts) AS p0, max(ts) AS p1 FROM pp), (SELECT count(DISTINCT recipient) AS cl_n, count(*) AS cl_t, CAST(sum(cents) AS DOUBLE) / 100 AS cl_g, count(DISTINCT CASE WHEN day >= DATE '2001-08-01' - 365 THEN recipient END) AS cl_y, min(ts) AS c0, max(ts) AS c1 FROM tt WHERE sender = 'claim' AND recipient IN (SELECT account FROM wl))""", "lpr", more={
            "tt": f"SELECT * FROM tr WHERE cents > 0 AND day <= DATE '2001-08-01' AND (sender IN ('claim', 'otp') OR (sender <> '{ZERO}' AND recipient <> '{ZERO}' AND sender <> recipient))",
            "pp": f"SELECT sender, recipient, cents, ts FROM tt WHERE sender NOT IN (SELECT address FROM co) AND recipient NOT IN (SELECT address FROM co) AND sender <> 'otp' AND tx_hash NOT IN (SELECT tx_hash FROM wd WHERE day <= DATE '2001-08-01') AND sender <> '{ZERO}' AND recipient <> '{ZERO}' AND sender <> recipient UNION ALL SELECT NULL, tt.recipient, w.cents, w.ts FROM wd w JOIN tt USING (tx_hash) WHERE tt.sender = 'otp' AND w.day <= DATE '2001-08-01'"}),
    "most_interacted_contracts": sql("""SELECT recipient, coalesce(ml.name, l.p, '(unlabeled)') AS project_name, CAST(sum(cents) AS DOUBLE) / 100 AS total_gd_received, CAST(sum(cents * CAST(round(price * 10000) AS HUGEINT)) AS DOUBLE) / 1000000 AS total_usd_received, count(*) AS transfer_events, count(DISTINCT tx_hash) AS tx_count, count(DISTINCT sender) AS unique_whitelisted_senders
        FROM tr LEFT JOIN lpr USING (day) LEFT JOIN (SELECT 'c' || s_suppkey AS recipient, coalesce(n_name, CASE WHEN s_suppkey % 3 = 0 THEN s_name END, 'owner') AS p FROM supplier LEFT JOIN nation ON s_suppkey % 4 = 0 AND n_nationkey = s_nationkey WHERE s_suppkey % 2 = 0) l USING (recipient) LEFT JOIN (VALUES ('c2', 'Payments'), ('c11', 'Bridge'), ('c16', 'Pool')) ml(recipient, name) USING (recipient)
        WHERE sender IN (SELECT account FROM wl) AND recipient NOT IN (SELECT account FROM wl) GROUP BY 1, 2 ORDER BY 3 DESC, 4 DESC NULLS LAST, 5 DESC, 1, 2 LIMIT 100""", "lpr"),
    "facts_build": sql(_BUILD, "f_ret"),
    "usd_computed": sql("SELECT *, 'COMPUTED' AS source FROM f_usd", "f_usd"),
    "supply_computed": sql("SELECT *, 'COMPUTED' AS source FROM f_sup", "f_sup"),
    "reserve_computed": sql("SELECT *, 'COMPUTED' AS source FROM f_res", "f_res"),
    "returning_claimers": sql("SELECT *, 'COMPUTED' AS source FROM f_ret", "f_ret"),
    "price_warnings": sql("SELECT date, m AS metric_key, 'price not available for ' || date || ' - row skipped' AS details FROM (SELECT date, 'xdc_usd_claimed_1d' AS m, xm AS v, xp FROM val UNION ALL SELECT date, 'xdc_p2p_usd_amount', xa, xp FROM val) WHERE v IS NOT NULL AND (xp IS NULL OR xp = 0)", "val"),
    "facts_agg": sql(f"""SELECT date, 'AGG' AS chain, 'agg_' || b AS metric_key, CASE WHEN b IN ({_ZERO}) THEN CAST(round(s, 0) AS DOUBLE) ELSE CAST(round(s, 2) AS DOUBLE) END AS value, 'AGG' AS source FROM (SELECT date, regexp_replace(metric_key, '^(celo|xdc|eth|fuse)_', '') AS b, sum(CAST(value AS DECIMAL(30,8))) AS s FROM (SELECT date, chain, metric_key, value FROM ({_BUILD})) WHERE chain <> 'AGG' AND metric_key = lower(chain) || '_' || regexp_replace(metric_key, '^(celo|xdc|eth|fuse)_', '') GROUP BY ALL) WHERE b IN ({_IN})""", "f_ret"),
    "facts_append": sql(f"SELECT date, chain, metric_key, value, source FROM ({_BUILD}) WHERE NOT (day(date) % 2 = 0 AND chain = 'XDC')", "f_ret"),
    "rolling_sum_nd": sql("SELECT chain, date, sum(v) OVER (PARTITION BY chain ORDER BY date ROWS 6 PRECEDING) AS value FROM (SELECT s.chain, s.date, coalesce(m.value, 0) AS v FROM (SELECT chain, CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS date FROM (SELECT chain, min(date) AS lo, max(date) AS hi FROM mf WHERE metric_key LIKE '%dau' AND day(date) % 3 <> 0 GROUP BY 1)) s LEFT JOIN (SELECT * FROM mf WHERE metric_key LIKE '%dau' AND day(date) % 3 <> 0) m USING (chain, date))", "mf"),
    "daily_price": sql("SELECT s.day, coalesce(o.price, last_value(o.price IGNORE NULLS) OVER (ORDER BY s.day ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)) AS price, CASE WHEN o.price IS NULL THEN 'carried' ELSE 'observed' END AS kind FROM (SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS day FROM (SELECT min(day) AS lo, max(day) AS hi FROM epr)) s LEFT JOIN epr o USING (day)", "epr"),
    "reserve_volume": sql("SELECT day, i AS amount_in, o AS amount_out, i + o AS volume FROM (SELECT CAST(block_timestamp AS DATE) AS day, CAST(coalesce(sum(cents) FILTER (event_type = 'purchase'), 0) AS DOUBLE) AS i, CAST(coalesce(sum(cents) FILTER (event_type = 'view'), 0) AS DOUBLE) AS o FROM ev WHERE event_type IN ('purchase', 'view') GROUP BY 1)", "ev"),
    "gap_report": sql("SELECT chain, metric_key, min(date) AS first_date, max(date) AS last_date, count(DISTINCT date) AS actual_days, date_diff('day', min(date), max(date)) + 1 AS expected_days, date_diff('day', min(date), max(date)) + 1 - count(DISTINCT date) AS missing_days FROM mf GROUP BY ALL", "mf"),
    "missing_days": sql("SELECT chain, metric_key, CAST(d AS DATE) AS date FROM (SELECT chain, metric_key, unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS d FROM (SELECT chain, metric_key, min(date) AS lo, max(date) AS hi FROM mf GROUP BY 1, 2)) s WHERE NOT EXISTS (SELECT 1 FROM mf WHERE mf.chain = s.chain AND mf.metric_key = s.metric_key AND mf.date = s.d)", "mf"),
    "coverage_report": sql(f"SELECT e.c AS chain, e.k AS metric_key, CASE WHEN EXISTS (SELECT 1 FROM mf WHERE mf.chain = e.c AND mf.metric_key = e.k AND mf.date >= DATE '2024-01-24') THEN 'present' ELSE 'missing' END AS status FROM (VALUES {_EXPECTED}) e(c, k)", "mf"),
    "backfill_preview": sql(f"""SELECT chain, metric_key, last_date, start_date, CAST(greatest(0, date_diff('day', start_date, DATE '2024-01-30') + 1) AS INTEGER) AS days_needed FROM (SELECT e.c AS chain, e.k AS metric_key, last_date, CASE WHEN e.c = 'XDC' THEN greatest(coalesce(last_date + 1, DATE '2024-01-05'), DATE '2024-01-05') ELSE coalesce(last_date + 1, DATE '2024-01-30' - 90) END AS start_date FROM (VALUES {_EXPECTED}) e(c, k) LEFT JOIN (SELECT chain, metric_key, max(date) AS last_date FROM mf GROUP BY ALL) m ON m.chain = e.c AND m.metric_key = e.k)""", "mf"),
    "bounty_split": sql("""SELECT tx_hash, log_index, inviter, invitee, CAST(i AS DOUBLE) / 100 AS inviter_paid_g, CAST(t AS DOUBLE) / 100 AS total_paid_g, CAST(n AS DOUBLE) / 100 AS invitee_paid_g, CAST(greatest(0, t - i - n) AS DOUBLE) / 100 AS campaign_returned_g FROM (SELECT b.tx_hash, b.log_index, b.inviter, b.invitee, coalesce(sum(cents) FILTER (recipient = inviter), 0) AS i, coalesce(sum(cents) FILTER (recipient = invitee AND recipient <> inviter), 0) AS n, coalesce(sum(cents), 0) AS t
        FROM (SELECT '0x' || o_orderkey AS tx_hash, o_orderkey % 5 AS log_index, 'c' || (o_orderkey % 100) AS inviter, 'c' || (o_custkey % 100) AS invitee FROM orders WHERE o_orderpriority = '3-MEDIUM') b LEFT JOIN tr USING (tx_hash) GROUP BY ALL)""", "tr"),
    "raw_dedup": "SELECT l_orderkey, l_linenumber, min(l_partkey) AS l_partkey FROM lineitem GROUP BY ALL",
    "freshness": sql("SELECT max(ingested_at) AS max_loaded_at, date_diff('microsecond', max(ingested_at), TIMESTAMP '2024-02-01 12:00:00') / 3600000000.0 AS age_hours, CASE WHEN date_diff('microsecond', max(ingested_at), TIMESTAMP '2024-02-01 12:00:00') / 3600000000.0 > 72 THEN 'error' WHEN date_diff('microsecond', max(ingested_at), TIMESTAMP '2024-02-01 12:00:00') / 3600000000.0 > 36 THEN 'warn' ELSE 'pass' END AS status FROM ev WHERE event_type IN ('view', 'click')", "ev"),
    "cursor": sql("SELECT network, max(block_number) AS from_block FROM cl GROUP BY 1", "cl"),
    "final_blocks": sql("SELECT network, greatest(0, max(block_number) - CASE network WHEN 'xdc' THEN 15 WHEN 'celo' THEN 64 ELSE 20 END) AS final_block FROM ev GROUP BY 1", "ev"),
    "utm_build": "SELECT page_id, CASE WHEN regexp_matches(url, '^https?://') THEN regexp_extract(url, '^([^#]*)', 1) || CASE WHEN contains(regexp_extract(url, '^([^#]*)', 1), '?') THEN '&' ELSE '?' END || 'utm_source=twitter&utm_medium=social_post&utm_campaign=spring-awareness-2024_01-p' || page_id || regexp_extract(url, '(#.*)$', 1) END AS tagged FROM pages",
    "utm_links": "SELECT page_id, CASE WHEN regexp_matches(url, '^https?://') AND page_id % 10 < 8 THEN regexp_extract(url, '^([^#]*)', 1) || CASE WHEN contains(regexp_extract(url, '^([^#]*)', 1), '?') THEN '&' ELSE '?' END || 'utm_source=twitter&utm_medium=social&utm_campaign=ubi-awareness-2024_01-p_' || page_id || CASE WHEN page_id % 2 = 0 THEN '&utm_content=c' || page_id ELSE '' END || regexp_extract(url, '(#.*)$', 1) END AS link FROM pages",
    "utm_validate": "SELECT page_id, nullif(regexp_extract(url, '[?&]ref=([^&#]*)', 1), '') AS ref, nullif(regexp_extract(url, '[?&]page=([^&#]*)', 1), '') AS page, coalesce(nullif(regexp_extract(url, '[?&]ref=([^&#]*)', 1), '') IN ('x', 'y'), false) AS known FROM pages",
}
SQL["claim_events"] = SQL["stg_claims"]


def _invites_long() -> str:
    a = "CAST(floor(cents / 3.0) AS BIGINT)", "CAST(floor(cents / 2.0) AS BIGINT)"
    rows = f"SELECT CAST(block_timestamp AS DATE) AS date, event_type = 'signup' AS j, CASE WHEN k < 30 THEN 'no_code' WHEN k < 50 THEN 'campaign_code' WHEN k < 80 THEN 'referral' ELSE '' END AS t, '0xref' || (k % 40) AS inviter, lower(wallet) AS invitee, CASE WHEN k % 4 = 0 THEN 0 ELSE {a[0]} END AS i, CASE WHEN k % 6 = 0 THEN 0 ELSE {a[1]} END AS n, cents FROM ev WHERE event_type IN ('signup', 'purchase') AND block_timestamp < DATE '2024-01-31'"
    daily = {
        "total_signups": "count_if(j)", "referral_signups": "count_if(j AND t NOT IN ('campaign_code', 'no_code'))", "campaign_signups": "count_if(j AND t = 'campaign_code')", "nocode_signups": "count_if(j AND t = 'no_code')", "total_bounties_count": "count_if(NOT j)", "invitee_bounties_count": "count_if(NOT j AND n > 0)", "inviter_bounties_count": "count_if(NOT j AND i > 0)",
        "total_amount_paid": "sum(CASE WHEN j THEN 0 ELSE cents END) / 100", "invitee_amount_paid": "sum(CASE WHEN j THEN 0 ELSE n END) / 100", "inviter_amount_paid": "sum(CASE WHEN j THEN 0 ELSE i END) / 100", "campaign_amount_returned": "sum(CASE WHEN j THEN 0 ELSE cents - i - n END) / 100",
    }
    people = "SELECT date, 'unique_invitees' AS role, invitee AS who FROM x WHERE NOT j AND n > 0 UNION SELECT date, 'unique_inviters', inviter FROM x WHERE NOT j AND i > 0 UNION SELECT date, 'total_unique_users', invitee FROM x WHERE NOT j AND n > 0 UNION SELECT date, 'total_unique_users', inviter FROM x WHERE NOT j AND i > 0"
    parts = []
    for m, e in daily.items():
        cents = m.endswith(("paid", "returned"))
        inner = e.removesuffix(" / 100") if cents else e
        over = " / 100" if cents else ""
        parts.append(f"SELECT date, 'xdc_invites_{m}' AS metric_key, CAST(v AS DOUBLE){over} AS value FROM (SELECT s.date, coalesce(({inner}), 0) AS v FROM s LEFT JOIN x USING (date) GROUP BY s.date)")
        parts.append(f"SELECT date, 'xdc_invites_{m}_at', CAST(sum(v) OVER (ORDER BY date) AS DOUBLE){over} FROM (SELECT s.date, coalesce(({inner}), 0) AS v FROM s LEFT JOIN x USING (date) GROUP BY s.date)")
    for m in ("total_unique_users", "unique_invitees", "unique_inviters"):
        parts.append(f"SELECT s.date, 'xdc_invites_{m}', CAST(count(DISTINCT who) AS DOUBLE) FROM s LEFT JOIN (SELECT * FROM p WHERE role = '{m}') USING (date) GROUP BY s.date")
        parts.append(f"SELECT s.date, 'xdc_invites_{m}_at', CAST(count(DISTINCT who) AS DOUBLE) FROM s LEFT JOIN (SELECT * FROM p WHERE role = '{m}') q ON q.date <= s.date GROUP BY s.date")
    spine = "SELECT CAST(unnest(generate_series((SELECT min(date) FROM x), DATE '2024-01-30', INTERVAL 1 DAY)) AS DATE) AS date"
    return sql(" UNION ALL ".join(parts), "ev", more={"x": rows, "p": people, "s": spine})


SQL["invites_daily_long"] = _invites_long()
SQL["stream_ingest"] = "SELECT DISTINCT 'celo' AS network, CAST(l_orderkey AS VARCHAR) AS tx_hash, l_linenumber AS log_index FROM lineitem"


def _more() -> dict[str, str]:
    hexa = lambda n: f"'0x' || lpad(lower(to_hex({n})), 40, '0')"
    out = {
        "decode_claims": sql(f"SELECT network, block_number, tx_hash, log_index, '0xabc' AS contract_address, 'UBIClaimed' AS event_name, {hexa('block_number % 1000 + 1')} AS claimer, CAST(cents AS VARCHAR) AS amount FROM ev WHERE event_type IN ('view', 'click')", "ev"),
        "decode_invites": sql(f"""SELECT network, block_number, tx_hash, log_index, '0xabc' AS contract_address, CASE event_type WHEN 'signup' THEN 'InviteeJoined' ELSE 'InviterBounty' END AS event_name, {hexa('k + 1')} AS inviter, {hexa('block_number % 1000 + 1')} AS invitee,
            CASE event_type WHEN 'purchase' THEN CAST(cents AS VARCHAR) END AS bounty_paid, CASE event_type WHEN 'purchase' THEN CAST(k % 5 AS VARCHAR) END AS inviter_level, CASE event_type WHEN 'purchase' THEN k % 2 = 1 END AS earned_level FROM ev WHERE event_type IN ('signup', 'purchase')""", "ev"),
    }
    p2p = SQL["p2p_transfers"]
    roll = ", ".join(f"CAST(sum({c}) OVER (ORDER BY date ROWS {n - 1} PRECEDING) AS DOUBLE) AS {c}_{n}d" for n in (7, 30) for c in ("total_tx_count", "total_amount_gd", "total_amount_usd"))
    cells = ", ".join(f"coalesce(CAST(p.{c} AS DECIMAL(28,6)), 0) AS {c}" for c in ("total_tx_count", "total_amount_gd", "total_amount_usd"))
    out["p2p_rolling"] = f"WITH q AS ({p2p}), s AS (SELECT CAST(unnest(generate_series((SELECT min(date) FROM q), (SELECT max(date) FROM q), INTERVAL 1 DAY)) AS DATE) AS date) SELECT date, {roll} FROM (SELECT s.date, {cells} FROM s LEFT JOIN q p USING (date))"
    columns = {m.key: m.spec["column"] for m in METRICS.values() if m.spec.get("source") == "ubi_daily_summary"}
    out["facts_tables"] = f"WITH q AS ({SQL['ubi_daily_summary']}) " + " UNION ALL ".join(f"SELECT date, 'CELO' AS chain, '{k}' AS metric_key, CAST({c} AS DOUBLE) AS value, 'UBI_DAILY_SUMMARY' AS source FROM q WHERE {c} IS NOT NULL" for k, c in columns.items())
    day = "SELECT CAST(block_timestamp AS DATE) AS date, count(DISTINCT wallet) AS u, sum(cents) AS c, count(*) AS n FROM ev GROUP BY 1"
    fields = {"activeUsers": ("dd", "u", 1), "newClaimers": ("dn", "u // 2", 1), "totalUBIDistributed": ("dd", "c", 100), "quota": ("dd", "n", 100), "transactionsCountClean": ("d", "n", 1), "transactionsValueClean": ("d", "c", 100)}
    totals = {"transactionsCountClean": ("n", 1), "transactionsValueClean": ("c", 100), "totalInCirculation": ("c", 100), "uniqueClaimers": ("n", 1), "totalClaims": ("n", 1), "totalUBIDistributed": ("c", 100)}
    parts = []
    for m in METRICS.values():
        kind, f = m.spec.get("type"), m.spec.get("field")
        if m.adapter != "Subgraph" or kind == "computed":
            continue
        if kind in ("transaction_lifetime", "global_total"):
            c, by = totals[f]
            parts.append(f"SELECT DATE '2024-01-30' AS date, '{m.key}' AS metric_key, CAST(sum({c}) AS DOUBLE) / {by} AS value FROM d")
        elif kind in ("daily_field", "transaction_daily"):
            t, c, by = fields[f]
            parts.append(f"SELECT date, '{m.key}' AS metric_key, CAST({c} AS DOUBLE) / {by} AS value FROM {t}")
        else:
            t, c, by = fields[f]
            parts.append(f"SELECT date, '{m.key}' AS metric_key, CAST(sum(coalesce({c}, 0)) OVER (ORDER BY date ROWS {m.spec['days'] - 1} PRECEDING) AS DOUBLE) / {by} AS value FROM (SELECT CAST(unnest(generate_series((SELECT min(date) FROM {t}), (SELECT max(date) FROM {t}), INTERVAL 1 DAY)) AS DATE) AS date) LEFT JOIN {t} USING (date)")
    out["facts_entities"] = sql("SELECT date, 'XDC' AS chain, metric_key, value, 'ENTITIES' AS source FROM (" + " UNION ALL ".join(parts) + ") WHERE date < DATE '2024-01-31' AND date >= DATE '2024-01-05'", "ev", more={"d": day, "dd": "SELECT * FROM d WHERE day(date) % 5 <> 0", "dn": "SELECT * FROM dd WHERE day(date) % 4 <> 0"})
    return out


SQL |= _more()


def _reports() -> dict[str, str]:
    tests = {
        "claim_events_not_null_network": "SELECT 1 FROM cl WHERE network IS NULL", "claim_events_not_null_amount_g": "SELECT 1 FROM cl WHERE cents IS NULL", "claim_events_unique_key": "SELECT 1 FROM cl GROUP BY network, tx_hash, log_index HAVING count(*) > 1",
        "claim_events_accepted_network": "SELECT 1 FROM cl WHERE network NOT IN ('celo', 'xdc')", "claim_events_non_negative_amount": "SELECT 1 FROM cl WHERE cents < 0", "claim_events_closed_days": "SELECT 1 FROM cl WHERE block_timestamp >= DATE '2024-01-31'",
        "invite_signups_accepted_type": "SELECT 1 FROM su WHERE signup_type NOT IN ('no_code', 'campaign', 'referral')", "invite_payouts_reconcile": "SELECT 1 FROM po WHERE total_cents IS DISTINCT FROM invitee_cents + coalesce(inviter_cents, 0)",
        "daily_claim_activity_unique_day": "SELECT 1 FROM (SELECT DISTINCT CAST(block_timestamp AS DATE) AS d, network FROM cl) GROUP BY d, network HAVING count(*) > 1", "invitee_unique_address": "SELECT 1 FROM li GROUP BY invitee_address HAVING count(*) > 1",
        "payouts_have_signups": "SELECT DISTINCT invitee_address FROM po WHERE invitee_address NOT IN (SELECT user_address FROM su)",
    }
    rows = " UNION ALL ".join(f"SELECT '{n}' AS test, count(*) AS failures FROM ({q})" for n, q in tests.items())
    warned = "SELECT m, count(*) AS w FROM (SELECT 'xdc_usd_claimed_1d' AS m, xm AS v, xp FROM val UNION ALL SELECT 'xdc_p2p_usd_amount', xa, xp FROM val) WHERE v IS NOT NULL AND (xp IS NULL OR xp = 0) GROUP BY 1"
    fixed = "'run' AS run_id, DATE '2024-01-31' AS run_date, TIMESTAMP '2024-01-31' AS started_at"
    one = f"SELECT {fixed}, 'ALL' AS adapter, chain, metric_key, CASE WHEN w > 0 THEN 'warn' ELSE 'ok' END AS status, n AS records_written, CAST(30 AS BIGINT) AS records_expected, coalesce(w || ' days without price', '') AS details, CAST(0 AS BIGINT) AS elapsed_ms FROM (SELECT chain, metric_key, count(*) AS n FROM ({_BUILD}) GROUP BY ALL) LEFT JOIN ({warned}) ON m = metric_key"
    total = f"SELECT {fixed}, 'SUMMARY', 'ALL', 'ALL', CASE WHEN count_if(status = 'warn') > 0 THEN 'warn' ELSE 'ok' END, CAST(sum(records_written) AS BIGINT), CAST(sum(records_expected) AS BIGINT), count(*) || ' metrics, 0 errors, ' || CAST(count_if(status = 'warn') AS BIGINT) || ' warnings', CAST(0 AS BIGINT) FROM one"
    return {"dq_tests": sql(f"SELECT test, failures, CASE WHEN failures = 0 THEN 'pass' ELSE 'fail' END AS status FROM ({rows})", "li"), "health": sql(f"SELECT * FROM one UNION ALL {total}", "f_ret", more={"one": one})}


SQL |= _reports()


def _run() -> dict[str, str]:
    """The run of all adapters: what each fetches by the SQL of its plan, then the computed metrics on a row a day."""
    days = {"active_claimers": "day", "daily_claimers": "period_date", "lifetime_claim_p2p": "end_date", "p2p_transfers": "date", "ubi_daily_summary": "date"}
    sources = {f"q_{n}": SQL[n] for n in days} | {"q_rolling": SQL["p2p_rolling"], "q_entities": SQL["facts_entities"], "q_price": SQL["daily_price"], "q_volume": SQL["reserve_volume"], "q_invites": SQL["invites_daily_long"]}
    parts, cells = [], "SELECT {day} AS date, '{chain}' AS chain, '{key}' AS metric_key, CAST({column} AS DOUBLE) AS value, '{source}' AS source FROM {table}"
    for m in METRICS.values():
        n, c = m.spec.get("source"), m.spec.get("column")
        if m.adapter == "Table":
            table = "q_rolling" if n == "p2p_transfers" and c.endswith(("_7d", "_30d")) else f"q_{n}"
            parts.append(cells.format(day=days[n], chain="CELO", key=m.key, column=c, source=n.upper(), table=table))
    parts.append("SELECT date, chain, metric_key, value, source FROM q_entities")
    parts.append(cells.format(day="day", chain="CELO", key="celo_gd_price", column="price", source="RESERVE", table="q_price"))
    parts += [cells.format(day="day", chain="CELO", key=f"celo_reserve_{k}", column=f"{c} / 100", source="RESERVE", table="q_volume") for k, c in (("in", "amount_in"), ("out", "amount_out"), ("volume", "volume"))]
    parts.append("SELECT date, 'XDC', metric_key, CAST(value AS DOUBLE), 'XDC_INVITES' FROM q_invites")
    past = "ev WHERE CAST(block_timestamp AS DATE) <= DATE '2024-01-30'"
    parts += [cells.format(day="DATE '2024-01-30'", chain=k[:4].strip("_").upper(), key=k, column=c, source="SUPPLY", table=f"(SELECT sum(cents) FILTER (event_type = 'error') / 100 AS e, sum(cents) FILTER (event_type = 'click') / 100 AS k, sum(cents) FILTER (event_type = 'signup') / 100 AS s FROM {past})") for k, c in (("eth_gd_total_supply", "900000000.0"), ("eth_gd_frozen_supply", "e"), ("fuse_gd_in_circulation", "k"), ("celo_gd_in_circulation", "s"))]
    parts.append(f"SELECT CAST(block_timestamp AS DATE), 'XDC', 'xdc_gd_price', (count(*) % 50 + 1) / 10000, 'XDC_RESERVE' FROM {past} GROUP BY 1")
    parts.append(f"SELECT CAST(block_timestamp AS DATE), 'XDC', 'xdc_reserve_liquidity_usd', sum(cents) / 100, 'XDC_RESERVE' FROM {past} AND event_type IN ('signup', 'error') GROUP BY 1")
    usd = {m.key: m.spec["source"] for m in METRICS.values() if m.adapter == "Computed"}
    eth = "eth_gd_total_supply - eth_gd_frozen_supply"
    rules = {("XDC", "xdc_returning_claimers"): "CASE WHEN xdc_dau IS NOT NULL AND xdc_new_claimers IS NOT NULL THEN greatest(0.0, xdc_dau - xdc_new_claimers) END", ("ETH", "eth_gd_in_circulation"): eth, ("AGG", "agg_gd_in_circulation"): f"{eth} + fuse_gd_in_circulation + celo_gd_in_circulation + xdc_gd_in_circulation"}
    rules |= {("XDC", k): f"CASE WHEN xdc_gd_price <> 0 THEN round(CAST({s} AS DECIMAL(24,4)) * CAST(xdc_gd_price AS DECIMAL(12,4)), 2) END" for k, s in usd.items()}
    rules |= {("XDC", "gd_price_spread"): "xdc_gd_price - celo_gd_price", ("XDC", "xdc_reserve_backing_ratio"): "CASE WHEN xdc_gd_in_circulation > 0 THEN xdc_reserve_liquidity_usd / xdc_gd_in_circulation END", ("XDC", "xdc_daily_gd_minted"): "xdc_gd_claimed_1d"}
    rules |= {("XDC", "xdc_reserve_growth_abs"): "xdc_reserve_liquidity_usd - (SELECT b.xdc_reserve_liquidity_usd FROM wide b WHERE b.date = wide.date - 1)"}
    needs = sorted({*usd.values(), "xdc_dau", "xdc_new_claimers", "xdc_gd_price", "celo_gd_price", "eth_gd_total_supply", "eth_gd_frozen_supply", "fuse_gd_in_circulation", "celo_gd_in_circulation", "xdc_gd_in_circulation", "xdc_reserve_liquidity_usd", "xdc_gd_claimed_1d"})
    wide = "SELECT date, " + ", ".join(f"max(value) FILTER (metric_key = '{k}') AS {k}" for k in needs) + " FROM fetched GROUP BY date"
    derived = " UNION ALL ".join(f"SELECT date, '{chain}', '{key}', CAST({rule} AS DOUBLE), 'COMPUTED' FROM wide" for (chain, key), rule in rules.items())
    fetched = f"SELECT date, chain, metric_key, {_ROUND} AS value, source FROM ({' UNION ALL '.join(parts)}) WHERE value IS NOT NULL"
    rounded = f"SELECT * FROM fetched UNION ALL SELECT date, chain, metric_key, {_ROUND}, source FROM (SELECT * FROM ({derived}) t(date, chain, metric_key, value, source) WHERE value IS NOT NULL)"
    due = "SELECT date, chain, metric_key, value, source FROM fetched WHERE chain = 'XDC' AND source IN ('ENTITIES', 'XDC_RESERVE') AND date >= DATE '2024-01-05' AND (date >= DATE '2024-01-20' OR metric_key = 'xdc_gd_price')"
    views = sources | {"fetched": fetched, "wide": wide}
    return {"facts_run": sql(rounded, "ev", more=views), "smart_backfill": sql(due, "ev", more=views)}


SQL |= _run()
