"""The metric registry: which adapter makes a metric, for which chain, whether it is summed over chains, and its decimals.

A metric's source is a plan's output column, by name."""

from __future__ import annotations

from dataclasses import dataclass, field

CHAINS = ("CELO", "XDC", "ETH", "FUSE")


@dataclass(frozen=True)
class Metric:
    key: str
    adapter: str
    chains: tuple[str, ...]
    aggregate: bool = False
    decimals: int = 0
    spec: dict = field(default_factory=dict)


def _table(source: str, columns: dict[str, tuple[str, bool, int]]) -> list[Metric]:
    """Metrics that are columns of a daily plan."""
    return [Metric(f"celo_{k}", "Table", ("CELO",), agg, dp, {"source": source, "column": c}) for k, (c, agg, dp) in columns.items()]


def _entity(kind: str, metrics: dict[str, tuple[str, bool, int, int, int]]) -> list[Metric]:
    """Metrics of daily entities: field, summed over chains, stored decimals, token decimals, window of days."""
    return [Metric(f"xdc_{k}", "Subgraph", ("XDC",), agg, dp, {"type": kind, "field": f, "token_decimals": scale, "days": days}) for k, (f, agg, dp, scale, days) in metrics.items()]


def build() -> dict[str, Metric]:
    m: list[Metric] = []
    m += _table("active_claimers", {"dau": ("dau", False, 0), "wau": ("wau", False, 0), "mau": ("mau", False, 0)})
    m += _table("daily_claimers", {"new_claimers": ("new_claimers", False, 0), "returning_claimers": ("returning_claimers", False, 0)})
    m += _table("lifetime_claim_p2p", {"yau": ("last365d_unique_claimers", False, 0), "p2p_lifetime_tx_count": ("p2p_lifetime_tx_count", True, 0), "p2p_lifetime_gd_amount": ("p2p_lifetime_gd_amount", True, 2), "p2p_lifetime_unique_users": ("p2p_lifetime_unique_users", False, 0), "lifetime_unique_claimers": ("lifetime_unique_claimers", False, 0), "lifetime_claim_txs": ("lifetime_unique_claim_txs", True, 0)})
    p2p = {"p2p_tx_count": ("total_tx_count", True, 0), "p2p_gd_amount": ("total_amount_gd", True, 2), "p2p_usd_amount": ("total_amount_usd", True, 2)}
    for days in (7, 30):
        p2p |= {f"{k}_{days}d": (f"{c}_{days}d", agg and "usd" not in k, dp) for k, (c, agg, dp) in list(p2p.items())[:3]}
    m += _table("p2p_transfers", p2p | {"p2p_senders": ("unique_senders", False, 0), "p2p_receivers": ("unique_receivers", False, 0), "p2p_users": ("unique_users", False, 0)})
    ubi = {"lifetime_claimed_gd_amount": ("total_gd_all_time", True, 2), "lifetime_claimed_usd_amount": ("total_usd_all_time", True, 2)}
    for days in (30, 7, 1):
        ubi |= {f"gd_claimed_{days}d": (f"gd_{days}d", True, 2), f"usd_claimed_{days}d": (f"usd_{days}d", True, 2), f"gd_per_user_{days}d": (f"gd_per_user_{days}d", False, 2)}
    m += _table("ubi_daily_summary", ubi)
    m += _entity("daily_field", {"dau": ("activeUsers", False, 0, 0, 1), "new_claimers": ("newClaimers", False, 0, 0, 1), "gd_claimed_1d": ("totalUBIDistributed", True, 2, 18, 1), "gd_per_user_1d": ("quota", False, 2, 18, 1)})
    m += _entity("computed", {"returning_claimers": ("", False, 0, 0, 1)})
    m += _entity("transaction_daily", {"p2p_tx_count": ("transactionsCountClean", True, 0, 0, 1), "p2p_gd_amount": ("transactionsValueClean", True, 2, 18, 1)})
    m += _entity("transaction_lifetime", {"p2p_lifetime_tx_count": ("transactionsCountClean", True, 0, 0, 0), "p2p_lifetime_gd_amount": ("transactionsValueClean", True, 2, 18, 0), "gd_in_circulation": ("totalInCirculation", False, 2, 18, 0)})
    m += _entity("global_total", {"lifetime_unique_claimers": ("uniqueClaimers", False, 0, 0, 0), "lifetime_claim_txs": ("totalClaims", True, 0, 0, 0), "lifetime_claimed_gd_amount": ("totalUBIDistributed", True, 2, 18, 0)})
    for days in (30, 7):
        m += _entity("rolling_sum", {f"gd_claimed_{days}d": ("totalUBIDistributed", True, 2, 18, days), f"gd_per_user_{days}d": ("quota", False, 2, 18, days)})
        m += _entity("transaction_rolling", {f"p2p_tx_count_{days}d": ("transactionsCountClean", True, 0, 0, days), f"p2p_gd_amount_{days}d": ("transactionsValueClean", True, 2, 18, days)})
    m += [Metric("celo_gd_price", "Reserve", ("CELO",), False, 8, {"type": "daily_avg_price"})]
    m += [Metric(f"celo_reserve_{k}", "Reserve", ("CELO",), False, 2, {"type": "daily_volume", "field": f}) for k, f in (("in", "amount_in"), ("out", "amount_out"), ("volume", "volume"))]
    m += [Metric(f"xdc_{k}", "Computed", ("XDC",), True, 2, {"type": "multiply_by_price", "source": f"xdc_{s}"}) for k, s in (("p2p_usd_amount", "p2p_gd_amount"), ("lifetime_claimed_usd_amount", "lifetime_claimed_gd_amount"), ("usd_claimed_30d", "gd_claimed_30d"), ("usd_claimed_7d", "gd_claimed_7d"), ("usd_claimed_1d", "gd_claimed_1d"))]
    m += [Metric("eth_gd_total_supply", "Supply", ("ETH",), False, 2, {"type": "eth_total"}), Metric("eth_gd_frozen_supply", "Supply", ("ETH",), False, 2, {"type": "eth_frozen"})]
    m += [Metric(f"{c.lower()}_gd_in_circulation", "Supply", (c,), False, 2, {"type": f"{c.lower()}_supply"}) for c in ("FUSE", "CELO")]
    m += [Metric("eth_gd_in_circulation", "SupplyComputed", ("ETH",), False, 2, {"type": "eth_circulating"}), Metric("agg_gd_in_circulation", "SupplyComputed", ("AGG",), False, 2, {"type": "total_circulating"})]
    m += [Metric("xdc_gd_price", "XdcReserve", ("XDC",), False, 8, {"type": "gd_price"}), Metric("xdc_reserve_liquidity_usd", "XdcReserve", ("XDC",), False, 2, {"type": "reserve_liquidity"})]
    m += [Metric(k, "XdcReserveComputed", ("XDC",), False, dp, {"type": t}) for k, t, dp in (("gd_price_spread", "price_spread", 8), ("xdc_reserve_backing_ratio", "backing_ratio", 8), ("xdc_daily_gd_minted", "daily_minted", 2), ("xdc_reserve_growth_abs", "reserve_growth_abs", 2))]
    for name in INVITE_COUNTS + INVITE_AMOUNTS:
        m += [Metric(f"xdc_invites_{name}{suffix}", "XdcInvites", ("XDC",), False, 2 if name in INVITE_AMOUNTS else 0, {"column": f"{name}{suffix}"}) for suffix in ("", "_at")]
    return {x.key: x for x in m}


INVITE_COUNTS = ["total_signups", "referral_signups", "campaign_signups", "nocode_signups", "total_unique_users", "unique_invitees", "unique_inviters", "total_bounties_count", "invitee_bounties_count", "inviter_bounties_count"]
INVITE_AMOUNTS = ["total_amount_paid", "invitee_amount_paid", "inviter_amount_paid", "campaign_amount_returned"]

METRICS = build()
