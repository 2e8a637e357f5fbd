"""Rule engines as columns: ladders of thresholds, scores with reasons, the decision cascade."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from tickloom import constants as K


def ladder(value: Column, steps: Iterable[tuple[float, str]], floor: str | None) -> Column:
    """Name of the first step whose threshold ``value`` reaches."""
    chain = reduce(lambda c, s: c.when(value >= s[0], s[1]), steps, F.when(F.lit(False), F.lit(None)))
    return chain.otherwise(F.lit(floor).cast("string"))


def concentration_tier(top10_share: Column) -> Column:
    return F.when(top10_share.isNotNull(), ladder(top10_share, K.CONCENTRATION_TIERS, "LOW"))


def score_tier(score: Column) -> Column:
    return ladder(score, K.SCORE_TIERS, "LOW")


def move_severity(change: Column) -> Column:
    return ladder(F.abs(change), K.MOVE_SEVERITIES, None)


def mint_flags(rpc_json: Column) -> tuple[Column, Column]:
    """(mint active, freeze active); both null when the account document has no parsed info."""
    info = "$.result.value.data.parsed.info"
    found = F.get_json_object(rpc_json, info).isNotNull()
    return tuple(
        F.when(found, F.get_json_object(rpc_json, f"{info}.{field}").isNotNull())
        for field in ("mintAuthority", "freezeAuthority")
    )


def _texts(table: dict[str, str], *entries: tuple) -> Column:
    """The texts whose condition holds: (condition, name in ``table``, arguments of the text)."""
    return F.array_compact(
        F.array(*[F.when(test, F.format_string(table[name], *args)) for test, name, *args in entries])
    )


def rug_risk(tier: Column, outflow: Column, mint: Column, freeze: Column) -> dict[str, Column]:
    """Rug-risk score 0..100 with its tier, reasons and the signals that were missing."""
    chain = reduce(lambda c, kv: c.when(tier == kv[0], kv[1]), K.TIER_POINTS.items(), F.when(F.lit(False), 0))
    points = chain.otherwise(0)
    flags = ((outflow, K.OUTFLOW_POINTS), (mint, K.MINT_POINTS), (freeze, K.FREEZE_POINTS))
    total = reduce(lambda a, b: a + b, [F.when(flag, p).otherwise(0) for flag, p in flags], points)
    score = F.least(total, F.lit(K.MAX_SCORE)).cast("int")
    found = _texts(
        K.RISK_TEXTS, (points > 0, "concentration", tier, points), (outflow, "outflow"), (mint, "mint"), (freeze, "freeze")
    )
    signals = {"no_concentration": tier, "no_outflow": outflow, "no_mint": mint, "no_freeze": freeze}
    return {
        "rug_risk_score": score,
        "risk_tier": score_tier(score),
        "reasons": F.when(F.size(found) > 0, found).otherwise(F.array(F.lit(K.RISK_TEXTS["clean"]))),
        "data_gaps": _texts(K.RISK_TEXTS, *[(signal.isNull(), name) for name, signal in signals.items()]),
    }


def candidate_problem(liquidity: Column, volume: Column) -> Column:
    """Why a screened token is not trusted; null for a sound one."""
    return (
        F.when(liquidity.isNull() | F.isnan(liquidity) | (liquidity <= 0), "bad_liquidity")
        .when(volume.isNull() | F.isnan(volume) | (volume < 0), "bad_volume")
        .when(F.try_divide(volume, liquidity) > K.MAX_VOLUME_TO_LIQUIDITY, "volume_to_liquidity")
    )


def momentum_tier(volume: Column, liquidity: Column, holders: Column, trades: Column) -> Column:
    """Tier whose four floors are all reached; a missing metric reaches none."""
    values = (volume, liquidity, holders, trades)
    chain = F.when(F.lit(False), F.lit(None).cast("string"))
    for name, *floors in K.MOMENTUM_FLOORS:
        chain = chain.when(reduce(lambda a, b: a & b, [v >= f for v, f in zip(values, floors, strict=True)]), name)
    return chain


def recommendation(
    score: Column, tier: Column, probability: Column, news_type: Column, credibility: Column, momentum: Column
) -> dict[str, Column]:
    """BUY / WATCHLIST / HOLD / AVOID by priority, with confidence, reasons and risks."""
    tier_override = F.coalesce(tier.isin(*K.OVERRIDE_TIERS), F.lit(False))
    news_override = ~tier_override & F.coalesce(news_type.isin(*K.ACUTE_NEWS), F.lit(False))
    override = tier_override | news_override
    acceptable = tier.isNull() | tier.isin("LOW", "MODERATE")
    unknown = probability.isNull()
    bullish = F.coalesce(probability >= 0.6, F.lit(False)) & acceptable
    low = F.coalesce(probability <= 0.3, F.lit(False))
    bearish = low | F.coalesce(tier == "HIGH", F.lit(False))
    strong = unknown & F.coalesce(momentum == "STRONG", F.lit(False)) & acceptable

    def outcome(action: str, confidence) -> Column:
        value = F.lit(confidence) if not isinstance(confidence, Column) else confidence
        return F.struct(F.lit(action).alias("action"), value.cast("double").alias("confidence"))

    chosen = (
        F.when(tier_override, outcome("AVOID", 0.9))
        .when(news_override, outcome("AVOID", 0.75))
        .when(strong, outcome("WATCHLIST", 0.5))
        .when(unknown, outcome("HOLD", 0.3))
        .when(bullish, outcome("BUY", F.least(probability, F.lit(0.85))))
        .when(bearish, outcome("AVOID", 0.6))
        .otherwise(outcome("HOLD", 0.4))
    )
    shown = F.coalesce(score.cast("string"), F.lit("None"))
    note = F.when(credibility.isNull(), "").otherwise(F.format_string(K.DECISION_TEXTS["credibility"], credibility))
    calm, scored = ~override, ~override & ~unknown
    reasons = _texts(
        K.DECISION_TEXTS,
        (tier_override, "tier_override", tier, shown),
        (news_override, "news_override", news_type, note),
        (calm & (tier == "LOW"), "tier", tier, shown),
        (calm & unknown, "no_model"),
        (calm & strong, "momentum"),
        (scored & bullish, "bullish", probability),
        (scored & ~bullish & ~bearish, "neutral", probability),
    )
    risks = _texts(
        K.DECISION_TEXTS,
        (tier_override, "tier_risk", tier),
        (news_override, "news_risk", news_type),
        (calm & tier.isin("HIGH", "MODERATE"), "tier", tier, shown),
        (scored & ~bullish & low, "bearish", probability),
    )
    nothing = (F.size(reasons) == 0) & (F.size(risks) == 0)
    return {
        "action": chosen["action"],
        "confidence": chosen["confidence"],
        "reasons": F.when(nothing, F.array(F.lit(K.DECISION_TEXTS["silent"]))).otherwise(reasons),
        "risks": risks,
        "override_triggered": override,
        "would_emergency_exit_if_held": override,
    }


def report_severity(action: Column, confidence: Column, override: Column) -> Column:
    return (
        F.when(override & (confidence >= 0.85), "CRITICAL")
        .when(override, "HIGH")
        .when((action == "BUY") & (confidence >= 0.7), "WATCH")
        .otherwise("INFO")
    )


def promotion(
    has_champion: Column, champion_auc: Column, champion_brier: Column, auc: Column, brier: Column
) -> dict[str, Column]:
    """Champion/challenger rule. A NaN metric counts as missing."""
    champion_auc, champion_brier, auc, brier = (
        F.when(~F.isnan(c), c) for c in (champion_auc, champion_brier, auc, brier)
    )
    gain, loss = auc - champion_auc, brier - champion_brier
    first = ~has_champion
    incomparable = has_champion & gain.isNull()
    weak = has_champion & F.coalesce(gain < K.MIN_AUC_GAIN, F.lit(False))
    ahead = has_champion & F.coalesce(gain >= K.MIN_AUC_GAIN, F.lit(False))
    worse = ahead & F.coalesce(loss > K.MAX_BRIER_LOSS, F.lit(False))
    reasons = _texts(
        K.PROMOTION_TEXTS,
        (first, "first"),
        (incomparable, "incomparable"),
        (weak, "weak", gain),
        (ahead, "ahead", gain, champion_auc, auc),
        (worse, "worse", loss),
        (ahead & ~worse & loss.isNotNull(), "calibrated", loss),
        (ahead & loss.isNull(), "uncalibrated"),
    )
    return {"promote": first | (ahead & ~worse), "reasons": reasons}
