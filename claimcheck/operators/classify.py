"""Messages to classes by weighted evidence."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimcheck.config import Settings
from claimcheck.functions import text as T

ORDER = ("SIGNAL", "FOLLOW_UP", "NOISE")


def price_count(text: Column, cfg: Settings) -> Column:
    """How many price-like numbers lie in the plausible band."""
    found = F.transform(F.regexp_extract_all(text, F.lit(T.PRICE_WORD), F.lit(0)), lambda x: T.number(x))
    return F.size(F.filter(found, lambda x: T.in_band(x, cfg.min_price, cfg.max_price)))


def evidence(text: Column, is_reply: Column, cfg: Settings) -> dict[str, list[tuple[str | Column, float, Column]]]:
    """Per class the (reason, weight, condition) rows in the order in which they add up."""
    hit = {name: T.has(text, p) for name, p in T.CLASSIFY.items()}
    prices = price_count(text, cfg)
    tp = hit["tp_token"] | hit["take_profit"]
    full = hit["sl_token"] & tp
    some = hit["outcome"] | hit["pips"] | hit["break_even"] | hit["cancel"]
    return {
        "SIGNAL": [
            ("has_instrument", 0.30, hit["instrument"]),
            ("has_direction", 0.30, hit["direction"]),
            (F.concat(F.lit("plausible_prices="), prices.cast("string")), 0.10, prices >= 1),
            ("has_sl", 0.20, hit["sl_token"]),
            ("has_tp", 0.20, tp),
            ("has_entry_kw", 0.05, hit["entry"]),
            ("outcome_verb_penalty", -0.40, hit["outcome"] & ~full),
            ("promo_penalty", -0.50, hit["promo"] | hit["gold_token"]),
            ("url_penalty", -0.15, hit["url"]),
        ],
        "FOLLOW_UP": [
            ("outcome_verb", 0.45, hit["outcome"]),
            ("pips_mention", 0.30, hit["pips"]),
            ("break_even", 0.30, hit["break_even"]),
            ("cancel_signal", 0.35, hit["cancel"]),
            ("is_reply", 0.10, is_reply),
            ("full_signal_form_penalty", -0.50, full),
            ("no_outcome_evidence", -0.30, ~some),
            ("outcome_plus_price", 0.10, hit["outcome"] & (prices >= 1)),
        ],
        "NOISE": [
            ("promo", 0.55, hit["promo"]),
            ("token_promo", 0.40, hit["gold_token"]),
            ("url", 0.30, hit["url"]),
            ("very_short", 0.50, F.length(text) <= 5),
            ("no_alphanumeric", 0.60, ~text.rlike("[A-Za-z0-9]")),
            ("signal_evidence_present", -0.35, hit["direction"] & hit["instrument"]),
        ],
    }


def _total(rows) -> Column:
    """Weights of what holds, added as doubles from the left, at least 0."""
    score = F.lit(0.0)
    for _, weight, cond in rows:
        score = score + F.when(cond, F.lit(weight)).otherwise(F.lit(0.0))
    return F.greatest(F.lit(0.0), score)


COLUMNS = ["class", "confidence", "method", "reasons", "classifier_version"]


def classify(messages: DataFrame, cfg: Settings) -> DataFrame:
    """message_uid, class, confidence, method, reasons, classifier_version."""
    return with_class(messages.select("message_uid", "text", "reply_to_msg_id"), cfg).select("message_uid", *COLUMNS)


def with_class(messages: DataFrame, cfg: Settings) -> DataFrame:
    """``messages`` with the columns of their class, without a join.

    The class of the highest score wins, ties in ORDER; confidence is a half
    plus half the lead.  No score, or a confidence below the threshold, leaves
    the message UNCERTAIN; an empty text is NOISE.
    """
    body = T.strip(T.tidy(F.col("text")))
    base = messages.withColumns({"body": body, "is_reply": F.col("reply_to_msg_id").isNotNull()})
    rows = evidence(F.col("body"), F.col("is_reply"), cfg)
    # one projection for the evidence, so that each pattern runs once
    named = base.select(
        *messages.columns,
        "body",
        *[_total(rows[c]).alias(f"s_{c}") for c in ORDER],
        *[T.reasons(*[(cond, why) for why, _, cond in rows[c]]).alias(f"r_{c}") for c in ORDER],
    )
    named = T.settle(named)
    s = {c: F.col(f"s_{c}") for c in ORDER}
    top = F.greatest(*s.values())
    second = F.sort_array(F.array(*s.values()), asc=False)[1]
    winner = F.when(s["SIGNAL"] == top, "SIGNAL").when(s["FOLLOW_UP"] == top, "FOLLOW_UP").otherwise("NOISE")
    won = F.when(s["SIGNAL"] == top, F.col("r_SIGNAL")).when(s["FOLLOW_UP"] == top, F.col("r_FOLLOW_UP")).otherwise(F.col("r_NOISE"))
    sure = F.least(F.lit(1.0), F.greatest(F.lit(0.0), F.lit(0.5) + (top - second) / F.lit(2.0)))
    scores = F.array(*[F.format_string(f"score_{c.lower()}=%.2f", s[c]) for c in ORDER])
    empty, none, weak = F.col("body") == "", top <= 0, sure < F.lit(cfg.classify_threshold)
    return named.select(
        *messages.columns,
        F.when(empty, "NOISE").when(none | weak, "UNCERTAIN").otherwise(winner).alias("class"),
        F.when(empty, 1.0).when(none, 0.0).otherwise(sure).alias("confidence"),
        F.lit("rules").alias("method"),
        F.when(empty, F.array(F.lit("empty_text"))).when(none, F.array(F.lit("no_evidence"))).when(weak, F.concat(scores, won)).otherwise(won).alias("reasons"),
        F.lit(cfg.version).alias("classifier_version"),
    )


def unclassified(messages: DataFrame, classifications: DataFrame) -> DataFrame:
    """Messages that have no class yet."""
    return messages.join(classifications.select("message_uid"), "message_uid", "left_anti")


def of_class(messages: DataFrame, classifications: DataFrame, name: str, limit: int | None = None) -> DataFrame:
    """Messages of one class, oldest first where a limit asks for it."""
    out = messages.join(classifications.where(F.col("class") == name).select("message_uid"), "message_uid", "left_semi")
    return out if limit is None else out.orderBy("ts", "message_uid").limit(limit)
