r"""Patterns and text helpers.

Spark's patterns are Java's with ASCII classes; ``tidy`` therefore maps wide
spaces and full-width digits to ASCII before any pattern runs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Classifier patterns, all without regard to case.
CLASSIFY = {
    "instrument": r"\b(?:#\s*)?(XAUUSD|XAU/USD|GOLD)\b",
    "direction": r"\b(BUY|SELL|LONG|SHORT)(?:\s+(?:NOW|LIMIT|STOP|ZONE))?\b",
    "sl_token": r"\b(SL|S/L|STOP\s*LOSS|STOPLOSS)\b\s*[:\-@]?\s*\d",
    "tp_token": r"\bTP\s*\d?\b\s*[:\-@]?\s*\d",
    "take_profit": r"\bTAKE\s*PROFIT\s*\d?\b\s*[:\-@]?\s*\d",
    "entry": r"\b(ENTRY|ENTRY\s*ZONE|PRICE|@)\b",
    "outcome": r"\b(HIT|HITS|TAPPED?|RAN|RUNNING|RUNS|SECURED?|BOOK(?:ED)?|CLOSE(?:D)?|CLOSING|STOPPED|TRAILING|REACHED|ACHIEVED|TARGET\s+HIT)\b",
    "pips": r"[+\-]?\s*\d{1,4}\s*PIPS?\b",
    "break_even": r"\b(BE|BREAK\s*EVEN|BREAKEVEN|MOVE\s*SL)\b",
    "cancel": r"\b(CANCEL(?:LED|LING)?|VOID|IGNORE\s+SIGNAL)\b",
    "promo": r"(?<![A-Za-z0-9])(VIP|PAYMENT|WALLET|TRC20|JOIN\s+HERE|WHATSAPP|MONIE\s*POINT|BONUS|DEPOSIT|SUBSCRIBE|REGISTER|AFFILIATE|VIPCODE|REFERRAL|PROMO|NEW\s+USER\s+DEAL)(?![A-Za-z0-9])",
    "url": r"https?://\S+",
    "gold_token": r"\b(XAUT|GOLD\s+TOKEN|TETHER\s*GOLD)\b",
}
PRICE_WORD = r"\b\d{3,5}(?:\.\d+)?\b"

# Signal patterns, on normalised upper-case text.
SIGNAL = {
    "direction": r"\b(BUY|SELL|LONG|SHORT)(?:\s+(?:NOW|LIMIT|STOP|ZONE))?\b",
    "instrument": r"(?:#\s*)?\b(XAUUSD|XAU/USD|GOLD)\b",
    "stop": r"\b(SL|S/L|STOP\s*LOSS|STOPLOSS)\b[\s:\-.@]*?(\d+(?:\.\d+)?)",
    "tp": r"\bTP\s*\d?\b[\s:\-.@]*?(\d+(?:\.\d+)?)",
    "take_profit": r"\bTAKE\s*PROFIT\s*\d?\b[\s:\-.@]*?(\d+(?:\.\d+)?)",
    "range": r"(?i)\b(\d{3,5}(?:\.\d+)?)\s*(?:-|/|to)\s*(\d{3,5}(?:\.\d+)?)\b",
    "entry_word": r"\b(?:ENTRY(?:\s*PRICE)?|PRICE|AT)\b\s*[:\-]?\s*(\d+(?:\.\d+)?)",
    "number": r"\d+(?:\.\d+)?",
    "outcome_line": r"\b(HIT|HITS|TAPPED?|RAN|RUNNING|RUNS|SECURED?|BOOK(?:ED)?|CLOSE(?:D)?|CLOSING|STOPPED|REACHED|ACHIEVED|TARGET\s+HIT)\b",
}

# Follow-up patterns, without regard to case.
FOLLOW_UP = {
    "tp_hit": r"\bTP\s*(\d+)\b(?:[^A-Za-z0-9\n]{0,12})\b(?:HIT|HITS|REACHED|ACHIEVED|TAPPED?|BOOK(?:ED)?|SUCCESSFUL|SUCCESS|DONE|COMPLETE[D]?|SECURED)\b",
    "hit_tp": r"\b(?:HIT|REACHED|ACHIEVED|TAPPED?|BOOK(?:ED)?|SUCCESSFUL|SECURED)\b\s+TP\s*(\d+)\b",
    "all_tps": r"\bALL\s+TP[S]?\s+(?:HIT|HITS|REACHED)\b",
    "sl_hit": r"\bSL\s+(?:HIT|HITS|TAKEN|STOPPED\s+OUT|STRUCK)\b",
    "stopped_out": r"\bSTOPPED\s+OUT\b|\bSTOP\s+(?:LOSS\s+)?HIT\b",
    "break_even": r"\b(?:MOVE\s+SL\s+(?:TO\s+)?(?:BE|BREAK\s*EVEN|ENTRY)|BREAK\s*EVEN\s+(?:SECURED|HIT)|BE\s+SECURED|SL\s+TO\s+(?:BE|ENTRY|BREAK\s*EVEN))\b",
    "sl_moved": r"\bMOVE\s+SL\s+(?:TO\s+)?(\d+(?:\.\d+)?)\b|\bSL\s+(?:NOW\s+)?(?:AT\s+|MOVED\s+TO\s+)(\d+(?:\.\d+)?)\b|\bUPDATE\s+SL\s+(?:TO\s+)?(\d+(?:\.\d+)?)\b",
    "cancel": r"\b(CANCEL(?:LED|LING)?|VOID(?:ED|ING)?|IGNORE\s+(?:THE\s+)?SIGNAL)\b",
    "manual_close": r"\b(CLOSE\s+ALL|CLOSE\s+(?:THE\s+)?TRADE|CLOSED\s+AT|CLOSING\s+(?:THE\s+)?TRADE|EXIT\s+(?:THE\s+)?TRADE|FULL\s+CLOSE|CLOSE\s+NOW|CLOSE\s+(?:THE\s+)?POSITION)\b",
    "pips": r"([+\-]?)\s*(\d{1,4})\s*\+?\s*PIPS?\b",
    "at_price": r"\bAT\s+(\d+(?:\.\d+)?)\b",
}

# Line ends besides the line feed, wide spaces, full-width digits.
LINE_ENDS = "[\n\u000b\u000c\u001c\u001d\u001e\u0085\u2028\u2029]"
WIDE_SPACES = "\u00a0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u202f\u205f\u3000"
WIDE_DIGITS = "０１２３４５６７８９"


def tidy(text: Column) -> Column:
    """Null to empty, wide spaces to spaces, full-width digits to ASCII."""
    text = F.coalesce(text.cast("string"), F.lit(""))
    return F.translate(text, WIDE_SPACES + WIDE_DIGITS, " " * len(WIDE_SPACES) + "0123456789")


def strip(text: Column) -> Column:
    """Without white space at either end."""
    return F.regexp_replace(text, r"^[\s\u001c-\u001f\u0085\u2028\u2029]+|[\s\u001c-\u001f\u0085\u2028\u2029]+$", "")


def has(text: Column, pattern: str) -> Column:
    """Whether the pattern occurs, without regard to case."""
    return text.rlike("(?i)" + pattern)


def first_of(text: Column, pattern: str, group: int) -> Column:
    """The group of the first match, null without one."""
    return F.nullif(F.regexp_extract(text, "(?i)" + pattern, group), F.lit(""))


def all_of(text: Column, pattern: str, group: int) -> Column:
    """The group of every match, in order."""
    return F.regexp_extract_all(text, F.lit("(?i)" + pattern), F.lit(group))


def number(text: Column) -> Column:
    return text.try_cast("double")


def in_band(price: Column, low: float, high: float) -> Column:
    return price.between(F.lit(low), F.lit(high))


def reasons(*named: tuple[Column, Column | str]) -> Column:
    """The texts whose condition holds, in order."""
    return F.array_compact(F.array(*[F.when(c, F.lit(t) if isinstance(t, str) else t) for c, t in named]))


def settle(df: DataFrame) -> DataFrame:
    """The same rows, their columns computed once.

    A filter above a projection is rewritten into its expressions and so runs
    them again, each as often as it is named; it does not pass a generator.
    """
    return df.select(F.inline(F.array(F.struct(*[F.col(f"`{c}`") for c in df.columns]))))
