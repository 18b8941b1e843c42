"""Text and lookup helpers (C-S1 … C-S3, R-S1, R-S2, M-S1)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values that must equal the reference's output.
#   trade id pattern: a type code SP, FW or SW followed by 12 digits
#   trade type codes: spot = SP, forward = FW, swap = SW
#   change markers (format prefix): up "▲ ", down "▼ ", no change "- -"
#   change colours: up "#1F7A4D", down "#7A0C1E", no change "#808080"
#   bank theme colours: SAN "#EC0000", CITI "#003B70", HSBC "#800020",
#     JPM "#117ACA", FXPB "#E28743", anything else "#888888"
#   utilisation texts: "<n> Banks above 75% of their credit utilization" /
#     "All banks below 75% of their credit utilization";
#     "<n> banks above breaching 100% of their credit utilization" /
#     "No breaches"
# ---------------------------------------------------------------------------
TRADE_ID_PATTERN = r"^(SP|FW|SW)\d{12}$"
TRADE_TYPE_CODES = {"spot": "SP", "forward": "FW", "swap": "SW"}
UP_MARK, DOWN_MARK, FLAT_MARK = "▲ ", "▼ ", "- -"
UP_COLOUR, DOWN_COLOUR, FLAT_COLOUR = "#1F7A4D", "#7A0C1E", "#808080"
BANK_THEME_COLOURS = {"SAN": "#EC0000", "CITI": "#003B70", "HSBC": "#800020",
                      "JPM": "#117ACA", "FXPB": "#E28743"}
BANK_THEME_DEFAULT = "#888888"
WARN_TEXT = " Banks above 75% of their credit utilization"
WARN_NONE_TEXT = "All banks below 75% of their credit utilization"
BREACH_TEXT = " banks above breaching 100% of their credit utilization"
BREACH_NONE_TEXT = "No breaches"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# C-S1 change_direction
def change_marker(x) -> Column:
    x = _c(x)
    return (F.when(x > 0, F.lit(UP_MARK)).when(x < 0, F.lit(DOWN_MARK))
            .otherwise(F.lit(FLAT_MARK)))


def change_colour(x) -> Column:
    x = _c(x)
    return (F.when(x > 0, F.lit(UP_COLOUR)).when(x < 0, F.lit(DOWN_COLOUR))
            .otherwise(F.lit(FLAT_COLOUR)))


# C-S2 code_map: small literal mapping with a default
def code_map(c, mapping: dict, default=None) -> Column:
    m = F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])
    out = F.try_element_at(m, _c(c))
    return out if default is None else F.coalesce(out, F.lit(default))


# C-S3 compact_number: 1.23M / 46K / 789; a change as "+ 1.23M", "- 46K", "- 0"
def compact_number(x) -> Column:
    """Millions with two decimals, thousands with none, smaller values with
    grouped digits and none; halves round to even."""
    x = _c(x).cast("double")
    ax = F.abs(x)
    sign = F.when(x < 0, F.lit("-")).otherwise(F.lit(""))
    return (F.when(x.isNull(), F.lit(None))
            .when(ax >= 1e6, F.concat(sign, F.format_string("%.2fM", F.bround(ax / 1e6, 2))))
            .when(ax >= 1e3, F.concat(sign, F.format_string("%.0fK", F.bround(ax / 1e3, 0))))
            .otherwise(F.concat(sign, F.format_string("%,.0f", F.bround(ax, 0)))))


def signed_compact(x) -> Column:
    x = _c(x).cast("double")
    return (F.when(x.isNull(), F.lit(None)).when(x > 0, F.concat(F.lit("+ "), compact_number(x)))
            .when(x < 0, F.concat(F.lit("- "), compact_number(F.abs(x)))).otherwise(F.lit("- 0")))


# R-S1 regex_id_check
def is_valid_trade_id(c) -> Column:
    return F.coalesce(_c(c).rlike(TRADE_ID_PATTERN), F.lit(False))


# R-S2 text_build
def sweep_id(from_acct, to_acct) -> Column:
    return F.concat(F.lit("SWEEP-"), _c(from_acct).cast("string"), F.lit("-"),
                    _c(to_acct).cast("string"))


def strip_dashes(c) -> Column:
    return F.regexp_replace(_c(c), "-", "")


def daily_id(prefix, d, seq, width: int) -> Column:
    """prefix + yyyymmdd + zero-padded sequence (W12).  A sequence of more
    than ``width`` digits raises: padding would cut it and repeat an id."""
    n = _c(seq)
    too_long = F.raise_error(F.concat(F.lit("daily sequence overflow: "), n.cast("string"), F.lit(" on "), _c(d).cast("string")))
    return F.concat(_c(prefix), F.date_format(_c(d), "yyyyMMdd"),
                    F.when(n > 10 ** width - 1, too_long.cast("string")).otherwise(F.lpad(n.cast("string"), width, "0")))


# M-S1 map_get: absent key → NULL
def map_get(m, key) -> Column:
    return F.try_element_at(_c(m), key if isinstance(key, Column) else F.lit(key))
