"""Column expressions shared by the operators.

All of them are native Catalyst expressions (no Python UDF), so they stay
inside whole-stage codegen. Each keeps the NULL semantics of the non-ANSI
behaviour the domain relies on while the session itself may run with ANSI on:
text casts use ``try_cast``, array access uses ``get``, division uses
``try_divide``.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_cr(c: ColumnOrName) -> Column:
    """Remove every carriage return (literal replace, no regex engine)."""
    return F.replace(col(c), F.lit("\r"), F.lit(""))


CONTROL_AND_SPACE = "".join(chr(i) for i in (*range(33), 127))


def text_to_integer(c: ColumnOrName, dtype: str = "bigint") -> Column:
    """Text -> integer with the non-ANSI cast rules the domain data was
    produced under: characters up to the space and U+007F are trimmed, an optional sign,
    then digits with an optional fraction that is truncated ('1200.0' -> 1200,
    '-7.5' -> -7, '.5' -> 0, '.' -> 0); anything else ('$1', '1,000', '1e6',
    '', a bare sign) and overflow give NULL. An ANSI ``cast`` would raise and
    ``try_cast`` would turn '1200.0' into NULL instead; it also makes an
    exception of each text it cannot read, so it sees only text that matched."""
    t = F.trim(col(c), F.lit(CONTROL_AND_SPACE))
    whole = F.get(F.regexp_extract_all(t, F.lit(r"^([+-]?[0-9]+)(?:\.[0-9]*)?\z"), 1), 0)  # $ would also match before a line terminator
    return F.coalesce(whole.try_cast(dtype), F.when(t.rlike(r"^[+-]?\.[0-9]*\z"), F.lit(0).cast(dtype)))


def season_start_year(c: ColumnOrName) -> Column:
    """First four characters as an int; NULL when they are not a number."""
    return text_to_integer(F.substring(col(c), 1, 4), "int")


def within(c: ColumnOrName, lo: float, hi: float) -> Column:
    """Value when lo <= value <= hi, else NULL (NULL and NaN give NULL)."""
    x = col(c)
    return F.when(x.between(F.lit(lo), F.lit(hi)), x)


def not_blank(c: ColumnOrName) -> Column:
    x = col(c)
    return x.isNotNull() & (x != "")


def not_sentinel(c: ColumnOrName, sentinels: Iterable[str]) -> Column:
    """True when the value is non-NULL and not one of the sentinel strings."""
    x = col(c)
    return x.isNotNull() & ~x.isin(list(sentinels))


def ratio(num: ColumnOrName, den: ColumnOrName) -> Column:
    """num / den as double, NULL when den is 0 or NULL."""
    return F.try_divide(col(num).cast("double"), col(den).cast("double"))


def literal_map(mapping: Mapping[str, object]) -> Column:
    """A constant map column; constant-folded by Catalyst."""
    items: list[Column] = []
    for k, v in mapping.items():
        items += [F.lit(k), F.lit(v)]
    return F.create_map(*items)


def lookup(mapping: Mapping[str, object], key: ColumnOrName) -> Column:
    """Map lookup; a missing or NULL key gives NULL."""
    return literal_map(mapping)[col(key)]


def q(name: str) -> str:
    """A column name quoted for SQL text."""
    return "`" + name.replace("`", "``") + "`"


def sql_text(value: str) -> str:
    """A string literal for SQL text, with quotes and backslashes escaped."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def sql_num(x: float) -> str:
    """A double literal for SQL text (``0.12D``), so comparisons and products
    widen like a Column comparison with a Python float."""
    return f"{float(x)!r}D"


def weighted_sum_sql(terms: Iterable[tuple[str, float]]) -> str:
    """SQL text of sum(w * c), left to right; negative weights subtract."""
    out = ""
    for c, w in terms:
        t = f"{sql_num(abs(w))} * {q(c)}"
        out = (t if w >= 0 else f"-({t})") if not out else f"{out} {'+' if w >= 0 else '-'} {t}"
    if not out:
        raise ValueError("weighted_sum needs at least one term")
    return out


def weighted_sum(terms: Iterable[tuple[ColumnOrName, float]]) -> Column:
    """sum(w * c) evaluated left to right, in the order given."""
    terms = list(terms)
    if all(isinstance(c, str) for c, _ in terms):
        return F.expr(weighted_sum_sql(terms))
    out: Column | None = None
    for c, w in terms:
        t = F.lit(abs(float(w))) * col(c)
        if out is None:
            out = t if w >= 0 else -t
        else:
            out = out + t if w >= 0 else out - t
    if out is None:
        raise ValueError("weighted_sum needs at least one term")
    return out
