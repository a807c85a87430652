"""Scalar column helpers (X-1 … X-5): thin, JVM-side expressions only.

Each helper returns a :class:`~pyspark.sql.Column` built from built-in Spark
functions, so it stays inside whole-stage codegen. They encode the pandas
semantics the reference relies on (Unicode strip, coercing parses, guarded
division, NULL-preserving clip, text booleans).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- X-1 strings ------------------------------------------------------------


def col_(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_unicode(c) -> Column:
    """Python ``str.strip()``: remove leading/trailing Unicode white space."""
    ws = r"[\s\p{Z}\x{1C}-\x{1F}\x{85}]"   # exactly the characters str.isspace() accepts
    return F.regexp_replace(col_(c), f"^{ws}+|{ws}+$", "")


def normalize_key(c) -> Column:
    """``lower(strip(x))`` — the player join key."""
    return F.lower(strip_unicode(c))


def contains_either(a, b) -> Column:
    """Case-insensitive containment in either direction."""
    la, lb = F.lower(col_(a)), F.lower(col_(b))
    return F.contains(la, lb) | F.contains(lb, la)


def label(name, league) -> Column:
    """``"name (LEAGUE)"`` display label."""
    return F.concat(col_(name), F.lit(" ("), col_(league), F.lit(")"))


def join_sorted(arr, sep: str = " | ") -> Column:
    """Sorted array joined to text (stable text form of a set)."""
    return F.array_join(F.array_sort(col_(arr)), sep)


# --- X-2 dates ----------------------------------------------------------------


def parse_ts(c) -> Column:
    """Parse a date or date-time string, NULL when unparseable (never raises).

    Accepts ``yyyy-MM-dd``, ``yyyy-MM-dd HH:mm:ss[.ffffff]`` and the ``T`` form.
    """
    return F.try_to_timestamp(col_(c).cast("string"))


def add_months_keep_time(ts, months: int) -> Column:
    """``ts + months`` keeping the time of day and clamping month ends.

    Equals pandas ``DateOffset(months=m)`` (``add_months`` would drop the time).
    """
    return col_(ts) + F.make_interval(F.lit(0), F.lit(int(months)))


def iso_day(c) -> Column:
    return F.date_format(col_(c), "yyyy-MM-dd")


# --- X-3 numeric ----------------------------------------------------------------


def safe_ratio(num, den, default=0.0) -> Column:
    """``num/den`` when ``den > 0`` else ``default`` (ANSI-safe)."""
    den = col_(den)
    return F.when(den > 0, col_(num) / den).otherwise(F.lit(default))


def clip(c, lo: float, hi: float) -> Column:
    """pandas ``clip``: NULL stays NULL (``least``/``greatest`` skip NULLs)."""
    c = col_(c)
    return F.when(c.isNull(), F.lit(None)).otherwise(
        F.least(F.greatest(c, F.lit(float(lo))), F.lit(float(hi))))


def to_number(c) -> Column:
    """``pd.to_numeric(errors='coerce')``: NULL for text that is not a number; NaN → NULL."""
    v = col_(c).cast("string").try_cast("double")
    return F.nanvl(v, F.lit(None).cast("double"))


def nan_to_null(c) -> Column:
    return F.nanvl(col_(c), F.lit(None).cast("double"))


def floor_at(c, lo: float) -> Column:
    return F.greatest(col_(c), F.lit(lo))


# --- X-4 null / boolean ---------------------------------------------------------


def text_bool(c) -> Column:
    """Repair a boolean read back from text: ``lower(trim(x)) == 'true'`` (or 1)."""
    s = F.lower(F.trim(col_(c).cast("string")))
    return F.coalesce(s.isin("true", "1", "1.0"), F.lit(False))


def all_not_null(cols) -> Column:
    """True when every listed column is non-NULL."""
    out = None
    for c in cols:
        e = col_(c).isNotNull()
        out = e if out is None else (out & e)
    return out if out is not None else F.lit(True)


def not_in(c, values) -> Column:
    return ~col_(c).isin(list(values)) | col_(c).isNull()


# --- X-5 nested -----------------------------------------------------------------
