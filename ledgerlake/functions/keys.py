"""Key normalisation and scalar parsing as Spark Column expressions.

Every function here maps Column -> Column and compiles to built-in Catalyst
expressions (regexp_replace, try_cast, split, lpad, ...), so it runs inside
whole-stage codegen with no Python in the hot path.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Characters Python's str.isprintable() rejects: categories C* and Z*, except
# the ASCII space. Tabs / CR / LF are turned into spaces before this runs.
_NON_PRINTABLE = "[\\p{C}\\p{Z}&&[^ ]]"
_NUMBER = "^\\s*([+-]?(?:\\d+(?:\\.\\d*)?|\\.\\d+)(?:[eE][+-]?\\d+)?)\\s*$"

FLOAT_TYPES = ("double", "float")
INTEGRAL_TYPES = ("bigint", "int", "smallint", "tinyint")


def col_of(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


# Python's str.strip() whitespace set, for a character-set trim (no regex).
_PY_SPACE_CHARS = (
    " \t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x85\xa0\u1680"
    + "".join(chr(c) for c in range(0x2000, 0x200B))
    + "\u2028\u2029\u202f\u205f\u3000"
)


def py_strip(c: str | Column) -> Column:
    """Trim Unicode whitespace at both ends (Spark's one-argument trim only
    removes ' '); a character-set trim, no regex."""
    return F.trim(col_of(c), F.lit(_PY_SPACE_CHARS))


def as_text(c: str | Column, dtype: str = "string") -> Column:
    """Render a value as text the way Python's ``str()`` does for the common
    cases: whole floats keep one ``.0`` (``64380201.0``), other floats use the
    shortest decimal form instead of Java's scientific ``6.4E7``."""
    x = col_of(c)
    if dtype in FLOAT_TYPES:
        x = x.cast("double")
        finite = ~F.isnan(x) & (F.abs(x) < F.lit(1e16))
        whole = finite & (x == F.floor(x))
        frac = F.regexp_replace(x.try_cast("decimal(38,16)").cast("string"), "0+$", "")
        return (
            F.when(x.isNull() | F.isnan(x), F.lit(None).cast("string"))
            .when(whole, F.concat(x.cast("decimal(38,0)").cast("string"), F.lit(".0")))
            .when(finite, frac)
            .otherwise(x.cast("string"))
        )
    return x.cast("string")


def clean_raw(c: str | Column) -> Column:
    """B1 without the empty -> null step: tab/CR/LF -> space, drop
    non-printables, collapse spaces, trim. Building block for keys: the
    single ``nullif`` is applied once, outermost, by the public functions
    (nested ``nullif``s would be inlined as ``if(x = '', null, x)`` and
    evaluate the regex chain twice)."""
    x = col_of(c).cast("string")
    x = F.translate(x, "\t\r\n", "   ")
    x = F.regexp_replace(x, _NON_PRINTABLE, "")
    x = F.regexp_replace(x, " {2,}", " ")
    return F.trim(x)


def clean_text(c: str | Column) -> Column:
    """B1: tab/CR/LF -> space, drop non-printables, collapse spaces, trim,
    empty -> null. Letter case is kept."""
    return F.nullif(clean_raw(c), F.lit(""))


def text_key(c: str | Column) -> Column:
    """B2: ``clean_text`` then upper case (case-insensitive join key)."""
    return F.nullif(F.upper(clean_raw(c)), F.lit(""))


def ident_key(c: str | Column) -> Column:
    """Identifier key, cleaned but case kept."""
    return clean_text(c)


def digits_raw(c: str | Column, dtype: str = "string") -> Column:
    """B4 without the empty -> null step (see ``clean_raw``)."""
    x = col_of(c)
    if dtype in FLOAT_TYPES:
        d = x.cast("double")
        text = (
            F.when(d.isNull() | F.isnan(d), F.lit(None).cast("string"))
            .when((F.abs(d) < F.lit(1e38)) & (d == F.floor(d)), d.cast("decimal(38,0)").cast("string"))
            .otherwise(as_text(d, "double"))
        )
    else:
        text = x.cast("string")
    # one pass: a trailing ".0+" and every non-digit go; the alternation
    # removes ".000" only where it ends the text, exactly like dropping it
    # first and stripping non-digits after
    return F.regexp_replace(py_strip(text), "\\.0+$|\\P{Nd}", "")


def digits_key(c: str | Column, dtype: str = "string") -> Column:
    """Identifier reduced to its digits; leading zeros kept.

    Whole floats become integer text first (``6438020101.0`` -> ``6438020101``)
    via an exact decimal cast, never ``cast(double as string)``, which would
    give ``6.438020101E9``. A trailing ``.0+`` is dropped before the non-digits
    are removed, so ``"64380201.0"`` keeps its eight digits.
    """
    return F.nullif(digits_raw(c, dtype), F.lit(""))


def strip_trailing_zero(c: str | Column) -> Column:
    """``+123.00`` -> ``+123``; anything else is just cleaned. The cleaned
    text is an input of one expression only: a branch on it would evaluate the
    regex chain again in each of its places."""
    return F.nullif(F.regexp_replace(clean_raw(c), "^([+-]?\\p{Nd}+)\\.0+$", "$1"), F.lit(""))


def to_number(c: str | Column, dtype: str = "string") -> Column:
    """Numeric value or null (pandas ``to_numeric(errors='coerce')``).

    Text must look like a decimal number; ``try_cast`` alone would accept
    ``'1d'`` and ``'NaN'``. NaN becomes null. The input is evaluated once.
    """
    x = col_of(c)
    if dtype in FLOAT_TYPES or dtype in INTEGRAL_TYPES or dtype.startswith("decimal") or dtype == "boolean":
        return F.nanvl(x.cast("double"), F.lit(None).cast("double"))
    # no match gives '', which is no number
    return F.regexp_extract(x.cast("string"), _NUMBER, 1).try_cast("double")


def to_text(c: str | Column) -> Column:
    """Value as text with ``''`` -> null."""
    return F.nullif(col_of(c).cast("string"), F.lit(""))


def is_blank(c: str | Column) -> Column:
    """Null, empty or whitespace-only."""
    return F.coalesce(clean_raw(c) == "", F.lit(True))


def _quote(literal: str) -> str:
    if "\\E" in literal:
        return "".join("\\" + ch if not ch.isalnum() else ch for ch in literal)
    return "\\Q" + literal + "\\E"


def segment_key(
    c: str | Column,
    delimiter: str,
    in_widths: Sequence[int],
    out_widths: Sequence[int],
) -> Column:
    """Split on a literal delimiter, require every segment to be digits of
    exactly ``in_widths[i]`` characters (spaces around a segment are
    trimmed), left-pad each to ``out_widths[i]`` and concatenate. Anything
    else -> null.

    Compiled to one anchored regex over the cleaned text: ``rlike`` validates
    and a single ``regexp_replace`` emits the key. Because every segment has
    an exact width, padding is a constant run of zeros in the replacement
    (zfill never truncates, so a narrower target keeps the segment)."""
    if len(in_widths) != len(out_widths):
        raise ValueError("out_widths must give one target width per input segment")
    cleaned = clean_raw(c)
    sep = f" *{_quote(delimiter)} *" if delimiter else ""
    groups = [f"(\\p{{Nd}}{{{int(w)}}})" for w in in_widths]
    pattern = "^ *" + sep.join(groups) + " *$"
    replacement = "".join("0" * max(int(wo) - int(wi), 0) + f"${i + 1}" for i, (wi, wo) in enumerate(zip(in_widths, out_widths)))
    return F.when(cleaned.rlike(pattern), F.regexp_replace(cleaned, pattern, replacement))


def key_for_mode(c: str | Column, mode: str, dtype: str = "string") -> Column:
    """Normalise a key part by mode: ``ndc`` -> digits, ``alnum`` ->
    identifier, anything else (``text``, ``lookup``) -> upper-cased text."""
    # every branch already maps '' to null
    if mode == "ndc":
        return digits_key(c, dtype)
    if mode == "alnum":
        return ident_key(as_text(c, dtype) if dtype in FLOAT_TYPES else c)
    return text_key(as_text(c, dtype) if dtype in FLOAT_TYPES else c)


def compose_key(parts: Sequence[Column]) -> Column:
    """Join normalised parts with ``|``. A single part is the key itself.
    With several parts, a missing part becomes ``''``; a key whose parts are
    all missing is null (it must not match other all-missing keys)."""
    if not parts:
        return F.lit(None).cast("string")
    if len(parts) == 1:
        return parts[0]
    # parts are never '' (keys map empty to null), so "every part missing" is
    # exactly "only separators": one nullif, each part evaluated once
    joined = F.concat_ws("|", *[F.coalesce(p, F.lit("")) for p in parts])
    return F.nullif(joined, F.lit("|" * (len(parts) - 1)))


def lookup_key(ndc: str | Column, customer: str | Column, ndc_dtype: str = "string") -> Column:
    """Canonical ``NDC digits || CUSTOMER TEXT``; either side may be
    missing (partial key); both missing -> null. Built from the raw chains
    with one outer ``nullif`` (``concat_ws`` skips a null side)."""
    return F.nullif(
        F.concat_ws("", digits_raw(ndc, ndc_dtype), F.upper(clean_raw(customer))),
        F.lit(""),
    )


def changed_by_normalising(original: str | Column, key: Column, dtype: str = "string") -> Column:
    """The trimmed original differs from its normalised key."""
    orig = py_strip(as_text(original, dtype))
    return orig.isNotNull() & key.isNotNull() & (orig != key)


def lowered_in(c: str | Column, values: Iterable[str]) -> Column:
    """Trimmed, lower-cased membership; null -> false."""
    vals = [str(v).strip().lower() for v in values]
    return F.coalesce(F.lower(py_strip(col_of(c).cast("string"))).isin(vals), F.lit(False))


def parse_number_text(c: str | Column) -> Column:
    """``' 1,056 '`` -> 1056.0; ``' - '`` -> null."""
    s = F.regexp_replace(col_of(c).cast("string"), ",", "")
    return to_number(py_strip(s))


def parse_date(c: str | Column, patterns: Sequence[str] = ("yyyy-MM-dd", "yyyy-MM-dd HH:mm:ss", "M/d/yy", "M/d/yyyy")) -> Column:
    """First pattern that parses wins; unparseable -> null."""
    x = col_of(c)
    s = py_strip(x.cast("string"))
    return F.coalesce(*[F.try_to_timestamp(s, F.lit(p)) for p in patterns])


def keyword_pattern(keywords: Sequence[str], whole_word: bool = False) -> str:
    quoted = [_quote(k) for k in keywords]
    body = "|".join(quoted)
    if whole_word:
        body = f"(?<![\\p{{L}}\\p{{Nd}}])(?:{body})(?![\\p{{L}}\\p{{Nd}}])"
    return "(?iu)" + body


def keyword_flag(c: str | Column, keywords: Sequence[str], whole_word: bool = False) -> Column:
    """Case-insensitive substring match on any keyword; null -> false."""
    if not keywords:
        return F.lit(False)
    return F.coalesce(col_of(c).cast("string").rlike(keyword_pattern(keywords, whole_word)), F.lit(False))


# Header substrings and the business meaning each one tags,
# checked in this order, first hit wins.
MEANING_RULES: tuple[tuple[tuple[str, ...], str], ...] = (
    (("ndc",), "Potential National Drug Code field"),
    (("material",), "Potential material identifier or description"),
    (("customer", "sold-to", "sold to"), "Potential customer/account field"),
    (("qty", "quantity"), "Potential quantity field"),
    (("date",), "Potential date field"),
    (("lookup",), "Potential composite lookup key"),
)


def meaning_tag(name: str | Column) -> Column:
    """Business meaning of a header from substrings of its lower-cased text."""
    low = F.lower(col_of(name))
    expr = None
    for needles, label in MEANING_RULES:
        cond = F.lit(False)
        for n in needles:
            cond = cond | F.contains(low, F.lit(n))
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr.otherwise(F.lit("UNKNOWN"))
