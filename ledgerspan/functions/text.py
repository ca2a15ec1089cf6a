"""Text normalisation as Column expressions; all of them stay inside whole-stage codegen."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Characters that count as blank at either end of a text.
BLANKS = (
    " \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007"
    "\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)
# The only accents the enum slug folds, position by position.
ACCENTED = "áàãâéêíóôõúç"
UNACCENTED = "aaaaeeiooouc"
SLUG_SHAPE = r"\A[a-z0-9]++(?:_[a-z0-9]++)*+\z"
# Identifier formats.
CNPJ_FORMAT = r"\d{14}"
CNPJ_ROOT_FORMAT = r"\d{8}"
CONTRACT_ID_FORMAT = r"CS\d{8}"
PAYMENT_ID_FORMAT = r"PAG\d{8}"
RISK_ID_FORMAT = r"RSK\d{9}"
COST_CENTER_FORMAT = r"CC-\d{3}"


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c: Column | str) -> Column:
    """Trim blanks of any kind at both ends; NULL stays NULL.

    Text that starts and ends with a visible ASCII character (nearly all of it) is passed through:
    the check is several times cheaper than a trim against the full list of blanks.
    """
    c = col(c)
    first, last = F.ascii(c), F.ascii(F.substring(c, -1, 1))
    return F.when(first.between(33, 126) & last.between(33, 126), c).otherwise(F.trim(c, F.lit(BLANKS)))


def strip_to_null(c: Column | str) -> Column:
    return F.nullif(strip(c), F.lit(""))


def strip_upper(c: Column | str) -> Column:
    return F.upper(strip(c))


def digits_only(c: Column | str) -> Column:
    return F.coalesce(F.regexp_replace(col(c), "[^0-9]", ""), F.lit(""))


def code(c: Column | str) -> Column:
    return F.coalesce(strip_upper(c), F.lit(""))


def enum_slug(c: Column | str) -> Column:
    """Stable technical value of a label: `Licença de Software` -> `licenca_de_software`.

    Blanks at the ends need no trim of their own: they turn into `_` and go with it. Accents are folded only in
    text that has any, and words with one blank between them need no regular expression to replace it.
    """
    c = col(c)
    unaccented = F.when(_is_ascii(c), c).otherwise(F.translate(c, ACCENTED, UNACCENTED))
    # Lower-casing ASCII is cheap; only text that still has other letters is lower-cased before it is folded.
    folded = F.when(_is_ascii(unaccented), F.lower(unaccented)).otherwise(F.translate(F.lower(c), ACCENTED, UNACCENTED))
    spaced = F.replace(folded, F.lit(" "), F.lit("_"))
    slug = F.when(spaced.rlike(SLUG_SHAPE), spaced).otherwise(F.trim(F.regexp_replace(folded, "[^a-z0-9]+", "_"), F.lit("_")))
    return F.coalesce(slug, F.lit(""))


def _is_ascii(c: Column) -> Column:
    return F.octet_length(c) == F.length(c)


def group_root(cnpj: Column | str) -> Column:
    return F.substring(col(cnpj), 1, 8)


def matches(c: Column | str, pattern: str) -> Column:
    """Whole-text match; NULL is a non-match. `\\z` (not `$`) also refuses a trailing newline."""
    return F.coalesce(col(c).rlike(rf"\A(?:{pattern})\z"), F.lit(False))


def member(c: Column | str, values) -> Column:
    """Membership where NULL is not a member, so its negation fires on NULL."""
    return F.coalesce(col(c).isin(*values), F.lit(False))


def blank(c: Column | str) -> Column:
    c = col(c)
    return c.isNull() | (c == "")


def category_label(code_column: Column | str) -> Column:
    """Readable label of an unmapped category: only the first letter is upper case."""
    spaced = F.replace(col(code_column), F.lit("_"), F.lit(" "))
    return F.concat(F.upper(F.substring(spaced, 1, 1)), F.lower(F.substring(spaced, 2, 1_000_000)))


def prefixed_key(prefix: str, *parts: Column | str) -> Column:
    """Deterministic surrogate key: no sequence generator, so no shuffle and no driver state."""
    return F.concat(F.lit(prefix), F.concat_ws("-", *[col(p).cast("string") for p in parts]))
