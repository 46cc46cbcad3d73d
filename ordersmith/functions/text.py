"""Text functions (F6 F7 F8 F13), all JVM-side column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# A word is a run of letters or digits; everything else separates words.
_PIECES = r"([\p{L}\p{N}]+|[^\p{L}\p{N}]+)"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def initcap_words(c) -> Column:
    """upper-case the first character of every word, lower-case the rest.

    Unlike Spark's ``initcap`` (which only splits at blanks) a word ends at any
    character that is not a letter or digit: ``santa barbara d'oeste`` ->
    ``Santa Barbara D'Oeste``, ``mogi-mirim`` -> ``Mogi-Mirim``. Null stays null.
    """
    pieces = F.regexp_extract_all(_col(c), F.lit(_PIECES), 1)
    return F.array_join(
        F.transform(pieces, lambda w: F.concat(F.upper(F.left(w, F.lit(1))),
                                               F.lower(F.substring(w, 2, 1 << 30)))),
        "",
    )


def strip(c) -> Column:
    """Text without white space of any kind at its ends (the loader's form of trimming)."""
    return F.regexp_replace(_col(c), r"^\s+|\s+$", "")


def title_words(c) -> Column:
    """F6, loader form: a word is a run of letters, so ``bairro 2a`` -> ``Bairro 2A``."""
    pieces = F.regexp_extract_all(_col(c), F.lit(r"(\p{L}+|[^\p{L}]+)"), 1)
    return F.array_join(F.transform(pieces, lambda w: F.concat(
        F.upper(F.left(w, F.lit(1))), F.lower(F.substring(w, 2, 1 << 30)))), "")


def loader_city(c) -> Column:
    """F6+F7 as the loader writes it: stripped, then title case."""
    return title_words(strip(c))


def loader_state(c) -> Column:
    return F.upper(strip(c))


def normalize_city(c) -> Column:
    """F6+F7 as the models write it: ``initcap(trim(city))``."""
    return initcap_words(F.trim(_col(c)))


def normalize_state(c) -> Column:
    """``upper(trim(state))``."""
    return F.upper(F.trim(_col(c)))


def surrogate_key(c) -> Column:
    """F8: lower-case hex md5 of the id; null in, null out."""
    return F.md5(_col(c).cast("string"))


def short_id(c, n: int = 8) -> Column:
    """first ``n`` characters followed by an ellipsis."""
    return F.concat(F.substring(_col(c), 1, n), F.lit("…"))


def money_text(c, currency: str = "R$") -> Column:
    """``R$1,234`` (no decimals, thousands separated)."""
    return F.concat(F.lit(currency), F.format_number(_col(c).cast("double"), 0))
