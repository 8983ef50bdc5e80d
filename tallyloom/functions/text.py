"""Text normalisation as native column expressions."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallyloom.functions.labels import CORPORATE_DOMAINS, PERSONAL_DOMAINS

# (?U) makes \s cover every Unicode space; the four separators below it are added by hand.
_SPACE = r"[\s\x1c-\x1f]"
_EDGES = rf"(?U)\A{_SPACE}+|{_SPACE}+\z"

_CASED = r"\p{IsUppercase}\p{IsLowercase}\p{IsTitlecase}"
_RUNS = rf"([{_CASED}]+|[^{_CASED}]+)"


def strip(text: Column) -> Column:
    """Remove whitespace of every kind from both ends (``trim`` knows blanks only)."""
    return F.regexp_replace(text, _EDGES, "")


def title(text: Column) -> Column:
    """Capitalise each run of letters, so that ``o'brien 3rd`` gives ``O'Brien 3Rd``.

    ``initcap`` alone starts a word at blanks only; here the text is cut wherever letters
    with case begin or end, and every piece is capitalised on its own.
    """
    runs = F.regexp_extract_all(text, F.lit(_RUNS), F.lit(1))
    return F.array_join(F.transform(runs, F.initcap), "")


def email_domain(email: Column) -> Column:
    """The piece after the first ``@``; null when there is none, '' for ``x@``."""
    return F.get(F.split(email, "@"), F.lit(1))


def customer_segment(domain: Column) -> Column:
    """Corporate, Personal, Unknown (empty domain) or Other (also for a missing domain)."""
    return (
        F.when(domain == "", "Unknown")
        .when(domain.isin(*CORPORATE_DOMAINS), "Corporate")
        .when(domain.isin(*PERSONAL_DOMAINS), "Personal")
        .otherwise("Other")
    )


def or_raise(value: Column, given: Column, complaint: str) -> Column:
    """``value``, or an error that names ``given`` if that is there and ``value`` is not."""
    wrong = given.isNotNull() & value.isNull()
    message = F.concat(F.lit(f"{complaint}: "), given.cast("string"))
    return F.when(wrong, F.raise_error(message)).otherwise(value)
