"""Review links and formatted evidence text."""
from pyspark.sql import Column, functions as F

from .. import fixed_values as fv
from .labels import quote_symbol


def _parts(acc: Column, icik: Column | None):
    a = F.regexp_replace(F.coalesce(acc, F.lit("")), "[^0-9-]", "")
    plain = F.translate(a, "-", "")
    given = F.regexp_replace(F.coalesce(icik, F.lit("")) if icik is not None else F.lit(""), "[^0-9]", "")
    cik = F.coalesce(F.nullif(F.ltrim(given, F.lit("0")), F.lit("")), F.ltrim(F.substring(plain, 1, 10), F.lit("0")))
    return a, plain, cik


def _archive_url(a: Column, plain: Column, cik: Column, tail: str) -> Column:
    url = F.concat(F.lit(fv.FILING_ARCHIVE), cik, F.lit("/"), plain, F.lit("/"), a, F.lit(tail))
    return F.when(a == "", F.lit("")).otherwise(url)


def filing_url(acc: Column, icik: Column | None = None) -> Column:
    """Index page of a filing; the issuer's number is preferred over the accession prefix."""
    return _archive_url(*_parts(acc, icik), "-index.htm")


def filing_text_url(acc: Column, icik: Column | None = None) -> Column:
    return _archive_url(*_parts(acc, icik), ".txt")


def filing_url_ok(url: Column, acc: Column, icik: Column) -> Column:
    """True for the four accepted spellings: page or text, number padded or not."""
    a, plain, cik = _parts(acc, icik)
    padded = F.when(F.length(cik) < 10, F.lpad(cik, 10, "0")).otherwise(cik)
    forms = [_archive_url(a, plain, c, tail) for c in (cik, padded) for tail in ("-index.htm", ".txt")]
    same = F.lit(False)
    for f in forms:
        same = same | (url == f)
    return F.coalesce((a != "") & (url != "") & same, F.lit(False))


def history_url(tk: Column) -> Column:
    sym = quote_symbol(tk)
    return F.when(sym == "", F.lit("")).otherwise(F.format_string(fv.PRICE_HISTORY_URL, sym))


def second_history_url(tk: Column) -> Column:
    sym = quote_symbol(tk)
    return F.when(sym == "", F.lit("")).otherwise(F.format_string(fv.SECOND_HISTORY_URL, F.lower(sym)))


def corporate_action_url(icik: Column) -> Column:
    return F.format_string(fv.CORPORATE_ACTION_URL, F.coalesce(icik, F.lit("")))


def money_text(x: Column) -> Column:
    body = F.concat(F.when(x < 0, F.lit("$-")).otherwise(F.lit("$")), F.format_number(F.abs(x), 2))
    return F.when(x.isNull(), F.lit("not reported")).otherwise(body)


def shares_text(x: Column) -> Column:
    """Whole numbers without decimals, others with at most four, trailing zeros dropped."""
    sign = F.when(x < 0, F.lit("-")).otherwise(F.lit(""))
    whole = F.format_number(F.abs(x), 0)
    part = F.regexp_replace(F.regexp_replace(F.format_number(F.abs(x), 4), "0+$", ""), r"\.$", "")
    body = F.when(F.abs(x - F.rint(x)) < 1e-9, whole).otherwise(part)
    return F.when(x.isNull(), F.lit("not reported")).otherwise(F.concat(sign, body))


def evidence_text(r) -> Column:
    """One line a reviewer can check against the filing. ``r`` maps a column name to a Column."""
    def said(name, otherwise):
        v = r(name).cast("string")
        return F.when(F.coalesce(v, F.lit("")) == "", F.lit(otherwise)).otherwise(v)

    price = F.when(r("px").isNull(), F.lit("no reported price")).otherwise(money_text(r("px")))
    value = F.when(r("val").isNull(), F.lit("no reported value")).otherwise(money_text(F.abs(r("val"))))
    table = F.when(F.coalesce(r("der"), F.lit(0)) != 0, F.lit("Table II derivative")).otherwise(
        F.lit("Table I non-derivative"))
    return F.concat(said("acc", ""), F.lit(": "), said("fd", ""), F.lit(" filing; "),
                    said("td", "no transaction date"), F.lit(" transaction; "), said("tk", "no ticker"), F.lit(" "),
                    said("co", ""), F.lit("; "), said("insider", "unknown insider"), F.lit("; "), table,
                    F.lit("; code "), said("code", "?"), F.lit("; "), shares_text(r("sh")), F.lit(" shares @ "),
                    price, F.lit("; value "), value, F.lit("."))
