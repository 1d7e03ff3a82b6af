"""Codes, relationships, tickers, security titles and buckets as column expressions."""
from itertools import chain

from pyspark.sql import Column, functions as F

from .. import fixed_values as fv


def _lookup(pairs, key: Column) -> Column:
    return F.create_map(*[F.lit(x) for x in chain.from_iterable(pairs)])[key]


def code_text(code: Column, source: str = "bulk") -> Column:
    """Description of a transaction code; unlisted codes say so."""
    if source == "bulk":
        known = _lookup([(c, t) for c, _, t in fv.TRANSACTION_CODES if t], code)
    else:
        known = _lookup(list(fv.XML_CODE_TEXT.items()), code)
    unknown = F.concat(F.lit("Unknown code ("), code, F.lit(")"))
    if source == "bulk":
        unknown = F.when(code == "", F.lit("Not reported")).otherwise(unknown)
    return F.coalesce(known, unknown)


def code_side(code: Column) -> Column:
    return F.coalesce(_lookup([(c, s) for c, s, _ in fv.TRANSACTION_CODES], code), F.lit("other"))


def form_root(doc_type: Column) -> Column:
    root = F.trim(F.regexp_replace(F.upper(F.trim(doc_type)), "/A", ""))
    return F.when(F.coalesce(root, F.lit("")) == "", F.lit("4")).otherwise(root)


def amend_flag(doc_type: Column) -> Column:
    return F.when(F.upper(F.trim(doc_type)).endswith("/A"), F.lit(1)).otherwise(F.lit(0))


def strip_cik(cik: Column) -> Column:
    s = F.trim(cik)
    return F.coalesce(F.nullif(F.ltrim(s, F.lit("0")), F.lit("")), s)


def relationship_label(flags: Column, note: Column) -> Column:
    """Delimited owner flags to one ordered label."""
    u = F.upper(F.coalesce(flags, F.lit("")))
    label = F.concat_ws("/",
                        F.when(u.contains("DIRECTOR"), F.lit("Director")),
                        F.when(u.contains("OFFICER"), F.lit("Officer")),
                        F.when(u.contains("TENPERCENT") | u.contains("10PERCENT"), F.lit("10% Owner")),
                        F.when(u.contains("OTHER"), F.lit("Other")))
    empty = F.when(F.coalesce(note, F.lit("")) != "", F.lit("Other")).otherwise(F.lit(fv.NO_RELATIONSHIP))
    return F.when(label == "", empty).otherwise(label)


def normalize_ticker(tk: Column) -> Column:
    return F.translate(F.upper(F.regexp_replace(F.coalesce(tk, F.lit("")), r"\s+", "")), "_", "-")


def quote_symbol(tk: Column, mode: str = "site") -> Column:
    """Ticker as price sources spell it: class shares use a dash."""
    if mode == "engine":
        return F.translate(normalize_ticker(tk), "./", "--")
    t = F.translate(F.upper(F.trim(F.coalesce(tk, F.lit("")))), "./", "--")
    return F.regexp_replace(t, "[^A-Z0-9-]", "")


def valid_ticker(tk: Column, mode: str = "site") -> Column:
    if mode == "engine":
        t = normalize_ticker(tk)
        return t.rlike(fv.ENGINE_TICKER_PATTERN) & ~t.isin(fv.ENGINE_TICKER_JUNK)
    if mode == "audit":
        return F.upper(F.trim(F.coalesce(tk, F.lit("")))).rlike(fv.AUDIT_TICKER_PATTERN)
    t = quote_symbol(tk)
    return t.rlike(fv.SITE_TICKER_PATTERN) & ~t.isin(fv.SITE_TICKER_JUNK)


def _any_of(text: Column, words) -> Column:
    hit = F.lit(False)
    for w in words:
        hit = hit | text.contains(w)
    return hit


def is_common_equity(title: Column, mode: str = "strict", der: Column | None = None) -> Column:
    """``strict`` accepts only titles that name plain equity; ``lenient`` rejects only titles that name
    something else (and Table II rows). The two disagree on purpose, e.g. on class C stock."""
    if mode == "lenient":
        t = F.trim(F.coalesce(title, F.lit("")))
        ok = (t == "") | t.rlike(fv.LENIENT_ADR_PATTERN) | ~t.rlike(fv.LENIENT_NOT_EQUITY_PATTERN)
        return ok if der is None else ok & (F.coalesce(der, F.lit(0)) != 1)
    t = F.lower(F.trim(F.coalesce(title, F.lit(""))))
    plainly_common = t.startswith("common stock") & ~t.contains("option") & ~t.contains("unit")
    return (F.when(t == "", F.lit(True))
            .when(_any_of(t, fv.STRICT_NOT_EQUITY_WORDS), plainly_common)
            .otherwise(_any_of(t, fv.STRICT_EQUITY_WORDS)))


def size_bucket(value: Column, mode: str = "site") -> Column:
    table = fv.SITE_SIZE_BUCKETS if mode == "site" else fv.ENGINE_SIZE_BUCKETS
    out = None
    for limit, name in table[:-1]:
        out = (F if out is None else out).when(value < limit, F.lit(name))
    return out.otherwise(F.lit(table[-1][1]))


def role_bucket(rel: Column, title: Column, mode: str = "site") -> Column:
    r, t = F.coalesce(rel, F.lit("")), F.lower(F.coalesce(title, F.lit("")))
    if mode == "engine":
        r = F.lower(r)
        return (F.when(t.contains("chief executive") | t.rlike(r"\bceo\b"), F.lit("CEO"))
                .when(t.contains("chief financial") | t.rlike(r"\bcfo\b"), F.lit("CFO"))
                .when(r.contains("officer"), F.lit("Officer"))
                .when(r.contains("10%") | r.contains("10 percent"), F.lit("10% Owner"))
                .when(r.contains("director"), F.lit("Director"))
                .otherwise(F.lit("Other")))
    officer = (F.when(t.contains("chief executive") | t.contains("ceo"), F.lit("CEO"))
               .when(t.contains("chief financial") | t.contains("cfo"), F.lit("CFO"))
               .when(t.contains("president"), F.lit("President"))
               .otherwise(F.lit("Other officer")))
    return (F.when(r.contains("Officer"), officer)
            .when(r.contains("10% Owner"), F.lit("10% owner"))
            .when(r.contains("Director"), F.lit("Director"))
            .otherwise(F.lit("Other")))


def company_bucket(cik: Column) -> Column:
    """Digits of the issuer number modulo 64; 0 without digits."""
    digits = F.regexp_replace(F.coalesce(cik, F.lit("")), "[^0-9]", "")
    return F.coalesce(F.pmod(digits.try_cast("decimal(38,0)"), F.lit(fv.ISSUER_BUCKETS)), F.lit(0)).cast("int")


def issuer_key(icik: Column, tk: Column, co: Column) -> Column:
    blank = F.lit("")
    return F.coalesce(F.nullif(F.trim(icik), blank), F.nullif(F.upper(F.trim(tk)), blank), F.nullif(F.trim(co), blank))


def owner_key(pcik: Column, insider: Column) -> Column:
    blank = F.lit("")
    return F.coalesce(F.nullif(F.trim(pcik), blank), F.nullif(F.trim(insider), blank))
