"""Bulk tables -> trades: owner roll-up, parent join and orphan report."""
from pyspark.sql import DataFrame, functions as F

from ..fixed_values import NO_RELATIONSHIP, RELATIONSHIPS
from ..functions.calendar import parse_sec_date
from ..functions.labels import amend_flag, code_side, code_text, form_root, relationship_label, strip_cik
from ..functions.numeric import parse_number, trade_value
from ..schemas import TRADES, with_missing


def _t(name):
    return F.coalesce(F.trim(F.col(name)), F.lit(""))


def rollup_owners(owners: DataFrame) -> DataFrame:
    """One row per accession. Only fixed-size aggregates: no list of owners is ever collected."""
    o = owners.select(
        _t("ACCESSION_NUMBER").alias("acc"), strip_cik(_t("RPTOWNERCIK")).alias("cik"), _t("RPTOWNERNAME").alias("name"),
        _t("RPTOWNER_TITLE").alias("owner_title"), "line_no",
        relationship_label(_t("RPTOWNER_RELATIONSHIP"), _t("RPTOWNER_TXT")).alias("label")).where("acc <> ''")
    named, titled = F.col("name") != "", F.col("owner_title") != ""
    parts = RELATIONSHIPS + [NO_RELATIONSHIP]
    has = [F.bool_or(F.concat(F.lit("/"), F.col("label"), F.lit("/")).contains(f"/{p}/")).alias(f"r{i}")
           for i, p in enumerate(parts)]
    g = o.groupBy("acc").agg(
        F.min_by("name", F.when(named, F.col("line_no"))).alias("first_name"),
        F.count(F.when(named, 1)).alias("names"), F.min_by("cik", "line_no").alias("pcik"),
        F.count(F.lit(1)).cast("int").alias("own_n"),
        F.min_by("owner_title", F.when(titled, F.col("line_no"))).alias("first_title"), *has)
    joint = F.when(F.col("names") > 1, F.concat(F.lit(" (+"), (F.col("names") - 1).cast("string"), F.lit(" joint)"))
                   ).otherwise(F.lit(""))
    rel = F.concat_ws("/", *[F.when(F.col(f"r{i}"), F.lit(p)) for i, p in enumerate(parts)])
    return g.select("acc", F.concat(F.coalesce("first_name", F.lit("")), joint).alias("insider"), "pcik", "own_n",
                    rel.alias("rel"), F.coalesce("first_title", F.lit("")).alias("title"))


def _submissions(subs: DataFrame) -> DataFrame:
    doc = _t("DOCUMENT_TYPE")
    rows = subs.select(
        _t("ACCESSION_NUMBER").alias("acc"), parse_sec_date(_t("FILING_DATE")).alias("fd"),
        parse_sec_date(_t("PERIOD_OF_REPORT")).alias("period"), form_root(doc).alias("form"),
        amend_flag(doc).alias("amend"), strip_cik(_t("ISSUERCIK")).alias("icik"), _t("ISSUERNAME").alias("co"),
        F.upper(_t("ISSUERTRADINGSYMBOL")).alias("tk"), "line_no")
    fields = F.struct(*[c for c in rows.columns if c not in ("acc", "line_no")])
    return (rows.where("acc <> ''").groupBy("acc").agg(F.max_by(fields, "line_no").alias("s"))   # last copy wins
            .select("acc", "s.*"))


def transaction_rows(table: DataFrame, derivative: bool) -> DataFrame:
    code = F.upper(F.substring(_t("TRANS_CODE"), 1, 1))
    sh, px = parse_number(_t("TRANS_SHARES")), parse_number(_t("TRANS_PRICEPERSHARE"))
    fallback = parse_number(_t("TRANS_TOTAL_VALUE")) if derivative else None
    def letter(name):
        return F.substring(F.upper(_t(name)), 1, 1)
    def either(tail):
        return F.when(_t("UNDLYING_" + tail) != "", _t("UNDLYING_" + tail)).otherwise(_t("UNDLYNG_" + tail))
    cols = [
        _t("ACCESSION_NUMBER").alias("acc"),
        F.coalesce(parse_sec_date(_t("TRANS_DATE")), parse_sec_date(_t("DEEMED_EXECUTION_DATE"))).alias("td"),
        code.alias("code"), code_text(code).alias("ct"), code_side(code).alias("side"),
        _t("SECURITY_TITLE").alias("sec"), sh.alias("sh"), px.alias("px"), trade_value(sh, px, fallback).alias("val"),
        letter("TRANS_ACQUIRED_DISP_CD").alias("ad"), parse_number(_t("SHRS_OWND_FOLWNG_TRANS")).alias("af"),
        letter("DIRECT_INDIRECT_OWNERSHIP").alias("di"), _t("NATURE_OF_OWNERSHIP").alias("nature"),
        F.lit(int(derivative)).alias("der"), letter("TRANS_TIMELINESS").alias("timely"),
        letter("EQUITY_SWAP_INVOLVED").alias("swap"), F.col("line_no").alias("pos")]
    if derivative:
        cols += [either("SEC_TITLE").alias("under"), parse_number(either("SEC_SHARES")).alias("under_sh"),
                 parse_number(_t("CONV_EXERCISE_PRICE")).alias("xp"), parse_sec_date(_t("EXPIRATION_DATE")).alias("exp")]
    else:
        cols += [F.lit("").alias("under"), F.lit(None).cast("double").alias("under_sh"),
                 F.lit(None).cast("double").alias("xp"), F.lit(None).cast("date").alias("exp")]
    return table.select(*cols)


def assemble_trades(tables: dict[str, DataFrame]) -> DataFrame:
    """Both transaction tables joined to their submission (inner) and owner roll-up (left)."""
    tx = transaction_rows(tables["NONDERIV_TRANS"], False).unionByName(
        transaction_rows(tables["DERIV_TRANS"], True))
    parents = _submissions(tables["SUBMISSION"]).join(rollup_owners(tables["REPORTINGOWNER"]), "acc", "left")
    parents = parents.na.fill({"insider": "", "pcik": "", "own_n": 0, "rel": NO_RELATIONSHIP, "title": ""})
    return with_missing(tx.join(parents, "acc", "inner"), TRADES)


def orphan_transactions(tables: dict[str, DataFrame]) -> DataFrame:
    """Transactions whose accession has no submission row."""
    tx = transaction_rows(tables["NONDERIV_TRANS"], False).unionByName(
        transaction_rows(tables["DERIV_TRANS"], True))
    return tx.join(_submissions(tables["SUBMISSION"]).select("acc"), "acc", "left_anti")
