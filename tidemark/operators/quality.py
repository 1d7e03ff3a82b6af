"""Row audit, coverage of the filing calendar, fingerprints."""
from pyspark.sql import DataFrame, functions as F

from .. import fixed_values as fv
from ..functions.calendar import business_days_between, first_business_day, in_year, last_business_day, month_key
from ..functions.labels import issuer_key, owner_key, valid_ticker
from ..functions.links import filing_url
from ..functions.numeric import abs_value, count_if, exact, r2
from .plan import settle


def _code():
    return F.upper(F.substring(F.coalesce("code", F.lit("")), 1, 1))


def _blank(name):
    return F.coalesce(F.trim(F.col(name)), F.lit("")) == ""


def _checks():
    """(issue, severity, message, condition) of every row check; a message ending in ':' takes a detail."""
    code = _code()
    market = code.isin("P", "S")
    fd, td, sh, px, val = (F.col(c) for c in ("fd", "td", "sh", "px", "val"))
    lag = business_days_between(td, fd)
    tk = F.upper(F.trim(F.coalesce("tk", F.lit(""))))
    no = F.lit(False)
    return [
        ("MISSING_ACCESSION", "high", "No accession number.", _blank("acc")),
        ("BAD_ACCESSION_FORMAT", "medium", "Unexpected accession format:",
         ~_blank("acc") & ~F.col("acc").rlike(fv.ACCESSION_PATTERN)),
        ("BAD_FILING_DATE", "high", "Filing date missing or unreadable.", fd.isNull()),
        ("BAD_TRANSACTION_DATE", "medium", "Transaction date missing or unreadable.", td.isNull() & (code != "")),
        ("TRANSACTION_AFTER_FILING", "high", "Transaction date is later than the filing date.",
         (td > fd) & F.col("form").isin("4", "5")),
        ("MISSING_TICKER", "medium", "No trading symbol; check whether the issuer is listed.", tk == ""),
        ("SUSPICIOUS_TICKER", "low", "Unusual trading symbol:", (tk != "") & ~valid_ticker(tk, "audit")),
        ("MISSING_TRANSACTION_CODE", "high", "No transaction code.", code == ""),
        ("UNKNOWN_TRANSACTION_CODE", "medium", "Transaction code is not in the official list:",
         (code != "") & ~code.isin(list(fv.AUDITED_CODES))),
        ("NEGATIVE_SHARES", "medium", "Share count below zero.", sh < 0),
        ("NEGATIVE_PRICE", "medium", "Price below zero.", px < 0),
        ("MISSING_OPEN_MARKET_SHARES", "high", "Purchase or sale without a positive share count.",
         market & ~F.coalesce(sh > 0, no)),
        ("MISSING_OPEN_MARKET_PRICE", "medium", "Purchase or sale without a price.", market & ~F.coalesce(px >= 0, no)),
        ("VALUE_MISMATCH", "high", "Value differs from shares times price.", F.abs(r2(sh * px) - val) > fv.VALUE_TOLERANCE),
        ("POSSIBLE_LATE_FORM4", "medium", "Business days from transaction to filing:",
         (F.col("form") == "4") & (lag > fv.LATE_FORM4_DAYS)),
    ]


def row_issues(trades: DataFrame, target_year: int | None = None) -> DataFrame:
    """Long table of issues, one pass and no shuffle; stateless, so batch and stream share it.

    Each row first gets a bit mask of its failed checks; clean rows stop there, and names and messages are
    only built for the bits that are set. With ``target_year``: only that year's rows and undated rows.
    """
    if target_year:
        trades = trades.where(F.col("fd").isNull() | in_year(F.col("fd"), target_year))
    checks = _checks()
    mask = F.lit(0)
    for i, check in enumerate(checks):
        mask = mask.bitwiseOR(F.when(check[3], F.lit(1 << i)).otherwise(F.lit(0)))
    wanted = trades.select("fd", "td", "form", "tk", "co", "insider", "acc", "pos", "icik", "code", "sh", "px", "val")
    hit = (settle(wanted, mask=mask).where("mask <> 0")
           .withColumn("bit", F.explode(F.array(*[F.lit(i) for i in range(len(checks))])))
           .where("(shiftright(mask, bit) & 1) = 1"))
    names, severities, texts = (F.get(F.array(*[F.lit(c[j]) for c in checks]), F.col("bit")) for j in (0, 1, 2))
    issue = F.col("issue")
    detail = (F.when(issue == "BAD_ACCESSION_FORMAT", F.col("acc")).when(issue == "SUSPICIOUS_TICKER", F.col("tk"))
              .when(issue == "UNKNOWN_TRANSACTION_CODE", F.col("code"))
              .when(issue == "POSSIBLE_LATE_FORM4", business_days_between(F.col("td"), F.col("fd")).cast("string")))
    return hit.withColumn("issue", names).select(
        "issue", severities.alias("severity"), F.concat_ws(" ", texts, detail).alias("message"),
        "fd", "td", "tk", "co", "insider", "acc", "pos", "icik",
        filing_url(F.col("acc"), F.col("icik")).alias("source_url"))


def issue_counts(trades: DataFrame, target_year: int | None = None) -> DataFrame:
    return (row_issues(trades, target_year).groupBy("issue", "severity").agg(F.count(F.lit(1)).alias("n")))


def severity_counts(trades: DataFrame, target_year: int | None = None) -> DataFrame:
    return issue_counts(trades, target_year).groupBy("severity").agg(F.sum("n").alias("n"))


def issue_examples(issues: DataFrame, limit: int | None = None) -> DataFrame:
    return issues.orderBy("fd", "acc", "pos", "issue").limit(limit) if limit else issues


def audit_counts(trades: DataFrame, target_year: int) -> DataFrame:
    v = F.when(F.col("val").isNotNull(), abs_value(F.col("val")))
    here = in_year(F.col("fd"), target_year)
    code = F.upper(F.substring(F.coalesce("code", F.lit("")), 1, 1))
    # one hash aggregate by filing, company and insider first: the distinct counts then copy its few rows, not the trades
    grain = trades.groupBy(F.nullif(F.col("acc"), F.lit("")).alias("acc"), issuer_key(F.col("icik"), F.col("tk"), F.col("co")).alias("company"),
                           owner_key(F.col("pcik"), F.col("insider")).alias("person"), F.coalesce(here, F.lit(False)).alias("here")).agg(
        F.count(F.lit(1)).alias("rows"), count_if(~_blank("tk")).alias("with_ticker"), count_if(F.col("px").isNotNull()).alias("with_price"),
        count_if(F.col("der") != 0).alias("derivative_rows"), F.sum(exact(v)).alias("v"), F.sum(exact(F.when(code == "P", v))).alias("buy"),
        F.sum(exact(F.when(code == "S", v))).alias("sell"))
    def add(c):
        return F.coalesce(F.sum(c), F.lit(0))
    def money(c):
        return add(c).cast("double")
    return grain.agg(
        add("rows").alias("rows"), add(F.when(F.col("here"), F.col("rows"))).alias("target_rows"),
        F.count_distinct("acc").alias("filings"), F.count_distinct(F.when(F.col("here"), F.col("acc"))).alias("target_filings"),
        F.count_distinct("company").alias("companies"), F.count_distinct("person").alias("insiders"),
        add("with_ticker").alias("with_ticker"), (add("rows") - add("with_ticker")).alias("without_ticker"),
        add("with_price").alias("with_price"), add("derivative_rows").alias("derivative_rows"), money("v").alias("total_value"),
        money("buy").alias("buy_value"), money("sell").alias("sell_value"), r2(money("buy") - money("sell")).alias("net_value"))


def audit_by_code(trades: DataFrame) -> DataFrame:
    code = F.upper(F.substring(F.coalesce("code", F.lit("")), 1, 1))
    return trades.groupBy(F.coalesce(F.nullif(code, F.lit("")), F.lit("?")).alias("code")).agg(F.count(F.lit(1)).alias("n"))


def _days(spark, start, end):
    return spark.range(1).select(F.explode(F.sequence(F.lit(start).cast("date"), F.lit(end).cast("date"))).alias("d"))


def missing_business_days(trades: DataFrame, target_year: int, asof: str) -> DataFrame:
    """Weekdays of the expected window on which nothing was filed."""
    start, end = first_business_day(target_year), last_business_day(target_year, asof)
    seen = trades.where(F.col("fd").between(F.lit(start).cast("date"), F.lit(end).cast("date"))).select(F.col("fd").alias("d")).distinct()
    return _days(trades.sparkSession, start, end).where(F.weekday("d") < 5).join(seen, "d", "left_anti")


def missing_months(trades: DataFrame, target_year: int, asof: str) -> DataFrame:
    end = last_business_day(target_year, asof)
    expected = _days(trades.sparkSession, f"{target_year}-01-01", end).select(month_key(F.col("d")).alias("m")).distinct()
    seen = trades.where(in_year(F.col("fd"), target_year)).select(month_key(F.col("fd")).alias("m")).distinct()
    return expected.join(seen, "m", "left_anti")


def manifest_blockers(ledger: DataFrame, target_year: int, asof: str) -> DataFrame:
    """(blocker, detail) rows from the ingest ledger: one row per window, quarter or daily run."""
    end = F.lit(last_business_day(target_year, asof)).cast("date")
    start = F.lit(f"{target_year}-01-01").cast("date")
    kind = F.col("kind")
    items = F.array_compact(F.array(
        F.when((kind == "window") & (F.col("target_year") != target_year),
               F.struct(F.lit("ledger_year_mismatch").alias("blocker"), F.col("target_year").cast("string").alias("detail"))),
        F.when((kind == "window") & ((F.col("window_from") > start) | (F.col("window_to") < end)),
               F.struct(F.lit("ledger_window_too_short").alias("blocker"),
                        F.concat_ws("..", "window_from", "window_to").alias("detail"))),
        F.when((kind == "quarter") & (F.col("status") != "ok"),
               F.struct(F.lit("quarter_not_available").alias("blocker"), F.col("label").alias("detail"))),
        F.when((kind == "daily") & ~F.col("status").isin("ok", "skipped"),
               F.struct(F.lit("daily_run_failed").alias("blocker"), F.col("label").alias("detail")))))
    return ledger.select(F.explode(items).alias("x")).select("x.*")


def coverage_report(trades: DataFrame, target_year: int, asof: str, ledger: DataFrame | None = None) -> DataFrame:
    """One row: expected window, observed ranges, number of missing months and weekdays, and the blockers.

    One aggregate by filing day (as many rows as the calendar has) answers all parts. The blockers of the ingest
    ledger count as well; a year without any ledger row is not proven, so ``ledger_missing`` blocks it too.
    ``ledger=None`` leaves the ledger out of the question.
    """
    first, last = first_business_day(target_year), last_business_day(target_year, asof)
    start, end = F.lit(first).cast("date"), F.lit(last).cast("date")
    per_day = trades.where("fd IS NOT NULL").groupBy("fd").agg(F.count(F.lit(1)).alias("n"))
    here, expected = in_year(F.col("fd"), target_year), F.col("fd").between(start, end)
    months = _days(trades.sparkSession, f"{target_year}-01-01", last).select(month_key(F.col("d"))).distinct().count()
    weekdays = _days(trades.sparkSession, first, last).where(F.weekday("d") < 5).count()
    g = per_day.agg(
        F.min("fd").alias("observed_from"), F.max("fd").alias("observed_to"), F.min(F.when(here, F.col("fd"))).alias("target_from"),
        F.max(F.when(here, F.col("fd"))).alias("target_to"), F.coalesce(F.sum(F.when(here, F.col("n"))), F.lit(0)).alias("target_rows"),
        (F.lit(months) - F.count_distinct(F.when(here & (F.col("fd") <= F.last_day(end)), month_key(F.col("fd"))))).alias("missing_months"),
        (F.lit(weekdays) - count_if(expected & (F.weekday("fd") < 5))).alias("missing_days"))
    items = [F.when(F.col("target_rows") == 0, F.lit("no_target_rows")),
             F.when(F.col("target_from") > F.date_add(start, 14), F.lit("starts_late")),
             F.when(F.col("target_to") < F.date_sub(end, 4), F.lit("ends_early")),
             F.when(F.col("missing_months") > 0, F.lit("months_missing"))]
    if ledger is not None:
        found = manifest_blockers(ledger, target_year, asof).agg(F.array_sort(F.collect_set("blocker")).alias("ledger_blockers"))
        size = ledger.agg(F.count(F.lit(1)).alias("ledger_rows"))
        g = g.join(found, F.lit(True)).join(size, F.lit(True))  # single rows
        items.append(F.when(F.col("ledger_rows") == 0, F.lit("ledger_missing")))
    blockers = F.array_compact(F.array(*items))
    if ledger is not None:
        blockers = F.concat(blockers, F.col("ledger_blockers"))
    return (g.withColumn("blockers", F.concat_ws(",", blockers))
            .withColumn("complete", F.col("blockers") == "")
            .select(start.alias("target_start"), end.alias("target_end"), "observed_from", "observed_to", "target_from",
                    "target_to", "target_rows", "missing_months", "missing_days", "blockers", "complete"))


def dataset_fingerprint(trades: DataFrame) -> DataFrame:
    """Order-insensitive fingerprint of the row identities: row count plus sum and xor of the first 60 bits
    of each identity's sha256. Partial aggregates of fixed size; any row order gives the same answer."""
    text = F.concat_ws("|", *[F.coalesce(c, F.lit("")) for c in (
        F.col("acc"), F.col("der").cast("string"), F.col("td").cast("string"), F.col("code"), F.col("sec"),
        F.rint(F.col("sh") * 10000).cast("bigint").cast("string"), F.rint(F.col("px") * 10000).cast("bigint").cast("string"),
        F.col("ad"), F.col("pcik"))])
    h = F.conv(F.substring(F.sha2(text, 256), 1, 15), 16, 10).cast("bigint")
    return trades.select(h.alias("h")).agg(
        F.count(F.lit(1)).alias("rows"), F.sum(F.col("h").cast("decimal(38,0)")).cast("string").alias("hash_sum"),
        F.bit_xor("h").alias("hash_xor"))
