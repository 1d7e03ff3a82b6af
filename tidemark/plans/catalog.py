"""Named queries over the test tables: one entry per operator."""
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from .. import fixed_values as fv
from ..functions import calendar as cal, labels as lb, links as lk, numeric as nm
from ..operators import (asof, assemble, flags, holdings as hd, intervals as iv, merge, positions as ps, quality as ql, rollups as ru, sketches as sk,
                         signals as sg, splits as sp, stats as st, verify as vf, views as vw)
from ..session import materialize, scratch_folder
from ..schemas import RAW_TABLES
from ..sources import bulk, indexes, ownership, prices, shards
from ..streaming import jobs, pending, table
from . import fixtures as fx

QUERIES = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def _day(df, *names):
    """Dates leave as ISO text, so both engines hand over the same type."""
    for n in names:
        df = df.withColumn(n, F.col(n).cast("string"))
    return df


def _signals(s, d):
    return sg.extract_signals(fx.trades(s, d))


def _stored_signals(s, d):
    return materialize(_signals(s, d), "signals")


def _book(s, d):
    d = fx.priced(s, d)
    return ps.simulate_positions(_stored_signals(s, d), fx.bars(s, d), fx.ASOF, fx.splits(s, d))


def _raw_book(s, d):
    d = fx.priced(s, d)
    return ps.simulate_positions(_stored_signals(s, d), fx.bars(s, d), fx.ASOF)


def _trip(s, d):
    d = fx.priced(s, d)
    return ps.round_trip_backtest(_stored_signals(s, d), fx.bars(s, d), fx.ASOF)


def _priced(s, d):
    t = fx.trades(s, d)
    return hd.price_holdings(ru.insider_issuer_activity(t), hd.reported_holdings(t), asof.latest_mark(fx.bars(s, d), fx.ASOF))


# ------------------------------------------------------------------ 2.1 sources and sinks


def _raw_tables(s, d):
    """The bulk tables spelled as text from orders and line items."""
    o = fx.table(s, d, "orders").join(fx.table(s, d, "customer").select("c_custkey", "c_mktsegment"), F.col("o_custkey") == F.col("c_custkey"))
    li, part = fx.table(s, d, "lineitem"), fx.table(s, d, "part").select("p_partkey", "p_type")
    acc = lambda k: F.format_string("%010d-%02d-%06d", k, F.lit(99), k % 1_000_000)
    named = F.upper(F.date_format("o_orderdate", "dd-MMM-yyyy"))
    subs = o.where("o_orderstatus <> 'F'").select(
        acc(F.col("o_orderkey")).alias("ACCESSION_NUMBER"), named.alias("FILING_DATE"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("PERIOD_OF_REPORT"),
        F.when(F.col("o_orderpriority") == "5-LOW", F.lit("4/A")).otherwise(F.lit("4")).alias("DOCUMENT_TYPE"),
        F.lpad((F.col("o_custkey") + 7).cast("string"), 10, "0").alias("ISSUERCIK"), F.concat(F.lit("Issuer "), F.col("o_custkey")).alias("ISSUERNAME"),
        F.concat(F.lit("i"), F.col("o_custkey")).alias("ISSUERTRADINGSYMBOL"), F.col("o_orderkey").alias("line_no"))
    seg = F.col("c_mktsegment")
    flag = fx._when([(seg == "BUILDING", "DIRECTOR"), (seg == "MACHINERY", "OFFICER"), (seg == "FURNITURE", "OFFICER|DIRECTOR"),
                     (seg == "HOUSEHOLD", "TENPERCENTOWNER")], "")
    first = o.select(acc(F.col("o_orderkey")).alias("ACCESSION_NUMBER"), F.lpad((F.col("o_custkey") + 1).cast("string"), 10, "0").alias("RPTOWNERCIK"),
                     F.concat(F.lit("Owner "), F.col("o_custkey")).alias("RPTOWNERNAME"), flag.alias("RPTOWNER_RELATIONSHIP"),
                     F.when(seg == "MACHINERY", F.lit("CFO")).otherwise(F.lit("")).alias("RPTOWNER_TITLE"), F.lit("").alias("RPTOWNER_TXT"),
                     (F.col("o_orderkey") * 2).alias("line_no"))
    second = (o.where("c_mktsegment = 'HOUSEHOLD'")
              .select(acc(F.col("o_orderkey")).alias("ACCESSION_NUMBER"), F.lit("0000000009").alias("RPTOWNERCIK"), F.lit("Trust").alias("RPTOWNERNAME"),
                      F.lit("DIRECTOR").alias("RPTOWNER_RELATIONSHIP"), F.lit("Trustee").alias("RPTOWNER_TITLE"), F.lit("").alias("RPTOWNER_TXT"),
                      (F.col("o_orderkey") * 2 + 1).alias("line_no")))
    x = li.join(part, F.col("l_partkey") == F.col("p_partkey"))
    kind = F.concat("l_returnflag", "l_linestatus")
    code = fx._when([(kind == "AF", "S"), (kind.isin("AO", "RF"), "p"), (kind == "NF", "A"), (kind == "NO", "M")], "G")
    pos = F.col("l_linenumber").cast("long") * 1_000_000_000_000 + F.col("l_partkey") * 100 + F.col("l_quantity").cast("long")
    priced = ~kind.isin("NF", "RO", "NO")
    tx = x.select(
        acc(F.col("l_orderkey")).alias("ACCESSION_NUMBER"), F.concat(F.col("p_type"), F.lit(" Stock")).alias("SECURITY_TITLE"),
        F.when(F.col("l_linenumber") % 2 == 0, F.upper(F.date_format("l_shipdate", "d-MMM-yyyy"))).otherwise(F.lit("")).alias("TRANS_DATE"),
        F.concat(F.date_format("l_shipdate", "yyyy-MM-dd"), F.lit(" 00:00:00")).alias("DEEMED_EXECUTION_DATE"), code.alias("TRANS_CODE"),
        F.lit("0").alias("EQUITY_SWAP_INVOLVED"), F.lit("late").alias("TRANS_TIMELINESS"), F.format_number("l_quantity", 2).alias("TRANS_SHARES"),
        F.when(priced, F.format_number(F.col("l_discount") + 3, 2)).otherwise(F.lit("")).alias("TRANS_PRICEPERSHARE"),
        F.lit("a").alias("TRANS_ACQUIRED_DISP_CD"), F.format_number("l_extendedprice", 2).alias("SHRS_OWND_FOLWNG_TRANS"), F.lit("D").alias("DIRECT_INDIRECT_OWNERSHIP"),
        F.lit("").alias("NATURE_OF_OWNERSHIP"), pos.alias("line_no"), kind.alias("kind"), "l_extendedprice")
    table2 = (tx.where("kind = 'NO'").withColumn("CONV_EXERCISE_PRICE", F.lit("95.00"))
              .withColumn("TRANS_TOTAL_VALUE", F.format_number("l_extendedprice", 2)).withColumn("EXPIRATION_DATE", F.lit("31-DEC-2029"))
              .withColumn("UNDLYING_SEC_TITLE", F.lit("")).withColumn("UNDLYING_SEC_SHARES", F.lit(""))
              .withColumn("UNDLYNG_SEC_TITLE", F.lit("Common Stock")).withColumn("UNDLYNG_SEC_SHARES", F.col("TRANS_SHARES")))
    return {"SUBMISSION": subs, "REPORTINGOWNER": first.unionByName(second), "NONDERIV_TRANS": tx.where("kind <> 'NO'"), "DERIV_TRANS": table2}


@query
def read_bulk_tables(s, d):
    """The four tables written as two quarters, one of them with its columns in another order, and read by the public reader."""
    path = scratch_folder(s, "quarters")
    for name, df in _raw_tables(s, d).items():
        columns = [c for c in df.columns if c in {f.name for f in RAW_TABLES[name].fields}]
        for quarter, order in ((0, columns), (1, columns[::-1])):
            part = df.where(F.pmod(F.xxhash64("ACCESSION_NUMBER"), F.lit(2)) == quarter)
            part = part.repartition("ACCESSION_NUMBER").sortWithinPartitions("line_no").select(*order)
            part.write.csv(f"{path}/q{quarter}/{name}.tsv", sep="\t", header=True, escape='"', emptyValue="", nullValue="")
    t = assemble.assemble_trades(bulk.read_bulk_tables(s, path))
    return _day(t.select("acc", "der", "fd", "td", "form", "amend", "icik", "co", "tk", "insider", "own_n", "rel", "code", "side", "sec", "sh", "px", "val", "af"), "fd", "td")


def _write_archives(s, d, path):
    """The four tables as zipped quarters: whole filings are dealt to archives of some thousand filings each, one task packs one
    archive. The folder has to be one that tasks can open, as the shared scratch folder of these tables is."""
    n = max(4, fx.table(s, d, "orders").count() // 4000)
    place = path.removeprefix("file://").removeprefix("file:")

    def pack(lines):
        import io
        import os
        import zipfile
        blob = io.BytesIO()
        with zipfile.ZipFile(blob, "w", zipfile.ZIP_DEFLATED) as z:
            for name, part in lines.groupby("member"):
                head = part["head"].iloc[0]
                z.writestr(f"{name}.tsv", "\n".join([head, *part.sort_values("line_no")["line"]]) + "\n")
        number = lines["archive"].iloc[0]
        os.makedirs(place, exist_ok=True)
        half = f"{place}/{number}.zip.{os.getpid()}"
        with open(half, "wb") as f:
            f.write(blob.getvalue())
        os.replace(half, f"{place}/{number}.zip")          # an attempt that is repeated replaces the whole file
        return lines[["archive"]].head(1)

    parts = []
    for name, df in _raw_tables(s, d).items():
        columns = [c for c in df.columns if c in {f.name for f in RAW_TABLES[name].fields}]
        line = F.to_csv(F.struct(*columns), {"sep": "\t", "escape": '"', "nullValue": "", "emptyValue": ""})
        parts.append(df.select(F.pmod(F.xxhash64("ACCESSION_NUMBER"), F.lit(n)).alias("archive"), F.lit(name).alias("member"),
                               F.lit("\t".join(columns)).alias("head"), "line_no", line.alias("line")))
    reduce(DataFrame.unionByName, parts).groupBy("archive").applyInPandas(pack, "archive long").write.format("noop").mode("overwrite").save()


@query
def read_bulk_archives(s, d):
    """The four tables packed into archives and read by the public reader."""
    path = scratch_folder(s, "zipped")
    _write_archives(s, d, path)
    t = assemble.assemble_trades(bulk.read_bulk_archives(s, path))
    return _day(t.select("acc", "der", "fd", "td", "form", "amend", "icik", "co", "tk", "insider", "own_n", "rel", "code", "side", "sec", "sh", "px", "val", "af"), "fd", "td")


@query
def assemble_trades(s, d):
    t = assemble.assemble_trades(_raw_tables(s, d))
    return _day(t.select("acc", "fd", "td", "period", "form", "amend", "icik", "co", "tk", "insider", "pcik", "own_n", "rel", "title", "code",
                         "ct", "side", "sec", "sh", "px", "val", "ad", "af", "di", "der", "under", "under_sh", "xp", "exp", "timely", "pos"),
                "fd", "td", "period", "exp")


@query
def orphan_transactions(s, d):
    return _day(assemble.orphan_transactions(_raw_tables(s, d)).select("acc", "pos", "td", "code"), "td")


@query
def rollup_owners(s, d):
    return assemble.rollup_owners(_raw_tables(s, d)["REPORTINGOWNER"])


@query
def union_sources(s, d):
    t = _raw_tables(s, d)
    both = merge.union_sources(assemble.transaction_rows(t["NONDERIV_TRANS"], False), assemble.transaction_rows(t["DERIV_TRANS"], True))
    return both.groupBy("der", "code").agg(F.count(F.lit(1)).alias("n"), nm.total(F.col("sh")).alias("shares"))


def _write_files(files, path):
    """One file per row, called as its ``name`` says, with the bytes of ``text``. Tasks write to the folder themselves, so it has to be
    one that they can open, as the shared scratch folder of these tables is; a repeated attempt replaces whole files."""
    place = path.removeprefix("file://").removeprefix("file:")

    def put(batches):
        import os
        os.makedirs(place, exist_ok=True)
        for batch in batches:
            for name, text in zip(batch.column("name").to_pylist(), batch.column("text").to_pylist()):
                half = f"{place}/.{name}.{os.getpid()}"
                with open(half, "w", encoding="utf-8") as f:
                    f.write(text)
                os.replace(half, f"{place}/{name}")
            yield batch.select(["name"]).slice(0, 0)

    files.select("name", "text").mapInArrow(put, "name string").write.format("noop").mode("overwrite").save()


def _documents(s, d):
    """One ownership document per line item, wrapped in a submission."""
    li = fx.table(s, d, "lineitem")
    body = F.format_string(
        "<SEC-DOCUMENT><DOCUMENT><TEXT><XML><html/></XML></TEXT></DOCUMENT><DOCUMENT><TEXT><XML>\n<?xml version=\"1.0\"?>\n"
        "<ns:ownershipDocument><schemaVersion>X0306</schemaVersion><documentType>4</documentType><periodOfReport>%s</periodOfReport>"
        "<issuer><issuerCik>%010d</issuerCik><issuerName>Issuer  %d </issuerName><issuerTradingSymbol>s%d</issuerTradingSymbol></issuer>"
        "<reportingOwner><reportingOwnerId><rptOwnerCik>%010d</rptOwnerCik><rptOwnerName>Owner A</rptOwnerName></reportingOwnerId>"
        "<reportingOwnerRelationship><isDirector>1</isDirector><isOfficer>true</isOfficer><officerTitle>CEO</officerTitle></reportingOwnerRelationship></reportingOwner>"
        "<reportingOwner><reportingOwnerId><rptOwnerCik>0000000005</rptOwnerCik><rptOwnerName>Owner B</rptOwnerName></reportingOwnerId>"
        "<reportingOwnerRelationship><isTenPercentOwner>1</isTenPercentOwner></reportingOwnerRelationship></reportingOwner>"
        "<nonDerivativeTable><nonDerivativeTransaction><securityTitle><value>Common Stock</value></securityTitle>"
        "<transactionDate><value>%s</value></transactionDate><transactionCoding><transactionCode>P</transactionCode><equitySwapInvolved>0</equitySwapInvolved></transactionCoding>"
        "<transactionAmounts><transactionShares><value>%s</value></transactionShares><transactionPricePerShare><value>%s</value></transactionPricePerShare>"
        "<transactionAcquiredDisposedCode><value>A</value></transactionAcquiredDisposedCode></transactionAmounts>"
        "<postTransactionAmounts><sharesOwnedFollowingTransaction><value>%s</value></sharesOwnedFollowingTransaction></postTransactionAmounts>"
        "<ownershipNature><directOrIndirectOwnership><value>D</value></directOrIndirectOwnership></ownershipNature></nonDerivativeTransaction></nonDerivativeTable>"
        "</ns:ownershipDocument>\n</XML></TEXT></DOCUMENT>",
        F.date_format("l_shipdate", "yyyy-MM-dd"), F.col("l_suppkey"), F.col("l_suppkey"), F.col("l_suppkey"), F.col("l_orderkey") + 1,
        F.date_format("l_shipdate", "yyyy-MM-dd"), F.format_number("l_quantity", 0), F.format_number("l_extendedprice", 2), F.format_number("l_extendedprice", 2))
    broken = F.when(F.col("l_returnflag") == "N", F.regexp_replace(body, "</ns:ownershipDocument>", "")).otherwise(body)
    return li.select(F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey").alias("acc"), F.lit("4").alias("form"), F.lit(0).alias("amend"),
                     F.col("l_shipdate").cast("date").alias("fd"), F.when(F.col("l_returnflag") == "N", broken).otherwise(body).alias("value"))


@query
def read_ownership_xml(s, d):
    """One file per submission, found again by the accession in its name, which the filing list gives form and date to."""
    path = scratch_folder(s, "submissions")
    # the tables repeat their line numbers, so an accession of 18 digits is made from the whole submission
    digits = F.lpad(F.pmod(F.xxhash64("acc", "fd", "value"), F.lit(10 ** 18)).cast("string"), 18, "0")
    listed = _documents(s, d).withColumn("number", F.regexp_replace(digits, r"^(\d{10})(\d{2})", "$1-$2-"))
    _write_files(listed.select(F.concat("number", F.lit(".txt")).alias("name"), F.col("value").alias("text")), path)
    read = ownership.read_ownership_xml(s, path).select(F.col("acc").alias("number"), "doc")
    t = ownership.ownership_trades(read.join(listed.select("number", "acc", "form", "amend", "fd"), "number"))
    return _day(t.select("acc", "fd", "td", "period", "icik", "co", "tk", "insider", "pcik", "own_n", "rel", "title", "code", "ct", "side", "sec",
                         "sh", "px", "val", "ad", "af", "di", "der"), "fd", "td", "period")


@query
def rejected_ownership_xml(s, d):
    return ownership.rejected_documents(ownership.parse_documents(_documents(s, d))).select("acc", "form")


_LISTED = ["4", "4/A", "5", "5/A", "10-K"]


def _listed(s, d):
    o = fx.table(s, d, "orders")
    form = F.element_at(F.array(*[F.lit(f) for f in _LISTED]), F.substring("o_orderpriority", 1, 1).cast("int"))
    acc = F.format_string("%010d-%02d-%06d", F.col("o_custkey"), (F.year("o_orderdate") % 100).cast("int"), F.col("o_orderkey") % 1_000_000)
    return o.withColumn("form", form).withColumn("acc", acc)


@query
def read_daily_index(s, d):
    """The list of filings written as index files and read by the public reader; the lines of one filing share a file, in order."""
    o = _listed(s, d)
    line = lambda cik, n: o.select(
        cik.cast("string").alias("cik"), F.lit("NAME").alias("name"), F.concat(F.lit(" "), "form").alias("form"), F.date_format("o_orderdate", "yyyyMMdd").alias("filed"),
        F.concat(F.lit("edgar/data/"), cik.cast("string"), F.lit("/"), "acc", F.lit(".txt")).alias("file"), "acc", (F.col("o_orderkey") * 2 + n).alias("line_no"))
    path = scratch_folder(s, "index")
    lines = line(F.col("o_custkey"), 0).unionByName(line(F.col("o_custkey") + 5, 1)).repartition("acc").sortWithinPartitions("line_no")
    lines.select("cik", "name", "form", "filed", "file").write.csv(path, sep="|", ignoreLeadingWhiteSpace=False)
    return _day(indexes.read_daily_index(s, path), "fd")


@query
def read_search_hits(s, d):
    o = _listed(s, d)
    even = F.col("o_orderkey") % 2 == 0
    src = F.struct(F.when(even, F.col("acc")).alias("adsh"), F.when(even, F.col("form")).alias("form_type"), F.col("form").alias("file_type"),
                   F.when(even, F.date_format("o_orderdate", "yyyyMMdd")).otherwise(F.date_format("o_orderdate", "yyyy-MM-dd")).alias("file_date"),
                   F.array(F.lpad((F.col("o_custkey") + 1).cast("string"), 10, "0")).alias("ciks"))
    hit = F.struct(F.concat_ws(":", "acc", "form").alias("_id"), src.alias("_source"))
    page = F.struct(F.struct(F.array(hit, hit).alias("hits")).alias("hits"))
    path = scratch_folder(s, "hits")
    # pages of a run of orders make one file, an array
    files = o.groupBy((F.col("o_orderkey") / 1000).cast("long").alias("run")).agg(F.array_sort(F.collect_list(F.struct(F.col("o_orderkey").alias("n"), page.alias("page")))).alias("x"))
    _write_files(files.select(F.format_string("%012d.json", "run").alias("name"), F.to_json(F.transform("x", lambda x: x["page"])).alias("text")), path)
    return _day(indexes.read_search_hits(s, path), "fd")


@query
def dedupe_by_accession(s, d):
    t = fx.trades(s, d).select("acc", "fd", "form", "pos")
    return _day(indexes.dedupe_by_accession(t, F.desc("pos")), "fd")


def _stored_shards(s, d, fmt_csv, fmt_json):
    t = fx.trades(s, d)
    a, b = scratch_folder(s, "year-shards"), scratch_folder(s, "month-shards")
    if fmt_csv:
        shards.write_trades_by_year(t, a, fmt="csv")
    if fmt_json:
        shards.write_trades_by_month(t.withColumn("co", F.concat(F.lit("late "), "co")), b, fmt="json")
    return a, b


_SHARD_COLUMNS = ["acc", "fd", "td", "tk", "co", "insider", "code", "sec", "sh", "px", "val", "af", "der", "amend", "pos"]


@query
def read_trade_shards(s, d):
    a, b = _stored_shards(s, d, True, True)
    t = shards.read_trade_shards(s, a, b, json_arrays=False)
    return _day(t.select(*_SHARD_COLUMNS, "source_rank"), "fd", "td")


@query
def write_trades_by_year(s, d):
    path = scratch_folder(s, "year-export")
    shards.write_trades_by_year(fx.trades(s, d), path, from_year=1998)
    return s.read.parquet(path).groupBy("fy").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("acc").alias("filings"), nm.total(F.col("val")).alias("value"))


@query
def write_trades_by_month(s, d):
    path = scratch_folder(s, "month-export")
    shards.write_trades_by_month(fx.trades(s, d), path, fmt="parquet")
    return s.read.parquet(path).groupBy("fm").agg(F.count(F.lit(1)).alias("n"), nm.total(F.col("val")).alias("value"))


@query
def write_company_buckets(s, d):
    path = scratch_folder(s, "buckets")
    shards.write_company_buckets(ru.recent_per_company(fx.trades(s, d)), path)
    return s.read.parquet(path).groupBy("bucket").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("issuer").alias("issuers"))


@query
def write_positions(s, d):
    path = scratch_folder(s, "positions")
    p = _book(s, d)
    shards.write_positions(p, path, fmt="json")
    return s.read.schema(p.schema).json(path).groupBy("status", "entry_rule_status", "exit_status").agg(
        F.count(F.lit(1)).alias("n"), nm.total(F.col("mtm")).alias("mtm"), nm.total(F.col("exit_pnl")).alias("exit_pnl"))


@query
def write_activity(s, d):
    path = scratch_folder(s, "activity")
    p = _priced(s, d)
    shards.write_activity(p, path, fmt="csv", columns=["owner", "issuer", "n", "net_v", "valuation_status"])
    back = s.read.csv(path, header=True, schema="owner STRING, issuer STRING, n BIGINT, net_v DOUBLE, valuation_status STRING")
    return back


@query
def write_portfolios(s, d):
    path = scratch_folder(s, "portfolios")
    p = hd.insider_portfolio(_priced(s, d)).select("owner", "insider", "issuer_n", "priced_value", "overlap")
    shards.write_portfolios(p, path, fmt="json")
    return s.read.schema(p.schema).json(path)


@query
def export_view(s, d):
    path = scratch_folder(s, "view")
    v = vw.view_filter(fx.trades(s, d), search="owner 1", equals={"side": "buy"})
    shards.export_view(v, path, ["acc", "pos", "tk", "insider", "nature", "sh"])
    return s.read.csv(path, header=True, schema="acc STRING, pos BIGINT, tk STRING, insider STRING, nature STRING, sh DOUBLE").fillna("", ["tk", "nature"])


@query
def compact_row(s, d):
    doc = F.from_json("doc", "fd STRING, tk STRING, title STRING, px DOUBLE, der INT, amend INT")
    keys = F.json_object_keys("doc")
    return shards.compact_row(fx.trades(s, d)).select("acc", "pos", doc.alias("j"), F.size(keys).alias("fields")).select("acc", "pos", "j.*", "fields")


@query
def read_bars_yahoo_json(s, d):
    b = fx.bars(s, d)
    unix = F.datediff("d", F.lit("1970-01-01").cast("date")).cast("long") * 86400 + 5 * 3600
    g = b.groupBy("tk").agg(F.array_sort(F.collect_list(F.struct(unix.alias("t"), F.when(F.col("v") != 2, F.col("o")).alias("o"), "c", "v"))).alias("x"))
    f = lambda n: F.transform("x", lambda r: r[n])
    quote = F.struct(f("o").alias("open"), f("c").alias("high"), f("o").alias("low"), f("c").alias("close"), f("v").alias("volume"))
    res = F.struct(F.struct(F.lit("").alias("symbol"), F.lit(-18000).cast("long").alias("gmtoffset")).alias("meta"), f("t").alias("timestamp"),
                   F.struct(F.array(quote).alias("quote")).alias("indicators"))
    text = F.to_json(F.struct(F.struct(F.array(res).alias("result")).alias("chart")))
    path = scratch_folder(s, "charts")
    _write_files(g.select(F.concat("tk", F.lit(".json")).alias("name"), text.alias("text")), path)
    return _day(prices.read_bars_yahoo_json(s, path).select("tk", "d", "o", "c", "v", "src"), "d")


@query
def read_splits(s, d):
    e = fx.splits(s, d)
    by_ratio = F.substring_index("tk", "S", -1).cast("int") % 2 == 0
    ev = F.struct(F.col("d").cast("string").alias("date"), F.when(~by_ratio, F.lit("1")).alias("numerator"), F.when(~by_ratio, F.lit("10")).alias("denominator"),
                  F.lit("1:10").alias("splitRatio"))
    res = F.struct(F.struct(F.col("tk").alias("symbol"), F.lit(0).cast("long").alias("gmtoffset")).alias("meta"),
                   F.struct(F.create_map(F.lit("0"), ev).alias("splits")).alias("events"))
    text = F.to_json(F.struct(F.struct(F.array(res).alias("result")).alias("chart")))
    path = scratch_folder(s, "splits")
    _write_files(e.select(F.concat("tk", F.lit("_"), "d", F.lit(".json")).alias("name"), text.alias("text")), path)
    out = prices.read_splits(s, path)
    return _day(out.withColumn("ratio", prices.split_ratio(F.col("num"), F.col("den"))), "d")


@query
def read_bars_stooq_csv(s, d):
    b = fx.bars(s, d)
    opened = F.when(F.col("v") == 2, F.lit("0")).otherwise(F.col("o").cast("string"))
    row = F.struct("d", F.concat_ws(",", F.col("d").cast("string"), opened, F.col("c").cast("string"), F.col("o").cast("string"), F.col("c").cast("string"),
                                    F.col("v").cast("string")).alias("row"))
    g = b.groupBy("tk").agg(F.array_sort(F.collect_list(row)).alias("x"))
    path = scratch_folder(s, "daily")
    lines = F.concat(F.array(F.lit("Date,Open,High,Low,Close,Volume")), F.transform("x", lambda x: x["row"]))
    _write_files(g.select(F.concat(F.lower("tk"), F.lit(".us.csv")).alias("name"), F.array_join(lines, "\n").alias("text")), path)
    both = [prices.read_bars_stooq_csv(s, path, p).withColumn("policy", F.lit(p)) for p in ("repair", "drop")]
    return _day(both[0].unionByName(both[1]).select("policy", "tk", "d", "o", "c", "v"), "d")


@query
def read_bars_nasdaq_json(s, d):
    b = fx.bars(s, d)
    money = lambda c: F.concat(F.lit("$"), F.format_number(c, 2))
    row = F.struct(F.date_format("d", "MM/dd/yyyy").alias("date"), F.when(F.col("v") == 2, F.lit("--")).otherwise(money(F.col("o"))).alias("open"),
                   money(F.col("c")).alias("high"), money(F.col("o")).alias("low"), money(F.col("c")).alias("close"), F.lit("1").alias("volume"))
    g = b.groupBy("tk").agg(F.collect_list(row).alias("rows"))
    path = scratch_folder(s, "quotes")
    text = F.to_json(F.struct(F.struct(F.struct("rows").alias("tradesTable")).alias("data")))
    _write_files(g.select(F.concat("tk", F.lit(".json")).alias("name"), text.alias("text")), path)
    return _day(prices.read_bars_nasdaq_json(s, path).select("tk", "d", "o", "c", "src"), "d")


@query
def file_manifest(s, d):
    return shards.content_manifest(fx.table(s, d, "documents"), "doc_id", "text")


# ------------------------------------------------------------------ 2.2 scalar functions


@query
def parse_sec_date(s, d):
    o = fx.table(s, d, "orders").select("o_orderkey", "o_orderdate", "o_orderstatus")
    named = F.upper(F.date_format("o_orderdate", "d-MMM-yyyy"))
    k = F.col("o_orderkey") % 4
    text = (F.when(F.col("o_orderstatus") == "P", F.lit("15-XXX-2025")).when(k == 0, named).when(k == 1, F.concat(named, F.lit(" 00:00:00")))
            .when(k == 2, F.date_format("o_orderdate", "yyyy-MM-dd")).otherwise(F.concat(F.lit("  "), F.date_format("o_orderdate", "yyyy-MM-dd"), F.lit("T09:30"))))
    return _day(o.select("o_orderkey", cal.parse_sec_date(text).alias("parsed")), "parsed")


@query
def parse_number(s, d):
    li = fx.table(s, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice", "l_returnflag", "l_linestatus")
    kind = F.concat("l_returnflag", "l_linestatus")
    text = (F.when(kind == "AF", F.lit(" n/a ")).when(kind == "NF", F.lit("NaN")).when(kind == "RO", F.lit("Infinity")).when(kind == "AO", F.lit(""))
            .when(kind == "RF", F.concat(F.lit("$"), F.format_number("l_extendedprice", 2))).otherwise(F.concat(F.lit(" "), F.format_number("l_extendedprice", 2))))
    return li.select("l_orderkey", "l_linenumber", "l_partkey", nm.parse_number(text).alias("number"))


@query
def form_root_and_amend(s, d):
    doc = F.when(F.col("amend") == 1, F.concat("form", F.lit("/a "))).otherwise(F.col("form"))
    return fx.trades(s, d).groupBy(lb.form_root(doc).alias("root"), lb.amend_flag(doc).alias("amended")).agg(F.count(F.lit(1)).alias("n"))


@query
def strip_cik(s, d):
    c = fx.table(s, d, "customer")
    return c.select("c_custkey", lb.strip_cik(F.lpad(F.col("c_custkey").cast("string"), 10, "0")).alias("cik"))


@query
def code_text_and_side(s, d):
    t = fx.trades(s, d)
    odd = F.when(F.col("form") == "5", F.concat(F.lit("Y"), "code")).otherwise(F.col("code"))
    return t.groupBy(odd.alias("code")).agg(F.count(F.lit(1)).alias("n")).select("code", "n", lb.code_text(F.col("code")).alias("text"), lb.code_side(F.col("code")).alias("side"))


@query
def trade_value(s, d):
    t = fx.trades(s, d)
    return t.select("acc", "pos", nm.trade_value(F.col("sh"), F.col("px"), F.col("af")).alias("value"))


@query
def relationship_label(s, d):
    t = fx.trades(s, d)
    raw = F.upper(F.translate(F.regexp_replace("rel", "10% Owner", "TENPERCENTOWNER"), "/", "|"))
    raw = F.when(raw == "UNKNOWN", F.lit("")).otherwise(raw)
    return t.groupBy(lb.relationship_label(raw, F.col("title")).alias("label"), lb.relationship_label(raw, F.lit("note")).alias("noted")).agg(F.count(F.lit(1)).alias("n"))


@query
def split_relationships(s, d):
    return ru.split_relationships(fx.trades(s, d)).select("acc", "pos", "relationship")


@query
def normalize_ticker(s, d):
    raw = F.concat(F.lit(" "), F.lower("tk"), F.lit("_b "))
    return fx.trades(s, d).select("acc", "pos", lb.normalize_ticker(raw).alias("normal"), lb.quote_symbol(F.regexp_replace(raw, "_", ".")).alias("symbol"),
                                  lb.quote_symbol(raw, "engine").alias("engine_symbol"))


@query
def valid_ticker(s, d):
    t = fx.trades(s, d)
    odd = (F.when(F.col("amend") == 1, F.concat("tk", F.lit("/B"))).when(F.col("form") == "5", F.lit(" none")).when(F.col("di") == "I", F.concat("tk", "tk", F.lit("LONGER")))
           .otherwise(F.col("tk")))
    return t.select("acc", "pos", *[lb.valid_ticker(odd, m).cast("int").alias(m) for m in ("engine", "site", "audit")])


@query
def is_common_equity(s, d):
    t = fx.trades(s, d)
    title = F.when(F.col("form") == "5", F.concat("sec", F.lit(" (option)"))).when(F.col("di") == "I", F.lit("")).otherwise(F.col("sec"))
    return t.groupBy(title.alias("title"), "der").agg(F.count(F.lit(1)).alias("n")).select(
        "title", "der", "n", lb.is_common_equity(F.col("title"), "lenient", F.col("der")).cast("int").alias("lenient"), lb.is_common_equity(F.col("title")).cast("int").alias("strict"))


@query
def size_bucket(s, d):
    v = F.coalesce(F.col("val"), F.lit(0.0)) * 10
    return fx.trades(s, d).groupBy(lb.size_bucket(v).alias("site"), lb.size_bucket(v, "engine").alias("engine")).agg(F.count(F.lit(1)).alias("n"))


@query
def role_bucket(s, d):
    return fx.trades(s, d).groupBy("rel", "title").agg(F.count(F.lit(1)).alias("n")).select(
        "rel", "title", "n", lb.role_bucket(F.col("rel"), F.col("title")).alias("site"), lb.role_bucket(F.col("rel"), F.col("title"), "engine").alias("engine"))


@query
def company_bucket(s, d):
    return fx.trades(s, d).groupBy("icik").agg(F.count(F.lit(1)).alias("n")).select("icik", "n", lb.company_bucket(F.col("icik")).alias("bucket"))


@query
def review_links(s, d):
    t = fx.trades(s, d)
    own = F.when(F.col("form") == "5", F.lit("")).otherwise(F.col("icik"))
    url = lk.filing_url(F.col("acc"), own)
    return t.select("acc", "pos", url.alias("filing"), lk.filing_text_url(F.col("acc"), own).alias("text"), lk.history_url(F.col("tk")).alias("history"),
                    lk.second_history_url(F.col("tk")).alias("second_history"), lk.corporate_action_url(F.col("icik")).alias("actions"),
                    lk.filing_url_ok(url, F.col("acc"), F.col("icik")).cast("int").alias("url_ok"))


@query
def business_days_between(s, d):
    t = fx.trades(s, d)
    return t.select("acc", "pos", cal.business_days_between(F.col("td"), F.col("fd")).alias("days"),
                    cal.business_days_between(F.col("fd"), F.col("period")).alias("to_period_end"))


@query
def calendar_delays(s, d):
    return _trip(s, d).select("id", F.date_diff("fd", "td").alias("delay_td_fd"), F.date_diff("entry_d", "fd").alias("delay_fd_entry"))


@query
def month_and_year_keys(s, d):
    return fx.trades(s, d).groupBy(cal.month_key(F.col("fd")).alias("m"), cal.year_key(F.col("fd")).alias("y")).agg(F.count(F.lit(1)).alias("n"))


@query
def evidence_text(s, d):
    return fx.trades(s, d).select("acc", "pos", lk.evidence_text(F.col).alias("evidence"), lk.shares_text(F.col("sh") / 8).alias("eighth"),
                                  lk.money_text(-F.col("val")).alias("outflow"))


@query
def abs_value(s, d):
    sign = F.when(F.col("code") == "S", -F.col("val")).otherwise(F.col("val"))
    return fx.trades(s, d).select("acc", "pos", nm.abs_value(sign).alias("v"))


# ------------------------------------------------------------------ 2.3 filters


@query
def filing_window(s, d):
    t = fx.trades(s, d)
    one = ru.filing_window(t, target_year=1999).groupBy("code").agg(F.count(F.lit(1)).alias("n")).withColumn("window", F.lit("1999"))
    on = ru.filing_window(t, from_year=1999).groupBy("code").agg(F.count(F.lit(1)).alias("n")).withColumn("window", F.lit("1999 on"))
    return one.unionByName(on)


@query
def paper_window(s, d):
    return sg.extract_signals(ru.paper_window(fx.trades(s, d), 1999)).groupBy("tk").agg(F.count(F.lit(1)).alias("n"), nm.total(F.col("insider_val")).alias("value"))


@query
def qualifying_purchase(s, d):
    t = fx.trades(s, d)
    return t.groupBy("code", "sec", *[F.coalesce(sg.qualifying_purchase(m), F.lit(False)).cast("int").alias(m) for m in ("site", "engine")]).agg(F.count(F.lit(1)).alias("n"))


@query
def asof_clip(s, d):
    return _day(asof.asof_clip(fx.bars(s, d), fx.ASOF).groupBy("tk").agg(F.count(F.lit(1)).alias("n"), F.max("d").alias("last")), "last")


@query
def price_window_trim(s, d):
    return _day(merge.price_window_trim(fx.bars(s, d), "2000-01-01").groupBy("tk").agg(F.count(F.lit(1)).alias("n"), F.min("d").alias("first")), "first")


@query
def min_value_filter(s, d):
    return sg.min_value_filter(sg.candidate_signals(fx.trades(s, d)), 20_000.0).select("id", "insider_val", "lots")


@query
def view_filter(s, d):
    d = fx.store(s, d)
    t = fx.trades(s, d)
    a = vw.view_filter(t, search="owner 12", role="Officer", equals={"code": "S"}).select(F.lit("trades").alias("view"), F.concat_ws(":", "acc", "pos").alias("key"))
    b = vw.view_filter(_book(s, d), search="s1", win="l", equals={"status": "open"}).select(F.lit("losers").alias("view"), F.col("id").alias("key"))
    b = materialize(b, "losers")
    c = vw.view_filter(_priced(s, d), overlap="both", holding="priced").select(F.lit("pairs").alias("view"), F.concat_ws(":", "owner", "issuer").alias("key"))
    return a.unionByName(b).unionByName(c)


# ------------------------------------------------------------------ 2.4 joins


@query
def next_session_entry(s, d):
    e = asof.next_session_entry(fx.trades(s, d).select("acc", "pos", "tk", "fd"), fx.bars(s, d))
    return _day(e.select("acc", "pos", "entry_d", "entry_px", "entry_i"), "entry_d")


def _reused_tickers(s, d):
    """Filings whose ticker went to another issuer on a day that differs by ticker, with a gap of nine days; some file later."""
    t = fx.trades(s, d).where("tk <> '' AND CAST(icik AS int) % 3 <> 0")
    cut = F.date_add(F.lit("1994-01-01").cast("date"), (F.col("icik").cast("int") * 37) % 1500)
    earlier = (F.col("fd") <= cut) | (F.col("pos") % 7 == 0)
    validity = t.select("tk", "icik", cut.alias("cut")).distinct()
    old = validity.select("tk", F.concat(F.lit("A"), "icik").alias("icik"), F.lit(None).cast("date").alias("from_d"), F.col("cut").alias("to_d"))
    new = validity.select("tk", F.concat(F.lit("B"), "icik").alias("icik"), F.date_add("cut", 10).alias("from_d"), F.lit(None).cast("date").alias("to_d"))
    every = fx.trades(s, d).select("acc", "pos", "tk", "fd", F.when((F.col("tk") == "") | (F.col("icik").cast("int") % 3 == 0), F.col("icik"))
                                   .otherwise(F.concat(F.when(earlier, F.lit("A")).otherwise(F.lit("B")), "icik")).alias("icik"))
    return every, old.unionByName(new)


@query
def entries_per_issuer(s, d):
    left, validity = _reused_tickers(s, d)
    e = iv.per_issuer(asof.next_session_entry, left, fx.bars(s, d), validity)
    return _day(e.select("acc", "pos", "tk", "icik", "entry_d", "entry_px", "entry_i"), "entry_d")


@query
def close_on_or_before(s, d):
    e = asof.close_on_or_before(fx.trades(s, d).select("acc", "pos", "tk", "td"), fx.bars(s, d), "td")
    return _day(e.select("acc", "pos", "close_d", "close_px"), "close_d")


@query
def latest_mark(s, d):
    return _day(asof.latest_mark(fx.bars(s, d), fx.ASOF), "mark_d")


@query
def horizon_close(s, d):
    e = _trip(s, d).where("entry_d IS NOT NULL").select("id", "tk", "entry_d")
    out = [asof.horizon_close(e, fx.bars(s, d), n, fx.ASOF).withColumn("n", F.lit(n)) for n in (0, 21)]
    return _day(out[0].unionByName(out[1]).select("id", "n", "horizon_d", "horizon_px"), "horizon_d")


@query
def price_holdings(s, d):
    return _day(_priced(s, d).select("owner", "issuer", "reported_shares", "holding_groups", "mark_px", "holding_value", "valuation_status", "latest_holding_fd"), "latest_holding_fd")


@query
def split_events_in_hold(s, d):
    d = fx.priced(s, d)
    ev = sp.classify_splits(fx.splits(s, d), asof.enrich_bars(fx.bars(s, d), fx.ASOF))
    return _day(sp.split_events_in_hold(_book(s, d), ev).select("id", "event_d", "ratio", "jump", "kind"), "event_d")


@query
def missing_business_days(s, d):
    return _day(ql.missing_business_days(fx.trades(s, d), fx.TARGET_YEAR, fx.AUDIT_ASOF), "d")


@query
def missing_months(s, d):
    return ql.missing_months(fx.trades(s, d), fx.TARGET_YEAR, fx.AUDIT_ASOF)


def _sourced(s, d):
    """Bars of three sources: which source saw a trade day depends on the supplier's nation and the line."""
    li = fx.table(s, d, "lineitem").select("l_suppkey", "l_returnflag", "l_shipdate", "l_extendedprice")
    n = fx.table(s, d, "supplier").select("s_suppkey", "s_nationkey")
    src = (F.when((F.col("l_returnflag") == "A") & (F.col("s_nationkey") < 10), F.lit("yahoo"))
           .when((F.col("l_returnflag") == "N") & (F.col("s_nationkey") < 18), F.lit("stooq")).otherwise(F.lit("nasdaq")))
    return (li.join(n, F.col("l_suppkey") == F.col("s_suppkey"))
            .groupBy(F.concat(F.lit("S"), F.col("l_suppkey").cast("string")).alias("tk"), F.col("l_shipdate").cast("date").alias("d"), src.alias("src"))
            .agg(F.max("l_extendedprice").alias("c")))


@query
def source_fallback(s, d):
    return _day(merge.source_fallback(_sourced(s, d)), "d")


@query
def price_source_counts(s, d):
    src = ps.ticker_sources(merge.source_fallback(_sourced(s, d)))
    p = _trip(s, d).select("id", "tk").join(src, "tk", "left")
    return ps.price_source_counts(p)


# ------------------------------------------------------------------ 2.5 dedupe and merge


def _twice(s, d):
    t = fx.trades(s, d)
    return t.withColumn("source_rank", F.lit(0)), t.withColumn("source_rank", F.lit(1)).withColumn("co", F.concat(F.lit("late "), "co"))


@query
def dedupe_trades(s, d):
    a, b = _twice(s, d)
    return merge.dedupe_trades(b.unionByName(a)).select("acc", "pos", "co", "sh", "px", "source_rank")


@query
def row_key(s, d):
    t = fx.trades(s, d)
    out = [t.groupBy(*merge.row_key(t, i)).agg(F.count(F.lit(1)).alias("n")).groupBy("n").agg(F.count(F.lit(1)).alias("identities")).withColumn("identity", F.lit(i)) for i in ("reference", "full")]
    return out[0].unionByName(out[1])


@query
def upsert_shard(s, d):
    a, b = _twice(s, d)
    return merge.upsert_shard(a.drop("source_rank"), b.where("code = 'P'").drop("source_rank")).select("acc", "pos", "co", "code")


@query
def upsert_counts(s, d):
    t = fx.trades(s, d)
    blanked = t.withColumn("fd", F.when(F.col("form") == "4", F.col("fd")))
    return merge.upsert_counts(t.where("code <> 'P'"), blanked)


@query
def supersede_amendments(s, d):
    t = fx.trades(s, d)
    newer = t.where("code = 'P'").withColumn("co", F.concat(F.lit("again "), "co"))
    return merge.supersede_amendments(t, newer).select("acc", "pos", "icik", "co")


@query
def supersede_only_amendments(s, d):
    return merge.supersede_amendments(fx.trades(s, d), only_amendments=True).select("acc", "pos", "icik")


@query
def merge_price_tail(s, d):
    b = fx.bars(s, d)
    old = b.where("d <= '1999-06-30'")
    tail = b.where("d >= '1999-03-01'").select("tk", "d", F.when(F.col("v") != 2, F.col("o") + 1).otherwise(F.lit(0.0)).alias("o"), (F.col("c") + 1).alias("c"))
    return _day(merge.merge_price_tail(old, tail), "d")


@query
def merge_splits(s, d):
    e = fx.splits(s, d)
    newer = e.where("d >= '1998-01-01'").withColumn("den", F.lit(20.0))
    return _day(merge.merge_splits(e, newer), "d")


@query
def last_update_wins(s, d):
    log = fx.trades(s, d).select("icik", "pos", "acc", "sh", "code").withColumn("seq", F.struct("acc", "pos"))
    return merge.last_update_wins(log, "icik", "seq").select("icik", "acc", "pos", "sh", "code")


@query
def dedupe_flags(s, d):
    f = flags.flag_large_transactions(fx.trades(s, d), fx.LARGE)
    return merge.dedupe_flags(f.unionByName(f)).select("category", "fd_text", "td_text", "summary", "filing_n")


# ------------------------------------------------------------------ 2.6 aggregates


@query
def global_totals(s, d):
    return _day(ru.global_totals(fx.trades(s, d)), "first_fd", "last_fd")


@query
def trade_cuts(s, d):
    return ru.trade_cuts(fx.trades(s, d))


@query
def approx_totals(s, d):
    """Distinct counts per year and over all time from one stored daily table, set beside exact ones: the exact counts, and whether each
    estimate keeps to its bound."""
    t = fx.trades(s, d)
    daily = materialize(sk.daily_sketches(t), "sketches").withColumn("y", F.year("fd").cast("string"))
    near = sk.approx_totals(daily, ["y"]).unionByName(sk.approx_totals(daily).withColumn("y", F.lit("all")))
    year, filing = F.year("fd").cast("string"), F.nullif(F.trim("acc"), F.lit(""))
    keyed = t.where("fd IS NOT NULL").select(year.alias("y"), filing.alias("filing"), lb.owner_key(F.col("pcik"), F.col("insider")).alias("insider"),
                                             lb.issuer_key(F.col("icik"), F.col("tk"), F.col("co")).alias("issuer"))
    counts = [F.count_distinct(k).alias(f"true_{c}") for k, c in zip(("filing", "insider", "issuer"), sk.COUNTED)]
    true = keyed.groupBy("y").agg(*counts).unionByName(keyed.agg(*counts).withColumn("y", F.lit("all")))
    kept = [(F.abs(F.col(c) - F.col(f"true_{c}")) <= F.col(f"true_{c}") * sk.relative_error() + 1).cast("int").alias(f"{c}_within") for c in sk.COUNTED]
    return near.join(true, "y").select("y", "n", "v", *[F.col(f"true_{c}").alias(c) for c in sk.COUNTED], *kept)


@query
def by_code(s, d):
    return ru.by_code(fx.trades(s, d))


@query
def by_side(s, d):
    return ru.by_side(fx.trades(s, d))


@query
def by_form(s, d):
    return ru.by_form(fx.trades(s, d))


@query
def by_relationship(s, d):
    return ru.by_relationship(fx.trades(s, d))


@query
def by_security(s, d):
    return ru.by_security(fx.trades(s, d))


@query
def code_share(s, d):
    return ru.code_share(fx.trades(s, d)).select("code", "n", nm.r4(F.col("pct")).alias("pct"))


@query
def monthly_flow(s, d):
    return ru.monthly_flow(fx.trades(s, d))


@query
def yearly_flow(s, d):
    return ru.yearly_flow(fx.trades(s, d))


@query
def daily_flow(s, d):
    return _day(ru.daily_flow(fx.trades(s, d)).withColumn("net", nm.r2(F.col("net"))), "d")


@query
def daily_flow_recent(s, d):
    return _day(ru.daily_flow(fx.trades(s, d), "2001-08-01", 90).withColumn("net", nm.r2(F.col("net"))), "d")


@query
def company_summary(s, d):
    return _day(ru.company_summary(fx.trades(s, d)), "first", "last")


@query
def insider_summary(s, d):
    return _day(ru.insider_summary(fx.trades(s, d)), "first", "last")


@query
def net_buyers(s, d):
    return ru.net_buyers(ru.company_summary(fx.trades(s, d))).select("issuer", "net_v")


@query
def net_sellers(s, d):
    return ru.net_sellers(ru.company_summary(fx.trades(s, d))).select("issuer", "net_v")


@query
def top_purchasers(s, d):
    return ru.top_purchasers(ru.insider_summary(fx.trades(s, d))).select("owner", "buy_v")


@query
def insider_issuer_activity(s, d):
    a = ru.insider_issuer_activity(fx.trades(s, d)).withColumn("overlap", F.col("overlap").cast("int"))
    return _day(a, "first", "last", "first_buy", "last_buy", "first_sell", "last_sell")


@query
def review_filings(s, d):
    return _day(ru.review_filings(fx.trades(s, d)).select("owner", "issuer", "rank", "acc", "fd", "form", "amend", "url"), "fd")


@query
def activity_summary(s, d):
    return hd.activity_summary(_priced(s, d))


@query
def ranked_activity(s, d):
    return hd.ranked_activity(_priced(s, d)).select("owner", "issuer", "net_v")


@query
def reported_holdings(s, d):
    return _day(hd.reported_holdings(fx.trades(s, d)).select("owner", "issuer", "hsec", "di", "nature", "shares", "fd", "td", "acc"), "fd", "td")


@query
def insider_portfolio(s, d):
    return _day(hd.insider_portfolio(_priced(s, d)).withColumn("overlap", F.col("overlap").cast("int")), "first", "last")


@query
def portfolio_issuers(s, d):
    return hd.portfolio_issuers(_priced(s, d)).select("owner", "rank", "issuer", "holding_value", "url")


@query
def portfolio_summary(s, d):
    return hd.portfolio_summary(hd.insider_portfolio(_priced(s, d)))


@query
def publish_activity(s, d):
    p = hd.publish_activity(fx.trades(s, d), asof.latest_mark(fx.bars(s, d), fx.ASOF))
    return p.select("owner", "issuer", F.size("filings").alias("links"), F.get("filings", 0)["acc"].alias("newest"))


@query
def extract_signals(s, d):
    return _day(_signals(s, d), "fd", "td")


@query
def extract_signals_engine(s, d):
    return _day(sg.extract_signals(fx.trades(s, d), "engine").select("id", "td", "insider_sh", "insider_val", "insider_px", "lots", "sec"), "td")


@query
def signal_coverage(s, d):
    return sg.signal_coverage(fx.trades(s, d), minimum=20_000.0)


@query
def signal_coverage_engine(s, d):
    return sg.signal_coverage(fx.trades(s, d), "engine", 1.0)


@query
def return_stats(s, d):
    p = _trip(s, d)
    out = [st.return_stats(p, ["exit_status"], "exit_roi", m).withColumn("method", F.lit(m)) for m in ("linear", "floor", "nearest")]
    return out[0].unionByName(out[1]).unionByName(out[2])


@query
def stats_by_role(s, d):
    return st.stats_by_role(_book(s, d))


@query
def stats_by_size(s, d):
    return st.stats_by_size(_book(s, d))


@query
def stats_by_year(s, d):
    return st.stats_by_year(_book(s, d))


@query
def stats_by_horizon(s, d):
    return st.stats_by_horizon(_book(s, d))


@query
def stats_cuts(s, d):
    return st.stats_cuts(_book(s, d))


@query
def stats_by_exit_year(s, d):
    return st.stats_by_exit_year(_trip(s, d))


@query
def capital_summary(s, d):
    p = _book(s, d)
    return st.capital_summary(p).withColumn("basis", F.lit("valued")).unionByName(st.capital_summary(p, "reference").withColumn("basis", F.lit("reference")))


@query
def backtest_capital(s, d):
    return st.backtest_capital(_trip(s, d))


@query
def position_counts(s, d):
    return st.position_counts(_book(s, d))


@query
def paper_verification_counts(s, d):
    return st.paper_verification_counts(_book(s, d))


@query
def outcome_split(s, d):
    return st.outcome_split(_book(s, d))


@query
def outcome_rows(s, d):
    p = _book(s, d)
    return st.outcome_rows(p, "winner").unionByName(st.outcome_rows(p, "loser")).select("id", "pnl")


@query
def findings(s, d):
    return st.findings(_book(s, d))


@query
def dataset_fingerprint(s, d):
    return ql.dataset_fingerprint(fx.trades(s, d))


# ------------------------------------------------------------------ 2.7 windows and time series


@query
def session_index(s, d):
    return _day(asof.session_index(fx.bars(s, d)).select("tk", "d", "i"), "d")


@query
def simulate_positions(s, d):
    p = _book(s, d)
    for b in ("split_flag", "roi_review"):
        p = p.withColumn(b, F.col(b).cast("int"))
    dates = ["fd", "td", "entry_d", "last_d", "exit_d"] + [f"r{n}_d" for n in fv.HORIZONS]
    return _day(p.drop("filing_url", "history_url", "second_history_url", "form", "amend", "co", "pcik", "rel", "title", "sec"), *dates)


@query
def simulate_positions_without_splits(s, d):
    return _raw_book(s, d).select("id", "status", "mtm", "pnl", "roi", "gap", F.col("roi_review").cast("int").alias("roi_review"), "roi_reported", "pnl_reported", "exit_roi", "exit_status")


@query
def round_trip_backtest(s, d):
    p = _trip(s, d).withColumn("roi_review", F.col("roi_review").cast("int"))
    return _day(p.drop("filing_url", "history_url", "co", "rel", "title", "insider", "icik"), "fd", "td", "entry_d", "last_d", "exit_d")


@query
def classify_position_status(s, d):
    return _trip(s, d).groupBy("status", "entry_rule_status", "exit_status").agg(F.count(F.lit(1)).alias("n"))


@query
def find_price_discontinuity(s, d):
    e = _trip(s, d).where("entry_d IS NOT NULL").select("id", "tk", "entry_d")
    return _day(sp.find_price_discontinuity(e, asof.enrich_bars(fx.bars(s, d), fx.ASOF)).select("id", "jump_d"), "jump_d")


@query
def classify_splits(s, d):
    x = asof.enrich_bars(fx.bars(s, d), fx.ASOF)
    out = [sp.classify_splits(fx.splits(s, d), x, t).withColumn("test", F.lit(t)) for t in ("reference", "log")]
    return _day(out[0].unionByName(out[1]), "d")


@query
def adjust_for_splits(s, d):
    return _book(s, d).where("split_flag").select("id", "roi_status", "shares", "shares_after_split", "mtm", "roi", "roi_corrected", "r5", "r21", "exit_roi")


@query
def withhold_suspicious_returns(s, d):
    return _raw_book(s, d).where("roi_review").select("id", "roi", "roi_reported", "pnl_reported")


@query
def performance_factors(s, d):
    return ps.performance_factors(_book(s, d))


@query
def equity_curve_monthly(s, d):
    return st.equity_curve_monthly(_book(s, d))


@query
def equity_curve_daily(s, d):
    d = fx.priced(s, d)
    return _day(st.equity_curve_daily(_raw_book(s, d), fx.bars(s, d), fx.ASOF), "d")


@query
def cluster_buys(s, d):
    return _day(flags.cluster_buys(fx.trades(s, d), fx.CLUSTER), "start_d", "end_d")


@query
def recent_tape(s, d):
    a = ru.recent_tape(fx.trades(s, d), "2001-09-01").withColumn("asof", F.lit("2001-09-01"))
    b = ru.recent_tape(fx.trades(s, d), "2003-01-01").withColumn("asof", F.lit("2003-01-01"))
    return _day(a.unionByName(b).select("asof", "acc", "pos", "fd", "td"), "fd", "td")


@query
def recent_per_company(s, d):
    return ru.recent_per_company(fx.trades(s, d)).select("issuer", "rank", "acc", "pos")


@query
def recent_per_pair(s, d):
    return ru.recent_per_pair(fx.trades(s, d)).select("owner", "issuer", "rank", "acc", "pos")


# ------------------------------------------------------------------ 2.8 sorts


@query
def best_worst_positions(s, d):
    return st.best_worst_positions(_book(s, d)).select("side", "id", "roi", "pnl")


@query
def view_sort_page(s, d):
    t = fx.trades(s, d)
    a = vw.view_sort_page(t, "val", numeric=True, page=3, tie=("acc", "pos")).withColumn("view", F.lit("value"))
    b = vw.view_sort_page(t, "nature", descending=False, page=1, tie=("acc", "pos")).withColumn("view", F.lit("nature"))
    return a.unionByName(b).select("view", "acc", "pos")


@query
def view_seek_page(s, d):
    """The second pages of two views, each behind the last row of the page before."""
    t, out = fx.trades(s, d).select("acc", "pos", "val", "nature"), []
    for view, key, how in (("value", "val", {"numeric": True}), ("nature", "nature", {"descending": False})):
        first = vw.view_seek_page(t, key, tie=("acc", "pos"), **how).collect()
        if first:
            after = vw.seek_position(first[-1], key, numeric=how.get("numeric", False), tie=("acc", "pos"))
            out.append(vw.view_seek_page(t, key, after, tie=("acc", "pos"), **how).withColumn("view", F.lit(view)))
    return reduce(DataFrame.unionByName, out or [t.limit(0).withColumn("view", F.lit(""))]).select("view", "acc", "pos")


@query
def sample_rows(s, d):
    return vw.sample_rows(fx.trades(s, d)).select("m", "pick", "t", "acc", "pos", "val")


@query
def top_flags(s, d):
    t = fx.trades(s, d)
    f = flags.all_flags(flags.flag_large_transactions(t, fx.LARGE), flags.flag_cluster_buys(t, fx.CLUSTER), flags.flag_synchronized_sales(t, fx.SYNC))
    return flags.top_flags(f).select("id", "category", "severity", "tk", "total_value", "flag_key")


# ------------------------------------------------------------------ 2.9 quality


@query
def row_issues(s, d):
    return ql.row_issues(fx.trades(s, d)).select("issue", "severity", "acc", "pos", "source_url")


@query
def row_issues_rare(s, d):
    """The same audit over rows whose fields are damaged by their own attributes, so every check fires."""
    t = fx.trades(s, d)
    k = F.col("amend") == 1
    worse = (t.withColumn("acc", F.when(k & (F.col("code") == "A"), F.lit("")).when(k & (F.col("code") == "G"), F.lit("12-3")).otherwise(F.col("acc")))
             .withColumn("tk", F.when(k & (F.col("code") == "S"), F.lit("?bad")).otherwise(F.col("tk")))
             .withColumn("sh", F.when(k & (F.col("sec") == "Warrant"), -F.col("sh")).otherwise(F.col("sh")))
             .withColumn("px", F.when(k & (F.col("di") == "I"), -F.col("px")).otherwise(F.col("px")))
             .withColumn("code", F.when(k & (F.col("code") == "M"), F.lit("")).when(F.col("code") == "M", F.lit("q")).otherwise(F.col("code")))
             .withColumn("td", F.when(k & (F.col("form") == "5"), F.lit(None)).otherwise(F.col("td"))))
    return ql.issue_counts(worse)


@query
def issue_counts(s, d):
    return ql.issue_counts(fx.trades(s, d), fx.TARGET_YEAR)


@query
def severity_counts(s, d):
    return ql.severity_counts(fx.trades(s, d))


@query
def issue_examples(s, d):
    return ql.issue_examples(ql.row_issues(fx.trades(s, d))).select("issue", "acc", "pos")


@query
def audit_counts(s, d):
    return ql.audit_counts(fx.trades(s, d), fx.TARGET_YEAR)


@query
def audit_by_code(s, d):
    return ql.audit_by_code(fx.trades(s, d))


@query
def coverage_report(s, d):
    """The year under audit, which ends early, and one that is whole."""
    t = fx.trades(s, d)
    both = ql.coverage_report(t, fx.TARGET_YEAR, fx.AUDIT_ASOF).unionByName(ql.coverage_report(t, 1999, fx.AUDIT_ASOF))
    c = both.withColumn("complete", F.col("complete").cast("int"))
    return _day(c, "target_start", "target_end", "observed_from", "observed_to", "target_from", "target_to")


@query
def manifest_blockers(s, d):
    """A ledger derived from the orders: one window, and one entry per quarter that says whether it is full."""
    o = fx.table(s, d, "orders").select(F.col("o_orderdate").cast("date").alias("d"))
    text = F.lit(None).cast("string")
    window = o.agg(F.min("d").alias("window_from"), F.max("d").alias("window_to")).select(
        F.year("window_to").alias("target_year"), "window_from", "window_to", F.lit("window").alias("kind"), text.alias("label"), text.alias("status"))
    label = F.concat(F.year("d").cast("string"), F.lit("Q"), F.quarter("d").cast("string"))
    quarters = o.groupBy(label.alias("label")).agg(F.max("d").alias("m")).select(
        F.lit(None).cast("int").alias("target_year"), F.lit(None).cast("date").alias("window_from"), F.lit(None).cast("date").alias("window_to"), F.lit("quarter").alias("kind"),
        "label", F.when(F.date_add("m", 20) > F.last_day(F.add_months(F.trunc("m", "quarter"), 2)), F.lit("ok")).otherwise(F.lit("partial")).alias("status"))
    return ql.manifest_blockers(window.unionByName(quarters), 2001, fx.AUDIT_ASOF)


_FLAG_COLUMNS = ["category", "severity", "tk", "icik", "fd_text", "td_text", "total_shares", "total_value", "row_n", "filing_n", "insider_n", "ticker_n"]


@query
def flag_large_transactions(s, d):
    return flags.flag_large_transactions(fx.trades(s, d), fx.LARGE).select(*_FLAG_COLUMNS, "summary")


@query
def flag_cluster_buys(s, d):
    return flags.flag_cluster_buys(fx.trades(s, d), fx.CLUSTER).select(*_FLAG_COLUMNS, "summary")


@query
def flag_synchronized_sales(s, d):
    return flags.flag_synchronized_sales(fx.trades(s, d), fx.SYNC).select(*_FLAG_COLUMNS)


@query
def flag_exercise_then_sale(s, d):
    return flags.flag_exercise_then_sale(fx.trades(s, d)).select(*_FLAG_COLUMNS, "sell_value")


@query
def flag_buy_sell_overlap(s, d):
    return flags.flag_buy_sell_overlap(fx.trades(s, d), fx.OVERLAP).select(*_FLAG_COLUMNS, "buy_value", "sell_value")


@query
def flag_large_noncash(s, d):
    return flags.flag_large_noncash(fx.trades(s, d), fx.NONCASH).select(*_FLAG_COLUMNS, "summary")


@query
def flag_price_gap(s, d):
    return flags.flag_price_gap(_raw_book(s, d)).select("category", "severity", "tk", "fd_text", "total_value", "flag_key")


@query
def flag_split_straddle(s, d):
    return flags.flag_split_straddle(_raw_book(s, d)).select("category", "severity", "tk", "fd_text", "total_value", "flag_key")


@query
def flag_unsupported_mark(s, d):
    return flags.flag_unsupported_mark(_raw_book(s, d)).select("category", "severity", "tk", "fd_text", "total_value", "flag_key")


@query
def flag_data_quality(s, d):
    t = fx.trades(s, d)
    return flags.flag_data_quality(ql.coverage_report(t, fx.TARGET_YEAR, fx.AUDIT_ASOF), ql.issue_counts(t, fx.TARGET_YEAR)).select("category", "severity", "row_n")


@query
def flag_item(s, d):
    t = fx.trades(s, d)
    members = t.withColumn("kind", F.lit("overlap")).withColumn("flag_key", F.col("icik"))
    return flags.flag_item(members).select("flag_key", *_FLAG_COLUMNS)


@query
def flag_evidence(s, d):
    t = fx.trades(s, d)
    return flags.flag_evidence(flags.flag_synchronized_sales(t, fx.SYNC), flags.members_synchronized_sales(t))


@query
def flag_filings(s, d):
    t = fx.trades(s, d)
    return flags.flag_filings(flags.flag_cluster_buys(t, fx.CLUSTER), flags.members_cluster(t, fx.CLUSTER))


@query
def flag_parties(s, d):
    t = fx.trades(s, d)
    return flags.flag_parties(flags.flag_cluster_buys(t, fx.CLUSTER), flags.members_cluster(t, fx.CLUSTER))


@query
def verify_positions(s, d):
    return vf.verify_counts(vf.verify_positions(_book(s, d)))


@query
def verify_backtest(s, d):
    return vf.verify_counts(vf.verify_backtest(_trip(s, d)))


@query
def verify_activity(s, d):
    return vf.verify_counts(vf.verify_activity(_priced(s, d), hd.reported_holdings(fx.trades(s, d))))


@query
def verify_summary(s, d):
    p = _book(s, d)
    return vf.verify_summary(p, st.position_counts(p), st.capital_summary(p)).withColumn("ok", F.col("ok").cast("int"))


@query
def backtest_reconciliation(s, d):
    return vf.backtest_reconciliation(_trip(s, d), _signals(s, d))


# ------------------------------------------------------------------ 2.10 streaming


def _trade_stream(s, d):
    return fx.trades_from(jobs.stream_table(s, d, "lineitem"), s, d)


@query
def stream_row_issues(s, d):
    path = scratch_folder(s, "stream-issues")
    out = jobs.stream_row_issues(_trade_stream(s, d))
    jobs.run_to_table(out, path)
    return jobs.stored(s, path, out).groupBy("issue", "severity").agg(F.count(F.lit(1)).alias("n"))


@query
def stream_flow_windows(s, d):
    path = scratch_folder(s, "stream-flow")
    out = jobs.stream_flow_windows(_trade_stream(s, d)).select(F.col("window.start").cast("date").alias("d"), "code", "n", "derivative", "value")
    jobs.run_batches(out, path, mode="update")
    log = jobs.stored(s, path, out, batches=True)
    latest = merge.last_update_wins(log.withColumn("k", F.struct("d", "code")), "k", "batch")
    return _day(latest.select("d", "code", "n", "derivative", "value"), "d")


@query
def stream_sliding_windows(s, d):
    path = scratch_folder(s, "stream-slide")
    out = jobs.stream_flow_windows(_trade_stream(s, d), "7 days", "1 day").select(F.col("window.start").cast("date").alias("d"), "code", "n", "value")
    jobs.run_batches(out, path, mode="update")
    log = jobs.stored(s, path, out, batches=True)
    return _day(merge.last_update_wins(log.withColumn("k", F.struct("d", "code")), "k", "batch").select("d", "code", "n", "value"), "d")


@query
def stream_dedupe(s, d):
    path = scratch_folder(s, "stream-dedupe")
    t = _trade_stream(s, d)
    out = jobs.stream_dedupe(t.unionByName(_trade_stream(s, d))).select("acc", "der", "td", "code", "sec", "sh", "px", "ad", "pcik")
    jobs.run_to_table(out, path)
    return _day(jobs.stored(s, path, out), "td")


def _arrivals(s, t, path):
    """What has been put below ``path`` so far, as a stream."""
    return s.readStream.schema(t.schema).option("recursiveFileLookup", "true").parquet(f"{path}/in")


def _ingested(s, d):
    """The trades arrive in four portions; the table is compacted after the second and goes on."""
    path = scratch_folder(s, "stream-ingest")
    t = materialize(fx.trades(s, d), "trades")
    for part in range(4):
        t.where(F.pmod("pos", F.lit(4)) == part).write.parquet(f"{path}/in/{part}")
        jobs.stream_ingest_trades(_arrivals(s, t, path), f"{path}/table")
        if part == 1:
            table.compact(s, f"{path}/table", t.schema)
        table.expire(s, f"{path}/table", keep=1)
    return f"{path}/table", t


@query
def stream_ingest_trades(s, d):
    path, t = _ingested(s, d)
    return jobs.merged_trades(s, path, t).select("acc", "pos", "code", "sh")


@query
def stream_table_years(s, d):
    """Rows per filing year of the ingested table, for two years that alone are listed and read."""
    path, t = _ingested(s, d)
    return table.read(s, path, t.schema, [1995, 1998]).groupBy("fy").agg(F.count(F.lit(1)).alias("n"))


def _appended(s, d):
    """Trades in filing order, in four portions; every 53rd comes with the last one, long after its time."""
    path = scratch_folder(s, "stream-append")
    t = fx.trades(s, d)
    delayed = F.pmod("pos", F.lit(53)) == 0
    part = F.when(delayed, 3).otherwise(F.floor((F.greatest(F.year("fd"), F.lit(1992)) - 1992) / 2)).cast("int")
    for k in range(4):
        t.where(F.least(part, F.lit(3)) == k).write.parquet(f"{path}/in/{k}")
        windows = jobs.stream_flow_windows(_arrivals(s, t, path))
        out = windows.select(F.col("window.start").cast("date").alias("d"), "code", "n", "derivative", "value")
        jobs.append_windows(out, path)
    return path, t, jobs.stored(s, path, out)


@query
def stream_flow_windows_append(s, d):
    """Final windows, each emitted once; late rows are not in them."""
    return _day(_appended(s, d)[2], "d")


@query
def stream_late_rows(s, d):
    """What became of every row that arrived."""
    path, t, emitted = _appended(s, d)
    return jobs.late_rows(t, emitted, path)


#: Bars that the state of a streamed join has to hold at a time, besides those of the window before them.
BARS_AT_ONCE = 2_000_000


def _entry_statuses(s, d):
    """Signals and bars arrive in order, in stretches of days with ``BARS_AT_ONCE`` bars each on average; what a stretch leaves
    open waits in the state for the next one."""
    path = scratch_folder(s, "pending")
    sources = {"signals": (materialize(_signals(s, d).select("id", "tk", "fd"), "signals"), "fd"),
               "bars": (materialize(fx.bars(s, d).select("tk", "d", "o"), "bars"), "d")}
    known = [df.agg(F.count(F.lit(1)), F.min(F.unix_date(day)), F.max(F.unix_date(day))).first() for df, day in sources.values()]
    first, last = min((k[1] for k in known if k[1] is not None), default=0), max((k[2] for k in known if k[2] is not None), default=0)
    portions = max(1, min(-(-known[1][0] // BARS_AT_ONCE), last - first + 1))
    for k in range(portions):
        for name, (df, day) in sources.items():
            portion = F.coalesce(F.floor((F.unix_date(day) - first) * portions / (last - first + 1)), F.lit(0))
            df.where(portion == k).write.parquet(f"{path}/{name}/in/{k}")
        out = jobs.stream_pending_entries(*[_arrivals(s, df, f"{path}/{name}") for name, (df, _) in sources.items()])
        jobs.run_batches(out, path)
    emitted = jobs.stored(s, path, out, batches=True)
    return _day(jobs.resolve_entries(sources["signals"][0], emitted), "fd", "entry_d")


@query
def stream_pending_entries(s, d):
    """The entries alone, as its statement asks; ``stream_entry_statuses`` has every signal."""
    return _entry_statuses(s, d).where("entry_rule_status = 'verified'")


@query
def stream_entry_statuses(s, d):
    """Every signal: entered, still waiting, or without a bar in its window."""
    return _entry_statuses(s, d)


@query
def stream_entry_timers(s, d):
    """The same statuses from keyed state with timers; signals and bars arrive in four portions of two years."""
    path = scratch_folder(s, "timers")
    sources = {"signals": (_signals(s, d).select("id", "tk", "fd"), "fd"), "bars": (fx.bars(s, d).select("tk", "d", "o"), "d")}
    for k in range(4):
        for name, (df, day) in sources.items():
            portion = F.least(F.floor((F.greatest(F.year(day), F.lit(1992)) - 1992) / 2), F.lit(3))
            df.where(portion == k).write.parquet(f"{path}/{name}/in/{k}")
        out = pending.entry_changes(*[_arrivals(s, df, f"{path}/{name}") for name, (df, _) in sources.items()])
        pending.run_changes(out, path)
    return _day(pending.current_statuses(jobs.stored(s, path, out, batches=True)), "fd", "entry_d")


def flagship(spark: SparkSession, folder: str) -> DataFrame:
    """Could a follower have made money? Purchases -> next-session entry -> returns by role, size and year."""
    return st.stats_cuts(_book(spark, folder))
