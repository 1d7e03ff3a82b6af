"""Table layouts. Ingest never infers a schema; absent columns become typed NULLs."""
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import (ArrayType, DateType, DoubleType, IntegerType, LongType, StringType, StructField,
                               StructType)


def _struct(spec):
    kinds = {"s": StringType(), "i": IntegerType(), "l": LongType(), "f": DoubleType(), "d": DateType()}
    return StructType([StructField(name, kinds[kind]) for name, kind in (item.split(":") for item in spec.split())])


# One row per transaction of one filing. ``pos`` is the row's position inside its filing; it makes every
# "first", "last" and "latest" below a total order instead of an accident of file order.
TRADES = _struct("fd:d td:d period:d form:s amend:i acc:s co:s tk:s icik:s insider:s pcik:s own_n:i rel:s title:s "
                 "code:s ct:s side:s sec:s sh:f px:f val:f ad:s af:f di:s nature:s der:i under:s under_sh:f xp:f "
                 "exp:d timely:s swap:s pos:l")
BARS = _struct("tk:s d:d o:f h:f l:f c:f v:l src:s")
SPLITS = _struct("tk:s d:d num:f den:f")
LEDGER = _struct("target_year:i window_from:d window_to:d kind:s label:s status:s")

# Raw quarterly tables: all text, found by header name.
_RAW = {
    "SUBMISSION": "ACCESSION_NUMBER FILING_DATE PERIOD_OF_REPORT DOCUMENT_TYPE ISSUERCIK ISSUERNAME "
                  "ISSUERTRADINGSYMBOL",
    "REPORTINGOWNER": "ACCESSION_NUMBER RPTOWNERCIK RPTOWNERNAME RPTOWNER_RELATIONSHIP RPTOWNER_TITLE RPTOWNER_TXT",
    "NONDERIV_TRANS": "ACCESSION_NUMBER NONDERIV_TRANS_SK SECURITY_TITLE TRANS_DATE DEEMED_EXECUTION_DATE "
                      "TRANS_CODE EQUITY_SWAP_INVOLVED TRANS_TIMELINESS TRANS_SHARES TRANS_PRICEPERSHARE "
                      "TRANS_ACQUIRED_DISP_CD SHRS_OWND_FOLWNG_TRANS DIRECT_INDIRECT_OWNERSHIP NATURE_OF_OWNERSHIP",
}
_RAW["DERIV_TRANS"] = (_RAW["NONDERIV_TRANS"].replace("NONDERIV_TRANS_SK", "DERIV_TRANS_SK")
                       + " CONV_EXERCISE_PRICE TRANS_TOTAL_VALUE EXPIRATION_DATE UNDLYING_SEC_TITLE "
                         "UNDLYING_SEC_SHARES UNDLYNG_SEC_TITLE UNDLYNG_SEC_SHARES")
RAW_TABLES = {name: StructType([StructField(c, StringType()) for c in cols.split()]) for name, cols in _RAW.items()}

_VALUE = StructType([StructField("value", StringType())])


def _tx(derivative):
    fields = [
        StructField("securityTitle", _VALUE),
        StructField("transactionDate", _VALUE),
        StructField("transactionCoding", StructType([StructField("transactionCode", StringType()),
                                                     StructField("equitySwapInvolved", StringType())])),
        StructField("transactionAmounts", StructType([
            StructField("transactionShares", _VALUE), StructField("transactionPricePerShare", _VALUE),
            StructField("transactionAcquiredDisposedCode", _VALUE)])),
        StructField("postTransactionAmounts", StructType([StructField("sharesOwnedFollowingTransaction", _VALUE)])),
        StructField("ownershipNature", StructType([StructField("directOrIndirectOwnership", _VALUE)])),
    ]
    if derivative:
        fields += [StructField("conversionOrExercisePrice", _VALUE), StructField("expirationDate", _VALUE),
                   StructField("underlyingSecurity", StructType([StructField("underlyingSecurityTitle", _VALUE)]))]
    return StructType(fields)


OWNERSHIP_DOCUMENT = StructType([
    StructField("schemaVersion", StringType()),
    StructField("documentType", StringType()),
    StructField("periodOfReport", StringType()),
    StructField("issuer", StructType([StructField("issuerCik", StringType()), StructField("issuerName", StringType()),
                                      StructField("issuerTradingSymbol", StringType())])),
    StructField("reportingOwner", ArrayType(StructType([
        StructField("reportingOwnerId", StructType([StructField("rptOwnerCik", StringType()),
                                                    StructField("rptOwnerName", StringType())])),
        StructField("reportingOwnerRelationship", StructType([
            StructField(n, StringType())
            for n in ("isDirector", "isOfficer", "isTenPercentOwner", "isOther", "officerTitle")])),
    ]))),
    StructField("nonDerivativeTable",
                StructType([StructField("nonDerivativeTransaction", ArrayType(_tx(False)))])),
    StructField("derivativeTable", StructType([StructField("derivativeTransaction", ArrayType(_tx(True)))])),
])


def with_missing(df: DataFrame, schema: StructType) -> DataFrame:
    """Project ``df`` onto ``schema``: absent columns appear as typed NULLs, extra ones are dropped."""
    have = set(df.columns)
    return df.select(*[(F.col(f"`{f.name}`") if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
                       for f in schema.fields])
