"""Lists, patterns, thresholds and texts that results depend on.

Nothing in this file is derived; changing any entry changes published numbers.
"""

# --- transaction codes: (code, side, description in the bulk tables) -------------------------
TRANSACTION_CODES = [
    ("P", "buy", "Open market or private purchase of securities"),
    ("S", "sell", "Open market or private sale of securities"),
    ("A", "grant", "Grant, award or other acquisition pursuant to Rule 16b-3(d)"),
    ("D", "to_issuer", "Disposition to the issuer pursuant to Rule 16b-3(e)"),
    ("F", "withholding", "Payment of exercise price or tax liability by delivering or withholding securities"),
    ("I", "other", "Discretionary transaction under Rule 16b-3(f)"),
    ("M", "exercise", "Exercise or conversion of derivative security exempt under Rule 16b-3"),
    ("C", "exercise", "Conversion of derivative security"),
    ("E", "expiration", "Expiration of short derivative position"),
    ("H", "expiration", "Expiration or cancellation of long derivative position with value received"),
    ("O", "exercise", "Exercise of out-of-the-money derivative security"),
    ("X", "exercise", "Exercise of in-the-money or at-the-money derivative security"),
    ("G", "gift", "Bona fide gift"),
    ("L", "other", "Small acquisition under Rule 16a-6"),
    ("W", "other", "Acquisition or disposition by will or the laws of descent and distribution"),
    ("Z", "other", "Deposit into or withdrawal from voting trust"),
    ("J", "other", "Other acquisition or disposition"),
    ("K", "other", "Transaction in equity swap or instrument with similar characteristics"),
    ("U", "other", "Disposition pursuant to a tender of shares in a change of control transaction"),
    ("V", "other", None),
]

# --- descriptions used for documents read one by one (XML) -----------------------------------
XML_CODE_TEXT = {
    "P": "Open market or private purchase of securities",
    "S": "Open market or private sale of securities",
    "V": "Transaction voluntarily reported earlier than required",
    "A": "Grant, award, or other acquisition",
    "D": "Sale (or disposition) back to the issuer",
    "F": "Payment of exercise price or tax liability by delivering/withholding securities",
    "I": "Discretionary transaction",
    "M": "Exercise or conversion of derivative security",
    "C": "Conversion of derivative security",
    "E": "Expiration of short derivative position",
    "H": "Expiration or cancellation of long derivative position with value received",
    "O": "Exercise of out-of-the-money derivative securities",
    "X": "Exercise of in-the-money or at-the-money derivative securities",
    "G": "Bona fide gift",
    "L": "Small acquisition",
    "W": "Acquisition or disposition by will or laws of descent and distribution",
    "Z": "Deposit into or withdrawal from voting trust",
    "J": "Other acquisition or disposition (described in footnotes)",
    "K": "Transaction in equity swap or similar instrument",
    "U": "Disposition due to a tender of shares in a change of control transaction",
}

AUDITED_CODES = "PSVADFIMCEHOXGLWZJKU"

# --- relationships, in display order ----------------------------------------------------------
RELATIONSHIPS = ["Director", "Officer", "10% Owner", "Other"]
NO_RELATIONSHIP = "Unknown"

# --- words that mean "no value" / "no ticker" --------------------------------------------------
NULL_WORDS = ["NULL", "NONE", "NA", "N/A"]
ENGINE_TICKER_JUNK = ["NONE", "N/A", "NA", "NULL", "NONEYET", "OTC", "PINK", "UNKNOWN", "NOTAPPLICABLE", "N.A."]
SITE_TICKER_JUNK = ["NONE", "N-A", "NA", "NULL", "NOTAPPLICABLE"]

# --- patterns ----------------------------------------------------------------------------------
ACCESSION_PATTERN = r"^\d{10}-\d{2}-\d{6}$"
ENGINE_TICKER_PATTERN = r"^[A-Z][A-Z0-9]{0,5}([./-][A-Z0-9]{1,2})?$"
SITE_TICKER_PATTERN = r"^[A-Z][A-Z0-9-]{0,7}$"
AUDIT_TICKER_PATTERN = r"^[A-Z][A-Z0-9./-]{0,15}$"
LENIENT_NOT_EQUITY_PATTERN = (
    r"(?i)\b(preferred|pref\.?|warrant|warrants|stock option|option(s)?|restricted stock units?|r[su]us?|"
    r"phantom|performance (share|unit|stock)|psu[s]?|stock appreciation|sa[rs][s]?|"
    r"right to (buy|purchase)|subscription right|convertible (note|debenture|preferred)|"
    r"note|bond|debenture|debt|swap|future|unit \(|depositary share)\b"
)
LENIENT_ADR_PATTERN = r"(?i)\b(adr|ads|american depositary(\s+(receipt|share))?s?)\b"
STRICT_NOT_EQUITY_WORDS = ["option", "warrant", "right", "unit", "note", "debenture", "preferred",
                           "restricted stock unit", "rsu", "phantom", "sar", "convertible", "deferred"]
STRICT_EQUITY_WORDS = ["common", "ordinary", "class a", "class b", "adr", "american depositary", "share"]

# --- buckets: (exclusive upper limit, label) ----------------------------------------------------
SITE_SIZE_BUCKETS = [(10_000, "<$10k"), (50_000, "$10k–50k"), (250_000, "$50k–250k"),
                     (1_000_000, "$250k–$1M"), (None, ">$1M")]
ENGINE_SIZE_BUCKETS = [(10_000, "<$10k"), (50_000, "$10–50k"), (250_000, "$50–250k"),
                       (1_000_000, "$250k–$1M"), (None, ">$1M")]
ISSUER_BUCKETS = 64

# --- simulation ---------------------------------------------------------------------------------
STAKE = 10_000.0
ENTRY_MAX_GAP_DAYS = 10
HORIZONS = [0, 1, 5, 21, 63, 252]
EXIT_SESSIONS = 252
MATURE_DAYS = 380
SITE_MIN_VALUE = 1_000.0
ENGINE_MIN_VALUE = 1.0
JUMP_FACTOR = 3.0

# --- published list lengths (features, not safety caps) -------------------------------------------
TAPE_DAYS = 120
RECENT_PER_ISSUER, RECENT_PER_PAIR = 40, 10
TOP_FLOW = 60
TOP_POSITIONS = 25
PORTFOLIO_ISSUERS, REVIEW_FILINGS = 25, 10
FLAG_ROWS = 250
FINDING_MIN_N = 30

# --- review thresholds -----------------------------------------------------------------------------
LARGE_VALUE = 5_000_000.0
CLUSTER_DAYS, CLUSTER_MIN_VALUE = 7, 25_000.0
SYNC_SALE_MIN_VALUE = 1_000_000.0
LARGE_NONCASH_SHARES = 100_000.0
OVERLAP_MIN_VALUE = 25_000.0
VALUE_TOLERANCE = 0.05
LATE_FORM4_DAYS = 2
SEVERITIES = ["High", "Medium", "Low", "Informational"]

# --- fields that survive in a compact row ------------------------------------------------------------
COMPACT_FIELDS = ["fd", "td", "co", "tk", "insider", "rel", "title", "code", "ct", "side", "sec", "sh", "px",
                  "val", "ad", "af", "di", "der", "acc", "icik", "pcik", "form", "amend", "xp", "exp", "under"]

# --- addresses -----------------------------------------------------------------------------------------
FILING_ARCHIVE = "https://www.sec.gov/Archives/edgar/data/"
CORPORATE_ACTION_URL = ("https://www.sec.gov/cgi-bin/browse-edgar?action=getcompany&CIK=%s"
                        "&type=8-K&dateb=&owner=include&count=40")
PRICE_HISTORY_URL = "https://finance.yahoo.com/quote/%s/history"
SECOND_HISTORY_URL = "https://stooq.com/q/d/?s=%s.us"

# --- forms kept from a filing index: form as listed -> (root form, amendment flag) ---------------------
INDEX_FORMS = {"4": ("4", 0), "4/A": ("4", 1), "5": ("5", 0), "5/A": ("5", 1)}
PRICE_SOURCES = ["yahoo", "stooq", "nasdaq"]

# --- review flags: kind -> (category, severity) ---------------------------------------------------------
FLAG_KINDS = {
    "large_purchase": ("Large disclosed purchase", "Medium"),
    "large_sale": ("Large disclosed sale", "Low"),
    "cluster": ("Cluster buying", "Medium"),
    "sync_sales": ("Synchronized same-day sales", "Medium"),
    "exercise_sale": ("Exercise/conversion with same-filing sale", "Low"),
    "overlap": ("Same-insider buy/sell overlap", "Low"),
    "noncash_gift": ("Large non-cash transaction", "Medium"),
    "noncash": ("Large non-cash transaction", "Low"),
    "price_gap": ("Paper gap vs as-filed insider price (possible split adjustment)", "High"),
    "straddle": ("Implausible mark-to-market ROI — corporate action / split-straddle review", "High"),
    "unsupported_mark": ("Paper mark not independently supported (no post-entry session bar)", "Medium"),
    "coverage_gap": ("Data coverage gap", "High"),
    "row_issue": ("Row integrity issue: ", "Medium"),
}
