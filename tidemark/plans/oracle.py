"""DuckDB statements that answer the catalog's queries independently, over the same parquet tables."""
import re

from .. import fixed_values as fv
from . import fixtures as fx

SQL = {}


def _grid(x, scale):
    y = f"(CAST(round_even(({x}) * {scale}, 0) AS DOUBLE) / {scale})"
    return f"(CASE WHEN {y} = 0 THEN 0.0::DOUBLE ELSE {y} END)"


def r2(x):
    return _grid(x, "1e2")


def r4(x):
    return _grid(x, "1e4")


def total(x):
    return f"CAST(coalesce(sum(CAST({x} AS DECIMAL(28,4))), 0) AS DOUBLE)"


def quoted(words):
    return ", ".join("'" + w.replace("'", "''") + "'" for w in words)


V = "abs(coalesce(val, 0))"
BUY, SELL = "code = 'P'", "code = 'S'"
URL = "'https://www.sec.gov/Archives/edgar/data/' || {cik} || '/' || replace({acc}, '-', '') || '/' || {acc} || '-index.htm'"
H = fv.HORIZONS

_STRICT = ("(CASE WHEN {t} = '' THEN true WHEN regexp_matches({t}, '" + "|".join(fv.STRICT_NOT_EQUITY_WORDS) + "') "
           "THEN starts_with({t}, 'common stock') AND NOT contains({t}, 'option') AND NOT contains({t}, 'unit') "
           "ELSE regexp_matches({t}, '" + "|".join(fv.STRICT_EQUITY_WORDS) + "') END)")
_LENIENT = (f"(trim({{t}}) = '' OR regexp_matches({{t}}, '{fv.LENIENT_ADR_PATTERN}') "
            f"OR NOT regexp_matches({{t}}, '{fv.LENIENT_NOT_EQUITY_PATTERN}'))")


def strict(t):
    return _STRICT.format(t=f"lower(trim({t}))")


def lenient(t):
    return _LENIENT.format(t=t)


def role(rel, title):
    return (f"CASE WHEN contains({rel}, 'Officer') THEN CASE WHEN regexp_matches(lower({title}), 'chief executive|ceo') THEN 'CEO' "
            f"WHEN regexp_matches(lower({title}), 'chief financial|cfo') THEN 'CFO' WHEN contains(lower({title}), 'president') THEN 'President' "
            f"ELSE 'Other officer' END WHEN contains({rel}, '10% Owner') THEN '10% owner' WHEN contains({rel}, 'Director') THEN 'Director' ELSE 'Other' END")


def size(v, table=fv.SITE_SIZE_BUCKETS):
    return "CASE " + " ".join(f"WHEN {v} < {lim} THEN '{name}'" for lim, name in table[:-1]) + f" ELSE '{table[-1][1]}' END"


CTES = {}


def _load(text):
    for m in re.finditer(r"(?ms)^([a-z_0-9]+) AS \(", text):
        CTES[m.group(1)] = None
    return text


# Blocks of common table expressions; each is included whole when one of its names is used.
BLOCKS = []


def block(text):
    BLOCKS.append((re.findall(r"(?m)^([a-z_0-9]+) AS \(", text), text))


block(fx.TRADES_SQL)
block(fx.BARS_SQL)
block(f"""clipped AS (SELECT * FROM bars WHERE d <= DATE '{fx.ASOF}'),
sessions AS (SELECT *, row_number() OVER (PARTITION BY tk ORDER BY d) - 1 AS i, lag(c) OVER (PARTITION BY tk ORDER BY d) AS pc FROM clipped),
series AS (SELECT tk, max(d) AS last_d, max(i) AS last_i, arg_max(c, d) AS last_c FROM sessions GROUP BY tk),
marks AS (SELECT tk, last_d AS mark_d, {r4('last_c')} AS mark_px FROM series)""")
block(f"""lots AS (SELECT * FROM trades WHERE code = 'P' AND der = 0 AND tk <> '' AND sh > 0 AND px > 0 AND {strict('sec')}),
candidates AS (SELECT acc || ':' || tk AS id, acc, tk, min(form) AS form, min(amend) AS amend, min(fd) AS fd, min(co) AS co, min(icik) AS icik, min(pcik) AS pcik,
  min(insider) AS insider, min(rel) AS rel, min(title) AS title, min(td) AS td, arg_min(sec, pos) AS sec,
  {r4(total('sh'))} AS insider_sh, {r2(total('val'))} AS insider_val, {r4(total('val') + ' / ' + total('sh'))} AS insider_px, count(*) AS lots
  FROM lots GROUP BY acc, tk),
signals AS (SELECT * FROM candidates WHERE insider_val >= 1000)""")
block(f"""entries AS (SELECT k.tk, k.fd, b.d AS entry_d, b.o AS epx, b.i AS entry_i
  FROM (SELECT DISTINCT tk, fd FROM signals) k ASOF LEFT JOIN (SELECT * FROM sessions WHERE o > 0) b ON k.tk = b.tk AND k.fd < b.d),
opened AS (SELECT s.*, e.epx, e.entry_d AS ed, e.entry_i, z.last_d AS zd, z.last_i AS zi, z.last_c AS zc,
  CASE WHEN z.tk IS NULL THEN 'no_price' WHEN e.entry_d IS NULL AND z.last_d < s.fd THEN 'no_bars_after_filing'
       WHEN e.entry_d IS NULL THEN 'awaiting_entry' WHEN e.entry_d - s.fd > 10 THEN 'entry_window_missing' ELSE 'verified' END AS rule
  FROM signals s LEFT JOIN entries e ON s.tk = e.tk AND s.fd = e.fd LEFT JOIN series z ON s.tk = z.tk),
live AS (SELECT o.*, 10000.0::DOUBLE / o.epx AS raw_shares, {', '.join(f'h{n}.c AS c{n}, h{n}.d AS d{n}' for n in H)}
  FROM opened o {' '.join(f"LEFT JOIN sessions h{n} ON o.tk = h{n}.tk AND h{n}.i = o.entry_i + {n}" for n in H)} WHERE rule = 'verified'),
jumps AS (SELECT tk, d FROM sessions WHERE pc > 0 AND (c / pc >= 3 OR c / pc <= 1.0::DOUBLE / 3)),
first_jumps AS (SELECT l.id, min(j.d) AS jump_d FROM live l JOIN jumps j ON l.tk = j.tk AND j.d > l.ed GROUP BY l.id)""")
block(f"""split_events AS (SELECT tk, ev AS d, ratio, jump, CASE WHEN jump BETWEEN 0.5 AND 2 THEN 'adjusted' WHEN jump BETWEEN 0.5 * ratio AND 2 * ratio THEN 'mixed' ELSE 'indeterminate' END AS kind
  FROM (SELECT s.tk, s.d AS ev, s.den / s.num AS ratio, {r4('b.o / b.pc')} AS jump FROM splits s ASOF JOIN sessions b ON s.tk = b.tk AND s.d <= b.d WHERE b.i > 0)),
crossed AS (SELECT l.id, count(*) AS ev_n, count(*) FILTER (WHERE kind = 'mixed') AS mixed_n, count(*) FILTER (WHERE kind = 'indeterminate') AS unclear_n,
  product(CASE WHEN kind = 'mixed' THEN e.ratio ELSE 1 END) AS ratio, min(e.d) FILTER (WHERE kind = 'mixed') AS first_mixed
  FROM live l JOIN split_events e ON l.tk = e.tk AND e.d > l.ed AND e.d <= l.zd GROUP BY l.id)""")


def _book(name, with_splits):
    split = ("LEFT JOIN crossed x USING (id)" if with_splits
             else "LEFT JOIN (SELECT NULL::VARCHAR AS id, NULL::BIGINT AS ev_n, NULL::BIGINT AS mixed_n, NULL::BIGINT AS unclear_n, NULL::DOUBLE AS ratio, NULL::DATE AS first_mixed) x USING (id)")
    hz = ", ".join(f"CASE WHEN c{n} IS NOT NULL AND (mixed_from IS NULL OR d{n} < mixed_from) THEN {r4(f'c{n} / epx - 1')} END AS r{n}, "
                   f"CASE WHEN c{n} IS NOT NULL AND (mixed_from IS NULL OR d{n} < mixed_from) THEN d{n} END AS r{n}_d, "
                   f"CASE WHEN c{n} IS NOT NULL AND (mixed_from IS NULL OR d{n} < mixed_from) THEN {r4(f'c{n}')} END AS r{n}_px" for n in H)
    return f"""{name}_a AS (SELECT l.*, x.ev_n, x.ratio, jump_d,
    CASE WHEN ev_n IS NULL THEN NULL WHEN unclear_n = ev_n THEN 'split_event_review' WHEN mixed_n > 0 THEN 'mixed_pre_post_split' ELSE 'split_adjusted_series' END AS roi_status,
    CASE WHEN mixed_n > 0 THEN raw_shares / x.ratio ELSE raw_shares END AS eff, CASE WHEN mixed_n > 0 THEN first_mixed END AS mixed_from
  FROM live l {split} LEFT JOIN first_jumps USING (id)),
{name}_b AS (SELECT *, eff * zc AS mark, zi - entry_i AS hold, {r4('eff * zc / 10000 - 1')} AS seen_roi, {r2('eff * zc - 10000')} AS seen_pnl, {hz} FROM {name}_a),
{name}_c AS (SELECT *, ev_n IS NULL AND (coalesce(jump_d <= zd, false) OR ((seen_roi > 2 OR seen_roi < -0.8) AND hold <= 90) OR seen_roi > 5) AS held_back FROM {name}_b),
{name} AS (SELECT s.id, s.acc, s.tk, s.fd, s.td, s.icik, s.pcik, s.insider, s.rel, s.title, s.insider_sh, s.insider_val, s.insider_px, s.lots,
    CASE s.rule WHEN 'verified' THEN 'open' WHEN 'awaiting_entry' THEN 'awaiting_entry' ELSE 'no_price' END AS status, s.rule AS entry_rule_status,
    CASE WHEN s.rule = 'entry_window_missing' THEN s.ed - s.fd END AS entry_gap_days, 10000.0::DOUBLE AS stake,
    c.ed AS entry_d, {r4('c.epx')} AS entry_px, {r4('c.raw_shares')} AS shares, c.zd AS last_d, {r4('c.zc')} AS last_px,
    CASE WHEN NOT held_back THEN {r2('mark')} END AS mtm, CASE WHEN NOT held_back THEN seen_pnl END AS pnl, CASE WHEN NOT held_back THEN seen_roi END AS roi,
    CASE WHEN ev_n IS NULL THEN {r4('c.epx / s.insider_px - 1')} END AS gap, hold, s.fd - s.td AS delay_td_fd, c.ed - s.fd AS delay_fd_entry,
    CAST(coalesce(ev_n, 0) > 0 AS INT) AS split_flag, roi_status, CASE WHEN roi_status = 'mixed_pre_post_split' THEN {r4('eff')} END AS shares_after_split,
    CASE WHEN roi_status = 'mixed_pre_post_split' THEN seen_roi END AS roi_corrected,
    CAST(coalesce(held_back, false) OR coalesce(roi_status = 'split_event_review', false) AS INT) AS roi_review,
    CASE WHEN held_back THEN seen_roi END AS roi_reported, CASE WHEN held_back THEN seen_pnl END AS pnl_reported,
    {', '.join(f'r{n}, r{n}_d, r{n}_px' for n in H)},
    CASE WHEN r252_px IS NOT NULL THEN r252_d END AS exit_d, r252_px AS exit_px, {r2('c.raw_shares * r252_px - 10000')} AS exit_pnl, r252 AS exit_roi,
    CASE WHEN r252_px IS NOT NULL THEN 'exited_252' ELSE 'open' END AS exit_status
  FROM opened s LEFT JOIN {name}_c c USING (id))"""


block(_book("book", True))
block(_book("raw_book", False))
block(f"""trip_a AS (SELECT *, zi - entry_i AS since, CASE WHEN c252 > 0 THEN 'exited_252'
    WHEN DATE '{fx.ASOF}' - ed >= 380 AND zi - entry_i < 252 AND zd < DATE '{fx.ASOF}' AND zi > entry_i THEN 'exit_last_observed' ELSE 'open' END AS xs FROM live),
trip_b AS (SELECT *, CASE xs WHEN 'exited_252' THEN c252 WHEN 'exit_last_observed' THEN zc END AS xpx, CASE xs WHEN 'exited_252' THEN d252 WHEN 'exit_last_observed' THEN zd END AS xd,
    {r4('raw_shares * zc / 10000 - 1')} AS roi_open FROM trip_a),
trip AS (SELECT s.id, s.acc, s.tk, s.fd, s.td, s.insider_sh, s.insider_val, s.insider_px, 10000.0::DOUBLE AS stake,
    CASE s.rule WHEN 'verified' THEN 'open' WHEN 'awaiting_entry' THEN 'awaiting_entry' ELSE 'no_price' END AS status, s.rule AS entry_rule_status,
    t.ed AS entry_d, {r4('t.epx')} AS entry_px, {r4('t.raw_shares')} AS shares, {r4('t.epx / s.insider_px - 1')} AS gap, t.zd AS last_d, {r4('t.zc')} AS last_px,
    roi_open, {r2('t.raw_shares * t.zc - 10000')} AS pnl_open, xs AS exit_status, xd AS exit_d, {r4('xpx')} AS exit_px, {r4('t.raw_shares * xpx / 10000 - 1')} AS exit_roi,
    {r2('t.raw_shares * xpx - 10000')} AS exit_pnl, CASE WHEN xs = 'exited_252' THEN 252 ELSE since END AS exit_sessions,
    CASE WHEN t.id IS NOT NULL THEN CAST(((roi_open > 2 OR roi_open < -0.8) AND since <= 90)
      OR coalesce(xs = 'exit_last_observed' AND ({r4('t.raw_shares * xpx / 10000 - 1')} > 3 OR {r4('t.raw_shares * xpx / 10000 - 1')} < -0.9), false) AS INT) END AS roi_review
  FROM opened s LEFT JOIN trip_b t USING (id))""")
block(f"""activity AS (SELECT pcik AS owner, icik AS issuer, min(insider) AS insider, min(co) AS co, max(tk) AS tk, min(icik) AS icik, min(rel) AS rel, min(title) AS title,
    count(*) AS n, count(*) FILTER (WHERE {BUY}) AS buy_n, count(*) FILTER (WHERE {SELL}) AS sell_n, count(*) FILTER (WHERE code NOT IN ('P', 'S')) AS other_n,
    {r4(total("CASE WHEN code = 'P' THEN sh END"))} AS buy_sh, {r4(total("CASE WHEN code = 'S' THEN sh END"))} AS sell_sh,
    {total(f"CASE WHEN code = 'P' THEN {V} END")} AS buy_v, {total(f"CASE WHEN code = 'S' THEN {V} END")} AS sell_v,
    {total(f"CASE WHEN code NOT IN ('P', 'S') THEN {V} END")} AS other_v,
    min(fd) AS first, max(fd) AS last, min(fd) FILTER (WHERE {BUY}) AS first_buy, max(fd) FILTER (WHERE {BUY}) AS last_buy,
    min(fd) FILTER (WHERE {SELL}) AS first_sell, max(fd) FILTER (WHERE {SELL}) AS last_sell FROM trades GROUP BY 1, 2),
holdings AS (SELECT pcik AS owner, icik AS issuer, lower(sec) AS hsec, di, lower(nature) AS nature, af AS shares, fd, td, acc
  FROM trades WHERE af >= 0 AND der = 0 AND {strict('sec')}
  QUALIFY row_number() OVER (PARTITION BY pcik, icik, lower(sec), di, lower(nature) ORDER BY fd DESC, td DESC, acc DESC, pos DESC) = 1),
held AS (SELECT owner, issuer, {r4(total('shares'))} AS reported_shares, count(*) AS holding_groups, max(fd) AS latest_holding_fd,
  arg_max(acc, ROW(fd, td, acc)) AS latest_holding_acc FROM holdings GROUP BY 1, 2),
priced AS (SELECT a.*, {r2('a.buy_v - a.sell_v')} AS net_v, a.buy_n > 0 AND a.sell_n > 0 AS overlap, reported_shares, coalesce(holding_groups, 0) AS holding_groups,
    latest_holding_fd, latest_holding_acc, mark_px, {r2('reported_shares * mark_px')} AS holding_value,
    CASE WHEN reported_shares IS NULL THEN 'no_reported_post_transaction_common_shares' WHEN mark_px IS NULL THEN 'shares_only_no_market_price' ELSE 'priced' END AS valuation_status
  FROM activity a LEFT JOIN held h USING (owner, issuer) LEFT JOIN marks m ON a.tk = m.tk),
portfolio AS (SELECT owner, min(insider) AS insider, min(rel) AS rel, min(title) AS title, count(reported_shares) AS issuer_n, {r4(total('reported_shares'))} AS reported_shares,
    {r2(total('holding_value'))} AS priced_value, count(holding_value) AS priced_issuer_n, count(reported_shares) - count(holding_value) AS unpriced_issuer_n,
    CAST(sum(buy_n) AS BIGINT) AS buy_n, CAST(sum(sell_n) AS BIGINT) AS sell_n, {r2(total('buy_v'))} AS buy_v, {r2(total('sell_v'))} AS sell_v,
    CAST(bool_or(overlap) AS INT) AS overlap, min(first) AS first, max(last) AS last, {r2(total('buy_v') + ' - ' + total('sell_v'))} AS net_v FROM priced GROUP BY owner)""")
_FLOWS = f"""count(*) AS n, count(*) FILTER (WHERE {BUY}) AS buy_n, count(*) FILTER (WHERE {SELL}) AS sell_n,
  {r2(total(f"CASE WHEN {BUY} THEN {V} END"))} AS buy_v, {r2(total(f"CASE WHEN {SELL} THEN {V} END"))} AS sell_v,
  {r2(total(f"CASE WHEN {BUY} THEN {V} END") + ' - ' + total(f"CASE WHEN {SELL} THEN {V} END"))} AS net_v, {r2(total(V))} AS val"""
block(f"""companies AS (SELECT icik AS issuer, min(co) AS co, max(tk) AS tk, {_FLOWS}, count(DISTINCT insider) AS insiders, count(DISTINCT acc) AS filings, min(fd) AS first, max(fd) AS last FROM trades GROUP BY icik),
insiders AS (SELECT pcik AS owner, min(insider) AS insider, min(rel) AS rel, min(title) AS title, {_FLOWS}, count(DISTINCT CASE WHEN tk <> '' THEN tk ELSE co END) AS companies,
  min(fd) AS first, max(fd) AS last FROM trades GROUP BY pcik)""")
block(f"""issues AS (
  SELECT acc, pos, fd, td, 'TRANSACTION_AFTER_FILING' AS issue, 'high' AS severity, icik FROM trades WHERE td > fd
  UNION ALL SELECT acc, pos, fd, td, 'MISSING_TICKER', 'medium', icik FROM trades WHERE tk = ''
  UNION ALL SELECT acc, pos, fd, td, 'VALUE_MISMATCH', 'high', icik FROM trades WHERE abs({r2('sh * px')} - val) > 0.05
  UNION ALL SELECT acc, pos, fd, td, 'POSSIBLE_LATE_FORM4', 'medium', icik FROM trades WHERE form = '4' AND fd > td
    AND (SELECT count(*) FROM range(1, (fd - td) + 1) x(k) WHERE isodow(td + CAST(k AS INT)) < 6) > 2)""")
block("""raw_lines AS (SELECT printf('%010d-%02d-%06d', l_orderkey, 99, l_orderkey % 1000000) AS acc, l_orderkey, o_orderstatus, o_custkey, c_mktsegment, o_orderpriority, CAST(o_orderdate AS DATE) AS od,
    CAST(l_shipdate AS DATE) AS td, l_returnflag || l_linestatus AS kind, l_quantity AS sh, l_extendedprice AS ext, l_discount, p_type,
    CAST(l_linenumber AS BIGINT) * 1000000000000 + l_partkey * 100 + CAST(l_quantity AS BIGINT) AS pos,
    CASE l_returnflag || l_linestatus WHEN 'AF' THEN 'S' WHEN 'AO' THEN 'P' WHEN 'RF' THEN 'P' WHEN 'NF' THEN 'A' WHEN 'NO' THEN 'M' ELSE 'G' END AS code
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey JOIN customer ON o_custkey = c_custkey),
raw_owners AS (SELECT printf('%010d-%02d-%06d', o_orderkey, 99, o_orderkey % 1000000) AS acc, 'Owner ' || o_custkey || CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN ' (+1 joint)' ELSE '' END AS insider,
    CAST(o_custkey + 1 AS VARCHAR) AS pcik, CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN 2 ELSE 1 END AS own_n,
    CASE c_mktsegment WHEN 'BUILDING' THEN 'Director' WHEN 'MACHINERY' THEN 'Officer' WHEN 'FURNITURE' THEN 'Director/Officer' WHEN 'HOUSEHOLD' THEN 'Director/10% Owner' ELSE 'Unknown' END AS rel,
    CASE c_mktsegment WHEN 'MACHINERY' THEN 'CFO' WHEN 'HOUSEHOLD' THEN 'Trustee' ELSE '' END AS title FROM orders JOIN customer ON o_custkey = c_custkey)""")
block("""listed AS (SELECT *, CAST(o_orderdate AS DATE) AS fd, substr(o_orderpriority, 1, 1)::INT AS k,
    printf('%010d-%02d-%06d', o_custkey, CAST(year(o_orderdate) % 100 AS INT), o_orderkey % 1000000) AS acc FROM orders WHERE substr(o_orderpriority, 1, 1) <> '5')""")
block("""sourced AS (SELECT 'S' || l_suppkey AS tk, CAST(l_shipdate AS DATE) AS d, CASE WHEN l_returnflag = 'A' AND s_nationkey < 10 THEN 'yahoo' WHEN l_returnflag = 'N' AND s_nationkey < 18 THEN 'stooq'
    ELSE 'nasdaq' END AS src, max(l_extendedprice) AS c FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY 1, 2, 3),
best_source AS (SELECT *, min(CASE src WHEN 'yahoo' THEN 1 WHEN 'stooq' THEN 2 ELSE 3 END) OVER (PARTITION BY tk) = CASE src WHEN 'yahoo' THEN 1 WHEN 'stooq' THEN 2 ELSE 3 END AS wins FROM sourced)""")
block(f"""cl_days AS (SELECT icik AS issuer, td AS day, sum(CAST({V} AS DECIMAL(28,4))) AS v FROM trades WHERE code = 'P' AND der = 0 GROUP BY 1, 2),
cl_windows AS (SELECT a.issuer, a.day, sum(b.v) AS wv, (SELECT count(DISTINCT t.pcik) FROM trades t WHERE t.code = 'P' AND t.der = 0 AND t.icik = a.issuer AND t.td BETWEEN a.day AND a.day + 7) AS owners
  FROM cl_days a JOIN cl_days b ON a.issuer = b.issuer AND b.day BETWEEN a.day AND a.day + 7 GROUP BY 1, 2),
clusters AS (SELECT issuer, day AS start_d, day + 7 AS end_d, wv FROM cl_windows WHERE owners >= 2 AND wv >= {fx.CLUSTER}
  QUALIFY row_number() OVER (PARTITION BY issuer ORDER BY wv DESC, day) = 1)""")


def add(name, body):
    used, todo = [], body
    names = {n: text for ns, text in BLOCKS for n in ns}
    found = {n for n in names if re.search(rf"\b{n}\b", body)}
    while True:
        texts = [t for ns, t in BLOCKS if found & set(ns)]
        more = {n for n in names if any(re.search(rf"\b{n}\b", t) for t in texts)} | found
        if more == found:
            break
        found = more
    parts = [t for ns, t in BLOCKS if found & set(ns)]
    SQL[name] = ("WITH " + ",\n".join(parts) + "\n" if parts else "") + body


def iso(*names):
    return ", ".join(f"CAST({n} AS VARCHAR) AS {n}" for n in names)


# ------------------------------------------------------------------ 2.1
_TEXT = {c: t for c, _, t in fv.TRANSACTION_CODES if t}
_TEXT_CASE = "CASE code " + " ".join(f"WHEN '{c}' THEN '{t}'" for c, t in _TEXT.items()) + " END"
_SIDE_CASE = "CASE code WHEN 'P' THEN 'buy' WHEN 'S' THEN 'sell' WHEN 'A' THEN 'grant' WHEN 'M' THEN 'exercise' ELSE 'gift' END"
add("assemble_trades", f"""SELECT l.acc, {iso('od')[:-5]} AS fd, CAST(td AS VARCHAR) AS td, CAST(od AS VARCHAR) AS period, '4' AS form, CASE WHEN o_orderpriority = '5-LOW' THEN 1 ELSE 0 END AS amend,
  CAST(o_custkey + 7 AS VARCHAR) AS icik, 'Issuer ' || o_custkey AS co, 'I' || o_custkey AS tk, insider, pcik, own_n, rel, title, code, {_TEXT_CASE} AS ct, {_SIDE_CASE} AS side,
  p_type || ' Stock' AS sec, sh, px, CASE WHEN px IS NOT NULL THEN {r2('sh * px')} WHEN kind = 'NO' THEN ext END AS val, 'A' AS ad, ext AS af, 'D' AS di, CASE WHEN kind = 'NO' THEN 1 ELSE 0 END AS der,
  CASE WHEN kind = 'NO' THEN 'Common Stock' ELSE '' END AS under, CASE WHEN kind = 'NO' THEN sh END AS under_sh, CASE WHEN kind = 'NO' THEN 95.0::DOUBLE END AS xp,
  CASE WHEN kind = 'NO' THEN '2029-12-31' END AS exp, 'L' AS timely, pos
  FROM (SELECT *, CASE WHEN kind NOT IN ('NF', 'RO', 'NO') THEN {r2('l_discount + 3')} END AS px FROM raw_lines) l JOIN raw_owners o ON l.acc = o.acc WHERE o_orderstatus <> 'F'""")
add("read_bulk_tables", "SELECT acc, der, fd, td, form, amend, icik, co, tk, insider, own_n, rel, code, side, sec, sh, px, val, af FROM (" + SQL["assemble_trades"] + ")")
SQL["read_bulk_archives"] = SQL["read_bulk_tables"]         # the same rows by another way
add("orphan_transactions", f"SELECT acc, pos, {iso('td')}, code FROM raw_lines WHERE o_orderstatus = 'F'")
add("rollup_owners", "SELECT * FROM raw_owners")
add("union_sources", f"SELECT CASE WHEN kind = 'NO' THEN 1 ELSE 0 END AS der, code, count(*) AS n, {total('sh')} AS shares FROM raw_lines GROUP BY 1, 2")
add("read_ownership_xml", f"""SELECT l_orderkey || '-' || l_linenumber || '-' || l_partkey AS acc, CAST(d AS VARCHAR) AS fd, CAST(d AS VARCHAR) AS td, CAST(d AS VARCHAR) AS period,
  CASE WHEN l_suppkey = 0 THEN '0' ELSE CAST(l_suppkey AS VARCHAR) END AS icik, 'Issuer ' || l_suppkey AS co, 'S' || l_suppkey AS tk, 'Owner A (+1 joint)' AS insider, CAST(l_orderkey + 1 AS VARCHAR) AS pcik,
  2 AS own_n, 'Director/Officer/10% Owner' AS rel, 'CEO' AS title, 'P' AS code, 'Open market or private purchase of securities' AS ct, 'buy' AS side, 'Common Stock' AS sec,
  l_quantity AS sh, l_extendedprice AS px, {r2('l_quantity * l_extendedprice')} AS val, 'A' AS ad, l_extendedprice AS af, 'D' AS di, 0 AS der
  FROM (SELECT *, CAST(l_shipdate AS DATE) AS d FROM lineitem) WHERE l_returnflag <> 'N'""")
add("rejected_ownership_xml", "SELECT l_orderkey || '-' || l_linenumber || '-' || l_partkey AS acc, '4' AS form FROM lineitem WHERE l_returnflag = 'N'")
_FORM = "CASE WHEN k IN (1, 2) THEN '4' ELSE '5' END AS form, CASE WHEN k IN (2, 4) THEN 1 ELSE 0 END AS amend"
add("read_daily_index", f"SELECT acc, 'edgar/data/' || o_custkey || '/' || acc || '.txt' AS path, {_FORM}, {iso('fd')} FROM listed")
add("read_search_hits", f"SELECT acc, 'edgar/data/' || (o_custkey + 1) || '/' || replace(acc, '-', '') || '/' || acc || '.txt' AS path, {_FORM}, {iso('fd')} FROM listed")
add("dedupe_by_accession", f"SELECT acc, {iso('fd')}, form, pos FROM trades QUALIFY row_number() OVER (PARTITION BY acc ORDER BY pos DESC) = 1")
add("read_trade_shards", f"""SELECT acc, {iso('fd', 'td')}, tk, CASE WHEN source_rank = 1 THEN 'late ' ELSE '' END || co AS co, insider, code, sec, sh, px, val, af, der, amend, pos, source_rank
  FROM trades, (VALUES (0), (1)) x(source_rank)""")
add("write_trades_by_year", f"SELECT CAST(year(fd) AS INT) AS fy, count(*) AS n, count(DISTINCT acc) AS filings, {total('val')} AS value FROM trades WHERE year(fd) >= 1998 GROUP BY 1")
add("write_trades_by_month", f"SELECT strftime(fd, '%Y-%m') AS fm, count(*) AS n, {total('val')} AS value FROM trades GROUP BY 1")
_RECENT = "ORDER BY fd DESC, td DESC, acc DESC, pos DESC"
add("write_company_buckets", f"""SELECT CAST(CAST(issuer AS BIGINT) % 64 AS INT) AS bucket, count(*) AS n, count(DISTINCT issuer) AS issuers FROM
  (SELECT icik AS issuer FROM trades QUALIFY row_number() OVER (PARTITION BY icik {_RECENT}) <= 40) GROUP BY 1""")
add("write_positions", f"SELECT status, entry_rule_status, exit_status, count(*) AS n, {total('mtm')} AS mtm, {total('exit_pnl')} AS exit_pnl FROM book GROUP BY 1, 2, 3")
add("write_activity", "SELECT owner, issuer, n, net_v, valuation_status FROM priced")
add("write_portfolios", "SELECT owner, insider, issuer_n, priced_value, overlap = 1 AS overlap FROM portfolio")
add("export_view", "SELECT acc, pos, tk, insider, nature, sh FROM trades WHERE side = 'buy' AND contains(lower(tk || ' ' || co || ' ' || insider), 'owner 1')")
add("compact_row", """SELECT acc, pos, CAST(fd AS VARCHAR) AS fd, nullif(tk, '') AS tk, nullif(title, '') AS title, px, nullif(der, 0) AS der, nullif(amend, 0) AS amend,
  CAST(15 + (tk <> '')::INT + (title <> '')::INT + (px IS NOT NULL)::INT + (val IS NOT NULL)::INT + (af IS NOT NULL)::INT + (der <> 0)::INT + (amend <> 0)::INT
    + (sh <> 0)::INT AS INT) AS fields FROM trades""")
add("read_bars_yahoo_json", f"SELECT tk, {iso('d')}, {r4('CASE WHEN v <> 2 THEN o ELSE c END')} AS o, {r4('c')} AS c, v, 'yahoo' AS src FROM bars")
add("read_splits", f"SELECT tk, {iso('d')}, num, den, den / num AS ratio FROM splits")
add("read_bars_stooq_csv", f"""SELECT 'repair' AS policy, tk, {iso('d')}, {r4('CASE WHEN v = 2 THEN c ELSE o END')} AS o, {r4('c')} AS c, v FROM bars
  UNION ALL SELECT 'drop', tk, CAST(d AS VARCHAR), {r4('o')}, {r4('c')}, v FROM bars WHERE v <> 2""")
add("read_bars_nasdaq_json", f"SELECT tk, {iso('d')}, {r2('CASE WHEN v = 2 THEN c ELSE o END')} AS o, {r2('c')} AS c, 'nasdaq' AS src FROM bars")

# ------------------------------------------------------------------ 2.2
add("parse_sec_date", "SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN CAST(CAST(o_orderdate AS DATE) AS VARCHAR) END AS parsed FROM orders")
add("parse_number", "SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN l_returnflag || l_linestatus IN ('RF', 'NO') THEN l_extendedprice END AS number FROM lineitem")
add("form_root_and_amend", "SELECT form AS root, amend AS amended, count(*) AS n FROM trades GROUP BY 1, 2")
add("strip_cik", "SELECT c_custkey, CASE WHEN c_custkey = 0 THEN '0000000000' ELSE CAST(c_custkey AS VARCHAR) END AS cik FROM customer")
add("code_text_and_side", f"""SELECT CASE WHEN form = '5' THEN 'Y' || code ELSE code END AS code, count(*) AS n,
  CASE WHEN form = '5' THEN 'Unknown code (Y' || code || ')' ELSE {_TEXT_CASE} END AS text, CASE WHEN form = '5' THEN 'other' ELSE {_SIDE_CASE} END AS side
  FROM (SELECT form, code FROM trades) GROUP BY ALL""")
add("trade_value", f"SELECT acc, pos, CASE WHEN sh IS NOT NULL AND px IS NOT NULL THEN {r2('sh * px')} ELSE af END AS value FROM trades")
add("relationship_label", """SELECT CASE WHEN rel <> 'Unknown' THEN rel WHEN title <> '' THEN 'Other' ELSE 'Unknown' END AS label, CASE WHEN rel = 'Unknown' THEN 'Other' ELSE rel END AS noted, count(*) AS n
  FROM trades GROUP BY 1, 2""")
add("split_relationships", "SELECT acc, pos, unnest(string_split(rel, '/')) AS relationship FROM trades")
add("normalize_ticker", "SELECT acc, pos, tk || '-B' AS normal, tk || '-B' AS symbol, tk || '-B' AS engine_symbol FROM trades")
add("valid_ticker", f"""SELECT acc, pos,
  CAST(regexp_matches(e, '{fv.ENGINE_TICKER_PATTERN}') AND e NOT IN ({quoted(fv.ENGINE_TICKER_JUNK)}) AS INT) AS engine,
  CAST(regexp_matches(q, '^[A-Z][A-Z0-9-]*$') AND length(q) <= 8 AND q NOT IN ({quoted(fv.SITE_TICKER_JUNK)}) AS INT) AS site,
  CAST(regexp_matches(a, '{fv.AUDIT_TICKER_PATTERN}') AS INT) AS audit
  FROM (SELECT acc, pos, upper(replace(x, ' ', '')) AS e, upper(trim(x)) AS a, replace(upper(trim(x)), '/', '-') AS q
    FROM (SELECT acc, pos, CASE WHEN amend = 1 THEN tk || '/B' WHEN form = '5' THEN ' none' WHEN di = 'I' THEN tk || tk || 'LONGER' ELSE tk END AS x FROM trades))""")
add("is_common_equity", f"""SELECT title, der, count(*) AS n, CAST({lenient('title')} AND der <> 1 AS INT) AS lenient, CAST({strict('title')} AS INT) AS strict
  FROM (SELECT der, CASE WHEN form = '5' THEN sec || ' (option)' WHEN di = 'I' THEN '' ELSE sec END AS title FROM trades) GROUP BY title, der""")
add("size_bucket", f"SELECT {size('v')} AS site, {size('v', fv.ENGINE_SIZE_BUCKETS)} AS engine, count(*) AS n FROM (SELECT coalesce(val, 0) * 10 AS v FROM trades) GROUP BY 1, 2")
add("role_bucket", f"""SELECT rel, title, count(*) AS n, {role('rel', 'title')} AS site, CASE WHEN contains(lower(title), 'chief executive') THEN 'CEO' WHEN lower(title) = 'cfo' THEN 'CFO'
  WHEN contains(rel, 'Officer') THEN 'Officer' WHEN rel = '10% Owner' THEN '10% Owner' WHEN rel = 'Director' THEN 'Director' ELSE 'Other' END AS engine FROM trades GROUP BY rel, title""")
add("company_bucket", "SELECT icik, count(*) AS n, CAST(CAST(icik AS BIGINT) % 64 AS INT) AS bucket FROM trades GROUP BY icik")
_OWN = "CASE WHEN form = '5' THEN ltrim(substr(replace(acc, '-', ''), 1, 10), '0') ELSE CASE WHEN icik = '0' THEN ltrim(substr(replace(acc, '-', ''), 1, 10), '0') ELSE icik END END"
_ISSUER = "CASE WHEN icik = '0' THEN ltrim(substr(replace(acc, '-', ''), 1, 10), '0') ELSE icik END"
add("review_links", f"""SELECT acc, pos, {URL.format(cik='(' + _OWN + ')', acc='acc')} AS filing, 'https://www.sec.gov/Archives/edgar/data/' || ({_OWN}) || '/' || replace(acc, '-', '') || '/' || acc || '.txt' AS text,
  CASE WHEN tk = '' THEN '' ELSE 'https://finance.yahoo.com/quote/' || tk || '/history' END AS history, CASE WHEN tk = '' THEN '' ELSE 'https://stooq.com/q/d/?s=' || lower(tk) || '.us' END AS second_history,
  'https://www.sec.gov/cgi-bin/browse-edgar?action=getcompany&CIK=' || icik || '&type=8-K&dateb=&owner=include&count=40' AS actions, CAST(({_OWN}) = ({_ISSUER}) AS INT) AS url_ok FROM trades""")
_BDAYS = "CASE WHEN {b} <= {a} THEN 0 ELSE (SELECT count(*) FROM range(1, ({b} - {a}) + 1) x(k) WHERE isodow({a} + CAST(k AS INT)) < 6) END"
add("business_days_between", f"SELECT acc, pos, CAST({_BDAYS.format(a='td', b='fd')} AS INT) AS days, CAST({_BDAYS.format(a='fd', b='period')} AS INT) AS to_period_end FROM trades")
add("calendar_delays", "SELECT id, CAST(fd - td AS INT) AS delay_td_fd, CAST(entry_d - fd AS INT) AS delay_fd_entry FROM trip")
add("month_and_year_keys", "SELECT strftime(fd, '%Y-%m') AS m, strftime(fd, '%Y') AS y, count(*) AS n FROM trades GROUP BY 1, 2")
_MONEY = "'$' || format('{{:,.2f}}', {x})"
add("evidence_text", f"""SELECT acc, pos, acc || ': ' || fd || ' filing; ' || td || ' transaction; ' || CASE WHEN tk = '' THEN 'no ticker' ELSE tk END || ' ' || co || '; ' || insider || '; ' ||
  CASE WHEN der = 1 THEN 'Table II derivative' ELSE 'Table I non-derivative' END || '; code ' || code || '; ' || format('{{:,}}', CAST(sh AS BIGINT)) || ' shares @ ' ||
  CASE WHEN px IS NULL THEN 'no reported price' ELSE {_MONEY.format(x='px')} END || '; value ' || CASE WHEN val IS NULL THEN 'no reported value' ELSE {_MONEY.format(x='val')} END || '.' AS evidence,
  CASE WHEN sh % 8 = 0 THEN format('{{:,}}', CAST(sh / 8 AS BIGINT)) ELSE rtrim(format('{{:,.4f}}', sh / 8), '0') END AS eighth,
  CASE WHEN val IS NULL THEN 'not reported' ELSE '$-' || format('{{:,.2f}}', val) END AS outflow FROM trades""")
add("abs_value", f"SELECT acc, pos, {V} AS v FROM trades")

# ------------------------------------------------------------------ 2.3
add("filing_window", """SELECT code, count(*) AS n, '1999' AS window FROM trades WHERE year(fd) = 1999 GROUP BY code
  UNION ALL SELECT code, count(*), '1999 on' FROM trades WHERE year(fd) >= 1999 GROUP BY code""")
add("paper_window", f"SELECT tk, count(*) AS n, {total('insider_val')} AS value FROM signals WHERE year(fd) >= 1999 GROUP BY tk")
add("qualifying_purchase", f"""SELECT code, sec, CAST(code = 'P' AND der = 0 AND tk <> '' AND coalesce(sh > 0 AND px > 0, false) AND {strict('sec')} AS INT) AS site,
  CAST(code = 'P' AND der = 0 AND tk <> '' AND coalesce(sh > 0 AND px > 0, false) AND {lenient('sec')} AS INT) AS engine, count(*) AS n FROM trades GROUP BY ALL""")
add("asof_clip", "SELECT tk, count(*) AS n, CAST(max(d) AS VARCHAR) AS last FROM clipped GROUP BY tk")
add("price_window_trim", """SELECT tk, count(*) AS n, CAST(min(d) AS VARCHAR) AS first FROM bars b WHERE d >= DATE '2000-01-01'
  OR NOT EXISTS (SELECT 1 FROM bars x WHERE x.tk = b.tk AND x.d >= DATE '2000-01-01') GROUP BY tk""")
add("min_value_filter", "SELECT id, insider_val, lots FROM candidates WHERE insider_val >= 20000")
add("view_filter", """SELECT 'trades' AS view, acc || ':' || pos AS key FROM trades WHERE code = 'S' AND contains(rel, 'Officer') AND contains(lower(tk || ' ' || co || ' ' || insider), 'owner 12')
  UNION ALL SELECT 'losers', id FROM book WHERE status = 'open' AND roi < 0 AND contains(lower(tk || ' Issuer ' || icik || ' ' || insider), 's1')
  UNION ALL SELECT 'pairs', owner || ':' || issuer FROM priced WHERE overlap AND holding_value IS NOT NULL""")

# ------------------------------------------------------------------ 2.4
add("next_session_entry", """SELECT t.acc, t.pos, CAST(b.d AS VARCHAR) AS entry_d, b.o AS entry_px, b.i AS entry_i
  FROM trades t ASOF LEFT JOIN (SELECT *, CAST(row_number() OVER (PARTITION BY tk ORDER BY d) - 1 AS INT) AS i FROM bars) b ON t.tk = b.tk AND t.fd < b.d""")
add("entries_per_issuer", """SELECT t.acc, t.pos, t.tk, t.issuer AS icik, CAST(b.d AS VARCHAR) AS entry_d, b.o AS entry_px, b.i AS entry_i
  FROM (SELECT *, CASE WHEN tk = '' OR CAST(icik AS INT) % 3 = 0 THEN icik WHEN fd <= DATE '1994-01-01' + (CAST(icik AS INT) * 37) % 1500 OR pos % 7 = 0 THEN 'A' || icik ELSE 'B' || icik END AS issuer,
      CASE WHEN tk = '' OR CAST(icik AS INT) % 3 = 0 THEN '' ELSE issuer END AS series FROM trades) t
  ASOF LEFT JOIN (SELECT *, CAST(row_number() OVER (PARTITION BY tk, series ORDER BY d) - 1 AS INT) AS i FROM (
      SELECT b.*, CASE WHEN v.icik IS NULL THEN '' WHEN d <= v.cut THEN 'A' || v.icik WHEN d >= v.cut + 10 THEN 'B' || v.icik END AS series
      FROM bars b LEFT JOIN (SELECT DISTINCT tk, icik, DATE '1994-01-01' + (CAST(icik AS INT) * 37) % 1500 AS cut FROM trades WHERE tk <> '' AND CAST(icik AS INT) % 3 <> 0) v ON b.tk = v.tk)
      WHERE series IS NOT NULL) b ON t.tk = b.tk AND t.series = b.series AND t.fd < b.d""")
add("close_on_or_before", "SELECT t.acc, t.pos, CAST(b.d AS VARCHAR) AS close_d, b.c AS close_px FROM trades t ASOF LEFT JOIN bars b ON t.tk = b.tk AND t.td >= b.d")
add("latest_mark", f"SELECT tk, {iso('mark_d')}, mark_px FROM marks")
add("horizon_close", """SELECT t.id, n, CAST(h.d AS VARCHAR) AS horizon_d, h.c AS horizon_px FROM (SELECT l.*, x.n FROM live l, (VALUES (0), (21)) x(n)) t
  LEFT JOIN sessions h ON t.tk = h.tk AND h.i = t.entry_i + n""")
add("price_holdings", f"SELECT owner, issuer, reported_shares, holding_groups, mark_px, holding_value, valuation_status, {iso('latest_holding_fd')} FROM priced")
add("split_events_in_hold", "SELECT l.id, CAST(e.d AS VARCHAR) AS event_d, e.ratio, e.jump, e.kind FROM live l JOIN split_events e ON l.tk = e.tk AND e.d > l.ed AND e.d <= l.zd")
add("missing_business_days", """SELECT CAST(x.d AS VARCHAR) AS d FROM (SELECT CAST(unnest(generate_series(DATE '2001-01-01', DATE '2001-12-31', INTERVAL 1 DAY)) AS DATE) AS d) x
  WHERE isodow(x.d) < 6 AND x.d NOT IN (SELECT fd FROM trades)""")
add("missing_months", """SELECT m FROM (SELECT DISTINCT strftime(unnest(generate_series(DATE '2001-01-01', DATE '2001-12-31', INTERVAL 1 DAY)), '%Y-%m') AS m)
  WHERE m NOT IN (SELECT strftime(fd, '%Y-%m') FROM trades)""")
add("source_fallback", f"SELECT tk, {iso('d')}, src, c FROM best_source WHERE wins")
add("price_source_counts", "SELECT coalesce(src, 'none') AS source, count(*) AS n FROM trip LEFT JOIN (SELECT DISTINCT tk, src FROM best_source WHERE wins) USING (tk) GROUP BY 1")

# ------------------------------------------------------------------ 2.5
_KEY = "acc, der, td, code, sec, sh, px, ad, pcik"
add("dedupe_trades", f"SELECT acc, pos, co, sh, px, 0 AS source_rank FROM trades QUALIFY row_number() OVER (PARTITION BY {_KEY} ORDER BY fd, pos, insider, icik) = 1")
add("row_key", f"""SELECT n, count(*) AS identities, 'reference' AS identity FROM (SELECT count(*) AS n FROM trades GROUP BY {_KEY}) GROUP BY n
  UNION ALL SELECT n, count(*), 'full' FROM (SELECT count(*) AS n FROM trades GROUP BY {_KEY}, di, nature, af) GROUP BY n""")
add("upsert_shard", f"""SELECT acc, pos, co, code FROM (SELECT *, 0 AS b FROM trades UNION ALL SELECT * REPLACE ('late ' || co AS co), 1 FROM trades WHERE code = 'P')
  QUALIFY row_number() OVER (PARTITION BY {_KEY} ORDER BY b DESC, pos DESC, icik DESC) = 1""")
add("upsert_counts", f"""SELECT (SELECT count(*) FROM (SELECT DISTINCT {_KEY} FROM trades WHERE code = 'P' AND form = '4')) AS added, count(*) AS undated FROM trades WHERE form <> '4'""")
add("supersede_amendments", """SELECT acc, pos, icik, co FROM (
    SELECT acc, pos, icik, pcik, period, fd, amend, co FROM trades WHERE acc NOT IN (SELECT acc FROM trades WHERE code = 'P')
    UNION ALL SELECT acc, pos, icik, pcik, period, fd, amend, 'again ' || co FROM trades WHERE code = 'P')
  QUALIFY acc = first_value(acc) OVER (PARTITION BY icik, pcik, period ORDER BY fd DESC, amend DESC, acc DESC)""")
add("supersede_only_amendments", """SELECT acc, pos, icik FROM trades t WHERE NOT EXISTS (SELECT 1 FROM trades a WHERE a.amend = 1 AND a.icik = t.icik AND a.pcik = t.pcik AND a.period = t.period
  AND (a.fd > t.fd OR (a.fd = t.fd AND (a.amend > t.amend OR (a.amend = t.amend AND a.acc > t.acc)))))""")
add("merge_price_tail", f"""SELECT coalesce(a.tk, b.tk) AS tk, CAST(coalesce(a.d, b.d) AS VARCHAR) AS d,
    CASE WHEN l.last IS NULL OR coalesce(a.d, b.d) > l.last THEN b.o WHEN a.d = l.last AND b.d IS NOT NULL THEN coalesce(nullif(b.o, 0), a.o) ELSE a.o END AS o,
    CASE WHEN l.last IS NULL OR coalesce(a.d, b.d) > l.last THEN b.c WHEN a.d = l.last AND b.d IS NOT NULL THEN coalesce(nullif(b.c, 0), a.c) ELSE a.c END AS c
  FROM (SELECT tk, d, o, c FROM bars WHERE d <= DATE '1999-06-30') a
  FULL JOIN (SELECT tk, d, CASE WHEN v <> 2 THEN o + 1 ELSE 0 END AS o, c + 1 AS c FROM bars WHERE d >= DATE '1999-03-01') b ON a.tk = b.tk AND a.d = b.d
  LEFT JOIN (SELECT tk, max(d) AS last FROM bars WHERE d <= DATE '1999-06-30' GROUP BY tk) l ON l.tk = coalesce(a.tk, b.tk)
  WHERE a.d IS NOT NULL OR l.last IS NULL OR b.d > l.last""")
add("merge_splits", f"SELECT tk, {iso('d')}, num, CASE WHEN d >= DATE '1998-01-01' THEN 20.0::DOUBLE ELSE den END AS den FROM splits")
add("last_update_wins", "SELECT icik, acc, pos, sh, code FROM trades QUALIFY row_number() OVER (PARTITION BY icik ORDER BY acc DESC, pos DESC) = 1")

# ------------------------------------------------------------------ 2.6
add("global_totals", f"""SELECT count(*) AS trades, count(DISTINCT acc) AS filings, {total(V)} AS total, {total(f"CASE WHEN {BUY} THEN {V} END")} AS buy, {total(f"CASE WHEN {SELL} THEN {V} END")} AS sell,
  count(*) FILTER (WHERE {BUY}) AS buys, count(*) FILTER (WHERE {SELL}) AS sells, count(*) FILTER (WHERE tk <> '') AS with_ticker, count(*) FILTER (WHERE px <> 0) AS with_price,
  count(px) AS with_reported_price, count(*) FILTER (WHERE der <> 0) AS derivative, CAST(min(fd) AS VARCHAR) AS first_fd, CAST(max(fd) AS VARCHAR) AS last_fd FROM trades""")
for _name, _col in (("by_code", "code"), ("by_side", "side"), ("by_form", "form"), ("by_security", "sec")):
    add(_name, f"SELECT {_col}, count(*) AS n, {total(V)} AS v FROM trades GROUP BY 1")
add("trade_cuts", " UNION ALL ".join(f"SELECT '{cut}' AS cut, {col} AS bucket, count(*) AS n, {total(V)} AS v FROM trades GROUP BY 2" for cut, col in (
    ("code", "code"), ("side", "side"), ("form", "form"), ("sec", "sec"), ("month", "strftime(fd, '%Y-%m')"))))
add("approx_totals", " UNION ALL ".join(f"""SELECT {y} AS y, count(*) AS n, {total(V)} AS v, count(DISTINCT acc) AS filings, count(DISTINCT pcik) AS insiders, count(DISTINCT icik) AS issuers,
  1 AS filings_within, 1 AS insiders_within, 1 AS issuers_within FROM trades GROUP BY 1""" for y in ("strftime(fd, '%Y')", "'all'")))
add("by_relationship", "SELECT relationship, count(*) AS n FROM (SELECT unnest(string_split(rel, '/')) AS relationship FROM trades) GROUP BY 1")
add("code_share", f"SELECT code, count(*) AS n, {r4('count(*) / CAST((SELECT count(*) FROM trades) AS DOUBLE) * 100')} AS pct FROM trades GROUP BY code")
_FLOW = f"""count(*) AS n, count(*) FILTER (WHERE {BUY}) AS buy_n, count(*) FILTER (WHERE {SELL}) AS sell_n, {total(f"CASE WHEN {BUY} THEN {V} END")} AS buy, {total(f"CASE WHEN {SELL} THEN {V} END")} AS sell"""
_NET = r2(total(f"CASE WHEN {BUY} THEN {V} END") + " - " + total(f"CASE WHEN {SELL} THEN {V} END"))
add("monthly_flow", f"SELECT strftime(fd, '%Y-%m') AS m, {_FLOW} FROM trades GROUP BY 1")
add("yearly_flow", f"SELECT strftime(fd, '%Y') AS y, {_FLOW} FROM trades GROUP BY 1")
add("daily_flow", f"SELECT CAST(fd AS VARCHAR) AS d, {_FLOW}, {_NET} AS net FROM trades GROUP BY fd")
add("daily_flow_recent", f"SELECT CAST(fd AS VARCHAR) AS d, {_FLOW}, {_NET} AS net FROM trades WHERE fd >= DATE '2001-08-01' - 90 GROUP BY fd")
add("company_summary", f"SELECT * EXCLUDE (first, last), {iso('first', 'last')} FROM companies")
add("insider_summary", f"SELECT * EXCLUDE (first, last), {iso('first', 'last')} FROM insiders")
add("net_buyers", "SELECT issuer, net_v FROM companies WHERE net_v > 0 ORDER BY net_v DESC, issuer LIMIT 60")
add("net_sellers", "SELECT issuer, net_v FROM companies WHERE net_v < 0 ORDER BY net_v, issuer LIMIT 60")
add("top_purchasers", "SELECT owner, buy_v FROM insiders WHERE buy_v > 0 ORDER BY buy_v DESC, owner LIMIT 60")
add("insider_issuer_activity", f"""SELECT owner, issuer, insider, co, tk, icik, rel, title, n, buy_n, sell_n, other_n, buy_sh, sell_sh, buy_v, sell_v, other_v, {iso('first', 'last', 'first_buy', 'last_buy', 'first_sell', 'last_sell')},
  net_v, CAST(overlap AS INT) AS overlap FROM priced""")
_PAIR_FILINGS = "(SELECT DISTINCT pcik AS owner, icik AS issuer, icik, acc, fd, form, amend FROM trades)"
add("review_filings", f"""SELECT owner, issuer, CAST(rank AS INT) AS rank, acc, {iso('fd')}, form, amend, {URL.format(cik='(' + _ISSUER + ')', acc='acc')} AS url FROM
  (SELECT *, row_number() OVER (PARTITION BY owner, issuer ORDER BY fd DESC, acc DESC) AS rank FROM {_PAIR_FILINGS})""")
add("activity_summary", f"""SELECT count(*) AS pairs, count(*) FILTER (WHERE overlap) AS buy_sell_pairs, count(reported_shares) AS with_reported_shares, count(holding_value) AS with_priced_holdings,
  {r2(total('holding_value'))} AS priced_value FROM priced""")
add("ranked_activity", "SELECT owner, issuer, net_v FROM priced ORDER BY overlap DESC, abs(net_v) DESC, n DESC, insider, owner, issuer")
add("reported_holdings", f"SELECT owner, issuer, hsec, di, nature, shares, {iso('fd', 'td')}, acc FROM holdings")
add("insider_portfolio", f"SELECT * EXCLUDE (first, last), {iso('first', 'last')} FROM portfolio")
add("portfolio_issuers", f"""SELECT owner, CAST(rank AS INT) AS rank, issuer, holding_value,
  CASE WHEN latest_holding_acc IS NULL THEN '' ELSE {URL.format(cik="(CASE WHEN icik = '0' THEN ltrim(substr(replace(latest_holding_acc, '-', ''), 1, 10), '0') ELSE icik END)", acc='latest_holding_acc')} END AS url FROM
  (SELECT *, row_number() OVER (PARTITION BY owner ORDER BY coalesce(holding_value, -1) DESC, coalesce(reported_shares, 0) DESC, issuer) AS rank FROM priced)""")
add("portfolio_summary", f"""SELECT count(*) AS insiders, count(*) FILTER (WHERE issuer_n > 1) AS with_multiple_issuers, count(*) FILTER (WHERE priced_value > 0) AS with_priced_value,
  {r2(total('priced_value'))} AS reported_value_priced FROM portfolio""")
add("publish_activity", f"SELECT owner, issuer, CAST(least(count(*), 10) AS INT) AS links, arg_max(acc, ROW(fd, acc)) AS newest FROM {_PAIR_FILINGS} GROUP BY 1, 2")
add("extract_signals", f"SELECT * EXCLUDE (fd, td), {iso('fd', 'td')} FROM signals")
add("extract_signals_engine", f"""SELECT acc || ':' || tk AS id, CAST(min(td) AS VARCHAR) AS td, {r4(total('sh'))} AS insider_sh, {r2(total('val'))} AS insider_val,
  {r4(total('val') + ' / ' + total('sh'))} AS insider_px, count(*) AS lots, arg_min(sec, pos) AS sec
  FROM trades WHERE code = 'P' AND der = 0 AND tk <> '' AND sh > 0 AND px > 0 AND {lenient('sec')} GROUP BY acc, tk HAVING {total('val')} >= 1""")
_REASON = ("CASE WHEN der <> 0 THEN 'derivative' WHEN tk = '' THEN 'no_ticker' WHEN NOT coalesce(sh > 0, false) THEN 'no_share_count' "
           "WHEN NOT coalesce(px > 0, false) THEN 'no_price_reported' WHEN NOT {eq} THEN 'not_common_equity' ELSE 'qualifying' END")
add("signal_coverage", f"""SELECT 'row' AS level, {_REASON.format(eq=strict('sec'))} AS reason, count(*) AS n FROM trades WHERE code = 'P' GROUP BY 2
  UNION ALL SELECT 'signal', CASE WHEN insider_val < 20000 THEN 'below_minimum_value' ELSE 'signal' END, count(*) FROM candidates GROUP BY 2""")
add("signal_coverage_engine", f"""SELECT 'row' AS level, {_REASON.format(eq=lenient('sec'))} AS reason, count(*) AS n FROM trades WHERE code = 'P' GROUP BY 2
  UNION ALL SELECT 'signal', 'signal', count(*) FROM (SELECT DISTINCT acc, tk FROM trades WHERE code = 'P' AND der = 0 AND tk <> '' AND sh > 0 AND px > 0 AND {lenient('sec')})""")


def stats(source, keys, value, method="linear", where="true"):
    """Statistics by sorting whole groups: the plain definition."""
    k = (", ".join(keys) + ",") if keys else ""
    if method == "linear":
        q = {p: f"list_extract(s, CAST(floor((n - 1) * {p}) AS INT) + 1) + (list_extract(s, CAST(least(floor((n - 1) * {p}) + 1, n - 1) AS INT) + 1) - "
                f"list_extract(s, CAST(floor((n - 1) * {p}) AS INT) + 1)) * ((n - 1) * {p}::DOUBLE - floor((n - 1) * {p}))" for p in (0.25, 0.5, 0.75)}
    elif method == "floor":
        q = {0.25: "list_extract(s, CAST(floor(n * 25 / 100) AS INT) + 1)", 0.75: "list_extract(s, CAST(least(n - 1, floor(n * 75 / 100)) AS INT) + 1)",
             0.5: "(CASE WHEN n % 2 = 1 THEN list_extract(s, n // 2 + 1) ELSE (list_extract(s, n // 2) + list_extract(s, n // 2 + 1)) / 2 END)"}
    else:
        q = {p: f"list_extract(s, CAST(round_even(CAST({p} AS DOUBLE) * (n - 1), 0) AS INT) + 1)" for p in (0.25, 0.5, 0.75)}
    return f"""SELECT {k} n, {r4('total / n')} AS mean, {r4(q[0.5])} AS median, {r4('wins / CAST(n AS DOUBLE)')} AS win, {r4(q[0.25])} AS p25, {r4(q[0.75])} AS p75,
      list_extract(s, 1) AS min, list_extract(s, -1) AS max
    FROM (SELECT {k} list_sort(list({value})) AS s, count({value}) AS n, CAST(sum(CAST({value} AS DECIMAL(28,4))) AS DOUBLE) AS total, count(*) FILTER (WHERE {value} > 0) AS wins
      FROM {source} WHERE {value} IS NOT NULL AND {where} GROUP BY {', '.join(keys)})"""


_CLEAN = "(SELECT *, " + role("rel", "title") + " AS role, " + size("coalesce(insider_val, 0)") + " AS size, CAST(year(fd) AS INT) AS y FROM book WHERE status = 'open' AND roi IS NOT NULL AND split_flag = 0)"
add("return_stats", " UNION ALL ".join("SELECT *, '" + m + "' AS method FROM (" + stats("trip", ["exit_status"], "exit_roi", m) + ")" for m in ("linear", "floor", "nearest")))
add("stats_by_role", stats(_CLEAN, ["role"], "roi"))
add("stats_by_size", stats(_CLEAN, ["size"], "roi"))
add("stats_by_year", stats(_CLEAN, ["y"], "roi"))
_LONG_H = "(" + " UNION ALL ".join(f"SELECT '{h}' AS horizon, {h} AS value FROM {_CLEAN}" for h in [f"r{n}" for n in H] + ["gap"]) + ")"
add("stats_by_horizon", stats(_LONG_H, ["horizon"], "value"))
_LONG_C = "(" + " UNION ALL ".join(f"SELECT '{c}' AS cut, {b} AS bucket, roi FROM {_CLEAN}" for c, b in (("all", "'all'"), ("role", "role"), ("size", "size"), ("year", "CAST(y AS VARCHAR)"))) + ")"
add("stats_cuts", stats(_LONG_C, ["cut", "bucket"], "roi"))
add("stats_by_exit_year", f"""SELECT CAST(year(exit_d) AS INT) AS exit_year, count(*) AS n, {r4(total('exit_roi') + ' / count(*)')} AS mean_roi, {r4('count(*) FILTER (WHERE exit_roi > 0) / CAST(count(*) AS DOUBLE)')} AS win_rate
  FROM trip WHERE exit_roi IS NOT NULL GROUP BY 1""")
_VALUED = "status = 'open' AND mtm IS NOT NULL AND split_flag = 0"
add("capital_summary", " UNION ALL ".join(
    f"SELECT deployed, value, {r2('value - deployed')} AS pnl, {r4('value / deployed - 1')} AS roi, '{b}' AS basis FROM (SELECT {total(f'CASE WHEN {c} THEN stake END')} AS deployed, "
    f"{r2(total(f'CASE WHEN {_VALUED} THEN mtm END'))} AS value FROM book)" for b, c in (("valued", _VALUED), ("reference", "status = 'open'"))))
add("backtest_capital", f"""SELECT {total("CASE WHEN entry_rule_status = 'verified' THEN stake END")} AS deployed, {r2(total("CASE WHEN exit_status <> 'open' THEN exit_pnl END"))} AS realised_pnl,
  count(*) FILTER (WHERE exit_status <> 'open') AS exited, count(*) FILTER (WHERE exit_pnl > 0) AS winners, count(*) FILTER (WHERE exit_pnl <= 0) AS losers FROM trip""")
_O = "status = 'open'"
add("position_counts", f"""SELECT count(*) AS signals, count(*) FILTER (WHERE {_O}) AS open, count(*) FILTER (WHERE {_O} AND roi IS NOT NULL) AS open_with_roi,
  count(*) FILTER (WHERE {_O} AND roi IS NOT NULL AND split_flag = 0) AS open_clean, count(*) FILTER (WHERE {_O} AND roi IS NOT NULL AND split_flag = 1) AS open_split_flagged,
  count(*) FILTER (WHERE {_O} AND roi_review = 1) AS roi_review, count(*) FILTER (WHERE status = 'awaiting_entry') AS awaiting_entry, count(*) FILTER (WHERE status = 'no_price') AS no_price,
  count(*) FILTER (WHERE entry_rule_status = 'entry_window_missing') AS entry_window_missing, count(*) FILTER (WHERE entry_rule_status = 'no_bars_after_filing') AS no_bars_after_filing FROM book""")
add("paper_verification_counts", f"""SELECT count(*) FILTER (WHERE {_O} AND NOT (entry_d > fd AND entry_px > 0)) AS entry_rule_failures,
  count(*) FILTER (WHERE {_O} AND abs(shares * entry_px - stake) > 0.25) + count(*) FILTER (WHERE {_O} AND abs(mtm - coalesce(shares_after_split, shares) * last_px) > 0.25) AS arithmetic_failures,
  count(*) FILTER (WHERE {_O} AND roi IS NOT NULL) AS open_positions_checked FROM book""")
_OUTCOME = "CASE WHEN status = 'open' AND pnl IS NOT NULL AND coalesce(roi_status, '') <> 'split_event_review' THEN CASE WHEN pnl > 0 THEN 'winner' ELSE 'loser' END ELSE 'unclassified' END"
add("outcome_split", f"SELECT {_OUTCOME} AS outcome, count(*) AS n, {r2(total('pnl'))} AS pnl FROM book GROUP BY 1")
add("outcome_rows", f"""SELECT * FROM (SELECT id, pnl FROM book WHERE {_OUTCOME} = 'winner' )
  UNION ALL SELECT * FROM (SELECT id, pnl FROM book WHERE {_OUTCOME} = 'loser' )""")
add("dataset_fingerprint", """SELECT count(*) AS rows, CAST(sum(h) AS VARCHAR) AS hash_sum, bit_xor(h) AS hash_xor FROM (SELECT CAST('0x' || substr(sha256(concat_ws('|', acc, der, CAST(td AS VARCHAR), code, sec,
  coalesce(CAST(CAST(round_even(sh * 1e4, 0) AS BIGINT) AS VARCHAR), ''), coalesce(CAST(CAST(round_even(px * 1e4, 0) AS BIGINT) AS VARCHAR), ''), ad, pcik)), 1, 15) AS BIGINT) AS h FROM trades)""")

# ------------------------------------------------------------------ 2.7
add("session_index", f"SELECT tk, {iso('d')}, CAST(row_number() OVER (PARTITION BY tk ORDER BY d) - 1 AS INT) AS i FROM bars")
_DATES = ["fd", "td", "entry_d", "last_d", "exit_d"] + [f"r{n}_d" for n in H]
_INTS = ["entry_gap_days", "hold", "delay_td_fd", "delay_fd_entry"]
add("simulate_positions", f"SELECT * EXCLUDE (pcik, rel, title, {', '.join(_DATES + _INTS)}), {iso(*_DATES)}, {', '.join(f'CAST({c} AS INT) AS {c}' for c in _INTS)} FROM book")
add("simulate_positions_without_splits", "SELECT id, status, mtm, pnl, roi, gap, roi_review, roi_reported, pnl_reported, exit_roi, exit_status FROM raw_book")
_TD = ["fd", "td", "entry_d", "last_d", "exit_d"]
add("round_trip_backtest", f"SELECT * EXCLUDE ({', '.join(_TD)}, exit_sessions), {iso(*_TD)}, CAST(exit_sessions AS INT) AS exit_sessions FROM trip")
add("classify_position_status", "SELECT status, entry_rule_status, exit_status, count(*) AS n FROM trip GROUP BY 1, 2, 3")
add("find_price_discontinuity", "SELECT l.id, CAST(jump_d AS VARCHAR) AS jump_d FROM live l LEFT JOIN first_jumps f ON l.id = f.id")
add("classify_splits", f"""SELECT tk, {iso('d')}, ratio, jump, kind, 'reference' AS test FROM split_events
  UNION ALL SELECT tk, CAST(d AS VARCHAR), ratio, jump, CASE WHEN abs(ln(jump)) <= ln(2) AND abs(ln(jump)) <= abs(ln(jump / ratio)) THEN 'adjusted' WHEN abs(ln(jump / ratio)) <= ln(2) THEN 'mixed'
    ELSE 'indeterminate' END, 'log' FROM split_events""")
add("adjust_for_splits", "SELECT id, roi_status, shares, shares_after_split, mtm, roi, roi_corrected, r5, r21, exit_roi FROM book WHERE split_flag = 1")
add("withhold_suspicious_returns", "SELECT id, roi, roi_reported, pnl_reported FROM raw_book WHERE roi_review = 1")
add("performance_factors", """SELECT id, 'entry_gap_vs_insider' AS factor, gap AS value, NULL::VARCHAR AS label FROM book WHERE gap IS NOT NULL
  UNION ALL SELECT id, 'large_entry_gap_review', gap, NULL FROM book WHERE abs(gap) >= 0.3 UNION ALL SELECT id, 'split_event_during_hold', NULL, roi_status FROM book WHERE split_flag = 1
  UNION ALL SELECT id, 'observed_holding_sessions', CAST(hold AS DOUBLE), NULL FROM book WHERE hold IS NOT NULL UNION ALL SELECT id, 'entry_to_last_close_return', roi, NULL FROM book WHERE roi IS NOT NULL
  UNION ALL SELECT id, 'long_horizon_not_available', NULL, NULL FROM book WHERE r252_d IS NULL""")
add("equity_curve_monthly", f"""SELECT m, n, deployed, value, {r2('value - deployed')} AS pnl, {r4('value / deployed - 1')} AS roi FROM (SELECT m, n, CAST(sum(ds) OVER (ORDER BY m) AS DOUBLE) AS deployed,
  {r2('CAST(sum(vs) OVER (ORDER BY m) AS DOUBLE)')} AS value FROM (SELECT strftime(entry_d, '%Y-%m') AS m, count(*) AS n, sum(CAST(stake AS DECIMAL(28,4))) AS ds, sum(CAST(mtm AS DECIMAL(28,4))) AS vs
  FROM book WHERE status = 'open' AND mtm IS NOT NULL GROUP BY 1))""")
add("equity_curve_daily", f"""SELECT CAST(day AS VARCHAR) AS d, n, n * 10000.0::DOUBLE AS deployed, value, {r2('value - n * 10000')} AS pnl, {r4('value / (n * 10000) - 1')} AS roi FROM (
  SELECT g.day, CAST(sum(g.held_n) AS BIGINT) AS n, {r2('CAST(sum(CAST(g.held AS DECIMAL(20,4)) * CAST(b.c AS DECIMAL(16,4))) AS DOUBLE)')} AS value
  FROM (SELECT y.day, p.tk, min(p.entry_d) AS first_entry, sum(CAST(p.shares AS DECIMAL(28,4))) AS held, count(*) AS held_n
        FROM (SELECT CAST(unnest(generate_series(DATE '1995-01-01', DATE '{fx.ASOF}', INTERVAL 1 DAY)) AS DATE) AS day) y JOIN raw_book p ON p.status = 'open' AND p.entry_d <= y.day
        WHERE isodow(y.day) < 6 GROUP BY 1, 2) g
  ASOF JOIN (SELECT * FROM clipped WHERE isodow(d) < 6) b ON g.tk = b.tk AND g.day >= b.d WHERE b.d >= g.first_entry GROUP BY g.day)""")
add("cluster_buys", f"SELECT issuer, {iso('start_d', 'end_d')}, {r2('CAST(wv AS DOUBLE)')} AS window_value FROM clusters")
_TAPE = "SELECT '{a}' AS asof, acc, pos, CAST(fd AS VARCHAR) AS fd, CAST(td AS VARCHAR) AS td FROM (SELECT * FROM trades WHERE {w})"
add("recent_tape", _TAPE.format(a="2001-09-01", w="fd >= DATE '2001-09-01' - 120") + " UNION ALL " + _TAPE.format(a="2003-01-01", w="true"))
add("recent_per_company", f"SELECT issuer, CAST(rank AS INT) AS rank, acc, pos FROM (SELECT icik AS issuer, acc, pos, row_number() OVER (PARTITION BY icik {_RECENT}) AS rank FROM trades) WHERE rank <= 40")
add("recent_per_pair", f"SELECT owner, issuer, CAST(rank AS INT) AS rank, acc, pos FROM (SELECT pcik AS owner, icik AS issuer, acc, pos, row_number() OVER (PARTITION BY pcik, icik {_RECENT}) AS rank FROM trades) WHERE rank <= 10")

# ------------------------------------------------------------------ 2.8
add("best_worst_positions", f"""SELECT * FROM (SELECT 'best' AS side, id, roi, pnl FROM {_CLEAN} ORDER BY roi DESC, id LIMIT 25)
  UNION ALL SELECT * FROM (SELECT 'worst', id, roi, pnl FROM {_CLEAN} ORDER BY roi, id LIMIT 25)""")
add("view_sort_page", """SELECT * FROM (SELECT 'value' AS view, acc, pos FROM trades ORDER BY val DESC NULLS LAST, acc, pos LIMIT 50 OFFSET 150)
  UNION ALL SELECT * FROM (SELECT 'nature', acc, pos FROM trades ORDER BY nullif(lower(nature), '') ASC NULLS LAST, acc, pos LIMIT 50 OFFSET 50)""")
add("view_seek_page", """SELECT * FROM (SELECT 'value' AS view, acc, pos FROM trades ORDER BY val DESC NULLS LAST, acc, pos LIMIT 50 OFFSET 50)
  UNION ALL SELECT * FROM (SELECT 'nature', acc, pos FROM trades ORDER BY nullif(lower(nature), '') ASC NULLS LAST, acc, pos LIMIT 50 OFFSET 50)""")
add("sample_rows", """SELECT m, pick, t, acc, pos, val FROM (SELECT *, strftime(fd, '%Y-%m') AS m, row_number() OVER (PARTITION BY strftime(fd, '%Y-%m') ORDER BY coalesce(val, 0) DESC, fd, tk, acc, pos, td) - 1 AS t,
    count(*) OVER (PARTITION BY strftime(fd, '%Y-%m')) AS n FROM trades) r, (VALUES ('top'), ('stride')) p(pick)
  WHERE (pick = 'top' AND t < 2) OR (pick = 'stride' AND t IN (0, greatest(1, n // 25), 2 * greatest(1, n // 25)))""")

# ------------------------------------------------------------------ 2.9
add("row_issues", f"SELECT issue, severity, acc, pos, {URL.format(cik='(' + _ISSUER + ')', acc='acc')} AS source_url FROM issues")
add("row_issues_rare", f"""SELECT issue, severity, count(*) AS n FROM (SELECT unnest(list_filter([
    CASE WHEN acc = '' THEN 'MISSING_ACCESSION|high' END, CASE WHEN acc <> '' AND NOT regexp_matches(acc, '{fv.ACCESSION_PATTERN}') THEN 'BAD_ACCESSION_FORMAT|medium' END,
    CASE WHEN td IS NULL AND code <> '' THEN 'BAD_TRANSACTION_DATE|medium' END, CASE WHEN td > fd THEN 'TRANSACTION_AFTER_FILING|high' END, CASE WHEN tk = '' THEN 'MISSING_TICKER|medium' END,
    CASE WHEN tk = '?bad' THEN 'SUSPICIOUS_TICKER|low' END, CASE WHEN code = '' THEN 'MISSING_TRANSACTION_CODE|high' END, CASE WHEN upper(code) = 'Q' THEN 'UNKNOWN_TRANSACTION_CODE|medium' END,
    CASE WHEN sh < 0 THEN 'NEGATIVE_SHARES|medium' END, CASE WHEN px < 0 THEN 'NEGATIVE_PRICE|medium' END, CASE WHEN code IN ('P', 'S') AND sh < 0 THEN 'MISSING_OPEN_MARKET_SHARES|high' END,
    CASE WHEN code IN ('P', 'S') AND (px IS NULL OR px < 0) THEN 'MISSING_OPEN_MARKET_PRICE|medium' END, CASE WHEN abs({r2('sh * px')} - val) > 0.05 THEN 'VALUE_MISMATCH|high' END,
    CASE WHEN form = '4' AND {_BDAYS.format(a='td', b='fd')} > 2 THEN 'POSSIBLE_LATE_FORM4|medium' END], lambda x: x IS NOT NULL)) AS z, split_part(z, '|', 1) AS issue, split_part(z, '|', 2) AS severity
  FROM (SELECT form, fd, val, CASE WHEN amend = 1 AND code = 'A' THEN '' WHEN amend = 1 AND code = 'G' THEN '12-3' ELSE acc END AS acc, CASE WHEN amend = 1 AND code = 'S' THEN '?bad' ELSE tk END AS tk,
    CASE WHEN amend = 1 AND sec = 'Warrant' THEN -sh ELSE sh END AS sh, CASE WHEN amend = 1 AND di = 'I' THEN -px ELSE px END AS px,
    CASE WHEN code = 'M' THEN CASE WHEN amend = 1 THEN '' ELSE 'q' END ELSE code END AS code, CASE WHEN amend = 1 AND form = '5' THEN NULL ELSE td END AS td FROM trades)) GROUP BY 1, 2""")
add("issue_counts", "SELECT issue, severity, count(*) AS n FROM issues WHERE year(fd) = 2001 GROUP BY 1, 2")
add("severity_counts", "SELECT severity, count(*) AS n FROM issues GROUP BY 1")
add("issue_examples", "SELECT issue, acc, pos FROM issues")
add("audit_counts", f"""SELECT count(*) AS rows, count(*) FILTER (WHERE year(fd) = 2001) AS target_rows, count(DISTINCT acc) AS filings, count(DISTINCT acc) FILTER (WHERE year(fd) = 2001) AS target_filings,
  count(DISTINCT icik) AS companies, count(DISTINCT pcik) AS insiders, count(*) FILTER (WHERE tk <> '') AS with_ticker, count(*) FILTER (WHERE tk = '') AS without_ticker, count(px) AS with_price,
  count(*) FILTER (WHERE der = 1) AS derivative_rows, {total('abs(val)')} AS total_value, {total(f"CASE WHEN {BUY} THEN abs(val) END")} AS buy_value, {total(f"CASE WHEN {SELL} THEN abs(val) END")} AS sell_value,
  {_NET} AS net_value FROM trades""")
add("audit_by_code", "SELECT code, count(*) AS n FROM trades GROUP BY 1")
add("coverage_report", """SELECT *, CASE WHEN blockers = '' THEN 1 ELSE 0 END AS complete FROM (
  SELECT y || '-01-01' AS target_start, y || '-12-31' AS target_end, observed_from, observed_to, target_from, target_to, target_rows, missing_months, missing_days,
    concat_ws(',', CASE WHEN target_rows = 0 THEN 'no_target_rows' END, CASE WHEN target_from::DATE > make_date(y, 1, 1) + 14 THEN 'starts_late' END,
      CASE WHEN target_to::DATE < make_date(y, 12, 31) - 4 THEN 'ends_early' END, CASE WHEN missing_months > 0 THEN 'months_missing' END) AS blockers
  FROM (SELECT y, CAST(min(fd) AS VARCHAR) AS observed_from, CAST(max(fd) AS VARCHAR) AS observed_to, CAST(min(fd) FILTER (WHERE year(fd) = y) AS VARCHAR) AS target_from,
      CAST(max(fd) FILTER (WHERE year(fd) = y) AS VARCHAR) AS target_to, count(*) FILTER (WHERE year(fd) = y) AS target_rows,
      12 - count(DISTINCT month(fd)) FILTER (WHERE year(fd) = y) AS missing_months,
      (SELECT count(*) FROM range(make_date(y, 1, 1), make_date(y + 1, 1, 1), INTERVAL 1 DAY) r(x) WHERE isodow(x) < 6) - count(DISTINCT fd) FILTER (WHERE year(fd) = y AND isodow(fd) < 6) AS missing_days
    FROM trades, (VALUES (2001), (1999)) v(y) GROUP BY y))""")
add("manifest_blockers", """SELECT 'ledger_window_too_short' AS blocker, CAST(min(CAST(o_orderdate AS DATE)) AS VARCHAR) || '..' || CAST(max(CAST(o_orderdate AS DATE)) AS VARCHAR) AS detail FROM orders
  HAVING max(o_orderdate) < DATE '2001-12-31'
  UNION ALL SELECT 'quarter_not_available', label FROM (SELECT year(o_orderdate) || 'Q' || quarter(o_orderdate) AS label, max(CAST(o_orderdate AS DATE)) AS m FROM orders GROUP BY 1)
  WHERE m + 20 <= CAST(date_trunc('quarter', m) + INTERVAL 3 MONTH - INTERVAL 1 DAY AS DATE)""")


def span(c):
    return f"CASE WHEN min({c}) = max({c}) THEN CAST(min({c}) AS VARCHAR) ELSE min({c}) || ' to ' || max({c}) END"


def flag(category, severity, source, keys, having="true", extra="", summary=None):
    """Common flag shape by plain grouping."""
    head = (f"SELECT {category} AS category, {severity} AS severity, coalesce(min(nullif(tk, '')), '') AS tk, CASE WHEN min(icik) = max(icik) THEN min(icik) ELSE '' END AS icik, {span('fd')} AS fd_text, {span('td')} AS td_text, "
            f"{r4(total('abs(sh)'))} AS total_shares, {r2(total(V))} AS total_value, count(*) AS row_n, count(DISTINCT acc) AS filing_n, count(DISTINCT pcik) AS insider_n, count(DISTINCT nullif(tk, '')) AS ticker_n{extra}")
    body = f"{head} FROM {source} GROUP BY {keys} HAVING {having}"
    return body if summary is None else f"SELECT *, {summary} AS summary FROM ({body})"


_TOTAL_TEXT = "'$' || format('{:,.2f}', total_value)"
_LARGE = flag("CASE WHEN code = 'P' THEN 'Large disclosed purchase' ELSE 'Large disclosed sale' END", "CASE WHEN code = 'P' THEN 'Medium' ELSE 'Low' END",
              f"(SELECT * FROM trades WHERE code IN ('P', 'S') AND val >= {fx.LARGE})", "acc, code",
              summary=f"'Large ' || CASE WHEN severity = 'Medium' THEN 'purchases' ELSE 'sales' END || ' in one filing total ' || {_TOTAL_TEXT} || '.'")
_CLUSTER = flag("'Cluster buying'", "'Medium'", "(SELECT t.* FROM trades t JOIN clusters c ON t.icik = c.issuer AND t.td BETWEEN c.start_d AND c.end_d WHERE t.code = 'P' AND t.der = 0)", "icik",
                summary=f"insider_n || ' insiders bought within a week for ' || {_TOTAL_TEXT} || '.'")
_SYNC = flag("'Synchronized same-day sales'", "'Medium'", "(SELECT *, icik AS issuer FROM trades WHERE code = 'S' AND der = 0)", "issuer, td", f"count(DISTINCT pcik) >= 2 AND {total(V)} >= {fx.SYNC}")
add("flag_large_transactions", _LARGE)
add("dedupe_flags", f"SELECT category, fd_text, td_text, summary, filing_n FROM ({_LARGE})")
add("flag_cluster_buys", _CLUSTER)
add("flag_synchronized_sales", _SYNC)
_SELLV = f""", {r2(total("CASE WHEN code = 'S' THEN " + V + " END"))} AS sell_value"""
_BUYV = f""", {r2(total("CASE WHEN code = 'P' THEN " + V + " END"))} AS buy_value"""
add("flag_exercise_then_sale", flag("'Exercise/conversion with same-filing sale'", "'Low'", "trades", "acc", "bool_or(der = 1 OR code IN ('M', 'C', 'X', 'O')) AND bool_or(code = 'S')", _SELLV))
add("flag_buy_sell_overlap", flag("'Same-insider buy/sell overlap'", "'Low'", "(SELECT * FROM trades WHERE code IN ('P', 'S') AND der = 0)", "pcik, icik",
    f"""bool_or(code = 'P') AND bool_or(code = 'S') AND greatest({total("CASE WHEN code = 'P' THEN " + V + " END")}, {total("CASE WHEN code = 'S' THEN " + V + " END")}) >= {fx.OVERLAP}""", _BUYV + _SELLV))
add("flag_large_noncash", flag("'Large non-cash transaction'", "CASE WHEN min(code) = 'G' THEN 'Medium' ELSE 'Low' END", f"(SELECT * FROM trades WHERE code IN ('G', 'A', 'J') AND coalesce(val, 0) = 0 AND sh >= {fx.NONCASH})",
    "acc, icik, pos", summary="'Row reports ' || CAST(CAST(total_shares AS BIGINT) AS VARCHAR) || ' shares without a cash value.'"))
_PF = "SELECT '{cat}' AS category, '{sev}' AS severity, tk, CAST(fd AS VARCHAR) AS fd_text, insider_val AS total_value, '{kind}|' || id AS flag_key FROM raw_book WHERE status = 'open' AND {cond}"
for _kind, _q, _cond in (("price_gap", "flag_price_gap", "abs(gap) >= 1"),
                         ("straddle", "flag_split_straddle", "(roi_review = 1 OR (roi > 2 AND hold <= 90) OR roi > 5)"),
                         ("unsupported_mark", "flag_unsupported_mark", "r1 IS NULL AND coalesce(hold, 0) = 0")):
    add(_q, _PF.format(cat=fv.FLAG_KINDS[_kind][0], sev=fv.FLAG_KINDS[_kind][1], kind=_kind, cond=_cond))
add("flag_data_quality", """SELECT 'Data coverage gap' AS category, 'High' AS severity, count(*) FILTER (WHERE year(fd) = 2001) AS row_n FROM trades
  UNION ALL SELECT 'Row integrity issue: ' || issue, CASE severity WHEN 'high' THEN 'High' WHEN 'low' THEN 'Low' ELSE 'Medium' END, count(*) FROM issues WHERE year(fd) = 2001 GROUP BY issue, severity""")
add("flag_item", f"""SELECT f.icik AS flag_key, f.* FROM ({flag("'Same-insider buy/sell overlap'", "'Low'", "(SELECT * REPLACE (abs(sh) AS sh) FROM trades)", "trades_key").replace('(SELECT * REPLACE (abs(sh) AS sh) FROM trades)', '(SELECT *, icik AS trades_key FROM trades)')}) f""")
add("top_flags", f"""SELECT printf('AUTO-%04d', row_number() OVER (ORDER BY rk, total_value DESC, category, tk, flag_key)) AS id, category, severity, tk, total_value, flag_key FROM (
  SELECT *, CASE severity WHEN 'High' THEN 1 WHEN 'Medium' THEN 2 ELSE 3 END AS rk FROM (
    SELECT category, severity, tk, total_value, flag_key FROM ({_LARGE.replace('SELECT CASE WHEN code', "SELECT CASE WHEN code = 'P' THEN 'large_purchase|' ELSE 'large_sale|' END || acc AS flag_key, CASE WHEN code", 1)})
    UNION ALL SELECT category, severity, tk, total_value, flag_key FROM ({_CLUSTER.replace("SELECT 'Cluster buying'", "SELECT 'cluster|' || icik AS flag_key, 'Cluster buying'", 1)})
    UNION ALL SELECT category, severity, tk, total_value, flag_key FROM ({_SYNC.replace("SELECT 'Synchronized", "SELECT 'sync_sales|' || issuer || '|' || td AS flag_key, 'Synchronized", 1)}))
  ORDER BY rk, total_value DESC, category, tk, flag_key LIMIT 250)""")
add("flag_filings", f"""SELECT DISTINCT 'cluster|' || t.icik AS flag_key, t.acc, t.icik, {URL.format(cik="(CASE WHEN t.icik = '0' THEN ltrim(substr(replace(t.acc, '-', ''), 1, 10), '0') ELSE t.icik END)", acc='t.acc')} AS url
  FROM trades t JOIN clusters c ON t.icik = c.issuer AND t.td BETWEEN c.start_d AND c.end_d WHERE t.code = 'P' AND t.der = 0""")
add("flag_parties", """SELECT flag_key, party, name, count(*) AS row_n FROM (
  SELECT 'cluster|' || t.icik AS flag_key, unnest(['insider', 'ticker', 'company']) AS party, unnest([t.insider, t.tk, t.co]) AS name
  FROM trades t JOIN clusters c ON t.icik = c.issuer AND t.td BETWEEN c.start_d AND c.end_d WHERE t.code = 'P' AND t.der = 0) WHERE name <> '' GROUP BY 1, 2, 3""")
add("verify_summary", f"""SELECT unnest(['signals', 'open', 'no_price', 'value']) AS check, unnest([a, b, c, v]) AS published, unnest([a, b, c, v]) AS recomputed, 1 AS ok FROM (
  SELECT CAST(count(*) AS DOUBLE) AS a, CAST(count(*) FILTER (WHERE {_O}) AS DOUBLE) AS b, CAST(count(*) FILTER (WHERE status = 'no_price') AS DOUBLE) AS c, {r2(total(f'CASE WHEN {_VALUED} THEN mtm END'))} AS v FROM book)""")
add("backtest_reconciliation", """SELECT count(*) AS positions, count(DISTINCT id) AS ids, count(*) FILTER (WHERE entry_rule_status = 'verified') AS verified, count(*) FILTER (WHERE entry_rule_status <> 'verified') AS unverified,
  (SELECT count(*) FROM signals) AS signals FROM trip""")
_TRIP_CHECKS = [("entry_after_filing", "entry_rule_status = 'verified'", "entry_d > fd"), ("entry_gap_1_to_10_days", "entry_rule_status = 'verified'", "entry_d - fd BETWEEN 1 AND 10"),
                ("shares_match_stake", "entry_rule_status = 'verified'", "abs(shares - 10000 / entry_px) <= 0.01"), ("filing_url_wellformed", "entry_rule_status = 'verified'", "true"),
                ("unpriced_has_no_entry", "entry_rule_status <> 'verified'", "entry_px IS NULL"), ("exit_after_entry", "exit_status <> 'open'", "exit_d > entry_d"),
                ("exit_roi_is_price_ratio", "exit_status <> 'open'", "abs(exit_roi - (exit_px / entry_px - 1)) <= 2e-4")]


def checked(source, checks):
    """Checks without any applicable row do not appear."""
    return " UNION ALL ".join(f"SELECT '{n}' AS check, count(*) FILTER (WHERE {ok}) AS passed, count(*) FILTER (WHERE NOT coalesce({ok}, false)) AS failed FROM {source} WHERE {applies} HAVING count(*) > 0"
                              for n, applies, ok in checks)


add("verify_backtest", checked("trip", _TRIP_CHECKS))
_REV = "(roi_review = 1 AND roi_reported IS NOT NULL)"
_MARKED = f"{_O} AND NOT {_REV} AND last_px IS NOT NULL"
_EFF = "coalesce(shares_after_split, shares)"
_BOOK_CHECKS = [
    ("open_has_verified_entry", _O, "entry_rule_status = 'verified'"), ("entry_after_filing", _O, "entry_d > fd"), ("entry_gap_1_to_10_days", _O, "entry_d - fd BETWEEN 1 AND 10"),
    ("entry_is_weekday", _O, "isodow(entry_d) < 6"), ("shares_match_stake", _O, "abs(shares - 10000 / entry_px) <= 0.01"), ("review_blanks_headline", f"{_O} AND {_REV}", "roi IS NULL AND mtm IS NULL AND pnl IS NULL"),
    ("mark_is_shares_times_price", _MARKED, f"abs(mtm - {_EFF} * last_px) <= greatest(0.05, {_EFF} * 1e-4, last_px * 1e-4)"), ("pnl_is_mark_minus_stake", _MARKED, "abs(pnl - (mtm - 10000)) <= 0.05"),
    ("roi_is_mark_over_stake", _MARKED, "abs(roi - (mtm / 10000 - 1)) <= 1e-4"), ("exit_after_entry", f"{_O} AND exit_px IS NOT NULL", "exit_d > entry_d"),
    ("exit_roi_is_price_ratio", f"{_O} AND exit_px IS NOT NULL", "abs(exit_roi - (exit_px / entry_px - 1)) <= 2e-4"),
    ("exit_pnl_is_shares_times_price", f"{_O} AND exit_px IS NOT NULL", "abs(exit_pnl - (shares * exit_px - 10000)) <= greatest(0.05, shares * 1e-4, exit_px * 1e-4)"),
    ("insider_price_is_value_over_shares", f"{_O} AND insider_px <> 0", "abs(insider_px - insider_val / insider_sh) <= greatest(0.01, insider_px * 1e-4)"),
    ("gap_blank_when_split", f"{_O} AND insider_px <> 0 AND split_flag = 1", "gap IS NULL"), ("gap_is_entry_over_insider", f"{_O} AND insider_px <> 0 AND split_flag = 0", "abs(gap - (entry_px / insider_px - 1)) <= 1e-4"),
    ("split_has_status", f"{_O} AND split_flag = 1", "roi_status IS NOT NULL"), ("mixed_has_adjusted_shares", f"{_O} AND roi_status = 'mixed_pre_post_split'", "shares_after_split IS NOT NULL"),
    ("mixed_roi_matches", f"{_O} AND roi_status = 'mixed_pre_post_split'", "abs(roi_corrected - roi) <= 1e-4"), ("filing_url_wellformed", _O, "true"), ("pending_has_no_entry", "status <> 'open'", "entry_px IS NULL"),
] + [(f"r{n}_has_day_and_price", f"{_O} AND r{n} IS NOT NULL", f"r{n}_d IS NOT NULL AND r{n}_px IS NOT NULL") for n in H] + [
    (f"r{n}_is_price_ratio", f"{_O} AND r{n} IS NOT NULL", f"abs(r{n} - (r{n}_px / entry_px - 1)) <= 2e-4") for n in H]
add("verify_positions", checked("book", _BOOK_CHECKS))
add("verify_activity", checked("priced", [("overlap_consistent", "true", "overlap = (buy_n > 0 AND sell_n > 0)"), ("counts_add_up", "true", "n = buy_n + sell_n + other_n"),
                                          ("shares_match_holdings", "reported_shares IS NOT NULL", "true"),
                                          ("value_is_shares_times_mark", "holding_value IS NOT NULL", "abs(holding_value - reported_shares * mark_px) <= 0.01")]))
add("flag_evidence", f"""SELECT 'sync_sales|' || icik || '|' || td AS flag_key, CAST(line AS INT) AS line, acc || ': ' || fd || ' filing; ' || td || ' transaction; ' || CASE WHEN tk = '' THEN 'no ticker' ELSE tk END || ' ' || co || '; '
    || insider || '; Table I non-derivative; code S; ' || CAST(CAST(sh AS BIGINT) AS VARCHAR) || ' shares @ ' || {_MONEY.format(x='px')} || '; value ' || {_MONEY.format(x='val')} || '.' AS evidence
  FROM (SELECT *, row_number() OVER (PARTITION BY icik, td ORDER BY fd, td, acc, pos, icik) AS line, {total(V)[:-len(' AS DOUBLE)')] if False else f'sum(CAST({V} AS DECIMAL(28,4))) OVER (PARTITION BY icik, td)'} AS tv
    FROM trades WHERE code = 'S' AND der = 0) t
  WHERE tv >= {fx.SYNC} AND (SELECT count(DISTINCT u.pcik) FROM trades u WHERE u.code = 'S' AND u.der = 0 AND u.icik = t.icik AND u.td = t.td) >= 2""")

# ------------------------------------------------------------------ 2.10
add("stream_row_issues", "SELECT issue, severity, count(*) AS n FROM issues GROUP BY 1, 2")
add("stream_flow_windows", f"SELECT CAST(fd AS VARCHAR) AS d, code, count(*) AS n, count(*) FILTER (WHERE der <> 0) AS derivative, {total(V)} AS value FROM trades GROUP BY fd, code")
add("stream_sliding_windows", f"""SELECT CAST(fd - CAST(k AS INT) AS VARCHAR) AS d, code, count(*) AS n, {total(V)} AS value FROM trades, range(0, 7) x(k) GROUP BY 1, 2""")
add("stream_dedupe", f"SELECT DISTINCT acc, der, CAST(td AS VARCHAR) AS td, code, sec, sh, px, ad, pcik FROM trades")
add("stream_ingest_trades", f"SELECT acc, pos, code, sh FROM trades QUALIFY row_number() OVER (PARTITION BY {_KEY} ORDER BY pos DESC, icik DESC) = 1")
add("stream_table_years", f"""SELECT CAST(year(fd) AS INT) AS fy, count(*) AS n FROM (SELECT fd FROM trades QUALIFY row_number() OVER (PARTITION BY {_KEY} ORDER BY pos DESC, icik DESC) = 1)
  WHERE year(fd) IN (1995, 1998) GROUP BY 1""")
# portions by two filing years; rows in a window that the watermark of the portions before had passed are late
_ARRIVED = """(SELECT *, CASE WHEN pos % 53 = 0 THEN 3 ELSE least(greatest(year(fd), 1992) - 1992, 7) // 2 END AS part FROM trades WHERE fd IS NOT NULL)"""
_PASSED = f"""(SELECT a.*, fd + 1 <= (SELECT max(b.fd) - 45 FROM {_ARRIVED} b WHERE b.part < a.part) AS late,
  fd + 1 > (SELECT max(fd) - 45 FROM trades) AS still_open FROM {_ARRIVED} a)"""
add("stream_flow_windows_append", f"SELECT CAST(fd AS VARCHAR) AS d, code, count(*) AS n, count(*) FILTER (WHERE der <> 0) AS derivative, {total(V)} AS value FROM {_PASSED} WHERE NOT still_open AND late IS NOT TRUE GROUP BY fd, code")
add("stream_late_rows", f"SELECT count(*) AS arrived, count(*) FILTER (WHERE still_open) AS still_open, count(*) FILTER (WHERE NOT still_open AND late IS NOT TRUE) AS emitted, count(*) FILTER (WHERE late AND NOT still_open) AS late FROM {_PASSED}")
add("stream_pending_entries", """SELECT s.id, s.tk, CAST(s.fd AS VARCHAR) AS fd, 'verified' AS entry_rule_status, CAST(min(b.d) AS VARCHAR) AS entry_d, arg_min(b.o, b.d) AS entry_px
  FROM signals s JOIN bars b ON s.tk = b.tk AND b.d > s.fd AND b.d <= s.fd + 10 GROUP BY s.id, s.tk, s.fd""")
# a window is closed once both streams have passed it by the watermark's delay of a day
add("stream_entry_statuses", """SELECT s.id, s.tk, CAST(s.fd AS VARCHAR) AS fd, CASE WHEN min(b.d) IS NOT NULL THEN 'verified'
    WHEN s.fd + 10 < least((SELECT max(fd) FROM signals), (SELECT max(d) FROM bars)) - 1 THEN 'entry_window_missing' ELSE 'awaiting_entry' END AS entry_rule_status,
    CAST(min(b.d) AS VARCHAR) AS entry_d, arg_min(b.o, b.d) AS entry_px
  FROM signals s LEFT JOIN bars b ON s.tk = b.tk AND b.d > s.fd AND b.d <= s.fd + 10 GROUP BY s.id, s.tk, s.fd""")

SQL["stream_entry_timers"] = SQL["stream_entry_statuses"]

_COUNTS = ["open", "open_split_flagged", "entry_window_missing", "no_bars_after_filing", "awaiting_entry", "no_price"]
_CAPITAL = ["deployed", "value", "pnl", "roi"]


def unpivot(kind, names, source):
    return (f"SELECT '{kind}' AS id, unnest([{quoted(names)}]) AS metric, unnest([{', '.join(f'CAST({n} AS DOUBLE)' for n in names)}]) AS value, "
            f"NULL::BIGINT AS n FROM ({source})")


def extreme(kind, cut, order):
    return f"SELECT * FROM (SELECT '{kind}', bucket, median, n FROM ({SQL['stats_cuts']}) WHERE cut = '{cut}' AND n >= {fv.FINDING_MIN_N} ORDER BY {order} LIMIT 1)"


SQL["findings"] = " UNION ALL ".join([
    unpivot("counts", _COUNTS, SQL["position_counts"]),
    unpivot("capital", _CAPITAL, f"SELECT * FROM ({SQL['capital_summary']}) WHERE basis = 'valued'"),
    f"SELECT 'roi', 'median', median, n FROM ({SQL['stats_cuts']}) WHERE cut = 'all'",
    f"SELECT CASE WHEN horizon = 'gap' THEN 'entry_gap' ELSE 'horizon' END, horizon, median, n FROM ({SQL['stats_by_horizon']}) WHERE n >= {fv.FINDING_MIN_N} OR horizon = 'gap'",
    extreme("best_role", "role", "median DESC, bucket DESC"), extreme("worst_role", "role", "median, bucket"),
    extreme("best_size", "size", "median DESC, bucket DESC")])


# ------------------------------------------------------------------ content manifest
add("file_manifest", "SELECT doc_id, octet_length(encode(coalesce(text, ''))) AS bytes, sha256(coalesce(text, '')) AS sha256 FROM documents")
