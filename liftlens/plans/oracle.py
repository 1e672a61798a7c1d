"""DuckDB SQL for the registered queries, written apart from the Spark code.

Each query is the shared common table expressions it needs plus one SELECT. Results are
rounded as the Spark side rounds them.
"""

from __future__ import annotations


def rnd(expr: str, digits: int) -> str:
    """Rounding that never yields a negative zero."""
    return (f"(CASE WHEN abs({expr}) < {0.5 * 10 ** -digits!r} THEN 0.0::DOUBLE "
            f"ELSE round({expr}, {digits}) END)")


KPI = ["Order Value", "Order Count", "% Open Orders"]
SEGMENTS = ["MARKET", "NATION", "REGION"]
NUM = ["Order Value_pre", "Order Count_pre", "% Open Orders_pre", "ACCTBAL", "LIFETIME"]
Z = "1.959963984540054"


def ident(name: str) -> str:
    return f'"{name}"'


STUDY = """
treatments(treatment_id, label, priority, a, b) AS (VALUES
  ('URGENT_1998H1', 'Urgent orders H1', '1-URGENT', TIMESTAMP '1998-01-01', TIMESTAMP '1998-06-30'),
  ('HIGH_1998H1', 'High orders H1', '2-HIGH', TIMESTAMP '1998-01-01', TIMESTAMP '1998-06-30'),
  ('URGENT_1998H2', 'Urgent orders H2', '1-URGENT', TIMESTAMP '1998-07-01', TIMESTAMP '1998-12-31')),
win AS (
  SELECT treatment_id, a AS alloc, a - INTERVAL 720 DAY AS s, a - INTERVAL 1 DAY AS e,
         a - INTERVAL 720 DAY AS low FROM treatments
  UNION ALL
  SELECT treatment_id, a, b, b + to_days(d), b + INTERVAL 1 DAY
  FROM treatments, (VALUES (32), (58), (720)) v(d)),
pop AS (
  SELECT emp_id, treatment_id, start_date, end_date,
         (cents // 100)::BIGINT AS "Order Value", n::BIGINT AS "Order Count",
         (CASE WHEN n > 0 THEN (100 * open) // n ELSE 0 END)::BIGINT AS "% Open Orders",
         "ACCTBAL", before::DOUBLE AS "LIFETIME"
  FROM (
    SELECT c_custkey::VARCHAR AS emp_id, w.treatment_id, w.s AS start_date, w.e AS end_date,
           c_acctbal AS "ACCTBAL",
           coalesce(sum(round(o_totalprice * 100)::BIGINT)
                    FILTER (WHERE o_orderdate BETWEEN w.low AND w.e), 0)::BIGINT AS cents,
           count(o_orderkey) FILTER (WHERE o_orderdate BETWEEN w.low AND w.e) AS n,
           count(o_orderkey) FILTER (WHERE o_orderdate BETWEEN w.low AND w.e
                                     AND o_orderstatus = 'O') AS open,
           count(o_orderkey) FILTER (WHERE o_orderdate < w.alloc) AS before
    FROM customer CROSS JOIN win w LEFT JOIN orders ON o_custkey = c_custkey
    GROUP BY c_custkey, w.treatment_id, w.s, w.e, c_acctbal)),
taken AS (
  SELECT o_custkey::VARCHAR AS emp_id, treatment_id, label, min(o_orderdate) AS t0,
         max(o_orderdate) AS t1
  FROM orders JOIN treatments ON o_orderpriority = priority AND o_orderdate BETWEEN a AND b
  GROUP BY ALL),
universe AS (
  SELECT emp_id, t.a AS treatment_allocated_date, t.b AS treatment_allocated_end_date,
         treatment_id, k.label AS treatment_label_taken, k.t0 AS start_date_of_treatment_taken,
         k.t1 AS end_date_of_treatment_taken
  FROM taken k FULL OUTER JOIN (SELECT DISTINCT emp_id, treatment_id FROM pop) p
       USING (emp_id, treatment_id)
  LEFT JOIN treatments t USING (treatment_id)),
seg AS (
  SELECT c_custkey::VARCHAR AS emp_id, c_mktsegment AS "MARKET", n_name AS "NATION",
         r_name AS "REGION"
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
""".strip()

_CLIP = ",\n".join(
    f'least(greatest("{k}"::DOUBLE, (SELECT quantile_cont("{k}"::DOUBLE, 0.01) FROM pop)), '
    f'(SELECT quantile_cont("{k}"::DOUBLE, 0.99) FROM pop)) AS "{k}"' for k in KPI)
_SNAP = ("CASE WHEN {d} BETWEEN 25 AND 35 THEN 30 WHEN {d} BETWEEN 55 AND 65 THEN 60 "
         "WHEN {d} BETWEEN 85 AND 95 THEN 90 ELSE {d} END")

SHAPED = f"""
clipped AS (SELECT emp_id, treatment_id, start_date, end_date, {_CLIP}, "ACCTBAL", "LIFETIME"
  FROM pop),
dated AS (
  SELECT c.*, floor(epoch(u.treatment_allocated_date - c.start_date) / 86400)::INT AS lead_days,
         floor(epoch(c.end_date - u.treatment_allocated_end_date) / 86400)::INT AS post_days
  FROM clipped c JOIN universe u USING (emp_id, treatment_id)),
pre AS (SELECT *, {_SNAP.format(d='lead_days')} AS date_diff FROM dated WHERE lead_days > 0),
post AS (SELECT *, {_SNAP.format(d='post_days')} AS date_diff FROM dated
  WHERE lead_days <= 0 AND post_days >= 0),
feats AS (
  SELECT p.emp_id, p.treatment_id, {", ".join(f'p."{k}"' for k in KPI)}, p."ACCTBAL",
         p."LIFETIME",
         CASE WHEN u.end_date_of_treatment_taken IS NULL THEN 0 ELSE 1 END AS "Control/Test_group",
         s."MARKET", s."NATION", s."REGION"
  FROM pre p JOIN universe u USING (emp_id, treatment_id) LEFT JOIN seg s USING (emp_id)),
""".strip()


def outcome(name: str, days: int) -> str:
    return f"""
{name} AS (
  SELECT f.emp_id, f.treatment_id, {", ".join(f'f."{k}" AS "{k}_pre"' for k in KPI)},
         f."ACCTBAL", f."LIFETIME", f."Control/Test_group", f."MARKET", f."NATION", f."REGION",
         {", ".join(f'o."{k}"' for k in KPI)}
  FROM feats f JOIN post o USING (emp_id, treatment_id) WHERE o.date_diff = {days}),
""".strip()


ROWS = outcome("rows_", 720)


def query(*parts: str, select: str) -> str:
    """CTE texts end in commas; the last one is dropped here."""
    body = "\n".join(parts).rstrip().rstrip(",")
    return f"WITH {body}\n{select}" if body else select


# --- matching -----------------------------------------------------------------------------

def _designs() -> list[tuple[int, str, str, dict[str, str]]]:
    covariates = [*NUM, "MARKET", "NATION", "REGION"]
    out = [("match_result1", "q5", {c: "q5" for c in NUM})]
    out += [("match_result2", f"{c}_q3", {c: "q3"}) for c in covariates]
    out += [("match_result3", f"{c}_log0.6", {c: "log0.6"}) for c in covariates]
    out += [("match_result4", f"{c}_" + ("log0.5" if c == NUM[0] else "q5"),
             {c: "log0.5" if c == NUM[0] else "q5"}) for c in covariates]
    out += [("match_result5", f"{m}_{k}", {c: f"{m}{k}" for c in NUM})
            for m in "qw" for k in (2, 3, 4, 5)]
    return [(i + 1, s, n, r) for i, (s, n, r) in enumerate(out)]


def _candidates() -> str:
    designs = _designs()
    infos = ", ".join(f"({i}, '{s}', '{n}')" for i, s, n, _ in designs)
    rules = ", ".join(f"({i}, '{c}', '{r.get(c, 'sturges')}')"
                      for i, _, _, r in designs for c in NUM)
    places = ", ".join(f"('{c}', {i})" for i, c in enumerate(NUM))
    long = " UNION ALL ".join(
        f"SELECT emp_id || '/' || treatment_id AS rid, \"Control/Test_group\" AS w, "
        f"\"MARKET\" || '/' || \"NATION\" || '/' || \"REGION\" AS cat, '{c}' AS covariate, \"{c}\"::DOUBLE AS x "
        f"FROM rows_" for c in NUM)
    quantiles = " UNION ALL ".join(
        f"SELECT covariate, 'q{k}' AS rule, "
        f"unnest(quantile_cont(x, [{', '.join(repr(j / k) + '::DOUBLE' for j in range(1, k))}])) AS cut "
        f"FROM long_ GROUP BY covariate" for k in (2, 3, 4, 5))
    logs = " UNION ALL ".join(
        f"""SELECT covariate, 'log{c}', CASE WHEN i = 0 THEN lo
              ELSE exp(ln(lo + sh) + i * ln({1 + c}::DOUBLE)) - sh END
            FROM grid, generate_series(0, floor((ln(hi + sh) + ln({1 + c}::DOUBLE) - ln(lo + sh))
                 / ln({1 + c}::DOUBLE) + 1e-10)::INT) g(i)
            WHERE i = 0 OR exp(ln(lo + sh) + i * ln({1 + c}::DOUBLE)) - sh >= 1000"""
        for c in (0.6, 0.5))
    return f"""
info(candidate_no, strategy, name) AS (VALUES {infos}),
rules(candidate_no, covariate, rule) AS (VALUES {rules}),
long_ AS ({long}),
ranges AS (SELECT covariate, min(x) AS lo, max(x) AS hi, count(x) AS n, bool_or(x = 0) AS zero
  FROM long_ GROUP BY covariate),
grid AS (SELECT covariate, lo, hi, CASE WHEN zero THEN 1 - lo ELSE 0 END AS sh FROM ranges
  WHERE zero OR lo > 0),
widths(rule, k) AS (VALUES ('w2', 2), ('w3', 3), ('w4', 4), ('w5', 5)),
sizes AS (SELECT covariate, lo, hi, rule, k FROM ranges, widths
  UNION ALL SELECT covariate, lo, hi, 'sturges', ceil(log2(n))::INT + 1 FROM ranges),
cuts AS (SELECT DISTINCT * FROM ({quantiles}
  UNION ALL SELECT covariate, rule, lo + (hi - lo) * j / k FROM sizes,
            generate_series(1, 20) g(j) WHERE j < k
  UNION ALL {logs})),
used AS (SELECT DISTINCT covariate, rule FROM rules),
bins AS (SELECT l.rid, u.covariate, u.rule, CASE WHEN l.x IS NULL THEN -1 ELSE count(c.cut) END AS bin
  FROM long_ l JOIN used u USING (covariate)
  LEFT JOIN cuts c ON c.covariate = u.covariate AND c.rule = u.rule AND l.x >= c.cut
  GROUP BY l.rid, u.covariate, u.rule, l.x),
placed AS (SELECT r.candidate_no, b.rid, string_agg(b.bin, ',' ORDER BY b.covariate) AS sig
  FROM rules r JOIN bins b USING (covariate, rule) GROUP BY ALL),
units AS (SELECT DISTINCT rid, w, cat FROM long_),
strata AS (SELECT candidate_no, sig, cat, count(*) FILTER (w = 1) AS t, count(*) FILTER (w = 0) AS c
  FROM placed JOIN units USING (rid) GROUP BY ALL),
totals AS (SELECT candidate_no, count(*) AS strata,
    count(*) FILTER (t > 0 AND c > 0) AS usable_strata,
    coalesce(sum(t) FILTER (t > 0 AND c > 0), 0)::BIGINT AS treated,
    coalesce(sum(c) FILTER (t > 0 AND c > 0), 0)::BIGINT AS controls,
    sum(t * t / c::DOUBLE) FILTER (t > 0 AND c > 0) AS tt_c
  FROM strata GROUP BY candidate_no),
places(covariate, place) AS (VALUES {places}),
spread AS (SELECT covariate, stddev_samp(x) AS sd FROM long_ WHERE w = 1 GROUP BY covariate),
weighted AS (SELECT p.candidate_no, l.covariate, l.x, l.w,
    CASE WHEN l.w = 1 THEN 1 ELSE s.t / s.c::DOUBLE END AS wt
  FROM placed p JOIN long_ l USING (rid)
  JOIN strata s ON s.candidate_no = p.candidate_no AND s.sig = p.sig AND s.cat = l.cat
  WHERE s.t > 0 AND s.c > 0),
smds AS (SELECT candidate_no, covariate,
    (sum(x * wt) FILTER (w = 1) / sum(wt) FILTER (w = 1 AND x IS NOT NULL)
     - sum(x * wt) FILTER (w = 0) / sum(wt) FILTER (w = 0 AND x IS NOT NULL)) / any_value(sd) AS smd
  FROM weighted JOIN spread USING (covariate) GROUP BY candidate_no, covariate),
worst AS (SELECT candidate_no, smd, covariate AS name FROM smds JOIN places USING (covariate)
  QUALIFY row_number() OVER (PARTITION BY candidate_no ORDER BY round(abs(smd), 9) DESC, place) = 1),
candidates AS (SELECT candidate_no, strategy AS "Match_Num", i.name AS "Cutpoint",
    (SELECT count(*) FROM rows_) AS "NumOriginal",
    CASE WHEN strategy = 'match_result1' THEN treated + controls
         ELSE coalesce(treated + treated * treated / tt_c, 0) END::DOUBLE AS "NumMatched",
    treated + controls AS rows_matched,
    coalesce(treated + treated * treated / tt_c, 0)::DOUBLE AS effective_matched,
    w.smd AS std_mean_diff_max_matched, w.name AS max_covariate,
    CASE WHEN abs(w.smd) < 0.05 THEN 'Green' WHEN abs(w.smd) < 0.1 THEN 'Yellow'
         WHEN w.smd IS NOT NULL THEN 'Red' END AS "Category"
  FROM totals JOIN info i USING (candidate_no) LEFT JOIN worst w USING (candidate_no)),
""".strip()


CANDIDATES = _candidates()
_CAND_OUT = f"""candidate_no, "Match_Num", "Cutpoint", "NumOriginal",
  {rnd('"NumMatched"', 6)} AS "NumMatched", rows_matched,
  {rnd('effective_matched', 6)} AS effective_matched,
  {rnd('std_mean_diff_max_matched', 6)} AS std_mean_diff_max_matched, max_covariate, "Category",
  {rnd('"NumMatched" / "NumOriginal"', 6)} AS "MatchPercent" """


def halves(source: str = "rows_") -> str:
    """`subclass` of every row: above or below the median of each numeric covariate (equal
    medians collapse), with market and region."""
    parts = " || '|' || ".join(
        f'("{c}" >= (SELECT quantile_cont("{c}"::DOUBLE, 0.5) FROM {source}))::INT::VARCHAR'
        for c in NUM)
    return f"""
sub AS (SELECT *, "Control/Test_group" AS w,
  {parts} || '|' || "MARKET" || '|' || "NATION" || '|' || "REGION" AS subclass FROM {source}),
""".strip()


MATCHED = """
st AS (SELECT subclass, sum(w) AS t, sum(1 - w) AS c FROM sub GROUP BY subclass
  HAVING sum(w) > 0 AND sum(1 - w) > 0),
matched AS (SELECT sub.*, CASE WHEN w = 1 THEN 1.0
    ELSE t / c::DOUBLE * (SELECT sum(c) / sum(t)::DOUBLE FROM st) END::DOUBLE AS wt
  FROM sub JOIN st USING (subclass)),
""".strip()


def long_kpis(source: str, name: str = "kl") -> str:
    parts = " UNION ALL ".join(
        f"""SELECT *, '{k}' AS "KPI", "{k}"::DOUBLE AS y FROM {source}""" for k in KPI)
    return f"{name} AS ({parts}),"


def spread_segments(source: str, columns: list[str], name: str = "sl") -> str:
    parts = [f"""SELECT *, 'Overall' AS "Segment_Name", 'Overall' AS "Segment" FROM {source}"""]
    parts += [f"""SELECT *, '{c}' AS "Segment_Name", "{c}" AS "Segment" FROM {source}"""
              for c in columns]
    return f"{name} AS ({' UNION ALL '.join(parts)}),"


def fit(source: str, by: list[str], name: str = "fit", clustered: bool = True) -> str:
    """Row-level residual regression: stratum means inside the group, then the slope, then
    the score sums per cluster (or per row)."""
    g = ", ".join(f'"{c}"' for c in by)
    clusters = (f"SELECT {g}, subclass, sum(a) AS a, sum(b) AS b FROM {name}_r GROUP BY ALL"
                if clustered else f"SELECT {g}, a, b FROM {name}_r")
    return f"""
{name}_m AS (SELECT {g}, subclass, sum(wt * w) / sum(wt) AS pbar, sum(wt * y) / sum(wt) AS ybar,
    min(w) <> max(w) AS has_both FROM {source} GROUP BY ALL),
{name}_r AS (SELECT {g}, subclass, wt * (w - pbar) * (y - ybar) AS a,
    wt * (w - pbar) * (w - pbar) AS b
  FROM {source} JOIN {name}_m USING ({g}, subclass) WHERE has_both),
{name}_t AS (SELECT {g}, sum(a) / sum(b) AS tau, sum(b) AS bb FROM {name}_r GROUP BY ALL),
{name}_u AS ({clusters}),
{name}_n AS (SELECT {g}, count(*) AS n FROM {source} GROUP BY ALL),
{name}_e AS (SELECT {g}, count(*) AS n_clusters, any_value(tau) AS tau,
    CASE WHEN count(*) > 1 THEN sqrt(sum((u.a - tau * u.b) * (u.a - tau * u.b)) * count(*)
         / (count(*) - 1)) / any_value(bb) END AS se
  FROM {name}_u u JOIN {name}_t USING ({g}) GROUP BY {g}),
{name}_all AS (SELECT {g}, n AS n_rows, coalesce(n_clusters, 0) AS n_clusters, tau, se,
    CASE WHEN n < 5 THEN 'fewer than 5 rows' WHEN tau IS NULL THEN 'no overlap' END AS reason
  FROM {name}_n LEFT JOIN {name}_e USING ({g})),
{name} AS (SELECT * FROM {name}_all WHERE reason IS NULL),
""".strip()


def fixed_number(x: str) -> str:
    return (f"regexp_replace(cast(cast(round_even({x}, 2) AS DECIMAL(38, 2)) AS VARCHAR), "
            r"'\.?0+$', '')")


_LO, _HI = f"(tau - se * {Z})", f"(tau + se * {Z})"
_CI = f"'[' || {fixed_number(_LO)} || ' - ' || {fixed_number(_HI)} || ']'"
_SIG = (f"CASE WHEN {_LO} <= 0 AND {_HI} >= 0 THEN 'Not Significant' "
        f"WHEN {_LO} > 0 OR {_HI} < 0 THEN 'Significant' END")


def effect_columns(digits: int = 3) -> str:
    return f"""{rnd('tau', digits)} AS "Average_treatment_effect",
  {rnd('se', digits)} AS "Standard_Error", {rnd(_LO, digits)} AS ci_low,
  {rnd(_HI, digits)} AS ci_high, {_CI} AS "CI", {_SIG} AS "Significance" """


SEGMENT_FIT = "\n".join([
    STUDY, SHAPED, ROWS, halves(), MATCHED, long_kpis("matched"),
    spread_segments("kl", SEGMENTS),
    fit("sl", ["treatment_id", "Segment_Name", "Segment", "KPI"])])

FINAL = f"""
final AS (SELECT label AS treatment_label, "KPI", "Segment_Name" AS seg_col, "Segment" AS seg_val,
    round_even(greatest(tau, 0), 2) + 0.0::DOUBLE AS ate,
    CASE WHEN greatest(tau, 0) = 0 THEN 0 ELSE round_even(se, 2) END::DOUBLE AS se2,
    CASE WHEN greatest(tau, 0) = 0 THEN '[0,0]' ELSE {_CI} END AS ci, {_SIG} AS sig
  FROM (SELECT * REPLACE (CASE WHEN abs(tau) <= 1e-9 THEN 0 ELSE tau END AS tau) FROM fit)
  JOIN treatments USING (treatment_id)),
overall AS (SELECT * FROM final WHERE seg_val = 'Overall'),
segs AS (SELECT * FROM final WHERE seg_val <> 'Overall'),
""".strip()

_PUB = """ate AS "Average_treatment_effect", se2 AS "Standard_Error", ci AS "CI",
  sig AS "Significance", 'customer_orders' AS project_name"""

# --- flagship -----------------------------------------------------------------------------

BASE = """
pc AS (SELECT o_custkey::VARCHAR AS "EMP_ID",
    max(CASE WHEN o_orderpriority = '1-URGENT' AND o_orderdate >= TIMESTAMP '1998-01-01'
        AND o_orderdate < TIMESTAMP '1998-07-01' THEN 1 ELSE 0 END) AS w,
    sum(round(o_totalprice * 100)::BIGINT) FILTER (o_orderdate < TIMESTAMP '1998-01-01')::BIGINT
      / 100 AS pre_kpi,
    sum(round(o_totalprice * 100)::BIGINT) FILTER (o_orderdate >= TIMESTAMP '1998-07-01')::BIGINT
      / 100 AS post_kpi
  FROM orders GROUP BY o_custkey),
base AS (SELECT pc.*, c_mktsegment AS "MARKET", r_name AS "REGION"
  FROM pc JOIN customer ON c_custkey::VARCHAR = "EMP_ID" JOIN nation ON c_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey WHERE pre_kpi IS NOT NULL AND post_kpi IS NOT NULL),
cut5 AS (SELECT unnest(quantile_cont(pre_kpi, [0.2, 0.4, 0.6, 0.8])) AS cut FROM base),
sub AS (SELECT *, 'post_kpi' AS "KPI", post_kpi AS y, 'URGENT_1998H1' AS treatment_id,
    (SELECT count(DISTINCT cut) FROM cut5 WHERE pre_kpi >= cut)::VARCHAR || '|' || "MARKET" || '|'
      || "REGION" AS subclass FROM base),
""".strip()

# --- text of the queries --------------------------------------------------------------------


def _mismatch_sql() -> str:
    return """
SELECT column_name, expected, mismatches FROM (VALUES
  ('key_text', 'int', (SELECT count(*) FROM orders WHERE try_cast(o_custkey::VARCHAR AS BIGINT) IS NULL)),
  ('priority_as_date', 'timestamp', (SELECT count(*) FROM orders
     WHERE try_strptime(o_orderpriority, '%Y-%m-%d') IS NULL AND try_strptime(o_orderpriority, '%m-%d-%Y') IS NULL)),
  ('us_date', 'timestamp', (SELECT count(*) FROM orders
     WHERE try_strptime(strftime(o_orderdate, '%m-%d-%Y'), '%m-%d-%Y') IS NULL)),
  ('status_as_int', 'int', (SELECT count(*) FROM orders WHERE try_cast(o_orderstatus AS DOUBLE) IS NULL))
) t(column_name, expected, mismatches)"""


def _daily() -> str:
    return """
daily AS (SELECT o_custkey::VARCHAR AS emp_id, 'URGENT_1998H1' AS treatment_id, l_shipdate AS date,
    l_quantity::BIGINT AS units, round(l_extendedprice * 100)::BIGINT AS cents
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey),"""


def _daily_windows() -> str:
    start, end = "TIMESTAMP '1998-01-01'", "TIMESTAMP '1998-06-30'"
    lead = f"floor(epoch({start} - date) / 86400)::INT"
    after = f"floor(epoch(date - {end}) / 86400)::INT"
    parts = []
    for status, days, cond in (
        [("pre", d, f"lead > 0 AND {_SNAP.format(d='lead')} <= {d}") for d in (90, 360)]
        + [("post", d, f"lead <= 0 AND late BETWEEN 0 AND {d}") for d in (30, 60, 90)]):
        parts.append(
            f"SELECT '{status}' AS status, emp_id, treatment_id, sum(units)::BIGINT AS \"Units\", "
            f"max(cents) AS \"Line Cents\", min(date) AS start_date, max(date) AS end_date, "
            f"{days} AS date_diff FROM dl WHERE {cond} GROUP BY emp_id, treatment_id")
    return query(_daily(), f"dl AS (SELECT *, {lead} AS lead, {after} AS late FROM daily),",
                 select=" UNION ALL ".join(parts))


def _null_pct() -> str:
    columns = ["emp_id", "treatment_allocated_date", "treatment_allocated_end_date",
               "treatment_id", "treatment_label_taken", "start_date_of_treatment_taken",
               "end_date_of_treatment_taken"]
    parts = [f"SELECT '{c}' AS column_name, "
             + rnd(f"100.0::DOUBLE * (count(*) - count({c})) / count(*)", 6)
             + " AS null_pct FROM universe" for c in columns]
    return query(STUDY, select=" UNION ALL ".join(parts))


def _duplicates(table: str, columns: str) -> str:
    return (f"SELECT '{table}' AS table_name, sum(n)::BIGINT AS n_rows, count(*) AS distinct_rows, "
            + rnd("100.0::DOUBLE * (sum(n) - count(*)) / sum(n)", 6)
            + f" AS duplicate_pct FROM (SELECT count(*) AS n FROM {table} GROUP BY {columns})")


def _iqr(table: str, column: str, name: str | None = None) -> str:
    a, b = (f"(SELECT quantile_cont({column}, {p}) FROM {table})" for p in (0.25, 0.75))
    bad = (f"count(*) FILTER ({column} < {a} - 1.5::DOUBLE * ({b} - {a}) "
           f"OR {column} > {b} + 1.5::DOUBLE * ({b} - {a}))")
    return (f"SELECT '{name or column}' AS column_name, {bad} AS outliers, "
            f"round_even({bad} / count(*) * 100, 2) AS outlier_pct FROM {table}")


_PROFILE_TABLES = """
raw_p AS (SELECT emp_id AS "EMP_ID", treatment_id AS "OFFERING_ID", start_date AS "START_DATE",
  end_date AS "END_DATE", "Order Value", "Order Count", "% Open Orders", "ACCTBAL", "LIFETIME" FROM pop),
raw_t AS (SELECT emp_id AS "EMP_ID", t0 AS "DATE_START_TREATMENT_TAKEN",
  t1 AS "DATE_END_TREATMENT_TAKEN", k.label AS "OFFERING_LABEL", treatment_id AS "OFFERING_ID",
  a AS "START_DATE", b AS "END_DATE" FROM taken k JOIN treatments USING (treatment_id)),
raw_s AS (SELECT emp_id AS "EMP_ID", "MARKET", "NATION", "REGION" FROM seg),"""


def _profile_select() -> str:
    columns = {
        "raw_p": ["EMP_ID", "OFFERING_ID", "START_DATE", "END_DATE", *KPI, "ACCTBAL", "LIFETIME"],
        "raw_t": ["EMP_ID", "DATE_START_TREATMENT_TAKEN", "DATE_END_TREATMENT_TAKEN",
                  "OFFERING_LABEL", "OFFERING_ID", "START_DATE", "END_DATE"],
        "raw_s": ["EMP_ID", "MARKET", "NATION", "REGION"]}
    names = {"raw_p": "population", "raw_t": "treatment", "raw_s": "segment"}
    parts = []
    for t, cols in columns.items():
        for c in cols:
            v = f'100.0::DOUBLE * (count(*) - count("{c}")) / count(*)'
            parts.append(f"SELECT '{names[t]}' AS table_name, '{c}' AS column_name, 'null_pct' AS "
                         f"metric, {rnd(v, 6)} AS value, ({v} > 10)::INT AS flagged FROM {t}")
        v = "100.0::DOUBLE * (sum(n) - count(*)) / sum(n)"
        parts.append(f"SELECT '{names[t]}', '*', 'duplicate_pct', {rnd(v, 6)}, ({v} > 0)::INT "
                     f"FROM (SELECT count(*) AS n FROM {t} GROUP BY ALL)".replace(
                         "GROUP BY ALL", "GROUP BY " + ", ".join(f'"{c}"' for c in cols)))
    for c in ("ACCTBAL", "LIFETIME"):
        parts.append(f"SELECT 'population', column_name, 'outlier_pct', outlier_pct, "
                     f"(outlier_pct >= 5)::INT FROM ({_iqr('raw_p', c)})")
    return " UNION ALL ".join(parts)


def _validation() -> str:
    ids = ["URGENT_1998H1", "HIGH_1998H1", "URGENT_1998H2"]
    dates = ["treatment_allocated_date", "treatment_allocated_end_date",
             "start_date_of_treatment_taken", "end_date_of_treatment_taken"]
    parts = [
        "SELECT 'kpis_configured' AS check_id, 'config' AS entity, 'ok' AS status, 3::BIGINT AS metric, "
        "'KPIs configured' AS message",
        "SELECT 'kpi_columns', 'population', 'ok', 0, 'KPI columns missing'",
        "SELECT 'renamed_columns', 'treatment', 'ok', 0, 'mapped columns missing'"]
    parts += [f"SELECT 'treatment_rows', '{i}', 'failed', 0, 'configured treatment has no rows' "
              f"WHERE NOT EXISTS (SELECT 1 FROM universe WHERE treatment_id = '{i}')" for i in ids]
    parts += [f"SELECT 'types', '{d}', 'ok', 0, 'values that do not fit the column type'"
              for d in dates]
    kpi_null = " OR ".join(f'"{k}" IS NULL' for k in KPI)
    parts += [
        f"SELECT 'null_rows', 'KPI values', CASE WHEN count(*) > 0 THEN 'failed' ELSE 'ok' END, "
        f"count(*), 'rows lost to nulls' FROM pop WHERE {kpi_null}",
        "SELECT 'null_rows', 'keys and dates', CASE WHEN count(*) > 0 THEN 'failed' ELSE 'ok' END, "
        "count(*), 'rows lost to nulls' FROM pop WHERE emp_id IS NULL OR start_date IS NULL OR "
        "end_date IS NULL",
        "SELECT 'sufficiency', concat_ws(' ', treatment_id, period, days::VARCHAR), "
        "CASE WHEN ok = 0 THEN 'failed' ELSE 'ok' END, available, 'rows available' FROM enough",
        "SELECT 'two_groups', 'eligibility', CASE WHEN count(DISTINCT f) = 2 THEN 'ok' ELSE 'failed' "
        "END, count(DISTINCT f), 'treated and control present' FROM (SELECT "
        "end_date_of_treatment_taken IS NULL AS f FROM universe)"]
    return query(STUDY, SHAPED, _sufficiency("enough", (720,), (30, 60, 720)),
                 select=" UNION ALL ".join(parts))


def _sufficiency(name: str, pre_days, post_days) -> str:
    parts = [f"SELECT t.treatment_id, 'pre' AS period, {d} AS days, count(p.emp_id) FILTER "
             f"(date_diff('day', p.start_date, t.a) <= {d}) AS available, 10 AS need "
             f"FROM treatments t LEFT JOIN pre p USING (treatment_id) GROUP BY ALL"
             for d in pre_days]
    parts += [f"SELECT t.treatment_id, 'post', {d}, count(p.emp_id) FILTER "
              f"(date_diff('day', t.b, p.end_date) = {d}), 1 "
              f"FROM treatments t LEFT JOIN post p USING (treatment_id) GROUP BY ALL"
              for d in post_days]
    return (f"{name} AS (SELECT treatment_id, period, days, available, "
            f"(available >= need)::INT AS ok FROM ({' UNION ALL '.join(parts)})),")


def _log_cuts() -> str:
    return query(
        "x AS (SELECT 'l_extendedprice' AS column_name, l_extendedprice AS v FROM lineitem UNION ALL "
        "SELECT 'reduced', l_extendedprice * ceil(l_discount) FROM lineitem),",
        "r AS (SELECT column_name, min(v) AS lo, max(v) AS hi, CASE WHEN bool_or(v = 0) THEN "
        "1 - min(v) ELSE 0 END AS sh, ln(1.6::DOUBLE) AS st FROM x GROUP BY column_name),",
        "g AS (SELECT column_name, i::INT AS cut_no, CASE WHEN i = 0 THEN lo ELSE "
        "exp(ln(lo + sh) + i * st) - sh END AS cut FROM r, generate_series(0, 100) s(i) "
        "WHERE i <= floor((ln(hi + sh) + st - ln(lo + sh)) / st + 1e-10)),",
        select=f"SELECT column_name, cut_no, {rnd('cut', 3)} AS cut FROM g "
               "WHERE cut_no = 0 OR cut >= 1000")


def _rank_auc(source: str, by: str, score: str, y: str) -> str:
    """Average-rank form of the rank-sum statistic."""
    return f"""
SELECT {by}, {rnd("(sum(rk) FILTER (pos = 1) - sum(pos) * (sum(pos) + 1) / 2.0::DOUBLE) / (sum(pos) * (count(*) - sum(pos)))", 9)} AS auc
FROM (SELECT {by}, {y} AS pos, rank() OVER (PARTITION BY {by} ORDER BY {score})
      + (count(*) OVER (PARTITION BY {by}, {score}) - 1) / 2.0::DOUBLE AS rk FROM {source})
GROUP BY {by}"""


SCORED = """
scored AS (SELECT *, ("LIFETIME" + 1) / ("LIFETIME" + "Order Count_pre" + 10) AS probability,
  (("LIFETIME" + 1) / ("LIFETIME" + "Order Count_pre" + 10) > 0.45::DOUBLE)::INT AS predictions,
  "Control/Test_group" AS w FROM rows_),
""".strip()


def _arbitrate() -> str:
    g = ["treatment_id", "Segment_Name", "Segment", "KPI"]

    def auc(source: str, name: str) -> str:
        by = '"treatment_id", "Segment_Name", "Segment"'
        return f"""
{name}_s AS (SELECT {by}, subclass, w, avg(w) OVER (PARTITION BY {by}, subclass) AS sc
  FROM {source} WHERE "KPI" = 'Order Value'),
{name} AS (SELECT {by}, (sum(rk) FILTER (w = 1) - sum(w) * (sum(w) + 1) / 2.0::DOUBLE)
    / nullif(sum(w) * (count(*) - sum(w)), 0) AS auc
  FROM (SELECT *, rank() OVER (PARTITION BY {by} ORDER BY sc)
        + (count(*) OVER (PARTITION BY {by}, sc) - 1) / 2.0::DOUBLE AS rk FROM {name}_s)
  GROUP BY {by}),"""

    weighted = ("wsub AS (SELECT *, (\"LIFETIME\" + 1) / (\"LIFETIME\" + \"Order Count_pre\" + 10) "
                "AS wt FROM sub),")
    take = ("CASE WHEN b.reason IS NULL AND NOT coalesce(a.n_rows > 0 AND a.reason IS NULL AND x.auc > y.auc, "
            "false) THEN 'weighted' WHEN a.n_rows > 0 AND a.reason IS NULL THEN 'matched' END")
    choose = lambda a, b: f"(CASE fit WHEN 'matched' THEN {a} WHEN 'weighted' THEN {b} END)"
    keys = ", ".join(ident(c) for c in g)
    known = "coalesce(a.n_rows > 0 AND a.reason IS NULL, false)"
    return query(
        STUDY, SHAPED, ROWS, halves(), MATCHED, weighted,
        long_kpis("matched", "kl"), spread_segments("kl", SEGMENTS, "sl"), fit("sl", g, "fa"),
        long_kpis("wsub", "wk"), spread_segments("wk", SEGMENTS, "ws"),
        fit("ws", g, "fb", clustered=False), auc("sl", "auca"), auc("ws", "aucb"), f"""
both_ AS (SELECT {keys}, {take} AS fit, a.tau AS ta, b.tau AS tb, a.se AS sa, b.se AS sb,
    a.n_rows AS na, b.n_rows AS nb, CASE WHEN {known} THEN x.auc END AS xa,
    CASE WHEN b.reason IS NULL THEN y.auc END AS ya,
    coalesce(b.reason, a.reason, 'no matched rows') AS why
  FROM fb_all b LEFT JOIN fa_all a USING ({keys})
  LEFT JOIN auca x USING ("treatment_id", "Segment_Name", "Segment")
  LEFT JOIN aucb y USING ("treatment_id", "Segment_Name", "Segment")
  WHERE "Segment" IS NOT NULL),""",
        select=f"""
SELECT {keys}, {rnd(choose('ta', 'tb'), 3)} AS "Average_treatment_effect",
  {rnd(choose('sa', 'sb'), 3)} AS "Standard_Error", {rnd(choose('xa', 'ya'), 3)} AS auc,
  {choose('na', 'nb')} AS n_rows, fit,
  {rnd('CASE WHEN fit IS NOT NULL THEN xa END', 3)} AS auc_matched,
  {rnd('CASE WHEN fit IS NOT NULL THEN ya END', 3)} AS auc_weighted,
  CASE WHEN fit IS NULL THEN why END AS reason FROM both_""")


def _effect_by_treatment() -> str:
    # Medians are taken over all rows; strata and weights within each treatment.
    st = """
st AS (SELECT treatment_id, subclass, sum(w) AS t, sum(1 - w) AS c FROM sub GROUP BY ALL
  HAVING sum(w) > 0 AND sum(1 - w) > 0),
sc AS (SELECT treatment_id, sum(c) / sum(t)::DOUBLE AS scale FROM st GROUP BY treatment_id),
matched AS (SELECT sub.*, CASE WHEN w = 1 THEN 1.0 ELSE t / c::DOUBLE * scale END::DOUBLE AS wt
  FROM sub JOIN st USING (treatment_id, subclass) JOIN sc USING (treatment_id)),"""
    return query(
        STUDY, SHAPED, ROWS, halves(), st, long_kpis("matched"), fit("kl", ["treatment_id", "KPI"]),
        select=f"""SELECT treatment_id, "KPI", n_rows, n_clusters,
  {rnd('tau', 3)} AS "Average_treatment_effect", {rnd('se', 3)} AS "Standard_Error",
  reason, 'Overall' AS "Segment_Name", 'Overall' AS "Segment" FROM fit_all""")


def _r2() -> str:
    parts = []
    for d in (30, 60, 720):
        cells = ", ".join(
            rnd(f"""1 - sum(power("{k}" - "{k}_pre" / 2, 2)) / (var_pop("{k}") * count(*))""", 6)
            + f' AS "{k}"' for k in KPI)
        parts.append(f"SELECT {d} AS days, {cells} FROM rows_{d}")
    return query(STUDY, SHAPED, *[outcome(f"rows_{d}", d) for d in (30, 60, 720)],
                 select=" UNION ALL ".join(parts))


def _causal_tree() -> str:
    """Even employees choose the split of the root, odd ones give the effects of its sides."""
    cuts = {"ACCTBAL": (0, 2500, 5000, 7500), "LIFETIME": (4, 8, 12, 16),
            "Order Count_pre": (2, 4, 6, 8)}
    w = '"Control/Test_group"'
    long = " UNION ALL ".join(
        f"""SELECT '{k}' AS "KPI", emp_id::BIGINT % 2 AS half, "ACCTBAL", "LIFETIME", "Order Count_pre",
            {w} - avg({w}) OVER (PARTITION BY treatment_id) AS d,
            "{k}" - avg("{k}") OVER (PARTITION BY treatment_id) AS y FROM rows_""" for k in KPI)
    places = ", ".join(f"({i}, '{f}', {c}.0::DOUBLE)" for i, (f, cs) in enumerate(cuts.items()) for c in cs)
    value = "CASE c.feature " + " ".join(f"WHEN '{f}' THEN r.\"{f}\"" for f in cuts) + " END"
    moments = "count(*) AS n, sum(d) AS d, sum(y) AS y, sum(d * y) AS dy, sum(d * d) AS dd"
    spread = lambda t, m: f"({t}dd - 2 * {m}d / {m}n * {t}d + ({m}d / {m}n) * ({m}d / {m}n) * {t}n)"
    cross = lambda t, m: (f"({t}dy - {m}d / {m}n * {t}y - {m}y / {m}n * {t}d "  # noqa: E731
                          f"+ {t}n * ({m}d / {m}n) * ({m}y / {m}n))")
    rho = lambda t: f"({cross(t, 'a.')} - {cross('a.', 'a.')} / {spread('a.', 'a.')} * {spread(t, 'a.')})"
    return f"""res AS (SELECT * FROM ({long}) WHERE y IS NOT NULL),
places(f, feature, cut) AS (VALUES {places}),
sides AS (
  SELECT r."KPI", half, f, c.feature, cut, ({value} IS NULL OR {value} < cut) AS is_left, {moments}
  FROM res r, places c GROUP BY ALL),
whole AS (SELECT "KPI", half, {moments} FROM res GROUP BY "KPI", half),
gains AS (
  SELECT l."KPI", l.f, l.feature, l.cut, {rho('l.')} * {rho('l.')} / l.n + {rho('r.')} * {rho('r.')} / r.n AS gain
  FROM sides l JOIN sides r USING ("KPI", half, f, cut) JOIN whole a USING ("KPI", half)
  WHERE half = 0 AND l.is_left AND NOT r.is_left AND least(l.n, r.n) >= 5
    AND least({spread('l.', 'l.')}, {spread('r.', 'r.')}) >= 0.05 * {spread('a.', 'a.')}),
chosen AS (
  SELECT *, row_number() OVER (PARTITION BY "KPI" ORDER BY gain DESC, f, cut) AS k FROM gains QUALIFY k = 1),
nodes AS (
  SELECT 1 AS node, w."KPI", c.feature, c.cut, w.* EXCLUDE ("KPI", half)
  FROM whole w LEFT JOIN chosen c USING ("KPI") WHERE half = 1
  UNION ALL
  SELECT CASE WHEN is_left THEN 2 ELSE 3 END, "KPI", NULL, NULL, s.n, s.d, s.y, s.dy, s.dd
  FROM sides s JOIN chosen USING ("KPI", f, cut) WHERE half = 1),
effects AS (SELECT *, {cross('', '')} / {spread('', '')} AS tau FROM nodes),"""


_CAUSAL_OUT = f"""SELECT node::INTEGER AS node, "KPI", feature, cut, n, {rnd('tau', 4)} AS effect FROM effects"""


_EMP_HASH = "(emp_id::BIGINT % 2147483648) * 2654435761 % 4294967296"


def _propensity_cells() -> str:
    """Newton's steps on two coefficients per treatment."""
    steps = ["""curve0(treatment_id, a, b) AS (
  SELECT DISTINCT treatment_id, 0::DOUBLE, 0::DOUBLE FROM train)"""]
    for i in range(16):
        steps.append(f"""
curve{i + 1} AS MATERIALIZED (
  SELECT treatment_id, a + coalesce((hxx * g - hx * gx) / nullif(det, 0), 0) AS a,
         b + coalesce((h * gx - hx * g) / nullif(det, 0), 0) AS b FROM (
    SELECT *, h * hxx - hx * hx AS det FROM (
      SELECT treatment_id, any_value(a) AS a, any_value(b) AS b, sum(p * (1 - p)) AS h,
             sum(p * (1 - p) * x) AS hx, sum(p * (1 - p) * x * x) AS hxx, sum(y - p) AS g,
             sum((y - p) * x) AS gx
      FROM (SELECT t.*, a, b, 1 / (1 + exp(-(a + b * x))) AS p FROM train t JOIN curve{i} USING (treatment_id))
      GROUP BY treatment_id)))""")
    return query(STUDY, SHAPED, f"""
split AS (SELECT emp_id, treatment_id, "LIFETIME" AS x, "Control/Test_group"::DOUBLE AS y,
  ({_EMP_HASH} < 0.33::DOUBLE * 4294967296)::INT AS is_test FROM feats),
train AS (SELECT * FROM split WHERE is_test = 0), {",".join(steps)},
scored AS (SELECT *, 1 / (1 + exp(-(a + b * x))) AS p FROM split JOIN curve16 USING (treatment_id)),
f1 AS (SELECT 2 * count(*) FILTER (p > 0.5 AND y = 1) / nullif(2 * count(*) FILTER (p > 0.5 AND y = 1)
  + count(*) FILTER ((p > 0.5) <> (y = 1)), 0)::DOUBLE AS f1 FROM scored WHERE is_test = 1),""", select=f"""
SELECT emp_id, treatment_id, is_test, {rnd('p', 6)} AS probability, (p > 0.5)::INT AS predictions,
  {rnd('f1', 6)} AS f1 FROM scored, f1""")


_KPI_LONG = " UNION ALL ".join(
    f"SELECT emp_id, treatment_id, is_test, x, \"Control/Test_group\" AS w, '{k}' AS \"KPI\", "
    f"\"{k}\"::DOUBLE AS y FROM split" for k in KPI)
_KPI_LINES = f"""
split AS (SELECT *, ({_EMP_HASH} < 0.33::DOUBLE * 4294967296)::INT AS is_test, "LIFETIME" AS x FROM rows_),
kl AS ({_KPI_LONG}),
line AS (SELECT "KPI", treatment_id, regr_slope(y, x) AS b, regr_intercept(y, x) AS a FROM kl
  WHERE w = 1 AND is_test = 0 GROUP BY ALL),
scored AS (SELECT kl.*, a, b, a + b * x AS p FROM kl JOIN line USING ("KPI", treatment_id)),
"""


_FACTS = f"""
tn AS (SELECT *, (w = predictions)::INT AS hit FROM scored),
splitk AS (SELECT *, ({_EMP_HASH} < 0.33::DOUBLE * 4294967296)::INT AS is_test, "LIFETIME" AS x FROM scored),
lk AS (SELECT treatment_id, regr_slope("{KPI[0]}", x) AS b, regr_intercept("{KPI[0]}", x) AS a FROM splitk
  WHERE w = 1 AND is_test = 0 GROUP BY ALL),
sk AS (SELECT stddev_pop(a) AS sa, stddev_pop(b * x) AS sb FROM splitk JOIN lk USING (treatment_id)
  WHERE w = 1 AND "{KPI[0]}" IS NOT NULL),
imp AS (SELECT 'treatment_id' AS feature, round_even(sa / (sa + sb), 2) AS importance FROM sk
  UNION ALL SELECT 'LIFETIME', round_even(sb / (sa + sb), 2) FROM sk),
facts AS (
  SELECT 'confusion_pct' AS section, 'actual ' || a || ' predicted ' || p AS item,
         round_even(count(*) FILTER (w = a AND predictions = p) / count(*) * 100, 2) AS value
  FROM scored, (VALUES (0), (1)) v(a), (VALUES (0), (1)) u(p) GROUP BY a, p
  UNION ALL SELECT 'accuracy', 'all rows', round_even(avg(hit), 2) FROM tn
  UNION ALL SELECT 'f1', 'holdout', round_even(2 * count(*) FILTER (w = 1 AND predictions = 1)
    / (2 * count(*) FILTER (w = 1 AND predictions = 1) + count(*) FILTER (hit = 0)), 2) FROM tn
  UNION ALL {" UNION ALL ".join(f'''SELECT 'r2', '720 days {k}',
    round_even(1 - sum(power("{k}" - "{k}_pre" / 2, 2)) / (var_pop("{k}") * count(*)), 2) FROM scored
    WHERE "{k}" IS NOT NULL AND "{k}_pre" IS NOT NULL''' for k in KPI)}
  UNION ALL SELECT 'top_feature', feature, importance FROM imp),
"""


def _insights() -> str:
    n = fixed_number
    whole = lambda x: n(f"round_even({x}, 0)")
    return f"""
profile AS ({_profile_select()}),
ranked AS (SELECT *, rank() OVER (PARTITION BY treatment_label, seg_val ORDER BY ate DESC)
  + (count(*) OVER (PARTITION BY treatment_label, seg_val, ate) - 1) / 2.0::DOUBLE AS rk FROM segs),
top_ AS (SELECT * FROM ranked WHERE rk = 1 AND sig = 'Significant'
  ORDER BY ate DESC, treatment_label, "KPI", seg_col, seg_val LIMIT 10),
most AS (SELECT * FROM segs WHERE sig = 'Significant' AND ate > 1000 QUALIFY row_number() OVER (
  PARTITION BY treatment_label, seg_col, "KPI"
  ORDER BY ate DESC, se2 NULLS FIRST, ci NULLS FIRST, sig NULLS FIRST, seg_val) = 1),
best_ AS (SELECT * FROM overall QUALIFY row_number() OVER (
  PARTITION BY "KPI" ORDER BY ate DESC, treatment_label, sig NULLS FIRST) = 1),
counts_ AS (SELECT "KPI", count(*) FILTER (ate <= 0) AS none,
  coalesce(string_agg(treatment_label, ', ' ORDER BY treatment_label) FILTER (ate <= 0), '') AS none_names,
  count(*) FILTER (sig = 'Significant') AS hits,
  coalesce(string_agg(treatment_label, ', ' ORDER BY treatment_label) FILTER (sig = 'Significant'), '')
    AS hit_names FROM overall GROUP BY "KPI"),
said(c, s) AS (
  SELECT 'Data_Quality_Insights', {n('value')} || '% ' || CASE metric WHEN 'null_pct' THEN 'missing values'
    WHEN 'duplicate_pct' THEN 'duplicate rows' ELSE 'outliers' END || ' in ' || table_name
    || CASE column_name WHEN '*' THEN '' ELSE ' ' || column_name END FROM profile WHERE flagged = 1
  UNION ALL SELECT 'Classification_Model_insights', {n('value')} || '% of all rows are ' || item FROM facts
    WHERE section = 'confusion_pct'
  UNION ALL SELECT 'Classification_Model_insights', CASE section WHEN 'f1' THEN 'F1' ELSE section END || ' ('
    || item || '): ' || coalesce({n('value')}, 'not known') FROM facts WHERE section IN ('accuracy', 'f1')
  UNION ALL SELECT 'Regression_Model_insights', 'R2 at ' || item || ': ' || coalesce({n('value')}, 'not known')
    FROM facts WHERE section = 'r2'
  UNION ALL SELECT 'Feature_importance_insights', feature || ' has an importance of ' || {n('importance')} FROM imp
  UNION ALL SELECT 'Matching_insights', treatment_label || ' has its best significant effect in ' || seg_col
    || ' ' || seg_val || ': ' || {n('ate')} || ' on ' || "KPI" FROM top_
  UNION ALL SELECT 'Matching_insights', 'For ' || treatment_label || ' the effect on ' || "KPI"
    || ' is largest in ' || seg_col || ' ' || seg_val || ' (' || {n('ate')} || ')' FROM most
  UNION ALL SELECT 'Matching_insights', treatment_label || ' has the best average effect on ' || "KPI" || ': '
    || {whole('ate')} || ' (' || sig || ')' FROM best_
  UNION ALL SELECT 'Matching_insights', none || ' treatments had no impact on ' || "KPI" || ': ' || none_names
    FROM counts_
  UNION ALL SELECT 'Matching_insights', hits || ' treatments had a significant effect on ' || "KPI" || ': '
    || hit_names FROM counts_),
"""


_ROWS = (STUDY, SHAPED, ROWS)
_POPULATION = """emp_id, treatment_id, start_date, end_date, "Order Value", "Order Count",
  "% Open Orders\""""
_SEG_OUT = '"treatment_id", "Segment_Name", "Segment", "KPI"'
_FIT_OUT = f"""n_rows, n_clusters, {rnd('tau', 3)} AS "Average_treatment_effect",
  {rnd('se', 3)} AS "Standard_Error", reason"""
_HASH = "(c_custkey % 2147483648) * 2654435761 % 4294967296"
_OHASH = "(o_orderkey % 2147483648) * 2654435761 % 4294967296"

ORACLE: dict[str, str] = {
    "cem_flagship": query(
        BASE, MATCHED, spread_segments("matched", ["MARKET"]),
        fit("sl", ["treatment_id", "Segment_Name", "Segment", "KPI"]),
        select=f'SELECT "KPI", treatment_id, "Segment_Name", "Segment", {effect_columns()}, reason FROM fit_all'),
    "cem_weights": query(BASE, MATCHED, select=(
        f'SELECT "EMP_ID", w, subclass, {rnd("wt", 9)} AS weights FROM matched')),
    "balance_smd": query(BASE, MATCHED, """
m AS (SELECT sum(pre_kpi * wt) FILTER (w = 1) / sum(wt) FILTER (w = 1) AS mt,
  sum(pre_kpi * wt) FILTER (w = 0) / sum(wt) FILTER (w = 0) AS mc,
  (SELECT stddev_samp(pre_kpi) FROM base WHERE w = 1) AS sd FROM matched),""", select=f"""
SELECT 'pre_kpi' AS covariate, {rnd('mt', 4)} AS mean_treated, {rnd('mc', 4)} AS mean_control,
  {rnd('(mt - mc) / sd', 4)} AS smd, CASE WHEN abs((mt - mc) / sd) < 0.05 THEN 'Green'
  WHEN abs((mt - mc) / sd) < 0.1 THEN 'Yellow' ELSE 'Red' END AS "Category" FROM m"""),
    "treatment_universe": query(STUDY, select="SELECT * FROM universe"),
    "control_flag": query(STUDY, select="""
SELECT treatment_id, (end_date_of_treatment_taken IS NOT NULL)::INT AS flag, count(*) AS n,
  count(DISTINCT emp_id) AS employees FROM universe GROUP BY ALL"""),
    "kpi_rename_project": query(STUDY, select="SELECT * FROM pop"),
    "type_mismatch": _mismatch_sql(),
    "drop_nulls_report": """
WITH o AS (SELECT o_orderstatus = 'P' OR o_orderpriority = '5-LOW' AS a, o_orderstatus <> 'F' AS b
  FROM orders)
SELECT 'KPI values' AS step, count(*) FILTER (a) AS rows_lost FROM o UNION ALL
SELECT 'keys and dates', count(*) FILTER (NOT a AND b) FROM o UNION ALL
SELECT 'rows kept', count(*) FILTER (NOT a AND NOT b) FROM o""",
    "treatment_filter": query(STUDY, select="""
SELECT i.treatment_id, count(u.emp_id) AS n FROM
  (VALUES ('URGENT_1998H1'), ('HIGH_1998H1'), ('NEVER_OFFERED')) i(treatment_id)
  LEFT JOIN (SELECT DISTINCT * FROM universe) u USING (treatment_id) GROUP BY ALL"""),
    "dedupe_first": """
SELECT o_custkey, o_orderpriority, o_orderdate, o_orderkey, o_orderstatus FROM orders
QUALIFY row_number() OVER (PARTITION BY o_custkey, o_orderpriority
  ORDER BY o_orderdate, o_orderkey) = 1""",
    "winsorize": "SELECT l_orderkey, l_linenumber, l_partkey, " + ", ".join(
        f"round(least(greatest({c}, (SELECT quantile_cont({c}, 0.01) FROM lineitem)), "
        f"(SELECT quantile_cont({c}, 0.99) FROM lineitem)), 4) AS {c}"
        for c in ("l_extendedprice", "l_quantity")) + " FROM lineitem",
    "grain_detect": query(STUDY, _daily(), select="""
SELECT table_name, max(n) AS max_rows, CASE WHEN max(n) > 20 THEN 'daily' ELSE 'agg' END AS grain
FROM (SELECT 'lines' AS table_name, count(*) AS n FROM daily GROUP BY emp_id, treatment_id
  UNION ALL SELECT 'windows', count(*) FROM pop GROUP BY emp_id, treatment_id) GROUP BY table_name"""),
    "kpi_daily_agg": query(_daily(), select="""
SELECT emp_id, treatment_id, median(units)::DOUBLE AS "Units", sum(cents)::BIGINT AS "Line Cents",
  min(date) AS start_date, max(date) AS end_date FROM daily GROUP BY emp_id, treatment_id"""),
    "daily_medians": query(_daily(), select="""
SELECT emp_id, treatment_id, median(units)::DOUBLE AS "Units", median(cents)::DOUBLE AS "Line Cents",
  min(date) AS start_date, max(date) AS end_date FROM daily GROUP BY emp_id, treatment_id"""),
    "quantile_brackets": f"""
WITH long AS (
  SELECT 'l_extendedprice' AS name, l_extendedprice::DOUBLE AS x FROM lineitem UNION ALL
  SELECT 'l_partkey', l_partkey::DOUBLE FROM lineitem UNION ALL
  SELECT 'volume', l_extendedprice * l_quantity FROM lineitem),
found AS (SELECT name, p, quantile_cont(x, [0.01::DOUBLE, 0.25::DOUBLE, 0.5::DOUBLE, 0.99::DOUBLE])[i] AS v
  FROM long, (VALUES (1, 0.01::DOUBLE), (2, 0.25::DOUBLE), (3, 0.5::DOUBLE), (4, 0.99::DOUBLE)) t(i, p)
  GROUP BY name, p, i)
SELECT name, p, {rnd('v', 4)} AS value FROM found""",
    "window_snap": query(_daily(), """
d AS (SELECT floor(epoch(TIMESTAMP '1998-01-01 12:00:00' - date) / 86400)::INT AS d FROM daily),""",
        f"s AS (SELECT {_SNAP.format(d='d')} AS date_diff FROM d),", select="""
SELECT date_diff, CASE WHEN date_diff > 0 THEN 'pre' ELSE 'post' END AS status, count(*) AS n
FROM s GROUP BY ALL"""),
    "pre_post_split": query(STUDY, SHAPED, select=" UNION ALL ".join(
        f"SELECT '{t}' AS status, emp_id, treatment_id, start_date, end_date, "
        + ", ".join(f'round("{k}", 3) AS "{k}"' for k in KPI) + f", date_diff FROM {t}"
        for t in ("pre", "post"))),
    "daily_windows": _daily_windows(),
    "sufficiency": query(STUDY, SHAPED, _sufficiency("enough", (90, 720), (30, 32, 720)),
                         select="SELECT * FROM enough"),
    "label_encode": query(STUDY, select=" UNION ALL ".join(
        f"""SELECT "{c}" AS "Segments", (row_number() OVER (ORDER BY "{c}") - 1)::INT AS "Segment",
  '{c}' AS "Segment_Name" FROM (SELECT DISTINCT "{c}" FROM seg)"""
        for c in ("MARKET", "NATION", "REGION"))),
    "segment_encode": query(STUDY, select="SELECT emp_id, " + ", ".join(
        f'(dense_rank() OVER (ORDER BY "{c}") - 1)::INT AS "{c}"'
        for c in ("MARKET", "NATION", "REGION")) + " FROM seg"),
    "encode_ids": query(STUDY, select=f"""
SELECT {_POPULATION.replace('treatment_id', "(dense_rank() OVER (ORDER BY treatment_id) - 1)::INT AS treatment_id")} FROM pop"""),
    "feature_frame": query(STUDY, SHAPED, select="SELECT emp_id, treatment_id, " + ", ".join(
        f'round("{c}", 3) AS "{c}"' for c in [*KPI, "ACCTBAL", "LIFETIME"])
        + ', "Control/Test_group", "MARKET", "NATION", "REGION" FROM feats'),
    "outcome_frame": query(*_ROWS, select="SELECT emp_id, treatment_id, " + ", ".join(
        f'round("{c}", 3) AS "{c}"' for c in [*[f"{k}_pre" for k in KPI], "ACCTBAL", "LIFETIME", *KPI])
        + ', "Control/Test_group", "MARKET", "NATION", "REGION" FROM rows_'),
    "drop_constant": query(_daily(), select="""
SELECT emp_id, date, units AS "Units", cents AS "Line Cents" FROM daily"""),
    "drop_all_null": """
SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN o_totalprice END AS price,
  CASE WHEN o_orderstatus <> 'P' THEN o_totalprice END AS "B predictions" FROM orders""",
    "one_hot": query(STUDY, select='SELECT emp_id AS "EMP_ID", ' + ", ".join(
        f"""("{c}" = '{v}')::INT AS "{c}_{v}" """ for c, vs in (
            ("MARKET", ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")),
            ("NATION", [f"NATION_{i}" for i in range(25)]),
            ("REGION", ("AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"))) for v in vs)
        + " FROM seg"),
    "union_distinct": """
SELECT c_nationkey AS nation, c_mktsegment AS market FROM customer UNION
SELECT s_nationkey, NULL FROM supplier""",
    "null_pct": _null_pct(),
    "duplicate_pct": " UNION ALL ".join([
        _duplicates("orders", "o_custkey, o_orderstatus, o_orderpriority"),
        _duplicates("lineitem", "l_partkey, l_quantity, l_returnflag"),
        _duplicates("events", "user_id, event_type")]),
    "iqr_outliers": " UNION ALL ".join(
        _iqr("lineitem", c) for c in ("l_quantity", "l_extendedprice", "l_discount", "l_tax")),
    "quality_profile": query(STUDY, _PROFILE_TABLES, select=_profile_select()),
    "validation_report": _validation(),
    "coarsen_quantile": query(select="""
WITH c AS (SELECT quantile_cont(l_extendedprice, [0.2, 0.4, 0.6, 0.8]) AS p,
  quantile_cont(l_quantity, [0.3333333333333333, 0.6666666666666666]) AS q FROM lineitem)
SELECT len(list_filter(list_distinct(p), lambda x: x <= l_extendedprice))::INT AS l_extendedprice_bin,
  len(list_filter(list_distinct(q), lambda x: x <= l_quantity))::INT AS l_quantity_bin,
  count(*) AS n FROM lineitem, c GROUP BY ALL"""),
    "coarsen_width": """
WITH r AS (SELECT min(o_totalprice) AS a, max(o_totalprice) AS b, min(o_custkey)::DOUBLE AS c,
  max(o_custkey)::DOUBLE AS d, ceil(log2(count(*)))::INT + 1 AS k FROM orders)
SELECT (SELECT count(*) FROM generate_series(1, 3) g(j) WHERE o_totalprice >= a + (b - a) * j / 4)::INT
  AS o_totalprice_bin,
  (SELECT count(*) FROM generate_series(1, 60) g(j) WHERE j < k AND o_custkey >= c + (d - c) * j / k)::INT
  AS o_custkey_bin, count(*) AS n FROM orders, r GROUP BY ALL""",
    "log_cutpoints": _log_cuts(),
    "match_candidates": query(*_ROWS, CANDIDATES, select="""
SELECT candidate_no, strata, usable_strata, treated, controls FROM totals"""),
    "candidate_balance": query(*_ROWS, CANDIDATES, select=f"SELECT {_CAND_OUT} FROM candidates"),
    "balance_nulls": query(STUDY, SHAPED, outcome("known_rows", 720), """
rows_ AS (SELECT * REPLACE (CASE WHEN "ACCTBAL" >= 0 THEN "ACCTBAL" END AS "ACCTBAL") FROM known_rows),""",
                           CANDIDATES, select=f"SELECT {_CAND_OUT} FROM candidates"),
    "select_match": query(*_ROWS, CANDIDATES, select=f"""
SELECT {_CAND_OUT} FROM candidates
QUALIFY row_number() OVER (ORDER BY "NumMatched" DESC, candidate_no) = 1"""),
    "causal_tree": query(*_ROWS, _causal_tree(), select=_CAUSAL_OUT),
    "propensity_cells": _propensity_cells(),
    "kpi_cells": query(*_ROWS, _KPI_LINES, """
fits AS (SELECT "KPI", 1 - sum((y - p) * (y - p)) / (var_pop(y) * count(*)) AS r2 FROM scored
  WHERE w = 1 AND is_test = 1 AND y IS NOT NULL GROUP BY "KPI"),""", select=f"""
SELECT emp_id, treatment_id, is_test, "KPI", {rnd('p', 4)} AS predictions, {rnd('r2', 4)} AS r2
FROM scored JOIN fits USING ("KPI")"""),
    "importance_cells": query(*_ROWS, _KPI_LINES, """
spread AS (SELECT "KPI", stddev_pop(a) AS sa, stddev_pop(b * x) AS sb FROM scored
  WHERE w = 1 AND is_test = 0 AND y IS NOT NULL GROUP BY "KPI"),""", select=f"""
SELECT "KPI", 'treatment_id' AS feature, {rnd('sa / (sa + sb)', 6)} AS importance FROM spread
UNION ALL SELECT "KPI", 'LIFETIME', {rnd('sb / (sa + sb)', 6)} FROM spread"""),
    "effect_overall": query(*_ROWS, halves(), MATCHED, long_kpis("matched"), fit("kl", ["KPI"]),
                            select=f'SELECT "KPI", {_FIT_OUT} FROM fit'),
    "effect_by_treatment": _effect_by_treatment(),
    "effect_by_segment": query(SEGMENT_FIT, select=f"SELECT {_SEG_OUT}, {_FIT_OUT} FROM fit_all"),
    "effect_ci": query(SEGMENT_FIT, select=f"SELECT {_SEG_OUT}, {effect_columns()}, reason FROM fit_all"),
    "effect_arbitrate": _arbitrate(),
    "vif": query(select="""
WITH g AS (SELECT sum(l_quantity * l_quantity) AS a, sum(l_extendedprice * l_extendedprice) AS b,
  sum(l_discount * l_discount) AS c, sum(l_quantity * l_extendedprice) AS ab,
  sum(l_quantity * l_discount) AS ac, sum(l_extendedprice * l_discount) AS bc FROM lineitem),
d AS (SELECT *, a * (b * c - bc * bc) - ab * (ab * c - bc * ac) + ac * (ab * bc - b * ac) AS det FROM g)
SELECT 'l_quantity' AS feature, round(a * (b * c - bc * bc) / det, 6) AS vif FROM d UNION ALL
SELECT 'l_extendedprice', round(b * (a * c - ac * ac) / det, 6) FROM d UNION ALL
SELECT 'l_discount', round(c * (a * b - ab * ab) / det, 6) FROM d"""),
    "vif_prune": """
WITH g AS (SELECT sum(l_quantity * l_quantity) AS a, sum(l_extendedprice * l_extendedprice) AS b,
  sum(l_discount * l_discount) AS c, sum(l_quantity * l_extendedprice) AS ab,
  sum(l_quantity * l_discount) AS ac, sum(l_extendedprice * l_discount) AS bc FROM lineitem),
d AS (SELECT *, a * (b * c - bc * bc) - ab * (ab * c - bc * ac) + ac * (ab * bc - b * ac) AS det FROM g),
v AS (SELECT 1 AS i, 'l_quantity' AS feature, a * (b * c - bc * bc) / det AS vif FROM d UNION ALL
  SELECT 2, 'l_extendedprice', b * (a * c - ac * ac) / det FROM d UNION ALL
  SELECT 3, 'l_discount', c * (a * b - ab * ab) / det FROM d),
worst AS (SELECT i FROM v WHERE vif >= 5 ORDER BY vif DESC, i LIMIT 1),
pairs AS (SELECT 1 AS i, 2 AS j, a * b / (a * b - ab * ab) AS vif FROM g UNION ALL
  SELECT 1, 3, a * c / (a * c - ac * ac) FROM g UNION ALL
  SELECT 2, 3, b * c / (b * c - bc * bc) FROM g),
next AS (SELECT p.i, p.j FROM pairs p, worst w WHERE w.i NOT IN (p.i, p.j) AND p.vif >= 5)
SELECT feature FROM v WHERE i NOT IN (SELECT i FROM worst) AND i NOT IN (SELECT i FROM next)""",
    "holdout_split": f"""
SELECT c_custkey, c_mktsegment, ({_HASH} < 0.33::DOUBLE * 4294967296)::INT AS is_test FROM customer""",
    "holdout_stratified": f"""
WITH h AS (SELECT o_orderkey, o_orderstatus, {_OHASH} AS h FROM orders),
c AS (SELECT o_orderstatus, quantile_cont(h::DOUBLE, 0.33) AS cut FROM h GROUP BY 1)
SELECT o_orderstatus, (h < cut)::INT AS is_test, count(*) AS n, sum(o_orderkey)::BIGINT AS key_sum
FROM h JOIN c USING (o_orderstatus) GROUP BY ALL""",
    "confusion_pct": query(*_ROWS, SCORED, select="""
SELECT a AS actual,
  round_even(count(*) FILTER (w = a AND predictions = 0) / count(*) * 100, 2) AS predicted_0,
  round_even(count(*) FILTER (w = a AND predictions = 1) / count(*) * 100, 2) AS predicted_1
FROM scored, (VALUES (0), (1)) v(a) GROUP BY a"""),
    "f1_accuracy": query(*_ROWS, SCORED, """
k AS (SELECT treatment_id, count(*) FILTER (w = 1 AND predictions = 1) AS tp,
  count(*) FILTER (w <> predictions) AS bad, count(*) AS n FROM scored GROUP BY treatment_id),""",
        select=f"""SELECT treatment_id, {rnd('2 * tp / (2 * tp + bad)', 9)} AS f1,
  {rnd('(n - bad) / n', 9)} AS accuracy, n FROM k"""),
    "r2_by_kpi": _r2(),
    "auc_rank_sum": query(*_ROWS, SCORED,
                          select=_rank_auc("scored", "treatment_id", "probability", "w")),
    "outcome_fit_corr": query(*_ROWS, SCORED, """
c AS (SELECT treatment_id, corr("Order Value_pre", "Order Value") AS c, avg("Order Value") AS m
  FROM scored GROUP BY treatment_id),""", select=f"""
SELECT treatment_id, {rnd('c * c', 4)} AS y_r2, {rnd('abs(c)', 4)} AS y_cor,
  {rnd('m', 4)} AS y_orig_mean FROM c"""),
    "final_effects": query(SEGMENT_FIT, FINAL, select=f"""
SELECT treatment_label, "KPI", {_PUB}, NULL::VARCHAR AS "Segment", NULL::VARCHAR AS "Segment_Name"
FROM overall UNION ALL SELECT treatment_label, "KPI", {_PUB}, seg_col, seg_val FROM segs"""),
    "rank_segments": query(SEGMENT_FIT, FINAL, select="""
SELECT treatment_label, seg_col AS "Segment", seg_val AS "Segment_Name", "KPI",
  ate AS "Average_treatment_effect",
  rank() OVER (PARTITION BY treatment_label, seg_val ORDER BY ate DESC)
  + (count(*) OVER (PARTITION BY treatment_label, seg_val, ate) - 1) / 2.0::DOUBLE AS "Rank"
FROM segs"""),
    "top_insights": query(SEGMENT_FIT, FINAL, """
ranked AS (SELECT *, rank() OVER (PARTITION BY treatment_label, seg_val ORDER BY ate DESC)
  + (count(*) OVER (PARTITION BY treatment_label, seg_val, ate) - 1) / 2.0::DOUBLE AS rk FROM segs),""",
        select=f"""SELECT treatment_label, "KPI", {_PUB}, seg_col AS "Segment",
  seg_val AS "Segment_Name", rk AS "Rank" FROM ranked WHERE rk = 1 AND sig = 'Significant'
ORDER BY ate DESC, treatment_label, "KPI", seg_col, seg_val LIMIT 10"""),
    "top_per_group": query(SEGMENT_FIT, FINAL, select=f"""
SELECT treatment_label, "KPI", {_PUB}, seg_col AS "Segment", seg_val AS "Segment_Name" FROM segs
QUALIFY row_number() OVER (PARTITION BY treatment_label, seg_col, "KPI"
  ORDER BY ate DESC, se2 NULLS FIRST, ci NULLS FIRST, sig NULLS FIRST, seg_val) = 1"""),
    "best_treatment_per_kpi": query(SEGMENT_FIT, FINAL, select="""
SELECT "KPI", treatment_label, ate AS "Average_treatment_effect", sig AS "Significance" FROM overall
QUALIFY row_number() OVER (PARTITION BY "KPI" ORDER BY ate DESC, treatment_label, sig NULLS FIRST) = 1"""),
    "no_impact_counts": query(SEGMENT_FIT, FINAL, select="""
SELECT "KPI", count(*) FILTER (ate <= 0) AS no_impact,
  coalesce(string_agg(treatment_label, ', ' ORDER BY treatment_label) FILTER (ate <= 0), '')
    AS no_impact_treatments,
  count(*) FILTER (sig = 'Significant') AS significant,
  coalesce(string_agg(treatment_label, ', ' ORDER BY treatment_label)
    FILTER (sig = 'Significant'), '') AS significant_treatments
FROM overall GROUP BY "KPI" """),
    "batch_outputs": _effect_by_treatment(),
    "named_codes": query(SEGMENT_FIT, FINAL, select=f"""
SELECT treatment_label, "KPI", {_PUB} FROM overall"""),
    "segment_labels": query(SEGMENT_FIT, FINAL, select=f"""
SELECT treatment_label, "KPI", {_PUB}, seg_col AS "Segment", seg_val AS "Segment_Name" FROM segs"""),
    "model_report": query(*_ROWS, SCORED, _FACTS, select="SELECT section, item, value FROM facts"),
    "insights": query(SEGMENT_FIT, SCORED, _FACTS, FINAL, _PROFILE_TABLES, _insights(),
                      select='SELECT c AS "Category", s AS insights FROM said'),
    "csv_roundtrip": query(STUDY, select="""
SELECT k.emp_id, k.t0 AS start_date_of_treatment_taken, k.t1 AS end_date_of_treatment_taken,
  k.label AS treatment_label_taken, treatment_id, a AS treatment_allocated_date,
  b AS treatment_allocated_end_date FROM taken k JOIN treatments USING (treatment_id)"""),
    "parquet_roundtrip": query(STUDY, select="""
SELECT emp_id AS "EMP_ID", "MARKET", "NATION", "REGION" FROM seg"""),
}
