"""Position-control pack on whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewatch.operators import identity, metrics
from tidewatch.plans import workforce as N
from tidewatch.sources.tables import staging
from tidewatch.workload.bindings import CALENDAR
from tidewatch.workload.registry import query


def _name(col: str) -> str:
    return (
        f"regexp_replace(regexp_replace(trim(regexp_replace(upper({col}), '\\s+', ' ', 'g')), ' RN$', ''), ' [A-Z]\\.? ', ' ', 'g')"
    )


def _people(src: str, id_col: str) -> str:
    return (
        f"SELECT DISTINCT id, dept, split_part(n, ' ', 1) AS first, split_part(n, ' ', -1) AS last FROM "
        f"(SELECT {id_col} AS id, upper(trim(department)) AS dept, {_name('worker_name')} AS n FROM {src})"
    )


def _soundex(x: str) -> str:
    """Letters to digits; H and W vanish between equal digits, vowels part them, runs collapse."""
    digits = f"translate({x}, 'AEIOUYBFPVCGJKQSXZDTLMNR', '000000111122222222334556')"
    body = f"regexp_replace(substr({digits}, 2), '[HW]', '', 'g')"
    chain = f"concat(translate(substr({x}, 1, 1), 'AEIOUYHWBFPVCGJKQSXZDTLMNR', '00000000111122222222334556'), {body})"
    for d in "123456":
        chain = f"regexp_replace({chain}, '{d}+', '{d}', 'g')"
    return f"rpad(substr(concat(substr({x}, 1, 1), replace(substr({chain}, 2), '0', '')), 1, 4), 4, '0')"


def _uniq(side: str, keys: str, tag: str) -> str:
    return f"(SELECT {keys}, min(id) AS id_{tag} FROM {side} WHERE first <> '' AND last <> '' GROUP BY {keys} HAVING count(*) = 1)"


def _link(n: int, left: str, right: str, keys: str, method: str, rule: str, conf: str, review: str) -> str:
    return (
        f"t{n} AS (SELECT id_l AS left_id, id_r AS right_id, '{method}' AS match_method, '{rule}' AS match_rule, {conf}::DOUBLE AS confidence, {review} AS needs_review "
        f"FROM {_uniq(left, keys, 'l')} a JOIN {_uniq(right, keys, 'r')} b USING ({keys}))"
    )


def _rest(n: int, left: str, right: str) -> str:
    return (
        f"l{n} AS (SELECT * FROM {left} WHERE id NOT IN (SELECT left_id FROM t{n})), r{n} AS (SELECT * FROM {right} WHERE id NOT IN (SELECT right_id FROM t{n}))"
    )


_CUTS = "list_distinct([{x}] || list_transform(range(1, length({x}) + 1), lambda i: concat(substr({x}, 1, i - 1), substr({x}, i + 1))))"
_GRAMS = "list_distinct(list_transform(range(1, greatest(length({x}), 2)), lambda i: substr({x}, i, 2)))"
_KEY = "concat('K-', substr(md5(concat(coalesce(left_id, '-'), '|', coalesce(right_id, '-'))), 1, 16))"


def _names(side: str) -> str:
    return (
        f"(SELECT dept, first, concat(first, ' ', last) AS nm, count(*) AS n, min(id) AS id, {_CUTS.format(x='any_value(concat(first, chr(32), last))')} AS cuts, "
        f"any_value({_GRAMS.format(x='concat(first, chr(32), last)')}) AS gr, sum(count(*)) OVER (PARTITION BY first, last) = 1 AS alone "
        f"FROM {side} WHERE first <> '' AND last <> '' AND dept <> '' GROUP BY dept, first, last)"
    )


def _pairs(left: str, right: str) -> str:
    """All pairs of one department compared directly; across departments, names of one holder by common deletion."""
    cols = "a.dept AS dl, b.dept AS dr, a.nm AS x, b.nm AS y, a.n AS nl, b.n AS nr, a.id AS il, b.id AS ir"
    return (
        f"na AS {_names(left)}, nb AS {_names(right)}, "
        f"p0 AS (SELECT {cols} FROM na a JOIN nb b ON a.dept = b.dept WHERE list_has_any(a.cuts, b.cuts) OR 3 * len(list_intersect(a.gr, b.gr)) >= len(a.gr) + len(b.gr) UNION "
        f"SELECT {cols} FROM (SELECT *, unnest(cuts) AS cut FROM na WHERE alone) a JOIN (SELECT *, unnest(cuts) AS cut FROM nb WHERE alone) b ON a.cut = b.cut AND a.dept <> b.dept), "
        "pr AS (SELECT *, round(greatest(jaro_winkler_similarity(x, y), 1 - levenshtein(x, y) / greatest(length(x), length(y))::DOUBLE) * 0.95::DOUBLE "
        "+ CASE WHEN dl = dr THEN 0.05::DOUBLE ELSE 0 END, 4) AS score FROM p0)"
    )


_XWALK = (
    f"lp AS ({_people('hr', 'employee_id')}), rp AS ({_people('tas', 'tas_worker_id')}), "
    + _link(1, "lp", "rp", "dept, first, last", "EXACT_NAME", "same_name", "1.0", "false") + ", " + _rest(1, "lp", "rp") + ", "
    f"{_pairs('l1', 'r1')}, "
    "rk AS (SELECT *, row_number() OVER wl AS p, lead(score) OVER wl AS p2, row_number() OVER wr AS q, lead(score) OVER wr AS q2 FROM pr WHERE score >= 0.88 "
    "WINDOW wl AS (PARTITION BY dl, x ORDER BY score DESC, y, dr), wr AS (PARTITION BY dr, y ORDER BY score DESC, x, dl)), "
    "t2 AS (SELECT il AS left_id, ir AS right_id, 'FUZZY' AS match_method, 'similar_name' AS match_rule, score::DOUBLE AS confidence, "
    "score < 0.93 OR round(score - greatest(coalesce(p2, 0), coalesce(q2, 0)), 4) < 0.03 OR dl <> dr AS needs_review FROM rk WHERE p = 1 AND q = 1 AND nl = 1 AND nr = 1), "
    + _rest(2, "l1", "r1") + ", "
    f"ls AS (SELECT *, {_soundex('last')} AS snd FROM l2), rs AS (SELECT *, {_soundex('last')} AS snd FROM r2), "
    + _link(3, "ls", "rs", "dept, first, snd", "FUZZY", "same_sound", "0.88", "true") + ", " + _rest(3, "l2", "r2") + ", "
    + _link(4, "l3", "r3", "dept, first", "FUZZY", "same_first_name", "0.5", "true") + ", " + _rest(4, "l3", "r3") + ", "
    "held AS (SELECT dept, first, last, count(*) FILTER (s = 'l') AS nl, count(*) FILTER (s = 'r') AS nr FROM (SELECT 'l' AS s, dept, first, last FROM l4 "
    "UNION ALL SELECT 'r', dept, first, last FROM r4) GROUP BY ALL), "
    "lo AS (SELECT id, bool_or(coalesce(nl > 1 OR nr > 1, false)) AS tie FROM l4 LEFT JOIN held USING (dept, first, last) GROUP BY id), "
    "ro AS (SELECT id, bool_or(coalesce(nl > 1 OR nr > 1, false)) AS tie FROM r4 LEFT JOIN held USING (dept, first, last) GROUP BY id), "
    "al AS (SELECT * FROM t1 UNION ALL SELECT * FROM t2 UNION ALL SELECT * FROM t3 UNION ALL SELECT * FROM t4 "
    "UNION ALL SELECT id, NULL, 'UNMATCHED', CASE WHEN tie THEN 'tie' ELSE 'none' END, 0, true FROM lo "
    "UNION ALL SELECT NULL, id, 'UNMATCHED', CASE WHEN tie THEN 'tie' ELSE 'none' END, 0, true FROM ro), "
    f"xw AS (SELECT {_KEY} AS employee_key, left_id AS employee_id, right_id AS tas_worker_id, match_method, match_rule, confidence, needs_review FROM al)"
)


def _xwalk(t):
    """Each tier's links are written once; later tiers and the leftovers read them back."""
    return N.crosswalk(t.hr, t.tas)


@query("identity_crosswalk", f"WITH {_XWALK} SELECT * FROM xw", "hr tas")
def _(t):
    return _xwalk(t)


@query("identity_review_queue", f"WITH {_XWALK} SELECT * FROM xw WHERE needs_review", "hr tas")
def _(t):
    return identity.review_queue(_xwalk(t))


@query(
    "crosswalk_method_counts",
    f"WITH {_XWALK} SELECT match_method, match_rule, needs_review, count(*) AS n FROM xw GROUP BY ALL",
    "hr tas",
)
def _(t):
    return _xwalk(t).groupBy("match_method", "match_rule", "needs_review").agg(F.count(F.lit(1)).alias("n"))


@query(
    "exact_name_matches",
    f"WITH lp AS ({_people('hr', 'employee_id')}), rp AS ({_people('tas', 'tas_worker_id')}) SELECT dept, first, last, id_l, id_r "
    f"FROM {_uniq('lp', 'dept, first, last', 'l')} a JOIN {_uniq('rp', 'dept, first, last', 'r')} b USING (dept, first, last)",
    "hr tas",
)
def _(t):
    l = identity.people(t.hr, "employee_id", "worker_name", "department")
    r = identity.people(t.tas, "tas_worker_id", "worker_name", "department")
    return identity.match_unique(l, r, identity.NAME_KEY).select("dept", "first", "last", "id_l", "id_r")


@query(
    "similar_name_pairs",
    f"WITH lp AS ({_people('hr', 'employee_id')}), rp AS ({_people('tas', 'tas_worker_id')}), {_pairs('lp', 'rp')} "
    "SELECT dl AS dept_l, dr AS dept_r, x AS name_l, y AS name_r, nl AS n_l, nr AS n_r, score FROM pr",
    "hr tas",
)
def _(t):
    l = identity.people(t.hr, "employee_id", "worker_name", "department")
    r = identity.people(t.tas, "tas_worker_id", "worker_name", "department")
    return identity.score_pairs(identity.candidate_pairs(l, r)).select("dept_l", "dept_r", "name_l", "name_r", "n_l", "n_r", "score")


@query(
    "naive_and_reconciled_headcount",
    f"WITH {_XWALK}, m AS (SELECT 'naive id join' AS method, fte FROM hr WHERE employee_id IN (SELECT tas_worker_id FROM tas) UNION ALL "
    "SELECT 'crosswalk', fte FROM hr WHERE employee_id IN (SELECT employee_id FROM xw WHERE tas_worker_id IS NOT NULL AND employee_id IS NOT NULL) UNION ALL SELECT 'roster', fte FROM hr) "
    "SELECT f.method, count(m.fte) AS headcount, coalesce(CAST(sum(CAST(round(m.fte * 1000) AS BIGINT)) AS DOUBLE) / 1000, 0) AS fte "
    "FROM (VALUES ('naive id join'), ('crosswalk'), ('roster')) f(method) LEFT JOIN m ON m.method = f.method GROUP BY 1",
    "hr tas",
)
def _(t):
    return N.naive_vs_reconciled(t.hr, t.tas, _xwalk(t))


@query(
    "reconciliation_difficulty",
    "SELECT (SELECT count(*) FROM hr) AS n_roster, (SELECT count(DISTINCT tas_worker_id) FROM tas) AS n_schedule_ids, "
    "(SELECT count(*) FROM hr JOIN tas ON employee_id = tas_worker_id) AS n_naive_matches",
    "hr tas",
)
def _(t):
    return N.difficulty(t.hr, t.tas)


@query(
    "pay_period_calendar_load",
    "WITH cal AS (SELECT CAST(i AS INTEGER) AS seq, CAST(DATE '1994-12-19' + CAST(i * 14 AS INTEGER) AS DATE) AS a FROM range(-26, 190) r(i)), "
    "c AS (SELECT seq, a, CAST(year(a) AS VARCHAR) || '-PP' || lpad(CAST(row_number() OVER (PARTITION BY year(a) ORDER BY a) AS VARCHAR), 2, '0') AS pay_period FROM cal) "
    "SELECT c.pay_period, c.a AS start_date, CAST(c.a + 13 AS DATE) AS end_date, CAST(count(n.department) AS BIGINT) AS n_cells, coalesce(sum(n.required_fte), 0) AS required_fte "
    "FROM c LEFT JOIN need n ON n.seq = c.seq WHERE c.seq >= 0 GROUP BY 1, 2, 3",
    "need",
)
def _(t):
    per = t.need.groupBy("seq").agg(F.count(F.lit(1)).alias("n_cells"), F.sum("required_fte").alias("required_fte"))
    return CALENDAR.frame(t.spark).join(per, "seq", "left").select(
        "pay_period", "start_date", "end_date",
        F.coalesce("n_cells", F.lit(0)).alias("n_cells"), F.coalesce("required_fte", F.lit(0.0)).alias("required_fte"),
    )


_CAL = "cal AS (SELECT CAST(i AS INTEGER) AS seq, CAST(DATE '1994-12-19' + CAST(i * 14 AS INTEGER) AS DATE) AS a, CAST(DATE '1994-12-19' + CAST(i * 14 + 13 AS INTEGER) AS DATE) AS b FROM range(190) r(i))"
_POSITION = (
    f"{_CAL}, sh AS (SELECT x.employee_id, min(s.shift) AS shift FROM xw x JOIN (SELECT tas_worker_id, shift FROM (SELECT tas_worker_id, shift, sum(scheduled_hours) AS h FROM tas GROUP BY 1, 2) "
    "QUALIFY row_number() OVER (PARTITION BY tas_worker_id ORDER BY h DESC, shift) = 1) s USING (tas_worker_id) WHERE x.employee_id IS NOT NULL GROUP BY 1), "
    "ro2 AS (SELECT h.employee_id, upper(trim(h.department)) AS department, fte, hire_date, term_date, coalesce(sh.shift, 'UNASSIGNED') AS shift FROM hr h LEFT JOIN sh USING (employee_id)), "
    # one row per employee and period, the plain way
    "ep AS (SELECT r.*, seq, greatest(date_diff('day', greatest(hire_date, a), least(coalesce(term_date, b), b)) + 1, 0) / 14.0::DOUBLE AS emp FROM ro2 r CROSS JOIN cal "
    "WHERE term_date IS NULL OR term_date >= hire_date), "
    "lod AS (SELECT DISTINCT employee_id, unnest(generate_series(greatest(start_date, (SELECT min(a) FROM cal)), least(coalesce(end_date, DATE '2099-01-01'), (SELECT max(b) FROM cal)), INTERVAL 1 DAY))::DATE AS d FROM leave WHERE leave_type = 'LOA'), "
    "loa AS (SELECT employee_id, seq, count(*) AS loa_days FROM lod JOIN cal ON d BETWEEN a AND b GROUP BY 1, 2), "
    "pto AS (SELECT employee_id, seq, sum(hours * (date_diff('day', greatest(start_date, a), least(end_date, b)) + 1) / (date_diff('day', start_date, end_date) + 1)) AS h FROM leave JOIN cal ON start_date <= b AND end_date >= a WHERE leave_type = 'PTO' GROUP BY 1, 2), "
    "av AS (SELECT ep.department, ep.shift, ep.seq, sum(fte * emp - fte * emp * least(1, coalesce(h, 0) / (80 * fte) + coalesce(loa_days, 0) / 14.0::DOUBLE)) AS available FROM ep LEFT JOIN loa USING (employee_id, seq) LEFT JOIN pto USING (employee_id, seq) GROUP BY 1, 2, 3), "
    "rq AS (SELECT upper(trim(department)) AS department, shift, seq, required_fte FROM need), "
    "bu AS (SELECT upper(trim(department)) AS department, shift, seq, budgeted_fte FROM budget CROSS JOIN cal), "
    "ks AS (SELECT department, shift, seq FROM av UNION SELECT department, shift, seq FROM rq UNION SELECT department, shift, seq FROM bu), "
    "pos AS (SELECT k.department, k.shift, k.seq, coalesce(budgeted_fte, 0) AS budgeted_fte, coalesce(available, 0) AS available_fte, coalesce(required_fte, 0) AS required_fte, "
    "coalesce(available, 0) - coalesce(required_fte, 0) AS net_fte FROM ks k LEFT JOIN av USING (department, shift, seq) LEFT JOIN rq USING (department, shift, seq) LEFT JOIN bu USING (department, shift, seq))"
)
_POS_USES = "hr tas leave need budget"


def _position(t):
    shifts = N.shift_of_employee(_xwalk(t), t.tas)
    roster = staging(t.spark, "roster")(N.placed_roster(t.hr, shifts), "placed")
    return N.position_control(roster, t.leave, t.need, t.budget, CALENDAR)


def _rounded(df, places, *cols):
    """Adding zero turns a negative zero into zero."""
    for c in cols:
        df = df.withColumn(c, F.round(c, places) + F.lit(0.0))
    return df


@query(
    "position_control",
    f"WITH {_XWALK}, {_POSITION} SELECT department, shift, seq, round(budgeted_fte, 8) + 0 AS budgeted_fte, round(available_fte, 8) + 0 AS available_fte, required_fte, round(net_fte, 8) + 0 AS net_fte FROM pos",
    _POS_USES,
)
def _(t):
    return _rounded(_position(t), 8, "budgeted_fte", "available_fte", "net_fte").drop("pay_period")


@query(
    "available_fte_by_period",
    f"WITH {_XWALK}, {_POSITION} SELECT seq, round(sum(available_fte), 8) AS available_fte, round(sum(required_fte), 8) AS required_fte FROM pos GROUP BY 1",
    _POS_USES,
)
def _(t):
    return _position(t).groupBy("seq").agg(
        F.round(F.sum("available_fte"), 8).alias("available_fte"), F.round(F.sum("required_fte"), 8).alias("required_fte")
    )


_AHEAD = (
    "fa AS (SELECT department, shift, max(seq) AS last, regr_slope(available_fte, seq) AS ba, regr_intercept(available_fte, seq) AS aa, regr_slope(required_fte, seq) AS br, regr_intercept(required_fte, seq) AS ar, "
    "count(*) AS n, arg_max(available_fte, seq) AS la, arg_max(required_fte, seq) AS lr FROM pos GROUP BY 1, 2), "
    "ah AS (SELECT department, shift, CAST(last + i AS INTEGER) AS seq, greatest(CASE WHEN n >= 2 THEN aa + ba * (last + i) ELSE la END, 0) AS available_fte, "
    "greatest(CASE WHEN n >= 2 THEN ar + br * (last + i) ELSE lr END, 0) AS required_fte FROM fa, (VALUES (1), (2), (3)) r(i))"
)


def _gold(t):
    return staging(t.spark, "position")(_position(t), "gold")


@query(
    "staffing_forecast",
    f"WITH {_XWALK}, {_POSITION}, {_AHEAD} SELECT department, shift, seq, round(available_fte, 6) + 0 AS available_fte, round(required_fte, 6) + 0 AS required_fte, "
    "round(greatest(required_fte - available_fte, 0), 6) + 0 AS shortage_fte, round(greatest(available_fte - required_fte, 0), 6) + 0 AS surplus_fte FROM ah",
    _POS_USES,
)
def _(t):
    out = N.staffing_forecast(_gold(t), 3)
    return _rounded(out, 6, "available_fte", "required_fte", "shortage_fte", "surplus_fte")


@query(
    "staffing_actual_and_forecast",
    f"WITH {_XWALK}, {_POSITION}, {_AHEAD}, al2 AS (SELECT department, shift, seq, available_fte, required_fte, false AS is_forecast FROM pos UNION ALL SELECT department, shift, seq, available_fte, required_fte, true FROM ah) "
    "SELECT is_forecast, shift, count(*) AS n_cells, round(sum(greatest(required_fte - available_fte, 0)), 5) AS shortage_fte, round(sum(greatest(available_fte - required_fte, 0)), 5) AS surplus_fte FROM al2 GROUP BY 1, 2",
    _POS_USES,
)
def _(t):
    return N.actual_and_forecast(_gold(t), 3).groupBy("is_forecast", "shift").agg(
        F.count(F.lit(1)).alias("n_cells"),
        F.round(F.sum("shortage_fte"), 5).alias("shortage_fte"),
        F.round(F.sum("surplus_fte"), 5).alias("surplus_fte"),
    )


@query(
    "short_units_next_period",
    f"WITH {_XWALK}, {_POSITION}, {_AHEAD} SELECT department, shift, round(required_fte - available_fte, 6) AS shortage_fte FROM ah WHERE seq = 190 AND required_fte > available_fte",
    _POS_USES,
)
def _(t):
    short = N.short_units(N.staffing_forecast(_gold(t), 3), CALENDAR.n)
    return short.select("department", "shift", F.round("shortage_fte", 6).alias("shortage_fte"))


@query(
    "net_fte_heatmap",
    f"WITH {_XWALK}, {_POSITION} SELECT department, " + ", ".join(f"round(sum(net_fte) FILTER (shift = '{s}'), 6) + 0 AS {s}" for s in ("Day", "Eve", "Night", "UNASSIGNED"))
    + " FROM pos GROUP BY 1",
    _POS_USES,
)
def _(t):
    total = metrics.Metric("net", {"net__sum": F.col("net_fte")}, F.round(F.col("net__sum"), 6) + F.lit(0.0))
    return metrics.heatmap(_position(t), "department", "shift", ["Day", "Eve", "Night", "UNASSIGNED"], total)


@query(
    "role_mix_gap",
    "WITH p AS (SELECT department, sum(CAST(json_extract(role_mix, '$.RN') AS INTEGER)) AS rn, sum(CAST(json_extract(role_mix, '$.Tech') AS INTEGER)) AS tech FROM budget GROUP BY 1), "
    "q AS (SELECT upper(trim(department)) AS department, 'RN' AS role, rn AS b FROM p UNION ALL SELECT upper(trim(department)), 'Tech', tech FROM p), "
    "a AS (SELECT upper(trim(department)) AS department, role, count(*) AS n FROM hr GROUP BY 1, 2) "
    "SELECT q.department, q.role, CAST(q.b AS BIGINT) AS budgeted, coalesce(a.n, 0) AS actual, CAST(coalesce(a.n, 0) - q.b AS BIGINT) AS gap FROM q LEFT JOIN a USING (department, role)",
    "hr budget",
)
def _(t):
    return N.role_mix_gap(t.budget, t.hr)


_PATTERNS = (
    f"lp AS ({_people('hr', 'employee_id')}), rp AS ({_people('tas', 'tas_worker_id')}), {_pairs('lp', 'rp')}, "
    "fl AS (SELECT *, split_part(x, ' ', 1) AS fx, split_part(y, ' ', 1) AS fy, split_part(x, ' ', -1) AS lx, split_part(y, ' ', -1) AS ly FROM pr), "
    f"sd AS (SELECT *, {_soundex('lx')} AS sx, {_soundex('ly')} AS sy FROM fl), "
    "pt AS (SELECT CAST(dl = dr AS INTEGER) AS a_dept, CAST(CASE WHEN fx = fy THEN 2 WHEN fx[1] = fy[1] THEN 1 ELSE 0 END AS INTEGER) AS a_first, "
    "CAST(CASE WHEN lx = ly THEN 2 WHEN levenshtein(lx, ly) <= 1 OR sx = sy THEN 1 ELSE 0 END AS INTEGER) AS a_last FROM sd)"
)


def _candidates(t):
    l = identity.people(t.hr, "employee_id", "worker_name", "department")
    r = identity.people(t.tas, "tas_worker_id", "worker_name", "department")
    return identity.candidate_pairs(l, r)


@query("name_agreement_patterns", f"WITH {_PATTERNS} SELECT a_dept, a_first, a_last, count(*) AS n FROM pt GROUP BY ALL", "hr tas")
def _(t):
    return identity.agreement_patterns(_candidates(t))


@query("link_probabilities")
def _(t):
    """Candidate pairs with the weight and probability that expectation maximisation gives their pattern of agreement."""
    pairs = staging(t.spark, "links")(_candidates(t), "pairs")
    model = identity.fit_weights(identity.agreement_patterns(pairs))
    out = identity.link_probabilities(pairs, model)
    return out.select("dept_l", "dept_r", "name_l", "name_r", F.round("weight", 4).alias("weight"), F.round("probability", 6).alias("probability"))
