"""The same results in plain SQL, written apart from the operators.

Only the mapping of the test tables onto the data model is shared text.
"""

from pacewell.sources.testviews import (
    FORMULA_SCORE,
    PERF_RAW,
    PREDICTIONS,
    REQUEST_LOG,
    TRAINING_RUNS,
    TRAINING_RUNS_WHERE,
)


def _mapped(columns, table, where=""):
    body = ", ".join(f"{text} AS {name}" for name, text in columns.items())
    return f"SELECT {body} FROM {table}" + (f" WHERE {where}" if where else "")


def _clip(c, low, high):
    return (f"CASE WHEN {c} < {low} THEN CAST({low} AS DOUBLE) "
            f"WHEN {c} > {high} THEN CAST({high} AS DOUBLE) ELSE {c} END")


SLEEP, QUALITY = _clip("sleep_hours", 0, 24), _clip("sleep_quality", 1, 10)
LOAD, STRESS = _clip("training_load", 0, 1000), _clip("stress_level", 1, 10)
RECOVERY = _clip("recovery_score", 1, 10)
RHR, HRV = _clip("resting_heart_rate", 30, 120), _clip("hrv", 0, 200)
EPS = "CAST(0.000001 AS DOUBLE)"
CRITICAL = "sleep_hours, sleep_quality, training_load, stress_level, recovery_score"
RECORD = f"athlete_id, record_date, {CRITICAL}, resting_heart_rate, hrv, performance_score"
FEATURES = (
    "sleep_hours", "sleep_quality", "training_load", "stress_level", "recovery_score",
    "resting_heart_rate_filled", "hrv_filled", "sleep_recovery_ratio", "load_stress_ratio",
)
FEATURE_LIST = ", ".join(FEATURES)
CRITICAL_PRESENT = " AND ".join(f"{c} IS NOT NULL" for c in CRITICAL.split(", "))
RATIOS = (f"sleep_hours * sleep_quality / (recovery_score + {EPS}) AS sleep_recovery_ratio, "
          f"training_load / (stress_level + {EPS}) AS load_stress_ratio")

BOUNDS = (0.005, 0.01, 0.025, 0.05, 0.075, 0.1, 0.25, 0.5, 0.75, 1.0, 2.5, 5.0, 7.5, 10.0)

# Named building blocks; each may use the ones before it.
BLOCKS = {
    "perf_raw": _mapped(PERF_RAW, "lineitem"),
    "predictions": _mapped(PREDICTIONS, "events"),
    "training_runs": _mapped(TRAINING_RUNS, "events", TRAINING_RUNS_WHERE),
    "request_log": _mapped(REQUEST_LOG, "events"),
    "measured": "SELECT * FROM request_log WHERE endpoint NOT LIKE '/metrics%' "
                "AND endpoint NOT LIKE '/health%'",
    "cleaned": f"SELECT record_key, athlete_id, record_date, {SLEEP} AS sleep_hours, "
               f"{QUALITY} AS sleep_quality, {LOAD} AS training_load, {STRESS} AS stress_level, "
               f"{RECOVERY} AS recovery_score, {RHR} AS resting_heart_rate, {HRV} AS hrv, "
               f"performance_score FROM perf_raw WHERE {CRITICAL_PRESENT}",
    "medians": "SELECT median(resting_heart_rate) AS m_rhr, median(hrv) AS m_hrv FROM cleaned",
    "featured": "SELECT cleaned.*, coalesce(resting_heart_rate, m_rhr) AS resting_heart_rate_filled, "
                f"coalesce(hrv, m_hrv) AS hrv_filled, {RATIOS} FROM cleaned CROSS JOIN medians",
    "parted": "SELECT *, CASE WHEN substr(md5(concat('42:', record_key)), 1, 8) < '33333333' "
              "THEN 'test' ELSE 'train' END AS split FROM featured "
              "WHERE performance_score IS NOT NULL",
    "scored": f"SELECT *, {FORMULA_SCORE} AS prediction FROM parted",
    "requests": "SELECT record_key, athlete_id, record_date, record_date AS prediction_date, "
                f"{CRITICAL}, "
                "CASE WHEN recovery_score = 4.5 THEN 0 ELSE resting_heart_rate END AS resting_heart_rate, "
                "CASE WHEN recovery_score = 4.5 THEN 0 ELSE hrv END AS hrv FROM perf_raw",
    "run_metrics": "SELECT id, run_date, model_version, samples_used, status, "
                   + ", ".join(f"CAST(json_extract_string(metrics, '$.{m}') AS DOUBLE) AS {m}"
                               for m in ("test_mae", "test_rmse", "test_r2")) + " FROM training_runs",
    "grid": "SELECT ts, job FROM (SELECT unnest(generate_series(date_trunc('hour', min(ts)), "
            "date_trunc('hour', max(ts)), INTERVAL 1 HOUR)) AS ts FROM request_log) "
            "CROSS JOIN (VALUES ('api'), ('data-ingestion'), ('ml-trainer')) AS jobs(job)",
    "up_samples": "SELECT grid.ts, grid.job, CASE WHEN n > 0 THEN 1 ELSE 0 END AS up FROM grid "
                  "LEFT JOIN (SELECT time_bucket(INTERVAL 1 HOUR, ts) AS ts, job, count(*) AS n "
                  "FROM request_log GROUP BY ALL) USING (ts, job)",
    "counter_samples": "SELECT *, row_number() OVER (PARTITION BY job, method, endpoint, status, "
                       "CAST(ts AS DATE) ORDER BY ts, event_id) AS v FROM request_log",
}

_USES = {
    "measured": ["request_log"],
    "cleaned": ["perf_raw"],
    "medians": ["cleaned"],
    "featured": ["medians"],
    "parted": ["featured"],
    "scored": ["parted"],
    "requests": ["perf_raw"],
    "run_metrics": ["training_runs"],
    "grid": ["request_log"],
    "up_samples": ["grid"],
    "counter_samples": ["request_log"],
}


def _with(last: str, sql: str, *more: tuple[str, str]) -> str:
    """The query behind its blocks, found by following what ``last`` uses."""
    needed = []

    def add(name):
        for used in _USES.get(name, []):
            add(used)
        if name not in needed:
            needed.append(name)

    for name in last.split():
        add(name)
    parts = [f"{n} AS ({BLOCKS[n]})" for n in needed] + [f"{n} AS ({q})" for n, q in more]
    return f"WITH {', '.join(parts)} {sql}"


def _rules(profile, block):
    rows = []
    for name, bad in profile.items():
        rows.append(f"SELECT '{name}' AS rule, count(*) FILTER (WHERE {bad}) AS n_rows FROM {block}")
    return _with(block, " UNION ALL ".join(rows))


def _range(c, low, high, required=True):
    outside = f"{c} < {low}" + (f" OR {c} > {high}" if high is not None else "")
    rules = {f"{c}_range": outside}
    if required:
        rules[f"{c}_missing"] = f"{c} IS NULL"
    return rules


def _missing(c):
    return {f"{c}_missing": f"{c} IS NULL"}


_BODY = {**_range("sleep_hours", 0, 24), **_range("sleep_quality", 1, 10)}
_MOOD = {**_range("stress_level", 1, 10), **_range("recovery_score", 1, 10)}
_RHR = _range("resting_heart_rate", 30, 120, False)
_SCORE = _range("performance_score", 0, 100, False)
INGEST = {
    "athlete_id_length": "athlete_id IS NULL OR length(athlete_id) NOT BETWEEN 1 AND 100",
    **_missing("record_date"), **_BODY, **_range("training_load", 0, 2000), **_MOOD,
    **_RHR, **_range("hrv", 0, 200, False), **_SCORE,
}
API = {
    **_missing("athlete_id"), **_missing("record_date"), **_BODY, **_range("training_load", 0, None),
    **_MOOD, **_RHR, **_range("hrv", 0, None, False), **_SCORE,
}
PREDICT = {
    **_missing("athlete_id"), **_missing("prediction_date"), **_BODY,
    **_range("training_load", 0, None), **_MOOD, **_RHR, **_range("hrv", 0, None, False),
}
ANY_BAD = " OR ".join(f"coalesce({bad}, FALSE)" for bad in INGEST.values())
VERDICT = _with("perf_raw", f"SELECT CASE WHEN {ANY_BAD} THEN 'bad' ELSE 'good' END AS verdict, "
                            "count(*) AS n_rows FROM perf_raw GROUP BY 1")

_FIRST = " ".join(f"WHEN coalesce({bad}, FALSE) THEN '{name}'" for name, bad in INGEST.items())


def _first_violations(damaged: str = "", known_id: str = "athlete_id") -> str:
    return _with("perf_raw", "SELECT first_violation, count(*) AS n_rows, count(DISTINCT known_id) AS n_athletes FROM ("
                             f"SELECT CASE {damaged} {_FIRST} ELSE 'none' END AS first_violation, {known_id} AS known_id "
                             "FROM perf_raw) GROUP BY 1")


FIRST_CLEAN = _first_violations()
FIRST_DAMAGED = _first_violations(
    "WHEN recovery_score IN (3, 9) THEN 'damaged_line' WHEN recovery_score = 6 THEN 'training_load_unparsed'",
    "CASE WHEN recovery_score NOT IN (3, 9) THEN athlete_id END")

# A quarter of the uploads each has all columns, has them turned round, lacks the sensors, or lacks the load and is damaged.
_UPLOAD = "CAST(recovery_score / 1.5 AS BIGINT) % 4"
READ_BACK = _with(
    "perf_raw", f"SELECT CASE WHEN {_UPLOAD} = 3 THEN 'unknown' ELSE athlete_id END AS athlete_id, count(*) AS n_rows, "
                f"count(*) FILTER (WHERE {_UPLOAD} = 3) AS n_damaged, count(hrv) FILTER (WHERE {_UPLOAD} < 2) AS n_hrv, "
                f"round(sum(training_load) FILTER (WHERE {_UPLOAD} < 3), 4) AS training_load, "
                f"max(record_date) FILTER (WHERE {_UPLOAD} < 3) AS last_date FROM perf_raw GROUP BY 1")

DEFAULTS = {"sleep_hours": 7, "sleep_quality": 7, "training_load": 200, "stress_level": 5,
            "recovery_score": 7}
_DEFAULTED = ", ".join(f"coalesce({c}, CAST({d} AS DOUBLE)) AS {c}" for c, d in DEFAULTS.items())
_FALSY = ("CASE WHEN resting_heart_rate IS NULL OR resting_heart_rate = 0 THEN CAST(60 AS DOUBLE) "
          "ELSE resting_heart_rate END AS resting_heart_rate, "
          "CASE WHEN hrv IS NULL OR hrv = 0 THEN CAST(50 AS DOUBLE) ELSE hrv END AS hrv")
SERVED = (f"SELECT record_key, {_DEFAULTED}, "
          "coalesce(resting_heart_rate, CAST(60 AS DOUBLE)) AS resting_heart_rate_filled, "
          "coalesce(hrv, CAST(50 AS DOUBLE)) AS hrv_filled FROM perf_raw")

ISO = "coalesce(strftime({c}, '%Y-%m-%dT%H:%M:%S.%f'), '')"


def _bucket(minutes, ts="ts"):
    return f"time_bucket(INTERVAL {minutes} MINUTE, {ts})"


def _rate(minutes, scale=""):
    return f"count(*) / CAST({minutes * 60} AS DOUBLE){scale} AS rate"


def _quantiles(keys, phis, where="TRUE"):
    """Interpolated from one row per bucket, by the textbook formula."""
    by = "".join(f"{k}, " for k in keys)
    bounds = ", ".join(f"({i}, CAST({b} AS DOUBLE))" for i, b in enumerate(BOUNDS))
    counted = (f"SELECT {by}window_start, i, le, count(*) FILTER (WHERE duration <= le) AS c FROM "
               f"(SELECT *, {_bucket(5)} AS window_start FROM measured WHERE {where}) "
               f"CROSS JOIN bounds GROUP BY ALL")
    stepped = ("SELECT *, coalesce(lag(c) OVER w, 0) AS c0, coalesce(lag(le) OVER w, 0) AS le0 "
               f"FROM counted WINDOW w AS (PARTITION BY {by}window_start ORDER BY i)")
    picks = []
    for name, phi in phis.items():
        picks.append(
            f"coalesce(min_by(le0 + (le - le0) * ((CAST({phi} AS DOUBLE) * n - c0) / (c - c0)), i) "
            f"FILTER (WHERE c >= CAST({phi} AS DOUBLE) * n), 10) AS {name}")
    join_keys = f"({by}window_start)"
    return _with(
        "measured",
        f"SELECT {by}window_start, {', '.join(picks)} FROM stepped JOIN totals USING {join_keys} "
        "GROUP BY ALL",
        ("bounds", f"SELECT * FROM (VALUES {bounds}) AS b(i, le)"),
        ("counted", counted), ("stepped", stepped),
        ("totals", f"SELECT {by}{_bucket(5)} AS window_start, count(*) AS n FROM measured "
                   f"WHERE {where} GROUP BY ALL"))


def _held(source_block, values, keys, ts, condition, hold, gap=None, extra=(), select="*"):
    """Gaps and islands: a break starts a new island, true rows share its start."""
    part = f"PARTITION BY {', '.join(keys)} " if keys else ""
    broken = "NOT ok"
    if gap:
        broken += f" OR {ts} - lag({ts}) OVER w > INTERVAL {gap} SECOND"
    flagged = f"SELECT *, coalesce({condition}, FALSE) AS ok FROM vals"
    cut = (f"SELECT *, CASE WHEN {broken} THEN 1 ELSE 0 END AS brk FROM flagged "
           f"WINDOW w AS ({part}ORDER BY {ts})")
    island = f"SELECT *, sum(brk) OVER ({part}ORDER BY {ts}) AS island FROM cut"
    group = ", ".join([*keys, "island"])
    since = (f"SELECT *, CASE WHEN ok THEN min(CASE WHEN ok THEN {ts} END) OVER (PARTITION BY {group}) "
             "END AS since FROM island")
    state = (f"SELECT *, CASE WHEN NOT ok THEN 'inactive' WHEN {ts} - since >= INTERVAL {hold} SECOND "
             "THEN 'firing' ELSE 'pending' END AS state FROM sinced")
    return _with(source_block, f"SELECT {select} FROM held", *extra, ("vals", values),
                 ("flagged", flagged), ("cut", cut), ("island", island), ("sinced", since),
                 ("held", state))


def _texts(rule, severity, summary, description, *rest):
    return ", ".join([f"'{rule}' AS alert", *rest, "since", "state", f"'{severity}' AS severity",
                      f"{summary} AS summary", f"{description} AS description"])


_RATIO5 = (f"SELECT {_bucket(5)} AS window_start, count(*) FILTER (WHERE status LIKE '5__') / count(*) "
           "AS value FROM measured WHERE job = 'api' GROUP BY 1")
_ERROR_TEXTS = _texts("HighApiErrorRate", "critical", "'High API error rate'",
                      "'API 5xx error rate is above 5% for 5 minutes.'", "window_start", "value")
_ERROR_ALERT = _held("measured", _RATIO5, [], "window_start", "value > 0.05", 300, 300,
                     select=_ERROR_TEXTS)

_DOWN_ALERT = _held(
    "up_samples", "SELECT * FROM up_samples", ["job"], "ts", "up = 0", 120,
    select=_texts("ServiceDown", "critical", "concat(job, ' is down')",
                  "concat('Service ', job, ' has been unreachable for 2 minutes.')",
                  "job", "ts", "up AS value"))

_LATENCY_ALERT = _held(
    "measured", "SELECT * FROM quantiles", [], "window_start", "value > 1", 300, 300,
    extra=(("quantiles", _quantiles([], {"value": 0.95}, "job = 'api'")),),
    select=_texts("HighApiLatencyP95", "warning", "'High API latency p95'",
                  "'API p95 latency is above 1 second for 5 minutes.'", "window_start", "value"))

_SERIES = "job, method, endpoint, status"

_RUN_METRICS = ("test_mae", "test_rmse", "test_r2")

_RATIO_BAND = "CASE WHEN value >= 0.2 THEN 'green' WHEN value >= 0.05 THEN 'yellow' ELSE 'red' END"
_UP_BAND = "CASE WHEN value >= 3 THEN 'green' WHEN value >= 1 THEN 'yellow' ELSE 'red' END"

_METRICS = {
    "mae": "avg(abs(performance_score - prediction))",
    "rmse": "sqrt(avg(power(performance_score - prediction, 2)))",
    "r2": "1 - sum(power(performance_score - prediction, 2)) / sum(power(performance_score - mean_y, 2))",
}
_SCORED_ALL = f"SELECT *, {FORMULA_SCORE} AS prediction FROM cleaned WHERE performance_score IS NOT NULL"
_CENTRED_ALL = "SELECT *, avg(performance_score) OVER () AS mean_y FROM scored_all"
_CENTRED = "SELECT *, avg(performance_score) OVER (PARTITION BY split) AS mean_y FROM scored"


def _one_metric(name):
    return _with("cleaned", f"SELECT round({_METRICS[name]}, 6) AS {name} FROM centred",
                 ("scored_all", _SCORED_ALL), ("centred", _CENTRED_ALL))


def _latest(block, n, time, key="id"):
    return f"SELECT * FROM {block} ORDER BY {time} DESC, {key} DESC LIMIT {n}"


_ALL_FIELDS = ", ".join(f"{c} DESC" for c in
                        ("record_date", "record_key", "athlete_id", *CRITICAL.split(", "),
                         "resting_heart_rate", "hrv", "performance_score"))

_HISTORY_PAGE = (
    ("page", "SELECT * FROM perf_raw"),
    ("chosen", "SELECT * FROM page WHERE athlete_id IN (SELECT DISTINCT athlete_id FROM page ORDER BY 1 LIMIT 5)"),
)

_STATS = " UNION ALL ".join(
    f"SELECT '{f}' AS feature, avg({f}) AS mean, stddev_pop({f}) AS std FROM parted WHERE split = 'train'"
    for f in FEATURES)

_TEXT = ("SELECT record_key, CASE WHEN recovery_score = 10.5 THEN '' ELSE athlete_id END AS athlete_id, "
         "CASE WHEN recovery_score = 9 THEN 'not a date' ELSE CAST(record_date AS VARCHAR) END AS record_date, "
         "sleep_hours, sleep_quality, "
         "CASE WHEN stress_level = 6 THEN 'n/a' ELSE CAST(training_load AS VARCHAR) END AS training_load, "
         "stress_level, recovery_score, "
         "CASE WHEN recovery_score = 3 THEN NULL ELSE hrv END AS hrv FROM perf_raw")

_TITLED_RATES = _with(
    "measured", f"SELECT method, endpoint, {_bucket(5)} AS window_start, {_rate(5)} "
                "FROM measured WHERE job = 'api' GROUP BY ALL")


def _closed(sql):
    """Windows still open at the end of the stream are not written."""
    end = _with("measured", "SELECT max(ts) - INTERVAL 10 MINUTE FROM measured WHERE job = 'api'")
    return f"SELECT * FROM ({sql}) WHERE window_start + INTERVAL 5 MINUTE <= ({end})"


_INCREASE = _with(
    "counter_samples",
    f"SELECT {_SERIES}, window_start, CAST(sum(d) AS BIGINT) AS increase, "
    "CAST(sum(d) AS DOUBLE) / CAST(3600 AS DOUBLE) AS rate FROM deltas GROUP BY ALL",
    ("lagged", f"SELECT *, lag(v) OVER (PARTITION BY {_SERIES} ORDER BY ts, event_id, v) AS v0 "
               "FROM counter_samples"),
    ("deltas", f"SELECT {_SERIES}, {_bucket(60)} AS window_start, "
               "CASE WHEN v0 IS NULL THEN 0 WHEN v < v0 THEN v ELSE v - v0 END AS d FROM lagged"))


def _steps(step, width):
    """Ends of the ranges that hold a sample: steps from its own time on, as many as a range has."""
    at = f"CAST(ceil(epoch_us(ts) / {step * 10**6}.0) AS BIGINT) * {step * 10**6}"
    return f"unnest(generate_series({at}, epoch_us(ts) + {width * 10**6} - 1, {step * 10**6})) AS at_us"


_FAR = "CASE WHEN {gap} >= mean * 1.1 THEN mean / 2 ELSE {gap} END"
_RANGE_INCREASE = _with(
    "counter_samples",
    f"SELECT {_SERIES}, make_timestamp(at_us) AS ts, n_samples, round(increase, 6) AS increase, round(increase / 3600, 6) AS rate "
    "FROM (SELECT *, raw * (span + CASE WHEN raw > 0 THEN least(head, span * v / raw) ELSE head END + tail) / span AS increase FROM ("
    f"SELECT *, {_FAR.format(gap='head_gap')} AS head, {_FAR.format(gap='tail_gap')} AS tail FROM edged))",
    ("lagged", f"SELECT *, lag(v) OVER (PARTITION BY {_SERIES} ORDER BY ts, event_id, v) AS v0 FROM counter_samples"),
    ("ranged", f"SELECT *, CASE WHEN v0 IS NULL THEN 0 WHEN v < v0 THEN v ELSE v - v0 END AS d, {_steps(300, 3600)} FROM lagged"),
    ("summed", f"SELECT {_SERIES}, at_us, count(*) AS n_samples, "
               "CAST(sum(d) - arg_min(d, ROW(ts, event_id)) AS DOUBLE) AS raw, "
               "CAST(arg_min(v, ROW(ts, event_id)) AS DOUBLE) AS v, min(epoch_us(ts)) AS first_us, max(epoch_us(ts)) AS last_us "
               "FROM ranged GROUP BY ALL"),
    ("edged", "SELECT *, (last_us - first_us) / 1e6 AS span, (last_us - first_us) / 1e6 / (n_samples - 1) AS mean, "
              "(first_us - at_us) / 1e6 + 3600 AS head_gap, (at_us - last_us) / 1e6 AS tail_gap "
              "FROM summed WHERE n_samples > 1 AND last_us > first_us"))
_UP_LOOKBACK = _with(
    "request_log",
    "SELECT make_timestamp(at_us) AS ts, CAST(sum(up) AS BIGINT) AS services_up, count(*) AS n_known FROM ("
    "SELECT job, at_us, arg_max(CASE WHEN status = '200' THEN 1 ELSE 0 END, ROW(ts, event_id)) AS up FROM seen GROUP BY ALL) GROUP BY ALL",
    ("seen", f"SELECT *, {_steps(900, 1800)} FROM request_log WHERE job IN ('api', 'data-ingestion', 'ml-trainer')"))


ORACLES = {
    "s01_csv_scan": _with("perf_raw", f"SELECT {RECORD} FROM perf_raw"),
    "s01_csv_headers": READ_BACK,
    "t01_csv_headers_stream": READ_BACK,
    "t01_whole_files_stream": _with(
        "cleaned", "SELECT name, n_rows, n_bad, first_violation FROM (SELECT athlete_id AS name, count(*) AS n_rows, "
                   "CAST(0 AS BIGINT) AS n_bad, 'none' AS first_violation FROM cleaned WHERE "
                   "CAST(split_part(record_key, '-', 1) AS BIGINT) % 13 NOT IN (3, 7) GROUP BY 1) UNION ALL "
                   "SELECT concat('upload=', CAST(split_part(record_key, '-', 1) AS BIGINT) % 13), count(*), "
                   "count(*) FILTER (WHERE split_part(record_key, '-', 4) = '2'), 'sleep_quality_range' FROM cleaned "
                   "WHERE CAST(split_part(record_key, '-', 1) AS BIGINT) % 13 IN (3, 7) GROUP BY 1"),
    "s02_csv_guards": _with("perf_raw", "SELECT athlete_id, count(*) AS n_rows, CAST(0 AS BIGINT) AS n_damaged "
                                        "FROM perf_raw GROUP BY 1"),
    "s03_json_scan": _with("perf_raw", f"SELECT {RECORD} FROM perf_raw"),
    "s03_json_damaged": FIRST_DAMAGED,
    "t01_json_stream": FIRST_DAMAGED,
    "s04_frame_intake": _with("perf_raw", f"SELECT {RECORD} FROM perf_raw"),
    "s05_append_records": _with("perf_raw", "SELECT athlete_id, 2 * count(*) AS n_rows, 2 * count(*) AS n_ids, "
                                            "2 * count(*) AS n_stamped FROM perf_raw GROUP BY 1"),
    "s06_load_all": _with("perf_raw", f"SELECT {RECORD} FROM perf_raw"),
    "s07_prediction_log": _with(
        "requests", f"SELECT athlete_id, prediction_date, {FORMULA_SCORE} AS performance_score, "
                    f"'1.0' AS model_version, {_DEFAULTED}, {_FALSY} FROM requests"),
    "s08_training_run_log": _with(
        "scored", "SELECT '1.0' AS model_version, count(*) AS samples_used, 'completed' AS status, "
                  + ", ".join(
                      f"(SELECT round({_METRICS[m]}, 6) FROM centred WHERE split = 'test') AS test_{m}"
                      for m in _METRICS) + " FROM scored", ("centred", _CENTRED)),
    "s11_batch_limit": _with("perf_raw", "SELECT athlete_id, count(*) AS n_rows FROM perf_raw GROUP BY 1 "
                                         "HAVING count(*) > 600"),
    "v01_required_columns": _with(
        "perf_raw", "SELECT count(*) AS n_rows, 'athlete_id,record_date,recovery_score,sleep_hours,"
                    "sleep_quality,stress_level,training_load' AS missing_before_mapping FROM perf_raw"),
    "v02_coercion": _with(
        "perf_raw",
        "SELECT record_key, nullif(athlete_id, '') AS athlete_id, TRY_CAST(record_date AS DATE) AS record_date, "
        "sleep_hours, sleep_quality, TRY_CAST(training_load AS DOUBLE) AS training_load, stress_level, "
        "recovery_score, hrv, concat_ws(',', CASE WHEN TRY_CAST(record_date AS DATE) IS NULL THEN 'record_date' END, "
        "CASE WHEN TRY_CAST(training_load AS DOUBLE) IS NULL THEN 'training_load' END) AS failed FROM texts",
        ("texts", _TEXT)),
    "v03_optional_fields": _with(
        "perf_raw", "SELECT record_key, CASE WHEN recovery_score = 3 THEN NULL ELSE resting_heart_rate END "
                    "AS resting_heart_rate, CAST(NULL AS DOUBLE) AS hrv, performance_score FROM perf_raw"),
    "v04_rules_ingest": _rules(INGEST, "perf_raw"),
    "v04_row_violations": _with(
        "perf_raw", "SELECT record_key, concat_ws(',', "
                    + ", ".join(f"CASE WHEN {bad} THEN '{n}' END" for n, bad in INGEST.items())
                    + ") AS violations FROM perf_raw"),
    "v05_rules_api": _rules(API, "perf_raw"),
    "v06_rules_predict": _rules(PREDICT, "requests"),
    "v07_batch_policy": VERDICT,
    "v07_quarantine": _with(
        "perf_raw", "SELECT first_violation, CAST(sum(count(*)) OVER (PARTITION BY first_violation = 'none') AS BIGINT) AS n_told, "
                    "count(*) AS n_rows FROM (SELECT CASE WHEN recovery_score = 9 THEN 'record_date_unparsed' "
                    f"WHEN stress_level = 6 THEN 'training_load_unparsed' {_FIRST} ELSE 'none' END AS first_violation FROM ("
                    "SELECT * REPLACE (CASE WHEN recovery_score <> 10.5 THEN athlete_id END AS athlete_id, "
                    "CASE WHEN recovery_score <> 3 THEN hrv END AS hrv) FROM perf_raw)) GROUP BY 1"),
    "v07_whole_batches": _with(
        "perf_raw", "SELECT athlete_id, coalesce(first_violation, 'none') AS first_violation, count(*) AS n_batches, "
                    "CAST(sum(n_rows) AS BIGINT) AS n_rows, CAST(sum(n_bad) AS BIGINT) AS n_bad FROM ("
                    f"SELECT athlete_id, count(*) AS n_rows, count(*) FILTER (WHERE {ANY_BAD}) AS n_bad, "
                    f"min(CASE {_FIRST} END) AS first_violation FROM perf_raw GROUP BY athlete_id, record_date) GROUP BY 1, 2"),
    "c01_drop_incomplete": _with("perf_raw", f"SELECT record_key, {CRITICAL} FROM perf_raw WHERE {CRITICAL_PRESENT}"),
    "c02_clip_critical": _with(
        "perf_raw", f"SELECT record_key, {SLEEP} AS sleep_hours, {QUALITY} AS sleep_quality, "
                    f"{LOAD} AS training_load, {STRESS} AS stress_level, {RECOVERY} AS recovery_score FROM perf_raw"),
    "c03_clip_sensors": _with("perf_raw", f"SELECT record_key, {RHR} AS resting_heart_rate, {HRV} AS hrv FROM perf_raw"),
    "c04_clean": _with("cleaned", "SELECT * FROM cleaned"),
    "f01_median_fill": _with("featured", "SELECT record_key, resting_heart_rate_filled, hrv_filled FROM featured"),
    "f02_constant_fill": _with("cleaned", "SELECT record_key, CAST(60 AS DOUBLE) AS resting_heart_rate_filled, "
                                          "CAST(50 AS DOUBLE) AS hrv_filled FROM cleaned"),
    "f03_sleep_recovery_ratio": _with("featured", "SELECT record_key, sleep_recovery_ratio FROM featured"),
    "f04_load_stress_ratio": _with("featured", "SELECT record_key, load_stress_ratio FROM featured"),
    "f05_serving_defaults": _with("perf_raw", SERVED),
    "f06_falsy_defaults": _with("requests", f"SELECT record_key, {_FALSY} FROM requests"),
    "f07_serving_features": _with("perf_raw", f"SELECT record_key, {FEATURE_LIST} FROM "
                                              f"(SELECT *, {RATIOS} FROM served)", ("served", SERVED)),
    "f08_feature_alignment": _with("featured", f"SELECT record_key, {FEATURE_LIST} FROM featured"),
    "d01_labelled": _with("perf_raw", "SELECT record_key, performance_score FROM perf_raw "
                                      "WHERE performance_score IS NOT NULL"),
    "d03_hash_split": _with(
        "perf_raw", "SELECT record_key, CASE WHEN substr(md5(concat('42:', record_key)), 1, 8) < '33333333' "
                    "THEN 'test' ELSE 'train' END AS split FROM perf_raw"),
    "d04_exact_split": _with(
        "perf_raw", "SELECT record_key, CASE WHEN row_number() OVER (ORDER BY md5(concat('42:', record_key)), "
                    f"record_key, {RECORD}) <= ceil(CAST(0.2 AS DOUBLE) * count(*) OVER ()) "
                    "THEN 'test' ELSE 'train' END AS split FROM perf_raw"),
    "d02_minimum_rows": "SELECT * FROM (VALUES ('few', 10, 7), ('none', 10, 0)) AS t(subset, required, actual)",
    "d05_sample_counts": _with("parted", "SELECT split, count(*) AS n_rows FROM parted GROUP BY 1"),
    "d06_full_dataset": _with(
        "parted", "SELECT split, count(*) AS n_rows, "
                  + ", ".join(f"round(sum({f}), 3) AS sum_{f}" for f in (*FEATURES, "performance_score"))
                  + " FROM parted GROUP BY 1"),
    "m01_scaler_fit": _with("parted", "SELECT feature, round(mean, 6) AS mean, round(std, 6) AS std FROM stats",
                            ("stats", _STATS)),
    "m02_scale": _with(
        "parted", "SELECT record_key, "
                  + ", ".join(f"round(({f} - mean_{f}) / CASE WHEN std_{f} = 0 THEN 1 ELSE std_{f} END, 6) "
                              f"AS {f}_scaled" for f in FEATURES)
                  + " FROM parted CROSS JOIN wide",
        ("wide", "SELECT " + ", ".join(f"avg({f}) AS mean_{f}, stddev_pop({f}) AS std_{f}" for f in FEATURES)
                 + " FROM parted WHERE split = 'train'")),
    "s10_model_store": _with("parted", "SELECT count(*) AS n_rows, count(*) AS n_equal FROM parted"),
    "m03_forest_fit": _with("parted", "SELECT split, count(*) AS n_rows, 100 AS n_trees, 10 AS depth, 1 AS is_good "
                                      "FROM parted GROUP BY 1"),
    "m04_batch_predict": _with("cleaned", "SELECT athlete_id, count(*) AS n_rows, count(*) AS n_possible, "
                                          "CAST(0 AS BIGINT) AS n_far FROM cleaned GROUP BY 1"),
    "m14_score_job": _with("requests", "SELECT athlete_id, count(*) AS n_rows, count(*) AS n_possible, "
                                       "CAST(0 AS BIGINT) AS n_far, 1 AS is_equal "
                                       "FROM requests GROUP BY 1"),
    "m13_train_job": _with(
        "parted", "SELECT 'completed' AS status, '1.0' AS model_version, (SELECT count(*) FROM parted) AS samples_used, "
                  "concat(side, '_', name) AS metric, 1 AS is_good FROM (VALUES ('train'), ('test')) AS s(side) "
                  "CROSS JOIN (VALUES ('mae'), ('rmse'), ('r2')) AS m(name)"),
    "m06_mae": _one_metric("mae"),
    "m07_rmse": _one_metric("rmse"),
    "m08_r2": _one_metric("r2"),
    "m09_metric_rows": _with(
        "scored", " UNION ALL ".join(
            f"SELECT concat(split, '_{m}') AS metric, round({text}, 6) AS value FROM centred GROUP BY split"
            for m, text in _METRICS.items()), ("centred", _CENTRED)),
    "m11_version_stamp": _with("requests", "SELECT '1.0' AS model_version, count(*) AS n_rows FROM requests"),
    "m12_rounded_answer": _with("cleaned", f"SELECT record_key, round(round(({FORMULA_SCORE}) / 7, 6), 2) AS score "
                                           "FROM cleaned"),
    "m14_score_formula": _with("requests", f"SELECT athlete_id, prediction_date, round(round({FORMULA_SCORE}, 6), 2) "
                                           "AS performance_score, '1.0' AS model_version FROM requests"),
    "a01_latest_predictions": _with(
        "predictions", "SELECT id, athlete_id, prediction_date, performance_score, model_version, "
                       f"{ISO.format(c='created_at')} AS created_at FROM ({_latest('predictions', 500, 'created_at')})"),
    "a02_latest_training_runs": _with(
        "run_metrics", f"SELECT {ISO.format(c='run_date')} AS run_date, model_version, samples_used, test_mae, "
                       f"test_rmse, test_r2, status FROM ({_latest('run_metrics', 100, 'run_date')})"),
    "a03_latest_history": _with(
        "perf_raw", f"SELECT {RECORD} FROM (SELECT * FROM perf_raw ORDER BY {_ALL_FIELDS} LIMIT 5000)"),
    "a04_prediction_figures": _with(
        "predictions", "SELECT count(*) AS total_predictions, (SELECT performance_score FROM "
                       f"({_latest('predictions', 1, 'created_at')})) AS latest_score, "
                       "count(DISTINCT athlete_id) AS unique_athletes FROM predictions"),
    "a04_prediction_figures_page": _with(
        "predictions", "SELECT count(*) AS total_predictions, (SELECT performance_score FROM "
                       f"({_latest('predictions', 1, 'created_at')})) AS latest_score, "
                       "count(DISTINCT athlete_id) AS unique_athletes FROM predictions"),
    "a05_latest_run_figures": _with(
        "run_metrics", "SELECT model_version, test_mae, test_rmse, test_r2, "
                       + ", ".join(f"coalesce(printf('%.3f', {m}), 'N/A') AS {m}_shown" for m in _RUN_METRICS)
                       + f" FROM ({_latest('run_metrics', 1, 'run_date')})"),
    "a06_athlete_list": _with("perf_raw", "SELECT DISTINCT athlete_id FROM perf_raw WHERE athlete_id IS NOT NULL"),
    "a06_default_athletes": _with("perf_raw", "SELECT DISTINCT athlete_id FROM perf_raw ORDER BY 1 LIMIT 5"),
    "a07_athlete_filter": _with(
        "perf_raw", f"SELECT record_key, {RECORD} FROM perf_raw WHERE athlete_id IN "
                    "(SELECT DISTINCT athlete_id FROM perf_raw ORDER BY 1 LIMIT 5)"),
    "a08_history_figures": _with(
        "perf_raw", "SELECT count(*) AS records, count(DISTINCT athlete_id) AS athletes, "
                    "min(record_date) AS first_date, max(record_date) AS last_date FROM perf_raw"),
    "a09_daily_means": _with(
        "perf_raw", "SELECT record_date, round(avg(performance_score), 9) AS mean_performance_score FROM perf_raw "
                    "WHERE performance_score IS NOT NULL GROUP BY 1"),
    "a09_daily_means_rollup": _with(
        "perf_raw", "SELECT record_date, round(avg(performance_score), 9) AS mean_performance_score FROM perf_raw "
                    "WHERE performance_score IS NOT NULL GROUP BY 1"),
    "a08_history_rollup": _with(
        "perf_raw", "SELECT strftime(record_date, '%Y-%m') AS month, count(*) AS records, min(record_date) AS first_date, "
                    "max(record_date) AS last_date, 1 AS is_near FROM perf_raw GROUP BY 1"),
    "f01_median_sketch": _with(
        "perf_raw", "SELECT 'resting_heart_rate' AS sensor, count(resting_heart_rate) AS n_values, 1 AS is_near FROM perf_raw "
                    "UNION ALL SELECT 'hrv', count(hrv), 1 FROM perf_raw"),
    "a09_daily_performance": _with(
        "featured", "SELECT record_date, round(avg(performance_score), 9) AS mean_performance_score, "
                    "round(avg(sleep_recovery_ratio), 9) AS mean_sleep_recovery_ratio, "
                    "round(avg(load_stress_ratio), 9) AS mean_load_stress_ratio FROM featured "
                    "WHERE performance_score IS NOT NULL GROUP BY 1"),
    "a09_history_page": _with(
        "perf_raw", "SELECT record_date, 'performance_score' AS series, round(avg(performance_score), 9) AS value "
                    "FROM chosen WHERE performance_score IS NOT NULL GROUP BY 1", *_HISTORY_PAGE),
    "a08_history_page_figures": _with(
        "perf_raw", "SELECT count(*) AS records, count(DISTINCT athlete_id) AS athletes, "
                    "min(record_date) AS first_date, max(record_date) AS last_date FROM chosen", *_HISTORY_PAGE),
    "a05_training_page_figures": _with(
        "run_metrics", "SELECT model_version, "
                       + ", ".join(f"coalesce(printf('%.3f', {m}), 'N/A') AS {m}" for m in _RUN_METRICS)
                       + f" FROM ({_latest('run_metrics', 1, 'run_date')})"),
    "a10_series_in_order": _with("predictions", "SELECT id, created_at, performance_score FROM predictions"),
    "a11_melted_runs": _with("run_metrics", " UNION ALL ".join(
        f"SELECT id, run_date, '{m}' AS series, {m} AS value FROM run_metrics" for m in _RUN_METRICS)),
    "a13_previews": _with(
        "predictions training_runs perf_raw",
        " UNION ALL ".join(
            f"SELECT row_id, '{block}' AS page FROM (SELECT CAST({key} AS VARCHAR) AS row_id, {time} AS t "
            f"FROM {source} ORDER BY t DESC, row_id DESC LIMIT {n})"
            for block, source, key, time, n in (
                ("predictions", "predictions", "id", "created_at", 180),
                ("training_runs", "training_runs", "id", "run_date", 120),
                ("history", "perf_raw", "record_key", "record_date", 240)))),
    "a14_lenient_time": _with(
        "predictions", "SELECT id, TRY_CAST(CASE WHEN id % 11 = 0 THEN 'pending' "
                       "ELSE CAST(created_at AS VARCHAR) END AS TIMESTAMP) AS created_at FROM predictions"),
    "a15_iso_time": _with(
        "predictions", f"SELECT id, {ISO.format(c='CASE WHEN id % 11 <> 0 THEN created_at END')} AS created_at "
                       "FROM predictions"),
    "o01_measured_requests": _with("measured", "SELECT * FROM measured"),
    "o02_request_rate": _TITLED_RATES,
    "o02_sliding_rate": _with(
        "measured", "SELECT endpoint, window_start, count(*) / CAST(3600 AS DOUBLE) AS rate FROM "
                    f"(SELECT endpoint, {_bucket(15)} - step * INTERVAL 15 MINUTE AS window_start "
                    "FROM measured CROSS JOIN range(0, 4) AS steps(step) WHERE job = 'api') GROUP BY ALL"),
    "o03_latency_histogram": _with(
        "measured", "SELECT method, endpoint, le, count(*) FILTER (WHERE duration <= bound) AS n_requests "
                    "FROM measured CROSS JOIN bounds GROUP BY ALL",
        ("bounds", "SELECT * FROM (VALUES "
                   + ", ".join(f"('{b}', CAST({b} AS DOUBLE))" for b in BOUNDS)
                   + ", ('+Inf', CAST('infinity' AS DOUBLE))) AS b(le, bound)")),
    "o04_latency_quantiles": _quantiles(["endpoint"], {"p50": 0.5, "p95": 0.95}, "job = 'api'"),
    "o04_quantiles_of_buckets": _quantiles(["endpoint"], {"p50": 0.5, "p95": 0.95}, "job = 'api'"),
    "o05_services_up": _with("up_samples", "SELECT CAST(sum(up) AS BIGINT) AS services_up FROM up_samples "
                                           "WHERE ts = (SELECT max(ts) FROM up_samples)"),
    "o06_predictions_per_hour": _with(
        "measured", f"SELECT {_bucket(60)} AS window_start, count(*) AS increase FROM measured "
                    "WHERE job = 'api' AND endpoint = '/predict' GROUP BY 1"),
    "o07_trainings_per_day": _with(
        "measured", "SELECT date_trunc('day', ts) AS window_start, count(*) AS increase FROM measured "
                    "WHERE job = 'api' AND endpoint = '/train' AND status = '200' GROUP BY 1"),
    "o08_requests_per_minute": _with("measured", f"SELECT {_bucket(5)} AS window_start, {_rate(5, ' * 60')} "
                                                 "FROM measured GROUP BY 1"),
    "o08_requests_per_second": _with("measured", f"SELECT {_bucket(5)} AS window_start, {_rate(5)} "
                                                 "FROM measured GROUP BY 1"),
    "o09_rate_by_endpoint": _with(
        "measured", f"SELECT job, endpoint, {_bucket(5)} AS window_start, {_rate(5)} FROM measured "
                    "WHERE job IN ('data-ingestion', 'ml-trainer') GROUP BY ALL"),
    "o10_success_ratio": _with(
        "measured", f"SELECT {_bucket(5)} AS window_start, 1 - count(*) FILTER (WHERE status LIKE '5__') / count(*) "
                    "AS success_ratio FROM measured GROUP BY 1"),
    "o11_trainer_quantiles": _quantiles([], {"p50": 0.5, "p95": 0.95}, "job = 'ml-trainer'"),
    "o11_overall_p95": _quantiles([], {"p95": 0.95}),
    "o12_counter_increase": _INCREASE,
    "o06_range_increase": _RANGE_INCREASE,
    "o05_services_up_lookback": _UP_LOOKBACK,
    "o13_label_matchers": _with(
        "measured", "SELECT job, status, count(*) AS n_requests FROM measured "
                    "WHERE regexp_full_match(job, 'api|data-ingestion') AND regexp_full_match(status, '5..') GROUP BY ALL"),
    "o14_threshold_bands": _with(
        "measured up_samples",
        f"SELECT 'services_up' AS panel, ts, value, {_UP_BAND} AS colour FROM "
        "(SELECT ts, CAST(sum(up) AS DOUBLE) AS value FROM up_samples GROUP BY 1) UNION ALL "
        f"SELECT 'success_ratio' AS panel, ts, value, {_RATIO_BAND} AS colour FROM "
        f"(SELECT {_bucket(60)} AS ts, 1 - count(*) FILTER (WHERE status LIKE '5__') / count(*) AS value "
        "FROM measured GROUP BY 1)"),
    "o15_service_down": _DOWN_ALERT,
    "o16_hold_state": _held(
        "request_log", f"SELECT {_bucket(60)} AS window_start, count(*) FILTER (WHERE status LIKE '5__') / count(*) "
                       "AS value FROM request_log WHERE job = 'api' GROUP BY 1",
        [], "window_start", "value > 0.05", 7200, select="window_start, value, since, state"),
    "o17_high_latency": _LATENCY_ALERT,
    "o18_high_error_rate": _ERROR_ALERT,
    "o20_last_known": _with(
        "run_metrics", "SELECT model_version, max_by(test_mae, ROW(run_date, id)) AS test_mae FROM run_metrics "
                       "WHERE test_mae IS NOT NULL GROUP BY 1"),
    "t01_intake_stream": FIRST_CLEAN,
    "t02_rate_stream": _closed(_TITLED_RATES),
    "t02_counter_increase_stream":
        f"SELECT * FROM ({_INCREASE}) WHERE window_start + INTERVAL 1 HOUR <= "
        f"(SELECT max(CAST(ts AS TIMESTAMP)) - INTERVAL 10 MINUTE FROM events)",
    "t03_scoring_stream": _with(
        "perf_raw", "SELECT athlete_id, record_date AS prediction_date, '1.0' AS model_version, count(*) AS n_rows, "
                    "count(*) AS n_possible, CAST(0 AS BIGINT) AS n_far FROM perf_raw GROUP BY ALL"),
    "m11_published_versions": _with(
        "perf_raw", "SELECT CASE CAST(split_part(record_key, '-', 1) AS BIGINT) % 2 WHEN 0 THEN '2.0' ELSE '2.1' END "
                    "AS model_version, count(*) AS n_rows, count(*) AS n_equal FROM perf_raw GROUP BY 1"),
    "t04_alert_stream": _closed(_ERROR_ALERT),
    "t04_latency_alert_stream": _closed(_LATENCY_ALERT),
    "t04_service_down_stream": _DOWN_ALERT,
    "t04_event_alert_stream": f"WITH states AS ({_DOWN_ALERT}) SELECT * FROM states "
                              "WHERE ts < (SELECT max(ts) - INTERVAL 4 HOUR FROM states)",
}
