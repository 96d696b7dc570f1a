"""SQL for each registered query, written from the definitions for DuckDB over the same tables."""

from __future__ import annotations

from .queries import ARRIVALS, CLAIM, CLAIM_MANY, CUT_HOUR, LATE_CUT, NOW, WAVES

ORACLE: dict[str, str] = {}

# ---- shared table definitions ----------------------------------------------------------------------------

KIND = "user_id % 4"
TIER = "(user_id // 4) % 4"


def case(what: str, values, quote: bool = False) -> str:
    q = (lambda v: f"'{v}'") if quote else str
    return f"CASE {what} " + " ".join(f"WHEN {i} THEN {q(v)}" for i, v in enumerate(values)) + " END"


TIERS = ["on-prem", "private-cloud", "public-hot", "public-cold"]
INITIAL = ["on-prem", "private-cloud", "public-cold", "public-hot"]
PERSONA = ["business_hours", "batch_processing", "cold_archive", "viral_content"]
ATTRIBUTES = f"""
  printf('ds_%06d', user_id) AS dataset_id,
  {case(KIND, PERSONA, True)} AS persona,
  {case(TIER, TIERS, True)} AS current_backend,
  {case(KIND, INITIAL, True)} AS initial_backend,
  CAST({case(KIND, ["10 + (user_id * 7919) % 490", "500 + (user_id * 7919) % 4500",
                    "1000 + (user_id * 7919) % 49000", "50 + (user_id * 7919) % 950"])} AS DOUBLE) AS size_gb"""


def scaled(column: str, factors) -> str:
    return (
        f"CAST(floor(CAST(coalesce({column}, 0) AS DECIMAL(18,2)) * "
        f"CAST({case(KIND, factors)} AS DECIMAL(6,3))) AS BIGINT)"
    )


CTE: dict[str, str] = {}
CTE["hourly"] = """
  SELECT user_id, CAST(floor(epoch(date_trunc('hour', ts)) / 3600) AS BIGINT) AS hour_no,
         sum(CASE WHEN event_type IN ('view', 'click', 'signup') THEN CAST(value AS DECIMAL(18,2)) END) AS r,
         sum(CASE WHEN event_type = 'purchase' THEN CAST(value AS DECIMAL(18,2)) END) AS w,
         sum(CAST(json_extract(props, '$.k') AS BIGINT)) AS k
  FROM events GROUP BY 1, 2"""
CTE["access"] = f"""
  SELECT user_id, hour_no, hour_no * 3600 AS timestamp,
         {scaled("r", ["20.000", "0.400", "0.020", "40.000"])} AS reads_1h,
         {scaled("w", ["2.000", "0.200", "0.002", "0.500"])} AS writes_1h,
         CAST(coalesce(k, 0) * 1024 AS BIGINT) AS bytes_read_1h,
         CAST(hour_no % 24 AS INTEGER) AS hour_of_day, CAST((hour_no // 24 + 3) % 7 AS INTEGER) AS day_of_week,
         {ATTRIBUTES}
  FROM hourly"""
CTE["jobs"] = f"""
  SELECT *, CASE WHEN status = 'COMPLETE' THEN round(o_totalprice / 10000, 3) END AS duration_sec,
         CASE WHEN status = 'PENDING' AND attempts > 0 THEN created_at + 3.0 * attempts END AS retry_after
  FROM (
    SELECT CAST(o_orderkey AS VARCHAR) AS job_id, o_orderkey, o_totalprice,
           printf('ds_%06d', o_custkey // 10) AS dataset_id,
           {case("o_orderkey % 4", TIERS, True)} AS from_backend,
           {case("(o_orderkey + 1) % 4", TIERS, True)} AS to_backend, o_orderpriority AS reason,
           CASE WHEN o_orderstatus = 'F' THEN 'COMPLETE' WHEN o_orderstatus = 'P' THEN 'PENDING'
                WHEN o_orderkey % 3 = 0 THEN 'FAILED' ELSE 'RUNNING' END AS status,
           CAST(o_orderkey % 4 AS INTEGER) AS attempts, CAST(epoch(o_orderdate) AS DOUBLE) AS created_at
    FROM orders)"""


def fault(number: int, normal: str, faults: dict[int, str]) -> str:
    cases = " ".join(f"WHEN {k} THEN {v}" for k, v in faults.items())
    return f"CASE fault {cases} ELSE {normal} END" if faults else normal


BODY = " || ".join([
    """'"timestamp":' || timestamp""",
    "CASE fault WHEN 0 THEN '' ELSE ',\"dataset_id\":\"' || dataset_id || '\"' END",
    "',\"reads_1h\":' || " + fault(
        1, "CAST(reads_1h AS VARCHAR)", {1: "'null'", 2: "'\"5\"'", 3: "'2.0'", 4: "'-1'"}),
    "',\"writes_1h\":' || " + fault(9, "CAST(writes_1h AS VARCHAR)", {9: "'true'"}),
    "',\"bytes_read_1h\":' || " + fault(14, "CAST(bytes_read_1h AS VARCHAR)", {14: "'-1024'"}),
    "',\"hour_of_day\":' || " + fault(6, "CAST(hour_of_day AS VARCHAR)", {6: "'24'", 7: "'-1'"}),
    "',\"day_of_week\":' || " + fault(8, "CAST(day_of_week AS VARCHAR)", {8: "'7'"}),
    "',\"current_backend\":\"' || " + fault(13, "current_backend", {13: "'tape-vault'"}) + " || '\"'",
    "CASE fault WHEN 18 THEN '' WHEN 19 THEN ',\"initial_backend\":null' ELSE ',\"initial_backend\":\"' || initial_backend || '\"' END",
    "',\"size_gb\":' || " + fault(5, "CAST(CAST(size_gb AS BIGINT) AS VARCHAR)", {5: "'-3.5'"}),
])
CTE["raw"] = f"""
  SELECT hour_no AS seq,
         CASE fault WHEN 10 THEN '[1,2]' WHEN 11 THEN 'null'
              ELSE '{{' || {BODY} || CASE fault WHEN 12 THEN '' ELSE '}}' END ||
                CASE fault WHEN 15 THEN ' end' WHEN 16 THEN '] garbage' WHEN 17 THEN '],[1' ELSE '' END END AS value
  FROM (SELECT *, (user_id * 7 + hour_no) % 64 AS fault FROM access)"""

INTEGERS = ["timestamp", "reads_1h", "writes_1h", "bytes_read_1h", "hour_of_day", "day_of_week"]
FIELDS = ["timestamp", "dataset_id", "reads_1h", "writes_1h", "bytes_read_1h", "hour_of_day", "day_of_week",
          "current_backend", "size_gb"]


def _rules() -> str:
    out = ["WHEN doc IS NULL THEN 'invalid json'", "WHEN json_type(doc) <> 'OBJECT' THEN 'event must be object'"]
    for f in FIELDS:
        if f in ("dataset_id", "current_backend"):
            good = "('VARCHAR')"
        elif f == "size_gb":
            good = "('BIGINT', 'UBIGINT', 'DOUBLE', 'BOOLEAN')"
        else:
            good = "('BIGINT', 'UBIGINT', 'BOOLEAN')"
        out.append(f"WHEN json_type(doc, '$.{f}') IS NULL THEN 'missing field: {f}'")
        out.append(f"WHEN json_type(doc, '$.{f}') NOT IN {good} THEN 'invalid type for {f}'")
    out.append("WHEN v_reads_1h < 0 OR v_writes_1h < 0 OR v_size_gb < 0 THEN 'negative metrics not allowed'")
    out.append("WHEN v_hour_of_day NOT BETWEEN 0 AND 23 THEN 'hour_of_day out of range'")
    out.append("WHEN v_day_of_week NOT BETWEEN 0 AND 6 THEN 'day_of_week out of range'")
    return "CASE " + "\n    ".join(out) + " END"


def _number(f: str, kind: str) -> str:
    text = f"json_extract_string(doc, '$.{f}')"
    return f"CASE {text} WHEN 'true' THEN 1 WHEN 'false' THEN 0 ELSE TRY_CAST({text} AS {kind}) END AS v_{f}"


CTE["checked"] = f"""
  SELECT *, {_rules()} AS error FROM (
    SELECT *, {", ".join(_number(f, "INTEGER" if f in ("hour_of_day", "day_of_week") else "BIGINT") for f in INTEGERS)},
           {_number("size_gb", "DOUBLE")},
           json_extract_string(doc, '$.dataset_id') AS v_dataset_id,
           json_extract_string(doc, '$.current_backend') AS v_current_backend,
           CASE WHEN json_exists(doc, '$.initial_backend') THEN json_extract_string(doc, '$.initial_backend')
                ELSE json_extract_string(doc, '$.current_backend') END AS v_initial_backend
    FROM (SELECT *, CASE WHEN json_valid(value) THEN CAST(value AS JSON) END AS doc FROM raw))"""
CTE["valid"] = (
    "SELECT seq, " + ", ".join(f"v_{f} AS {f}" for f in FIELDS) + ", v_initial_backend AS initial_backend "
    "FROM checked WHERE error IS NULL"
)

# Newest-first numbering of a table's rows per dataset; ``rn`` = 1 is the last.
CTE["ranked"] = "SELECT *, row_number() OVER (PARTITION BY dataset_id ORDER BY timestamp DESC) AS rn FROM access"
CTE["ranked_valid"] = "SELECT *, row_number() OVER (PARTITION BY dataset_id ORDER BY seq DESC) AS rn FROM valid"
CTE["state"] = """
  SELECT dataset_id, any_value(size_gb) AS size_gb, any_value(current_backend) AS current_backend,
         any_value(initial_backend) AS initial_backend FROM access GROUP BY 1"""
CTE["state_valid"] = """
  SELECT dataset_id, arg_max(size_gb, seq) AS size_gb, arg_min(current_backend, seq) AS current_backend,
         arg_min_null(initial_backend, seq) AS initial_backend FROM valid GROUP BY 1"""


def window(source: str, hours: int) -> str:
    """Statistics of the last ``hours`` entries per dataset of a newest-first numbered table."""
    avg = lambda c, when: f"coalesce(avg(CASE WHEN {when} THEN {c} END), 0)"
    older = "CASE WHEN n >= 12 THEN rn BETWEEN 7 AND 12 ELSE rn > n - greatest(1, n // 2) END"
    return f"""
  SELECT dataset_id, any_value(n) AS n, {avg("reads_1h", "rn <= 6")} AS recent_reads,
         {avg("writes_1h", "rn <= 6")} AS recent_writes, {avg("reads_1h", older)} AS older_reads,
         {avg("writes_1h", older)} AS older_writes, CAST(sum(reads_1h) AS BIGINT) AS sum_reads,
         CAST(sum(writes_1h) AS BIGINT) AS sum_writes, CAST(sum(bytes_read_1h) AS BIGINT) AS sum_bytes,
         max(reads_1h) AS peak_reads
  FROM (SELECT *, count(*) OVER (PARTITION BY dataset_id) AS n FROM {source} WHERE rn <= least({hours}, 24))
  GROUP BY dataset_id"""


def forecast(stats: str, state: str, hours: int) -> str:
    f = lambda k: (
        f"recent_{k} * greatest(0.7, least(2.0, recent_{k} / greatest(older_{k}, 1))) * {float(hours)} AS fc_{k}"
    )
    return f"""
  SELECT s.*, w.* EXCLUDE (dataset_id), {f("reads")}, {f("writes")}, sum_reads / n AS avg_reads,
         sum_writes / n AS avg_writes
  FROM {state} s JOIN {stats} w USING (dataset_id)"""


CTE["win24"], CTE["win12"], CTE["win8"] = window("ranked", 24), window("ranked", 12), window("ranked", 8)
CTE["fc24"], CTE["fc12"], CTE["fc8"] = (forecast(f"win{h}", "state", h) for h in (24, 12, 8))
CTE["win_valid"] = window("ranked_valid", 24)
CTE["fc_valid"] = forecast("win_valid", "state_valid", 24)
CTE["prices"] = """
  SELECT * FROM (VALUES (0, 'on-prem', 0.40::DOUBLE, 0.00::DOUBLE, 0.00::DOUBLE, 0.01::DOUBLE),
    (1, 'private-cloud', 0.25, 0.05, 0.05, 0.03), (2, 'public-hot', 0.20, 0.04, 0.04, 0.07),
    (3, 'public-cold', 0.04, 0.001, 0.001, 4.0)) t(ord, backend, p_store, p_read, p_write, p_latency)"""


def cost(p: str, hours: int = 24, latency: str = "1") -> str:
    return (
        f"(size_gb * {p}.p_store * ({hours} / 720.0::DOUBLE) + (fc_reads * {p}.p_read + fc_writes * {p}.p_write)"
        f" + {latency} * (fc_reads * {p}.p_latency * 0.10::DOUBLE))"
    )


def both_costs(source: str) -> str:
    return f"""
  SELECT f.dataset_id, f.initial_backend, f.current_backend, {cost("i")} AS initial_cost, {cost("c")} AS current_cost
  FROM {source} f JOIN prices i ON i.backend = coalesce(nullif(f.initial_backend, ''), f.current_backend)
  JOIN prices c ON c.backend = f.current_backend"""


def cost_totals(costs: str, source: str) -> str:
    return f"""
  SELECT sum(initial_cost) AS b, sum(current_cost) AS o, (SELECT count(*) FROM {source}) - count(*) AS unpriced_datasets,
         (SELECT count(*) * 0.001::DOUBLE FROM jobs WHERE status = 'COMPLETE') AS m FROM {costs}"""


CTE["costs"], CTE["costs_valid"] = both_costs("fc24"), both_costs("fc_valid")
CTE["cost_totals"] = cost_totals("costs", "fc24")
CTE["cost_totals_valid"] = cost_totals("costs_valid", "fc_valid")


def place(source: str, hot: float = 100, cold: float = 10, extra: str = "") -> str:
    """Decision for every row of ``source``; ``key`` columns besides dataset_id come in ``extra``."""
    keys = "dataset_id, current_backend" + extra
    lat = "CASE WHEN cold THEN 0 ELSE 1 END"
    return f"""
  SELECT {keys}, CASE WHEN hold THEN current_backend ELSE target END AS target_backend,
         CASE WHEN hold THEN 'hysteresis-hold' WHEN target = 'public-cold' THEN 'cold-data-cooldown'
              WHEN peak_reads >= {hot} THEN 'hot-read-low-latency' ELSE 'forecasted-cost-reduction' END AS reason,
         round(cost_here, 4) AS current_cost, round(CASE WHEN hold THEN cost_here ELSE best END, 4) AS target_cost,
         CASE WHEN hold THEN 0.0::DOUBLE ELSE round(gain, 4) END AS savings,
         CASE WHEN hold THEN 0.0::DOUBLE ELSE round(pct, 2) END AS savings_percent
  FROM (
    SELECT *, target <> current_backend AND gain < 0.5 AND pct < 5.0 AS hold FROM (
      SELECT *, cost_here - best AS gain,
             CASE WHEN cost_here <> 0 THEN (cost_here - best) / cost_here * 100 ELSE 0.0::DOUBLE END AS pct FROM (
        SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY best, ord) AS choice FROM (
          SELECT f.*, p.ord, p.backend AS target, {cost("p", 24, lat)} AS best, {cost("c", 24, lat)} AS cost_here
          FROM (SELECT *, avg_reads <= {cold} AND peak_reads < {hot} AS cold,
                       peak_reads >= {hot} OR (CASE WHEN fc_reads <> 0 THEN fc_reads / 24 ELSE avg_reads END) >= {hot}
                         AS hot FROM {source}) f
          JOIN prices c ON c.backend = f.current_backend, prices p
          WHERE CASE WHEN hot THEN p.p_latency <= 0.10 WHEN cold THEN true ELSE p.backend <> 'public-cold' END))
      WHERE choice = 1))"""


CTE["placed"] = place("fc24")
CTE["placed_other"] = place("fc24", 400, 500)
CTE["placed_valid"] = place("fc_valid")


def number_text(x: str, places: int) -> str:
    return rf"regexp_replace(CAST(CAST({x} AS DECIMAL(38,{places})) AS VARCHAR), '(\.\d+?)0+$', '\1')"


CTE["scanned"] = f"""
  SELECT * FROM (
    SELECT dataset_id, current_backend AS from_backend, target_backend AS to_backend,
           reason || ': save $' || {number_text("savings", 4)} || '/day (' || {number_text("savings_percent", 2)} || '%)'
             AS reason
    FROM placed WHERE target_backend <> current_backend) c
  WHERE NOT EXISTS (SELECT 1 FROM jobs j WHERE j.status = 'PENDING' AND j.dataset_id = c.dataset_id
                    AND j.reason = c.reason)"""


def trailing(source: str, order: str, keep: str, hours: int = 24) -> str:
    """Window statistics after every row of ``source``."""
    w = f"PARTITION BY dataset_id ORDER BY {order}"
    rows = lambda a, b: f"OVER ({w} ROWS BETWEEN {a} AND {b})"
    last = rows(f"{hours - 1} PRECEDING", "CURRENT ROW")
    recent = rows(f"{min(6, hours) - 1} PRECEDING", "CURRENT ROW")
    before = rows("11 PRECEDING", "6 PRECEDING")
    older = lambda c: (
        f"CASE WHEN n >= 12 THEN before_{c} ELSE list_avg(list_slice(all_{c}, 1, greatest(1, n // 2))) END AS older_{c}"
    )
    return f"""
  SELECT *, {older("reads")}, {older("writes")}, sum_reads / n AS avg_reads FROM (
    SELECT {keep}, count(*) {last} AS n, avg(reads_1h) {recent} AS recent_reads, avg(writes_1h) {recent} AS recent_writes,
           avg(reads_1h) {before} AS before_reads, avg(writes_1h) {before} AS before_writes,
           list(reads_1h) {last} AS all_reads, list(writes_1h) {last} AS all_writes,
           CAST(sum(reads_1h) {last} AS DOUBLE) AS sum_reads, max(reads_1h) {last} AS peak_reads
    FROM {source})"""


CTE["walked"] = trailing(
    "valid", "seq", "dataset_id, seq, timestamp, reads_1h, size_gb, first(current_backend) OVER "
    "(PARTITION BY dataset_id ORDER BY seq) AS current_backend")
CTE["hot_rows"] = """
  SELECT *, recent_reads * greatest(0.7, least(2.0, recent_reads / greatest(older_reads, 1))) * 24.0 AS fc_reads,
         recent_writes * greatest(0.7, least(2.0, recent_writes / greatest(older_writes, 1))) * 24.0 AS fc_writes
  FROM walked WHERE reads_1h > 100 AND current_backend = 'public-cold'"""
CTE["reacted"] = place("hot_rows", extra=", seq, timestamp, reads_1h, n")

# Events that come late: times in steps of two hours, arrival numbers that permute the hours.
CTE["late"] = f"""
  SELECT * REPLACE (timestamp - timestamp % 7200 AS timestamp, (seq * 7919) % {ARRIVALS} AS seq) FROM valid"""
CTE["ranked_late"] = "SELECT *, row_number() OVER (PARTITION BY dataset_id ORDER BY timestamp DESC, seq DESC) AS rn FROM late"
CTE["state_late"] = f"""
  SELECT dataset_id, arg_max(size_gb, timestamp * {ARRIVALS} + seq) AS size_gb, arg_min(current_backend, seq) AS current_backend,
         arg_min_null(initial_backend, seq) AS initial_backend FROM late GROUP BY 1"""
CTE["late_rows"] = f"""
  SELECT l.dataset_id, l.seq, l.timestamp, l.reads_1h, l.writes_1h, l.size_gb, s.current_backend, l.fresh FROM (
    SELECT *, 1 AS fresh FROM late WHERE seq >= {LATE_CUT} UNION ALL
    SELECT *, 0 AS fresh FROM late WHERE seq < {LATE_CUT}
    QUALIFY row_number() OVER (PARTITION BY dataset_id ORDER BY timestamp DESC, seq DESC) <= 24) l
  JOIN state_late s USING (dataset_id)"""
CTE["walked_late"] = trailing(
    "late_rows", "timestamp, fresh, seq", "dataset_id, seq, timestamp, reads_1h, size_gb, current_backend, fresh")
CTE["hot_late"] = CTE["hot_rows"].replace("FROM walked WHERE", "FROM walked_late WHERE fresh = 1 AND")
CTE["reacted_late"] = place("hot_late", extra=", seq, timestamp, reads_1h, n")


def sql(body: str, *names: str) -> str:
    """``body`` with the shared definitions it needs, in the order in which they are defined."""
    need: set[str] = set()

    def add(text: str) -> None:
        for name in CTE:
            if name not in need and _mentions(text, name):
                need.add(name)
                add(CTE[name])

    add(body)
    for name in names:
        need.add(name)
    parts = ",\n".join(f"{name} AS ({CTE[name]})" for name in CTE if name in need)
    return f"WITH {parts}\n{body}" if parts else body


def _mentions(text: str, name: str) -> bool:
    import re

    return re.search(rf"\b(FROM|JOIN|,)\s+{name}\b", text) is not None


def put(name: str, body: str) -> None:
    ORACLE[name] = sql(body)


# ---- events and state ------------------------------------------------------------------------------------

put("access_hourly", "SELECT * EXCLUDE (user_id, hour_no) FROM access")
put("event_validation", "SELECT seq, value, error IS NULL AS valid, error FROM checked")
put("accepted_events", "SELECT * FROM valid")
put("dead_letter_events",
    f"SELECT error, value AS payload, {NOW}::DOUBLE AS ts FROM checked WHERE error IS NOT NULL")
put("run_counters", "SELECT coalesce(error, 'accepted') AS outcome, count(*) AS events FROM checked GROUP BY 1")
put("event_throughput", """
SELECT events, accepted, duration_sec, round(accepted / duration_sec, 2) AS events_per_sec,
       round(accepted / duration_sec * 3600, 2) AS events_per_hour
FROM (SELECT count(*) AS events, count(*) FILTER (WHERE error IS NULL) AS accepted,
             CAST((max(seq) - min(seq) + 1) * 3600 AS DOUBLE) AS duration_sec FROM checked)""")
put("event_messages", """
SELECT dataset_id AS key,
       '{"timestamp":' || timestamp || ',"dataset_id":"' || dataset_id || '","reads_1h":' || reads_1h ||
       ',"writes_1h":' || writes_1h || ',"bytes_read_1h":' || bytes_read_1h || ',"hour_of_day":' || hour_of_day ||
       ',"day_of_week":' || day_of_week || ',"current_backend":"' || current_backend || '","initial_backend":' ||
       coalesce('"' || initial_backend || '"', 'null') || '}' AS value
FROM valid""")
put("history_entries", """
SELECT dataset_id, least(c, 24) - rn AS pos, timestamp, reads_1h, writes_1h, bytes_read_1h, hour_of_day, day_of_week
FROM (SELECT *, count(*) OVER (PARTITION BY dataset_id) AS c FROM ranked) WHERE rn <= 24""")
STATE_ROW = """
SELECT r.dataset_id, any_value(s.size_gb) AS size_gb, any_value(s.initial_backend) AS initial_backend,
       any_value(s.current_backend) AS current_backend, arg_min(timestamp, rn) AS last_timestamp,
       arg_min(reads_1h, rn) AS reads_1h, arg_min(writes_1h, rn) AS writes_1h, arg_min(bytes_read_1h, rn) AS bytes_read_1h,
       count(*) AS entries, arg_max(timestamp, rn) AS first_timestamp, CAST(sum(reads_1h) AS BIGINT) AS history_reads
FROM {ranked} r JOIN {state} s ON s.dataset_id = r.dataset_id WHERE rn <= 24 {where} GROUP BY 1"""
put("dataset_state", STATE_ROW.format(ranked="ranked_valid", state="state_valid", where=""))
ORACLE["dataset_state_upsert"] = ORACLE["dataset_state"]
put("dataset_state_event_time", STATE_ROW.format(ranked="ranked_late", state="state_late", where=""))
put("hot_reactions_event_time", "SELECT * FROM reacted_late")
put("dataset_detail", STATE_ROW.format(ranked="ranked", state="state", where="AND r.dataset_id = 'ds_000007'"))
put("duplicate_dataset_keys", "SELECT dataset_id, count(*) AS rows FROM state GROUP BY 1 HAVING count(*) > 1")
put("duplicate_access_keys", "SELECT dataset_id, count(*) AS rows FROM access GROUP BY 1 HAVING count(*) > 1")
put("hot_reactions", "SELECT * FROM reacted")
put("hot_reactions_on_state", f"SELECT * FROM reacted WHERE seq >= {CUT_HOUR}")
put("reaction_job_list", f"""
SELECT dataset_id, arg_min(current_backend, seq) AS from_backend, arg_min(target_backend, seq) AS to_backend,
       'real-time-hot-read: ' || reason AS reason, 'PENDING' AS status, 0 AS attempts, {NOW}::DOUBLE AS created_at
FROM reacted GROUP BY dataset_id, reason""")

# ---- forecast, prices, placement -------------------------------------------------------------------------

FORECAST = """
SELECT dataset_id, round(fc_reads, 4) AS reads, round(fc_writes, 4) AS writes, sum_bytes AS bytes_read FROM {}"""
put("forecast_access", FORECAST.format("fc24"))
put("forecast_access_8h", FORECAST.format("fc8"))
put("access_stats", """
SELECT dataset_id, n, round(avg_reads, 4) AS avg_reads, peak_reads, round(avg_writes, 4) AS avg_writes FROM fc24""")
put("tier_costs", f"""
SELECT dataset_id, ord, backend, round({cost("p")}, 4) AS cost, round({cost("p", 24, "0")}, 4) AS cost_without_latency
FROM fc24 f, prices p""")
put("window_cost_12h", f"""
SELECT dataset_id, backend, round({cost("p", 12)}, 4) AS cost FROM fc12 f JOIN prices p ON p.backend = f.current_backend""")
put("dataset_costs", """
SELECT dataset_id, initial_backend, current_backend, round(initial_cost, 4) AS initial_cost,
       round(current_cost, 4) AS current_cost FROM costs""")
put("baseline_cost", "SELECT round(b, 4) AS baseline, unpriced_datasets FROM cost_totals")
put("optimized_cost", """
SELECT round(o + m, 4) AS optimized, round(m, 4) AS migration_cost, unpriced_datasets FROM cost_totals""")
SUMMARY = """
SELECT round(b, 2) AS baseline, round(o + m, 2) AS optimized, round(m, 2) AS migration_cost,
       round(b - (o + m), 2) AS savings, round(CASE WHEN b <> 0 THEN (b - (o + m)) / b * 100 ELSE 0 END, 2)
         AS savings_percent, unpriced_datasets FROM {}"""
put("cost_summary", SUMMARY.format("cost_totals"))
put("cost_summary_after_faults", SUMMARY.format("cost_totals_valid"))
put("unpriced_datasets", """
SELECT dataset_id, current_backend, initial_backend
FROM (SELECT * REPLACE (coalesce(nullif(initial_backend, ''), current_backend) AS initial_backend) FROM state_valid)
WHERE current_backend NOT IN (SELECT backend FROM prices) OR initial_backend NOT IN (SELECT backend FROM prices)""")
put("placement_decisions", "SELECT * FROM placed")
put("placement_other_limits", "SELECT * FROM placed_other")
put("placement_after_faults", "SELECT * FROM placed_valid")
put("best_backend", "SELECT dataset_id, target_backend, reason FROM placed")

# ---- jobs ------------------------------------------------------------------------------------------------

put("scan_jobs", f"""
SELECT dataset_id, from_backend, to_backend, reason, 'PENDING' AS status, 0 AS attempts, {NOW}::DOUBLE AS created_at
FROM scanned""")
put("scan_job_count", "SELECT count(*) AS jobs_created FROM scanned")
put("suppressed_jobs", f"""
SELECT dataset_id, arg_min(from_backend, job_id) AS from_backend, arg_min(to_backend, job_id) AS to_backend, reason,
       'PENDING' AS status, {NOW}::DOUBLE AS created_at
FROM (SELECT * REPLACE (CASE WHEN status = 'COMPLETE' THEN reason || ' again' ELSE reason END AS reason) FROM jobs)
GROUP BY dataset_id, reason HAVING count(*) FILTER (WHERE status = 'PENDING') = 0""")
put("recent_jobs", """
SELECT job_id, dataset_id, status, created_at FROM jobs ORDER BY created_at DESC, job_id LIMIT 100""")
CLAIMED = f"""(SELECT job_id FROM jobs WHERE status = 'PENDING' AND (retry_after IS NULL OR retry_after <= {NOW})
  ORDER BY created_at, job_id LIMIT {CLAIM})"""
put("next_jobs", f"""
SELECT job_id, 'RUNNING' AS status, attempts + 1 AS attempts, {NOW}::DOUBLE AS started_at, created_at
FROM jobs WHERE job_id IN {CLAIMED}""")
put("claimed_job_table", f"""
SELECT job_id, dataset_id, CASE WHEN hit THEN 'RUNNING' ELSE status END AS status,
       CASE WHEN hit THEN attempts + 1 ELSE attempts END AS attempts, CASE WHEN hit THEN {NOW}::DOUBLE END AS started_at
FROM (SELECT *, job_id IN {CLAIMED.replace(f"LIMIT {CLAIM}", f"LIMIT {CLAIM_MANY}")} AS hit FROM jobs)""")
put("job_outcomes", f"""
SELECT job_id,
       CASE WHEN good THEN 'COMPLETE' WHEN bad AND attempts >= 3 THEN 'FAILED' WHEN bad THEN 'PENDING' ELSE status END
         AS status,
       attempts, CASE WHEN good OR (bad AND attempts >= 3) THEN {NOW}::DOUBLE END AS finished_at,
       CASE WHEN good THEN round((o_orderkey % 1000) / 7, 3) ELSE duration_sec END AS duration_sec,
       CASE WHEN bad THEN 'mover lost ' || dataset_id END AS error,
       CASE WHEN bad AND attempts < 3 THEN {NOW}::DOUBLE + 3.0 * attempts ELSE retry_after END AS retry_after
FROM (SELECT *, status = 'RUNNING' AND o_orderkey % 2 = 0 AS good, status = 'RUNNING' AND o_orderkey % 2 = 1 AS bad
      FROM jobs)""")
put("moved_datasets", f"""
SELECT s.dataset_id, s.initial_backend, coalesce(m.to_backend, s.current_backend) AS current_backend,
       CASE WHEN m.dataset_id IS NOT NULL THEN {NOW}::DOUBLE END AS last_migrated_at
FROM state s LEFT JOIN (
  SELECT dataset_id, to_backend FROM jobs WHERE status = 'COMPLETE'
  QUALIFY row_number() OVER (PARTITION BY dataset_id ORDER BY created_at DESC, job_id DESC) = 1) m USING (dataset_id)""")
OLDEST = "(SELECT o_orderkey FROM orders WHERE o_orderstatus = 'O' ORDER BY o_orderdate, CAST(o_orderkey AS VARCHAR) LIMIT 1)"
put("claimed_requests", f"""
SELECT CAST(o_orderkey AS VARCHAR) AS request_id,
       CASE WHEN o_orderkey = {OLDEST} THEN 'RUNNING' WHEN o_orderstatus = 'O' THEN 'PENDING' ELSE 'COMPLETE' END AS status,
       CAST(epoch(o_orderdate) AS DOUBLE) AS created_at,
       CASE WHEN o_orderkey = {OLDEST} THEN {NOW}::DOUBLE END AS started_at
FROM orders""")
put("finished_requests", f"""
SELECT CAST(o_orderkey AS VARCHAR) AS request_id,
       CASE WHEN o_orderkey = {OLDEST} OR o_orderstatus <> 'O' THEN 'COMPLETE' ELSE 'PENDING' END AS status,
       CASE WHEN o_orderkey = {OLDEST} THEN {NOW}::DOUBLE END AS started_at,
       CASE WHEN o_orderkey = {OLDEST} THEN {NOW + 5}::DOUBLE END AS finished_at,
       CASE WHEN o_orderkey = {OLDEST} THEN (SELECT count(*) FROM scanned) END AS jobs_created
FROM orders""")

# ---- reports ---------------------------------------------------------------------------------------------

CTE["day"] = """
  SELECT dataset_id, CAST(sum(reads_1h) AS BIGINT) AS reads, CAST(sum(writes_1h) AS BIGINT) AS writes
  FROM ranked WHERE rn <= 24 GROUP BY 1"""


CTE["day_valid"] = CTE["day"].replace("FROM ranked ", "FROM ranked_valid ")


def observed(tier: str, other: str = "current_backend", valid: str = "") -> str:
    """Sums at one tier over the datasets with a price at both."""
    return f"""
  SELECT sum(size_gb * p.p_store * (24 / 720.0::DOUBLE)) AS storage, sum(reads * p.p_read + writes * p.p_write) AS access_,
         sum(reads * p.p_latency * 0.0001::DOUBLE) AS latency,
         (SELECT count(*) FROM state{valid}) - count(*) AS unpriced_datasets
  FROM (SELECT * REPLACE (coalesce(nullif(initial_backend, ''), current_backend) AS initial_backend) FROM state{valid}) s
  JOIN day{valid} d USING (dataset_id) JOIN prices p ON p.backend = s.{tier} JOIN prices q ON q.backend = s.{other}"""


CTE["seen"] = observed("current_backend")
CTE["seen_initial"] = observed("initial_backend")
CTE["seen_valid"] = observed("current_backend", "initial_backend", "_valid")
CTE["seen_initial_valid"] = observed("initial_backend", "current_backend", "_valid")
CTE["fee"] = "SELECT count(*) * 0.5::DOUBLE AS migration FROM jobs WHERE status = 'COMPLETE'"
put("observed_baseline", """
SELECT round(storage, 2) AS storage, round(access_, 2) AS access, round(latency, 2) AS latency,
       round(storage + access_ + latency, 2) AS total, unpriced_datasets FROM seen""")
put("observed_optimized", """
SELECT round(storage, 2) AS storage, round(access_, 2) AS access, round(latency, 2) AS latency,
       round(storage + access_ + latency + migration, 2) AS total, round(migration, 2) AS migration,
       unpriced_datasets FROM seen, fee""")


def savings(base: str, now: str = "seen") -> str:
    return f"""
  SELECT b.storage + b.access_ + b.latency AS baseline, b.storage, b.access_, b.latency,
         o.storage + o.access_ + o.latency + migration AS optimized, o.storage AS opt_storage, o.access_ AS opt_access,
         o.latency AS opt_latency, migration,
         (b.storage + b.access_ + b.latency) - (o.storage + o.access_ + o.latency + migration) AS savings,
         b.unpriced_datasets
  FROM {base} b, {now} o, fee"""


CTE["saved"] = savings("seen")
CTE["saved_initial"] = savings("seen_initial")
CTE["saved_valid"] = savings("seen_initial_valid", "seen_valid")
SAVINGS = """
SELECT round(baseline, 2) AS baseline, round(storage, 2) AS storage, round(access_, 2) AS access,
       round(latency, 2) AS latency, round(optimized, 2) AS optimized, round(opt_storage, 2) AS opt_storage,
       round(opt_access, 2) AS opt_access, round(opt_latency, 2) AS opt_latency, round(migration, 2) AS migration,
       round(savings, 2) AS savings, round(CASE WHEN baseline > 0 THEN savings / baseline * 100 ELSE 0 END, 2)
         AS savings_percent, round(savings * 30, 2) AS monthly, round(savings * 365, 2) AS annual, unpriced_datasets FROM {}"""
put("savings_projection", SAVINGS.format("saved"))
put("savings_from_initial", SAVINGS.format("saved_initial"))
put("savings_after_faults", SAVINGS.format("saved_valid").replace(", 2)", ", 3)"))
CTE["counted"] = """
  SELECT kind, item, CAST(sum(jobs) AS BIGINT) AS jobs FROM (
    SELECT 'status' AS kind, status AS item, count(*) AS jobs FROM jobs GROUP BY status
    UNION ALL SELECT 'reason', reason, count(*) FROM jobs GROUP BY reason
    UNION ALL SELECT 'status', 'COMPLETE', 0 UNION ALL SELECT 'status', 'FAILED', 0) GROUP BY 1, 2"""
put("migration_counts", "SELECT * FROM counted")
CTE["efficiency"] = """
  SELECT count(*) AS total, count(*) FILTER (WHERE status = 'COMPLETE') * 100.0::DOUBLE /
           count(*) FILTER (WHERE status IN ('COMPLETE', 'FAILED')) AS success_rate,
         avg(d) AS avg_duration, min(d) AS min_duration, max(d) AS max_duration, median(d) AS median_duration
  FROM (SELECT *, nullif(duration_sec, 0) AS d FROM jobs)"""
put("migration_efficiency", """
SELECT total, round(success_rate, 4) AS success_rate, round(avg_duration, 4) AS avg_duration,
       round(min_duration, 4) AS min_duration, round(max_duration, 4) AS max_duration,
       round(median_duration, 4) AS median_duration FROM efficiency""")
put("duration_histogram", """
SELECT le, count(*) FILTER (WHERE duration_sec <= bound) AS jobs
FROM jobs, (VALUES ('5.0', 5.0), ('10.0', 10.0), ('20.0', 20.0), ('30.0', 30.0), ('40.0', 40.0), ('+Inf', 1e300))
  t(le, bound)
WHERE status = 'COMPLETE' GROUP BY le""")


def p95(column: str, table: str) -> str:
    return f"""
SELECT n, round(CASE WHEN n < 100 THEN v[n] ELSE v[k] + (pos - k) * (v[k + 1] - v[k]) END, 4) AS value
FROM (SELECT *, CAST(floor(pos) AS BIGINT) AS k FROM (
  SELECT count({column}) AS n, list({column} ORDER BY {column}) FILTER (WHERE {column} IS NOT NULL) AS v,
         0.95::DOUBLE * (count({column}) + 1) AS pos FROM {table}))"""


put("p95_duration", p95("duration_sec", "jobs"))
put("p95_event_value", p95("value", "events"))
CTE["shares"] = """
  SELECT current_backend AS backend, count(*) AS datasets, sum(size_gb) AS total_gb,
         count(*) * 100.0::DOUBLE / sum(count(*)) OVER () AS share FROM state GROUP BY 1"""
put("tier_distribution",
    "SELECT backend, datasets, round(total_gb, 4) AS total_gb, round(share, 4) AS share FROM shares")
put("datasets_per_tier", "SELECT current_backend, count(*) AS datasets FROM state GROUP BY 1")
CTE["classes"] = """
  SELECT *, CASE WHEN reads / 24 > 100 THEN 'hot' WHEN reads / 24 > 10 THEN 'warm' ELSE 'cold' END AS temperature
  FROM day"""
CTE["patterns"] = """
  SELECT CAST(sum(reads) AS BIGINT) AS total_reads_24h, CAST(sum(writes) AS BIGINT) AS total_writes_24h,
         count(*) FILTER (WHERE temperature = 'hot') AS hot_datasets,
         count(*) FILTER (WHERE temperature = 'warm') AS warm_datasets,
         count(*) FILTER (WHERE temperature = 'cold') AS cold_datasets FROM classes"""
put("access_patterns", "SELECT * FROM patterns")
put("temperature_classes", "SELECT dataset_id, reads, writes, temperature FROM classes")
JOB_COUNTS = """
SELECT count(*) AS total, count(*) FILTER (WHERE status = 'PENDING') AS pending,
       count(*) FILTER (WHERE status = 'RUNNING') AS running, count(*) FILTER (WHERE status = 'COMPLETE') AS completed,
       count(*) FILTER (WHERE status = 'FAILED') AS failed FROM jobs"""
put("job_counts", JOB_COUNTS)
TOTALS = "SELECT (SELECT count(*) FROM state) AS total_datasets, (SELECT count(*) FROM jobs) AS total_migrations"
put("report_totals", TOTALS)
CTE["newest"] = """
  SELECT event_type AS service, arg_max(value, event_id) AS events_per_sec, arg_max(value, event_id) * 3600 AS
         events_per_hour, CAST(arg_max(event_id, event_id) % 97 AS DOUBLE) AS p95_latency_ms
  FROM (SELECT * FROM events WHERE (event_type, date_trunc('second', ts)) IN
        (SELECT (event_type, max(date_trunc('second', ts))) FROM events GROUP BY event_type)) GROUP BY 1"""
put("latest_metrics", """
SELECT service, round(events_per_sec, 4) AS events_per_sec, round(events_per_hour, 4) AS events_per_hour,
       round(p95_latency_ms, 4) AS p95_latency_ms FROM newest""")
put("overview", f"""
SELECT total_datasets, tiers, j.*, c.*, round(events_per_sec, 2) AS events_per_sec,
       round(events_per_hour, 2) AS events_per_hour, round(p95_latency_ms, 2) AS p95_latency_ms
FROM (SELECT count(*) AS total_datasets FROM state),
     (SELECT string_agg(backend || '=' || datasets || ';', '' ORDER BY backend) AS tiers FROM shares),
     ({JOB_COUNTS}) j, ({SUMMARY.format('cost_totals')}) c, (SELECT * FROM newest WHERE service = 'view')""")
put("json_report", """
SELECT '2024-02-01T00:00:00' AS generated_at, (SELECT count(*) FROM state) AS total_datasets, total AS total_migrations,
       round(baseline, 2) AS baseline, round(migration, 2) AS migration, round(savings * 365, 2) AS annual,
       round(success_rate, 2) AS success_rate, round(median_duration, 2) AS median_duration,
       (SELECT jobs FROM counted WHERE kind = 'status' AND item = 'FAILED') AS failed,
       unpriced_datasets,
       (SELECT datasets FROM shares WHERE backend = 'on-prem') AS on_prem, hot_datasets
FROM saved, efficiency, patterns""")


put("report_reasons", "SELECT item AS reason, jobs FROM counted WHERE kind = 'reason'")


def _line(section: str, source: str, items) -> str:
    return " UNION ALL ".join(
        f"SELECT '{section}' AS section, '{item}' AS item, round(CAST({value} AS DOUBLE), 2) AS value, {text} AS text "
        f"FROM {source}" for item, value, text in items
    )


def _money(x: str) -> str:
    return f"printf('$%.2f', {x})"


def _plain(x: str) -> str:
    return f"CAST({x} AS VARCHAR)"


_pct = "CASE WHEN baseline > 0 THEN savings / baseline * 100 ELSE 0 END"
put("text_report", " UNION ALL ".join([
    _line("system", f"({TOTALS})", [(k.replace("_", " "), k, _plain(k)) for k in ("total_datasets", "total_migrations")]),
    _line("cost", "saved", [(item, x, _money(x)) for item, x in [
        ("baseline", "baseline"), ("baseline storage", "storage"), ("baseline access", "access_"),
        ("baseline latency", "latency"), ("optimized", "optimized"), ("optimized storage", "opt_storage"),
        ("optimized access", "opt_access"), ("optimized latency", "opt_latency"), ("optimized migration", "migration"),
        ("savings", "savings"), ("monthly savings", "savings * 30"), ("annual savings", "savings * 365")]]
        + [("savings percent", _pct, f"printf('%.1f%%', {_pct})"),
           ("unpriced datasets", "unpriced_datasets", _plain("unpriced_datasets"))]),
    _line("migrations", "efficiency", [("total", "total", _plain("total")),
          ("success rate", "success_rate", "printf('%.1f%%', success_rate)")]
          + [(f"{label} duration", f"{k}_duration", f"printf('%.2fs', {k}_duration)") for label, k in
             [("average", "avg"), ("median", "median"), ("min", "min"), ("max", "max")]]),
    "SELECT 'jobs by ' || kind, item, CAST(jobs AS DOUBLE), CAST(jobs AS VARCHAR) FROM counted",
    "SELECT 'tiers', backend, CAST(datasets AS DOUBLE), "
    "printf('%d datasets, %.1f GB, share %.1f%%', datasets, total_gb, share) FROM shares",
    _line("access", "patterns", [(f"total {k}", f"total_{k}_24h", f"format('{{:,}}', total_{k}_24h)")
          for k in ("reads", "writes")]
          + [(f"{k} datasets", f"{k}_datasets", _plain(f"{k}_datasets")) for k in ("hot", "warm", "cold")]),
]))
put("event_rate", """
SELECT CAST(date_trunc('minute', ts) AS TIMESTAMP) AS window_start, count(*) AS events,
       round(count(*) / 60.0::DOUBLE, 6) AS events_per_sec FROM events GROUP BY 1""")

# ---- scenario and features -------------------------------------------------------------------------------

CTE["calendar"] = """
  SELECT * FROM (VALUES ('business_hours', 5, 7, 5.0::DOUBLE, 1.0::DOUBLE), ('viral_content', 5, 7, 5.0, 1.0),
    ('batch_processing', 15, 16, 1.0, 8.0), ('cold_archive', 20, 20, 30.0, 1.0)) t(who, first_day, last_day, rm, wm)"""
CTE["templates"] = f"""
  SELECT * FROM (VALUES {", ".join(f"('{p}', {r}::DOUBLE, {w}::DOUBLE)" for p, r, w in zip(PERSONA, [5000, 800, 1, 8000], [500, 400, 0.1, 100]))})
    t(who, base_reads, base_writes)"""
CTE["in_calendar"] = """
  SELECT dataset_id, persona, timestamp, reads_1h, writes_1h, cycle_day, c.who IS NOT NULL AS in_entry,
         coalesce(rm, 1.0) AS read_multiplier, coalesce(wm, 1.0) AS write_multiplier, base_reads, base_writes
  FROM (SELECT *, CAST((timestamp // 86400) % 30 AS INTEGER) AS cycle_day FROM access) a
  LEFT JOIN calendar c ON c.who = a.persona AND a.cycle_day BETWEEN c.first_day AND c.last_day
  LEFT JOIN templates t ON t.who = a.persona"""
put("calendar_access", "SELECT * FROM in_calendar")
put("calendar_effect", """
SELECT dataset_id, persona, count(*) FILTER (WHERE in_entry) AS hours_inside, count(*) FILTER (WHERE NOT in_entry) AS hours_outside,
       round(avg(reads_1h) FILTER (WHERE in_entry), 4) AS reads_inside, round(avg(reads_1h) FILTER (WHERE NOT in_entry), 4)
         AS reads_outside, max(read_multiplier) AS expected_multiplier, max(base_reads) AS template_reads
FROM in_calendar GROUP BY 1, 2""")
CTE["grid"] = """
  SELECT g.dataset_id, g.timestamp, coalesce(reads_1h, 0) AS reads_1h, coalesce(writes_1h, 0) AS writes_1h,
         coalesce(bytes_read_1h, 0) AS bytes_read_1h, CAST((g.timestamp // 3600) % 24 AS INTEGER) AS hour_of_day,
         CAST((g.timestamp // 86400 + 3) % 7 AS INTEGER) AS day_of_week
  FROM (SELECT dataset_id, unnest(range(min(timestamp), max(timestamp) + 3600, 3600)) AS timestamp FROM access GROUP BY 1) g
  LEFT JOIN access a ON a.dataset_id = g.dataset_id AND a.timestamp = g.timestamp"""
put("filled_hours", "SELECT * FROM grid")


CTE["event_hours"] = """
  SELECT printf('ds_%06d', user_id) AS dataset_id, CAST(floor(epoch(ts) / 3600) AS BIGINT) * 3600 AS timestamp,
         count(*) AS reads_1h, CAST(sum(event_id) AS BIGINT) AS bytes_read_1h FROM events GROUP BY 1, 2"""
put("filled_hours_of_events", """
SELECT g.dataset_id, g.timestamp, coalesce(reads_1h, 0) AS reads_1h, CAST(0 AS BIGINT) AS writes_1h,
       coalesce(bytes_read_1h, 0) AS bytes_read_1h, CAST((g.timestamp // 3600) % 24 AS INTEGER) AS hour_of_day,
       CAST((g.timestamp // 86400 + 3) % 7 AS INTEGER) AS day_of_week
FROM (SELECT dataset_id, unnest(range(min(timestamp), max(timestamp) + 3600, 3600)) AS timestamp FROM event_hours GROUP BY 1) g
LEFT JOIN event_hours a ON a.dataset_id = g.dataset_id AND a.timestamp = g.timestamp""")

# ---- sources, sinks and streams --------------------------------------------------------------------------

put("appended_requests", f"""
SELECT CAST(o_orderkey AS VARCHAR) AS request_id, CASE WHEN o_orderstatus = 'O' THEN 'PENDING' ELSE 'COMPLETE' END AS status,
       CAST(epoch(o_orderdate) AS DOUBLE) AS created_at, 'api-full-scan' AS reason FROM orders
UNION ALL SELECT 'full-scan-1', 'PENDING', {NOW}::DOUBLE, 'api-full-scan'""")
CTE["runs"] = """
  SELECT event_type AS service, count(*)::DOUBLE AS n, max(CAST(event_id % 97 AS DOUBLE)) AS p95 FROM events GROUP BY 1"""
put("imported_run_log", """
SELECT n AS events, n AS accepted, 2.5::DOUBLE AS duration_sec, round(n / 2.5, 4) AS events_per_sec,
       round(n * 1440, 4) AS events_per_hour, p95 AS p95_latency_ms FROM runs""")
put("logged_runs", """
SELECT service, n AS events, n AS accepted, 2.5::DOUBLE AS duration_sec, round(n / 2.5, 4) AS events_per_sec,
       round(n * 1440, 4) AS events_per_hour, 1.0::DOUBLE AS p95_latency_ms
FROM runs ORDER BY n DESC, service DESC LIMIT 1""")
ORACLE["streamed_state"] = ORACLE["dataset_state"]
ORACLE["streamed_jobs"] = ORACLE["reaction_job_list"]
ORACLE["streamed_dead_letters"] = ORACLE["dead_letter_events"]
ORACLE["streamed_state_without_replays"] = ORACLE["dataset_state"]
ORACLE["stored_dataset_detail"] = ORACLE["dataset_detail"]
put("streamed_scans", f"""
SELECT dataset_id, from_backend, to_backend, reason, 'PENDING' AS status, 0 AS attempts, {NOW}::DOUBLE AS created_at, CAST(2 AS BIGINT) AS requests_done
FROM scanned""")
put("streamed_run_log", f"""
SELECT CAST((seq - low) // ((high - low) // {WAVES} + 1) AS INTEGER) AS batch, 'ingest' AS service, {NOW}::DOUBLE AS ts,
       count(*)::DOUBLE AS events, (count(*) FILTER (WHERE error IS NULL))::DOUBLE AS accepted
FROM checked, (SELECT min(seq) AS low, max(seq) AS high FROM checked) GROUP BY 1""")
CTE["minutes"] = "SELECT event_id, ts, CAST(floor(epoch(date_trunc('minute', ts)) / 60) AS BIGINT) AS minute FROM events"
CTE["arriving"] = f"""
  SELECT event_id, ts, minute, least((minute - low) // ((high - low) // {WAVES} + 1) + CASE WHEN event_id % 50 = 0 THEN 2 ELSE 0 END, {WAVES - 1}) AS wave
  FROM minutes, (SELECT min(minute) AS low, max(minute) AS high FROM minutes)"""
# The watermark that holds when a wave comes: ten minutes before the newest event so far.
CTE["marks"] = f"""
  SELECT w.wave, (SELECT max(date_trunc('millisecond', ts)) - INTERVAL 10 MINUTE FROM arriving a WHERE a.wave < w.wave) AS mark
  FROM (SELECT unnest(range({WAVES + 1})) AS wave) w"""
CTE["rate_rows"] = f"""
  SELECT date_trunc('minute', a.ts) AS window_start,
         CASE WHEN date_trunc('minute', a.ts) + INTERVAL 1 MINUTE <= m.mark THEN 'late'
              WHEN date_trunc('minute', a.ts) + INTERVAL 1 MINUTE <= (SELECT mark FROM marks WHERE wave = {WAVES}) THEN 'closed' ELSE 'open' END AS part
  FROM arriving a JOIN marks m ON m.wave = a.wave"""
put("streamed_event_rate", """
SELECT 'closed' AS part, CAST(window_start AS TIMESTAMP) AS window_start, count(*) AS events FROM rate_rows WHERE part = 'closed' GROUP BY 2
UNION ALL SELECT 'open', NULL, count(*) FROM rate_rows WHERE part = 'open'
UNION ALL SELECT 'late', NULL, count(*) FROM rate_rows WHERE part = 'late'""")
put("reads_quantiles", """
SELECT current_backend, p, count(*) AS n, true AS within FROM access, (VALUES (0.25::DOUBLE), (0.5), (0.95)) t(p) GROUP BY 1, 2""")


def over(function: str, first: int, last: int) -> str:
    side = lambda n: "CURRENT ROW" if n == 0 else f"{abs(n)} {'PRECEDING' if n < 0 else 'FOLLOWING'}"
    return f"{function} OVER (PARTITION BY dataset_id ORDER BY timestamp ROWS BETWEEN {side(first)} AND {side(last)})"


ROLLS = [(k, h) for k in ("reads", "writes") for h in (6, 12, 24, 48, 96)]
CTE["training"] = f"""
  SELECT *, CASE WHEN reads_24h / 24 > 100 THEN 'hot' WHEN reads_24h / 24 > 10 THEN 'warm' ELSE 'cold' END
         AS data_temperature FROM (
    SELECT dataset_id, timestamp, reads_1h, writes_1h, bytes_read_1h, hour_of_day, day_of_week,
           {", ".join(f"CAST({over(f'sum({k}_1h)', 1 - h, 0)} AS DOUBLE) AS {k}_{h}h" for k, h in ROLLS)},
           greatest(0.7, least(2.0, {over("avg(reads_1h)", -5, 0)} /
             greatest(coalesce({over("avg(reads_1h)", -11, -6)}, 0), 1))) AS trend_6h,
           CAST({over("count(CASE WHEN reads_1h > 0 THEN 1 END)", -23, 0)} AS DOUBLE) AS access_freq_24h
    FROM access)"""
CTE["split"] = """
  SELECT *, pos < n_train AS is_train, CASE WHEN pos < n_train THEN pos ELSE pos - n_train END AS part_pos,
         CASE WHEN pos < n_train THEN n_train ELSE n - n_train END AS part_rows FROM (
    SELECT *, row_number() OVER (PARTITION BY dataset_id ORDER BY timestamp) - 1 AS pos,
           count(*) OVER (PARTITION BY dataset_id) AS n,
           CAST(floor(count(*) OVER (PARTITION BY dataset_id) * 0.8::DOUBLE) AS BIGINT) AS n_train FROM training)"""
put("training_features", """
SELECT * REPLACE (round(trend_6h, 4) AS trend_6h) FROM training""")
ORACLE["training_csv"] = ORACLE["training_features"]
_KEPT = "SELECT '{}' AS input, dataset_id, timestamp, reads_24h, round(trend_6h, 4) AS trend_6h FROM training {}"
put("reused_features", " UNION ALL ".join([
    _KEPT.format("all", ""), _KEPT.format("early", f"WHERE timestamp < {CUT_HOUR * 3600}"), _KEPT.format("all again", "")]))
put("chronological_split", "SELECT dataset_id, timestamp, is_train, part_pos, part_rows FROM split")


def inputs(kind: str) -> list[str]:
    return (
        [f"{kind}_1h", "bytes_read_1h", "hour_of_day", "day_of_week"] + [f"{kind}_{h}h" for h in (6, 12, 24, 48, 96)]
        + ["trend_6h", "CASE data_temperature WHEN 'hot' THEN 2 WHEN 'warm' THEN 1 ELSE 0 END", "access_freq_24h"]
    )


def samples(kind: str, horizon: int) -> str:
    # Row i of a window (1 is the oldest of 24) weighs i: 24 minus its distance to the newest row.
    checks = ", ".join(
        f"round(list_sum(list_transform({over(f'list(CAST({c} AS DOUBLE))', -23, 0)}, lambda v, i: v * i)), 2) AS x{j:02d}"
        for j, c in enumerate(inputs(kind))
    )
    return f"""
SELECT * EXCLUDE (seen, ahead) FROM (
  SELECT dataset_id, timestamp, round(CAST({over(f"sum({kind}_1h)", 1, horizon)} AS DOUBLE), 2) AS target, {checks},
         {over("count(*)", -23, 0)} AS seen, {over("count(*)", 1, horizon)} AS ahead FROM training)
WHERE seen = 24 AND ahead = {horizon}"""


put("sequence_samples_reads", samples("reads", 12))
put("sequence_samples_writes", samples("writes", 8))
NAMES = [f"{c}" for c in ("reads_1h", "bytes_read_1h", "hour_of_day", "day_of_week", "reads_6h", "reads_12h", "reads_24h",
                          "reads_48h", "reads_96h", "trend_6h", "data_temperature_encoded", "access_freq_24h")]
# Every row of every sequence of the training part, written out.
CTE["unfolded"] = """
  SELECT t.* FROM split t JOIN (
    SELECT dataset_id, unnest(range(0, part_rows - 35)) AS first FROM (SELECT DISTINCT dataset_id, part_rows FROM split WHERE is_train)
  ) s ON s.dataset_id = t.dataset_id AND t.part_pos BETWEEN s.first AND s.first + 23 WHERE is_train"""
put("feature_scaler", f"""
SELECT {", ".join(f"round(avg({c}), 3) AS mean_f_{n}" for n, c in zip(NAMES, inputs("reads")))},
       {", ".join(f"round(CASE WHEN min({c}) = max({c}) THEN 1 ELSE stddev_pop({c}) END, 3) AS sd_f_{n}" for n, c in zip(NAMES, inputs("reads")))}
FROM unfolded""")


def backtest(horizon: int) -> str:
    keep = "dataset_id, timestamp, " + ", ".join(
        f"CAST({over(f'sum({k}_1h)', 1, horizon)} AS BIGINT) AS actual_{k}" for k in ("reads", "writes")
    ) + f", {over('count(*)', -23, 0)} AS seen, {over('count(*)', 1, horizon)} AS ahead"
    guess = lambda k: (
        f"recent_{k} * greatest(0.7, least(2.0, recent_{k} / greatest(older_{k}, 1))) * {float(horizon)} AS predicted_{k}"
    )
    return f"""
  SELECT dataset_id, timestamp, actual_reads, {guess("reads")}, actual_writes, {guess("writes")}
  FROM ({trailing("access", "timestamp", keep, horizon)}) WHERE seen = 24 AND ahead = {horizon}"""


CTE["back12"], CTE["back8"] = backtest(12), backtest(8)
BACK = """
SELECT dataset_id, timestamp, actual_reads, round(predicted_reads, 4) AS predicted_reads, actual_writes,
       round(predicted_writes, 4) AS predicted_writes FROM {}"""
put("trend_backtest", BACK.format("back12"))
put("trend_backtest_8h", BACK.format("back8"))
put("backtest_errors", " UNION ALL ".join(f"""
SELECT count(*) AS n, round(avg(abs(actual_{k} - predicted_{k})), 3) AS mae,
       round(sqrt(avg(pow(actual_{k} - predicted_{k}, 2))), 3) AS rmse,
       round(CASE WHEN avg(abs(actual_{k})) > 0 THEN avg(abs(actual_{k} - predicted_{k})) / avg(abs(actual_{k})) * 100
             ELSE 0 END, 3) AS mape, '{k}' AS target FROM back12""" for k in ("reads", "writes")))
_huber = lambda k: (
    f"avg(CASE WHEN abs(actual_{k} - predicted_{k}) <= 1 THEN 0.5::DOUBLE * pow(actual_{k} - predicted_{k}, 2) "
    f"ELSE abs(actual_{k} - predicted_{k}) - 0.5::DOUBLE END)"
)
put("backtest_losses", f"""
SELECT round({_huber("reads")} + {_huber("writes")}, 2) AS huber,
       round((avg(pow(actual_reads - predicted_reads, 2)) + avg(pow(actual_writes - predicted_writes, 2))) / 2, 2) AS mse
FROM back12""")
put("best_horizon", " UNION ALL ".join(f"""
SELECT '{k}' AS target, CASE WHEN a <= b THEN '8h' ELSE '12h' END AS best, round(least(a, b), 3) AS val_mae
FROM (SELECT (SELECT avg(abs(actual_{k} - predicted_{k})) FROM back8) AS a,
             (SELECT avg(abs(actual_{k} - predicted_{k})) FROM back12) AS b)""" for k in ("reads", "writes")))
# The joint forecaster on gap-free hours: two inputs, three targets, solved in closed form.
CTE["grid_split"] = f"""
  SELECT *, pos < n_train AS is_train FROM (
    SELECT dataset_id, timestamp, reads_1h, writes_1h, bytes_read_1h, row_number() OVER (PARTITION BY dataset_id ORDER BY timestamp) - 1 AS pos,
           floor(count(*) OVER (PARTITION BY dataset_id) * 0.8::DOUBLE) AS n_train,
           CAST({over("sum(reads_1h)", -23, 0)} AS DOUBLE) AS x1, CAST({over("sum(writes_1h)", -23, 0)} AS DOUBLE) AS x2 FROM grid)"""
REG, DELTA = "0.01::DOUBLE", "1.35::DOUBLE"
JOINT = ("reads", "writes", "bytes_read")


def joint(horizon: int) -> None:
    """Samples ``js``, their long scaled form ``jz``, and the fits ``jf0`` (squared loss) to ``jf2`` (reweighted twice)."""
    part = lambda f, a, b: over(f, a, b).replace("PARTITION BY dataset_id", "PARTITION BY dataset_id, is_train")
    ahead = ", ".join(f"CAST({part(f'sum({k}_1h)', 1, horizon)} AS DOUBLE) AS y_{k}" for k in JOINT)
    keep = (
        f"dataset_id, timestamp, is_train, x1, x2, {ahead}, {part('count(*)', -23, 0)} AS seen, {part('count(*)', 1, horizon)} AS ahead, "
        f"CAST({part('sum(bytes_read_1h)', 1 - horizon, 0)} AS DOUBLE) AS t_bytes_read"
    )
    guess = lambda k: f"recent_{k} * greatest(0.7, least(2.0, recent_{k} / greatest(older_{k}, 1))) * {float(horizon)} AS t_{k}"
    CTE[f"js{horizon}"] = f"""
  SELECT *, {guess("reads")}, {guess("writes")} FROM ({trailing("grid_split", "timestamp", keep, horizon)}) WHERE seen = 24 AND ahead = {horizon}"""
    CTE[f"jl{horizon}"] = " UNION ALL ".join(
        f"SELECT '{k}' AS target, is_train, x1, x2, y_{k} AS truth, t_{k} AS trend FROM js{horizon}" for k in JOINT)
    sd = lambda c: f"CASE WHEN min({c}) = max({c}) THEN 1 ELSE stddev_pop({c}) END"
    CTE[f"jm{horizon}"] = f"""
  SELECT target, {", ".join(f"avg({c}) AS m_{c}, {sd(c)} AS s_{c}" for c in ("x1", "x2", "truth"))} FROM jl{horizon} WHERE is_train GROUP BY 1"""
    CTE[f"jz{horizon}"] = f"""
  SELECT l.*, m.m_truth, m.s_truth, (x1 - m_x1) / s_x1 AS u1, (x2 - m_x2) / s_x2 AS u2, (truth - m_truth) / s_truth AS v
  FROM jl{horizon} l JOIN jm{horizon} m USING (target)"""
    for k in range(3):
        far = f"abs(v - b0 - b1 * u1 - b2 * u2)"
        source = f"(SELECT *, 1::DOUBLE AS w FROM jz{horizon})" if k == 0 else (
            f"(SELECT z.*, CASE WHEN {far} <= {DELTA} THEN 1 ELSE {DELTA} / {far} END AS w FROM jz{horizon} z JOIN jf{horizon}_{k - 1} USING (target))")
        c = lambda a, b: f"(sum(w * {a} * {b}) - sum(w * {a}) * sum(w * {b}) / sum(w)) / count(*)"
        CTE[f"jf{horizon}_{k}"] = f"""
  SELECT target, b1, b2, mv - b1 * m1 - b2 * m2 AS b0 FROM (
    SELECT *, (c1v * c22 - c2v * c12) / (c11 * c22 - c12 * c12) AS b1, (c2v * c11 - c1v * c12) / (c11 * c22 - c12 * c12) AS b2 FROM (
      SELECT target, sum(w * u1) / sum(w) AS m1, sum(w * u2) / sum(w) AS m2, sum(w * v) / sum(w) AS mv, {c("u1", "u1")} + {REG} AS c11,
             {c("u2", "u2")} + {REG} AS c22, {c("u1", "u2")} AS c12, {c("u1", "v")} AS c1v, {c("u2", "v")} AS c2v
      FROM {source} WHERE is_train GROUP BY 1))"""


for _h in (8, 12):
    joint(_h)
put("trained_forecast", "SELECT *, mae < mean_mae AS beats_mean, mae < trend_mae AS beats_trend FROM (" + " UNION ALL ".join(f"""
SELECT target, '{h}h' AS name, '{loss}' AS loss, count(*) AS n,
       round(avg(abs(truth - ((b0 + b1 * u1 + b2 * u2) * s_truth + m_truth))), 3) AS mae, round(avg(abs(truth - m_truth)), 3) AS mean_mae,
       round(avg(abs(truth - trend)), 3) AS trend_mae
FROM jz{h} JOIN jf{h}_{k} USING (target) WHERE NOT is_train GROUP BY 1""" for h in (8, 12) for loss, k in (("squaredError", 0), ("huber", 2))) + ")")
