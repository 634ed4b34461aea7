"""SQL that DuckDB runs on the same tables to check each query of the catalog.

The texts are written from the definitions of the operators, with plain window
functions and recursion; they share only the two source views with the package.
"""

from tradeloom.functions.fixed_values import (
    FX_TO_USD,
    LAYER_COLOURS,
    LAYER_ORDER,
    LEGAL_ENTITIES,
    NULL_DEFAULTS,
    RULES,
    STATUSES,
)
from tradeloom.sources.lineage_log import lineage_log_sql, node_name
from tradeloom.sources.trades import RAW_TRADES_SQL

NODE = "fact_trades.s7"


def _list(values) -> str:
    return ", ".join(f"'{v}'" for v in values)


def _micros(amount: str) -> str:
    return f"CAST(round_even(({amount}) * CAST(1e6 AS DOUBLE), 0) AS HUGEINT)"


def _sum(amount: str, over: str = "") -> str:
    return f"(CAST(SUM({_micros(amount)}){over} AS DOUBLE) / CAST(1e6 AS DOUBLE))"


BUY = "CASE WHEN UPPER(direction) = 'BUY' THEN notional_usd ELSE 0.0 END"
SELL = "CASE WHEN UPPER(direction) = 'SELL' THEN notional_usd ELSE 0.0 END"
RUNNING = (
    " OVER (PARTITION BY counterparty_id ORDER BY trade_date NULLS FIRST, "
    "md5(COALESCE(trade_id, '')), trade_id NULLS FIRST "
    "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
)
RATES = " ".join(f"WHEN '{c}' THEN CAST({r} AS DOUBLE)" for c, r in FX_TO_USD.items())
ENTITIES = ", ".join(
    "(" + ", ".join(f"'{v}'" for v in row) + ")" for row in LEGAL_ENTITIES
)
STATUS_ROWS = ", ".join(f"({k}, '{c}', '{label}')" for k, c, label, _, _ in STATUSES)

CTES = {
    "raw": RAW_TRADES_SQL.format(lineitem="lineitem", orders="orders"),
    "filled": """
        SELECT * REPLACE (
          COALESCE(notional, '0.0') AS notional, COALESCE(quantity, 0.0) AS quantity,
          COALESCE(currency, 'USD') AS currency, COALESCE(direction, 'UNKNOWN') AS direction,
          COALESCE(settlement_status, 'PENDING') AS settlement_status,
          COALESCE(asset_class, 'UNKNOWN') AS asset_class, COALESCE(exchange, 'UNKNOWN') AS exchange)
        FROM raw""",
    "failed": "SELECT * FROM filled WHERE TRY_CAST(notional AS DOUBLE) IS NULL",
    "typed": """
        SELECT * REPLACE (TRY_CAST(notional AS DOUBLE) AS notional)
        FROM filled WHERE TRY_CAST(notional AS DOUBLE) IS NOT NULL""",
    "ranked": """
        SELECT *, ROW_NUMBER() OVER (PARTITION BY trade_id ORDER BY trade_date DESC NULLS LAST,
          src_suppkey NULLS FIRST, src_partkey NULLS FIRST) AS rn FROM typed""",
    "cleaned": "SELECT * EXCLUDE (rn) FROM ranked WHERE rn = 1",
    "duplicates": "SELECT * EXCLUDE (rn) FROM ranked WHERE rn > 1",
    "rated": f"SELECT *, CASE UPPER(currency) {RATES} ELSE CAST(1.0 AS DOUBLE) END AS fx_rate_to_usd FROM cleaned",
    "converted": """
        SELECT *, notional * fx_rate_to_usd AS notional_usd,
          notional * fx_rate_to_usd / CAST(1.085 AS DOUBLE) AS notional_eur FROM rated""",
    "entities": f"""
        SELECT * FROM (VALUES {ENTITIES})
          AS t(entity_id, lei_code, legal_entity_name, lei_country, credit_rating)""",
    "attributes": """
        SELECT c.*, CAST(YEAR(trade_date) AS INTEGER) AS trade_year,
          CAST(QUARTER(trade_date) AS INTEGER) AS trade_quarter,
          CAST(MONTH(trade_date) AS INTEGER) AS trade_month,
          CAST(DAYOFWEEK(trade_date) + 1 AS INTEGER) AS trade_day_of_week,
          DAY(trade_date) = DAY(LAST_DAY(trade_date)) AS is_month_end,
          DAYOFWEEK(trade_date) + 1 BETWEEN 2 AND 6 AS is_trading_day,
          CAST(DATE_DIFF('day', trade_date, settlement_date) AS INTEGER) AS days_to_settlement,
          lei_code, legal_entity_name, lei_country, credit_rating
        FROM converted c LEFT JOIN entities ON counterparty_id = entity_id""",
    "exposed": f"""
        SELECT *, {_sum("notional_usd", " OVER (PARTITION BY counterparty_id)")} AS cpty_total_notional_usd,
          COUNT(*) OVER (PARTITION BY counterparty_id) AS cpty_trade_count,
          {_sum("notional_usd", RUNNING)} AS running_notional_usd,
          {_sum("notional_usd", " OVER (PARTITION BY asset_class)")} AS asset_class_exposure_usd,
          {_sum(BUY, " OVER (PARTITION BY counterparty_id, product_id)")} AS buy_notional_usd,
          {_sum(SELL, " OVER (PARTITION BY counterparty_id, product_id)")} AS sell_notional_usd
        FROM attributes""",
    "enriched": "SELECT *, buy_notional_usd - sell_notional_usd AS net_notional_usd FROM exposed",
    "products": """
        SELECT CAST(ROW_NUMBER() OVER (ORDER BY product_id) AS INTEGER) AS product_key, * FROM (
          SELECT product_id, COALESCE(MAX(asset_class), 'UNKNOWN') AS asset_class,
            COALESCE(MAX(currency), 'USD') AS currency, COALESCE(MAX(exchange), 'UNKNOWN') AS exchange
          FROM attributes WHERE product_id IS NOT NULL GROUP BY product_id)""",
    "counterparties": """
        SELECT CAST(ROW_NUMBER() OVER (ORDER BY counterparty_id) AS INTEGER) AS counterparty_key, * FROM (
          SELECT counterparty_id, COALESCE(MAX(legal_entity_name), counterparty_id) AS legal_entity_name,
            MAX(lei_code) AS lei_code, MAX(lei_country) AS lei_country, MAX(credit_rating) AS credit_rating
          FROM attributes WHERE counterparty_id IS NOT NULL GROUP BY counterparty_id)""",
    "statuses": f"SELECT * FROM (VALUES {STATUS_ROWS}) AS t(status_key, status_code, status_label)",
    "facts": """
        SELECT ROW_NUMBER() OVER (ORDER BY e.trade_id) AS trade_key, product_key, counterparty_key,
          CAST(STRFTIME(trade_date, '%Y%m%d') AS INTEGER) AS trade_date_key,
          CAST(STRFTIME(settlement_date, '%Y%m%d') AS INTEGER) AS settlement_date_key,
          CAST(COALESCE(status_key, 5) AS INTEGER) AS status_key,
          trade_id, notional, quantity, e.currency, direction, notional_usd, notional_eur, fx_rate_to_usd,
          buy_notional_usd, sell_notional_usd, net_notional_usd, cpty_total_notional_usd, cpty_trade_count,
          running_notional_usd, asset_class_exposure_usd, trade_year, trade_quarter, trade_month,
          trade_day_of_week, is_month_end, is_trading_day, days_to_settlement,
          'b_test' AS batch_id, 'trades' AS pipeline_name
        FROM enriched e LEFT JOIN products p ON p.product_id = e.product_id
          LEFT JOIN counterparties c ON c.counterparty_id = e.counterparty_id
          LEFT JOIN statuses s ON s.status_code = COALESCE(e.settlement_status, 'UNKNOWN')
        WHERE direction IN ('BUY', 'SELL', 'UNKNOWN')""",
    "days": """
        SELECT CAST(trade_date AS DATE) AS d FROM raw WHERE trade_date IS NOT NULL
        UNION SELECT CAST(settlement_date AS DATE) FROM raw WHERE settlement_date IS NOT NULL""",
    "gappy": """
        SELECT * REPLACE (CASE WHEN src_partkey % 31 <> 0 THEN trade_id END AS trade_id,
          CASE WHEN src_partkey % 37 <> 0 THEN TRY_CAST(notional AS DOUBLE) END AS notional,
          CASE WHEN src_partkey % 41 <> 0 THEN quantity END AS quantity,
          CASE WHEN src_partkey % 43 <> 0 THEN trade_date END AS trade_date,
          CASE WHEN src_partkey % 47 <> 0 THEN direction END AS direction) FROM raw""",
    "log": lineage_log_sql(),
    "graph": """
        SELECT * EXCLUDE (rn, ts) FROM (
          SELECT *, ROW_NUMBER() OVER (PARTITION BY source, target
            ORDER BY ts DESC, transform DESC, stage DESC, batch_id DESC, metadata DESC) AS rn
          FROM log) WHERE rn = 1""",
    "nodes": "SELECT source AS node FROM log UNION SELECT target FROM log",
}
NEEDS = {
    "raw": [], "filled": ["raw"], "failed": ["filled"], "typed": ["filled"], "ranked": ["typed"],
    "cleaned": ["ranked"], "duplicates": ["ranked"], "rated": ["cleaned"], "converted": ["rated"],
    "entities": [], "attributes": ["converted", "entities"], "exposed": ["attributes"],
    "enriched": ["exposed"], "products": ["attributes"], "counterparties": ["attributes"],
    "statuses": [], "facts": ["enriched", "products", "counterparties", "statuses"], "days": ["raw"], "gappy": ["raw"],
    "log": [], "graph": ["log"], "nodes": ["log"],
}


def _with(body: str, *names: str, recursive: str = "") -> str:
    """Prefix ``body`` with the named CTEs and what they need, in order."""
    wanted: set[str] = set()
    todo = list(names)
    while todo:
        name = todo.pop()
        if name not in wanted:
            wanted.add(name)
            todo += NEEDS[name]
    parts = [f"{n} AS MATERIALIZED ({text})" for n, text in CTES.items() if n in wanted]
    if recursive:
        parts.append(recursive)
    head = "WITH RECURSIVE " if recursive else "WITH "
    return head + ",\n".join(parts) + "\n" + body


# --- data quality ------------------------------------------------------------

def _rule_sql(rule: dict, columns: set[str]) -> tuple[str, str]:
    """(violation predicate, offending value) of a rule as plain SQL."""
    field = rule.get("field")
    if field and field not in columns or not set(rule.get("fields", [])) <= columns:
        return "FALSE", "NULL"
    kind = rule["type"]
    if kind == "null_check":
        return f"{field} IS NULL", "NULL"
    if kind == "range_check":
        return (
            f"({field} IS NULL OR {field} < {rule['min']} OR {field} > {rule['max']})",
            f"COALESCE(CAST({field} AS VARCHAR), 'NULL')",
        )
    if kind == "referential_integrity":
        return f"{field} IS NOT NULL AND UPPER({field}) NOT IN ({_list(rule['allowed_values'])})", field
    shown = " || ', ' || ".join(f"'{f}=' || COALESCE(CAST({f} AS VARCHAR), 'None')" for f in rule["fields"])
    return f"(({rule['expr']}) IS NOT NULL AND NOT ({rule['expr']}))", shown


RAW_COLUMNS = {
    "trade_id", "product_id", "counterparty_id", "asset_class", "currency", "direction", "notional",
    "quantity", "trade_date", "settlement_date", "settlement_status", "exchange",
}
ATTRIBUTE_COLUMNS = RAW_COLUMNS | {
    "fx_rate_to_usd", "notional_usd", "notional_eur", "trade_year", "days_to_settlement", "lei_code",
}
CROSS_RULES = [
    {"name": "settles_after_trade", "type": "cross_field", "fields": ["trade_date", "settlement_date"],
     "expr": "settlement_date >= trade_date", "severity": "WARN", "stage": "pre_load"},
    {"name": "settles_soon", "type": "cross_field",
     "fields": ["trade_date", "settlement_date", "days_to_settlement"],
     "expr": "days_to_settlement BETWEEN 0 AND 3", "severity": "ERROR", "stage": "pre_load"},
    {"name": "large_trade_has_entity", "type": "cross_field", "fields": ["direction", "lei_code"],
     "expr": "NOT (notional_usd > 60000 AND (lei_code IS NULL OR lei_code = ''))",
     "severity": "WARN", "stage": "pre_load"},
]
BY_STAGE = {s: [r for r in RULES if r["stage"] == s] for s in ("post_ingest", "post_clean", "pre_load")}
FRAMES = {"post_ingest": "raw", "post_clean": "cleaned", "pre_load": "attributes"}
FRAME_COLUMNS = {"raw": RAW_COLUMNS, "cleaned": RAW_COLUMNS, "attributes": ATTRIBUTE_COLUMNS}
MONTH = "'b_' || STRFTIME(trade_date, '%Y%m')"


def _violations(rules: list, frame: str, batch: str = "'b_test'", ts: str = "") -> str:
    rows = []
    for rule in rules:
        broken, value = _rule_sql(rule, FRAME_COLUMNS[frame])
        if broken == "FALSE":
            continue
        fields = rule.get("field") or ", ".join(rule["fields"])
        rows.append(
            f"SELECT {batch} AS batch_id, '{rule['name']}' AS rule_name, '{rule['severity']}' AS severity, "
            f"'{fields}' AS field_name, CAST({value} AS VARCHAR) AS offending_value, "
            f"COALESCE(trade_id, 'None') AS row_key, '{rule['stage']}' AS stage{ts} FROM {frame} WHERE {broken}"
        )
    return "\nUNION ALL ".join(rows)


def _counts(rules: list, frame: str, by: str = "") -> str:
    """Failing rows per rule; ``by`` is a batch expression or empty."""
    rows = []
    for rule in rules:
        broken, _ = _rule_sql(rule, FRAME_COLUMNS[frame])
        skipped = "TRUE" if broken == "FALSE" else "FALSE"
        group = f"{by} AS batch_id, " if by else ""
        rows.append(
            f"SELECT {group}'{rule['stage']}' AS checkpoint, '{rule['name']}' AS rule_name, "
            f"'{rule['severity']}' AS severity, COUNT(*) FILTER (WHERE {broken}) AS failing_rows, "
            f"{skipped} AS skipped FROM {frame}" + (" GROUP BY 1" if by else "")
        )
    return "\nUNION ALL ".join(rows)


def _scores(counts: str, by: str = "") -> str:
    group = f"{by}, " if by else ""
    return f"""
        SELECT *, round_even(GREATEST(0.0, 100.0 * (1.0 -
            (critical_count * CAST(2.0 AS DOUBLE) + error_count * CAST(1.5 AS DOUBLE) + warn_count)
              / (rules_run * CAST(2.0 AS DOUBLE)))), 2) AS dq_score
        FROM (
          SELECT {group}checkpoint, COUNT(*) AS rules_run, COUNT(*) FILTER (WHERE v = 0) AS rules_passed,
            COUNT(*) FILTER (WHERE v > 0) AS rules_failed, COUNT(*) FILTER (WHERE skipped) AS rules_skipped,
            CAST(SUM(v) AS BIGINT) AS total_violations,
            CAST(SUM(CASE WHEN severity = 'CRITICAL' THEN v ELSE 0 END) AS BIGINT) AS critical_count,
            CAST(SUM(CASE WHEN severity = 'ERROR' THEN v ELSE 0 END) AS BIGINT) AS error_count,
            CAST(SUM(CASE WHEN severity = 'WARN' THEN v ELSE 0 END) AS BIGINT) AS warn_count
          FROM (SELECT *, failing_rows AS v FROM ({counts}))
          GROUP BY {group}checkpoint)"""


def _two_batches(sql: str) -> str:
    """The result of ``sql`` for both stored batches: all trades, and those of every other supplier."""
    half = f"SELECT * FROM ({CTES['raw']}) WHERE src_suppkey % 2 = 0"
    return f"""
        SELECT 'b_1' AS batch_id, * FROM ({sql})
        UNION ALL SELECT 'b_2' AS batch_id, * FROM ({sql.replace(CTES["raw"], half)})"""


def _stored_scores() -> str:
    union = "\nUNION ALL ".join(f"SELECT * FROM ({_scores(_counts(BY_STAGE[s], f))})" for s, f in FRAMES.items())
    return _two_batches(_with(union, *FRAMES.values()))


def _stored_violations() -> str:
    union = "\nUNION ALL ".join(
        f"SELECT checkpoint, rule_name, failing_rows FROM ({_counts(BY_STAGE[s], f)})" for s, f in FRAMES.items()
    )
    counts = _two_batches(_with(union, *FRAMES.values()))
    return f"""SELECT batch_id, checkpoint, rule_name, CAST(failing_rows AS BIGINT) AS violations
               FROM ({counts}) WHERE failing_rows > 0"""


# --- run metadata ------------------------------------------------------------

_STAGE_ROWS = [
    (0, "ingest", {"in": ["raw"], "out": ["raw"], "dead": []}),
    (1, "clean", {"in": ["raw"], "out": ["cleaned"], "dead": ["failed", "duplicates"]}),
    (2, "enrich", {"in": ["cleaned"], "out": ["cleaned"], "dead": []}),
    (3, "load", {"in": ["cleaned"], "out": ["cleaned"], "dead": ["rejected"]}),
]


def _stage_counts() -> str:
    rows = []
    for place, stage, roles in _STAGE_ROWS:
        for role, frames in roles.items():
            for frame in frames:
                source = frame
                if frame == "rejected":
                    source = "(SELECT * FROM cleaned WHERE direction NOT IN ('BUY', 'SELL', 'UNKNOWN'))"
                rows.append(
                    f"SELECT {MONTH} AS batch_id, {place} AS stage_order, '{stage}' AS stage_name, "
                    f"'{role}' AS role FROM {source}"
                )
    union = "\nUNION ALL ".join(rows)
    return f"""
        SELECT *, CAST(SUM(records_dead) OVER (PARTITION BY batch_id ORDER BY stage_order) AS BIGINT)
          AS records_dead_total
        FROM (SELECT batch_id, stage_order, stage_name,
            COUNT(*) FILTER (WHERE role = 'in') AS records_in,
            COUNT(*) FILTER (WHERE role = 'out') AS records_out,
            COUNT(*) FILTER (WHERE role = 'dead') AS records_dead
          FROM ({union}) GROUP BY ALL)"""


def _stored_runs() -> str:
    counts = _stage_counts().replace(f"{MONTH} AS batch_id", "'all' AS batch_id")
    return _two_batches(_with(
        f"""SELECT 'trades' AS pipeline_name, stage_name, 'SUCCESS' AS status, records_in, records_out,
              records_dead, records_dead_total FROM ({counts})""",
        *_RUN_FRAMES,
    ))


_RUN_FRAMES = ("raw", "cleaned", "failed", "duplicates")


# --- lineage -----------------------------------------------------------------

def _reach(start: str, here: str, there: str) -> str:
    body = f"SELECT node, CAST(MIN(dist) AS INTEGER) AS dist FROM walk WHERE node <> '{start}' GROUP BY node"
    walk = f"""walk AS (
        SELECT DISTINCT {there} AS node, 1 AS dist FROM log WHERE {here} = '{start}'
        UNION SELECT e.{there}, dist + 1 FROM walk JOIN (SELECT DISTINCT source, target FROM log) e
          ON e.{here} = walk.node)"""
    return _with(body, "log", recursive=walk)


def _path(start: str, end: str) -> str:
    walk = f"""walk AS (
        SELECT DISTINCT target AS node, [source, target] AS path FROM log WHERE source = '{start}'
        UNION SELECT e.target, list_append(path, e.target) FROM walk
          JOIN (SELECT DISTINCT source, target FROM log) e ON e.source = walk.node)"""
    body = f"""SELECT CAST(UNNEST(RANGE(LEN(path))) AS INTEGER) AS position, UNNEST(path) AS node FROM (
        SELECT path FROM walk WHERE node = '{end}' ORDER BY LEN(path), path LIMIT 1)"""
    return _with(body, "log", recursive=walk)


LAYER = "CASE WHEN CONTAINS(node, '.') THEN SPLIT_PART(node, '.', 1) ELSE '{none}' END"
COLUMN = "SPLIT_PART(node, '.', -1)"
COLOURS = " ".join(f"WHEN '{layer}' THEN '{colour}'" for layer, colour in LAYER_COLOURS.items())
KNOWN = f"CASE WHEN {LAYER.format(none='other')} IN ({_list(LAYER_ORDER)}) THEN {LAYER.format(none='other')} ELSE 'other' END"


EDGES = """
  ('raw.trade_id', 'typed.trade_id', 'type_cast', 'clean'),
  ('raw.notional', 'typed.notional', 'type_cast', 'clean'),
  ('raw.quantity', 'typed.quantity', 'type_cast', 'clean'),
  ('raw.trade_date', 'typed.trade_date', 'type_cast', 'clean'),
  ('raw.settlement_date', 'typed.settlement_date', 'type_cast', 'clean'),
  ('raw.counterparty_id', 'typed.counterparty_id', 'type_cast', 'clean'),
  ('raw.product_id', 'typed.product_id', 'type_cast', 'clean'),
  ('raw.currency', 'typed.currency', 'type_cast', 'clean'),
  ('raw.direction', 'typed.direction', 'type_cast', 'clean'),
  ('typed.trade_id', 'dedup.trade_id', 'dedup', 'clean'),
  ('clean.notional', 'enriched.notional_usd', 'fx_convert', 'enrich'),
  ('enriched.notional_usd', 'enriched.notional_eur', 'fx_to_eur', 'enrich'),
  ('clean.trade_date', 'enriched.days_to_settlement', 'date_expand', 'enrich'),
  ('clean.trade_date', 'enriched.trade_year', 'date_expand', 'enrich'),
  ('clean.trade_date', 'enriched.trade_quarter', 'date_expand', 'enrich'),
  ('clean.trade_date', 'enriched.trade_month', 'date_expand', 'enrich'),
  ('clean.trade_date', 'enriched.trade_day_of_week', 'date_expand', 'enrich'),
  ('clean.trade_date', 'enriched.is_month_end', 'date_expand', 'enrich'),
  ('clean.trade_date', 'enriched.is_trading_day', 'date_expand', 'enrich'),
  ('clean.counterparty_id', 'enriched.lei_code', 'lei_lookup', 'enrich'),
  ('clean.counterparty_id', 'enriched.legal_entity_name', 'lei_lookup', 'enrich'),
  ('clean.counterparty_id', 'enriched.lei_country', 'lei_lookup', 'enrich'),
  ('clean.counterparty_id', 'enriched.credit_rating', 'lei_lookup', 'enrich'),
  ('enriched.notional_usd', 'risk_report.usd_exposure', 'exposure_rollup', 'enrich'),
  ('risk_report.usd_exposure', 'risk_report.eur_exposure', 'eur_conversion', 'enrich'),
  ('enriched.notional_usd', 'enriched.net_notional_usd', 'position_net', 'enrich'),
  ('enriched.notional_usd', 'fact_trades.notional_usd', 'write_star_schema', 'load'),
  ('enriched.notional_eur', 'fact_trades.notional_eur', 'write_star_schema', 'load'),
  ('enriched.net_notional_usd', 'fact_trades.net_notional_usd', 'write_star_schema', 'load')"""


def _emitted() -> str:
    fills = "\nUNION ALL ".join(
        f"SELECT {MONTH} AS batch_id, 'raw.{c}' AS source, 'clean.{c}' AS target, 'null_fill' AS transform, "
        f"'clean' AS stage, '{{\"null_count\":' || COUNT(*) || ',\"fill_value\":\"{v}\"}}' AS metadata "
        f"FROM raw WHERE {c} IS NULL GROUP BY 1"
        for c, v in NULL_DEFAULTS.items()
    )
    steps = EDGES
    always = (
        f"SELECT batch_id, source, target, transform, stage, '{{}}' AS metadata FROM "
        f"(SELECT DISTINCT {MONTH} AS batch_id FROM raw), "
        f"(VALUES {steps}) AS t(source, target, transform, stage)"
    )
    return (
        "SELECT *, STRPTIME(SUBSTR(batch_id, 3) || '01', '%Y%m%d') + INTERVAL '1' HOUR AS ts "
        f"FROM ({fills}\nUNION ALL {always})"
    )


def _run_edges(batch: str = "b_2", part: str = "src_suppkey % 2 = 0") -> str:
    """The edges of a stored run over a part of the trades."""
    fills = "\nUNION ALL ".join(
        f"SELECT '{batch}' AS batch_id, 'raw.{c}' AS source, 'clean.{c}' AS target, 'null_fill' AS transform, 'clean' AS stage, "
        f"'{{\"null_count\":' || COUNT(*) || ',\"fill_value\":\"{v}\"}}' AS metadata "
        f"FROM raw WHERE {c} IS NULL AND {part} HAVING COUNT(*) > 0"
        for c, v in NULL_DEFAULTS.items()
    )
    always = f"SELECT '{batch}', source, target, transform, stage, '{{}}' FROM (VALUES {EDGES}) AS t(source, target, transform, stage)"
    return _with(f"{fills}\nUNION ALL {always}", "raw")


def _triples() -> str:
    base = "http://example.org/lineage/"

    def name(column: str) -> str:
        return f"'<{base}column/' || REPLACE(REPLACE({column}, ' ', '_'), '/', '_') || '>'"

    edge = f"'<{base}edge/' || md5(source || ' ' || target) || '>'"
    rows = [
        f"SELECT {edge} || ' <http://www.w3.org/1999/02/22-rdf-syntax-ns#type> <{base}LineageEdge> .' AS triple FROM graph",
        f"SELECT {edge} || ' <{base}source> ' || {name('source')} || ' .' FROM graph",
        f"SELECT {edge} || ' <{base}target> ' || {name('target')} || ' .' FROM graph",
    ]
    for label, column in (("transform", "transform"), ("stage", "stage"), ("batchId", "batch_id")):
        rows.append(f"SELECT {edge} || ' <{base}{label}> \"' || {column} || '\" .' FROM graph")
    for label, text in (("layer", LAYER.format(none="unknown")), ("column", COLUMN)):
        rows.append(f"SELECT {name('node')} || ' <{base}{label}> \"' || {text} || '\" .' FROM nodes")
    return _with("\nUNION ALL ".join(rows), "graph", "nodes")


_FEED_COLUMNS = [
    "trade_id", "product_id", "counterparty_id", "asset_class", "currency", "direction", "notional", "quantity",
    "trade_date", "settlement_date", "settlement_status", "exchange",
]
_LINES = f"""
    WITH texts AS (
      SELECT src_partkey AS part, trade_id, notional,
        CASE WHEN src_partkey % 17 = 0 THEN 'abc' ELSE CAST(quantity AS VARCHAR) END AS quantity,
        [COALESCE(CAST(v AS VARCHAR), '') FOR v IN [trade_id, product_id, counterparty_id, asset_class, currency, direction, notional,
          CASE WHEN src_partkey % 17 = 0 THEN 'abc' ELSE CAST(quantity AS VARCHAR) END,
          STRFTIME(trade_date, '%Y-%m-%d %H:%M:%S'), STRFTIME(settlement_date, '%Y-%m-%d %H:%M:%S'), settlement_status, exchange]] AS f
      FROM raw)
    SELECT *, CASE WHEN part % 11 = 0 THEN ARRAY_TO_STRING(f[:{len(_FEED_COLUMNS) - 2}], ',')
        WHEN part % 13 = 0 THEN ARRAY_TO_STRING(f, ',') || ',late' END AS raw_line,
      COALESCE(notional, '0.0') AS amount FROM texts"""
_BAD_NUMBER = "raw_line IS NULL AND (TRY_CAST(amount AS DOUBLE) IS NULL OR TRY_CAST(quantity AS DOUBLE) IS NULL)"


def _stale(name: str, severity: str, source: str, oldest: str) -> str:
    return f"""
        SELECT 'b_test' AS batch_id, '{name}' AS rule_name, '{severity}' AS severity, 'trade_date' AS field_name,
          COALESCE(STRFTIME(newest, '%Y-%m-%d %H:%M:%S'), 'NULL') AS offending_value,
          COALESCE(CAST({source} AS VARCHAR), 'None') AS row_key, 'post_ingest' AS stage
        FROM (SELECT {source}, MAX(trade_date) AS newest FROM raw GROUP BY {source})
        WHERE newest IS NULL OR newest < TIMESTAMP '{oldest}'"""


def _freshness() -> str:
    return " UNION ALL ".join([
        _stale("supplier_is_fresh", "ERROR", "src_suppkey", "1998-11-17 00:00:00"),
        _stale("exchange_is_fresh", "WARN", "exchange", "1998-12-01 12:00:00"),
        """SELECT 'b_test', 'product_present', 'ERROR', 'product_id', NULL, COALESCE(trade_id, 'None'), 'post_ingest'
           FROM raw WHERE product_id IS NULL""",
    ])


def _freshness_score() -> str:
    counts = f"""
        SELECT 'post_ingest' AS checkpoint, r.rule_name, r.severity, COUNT(v.rule_name) AS failing_rows, r.skipped FROM (VALUES
          ('supplier_is_fresh', 'ERROR', FALSE), ('exchange_is_fresh', 'WARN', FALSE), ('absent_source', 'ERROR', TRUE),
          ('product_present', 'ERROR', FALSE)) AS r(rule_name, severity, skipped)
        LEFT JOIN ({_freshness()}) v ON v.rule_name = r.rule_name GROUP BY ALL"""
    return _scores(counts)


def _routed(rules: list, frame: str, more: str = "") -> str:
    """Rows with the worst severity and the names of the rules they break."""
    ranks = {"WARN": 2, "ERROR": 3, "CRITICAL": 4}
    broken = [(r["name"], ranks[r["severity"]], _rule_sql(r, FRAME_COLUMNS[frame])[0]) for r in rules]
    names = ", ".join(f"CASE WHEN {b} THEN '{n}' END" for n, _, b in broken if b != "FALSE")
    worst = ", ".join(f"CASE WHEN {b} THEN {k} ELSE 0 END" for _, k, b in broken if b != "FALSE")
    return f"""
        SELECT trade_id{more}, ['PASS', 'OTHER', 'WARN', 'ERROR', 'CRITICAL'][GREATEST({worst}) + 1] AS dq_route,
          CONCAT_WS(',', {names}) AS dq_rules FROM {frame}"""


_FEED = """trade_id, product_id, counterparty_id, asset_class, currency, direction, notional, quantity,
  STRFTIME(trade_date, '%Y-%m-%d %H:%M:%S') AS trade_date,
  STRFTIME(settlement_date, '%Y-%m-%d %H:%M:%S') AS settlement_date, settlement_status, exchange"""
_DEAD = """trade_id, product_id, counterparty_id, asset_class, currency, direction,
  {notional} AS notional, quantity, trade_date, settlement_date, settlement_status, exchange,
  src_suppkey, src_partkey, 'b_test' AS _dlq_batch_id, '{stage}' AS _dlq_stage, '{reason}' AS _dlq_reason"""
_HASH_TEXTS = ", ".join(
    f"COALESCE(CAST({c} AS VARCHAR), '<null>')"
    for c in (
        "trade_id", "product_id", "counterparty_id", "asset_class", "currency", "direction", "notional",
        "quantity", "trade_date", "settlement_date", "settlement_status", "exchange", "src_suppkey", "src_partkey",
    )
)
_DAILY = f"""
    SELECT CAST(STRPTIME(CAST(trade_date_key AS VARCHAR), '%Y%m%d') AS DATE) AS calendar_date,
      legal_entity_name, lei_code, credit_rating, f.currency,
      {_sum("notional_usd")} AS total_notional_usd, {_sum("notional_eur")} AS total_notional_eur,
      {_sum("net_notional_usd")} AS net_notional_usd, COUNT(*) AS trade_count
    FROM facts f JOIN counterparties c ON f.counterparty_key = c.counterparty_key GROUP BY ALL"""
_NULL_COUNTS = "\nUNION ALL ".join(
    f"SELECT '{c}' AS column_name, COUNT(*) FILTER (WHERE {c} IS NULL) AS null_count, '{v}' AS fill_value FROM raw"
    for c, v in NULL_DEFAULTS.items()
)


def oracle_sql() -> dict[str, str]:
    nulls = [r for r in BY_STAGE["post_ingest"] if r["type"] == "null_check"]
    references = [r for r in BY_STAGE["post_ingest"] if r["type"] == "referential_integrity"]
    ranges = [r for r in RULES if r["type"] == "range_check"]
    all_counts = _counts(RULES, "attributes")
    stored = _violations(BY_STAGE["post_ingest"], "raw", MONTH, ", trade_date AS ts")
    text = "CAST(NULL AS VARCHAR)"
    return {
        # sources and sinks
        "scan_parquet": "SELECT * FROM orders",
        "scan_csv_roundtrip": _with(f"SELECT {_FEED} FROM raw", "raw"),
        "scan_latest_file": _with(f"SELECT {_FEED} FROM raw WHERE settlement_status <> 'SETTLED'", "raw"),
        "csv_bad_records": _with(
            f"""SELECT raw_line, CASE WHEN raw_line IS NULL THEN trade_id END AS trade_id,
                  CASE WHEN raw_line IS NULL THEN amount END AS notional, CASE WHEN raw_line IS NULL THEN quantity END AS quantity,
                  CASE WHEN raw_line IS NULL THEN 'TypeCast' ELSE 'Ingest' END AS stage,
                  CASE WHEN raw_line IS NULL THEN 'type_cast_failure' ELSE 'malformed_line' END AS reason
                FROM ({_LINES}) WHERE raw_line IS NOT NULL OR {_BAD_NUMBER}""",
            "raw",
        ),
        "csv_good_records": _with(
            f"""SELECT trade_id, CAST(amount AS DOUBLE) AS notional, CAST(quantity AS DOUBLE) AS quantity
                FROM ({_LINES}) WHERE raw_line IS NULL AND NOT ({_BAD_NUMBER})""",
            "raw",
        ),
        "metadata_roundtrip": _stored_runs(),
        "lineage_json_roundtrip": _with(
            "SELECT source, target, transform, stage, batch_id, metadata FROM graph", "graph"
        ),
        # cleaning
        "null_fill": _with("SELECT * FROM filled", "filled"),
        "null_fill_counts": _with(_NULL_COUNTS, "raw"),
        "row_hash": _with(
            f"SELECT trade_id, src_suppkey, src_partkey, md5(CONCAT_WS('|', {_HASH_TEXTS})) AS row_hash FROM raw",
            "raw",
        ),
        "type_cast_clean": _with("SELECT * FROM typed", "typed"),
        "type_cast_rejects": _with("SELECT *, 'notional' AS failed_columns FROM failed", "failed"),
        "dedup": _with("SELECT * FROM cleaned", "cleaned"),
        "dedup_rejects": _with("SELECT * FROM duplicates", "duplicates"),
        "duplicate_trade_ids": _with(
            """SELECT trade_id, trade_date, src_suppkey, src_partkey FROM raw WHERE trade_id IN (
                 SELECT trade_id FROM raw GROUP BY trade_id HAVING COUNT(*) > 1)""",
            "raw",
        ),
        "batch_counts": _with(
            """SELECT COUNT(*) AS raw_count, COUNT(DISTINCT trade_id) AS clean_count,
                 COUNT(*) - COUNT(DISTINCT trade_id) AS duplicate_count FROM raw""",
            "raw",
        ),
        # enrichment
        "fx_convert": _with(
            "SELECT trade_id, currency, notional, fx_rate_to_usd, notional_usd, notional_eur FROM converted",
            "converted",
        ),
        "date_expand": _with(
            """SELECT trade_id, src_suppkey, src_partkey, CAST(YEAR(trade_date) AS INTEGER) AS trade_year,
                 CAST(QUARTER(trade_date) AS INTEGER) AS trade_quarter,
                 CAST(MONTH(trade_date) AS INTEGER) AS trade_month,
                 CAST(DAYOFWEEK(trade_date) + 1 AS INTEGER) AS trade_day_of_week,
                 DAY(trade_date) = DAY(LAST_DAY(trade_date)) AS is_month_end,
                 DAYOFWEEK(trade_date) BETWEEN 1 AND 5 AS is_trading_day,
                 CAST(DATE_DIFF('day', trade_date, settlement_date) AS INTEGER) AS days_to_settlement
               FROM raw""",
            "raw",
        ),
        "lei_lookup": _with(
            """SELECT trade_id, src_suppkey, src_partkey, counterparty_id, lei_code, legal_entity_name,
                 lei_country, credit_rating FROM raw LEFT JOIN entities ON counterparty_id = entity_id""",
            "raw", "entities",
        ),
        "exposure_rollup": _with(
            """SELECT trade_id, counterparty_id, asset_class, trade_date, notional_usd, cpty_total_notional_usd,
                 cpty_trade_count, running_notional_usd, asset_class_exposure_usd FROM exposed""",
            "exposed",
        ),
        "running_exposure": _with(
            "SELECT trade_id, counterparty_id, trade_date, notional_usd, running_notional_usd FROM exposed",
            "exposed",
        ),
        "position_net": _with(
            f"""SELECT *, buy_notional_usd - sell_notional_usd AS net_notional_usd FROM (
                  SELECT counterparty_id, product_id, {_sum(BUY)} AS buy_notional_usd,
                    {_sum(SELL)} AS sell_notional_usd FROM converted GROUP BY ALL)""",
            "converted",
        ),
        "position_net_rows": _with(
            """SELECT trade_id, counterparty_id, product_id, buy_notional_usd, sell_notional_usd,
                 net_notional_usd FROM enriched""",
            "enriched",
        ),
        # star schema
        "surrogate_keys": _with(
            "SELECT ROW_NUMBER() OVER (ORDER BY trade_id) AS trade_key, trade_id FROM cleaned", "cleaned"
        ),
        "dim_product": _with(
            f"""SELECT product_key, product_id, product_id AS ticker, {text} AS isin, {text} AS cusip,
                  {text} AS sedol, asset_class, {text} AS sub_asset_class, currency, exchange,
                  {text} AS country, TRUE AS is_active FROM products""",
            "products",
        ),
        "dim_counterparty": _with(
            f"""SELECT *, {text} AS rating_agency, {text} AS country, {text} AS city, {text} AS entity_type,
                  FALSE AS is_internal, TRUE AS is_active FROM counterparties""",
            "counterparties",
        ),
        "dim_date": _with(
            """SELECT CAST(STRFTIME(d, '%Y%m%d') AS INTEGER) AS date_key, d AS calendar_date,
                 CAST(YEAR(d) AS INTEGER) AS year, CAST(QUARTER(d) AS INTEGER) AS quarter,
                 CAST(MONTH(d) AS INTEGER) AS month, STRFTIME(d, '%B') AS month_name,
                 CAST(STRFTIME(d, '%u') AS INTEGER) AS day_of_week, STRFTIME(d, '%A') AS day_name,
                 d = LAST_DAY(d) AS is_month_end, MONTH(d) IN (3, 6, 9, 12) AND d = LAST_DAY(d) AS is_quarter_end,
                 MONTH(d) = 12 AND d = LAST_DAY(d) AS is_year_end,
                 CAST(STRFTIME(d, '%u') AS INTEGER) BETWEEN 1 AND 5 AS is_trading_day,
                 CAST(YEAR(d) AS INTEGER) AS fiscal_year, CAST(QUARTER(d) AS INTEGER) AS fiscal_quarter
               FROM days""",
            "days",
        ),
        "dim_product_new": _with(
            """SELECT CAST((SELECT COUNT(*) FROM products WHERE product_id <= 'PROD005')
                 + ROW_NUMBER() OVER (ORDER BY product_id) AS INTEGER) AS product_key,
                 product_id, asset_class, currency, exchange
               FROM products WHERE product_id > 'PROD005'""",
            "products",
        ),
        "dim_counterparty_new": _with(
            """SELECT CAST((SELECT COUNT(*) FROM counterparties WHERE counterparty_id <= 'CP003')
                 + ROW_NUMBER() OVER (ORDER BY counterparty_id) AS INTEGER) AS counterparty_key,
                 counterparty_id, legal_entity_name, lei_code, lei_country, credit_rating
               FROM counterparties WHERE counterparty_id > 'CP003'""",
            "counterparties",
        ),
        "fact_key_resolution": _with(
            """SELECT trade_id, product_key, counterparty_key, CAST(COALESCE(status_key, 5) AS INTEGER) AS status_key,
                 CAST(STRFTIME(trade_date, '%Y%m%d') AS INTEGER) AS trade_date_key,
                 CAST(STRFTIME(settlement_date, '%Y%m%d') AS INTEGER) AS settlement_date_key
               FROM attributes a LEFT JOIN products p ON p.product_id = a.product_id
                 LEFT JOIN counterparties c ON c.counterparty_id = a.counterparty_id
                 LEFT JOIN statuses s ON s.status_code = COALESCE(a.settlement_status, 'UNKNOWN')""",
            "attributes", "products", "counterparties", "statuses",
        ),
        "fact_unique_rejects": _with(
            """SELECT trade_id, src_suppkey, src_partkey, CASE WHEN valid THEN 'trade_id_not_unique'
                 ELSE 'direction_not_allowed' END AS constraint_reason
               FROM (SELECT *, COUNT(*) OVER (PARTITION BY trade_id, valid) AS n FROM (
                 SELECT *, direction IN ('BUY', 'SELL', 'UNKNOWN') AS valid FROM typed))
               WHERE NOT valid OR n > 1""",
            "typed",
        ),
        "fact_null_rejects": _with(
            """SELECT trade_id, src_suppkey, src_partkey, notional, quantity, COALESCE(reason, 'trade_id_not_unique') AS constraint_reason
               FROM (SELECT *, COUNT(*) OVER (PARTITION BY trade_id, reason) AS n FROM (
                 SELECT *, CASE WHEN trade_id IS NULL THEN 'trade_id_missing' WHEN notional IS NULL THEN 'notional_missing'
                     WHEN quantity IS NULL THEN 'quantity_missing'
                     WHEN COALESCE(direction, 'UNKNOWN') NOT IN ('BUY', 'SELL', 'UNKNOWN') THEN 'direction_not_allowed' END AS reason
                 FROM gappy))
               WHERE reason IS NOT NULL OR n > 1""",
            "gappy",
        ),
        "dedup_null_keys": _with(
            """SELECT product_id, trade_date, trade_id, src_suppkey, src_partkey FROM (
                 SELECT *, ROW_NUMBER() OVER (PARTITION BY product_id ORDER BY trade_date DESC NULLS LAST, trade_id NULLS FIRST,
                   src_suppkey NULLS FIRST, src_partkey NULLS FIRST) AS rn FROM gappy) WHERE rn = 1""",
            "gappy",
        ),
        "fact_constraint_rejects": _with(
            """SELECT trade_id, direction, 'direction_not_allowed' AS constraint_reason FROM cleaned
               WHERE direction NOT IN ('BUY', 'SELL', 'UNKNOWN')""",
            "cleaned",
        ),
        "fact_trades": _with("SELECT * FROM facts", "facts"),
        "fact_upsert": _with(
            """SELECT * REPLACE ('b_1' AS batch_id) FROM facts WHERE trade_year < 1998
               UNION ALL
               SELECT * REPLACE ('b_2' AS batch_id, (SELECT MAX(trade_key) FROM facts)
                 + ROW_NUMBER() OVER (ORDER BY trade_id) AS trade_key)
               FROM facts WHERE trade_year >= 1998""",
            "facts",
        ),
        "fact_current_after_compaction": _with(
            """SELECT trade_id, product_key, notional_usd, running_notional_usd,
                 CASE WHEN third THEN 'b_3' WHEN second THEN 'b_2' ELSE 'b_1' END AS batch_id,
                 CASE WHEN third THEN everything + seconds + place_3 WHEN second THEN everything + place_2 ELSE trade_key END AS trade_key
               FROM (SELECT *, COUNT(*) OVER () AS everything, COUNT(*) FILTER (second) OVER () AS seconds,
                   COUNT(*) FILTER (second) OVER (ORDER BY trade_id) AS place_2, COUNT(*) FILTER (third) OVER (ORDER BY trade_id) AS place_3
                 FROM (SELECT f.*, trade_year >= 1998 AS second, COALESCE(product_id <= 'PROD003', FALSE) AS third
                   FROM facts f LEFT JOIN products p ON f.product_key = p.product_key))""",
            "facts", "products",
        ),
        "vw_daily_cpty_exposure": _with(_DAILY, "facts", "counterparties"),
        "vw_asset_class_exposure": _with(
            f"""SELECT p.asset_class, p.currency, trade_date_key // 10000 AS year,
                  CAST((trade_date_key // 100 % 100 + 2) // 3 AS INTEGER) AS quarter,
                  {_sum("notional_usd")} AS total_notional_usd, {_sum("net_notional_usd")} AS net_notional_usd,
                  COUNT(*) AS trade_count, COUNT(DISTINCT counterparty_key) AS unique_counterparties
                FROM facts f JOIN products p ON f.product_key = p.product_key GROUP BY ALL""",
            "facts", "products",
        ),
        "class_counterparties_sketch": _with(
            """SELECT * FROM (WITH days AS (SELECT asset_class, trade_date_key AS d, counterparty_key AS c
                 FROM facts f JOIN products p ON f.product_key = p.product_key)
               SELECT asset_class, CAST(d // 10000 AS INTEGER) AS year, COUNT(DISTINCT c) AS distinct_values
               FROM days WHERE d BETWEEN 19930101 AND 19961231 GROUP BY ALL
               UNION ALL
               SELECT asset_class, NULL, COUNT(DISTINCT c) FROM days WHERE d BETWEEN 19930215 AND 19971110 GROUP BY ALL)""",
            "facts", "products",
        ),
        "vw_settlement_failures": _with(
            """SELECT trade_id, trade_date_key, notional_usd, f.currency, legal_entity_name, credit_rating,
                 p.asset_class, status_label, days_to_settlement, batch_id
               FROM facts f JOIN statuses s ON f.status_key = s.status_key
                 JOIN counterparties c ON f.counterparty_key = c.counterparty_key
                 JOIN products p ON f.product_key = p.product_key WHERE status_code = 'FAILED'""",
            "facts", "statuses", "counterparties", "products",
        ),
        # data quality
        "dq_null_check": _with(_violations(nulls, "raw"), "raw"),
        "dq_range_check": _with(_violations(ranges, "attributes"), "attributes"),
        "dq_ref_static": _with(_violations(references, "raw"), "raw"),
        "dq_ref_table": _with(
            """SELECT 'b_test' AS batch_id, 'part_listed' AS rule_name, 'ERROR' AS severity,
                 'src_partkey' AS field_name, CAST(src_partkey AS VARCHAR) AS offending_value,
                 trade_id AS row_key, 'post_ingest' AS stage
               FROM raw WHERE src_partkey NOT IN (SELECT p_partkey FROM part WHERE p_size <= 25)""",
            "raw",
        ),
        "dq_cross_field": _with(_violations(CROSS_RULES, "attributes"), "attributes"),
        "dq_violations": _with(_violations(BY_STAGE["post_ingest"], "raw"), "raw"),
        "dq_violations_first": _with(
            f"""SELECT * EXCLUDE (rn) FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY rule_name ORDER BY row_key,
                  offending_value NULLS FIRST, field_name) AS rn
                FROM ({_violations(BY_STAGE["post_ingest"], "raw")})) WHERE rn <= 1000""",
            "raw",
        ),
        "dq_rule_counts": _with(all_counts, "attributes"),
        "dq_checkpoint_score": _with(
            "\nUNION ALL ".join(f"SELECT * FROM ({_scores(_counts(BY_STAGE[s], f))})" for s, f in FRAMES.items()),
            *FRAMES.values(),
        ),
        "dq_run_all": _with(_scores(all_counts), "attributes"),
        "violations_filtered": _with(
            f"""SELECT * FROM ({stored}) WHERE severity = 'ERROR'
                ORDER BY ts DESC, batch_id, rule_name, row_key, offending_value NULLS FIRST, field_name LIMIT 500""",
            "raw",
        ),
        "violations_csv_roundtrip": _with(
            f"""SELECT CAST(DATE_TRUNC('month', ts) AS DATE) AS run_date, * FROM ({stored})
                WHERE ts >= TIMESTAMP '1994-01-01' AND ts < TIMESTAMP '1996-01-01'""",
            "raw",
        ),
        "violation_summary": _with(
            f"""SELECT rule_name, severity, COUNT(*) AS violation_count,
                  CAST(CASE severity WHEN 'CRITICAL' THEN 1 WHEN 'ERROR' THEN 2 WHEN 'WARN' THEN 3 ELSE 4 END
                    AS INTEGER) AS severity_rank
                FROM ({stored}) GROUP BY ALL""",
            "raw",
        ),
        "latest_scores": _stored_scores(),
        "vw_dq_score_trend": f"SELECT * EXCLUDE (rules_skipped) FROM ({_stored_scores()})",
        "dq_scorecard": f"""SELECT batch_id, checkpoint, dq_score, total_violations, rules_failed
            FROM ({_stored_scores()}) WHERE batch_id = 'b_2' AND checkpoint = 'pre_load'""",
        "dq_stored_violations": _stored_violations(),
        "dq_freshness": _with(_freshness(), "raw"),
        "dq_freshness_score": _with(_freshness_score(), "raw"),
        "dq_route": _with(
            f"""SELECT *, CASE WHEN dq_route IN ('ERROR', 'CRITICAL') THEN 'dead' ELSE 'kept' END AS side
                FROM ({_routed([*BY_STAGE["post_clean"], *BY_STAGE["pre_load"], *CROSS_RULES], "attributes")})""",
            "attributes",
        ),
        "dlq_quality": _with(
            f"""SELECT trade_id, CAST(notional AS VARCHAR) AS notional, settlement_status, 'dq_failed: ' || dq_rules AS reason
                FROM ({_routed(BY_STAGE["post_clean"], "cleaned", ", notional, settlement_status")})
                WHERE dq_route IN ('ERROR', 'CRITICAL')""",
            "cleaned",
        ),
        "dq_rule_errors": _with(
            """SELECT 'product_present' AS rule_name, 'ERROR' AS severity, 'product_id' AS field_name, COUNT(*) AS violations
               FROM raw WHERE product_id IS NULL
               UNION ALL SELECT 'no_field', 'ERROR', 'unknown', 1 UNION ALL SELECT 'bad_bound', 'ERROR', 'quantity', 1""",
            "raw",
        ),
        # dead letters
        "dlq_roundtrip": _with(
            f"""SELECT {_DEAD.format(notional="notional", stage="TypeCast", reason="type_cast_failure")} FROM failed
                UNION ALL
                SELECT {_DEAD.format(notional="CAST(notional AS VARCHAR)", stage="Dedup", reason="duplicate_trade_id")}
                FROM duplicates""",
            "failed", "duplicates",
        ),
        "dlq_counts": _with(
            f"""SELECT {MONTH} AS _dlq_batch_id, 'TypeCast' AS _dlq_stage, COUNT(*) AS records FROM failed GROUP BY 1
                UNION ALL
                SELECT {MONTH}, 'Dedup', COUNT(*) FROM duplicates GROUP BY 1""",
            "failed", "duplicates",
        ),
        "dlq_reprocess": _with(
            """SELECT * REPLACE (COALESCE(TRY_CAST(notional AS DOUBLE), 0.0) AS notional) FROM failed""", "failed"
        ),
        "dlq_batch_failure": _with(
            "SELECT *, 'b_test' AS _dlq_batch_id, 'FxConvert' AS _dlq_stage, "
            "'no rates for this batch' AS _dlq_reason FROM raw",
            "raw",
        ),
        "dlq_route_keys": _with(
            """SELECT CASE WHEN trade_id IN (SELECT trade_id FROM failed) THEN 'dead' ELSE 'kept' END AS side,
                 COUNT(*) AS records FROM raw GROUP BY 1""",
            "raw", "failed",
        ),
        # run metadata
        "stage_counts": _with(_stage_counts(), *_RUN_FRAMES),
        "latest_runs": f"SELECT * FROM ({_stored_runs()}) WHERE batch_id = 'b_2'",
        # lineage
        "lineage_emitted": _with(_emitted(), "raw"),
        "lineage_batch_edges": _with("SELECT * FROM log WHERE batch_id = 'b_3'", "log"),
        "lineage_latest_batch": _run_edges(),
        "lineage_kept_graph": f"""
            WITH runs AS (SELECT * FROM ({_run_edges("b_1", "TRUE")}) UNION ALL SELECT * FROM ({_run_edges()}))
            SELECT source, target, arg_max(transform, batch_id) AS transform, arg_max(stage, batch_id) AS stage,
              max(batch_id) AS batch_id, arg_max(metadata, batch_id) AS metadata FROM runs GROUP BY source, target""",
        "violations_latest_batch": f"SELECT * FROM ({_stored_violations()}) WHERE batch_id = 'b_2'",
        "lineage_edge_count": _with("SELECT COUNT(*) AS edge_count FROM log", "log"),
        "lineage_merge": _with("SELECT * FROM log WHERE batch_id IN ('b_1', 'b_2')", "log"),
        "lineage_graph_edges": _with("SELECT * FROM graph", "graph"),
        "lineage_graph_incremental": _with("SELECT * FROM graph", "graph"),
        "lineage_ancestors": _reach(NODE, "target", "source"),
        "lineage_descendants": _reach(node_name(2), "source", "target"),
        "lineage_path": _path(node_name(1), NODE),
        "lineage_transforms_touching": _with(
            f"SELECT DISTINCT transform FROM log WHERE '{node_name(90)}' IN (source, target)", "log"
        ),
        "lineage_impact": _with(
            f"""SELECT DISTINCT 'descendant' AS kind, node AS name FROM walk WHERE node <> '{node_name(90)}'
                UNION ALL
                SELECT DISTINCT 'transform', transform FROM graph
                WHERE source IN (SELECT node FROM walk) OR target IN (SELECT node FROM walk)""",
            "graph",
            recursive=f"""walk AS (SELECT '{node_name(90)}' AS node
                UNION SELECT target FROM walk JOIN graph ON source = node)""",
        ),
        "lineage_direct": _with(
            f"""SELECT 'source' AS role, source AS node, transform, stage FROM graph WHERE target = '{node_name(90)}'
                UNION ALL
                SELECT 'target', target, transform, stage FROM graph WHERE source = '{node_name(90)}'""",
            "graph",
        ),
        "lineage_layers": _with(
            f"""SELECT CAST(LIST_POSITION([{_list([*LAYER_ORDER, 'other'])}], layer) AS INTEGER) AS layer_order,
                  layer, node FROM (SELECT {KNOWN} AS layer, node FROM nodes)""",
            "nodes",
        ),
        "lineage_summary": _with(
            f"""SELECT (SELECT COUNT(*) FROM nodes) AS node_count, (SELECT COUNT(*) FROM graph) AS edge_count,
                  (SELECT COUNT(DISTINCT {KNOWN}) FROM nodes WHERE {KNOWN} <> 'other') AS layer_count,
                  (SELECT COUNT(DISTINCT batch_id) FROM log) AS batch_count,
                  (SELECT COUNT(DISTINCT transform) FROM graph) AS transform_count""",
            "graph", "nodes",
        ),
        "lineage_summary_members": _with(
            f"""SELECT DISTINCT 'layer' AS kind, {KNOWN} AS name FROM nodes WHERE {KNOWN} <> 'other'
                UNION ALL SELECT DISTINCT 'batch', batch_id FROM log
                UNION ALL SELECT DISTINCT 'transform', transform FROM graph""",
            "graph", "nodes",
        ),
        "lineage_nodes": _with(
            f"SELECT node AS id, {LAYER.format(none='unknown')} AS layer, {COLUMN} AS \"column\" FROM nodes", "nodes"
        ),
        "lineage_edges_export": _with("SELECT * FROM graph", "graph"),
        "lineage_cytoscape_nodes": _with(
            f"""SELECT id, label, layer, CASE layer {COLOURS} ELSE '#9CA3AF' END AS color FROM (
                  SELECT node AS id, {COLUMN} AS label, {LAYER.format(none='other')} AS layer FROM nodes)""",
            "nodes",
        ),
        "lineage_cytoscape_edges": _with(
            "SELECT source, target, transform AS label, transform, stage FROM graph", "graph"
        ),
        "rdf_triples": _triples(),
        # the whole pipeline
        "pipeline_end_to_end": _with(_DAILY, "facts", "counterparties"),
    }
