"""Every operator as a query over the test tables, with its SQL twin.

A query takes (spark, folder) and returns a DataFrame. Cleaning, checks, flags and
split operators run on the raw views; later ones on the stored layers of the ledger.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyspark import schemas
from tallyspark.functions import expr
from tallyspark.operators import (
    breaks,
    bronze,
    calendar,
    checks,
    cleaning,
    corpus,
    events,
    evidence,
    grounding,
    investigation,
    ledger,
    metric_index,
    positions,
    quality,
    splits,
    vectors,
)
from tallyspark.plans import jobs
from tallyspark.session import configure, shared_folder
from tallyspark.sources import files
from workbench.flaws import flawed, flawed_sql
from workbench.lake import LedgerLake, lake_for
from workbench.sql import statement
from workbench.views import RawLedger

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


class Ledger:
    """What a query may need: raw views, their cleaned form, and the stored layers."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = configure(spark)
        self.sf_dir = sf_dir
        self.raw = RawLedger(spark, sf_dir)

    @property
    def lake(self) -> LedgerLake:
        return lake_for(self.spark, self.sf_dir)

    def clean(self, name: str) -> DataFrame:
        return cleaning.clean(name, self.raw.table(name)).drop("_silver_processed_at")

    def factors(self) -> DataFrame:
        return splits.split_factors(self.clean("prices"), self.clean("corporate_actions"))

    def flawed(self, name: str) -> DataFrame:
        """A cleaned table and rows that break every rule of its check."""
        return flawed(self.clean(name), name)

    def manifest(self) -> DataFrame:
        name = "injected_issues_manifest"
        return flawed(self.raw.keep_lines().table(name), name)

    def folder(self) -> str:
        return shared_folder(self.spark)

    def silver(self, name: str) -> DataFrame:
        return self.lake.clean(name)

    def valid_trades(self) -> DataFrame:
        return positions.valid_trades(self.silver("trades"), self.silver("securities"))

    def timeline(self) -> DataFrame:
        return positions.position_timeline(
            self.silver("starting_positions"),
            self.valid_trades(),
            self.silver("reported_positions"),
            self.silver("flags"),
        )

    def reasons(self) -> DataFrame:
        return positions.break_reason_code(positions.reconciliation_status(self.timeline()))

    def causes(self) -> DataFrame:
        return positions.root_causes(positions.break_segments(self.reasons()))

    def mapped_events(self) -> DataFrame:
        return events.event_asof_forward(self.silver("filing_events"), self.silver("prices"))

    def anchors(self) -> DataFrame:
        return events._anchors(self.mapped_events())

    def held(self) -> DataFrame:
        return events.security_positions(self.lake.positions(), self.silver("prices"))

    def parsed(self) -> DataFrame:
        return investigation.parse_query(self.lake.questions())

    def packets(self) -> DataFrame:
        return jobs.run_investigation(self.lake.ensure("index"), self.lake.questions())

    def calendar(self) -> DataFrame:
        date = F.to_date("o_orderdate")
        orders = self.spark.read.parquet(f"{self.sf_dir}/orders.parquet")
        bounds = orders.agg(F.min(date).alias("first_date"), F.max(date).alias("last_date"))
        return calendar.business_calendar(bounds)


def query(name: str, sql: str | None = None) -> Callable[[Callable[[Ledger], DataFrame]], None]:
    """Register a query, and its SQL body where there is one."""

    def register(run: Callable[[Ledger], DataFrame]) -> None:
        QUERIES[name] = lambda spark, sf_dir: run(Ledger(spark, sf_dir))
        if sql:
            ORACLES[name] = statement(sql)

    return register


CELL = "account_id, security_id, position_date"


def _columns(text: str) -> list[str]:
    return [name.strip() for name in text.split(",")]


# --- sources and sinks ---------------------------------------------------------------

TRADE_RAW = (
    "trade_id, account_id, security_id, side, quantity, execution_price, trade_date, settlement_date, "
    "event_timestamp, ingestion_timestamp, source_system"
)
TRADE_SILVER = f"{TRADE_RAW}, split_adjustment_factor, adjusted_quantity, adjusted_execution_price"
CORPUS_FLAT = (
    "document_id, document_type, account_id, security_id, position_date, event_date, title, text, sources, entries"
)
NUMBERS = (
    "pre_event_return",
    "post_event_return",
    "event_day_return",
    "position_change_around_event",
    "exposure_change_around_event",
)


def _flat_corpus(documents: DataFrame, *more: str) -> DataFrame:
    """Documents with their arrays and maps as text; measured numbers are left out."""
    keys = F.array_sort(F.map_keys("metadata"))
    kept = F.filter(keys, lambda key: ~key.isin(*NUMBERS))
    pairs = F.transform(
        kept, lambda key: F.concat(key, F.lit("="), F.coalesce(F.col("metadata")[key], F.lit("null")))
    )
    return documents.select(
        *_columns(CORPUS_FLAT)[:8],
        F.array_join("source_tables", ",").alias("sources"),
        F.array_join(pairs, ";").alias("entries"),
        *more,
    )


NO_TRADE = ", ".join(f"null as {name}" for name in _columns(TRADE_RAW))


@query(
    "scan_jsonl",
    f"select {TRADE_RAW}, null as broken from r_trades union all select {NO_TRADE}, line from v_broken",
)
def _(t):
    lake, spec = t.lake.ensure("raw"), schemas.TABLES["trades"]
    raw = files.scan_jsonl(t.spark, "trades", lake.path(spec.raw), spec.schema)
    return raw.withColumnRenamed(schemas.CORRUPT_RECORD, "broken")


@query("quarantine", "select 'trades' as dataset, line, reason, true as has_file from v_broken")
def _(t):
    lines = t.lake.ensure("bronze").read(f"{schemas.QUARANTINE}/trades")
    return lines.select("dataset", "line", "reason", F.contains("_source_file", F.lit("raw/trades/")).alias("has_file"))


@query("scan_parquet", f"select {TRADE_SILVER} from s_trades")
def _(t):
    path = t.lake.ensure("silver").path(schemas.TABLES["trades"].silver)
    return files.scan_parquet(t.spark, path).select(*_columns(TRADE_SILVER))


@query("sink_parquet", "select * from c_reported_positions")
def _(t):
    path = f"{t.folder()}/reported"
    files.sink_parquet(t.clean("reported_positions"), path)
    return files.scan_parquet(t.spark, path)


@query("require_source", "select * from r_prices")
def _(t):
    lake, spec = t.lake.ensure("raw"), schemas.TABLES["prices"]
    try:
        files.scan_jsonl(t.spark, "prices", lake.path("raw/absent"), spec.schema)
    except FileNotFoundError:
        return files.scan_jsonl(t.spark, "prices", lake.path(spec.raw), spec.schema).drop(schemas.CORRUPT_RECORD)
    raise AssertionError("a missing source must not be readable")


@query("resolve_events", "select * from c_filing_events")
def _(t):
    root = t.folder()
    files.sink_parquet(t.clean("filing_events"), f"{root}/{schemas.SILVER_EVENTS[1]}")
    return files.scan_first(t.spark, [f"{root}/{path}" for path in schemas.SILVER_EVENTS])


CORPUS_PLACE = ", ".join(f"{name} nulls first" for name in files.CORPUS_ORDER)


@query(
    "sink_corpus_jsonl",
    f"select {CORPUS_FLAT}, row_number() over (order by {CORPUS_PLACE}) - 1 as place from k_corpus",
)
def _(t):
    path = f"{t.folder()}/corpus"
    documents = corpus.investigation_corpus(
        t.lake.breaks(), t.lake.metrics(), t.silver("filing_events"), t.silver("flags"), t.silver("trades")
    )
    files.sink_corpus(documents, path)
    return _flat_corpus(files.with_places(t.spark, path, files.CORPUS_SCHEMA), "place")


@query("scan_corpus_jsonl", f"select {CORPUS_FLAT} from k_corpus")
def _(t):
    return _flat_corpus(t.lake.corpus())


def _count_sql(tables: dict[str, str], label: str) -> str:
    parts = [f"select '{name}' as {label}, count(*) as rows from {table}" for name, table in tables.items()]
    return " union all ".join(parts)


@query("dataset_registry", _count_sql({name: f"r_{name}" for name in schemas.TABLES}, "dataset"))
def _(t):
    lake = t.lake.ensure("bronze")
    parts = [
        lake.bronze(name).groupBy(F.lit(name).alias("dataset")).agg(F.count(F.lit(1)).alias("rows"))
        for name in schemas.TABLES
    ]
    return _union(parts)


def _union(parts: list[DataFrame]) -> DataFrame:
    table = parts[0]
    for part in parts[1:]:
        table = table.unionByName(part)
    return table


SILVER_COUNTED = {name: f"c_{name}" for name, spec in schemas.TABLES.items() if spec.silver}
WRITTEN = SILVER_COUNTED | {
    "flags": "s_flags",
    "position_reconstruction": "g_positions",
    "reconciliation_breaks": "g_breaks",
}


@query("write_counts", _count_sql(WRITTEN, "table_name"))
def _(t):
    results = t.lake.ensure("positions").results
    counted = results["silver"].rows | results["positions"].rows
    return t.spark.createDataFrame(list(counted.items()), "table_name string, rows long")


# --- bronze --------------------------------------------------------------------------


@query(
    "bronze_metadata",
    f"select {TRADE_RAW}, 'load-1' as _bronze_load_id, true as has_file, true as has_time from r_trades",
)
def _(t):
    lake, spec = t.lake.ensure("raw"), schemas.TABLES["trades"]
    raw = files.scan_jsonl(t.spark, "trades", lake.path(spec.raw), spec.schema)
    return bronze.bronze_metadata(raw, "load-1").filter(~bronze.is_no_record()).select(
        *_columns(TRADE_RAW),
        "_bronze_load_id",
        F.contains("_source_file", F.lit("raw/trades/")).alias("has_file"),
        F.col("_ingested_at").isNotNull().alias("has_time"),
    )


def _record_hash(name: str) -> str:
    """Hash of a raw record's JSON: text quoted, the rest plain, nulls left out."""
    parts = []
    for column in schemas.RAW_SCHEMAS[name].split(","):
        field, kind = column.split()
        value = f"'\"' || {field} || '\"'" if kind == "string" else f"{field}::varchar"
        parts.append(f"'\"{field}\":' || {value}")
    return f"sha256('{{' || concat_ws(',', {', '.join(parts)}) || '}}')"


PRICE_HASH = _record_hash("prices")


@query(
    "raw_record_hash",
    " union all ".join(
        f"select '{name}' as dataset, {_record_hash(name)} as _raw_record_hash from r_{name}" for name in schemas.TABLES
    ),
)
def _(t):
    raw = t.raw.keep_lines()  # three of the tables are made of them, one five times over
    return _union(
        [
            bronze.raw_record_hash(raw.table(name)).select(F.lit(name).alias("dataset"), "_raw_record_hash")
            for name in schemas.TABLES
        ]
    )


@query(
    "metadata_passthrough",
    "select upper(trim(security_id)) as security_id, cast(price_date as date) as price_date, volume, "
    f"'load-1' as _bronze_load_id, 'feed' as _source_file, {PRICE_HASH} as _raw_record_hash, true as is_processed "
    "from r_prices",
)
def _(t):
    loaded = bronze.bronze_metadata(t.raw.table("prices"), "load-1", F.lit("feed"))
    return cleaning.clean_prices(loaded).select(
        "security_id",
        "price_date",
        "volume",
        "_bronze_load_id",
        "_source_file",
        "_raw_record_hash",
        F.col("_silver_processed_at").isNotNull().alias("is_processed"),
    )


# --- cleaning ------------------------------------------------------------------------


@query(
    "normalize_id",
    "select upper(trim(account_id)) as account_id, upper(trim(security_id)) as security_id, "
    "upper(trim(source_system)) as source_system, count(*) as rows from r_trades group by all",
)
def _(t):
    names = ("account_id", "security_id", "source_system")
    normalized = t.raw.trades().select(*[expr.normalized_id(name).alias(name) for name in names])
    return normalized.groupBy(*names).agg(F.count(F.lit(1)).alias("rows"))


@query("normalize_text", "select trim(trade_id) as trade_id from r_trades")
def _(t):
    return t.raw.trades().select(expr.normalized_text("trade_id").alias("trade_id"))


@query(
    "standardize_side",
    "select side as raw_side, case when upper(trim(side)) in ('B', 'BUY') then 'BUY' "
    "when upper(trim(side)) in ('S', 'SELL') then 'SELL' else upper(trim(side)) end as side, count(*) as rows "
    "from r_trades group by all",
)
def _(t):
    return (
        t.raw.trades()
        .select(F.col("side").alias("raw_side"), expr.standard_side("side").alias("side"))
        .groupBy("raw_side", "side")
        .agg(F.count(F.lit(1)).alias("rows"))
    )


for _name, _key in {
    "clean_securities": "securities",
    "clean_prices": "prices",
    "clean_corporate_actions": "corporate_actions",
    "clean_starting_positions": "starting_positions",
    "clean_trades": "trades",
    "clean_reported_positions": "reported_positions",
    "clean_events": "filing_events",
}.items():
    query(_name, f"select * from c_{_key}")(lambda t, key=_key: t.clean(key))


# --- flags and checks ----------------------------------------------------------------

for _name, _kind, _cte in (
    ("flag_duplicate_trade", "DUPLICATE_TRADE", "f_duplicate"),
    ("flag_unknown_security", "UNKNOWN_SECURITY", "f_unknown"),
    ("flag_missing_price", "MISSING_PRICE", "f_missing_price"),
    ("flag_invalid_quantity", "INVALID_QUANTITY", "f_quantity"),
    ("flag_invalid_price", "INVALID_PRICE", "f_price"),
    ("flag_late_arriving", "LATE_ARRIVING_TRADE", "f_late"),
):
    query(_name, f"select * from {_cte}")(
        lambda t, kind=_kind: quality.trade_flags(
            t.clean("trades"), t.clean("securities"), t.clean("prices"), kinds=(kind,)
        )
    )


@query("flag_split_break", "select * from f_split")
def _(t):
    return quality.split_break_flags(t.clean("reported_positions"), t.clean("corporate_actions"))


def _all_flags(t: Ledger) -> DataFrame:
    names = ("trades", "securities", "prices", "reported_positions", "corporate_actions")
    return quality.trade_quality_flags(*[t.silver(name) for name in names])


query("trade_quality_flags", "select * from s_flags")(_all_flags)
query("flag_id", "select flag_id, flag_type, affected_record_id from s_flags")(
    lambda t: _all_flags(t).select("flag_id", "flag_type", "affected_record_id")
)
@query(
    "flag_counts",
    "select flag_type, count(*) as count, row_number() over (order by flag_type) - 1 as place from s_flags group by 1",
)
def _(t):
    """A row per flag type, with its place as the operator returns them."""
    rows = [(r["flag_type"], r["count"], place) for place, r in enumerate(quality.flag_counts(_all_flags(t)).collect())]
    return t.spark.createDataFrame(rows, "flag_type string, count long, place long")


def _rule(table: str, rule: str, record: str, source: str, condition: str) -> str:
    return (
        f"select '{table}' as table_name, '{rule}' as rule, {record} as record_id, count(*) as row_count "
        f"from {source} where {condition} group by 3"
    )


def _duplicate(table: str, keys: tuple[str, ...], source: str) -> str:
    return (
        f"select '{table}' as table_name, 'duplicate' as rule, {_record(keys)} as record_id, count(*) as row_count "
        f"from {source} where {' and '.join(f'{key} is not null' for key in keys)} group by 3 having count(*) > 1"
    )


def _record(keys: tuple[str, ...]) -> str:
    return "concat_ws('|', " + ", ".join(f"coalesce({key}::varchar, '')" for key in keys) + ")"


def _checked(table: str, keys: tuple[str, ...], rules: dict[str, str], unique: tuple[str, ...] = ()) -> str:
    source = flawed_sql(f"c_{table}", table)
    parts = [_rule(table, rule, _record(keys), source, condition) for rule, condition in rules.items()]
    return " union all ".join(parts + ([_duplicate(table, unique, source)] if unique else []))


UNKNOWN = {"unknown_security": "coalesce(security_id, '') not in (select security_id from c_securities)"}
POSITIVE = " and ".join(f"coalesce({name}_price > 0, false)" for name in ("open", "high", "low", "close"))
PRICE_KEY = ("security_id", "price_date")
POSITION_KEY = ("account_id", "security_id", "position_date")


def _position_rules(quantity: str) -> dict[str, str]:
    return UNKNOWN | {
        "null_account_id": "account_id is null",
        "invalid_date": "position_date is null",
        "invalid_quantity": f"{quantity} is null",
    }


query(
    "check_securities",
    _checked(
        "securities",
        ("security_id",),
        {"null_security_id": "security_id is null", "null_ticker": "ticker is null"},
        ("security_id",),
    ),
)(lambda t: checks.check_securities(t.flawed("securities")))
query(
    "check_prices",
    _checked(
        "prices",
        PRICE_KEY,
        UNKNOWN
        | {
            "invalid_date": "price_date is null",
            "price_not_positive": f"not ({POSITIVE})",
            "high_below_low": "high_price < low_price",
        },
        PRICE_KEY,
    ),
)(lambda t: checks.check_prices(t.flawed("prices"), t.clean("securities")))
query(
    "check_trades",
    _checked(
        "trades",
        ("trade_id",),
        {
            "null_trade_id": "trade_id is null",
            "null_account_id": "account_id is null",
            "invalid_side": "coalesce(side, '') not in ('BUY', 'SELL')",
        },
    ),
)(lambda t: checks.check_trades(t.flawed("trades")))
query(
    "check_positions",
    " union all ".join(
        _checked(table, POSITION_KEY, _position_rules(quantity), POSITION_KEY)
        for table, quantity in (("starting_positions", "quantity"), ("reported_positions", "reported_quantity"))
    ),
)(
    lambda t: checks.check_positions(
        t.flawed("starting_positions"), t.flawed("reported_positions"), t.clean("securities")
    )
)
query(
    "check_events",
    _checked(
        "filing_events",
        ("event_id",),
        UNKNOWN | {"null_event_id": "event_id is null", "invalid_date": "event_date is null"},
    ),
)(lambda t: checks.check_events(t.flawed("filing_events"), t.clean("securities")))


# --- split adjustment ----------------------------------------------------------------

query("split_factors", "select * from v_factors")(lambda t: t.factors())


@query(
    "attach_split_factor",
    "select trade_id, account_id, security_id, trade_date, quantity, split_adjustment_factor from s_trades",
)
def _(t):
    return splits.attach_split_factor(t.clean("trades"), "trade_date", t.factors()).select(
        "trade_id", "account_id", "security_id", "trade_date", "quantity", "split_adjustment_factor"
    )


PRICE_SILVER = (
    "security_id, price_date, open_price, high_price, low_price, close_price, volume, split_adjustment_factor, "
    "adjusted_open_price, adjusted_high_price, adjusted_low_price, adjusted_close_price"
)
query("adjust_prices", f"select {PRICE_SILVER} from s_prices")(
    lambda t: splits.adjust_prices(t.clean("prices"), t.factors()).select(*_columns(PRICE_SILVER))
)
query("adjust_starting_positions", "select * from s_starting_positions")(
    lambda t: splits.adjust_starting_positions(t.clean("starting_positions"), t.factors())
)
query("adjust_trades", f"select {TRADE_SILVER} from s_trades")(
    lambda t: splits.adjust_trades(t.clean("trades"), t.factors()).select(*_columns(TRADE_SILVER))
)
query("adjust_reported_positions", "select * from s_reported_positions")(
    lambda t: splits.adjust_reported_positions(t.clean("reported_positions"), t.factors())
)


# --- positions and breaks ------------------------------------------------------------

query("valid_trades", f"select {TRADE_SILVER} from g_valid")(
    lambda t: t.valid_trades().select(*_columns(TRADE_SILVER))
)
query("daily_trade_activity", "select * from g_activity")(
    lambda t: positions.daily_trade_activity(t.valid_trades())
)
query("position_scaffold", f"select {CELL} from g_scaffold")(
    lambda t: positions.position_scaffold(
        t.silver("starting_positions"), t.valid_trades(), t.silver("reported_positions")
    ).select(*_columns(CELL))
)
query("starting_baseline", "select * from g_baseline")(
    lambda t: positions.starting_baseline(t.silver("starting_positions"))
)


def _stage(name: str, columns: str, sql_from: str, run: Callable[[Ledger], DataFrame]) -> None:
    """A stage of the reconciliation: equal snapshots written out again, some columns."""

    def rows(t: Ledger) -> DataFrame:
        return positions.repeat_rows(run(t), "_copies", "_copy").select(*_columns(columns))

    query(name, f"select {columns} from {sql_from}")(rows)


EXPECTED = f"{CELL}, starting_quantity, cumulative_buy_quantity, cumulative_sell_quantity, expected_position"
query("expected_position", f"select {EXPECTED} from g_expected")(
    lambda t: t.timeline().select(*_columns(EXPECTED)).distinct()
)
_stage("join_reported", f"{CELL}, expected_position, reported_position", "g_joined", Ledger.timeline)
query("flag_signals", "select * from g_signals")(lambda t: positions.flag_signals(t.silver("flags")))
_stage(
    "reconciliation_status",
    f"{CELL}, reported_position, position_difference, reconciliation_status",
    "g_status",
    lambda t: positions.reconciliation_status(t.timeline()),
)
_stage("break_reason_code", f"{CELL}, reported_position, break_reason_code", "g_reason", Ledger.reasons)
_stage(
    "break_segments",
    f"{CELL}, reported_position, reconciliation_status, break_segment_id",
    "(select * replace (break_segment_id::bigint as break_segment_id) from g_segments)",
    lambda t: positions.break_segments(t.reasons()),
)
_stage("first_break_date", f"{CELL}, reported_position, first_break_date", "g_positions", Ledger.causes)
_stage(
    "root_cause",
    f"{CELL}, reported_position, break_reason_code, root_cause_reason_code",
    "g_positions",
    Ledger.causes,
)
_stage(
    "days_since_first_break", f"{CELL}, reported_position, days_since_first_break", "g_positions", Ledger.causes
)
_stage("is_cascading_break", f"{CELL}, reported_position, is_cascading_break", "g_positions", Ledger.causes)


@query("position_reconstruction", "select * from g_positions")
def _(t):
    names = ("securities", "starting_positions", "trades", "reported_positions", "flags")
    return positions.position_reconstruction(*[t.silver(name) for name in names])


query("reconciliation_breaks", "select * from g_breaks")(
    lambda t: breaks.reconciliation_breaks(t.lake.positions()).drop("_gold_processed_at")
)
query(
    "break_summary",
    "select 'total' as measure, 'ALL' as value, count(*) as rows from g_positions "
    "union all select 'status', reconciliation_status, count(*) from g_positions group by 2 "
    "union all select 'break_reason', break_reason_code, count(*) from g_breaks group by 2 "
    "union all select 'root_cause', root_cause_reason_code, count(*) from g_breaks group by 2",
)(lambda t: breaks.break_summary(t.lake.positions()))


# --- event windows -------------------------------------------------------------------


def _rounded(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({name: F.round(name, 6) for name in names})


ANCHOR = "security_id, event_trading_day_index"
CLOSES = "close_m5, close_m1, close_0, close_p1, close_p5"
VOLATILITY = "round(pre_event_volatility, 6) as pre_event_volatility, round(post_event_volatility, 6) as post_event_volatility"
METRICS = (
    "event_id, security_id, event_date, event_type, event_trading_day_index, round(pre_event_return, 6) as pre_event_return, "
    "round(post_event_return, 6) as post_event_return, round(event_day_return, 6) as event_day_return, "
    f"{VOLATILITY}, position_before_event, position_after_event, position_change_around_event, exposure_before_event, "
    "exposure_after_event, exposure_change_around_event, is_full_window"
)
MEASURED = "(select * from e_prices where event_trading_day_index is not null)"

query("price_index", "select * from e_index")(lambda t: events.price_index(t.silver("prices")))
query("event_asof_forward", "select * from e_mapped")(lambda t: t.mapped_events())
query("event_price_window", "select * from e_window")(
    lambda t: events.event_price_window(t.mapped_events(), t.silver("prices"))
)


def _measured(t: Ledger) -> DataFrame:
    return events.price_window_metrics(t.anchors(), t.silver("prices"))


query("window_closes", f"select distinct {ANCHOR}, {CLOSES} from {MEASURED}")(
    lambda t: _measured(t).select(*_columns(ANCHOR), *_columns(CLOSES))
)
query(
    "window_volatility",
    f"select distinct {ANCHOR}, {VOLATILITY}, pre_return_obs, post_return_obs from {MEASURED}",
)(
    lambda t: _rounded(_measured(t), "pre_event_volatility", "post_event_volatility").select(
        *_columns(ANCHOR), "pre_event_volatility", "post_event_volatility", "pre_return_obs", "post_return_obs"
    )
)
query(
    "window_returns",
    f"select distinct {ANCHOR}, pre_event_return, post_event_return, event_day_return from {MEASURED}",
)(
    lambda t: _measured(t).select(
        *_columns(ANCHOR), "pre_event_return", "post_event_return", "event_day_return"
    )
)
query("is_full_window", f"select distinct {ANCHOR}, is_full_window from {MEASURED}")(
    lambda t: _measured(t).select(*_columns(ANCHOR), "is_full_window")
)
query(
    "security_positions",
    "select security_id, price_date, position_quantity, trading_day_index, close_price from e_held",
)(lambda t: t.held())
ANCHORED = "join e_mapped m using (event_id, security_id) where event_trading_day_index is not null"
query(
    "position_before",
    f"select distinct {ANCHOR}, position_before_event, close_price_before from e_before {ANCHORED}",
)(lambda t: events.position_before(t.anchors(), t.held()))
query(
    "position_after",
    f"select distinct {ANCHOR}, position_after_event, close_price_after from e_after {ANCHORED}",
)(lambda t: events.position_after(t.anchors(), t.held()))
EXPOSURES = (
    "position_before_event, position_after_event, position_change_around_event, exposure_before_event, "
    "exposure_after_event, exposure_change_around_event"
)
query(
    "exposure_metrics",
    f"select distinct {ANCHOR}, {EXPOSURES} from e_metrics where event_trading_day_index is not null",
)(lambda t: events.exposure_metrics(t.anchors(), t.held()))


@query("event_window_metrics", f"select {METRICS} from e_metrics")
def _(t):
    metrics = events.event_window_metrics(
        t.silver("prices"), t.silver("filing_events"), t.lake.positions()
    )
    return _rounded(metrics, *events.METRICS[:5])


query(
    "event_window_summary",
    "select count(*) as output_rows, count(*) filter (where is_full_window) as full_windows, "
    "count(*) filter (where not is_full_window) as partial_windows, "
    + ", ".join(f"count(*) filter (where {name} is null) as null_{name}" for name in events.METRICS)
    + ", (select count(*) from (select distinct event_id, security_id from c_filing_events)) as events from e_metrics",
)(lambda t: events.event_window_summary(t.silver("filing_events"), t.lake.metrics()))


# --- corpus --------------------------------------------------------------------------

query("docs_breaks", f"select {CORPUS_FLAT} from k_breaks")(
    lambda t: _flat_corpus(corpus.docs_breaks(t.lake.breaks()))
)


@query(
    "docs_events",
    f"select {CORPUS_FLAT}, " + ", ".join(f"round({name}, 6) as {name}" for name in NUMBERS) + " from k_events_full",
)
def _(t):
    documents = corpus.docs_events(t.lake.metrics(), t.silver("filing_events"))
    numbers = [
        F.round(F.col("metadata")[name].cast("double"), 6).alias(name) for name in NUMBERS
    ]
    flat = _flat_corpus(documents).columns
    keyed = documents.select("*", *numbers)
    return keyed.select("document_id", *NUMBERS).join(_flat_corpus(documents), "document_id").select(*flat, *NUMBERS)


query("docs_trade_quality", f"select {CORPUS_FLAT} from k_quality")(
    lambda t: _flat_corpus(corpus.docs_trade_quality(t.silver("flags"), t.silver("trades")))
)


def _corpus(t: Ledger) -> DataFrame:
    return corpus.investigation_corpus(
        t.lake.breaks(), t.lake.metrics(), t.silver("filing_events"), t.silver("flags"), t.silver("trades")
    )


query("investigation_corpus", f"select {CORPUS_FLAT} from k_corpus")(lambda t: _flat_corpus(_corpus(t)))
query(
    "corpus_counts", "select document_type, count(*) as count from k_corpus group by 1 order by 1"
)(lambda t: corpus.corpus_counts(_corpus(t)))


# --- retrieval -----------------------------------------------------------------------


@query(
    "vector_table",
    "select document_id, text, array_to_string(vector::int[], ',') as vector from k_documents join n_vectors using (document_id)",
)
def _(t):
    places = F.transform("vector", lambda value: value.cast("int").cast("string"))
    return vectors.vector_table(t.lake.corpus()).select(
        "document_id", "text", F.array_join(places, ",").alias("vector")
    )


VECTOR_METADATA = "document_id, document_type, account_id, security_id, position_date, event_date, title"


@query(
    "vector_metadata",
    "select document_id, document_type, coalesce(account_id, '') as account_id, security_id, "
    "coalesce(position_date::varchar, '') as position_date, coalesce(event_date::varchar, '') as event_date, title, "
    "'[\"' || replace(sources, ',', '\",\"') || '\"]' as source_tables, sources as parsed from k_corpus",
)
def _(t):
    described = vectors.vector_metadata(t.lake.corpus())
    parsed = F.array_join(vectors.parsed_source_tables("source_tables"), ",")
    return described.select(*_columns(VECTOR_METADATA), "source_tables", parsed.alias("parsed"))


@query(
    "knn_topk",
    """select query_id, document_id, round(distance, 6) as distance, cast(rank as int) as rank from (
         select query_id, document_id, distance, row_number() over (partition by query_id order by distance, document_id) as rank
         from (select c.query_id, e.vec_id::varchar as document_id,
                      sum((c.centre - e.value) * (c.centre - e.value)) as distance
               from (select 'label-' || label as query_id, place, avg(value) as centre
                     from (select label, unnest(embedding)::double as value, generate_subscripts(embedding, 1) as place
                           from embeddings) group by 1, 2) c
               join (select vec_id, unnest(embedding)::double as value, generate_subscripts(embedding, 1) as place
                     from embeddings) e using (place)
               group by 1, 2))
       where rank <= 10""",
)
def _(t):
    stored = t.spark.read.parquet(f"{t.sf_dir}/embeddings.parquet")
    centre = (
        stored.select("label", F.posexplode("embedding").alias("place", "value"))
        .groupBy("label", "place")
        .agg(F.avg("value").alias("centre"))
        .groupBy(F.format_string("label-%d", "label").alias("query_id"))
        .agg(F.array_sort(F.collect_list(F.struct("place", "centre"))).alias("places"))
        .select("query_id", F.transform("places", lambda p: p["centre"]).alias("vector"))
    )
    documents = stored.select(F.col("vec_id").alias("document_id"), F.col("embedding").alias("vector"))
    index = metric_index.build_index(documents, t.folder())
    return _rounded(index.search(centre, 10), "distance")


@query(
    "similarity_retriever",
    "select query_id, document_id, cast(rank as int) as rank, document_type, account_id, security_id, title, text, sources "
    "from n_ranked join k_documents using (document_id) where rank <= 5",
)
def _(t):
    found = vectors.similarity_retriever(t.lake.questions(), t.lake.documents(), 5, search=t.lake.search())
    return found.select(
        "query_id",
        "document_id",
        "rank",
        "document_type",
        "account_id",
        "security_id",
        "title",
        "text",
        F.array_join("source_tables", ",").alias("sources"),
    )


query("exact_metadata_evidence", "select query_id, document_id, cast(place as int) as place from n_exact")(
    lambda t: evidence.exact_metadata_evidence(t.parsed(), t.lake.documents(), 5)
)
query("security_evidence", "select query_id, document_id, cast(place as int) as place from n_security")(
    lambda t: evidence.security_evidence(t.parsed(), t.lake.documents(), 5)
)
query("hybrid_evidence", "select query_id, document_id, cast(rank as int) as rank, is_exact from n_evidence")(
    lambda t: evidence.hybrid_evidence(t.parsed(), t.lake.documents(), search=t.lake.search())
)


# --- investigation -------------------------------------------------------------------

query("parse_query", "select * from k_parsed")(lambda t: t.parsed())
BREAK_FIELDS = ", ".join(investigation.BREAK_FIELDS)
query("lookup_break", f"select query_id, {BREAK_FIELDS} from i_break")(
    lambda t: investigation.lookup_break(t.parsed(), t.lake.breaks())
)
FLAG_FIELDS = ", ".join(investigation.FLAG_FIELDS)
query("lookup_flags", f"select query_id, cast(rank as int) as rank, {FLAG_FIELDS} from i_flags")(
    lambda t: investigation.lookup_flags(t.parsed(), t.silver("flags"))
)
CONTEXT = "event_id, security_id, event_date, event_type, event_summary, is_full_window"


@query(
    "lookup_event_context",
    f"select query_id, cast(rank as int) as rank, {CONTEXT}, "
    + ", ".join(f"round({name}, 6) as {name}" for name in NUMBERS)
    + " from i_events",
)
def _(t):
    found = investigation.lookup_event_context(t.parsed(), t.lake.metrics(), t.silver("filing_events"))
    return _rounded(found, *NUMBERS).select("query_id", "rank", *_columns(CONTEXT), *NUMBERS)


def _listed(column: str, item) -> F.Column:
    return F.array_join(F.transform(column, item), ";")


def _none_if_empty(text: F.Column) -> F.Column:
    return F.when(text != "", text)


@query(
    "investigation_packet",
    "select query_id, query, account_id, security_id, target_date, summary, has_break, cast(flag_count as int) as flag_count, "
    "flags, cast(event_count as int) as event_count, events, evidence, titles, confidence_notes, missing_data_notes from i_packet",
)
def _(t):
    flag = _listed("quality_flags", lambda row: F.concat_ws(":", row["flag_type"], row["affected_record_id"]))
    return t.packets().select(
        "query_id",
        "query",
        "account_id",
        "security_id",
        "target_date",
        "summary",
        F.col("structured_break").isNotNull().alias("has_break"),
        F.coalesce(F.size("quality_flags"), F.lit(0)).alias("flag_count"),
        _none_if_empty(flag).alias("flags"),
        F.coalesce(F.size("event_context"), F.lit(0)).alias("event_count"),
        _none_if_empty(_listed("event_context", lambda row: row["event_id"])).alias("events"),
        _listed("retrieved_evidence", lambda row: row["document_id"]).alias("evidence"),
        F.array_join("retrieved_evidence_titles", ";").alias("titles"),
        F.array_join("confidence_notes", " | ").alias("confidence_notes"),
        F.array_join("missing_data_notes", " | ").alias("missing_data_notes"),
    )


STRINGS = ", ".join(
    f"{name}::varchar as {name}"
    for name in investigation.BREAK_FIELDS + ("first_break_date", "days_since_first_break")
)


@query(
    "stringify_rows",
    f"select break_id, {STRINGS}, case when is_cascading_break then 'True' else 'False' end as is_cascading_break from g_breaks",
)
def _(t):
    shown = investigation.stringify_rows(t.lake.breaks())
    names = investigation.BREAK_FIELDS + ("first_break_date", "days_since_first_break", "is_cascading_break")
    return shown.select("break_id", *names)


for _name, _check, _shown in (
    ("eval_break_found", grounding.eval_break_found, "structured_break_found"),
    ("eval_type_coverage", grounding.eval_type_coverage, "evidence_type_coverage"),
    ("eval_missing_data", grounding.eval_missing_data, "missing_data_coverage"),
):
    query(_name, f"select query_id, {_shown} from i_checks")(
        lambda t, check=_check, shown=_shown: check(t.packets()).select("query_id", shown)
    )


RISK_VARIANTS = ("as it is", "bare summary", "no evidence", "no evidence and break")


@query(
    "eval_claim_risk",
    """select query_id, variant,
              case when not broken and not shown and summary <> '' then 'HIGH'
                   when broken and len(list_filter(break_values, lambda x: x <> '' and contains(summary, x))) > 0 then 'LOW'
                   when not broken and shown and len(list_filter(evidence_values, lambda x: x <> '' and contains(summary, x))) > 0 then 'LOW'
                   else 'MEDIUM' end as unsupported_claim_risk
       from (select query_id, variant, case when variant = 'bare summary' then 'nothing to add' else summary end as summary,
                    has_break and variant <> 'no evidence and break' as broken, evidence is not null and variant not like 'no %' as shown,
                    break_values, evidence_values
             from i_claims cross join (values ('as it is'), ('bare summary'), ('no evidence'), ('no evidence and break')) v(variant))""",
)
def _(t):
    packets = t.packets().withColumn("variant", F.explode(F.array(*map(F.lit, RISK_VARIANTS))))
    none = F.lit(None)
    varied = packets.withColumns(
        {
            "summary": F.when(F.col("variant") == "bare summary", "nothing to add").otherwise(F.col("summary")),
            "retrieved_evidence": F.when(F.col("variant").startswith("no "), none).otherwise(F.col("retrieved_evidence")),
            "structured_break": F.when(F.col("variant") == "no evidence and break", none).otherwise(F.col("structured_break")),
        }
    )
    return grounding.eval_claim_risk(varied).select("query_id", "variant", "unsupported_claim_risk")


@query(
    "eval_exact_evidence", "select query_id, exact_evidence_found, matching_document_ids from i_checks"
)
def _(t):
    return grounding.eval_exact_evidence(t.packets()).select(
        "query_id",
        "exact_evidence_found",
        F.array_join("matching_document_ids", ";").alias("matching_document_ids"),
    )


@query(
    "groundedness",
    """select query_id, query, account_id, security_id, target_date, structured_break_found, exact_evidence_found,
              matching_document_ids, evidence_type_coverage, retrieved_types, missing_data_coverage, event_context_count,
              missing_data_notes_count, groundedness_score, unsupported_claim_risk,
              case when groundedness_score >= 0.8 then 'Investigation packet is well grounded in structured and retrieved evidence.'
                   when groundedness_score >= 0.6 then 'Investigation packet is usable, but review missing support before relying on summary.'
                   else 'Investigation packet needs manual review because grounding support is incomplete.' end as recommendation
       from i_scores""",
)
def _(t):
    return grounding.groundedness(t.packets()).withColumns(
        {
            "matching_document_ids": F.array_join("matching_document_ids", ";"),
            "retrieved_types": F.array_join("retrieved_types", ";"),
        }
    )


# --- ledger views and manifest -------------------------------------------------------


@query(
    "expected_by_date_basis",
    " union all ".join(
        f"""select '{basis}' as basis, {CELL},
                   case when position_date = (select min(trading_day) from l_calendar) then baseline else 0.0 end as starting_quantity,
                   greatest(net, 0.0) as buy_quantity, greatest(-net, 0.0) as sell_quantity,
                   round(baseline + run, 4) as expected_position from {cte}"""
        for basis, cte in (("trade_date", "l_trade_basis"), ("settlement_date", "l_settle_basis"))
    ),
)
def _(t):
    return ledger.expected_by_both_bases(t.clean("starting_positions"), t.clean("trades"), t.calendar())


query(
    "timing_divergence",
    f"""select {CELL}, round(t.baseline + t.run, 4) as expected_position_trade,
               round(s.baseline + s.run, 4) as expected_position_settlement
        from l_trade_basis t join l_settle_basis s using ({CELL})
        where round(t.baseline + t.run, 4) <> round(s.baseline + s.run, 4)""",
)(lambda t: ledger.timing_divergence(t.clean("starting_positions"), t.clean("trades"), t.calendar()))
GAPS = (
    "select distinct account_id, security_id from c_trades t where not exists (select 1 from c_starting_positions s "
    "where s.account_id = t.account_id and s.security_id = t.security_id)"
)
query(
    "zero_fill_starting",
    f"select {CELL}, quantity from c_starting_positions union all "
    f"select account_id, security_id, date '1995-01-01', 0.0 from ({GAPS})",
)(lambda t: ledger.zero_fill_starting(t.clean("starting_positions"), t.clean("trades"), "1995-01-01"))
query("business_calendar", "select cast(day_index as int) as day_index, trading_day from l_calendar")(
    lambda t: t.calendar()
)
query(
    "settlement_date_t2",
    """select trade_id, trade_date, cast(friday + cast(2 + 2 * floor((least(isodow(trade_date) - 1, 4) + 2) / 5) as int) as date) as settlement_date
       from (select trade_id, trade_date, trade_date - cast(greatest(isodow(trade_date) - 5, 0) as int) as friday from c_trades)""",
)(lambda t: calendar.settlement_date(t.clean("trades")).select("trade_id", "trade_date", "settlement_date"))
query("event_window_dates", "select * from l_near_events")(
    lambda t: calendar.event_window_dates(t.clean("filing_events"), t.calendar())
)
query(
    "price_required_dates",
    "select * from c_prices where (security_id, price_date) in (select (security_id, price_date) from l_required)",
)(
    lambda t: calendar.price_required_dates(
        t.clean("prices"), t.clean("trades"), t.clean("filing_events"), t.calendar()
    )
)
FORWARD = ", ".join(
    f"case when f is null then {name} else round({name} / f, 4) end as {name}"
    for name in ("open_price", "high_price", "low_price", "close_price")
)
query(
    "forward_split_prices",
    f"""select p.security_id, p.price_date, {FORWARD}, volume from c_prices p
        left join (select k.security_id, k.price_date, product(s.split_ratio) as f
                   from (select distinct security_id, price_date from c_prices) k
                   join v_splits s on s.security_id = k.security_id and s.effective_date <= k.price_date
                   group by 1, 2) x on x.security_id = p.security_id and x.price_date = p.price_date""",
)(lambda t: ledger.forward_split_prices(t.clean("prices"), t.clean("corporate_actions")))
query(
    "forward_split_positions",
    f"""select r.account_id, r.security_id, r.position_date, r.source_system,
               case when place = 1 then round(value, 4) else reported_quantity end as reported_quantity
        from (select *, row_number() over (partition by {CELL} order by reported_quantity, source_system) as place
              from c_reported_positions) r
        left join l_walk w on w.account_id = r.account_id and w.security_id = r.security_id
          and w.position_date = r.position_date""",
)(
    lambda t: ledger.forward_split_positions(
        t.silver("reported_positions").select(*_columns(CELL), "reported_quantity", "source_system"),
        t.silver("trades"),
        t.silver("corporate_actions"),
    )
)
ISSUE_KEY = "issue_type, affected_record_id, issue_date"
query(
    "check_manifest_unique",
    f"select {ISSUE_KEY}, count(*) as row_count from l_manifest group by 1, 2, 3 having count(*) > 1",
)(lambda t: checks.check_manifest_unique(t.manifest()))
query(
    "check_missing_price_targets",
    """select issue_id, security_id, cast(issue_date as date) as price_date,
              case when coalesce(security_id, '') = '' or issue_date is null then 'missing_keys' else 'not_required' end as rule
       from l_manifest m where issue_type = 'MISSING_PRICE' and not exists (
         select 1 from l_required k where k.security_id = m.security_id and k.price_date = cast(m.issue_date as date))""",
)(
    lambda t: checks.check_missing_price_targets(
        t.manifest(),
        calendar.price_required_keys(t.clean("trades"), t.clean("filing_events"), t.calendar()),
    )
)
query("check_starting_coverage", GAPS)(
    lambda t: ledger.starting_coverage_gaps(t.clean("starting_positions"), t.clean("trades"))
)
query(
    "canonical_trade_order",
    """select *, cast(rank() over (partition by account_id, security_id, trade_date
                                 order by event_timestamp, trade_id) as int) as place from c_trades""",
)(lambda t: ledger.trade_places(ledger.canonical_trade_order(t.clean("trades"))))
def _found_by_keys() -> str:
    """One membership test for each set of keys that an issue may name."""
    keys = {"account_id": "account_id", "security_id": "security_id", "issue_date": "day"}
    cases = [
        "when trade_id is not null then (expected_detection_category, trade_id) in "
        "(select (flag_type, affected_record_id) from s_flags where affected_entity = 'trades')"
    ]
    for mask in range(8):
        named = [name for bit, name in enumerate(keys) if mask >> bit & 1]
        shape = " and ".join(f"{name} is {'not ' if name in named else ''}null" for name in keys)
        ours = ", ".join(["expected_detection_category", *named])
        theirs = ", ".join(["category", *(keys[name] for name in named)])
        ours, theirs = (f"({ours})", f"({theirs})") if named else (ours, theirs)
        cases.append(f"when {shape} then {ours} in (select {theirs} from l_detected)")
    return "case " + " ".join(cases) + " end"


query(
    "detection_scorecard",
    f"""select category, count(*) as issues, count(*) filter (where is_found) as found,
              count(*) filter (where not is_found) as missed
       from (select expected_detection_category as category, {_found_by_keys()} as is_found from l_manifest)
       group by 1""",
)(
    lambda t: checks.detection_scorecard(
        t.manifest(), t.silver("flags"), t.lake.breaks()
    )
)
