"""Raw ledger tables derived from the test tables.

The test tables hold no ledger, so lines of orders stand in for trades: the
customer's region is the account, the part's brand is the security and the order
date is the trade date. All rows of the tables are used. Ids are written untidily
on purpose, so that cleaning has work to do, and known faults are built in: the
data repeats (order, line) pairs, brand 25 is missing from the security master,
some prices, quantities and reports are missing or wrong.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyspark.functions.frames import every_date, union_all
from tallyspark.session import drop_folder, shared_folder
from tallyspark.sources import files

EPOCH = "1995-01-01"
SPLIT_BASE = "1996-01-01"
REVERSE_SPLIT = "2000-03-01"
RAW_TABLES = (
    "securities",
    "prices",
    "corporate_actions",
    "starting_positions",
    "trades",
    "reported_positions",
    "filing_events",
    "injected_issues_manifest",
)
# What the raw tables need of a joined order line.
LINE = (
    "l_orderkey",
    "l_linenumber",
    "l_quantity",
    "l_extendedprice",
    "l_tax",
    "l_returnflag",
    "l_linestatus",
    "a",
    "s",
    "d",
)


def _day(text: str) -> F.Column:
    return F.lit(text).cast("date")


class RawLedger:
    """The raw tables as lazy DataFrames over one folder of test tables."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir
        self._frames: dict[str, DataFrame] = {}
        self._kept: str | None = None

    def _read(self, name: str) -> DataFrame:
        if name not in self._frames:
            self._frames[name] = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        return self._frames[name]

    def table(self, name: str) -> DataFrame:
        return getattr(self, name)()

    def _lines(self) -> DataFrame:
        """Order lines with account number a, security number s and trade date d."""
        if self._kept:
            return files.scan_parquet(self.spark, self._kept)
        nations = self._read("nation").select(
            F.col("n_nationkey").alias("c_nationkey"), (F.col("n_regionkey") + 1).alias("a")
        )
        customers = self._read("customer").select("c_custkey", "c_nationkey")
        orders = self._read("orders").select(
            F.col("o_orderkey").alias("l_orderkey"),
            F.col("o_custkey").alias("c_custkey"),
            F.to_date("o_orderdate").alias("d"),
        )
        parts = self._read("part").select(
            F.col("p_partkey").alias("l_partkey"), self._security_number("p_brand").alias("s")
        )
        # Orders find their account before the lines meet them: there are fewer of them.
        owned = orders.join(customers, "c_custkey").join(nations, "c_nationkey")
        return self._read("lineitem").join(owned, "l_orderkey").join(parts, "l_partkey").select(*LINE)

    def keep_lines(self) -> "RawLedger":
        """Store the joined lines once, for who reads more than one table that is made of them."""
        if not self._kept:
            path = shared_folder(self.spark)
            files.sink_parquet(self._lines(), path)
            self._kept = path
        return self

    def drop_lines(self) -> None:
        """Remove the stored lines; frames made of them can't be read any more."""
        if self._kept:
            drop_folder(self.spark, self._kept)
            self._kept = None

    @staticmethod
    def _security_number(brand: str) -> F.Column:
        return F.substring(brand, 7, 2).cast("int")

    @staticmethod
    def _quantity() -> F.Column:
        zero = (F.col("l_linenumber") == 7) & (F.col("l_tax") < 0.005)
        return F.when(zero, 0.0).otherwise(F.col("l_quantity"))

    @staticmethod
    def _is_late() -> F.Column:
        return F.col("l_tax") > 0.075

    def _known_security_numbers(self) -> DataFrame:
        return (
            self._read("part")
            .select(self._security_number("p_brand").alias("s"))
            .filter("s < 25")
            .distinct()
        )

    def _order_dates(self) -> DataFrame:
        return self._read("orders").select(F.to_date("o_orderdate").alias("d"))

    def broken_lines(self) -> DataFrame:
        """Lines that are no trade records, one for some of the orders, and why."""
        key = F.col("o_orderkey")
        kinds = [
            (11, F.format_string('{"trade_id": "TRD%d', key), "NOT_JSON"),
            (12, F.format_string('"order %d"', key), "NOT_A_RECORD"),
            (13, F.format_string("order %d is late", key), "NOT_JSON"),
        ]
        found = [F.when(key % 40 == at, F.struct(line.alias("line"), F.lit(why).alias("reason"))) for at, line, why in kinds]
        return self._read("orders").select(F.coalesce(*found).alias("found")).filter("found is not null").select("found.*")

    def securities(self) -> DataFrame:
        s = F.col("s")
        return self._known_security_numbers().select(
            F.format_string(" sec%03d ", s).alias("security_id"),
            F.format_string("tkr%d", s).alias("ticker"),
            F.format_string(" Brand %d Inc. ", s).alias("company_name"),
            F.when(s % 2 == 0, "nyse").otherwise(" nasdaq").alias("exchange"),
            F.when(s < 13, "Technology ").otherwise("Energy").alias("sector"),
            (s != 9).alias("is_active"),
        )

    def prices(self) -> DataFrame:
        """A price per known security and order date, but none on the day of the
        month that equals the security number; a few repeated and crossed rows."""
        s, k, day = F.col("s"), F.datediff("d", _day(EPOCH)), F.dayofmonth("d")
        close = 100.0 + 5 * s + ((37 * k + 11 * s) % 23) * 0.5
        base = (
            every_date(self._known_security_numbers(), self._order_dates(), "d")
            .filter(day != s)
            .withColumn("close", close)
        )
        again = base.filter(((s == 5) & (day == 17)) | ((s == 6) & (day == 18))).withColumn(
            "close", F.when(s == 6, F.col("close") + 0.5).otherwise(F.col("close"))
        )
        crossed = (s == 11) & (day == 15)
        return base.unionByName(again).select(
            F.format_string(" sec%03d", s).alias("security_id"),
            F.col("d").cast("string").alias("price_date"),
            (F.col("close") - 0.5).alias("open_price"),
            (F.col("close") + F.when(crossed, -2.0).otherwise(1.0)).alias("high_price"),
            (F.col("close") - 1.5).alias("low_price"),
            F.col("close").alias("close_price"),
            (1000 * s + k).cast("long").alias("volume"),
        )

    def corporate_actions(self) -> DataFrame:
        """A split per nation of region 2, a reverse split, a dividend per supplier."""
        n, s = F.col("n_nationkey"), F.col("s_suppkey")
        nations = self._read("nation")
        splits = nations.filter("n_regionkey = 2").select(
            F.format_string(" CA-SPL-%d", n).alias("corporate_action_id"),
            F.format_string("sec%03d", n).alias("security_id"),
            F.lit(" stock_split").alias("action_type"),
            F.date_add(_day(SPLIT_BASE), n * 60).cast("string").alias("effective_date"),
            F.when(n % 2 == 0, 2.0).otherwise(4.0).alias("split_ratio"),
            F.lit(" forward split ").alias("description"),
        )
        reverse = nations.filter("n_nationkey = 3").select(
            F.lit("CA-SPL-3").alias("corporate_action_id"),
            F.lit("sec002").alias("security_id"),
            F.lit("stock_split").alias("action_type"),
            F.lit(REVERSE_SPLIT).alias("effective_date"),
            F.lit(0.5).alias("split_ratio"),
            F.lit("reverse split").alias("description"),
        )
        dividends = self._read("supplier").select(
            F.format_string("CA-DIV-%d", s).alias("corporate_action_id"),
            F.format_string("sec%03d", s % 24 + 1).alias("security_id"),
            F.lit("cash_dividend").alias("action_type"),
            F.date_add(_day(EPOCH), (150 + s % 2000).cast("int")).cast("string").alias("effective_date"),
            F.lit(None).cast("double").alias("split_ratio"),
            F.lit("dividend").alias("description"),
        )
        return union_all([splits, reverse, dividends])

    @staticmethod
    def _starting_quantity() -> F.Column:
        """Baseline of a pair; four securities per account have none."""
        gap = F.col("s") - F.col("a")
        return F.when(~gap.isin(0, 5, 10, 15), 1000.0 * F.col("a") + 100.0 * F.col("s"))

    def _pairs(self) -> DataFrame:
        return self._lines().select("a", "s").distinct()

    def starting_positions(self) -> DataFrame:
        return (
            self._pairs()
            .withColumn("quantity", self._starting_quantity())
            .filter("quantity is not null")
            .select(
                F.format_string("acc%03d", "a").alias("account_id"),
                F.format_string("sec%03d ", "s").alias("security_id"),
                F.lit(EPOCH).alias("position_date"),
                "quantity",
            )
        )

    @staticmethod
    def _trade_id() -> F.Column:
        return F.format_string("TRD%d-%d", "l_orderkey", "l_linenumber")

    def trades(self) -> DataFrame:
        no_price = (F.col("l_linenumber") == 6) & F.col("l_tax").between(0.005, 0.015)
        arrival = F.when(self._is_late(), F.date_add("d", 3)).otherwise(F.col("d"))
        return self._lines().select(
            F.concat(F.lit(" "), self._trade_id()).alias("trade_id"),
            F.format_string("acc%03d", "a").alias("account_id"),
            F.format_string(" sec%03d ", "s").alias("security_id"),
            F.when(F.col("l_returnflag") == "A", "b")
            .when(F.col("l_returnflag") == "R", "Buy")
            .when(F.col("l_linestatus") == "O", " SELL ")
            .otherwise("s")
            .alias("side"),
            self._quantity().alias("quantity"),
            F.when(~no_price, F.col("l_extendedprice") / F.col("l_quantity")).alias("execution_price"),
            F.col("d").cast("string").alias("trade_date"),
            F.date_add("d", 2).cast("string").alias("settlement_date"),
            F.concat(F.col("d").cast("string"), F.lit("T10:00:00")).alias("event_timestamp"),
            F.concat(arrival.cast("string"), F.lit("T11:00:00")).alias("ingestion_timestamp"),
            F.when(F.col("l_linestatus") == "O", "oms_alpha")
            .otherwise(" ems_beta")
            .alias("source_system"),
        )

    @staticmethod
    def _own_factor(day_column: str) -> F.Column:
        """Ratio product of the splits after this day; 1.0 on days without a price."""
        s, day = F.col("s"), F.col(day_column)
        effective = F.date_add(_day(SPLIT_BASE), s * 60)
        forward = F.when((s % 5 == 2) & (day < effective), F.when(s % 2 == 0, 2.0).otherwise(4.0))
        reverse = F.when((s == 2) & (day < _day(REVERSE_SPLIT)), 0.5)
        product = F.coalesce(forward, F.lit(1.0)) * F.coalesce(reverse, F.lit(1.0))
        return F.when(F.dayofmonth(day) == s, 1.0).otherwise(product)

    def reported_positions(self) -> DataFrame:
        """The custodian's books: it sees late trades three days on, errs on set days
        of the month, is silent on one day a quarter and repeats some reports."""
        a, s, day = F.col("a"), F.col("s"), F.dayofmonth("d")
        signed = F.when(F.col("l_returnflag") == "N", -self._quantity()).otherwise(self._quantity())
        booked = F.when(self._is_late(), F.date_add("d", 3)).otherwise(F.col("d"))
        moves = (
            self._lines()
            .withColumn("net", signed * self._own_factor("d"))
            .filter("s < 25")
            .groupBy("a", "s", booked.alias("d"))
            .agg(F.sum("net").alias("net"))
        )
        pairs = self._pairs().filter("s < 25")
        cells = every_date(pairs, self._order_dates(), "d").withColumn("cell", F.lit(True))
        to_date = Window.partitionBy("a", "s").orderBy("d")
        running = F.sum(F.coalesce("net", F.lit(0.0))).over(to_date)
        base = F.coalesce(self._starting_quantity(), F.lit(0.0)) * F.coalesce(
            F.when(s == 2, 1.0).when(s % 10 == 2, 2.0).when(s % 10 == 7, 4.0), F.lit(1.0)
        )
        silent = (day == a) & F.month("d").isin(1, 4, 7, 10)
        effective = F.date_add(_day(SPLIT_BASE), s * 60)
        error = (
            F.when((day == 13) & (s == a + 7), 25.0)
            .when((day == 27) & (s == 2 * a + 1), 150.0)
            .when((a == 1) & (s % 5 == 2) & (F.col("d") == effective), 10.0)
            .otherwise(0.0)
        )
        books = (
            union_all([cells, moves])
            .withColumn("held", base + running)
            .filter(F.col("cell") & ~silent)
            .withColumn("quantity", F.col("held") / self._own_factor("d") + error)
        )
        again = F.when((a == 3) & (s == 7) & (day == 21), F.array(F.lit(0.0), F.lit(40.0))).when(
            (a == 4) & (s == 8) & (day == 22), F.array(F.lit(0.0), F.lit(0.0))
        )
        extra = F.explode(F.coalesce(again, F.array(F.lit(0.0))))
        return books.withColumn("extra", extra).select(
            F.format_string("ACC%03d ", "a").alias("account_id"),
            F.format_string("sec%03d", "s").alias("security_id"),
            F.col("d").cast("string").alias("position_date"),
            (F.col("quantity") + F.col("extra")).alias("reported_quantity"),
            F.lit("custody_gamma ").alias("source_system"),
        )

    def filing_events(self) -> DataFrame:
        """One event per order; the order priority picks the type."""
        kinds = {
            "1-URGENT": "earnings_release",
            "2-HIGH": "sec_10k",
            "3-MEDIUM": " sec_10q",
            "4-NOT SPECIFIED": "dividend_announcement",
            "5-LOW": "guidance_update ",
        }
        priority = F.col("o_orderpriority")
        lookup = F.create_map(*[F.lit(part) for pair in kinds.items() for part in pair])
        date = F.to_date("o_orderdate")
        return self._read("orders").select(
            F.format_string(" EVT%d", "o_orderkey").alias("event_id"),
            F.format_string("sec%03d", F.col("o_custkey") % 24 + 1).alias("security_id"),
            F.when(priority == "5-LOW", F.date_add(date, 2))
            .otherwise(date)
            .cast("string")
            .alias("event_date"),
            lookup[priority].alias("event_type"),
            F.format_string(" Order %d has status %s", "o_orderkey", "o_orderstatus").alias(
                "event_summary"
            ),
        )

    def injected_issues_manifest(self) -> DataFrame:
        """The built-in faults, each with the category that should detect it."""
        lines = self._lines()
        text = F.lit(None).cast("string")
        account = F.format_string("ACC%03d", "a")
        security = F.format_string("SEC%03d", "s")

        def issues(
            rows: DataFrame, kind: str, entity: str, record: F.Column, category: str | None = None, **keys
        ) -> DataFrame:
            parts = {name: keys.get(name, text) for name in ("account_id", "security_id", "trade_id", "issue_date")}
            return rows.select(
                F.lit(kind).alias("issue_type"),
                F.lit(entity).alias("affected_entity"),
                record.alias("affected_record_id"),
                *[part.cast("string").alias(name) for name, part in parts.items()],
                F.lit(category or kind).alias("expected_detection_category"),
            ).distinct()

        trade = self._trade_id()
        ids = lines.select("l_orderkey", "l_linenumber")
        repeated = ids.groupBy("l_orderkey", "l_linenumber").count().filter("count > 1")
        reports = (
            every_date(self._pairs().filter("s < 25"), self._order_dates(), "d")
        )
        wrong = reports.filter(
            ((F.dayofmonth("d") == 13) & (F.col("s") == F.col("a") + 7))
            | ((F.dayofmonth("d") == 27) & (F.col("s") == 2 * F.col("a") + 1))
        )
        cell = F.concat_ws("|", account, security, F.col("d").cast("string"))
        parts = [
            issues(repeated, "DUPLICATE_TRADE", "trades", trade, trade_id=trade),
            issues(lines.filter(self._is_late()), "LATE_ARRIVING_TRADE", "trades", trade, trade_id=trade),
            issues(
                lines.filter("s = 25"),
                "INVALID_SECURITY_ID",
                "trades",
                trade,
                "UNKNOWN_SECURITY",
                trade_id=trade,
            ),
            issues(
                lines.filter("s < 25 and dayofmonth(d) = s"),
                "MISSING_PRICE",
                "prices",
                F.concat_ws("|", security, F.col("d").cast("string")),
                security_id=security,
                issue_date=F.col("d"),
            ),
            issues(
                wrong,
                "WRONG_REPORTED_POSITION",
                "reported_positions",
                cell,
                "QUANTITY_MISMATCH",
                account_id=account,
                security_id=security,
                issue_date=F.col("d"),
            ),
        ]
        return union_all(parts).select(
            F.concat_ws("-", F.lit("ISS"), "issue_type", "affected_record_id").alias("issue_id"),
            "issue_type",
            "affected_entity",
            "affected_record_id",
            "account_id",
            "security_id",
            "trade_id",
            "issue_date",
            "expected_detection_category",
            F.lit("built into the view").alias("short_description"),
        )
