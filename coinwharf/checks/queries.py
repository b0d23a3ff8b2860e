"""One query per operator, each over whole benchmark tables."""

from __future__ import annotations

import datetime as dt
import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from coinwharf.checks.inputs import TARGET_KEYS, spark_input
from coinwharf.functions import numeric, temporal, text
from coinwharf.operators.absence import without_match
from coinwharf.operators.kinds import column_kinds
from coinwharf.operators.latest import latest_per_key
from coinwharf.operators.share import with_percentage
from coinwharf.operators.upsert import apply_updates, merge_upsert
from coinwharf.plans import reports, summaries
from coinwharf.plans.audit import action_counts, quality_counts, read_log, rejected_rows
from coinwharf.plans.chain import Run, load_curated, load_raw, run_batch
from coinwharf.plans.curated import SPECS, complete_rows, merge_curated, upsert_source
from coinwharf.plans.lake import Lake
from coinwharf.plans.summaries import ACCOUNT_VOLUMES, IMAGED, MONTHLY_TOTALS, PRODUCT_REVENUE, refresh_activity
from coinwharf.schemas import ENTITIES, RAW_COLUMNS, curated_schema
from coinwharf.session import work_path
from coinwharf.sources.landing import list_files, load_plan, planned, routed
from coinwharf.sources.notifications import decode_notifications, encode_notifications, undecodable
from coinwharf.sources.tables import SnapshotTable
from coinwharf.streaming.arrivals import file_arrivals, message_arrivals, start_chain

Query = Callable[[SparkSession, str], DataFrame]

BEFORE = dt.datetime(2025, 12, 1)
RUN_TS = dt.datetime(2026, 1, 1)
AS_OF = dt.date(2026, 1, 1)
LAST_DAY = dt.date(2001, 8, 1)

QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


# -- reports ---------------------------------------------------------------------


@query
def top_customers(spark, sf):
    return reports.top_customers(
        spark_input(spark, sf, "transactions"), spark_input(spark, sf, "customers"), status="f"
    )


@query
def monthly_trend(spark, sf):
    sales = spark_input(spark, sf, "sales").drop("status").withColumnRenamed("line", "status")
    return reports.monthly_trend(sales)


@query
def product_share(spark, sf):
    return reports.product_share(spark_input(spark, sf, "sales"), spark_input(spark, sf, "products"), status="R")


@query
def inactive_accounts(spark, sf):
    return reports.inactive_accounts(
        spark_input(spark, sf, "accounts"), spark_input(spark, sf, "transactions"), LAST_DAY
    )


@query
def suspicious(spark, sf):
    return reports.suspicious(
        spark_input(spark, sf, "transactions"), spark_input(spark, sf, "customers"), above=450000
    )


@query
def suspicious_hot(spark, sf):
    """Amounts per customer where all rows share two accounts, which are dealt over many tasks on both sides."""
    account = F.when(F.dayofmonth("date") > 10, "hot").otherwise("cold").alias("account_id")
    sales = spark_input(spark, sf, "transactions").select("transaction_id", account, "amount", "date", "status")
    owner = F.when(F.col("customer_id") % 10 > 3, "hot").otherwise("cold").alias("account_id")
    people = spark_input(spark, sf, "customers").select("customer_id", "name", owner)
    pairs = reports.suspicious(sales, people, above=400000, hot={"part_rows": 100})
    return pairs.groupBy("customer_id", "status").agg(F.count("*").alias("n"), numeric.exact_sum(F.col("amount"), 2).cast("double").alias("amount"))


@query
def product_order(spark, sf):
    """The order a report is shown in, as a column."""
    return reports.placed(reports.PRODUCT_SHARE, product_share(spark, sf)).select("place", "product_id")


@query
def suspicious_order(spark, sf):
    return reports.placed(reports.SUSPICIOUS, suspicious(spark, sf)).select("place", "transaction_id", "customer_id")


# -- reports kept up to date by what changed ---------------------------------------


def _loaded(spark, sf) -> tuple[Lake, SnapshotTable]:
    """Three loads of transactions that add and update rows; the summaries follow each."""
    lake = Lake(spark, work_path(spark, "lake"))
    table, spec = lake.curated("transaction"), SPECS["transaction"]
    for name in ("load_1", "load_2", "load_3"):
        rows = spark_input(spark, sf, name)
        values = {
            "transaction_id": F.concat(F.lit("T"), F.col("k").cast("string")),
            "account_id": F.concat(F.lit("A"), F.col("account").cast("string")),
            "product_id": F.concat(F.lit("P"), F.col("product").cast("string")),
            "branch_id": F.concat(F.lit("B"), F.col("branch").cast("string")),
        }
        values |= {c: F.col(c) for c in ("date", "status", "amount")}
        fields = [(values.get(f.name, F.lit(None))).cast(f.dataType).alias(f.name) for f in curated_schema("transaction")]
        table.merge(rows.select(*fields), [spec.key], spec.on_match, load_id=name, changes=IMAGED)
        for summary in (ACCOUNT_VOLUMES, MONTHLY_TOTALS, PRODUCT_REVENUE):
            summary.refresh(lake, table)
        refresh_activity(lake, table)
    return lake, table


@query
def trend_by_deltas(spark, sf):
    lake, table = _loaded(spark, sf)
    return reports.trend_rows(MONTHLY_TOTALS.read(MONTHLY_TOTALS.refresh(lake, table)))


@query
def share_by_deltas(spark, sf):
    lake, table = _loaded(spark, sf)
    products = spark_input(spark, sf, "select distinct 'P' || cast(p_partkey % 25 as string) as product_id from {part}")
    return reports.shares(PRODUCT_REVENUE.read(PRODUCT_REVENUE.refresh(lake, table)), products)


@query
def customers_by_deltas(spark, sf):
    """The greatest customers of two per account."""
    lake, table = _loaded(spark, sf)
    customers = spark_input(
        spark, sf, "select c_custkey as customer_id, c_name as name, 'A' || cast(c_custkey % 120 as string) as account_id from {customer}"
    )
    return reports.greatest_customers(ACCOUNT_VOLUMES.read(ACCOUNT_VOLUMES.refresh(lake, table)), customers, 50)


@query
def inactive_by_state(spark, sf):
    """Accounts without a recent transaction, from their last days, as of three days."""
    lake, table = _loaded(spark, sf)
    activity = refresh_activity(lake, table).read()
    accounts = spark_input(spark, sf, "select distinct 'A' || cast(c_custkey % 120 as string) as account_id, 'name' as account_name from {customer}")
    parts = [
        summaries.inactive_by_state(accounts, activity, day).select("account_id", F.lit(day).alias("as_of"))
        for day in ("2000-01-01", "2001-06-01", "2001-12-15")
    ]
    return parts[0].unionAll(parts[1]).unionAll(parts[2])


@query
def inferred_types(spark, sf):
    """The type of each text column that leaves every value as it is."""
    return column_kinds(spark_input(spark, sf, "kinds"))


# -- operators ---------------------------------------------------------------------


@query
def latest_per_customer(spark, sf):
    rows = spark_input(spark, sf, "transactions").select("account_id", "date", "transaction_id", "amount")
    return latest_per_key(rows, ["account_id"], ["date", "transaction_id"])


@query
def share_of_total(spark, sf):
    groups = spark_input(spark, sf, "sales").groupBy("branch_id").agg(numeric.exact_sum(F.col("amount")).alias("total"))
    return with_percentage(groups, "total", "percentage").withColumn("total", F.col("total").cast("double"))


@query
def rows_without_match(spark, sf):
    parts = spark_input(spark, sf, "products")
    dear = spark_input(spark, sf, "sales").groupBy("product_id").agg(F.max("amount").alias("most")).where("most > 94000")
    return without_match(parts, dear, ["product_id"])


def _book(spark, sf):
    return spark_input(spark, sf, "book"), spark_input(spark, sf, "book_changes")


@query
def upsert_rows(spark, sf):
    target, source = _book(spark, sf)
    return merge_upsert(target, source, ["o_orderkey"], ["o_totalprice", "day"])


@query
def upsert_action_counts(spark, sf):
    return action_counts(upsert_rows(spark, sf))


@query
def updated_rows(spark, sf):
    target, source = _book(spark, sf)
    return apply_updates(target, source, ["o_orderkey"], ["o_totalprice", "o_orderstatus"])


@query
def stored_upsert(spark, sf):
    """The upsert on a stored table, partitioned by a day that moves for updated rows."""
    target, source = _book(spark, sf)
    month = F.trunc("day", "month")
    target, source = target.withColumn("day", month), source.withColumn("day", month)
    table = SnapshotTable(spark, work_path(spark, "book"), target.schema, ("day", "day"), ["o_orderkey"])
    table.merge(target, ["o_orderkey"], [])
    table.merge(source, ["o_orderkey"], ["o_totalprice", "day"])
    return table.read()


@query
def replaced_table(spark, sf):
    """A table replaced by a query over itself."""
    table = SnapshotTable(spark, work_path(spark, "trend"))
    table.replace(monthly_trend(spark, sf))
    table.replace(table.read().where("total_transactions > 1"))
    return table.read()


@query
def partitioned_table(spark, sf):
    """A table with a day partition derived from a timestamp, read back by day."""
    events = spark.read.parquet(f"{sf}/events.parquet").select(
        "event_id", F.col("ts").cast("timestamp").alias("ts"), "event_type"
    )
    table = SnapshotTable(
        spark, work_path(spark, "events"), events.schema, ("event_day", "ts"), ["event_type", "event_id"]
    )
    table.append(events)
    return table.read().select("event_id", "event_type", F.to_date("ts").alias("event_day"))


# -- functions and predicates --------------------------------------------------------


@query
def trim_names(spark, sf):
    return spark_input(spark, sf, "texts").select("id", text.trim_whitespace(F.col("padded")).alias("name"))


@query
def validate_email(spark, sf):
    return spark_input(spark, sf, "texts").select("id", text.valid_email(F.col("email")).alias("email"))


@query
def validate_phone(spark, sf):
    phone = F.col("phone")
    return spark_input(spark, sf, "texts").select(
        "id", text.valid_phone(phone).alias("phone"), text.valid_phone(phone, normalize=True).alias("normalized")
    )


@query
def strip_non_alnum(spark, sf):
    return spark_input(spark, sf, "texts").select("id", text.strip_non_alnum(F.col("dirty")).alias("stripped"))


@query
def strip_non_word(spark, sf):
    return spark_input(spark, sf, "texts").select("id", text.strip_non_word(F.col("dirty")).alias("stripped"))


@query
def blank_non_alnum(spark, sf):
    return spark_input(spark, sf, "texts").select("id", text.blank_non_alnum(F.col("dirty")).alias("blanked"))


@query
def parse_dates(spark, sf):
    return spark_input(spark, sf, "days").select("id", temporal.to_day(F.col("text")).alias("day"))


@query
def clamp_future_date(spark, sf):
    day = temporal.clamp_future(temporal.to_day(F.col("text")), temporal.day_literal("2000-01-01"))
    return spark_input(spark, sf, "days").select("id", day.alias("day"))


@query
def three_months_back(spark, sf):
    return spark_input(spark, sf, "days").select("id", temporal.months_before(F.col("day"), 3).alias("day"))


@query
def month_text(spark, sf):
    return spark_input(spark, sf, "days").select("id", temporal.year_month(F.col("day")).alias("year_month"))


@query
def ratio_or_null(spark, sf):
    """Tax in percent of the discount; a discount of zero gives no ratio."""
    lines = spark.read.parquet(f"{sf}/lineitem.parquet")
    ratio = numeric.percent_of(F.col("l_tax"), F.col("l_discount"))
    return lines.select("l_orderkey", "l_linenumber", "l_partkey", ratio.alias("ratio"))


@query
def bool_casts(spark, sf):
    return spark_input(spark, sf, "days").select(
        "id",
        numeric.to_flag(F.col("flag")).alias("as_boolean"),
        numeric.flag_text(F.col("flag")).alias("as_text"),
        numeric.flag_text(F.col("done")).alias("done_text"),
    )


@query
def required_fields(spark, sf):
    return complete_rows(spark_input(spark, sf, "required"), ["a", "b"])


@query
def status_filters(spark, sf):
    """Counts under the case-insensitive, the exact, the threshold and the day predicate."""
    rows = spark_input(spark, sf, "transactions")
    since = temporal.months_before(temporal.day_literal(LAST_DAY), 3)
    return rows.groupBy("account_id").agg(
        F.count_if(text.same_word(F.col("status"), "f")).alias("any_case"),
        F.count_if(F.col("status") == "F").alias("exact"),
        F.count_if(F.col("amount") > 100000).alias("large"),
        F.count_if(F.col("date") >= since).alias("recent"),
    )


# -- messages and files ----------------------------------------------------------------


@query
def message_paths(spark, sf):
    """Messages encoded from the events and decoded again; every seventh is cut short."""
    objects = spark_input(spark, sf, "objects")
    body = F.base64(F.encode(F.to_json(F.struct("bucket", "name")), "UTF-8"))
    damaged = F.when(F.col("event_id") % 7 == 0, F.substring(body, 1, 21)).otherwise(body)
    return decode_notifications(objects.select("event_id", damaged.alias("data"))).select("event_id", "path")


@query
def undecodable_messages(spark, sf):
    objects = spark_input(spark, sf, "objects")
    body = F.to_json(F.struct("bucket", F.when(F.col("event_id") % 5 > 0, F.col("name")).alias("name")))
    messages = objects.select("event_id", F.base64(F.encode(body, "UTF-8")).alias("data"))
    return undecodable(decode_notifications(messages)).select("event_id", "bucket")


@query
def route_files(spark, sf):
    return routed(spark_input(spark, sf, "paths")).where("table is not null").select("event_id", "table")


@query
def skipped_files(spark, sf):
    return routed(spark_input(spark, sf, "paths")).where("table is null").select("event_id", "path")


@query
def planned_loads(spark, sf):
    """Files per table and write mode, from a job configuration document."""
    document = {
        "bigquery": {"write_mode_default": "append"},
        "tables": {"account": {"write_mode": "overwrite"}, "branch": {"write_mode": None}},
    }
    path = work_path(spark, "config")
    spark.createDataFrame([(json.dumps(document, indent=1),)], "value string").coalesce(1).write.text(path)
    files = planned(spark_input(spark, sf, "paths"), load_plan(spark, path))
    return files.groupBy("table", "write_mode").agg(F.count("*").alias("files"))


def _land(rows: DataFrame, landing: str, name: str, columns: list[str] | None = None) -> None:
    """Write rows as CSV files whose names start with ``name``."""
    (
        rows.select(*(columns or rows.columns))
        .write.mode("append")
        .option("header", True)
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .option("mapreduce.output.basename", name)
        .csv(landing)
    )


def _land_all(spark, sf, landing, older=True, current=True):
    """The raw inputs as landed files; older transactions have their columns in reverse."""
    if older:
        for entity in ("account", "branch", "customer", "products"):
            _land(spark_input(spark, sf, f"raw_{entity}"), landing, f"Datafile_{entity.upper()}s")
        _land(
            spark_input(spark, sf, "raw_transaction_older"),
            landing,
            "Datafile_transactions_old",
            RAW_COLUMNS["transaction"][::-1],
        )
        _land(spark.read.parquet(f"{sf}/nation.parquet"), landing, "notes")
    if current:
        _land(spark_input(spark, sf, "raw_transaction"), landing, "Datafile_transactions")


@query
def raw_load(spark, sf):
    """Raw tables loaded from CSV files: id, name and day of every landed row."""
    landing, lake = work_path(spark, "landing"), Lake(spark, work_path(spark, "lake"), partition_raw_by_day=True)
    _land_all(spark, sf, landing)
    load_raw(lake, list_files(spark, landing), Run.of("load", RUN_TS, AS_OF))
    picks = {
        "account": ("account_id", "account_name", "created_date"),
        "branch": ("branch_id", "branch_name", "opened_date"),
        "customer": ("customer_id", "customer_name", "registration_date"),
        "products": ("product_id", "product_name", "launch_date"),
        "transaction": ("transaction_id", "status", "date"),
    }
    parts = [
        lake.raw(entity).read().select(
            F.lit(entity).alias("entity"),
            F.col(id_).alias("id"),
            F.col(name).alias("name"),
            F.col(day).alias("day"),
            F.col("ingestion_timestamp").cast("date").alias("ingested"),
        )
        for entity, (id_, name, day) in picks.items()
    ]
    result = parts[0]
    for part in parts[1:]:
        result = result.unionAll(part)
    return result


# -- curated loads -----------------------------------------------------------------------


def _raw(spark, sf, entity):
    rows = spark_input(spark, sf, f"raw_{entity}")
    return rows.unionByName(spark_input(spark, sf, "raw_transaction_older")) if entity == "transaction" else rows


def _target(spark, sf, entity):
    """Curated rows from before the load: an id, text ``old`` and the old stamps."""
    table, key = TARGET_KEYS[entity]
    rows = spark_input(spark, sf, f"select {key} as _key from {{{table}}}")
    spec = SPECS[entity]
    stamp = F.lit(BEFORE.replace(tzinfo=dt.timezone.utc))

    def value(field):
        if field.name == spec.key:
            return F.col("_key").alias(field.name)
        if field.name in spec.stamps:
            return stamp.alias(field.name)
        text_column = field.dataType.simpleString() == "string"
        return (F.lit("old") if text_column else F.lit(None)).cast(field.dataType).alias(field.name)

    return rows.select(*[value(f) for f in curated_schema(entity)])


def _curated(entity: str) -> Query:
    def run(spark, sf):
        source = upsert_source(_raw(spark, sf, entity), SPECS[entity], AS_OF, RUN_TS)
        merged = merge_curated(_target(spark, sf, entity), source, SPECS[entity])
        stamps = {c: F.col(c).cast("date") for c in SPECS[entity].stamps}
        if entity == "transaction":
            stamps["timestamp"] = F.col("timestamp").cast("string")
        return merged.withColumns(stamps)

    return run


def _stored_curated(entity: str) -> Query:
    def run(spark, sf):
        """The same load through the job's own steps, over a stored table of older rows."""
        spec, lake = SPECS[entity], Lake(spark, work_path(spark, "lake"))
        lake.curated(entity).append(_target(spark, sf, entity).select(*spec.columns))
        load_curated(lake, entity, _raw(spark, sf, entity), Run.of("load", RUN_TS, AS_OF))
        stamps = {c: F.col(c).cast("date") for c in spec.stamps}
        if entity == "transaction":
            stamps["timestamp"] = F.col("timestamp").cast("string")
        return lake.curated(entity).read().withColumns(stamps)

    return run


for _entity in ENTITIES:
    QUERIES[f"curated_{_entity}"] = _curated(_entity)
    QUERIES[f"stored_curated_{_entity}"] = _stored_curated(_entity)


@query
def quality_of_raw(spark, sf):
    """Rows read, rejected and unreadable, per raw table."""
    result = None
    for entity in ENTITIES:
        raw = _raw(spark, sf, entity)
        counts = quality_counts(raw, SPECS[entity])
        names = [c for c in counts.columns if c.startswith("unreadable_")]
        unreadable = F.lit(0)
        for name in names:
            unreadable = unreadable + F.col(name)
        part = counts.select(
            F.lit(entity).alias("entity"), "rows_in", "rejected", unreadable.cast("long").alias("unreadable")
        )
        result = part if result is None else result.unionAll(part)
    return result


@query
def rejected_raw_rows(spark, sf):
    raw = _raw(spark, sf, "customer")
    return rejected_rows(raw, SPECS["customer"]).select(
        "customer_name", "email", F.array_join("missing", ",").alias("missing")
    )


@query
def rejected_keys(spark, sf):
    """Rows without a key and rows of whose key cleaning leaves nothing."""
    rejected = rejected_rows(_raw(spark, sf, "account"), SPECS["account"])
    return rejected.select("account_id", "account_name", F.array_join("missing", ",").alias("missing"))


# -- the chain ----------------------------------------------------------------------------


def _report_rows(lake: Lake) -> DataFrame:
    """The five report tables as one list of (report, key, detail, rows, amount)."""

    def part(name, key, detail, rows, amount):
        return lake.report(name).read().select(
            F.lit(name).alias("report"),
            key.cast("string").alias("key"),
            detail.cast("string").alias("detail"),
            rows.cast("long").alias("rows"),
            amount.cast("double").alias("amount"),
        )

    one = F.lit(1)
    c = F.col
    parts = [
        part(reports.TOP_CUSTOMERS, c("customer_id"), c("customer_name"), one, c("total_volume")),
        part(
            reports.MONTHLY_TREND,
            c("branch_id"),
            F.concat_ws(" ", "year_month", "transaction_status"),
            c("total_transactions"),
            c("total_amount"),
        ),
        part(reports.PRODUCT_SHARE, c("product_id"), c("revenue_percentage"), one, c("total_revenue")),
        part(reports.INACTIVE_ACCOUNTS, c("account_id"), c("account_name"), one, F.lit(None)),
        part(
            reports.SUSPICIOUS,
            c("transaction_id"),
            F.concat_ws(" ", "customer_id", "name", "date", "status"),
            one,
            c("amount"),
        ),
    ]
    result = parts[0]
    for other in parts[1:]:
        result = result.unionAll(other)
    return result


@query
def batch_chain(spark, sf):
    """CSV files to raw, curated and report tables in one batch run."""
    landing, lake = work_path(spark, "landing"), Lake(spark, work_path(spark, "lake"))
    _land_all(spark, sf, landing)
    run_batch(lake, landing, Run.of("batch", RUN_TS, LAST_DAY))
    return _report_rows(lake)


@query
def stream_chain(spark, sf):
    """The same files in two arrivals, the newer first; the reports must come out equal."""
    landing, checkpoint = work_path(spark, "landing"), work_path(spark, "arrivals")
    lake = Lake(spark, work_path(spark, "lake"))
    for older in (False, True):
        _land_all(spark, sf, landing, older=older, current=not older)
        arrivals = start_chain(file_arrivals(spark, landing), lake, checkpoint, None, RUN_TS, LAST_DAY)
        arrivals.awaitTermination()
    return _report_rows(lake)


@query
def message_chain(spark, sf):
    """Messages that name the landed files, with damaged ones and some that name no CSV file, to
    the reports; and the rows and messages the audit log counts."""
    landing, folder = work_path(spark, "landing"), work_path(spark, "messages")
    lake = Lake(spark, work_path(spark, "lake"))
    _land_all(spark, sf, landing)
    files = list_files(spark, landing)
    part = lambda n: F.regexp_extract("path", r"^(\w+:/*)([^/]+)/(.*)$", n)
    damaged = spark_input(spark, sf, "select n_name || '!' as data from {nation}")
    others = spark.read.parquet(f"{sf}/region.parquet").select(F.lit("b").alias("bucket"), F.concat("r_name", F.lit(".txt")).alias("name"))
    messages = encode_notifications(files.select(part(2).alias("bucket"), part(3).alias("name")).union(others))
    messages.union(damaged).write.json(folder)
    start = files.select(part(1).alias("start")).first()["start"]
    arrivals = message_arrivals(spark, folder).withColumn("path", F.concat(F.lit(start), "bucket", F.lit("/"), "name"))
    start_chain(arrivals, lake, work_path(spark, "arrivals"), None, RUN_TS, LAST_DAY).awaitTermination()
    none = F.lit(None)
    counted = read_log(spark, lake.audit).where("step = 'arrivals' or step = 'raw' and metric = 'rows'").select(
        F.col("step").alias("report"),
        F.when(F.col("step") == "raw", F.col("entity")).otherwise(F.col("metric")).alias("key"),
        none.cast("string").alias("detail"),
        "rows",
        none.cast("double").alias("amount"),
    )
    return _report_rows(lake).unionByName(counted)


@query
def chain_audit(spark, sf):
    """Upsert actions the audit log holds after the same files were loaded twice."""
    landing, lake = work_path(spark, "landing"), Lake(spark, work_path(spark, "lake"))
    _land_all(spark, sf, landing)
    for name in ("first", "second"):
        run_batch(lake, landing, Run.of(name, RUN_TS, LAST_DAY))
    wanted = F.col("metric").isin("rows_in", "rejected", "collapsed", "insert", "update", "keep")
    return read_log(spark, lake.audit).where(wanted & (F.col("step") == "curated")).select(
        "run_id", "entity", "metric", "rows"
    )


@query
def stream_messages(spark, sf):
    """Messages read as a stream, decoded and appended to a table batch by batch."""
    folder, checkpoint = work_path(spark, "messages"), work_path(spark, "decoded")
    encode_notifications(spark_input(spark, sf, "objects")).write.json(folder)
    table = SnapshotTable(
        spark, work_path(spark, "paths"), StructType.fromDDL("bucket string, name string, path string")
    )

    def keep(batch, batch_id):
        table.append(batch.select("bucket", "name", "path"), load_id=f"batch-{batch_id}")

    stream = (
        message_arrivals(spark, folder)
        .writeStream.foreachBatch(keep)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    stream.awaitTermination()
    return table.read()
