"""The whole chain: landed files to raw, raw to curated, curated to reports."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame

from coinwharf.plans import reports
from coinwharf.plans.audit import collapsed_keys, refused, verdict_counts, write_log
from coinwharf.plans.curated import ORDER_STAMPS, SPECS, accepted_rows, check_spellings, classified, latest_rows
from coinwharf.plans.lake import Lake
from coinwharf.plans.raw_load import files_per_table, load_table, skipped
from coinwharf.plans.summaries import ACCOUNT_VOLUMES, IMAGED, MONTHLY_TOTALS, PRODUCT_REVENUE, inactive_by_state, refresh_activity
from coinwharf.schemas import ENTITIES
from coinwharf.session import join_side, staged
from coinwharf.sources.landing import list_files

Entry = tuple[str, str, dict[str, int]]


@dataclass(frozen=True)
class Run:
    """The clock, identity and options of one run.

    ``headers`` is how files are read, ``infer`` finds their types first (none that would change a
    value), ``normalize_phone`` repairs numbers before they are
    checked, ``null_keys`` lets rows without a key in, ``strict`` refuses a load in
    which two spellings of a key meet, and ``split_hot`` deals accounts that are hot among
    transactions and customers over many tasks.
    """

    run_id: str
    run_ts: dt.datetime
    as_of: dt.date
    headers: str = "by_name"
    infer: bool = False
    normalize_phone: bool = False
    null_keys: bool = False
    strict: bool = False
    split_hot: bool = False

    @staticmethod
    def of(
        run_id: str | None = None,
        run_ts: dt.datetime | None = None,
        as_of: dt.date | None = None,
        **options,
    ) -> "Run":
        """Fill what is not given from the wall clock (UTC), once for the whole run."""
        run_ts = run_ts or dt.datetime.now(dt.timezone.utc)
        return Run(run_id or uuid.uuid4().hex, run_ts, as_of or run_ts.date(), **options)


def _together(work: Callable, items: Iterable) -> list:
    """Run independent jobs at the same time; the cluster shares its tasks among them."""
    items = list(items)
    if not items:
        return []
    with ThreadPoolExecutor(max_workers=len(items)) as pool:
        return list(pool.map(work, items))


def load_raw(
    lake: Lake, files: DataFrame, run: Run, config_path: str | None = None, append: bool = False
) -> tuple[dict, list[Entry]]:
    """Load the listed files; returns each loaded table's rows and the audit entries.

    ``append`` keeps what is there, whatever the configured mode.
    """
    tables = files_per_table(lake, files, config_path)
    unknown = skipped(files)
    entries: list[Entry] = [("raw", "unknown", {"files_skipped": unknown.count()})]
    if entries[0][2]["files_skipped"]:
        unknown.select("path").write.mode("overwrite").parquet(f"{lake.rejects('files')}/run_id={run.run_id}")

    def load(entry):
        rows = load_table(
            lake, entry["table"], entry["paths"], "append" if append else entry["write_mode"], run.run_id, run.run_ts, run.headers, run.infer
        )
        return entry["table"], rows, len(entry["paths"])

    loaded = {}
    for table, rows, count in _together(load, tables):
        loaded[table] = rows
        entries.append(("raw", table, {"files": count, "rows": lake.raw(table).rows_loaded(run.run_id)}))
    return loaded, entries


def load_curated(lake: Lake, entity: str, raw: DataFrame, run: Run, only_new: bool = False) -> Entry:
    """Upsert one curated table from raw rows; returns its audit entry.

    The raw rows are scanned and cleaned once: all that is said and done about them is read from the
    classified rows. With ``only_new`` they are not all raw rows but those that just arrived: one of
    them replaces the row of its key only if it is the later one by the order stamps that the
    curated row keeps, so the result does not depend on how arrivals were cut, and no raw row
    of an older load is read.
    """
    spec = SPECS[entity]
    if run.strict:
        check_spellings(raw, spec)
    rows = staged(classified(raw, spec, run.as_of, run.normalize_phone, run.null_keys), "classified")
    source = latest_rows(accepted_rows(rows), spec, run.run_ts, ordered=True)
    order = {"newest": ORDER_STAMPS.names, "tie": spec.tie} if only_new else {}
    changes = IMAGED if only_new and entity == "transaction" else ()
    merge = lambda: lake.curated(entity).merge(source, [spec.key], spec.on_match, load_id=run.run_id, changes=changes, **order)
    counted = [lambda: verdict_counts(rows, spec).first().asDict(), lambda: collapsed_keys(rows, spec).first().asDict()]
    quality, collapsed, actions = _together(lambda job: job(), [*counted, merge])
    if quality["rejected"]:
        refused(rows).write.mode("overwrite").parquet(f"{lake.rejects(entity)}/run_id={run.run_id}")
    return "curated", entity, {**quality, **collapsed, **actions}


def _joined(lake: Lake, entity: str) -> DataFrame:
    """A curated table that reports join."""
    table = lake.curated(entity)
    state = table.state()
    return join_side(table.read(state), state.rows)


def build_reports(lake: Lake, run: Run) -> dict[str, DataFrame]:
    """The five reports over the curated tables, not yet computed."""
    customers, accounts, products = (_joined(lake, entity) for entity in ("customer", "account", "products"))
    transactions = lake.curated("transaction").read()
    return {
        reports.TOP_CUSTOMERS: reports.top_customers(transactions, customers),
        reports.MONTHLY_TREND: reports.monthly_trend(transactions),
        reports.PRODUCT_SHARE: reports.product_share(transactions, products),
        reports.INACTIVE_ACCOUNTS: reports.inactive_accounts(accounts, transactions, run.as_of),
        reports.SUSPICIOUS: reports.suspicious(transactions, customers, hot={} if run.split_hot else None),
    }


def build_from_summaries(lake: Lake, run: Run) -> dict[str, DataFrame]:
    """The same reports; four of them from summaries that take in only what changed."""
    stored = lake.curated("transaction")
    summaries = (ACCOUNT_VOLUMES, MONTHLY_TOTALS, PRODUCT_REVENUE)
    *tables, activity = _together(
        lambda refresh: refresh(lake, stored), [*(summary.refresh for summary in summaries), refresh_activity]
    )
    volumes, months, revenue = (summary.read(table) for summary, table in zip(summaries, tables))
    customers, accounts, products = (_joined(lake, entity) for entity in ("customer", "account", "products"))
    return {
        reports.TOP_CUSTOMERS: reports.greatest_customers(volumes, customers),
        reports.MONTHLY_TREND: reports.trend_rows(months),
        reports.PRODUCT_SHARE: reports.shares(revenue, products),
        reports.INACTIVE_ACCOUNTS: inactive_by_state(accounts, activity.read(), run.as_of),
        reports.SUSPICIOUS: reports.suspicious(stored.read(), customers, hot={} if run.split_hot else None),
    }


def refresh_reports(lake: Lake, run: Run, only_new: bool = False) -> list[Entry]:
    """Compute the reports and put them in place of the old ones."""

    def refresh(item):
        name, report = item
        return "reporting", name, {"rows": lake.report(name).replace(report, load_id=run.run_id)}

    build = build_from_summaries if only_new else build_reports
    return _together(refresh, build(lake, run).items())


def run_files(
    lake: Lake,
    files: DataFrame,
    run: Run,
    config_path: str | None = None,
    only_new: bool = False,
    noted: Iterable[Entry] = (),
) -> list[Entry]:
    """Load the listed files and bring curated tables and reports up to date.

    A batch run curates the whole raw tables. ``only_new`` is what a stream of arrivals needs:
    it adds to the raw tables, curates just the rows that these files brought, and brings the
    summaries behind the reports up to date by what that changed.
    """
    loaded, entries = load_raw(lake, files, run, config_path, append=only_new)
    if only_new:
        sources = loaded
    else:
        states = dict(zip(ENTITIES, _together(lambda entity: lake.raw(entity).state(), ENTITIES)))
        sources = {entity: lake.raw(entity).read(state) for entity, state in states.items() if state.rows}
    _together(lambda entity: lake.curated(entity).ensure(), ENTITIES)
    entries += _together(lambda entity: load_curated(lake, entity, sources[entity], run, only_new), sources)
    entries += [*refresh_reports(lake, run, only_new), *noted]
    write_log(lake.spark, lake.audit, run.run_id, entries, run.run_ts)
    return entries


def run_batch(
    lake: Lake, landing: str, run: Run, config_path: str | None = None, only_new: bool = False
) -> list[Entry]:
    """One run over everything in the landing folder."""
    return run_files(lake, list_files(lake.spark, landing), run, config_path, only_new)
