"""The registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per operator.

Every query runs over the whole driver tables of ``sf_dir``.  As in the
layered pipeline, each layer reads the one below it: the Silver operators run
on the raw tables (through the canonical bindings); Gold operators run on the
Silver tables, and reports on the Gold tables, which ``Lake`` materialises
from the same inputs on first use.  Processing stamps are left out so results
are deterministic; storage queries write to fresh locations under the shared
folder (``spark.checkpoint.dir``) and read back what they wrote.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ledgerloom.operators import curate, marts, merchants, months, quality, recurrence, signals, sketches
from ledgerloom.plans import insights, messy, pipeline, upsert
from ledgerloom.plans.lake import Lake
from ledgerloom.session import scratch_path
from ledgerloom.sources import contracts, evolution, files, landing, tables, zorder
from ledgerloom.sources.bindings import DriverTables
from ledgerloom.streaming.dedup_stream import dedup_stream
from ledgerloom.streaming.landing_stream import land_stream

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(name: str):
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        return fn
    return register


class Layers:
    """Silver views over one scale-factor directory, built lazily."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.tables = DriverTables(spark, sf_dir)

    def silver_txn(self) -> DataFrame:
        return curate.clean_transactions(self.tables.unique_ledger(), stamp=False, dedup=False)

    def silver_events(self) -> DataFrame:
        return curate.clean_transactions(self.tables.raw_event_ledger(), stamp=False)

    def silver_customers(self) -> DataFrame:
        return curate.clean_customers(self.tables.raw_customers(), stamp=False)


# ------------------------------------------------------------------ Silver (K1, K2)

@query("dedup_transactions")
def q_dedup(spark, sf_dir):
    return Layers(spark, sf_dir).tables.unique_ledger()


@query("standardise_text")
def q_standardise(spark, sf_dir):
    return curate.standardise_transactions(Layers(spark, sf_dir).tables.unique_ledger())


@query("date_parts")
def q_date_parts(spark, sf_dir):
    ev = Layers(spark, sf_dir).silver_events()
    return ev.select("transaction_id", "txn_year", "txn_month", "txn_day", "txn_day_of_week", "txn_hour",
                     "is_weekend")


@query("calendar_flags")
def q_calendar_flags(spark, sf_dir):
    ev = Layers(spark, sf_dir).silver_events()
    return ev.select("transaction_id", "txn_day", "is_month_end", "is_salary_period", "is_weekend")


@query("filter_valid")
def q_filter_valid(spark, sf_dir):
    raw = Layers(spark, sf_dir).tables.raw_ledger()
    valid = curate.valid_transactions(curate.standardise_transactions(raw))
    return valid.select("transaction_id", "customer_id", "amount", "transaction_type")


@query("clean_transactions")
def q_clean_transactions(spark, sf_dir):
    return Layers(spark, sf_dir).silver_txn()


@query("clean_events")
def q_clean_events(spark, sf_dir):
    return Layers(spark, sf_dir).silver_events()


@query("quarantined_transactions")
def q_quarantined(spark, sf_dir):
    return curate.quarantined_transactions(Layers(spark, sf_dir).tables.unique_ledger(), dedup=False)


@query("null_flags")
def q_null_flags(spark, sf_dir):
    raw = Layers(spark, sf_dir).tables.unique_ledger()
    flagged = curate.flag_nulls(raw, contracts.LEDGER_COLUMNS)
    return flagged.select("transaction_id", F.size("_null_flags").alias("null_fields"))


@query("ledger_by_time")
def q_ledger_by_time(spark, sf_dir):
    return curate.ledger_by_time(Lake(spark, sf_dir).txn()).select(
        "transaction_id", "transaction_date", "customer_id", "amount")


@query("clean_customers")
def q_clean_customers(spark, sf_dir):
    return Layers(spark, sf_dir).silver_customers()


# ------------------------------------------------------------------ Gold parts and marts (K3, K4)

@query("monthly_spend")
def q_monthly_spend(spark, sf_dir):
    return marts.monthly_spend(Lake(spark, sf_dir).txn())


@query("monthly_income")
def q_monthly_income(spark, sf_dir):
    return marts.monthly_income(Lake(spark, sf_dir).txn())


@query("month_end_spend")
def q_month_end_spend(spark, sf_dir):
    return marts.month_end_spend(Lake(spark, sf_dir).txn())


@query("category_spend")
def q_category_spend(spark, sf_dir):
    return marts.category_spend(Lake(spark, sf_dir).txn())


@query("top_category")
def q_top_category(spark, sf_dir):
    return marts.top_category(Lake(spark, sf_dir).txn(), "one")


@query("top_category_ties")
def q_top_category_ties(spark, sf_dir):
    return marts.top_category(Lake(spark, sf_dir).txn(), "all")


@query("preferred_channel")
def q_preferred_channel(spark, sf_dir):
    return marts.preferred_channel(Lake(spark, sf_dir).txn(), "one")


@query("preferred_channel_ties")
def q_preferred_channel_ties(spark, sf_dir):
    return marts.preferred_channel(Lake(spark, sf_dir).txn(), "all")


@query("lifetime_stats")
def q_lifetime_stats(spark, sf_dir):
    return marts.lifetime_stats(Lake(spark, sf_dir).txn())


@query("stress_by_customer")
def q_stress_by_customer(spark, sf_dir):
    return marts.stress_by_customer(Lake(spark, sf_dir).monthly_summary())


@query("monthly_summary")
def q_monthly_summary(spark, sf_dir):
    return marts.monthly_summary(Lake(spark, sf_dir).txn())


@query("monthly_summary_ties")
def q_monthly_summary_ties(spark, sf_dir):
    return marts.monthly_summary(Lake(spark, sf_dir).txn(), ties="all")


@query("monthly_summary_events")
def q_monthly_summary_events(spark, sf_dir):
    return marts.monthly_summary(Layers(spark, sf_dir).silver_events())


@query("customer_profile")
def q_customer_profile(spark, sf_dir):
    lake = Lake(spark, sf_dir)
    return marts.customer_profile(lake.customers(), lake.txn(), lake.monthly_summary())


@query("customer_profile_ties")
def q_customer_profile_ties(spark, sf_dir):
    lake = Lake(spark, sf_dir)
    return marts.customer_profile(lake.customers(), lake.txn(), lake.monthly_summary("all"), ties="all")


@query("profile_from_months")
def q_profile_from_months(spark, sf_dir):
    """K4 from customers and the stored customer months in shared buckets; Silver isn't read."""
    lake = Lake(spark, sf_dir)
    return months.customer_profile(lake.bucketed_customers(), lake.customer_months())


@query("yearly_distincts")
def q_yearly_distincts(spark, sf_dir):
    """Exact distinct merchants and categories per customer and year, united from the months' sets."""
    stored, keys = Lake(spark, sf_dir).customer_months(), ["customer_id", "txn_year"]
    parts = [months.distinct_counts(stored, name, keys, f"unique_{name}") for name in months.SETS]
    return parts[0].join(parts[1], keys)


# ------------------------------------------------------------------ insights

def _profile(spark, sf_dir) -> DataFrame:
    """The Gold profile table, as the reports read it (without activity columns)."""
    return Lake(spark, sf_dir).customer_profile().drop(*marts.ACTIVITY)


@query("spend_by_segment")
def q_spend_by_segment(spark, sf_dir):
    return insights.spend_by_segment(Lake(spark, sf_dir).customer_profile(), months=None)


@query("stress_by_province")
def q_stress_by_province(spark, sf_dir):
    return insights.stress_by_province(_profile(spark, sf_dir))


@query("category_totals")
def q_category_totals(spark, sf_dir):
    return insights.category_totals(Lake(spark, sf_dir).txn())


@query("monthly_volume")
def q_monthly_volume(spark, sf_dir):
    return insights.monthly_volume(Lake(spark, sf_dir).txn())


@query("stress_report")
def q_stress_report(spark, sf_dir):
    return insights.stress_report(_profile(spark, sf_dir))


@query("stress_by_segment")
def q_stress_by_segment(spark, sf_dir):
    return insights.stress_by_segment(_profile(spark, sf_dir))


# ------------------------------------------------------------------ quality

@query("null_report")
def q_null_report(spark, sf_dir):
    return quality.null_report(Lake(spark, sf_dir).txn(), contracts.LEDGER_COLUMNS)


@query("numeric_profile")
def q_numeric_profile(spark, sf_dir):
    return quality.numeric_profile(Lake(spark, sf_dir).txn(), ["amount", "txn_day", "txn_hour"])


@query("amount_quartiles")
def q_amount_quartiles(spark, sf_dir):
    return quality.quartile_profile(Lake(spark, sf_dir).txn(), "amount")


@query("type_split")
def q_type_split(spark, sf_dir):
    return quality.value_counts(Lake(spark, sf_dir).txn(), "transaction_type")


@query("segment_mix")
def q_segment_mix(spark, sf_dir):
    return quality.relative_frequency(Lake(spark, sf_dir).customers(), "segment")


@query("top_merchants")
def q_top_merchants(spark, sf_dir):
    txn = Lake(spark, sf_dir).txn()
    return quality.top_values(txn.filter(F.col("transaction_type") == "DEBIT"), "merchant_name", 10)


@query("credits_by_day")
def q_credits_by_day(spark, sf_dir):
    return quality.day_histogram(Lake(spark, sf_dir).txn(), "CREDIT")


@query("quality_gate")
def q_quality_gate(spark, sf_dir):
    return quality.quality_gate(Lake(spark, sf_dir).txn())


# ------------------------------------------------------------------ signals

@query("salary_earners")
def q_salary_earners(spark, sf_dir):
    return signals.salary_earners(Lake(spark, sf_dir).txn())


@query("grant_recipients")
def q_grant_recipients(spark, sf_dir):
    return signals.grant_recipients(Lake(spark, sf_dir).txn())


@query("category_spikes")
def q_category_spikes(spark, sf_dir):
    return signals.category_spikes(Lake(spark, sf_dir).txn())


@query("income_bands")
def q_income_bands(spark, sf_dir):
    return signals.income_band(Lake(spark, sf_dir).customers())


@query("favourite_category")
def q_favourite_category(spark, sf_dir):
    return signals.favourite_category(Lake(spark, sf_dir).txn())


@query("avg_monthly_spend")
def q_avg_monthly_spend(spark, sf_dir):
    return signals.average_monthly_spend(Lake(spark, sf_dir).txn())


@query("merchant_categories")
def q_merchant_categories(spark, sf_dir):
    txn = Lake(spark, sf_dir).txn()
    assigned = signals.assign_categories(txn, signals.merchant_dimension(txn))
    return assigned.select("transaction_id", "merchant_name", "merchant_category", "assigned_category")


@query("reference_merchant_lookup")
def q_reference_merchant_lookup(spark, sf_dir):
    txn = Lake(spark, sf_dir).txn()
    dim = signals.reference_merchants(spark).withColumnRenamed("display_name", "merchant_name")
    assigned = signals.assign_categories(txn, dim)
    return assigned.groupBy("assigned_category").agg(F.count(F.lit(1)).alias("transactions"))


@query("recurring_credits")
def q_recurring_credits(spark, sf_dir):
    return recurrence.recurring_credits(Lake(spark, sf_dir).txn())


@query("quantile_sketches")
def q_quantile_sketches(spark, sf_dir):
    """Yearly quartiles of the amounts from stored monthly sketches, each checked against the transactions."""
    txn = Lake(spark, sf_dir).txn()
    monthly = tables.stored(sketches.monthly_sketches(txn, "amount", ["txn_year", "txn_month"]), "sketches")
    return sketches.rank_check(txn, "amount", sketches.merged(monthly, ["txn_year"]), ["txn_year"])


# ------------------------------------------------------------------ rules on input that triggers them

@query("messy_clean")
def q_messy_clean(spark, sf_dir):
    return curate.clean_transactions(messy.messy_ledger(DriverTables(spark, sf_dir)), stamp=False)


@query("messy_dedup")
def q_messy_dedup(spark, sf_dir):
    return curate.dedup_transactions(messy.messy_ledger(DriverTables(spark, sf_dir))).select(*contracts.LEDGER_COLUMNS)


@query("messy_quarantine")
def q_messy_quarantine(spark, sf_dir):
    rows = curate.quarantined_transactions(messy.messy_ledger(DriverTables(spark, sf_dir)))
    return rows.select("transaction_id", "amount", "transaction_date", "reason")


@query("messy_null_flags")
def q_messy_null_flags(spark, sf_dir):
    flagged = curate.flag_nulls(messy.messy_ledger(DriverTables(spark, sf_dir)), contracts.LEDGER_COLUMNS)
    return flagged.select("transaction_id", F.array_join("_null_flags", ",").alias("null_fields"))


@query("messy_customers")
def q_messy_customers(spark, sf_dir):
    return curate.clean_customers(messy.messy_customers(DriverTables(spark, sf_dir)), stamp=False)


@query("tied_top_category")
def q_tied_top_category(spark, sf_dir):
    return marts.top_category(messy.tied(Lake(spark, sf_dir).txn()), "all")


@query("tied_monthly_summary")
def q_tied_monthly_summary(spark, sf_dir):
    return marts.monthly_summary(messy.tied(Lake(spark, sf_dir).txn()), ties="all")


@query("catalogue_lookup")
def q_catalogue_lookup(spark, sf_dir):
    txn = messy.catalogue_named(Lake(spark, sf_dir).txn())
    dim = signals.reference_merchants(spark).withColumnRenamed("display_name", "merchant_name")
    return signals.assign_categories(txn, dim).select("transaction_id", "merchant_name", "assigned_category")


@query("longest_code_lookup")
def q_longest_code_lookup(spark, sf_dir):
    txn = messy.store_named(Lake(spark, sf_dir).txn())
    rows = merchants.assign_by_code(txn, signals.reference_merchants(spark))
    return rows.select("transaction_id", "merchant_name", "matched_code", "assigned_category")


# ------------------------------------------------------------------ storage (S1-S12) and streaming

LEDGER_SOURCE = "lineitem+orders+part+supplier"
EVENT_SOURCE = "events"


@query("bronze_roundtrip")
def q_bronze_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "bronze")
    landing.land(Layers(spark, sf_dir).tables.raw_ledger(), path, "b1", LEDGER_SOURCE)
    back = landing.read_bronze(spark, path)
    return back.select(*contracts.LEDGER_COLUMNS, "_source_file", "_batch_id")


@query("batch_replay")
def q_batch_replay(spark, sf_dir):
    """b1 is landed, then corrected by a replay; b2 is landed and emptied by a replay; b10 stays."""
    raw = Lake(spark, sf_dir).txn().select(*contracts.LEDGER_COLUMNS)
    path = scratch_path(spark, "bronze")
    landing.land(raw, path, "b1", LEDGER_SOURCE)
    landing.land(raw, path, "b2", LEDGER_SOURCE)
    landing.land(Layers(spark, sf_dir).tables.raw_event_ledger(), path, "b10", EVENT_SOURCE)
    landing.land(raw.withColumn("amount", (F.col("amount") + 1).cast(contracts.MONEY)), path, "b1", LEDGER_SOURCE)
    landing.land(raw.limit(0), path, "b2", LEDGER_SOURCE)
    return landing.read_bronze(spark, path).select("transaction_id", "customer_id", "amount", "_batch_id")


@query("as_of_batch")
def q_as_of_batch(spark, sf_dir):
    """Landed in the order 007, b10, b2: as of b10 the first two are there, whatever their ids' order."""
    raw = Lake(spark, sf_dir).txn().select(*contracts.LEDGER_COLUMNS)
    path = scratch_path(spark, "bronze")
    landing.land(raw, path, "007", LEDGER_SOURCE)
    landing.land(Layers(spark, sf_dir).tables.raw_event_ledger(), path, "b10", EVENT_SOURCE)
    landing.land(raw, path, "b2", LEDGER_SOURCE)
    return landing.as_of(spark, path, "b10").select("transaction_id", "customer_id", "amount", "_batch_id")


@query("as_of_after_replay")
def q_as_of_after_replay(spark, sf_dir):
    """b1 and b2 are landed, then b1 is corrected and b2 emptied by replays: as of the first b2 all is as it was then."""
    raw = Lake(spark, sf_dir).txn().select(*contracts.LEDGER_COLUMNS)
    path = scratch_path(spark, "bronze")
    landing.land(raw, path, "b1", LEDGER_SOURCE)
    landing.land(Layers(spark, sf_dir).tables.raw_event_ledger(), path, "b2", EVENT_SOURCE)
    then = landing.versions(spark, path)[-1][1]
    landing.land(raw.withColumn("amount", (F.col("amount") + 1).cast(contracts.MONEY)), path, "b1", LEDGER_SOURCE)
    landing.land(raw.limit(0), path, "b2", EVENT_SOURCE)
    return landing.as_of(spark, path, version=then).select("transaction_id", "customer_id", "amount", "_batch_id")


#: (application, input state) -> the tables that the upsert queries read.
_UPSERTED: dict[tuple, pipeline.Layout] = {}


def _upserted(spark, sf_dir) -> pipeline.Layout:
    """Silver of one batch with faults, then brought up to date with a late one, which is replayed with other rows."""
    state = Lake(spark, sf_dir).state
    if state in _UPSERTED:
        return _UPSERTED[state]
    driver, layout = DriverTables(spark, sf_dir), pipeline.Layout(scratch_path(spark, "lake"))
    ledger = tables.passes(messy.messy_ledger(driver), "transaction_id", files.size(spark, f"{driver.sf_dir}/lineitem.parquet"))
    pipeline.land_raw(ledger, layout, "transactions", "b1", LEDGER_SOURCE)
    pipeline.land_raw(driver.raw_customers(), layout, "customers", "b1", "customer")
    pipeline.build_silver(spark, layout)
    for every in (5, 10):
        pipeline.land_raw(messy.late_copies(driver, every), layout, "transactions", "b2", LEDGER_SOURCE)
        upsert.upsert_silver(spark, layout, "b2")
    _UPSERTED[state] = layout
    return layout


@query("silver_upsert")
def q_silver_upsert(spark, sf_dir):
    silver = tables.read_table(spark, _upserted(spark, sf_dir).path("silver", "transactions"))
    return silver.drop("_silver_processed_at", "_ingested_at", "_source_file", "_batch_id")


@query("quarantine_upsert")
def q_quarantine_upsert(spark, sf_dir):
    rows = tables.read_table(spark, _upserted(spark, sf_dir).path("silver", pipeline.QUARANTINE))
    return rows.select("transaction_id", "amount", "transaction_date", "reason")


CLUSTERED_DAYS = ("1995-03-15", "1997-07-01")
PRUNED_PERIOD = tables.last_months((1998, 12), 3)


@query("pruned_read")
def q_pruned_read(spark, sf_dir):
    path = Lake(spark, sf_dir).silver_transactions_path()
    start, end = PRUNED_PERIOD
    back = tables.read_period(spark, path, start, end)
    return back.select("transaction_id", "customer_id", "amount", "txn_year", "txn_month", "txn_day")


@query("contract_evolution")
def q_contract_evolution(spark, sf_dir):
    """Two batches as one table: the first without channel and in narrower types, the second with a column more."""
    raw = Layers(spark, sf_dir).tables.raw_ledger().withColumn("customer_id", F.col("customer_id").cast("long"))
    number = F.split("transaction_id", "-")[0].cast("long")
    path = scratch_path(spark, "bronze")
    first = raw.filter(number % 2 == 0).drop("channel").withColumns(
        {"customer_id": F.col("customer_id").cast("int"), "amount": F.col("amount").cast("decimal(18,2)")})
    second = raw.filter(number % 2 == 1).withColumns({"amount": F.col("amount").cast("decimal(22,4)"), "store": number % 7})
    contract = evolution.land_evolving(first, path, "b1", first.schema, LEDGER_SOURCE)
    contract = evolution.land_evolving(second, path, "b2", contract, LEDGER_SOURCE)
    return evolution.read_evolved(spark, path, contract).select(
        "transaction_id", "customer_id", "amount", "channel", "store", "_batch_id")


@query("rescued_fields")
def q_rescued_fields(spark, sf_dir):
    """A CSV with a column that the contract doesn't know and amounts that it can't type."""
    raw, path = Layers(spark, sf_dir).tables.raw_ledger(), scratch_path(spark, "csv")
    number = F.split("transaction_id", "-")[0].cast("long")
    text = raw.select("transaction_id", F.when(number % 5 == 0, "n/a").otherwise(F.col("amount").cast("string")).alias("amount"),
                      F.when(number % 3 == 0, (number % 7).cast("string")).alias("store"))
    tables.export_csv(text, path)
    contract = StructType.fromDDL("transaction_id string, amount decimal(22,4), channel string")
    rows = evolution.read_csv_rescued(spark, path, contract)
    return rows.select("transaction_id", "amount", "channel", F.element_at(evolution.RESCUED, "amount").alias("amount_text"),
                       F.element_at(evolution.RESCUED, "store").alias("store"))


@query("clustered_read")
def q_clustered_read(spark, sf_dir):
    """Silver in Z-order of customer and day: all of two customers and all of two days are read back from it."""
    txn = Lake(spark, sf_dir).txn().withColumn("day", F.to_date("transaction_date"))
    path = scratch_path(spark, "clustered")
    zorder.write_clustered(txn, path, ["customer_id", "day"])
    back = tables.read_table(spark, path)
    customers = back.filter(F.col("customer_id").isin(1, 100)).withColumn("asked", F.lit("customer"))
    days = back.filter(F.col("day").isin(*[F.to_date(F.lit(d)) for d in CLUSTERED_DAYS])).withColumn("asked", F.lit("day"))
    return customers.unionByName(days).select("asked", "transaction_id", "customer_id", "amount")


@query("landing_counts")
def q_landing_counts(spark, sf_dir):
    """The rows that each landing observed while it wrote, beside those that are there."""
    driver, path = DriverTables(spark, sf_dir), scratch_path(spark, "bronze")
    feeds = {"b1": driver.raw_ledger(), "b2": driver.raw_event_ledger(), "b3": driver.raw_event_ledger().limit(0)}
    seen = {batch: landing.land(rows, path, batch, "driver") for batch, rows in feeds.items()}
    counted = landing.read_bronze(spark, path).groupBy("_batch_id").agg(F.count(F.lit(1)).alias("counted"))
    observed = spark.createDataFrame(list(seen.items()), "_batch_id string, observed long")
    return observed.join(counted, "_batch_id", "left").select("_batch_id", "observed", F.coalesce("counted", F.lit(0)).alias("counted"))


@query("layer_report")
def q_layer_report(spark, sf_dir):
    """Every layer's rows and contract columns, after its contract has been checked."""
    lake = Lake(spark, sf_dir)
    layers = {"silver_transactions": (lake.txn(), contracts.SILVER_TXN), "silver_customers": (lake.customers(), ["customer_id", "segment"]),
              "gold_monthly": (lake.monthly_summary(), contracts.MONTHLY_SUMMARY)}
    rows = [(name, tables.verify_layer(df, contract, name)["rows"], len(contract)) for name, (df, contract) in layers.items()]
    return spark.createDataFrame(rows, "layer string, rows long, contract_columns int")


@query("csv_roundtrip")
def q_csv_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "csv")
    tables.export_csv(Layers(spark, sf_dir).tables.raw_ledger(), path)
    schema = StructType([f for f in contracts.RAW_TRANSACTIONS.fields if f.name in contracts.LEDGER_COLUMNS])
    good, _bad = landing.quarantine_corrupt(landing.read_csv(spark, path, schema))
    return good.select(*[c for c in contracts.LEDGER_COLUMNS if c != "amount"],
                       F.col("amount").cast(contracts.MONEY).alias("amount"))


@query("stream_landing")
def q_stream_landing(spark, sf_dir):
    """Two feeds, each with its own checkpoint, into one table; the first is run again without new files."""
    layers, bronze = Layers(spark, sf_dir), scratch_path(spark, "bronze")
    feeds = [(layers.tables.raw_ledger(), scratch_path(spark, "feed-a"), scratch_path(spark, "stream-a")),
             (layers.tables.raw_event_ledger(), scratch_path(spark, "feed-b"), scratch_path(spark, "stream-b"))]
    for rows, files, checkpoint in [*feeds, (None, *feeds[0][1:])]:
        if rows is not None:
            rows.withColumn("customer_id", F.col("customer_id").cast("long")).write.parquet(files)
        land_stream(spark, files, spark.read.parquet(files).schema, bronze, checkpoint, max_files_per_trigger=4)
    return landing.read_bronze(spark, bronze).select(*contracts.LEDGER_COLUMNS)


#: Fixed values of the stand-in feed: the events' time line is cut here, and these ids of its first part come last.
FEED_CUT, LATE_IDS = "2024-01-16", (50, 7)


@query("stream_dedup")
def q_stream_dedup(spark, sf_dir):
    """Three files of events, one per micro-batch: the first part of the time line; the second, with every tenth
    row of the first again; and late rows of the first, with every seventh row of the second again."""
    events = DriverTables(spark, sf_dir).raw_event_ledger().withColumn("customer_id", F.col("customer_id").cast("long"))
    number, early = F.col("transaction_id").cast("long"), F.col("transaction_date") < F.lit(FEED_CUT).cast("timestamp_ntz")
    late = early & (number % LATE_IDS[0] == LATE_IDS[1])
    first, second = events.filter(early & ~late), events.filter(~early)
    feed, accepted, refused = (scratch_path(spark, n) for n in ("feed", "accepted", "refused"))
    checkpoint = scratch_path(spark, "stream")
    for rows in (first, second.unionByName(first.filter(number % 10 == 0)), events.filter(late).unionByName(second.filter(number % 7 == 0))):
        rows.coalesce(1).write.mode("append").parquet(feed)
        dedup_stream(spark, feed, rows.schema, accepted, refused, checkpoint, delay="1 day", max_files_per_trigger=1)
    columns = ["transaction_id", "customer_id", "transaction_date", "amount"]
    return landing.read_bronze(spark, accepted).select(*columns, F.lit("accepted").alias("outcome")).unionByName(
        landing.read_bronze(spark, refused).select(*columns, F.col("reason").alias("outcome")))
