"""Ingest, replay, incremental loads and streams. Those that need stored input write it to the shared checkpoint folder first."""

from __future__ import annotations

from functools import reduce

from lakeops.contracts import FEEDS, REGIONS, TABLES, Feed
from lakeops.functions.ids import region_of
from lakeops.operators import checks, conform, dedupe, incremental, views
from lakeops.plans import curate
from lakeops.sources import feeds, replay, tables, testdata
from lakeops.streaming import drain, windows
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from verification.registry import Tables, query, register

RUN_TS = "2025-01-01 06:00:00"


def _raw_name(feed: Feed) -> str:
    return feed.table.split(".")[1]


def _ingest(t: Tables, feed: Feed) -> DataFrame:
    bodies = feeds.to_bodies(testdata.spread(t.raw(_raw_name(feed))), feed)
    return conform.valid_events(conform.decode(bodies, feed), feed)


def _replay(t: Tables, feed: Feed) -> DataFrame:
    """Write the payload columns as CSV, replay it, and keep what the replay does not make up."""
    payload = [c for c in feed.columns if c.name not in ("event_id", "event_ts", "event_type")]
    text = [F.col(c.name).cast("string").alias(c.source) for c in payload]
    path = f"{t.scratch}/csv"
    testdata.spread(t.raw(_raw_name(feed))).select(*text).write.option("header", True).csv(path)
    bodies = replay.replay_csv(t.spark, path, feed, RUN_TS)
    valid = conform.valid_events(conform.decode(bodies, feed), feed)
    return valid.select("event_ts", "event_type", *[c.name for c in payload], "event_date")


for _feed in FEEDS.values():
    _names = ", ".join([c.name for c in _feed.columns] + ["event_date"])
    register(f"ingest_{_feed.name}", f"SELECT {_names} FROM {_raw_name(_feed)}", lambda t, f=_feed: _ingest(t, f))
    _payload = ", ".join(c.name for c in _feed.columns[3:])
    _day = f"DATE '{RUN_TS[:10]}'" if _feed.date_field == "event_ts" else f"CAST({_feed.date_field} AS DATE)"
    register(
        f"replay_csv_{_feed.name}",
        f"SELECT TIMESTAMP '{RUN_TS}' AS event_ts, '{_feed.event_type}' AS event_type, {_payload}, {_day} AS event_date "
        f"FROM {_raw_name(_feed)}",
        lambda t, f=_feed: _replay(t, f),
    )


# Regional queues: each region's orders are a feed of their own and land in one raw table.
@query(
    "ingest_orders_of_all_regions",
    "SELECT event_id, event_ts, event_type, order_id, product_id, warehouse_id, order_ts, qty, event_date FROM raw_orders",
)
def ingest_orders_of_all_regions(t: Tables) -> DataFrame:
    feed, orders = FEEDS["orders"], t.raw("raw_orders")
    region = region_of(F.col("warehouse_id"))
    queues = [feeds.to_bodies(orders.where(region == name), feed) for name in REGIONS]
    return reduce(DataFrame.unionByName, [conform.valid_events(conform.decode(q, feed), feed) for q in queues])


# Defects: every event becomes an order-error body in one of fifteen good or bad forms, by its type and value.
_FORM = (
    "(CASE event_type WHEN 'view' THEN 0 WHEN 'click' THEN 3 WHEN 'signup' THEN 6 WHEN 'purchase' THEN 9 ELSE 12 END "
    "+ CASE WHEN value < 15 THEN 0 WHEN value < 40 THEN 1 ELSE 2 END)"
)
_HEAD = "'{\"event_id\":\"', event_id, '\",\"event_type\":\"order_error\",\"error_id\":\"x\",\"event_ts\":\"2024-02-03T04:05:06\"'"
_FORMS = (
    ',"order_id":"a","error_code":"U","detected_ts":"2024-02-03T04:05:06.5"}',  # 0 valid
    None,  # 1 not JSON
    None,  # 2 an array
    ',"error_code":"U","detected_ts":"2024-02-03T04:05:06"}',  # 3 no order_id
    ',"order_id":"a","error_code":null,"detected_ts":"2024-02-03T04:05:06"}',  # 4 null
    ',"order_id":7,"error_code":"U","detected_ts":"2024-02-03T04:05:06"}',  # 5 number for text
    ',"order_id":"a","error_code":"U","detected_ts":"2024-02-03T04:05:06+05:30"}',  # 6 valid, with an offset
    ',"order_id":"a","error_code":"U","detected_ts":"yesterday"}',  # 7 no time
    ',"order_id":"","error_code":"U","detected_ts":"2024-02-03","more":{"x":[1]}}',  # 8 valid, empty text, date, extra field
    ',"order_id":"a","error_code":"U","detected_ts":1706933106}',  # 9 valid, epoch seconds
    ',"order_id":"a","error_code":"U","error_ts":"2024-02-03T04:05:06"}',  # 10 column name for JSON name
    ',"order_id":"a","error_code":"U","detected_ts":"2024-02-03T04:05:06"} tail',  # 11 text after the object
    ',"order_id":"a","error_code":"U","detected_ts":"2024-02-30T00:00:00"}',  # 12 no such day
    ',"order_id":"a","error_code":"U","detected_ts":"2024-02-03T04:05:06Z"}',  # 13 valid, UTC
    ',"order_id":true,"error_code":5,"detected_ts":null}',  # 14 all wrong
)
_OTHER_BODIES = {1: "concat('not json ', event_id)", 2: f"concat('[', {_HEAD}, '}}]')"}
_BODY = (
    "CASE form "
    + " ".join(f"WHEN {i} THEN {_OTHER_BODIES.get(i) or f'concat({_HEAD}, {chr(39)}{form}{chr(39)})'}" for i, form in enumerate(_FORMS))
    + " END"
)
_DEFECTS = (
    f"SELECT event_id, form, {_BODY} AS body FROM (SELECT CAST(event_id AS STRING) AS event_id, {_FORM} AS form FROM events) e"
)


def _defect_bodies(t: Tables) -> DataFrame:
    events = testdata.source_table(t.spark, t.sf_dir, "events")
    forms = events.select(F.col("event_id").cast("string").alias("event_id"), F.expr(_FORM).alias("form"))
    return forms.select(F.expr(_BODY).alias("body"))


@query(
    "ingest_defects_valid",
    f"WITH bodies AS ({_DEFECTS}) SELECT event_id, TIMESTAMP '2024-02-03 04:05:06' AS event_ts, "
    "'order_error' AS event_type, 'x' AS error_id, CASE WHEN form = 8 THEN '' ELSE 'a' END AS order_id, 'U' AS error_code, "
    "CASE form WHEN 0 THEN TIMESTAMP '2024-02-03 04:05:06.5' WHEN 6 THEN TIMESTAMP '2024-02-02 22:35:06' "
    "WHEN 8 THEN TIMESTAMP '2024-02-03 00:00:00' ELSE TIMESTAMP '2024-02-03 04:05:06' END AS error_ts, "
    "CASE form WHEN 6 THEN DATE '2024-02-02' ELSE DATE '2024-02-03' END AS event_date FROM bodies WHERE form IN (0, 6, 8, 9, 13)",
)
def ingest_defects_valid(t: Tables) -> DataFrame:
    return conform.valid_events(conform.decode(_defect_bodies(t), FEEDS["errors"]), FEEDS["errors"])


@query(
    "ingest_defects_quarantine",
    f"WITH bodies AS ({_DEFECTS}) SELECT body, CASE WHEN form IN (1, 2, 11) THEN 'not a JSON object' "
    "WHEN form IN (3, 5) THEN 'missing or invalid: order_id' WHEN form = 4 THEN 'missing or invalid: error_code' "
    "WHEN form = 14 THEN 'missing or invalid: order_id,error_code,detected_ts' "
    "ELSE 'missing or invalid: detected_ts' END AS reason FROM bodies WHERE form NOT IN (0, 6, 8, 9, 13)",
)
def ingest_defects_quarantine(t: Tables) -> DataFrame:
    return conform.rejected_events(conform.decode(_defect_bodies(t), FEEDS["errors"]), FEEDS["errors"])


# Integer forms: each event's number as an integer, a float, texts, a boolean and values that are no integers, by its type.
_NUMBER = (
    "CASE event_type WHEN 'view' THEN CASE WHEN value < 20 THEN id ELSE concat(id, '.0') END "
    "WHEN 'click' THEN CASE WHEN value < 20 THEN concat('\"', id, '\"') ELSE concat('\" +', id, '.00 \"') END "
    "WHEN 'signup' THEN 'true' WHEN 'purchase' THEN concat(id, '.5') ELSE concat('\"', id, 'e1\"') END"
)
_NUMBER_BODY = (
    "concat('{\"event_id\":\"i\",\"event_ts\":\"2024-01-02 03:04:05\",\"event_type\":\"inventory_movement\",\"movement_id\":\"', "
    f"id, '\",\"product_id\":\"p\",\"source_type\":\"SALE\",\"delta_qty\":', {_NUMBER}, '}}')"
)


@query(
    "ingest_number_forms",
    "SELECT CAST(event_id AS VARCHAR) AS movement_id, CASE WHEN event_type = 'signup' THEN 1 ELSE event_id END AS delta_qty "
    "FROM events WHERE event_type IN ('view', 'click', 'signup')",
)
def ingest_number_forms(t: Tables) -> DataFrame:
    events = testdata.source_table(t.spark, t.sf_dir, "events")
    named = events.select(F.col("event_id").cast("string").alias("id"), "event_type", "value")
    feed = FEEDS["inventory"]
    decoded = conform.decode(named.select(F.expr(_NUMBER_BODY).alias("body")), feed)
    return conform.valid_events(decoded, feed).select("movement_id", "delta_qty")


# Incremental curation: the raw table arrives in two deliveries and the fact is curated after each.
_ROUTES = "logistics_core.raw_route_updates"
_FIRST = "source_type IN ('view', 'click', 'signup')"
_ROUTE_EVENTS = (
    "WITH typed AS (SELECT f.*, e.event_type AS source_type FROM fact_vehicle_routes f JOIN events e "
    "ON f.event_id = concat('u-', CAST(e.event_id AS VARCHAR))), "
    f"top AS (SELECT MAX(updated_ts) AS mark FROM typed WHERE {_FIRST}) "
)
_ROUTE_COLUMNS = "event_id, event_ts, typed.event_type, route_id, status, updated_ts, event_date"


def _curate_twice(t: Tables, mode: str, lookback_hours: int, name: str = "fact_vehicle_routes") -> DataFrame:
    """Deliver views, clicks and signups, curate, deliver purchases and errors (as late as they are), curate again."""
    events = testdata.source_table(t.spark, t.sf_dir, "events")
    early = F.col("event_type").isin("view", "click", "signup")
    warehouse = f"{t.scratch}/warehouse"
    for delivery in (early, ~early):
        tables.append(testdata.project(events.where(delivery), "raw_route_updates"), warehouse, _ROUTES)
        curate.run(t.spark, warehouse, name, mode=mode, lookback_hours=lookback_hours)
    return tables.scan(t.spark, warehouse, curate.JOBS[name].target)


@query(
    "incremental_strict",
    _ROUTE_EVENTS + f"SELECT {_ROUTE_COLUMNS} FROM typed, top WHERE {_FIRST} OR updated_ts > mark",
)
def incremental_strict(t: Tables) -> DataFrame:
    return _curate_twice(t, "strict", 0)


@query(
    "incremental_lookback",
    _ROUTE_EVENTS
    + f"SELECT {_ROUTE_COLUMNS} FROM typed WHERE {_FIRST} UNION ALL "
    + f"SELECT {_ROUTE_COLUMNS} FROM typed, top WHERE updated_ts > mark - INTERVAL '48' HOUR",
)
def incremental_lookback(t: Tables) -> DataFrame:
    """A look-back in strict mode repeats the rows it reads again."""
    return _curate_twice(t, "strict", 48)


@query(
    "incremental_idempotent",
    _ROUTE_EVENTS + f"SELECT {_ROUTE_COLUMNS} FROM typed, top WHERE {_FIRST} OR updated_ts > mark - INTERVAL '48' HOUR",
)
def incremental_idempotent(t: Tables) -> DataFrame:
    return _curate_twice(t, "idempotent", 48)


@query("incremental_idempotent_whole", "SELECT * FROM fact_vehicle_routes")
def incremental_idempotent_whole(t: Tables) -> DataFrame:
    """A look-back over the whole month recovers every late row, once."""
    return _curate_twice(t, "idempotent", 24 * 40)


@query(
    "incremental_dimension",
    _ROUTE_EVENTS
    + ", days AS (SELECT MAX(event_date) AS mark_day FROM typed WHERE "
    + _FIRST
    + "), seen AS (SELECT DISTINCT route_id, event_date FROM typed WHERE "
    + _FIRST
    + " UNION ALL SELECT DISTINCT route_id, event_date FROM typed, days WHERE event_date > mark_day) "
    "SELECT route_id, CAST(NULL AS VARCHAR) AS region_covered, CAST(NULL AS INTEGER) AS avg_duration, event_date FROM seen",
)
def incremental_dimension(t: Tables) -> DataFrame:
    """Dimension marks are dates: the rest of the mark's own day is not read again."""
    return _curate_twice(t, "strict", 0, "dim_route")


@query("incremental_dimension_idempotent", "SELECT * FROM dim_route")
def incremental_dimension_idempotent(t: Tables) -> DataFrame:
    """A table without a key takes in late rows once, however often it runs."""
    _curate_twice(t, "idempotent", 24 * 40, "dim_route")
    curate.run(t.spark, f"{t.scratch}/warehouse", "dim_route", lookback_hours=24 * 40)
    return tables.scan(t.spark, f"{t.scratch}/warehouse", "dimensions.dim_route")


@query("curate_retry_same_load", "SELECT * FROM fact_vehicle_routes")
def curate_retry_same_load(t: Tables) -> DataFrame:
    """A retry under the same load id replaces the load and keeps its rows."""
    warehouse = f"{t.scratch}/warehouse"
    routes = t.raw("raw_route_updates")
    second = F.xxhash64("event_id") % 2 == 0
    for delivery in (routes.where(~second), routes.where(second)):
        tables.append(delivery, warehouse, _ROUTES)
        curate.run(t.spark, warehouse, "fact_vehicle_routes", load_id="nightly")
    return tables.scan(t.spark, warehouse, "logistics_core.fact_vehicle_routes")


# Stored tables behind views: dashboard SQL and checks by name.
def _store_routes(t: Tables) -> str:
    warehouse = f"{t.scratch}/warehouse"
    tables.append(t.raw("raw_route_updates"), warehouse, _ROUTES)
    for name in ("fact_vehicle_routes", "dim_route"):
        curate.run(t.spark, warehouse, name, lookback_hours=0)
    return warehouse


@query("stored_route_updates", "SELECT * FROM raw_route_updates")
def stored_route_updates(t: Tables) -> DataFrame:
    tables.append(t.raw("raw_route_updates"), f"{t.scratch}/warehouse", _ROUTES)
    return tables.scan(t.spark, f"{t.scratch}/warehouse", _ROUTES)


@query(
    "sql_on_views",
    "SELECT f.status, COUNT(*) AS updates, COUNT(DISTINCT d.route_id) AS routes, MIN(f.event_date) AS first_day "
    "FROM fact_vehicle_routes f JOIN dim_route d ON f.route_id = d.route_id AND f.event_date = d.event_date GROUP BY f.status",
)
def sql_on_views(t: Tables) -> DataFrame:
    warehouse = _store_routes(t)
    views.register_views(t.spark, warehouse, ("logistics_core.fact_vehicle_routes", "dimensions.dim_route"))
    return t.spark.sql(
        "SELECT f.status, COUNT(*) AS updates, COUNT(DISTINCT d.route_id) AS routes, MIN(f.event_date) AS first_day "
        "FROM logistics_core.fact_vehicle_routes f JOIN dimensions.dim_route d "
        "ON f.route_id = d.route_id AND f.event_date = d.event_date GROUP BY f.status"
    )


@query(
    "stored_table_checks",
    "SELECT 'logistics_core.fact_vehicle_routes' AS table_name, TRUE AS table_exists, COUNT(*) AS row_count, 'ok' AS status, "
    "concat('count=', CAST(COUNT(*) AS VARCHAR)) AS message FROM fact_vehicle_routes UNION ALL "
    "SELECT 'dimensions.dim_route', TRUE, COUNT(*), 'ok', concat('count=', CAST(COUNT(*) AS VARCHAR)) FROM dim_route UNION ALL "
    "SELECT 'dimensions.dim_vehicle', FALSE, NULL, 'skipped', 'table not found'",
)
def stored_table_checks(t: Tables) -> DataFrame:
    """Two stored tables and one that does not exist."""
    names = ("logistics_core.fact_vehicle_routes", "dimensions.dim_route", "dimensions.dim_vehicle")
    return checks.check_tables(t.spark, _store_routes(t), names)


_STORED = ("logistics_core.fact_vehicle_routes", "dimensions.dim_route")


@query(
    "stored_high_water_marks",
    " UNION ALL ".join(f"SELECT '{n}' AS table_name, CAST(MAX({TABLES[n].mark}) AS TIMESTAMP) AS mark FROM {n.split('.')[1]}" for n in _STORED),
)
def stored_high_water_marks(t: Tables) -> DataFrame:
    """The marks of two stored tables, a timestamp and a date, as the incremental jobs read them."""
    warehouse, rows = _store_routes(t), []
    for name in _STORED:
        mark = incremental.high_water_mark(t.spark, warehouse, name)
        value = F.lit(mark.value).cast(mark.kind) if mark else F.lit(None)
        rows.append(t.spark.range(1).select(F.lit(name).alias("table_name"), value.cast("timestamp_ntz").alias("mark")))
    return reduce(DataFrame.unionByName, rows)


@query(
    "sql_on_stored_derived_view",
    "SELECT COUNT(*) AS days, CAST(SUM(updates) AS BIGINT) AS updates, MAX(updates) AS most FROM "
    "(SELECT event_date, COUNT(*) AS updates FROM fact_vehicle_routes GROUP BY event_date) d",
)
def sql_on_stored_derived_view(t: Tables) -> DataFrame:
    """A view of a query over another view, both kept in the catalog."""
    views.register_views(t.spark, _store_routes(t), _STORED[:1])
    per_day = "SELECT event_date, COUNT(*) AS updates FROM logistics_core.fact_vehicle_routes GROUP BY event_date"
    views.register_derived_view(t.spark, "/".join([t.scratch, "warehouse"]), "logistics_core.updates_per_day", per_day)
    return t.spark.sql("SELECT COUNT(*) AS days, SUM(updates) AS updates, MAX(updates) AS most FROM logistics_core.updates_per_day")


@query(
    "view_checks",
    " UNION ALL ".join(
        f"SELECT '{n}' AS table_name, TRUE AS table_exists, COUNT(*) AS row_count, CASE WHEN COUNT(*) > 0 THEN 'ok' ELSE 'bad' END AS status, "
        f"concat('count=', CAST(COUNT(*) AS VARCHAR)) AS message FROM {n.split('.')[1]}"
        for n in _STORED
    )
    + " UNION ALL SELECT 'dimensions.dim_vehicle', FALSE, NULL, 'skipped', 'table not found'",
)
def view_checks(t: Tables) -> DataFrame:
    """Two registered views and one that does not exist."""
    views.register_views(t.spark, _store_routes(t), _STORED)
    t.spark.sql("DROP VIEW IF EXISTS dimensions.dim_vehicle")
    return checks.check_views(t.spark, (*_STORED, "dimensions.dim_vehicle"))


@query(
    "one_row_per_event",
    "SELECT * EXCLUDE (pick) FROM (SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY event_ts, event_type, movement_id, "
    "product_id, delta_qty, source_type, event_date) AS pick FROM raw_inventory_movements) WHERE pick = 1",
)
def one_row_per_event(t: Tables) -> DataFrame:
    return dedupe.one_row_per(t.raw("raw_inventory_movements"), "event_id")


@query(
    "not_yet_stored",
    "SELECT * FROM raw_inventory_movements r WHERE source_type <> 'SALE' AND NOT EXISTS "
    "(SELECT 1 FROM raw_inventory_movements s WHERE s.source_type = 'SALE' AND s.event_id = r.event_id)",
)
def not_yet_stored(t: Tables) -> DataFrame:
    rows = t.raw("raw_inventory_movements")
    sale = F.col("source_type") == "SALE"
    return dedupe.not_stored(rows.where(~sale), rows.where(sale), "event_id")


# Streams. Regional landing folders hold JSON lines; the region is the reporting user's.
def _land_errors(t: Tables, feed: Feed) -> str:
    region = F.element_at(F.array(*[F.lit(r) for r in REGIONS]), (F.col("order_id").cast("int") % 4 + 1).cast("int"))
    bodies = feeds.to_bodies(t.raw("raw_order_errors").withColumn("region", region), feed, keep=("region",))
    landing = f"{t.scratch}/landing"
    bodies.write.partitionBy("region").text(landing)
    return landing


def _drain_errors(t: Tables, times: int, unique: bool = False) -> DataFrame:
    feed = FEEDS["errors"]
    landing, warehouse = _land_errors(t, feed), f"{t.scratch}/warehouse"

    def source(queue: str) -> DataFrame:
        return feeds.stream_json_lines(t.spark, f"{landing}/region={queue.rsplit('_', 1)[1]}")

    for n in range(times):
        # A new checkpoint reads everything again; the same one finds nothing new.
        checkpoint = f"{t.scratch}/checkpoint-{n if unique else 0}"
        if unique and n:
            # a second pass stands for a re-delivery under new batch names
            drain_again(t, feed, source, warehouse, checkpoint)
        else:
            drain.drain(t.spark, feed, source, warehouse, checkpoint, unique=unique)
    return tables.scan(t.spark, warehouse, feed.table)


def drain_again(t: Tables, feed: Feed, source, warehouse: str, checkpoint: str) -> None:
    for queue in feed.queues:
        started = drain.start_drain(source(queue), feed, f"{queue}-redelivered", warehouse, f"{checkpoint}/{queue}", unique=True)
        started.awaitTermination()


_ERRORS = "SELECT event_id, event_ts, event_type, error_id, order_id, error_code, error_ts, event_date FROM raw_order_errors"


@query("drain_order_errors", _ERRORS)
def drain_order_errors(t: Tables) -> DataFrame:
    return _drain_errors(t, 1)


@query("drain_order_errors_twice", _ERRORS)
def drain_order_errors_twice(t: Tables) -> DataFrame:
    """The second drain finds nothing pending."""
    return _drain_errors(t, 2)


@query("drain_order_errors_redelivered", _ERRORS)
def drain_order_errors_redelivered(t: Tables) -> DataFrame:
    """Everything is delivered a second time; the ids are known, so nothing is added."""
    return _drain_errors(t, 2, unique=True)


def _run_to_parquet(t: Tables, stream: DataFrame) -> DataFrame:
    out = f"{t.scratch}/out"
    started = (
        stream.writeStream.format("parquet")
        .option("checkpointLocation", f"{t.scratch}/checkpoint")
        .trigger(availableNow=True)
        .outputMode("append")
        .start(out)
    )
    started.awaitTermination()
    return t.spark.read.schema(stream.schema).parquet(out)


def _stream(t: Tables, raw: str) -> DataFrame:
    source = testdata.source_table(t.spark, t.sf_dir, testdata.RAW[raw].source)
    path = f"{t.sf_dir}/{testdata.RAW[raw].source}.parque[t]"  # a pattern may match one file or a folder of files
    return testdata.project(t.spark.readStream.schema(source.schema).parquet(path), raw)


@query("stream_unique_movements", "SELECT DISTINCT event_id FROM raw_inventory_movements")
def stream_unique_movements(t: Tables) -> DataFrame:
    """The copies of an id lie years apart here, hence the delay."""
    movements = _stream(t, "raw_inventory_movements").select("event_id", "event_ts")
    return _run_to_parquet(t, windows.drop_duplicates(movements, "event_id", "event_ts", "3650 days")).select("event_id")


@query(
    "stream_daily_inventory",
    "SELECT event_date, COUNT(*) AS movements, CAST(SUM(delta_qty) AS BIGINT) AS total_delta_qty FROM raw_inventory_movements "
    "GROUP BY event_date "
    "HAVING event_date + INTERVAL '1' DAY <= (SELECT MAX(event_ts) - INTERVAL '3' DAY FROM raw_inventory_movements)",
)
def stream_daily_inventory(t: Tables) -> DataFrame:
    """Days whose end the watermark (newest event minus three days) has passed."""
    totals = {"movements": F.count("*"), "total_delta_qty": F.sum("delta_qty")}
    return _run_to_parquet(t, windows.daily_totals(_stream(t, "raw_inventory_movements"), "event_ts", "3 days", totals))
