"""Named queries: each runs one operator over the whole given tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from opinara.functions import parse_instant, register_sql_functions, strip_prefix
from opinara.operators import alerts, dashboards, quality, serving, sketches, stats, tables, windows
from opinara.plans import fixtures as fx
from opinara.schemas import REVIEW, RUN_SUMMARY, SLIDING_AGG, WINDOW_AGG
from opinara.session import durable, shared_dir
from opinara.sources import codec, messages, texts, writers
from opinara.streaming import jobs, timers

Query = Callable[[SparkSession, str], DataFrame]
CATALOG: dict[str, Query] = {}

DAY, HOUR = fx.DAY, fx.HOUR
RULE_COLUMNS = {"rating": "rating_f", "text": "text", "likes": "likes"}


def plain(df: DataFrame) -> DataFrame:
    """Timestamps without zone, as the given tables have them."""
    return df.select(*[F.col(f.name).cast("timestamp_ntz").alias(f.name)
                       if isinstance(f.dataType, T.TimestampType) else F.col(f.name)
                       for f in df.schema.fields])


def query(build: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return plain(build(spark, sf_dir))
    CATALOG[build.__name__] = run
    return run


# --- windows ----------------------------------------------------------------

@query
def tumbling_final(spark, sf):
    return fx.windows(spark, sf)


@query
def sliding_agg(spark, sf):
    return fx.slides(spark, sf)


@query
def sliding_fine(spark, sf):
    """Windows of a day, a new one every 80 seconds (1,080 overlap at any time), summed up per product and day of their start."""
    fine = windows.sliding(fx.reviews(spark, sf), DAY, 80)
    hundredths = lambda c, n: F.sum(F.rint(F.col(c) * n).cast("long"))
    return (fine.groupBy("product_id", F.to_date("window_start").alias("day"))
            .agg(F.count("*").alias("n_windows"), F.sum("review_count").alias("reviews"), F.max("review_count").alias("busiest"),
                 hundredths("avg_rating", 100).alias("ratings"), hundredths("negative_share", 10000).alias("negative"),
                 F.max("max_review_date").alias("newest"), F.max("latency_sec").alias("slowest")))


@query
def late_classes(spark, sf):
    return (windows.classify_arrival(fx.reviews(spark, sf), fx.WIDTH_S, fx.LATENESS_S)
            .groupBy("arrival_class").agg(F.count("*").alias("n"), F.sum("rating").alias("rating_sum")))


@query
def tumbling_changelog(spark, sf):
    return windows.tumbling_changelog(fx.reviews(spark, sf), fx.WIDTH_S, fx.LATENESS_S)


@query
def tumbling_changelog_split(spark, sf):
    """The same changelog by the way that hot groups take."""
    return windows.tumbling_changelog(fx.reviews(spark, sf), fx.WIDTH_S, fx.LATENESS_S,
                                      max_group_rows=1, chunks=16)


# --- quality ----------------------------------------------------------------

@query
def validate_reviews(spark, sf):
    return quality.annotate_validity(fx.reviews_with_text(spark, sf), **RULE_COLUMNS).drop("text")


@query
def is_valid_flag(spark, sf):
    return fx.reviews_with_text(spark, sf).select("id", quality.validity_flag(**RULE_COLUMNS).alias("is_valid"))


@query
def validate_in_sql(spark, sf):
    reviews = fx.reviews_with_text(spark, sf)
    register_sql_functions(spark)
    return reviews.select("id", F.expr("review_valid(rating_f, text, likes)").alias("is_valid"),
                          F.expr("review_error(rating_f, text, likes)").alias("error_msg"))


@query
def clean_reviews(spark, sf):
    return quality.keep_valid(fx.reviews_with_text(spark, sf), **RULE_COLUMNS)


@query
def rejected_reviews(spark, sf):
    return quality.rejected(fx.reviews_with_text(spark, sf), **RULE_COLUMNS)


@query
def validation_summary(spark, sf):
    return quality.validation_summary(fx.reviews_with_text(spark, sf), **RULE_COLUMNS)


@query
def error_breakdown(spark, sf):
    return quality.error_breakdown(quality.annotate_validity(fx.reviews_with_text(spark, sf), **RULE_COLUMNS))


@query
def json_quarantine(spark, sf):
    decoded = codec.decode_json(fx.review_messages(spark, sf).drop("key"), REVIEW)
    return decoded.select("seq", F.col(codec.CORRUPT).isNotNull().alias("corrupt"), "id", "product_id",
                          "rating", "likes", "dislikes", "date", F.char_length("text").alias("text_chars"))


# --- statistics -------------------------------------------------------------

@query
def valid_ratings(spark, sf):
    return stats.valid_ratings(fx.reviews(spark, sf)).select("id", "product_id", "rating", "date")


@query
def fill_defaults(spark, sf):
    return stats.fill_defaults(fx.reviews_with_gaps(spark, sf)).select("id", "product_id", "rating")


@query
def review_stats(spark, sf):
    return stats.review_stats(fx.reviews(spark, sf))


@query
def rating_distribution(spark, sf):
    return stats.rating_distribution(fx.reviews(spark, sf))


@query
def top_products(spark, sf):
    return stats.top_products(fx.reviews(spark, sf))


@query
def last_reviews(spark, sf):
    return stats.last_reviews(fx.reviews(spark, sf))


@query
def throughput(spark, sf):
    return stats.throughput(fx.reviews(spark, sf), HOUR)


@query
def throughput_delta(spark, sf):
    return stats.throughput_delta(stats.throughput(fx.reviews(spark, sf), HOUR))


@query
def moving_rps(spark, sf):
    return stats.moving_rate(fx.reviews(spark, sf), span_s=5 * 600, step_s=600)


def _summary(reviews: DataFrame) -> DataFrame:
    return (stats.run_summary(stats.throughput(reviews, HOUR))
            .withColumn("avg_rps", F.round("avg_rps", 9)))


@query
def run_summary(spark, sf):
    return _summary(fx.reviews(spark, sf))


@query
def run_totals(spark, sf):
    return stats.run_totals(fx.reviews(spark, sf))


@query
def compare_runs(spark, sf):
    reviews = fx.reviews(spark, sf)
    names = ["duration_s", "total_reviews", "avg_rps", "peak_rps"]
    runs = [stats.as_metrics(_summary(serving.filter_prefix(reviews, source)), names)
            for source in ("WB-", "OZ-")]
    compared = stats.compare_runs(*runs)
    return compared.withColumns({c: F.round(c, 6) for c in ("change_pct", "ratio")})


@query
def parse_summaries(spark, sf):
    """Per product a log with a readable summary, a line without one and a broken one."""
    runs = (fx.reviews(spark, sf).groupBy("product_id")
            .agg(F.count("*").alias("total_reviews"),
                 ((F.unix_micros(F.max("arrival_ts")) - F.unix_micros(F.min("arrival_ts"))) / 1e6)
                 .alias("wall_clock_s"))
            .select("product_id", F.split_part("product_id", F.lit("-"), F.lit(1)).alias("language"),
                    "wall_clock_s", "total_reviews"))
    summary = F.to_json(F.struct("language", "wall_clock_s", "total_reviews"))
    lines = F.explode(F.array(
        F.struct(F.lit("good").alias("kind"), F.concat(F.lit("done\nSUMMARY_JSON: "), summary).alias("line")),
        F.struct(F.lit("none").alias("kind"), F.lit("still collecting").alias("line")),
        F.struct(F.lit("broken").alias("kind"),
                 F.concat(F.lit("SUMMARY_JSON: "), F.substring(summary, 1, 20), F.lit("}")).alias("line"))))
    logs = runs.select("product_id", lines.alias("l")).select("product_id", "l.kind", "l.line")
    schema = T.StructType(RUN_SUMMARY.fields[:3])
    return stats.parse_summaries(logs, schema)


@query
def backlog(spark, sf):
    """Listed products (all seen ones and three that never occur) without a review in the newest window."""
    reviews = fx.reviews(spark, sf)
    prefix = "/products/"
    never = spark.range(900, 903).select(F.concat(F.lit("WB-"), F.col("id").cast("string")).alias("product_id"))
    keys = (reviews.select("product_id").distinct().unionByName(never)
            .select(F.concat(F.lit(prefix), "product_id").alias("key")))
    listed = keys.select(strip_prefix(F.col("key"), prefix).alias("product_id"))
    return stats.product_backlog(listed, tables.retain_since(reviews, fx.newest_window(spark, sf), 0, "date"))


# --- dashboards -------------------------------------------------------------

@query
def kpi_windows(spark, sf):
    return dashboards.kpi_windows(fx.windows(spark, sf))


@query
def weighted_rating(spark, sf):
    return dashboards.weighted_rating(fx.windows(spark, sf))


@query
def kpi_latest(spark, sf):
    return dashboards.kpi_latest(fx.slides(spark, sf))


@query
def latest_per_product(spark, sf):
    return dashboards.latest_per_product(fx.slides(spark, sf))


@query
def top20_latest(spark, sf):
    return dashboards.top_latest(fx.slides(spark, sf))


@query
def reviews_by_product(spark, sf):
    return dashboards.reviews_by_product(fx.windows(spark, sf))


@query
def top20_rating(spark, sf):
    return dashboards.top_rated(fx.windows(spark, sf))


@query
def timeline(spark, sf):
    return dashboards.timeline(fx.windows(spark, sf))


@query
def latency_series(spark, sf):
    return dashboards.latency_series(fx.slides(spark, sf), 2 * DAY)


@query
def current_latency(spark, sf):
    return dashboards.current_latency(fx.slides(spark, sf), 2 * DAY)


@query
def product_list(spark, sf):
    return dashboards.product_list(fx.windows(spark, sf))


@query
def product_series(spark, sf):
    return dashboards.product_series(fx.slides(spark, sf))


@query
def rating_bands(spark, sf):
    return dashboards.rating_bands(fx.windows(spark, sf))


@query
def recent_table(spark, sf):
    return dashboards.recent_table(fx.slides(spark, sf))


@query
def windows_newest(spark, sf):
    return dashboards.windows_newest(fx.windows(spark, sf))


@query
def emissions_newest(spark, sf):
    """Everything the windows emitted, numbered in the order of arrival."""
    return dashboards.emissions_newest(windows.tumbling_changelog(fx.reviews(spark, sf), fx.WIDTH_S, fx.LATENESS_S))


@query
def windows_sorted(spark, sf):
    return dashboards.windows_sorted(fx.windows(spark, sf))


@query
def parse_window_start(spark, sf):
    return fx.windows_mixed_time(spark, sf).withColumn("window_start", parse_instant(F.col("raw_start")))


# --- sketches ----------------------------------------------------------------

def _weeks(spark: SparkSession, reviews: DataFrame) -> DataFrame:
    """Sketches per day, stored, and merged over every span of seven days."""
    days = durable(sketches.interval_sketches(reviews, DAY))
    return sketches.rolling(days, DAY, 7)


@query
def approx_distinct(spark, sf):
    """Distinct ids and products of every seven days from stored sketches, beside the exact numbers."""
    reviews = fx.reviews_refetched(spark, sf).withColumn("id", F.concat_ws("-", "id", (F.col("seq") % 500).cast("string")))
    counts = sketches.distinct_counts(_weeks(spark, reviews))
    day = windows.tumbling_bucket("date", DAY)["start"]
    spans = F.explode(F.transform(F.sequence(F.lit(0), F.lit(6)), lambda d: day - F.make_dt_interval(days=d)))
    exact = (reviews.select("id", "product_id", spans.alias("span_start"))
             .groupBy("span_start").agg(F.count_distinct("id").alias("n_ids"), F.count_distinct("product_id").alias("n_products")))
    return counts.join(exact, "span_start").select(
        "span_start", "reviews", "n_ids", "n_products", F.col("n_ids").between(F.col("ids_low"), F.col("ids_high")).alias("ids_in_bounds"),
        F.col("n_products").between(F.col("products_low"), F.col("products_high")).alias("products_in_bounds"))


@query
def approx_top_products(spark, sf):
    """Most reviewed products of every seven days from stored sketches."""
    return sketches.top_counts(_weeks(spark, fx.reviews(spark, sf)), "span_start")


# --- serving and encoding ---------------------------------------------------

@query
def filter_prefix(spark, sf):
    return serving.filter_prefix(fx.windows(spark, sf), "WB-00")


@query
def filter_exact(spark, sf):
    return serving.filter_exact(fx.windows(spark, sf), "WB-002")


@query
def filter_stored(spark, sf):
    """The prefix filter on the stored window table, which is written in two batches, clustered by product."""
    root, seen = _fresh(spark), fx.windows(spark, sf).withColumn("is_update", F.lit(False))
    for batch_id, kept in enumerate(("review_count > 1", "review_count > 0")):  # the second replaces rows of the first
        writers.append_batch(seen.filter(kept).select(*WINDOW_AGG.fieldNames()), root, batch_id, "window_start", cluster=tables.WINDOW_KEY)
    return serving.filter_prefix(writers.latest_windows(spark, root, WINDOW_AGG), "WB-00").drop("is_update")


@query
def ticket_filter(spark, sf):
    return serving.query_windows(fx.windows(spark, sf), serving.ticket_for_path(["windows", "OZ-"]))


@query
def serve_projection(spark, sf):
    changes = windows.tumbling_changelog(fx.reviews(spark, sf), fx.WIDTH_S, fx.LATENESS_S)
    return serving.serve_projection(changes)


@query
def paths_equal(spark, sf):
    """The same filter asked by path and by ticket, and against everything."""
    everything = fx.windows(spark, sf)
    by_path = serving.query_windows(everything, serving.ticket_for_path(["windows", "WB-"]))
    by_ticket = serving.query_windows(everything, '{"cmd": "filter", "product_id": "WB-"}')
    by_all = serving.query_windows(everything, '{"cmd": "all"}')
    same = tables.same_rows(by_path, by_ticket).withColumn("pair", F.lit("path_ticket"))
    return same.unionByName(tables.same_rows(by_path, by_all).withColumn("pair", F.lit("path_all")))


@query
def encode_raw(spark, sf):
    return codec.encode_raw(fx.reviews_with_text(spark, sf))


@query
def encode_windowed(spark, sf):
    return codec.encode_windowed(fx.windows(spark, sf))


@query
def encode_sliding(spark, sf):
    return codec.encode_sliding(fx.slides(spark, sf))


@query
def json_payload_bytes(spark, sf):
    return serving.payload_bytes(fx.windows(spark, sf))


# --- table maintenance ------------------------------------------------------

@query
def upsert_windows(spark, sf):
    """First publications as the table, corrections as the batch."""
    changes = durable(windows.tumbling_changelog(fx.reviews(spark, sf), fx.WIDTH_S, fx.LATENESS_S))
    merged = tables.merge_latest(changes.filter(~F.col("is_update")), changes.filter("is_update"),
                                 ["emitted_at", "seq"])
    return serving.serve_projection(merged)


@query
def mark_updates(spark, sf):
    """Windows of late reviews, flagged if an on-time review had already published the window."""
    kept = windows.classify_arrival(fx.reviews(spark, sf), fx.WIDTH_S, fx.LATENESS_S)
    published = kept.filter("arrival_class = 'on_time'").select("window_start")
    late = kept.filter("arrival_class = 'late'").select("product_id", "window_start").distinct()
    return tables.mark_updates(late, published)


@query
def dedup_reviews(spark, sf):
    return tables.dedup_reviews(fx.reviews_replayed(spark, sf)).drop("rating_f")


@query
def dedup_reviews_by_id(spark, sf):
    """The same dedup when the filter of repeated ids is far too small and lets most single ids through."""
    return tables.dedup_reviews(fx.reviews_replayed(spark, sf), blocks=1).drop("rating_f")


@query
def dedup_within_horizon(spark, sf):
    return tables.dedup_within(fx.reviews_refetched(spark, sf), 6 * HOUR).select("id", "arrival_ts", "seq", "rating")


@query
def retain_last_n(spark, sf):
    return tables.retain_last(fx.windows(spark, sf), 100, ["window_start", "product_id"])


@query
def retain_last_emitted(spark, sf):
    """The last 100 emissions that a bounded store keeps."""
    return tables.retain_last_emitted(windows.tumbling_changelog(fx.reviews(spark, sf), fx.WIDTH_S, fx.LATENESS_S), 100)


@query
def retain_24h(spark, sf):
    return tables.retain_since(fx.windows(spark, sf), fx.newest_window(spark, sf), DAY)


@query
def recent_windows(spark, sf):
    return tables.retain_since(fx.windows(spark, sf), fx.newest_window(spark, sf), fx.RECENT_S)


# --- alerts -----------------------------------------------------------------

@query
def anomalies(spark, sf):
    return alerts.anomalies(fx.windows(spark, sf), fx.newest_window(spark, sf), fx.RECENT_S)


@query
def anomaly_history(spark, sf):
    return alerts.anomaly_history(fx.windows(spark, sf), fx.RECENT_S, fx.CHECK_S)


@query
def alert_cooldown(spark, sf):
    history = alerts.anomaly_history(fx.windows(spark, sf), fx.RECENT_S, fx.CHECK_S)
    return alerts.alert_cooldown(history, fx.CHECK_S, fx.COOLDOWN_S, block_steps=28)


# --- streams, drained once --------------------------------------------------

def _event_stream(spark: SparkSession, sf: str, batches: int = 4) -> DataFrame:
    """The events as a stream of several batches, each a stretch of event ids; the number of files in each follows from the data."""
    root = _fresh(spark)
    events = spark.read.schema(fx.EVENTS).parquet(f"{sf}/events.parquet")
    first, last = events.agg(F.coalesce(F.min("event_id"), F.lit(0)), F.coalesce(F.max("event_id"), F.lit(0))).first()
    part = F.floor((F.col("event_id") - first) * batches / (last - first + 1)).cast("int").alias("part")
    events.select("*", part).hint("rebalance", F.col("part")).write.partitionBy("part").parquet(root)
    n_files = len(spark.read.schema(fx.EVENTS).parquet(root).inputFiles())
    return fx.as_reviews(_source(spark, root, fx.EVENTS, -(-n_files // batches)))


def _source(spark: SparkSession, path: str, schema, files_per_batch: int = 1) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(path)


def _dealt(spark: SparkSession, sf: str, *by: str) -> DataFrame:
    """The events as a stream of several files, each with other products: not in the order of arrival."""
    root = _fresh(spark)
    placed = fx.reviews(spark, sf).repartition(6, *by).sortWithinPartitions("arrival_ts")
    placed.write.parquet(root)
    return _source(spark, root, placed.schema)


def _fed(spark: SparkSession, rows: DataFrame, ts: str, run: Callable[[DataFrame], None], disorder_s: int = 0,
         mark: Callable[[T.StructType], DataFrame] | None = None, batches: int = 4) -> None:
    """Feed rows to a stream in `batches` stretches of time; the stream stops and starts again after each of them.

    The rows are written once, by ranges of their time; the number of files follows from the data. A row may come up to
    `disorder_s` late: into a later stretch than its time says. `mark` gives rows to add at the end.
    """
    root, source = _fresh(spark), _fresh(spark)
    late_s = F.pmod(F.xxhash64(*[c for c in rows.columns if c in ("id", "product_id", "seq")]), F.lit(max(1, disorder_s)))
    read_at = F.unix_micros(ts) + 1_000_000 * late_s
    cuts = rows.select(read_at.alias("t")).approxQuantile("t", [i / batches for i in range(1, batches)], 0.01)
    placed = rows.withColumn("stretch", sum(((read_at > c).cast("int") for c in cuts), F.lit(0)))
    placed.hint("rebalance", F.col("stretch")).write.partitionBy("stretch").parquet(root)
    stored = spark.read.schema(placed.schema).parquet(root)
    parts = [stored.filter(F.col("stretch") == i).drop("stretch") for i in range(batches)]
    for part in [*parts, *([mark(rows.schema)] if mark else [])]:
        part.write.mode("append").parquet(source)
        run(spark.readStream.schema(rows.schema).parquet(source))


def _fresh(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/run-{uuid.uuid4().hex}"


def _window_table(spark: SparkSession, stream: DataFrame) -> DataFrame:
    root = _fresh(spark)
    jobs.run_tumbling_table(stream, f"{root}/table", f"{root}/state", fx.WIDTH_S, fx.LATENESS_S, final=True).awaitTermination()
    return serving.serve_projection(writers.latest_windows(spark, f"{root}/table", WINDOW_AGG))


@query
def stream_tumbling_table(spark, sf):
    """A stream into the window table, then the last version of every window."""
    return _window_table(spark, _event_stream(spark, sf))


@query
def stream_tumbling_shuffled(spark, sf):
    """The same from files that hold the products one after the other."""
    return _window_table(spark, _dealt(spark, sf, "product_id"))


@query
def stream_tumbling_future(spark, sf):
    """Some reviews are dated after their arrival; they count like others."""
    return _window_table(spark, fx.dated_ahead(_event_stream(spark, sf)))


@query
def stream_restart_table(spark, sf):
    """Two runs with checkpoints of their own into one table: the later run's versions win, others stay."""
    root = _fresh(spark)
    for name, kept in (("a", "true"), ("b", "seq % 2 = 0")):
        jobs.run_tumbling_table(_event_stream(spark, sf).filter(kept), f"{root}/table", f"{root}/state-{name}",
                                fx.WIDTH_S, fx.LATENESS_S, final=True).awaitTermination()
    return serving.serve_projection(writers.latest_windows(spark, f"{root}/table", WINDOW_AGG))


@query
def stream_sliding(spark, sf):
    """Sliding windows from stored panes, with those still open when the stream stops."""
    root = _fresh(spark)
    jobs.run_sliding_panes(_event_stream(spark, sf), f"{root}/panes", f"{root}/state", fx.SIZE_S, fx.SLIDE_S,
                           final=True).awaitTermination()
    return jobs.sliding_windows(spark, f"{root}/panes", writers.run_of(spark, f"{root}/state"), fx.SIZE_S, fx.SLIDE_S)


@query
def quarantine_counts(spark, sf):
    """What becomes of reviews, some of which lack a date or an arrival."""
    return windows.reviews_by_fate(fx.reviews_undated(spark, sf), fx.WIDTH_S, fx.LATENESS_S)


@query
def stream_review_stats(spark, sf):
    root = _fresh(spark)

    def keep(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{root}/out")

    stream = jobs.flush_every(jobs.stats_stream(_event_stream(spark, sf)).writeStream.outputMode("complete")
                              .option("checkpointLocation", f"{root}/state").foreachBatch(keep), final=True)
    stream.start().awaitTermination()
    return spark.read.schema("total long, valid long, invalid long, avg_rating double").parquet(f"{root}/out")


def _complete(spark: SparkSession, build, schema: str, sf: str) -> DataFrame:
    """The last result of an aggregate over the event stream."""
    root = _fresh(spark)

    def keep(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{root}/out")

    stream = jobs.flush_every(build(_event_stream(spark, sf)).writeStream.outputMode("complete")
                              .option("checkpointLocation", f"{root}/state").foreachBatch(keep), final=True)
    stream.start().awaitTermination()
    return spark.read.schema(schema).parquet(f"{root}/out")


@query
def stream_rating_counts(spark, sf):
    """Reviews per rating and per product so far, as the running statistics of the stream."""
    counts = lambda r: r.filter("rating between 1 and 5").groupBy("product_id", "rating").agg(F.count("*").alias("n"))
    return _complete(spark, counts, "product_id string, rating int, n long", sf)


def _accepted(spark: SparkSession, stream: DataFrame, horizon_s: int) -> DataFrame:
    root = _fresh(spark)
    jobs.run_dedup(stream, f"{root}/dedup", f"{root}/state", horizon_s, final=True).awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{root}/dedup/accepted")


@query
def stream_dedup(spark, sf):
    """Every event read twice; the horizon covers the delay between the copies."""
    twice = _event_stream(spark, sf).withColumn("_", F.explode(F.array(F.lit(0), F.lit(1)))).drop("_")
    return _accepted(spark, twice, jobs.DEDUP_HORIZON_S).select("id", "product_id", "rating", "arrival_ts")


@query
def stream_dedup_refetched(spark, sf):
    """Ids that are used again after the horizon, over several batches in the order of arrival."""
    root, reviews = _fresh(spark), fx.reviews_refetched(spark, sf)
    _fed(spark, reviews, "arrival_ts",
         lambda stream: jobs.run_dedup(stream, f"{root}/dedup", f"{root}/state", 6 * HOUR, final=True).awaitTermination())
    return spark.read.schema(reviews.schema).parquet(f"{root}/dedup/accepted").select("id", "arrival_ts", "seq", "rating")


def _review_messages(spark: SparkSession, sf: str, root: str) -> tuple[DataFrame, Callable[[DataFrame], DataFrame]]:
    """Messages with the place of their text, for the texts are kept at `root`, and how they get their values once they are in order."""
    documents = texts.keep(fx.texts(spark, sf), "body", root)
    sent = (fx.with_document(fx.reviews(spark, sf), documents, documents.count())
            .select("seq", F.col("product_id").alias("key"), *[c for c in codec.RAW_FIELDS if c != "text"], *texts.PLACE.fieldNames()))

    def attach(placed: DataFrame) -> DataFrame:
        base = fx.with_body(texts.fetch(placed, root, "body"))
        return base.withColumn("value", fx.message_value(base))

    return sent, attach


@query
def stream_messages(spark, sf):
    """Review messages appended to a topic in two goes, decoded in polls by record offset, with a restart in between."""
    root = _fresh(spark)
    sent, attach = _review_messages(spark, sf, f"{root}/texts")
    n, halves = sent.count(), (F.col("seq") % 3 == 0, F.col("seq") % 3 != 0)
    for half in halves:
        messages.append_messages(sent.filter(half), f"{root}/topic", ["seq"], attach=attach, weight="text_size")
        if half is halves[-1]:
            texts.drop(spark, f"{root}/texts")
        jobs.drain(jobs.run_decoded(spark, f"{root}/topic", f"{root}/out", f"{root}/state", per_batch=max(1, -(-n // 6)), delete_read=True),
                   read_topic=f"{root}/topic")
    stored = T.StructType([*REVIEW.fields, T.StructField(codec.CORRUPT, T.StringType())])
    return (spark.read.schema(stored).parquet(f"{root}/out")
            .select(F.col(codec.CORRUPT).isNotNull().alias("corrupt"), "id", "product_id", "rating", "likes", "dislikes", "date",
                    F.char_length("text").alias("text_chars")))


@query
def stream_flushed(spark, sf):
    """Window messages in the order of emission through a topic into the window table, a flush per full buffer and one on stop."""
    root = _fresh(spark)
    emitted = windows.tumbling_changelog(fx.reviews(spark, sf), fx.WIDTH_S, fx.LATENESS_S)
    n = messages.append_messages(codec.encode_windowed(emitted, "emitted_at", "seq"), f"{root}/topic", ["emitted_at", "seq"])
    run, rows = writers.run_of(spark, f"{root}/state"), max(jobs.FLUSH_ROWS, n // 5 + 1)
    for seconds in (DAY, 0):  # what is left of the last buffer stays until the stream stops
        jobs.drain(jobs.run_flushed(spark, f"{root}/topic", f"{root}/state", jobs.upsert_into(f"{root}/table", run), rows=rows, seconds=seconds))
    return serving.serve_projection(writers.latest_windows(spark, f"{root}/table", WINDOW_AGG))


# --- streams with timers ----------------------------------------------------

@query
def stream_closing(spark, sf):
    """Windows published when they end and corrected by late reviews; read out of order, with a restart after each batch."""
    root, reviews = _fresh(spark), fx.reviews(spark, sf).select("product_id", "rating", "likes", "date", "arrival_ts", "seq")
    newest = reviews.agg(F.max("arrival_ts").alias("at"))
    _fed(spark, reviews, "arrival_ts",
         lambda stream: timers.run_closing(stream, f"{root}/log", f"{root}/state", fx.WIDTH_S, fx.LATENESS_S, HOUR, salts=2, final=True).awaitTermination(),
         disorder_s=HOUR, mark=lambda schema: timers.end_mark(schema, newest, 2 * DAY))
    return timers.emitted(spark, f"{root}/log", writers.run_of(spark, f"{root}/state"))


@query
def stream_alerts(spark, sf):
    """Alerts of a stream of windows, with a restart after each batch."""
    root, seen = _fresh(spark), fx.windows(spark, sf)
    newest = seen.agg(F.max("window_start").alias("at"))
    ends = {"product_id": F.lit("(end)"), "window_start": F.col("at") + F.make_dt_interval(days=F.lit(30))}
    mark = lambda schema: newest.select(*[ends.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in schema.fields])
    _fed(spark, seen, "window_start",
         lambda stream: timers.run_alerts(stream, f"{root}/log", f"{root}/state", fx.RECENT_S, fx.CHECK_S, fx.COOLDOWN_S, final=True).awaitTermination(),
         mark=mark)
    return timers.logged_alerts(spark, f"{root}/log", writers.run_of(spark, f"{root}/state"))
