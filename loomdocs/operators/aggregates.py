"""Counts, rates and reports."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import edge_text
from .filters import exclude_rolls
from .substrings import candidates, write_gram_index

GAP_SECONDS, BUCKET_MINUTES, ONLINE_MINUTES = 120, 5, 15
#: Length of the time slices that one key's events are cut into.
SLICE_SECONDS = 3600
PERIODS = {"7d": 604_800, "24h": 86_400}


def top_k(df: DataFrame, by: str, k: int, tie: list[str]) -> DataFrame:
    """The k rows with the largest value, ties by other columns."""
    return df.orderBy(F.desc(by), *tie).limit(k)


def type_status_counts(rec: DataFrame) -> DataFrame:
    """A1."""
    return rec.groupBy("record_type", "status").agg(F.count("*").alias("n")).orderBy("record_type", "status")


def top_targets(rec: DataFrame, n: int = 20) -> DataFrame:
    """A2: largest groups of (entity, target, type, status)."""
    keys = ["entity_name", "target_name", "record_type", "status"]
    return top_k(rec.groupBy(*keys).agg(F.count("*").alias("n")), "n", n, keys)


def heading_search(rec: DataFrame, heading: str, n: int, bottom: bool = False, rolls: bool = True, text: str = "full_text") -> DataFrame:
    """A3: records whose first or last n characters hold the heading: as a word, at a line start, anywhere, anywhere in any case."""
    quoted = "".join(c if c.isalnum() or c == "_" else "\\" + c for c in heading)
    edge = F.coalesce(edge_text(text, n, bottom), F.lit(""))
    rec = rec if rolls else rec.where(exclude_rolls())
    return rec.agg(
        F.count("*").alias("total"),
        F.count_if(edge.rlike(rf"\b{quoted}\b")).alias("as_word"),
        F.count_if(edge.rlike(rf"(?m)^\s*{quoted}")).alias("at_line_start"),
        F.count_if(F.contains(edge, F.lit(heading))).alias("anywhere"),
        F.count_if(F.contains(F.lower(edge), F.lit(heading.lower()))).alias("any_case"),
    )


def index_headings(rec: DataFrame, path: str, n: int, bottom: bool = False, text: str = "full_text", key: str = "id") -> None:
    """The gram index of the records' first or last n characters, for heading_search_by_index."""
    write_gram_index(rec, path, [edge_text(text, n, bottom)], key)


def heading_search_by_index(rec: DataFrame, index: DataFrame, heading: str, n: int, bottom: bool = False, rolls: bool = True, text: str = "full_text", key: str = "id") -> DataFrame:
    """A3 on index_headings of the same edge: texts are read only of records with the heading's rarest gram. Same counts as heading_search; short headings, and such with letters beyond ASCII (whose case may depend on their neighbours), scan."""
    found = candidates(index, heading) if heading.isascii() else None
    if found is None:
        return heading_search(rec, heading, n, bottom, rolls, text)
    rec = rec if rolls else rec.where(exclude_rolls())
    hits = heading_search(rec.join(found.select(F.col("id").alias(key)), key, "left_semi"), heading, n, bottom, True, text)
    kinds = [c for c in hits.columns if c != "total"]
    both = hits.withColumn("total", F.lit(0).cast("long")).unionByName(rec.agg(F.count("*").alias("total"), *[F.lit(0).cast("long").alias(c) for c in kinds]))
    return both.agg(*[F.sum(c).alias(c) for c in hits.columns])


def online_changes(ev: DataFrame, key: str, until: Column, minutes: int = ONLINE_MINUTES) -> DataFrame:
    """ST6 in batch, as gaps and islands: `online` at an event after silence, `offline` when `minutes` have passed without one, up to the time `until`."""
    us, silence = F.unix_micros("ts"), minutes * 60_000_000
    own = ev.where("ts is not null").select(F.col(key).cast("string").alias("key"), us.alias("at_us")).distinct().where(F.col("at_us") <= until)
    order = Window.partitionBy("key").orderBy("at_us")
    own = own.withColumns({"before": F.lag("at_us").over(order), "after": F.lead("at_us").over(order)})
    on = own.where(F.col("before").isNull() | (F.col("at_us") - F.col("before") > silence)).select("key", F.lit("online").alias("state"), "at_us")
    end = F.col("at_us") + silence
    off = own.where((F.col("after") - F.col("at_us") > silence) | (F.col("after").isNull() & (end <= until))).select("key", F.lit("offline").alias("state"), end.alias("at_us"))
    return on.unionAll(off)


def is_detailed() -> Column:
    return F.coalesce(F.col("status") == "detailed", F.lit(False)) | F.get_json_object("data", "$.details_scraped_at").isNotNull()


def pipeline_state(rec: DataFrame) -> DataFrame:
    """A4: per record type totals, complete and incomplete years, and whether all is detailed. Null years count in totals only."""
    per = rec.groupBy("record_type", "rec_year").agg(F.count("*").alias("n"), F.count_if(is_detailed()).alias("detailed"))
    years = F.collect_list(F.when(F.col("rec_year").isNotNull(), F.struct("rec_year", (F.col("n") == F.col("detailed")).alias("done"))))
    out = per.groupBy("record_type").agg(F.sum("n").alias("total"), F.sum("detailed").alias("total_detailed"), F.sort_array(years).alias("years"))
    pick = lambda done: F.transform(F.filter("years", lambda y: y["done"] == done), lambda y: y["rec_year"])
    return out.select("record_type", "total", "total_detailed", (F.col("total") - F.col("total_detailed")).alias("total_indexed"), pick(True).alias("complete_years"), pick(False).alias("incomplete_years"), (F.col("total") == F.col("total_detailed")).alias("fully_complete"))


def overall_totals(rec: DataFrame) -> DataFrame:
    """A5: per scraper type counts of indexed (no status counts as such), detailed and all; input has scraper_type, status and n (pre-counted)."""
    return rec.groupBy("scraper_type").agg(F.sum(F.when(F.coalesce("status", F.lit("indexed")) == "indexed", F.col("n")).otherwise(0)).alias("indexed"), F.sum(F.when(F.col("status") == "detailed", F.col("n")).otherwise(0)).alias("detailed"), F.sum("n").alias("total"))


def _sliced(ev: DataFrame, seconds: int) -> DataFrame:
    """ev with its time in microseconds and the number of its time slice."""
    us = F.unix_micros(F.col("ts").cast("timestamp"))
    return ev.withColumn("us", us).withColumn("slice", F.floor(F.col("us") / (seconds * 1_000_000)))


def with_gap(ev: DataFrame, keys: list[str], tie: list[str], slice_seconds: int = SLICE_SECONDS) -> DataFrame:
    """Microseconds since the key's previous event.

    A key's events are ordered slice by slice, so one key's events go to many
    tasks; the first event of a slice takes the last time of the slice before
    from a table of a row per key and slice.
    """
    cut = _sliced(ev, slice_seconds)
    own = Window.partitionBy(*keys, "slice").orderBy("us", *tie)
    cut = cut.withColumn("before", F.lag("us").over(own)).withColumn("leads", F.row_number().over(own) == 1)
    ends = cut.groupBy(*keys, "slice").agg(F.max("us").alias("end"))
    ends = ends.withColumn("end", F.lag("end").over(Window.partitionBy(*keys).orderBy("slice")))
    ends = ends.select(*[F.col(k).alias(f"end {k}") for k in (*keys, "slice")], "end").where("end is not null")
    same = [F.col(k).eqNullSafe(F.col(f"`end {k}`")) for k in (*keys, "slice")]
    joined = cut.join(ends, [*same], "left")
    return joined.select(*ev.columns, "us", (F.col("us") - F.when(F.col("leads"), F.col("end")).otherwise(F.col("before"))).alias("gap_us"))


def _uptime(ev: DataFrame, keys: list[str], tie: list[str], gap: int, also: dict[str, Column], slice_seconds: int = SLICE_SECONDS) -> DataFrame:
    """total, active, uptime_us and rates per key, and sums of other counts, in one pass: slices first, then their borders."""
    gap_us, known = gap * 1_000_000, F.coalesce(F.col("gap_us") <= gap * 1_000_000, F.lit(False))
    cut = _sliced(ev, slice_seconds)
    inner = F.col("us") - F.lag("us").over(Window.partitionBy(*keys, "slice").orderBy("us", *tie))
    part = cut.withColumn("gap_us", inner).groupBy(*keys, "slice").agg(
        F.count("*").alias("total"), F.count_if(known).alias("active"), F.sum(F.when(known, F.col("gap_us")).otherwise(0)).alias("uptime_us"),
        F.min("us").alias("begin"), F.max("us").alias("end"), *[c.alias(n) for n, c in also.items()],
    )
    border = F.col("begin") - F.lag("end").over(Window.partitionBy(*keys).orderBy("slice"))
    part = part.withColumn("border", F.when(border <= gap_us, border))
    out = part.groupBy(*keys).agg(
        F.sum("total").alias("total"), (F.sum("active") + F.count("border")).alias("active"), (F.sum("uptime_us") + F.coalesce(F.sum("border"), F.lit(0))).alias("uptime_us"),
        *[F.sum(n).alias(n) for n in also],
    )
    rate = F.when(F.col("uptime_us") > 0, F.col("active") * F.lit(1e6) / F.col("uptime_us")).otherwise(0.0)
    return out.select(*keys, "total", "active", "uptime_us", rate.alias("rate"), (rate * 3600).alias("rate_per_hour"), *also)


def uptime_and_rate(ev: DataFrame, keys: list[str], tie: list[str], gap: int = GAP_SECONDS) -> DataFrame:
    """Active time (sum of gaps up to `gap` seconds), number of such gaps, and their rate per second and hour."""
    return _uptime(ev, keys, tie, gap, {})


def period_rate(ev: DataFrame, keys: list[str], now: Column, period: str) -> DataFrame:
    """Events since the start of the period (no upper bound), and their rate per second."""
    seconds = PERIODS[period]
    n = F.count_if(F.col("ts").cast("timestamp") >= now - F.make_dt_interval(secs=F.lit(seconds)))
    return ev.groupBy(*keys).agg(n.alias("n"), (n / seconds).alias("rate"))


def is_online(ev: DataFrame, keys: list[str], now: Column, minutes: int = ONLINE_MINUTES) -> DataFrame:
    """Any event in the last minutes."""
    return ev.groupBy(*keys).agg(F.coalesce(F.bool_or(F.col("ts").cast("timestamp") >= now - F.make_dt_interval(mins=F.lit(minutes))), F.lit(False)).alias("online"))


def worker_breakdown(ev: DataFrame, key: str, worker: str, tie: list[str]) -> DataFrame:
    """A10: a map from worker to its counts and rate."""
    ev = ev.withColumn("worker", F.coalesce(F.col(worker).cast("string"), F.lit("unknown")))
    per = uptime_and_rate(ev, [key, "worker"], tie)
    return per.groupBy(key).agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("worker", F.struct("total", "active", "uptime_us", "rate").alias("metrics"))))).alias("workers"))


def configured_concurrency(cfg: DataFrame) -> DataFrame:
    """Sum of the numbers among the concurrency settings; null if there is none."""
    return cfg.groupBy("scraper_type").agg(F.sum(F.expr("try_cast(concurrency AS int)")).alias("concurrency"))


def last_hour_intervals(ev: DataFrame, keys: list[str], now: dt.datetime, minutes: int = BUCKET_MINUTES) -> DataFrame:
    """The completed buckets of the last hour for each key, empty ones too, with projected hourly rates."""
    spark = ev.sparkSession
    end = now.replace(minute=now.minute - now.minute % minutes, second=0, microsecond=0)
    begin = end - dt.timedelta(hours=1)
    at = F.unix_seconds(F.col("ts").cast("timestamp"))
    first, last = (int(x.replace(tzinfo=dt.UTC).timestamp()) for x in (begin, end))
    step = minutes * 60
    bucket = F.expr(f"({first} + ((unix_seconds(cast(ts AS timestamp)) - {first}) div {step}) * {step})")
    counted = ev.where((at >= first) & (at < last)).groupBy(*keys, bucket.alias("start_s")).agg(F.count("*").alias("n"))
    buckets = spark.range(first, last, step).select(F.col("id").alias("start_s"))  # a dozen rows
    spine = ev.select(*keys).distinct().join(F.broadcast(buckets), F.lit(True))
    out = spine.join(counted, [*keys, "start_s"], "left").withColumn("n", F.coalesce("n", F.lit(0)))
    return out.select(*keys, "start_s", "n", (F.col("n") * (60 // minutes)).cast("double").alias("rate_per_hour"))


def month_windows(years: DataFrame, resume: tuple[int, int] | None = None) -> DataFrame:
    """First and last day of every month of the given years (year), from a resume point (year, month) on."""
    first = F.explode(F.sequence(F.make_date("year", F.lit(1), F.lit(1)), F.make_date("year", F.lit(12), F.lit(1)), F.expr("interval 1 month")))
    out = years.select("year").distinct().select("year", first.alias("first_day")).select("year", F.month("first_day").alias("month"), "first_day", F.last_day("first_day").alias("last_day"))
    return out if resume is None else out.where((F.col("year") * 100 + F.col("month")) >= resume[0] * 100 + resume[1])


def fallback_sample(rec: DataFrame, recent: DataFrame, key: str, n: int = 1000) -> DataFrame:
    """The latest n rows of each key that has none in `recent`."""
    idle = rec.join(recent.select(key).distinct(), key, "left_anti")
    return idle.withColumn("place", F.row_number().over(Window.partitionBy(key).orderBy(F.desc("scraped_at"), F.desc("id")))).where(F.col("place") <= n).drop("place")


def both_advanced(latest: DataFrame, cursor: DataFrame) -> DataFrame:
    """Whether every source's latest time is beyond its cursor (source, ts); a missing cursor counts as advanced."""
    newest = latest.groupBy("source").agg(F.max("ts").alias("latest"))
    seen = cursor.groupBy("source").agg(F.max("ts").alias("seen"))
    return newest.join(seen, "source", "left").agg(F.coalesce(F.every(F.coalesce(F.col("latest") > F.col("seen"), F.col("seen").isNull())), F.lit(False)).alias("due"))


def pipeline_metrics(ev: DataFrame, key: str, worker: str, tie: list[str], now: dt.datetime, minutes: int = BUCKET_MINUTES) -> DataFrame:
    """Per key one struct of uptime, periods, online state, last-hour buckets and workers.

    Two passes over the events: one by key with every count, one by key and worker.
    """
    at, time = F.lit(now).cast("timestamp"), F.col("ts").cast("timestamp")
    end = now.replace(minute=now.minute - now.minute % minutes, second=0, microsecond=0).replace(tzinfo=dt.UTC)
    starts = [int(end.timestamp()) - 3600 + i * minutes * 60 for i in range(60 // minutes)]
    within = lambda s: F.count_if((F.unix_seconds(time) >= s) & (F.unix_seconds(time) < s + minutes * 60))
    also = {f"last_{p}": F.count_if(time >= at - F.make_dt_interval(secs=F.lit(s))) for p, s in PERIODS.items()}
    also |= {"recent": F.count_if(time >= at - F.make_dt_interval(mins=F.lit(ONLINE_MINUTES)))} | {f"from_{s}": within(s) for s in starts}
    per = _uptime(ev, [key], tie, GAP_SECONDS, also)
    periods = [F.struct(F.col(f"last_{p}").alias("n"), (F.col(f"last_{p}") / s).alias("rate")).alias(f"last_{p}") for p, s in PERIODS.items()]
    buckets = [F.struct(F.lit(s).cast("long").alias("start_s"), F.col(f"from_{s}").alias("n"), (F.col(f"from_{s}") * (60 // minutes)).cast("double").alias("rate_per_hour")) for s in starts]
    per = per.select(key, "total", "active", "uptime_us", "rate", "rate_per_hour", *periods, F.array(*buckets).alias("intervals"), (F.col("recent") > 0).alias("online"))
    workers = worker_breakdown(ev, key, worker, tie).withColumnRenamed(key, "worker key")
    out = per.join(workers, F.col(key).eqNullSafe(F.col("worker key")), "left").drop("worker key")
    return out.select(key, F.struct(*[c for c in out.columns if c != key]).alias("metrics"))


def legal_kpis(cases: DataFrame) -> DataFrame:
    """Number of cases, mean duration (one place, ties to even) and share of reportable ones."""
    return cases.agg(F.count("*").alias("total"), F.bround(F.avg("duration_years"), 1).alias("mean_duration"), (F.count_if("reportable") / F.nullif(F.count("reportable"), F.lit(0))).alias("reportable_share"))


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Rows per value, without nulls."""
    return df.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("value")).agg(F.count("*").alias("n"))


def top_terms(df: DataFrame, array_col: str, n: int = 10) -> DataFrame:
    """Most frequent elements of an array column."""
    return top_k(df.select(F.explode(array_col).alias("value")).where("value is not null").groupBy("value").agg(F.count("*").alias("n")), "n", n, ["value"])


def judge_outcome(cases: DataFrame, outcomes: list[str] | None = None) -> DataFrame:
    """Judge by outcome, 0 where missing."""
    named = cases.where(F.col("judge").isNotNull() & F.col("outcome").isNotNull())
    return named.groupBy("judge").pivot("outcome", outcomes).agg(F.count(F.lit(1))).na.fill(0)


def repair_report(changes: DataFrame) -> DataFrame:
    """Changes per target and kind."""
    return changes.groupBy("target_name", "fix_type").agg(F.count("*").alias("n"))


def reset_report(df: DataFrame) -> DataFrame:
    """Rows, and those with parsed, scrubbed and flagged state."""
    return df.agg(F.count("*").alias("total"), F.count_if("is_parsed").alias("parsed"), F.count_if("is_scrubbed").alias("scrubbed"), F.count_if(F.coalesce("requires_human_review", F.lit(False))).alias("flagged"))


def recovery_report(df: DataFrame) -> DataFrame:
    """Reprocessed and recovered rows; the rate is 0 for none."""
    return df.agg(F.count("*").alias("reprocessed"), F.count_if("recovered").alias("recovered"), F.coalesce(F.avg(F.col("recovered").cast("double")), F.lit(0.0)).alias("rate"))


def pending_types(rec: DataFrame) -> DataFrame:
    """Record types with detailed records that aren't scrubbed."""
    return rec.where("status = 'detailed' and scrubbed_at is null").select("record_type").distinct()


def sync_report(plan: DataFrame) -> DataFrame:
    """Rows per action."""
    return plan.groupBy("action").agg(F.count("*").alias("n"))


def section_nulls(parsed: DataFrame) -> DataFrame:
    """How often each section is missing; parsed has id and null_values."""
    return parsed.select("id", F.explode("null_values").alias("section")).groupBy("section").agg(F.count("*").alias("n"), F.min("id").alias("first_id"))
