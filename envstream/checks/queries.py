"""One query per operator. Times are given as unix seconds (``measured_at``), so
no result depends on a time zone setting."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from envstream import schemas as S
from envstream.functions import epoch_seconds, epoch_to_timestamp
from envstream.operators import catalogue as cat
from envstream.operators import clean, encode, keys, metrics, moments, parse, unify
from envstream.plans import derived, model
from envstream.plans.landing import replay_messages
from envstream.plans.replay import replay_to_batches, replay_to_files
from envstream.session import materialise, shared_dir, streaming_session
from envstream.sinks import outputs
from envstream.sources import files, split_documents
from envstream.sources.tables import AIR, LOCATIONS, WEATHER, FolderStore
from envstream.streaming.batch_parts import BatchParts
from envstream.streaming.last_values import LastValues, last_rows
from envstream.streaming.queries import start_files, unified_stream
from envstream.streaming.state import state_rows
from envstream.streaming.table_writer import FACT_ID, TableWriter, read_ledger


def timed(df: DataFrame, *columns: str) -> DataFrame:
    """The columns (default: all) with the time as unix seconds."""
    seconds = f"unix_seconds({S.TIME}) as measured_at"
    return df.selectExpr(*(seconds if c == S.TIME else c for c in columns or df.columns))


def air(spark, sf_dir) -> DataFrame:
    return parse.air_rows(derived.air_messages(spark, sf_dir))


def weather(spark, sf_dir) -> DataFrame:
    return parse.weather_rows(derived.weather_messages(spark, sf_dir))


# --- decoding -------------------------------------------------------------------


def parse_air(spark, sf_dir):
    rows = parse.parse_envelope(derived.air_messages(spark, sf_dir), S.AIR_ENVELOPE)
    info = "entry.air_pollution_info"
    return rows.select(
        epoch_seconds("timestamp").alias("measured_at"),
        "entry.location_id.*", f"{info}.main.aqi", f"{info}.components.*",
    )


def parse_weather(spark, sf_dir):
    rows = parse.parse_envelope(derived.weather_messages(spark, sf_dir), S.WEATHER_ENVELOPE)
    info = "entry.weather_info"
    return rows.select(
        epoch_seconds("timestamp").alias("measured_at"),
        "entry.location_id", f"{info}.main.*", f"{info}.wind.*", f"{info}.clouds.all",
        F.size(f"{info}.weather").alias("n_conditions"),
    )


def flatten_air(spark, sf_dir):
    return timed(air(spark, sf_dir))


def flatten_weather(spark, sf_dir):
    return timed(weather(spark, sf_dir))


def first_description(spark, sf_dir):
    return timed(weather(spark, sf_dir), S.TIME, "location_name", "weather_description")


def epoch_to_ts(spark, sf_dir):
    times = derived.feed(spark, sf_dir).select(
        "topic", "pos", F.col("dt").cast("string").alias("unix_timestamp")
    )
    return times.withColumn("measured_at", epoch_seconds(epoch_to_timestamp("unix_timestamp")))


def rejected_messages(spark, sf_dir):
    """The weather messages, those of errors cut short, those of clicks with a
    key that is no time."""
    text = F.col("value").cast("string")
    broken = (
        F.when(F.col("kind") == "error", F.left(text, F.length(text) - 3))
        .when(F.col("kind") == "click", F.regexp_replace(text, r'^\{"\d+', '{"noon'))
        .otherwise(text)
    )
    sent = derived.weather_messages(spark, sf_dir).select(broken.alias("value"))
    bad = parse.rejects(sent, S.WEATHER_ENVELOPE)
    return bad.groupBy("reason").agg(F.count("*").alias("n_messages"))


# --- cleaning and joining -------------------------------------------------------


def drop_nulls(spark, sf_dir):
    return timed(clean.drop_nulls(weather(spark, sf_dir)))


def batch_distinct(spark, sf_dir):
    return timed(clean.dedup_batch(air(spark, sf_dir)))


def unified(spark, sf_dir):
    return timed(unify.unify(air(spark, sf_dir), weather(spark, sf_dir)))


def label_categories(spark, sf_dir):
    return clean.categories(air(spark, sf_dir), S.LABEL)


def label_category_count(spark, sf_dir):
    return clean.category_count(air(spark, sf_dir), S.LABEL)


def _fetched(spark, sf_dir):
    """Two overlapping fetches; the later one gives temperatures one degree up."""
    rows = derived.raw_weather(spark, sf_dir).select(
        "location_name", "dt", "pos", "copy", F.col("item.main.temp").alias("temp"), "kind"
    )
    early = rows.where(F.col("kind") != "error").withColumn("fetch_no", F.lit(0))
    late = rows.withColumn("temp", F.col("temp") + 1).withColumn("fetch_no", F.lit(1))
    return early.unionByName(late).drop("kind")


def first_per_key(spark, sf_dir):
    return clean.first_per_key(
        _fetched(spark, sf_dir), ["location_name", "dt"], ["fetch_no", "pos", "copy"]
    )


def last_per_name(spark, sf_dir):
    rows = cat.location_table(derived.catalogue(spark, sf_dir))
    return clean.last_per_key(rows, ["name"], ["index"])


#: Delay of the bounded distincts.
DELAY = "2 hours"


# --- streams --------------------------------------------------------------------


def stream_dedup(spark, sf_dir):
    messages = derived.feed(spark, sf_dir).where(F.col("topic") == derived.AIR_TOPIC)
    return timed(
        replay_to_files(spark, messages, lambda m: clean.dedup_global(parse.air_rows(m)))
    )


def stream_dedup_spread(spark, sf_dir):
    """The same result where one message is sent very many times."""
    messages = derived.feed(spark, sf_dir).where(F.col("topic") == derived.AIR_TOPIC)
    times = F.when(F.col("pos") == 1, 2000).otherwise(1)
    messages = messages.withColumn("n", F.explode(F.sequence(F.lit(1), times))).drop("n")

    def build(stream):
        return clean.dedup_spread(parse.air_rows(stream, "message_no"), "message_no")

    return timed(replay_to_files(spark, messages, build, positions=True))


def _dedup_within(dedup, spark, sf_dir, checkpoint=None):
    messages = derived.feed(spark, sf_dir).where(F.col("topic") == derived.AIR_TOPIC)
    return replay_to_files(
        spark, messages, lambda m: dedup(parse.air_rows(m), S.TIME, DELAY), checkpoint=checkpoint)


def stream_dedup_digest(spark, sf_dir):
    return timed(_dedup_within(clean.dedup_digest, spark, sf_dir))


def state_after_replay(spark, sf_dir):
    """How many rows each bounded distinct still remembers when all is taken in: those
    that a copy in time could still meet."""
    found = None
    for name, dedup in (("rows", clean.dedup_global), ("digests", clean.dedup_digest)):
        checkpoint = shared_dir(spark, "state")
        _dedup_within(dedup, spark, sf_dir, checkpoint)
        kept = state_rows(spark, checkpoint).agg(
            F.lit(name).alias("state"), F.count("*").alias("n_rows"))
        found = kept if found is None else found.unionByName(kept)
    return found


def stream_join(spark, sf_dir, slices=4, **how):
    def build(messages):
        return unified_stream(messages, derived.AIR_TOPIC, derived.WEATHER_TOPIC, **how)

    return timed(replay_to_files(spark, derived.feed(spark, sf_dir), build, slices))


def stream_join_bounded(spark, sf_dir):
    return stream_join(spark, sf_dir, delay="2 hours")


def stream_join_spread(spark, sf_dir):
    return stream_join(spark, sf_dir, slices=2, parts=4)


def stream_join_replayed(spark, sf_dir):
    """Raw readings sent as ``replay`` sends them, half a stretch per micro-batch, and
    joined under a watermark that is no longer than a stretch."""
    cores = spark.sparkContext.defaultParallelism
    places = {"location_no": F.lit(0), "item_no": F.col("pos")}
    messages = replay_messages(
        derived.raw_air(spark, sf_dir).withColumns(places),
        derived.raw_weather(spark, sf_dir).withColumns(places),
        derived.AIR_TOPIC, derived.WEATHER_TOPIC, whole=False, spread=2,
    )
    low, high = messages.agg(F.min("dt"), F.max("dt")).first()
    width = ((high - low) // 8 // 3600 + 1) * 3600
    feed, out, state = (shared_dir(spark, p) for p in ("feed", "rows", "state"))
    for part in outputs.in_stretches(messages, width):
        # Two batches a stretch, in no order among themselves, each of a file per core.
        outputs.write_feed(part.repartition(2 * cores, "value"), feed)
    session = streaming_session(spark)
    stream = files.read_feed(session, feed, cores)
    joined = unified_stream(
        stream, derived.AIR_TOPIC, derived.WEATHER_TOPIC, delay=f"{width} seconds")
    start_files(joined, out, state, drain=True).awaitTermination()
    return timed(spark.read.parquet(out))


def stream_last_per_key(spark, sf_dir):
    """The last weather reading of every location, kept up to date over four runs on
    one checkpoint."""
    keys_, order = ["location_name"], [S.TIME]
    messages = derived.feed(spark, sf_dir).where(F.col("topic") == derived.WEATHER_TOPIC)
    kept = LastValues(shared_dir(spark, "last"), tuple(keys_))
    replay_to_batches(
        spark, messages, lambda m: last_rows(parse.weather_rows(m), keys_, order), kept.write,
        mode="update")
    return timed(kept.read(spark), *S.WEATHER_COLUMNS)


def ledger_after_crash(spark, sf_dir):
    """What the ledger says where every batch is written, breaks off before its ledger
    entry, and is run again."""
    store = FolderStore(spark, shared_dir(spark, "tables")).create()
    ledger = shared_dir(spark, "ledger")
    first = TableWriter(store, derived.AIR_TOPIC, derived.WEATHER_TOPIC)
    again = TableWriter(store, derived.AIR_TOPIC, derived.WEATHER_TOPIC, ledger=ledger)

    def handle(batch, batch_id):
        with first.readings(batch) as readings:
            first.write(readings, batch_id)
            again.write(readings, batch_id)

    replay_to_batches(spark, derived.feed(spark, sf_dir), lambda m: m, handle)
    return read_ledger(spark, ledger).drop("job")


def _streamed_tables(spark, sf_dir):
    store = FolderStore(spark, shared_dir(spark, "tables")).create()
    writer = TableWriter(store, derived.AIR_TOPIC, derived.WEATHER_TOPIC)
    replay_to_batches(spark, derived.feed(spark, sf_dir), lambda m: m, writer)
    return store


def stream_facts(spark, sf_dir):
    store = _streamed_tables(spark, sf_dir)
    named = store.read(AIR).join(store.read(LOCATIONS), "location_id")
    return timed(named, "location_name", S.TIME, *S.AIR_MEASURES)


def stream_weather_facts(spark, sf_dir):
    store = _streamed_tables(spark, sf_dir)
    named = store.read(WEATHER).join(store.read(LOCATIONS), "location_id")
    return timed(named, "location_name", S.TIME, *S.WEATHER_MEASURES)


def stream_two_writers(spark, sf_dir):
    """Keys and facts where each topic has a writer of its own on the same tables."""
    store = FolderStore(spark, shared_dir(spark, "tables"), keyed=True).create()
    of_air = TableWriter(store, derived.AIR_TOPIC, "", "air")
    of_weather = TableWriter(store, "", derived.WEATHER_TOPIC, "weather")

    def handle(batch, batch_id):
        of_weather(batch, batch_id)
        of_air(batch, batch_id)

    replay_to_batches(spark, derived.feed(spark, sf_dir), lambda m: m, handle)
    found = store.read(LOCATIONS).select("location_id", "location_name")
    for name, label in ((AIR, "air"), (WEATHER, "weather")):
        facts = store.read(name).groupBy("location_id").agg(
            F.count("*").alias(f"{label}_facts"),
            F.min(FACT_ID[name]).cast("string").alias(f"first_{label}_id"))
        found = found.join(facts, "location_id", "left").fillna(0, [f"{label}_facts"])
    return found


def stream_locations(spark, sf_dir):
    located = _streamed_tables(spark, sf_dir).read(LOCATIONS)
    return located.select("location_name", "longitude", "latitude")


# --- tables ---------------------------------------------------------------------


def dim_locations(spark, sf_dir):
    named = materialise(keys.batch_locations(air(spark, sf_dir), weather(spark, sf_dir)))
    return keys.number_rows(named, "location_name", 0, "location_id")


def scan_locations(spark, sf_dir):
    store = FolderStore(spark, shared_dir(spark, "tables")).create()
    store.append(LOCATIONS, dim_locations(spark, sf_dir).select(
        "location_id", "location_name", "longitude", "latitude"
    ))
    return store.read(LOCATIONS)


def _facts(readings, locations, measures, id_column):
    keyed = readings.dropna(subset=list(S.JOIN_KEYS))
    first = clean.first_per_key(keyed, S.JOIN_KEYS, measures)
    return keys.fact_rows(first, locations, measures, id_column)


def _fact_air(spark, sf_dir, locations=None):
    known = dim_locations(spark, sf_dir) if locations is None else locations
    return _facts(air(spark, sf_dir), known, S.AIR_MEASURES, FACT_ID[AIR])


def fact_air(spark, sf_dir):
    return timed(_fact_air(spark, sf_dir))


def fact_weather(spark, sf_dir):
    known = dim_locations(spark, sf_dir)
    return timed(_facts(weather(spark, sf_dir), known, S.WEATHER_MEASURES, FACT_ID[WEATHER]))


def facts_ordered(spark, sf_dir):
    return timed(keys.in_time_order(_fact_air(spark, sf_dir)))


def fk_orphans(spark, sf_dir):
    """Pollution facts left without a location by a dimension that holds only
    users who are suppliers too."""
    known = dim_locations(spark, sf_dir)
    suppliers = spark.read.parquet(f"{sf_dir}/supplier.parquet").select(
        F.expr("concat('loc_', cast(s_suppkey as string))").alias("location_name")
    )
    partial = known.join(suppliers, "location_name", "left_semi")
    return timed(keys.orphans(_fact_air(spark, sf_dir, known), partial), "location_id", S.TIME)


def insert_if_absent(spark, sf_dir):
    """What a second load of all pollution readings adds to a table that has the
    views and clicks."""
    rows = derived.raw_air(spark, sf_dir).select(
        "location_name", "dt", F.col("item.components.co").alias("co"), "pos", "kind"
    )
    existing = rows.where(F.col("kind").isin("view", "click"))
    return keys.insert_if_absent(
        existing, rows.drop("kind"), ["location_name", "dt"], ["co", "pos"]
    )


# --- encoding -------------------------------------------------------------------


def _air_groups(spark, sf_dir):
    rows = derived.raw_air(spark, sf_dir).withColumn("entry", encode.air_entry())
    return encode.regroup(rows, ["dt"], "entry", ["pos", "copy"], encode.span_of())


def _weather_groups(spark, sf_dir):
    rows = derived.raw_weather(spark, sf_dir).withColumn("entry", encode.weather_entry())
    return encode.regroup(rows, ["dt"], "entry", ["pos", "copy"], encode.span_of())


def _unlisted(groups, *extra):
    return groups.select(
        "dt", "stretch", "chunk", *extra, F.posexplode("entries").alias("entry_no", "entry")
    )


def regroup_air(spark, sf_dir):
    rows = _unlisted(_air_groups(spark, sf_dir))
    info = "entry.air_pollution_info"
    return rows.select(
        "dt", "stretch", "chunk", "entry_no", "entry.location_id.*", f"{info}.main.aqi",
        f"{info}.components.*",
    )


def regroup_weather(spark, sf_dir):
    rows = _unlisted(_weather_groups(spark, sf_dir))
    info = "entry.weather_info"
    return rows.select(
        "dt", "stretch", "chunk", "entry_no", "entry.location_id", f"{info}.main.temp",
        f"{info}.wind.gust", f"{info}.clouds.all", F.size(f"{info}.weather").alias("n_conditions"),
    )


def key_union(spark, sf_dir):
    return encode.key_union(derived.raw_air(spark, sf_dir), derived.raw_weather(spark, sf_dir))


def timestamp_count(spark, sf_dir):
    return encode.timestamp_count(key_union(spark, sf_dir))


def first_n_timestamps(spark, sf_dir):
    return encode.first_timestamps(key_union(spark, sf_dir), 10)


def align_topics(spark, sf_dir):
    """Messages of both topics side by side: how many entries each holds."""
    aligned = encode.align(_air_groups(spark, sf_dir), _weather_groups(spark, sf_dir))
    return aligned.select(
        "dt", "stretch", "chunk",
        F.size("air_entries").alias("n_air"), F.size("weather_entries").alias("n_weather"),
        F.array_join("air_entries.location_id.location_name", ",").alias("air_names"),
        F.array_join("weather_entries.location_id", ",").alias("weather_names"),
    ).orderBy("dt", "stretch", "chunk")


def encode_roundtrip(spark, sf_dir):
    """All weather readings grouped, encoded to messages, decoded and flattened."""
    messages = encode.encode(_weather_groups(spark, sf_dir))
    return timed(parse.weather_rows(messages))


def encode_roundtrip_air(spark, sf_dir):
    messages = encode.encode(_air_groups(spark, sf_dir))
    return timed(parse.air_rows(messages))


def scan_map_json(spark, sf_dir):
    """Pollution readings written as raw documents by location, and read back."""
    rows = derived.raw_air(spark, sf_dir)
    path = shared_dir(spark, "raw-air")
    lines = outputs.raw_lines(
        rows, coord="coord", order=("pos", "copy"), stretch=encode.span_of()
    )
    outputs.write_lines(lines, path)
    back = files.scan_raw_air(spark, path, whole=False)
    return back.select(
        "location_name", "coord.lon", "coord.lat", "item_no", "item.dt", "item.main.aqi",
        "item.components.*",
    )


#: Split size of the queries over one document; small, so that small tables are split too.
DOCUMENT_SPLIT = 1 << 18


def scan_map_document(spark, sf_dir):
    """Pollution readings as ONE document in one file, read by many tasks. Names hold
    braces, quotes and escapes."""
    name = F.concat(F.lit('{"'), "location_name", F.lit("}\\"))
    rows = derived.raw_air(spark, sf_dir).withColumn("location_name", name)
    lines = outputs.raw_lines(rows, coord="coord", order=("pos", "copy"), stretch=encode.span_of())
    entry = lines.select(F.expr("substring(value, 2, length(value) - 2)").alias("value"))
    path = shared_dir(spark, "air-document")
    outputs.write_document(entry, path, ["value"], "{", "}")
    back = split_documents.scan_raw_air_document(spark, path, DOCUMENT_SPLIT)
    return back.select(
        "location_name", "coord.lon", "coord.lat", "item_no", "item.dt", "item.main.aqi",
        "item.components.*",
    )


def scan_array_document(spark, sf_dir):
    """Customers as ONE array in one file, read by many tasks; ``index`` is the place
    in the whole array."""
    name = F.concat("name", F.lit('}, {"'))
    rows = derived.catalogue(spark, sf_dir).withColumn("name", name)
    lines = rows.select("id", F.to_json(F.struct("id", "name", "country", "coord")).alias("value"))
    path = shared_dir(spark, "catalogue-document")
    outputs.write_document(lines, path, ["id"], "[", "]")
    back = split_documents.scan_array_document(spark, path, S.CATALOGUE_RECORD, DOCUMENT_SPLIT)
    return back.select("index", "id", "name", "country", "coord.lon", "coord.lat")


def scan_name_line(spark, sf_dir):
    """All suppliers' names as ONE line in one file, read by many tasks."""
    path = shared_dir(spark, "name-line")
    outputs.write_document(derived.name_texts(spark, sf_dir), path, ["list_no"], "", None, " ", ",")
    return split_documents.scan_name_line(spark, path, 1 << 10)


# --- catalogue ------------------------------------------------------------------


def scan_catalogue(spark, sf_dir):
    """Customers written as arrays of 1000 neighbours each, and read back."""
    rows = derived.catalogue(spark, sf_dir)
    record = F.struct("id", "name", "country", "coord")
    arrays = rows.groupBy(F.floor(F.col("id") / 1000).alias("part")).agg(
        F.sort_array(F.collect_list(record)).alias("records")
    )
    path = shared_dir(spark, "catalogue")
    outputs.write_lines(arrays.select(F.to_json("records").alias("value")), path)
    back = files.scan_catalogue(spark, path, whole=False)
    return back.select("index", "id", "name", "country", "coord.lon", "coord.lat")


def _names(spark, sf_dir):
    return cat.name_list(derived.name_texts(spark, sf_dir))


def name_list(spark, sf_dir):
    return _names(spark, sf_dir)


def catalogue_by_country(spark, sf_dir):
    return cat.in_country(derived.catalogue(spark, sf_dir), "FURNITURE").select(
        "id", "name", "country"
    )


def catalogue_semi(spark, sf_dir):
    rows = derived.catalogue(spark, sf_dir)
    return cat.named_in(rows, _names(spark, sf_dir)).select("id", "name", "country")


def locations(spark, sf_dir):
    chosen = cat.in_country(derived.catalogue(spark, sf_dir), "FURNITURE")
    return cat.location_table(cat.named_in(chosen, _names(spark, sf_dir)))


def fetch_plan(spark, sf_dir):
    table = cat.location_table(derived.catalogue(spark, sf_dir)).drop("index")
    return cat.fetch_plan(table, "2024-01-01 00:00:00", weeks=9)


def nonempty_locations(spark, sf_dir):
    """One answer per event: errors have no list, clicks an empty one."""
    answers = derived.events(spark, sf_dir, "event_id", "ts", "user_id", "event_type").select(
        F.col("event_id").alias("answer_no"),
        F.expr(derived.LOCATION).alias("location_name"),
        F.when(F.col("event_type") == "click", F.array().cast("array<bigint>"))
        .when(F.col("event_type") != "error", F.array(derived.hour_of()))
        .alias("list"),
    )
    kept = cat.with_readings(answers)
    return kept.select("answer_no", "location_name", F.col("list")[0].alias("dt"))


# --- model ----------------------------------------------------------------------


def _unified(spark, sf_dir):
    return unify.unify(air(spark, sf_dir), weather(spark, sf_dir))


def scaled_features(spark, sf_dir):
    rows = materialise(_unified(spark, sf_dir))
    scaled = timed(model.scaled_columns(rows))
    return scaled.select(
        *(F.round(c, 6).alias(c) if c.startswith("scaled_") else c for c in scaled.columns)
    )


def _write_twice(parts, part, batch_id):
    """A batch that is run again counts once. Its part is kept in between: each look at a
    batch goes through the state of the stream anew."""
    part.persist()
    try:
        for _ in range(2):
            parts.write(part, batch_id)
    finally:
        part.unpersist()


def scaled_from_history(spark, sf_dir):
    """All joined readings scaled by what the batches of a stream left by day."""
    parts = BatchParts(shared_dir(spark, "moments"), moments.MOMENTS)

    def build(messages):
        return unified_stream(messages, derived.AIR_TOPIC, derived.WEATHER_TOPIC)

    def keep(batch, batch_id):
        _write_twice(parts, moments.day_moments(batch), batch_id)

    replay_to_batches(spark, derived.feed(spark, sf_dir), build, keep, slices=2)
    known = moments.history(parts.read(spark))
    scaled = timed(moments.scaled_by(_unified(spark, sf_dir), known))
    return scaled.select(
        *(F.round(c, 6).alias(c) if c.startswith("scaled_") else c for c in scaled.columns)
    )


def split_counts(spark, sf_dir):
    part = F.when(model.in_training(), "train").otherwise("test").alias("part")
    return _unified(spark, sf_dir).groupBy(part).agg(F.count("*").alias("n_rows"))


def rf_predictions(spark, sf_dir):
    rows = materialise(_unified(spark, sf_dir))
    _, pairs = model.fit_and_score(rows)
    return pairs


def rf_metrics(spark, sf_dir):
    return metrics.regression_metrics(rf_predictions(spark, sf_dir))


def rf_checks(spark, sf_dir):
    """What must hold of the forest: a prediction per test row, all inside the range
    of the labels, and closer to them than their mean."""
    rows = materialise(_unified(spark, sf_dir))
    low, high, mean = rows.where(model.in_training()).agg(
        F.min(S.LABEL), F.max(S.LABEL), F.avg(S.LABEL)).first()
    _, pairs = model.fit_and_score(rows)
    guess, label = F.col("prediction"), F.col("label")
    return pairs.agg(
        F.count("*").alias("n_rows"),
        F.bool_and(guess.between(low, high)).alias("in_range"),
        (F.sum((guess - label) ** 2) < F.sum((F.lit(mean) - label) ** 2)).alias("beats_mean"),
    )


def _guessed(rows):
    guess = F.least(F.lit(5.0), F.lit(1.0) + F.col("co") / F.lit(100.0))
    return metrics.prediction_pairs(rows.withColumn("prediction", guess))


def _pairs(spark, sf_dir):
    """Pairs with a fixed prediction rule, so that SQL can follow."""
    return _guessed(air(spark, sf_dir))


def _score_history(spark, sf_dir):
    """Score parts of a stream whose every batch is run twice."""
    parts = BatchParts(shared_dir(spark, "scores"), metrics.SCORE_PARTS)
    messages = derived.feed(spark, sf_dir).where(F.col("topic") == derived.AIR_TOPIC)

    def keep(batch, batch_id):
        _write_twice(parts, metrics.score_parts(batch), batch_id)

    replay_to_batches(spark, messages, lambda m: _guessed(parse.air_rows(m)), keep)
    return parts.read(spark)


def metrics_overall(spark, sf_dir):
    return _rounded(metrics.metrics_of_parts(_score_history(spark, sf_dir)))


def confusion_overall(spark, sf_dir):
    return metrics.cells_of_parts(_score_history(spark, sf_dir))


def prediction_pairs(spark, sf_dir):
    return _pairs(spark, sf_dir)


def _rounded(df):
    return df.select(*(F.round(c, 9).alias(c) if t == "double" else c for c, t in df.dtypes))


def regression_metrics(spark, sf_dir):
    return _rounded(metrics.regression_metrics(_pairs(spark, sf_dir)))


def confusion_matrix(spark, sf_dir):
    return metrics.confusion_counts(_pairs(spark, sf_dir))


def metrics_row(spark, sf_dir):
    path = shared_dir(spark, "metrics")
    outputs.write_metrics(model.metrics_for(_pairs(spark, sf_dir), 3), path)
    return _rounded(outputs.read_metrics(spark, path))


QUERIES = (
    parse_air, parse_weather, flatten_air, flatten_weather, first_description, epoch_to_ts,
    rejected_messages, drop_nulls, batch_distinct, unified, label_categories,
    label_category_count, first_per_key, last_per_name, stream_dedup, stream_dedup_spread,
    stream_dedup_digest, state_after_replay, stream_join,
    stream_join_bounded, stream_join_spread, stream_join_replayed, stream_facts,
    stream_weather_facts, stream_two_writers, stream_locations, stream_last_per_key, ledger_after_crash, dim_locations, scan_locations,
    fact_air, fact_weather, facts_ordered, fk_orphans, insert_if_absent, regroup_air,
    regroup_weather, key_union, timestamp_count, first_n_timestamps, align_topics,
    encode_roundtrip, encode_roundtrip_air, scan_map_json, scan_map_document,
    scan_array_document, scan_name_line, scan_catalogue, name_list, catalogue_by_country,
    catalogue_semi, locations, fetch_plan, nonempty_locations, scaled_features,
    scaled_from_history, split_counts,
    rf_predictions, rf_metrics, rf_checks, prediction_pairs, regression_metrics, confusion_matrix,
    metrics_row, metrics_overall, confusion_overall,
)


def registered():
    return {query.__name__: query for query in QUERIES}
