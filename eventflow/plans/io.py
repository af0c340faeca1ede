"""Source / sink round trips over data derived from the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from eventflow.plans.registry import query
from eventflow.plans.sqlviews import CART
from eventflow.session import scratch_path
from eventflow.sinks import upsert
from eventflow.sinks.files import to_text_stream, write_text
from eventflow.sinks.rich import LineFileSink, run_rich_sink
from eventflow.sources.tables import read_table
from eventflow.sources.views import cart_events
from eventflow.streaming.replay import line_text_stream, replay
from eventflow.streaming.runner import run_available_now, run_foreach_batch

LINES_SQL = f"""SELECT CAST(event_id AS VARCHAR) || ',' || CAST(user_id AS VARCHAR) || ',' || sku AS value
FROM {CART}"""


def _lines(df):
    return df.select(F.concat_ws(",", F.col("event_id").cast("string"),
                                 F.col("user_id").cast("string"), F.col("sku")).alias("value"))


@query("text_sink_roundtrip", LINES_SQL)
def text_sink_roundtrip(spark, sf):
    """K3: cart events as lines through the streaming text sink, read back."""
    path = scratch_path(spark, "text_sink")
    q = to_text_stream(_lines(cart_events(replay(spark, sf))), path, path + "__checkpoint",
                       available_now=True)
    q.awaitTermination()
    return spark.read.text(path)


def _write_line_files(spark, sf, name):
    src = scratch_path(spark, name)
    write_text(_lines(cart_events(read_table(spark, sf, "events"))), src)
    return src


@query("custom_sink_roundtrip", LINES_SQL)
def custom_sink_roundtrip(spark, sf):
    """K7: a user-defined sink: a function of (micro-batch, id) that writes the
    batch idempotently under its id, read back."""
    def sink(batch, batch_id, path):
        batch.write.mode("overwrite").text(f"{path}/batch_id={batch_id}")
    path = run_foreach_batch(_lines(cart_events(replay(spark, sf))), "custom_sink", sink)
    return spark.read.text(path).select("value")


@query("rich_sink_roundtrip", LINES_SQL)
def rich_sink_roundtrip(spark, sf):
    """K7: a per-row sink with open, process and close, each partition of an epoch published once, read back."""
    path = scratch_path(spark, "rich_sink")
    rows = cart_events(replay(spark, sf)).select("event_id", "user_id", "sku")
    run_rich_sink(rows, LineFileSink(path, lambda r: f"{r.event_id},{r.user_id},{r.sku}"), path + "__checkpoint")
    return spark.read.text(path)


@query("line_source", LINES_SQL)
def line_source(spark, sf):
    """A user's line source: the text stream with the user's own decoding
    of each line (here: fields split off and joined again)."""
    src = _write_line_files(spark, sf, "line_source_src")
    fields = F.split("value", ",")
    lines = line_text_stream(spark, src).select(fields[0].cast("long").alias("event_id"), fields[1].alias("user_id"), fields[2].alias("sku"))
    return run_available_now(lines, "line_source").select(F.concat_ws(",", "event_id", "user_id", "sku").alias("value"))


@query("line_text_source", LINES_SQL)
def line_text_source(spark, sf):
    """One row per newline-terminated line of a text stream."""
    src = _write_line_files(spark, sf, "line_text_src")
    return run_available_now(line_text_stream(spark, src), "line_text_source")


@query("upsert_latest", """SELECT name, age FROM (
  SELECT 'u' || CAST(user_id AS VARCHAR) AS name,
         CAST(json_extract_string(props, '$.k') AS INTEGER) AS age,
         row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn
  FROM events) WHERE rn = 1""")
def upsert_latest(spark, sf):
    """K6: people upserted by name in two batches (first half of the time
    range, then the rest); the table keeps the latest row per name."""
    ev = read_table(spark, sf, "events")
    people = ev.select(F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("name"),
                       F.get_json_object("props", "$.k").cast("int").alias("age"), "ts", "event_id")
    span = ev.agg(F.min("ts").alias("lo"), F.max("ts").alias("hi")).first()
    mid = F.lit(span["lo"] + (span["hi"] - span["lo"]) / 2) if span["lo"] else F.lit(None).cast("timestamp_ntz")
    path = scratch_path(spark, "upsert_people")
    upsert.upsert_latest(spark, path, people.filter(F.col("ts") < mid), ["name"], ["ts", "event_id"])
    upsert.upsert_latest(spark, path, people.filter(F.col("ts") >= mid), ["name"], ["ts", "event_id"])
    return upsert.read_latest(spark, path).select("name", "age")
