"""Streaming queries: the T forms run on the replayed ``events`` table and
are checked with the SAME SQL as their batch forms."""

from __future__ import annotations

from pyspark.sql import functions as F

from eventflow import schemas as S
from eventflow.functions.time import epoch_us, to_ntz
from eventflow.operators.windows import arrival_time_count, session_count_native, with_event_time
from eventflow.plans.registry import ORACLE, query
from eventflow.plans.sqlviews import CART, HOUR, SERVER, ts_of, wstart
from eventflow.session import scratch_path
from eventflow.sources.tables import read_table
from eventflow.sources.views import cart_events, catalog_events, rules_from_events, server_events
from eventflow.operators.aggregate import CountIf
from eventflow.streaming import connected, forms, keyed
from eventflow.streaming.replay import replay, replay_dir, write_time_slice
from eventflow.streaming.runner import run_available_now, run_foreach_batch


def _stream(spark, sf):
    return replay(spark, sf, "events", max_files_per_trigger=1)


def _read_batches(spark, path):
    return spark.read.parquet(path).drop("batch_id")


@query("stream_running_count", ORACLE["running_count"])
def stream_running_count(spark, sf):
    """A4 T form: bucketed running sums of each micro-batch, counts per user carried."""
    path = run_foreach_batch(_stream(spark, sf), "stream_running_count", keyed.running_count_fn(cart_events))
    return _read_batches(spark, path).select("event_id", "user_id", "n")


@query("stream_type_counts", ORACLE["running_type_counts"])
def stream_type_counts(spark, sf):
    """A5 T form: one carried count per user and event type."""
    path = run_foreach_batch(_stream(spark, sf), "stream_type_counts", keyed.type_counts_fn(cart_events))
    return _read_batches(spark, path).select("event_id", "user_id", "n_add", "n_removed")


@query("stream_list_size", ORACLE["running_list_size"])
def stream_list_size(spark, sf):
    """A6 T form: size of each user's list, carried."""
    path = run_foreach_batch(_stream(spark, sf), "stream_list_size", keyed.running_count_fn(cart_events))
    return _read_batches(spark, path).select("event_id", "user_id", "n")


@query("stream_count_with_reset", ORACLE["count_with_reset"])
def stream_count_with_reset(spark, sf):
    """A8 T form: list cleared past 10, its adds carried."""
    path = run_foreach_batch(_stream(spark, sf), "stream_count_with_reset", keyed.running_count_fn(cart_events, limit=10))
    return _read_batches(spark, path).select("event_id", "user_id", "n")


@query("stream_high_quantity", ORACLE["high_quantity_counts"])
def stream_high_quantity(spark, sf):
    """A9 T form: filter, then a carried count per user."""
    path = run_foreach_batch(_stream(spark, sf), "stream_high_quantity", keyed.high_quantity_fn(cart_events, 5))
    return _read_batches(spark, path).select("event_id", "user_id", "n")


@query("stream_running_share", ORACLE["running_share"])
def stream_running_share(spark, sf):
    """A10 T form: per micro-batch bucketed prefix + carried counts."""
    fn = forms.carried_batch_fn(forms.running_share_batch, ["n_left", "n_right"])
    path = run_foreach_batch(_stream(spark, sf), "stream_running_share", fn)
    return _read_batches(spark, path).select("event_id", "share")


@query("stream_count_windows", ORACLE["global_count_windows"])
def stream_count_windows(spark, sf):
    """W8 T form: count-triggered global window, carried counts."""
    fn = forms.carried_batch_fn(forms.count_windows_batch, ["rows", "hits"], every=10)
    path = run_foreach_batch(_stream(spark, sf), "stream_count_windows", fn)
    return _read_batches(spark, path).select("firing_no", "n")


@query("stream_early_count", ORACLE["early_count"])
def stream_early_count(spark, sf):
    """W10 T form: count trigger per 1-hour window, counts of open windows carried."""
    path = run_foreach_batch(_stream(spark, sf), "stream_early_count", forms.early_count_fn("1 hour", 5))
    return forms.early_count_output(_read_batches(spark, path))


@query("stream_early_count_purging", ORACLE["early_count_purging"])
def stream_early_count_purging(spark, sf):
    """W11 T form."""
    path = run_foreach_batch(_stream(spark, sf), "stream_early_count_purging", forms.early_count_fn("1 hour", 5, purge=True))
    return forms.early_count_output(_read_batches(spark, path))


@query("stream_rolling_sum", ORACLE["rolling_sum"])
def stream_rolling_sum(spark, sf):
    """A1 T form: running sum of quantity per user, sums carried."""
    path = run_foreach_batch(_stream(spark, sf), "stream_rolling_sum", keyed.rolling_sum_fn(cart_events, "quantity"))
    return _read_batches(spark, path).select("event_id", "user_id", "running")


@query("stream_final_sum", ORACLE["final_sum"])
def stream_final_sum(spark, sf):
    """A2 T form: update mode; each key's newest micro-batch holds its total."""
    def fn(batch, batch_id, path):
        batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")
    s = forms.stream_final_sum(cart_events(_stream(spark, sf)), "quantity")
    path = run_foreach_batch(s, "stream_final_sum", fn, output_mode="update")
    return spark.read.parquet(path).groupBy("user_id").agg(F.max_by("total", "batch_id").alias("total"))


@query("stream_side_output", ORACLE["side_output"])
def stream_side_output(spark, sf):
    """R5 T form: main and side output of every micro-batch written in one pass."""
    path = run_foreach_batch(_stream(spark, sf), "stream_side_output", forms.side_output_fn(F.col("user_id") == 1, cart_events))
    return spark.read.parquet(path).groupBy("route").agg(F.count(F.lit(1)).alias("n"))


@query("stream_window_join", ORACLE["window_join"])
def stream_window_join(spark, sf):
    """J2 T form: stream-stream join on user and 6-hour window."""
    left = (cart_events(_stream(spark, sf)).filter(F.col("event_type") == S.ADD)
            .select(F.col("event_id").alias("left_id"), "user_id", "ts"))
    right = (catalog_events(_stream(spark, sf))
             .select(F.col("event_id").alias("right_id"), F.col("user_id").alias("r_user_id"), "ts"))
    return run_available_now(forms.stream_window_join(left, right, "6 hours"), "stream_window_join")


@query("stream_session_by_user", f"""SELECT * FROM ({ORACLE["session_by_user"]})
WHERE epoch_us(window_end) <= (SELECT max(epoch_us(ts)) FROM {SERVER}) - 500000""")
def stream_session_by_user(spark, sf):
    """W7 T form: keyed session windows, emitted when the watermark passes their end."""
    s = with_event_time(server_events(_stream(spark, sf)), "ts", "500 milliseconds")
    g = session_count_native(s, "6 hours", keys=["player_id"], ts="event_time")
    g = g.select("player_id", to_ntz("window_start").alias("window_start"), to_ntz("window_end").alias("window_end"), "n")
    return run_available_now(g, "stream_session_by_user")


@query("stream_count_windows_purging", ORACLE["global_count_windows_purging"])
def stream_count_windows_purging(spark, sf):
    """W8 T form, purging: registrations in each block of 10 events."""
    fn = forms.carried_batch_fn(forms.purged_windows_batch, ["rows", "open_hits"], every=10)
    path = run_foreach_batch(_stream(spark, sf), "stream_count_windows_purging", fn)
    return _read_batches(spark, path).select("firing_no", "n")


@query("stream_interval_join", ORACLE["interval_join"])
def stream_interval_join(spark, sf):
    """J3 T form: stream-stream join with watermarks and the range condition."""
    left = (cart_events(_stream(spark, sf)).filter(F.col("event_type") == S.ADD)
            .select(F.col("event_id").alias("left_id"), "user_id", "ts"))
    right = (catalog_events(_stream(spark, sf))
             .select(F.col("event_id").alias("right_id"), F.col("user_id").alias("r_user_id"), "ts"))
    j = forms.stream_interval_join(left, right, "-2 hours", "2 hours",
                                   lower_inclusive=False, upper_inclusive=False)
    return run_available_now(j, "stream_interval_join")


@query("stream_changing_threshold", ORACLE["changing_threshold"])
def stream_changing_threshold(spark, sf):
    """J6 T form: each micro-batch reads the rules of its own time span."""
    fn = forms.changing_threshold_fn(lambda sp: rules_from_events(read_table(sp, sf, "events")))
    path = run_foreach_batch(_stream(spark, sf), "stream_changing_threshold", fn)
    return _read_batches(spark, path)


@query("stream_tumbling_append", f"""SELECT * FROM (
  SELECT {ts_of('ws')} AS window_start, {ts_of(f'ws + {HOUR}')} AS window_end,
         count(*) FILTER (WHERE event_type = 'PlayerRegistered') AS n
  FROM (SELECT *, {wstart('epoch_us(ts)', HOUR)} AS ws FROM {SERVER}) GROUP BY ws)
WHERE epoch_us(window_end) <= (SELECT max(epoch_us(ts)) FROM {SERVER}) - 500000""")
def stream_tumbling_append(spark, sf):
    """S8 + W1 + W12: append-mode windows, emitted when the watermark
    (max event time - 500 ms) passes their end; the last open window of a
    bounded replay is not emitted (see ``windows.drain_windows``)."""
    s = forms.stream_tumbling_count(server_events(_stream(spark, sf)), "1 hour",
                                    F.col("event_type") == S.REGISTERED)
    return run_available_now(s, "stream_tumbling_append")


@query("stream_restart", ORACLE["running_count"])
def stream_restart(spark, sf):
    """The A4 stream stopped after the first half of the data and
    restarted from its checkpoint on the second half; counts continue."""
    ev = read_table(spark, sf, "events")
    span = ev.agg(F.min(epoch_us("ts", ev)).alias("lo"), F.max(epoch_us("ts", ev)).alias("hi")).collect()[0]
    mid = (int(span["lo"]) + int(span["hi"])) // 2
    src = scratch_path(spark, "stream_restart_src")
    out = scratch_path(spark, "stream_restart_out")
    ckpt = out + "__checkpoint"
    for lo, hi in ((None, mid), (mid, None)):
        write_time_slice(ev, src, lo, hi)
        s = forms.stream_running_count(cart_events(replay_dir(spark, src, ev.schema)))
        res = run_available_now(s, "stream_restart", path=out, checkpoint=ckpt)
    return res.select("event_id", "user_id", "n")


@query("stream_arrival_window", f"SELECT count(*) AS n FROM {CART}")
def stream_arrival_window(spark, sf):
    """Processing-time (arrival) tumbling windows, update mode. Which
    window a row falls in depends on the clock; that every row is counted in
    one does not, so the newest counts of all windows are summed."""
    g = arrival_time_count(cart_events(_stream(spark, sf)), "1 hour").select("window_start", "n")

    def fn(batch, batch_id, path):
        batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")
    path = run_foreach_batch(g, "stream_arrival_window", fn, output_mode="update")
    newest = spark.read.parquet(path).groupBy("window_start").agg(F.max_by("n", "batch_id").alias("n"))
    return newest.agg(F.sum("n").alias("n"))


@query("stream_connected_state", ORACLE["connected_state"])
def stream_connected_state(spark, sf):
    """J4 T form: one state program per user over cart and catalog events, a state per side."""
    ev = _stream(spark, sf)
    out = connected.stream_connect_keyed(cart_events(ev), catalog_events(ev), "user_id", connected.SideShare())
    return run_available_now(out, "stream_connected_state").select("event_id", "user_id", "side", "share")


@query("stream_retained_count", f"""SELECT r.* FROM ({ORACLE["retained_count"]}) r JOIN {CART} c USING (event_id)
WHERE epoch_us(c.ts) <= (SELECT max(epoch_us(ts)) FROM {CART}) - {HOUR}""")
def stream_retained_count(spark, sf):
    """A7 T form in event time: rows younger than 1 hour, emitted when the watermark (1 hour behind) passes."""
    fn = keyed.retained_count_fn(cart_events, "user_id", "1 hour", "1 hour")
    path = run_foreach_batch(_stream(spark, sf), "stream_retained_count", fn)
    return _read_batches(spark, path).select("event_id", "user_id", "n")


@query("stream_registrations_agg", f"""SELECT * FROM ({ORACLE["registrations_agg_udaf"]})
WHERE epoch_us(window_end) <= (SELECT max(epoch_us(ts)) FROM {SERVER}) - 500000""")
def stream_registrations_agg(spark, sf):
    """A3 / W14 T form: a user accumulator per window, carried until the watermark closes it."""
    fn = keyed.window_aggregate_fn(server_events, "1 hour", CountIf("event_type", S.REGISTERED, "n"))
    path = run_foreach_batch(_stream(spark, sf), "stream_registrations_agg", fn)
    return _read_batches(spark, path).select("window_start", "window_end", "n")


@query("stream_session_registrations", f"""SELECT * FROM ({ORACLE["session_registrations"]})
WHERE epoch_us(window_end) <= (SELECT max(epoch_us(ts)) FROM {SERVER}) - 500000""")
def stream_session_registrations(spark, sf):
    """W7 T form without a key: bucketed sessions per micro-batch, open sessions carried."""
    fn = keyed.session_count_fn(server_events, "10 minutes", F.col("event_type") == S.REGISTERED)
    path = run_foreach_batch(_stream(spark, sf), "stream_session_registrations", fn)
    return _read_batches(spark, path).select("window_start", "window_end", "n")


@query("stream_busiest_window", ORACLE["busiest_window"])
def stream_busiest_window(spark, sf):
    """W13 T form: the best 2 h / 1 h window after each micro-batch; the newest answer."""
    fn = keyed.busiest_window_fn(server_events, "2 hours", "1 hour", F.col("event_type") == S.REGISTERED)
    path = run_foreach_batch(_stream(spark, sf), "stream_busiest_window", fn)
    out = spark.read.parquet(path)
    newest = out.groupBy().agg(F.max_by(F.struct("window_start", "window_end", "n"), "batch_id").alias("r"))
    return newest.where("r IS NOT NULL").select("r.*")
