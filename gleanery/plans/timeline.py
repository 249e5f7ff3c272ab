"""Queries of tracks, as-of lookups, ledgers, runs and streams."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..functions import keys as K
from ..operators import ledger, lookups, tracks
from ..session import scratch_root
from ..streaming import incremental
from .common import KEYS, keyframes, table

_V = ("x", "y")


def interpolate_closed(spark, sf_dir):
    return tracks.interpolate_closed(keyframes(spark, sf_dir), "user_id", _V, "event_id")


_LEAD = f"SELECT *, lead(frame) OVER w AS f2, lead(enabled) OVER w AS e2, lead(x) OVER w AS x2, lead(y) OVER w AS y2 FROM ({KEYS}) WINDOW w AS (PARTITION BY user_id ORDER BY frame, event_id)"
_VALUE = lambda c: f"CASE WHEN f2 IS NULL OR f2 <= frame THEN {c} ELSE {c} + (g - frame)::DOUBLE / (f2 - frame)::DOUBLE * ({c}2 - {c}) END AS {c}"


def interpolate_halfopen(spark, sf_dir):
    return tracks.interpolate_half_open(keyframes(spark, sf_dir).withColumn("frame", F.col("frame") + 1), "user_id", 600, _V, "event_id")


def _times(spark, sf_dir):
    users = table(spark, sf_dir, "events").select("user_id").distinct()
    return users.select("user_id", F.explode(F.sequence(F.lit(1), F.lit(200))).alias("i")).select("user_id", (F.col("i") * F.lit(250.0)).alias("t"))


def interpolate_time_asof(spark, sf_dir):
    return tracks.interpolate_at(keyframes(spark, sf_dir), _times(spark, sf_dir), "user_id", _V, "event_id")


def asof_last_view(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    clicks = e.where("event_type = 'click'").select("event_id", "user_id", "ts")
    views = e.where("event_type = 'view'").select("user_id", "ts", "value", F.col("event_id").alias("view_id"))
    return tracks.as_of(clicks, views, "user_id", "ts", ["value", "view_id"], []).select("event_id", "user_id", "last_value", "last_view_id")


def interval_join(spark, sf_dir):
    """Orders in each customer's open intervals of 30 days: an interval touches two bins of 30 days at most."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", F.unix_date(F.to_date("o_orderdate")).alias("d"))
    spans = o.select(F.col("o_orderkey").alias("from_key"), "o_custkey", (F.col("d") + 1).alias("first"), (F.col("d") + 30).alias("last"))
    return tracks.within(spans, o, ["o_custkey"], "first", "last", "d", 30).groupBy("from_key").agg(F.count("*").alias("n"), F.min("o_orderkey").alias("least"))


def lookup_fallback(spark, sf_dir):
    names = table(spark, sf_dir, "customer").select("c_custkey", F.when(F.col("c_custkey") % 2 == 0, F.col("c_mktsegment")).otherwise(F.concat(F.lit("x-"), F.lower("c_mktsegment"))).alias("name"))
    videos = table(spark, sf_dir, "customer").select(F.col("c_mktsegment").alias("video")).distinct()
    exact = videos.where("video < 'G'").select(F.col("video").alias("name"), "video")
    return lookups.lookup_with_fallback(names, "name", exact, videos.select(F.lower("video").alias("tail"), "video"), "video").drop("name")


def first_active_time(spark, sf_dir):
    return lookups.first_active_time(keyframes(spark, sf_dir), "user_id", F.col("enabled") & (F.col("x") > 15), "time")


def _ledger(spark, sf_dir):
    status = F.create_map(*(F.lit(x) for x in ("view", "downloading", "click", "downloaded", "signup", "extracting", "purchase", "ingested", "error", "download_failed")))
    return table(spark, sf_dir, "events").select("user_id", F.col("event_id").alias("seq"), F.element_at(status, F.col("event_type")).alias("status"))


_LEDGER = "SELECT user_id, event_id AS seq, CASE event_type WHEN 'view' THEN 'downloading' WHEN 'click' THEN 'downloaded' WHEN 'signup' THEN 'extracting' WHEN 'purchase' THEN 'ingested' ELSE 'download_failed' END AS status FROM events"


def ledger_current(spark, sf_dir):
    return ledger.current(_ledger(spark, sf_dir), "user_id", "seq", "status")


def ledger_histogram(spark, sf_dir):
    return ledger.histogram(ledger_current(spark, sf_dir))


def retry_attempts(spark, sf_dir):
    return ledger.attempts(_ledger(spark, sf_dir), "user_id", "status", "downloading")


def listing_diff(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("doc_id", F.concat("source", F.lit("/"), F.lpad(F.col("doc_id").cast("string"), 9, "0")).alias("path"), F.md5(F.col("text").cast("binary")).alias("md5"))
    id_, k = F.concat(F.lit("f"), F.col("doc_id").cast("string")).alias("drive_id"), F.col("doc_id")
    status = F.element_at(F.array(*map(F.lit, ("ingested", "download_failed", "new", "extracted", "ignored"))), (k % 10 / 2 + 1).cast("int"))
    state = d.where("doc_id % 2 = 0").select(id_, "path", F.when(k % 16 == 0, F.concat("md5", F.lit("-"))).otherwise(F.col("md5")).alias("md5"), status.alias("status"), (k * 7 % 1000003).alias("seq"))
    name = F.concat("path", F.when(k % 12 == 0, "x").otherwise(""), F.when(k % 7 != 0, ".zip").otherwise(""))
    listing = d.where("doc_id % 5 != 0 or doc_id % 4 = 0").select(id_, name.alias("path"), "md5", K.archive_kind(name, F.when(k % 3 == 0, "application/zip").otherwise("text/plain")).alias("suffix"))
    return ledger.listing_diff(listing, state)


_DIFF = """WITH d AS (SELECT doc_id AS k, 'f' || doc_id AS drive_id, source || '/' || lpad(doc_id::VARCHAR, 9, '0') AS path, md5(text) AS md5 FROM documents),
o AS (SELECT drive_id, path, CASE WHEN k % 16 = 0 THEN md5 || '-' ELSE md5 END AS md5, ['ingested', 'download_failed', 'new', 'extracted', 'ignored'][k % 10 // 2 + 1] AS status, k * 7 % 1000003 AS seq FROM d WHERE k % 2 = 0),
n AS (SELECT drive_id, path || CASE WHEN k % 12 = 0 THEN 'x' ELSE '' END || CASE WHEN k % 7 <> 0 THEN '.zip' ELSE '' END AS path, md5, k % 7 <> 0 OR k % 3 = 0 AS archive FROM d WHERE k % 5 <> 0 OR k % 4 = 0),
w AS (SELECT md5, arg_max(drive_id, seq) AS owner FROM o WHERE status NOT IN ('download_failed', 'ignored', 'duplicate') GROUP BY md5),
j AS (SELECT n.*, o.path AS old_path, status, owner, EXISTS (SELECT 1 FROM o x WHERE x.drive_id = n.drive_id) AS versions, coalesce(status NOT IN ('new', 'download_failed', 'downloading', 'ignored'), false) AS handled
 FROM n LEFT JOIN o ON o.drive_id = n.drive_id AND o.md5 = n.md5 LEFT JOIN w ON w.md5 = n.md5),
t AS (SELECT *, min(CASE WHEN NOT handled AND archive AND (owner IS NULL OR owner = drive_id) THEN path END) OVER (PARTITION BY md5) AS first_path FROM j)
SELECT drive_id, path, md5, CASE WHEN handled THEN 'skip' WHEN NOT archive THEN 'ignored' WHEN owner <> drive_id OR owner IS NULL AND path <> first_path THEN 'duplicate' WHEN status IS NOT NULL THEN 'again' WHEN versions THEN 'new_version' ELSE 'new' END AS action,
 coalesce(old_path <> path, false) AS renamed FROM t"""


def undo_replay(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    changes = e.select("user_id", (F.col("event_id") % 3).alias("cell"), F.col("event_id").alias("seq"), F.when(F.col("event_type") == "error", "undo").otherwise("edit").alias("op"), "value")
    return ledger.replayed(changes, ["user_id", "cell"], "seq", "op", "value")


_UNDO = """WITH c AS (SELECT user_id, event_id % 3 AS cell, event_id AS seq, event_type = 'error' AS undo, value FROM events),
b AS (SELECT *, sum(CASE WHEN undo THEN 1 ELSE -1 END) OVER (PARTITION BY user_id, cell ORDER BY seq DESC) AS level FROM c)
SELECT user_id, cell, arg_max(value, seq) AS value FROM b WHERE NOT undo AND level < 0 GROUP BY 1, 2"""


def run_history(spark, sf_dir):
    e = table(spark, sf_dir, "events").withColumn("code", F.when(F.col("event_type") == "error", 1).when(F.col("event_type") == "view", 0))
    return ledger.run_history(e, "event_type", F.col("code"), "value")


def run_statuses(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    return e.select("event_id", K.run_status(F.when(F.col("event_type") == "error", 1).when(F.col("event_type") == "view", 0), F.col("event_type") == "signup").alias("status"))


def best_metric(spark, sf_dir):
    return ledger.best_rows(table(spark, sf_dir, "events").select("user_id", "value", "event_id"), "user_id", "value", ["event_id"])


def next_empty(spark, sf_dir):
    c = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", F.length("text").alias("n"))
    return ledger.next_empty(c, "conv_id", "turn", F.col("n") % 2 == 0).select("conv_id", "turn", "next_empty")


def copy_previous(spark, sf_dir):
    return lookups.previous_value(table(spark, sf_dir, "conversations"), "conv_id", "turn", "role").select("conv_id", "turn", "previous")


def contiguity(spark, sf_dir):
    c = table(spark, sf_dir, "conversations").where("turn != 2 or conv_id % 2 = 0")
    return lookups.out_of_place(c.select("conv_id", "turn"), "conv_id", "turn")


def phase_changes(spark, sf_dir):
    e = table(spark, sf_dir, "events").select("user_id", "event_id", F.when(F.col("event_type").isin("view", "click"), "train").otherwise("test").alias("phase"))
    return ledger.phase_changes(e, "user_id", "event_id", "phase")


def eligible_runs(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    return lookups.having_all(e, "user_id", *(e.where(f"event_type = '{k}'") for k in ("purchase", "signup")))


def streaming_dedup(spark, sf_dir):
    """The first event of each user, type and k that a stream of the events brings; which one it is, the stream decides, so only the key is returned."""
    events = table(spark, sf_dir, "events")
    root = f"{scratch_root(spark)}/stream-{uuid.uuid4().hex[:12]}"
    stream = incremental.stream_table(spark, events.schema, f"{sf_dir}/event[s].parquet")  # a pattern may name one file or a folder
    incremental.run_to_end(incremental.first_of_key(stream.select("user_id", "event_type", "props"), ["user_id", "event_type", "props"]), f"{root}/out", f"{root}/state")
    return spark.read.schema("user_id long, event_type string, props string").parquet(f"{root}/out")


def revenue_by_nation(spark, sf_dir):
    t = lambda n: table(spark, sf_dir, n)
    amount = (F.col("l_extendedprice").cast("decimal(18,2)") * (1 - F.col("l_discount").cast("decimal(4,2)"))).cast("decimal(24,4)")
    j = t("lineitem").select("l_orderkey", "l_suppkey", amount.alias("a")).join(t("orders").select("o_orderkey", "o_custkey"), F.col("l_orderkey") == F.col("o_orderkey"))
    j = j.join(t("customer").select("c_custkey", "c_nationkey"), F.col("o_custkey") == F.col("c_custkey")).join(t("supplier").select("s_suppkey", "s_nationkey"), F.col("l_suppkey") == F.col("s_suppkey")).where("c_nationkey = s_nationkey")
    return j.join(t("nation"), F.col("s_nationkey") == F.col("n_nationkey")).groupBy("n_name").agg(F.sum("a").cast("decimal(34,4)").cast("string").alias("revenue"), F.count("*").alias("n"))


QUERIES = {
    interpolate_closed: f"""WITH k AS ({_LEAD}), p AS (SELECT *, CASE WHEN f2 IS NULL THEN frame WHEN e2 THEN f2 ELSE f2 - 1 END AS last FROM k WHERE enabled AND (f2 IS NULL OR f2 > frame)),
g AS (SELECT *, unnest(range(frame, last + 1)) AS g FROM p)
SELECT user_id, g::INTEGER AS frame, {_VALUE('x')}, {_VALUE('y')} FROM g QUALIFY row_number() OVER (PARTITION BY user_id, g ORDER BY frame DESC, event_id DESC) = 1""",
    interpolate_halfopen: f"""WITH k AS ({_LEAD.replace(KEYS, KEYS.replace(' AS frame,', ' + 1 AS frame,'))}), p AS (SELECT *, least(CASE WHEN f2 IS NULL THEN frame ELSE f2 - 1 END, 600) AS last FROM k WHERE enabled AND rotation = 0),
g AS (SELECT *, unnest(range(greatest(frame, 1), last + 1)) AS g FROM p) SELECT user_id, (g - 1)::INTEGER AS frame, {_VALUE('x')}, {_VALUE('y')} FROM g""",
    interpolate_time_asof: f"""WITH k AS ({KEYS}), t AS (SELECT user_id, i * 250e0 AS t FROM (SELECT DISTINCT user_id FROM events), range(1, 201) r(i)),
a AS (SELECT t.user_id, t, k.time AS ta, k.enabled AS ea, k.x AS xa, k.y AS ya FROM t ASOF JOIN k ON k.user_id = t.user_id AND k.time <= t.t),
b AS (SELECT a.*, k.time AS tb, k.x AS xb, k.y AS yb FROM a ASOF LEFT JOIN k ON k.user_id = a.user_id AND k.time >= a.t)
SELECT user_id, t, CASE WHEN tb IS NULL OR tb <= ta THEN xa ELSE xa + (t - ta) / (tb - ta) * (xb - xa) END AS x, CASE WHEN tb IS NULL OR tb <= ta THEN ya ELSE ya + (t - ta) / (tb - ta) * (yb - ya) END AS y FROM b WHERE ea""",
    asof_last_view: "SELECT c.event_id, c.user_id, v.value AS last_value, v.event_id AS last_view_id FROM (SELECT * FROM events WHERE event_type = 'click') c ASOF LEFT JOIN (SELECT * FROM events WHERE event_type = 'view') v ON c.user_id = v.user_id AND v.ts <= c.ts",
    interval_join: "SELECT a.o_orderkey AS from_key, count(*) AS n, min(b.o_orderkey) AS least FROM orders a JOIN orders b ON a.o_custkey = b.o_custkey AND b.o_orderdate::DATE BETWEEN a.o_orderdate::DATE + 1 AND a.o_orderdate::DATE + 30 GROUP BY 1",
    lookup_fallback: "SELECT c_custkey, CASE WHEN c_custkey % 2 = 0 THEN CASE WHEN c_mktsegment < 'G' THEN c_mktsegment END ELSE c_mktsegment END AS video FROM customer",
    first_active_time: f"SELECT user_id, coalesce(min(time) FILTER (WHERE enabled AND x > 15), 0e0) AS starts FROM ({KEYS}) GROUP BY user_id",
    ledger_current: f"SELECT user_id, arg_max(status, seq) AS status, min(seq) AS first_seq, max(seq) AS last_seq, count(*) AS n_events FROM ({_LEDGER}) GROUP BY user_id",
    ledger_histogram: f"SELECT status, count(*) AS n, count(*) FILTER (WHERE status LIKE '%failed') AS failed FROM (SELECT user_id, arg_max(status, seq) AS status FROM ({_LEDGER}) GROUP BY user_id) GROUP BY status",
    retry_attempts: "SELECT user_id, count(*) FILTER (WHERE event_type = 'view') AS attempts FROM events GROUP BY user_id",
    listing_diff: _DIFF,
    undo_replay: _UNDO,
    run_history: "SELECT event_type, count(*) AS runs, count(*) FILTER (WHERE event_type = 'error') AS failures, max(value) AS longest FROM events GROUP BY event_type",
    run_statuses: "SELECT event_id, CASE event_type WHEN 'signup' THEN 'interrupted' WHEN 'error' THEN 'failed' ELSE 'ok' END AS status FROM events",
    best_metric: "SELECT user_id, round(max(value), 4) AS best, arg_min(event_id, (-value, event_id)) AS event_id, count(*) AS epochs FROM events GROUP BY user_id",
    next_empty: "SELECT conv_id, turn, min(CASE WHEN length(text) % 2 = 0 THEN turn END) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS next_empty FROM conversations",
    copy_previous: "SELECT conv_id, turn, lag(role) OVER (PARTITION BY conv_id ORDER BY turn) AS previous FROM conversations",
    contiguity: "SELECT * FROM (SELECT conv_id, turn, row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS place FROM conversations WHERE turn <> 2 OR conv_id % 2 = 0) WHERE place <> turn",
    phase_changes: """WITH p AS (SELECT user_id, event_id, CASE WHEN event_type IN ('view', 'click') THEN 'train' ELSE 'test' END AS phase FROM events),
c AS (SELECT *, lag(phase) OVER (PARTITION BY user_id ORDER BY event_id) AS last FROM p)
SELECT user_id, event_id, phase, (row_number() OVER (PARTITION BY user_id ORDER BY event_id))::INTEGER AS phase_no FROM c WHERE last IS DISTINCT FROM phase""",
    eligible_runs: "SELECT user_id FROM events GROUP BY user_id HAVING count(*) FILTER (WHERE event_type = 'purchase') > 0 AND count(*) FILTER (WHERE event_type = 'signup') > 0",
    streaming_dedup: "SELECT DISTINCT user_id, event_type, props FROM events",
    revenue_by_nation: """SELECT n_name, (sum(((l_extendedprice::DECIMAL(18, 2)) * (1 - l_discount::DECIMAL(4, 2)))::DECIMAL(24, 4))::DECIMAL(34, 4))::VARCHAR AS revenue, count(*) AS n
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN supplier ON l_suppkey = s_suppkey AND c_nationkey = s_nationkey JOIN nation ON s_nationkey = n_nationkey GROUP BY n_name""",
}
