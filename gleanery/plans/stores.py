"""Queries of the ledger stream, the set of known keys, workspaces and archive sets."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..operators import archives, package
from ..session import scratch_root
from ..sources import sinks, workspaces
from ..streaming import incremental, known, machine
from .common import BOXES, boxes, table

_S = lambda c: F.col(c).cast("string")
_PATIENCE = 6 * 3600


def _folder(spark, label):
    return f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex[:12]}"


def ledger_stream(spark, sf_dir):
    """Events as changes of a user's status, run as a stream to its end: what is accepted, rejected and timed out."""
    events = table(spark, sf_dir, "events")
    root = _folder(spark, "ledger")
    status = F.create_map(*(F.lit(x) for x in ("signup", "new", "view", "downloading", "click", "downloaded", "purchase", "extracting", "error", "download_failed")))
    stream = incremental.stream_table(spark, events.schema, f"{sf_dir}/event[s].parquet").withColumn("status", F.element_at(status, F.col("event_type")))
    told = machine.ledger(stream, "user_id", "ts", "event_id", "status", _PATIENCE, "1 hour")
    incremental.run_to_end(told.withColumn("at", F.unix_micros("at")), f"{root}/out", f"{root}/state")
    return spark.read.schema("key long, at long, seq long, status string, previous string, attempts int, accepted boolean, reason string").parquet(f"{root}/out")


_ALLOWED = "[" + ", ".join(f"'{a}>{b}'" for a, follows in machine.FOLLOWS.items() for b in follows) + "]"
_FAILED = "CASE {0} " + " ".join(f"WHEN '{a}' THEN '{b}'" for a, b in machine.FAILS_TO.items()) + " END"
_DUE = f"ceil(({{0}} + {_PATIENCE}000000) / 1000)::BIGINT * 1000"
_LEDGER = f"""WITH RECURSIVE e AS (SELECT user_id AS key, epoch_us(ts) AS at, event_id AS seq, CASE event_type WHEN 'signup' THEN 'new' WHEN 'view' THEN 'downloading' WHEN 'click' THEN 'downloaded' WHEN 'purchase' THEN 'extracting' ELSE 'download_failed' END AS status,
 row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS i FROM events),
s AS (SELECT key, 0::BIGINT AS i, ''::VARCHAR AS status, NULL::BIGINT AS at, 0 AS attempts, ''::VARCHAR AS s0, ''::VARCHAR AS s1, NULL::BIGINT AS t1, 0 AS n0, false AS ok, false AS timed, NULL::BIGINT AS eat, NULL::BIGINT AS seq, ''::VARCHAR AS ev FROM (SELECT DISTINCT key FROM e)
 UNION ALL SELECT key, i, CASE WHEN ok THEN ev ELSE s1 END, CASE WHEN ok THEN eat ELSE t1 END, attempts + (ok AND ev = 'downloading')::INTEGER, s0, s1, t1, attempts, ok, timed, eat, seq, ev
 FROM (SELECT *, list_contains({_ALLOWED}, s1 || '>' || ev) AS ok FROM (SELECT *, CASE WHEN timed THEN {_FAILED.format('s0')} ELSE s0 END AS s1, CASE WHEN timed THEN {_DUE.format('at0')} ELSE at0 END AS t1
  FROM (SELECT s.key, e.i, s.status AS s0, s.at AS at0, s.attempts, e.at AS eat, e.seq, e.status AS ev, coalesce({_FAILED.format('s.status')} IS NOT NULL AND {_DUE.format('s.at')} <= e.at, false) AS timed FROM s JOIN e ON e.key = s.key AND e.i = s.i + 1)))),
l AS (SELECT *, row_number() OVER (PARTITION BY key ORDER BY i DESC) AS back FROM s), m AS (SELECT (max(epoch_us(ts)) // 1000 - 3600000) * 1000 AS mark FROM events)
SELECT key, eat AS at, seq, ev AS status, nullif(s1, '') AS previous, (n0 + (ok AND ev = 'downloading')::INTEGER)::INTEGER AS attempts, ok AS accepted, CASE WHEN NOT ok THEN 'not_allowed' END AS reason FROM s WHERE i > 0
UNION ALL SELECT key, t1, NULL, s1, s0, n0::INTEGER, true, 'timeout' FROM s WHERE timed
UNION ALL SELECT key, {_DUE.format('l.at')}, NULL, {_FAILED.format('status')}, status, attempts::INTEGER, true, 'timeout' FROM l, m WHERE back = 1 AND {_FAILED.format('status')} IS NOT NULL AND {_DUE.format('l.at')} <= mark"""


def known_set(spark, sf_dir):
    """Two batches of documents against a set of known texts that starts empty: what each brings anew."""
    d = table(spark, sf_dir, "documents").select("doc_id", F.sha2(F.col("text").cast("binary"), 256).alias("sha"))
    keys = known.KnownKeys(spark, _folder(spark, "known"), "sha")
    out = []
    for n in (0, 1):
        fresh = keys.fresh(d.where(F.col("doc_id") % 2 == n), "doc_id", n)
        keys.add(fresh, n)
        out.append(fresh.withColumn("batch", F.lit(n)))
    return out[0].unionByName(out[1]).select("batch", "doc_id", "sha")


def _workspace_files(spark, sf_dir):
    """A file for each document: frames, documents of the sequence's name and of others, in bases of each kind and outside of them."""
    d, k = table(spark, sf_dir, "documents"), F.col("doc_id")
    base = F.element_at(F.array(*map(F.lit, ("recordings_clean_annotated", "b_annotations", "a_annotations", "dataset_samples2", "elsewhere"))), (k % 5 + 1).cast("int"))
    sequence = F.concat(F.when(k % 7 == 0, "/verif").otherwise(""), F.lit("/day"), (k % 3).cast("string"), F.lit("/s"), (F.floor(k / 5) % 11).cast("string"))
    name = F.when(k % 9 == 0, F.concat(F.lit("/s"), (F.floor(k / 5) % 11).cast("string"), F.lit(".json"))).when(k % 9 == 1, F.concat(F.lit("/x"), _S("doc_id"), F.lit(".json"))).when(k % 9 == 2, F.concat(F.lit("/frames/"), _S("doc_id"), F.lit(".txt"))).otherwise(F.concat(F.lit("/frames/frame_"), _S("doc_id"), F.lit(".jpg")))
    return d.select(F.concat(base, sequence, name).alias("path")).distinct()


def workspace_sequences(spark, sf_dir):
    return workspaces.sequences(_workspace_files(spark, sf_dir))


def incoming_sequences(spark, sf_dir):
    return workspaces.sequences(_workspace_files(spark, sf_dir), only_one=True)


def workspace_frames(spark, sf_dir):
    """Sequences with their documents, which have as many entries as there are frames, or one more, or are no documents."""
    chosen = workspaces.sequences(_workspace_files(spark, sf_dir))
    n = (F.col("frames") + F.when(F.length("sequence") % 3 == 0, 1).otherwise(0)).cast("int")
    listed = lambda x: F.concat(F.lit("["), F.array_join(F.array_repeat(F.lit(x), n), ","), F.lit("]"))
    text = F.when(F.length("annotation") % 4 == 0, '{"exist": 1}').otherwise(F.concat(F.lit('{"exist":'), listed("1"), F.lit(',"gt_rect":'), listed("[1,2,3,4]"), F.lit("}")))
    documents = chosen.where("annotation is not null").select(F.col("annotation").alias("path"), text.alias("text"))
    return workspaces.with_documents(chosen, documents).select("sequence", "frames", "status", F.col("document").isNotNull().alias("complete"))


_SEQUENCES = """f AS (SELECT DISTINCT ['recordings_clean_annotated', 'b_annotations', 'a_annotations', 'dataset_samples2', 'elsewhere'][k % 5 + 1] AS base, CASE WHEN k % 7 = 0 THEN '/verif' ELSE '' END || '/day' || (k % 3) || '/s' || (k // 5 % 11) AS s, 's' || (k // 5 % 11) AS name,
 CASE k % 9 WHEN 0 THEN '/s' || (k // 5 % 11) || '.json' WHEN 1 THEN '/x' || k || '.json' WHEN 2 THEN '/frames/' || k || '.txt' ELSE '/frames/frame_' || k || '.jpg' END AS file FROM (SELECT doc_id AS k FROM documents)),
q AS (SELECT base, s, count(*) FILTER (WHERE file LIKE '/frames/%.jpg') AS frames, count(*) FILTER (WHERE file LIKE '%.json') AS jsons, min(base || s || file) FILTER (WHERE file = '/' || name || '.json') AS exact, min(base || s || file) FILTER (WHERE file LIKE '%.json') AS other,
 count(*) FILTER (WHERE file LIKE '/frames/%') AS inside FROM f WHERE base <> 'elsewhere' GROUP BY base, s, name),
w AS (SELECT CASE base WHEN 'recordings_clean_annotated' THEN 0 WHEN 'dataset_samples2' THEN 2 ELSE 1 END AS rank, base, base || s AS sequence, 'recordings:' || s[2:] AS "group", frames, coalesce(exact, other) AS annotation, exact IS NULL AND jsons > 1 AS unsure, s LIKE '/verif%' AS verif FROM q WHERE inside > 0)"""


def volume_sets(spark, sf_dir):
    """Parts as files of archives in both styles, some twice, some gone, some numbers too long, listed backwards in places."""
    p, k = table(spark, sf_dir, "part"), F.col("p_partkey")
    stem = F.concat(F.lit("in/v"), F.floor(k / 12).cast("string"))
    number = F.when(k % 97 == 0, F.lit("99999999999999999999")).otherwise((k % 12 + F.when(k % 31 == 0, 0).otherwise(1)).cast("string"))
    old = F.when(k % 12 == 0, ".RAR").otherwise(F.concat(F.lit(".r"), F.lpad((k % 12 - 1).cast("string"), 2, "0")))
    name = F.concat(stem, F.when(F.floor(k / 12) % 3 == 0, F.concat(F.lit(".part"), number, F.lit(".rar"))).when(F.floor(k / 12) % 3 == 1, old).otherwise(".zip"))
    files = p.where("p_partkey % 17 != 0").select(name.alias("path"), F.when(k % 5 == 0, -k).otherwise(k).alias("ordinal"))
    return archives.volume_sets(files, "path", "ordinal")


_VOLUMES = """WITH p AS (SELECT p_partkey AS k, p_partkey // 12 AS a, p_partkey // 12 % 3 AS t, CASE WHEN p_partkey % 5 = 0 THEN -p_partkey ELSE p_partkey END AS o FROM part WHERE p_partkey % 17 <> 0),
f AS (SELECT 'in/v' || a || CASE WHEN t = 2 THEN '.zip' ELSE '' END AS archive, ['part', 'old', 'single'][t + 1] AS style, o, CASE t WHEN 0 THEN CASE WHEN k % 97 <> 0 THEN k % 12 + CASE WHEN k % 31 = 0 THEN 0 ELSE 1 END END WHEN 1 THEN k % 12 + 1 ELSE 1 END AS v FROM p),
e AS (SELECT archive, style, v, count(*) AS n, min(o) AS o FROM f WHERE v > 0 GROUP BY ALL),
g AS (SELECT *, lag(v, 1, 0) OVER w AS before, lead(v) OVER w AS next, lead(o) OVER w AS next_o FROM e WINDOW w AS (PARTITION BY archive, style ORDER BY v)),
s AS (SELECT archive, style, count(*) AS volumes, max(v) AS last, coalesce(string_agg(CASE WHEN v - before = 2 THEN (v - 1)::VARCHAR ELSE (before + 1) || '-' || (v - 1) END, ',' ORDER BY v) FILTER (WHERE v - before > 1), '') AS missing,
 coalesce(string_agg(v::VARCHAR, ',' ORDER BY v) FILTER (WHERE n > 1), '') AS doubled, count(*) FILTER (WHERE next = v + 1 AND next_o < o) AS disordered FROM g GROUP BY ALL),
t AS (SELECT archive, style, count(*) AS files, count(*) FILTER (WHERE v IS NULL OR v < 1) AS unreadable FROM f GROUP BY ALL)
SELECT t.archive, t.style, files, coalesce(volumes, 0) AS volumes, last, missing, doubled, coalesce(disordered, 0) AS disordered, unreadable, coalesce(volumes > 0 AND missing = '' AND doubled = '' AND unreadable = 0, false) AS openable
FROM t LEFT JOIN s ON s.archive = t.archive AND s.style = t.style"""

def coco_lines(spark, sf_dir):
    """The lines of a COCO document by split: where each stands, and whether one of its kind follows."""
    b = boxes(spark, sf_dir).withColumn("split", F.when(F.col("image") % 10 == 0, "test").when(F.col("image") % 10 == 1, "val").otherwise("train"))
    ids = package.coco_ids(b, "split", "image", ["line", "l_partkey", "l_suppkey", "cx", "cy", "w"])
    return package.coco_lines(ids, "split").select("split", "section", "n", F.col("line").endswith(",").alias("goes_on"))


def audit_lines(spark, sf_dir):
    """Counters by segment and nation as the lines of one document."""
    c = table(spark, sf_dir, "customer").groupBy(F.col("c_mktsegment").alias("metric"), _S("c_nationkey").alias("key")).agg(F.count("*").alias("n"))
    return sinks.audit_lines(c)


QUERIES = {
    coco_lines: f"""WITH b AS (SELECT image, CASE image % 10 WHEN 0 THEN 'test' WHEN 1 THEN 'val' ELSE 'train' END AS split FROM ({BOXES})),
a AS (SELECT split, row_number() OVER (PARTITION BY split) AS n, count(*) OVER (PARTITION BY split) AS m FROM b), i AS (SELECT split, row_number() OVER (PARTITION BY split) AS n, count(*) OVER (PARTITION BY split) AS m FROM (SELECT DISTINCT split, image FROM b))
SELECT split, 1::INTEGER AS section, n, n < m AS goes_on FROM i UNION ALL SELECT split, 3, n, n < m FROM a UNION ALL SELECT DISTINCT split, unnest([0, 2, 4])::INTEGER, 0, false FROM b""",
    audit_lines: """WITH c AS (SELECT c_mktsegment AS metric, c_nationkey::VARCHAR AS key, count(*) AS n FROM customer GROUP BY 1, 2),
d AS (SELECT *, row_number() OVER w AS i, count(*) OVER (PARTITION BY metric) AS m, dense_rank() OVER (ORDER BY metric) AS a, min(metric) OVER () AS lo, max(metric) OVER () AS hi FROM c WINDOW w AS (PARTITION BY metric ORDER BY key))
SELECT metric, key, CASE WHEN i = 1 THEN CASE WHEN metric = lo THEN '{' ELSE '' END || '"' || metric || '":{' ELSE '' END || '"' || key || '":' || n || CASE WHEN i < m THEN ',' WHEN metric = hi THEN '}}' ELSE '},' END AS line FROM d""",
    ledger_stream: _LEDGER,
    known_set: "SELECT (doc_id % 2)::INTEGER AS batch, doc_id, sha256(text) AS sha FROM documents QUALIFY row_number() OVER (PARTITION BY text ORDER BY doc_id % 2, doc_id) = 1",
    workspace_sequences: f"WITH {_SEQUENCES} SELECT rank, base, sequence, \"group\", frames, annotation, CASE WHEN annotation IS NULL THEN 'missing_json' ELSE 'chosen' END AS status FROM w",
    incoming_sequences: f"WITH {_SEQUENCES} SELECT rank, base, sequence, \"group\", frames, CASE WHEN NOT unsure THEN annotation END AS annotation, CASE WHEN annotation IS NULL THEN 'missing_json' WHEN unsure THEN 'ambiguous_json' ELSE 'chosen' END AS status FROM w WHERE NOT verif",
    workspace_frames: f"""WITH {_SEQUENCES}, x AS (SELECT *, CASE WHEN annotation IS NULL THEN 'missing_json' WHEN length(annotation) % 4 = 0 THEN 'invalid_json' WHEN length(sequence) % 3 = 0 THEN 'length_mismatch' ELSE 'complete' END AS status FROM w)
SELECT sequence, frames, status, status = 'complete' AS complete FROM x""",
    volume_sets: _VOLUMES,
}
