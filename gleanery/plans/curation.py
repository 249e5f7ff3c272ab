"""Queries of dedup, splits, packing, paths and profiles."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import keys as K
from ..operators import dedup, lookups, package, profile, splits
from ..sources import annotations, scans
from .common import table


def _candidates(spark, sf_dir):
    return table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("ordinal"), F.sha2(F.col("text").cast("binary"), 256).alias("image_hash"), F.substring("source", 4, 9).cast("int").alias("priority"), "n_chars", "source", "lang",
        F.concat("source", F.lit(":"), "lang", F.lit(":"), (F.col("doc_id") % 100).cast("string")).alias("group"),
        F.when(F.col("doc_id") % 11 == 0, "test").when(F.col("doc_id") % 3 == 0, "train").alias("source_split"),
    )


_CAND = """SELECT doc_id AS ordinal, sha256(text) AS image_hash, substr(source, 4)::INTEGER AS priority, n_chars, source, lang, source || ':' || lang || ':' || (doc_id % 100) AS "group",
 CASE WHEN doc_id % 11 = 0 THEN 'test' WHEN doc_id % 3 = 0 THEN 'train' END AS source_split FROM documents"""
_RANKED = f"SELECT *, first_value(ordinal) OVER w AS winner, first_value(source) OVER w AS kept_source, min(ordinal) OVER (PARTITION BY image_hash) AS rank_ordinal FROM ({_CAND}) WINDOW w AS (PARTITION BY image_hash ORDER BY priority DESC, n_chars DESC, ordinal)"
_FRACTION = "(('0x' || substr(sha256({0}), 1, 16))::UBIGINT)::DOUBLE / 18446744073709551616e0"


def _deduped(spark, sf_dir):
    return dedup.exact_dedup(_candidates(spark, sf_dir), "image_hash", F.col("priority"), F.col("n_chars"), "ordinal")


def dedup_exact(spark, sf_dir):
    return _deduped(spark, sf_dir).select("ordinal", "image_hash", "source", "rank_ordinal")


def dedup_audit(spark, sf_dir):
    return dedup.dedup_audit(_candidates(spark, sf_dir), "image_hash", F.col("priority"), F.col("n_chars"), "ordinal", "source")


def dup_images(spark, sf_dir):
    return lookups.repeats(_candidates(spark, sf_dir), "image_hash", "ordinal")


def _split(spark, sf_dir):
    return splits.split_by_group(_deduped(spark, sf_dir), "group", "rank_ordinal", F.col("source_split"), F.col("source") == "src5")


def split_by_group(spark, sf_dir):
    return _split(spark, sf_dir).select("ordinal", "group", "split")


_SPLIT = f"""WITH d AS (SELECT * FROM ({_RANKED}) WHERE ordinal = winner),
g AS (SELECT "group", arg_min(coalesce(source_split, '-'), rank_ordinal) AS known, arg_min(source = 'src5', rank_ordinal) AS again FROM d GROUP BY 1),
s AS (SELECT *, {_FRACTION.format('"group"')} AS f FROM g)
SELECT ordinal, d."group", n_chars, CASE WHEN known = 'test' THEN 'test' WHEN again AND known = 'train' THEN CASE WHEN f < 0.1 THEN 'val' ELSE 'train' END WHEN known <> '-' THEN known
 WHEN f < 0.1 THEN 'test' WHEN f < 0.2 THEN 'val' ELSE 'train' END AS split FROM d JOIN s ON d."group" = s."group\""""


def split_summary(spark, sf_dir):
    return splits.summary(_split(spark, sf_dir), "split", F.floor(F.col("n_chars") / 500).cast("long"))


flagship = split_summary


def subset_fraction(spark, sf_dir):
    rows = _candidates(spark, sf_dir).select("ordinal", "image_hash", F.coalesce("source_split", F.lit("train")).alias("split"))
    return splits.subset(rows, "image_hash", "split", 0.25).select("ordinal", "split")


def split_greedy(spark, sf_dir):
    groups = table(spark, sf_dir, "events").groupBy(F.date_format("ts", "yyyy-MM-dd").alias("name")).agg(F.count("*").alias("size"))
    known = table(spark, sf_dir, "labels").groupBy(F.when(F.col("quality") == 1, "val").otherwise("test").alias("split")).agg(F.floor(F.count("*") / 10).cast("long").alias("n"))
    return splits.greedy_splits(groups, known)


_GREEDY = """WITH RECURSIVE g AS (SELECT strftime(ts, '%Y-%m-%d') AS name, count(*) AS size FROM events GROUP BY 1),
k AS (SELECT CASE WHEN quality = 1 THEN 'val' ELSE 'test' END AS split, floor(count(*) / 10)::BIGINT AS n FROM labels GROUP BY 1),
o AS (SELECT name, size, row_number() OVER (ORDER BY size DESC, name) AS i FROM g),
z AS (SELECT coalesce((SELECT sum(size) FROM g), 0)::DOUBLE + coalesce((SELECT sum(n) FROM k), 0)::DOUBLE AS total),
f AS (SELECT 0::BIGINT AS i, ''::VARCHAR AS name, ''::VARCHAR AS split, 0e0 AS a, coalesce((SELECT n FROM k WHERE split = 'val'), 0)::DOUBLE AS b, coalesce((SELECT n FROM k WHERE split = 'test'), 0)::DOUBLE AS c
 UNION ALL SELECT i, name, split, a + CASE WHEN split = 'train' THEN size ELSE 0 END, b + CASE WHEN split = 'val' THEN size ELSE 0 END, c + CASE WHEN split = 'test' THEN size ELSE 0 END
 FROM (SELECT o.i, o.name, o.size, f.a, f.b, f.c, CASE WHEN 0.8e0 * total - a >= 0.1e0 * total - b AND 0.8e0 * total - a >= 0.1e0 * total - c THEN 'train' WHEN 0.1e0 * total - b >= 0.1e0 * total - c THEN 'val' ELSE 'test' END AS split
  FROM f JOIN o ON o.i = f.i + 1 CROSS JOIN z))
SELECT name, split FROM f WHERE i > 0"""


def known_hash_filter(spark, sf_dir):
    rows = _candidates(spark, sf_dir)
    return dedup.drop_known(rows.where("ordinal % 5 != 0"), rows.where("ordinal % 5 = 0"), "image_hash", "ordinal").select("ordinal", "image_hash")


def contamination(spark, sf_dir):
    """Documents that share a run of 8 words with a benchmark item, by item."""
    return profile.shared_runs(table(spark, sf_dir, "documents"), "doc_id", table(spark, sf_dir, "benchmark"), "item_id")


_GRAMS = "SELECT {0}, unnest(list_distinct(list_transform(range(1, len(w) - 6), lambda i: array_to_string(w[i:i + 7], ' ')))) AS gram FROM (SELECT {0}, list_filter(regexp_split_to_array(lower(text), '\\s+'), lambda x: x <> '') AS w FROM {1}) WHERE len(w) >= 8"


def pack_nextfit(spark, sf_dir):
    rows = _candidates(spark, sf_dir).select("lang", "ordinal", "n_chars")
    return package.pack_next_fit(rows, "lang", ["ordinal"], "n_chars", 20000)


_NEXTFIT = """WITH RECURSIVE o AS (SELECT {rows}, row_number() OVER (PARTITION BY lang ORDER BY doc_id) AS i FROM documents {where}),
f AS (SELECT lang, i, doc_id, n_chars, n_chars AS held, {start} AS shard FROM o WHERE i = 1
 UNION ALL SELECT o.lang, o.i, o.doc_id, o.n_chars, CASE WHEN f.held + o.n_chars > 20000 THEN o.n_chars ELSE f.held + o.n_chars END, CASE WHEN f.held + o.n_chars > 20000 THEN f.shard + 1 ELSE f.shard END FROM f JOIN o ON o.lang = f.lang AND o.i = f.i + 1)"""
_FIT = _NEXTFIT.format(rows="lang, doc_id, n_chars", where="", start="0")


def pack_append(spark, sf_dir):
    rows = _candidates(spark, sf_dir).select("lang", "ordinal", "n_chars")
    old = package.pack_next_fit(rows.where("ordinal % 5 != 0"), "lang", ["ordinal"], "n_chars", 20000)
    fresh = rows.join(old.select("ordinal"), "ordinal", "left_anti").select("lang", "ordinal", "n_chars")
    return package.pack_next_fit(fresh, "lang", ["ordinal"], "n_chars", 20000, package.next_shard(old, "lang", "shard"))


def shard_manifest(spark, sf_dir):
    return package.shard_manifest(pack_nextfit(spark, sf_dir), "lang", F.col("n_chars"), F.lit(1))


def first_k_per_source(spark, sf_dir):
    return package.first_rows(_candidates(spark, sf_dir).select("source", "ordinal"), "source", ["ordinal"], 4)


def collision_rename(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").select("doc_id", F.concat("source", F.lit("/"), "lang", F.lit("_"), (F.col("doc_id") % 7).cast("string"), F.when(F.col("doc_id") % 2 == 0, ".zip").otherwise("")).alias("target"), F.md5(F.col("doc_id").cast("string").cast("binary")).alias("md5"))
    return package.renamed_on_collision(rows, "target", ["doc_id"], "md5").select("doc_id", "local_name")


def full_directories(spark, sf_dir):
    return package.full_directories(table(spark, sf_dir, "documents").select(F.concat("source", F.lit("/"), "lang", F.lit("/"), F.col("doc_id").cast("string")).alias("path")), "path", 12)


def output_paths(spark, sf_dir):
    rows = _candidates(spark, sf_dir)
    path = K.output_path(F.coalesce("source_split", F.lit("train")), F.col("source"), F.col("image_hash"), F.when(F.col("ordinal") % 3 == 0, "gif").otherwise("png"))
    return rows.select("ordinal", path.alias("path"), K.image_bucket(path).alias("bucket"), K.label_path(path).alias("label"))


def recording_day(spark, sf_dir):
    d = F.col("o_orderdate")
    p = lambda *f: F.concat_ws("_", *(F.date_format(d, x) for x in f))
    name = F.when(F.col("o_orderkey") % 4 == 0, p("yyyy", "M", "d")).when(F.col("o_orderkey") % 4 == 1, F.concat(p("dd", "MM", "yyyy"), F.lit("_cam"))).when(F.col("o_orderkey") % 4 == 2, F.concat(F.lit("cam_"), p("yyyy", "M"))).otherwise(F.concat(p("yyyy", "MM", "d"), F.lit("x")))
    return table(spark, sf_dir, "orders").select("o_orderkey", K.recording_day(name).alias("day"))


def path_ops(spark, sf_dir):
    u = F.col("url")
    path = F.concat(F.lit("a/images/"), F.regexp_replace(u, "^[a-z]+://", ""), F.lit("/images/p"), F.col("page_id").cast("string"), F.lit(".jpg"))
    return table(spark, sf_dir, "pages").select("page_id", K.label_path(path).alias("label"), K.clean_name(F.concat(F.lit("  "), F.regexp_replace(u, "/", " /& "), F.lit("-_ "))).alias("clean"), K.is_junk(F.concat(u, F.when(F.col("page_id") % 5 == 0, "/__MACOSX/x").when(F.col("page_id") % 5 == 1, "/._y").otherwise("/z"))).alias("junk"), K.is_unsafe_member(F.concat(F.when(F.col("page_id") % 3 == 0, "/").when(F.col("page_id") % 3 == 1, "a/../").otherwise(""), F.col("page_id").cast("string"))).alias("unsafe"), K.folder_reference(F.concat(F.when(F.col("page_id") % 7 == 0, "bare id ").otherwise("https://host.test/drive/folders/F"), F.col("page_id").cast("string"), F.when(F.col("page_id") % 2 == 0, F.concat(F.lit("?x=/folders/no&resourcekey=k%2D"), F.col("page_id").cast("string"), F.lit("&x=1"))).otherwise(""))).alias("f")).select("*", "f.id", "f.resource_key").drop("f")


def archive_classify(spark, sf_dir):
    k = F.col("p_partkey")
    name = F.concat(F.lit("v"), k.cast("string"), F.when(k % 5 == 0, F.concat(F.lit(".part"), F.when(k % 25 == 0, "99999999999").otherwise((k % 4 + 1).cast("string")), F.lit(".RAR"))).when(k % 5 == 1, ".zip").when(k % 5 == 2, F.concat(F.lit(".r"), F.when(k % 2 == 0, "10").otherwise("0"), (k % 3).cast("string"))).when(k % 5 == 3, ".rar").otherwise(""))
    mime = F.when(k % 2 == 0, "application/zip").otherwise("text/plain")
    return table(spark, sf_dir, "part").select("p_partkey", name.alias("name"), K.archive_kind(name, mime).alias("kind"), K.rar_volume(name).alias("v")).select("p_partkey", "name", "kind", "v.number", "v.later")


def _files(spark, sf_dir):
    suffix = F.element_at(F.array(*(F.lit(x) for x in (".JPG", ".png", ".mp4", ".json", ".yml", "", ".zip"))), (F.col("doc_id") % 7 + 1).cast("int"))
    return table(spark, sf_dir, "documents").select("source", "n_chars", F.concat(F.when(F.col("doc_id") % 13 == 0, "__MACOSX/").when(F.col("doc_id") % 5 == 0, "").otherwise(F.concat(F.lit("d"), (F.col("doc_id") % 4).cast("string"), F.when(F.col("doc_id") % 3 == 0, "/Images/a/").otherwise("/labels/"))), F.col("doc_id").cast("string"), suffix).alias("path"))


_FILES = "SELECT source, n_chars, CASE WHEN doc_id % 13 = 0 THEN '__MACOSX/' WHEN doc_id % 5 = 0 THEN '' WHEN doc_id % 3 = 0 THEN 'd' || (doc_id % 4) || '/Images/a/' ELSE 'd' || (doc_id % 4) || '/labels/' END || doc_id || ['.JPG', '.png', '.mp4', '.json', '.yml', '', '.zip'][doc_id % 7 + 1] AS path FROM documents"


def content_profile(spark, sf_dir):
    return profile.content_profile(_files(spark, sf_dir), "source", "path", "n_chars").withColumns({c: F.array_join(c, ",") for c in ("top_level", "annotation_examples")})


def suffix_histogram(spark, sf_dir):
    return profile.suffix_histogram(_files(spark, sf_dir), "source", "path")


def detect_format(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").select(F.col("l_partkey").alias("seq"), F.concat(F.lit("s/"), F.element_at(F.array(*(F.lit(x) for x in ("labels/a.txt", "b.csv", "c.jpg", "d.JSON"))), F.when(F.col("l_quantity") > 48, 4).otherwise(F.col("l_suppkey") % 3 + 1).cast("int"))).alias("path"))
    return annotations.detect_format(rows, "seq", "path")


def stride_filter(spark, sf_dir):
    k = F.col("event_id")  # some have 24 digits and more, of which the last ones do not change the remainder
    name = F.concat(F.lit("frame_"), k.cast("string"), F.when(k % 10 == 0, "x").when(k % 7 == 0, "300000000000000000000000").otherwise(""))
    return table(spark, sf_dir, "events").select("event_id", name.alias("name")).where(scans.on_stride(F.col("name"))).select("event_id", K.frame_number(F.col("name")).alias("frame"))


def manifest_union_minus(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("doc_id", "lang")
    return lookups.union_minus([d.where("doc_id % 2 = 0"), d.where("doc_id % 3 = 0")], d.where("doc_id % 10 = 0"))


def latest_annotation(spark, sf_dir):
    c = table(spark, sf_dir, "conversations").where("turn % 4 != 3")
    return lookups.latest(c, "conv_id", "turn", role=F.col("role"), n=F.length("text").cast("long"))


def html_extract(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", F.regexp_extract("html", "(?s)<title>(.*?)</title>", 1).alias("title"), (F.size(F.split("html", "<p")) - 1).cast("long").alias("paragraphs"))


def json_props(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_type", F.from_json("props", "k int").getField("k").alias("k")).groupBy("event_type", "k").agg(F.count("*").alias("n"))


def nested_transform(spark, sf_dir):
    e = F.transform("embedding", lambda x: x.cast("double"))
    return table(spark, sf_dir, "embeddings").select("vec_id", F.size(F.filter(e, lambda x: x > 0)).cast("long").alias("positive"), F.array_max(e).alias("most"), F.array_min(e).alias("least"), F.element_at(e, 3).alias("third"))


QUERIES = {
    dedup_exact: f"SELECT ordinal, image_hash, source, rank_ordinal FROM ({_RANKED}) WHERE ordinal = winner",
    dedup_audit: f"SELECT source || '->kept:' || kept_source AS key, count(*) AS n FROM ({_RANKED}) WHERE ordinal <> winner GROUP BY 1",
    dup_images: "SELECT doc_id AS ordinal, first FROM (SELECT doc_id, min(doc_id) OVER (PARTITION BY text) AS first FROM documents) WHERE doc_id <> first",
    split_by_group: f'SELECT ordinal, "group", split FROM ({_SPLIT})',
    split_summary: f"""WITH s AS (SELECT split, floor(n_chars / 500)::BIGINT AS o FROM ({_SPLIT})), n AS (SELECT unnest(['train', 'val', 'test']) AS split),
b AS (SELECT n.split, count(s.split) AS images, coalesce(sum(o), 0)::BIGINT AS objects, count(*) FILTER (WHERE o = 0) AS negatives FROM n LEFT JOIN s USING (split) GROUP BY 1)
SELECT * FROM b UNION ALL SELECT 'total', sum(images)::BIGINT, sum(objects)::BIGINT, sum(negatives)::BIGINT FROM b""",
    subset_fraction: f"SELECT ordinal, coalesce(source_split, 'train') AS split FROM ({_CAND}) WHERE source_split = 'test' OR (('0x' || substr(image_hash, 1, 12))::UBIGINT)::DOUBLE / 281474976710656e0 < 0.25e0",
    split_greedy: _GREEDY,
    known_hash_filter: f"SELECT ordinal, image_hash FROM ({_CAND}) WHERE ordinal % 5 <> 0 AND image_hash NOT IN (SELECT image_hash FROM ({_CAND}) WHERE ordinal % 5 = 0) QUALIFY row_number() OVER (PARTITION BY image_hash ORDER BY ordinal) = 1",
    contamination: f"SELECT item_id, doc_id, count(*) AS shared FROM ({_GRAMS.format('doc_id', 'documents')}) JOIN ({_GRAMS.format('item_id', 'benchmark')}) USING (gram) GROUP BY 1, 2",
    pack_nextfit: f"{_FIT} SELECT lang, doc_id AS ordinal, n_chars, shard FROM f",
    pack_append: "WITH " + "RECURSIVE old AS (" + _NEXTFIT.format(rows="lang, doc_id, n_chars", where="WHERE doc_id % 5 <> 0", start="0") + " SELECT lang, max(shard) + 1 AS start FROM f GROUP BY lang), "
    + _NEXTFIT.format(rows="documents.lang, doc_id, n_chars, coalesce(start, 0) AS start", where="LEFT JOIN old ON old.lang = documents.lang WHERE doc_id % 5 = 0", start="start").removeprefix("WITH RECURSIVE ").replace("PARTITION BY lang", "PARTITION BY documents.lang")
    + " SELECT lang, doc_id AS ordinal, n_chars, shard FROM f",
    shard_manifest: f"{_FIT} SELECT lang, shard, count(*) AS images, sum(n_chars)::BIGINT AS bytes, count(*) AS boxes FROM f GROUP BY lang, shard",
    first_k_per_source: "SELECT source, doc_id AS ordinal, (row_number() OVER w)::INTEGER AS place FROM documents WINDOW w AS (PARTITION BY source ORDER BY doc_id) QUALIFY row_number() OVER w <= 4",
    collision_rename: """WITH t AS (SELECT doc_id, source || '/' || lang || '_' || (doc_id % 7) AS stem, CASE WHEN doc_id % 2 = 0 THEN '.zip' ELSE '' END AS suffix FROM documents)
SELECT doc_id, CASE WHEN row_number() OVER (PARTITION BY stem || suffix ORDER BY doc_id) > 1 THEN stem || '__' || substr(md5(doc_id::VARCHAR), 1, 8) || suffix ELSE stem || suffix END AS local_name FROM t""",
    full_directories: "SELECT source || '/' || lang AS directory, count(*) AS files FROM documents GROUP BY 1 HAVING count(*) >= 12",
    output_paths: f"""WITH p AS (SELECT ordinal, image_hash, 'images/' || coalesce(source_split, 'train') || '/' || substr(image_hash, 1, 2) || '/' || source || '_' || substr(image_hash, 1, 20) AS stem FROM ({_CAND}))
SELECT ordinal, stem || CASE WHEN ordinal % 3 = 0 THEN '.jpg' ELSE '.png' END AS path, substr(image_hash, 1, 2) AS bucket, 'labels/' || substr(stem, 8) || '.txt' AS label FROM p""",
    recording_day: "SELECT o_orderkey, CASE WHEN o_orderkey % 4 IN (0, 1) AND year(o_orderdate) >= 2000 THEN strftime(o_orderdate, '%Y-%m-%d') END AS day FROM orders",
    path_ops: """SELECT page_id, 'a/images/' || regexp_replace(url, '^[a-z]+://', '') || '/labels/p' || page_id || '.txt' AS label, nullif(regexp_replace(regexp_replace(url, '[^A-Za-z0-9_-]+', '_', 'g'), '^[_-]+|[_-]+$', '', 'g'), '') AS clean,
 page_id % 5 IN (0, 1) AS junk, page_id % 3 IN (0, 1) AS unsafe, CASE WHEN page_id % 7 = 0 THEN 'bare id ' || page_id || CASE WHEN page_id % 2 = 0 THEN '?x=/folders/no&resourcekey=k%2D' || page_id || '&x=1' ELSE '' END ELSE 'F' || page_id END AS id, CASE WHEN page_id % 2 = 0 AND page_id % 7 <> 0 THEN 'k-' || page_id END AS resource_key FROM pages""",
    archive_classify: """WITH n AS (SELECT p_partkey, 'v' || p_partkey || CASE p_partkey % 5 WHEN 0 THEN '.part' || CASE WHEN p_partkey % 25 = 0 THEN 99999999999 ELSE p_partkey % 4 + 1 END || '.RAR' WHEN 1 THEN '.zip' WHEN 2 THEN '.r' || CASE WHEN p_partkey % 2 = 0 THEN '10' ELSE '0' END || (p_partkey % 3) WHEN 3 THEN '.rar' ELSE '' END AS name FROM part)
SELECT p_partkey, name, CASE WHEN p_partkey % 5 <> 4 THEN '' WHEN p_partkey % 2 = 0 THEN '.zip' END AS kind, CASE WHEN v < 99999999999 THEN v END::INTEGER AS number, coalesce(v > 1, false) AS later
FROM (SELECT *, CASE p_partkey % 5 WHEN 0 THEN CASE WHEN p_partkey % 25 = 0 THEN 99999999999 ELSE p_partkey % 4 + 1 END WHEN 2 THEN p_partkey % 3 + 2 + CASE WHEN p_partkey % 2 = 0 THEN 100 ELSE 0 END WHEN 3 THEN 1 END AS v FROM n)""",
    content_profile: f"""WITH f AS (SELECT * FROM ({_FILES}) WHERE NOT starts_with(path, '__MACOSX/')),
d AS (SELECT DISTINCT source, string_split(path, '/')[1:i] AS d FROM f, range(1, 4) r(i) WHERE i < len(string_split(path, '/'))),
n AS (SELECT source, count(*) FILTER (WHERE lower(d[-1]) IN ('frames', 'images')) AS frames_or_images_dirs, count(*) FILTER (WHERE lower(d[-1]) = 'labels') AS labels_dirs FROM d GROUP BY source),
s AS (SELECT source, count(*) AS files, sum(n_chars)::BIGINT AS bytes, count(*) FILTER (WHERE lower(path) LIKE '%.jpg' OR path LIKE '%.png') AS images, count(*) FILTER (WHERE path LIKE '%.mp4') AS videos,
 count(*) FILTER (WHERE path LIKE '%.json' OR path LIKE '%.yml') AS annotation_files, list_sort(list(DISTINCT string_split(path, '/')[1]))[1:30] AS top_level,
 coalesce(list_sort(list(DISTINCT path) FILTER (WHERE path LIKE '%.json' OR path LIKE '%.yml'))[1:20], []) AS annotation_examples FROM f GROUP BY source)
SELECT s.source, files, bytes, images, videos, annotation_files, coalesce(frames_or_images_dirs, 0) AS frames_or_images_dirs, coalesce(labels_dirs, 0) AS labels_dirs, list_aggregate(top_level, 'string_agg', ',') AS top_level, coalesce(list_aggregate(annotation_examples, 'string_agg', ','), '') AS annotation_examples FROM s LEFT JOIN n ON n.source = s.source""",
    suffix_histogram: f"SELECT source, coalesce(nullif(lower(regexp_extract(path, '[^/](\\.[^./]+)$', 1)), ''), '<none>') AS suffix, count(*) AS n FROM ({_FILES}) WHERE NOT starts_with(path, '__MACOSX/') GROUP BY 1, 2",
    detect_format: """WITH f AS (SELECT l_partkey AS seq, CASE WHEN l_quantity > 48 THEN 3 ELSE l_suppkey % 3 END AS k FROM lineitem)
SELECT seq, CASE WHEN bool_or(k = 3) THEN 'json' WHEN bool_or(k = 0) THEN 'yolo' WHEN bool_or(k = 1) THEN 'csv' ELSE 'json' END AS format FROM f GROUP BY seq""",
    stride_filter: "SELECT event_id, CASE WHEN event_id % 10 = 0 OR event_id % 7 <> 0 THEN event_id END::INTEGER AS frame FROM events WHERE event_id % 10 = 0 OR event_id % 3 = 0",
    manifest_union_minus: "SELECT doc_id, lang FROM documents WHERE (doc_id % 2 = 0 OR doc_id % 3 = 0) AND doc_id % 10 <> 0",
    latest_annotation: "SELECT conv_id, max(turn) AS turn, arg_max(role, turn) AS role, arg_max(length(text), turn) AS n FROM conversations WHERE turn % 4 <> 3 GROUP BY conv_id",
    html_extract: "SELECT page_id, regexp_extract(html, '(?s)<title>(.*?)</title>', 1) AS title, len(string_split(html, '<p')) - 1 AS paragraphs FROM pages",
    json_props: "SELECT event_type, (props->>'k')::INTEGER AS k, count(*) AS n FROM events GROUP BY 1, 2",
    nested_transform: "SELECT vec_id, len(list_filter(embedding, lambda x: x > 0)) AS positive, list_max(embedding)::DOUBLE AS most, list_min(embedding)::DOUBLE AS least, embedding[3]::DOUBLE AS third FROM embeddings",
}
