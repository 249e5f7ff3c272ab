"""Hash fractions and what names, paths and addresses tell, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schema import ARCHIVE_SUFFIX_BY_MIME, JUNK_PARTS, SOURCE_PRIORITY


def stable_fraction(key: Column) -> Column:
    """The first eight bytes of SHA-256, big-endian, as a share of 2^64."""
    head = F.substring(F.sha2(key.cast("string").cast("binary"), 256), 1, 16)
    return F.conv(head, 16, 10).cast("decimal(20,0)").cast("double") / F.lit(18446744073709551616.0)


def hex_fraction(sha256: Column) -> Column:
    """The first twelve hex digits as a share of 16^12."""
    return F.conv(F.substring(sha256, 1, 12), 16, 10).cast("long").cast("double") / F.lit(281474976710656.0)


def recording_day(name: Column) -> Column:
    """yyyy-MM-dd from 20yy_m_d or d_m_20yy at the start of a name, up to its end or the next underscore; else null. Not checked against the calendar."""
    iso = r"^(20\d\d)_(\d{1,2})_(\d{1,2})(?:_|$)"
    day_first = r"^(\d{1,2})_(\d{1,2})_(20\d\d)(?:_|$)"
    part = lambda p, i: F.regexp_extract(name, p, i)
    two = lambda c: F.lpad(c, 2, "0")
    return F.when(name.rlike(iso), F.concat_ws("-", part(iso, 1), two(part(iso, 2)), two(part(iso, 3)))).when(name.rlike(day_first), F.concat_ws("-", part(day_first, 3), two(part(day_first, 2)), two(part(day_first, 1))))


def image_bucket(name: Column) -> Column:
    """The first two digits of the 20-digit hash at the end of an image's name; null if it has none."""
    return F.nullif(F.substring(F.regexp_extract(name, r"_([0-9a-f]{20})\.[^./]+$", 1), 1, 2), F.lit(""))


def suffix_of(path: Column) -> Column:
    """.jpg and the like in lower case, '' without one; a name that only begins with a dot has none."""
    return F.lower(F.regexp_extract(path, r"[^/](\.[^./]+)$", 1))


def stem_of(path: Column) -> Column:
    return F.regexp_replace(F.regexp_extract(path, r"([^/]*)$", 1), r"(?<=.)\.[^.]+$", "")


def with_suffix(path: Column, suffix: str) -> Column:
    return F.concat(F.regexp_replace(path, r"(?<=[^/])\.[^./]+$", ""), F.lit(suffix))


def label_path(path: Column, root: Column | None = None) -> Column:
    """The label file of an image: below root/images/ the same place below root/labels/, else labels in place of the last images folder, else beside the image."""
    moved = F.when(path.rlike(r"(^|/)images/"), F.regexp_replace(path, r"^((?:.*/)?)images/", "$1labels/")).otherwise(path)
    if root is not None:
        head = F.concat(root, F.lit("/images/"))
        moved = F.when(path.startswith(head), F.concat(root, F.lit("/labels/"), F.substr(path, F.length(head) + 1))).otherwise(moved)
    return with_suffix(moved, ".txt")


def clean_name(name: Column) -> Column:
    """Letters, digits, _ and - stay, each run of others becomes one _; ends are stripped of _ and -; null if nothing is left."""
    return F.nullif(F.regexp_replace(F.regexp_replace(name, "[^A-Za-z0-9_-]+", "_"), "^[_-]+|[_-]+$", ""), F.lit(""))


def timestamped_name(name: Column, started: Column) -> Column:
    return F.concat(F.date_format(started, "yyyy_MM_dd_HH_mm_ss"), F.lit("_"), clean_name(name))


def now() -> Column:
    """Local time in ISO form, to the second."""
    return F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss")


def source_priority(source: Column) -> Column:
    """How far a source is trusted when copies disagree; 0 for one that is not known."""
    return F.coalesce(F.try_element_at(F.create_map(*(F.lit(x) for kv in SOURCE_PRIORITY.items() for x in kv)), source), F.lit(0))


def archive_kind(name: Column, mime: Column) -> Column:
    """'' if the name says archive by itself, the suffix that a MIME type stands for, else null."""
    by_mime = F.create_map(*(F.lit(x) for kv in ARCHIVE_SUFFIX_BY_MIME.items() for x in kv))
    return F.when(F.lower(name).rlike(r"\.(zip|rar|r\d{2,3})$"), F.lit("")).otherwise(F.try_element_at(by_mime, mime))


def rar_volume(name: Column) -> Column:
    """struct(number, later): the volume that a RAR name tells (null if it is no int), and whether it isn't the first."""
    low = F.lower(name)
    part, old = F.regexp_extract(low, r"\.part(\d+)\.rar$", 1), F.regexp_extract(low, r"\.r(\d{2,3})$", 1)
    number = F.when(part != "", part.try_cast("int")).when(old != "", old.cast("int") + 2).when(low.endswith(".rar"), F.lit(1))
    return F.struct(number.alias("number"), F.when(part != "", F.ltrim(part, F.lit("0")).isin("", "1") == F.lit(False)).otherwise(F.coalesce(number > 1, F.lit(False))).alias("later"))


def in_excluded_folder(path: Column, folder: str = "verif") -> Column:
    """Whether a folder on the way to a file, given relative to the root, has that name."""
    return F.array_contains(F.split(F.regexp_replace(path, r"/?[^/]*$", ""), "/"), folder)


def is_junk(path: Column) -> Column:
    return F.exists(F.split(path, "/"), lambda p: p.isin(*JUNK_PARTS) | p.startswith("._"))


def is_unsafe_member(path: Column) -> Column:
    """Absolute, with a drive letter, or with a part that climbs up."""
    return path.rlike(r"^[/\\]") | path.rlike(r"^[A-Za-z]:") | F.array_contains(F.split(F.translate(path, "\\", "/"), "/"), "..")


def folder_reference(address: Column) -> Column:
    """struct(id, resource_key) of a shared folder's address, the key percent-decoded; without :// it is an id itself. An address of another kind has a null id."""
    place, query = F.regexp_extract(address, r"^([^?#]*)", 1), F.regexp_extract(address, r"^[^?#]*\?([^#]*)", 1)
    found = F.nullif(F.regexp_extract(place, r"/folders/([A-Za-z0-9_-]+)", 1), F.lit(""))
    key = F.nullif(F.regexp_extract(query, r"(?:^|&)resourcekey=([^&]+)", 1), F.lit(""))
    link = address.contains("://")
    return F.struct(F.when(link, found).otherwise(address).alias("id"), F.when(link, F.try_url_decode(key)).alias("resource_key"))


def frame_number(name: Column) -> Column:
    """The number after frame_; null without one, or with one that is no int."""
    return F.nullif(F.regexp_extract(name, r"(?i)^frame_(\d+)", 1), F.lit("")).try_cast("int")


def shard_number(path: Column, split: str) -> Column:
    return F.nullif(F.regexp_extract(path, rf"^shards/{split}-(\d+)\.tar$", 1), F.lit("")).try_cast("int")


def content_key(md5: Column, size: Column, modified: Column) -> Column:
    return F.coalesce(md5, F.concat(F.lit("size"), size.cast("string"), F.lit("-"), modified))


def output_path(split: Column, source: Column, sha256: Column, suffix: Column) -> Column:
    """images/<split>/<two digits>/<source>_<20 digits>.<suffix>; GIFs become JPEGs."""
    kind = F.when(suffix.isin("gif", "jpeg"), F.lit("jpg")).otherwise(suffix)
    return F.concat(F.lit("images/"), split, F.lit("/"), F.substring(sha256, 1, 2), F.lit("/"), source, F.lit("_"), F.substring(sha256, 1, 20), F.lit("."), kind)


def run_status(exit_code: Column, interrupted: Column) -> Column:
    return F.when(interrupted, "interrupted").when(exit_code.isNull() | (exit_code == 0), "ok").otherwise("failed")
