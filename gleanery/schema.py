"""Record types and the constants that are part of the semantics."""

from __future__ import annotations

# --- fixed values -------------------------------------------------------------------------------------------------
SOURCE_PRIORITY = {
    "recordings": 120, "gem_new": 115, "gem": 110, "midgard": 105, "antiuav": 100, "pathik": 90,
    "kaggle1_xml": 85, "kaggle2": 80, "kaggle3": 70, "rigoleto": 60, "kaggle1_yolo": 50,
}
SPLITS = ("train", "val", "test")
SPLIT_TARGETS = (0.8, 0.1, 0.1)
BUILD_IMAGE_SUFFIXES = ("bmp", "gif", "jpeg", "jpg", "png", "webp")
IMAGE_SUFFIXES = ("bmp", "jpeg", "jpg", "png", "tif", "tiff", "webp")
VIDEO_SUFFIXES = ("avi", "m4v", "mkv", "mov", "mp4", "webm")
MIN_BOX_PIXELS = 8.0
NEAR_DUPLICATE_BITS = 10
ASPECT_TOLERANCE = 0.02
STRIDE = 3
VALIDATOR_TOLERANCE = 1e-6
REPAIR_TOLERANCE = 1e-9
BUCKET_FILES = 10_000
SHARD_BYTES = 1 << 30
ANNOTATION_SUFFIXES = ("json", "csv", "txt", "xml", "yaml", "yml", "parquet")
JUNK_PARTS = ("__MACOSX", ".DS_Store", "Thumbs.db", "desktop.ini")
ARCHIVE_SUFFIX_BY_MIME = {
    "application/zip": ".zip",
    "application/x-zip-compressed": ".zip",
    "application/x-rar": ".rar",
    "application/x-rar-compressed": ".rar",
    "application/vnd.rar": ".rar",
}
HANDLED_AGAIN = ("new", "download_failed", "downloading", "ignored")
NO_ORIGINAL = ("download_failed", "ignored", "duplicate")
MANIFEST = "output_image string, split string, source string, original string, sha256 string, visual_hash string, `group` string, source_split string, width int, height int, boxes int, negative_kind string, removed_classes string"
NEAR_DUPLICATE_COLUMNS = ("hamming_distance", "source_a", "image_a", "sha256_a", "source_b", "image_b", "sha256_b")
# ------------------------------------------------------------------------------------------------------------------

LABEL_STUDIO = "array<struct<data:struct<video_url:string>,annotations:array<struct<id:bigint,was_cancelled:boolean,result:array<struct<type:string,value:struct<labels:array<string>,framesCount:int,sequence:array<struct<frame:int,time:double,enabled:boolean,rotation:double,x:double,y:double,width:double,height:double>>>>>>>>>"
EDITOR = "struct<exist:array<int>,gt_rect:array<array<double>>>"
