"""Logo pictures in a binary column: type, stable name, data URI and the outcome of a batch."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postlens.functions.text import col, logo_key

# fixed values: leading bytes (as hex pattern of the first 12 bytes) -> picture type
IMAGE_TYPES = (
    ("jpeg", "^.{12}(4A464946|45786966)|^FFD8FFDB"),
    ("png", "^89504E470D0A1A0A"),
    ("gif", "^474946383[79]61"),
    ("tiff", "^(4D4D|4949)"),
    ("rgb", "^01DA"),
    ("pbm", "^503[14](20|09|0A|0D)"),
    ("pgm", "^503[25](20|09|0A|0D)"),
    ("ppm", "^503[36](20|09|0A|0D)"),
    ("rast", "^59A66A95"),
    ("xbm", "^23646566696E6520"),
    ("bmp", "^424D"),
    ("webp", "^52494646.{8}57454250"),
    ("exr", "^762F3101"),
)


def image_type(content: Column | str) -> Column:
    """Picture type by leading bytes, NULL when unknown."""
    head = F.hex(F.substring(col(content), 1, 12))
    return F.coalesce(*[F.when(head.rlike(pattern), F.lit(name)) for name, pattern in IMAGE_TYPES])


def object_name(url: Column | str, kind: Column) -> Column:
    return F.concat(F.lit("logos/"), logo_key(url), F.lit("."), kind)


def mime_subtype(kind: Column) -> Column:
    return F.when(kind == "png", "png").when(kind.isNotNull(), "jpeg")


def data_uri(content: Column | str, kind: Column) -> Column:
    # `base64` breaks its output into lines of 76 characters
    text = F.regexp_replace(F.base64(col(content)), r"\s", "")
    return F.concat(F.lit("data:image/"), mime_subtype(kind), F.lit(";base64,"), text)


def store_logos(pictures: DataFrame) -> DataFrame:
    """(logo_url, content) with type, object name, data URI and status; an unknown picture fails alone."""
    named = pictures.withColumn("kind", image_type("content"))
    kind = F.col("kind")
    return named.select(
        "logo_url",
        "kind",
        object_name("logo_url", kind).alias("object_name"),
        data_uri("content", kind).alias("logo_path"),
        F.when(kind.isNull(), "failed").otherwise("stored").alias("status"),
    )


def stored_or_raise(results: DataFrame) -> DataFrame:
    """The stored pictures; raises only when there were failures and nothing was stored."""
    counts = results.agg(
        F.count_if(F.col("status") == "stored").alias("stored"), F.count_if(F.col("status") == "failed").alias("failed")
    ).first()
    if counts["failed"] and not counts["stored"]:
        raise RuntimeError(f"none of {counts['failed']} logos could be stored")
    return results.filter(F.col("status") == "stored")
