"""Patterns, names and notices."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .fixed_values import IMAGE_SIGNATURES, NOTICE_BODY, NOTICE_SUBJECT


def contains_pattern(term: Column) -> Column:
    return F.concat(F.lit("%"), term, F.lit("%"))


def prefix_pattern(term: Column) -> Column:
    return F.concat(term, F.lit("%"))


def like_any(name: Column, term: Column) -> Column:
    """LIKE '%term%'; wildcards inside the term keep their meaning."""
    return F.like(name, contains_pattern(term))


def relative_name(path: Column, prefix: Column) -> Column:
    return F.replace(path, prefix, F.lit(""))


def notice_subject() -> Column:
    return F.lit(NOTICE_SUBJECT)


def notice_body(stid: Column, stnm: Column, context: Column) -> Column:
    return F.format_string(NOTICE_BODY, stid, stnm, context)


def image_type(blob: Column) -> Column:
    """Type of an image by its leading bytes, null when none fits."""
    head = F.hex(F.substring(blob, 1, 12))
    starts = lambda kind: F.array_contains(
        F.transform(F.array(*map(F.lit, IMAGE_SIGNATURES[kind])), lambda s: F.startswith(head, s)),
        True,
    )
    # Plain maps: letter P, a digit for the kind, white space.
    plain = lambda digits: head.rlike(f"^503[{digits}](20|09|0A|0D)")
    marked = F.substring(head, 13, 8).isin("4A464946", "45786966")  # JFIF, Exif
    webp = F.startswith(head, F.lit("52494646")) & (F.substring(head, 17, 8) == "57454250")
    return (
        F.when(marked | starts("jpeg"), "jpeg")
        .when(starts("png"), "png")
        .when(starts("gif"), "gif")
        .when(starts("tiff"), "tiff")
        .when(starts("rgb"), "rgb")
        .when(plain("14"), "pbm")
        .when(plain("25"), "pgm")
        .when(plain("36"), "ppm")
        .when(starts("rast"), "rast")
        .when(starts("xbm"), "xbm")
        .when(starts("bmp"), "bmp")
        .when(webp, "webp")
        .when(starts("exr"), "exr")
    )
