"""Checks of jobs before anything is uploaded: an error code, or null if the job may go."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions.text import extension_of, positive

# Languages and extensions that the kinds of task accept.
OCR_LANGUAGES = ("zh-hans", "zh-hant", "en", "ja", "ko", "ar", "de", "es", "fr", "it", "pt", "ru")
OCR_FILES = (".jpg", ".jpeg", ".png")
TRANSLATION_TARGETS = ("zh", "zh-hans", "zh-hant", "en", "ja", "ko", "de", "fr", "es", "it", "pt", "ru")
TRANSLATION_FILES = (".docx", ".pptx", ".pdf", ".xlsx", ".key")
GENERATION_FILES = (".html", ".pdf", ".docx", ".pptx", ".txt", ".md", ".mm", ".xmind", ".ipynb")


def _all_of(files: Column, extensions: tuple[str, ...]) -> Column:
    return F.forall(files, lambda f: extension_of(f).isin(*extensions))


def join_error(files: Column) -> Column:
    return F.when(F.size(files) < 2, "INVALID_ARGS").when(~_all_of(files, (".pptx",)), "UNSUPPORTED_TYPE")


def generation_error(text: Column, files: Column) -> Column:
    return (
        F.when((F.coalesce(text, F.lit("")) == "") & (F.size(files) == 0), "GENERATION_INPUT_REQUIRED")
        .when(F.size(files) > 2, "GENERATION_TOO_MANY_FILES")
        .when(~_all_of(files, GENERATION_FILES), "UNSUPPORTED_TYPE")
    )


def translation_error(source: Column, target: Column, file: Column) -> Column:
    known = lambda c, values: F.coalesce(c.isin(*values), F.lit(False))
    return (
        F.when(~known(source, ("auto", *TRANSLATION_TARGETS)), "INVALID_SOURCE_LANGUAGE")
        .when(~known(target, TRANSLATION_TARGETS), "INVALID_TARGET_LANGUAGE")
        .when(~known(extension_of(file), TRANSLATION_FILES), "UNSUPPORTED_TYPE")
    )


def ocr_error(language: Column, file: Column) -> Column:
    return F.when(~F.coalesce(language.isin(*OCR_LANGUAGES), F.lit(False)), "INVALID_LANGUAGE").when(~F.coalesce(extension_of(file).isin(*OCR_FILES), F.lit(False)), "UNSUPPORTED_TYPE")


def size_error(width: Column, height: Column) -> Column:
    """Both sides are whole numbers above zero where they are given at all."""
    wrong = lambda c: c.isNotNull() & positive(c).isNull()
    return F.when(wrong(width) | wrong(height), "INVALID_ARGS")
