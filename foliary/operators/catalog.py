"""Kinds of task, and which kind a file or URL is routed to. Lookups are literal maps, so routing needs no join."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import extension_of

# The kinds of task.
TASK_TYPES = (
    "file.compress", "image.ocr", "pptx.split", "pptx.join", "pptx.getFontInfo", "pptx.getTextShapes", "pptx.embedFonts",
    "convertor.ppt2image", "convertor.ppt2pptx", "convertor.ppt2pdf", "convertor.doc2pdf", "convertor.ppt2video",
    "convertor.pdf2image", "convertor.keynote2image", "convertor.keynote2html", "convertor.keynote2pdf", "convertor.html2png",
    "convertor.markdown2png", "convertor.html2pptx", "html.buildPlayer", "video.compress", "image.convertWebp", "image.resize",
    "pdf.parse", "pptx.parse", "docx.parseTextAndImage", "keynote.parseTextAndImage", "html.getByURL", "generation", "translation", "revamp",
)
# Kinds that take several sources in order.
MULTI_SOURCE = ("pptx.join", "convertor.html2pptx", "html.buildPlayer", "generation")
# Routing by extension.
PARSE = {".pdf": "pdf.parse", ".pptx": "pptx.parse", ".docx": "docx.parseTextAndImage", ".key": "keynote.parseTextAndImage"}
COMPRESS = {e: "file.compress" for e in (".zip", ".pptx", ".key", ".docx", ".xlsx")} | {e: "video.compress" for e in (".mp4", ".avi", ".mov", ".mkv")}
EXTRACT = {".pptx": "pptx.getFontInfo", "fonts": "pptx.getFontInfo", "text-shapes": "pptx.getTextShapes"}
CONVERT = {
    "image": {".ppt": "convertor.ppt2image", ".pptx": "convertor.ppt2image", ".pdf": "convertor.pdf2image", ".key": "convertor.keynote2image"},
    "pdf": {".ppt": "convertor.ppt2pdf", ".pptx": "convertor.ppt2pdf", ".doc": "convertor.doc2pdf", ".docx": "convertor.doc2pdf", ".key": "convertor.keynote2pdf"},
    "video": {".ppt": "convertor.ppt2video", ".pptx": "convertor.ppt2video"},
    "html": {".key": "convertor.keynote2html"},
    "png": {".html": "convertor.html2png", ".md": "convertor.markdown2png"},
    "pptx": {".ppt": "convertor.ppt2pptx", ".html": "convertor.html2pptx"},
    "webp": {".jpg": "image.convertWebp", ".jpeg": "image.convertWebp", ".png": "image.convertWebp"},
}


def _map(of: dict[str, str]) -> Column:
    return F.create_map(*map(F.lit, chain.from_iterable(of.items())))


def parse_type(name: Column) -> Column:
    return F.try_element_at(_map(PARSE), extension_of(name))


def convert_type(form: Column, name: Column) -> Column:
    pairs = {f"{form_}{ext}": kind for form_, exts in CONVERT.items() for ext, kind in exts.items()}
    return F.try_element_at(_map(pairs), F.concat(form, extension_of(name)))


def compress_type(name: Column) -> Column:
    return F.try_element_at(_map(COMPRESS), extension_of(name))


def extract_type(wanted: Column, name: Column) -> Column:
    """By the kind asked for, else by extension."""
    return F.coalesce(F.try_element_at(_map(EXTRACT), wanted), F.try_element_at(_map(EXTRACT), extension_of(name)))


# Names of the parameters of each kind that has any.
PARAMETERS = {
    "file.compress": "id",
    "image.ocr": "language",
    "pptx.split": "indexes allowSize pptId versionIds replaceFiles",
    "pptx.join": "hiddens contactId sections changedLayoutMap autoResize",
    "pptx.embedFonts": "usedFonts",
    "convertor.ppt2image": "resolution format",
    "convertor.pdf2image": "resolution format",
    "convertor.keynote2html": "isHost",
    "convertor.html2png": "scale fullPage html width height",
    "convertor.markdown2png": "scale theme pageWidth markdown",
    "convertor.html2pptx": "needEmbedFonts html width height",
    "html.buildPlayer": "contents pageWidth pageHeight title description brandMarkPosition",
    "image.resize": "maxWidth maxHeight target",
    "pdf.parse": "includeText includeImages minImageAreaRatio debug",
    "html.getByURL": "url mode",
    "generation": "inputText enableSearch advancedModel fastMode intent audience pageCount author",
    "translation": "model from to useGlossary imageTranslate",
    "revamp": "lang",
}
# Shapes of the results that are not files.
RESULTS = {
    "image.ocr": "text", "pptx.split": "slides", "pptx.getFontInfo": "fonts", "pptx.getTextShapes": "shapes", "convertor.html2pptx": "target", "pdf.parse": "pdf", "pptx.parse": "presentation",
    "docx.parseTextAndImage": "docx", "keynote.parseTextAndImage": "keynote", "html.getByURL": "html", "generation": "downloadUrl", "translation": "downloadUrl", "revamp": "downloadUrl",
}
#: What turns the results of a kind into Markdown here; the kinds themselves run elsewhere.
EXECUTORS = {"pdf.parse": "pdf_markdown", "pptx.parse": "pptx_markdown", "docx.parseTextAndImage": "docx_markdown", "keynote.parseTextAndImage": "keynote_markdown", "html.getByURL": "html_markdown"}


def task_catalog(spark: SparkSession) -> DataFrame:
    """task_type, multi_source, parameters (names, by blanks), result and executor ('none' where the results are not converted here)."""
    rows = [(t, t in MULTI_SOURCE, PARAMETERS.get(t, ""), RESULTS.get(t, "file"), EXECUTORS.get(t, "none")) for t in TASK_TYPES]
    return spark.createDataFrame(rows, "task_type string, multi_source boolean, parameters string, result string, executor string")


def validated(jobs: DataFrame, form: Column) -> DataFrame:
    """Per job: its kind and an error code. ``jobs`` has job and name, one row for each file; all files of a job must be of one kind."""
    kind = convert_type(form, F.col("name"))
    summed = jobs.select("job", kind.alias("kind")).groupBy("job").agg(F.count("*").alias("files"), F.count("kind").alias("known"), F.min("kind").alias("low"), F.max("kind").alias("high"))
    error = (
        F.when(F.col("known") < F.col("files"), "UNSUPPORTED_FORMAT")
        .when(F.col("low") != F.col("high"), "MIXED_CONVERSION_TYPES")
        .when((F.col("files") > 1) & ~F.col("low").isin(*MULTI_SOURCE), "MULTIPLE_SOURCES")
    )
    return summed.select("job", "files", F.when(error.isNull(), F.col("low")).alias("task_type"), error.alias("error_code"))
