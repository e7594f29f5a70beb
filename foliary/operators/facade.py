"""Results of parse tasks to Markdown by kind of task: the one entry for files, stored files and links."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.files import decoded
from . import catalog, html, nested, paged, slides

LINK = "html.getByURL"


def kind_of(name: Column, url: Column) -> Column:
    """Links have a kind of their own; files go by the extension of their name; null if none fits."""
    return F.when(url.isNotNull(), LINK).otherwise(catalog.parse_type(name))


def unsupported(name: Column) -> Column:
    """What a file without a parser is refused with."""
    shown = F.when(F.coalesce(name, F.lit("")) != "", F.concat(F.lit('"'), name, F.lit('"'))).otherwise("input")
    return F.concat(F.lit("Cannot determine parser for "), shown, F.lit(f". Supported extensions: {', '.join(catalog.PARSE)}. Pass {{ name }} to specify the file name."))


def markdown(results: DataFrame) -> DataFrame:
    """``results`` (name, url, result as JSON, any other columns) with task_type, markdown and error.

    Each kind is a branch over its own rows, read once: paged kinds stay in Spark's expressions,
    slides and pages go through Arrow. A result that does not fit its kind gives an error in its row.
    """
    typed = results.withColumn("task_type", kind_of(F.col("name"), F.col("url")))
    result = F.col("result")
    of = lambda kind: F.when(F.col("task_type") == kind, result)
    page = html.converted(F.get_json_object(of(LINK), "$.html"), F.col("url"))
    found = (
        F.when(F.col("task_type") == "pdf.parse", paged.pdf_markdown(decoded(of("pdf.parse"), paged.PDF_SCHEMA)))
        .when(F.col("task_type") == "docx.parseTextAndImage", paged.docx_markdown(decoded(of("docx.parseTextAndImage"), paged.DOCX_SCHEMA), texts_of=nested.texts_of_each))
        .when(F.col("task_type") == "keynote.parseTextAndImage", paged.keynote_markdown(decoded(of("keynote.parseTextAndImage"), paged.KEYNOTE_SCHEMA)))
        .when(F.col("task_type") == "pptx.parse", slides.markdown(of("pptx.parse")))
    )
    own = [c for c in typed.columns if c not in ("markdown", "error", "_page")]
    with_page = typed.select(*own, F.when(F.col("task_type") == LINK, page).alias("_page"), found.alias("markdown"))
    link = F.col("task_type") == LINK
    error = F.when(F.col("task_type").isNull(), unsupported(F.col("name"))).when(link, F.col("_page.error")).when(F.col("markdown").isNull(), "the result does not fit its kind")
    return with_page.select(*own, F.when(link, F.col("_page.markdown")).otherwise(F.col("markdown")).alias("markdown"), error.alias("error"))
