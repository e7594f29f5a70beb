"""Structured results of parsers to Markdown, as expressions over one nested row for each document; nothing is shuffled."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions.text import filled, image, joined, table, trimmed, without_extension

PDF_SCHEMA = (
    "struct<textBlocks:array<struct<text:string,role:string,style:struct<bold:boolean,italic:boolean>,locator:struct<pageIndex:int>>>,"
    "images:array<struct<key:string,fileName:string,locator:struct<pageIndex:int>,bytes:bigint,hash:string>>>"
)
KEYNOTE_SCHEMA = (
    "struct<slides:array<struct<text:array<struct<id:string,text:string>>,table:array<struct<id:string,data:array<string>>>,"
    "chart:array<struct<id:string,data:struct<rowName:array<string>,columnName:array<string>>>>>>,"
    "images:array<struct<id:string,fileName:string,pageIndex:double,key:string>>,pageNum:int,width:double,height:double>"
)
DOCX_SCHEMA = (
    "struct<width:double,height:double,pageNum:int,content:array<struct<idx:double,type:string,text:string,style:struct<styleId:string,styleName:string,outlineLvl:double>,"
    "image:string,name:string,children:string,table:array<array<string>>,series:array<string>,categories:array<string>,texts:array<string>>>>"
)
ToUrl = Callable[[Column], Column]


def _same(key: Column) -> Column:
    return key


def _some(array: Column, kind: str) -> Column:
    return F.coalesce(array, F.array().cast(kind))


def pdf_markdown(result: Column, to_url: ToUrl = _same) -> Column:
    """Text blocks by page and position, then the images of the page; all apart by a blank line. A missing page is the first."""

    def block(b: Column, at: Column) -> Column:
        text = trimmed(b["text"])
        line = (
            F.when(b["role"] == "heading", F.concat(F.lit("## "), text))
            .when(b["role"] == "list-item", F.concat(F.lit("- "), text))
            .when(b["role"] == "caption", F.concat(F.lit("*"), text, F.lit("*")))
            .when(b["style"]["bold"], F.concat(F.lit("**"), text, F.lit("**")))
            .when(b["style"]["italic"], F.concat(F.lit("*"), text, F.lit("*")))
            .otherwise(text)
        )
        return F.struct(F.coalesce(b["locator"]["pageIndex"], F.lit(0)).alias("page"), F.lit(0).alias("kind"), at.alias("at"), F.when(text != "", line).alias("line"))

    def picture(i: Column, at: Column) -> Column:
        line = F.when(i["key"] != "", image(F.coalesce(filled(i["fileName"]), F.lit("img")), to_url(i["key"])))
        return F.struct(F.coalesce(i["locator"]["pageIndex"], F.lit(0)).alias("page"), F.lit(1).alias("kind"), at.alias("at"), line.alias("line"))

    kind = "array<struct<page:int,kind:int,at:int,line:string>>"
    parts = F.concat(_some(F.transform(result["textBlocks"], block), kind), _some(F.transform(result["images"], picture), kind))
    return joined(F.transform(F.array_sort(parts), lambda p: p["line"]), "\n\n")


def keynote_markdown(result: Column, to_url: ToUrl = _same) -> Column:
    """A page for each slide that is not blank: texts, tables, charts, images; images of no slide come last, on a page of their own."""
    images = F.filter(result["images"], lambda i: i["key"] != "")
    slides = _some(result["slides"], KEYNOTE_SCHEMA[len("struct<slides:") : KEYNOTE_SCHEMA.index(",images:")])
    count = F.size(slides)
    lines = lambda of: F.array_join(F.transform(of, lambda i: image(F.lit("img"), to_url(i["key"]))), "\n")
    valid = lambda i: F.coalesce((i["pageIndex"] == F.floor(i["pageIndex"])) & (i["pageIndex"] >= 0) & (i["pageIndex"] < count), F.lit(False))
    spoken = lambda values: F.array_join(F.filter(values, lambda v: trimmed(v) != ""), " | ")

    def page(s: Column, at: Column) -> Column:
        texts = joined(F.transform(s["text"], lambda t: trimmed(t["text"])), "\n")
        tables = joined(F.transform(s["table"], lambda t: F.array_join(F.filter(F.transform(t["data"], trimmed), lambda c: c != ""), " | ")), "\n")
        charts = joined(F.flatten(F.transform(s["chart"], lambda c: F.array(spoken(c["data"]["columnName"]), spoken(c["data"]["rowName"])))), "\n")
        return joined(F.array(texts, tables, charts, lines(F.filter(images, lambda i: valid(i) & (i["pageIndex"] == at)))), "\n")

    pages = F.transform(slides, page)
    last = lines(F.filter(images, lambda i: ~valid(i)))
    return joined(F.concat(pages, F.array(F.coalesce(last, F.lit("")))), "\n\n---\n\n")


def docx_markdown(result: Column, to_url: ToUrl = _same, texts_of: ToUrl | None = None) -> Column:
    """Elements by index. ``texts_of`` turns the JSON texts of all elements' children (an array) into an array of their texts for each."""

    def cells(rows: Column) -> Column:
        clean = lambda c: F.regexp_replace(F.replace(trimmed(c), F.lit("|"), F.lit("\\|")), r"\s*\n\s*", " ")
        return F.transform(F.filter(rows, lambda r: F.size(r) > 0), lambda r: F.transform(r, lambda c: F.coalesce(clean(c), F.lit(""))))

    def block(e: Column, inner: Column) -> Column:
        text, level = trimmed(e["text"]), e["style"]["outlineLvl"]
        whole = (level >= 0) & (level == F.floor(level))
        title = F.lower(F.concat_ws(" ", e["style"]["styleId"], e["style"]["styleName"])).contains("title")
        prefix = F.when(whole, F.concat(F.repeat(F.lit("#"), F.least(level + 1, F.lit(6)).cast("int")), F.lit(" "))).when(title, "# ").otherwise("")
        rows = cells(e["table"])
        return (
            F.when((e["type"] == "text") & (text != ""), F.concat(prefix, text))
            .when((e["type"] == "image") & (e["image"] != ""), image(F.when(e["name"] != "", without_extension(e["name"])).otherwise("img"), to_url(e["image"])))
            .when((e["type"] == "table") & F.exists(F.flatten(rows), lambda c: c != ""), table(rows))
            .when(e["type"] == "chart", joined(F.array(joined(e["categories"], " | "), joined(e["series"], " | ")), "\n"))
            .when(e["type"].isin("diagram", "sdt"), joined(F.transform(F.coalesce(e["texts"], F.array(e["text"])), trimmed), "\n"))
            .when(e["type"].isin("group", "wsp"), joined(F.transform(inner, trimmed), "\n"))
        )

    content = result["content"]
    placed = lambda e, at, inner: F.struct(F.coalesce(e["idx"], F.lit(0.0)).alias("idx"), at.alias("at"), block(e, inner).alias("block"))
    if texts_of is None:
        numbered = F.transform(content, lambda e, at: placed(e, at, F.array().cast("array<string>")))
    else:  # a Python function may not stand inside a lambda, so children are opened beside the elements
        opened = texts_of(F.transform(content, lambda e: e["children"]))
        numbered = F.transform(F.arrays_zip(content.alias("e"), opened.alias("inner")), lambda p, at: placed(p["e"], at, p["inner"]))
    return F.coalesce(joined(F.transform(F.array_sort(numbered), lambda b: b["block"]), "\n\n"), F.lit(""))
