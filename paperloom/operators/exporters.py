"""Pages, tables and key information as text, Markdown, AsciiDoc, HTML, hOCR and JSON.

Items are the ordered pieces of a page: keys, ``position``, ``label`` (the layout
label in any notation, null for none), ``lines`` (array of texts) and, for a
table, ``table`` (its text in the same format).  Everything is a column
expression over the items of a page, which come in one array a page.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import asciidoc_escaped, asciidoc_line, html_escaped, label_role, markdown_escaped, markdown_line, normal_label

#: Of each format: what parts blocks, and what parts pages (fixed values).
BREAKS = {"text": ("\n\n", "\n\n\n\n"), "markdown": ("\n\n", "\n\n---\n\n"), "asciidoc": ("\n\n", "\n\n<<<\n\n"), "html": ("\n", "\n<hr>\n")}
HEADINGS = {"markdown": {"title": "# ", "section_header": "## "}, "asciidoc": {"title": "== ", "section_header": "=== "}, "html": {"title": "h1", "section_header": "h2"}, "text": {}}
BULLETS = {"text": "", "markdown": "- ", "asciidoc": "* ", "html": ""}
ALIASES = {"md": "markdown", "adoc": "asciidoc", "txt": "text", "dict": "json", "hocr": "xml"}
ESCAPES: dict[str, Callable[[Column], Column]] = {"markdown": markdown_escaped, "asciidoc": asciidoc_escaped, "html": html_escaped}
LINES: dict[str, Callable[[Column], Column]] = {"markdown": markdown_line, "asciidoc": asciidoc_line}


def format_name(name: str) -> str:
    """Canonical name of a format; an error lists the known ones."""
    key = name.strip().lower()
    key = ALIASES.get(key, key)
    if key not in (*BREAKS, "json", "xml"):
        raise ValueError(f"unknown format {name!r}; known are {', '.join([*BREAKS, 'json', 'xml', *ALIASES])}")
    return key


def escaped(text: Column, form: str, escape: bool = True) -> Column:
    return ESCAPES[form](text) if escape and form in ESCAPES else text


def finished(line: Column, form: str, escape: bool = True) -> Column:
    """A line that no longer starts like a marker of the format."""
    return LINES[form](line) if escape and form in LINES else line


def rendered(label: Column, lines: Column, form: str, escape: bool = True) -> Column:
    """One item in a format: a heading or list entry on one line, else line by line."""
    clean = F.transform(lines, lambda t: escaped(t, form, escape))
    name, joined = normal_label(label), F.array_join(clean, " ")
    if form == "html":
        out = F.concat(F.lit("<p>"), F.array_join(clean, "<br>\n"), F.lit("</p>"))
        bullet = F.concat(F.lit("<li>"), joined, F.lit("</li>"))
        head = lambda tag: F.concat(F.lit(f"<{tag}>"), joined, F.lit(f"</{tag}>"))
    else:
        out = F.array_join(F.transform(clean, lambda t: finished(t, form, escape)), "\n")
        bullet = F.concat(F.lit(BULLETS[form]), finished(joined, form, escape))
        head = lambda mark: F.concat(F.lit(mark), joined)
    out = F.when(name == "list_item", bullet).otherwise(out)
    for key, mark in HEADINGS[form].items():
        out = F.when(name == key, head(mark)).otherwise(out)
    return out


def page_text(items: DataFrame, keys: list[str], form: str = "text", escape: bool = True, furniture: bool = True, block_break: str | None = None) -> DataFrame:
    """``text`` of each page: its items in order, runs of list entries as one list.

    Blank lines and items without any go; without ``furniture`` so do headers,
    footers and footnotes.  A page without items keeps no row.
    """
    form = format_name(form)
    gap = BREAKS[form][0] if block_break is None else block_break
    table = F.col("table") if "table" in items.columns else F.lit(None).cast("string")
    kept = items if furniture else items.filter(~label_role(F.col("label")).isin("header", "footer", "footnote"))
    lines = F.filter(F.coalesce("lines", F.array().cast("array<string>")), lambda t: F.trim(t) != "")
    kept = kept.withColumn("_lines", lines).withColumn("_table", table).filter(F.when(F.col("_table").isNotNull(), F.col("_table") != "").otherwise(F.size("_lines") > 0))
    out = F.coalesce("_table", rendered(F.col("label"), F.col("_lines"), form, escape))
    listed = F.col("_table").isNull() & (normal_label(F.col("label")) == "list_item")
    pages = kept.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("position", listed.alias("listed"), out.alias("out")))).alias("p"))
    begin, end = ("<ul>\n", "\n</ul>") if form == "html" else ("", "")
    other = lambda i: F.coalesce(F.get("p", i)["listed"], F.lit(False))

    def piece(x: Column, i: Column) -> Column:
        first, last = x["listed"] & ~((i > 0) & other(F.greatest(i - 1, F.lit(0)))), x["listed"] & ~other(i + 1)
        part = F.when(i == 0, "").when(x["listed"] & ~first, "\n").otherwise(F.lit(gap))
        return F.concat(part, F.when(first, begin).otherwise(""), x["out"], F.when(last, end).otherwise(""))

    return pages.select(*keys, F.array_join(F.transform("p", piece), "").alias("text"))


def document_text(pages: DataFrame, document: str, page: str, form: str = "text", page_break: str | None = None) -> DataFrame:
    """``text`` of each document: its pages in order with the format's break (a document is one row of the result)."""
    sep = BREAKS[format_name(form)][1] if page_break is None else page_break
    return pages.groupBy(document).agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct(page, "text"))), lambda s: s["text"]), sep).alias("text"))


def grid_rows(cells: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of tables: ``row_idx, values``, a spanning value at its top left only, later cells over earlier."""
    size = cells.groupBy(*keys).agg((F.max("row_end") + 1).alias("n_rows"), (F.max("col_end") + 1).alias("n_cols"))
    value = cells.groupBy(*keys, F.col("row_start").alias("row_idx"), F.col("col_start").alias("col_idx")).agg(F.max_by("value", "cell_idx").alias("value"))
    rows = value.groupBy(*keys, "row_idx").agg(F.map_from_entries(F.collect_list(F.struct("col_idx", F.coalesce("value", F.lit("")).alias("value")))).alias("m"))
    grid = size.withColumn("row_idx", F.explode(F.sequence(F.lit(0), F.col("n_rows") - 1)))
    full = grid.join(rows, [*keys, "row_idx"], "left")
    return full.select(*keys, "row_idx", F.transform(F.sequence(F.lit(0), F.col("n_cols") - 1), lambda c: F.coalesce(F.try_element_at("m", c), F.lit(""))).alias("values"))


def table_text(rows: DataFrame, keys: list[str], form: str = "text", escape: bool = True) -> DataFrame:
    """Tables as tab-separated lines, Markdown, AsciiDoc or HTML; the first row is the head."""
    form = format_name(form)
    v, first = F.col("values"), F.col("row_idx") == 0
    clean = lambda x: escaped(x, form) if escape else F.replace(x, F.lit("|"), F.lit("\\|"))
    cells = F.transform(v, lambda x: F.trim(F.replace(clean(x), F.lit("\n"), F.lit(" "))))
    if form == "markdown":
        line = F.concat(F.lit("| "), F.array_join(cells, " | "), F.lit(" |"))
        line = F.when(first, F.concat(line, F.lit("\n| "), F.array_join(F.transform(v, lambda _: F.lit("---")), " | "), F.lit(" |"))).otherwise(line)
    elif form == "asciidoc":
        line = F.array_join(F.transform(cells, lambda x: F.concat(F.lit("|"), x)), " ")
        line = F.when(first, F.concat(line, F.lit("\n"))).otherwise(line)
    elif form == "html":
        cell = lambda t: F.array_join(F.transform(v, lambda x: F.concat(F.lit(f"<{t}>"), F.trim(escaped(x, form, escape)), F.lit(f"</{t}>"))), "")
        line = F.concat(F.lit("<tr>"), F.when(first, cell("th")).otherwise(cell("td")), F.lit("</tr>"))
    else:
        line = F.array_join(v, "\t")
    out = rows.groupBy(*keys).agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("row_idx", line.alias("line")))), lambda s: s["line"]), "\n").alias("text"))
    wrap = {"asciidoc": ("|===\n", "\n|==="), "html": ("<table>\n", "\n</table>")}.get(form)
    return out.withColumn("text", F.concat(F.lit(wrap[0]), F.col("text"), F.lit(wrap[1]))) if wrap else out


def pixel(v: Column, size: Column) -> Column:
    """Relative coordinate in pixels, halves to even."""
    return F.bround(v * size).cast("long")


def hocr_box(box: tuple[Column, ...], width: Column, height: Column) -> Column:
    """The ``bbox`` property of a relative box."""
    return F.concat_ws(" ", F.lit("bbox"), pixel(box[0], width), pixel(box[1], height), pixel(box[2], width), pixel(box[3], height))


def hocr_size(box: tuple[Column, ...], height: Column, dpi: int = 72) -> tuple[Column, Column]:
    """Height of a line in pixels and its font size in points."""
    size = F.bround((box[3] - box[1]) * height).cast("long")
    return size, F.bround(size * 72 / dpi).cast("long")


def hocr_language(language: Column) -> Column:
    """Language of the page, English where there is none."""
    return F.when(F.length(language) > 0, language).otherwise("en")


def _tag(name: str, kind: str, mark: Column, title: Column, body: Column) -> Column:
    return F.concat(F.lit(f'<{name} class="{kind}" id="'), mark, F.lit('" title="'), title, F.lit('">'), body, F.lit(f"</{name}>"))


def _line_title(box: tuple[Column, ...], width: Column, height: Column, dpi: int) -> Column:
    size, font = hocr_size(box, height, dpi)
    return F.concat(hocr_box(box, width, height), F.lit("; baseline 0 0; x_size "), size, F.lit("; x_fsize "), font, F.lit("; x_descenders 0; x_ascenders 0"))


def hocr_document(body: Column, language: Column, title: str = "hOCR export", system: str = "paperloom") -> Column:
    """The whole hOCR text around the body of a page."""
    head = (
        f"<head><title>{title}</title><meta http-equiv=\"Content-Type\" content=\"text/html; charset=utf-8\" /><meta name=\"ocr-system\" content=\"{system}\" />"
        '<meta name="ocr-capabilities" content="ocr_page ocr_carea ocr_par ocr_line ocrx_word" /></head>'
    )
    return F.concat(F.lit('<html xmlns="http://www.w3.org/1999/xhtml" xml:lang="'), hocr_language(language), F.lit(f'">{head}<body>'), body, F.lit("</body></html>"))


def page_hocr(words: DataFrame, keys: list[str], page: str, width: int, height: int, dpi: int = 72) -> DataFrame:
    """``hocr`` of each page: areas, paragraphs, lines and words with numbers that run through the page.

    ``words``: keys, ``block_idx, line_idx, word_idx`` in reading order, the
    relative box ``x0..y1``, ``value`` and ``confidence`` (0..1); optional ``language``.
    """
    w, h = F.lit(width), F.lit(height)
    box = tuple(F.col(c) for c in ("x0", "y0", "x1", "y1"))
    order = Window.partitionBy(*keys).orderBy("block_idx", "line_idx", "word_idx")
    number = lambda c: F.dense_rank().over(Window.partitionBy(*keys).orderBy(*c))
    word = words.withColumns({"_w": F.row_number().over(order), "_l": number(["block_idx", "line_idx"]), "_b": number(["block_idx"])})
    text = _tag("span", "ocrx_word", F.concat(F.lit("word_"), "_w"), F.concat(hocr_box(box, w, h), F.lit("; x_wconf "), F.bround(F.col("confidence") * 100).cast("long")), html_escaped(F.col("value")))
    edges = [f(c).alias(c) for f, c in ((F.min, "x0"), (F.min, "y0"), (F.max, "x1"), (F.max, "y1"))]
    inner = lambda key, c: F.array_join(F.transform(F.sort_array(F.collect_list(F.struct(key, F.col(c).alias("t")))), lambda s: s["t"]), "").alias("t")
    language = F.max("language").alias("language") if "language" in words.columns else F.lit(None).cast("string").alias("language")
    lines = word.withColumn("t", text).groupBy(*keys, "_b", "_l").agg(inner("_w", "t"), *edges, language)
    lines = lines.withColumn("t", _tag("span", "ocr_line", F.concat(F.lit("line_"), "_l"), _line_title(box, w, h, dpi), F.col("t")))
    blocks = lines.groupBy(*keys, "_b").agg(inner("_l", "t"), *edges, F.max("language").alias("language"))
    title = hocr_box(box, w, h)
    area = _tag("div", "ocr_carea", F.concat(F.lit("block_"), "_b"), title, _tag("p", "ocr_par", F.concat(F.lit("par_"), "_b"), title, F.col("t")))
    pages = blocks.withColumn("t", area).groupBy(*keys).agg(inner("_b", "t"), F.max("language").alias("language"))
    div = _tag("div", "ocr_page", F.concat(F.lit("page_"), F.col(page) + 1), F.lit(f"image; bbox 0 0 {width} {height}; ppageno 0"), F.col("t"))
    return pages.select(*keys, hocr_document(div, F.col("language")).alias("hocr"))


def table_hocr(cells: DataFrame, keys: list[str], width: int, height: int, dpi: int = 72) -> DataFrame:
    """``hocr`` area of each table: a line for each row, a word for each cell.

    ``cells``: keys, ``table_idx`` (from 0), ``row_start, col_start, value, confidence`` and the relative box.
    """
    w, h, box = F.lit(width), F.lit(height), tuple(F.col(c) for c in ("x0", "y0", "x1", "y1"))
    number, row = F.col("table_idx") + 1, F.col("row_start") + 1
    at = F.row_number().over(Window.partitionBy(*keys, "table_idx", "row_start").orderBy("col_start", "x0"))
    cell = cells.withColumn("_c", at)
    text = _tag("span", "ocrx_word", F.concat(F.lit("table_"), number, F.lit("_cell_"), row, F.lit("_"), "_c"), F.concat(hocr_box(box, w, h), F.lit("; x_wconf "), F.bround(F.col("confidence") * 100).cast("long")), html_escaped(F.coalesce("value", F.lit(""))))
    edges = [f(c).alias(c) for f, c in ((F.min, "x0"), (F.min, "y0"), (F.max, "x1"), (F.max, "y1"))]
    inner = lambda key, c: F.array_join(F.transform(F.sort_array(F.collect_list(F.struct(key, F.col(c).alias("t")))), lambda s: s["t"]), "").alias("t")
    rows = cell.withColumn("t", text).groupBy(*keys, "table_idx", "row_start").agg(inner("_c", "t"), *edges)
    rows = rows.withColumn("t", _tag("span", "ocr_line", F.concat(F.lit("table_"), number, F.lit("_row_"), row), _line_title(box, w, h, dpi), F.col("t")))
    tables = rows.groupBy(*keys, "table_idx").agg(inner("row_start", "t"), *edges)
    title = hocr_box(box, w, h)
    return tables.select(*keys, "table_idx", _tag("div", "ocr_carea", F.concat(F.lit("table_"), number), title, _tag("p", "ocr_par", F.concat(F.lit("table_par_"), number), title, F.col("t"))).alias("hocr"))


def page_json(words: DataFrame, keys: list[str]) -> DataFrame:
    """Pages as nested JSON: lines of words with geometry."""
    geometry = F.array("x0", "y0", "x1", "y1").alias("geometry")
    lines = words.groupBy(*keys, "line_idx").agg(F.sort_array(F.collect_list(F.struct("word_idx", "value", geometry))).alias("words"))
    return lines.groupBy(*keys).agg(F.to_json(F.struct(F.transform(F.sort_array(F.collect_list(F.struct("line_idx", "words"))), lambda s: F.struct(s["words"].alias("words"))).alias("lines"))).alias("json"))


def kie_text(predictions: DataFrame, keys: list[str], form: str = "text", escape: bool = True) -> DataFrame:
    """``text`` of each page: a section for each class, its values in order.

    ``predictions``: keys, ``class_idx`` and ``class_name`` in stored order, ``position``, ``value``.
    """
    form = format_name(form)
    name = escaped(F.col("class_name"), form, escape)
    mark = {"text": ("", ":"), "markdown": ("**", "**"), "asciidoc": ("*", "*"), "html": ("<h3>", "</h3>")}[form]
    head = F.concat(F.lit(mark[0]), name, F.lit(mark[1]))
    value = escaped(F.col("value"), form, escape)
    value = F.concat(F.lit("<li>"), value, F.lit("</li>")) if form == "html" else F.concat(F.lit(BULLETS[form]), finished(value, form, escape))
    values = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("position", value.alias("v")))), lambda s: s["v"]), "\n").alias("values")
    sections = predictions.groupBy(*keys, "class_idx", "class_name").agg(values)
    part = F.concat(head, F.lit("\n<ul>\n"), "values", F.lit("\n</ul>")) if form == "html" else F.concat(head, F.lit("\n\n"), "values")
    parts = sections.select(*keys, "class_idx", part.alias("part"))
    return parts.groupBy(*keys).agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("class_idx", "part"))), lambda s: s["part"]), BREAKS[form][0]).alias("text"))


def kie_hocr(predictions: DataFrame, keys: list[str], page: str, width: int, height: int, dpi: int = 72) -> DataFrame:
    """``hocr`` of each page of key information: an area, paragraph, line and word for each prediction.

    ``predictions``: as for ``kie_text``, with the relative box and ``confidence``.
    """
    w, h, box = F.lit(width), F.lit(height), tuple(F.col(c) for c in ("x0", "y0", "x1", "y1"))
    n = F.row_number().over(Window.partitionBy(*keys).orderBy("class_idx", "position"))
    rows = predictions.withColumn("_n", n)
    mark = lambda part: F.concat("class_name", F.lit(f"_{part}_"), "_n")
    word = _tag("span", "ocrx_word", mark("word"), F.concat(hocr_box(box, w, h), F.lit("; x_wconf "), F.bround(F.col("confidence") * 100).cast("long")), html_escaped(F.col("value")))
    line = _tag("span", "ocr_line", mark("line"), _line_title(box, w, h, dpi), word)
    area = _tag("div", "ocr_carea", mark("prediction"), hocr_box(box, w, h), _tag("p", "ocr_par", mark("par"), hocr_box(box, w, h), line))
    pages = rows.withColumn("t", area).groupBy(*keys).agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("_n", "t"))), lambda s: s["t"]), "").alias("t"))
    empty = _tag("div", "ocr_page", F.concat(F.lit("page_"), F.col(page) + 1), F.lit(f"image; bbox 0 0 {width} {height}; ppageno 0"), F.lit(""))
    return pages.select(*keys, hocr_document(F.concat(empty, "t"), F.lit(None)).alias("hocr"))


def kie_lines(predictions: DataFrame, keys: list[str]) -> DataFrame:
    """``text`` of each page: one ``class: value`` for each prediction, classes in stored order."""
    line = F.concat_ws(": ", "class_name", "value")
    return predictions.groupBy(*keys).agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("class_idx", "position", line.alias("v")))), lambda s: s["v"]), "\n\n").alias("text"))


def export_as(form: str, keys: list[str], items: DataFrame | None = None, words: DataFrame | None = None, predictions: DataFrame | None = None, page: str = "page_idx", width: int = 1, height: int = 1, **options: object) -> DataFrame:
    """Pages in the format of the name: ``text`` and its markups from items, JSON and hOCR from words, any of them from predictions."""
    name = format_name(form)
    if predictions is not None:
        return kie_hocr(predictions, keys, page, width, height) if name == "xml" else kie_text(predictions, keys, name, **options)
    if name == "json":
        return page_json(words, keys)
    if name == "xml":
        return page_hocr(words, keys, page, width, height, **options)
    return page_text(items, keys, name, **options)


def documents_as(form: str, pages: DataFrame, document: str, page: str, page_break: str | None = None) -> DataFrame:
    """Documents from exported pages; JSON becomes a list of the pages."""
    if format_name(form) == "json":
        ordered = F.transform(F.sort_array(F.collect_list(F.struct(page, "json"))), lambda s: s["json"])
        return pages.groupBy(document).agg(F.concat(F.lit('{"pages":['), F.array_join(ordered, ","), F.lit("]}")).alias("json"))
    return document_text(pages, document, page, form, page_break)
