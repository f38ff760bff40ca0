"""Web pages to blocks: a tolerant tokenizer in the tasks, everything after it in DataFrame functions."""

from __future__ import annotations

from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Element classes of HTML.
RAW = {"script", "style", "noscript", "template"}
VOID = {"br", "img", "hr", "input", "meta", "link", "source", "wbr", "area", "base", "col", "embed", "track"}
HEADINGS = {f"h{k}": k for k in range(1, 7)}
CLOSES_P = {"p", "div", "ul", "ol", "table", "section", "article", "pre", "blockquote", "form", "header", "footer", "nav", "main", "figure", "hr", *HEADINGS}
INLINE = {"b": "**", "strong": "**", "i": "*", "em": "*", "code": "`"}
ROOTS = ("article", "main", "body")

BLOCKS = "block_ord int, block_type string, level int, text string, root string, row_id int, col_id int, is_header boolean, attrs map<string,string>"


class _Page(HTMLParser):
    """Collects block tuples in document order. Unclosed paragraphs and inline marks end where a block begins or ends."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.blocks: list[tuple] = []
        self.open: list[str] = []
        self.raw = 0
        self.kind, self.level, self.parts, self.attrs = None, None, [], {}
        self.table: list[int] = []  # current row of each open table
        self.column, self.header = 0, False
        self.title_on, self.meta = False, {}

    def flush(self) -> None:
        text = "".join(self.parts).strip() if self.kind == "Code" else " ".join("".join(self.parts).split())
        if self.kind and text:
            root = next((r for r in ROOTS if r in self.open), "")
            cell = self.kind == "TableCell"
            self.blocks.append((len(self.blocks), self.kind, self.level, text, root, self.table[-1] if cell and self.table else None, self.column if cell else None, self.header if cell else None, self.attrs))
        if self.kind == "TableCell":
            self.column += 1
        self.kind, self.level, self.parts, self.attrs = None, None, [], {}

    def begin(self, kind: str, level: int | None = None, attrs: dict | None = None) -> None:
        self.flush()
        self.kind, self.level, self.attrs = kind, level, attrs or {}

    def handle_starttag(self, tag: str, attrs: list) -> None:
        given = {k: v or "" for k, v in attrs}
        if tag in RAW:
            self.raw += 1
            return
        if self.raw:
            return
        if tag == "meta":
            if given.get("name") or given.get("property"):
                self.meta[given.get("name") or given["property"]] = given.get("content", "")
            elif "charset" in given:
                self.meta["charset"] = given["charset"]
        elif tag == "html" and "lang" in given:
            self.meta["lang"] = given["lang"]
        elif tag == "title":
            self.title_on = True
        elif tag == "img":
            self.flush()
            self.blocks.append((len(self.blocks), "Picture", None, given.get("alt", ""), next((r for r in ROOTS if r in self.open), ""), None, None, None, given))
        elif tag == "br":
            self.parts.append("\n")
        elif tag in HEADINGS:
            self.begin("SectionHeader", HEADINGS[tag])
        elif tag == "p":
            self.begin("Text")
        elif tag == "li":
            self.begin("ListItem")
        elif tag == "pre":
            self.begin("Code", attrs=given)
        elif tag == "code" and self.kind == "Code":
            self.attrs = self.attrs | {"language": next((c[9:] for c in given.get("class", "").split() if c.startswith("language-")), "")}
        elif tag == "blockquote":
            self.begin("Text", attrs={"quote": "true"})
        elif tag == "table":
            self.flush()
            self.table.append(-1)
        elif tag == "tr" and self.table:
            self.flush()
            self.table[-1] += 1
            self.column = 0
        elif tag in ("td", "th") and self.table:
            self.begin("TableCell", attrs={k: v for k, v in given.items() if k in ("rowspan", "colspan")})
            self.header = tag == "th" or "thead" in self.open
        elif tag == "a" and self.kind:
            self.attrs = self.attrs | {"href": given.get("href", "")}
        elif tag in INLINE and self.kind and self.kind != "Code":
            self.parts.append(INLINE[tag])
        elif tag in CLOSES_P:
            self.flush()
        if tag not in VOID:
            self.open.append(tag)

    def handle_endtag(self, tag: str) -> None:
        if tag in RAW:
            self.raw = max(0, self.raw - 1)
            return
        if self.raw:
            return
        if tag == "title":
            self.title_on = False
        if tag in INLINE and self.kind and self.kind != "Code" and tag in self.open:
            self.parts.append(INLINE[tag])
        elif tag in CLOSES_P or tag in ("li", "td", "th", "tr"):
            self.flush()
        if tag == "table" and self.table:
            self.table.pop()
        if tag in self.open:
            while self.open.pop() != tag:
                pass

    def handle_data(self, data: str) -> None:
        if self.raw:
            return
        if self.title_on:
            self.meta["title"] = self.meta.get("title", "") + data
        elif self.kind:
            self.parts.append(data)


def parse(html: str | None) -> tuple[list[tuple], dict[str, str]]:
    """(blocks, metadata) of one page. Only the content root counts: the first of article, main and body that has blocks."""
    page = _Page()
    page.feed(html or "")
    page.close()
    page.flush()
    root = next((r for r in ROOTS if any(b[4] == r for b in page.blocks)), "")
    kept = [b for b in page.blocks if b[4] == root]
    return [(k, *b[1:]) for k, b in enumerate(kept)], page.meta


#: Pages whose blocks a worker holds at once.
PAGES = 64


def _block_batches(page_id: str):
    names = [c.split()[0] for c in BLOCKS.split(", ")]
    types = [{"int": pa.int32(), "string": pa.string(), "boolean": pa.bool_()}.get(c.split()[1], pa.map_(pa.string(), pa.string())) for c in BLOCKS.split(", ")]

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A batch of pages goes through in slices, so a worker holds the blocks of a few pages, not of a batch."""
        for batch in batches:
            for at in range(0, batch.num_rows, PAGES):
                part = batch.slice(at, PAGES)
                found = [parse(h)[0] for h in part.column(1).to_pylist()]
                ids = part.column(0).take(pa.array([i for i, b in enumerate(found) for _ in b], pa.int64()))
                columns = zip(*(b for page in found for b in page), strict=True) if len(ids) else [()] * len(names)
                made = [pa.array([list(v.items()) for v in c] if pa.types.is_map(t) else c, t) for c, t in zip(columns, types, strict=True)]
                yield pa.RecordBatch.from_arrays([ids, *made], names=[page_id, *names])

    return blocks


def html_blocks(pages: DataFrame, page_id: str = "page_id", html: str = "html") -> DataFrame:
    """Pages to block rows: page_id and BLOCKS. Text outside paragraphs, headings, items, cells, code and quotes is dropped.

    Null pages have no blocks. Repeated page_ids give repeated rows.
    """
    return pages.select(page_id, html).mapInArrow(_block_batches(page_id), f"{page_id} {dict(pages.dtypes)[page_id]}, {BLOCKS}")


def html_metadata(pages: DataFrame, page_id: str = "page_id", html: str = "html") -> DataFrame:
    """(page_id, meta): title, lang, charset and the named meta elements of each page."""

    @F.pandas_udf("map<string,string>")
    def meta(pages_: pd.Series) -> pd.Series:
        return pages_.map(lambda h: parse(h)[1], na_action=None)

    return pages.select(page_id, meta(F.col(html)).alias("meta"))


def markdown(blocks: DataFrame, doc: list[str]) -> DataFrame:
    """(doc, markdown) from blocks other than cells, joined by blank lines in reading order."""
    line = (
        F.when(F.col("block_type") == "SectionHeader", F.concat(F.repeat(F.lit("#"), F.col("level")), F.lit(" "), "text")).when(F.col("block_type") == "ListItem", F.concat(F.lit("- "), "text"))
        .when(F.col("block_type") == "Code", F.concat(F.lit("```\n"), "text", F.lit("\n```"))).when(F.col("block_type") == "Picture", F.concat(F.lit("!["), "text", F.lit("]()"))).otherwise(F.col("text"))
    )
    rows = blocks.where("block_type <> 'TableCell'").select(*doc, F.struct("block_ord", line.alias("line")).alias("r"))
    return rows.groupBy(*doc).agg(F.array_join(F.transform(F.array_sort(F.collect_list("r")), lambda r: r["line"]), "\n\n").alias("markdown"))
