"""Office files and XML to blocks, from rows of Spark's binaryFile reader. Each file is one row and parsed in its task."""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Iterator
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLOCKS = "path string, block_ord int, block_type string, level int, text string, row_id int, col_id int, is_header boolean, error string"


def _name(e: ElementTree.Element) -> str:
    return e.tag.rpartition("}")[2]


def _all(e: ElementTree.Element, name: str) -> list[ElementTree.Element]:
    return [x for x in e.iter() if isinstance(x.tag, str) and _name(x) == name]


def _text(e: ElementTree.Element) -> str:
    return "".join(x.text or "" for x in _all(e, "t"))


def _attr(e: ElementTree.Element, name: str) -> str:
    return next((v for k, v in e.attrib.items() if k.rpartition("}")[2] == name), "")


def _cells(table: ElementTree.Element, row: str, cell: str) -> Iterator[tuple]:
    """Cells of a table; its first row is the header if all its texts are under fifty characters."""
    rows = [[_text(c).strip() for c in r if _name(c) == cell] for r in table.iter() if isinstance(r.tag, str) and _name(r) == row]
    header = bool(rows) and all(len(t) < 50 for t in rows[0])
    for i, r in enumerate(rows):
        for j, t in enumerate(r):
            yield ("TableCell", None, t, i, j, header and i == 0)


def docx_blocks(content: bytes) -> Iterator[tuple]:
    """Paragraphs, headings by style (Title 0, Subtitle 1, Heading n), tables, then comments and footnotes."""
    with zipfile.ZipFile(io.BytesIO(content)) as z:
        body = _all(ElementTree.fromstring(z.read("word/document.xml")), "body")[0]
        for e in body:
            if _name(e) == "tbl":
                yield from _cells(e, "tr", "tc")
            elif _name(e) == "p" and (text := _text(e).strip()):
                style = next((_attr(s, "val") for s in _all(e, "pStyle")), "")
                heading = re.fullmatch(r"[Hh]eading\s*(\d)", style)
                level = 0 if style == "Title" else 1 if style == "Subtitle" else int(heading[1]) if heading else None
                kind = "SectionHeader" if level is not None else "ListItem" if _all(e, "numPr") else "Text"
                yield (kind, level, text, None, None, None)
        for part, kind in (("word/comments.xml", "Comment"), ("word/footnotes.xml", "Footnote")):
            if part in z.namelist():
                for e in ElementTree.fromstring(z.read(part)):
                    if text := _text(e).strip():
                        yield (kind, None, text, None, None, None)


def _numbered(names: list[str], pattern: str) -> list[str]:
    found = [(int(m[1]), n) for n in names if (m := re.fullmatch(pattern, n))]
    return [n for _, n in sorted(found)]


def pptx_blocks(content: bytes) -> Iterator[tuple]:
    """Slides in order: the title (or "Slide n") as heading 1, subtitle as 2, lists, tables, then notes as comments."""
    with zipfile.ZipFile(io.BytesIO(content)) as z:
        names = z.namelist()
        for n, slide in enumerate(_numbered(names, r"ppt/slides/slide(\d+)\.xml"), 1):
            root = ElementTree.fromstring(z.read(slide))
            shapes = [(next((_attr(p, "type") for p in _all(s, "ph")), ""), [t for p in _all(s, "p") if (t := _text(p).strip())]) for s in _all(root, "sp")]
            title = next((" ".join(t) for k, t in shapes if k in ("title", "ctrTitle") and t), f"Slide {n}")
            yield ("SectionHeader", 1, title, None, None, None)
            for kind, texts in shapes:
                if kind in ("title", "ctrTitle") or not texts:
                    continue
                if kind == "subTitle":
                    yield ("SectionHeader", 2, " ".join(texts), None, None, None)
                else:
                    yield ("ListGroup" if len(texts) > 1 else "Text", None, "\n".join(texts), None, None, None)
            for table in _all(root, "tbl"):
                yield from _cells(table, "tr", "tc")
            notes = f"ppt/notesSlides/notesSlide{n}.xml"
            if notes in names and (text := _text(ElementTree.fromstring(z.read(notes))).strip()):
                yield ("Comment", None, text, None, None, None)


def xlsx_blocks(content: bytes) -> Iterator[tuple]:
    """Sheets in order: the name as heading 1, then its cells; absent values are empty."""
    with zipfile.ZipFile(io.BytesIO(content)) as z:
        names = z.namelist()
        shared = [_text(e) for e in ElementTree.fromstring(z.read("xl/sharedStrings.xml"))] if "xl/sharedStrings.xml" in names else []
        titles = [_attr(s, "name") for s in _all(ElementTree.fromstring(z.read("xl/workbook.xml")), "sheet")]
        for title, sheet in zip(titles, _numbered(names, r"xl/worksheets/sheet(\d+)\.xml"), strict=False):
            yield ("SectionHeader", 1, title, None, None, None)
            for i, row in enumerate(_all(ElementTree.fromstring(z.read(sheet)), "row")):
                for c in _all(row, "c"):
                    column = 0
                    for letter in re.match(r"[A-Z]*", _attr(c, "r"))[0]:
                        column = column * 26 + ord(letter) - 64
                    value = next((v.text or "" for v in _all(c, "v")), "")
                    if _attr(c, "t") == "s" and value.isdigit():
                        value = shared[int(value)]
                    elif _attr(c, "t") == "inlineStr":
                        value = _text(c)
                    yield ("TableCell", None, value, i, max(0, column - 1), i == 0)


def xml_blocks(content: bytes) -> Iterator[tuple]:
    """Every non-blank text with its path as heading; two and more children of one tag and one set of child tags are a table."""

    def walk(e: ElementTree.Element, path: str) -> Iterator[tuple]:
        here = f"{path}/{_name(e)}"
        if (e.text or "").strip():
            yield ("Text", None, f"{here}: {e.text.strip()}", None, None, None)
        children = [c for c in e if isinstance(c.tag, str)]
        shapes = {(c.tag, frozenset(x.tag for x in c)) for c in children}
        if len(children) >= 2 and len(shapes) == 1 and len(next(iter(shapes))[1]) >= 2:
            names = list(dict.fromkeys(_name(x) for x in children[0]))
            for j, n in enumerate(names):
                yield ("TableCell", None, n, 0, j, True)
            for i, c in enumerate(children, 1):
                values = {_name(x): (x.text or "").strip() for x in c}
                for j, n in enumerate(names):
                    yield ("TableCell", None, values.get(n, ""), i, j, False)
            return
        for c in children:
            yield from walk(c, here)
            if (c.tail or "").strip():
                yield ("Text", None, f"{here}: {c.tail.strip()}", None, None, None)

    yield from walk(ElementTree.fromstring(content), "")


PARSERS = {"docx": docx_blocks, "pptx": pptx_blocks, "xlsx": xlsx_blocks, "xml": xml_blocks}


def kind_of(path: Column, content: Column) -> Column:
    """What a file is: by its first bytes, then by its extension; pdf where nothing tells."""
    head = F.hex(F.substring(content, 1, 8))
    ext = F.lower(F.regexp_extract(path, r"\.([A-Za-z0-9]+)$", 1))
    starts = lambda *h: head.rlike(f"^({'|'.join(h)})")
    return (
        F.when(starts("89504E47", "FFD8FF", "47494638", "424D", "49492A00", "4D4D002A"), "image").when(starts("25504446"), "pdf")
        .when(starts("504B0304") & ext.isin("docx", "pptx", "xlsx", "epub"), ext).when(ext.isin("htm", "html", "xhtml"), "html").when(starts("3C3F786D6C") | (ext == "xml"), "xml")
        .when(ext.isin("json", "jsonl", "md", "txt"), ext).otherwise("pdf")
    )


def file_blocks(files: DataFrame) -> DataFrame:
    """Block rows of docx, pptx, xlsx and xml files. files: path, content. A file that can't be read gives one row with its error."""

    def parsed(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = [c.split()[0] for c in BLOCKS.split(", ")]
        for f in frames:
            rows = []
            for path, content, kind in f.itertuples(index=False):
                try:
                    rows += [(path, k, *b, None) for k, b in enumerate(PARSERS[kind](content))]
                except (zipfile.BadZipFile, ElementTree.ParseError, KeyError, IndexError) as e:
                    rows.append((path, 0, None, None, None, None, None, None, f"{type(e).__name__}: {e}"))
            yield pd.DataFrame(rows, columns=names).astype({"level": "Int32", "row_id": "Int32", "col_id": "Int32"})

    known = files.select("path", "content", kind_of(F.col("path"), F.col("content")).alias("kind")).where(F.col("kind").isin(*PARSERS))
    return known.mapInPandas(parsed, BLOCKS)
