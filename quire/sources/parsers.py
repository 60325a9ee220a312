"""Format parsers: bytes of one file to item rows, standard library only.

A parser yields dicts with ``family`` and the fields of that family; ``ord`` is set by ``parse``.
Everything after this is DataFrame expressions.
"""

from __future__ import annotations

import hashlib
import io
import posixpath
import re
import signal
import threading
import unicodedata
import zipfile
import zlib
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from functools import lru_cache
from xml.etree import ElementTree

from ..limits import LIMITS, QueryError
from ..operators.cells import column_name, parse_a1, parse_range

Row = dict


# CSV


def csv_text(data: bytes) -> tuple[str, str]:
    """Text and encoding: UTF-8 (a BOM is dropped) or GB18030, both strict."""
    for encoding in ("utf-8-sig", "gb18030"):
        try:
            return data.decode(encoding), encoding.removesuffix("-sig")
        except UnicodeDecodeError:
            continue
    raise QueryError("TEXT_ENCODING_UNSUPPORTED")


def csv_delimiter(data: bytes) -> str:
    """The most frequent of comma, tab and semicolon near the start; that order breaks ties."""
    head = data[:16384]
    return max(",\t;", key=lambda d: head.count(d.encode()))


def csv_stream(text: str, delimiter: str = ",") -> Iterator[list[str]]:
    """RFC 4180 rows, one by one. A quote opens only in an empty field; CR, LF and CRLF end rows; a blank line is one empty field."""
    row: list[str] = []
    stop = re.compile(f'[{re.escape(delimiter)}\r\n"]')
    at, n, started = 0, len(text), False
    field: list[str] = []
    while at < n:
        m = stop.search(text, at)
        if m is None:
            field.append(text[at:])
            started, at = True, n
            break
        if m.start() > at:
            field.append(text[at : m.start()])
        c, at = m[0], m.end()
        started = True
        if c == '"':
            if field and any(field):
                field.append(c)
                continue
            while True:
                end = text.find('"', at)
                if end < 0:
                    raise QueryError("DOCUMENT_CORRUPT", "a quote is not closed")
                field.append(text[at:end])
                at = end + 1
                if text[at : at + 1] != '"':
                    break
                field.append('"')
                at += 1
        elif c == delimiter:
            row.append("".join(field))
            field = []
        else:
            if c == "\r" and text[at : at + 1] == "\n":
                at += 1
            row.append("".join(field))
            yield row
            row, field, started = [], [], False
    if started or row or field:
        row.append("".join(field))
        yield row


def csv_rows(text: str, delimiter: str = ",") -> list[list[str]]:
    """All rows; a text without any is corrupt."""
    rows = list(csv_stream(text, delimiter))
    if not rows:
        raise QueryError("DOCUMENT_CORRUPT", "no rows")
    return rows


def csv_index(data: bytes) -> Iterator[Row]:
    """What a large CSV file has without its cells: number of rows and greatest width."""
    text, encoding = csv_text(data)
    n = width = 0
    for row in csv_stream(text, csv_delimiter(data)):
        n, width = n + 1, max(width, len(row))
    if not n:
        raise QueryError("DOCUMENT_CORRUPT", "no rows")
    used = f"A1:{column_name(width)}{n}"
    yield {"family": "document", "name": "spreadsheet", "status": "COMPLETE", "text": f"encoding:{encoding}"}
    yield {"family": "outline", "id": "sheet-1", "title": "CSV", "level": 1, "sheet": "CSV", "cell": used}
    yield {"family": "sheets", "name": "CSV", "status": "visible", "cell": used}


def csv_range(data: bytes, sheet: str, where: str) -> Iterator[Row]:
    """The non-empty cells of a range, row by row; nothing after its last row or the item limit is read."""
    if sheet != "CSV":
        raise QueryError("PARSER_OUTPUT_INVALID", f"no sheet {sheet}")
    r1, c1, r2, c2 = parse_range(where)
    left = LIMITS.query_items
    for i, row in enumerate(csv_stream(csv_text(data)[0], csv_delimiter(data)), 1):
        if i > r2 or not left:
            return
        for j in range(c1, min(c2, len(row)) + 1) if i >= r1 else ():
            if row[j - 1] and left:
                left -= 1
                yield {"family": "cells", "sheet": "CSV", "cell": f"{column_name(j)}{i}", "row_no": i, "col_no": j, "value": row[j - 1]}


def parse_csv(data: bytes) -> Iterator[Row]:
    text, encoding = csv_text(data)
    rows = csv_rows(text, csv_delimiter(data))
    width = max(map(len, rows))
    used = f"A1:{column_name(width)}{len(rows)}"
    yield {"family": "document", "name": "spreadsheet", "status": "COMPLETE", "text": f"encoding:{encoding}"}
    yield {"family": "outline", "id": "sheet-1", "title": "CSV", "level": 1, "sheet": "CSV", "cell": used}
    headers = [rows[0][i] if i < len(rows[0]) else column_name(i + 1) for i in range(width)]
    yield from row_blocks("CSV", [(i, r + [""] * (width - len(r))) for i, r in enumerate(rows, 1)], headers, "csv-rows")
    for i, r in enumerate(rows, 1):
        for j, v in enumerate(r, 1):
            if v:
                yield {"family": "cells", "sheet": "CSV", "cell": f"{column_name(j)}{i}", "row_no": i, "col_no": j, "value": v}
    yield {"family": "sheets", "name": "CSV", "status": "visible", "cell": used}


def row_blocks(sheet: str, rows: list[tuple[int, list[str]]], headers: list[str], prefix: str) -> Iterator[Row]:
    """Tables of 500 present rows; the header row is among them."""
    for i in range(0, len(rows), LIMITS.rows_per_block):
        part = rows[i : i + LIMITS.rows_per_block]
        first, last = part[0][0], part[-1][0]
        yield {
            "family": "tables", "id": f"{prefix}-{first}-{last}", "title": f"{sheet} {first}-{last}", "sheet": sheet, "headers": headers, "rows": [r for _, r in part],
            "cell": f"A{first}:{column_name(len(headers))}{last}",
        }


# Packages


@lru_cache(4096)
def safe_part(name: str) -> bool:
    p = name.replace("\\", "/")
    return not (p.startswith("/") or re.match("[A-Za-z]:/", p) or any(s in ("", ".", "..") for s in p.rstrip("/").split("/")) or "\0" in p)


def open_zip(data: bytes, corrupt: str, unsafe: str, limit: str, ratio_from: int = 0) -> zipfile.ZipFile:
    """A ZIP within limits: entries, total size, compression ratio, methods, paths."""
    try:
        z = zipfile.ZipFile(io.BytesIO(data))
    except (zipfile.BadZipFile, EOFError, ValueError) as bad:
        raise QueryError(corrupt) from bad
    infos = z.infolist()
    if len(infos) > LIMITS.archive_entries or sum(i.file_size for i in infos) > LIMITS.decompressed_bytes:
        raise QueryError(limit)
    seen = set()
    for i in infos:
        if not safe_part(i.orig_filename):
            raise QueryError(unsafe)
        if i.flag_bits & 1:
            raise QueryError("ENCRYPTED_DOCUMENT_UNSUPPORTED" if corrupt == "DOCUMENT_CORRUPT" else corrupt)
        name = unicodedata.normalize("NFC", i.filename.replace("\\", "/"))
        if i.compress_type not in (0, 8) or name in seen:
            raise QueryError(corrupt)
        seen.add(name)
        if not i.is_dir() and i.file_size >= ratio_from and i.file_size > LIMITS.ratio * max(1, i.compress_size):
            raise QueryError(limit)
    return z


class Archive:
    """An archive within limits, opened once: its entries, and their bytes on request."""

    def __init__(self, data: bytes):
        self.zip = open_zip(data, "ARCHIVE_CORRUPT", "ARCHIVE_UNSAFE_PATH", "ARCHIVE_RESOURCE_LIMIT", LIMITS.ratio_from_bytes)
        self.infos = self.zip.infolist()

    def entries(self) -> list[Row]:
        """path, bytes, compressed_bytes, method, directory of each entry."""
        return [{"path": archive_path(i.filename), "bytes": i.file_size, "compressed_bytes": i.compress_size, "method": i.compress_type, "directory": i.is_dir()} for i in self.infos]

    def find(self, path: str) -> zipfile.ZipInfo:
        """The entry of a path, both normalised."""
        wanted = archive_path(path)
        if wanted.endswith("/"):
            raise QueryError("ARCHIVE_ENTRY_UNSUPPORTED")
        for i in self.infos:
            if not i.is_dir() and archive_path(i.filename) == wanted:
                return i
        raise QueryError("ARCHIVE_ENTRY_NOT_FOUND", wanted)

    def read(self, info: zipfile.ZipInfo) -> bytes:
        """An entry's bytes; a damaged one is an error of its own."""
        try:
            return self.zip.read(info)
        except Exception as bad:  # the library raises many kinds for damaged data
            raise QueryError("ARCHIVE_CORRUPT", info.filename) from bad


def archive_path(raw: str) -> str:
    """Path of an entry with forward slashes in Unicode form C; an unsafe one is an error."""
    if not safe_part(raw):
        raise QueryError("ARCHIVE_UNSAFE_PATH", raw)
    return unicodedata.normalize("NFC", raw.replace("\\", "/"))


def zip_manifest(data: bytes) -> list[Row]:
    return Archive(data).entries()


def decoded_text(raw: bytes) -> str | None:
    """Text of an entry: UTF-16 by its BOM, else strict UTF-8; None if it is not text."""
    encoding = "utf-16" if raw[:2] in (b"\xff\xfe", b"\xfe\xff") else "utf-8-sig"
    try:
        return raw.decode(encoding)
    except UnicodeDecodeError:
        return None


class Package:
    """An OOXML package: parts as element trees without namespaces, relationships by id."""

    def __init__(self, data: bytes, main: str):
        if data[:8] == bytes.fromhex("D0CF11E0A1B11AE1"):
            raise QueryError("ENCRYPTED_DOCUMENT_UNSUPPORTED")
        self.zip = open_zip(data, "DOCUMENT_CORRUPT", "DOCUMENT_CORRUPT", "DOCUMENT_RESOURCE_LIMIT")
        self.names = set(self.zip.namelist())
        self.nodes = 0
        if main not in self.names:
            raise QueryError("FILE_TYPE_MISMATCH" if "[Content_Types].xml" in self.names else "DOCUMENT_CORRUPT")

    def part(self, name: str) -> ElementTree.Element | None:
        if name not in self.names:
            return None
        try:
            raw = self.zip.read(name)
            if b"<!DOCTYPE" in raw or b"<!ENTITY" in raw:
                raise QueryError("DOCUMENT_CORRUPT", "document types are not read")
            root = ElementTree.fromstring(raw)
        except (ElementTree.ParseError, zipfile.BadZipFile, zlib.error) as bad:
            raise QueryError("DOCUMENT_CORRUPT", name) from bad
        for e in root.iter():
            self.nodes += 1
            if "}" in e.tag:
                e.tag = e.tag.rpartition("}")[2]
            for k in e.keys():  # a list of its own
                if "}" in k:
                    e.attrib.setdefault(k.rpartition("}")[2] if "relationships" not in k else "r:" + k.rpartition("}")[2], e.attrib.pop(k))
        if self.nodes > LIMITS.xml_nodes:
            raise QueryError("DOCUMENT_RESOURCE_LIMIT")
        return root

    def title(self) -> str | None:
        """The document's own title, trimmed; a blank one is none."""
        core = self.part("docProps/core.xml")
        found = None if core is None else next(core.iter("title"), None)
        return (found.text or "").strip() or None if found is not None else None

    def elements(self, name: str, tag: str) -> Iterator[ElementTree.Element]:
        """The elements of a kind in a part, one by one: what was read is let go, and what follows the last one asked for is never read."""
        if name not in self.names:
            raise QueryError("DOCUMENT_CORRUPT", name)
        try:
            with self.zip.open(name) as raw:
                above = []
                for event, e in ElementTree.iterparse(raw, ("start", "end")):
                    if event == "start":
                        self.nodes += 1
                        if self.nodes > LIMITS.xml_nodes:
                            raise QueryError("DOCUMENT_RESOURCE_LIMIT")
                        e.tag = e.tag.rpartition("}")[2]
                        above.append(e)
                        continue
                    above.pop()
                    if e.tag == tag:
                        yield e
                    if tag not in {x.tag for x in above}:
                        e.clear()
                        if above:
                            above[-1].remove(e)
        except (ElementTree.ParseError, zipfile.BadZipFile, zlib.error, EOFError) as bad:
            raise QueryError("DOCUMENT_CORRUPT", name) from bad

    def dimension(self, name: str) -> str | None:
        """The declared range of a sheet, which comes before its rows; no more than that is read."""
        try:
            with self.zip.open(name) as raw:
                for _, e in ElementTree.iterparse(raw, ("start",)):
                    tag = e.tag.rpartition("}")[2]
                    if tag == "dimension":
                        return e.get("ref")
                    if tag == "sheetData":
                        return None
        except KeyError:
            return None
        except (ElementTree.ParseError, zipfile.BadZipFile, zlib.error, EOFError) as bad:
            raise QueryError("DOCUMENT_CORRUPT", name) from bad
        return None

    def rels(self, name: str) -> dict[str, tuple[str, str, bool]]:
        """Relationship id -> (target part, kind, external)."""
        folder, leaf = posixpath.split(name)
        root = self.part(f"{folder}/_rels/{leaf}.rels" if folder else f"_rels/{leaf}.rels")
        out = {}
        for r in root if root is not None else ():
            target, outside = r.get("Target", ""), r.get("TargetMode") == "External"
            if not outside:
                target = target.lstrip("/") if target.startswith("/") else posixpath.normpath(posixpath.join(folder, target))
                if target.startswith(".."):
                    raise QueryError("DOCUMENT_CORRUPT", "a relationship leaves the package")
            out[r.get("Id", "")] = (target, r.get("Type", "").rpartition("/")[2], outside)
        return out


def text_of(e: ElementTree.Element | None) -> str:
    """All text runs below an element, tabs and breaks kept."""
    if e is None:
        return ""
    out = []
    for x in e.iter():
        if x.tag == "t":
            out.append(x.text or "")
        elif x.tag == "tab" and x.get("pos") is None:
            out.append("\t")
        elif x.tag in ("br", "cr"):
            out.append("\n")
    return "".join(out)


# XLSX


def parse_xlsx(data: bytes, families: frozenset[str] | None = None) -> Iterator[Row]:
    """Every part is read and checked; rows of cells, formulas and tables are made only if their family is wanted."""
    has = lambda family: families is None or family in families
    all_cells, all_formulas, all_tables = has("cells"), has("formulas"), has("tables")
    p = Package(data, "xl/workbook.xml")
    book, rels = p.part("xl/workbook.xml"), p.rels("xl/workbook.xml")
    strings = [text_of(si) for si in (p.part("xl/sharedStrings.xml") if "xl/sharedStrings.xml" in p.names else ())]
    styles = p.part("xl/styles.xml")
    codes = {f.get("numFmtId"): f.get("formatCode") for f in styles.iter("numFmt")} if styles is not None else {}
    xfs = [x.get("numFmtId") for x in styles.findall("cellXfs/xf")] if styles is not None else []
    warnings, outline, blocks, tables, formulas, cells, sheets, images = [], [], [], [], [], [], [], []
    for k, node in enumerate(book.iter("sheet"), 1):
        name, state = node.get("name", ""), node.get("state", "visible")
        target, _, _ = rels.get(node.get("r:id", ""), ("", "", False))
        sheet = p.part(target)
        if sheet is None:
            warnings.append(f"sheet {name} is missing")
            outline.append({"family": "outline", "id": f"sheet-{k}", "title": name, "level": 1, "sheet": name})
            continue
        dim = sheet.find("dimension")
        used = dim.get("ref") if dim is not None else None
        sheets.append({"family": "sheets", "name": name, "status": state if state in ("hidden", "veryHidden") else "visible", "cell": used})
        outline.append({"family": "outline", "id": f"sheet-{k}", "title": name, "level": 1, "sheet": name, "cell": used})
        grid: dict[int, dict[int, str]] = {}
        for c in sheet.iter("c"):
            try:
                row, col = parse_a1(c.get("r", ""))
            except QueryError:
                continue
            kind, raw = c.get("t"), c.findtext("v")
            if kind == "s":
                value = strings[int(raw)] if raw and raw.isdigit() and int(raw) < len(strings) else ""
            elif kind == "inlineStr":
                value = text_of(c.find("is"))
            elif kind == "b":
                value = "TRUE" if raw == "1" else "FALSE"
            else:
                value = raw or ""
            if all_tables:
                grid.setdefault(row, {})[col] = value
            if not (all_cells or all_formulas):
                continue
            f, saved = c.find("f"), raw or None
            formula = f"={f.text}" if f is not None and f.text else None
            base = {"sheet": name, "cell": c.get("r"), "row_no": row, "col_no": col, "formula": formula, "saved_value": saved}
            if all_cells:
                cells.append({"family": "cells", "value": value, **base})
            if f is not None and all_formulas:
                style = c.get("s")
                fid = xfs[int(style)] if style and style.isdigit() and int(style) < len(xfs) else None
                formulas.append({
                    "family": "formulas", "id": f"formula-{k}-{c.get('r')}", "status": formula_state(formula, saved),
                    "name": None if fid is None else codes.get(fid, f"builtin:{fid}"), **base,
                })
        sheet_rels = p.rels(target)
        for where, kind, outside in sheet_rels.values():
            if kind == "comments" and not outside and where in p.names:
                for i, c in enumerate(p.part(where).iter("comment")):
                    ref = c.get("ref", "?")
                    code = hashlib.sha1(f"{name}:{ref}:{i}".encode()).hexdigest()[:12]
                    blocks.append({"family": "blocks", "id": f"comment-{code}", "type": "comment", "text": text_of(c.find("text")), "sheet": name, "cell": ref})
        for m in sheet.iter("mergeCell"):
            blocks.append({"family": "blocks", "id": f"merge-{k}-{m.get('ref')}", "type": "cell-row", "text": f"merged {m.get('ref')}", "sheet": name, "cell": m.get("ref")})
        if grid:
            width = max(max(r) for r in grid.values())
            rows = [(i, [grid[i].get(j, "") for j in range(1, width + 1)]) for i in sorted(grid)]
            first = grid[rows[0][0]]
            headers = [first.get(j, column_name(j)) for j in range(1, width + 1)]
            tables += row_blocks(name, rows, headers, f"sheet-{k}-rows")
    for i, part in enumerate(sorted(n for n in p.names if n.startswith(("xl/media/", "xl/charts/", "xl/pivotTables/")) and not n.endswith("/") and "/_rels/" not in n), 1):
        images.append({"family": "images", "id": f"media-{i}", "path": part, "status": "NOT_REQUESTED"})
    if any(n.startswith("xl/externalLinks/") for n in p.names):
        warnings.append("external links are not followed")
    if any(n.startswith("xl/model/") for n in p.names):
        warnings.append("the data model is not read")
    yield {"family": "document", "name": "spreadsheet", "status": "PARTIAL" if warnings else "COMPLETE", "text": "\n".join(warnings) or None}
    for family in (outline, blocks, tables, formulas, cells, sheets, images):
        yield from family


def xlsx_index(data: bytes) -> Iterator[Row]:
    """What a large workbook has without its cells: sheets with state and dimension, as far as the sheets' heads tell."""
    p = Package(data, "xl/workbook.xml")
    rels, sheets = p.rels("xl/workbook.xml"), []
    for k, node in enumerate(p.part("xl/workbook.xml").iter("sheet"), 1):
        name, state = node.get("name", ""), node.get("state", "visible")
        used = p.dimension(rels.get(node.get("r:id", ""), ("", "", False))[0])
        sheets.append(({"family": "outline", "id": f"sheet-{k}", "title": name, "level": 1, "sheet": name, "cell": used}, {"family": "sheets", "name": name, "status": state if state in ("hidden", "veryHidden") else "visible", "cell": used}))
    yield {"family": "document", "name": "spreadsheet", "status": "COMPLETE"}
    for i in (0, 1):
        yield from (pair[i] for pair in sheets)


def xlsx_range(data: bytes, sheet: str, where: str) -> Iterator[Row]:
    """The cells of a range, each formula right after its cell; only the sheet's own part is read, and of the shared strings those wanted."""
    r1, c1, r2, c2 = parse_range(where)
    p = Package(data, "xl/workbook.xml")
    rels = p.rels("xl/workbook.xml")
    target = next((rels.get(n.get("r:id", ""), ("", "", False))[0] for n in p.part("xl/workbook.xml").iter("sheet") if n.get("name") == sheet), None)
    if target is None:
        raise QueryError("PARSER_OUTPUT_INVALID", f"no sheet {sheet}")
    picked, wanted = [], set()
    for c in p.elements(target, "c"):
        try:
            row, col = parse_a1(c.get("r", ""))
        except QueryError:
            continue
        if row > r2 or len(picked) >= LIMITS.query_items:
            break
        if r1 <= row and c1 <= col <= c2:
            f = c.find("f")
            kind, raw = c.get("t"), c.findtext("v")
            if kind == "s" and raw and raw.isdigit():
                wanted.add(int(raw))
            picked.append((row, col, kind, raw, text_of(c.find("is")), None if f is None else f.text or ""))
    strings = {}
    if wanted and "xl/sharedStrings.xml" in p.names:
        for i, si in enumerate(p.elements("xl/sharedStrings.xml", "si")):
            if i in wanted:
                strings[i] = text_of(si)
            if i >= max(wanted):
                break
    left = LIMITS.query_items
    for row, col, kind, raw, inline, f in picked:
        value = {"s": lambda: strings.get(int(raw), "") if raw and raw.isdigit() else "", "inlineStr": lambda: inline, "b": lambda: "TRUE" if raw == "1" else "FALSE"}.get(kind, lambda: raw or "")()
        base = {"sheet": sheet, "cell": f"{column_name(col)}{row}", "row_no": row, "col_no": col, "formula": f"={f}" if f else None, "saved_value": raw or None}
        items = [{"family": "cells", "value": value, **base}]
        if f is not None:
            items.append({"family": "formulas", "id": f"formula-stream-{base['cell']}", "status": formula_state(base["formula"], base["saved_value"]), **base})
        for item in items[:left]:
            left -= 1
            yield item


def formula_state(formula: str | None, saved: str | None) -> str:
    if formula is None:
        return "UNSUPPORTED_FORMULA" if saved is None else "SAVED_VALUE_ONLY"
    return "FORMULA_ONLY" if saved is None else "SAVED_CACHE"


# DOCX and PPTX


def heading_level(style: str | None) -> int | None:
    m = re.search(r"heading\s*([1-9])", style or "", re.I)
    return int(m[1]) if m else None


def whole(text: str | None, least: int = 1) -> int:
    """A number in an attribute, ``least`` where there is none."""
    return max(least, int(text)) if text and text.isascii() and text.isdigit() and len(text) < 6 else least


Cell = tuple[str, int, int, str]  # text, columns, rows, and whether it starts ("restart") or goes on with ("continue") a vertical merge


def table_of(rows: list[list[Cell]]) -> dict:
    """Headers, rows and merged cells of a document's table: a field per cell, spans by row and column from 1.

    A cell that goes on with the merge above it adds a row to that merge and starts none.
    """
    merged, open_at = [], {}
    for r, row in enumerate(rows, 1):
        column = 1
        for _, wide, high, mode in row:
            places = range(column, column + wide)
            column += wide
            if mode == "continue":
                if (above := open_at.get(places[0])) is not None:
                    above["row_span"] += 1
                continue
            span = {"row": r, "col": places[0], "row_span": high, "col_span": wide}
            starts = mode == "restart"
            if starts or wide > 1 or high > 1:
                merged.append(span)
            open_at = {k: v for k, v in open_at.items() if k not in places} | (dict.fromkeys(places, span) if starts else {})
    texts = [[c[0] for c in row] for row in rows]
    return {"headers": texts[0] if texts else [], "rows": texts[1:], "merged": merged or None}


def word_table(tbl: ElementTree.Element) -> list[list[Cell]]:
    def cell(tc: ElementTree.Element) -> Cell:
        span, merge = tc.find("tcPr/gridSpan"), tc.find("tcPr/vMerge")
        mode = "" if merge is None else "restart" if merge.get("val") == "restart" else "continue"
        return "" if mode == "continue" else "\n".join(text_of(x) for x in tc.findall("p")), whole(None if span is None else span.get("val")), 1, mode

    return [[cell(tc) for tc in tr.findall("tc")] for tr in tbl.findall("tr")]


def slide_table(tbl: ElementTree.Element) -> list[list[Cell]]:
    """Cells that only fill a merge to the right are not cells of their own; those below one go on with it."""

    def cell(tc: ElementTree.Element) -> Cell:
        high = whole(tc.get("rowSpan"))
        mode = "continue" if tc.get("vMerge") in ("1", "true") else "restart" if high > 1 else ""
        return "\n".join(text_of(x) for x in tc.iter("p")), whole(tc.get("gridSpan")), 1, mode

    return [[cell(tc) for tc in tr.findall("tc") if tc.get("hMerge") not in ("1", "true")] for tr in tbl.findall("tr")]


class _Blocks:
    """Numbers blocks in visit order and links each to the latest heading."""

    def __init__(self):
        self.n, self.parent = 0, None
        self.outline: list[Row] = []
        self.rest: list[Row] = []

    def block(self, text: str, path: str, kind: str = "paragraph", level: int | None = None, slide: int | None = None) -> None:
        if not text.strip():
            return
        self.n += 1
        row = {"family": "blocks", "id": f"block-{self.n}", "type": kind, "text": text, "path": path, "slide": slide}
        if level is not None:
            row |= {"type": "heading", "level": level}
            self.outline.append({"family": "outline", "id": row["id"], "title": text.strip(), "level": level, "path": path, "slide": slide})
            self.parent = row["id"]
        else:
            row["parent_id"] = self.parent
        self.rest.append(row)

    def table(self, rows: list[list[Cell]], path: str, slide: int | None = None) -> None:
        self.n += 1
        self.rest.append({"family": "tables", "id": f"table-{self.n}", "path": path, "slide": slide, **table_of(rows)})

    def image(self, alt: str | None, path: str, slide: int | None = None) -> None:
        self.n += 1
        self.rest.append({"family": "images", "id": f"image-{self.n}", "alt_text": alt, "path": path, "slide": slide, "status": "NOT_REQUESTED"})

    def rows(self, kind: str, title: str | None) -> Iterator[Row]:
        yield {"family": "document", "name": kind, "status": "COMPLETE", "title": title}
        yield from self.outline
        for family in ("blocks", "tables", "images"):
            yield from (r for r in self.rest if r["family"] == family)


def parse_docx(data: bytes) -> Iterator[Row]:
    p = Package(data, "word/document.xml")
    styles = p.part("word/styles.xml")
    names = {s.get("styleId"): s.find("name").get("val", "") for s in styles.iter("style") if s.find("name") is not None} if styles is not None else {}
    out = _Blocks()

    def walk(parent: ElementTree.Element, prefix: str, kind: str = "paragraph") -> None:
        counts: dict[str, int] = {}
        for e in parent:
            counts[e.tag] = counts.get(e.tag, 0) + 1
            path = f"{prefix}/{e.tag}[{counts[e.tag]}]"
            if e.tag == "p":
                style = e.find("pPr/pStyle")
                sid = style.get("val") if style is not None else None
                level = heading_level(names.get(sid)) or heading_level(sid)
                out.block(text_of(e), path, kind, level if kind == "paragraph" else None)
                for pic in e.iter("docPr"):
                    out.image(pic.get("descr") or pic.get("name"), f"{path}/picture[@id={pic.get('id')}]")
            elif e.tag == "tbl":
                out.table(word_table(e), path)
            elif e.tag in ("sdt", "sdtContent"):
                walk(e, path, kind)

    body = p.part("word/document.xml").find("body")
    if body is None:
        raise QueryError("DOCUMENT_CORRUPT", "no body")
    walk(body, "/body")
    found = sorted(p.rels("word/document.xml").values())
    for kind in ("header", "footer"):
        for i, (target, _, _) in enumerate((t for t in found if t[1] == kind), 1):
            if (part := p.part(target)) is not None:
                out.block("\n".join(t for t in (text_of(x) for x in part.iter("p")) if t), f"/{kind}[{i}]")
    for name in ("footnotes", "endnotes"):
        if (part := p.part(f"word/{name}.xml")) is not None:
            notes = [text_of(n) for n in part if n.get("type") not in ("separator", "continuationSeparator")]
            out.block("\n".join(n for n in notes if n), f"/{name}", "note")
    if (part := p.part("word/comments.xml")) is not None:
        for i, c in enumerate(part.iter("comment"), 1):
            out.block("\n".join(text_of(x) for x in c.iter("p")), f"/comments/comment[{i}]", "comment")
    yield from out.rows("document", p.title())


def parse_pptx(data: bytes) -> Iterator[Row]:
    p = Package(data, "ppt/presentation.xml")
    rels = p.rels("ppt/presentation.xml")
    out, firsts = _Blocks(), []
    paragraphs = lambda e: "\n".join(text_of(x) for x in e.iter("p"))
    for n, ref in enumerate(p.part("ppt/presentation.xml").iter("sldId"), 1):
        target = rels.get(ref.get("r:id", ""), ("", "", False))[0]
        slide = p.part(target)
        if slide is None:
            raise QueryError("DOCUMENT_CORRUPT", f"slide {n} is missing")
        before = len(out.rest)
        counts: dict[str, int] = {}
        for e in slide.iter():
            if e.tag not in ("sp", "pic", "graphicFrame"):
                continue
            pr = e.find(".//cNvPr")
            counts[e.tag] = counts.get(e.tag, 0) + 1
            key = f"@id={pr.get('id')}" if pr is not None else counts[e.tag]
            if e.tag == "pic":
                out.image(None if pr is None else pr.get("descr") or pr.get("name"), f"/slide[{n}]/picture[{key}]", n)
            elif e.tag == "sp":
                ph = e.find(".//ph")
                title = ph is not None and ph.get("type") in ("title", "ctrTitle")
                body = e.find("txBody")
                out.block("" if body is None else paragraphs(body), f"/slide[{n}]/shape[{key}]", "paragraph", 1 if title else None, n)
            elif (tbl := e.find(".//tbl")) is not None:
                out.table(slide_table(tbl), f"/slide[{n}]/table[{key}]", n)
        texts = [r["text"] for r in out.rest[before:] if r["family"] == "blocks"]
        firsts.append((n, texts[0] if texts else f"Slide {n}"))
        for where, kind, outside in sorted(p.rels(target).values()):
            if outside or kind not in ("notesSlide", "comments"):
                continue
            part = p.part(where)
            if kind == "notesSlide" and part is not None:
                notes = [paragraphs(s.find("txBody")) for s in part.iter("sp") if s.find("txBody") is not None and (s.find(".//ph") is None or s.find(".//ph").get("type") in (None, "body"))]
                out.block("\n".join(x for x in notes if x), f"/slide[{n}]/notes", "note", None, n)
            elif part is not None:
                for i, c in enumerate(part.iter("cm"), 1):
                    out.block(c.findtext("text") or text_of(c), f"/slide[{n}]/comment[{i}]", "comment", None, n)
    if not out.outline:
        out.outline = [{"family": "outline", "id": f"slide-{n}", "title": t, "level": 1, "slide": n, "path": f"/slide[{n}]"} for n, t in firsts]
    yield from out.rows("presentation", p.title())


PARSERS = {"csv": parse_csv, "xlsx": parse_xlsx, "docx": parse_docx, "pptx": parse_pptx}
INDEXERS = {"csv": csv_index, "xlsx": xlsx_index}
RANGES = {"csv": csv_range, "xlsx": xlsx_range}
#: Changes when parsers answer differently; part of the key of stored results.
VERSION = "2"


@contextmanager
def deadline(seconds: float):
    """Ends what runs inside after so many seconds, with the error of a parser's time limit.

    A worker parses in its main thread, where the timer's signal is handled between two steps of
    Python; a single call into a library ends first.
    """
    if seconds <= 0 or threading.current_thread() is not threading.main_thread():
        yield
        return

    def over(*_):
        raise QueryError("DOCUMENT_PARSE_TIMEOUT", f"no answer in {seconds:g} s")

    before = signal.signal(signal.SIGALRM, over)
    signal.setitimer(signal.ITIMER_REAL, seconds, 0.05)  # again, should a parser take the first for a bad number
    try:
        yield
    finally:
        signal.setitimer(signal.ITIMER_REAL, 0)
        signal.signal(signal.SIGALRM, before)


def guarded(kind: str, known: dict, read: Callable[[], Iterator[Row]], size: int, seconds: float = LIMITS.parse_seconds) -> list[Row]:
    """The rows of a file; whatever goes wrong in it, or takes too long, is a single row of family ``error``."""
    try:
        if size > LIMITS.file_bytes:
            raise QueryError("FILE_TOO_LARGE")
        if kind not in known:
            raise QueryError("UNSUPPORTED_FILE_TYPE")
        with deadline(seconds):
            return list(read())
    except QueryError as bad:
        return [{"family": "error", "status": bad.code, "text": str(bad)}]
    except Exception as bad:  # a damaged file must not end the job that reads a million others
        return [{"family": "error", "status": "DOCUMENT_CORRUPT", "text": f"DOCUMENT_CORRUPT: {type(bad).__name__}"}]


def parse(kind: str, data: bytes, index_from: int | None = None, seconds: float = LIMITS.parse_seconds, families: frozenset[str] | None = None) -> list[Row]:
    """All rows of a file, numbered by family. Spreadsheets from ``index_from`` bytes on give their sheets without cells. Rows of families that are not wanted may be left out."""
    large = index_from is not None and len(data) >= index_from and kind in INDEXERS
    more = (families,) if kind == "xlsx" else ()
    rows = guarded(kind, PARSERS, lambda: INDEXERS[kind](data) if large else PARSERS[kind](data, *more), len(data), seconds)
    counts: dict[str, int] = {}
    for r in rows:
        r["ord"] = counts.get(r["family"], 0)
        counts[r["family"]] = r["ord"] + 1
    return rows


def read_range(kind: str, data: bytes, sheet: str, where: str) -> list[Row]:
    """The items of a range of one spreadsheet, numbered in answer order; an unknown sheet is an error."""
    rows = guarded(kind, RANGES, lambda: RANGES[kind](data, sheet, where), len(data))
    for i, r in enumerate(rows):
        r["ord"] = i
    return rows
