import io
import zipfile

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from quire.limits import QueryError
from quire.operators import cells
from quire.sources import images, parsers
from quire.sources.files import Corpus


def packed(parts: dict[str, str]) -> bytes:
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for n, t in parts.items():
            z.writestr(n, t)
    return out.getvalue()


W = 'xmlns="http://w" xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"'
REL = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"


def rels(*items: tuple[str, str, str]) -> str:
    return "<Relationships>" + "".join(f'<Relationship Id="{i}" Type="{REL}/{k}" Target="{t}"/>' for i, k, t in items) + "</Relationships>"


def xlsx() -> bytes:
    return packed({
        "[Content_Types].xml": "<Types/>",
        "xl/workbook.xml": f'<workbook {W}><sheets><sheet name="Main" r:id="r1"/><sheet name="Hidden" state="hidden" r:id="r2"/></sheets></workbook>',
        "xl/_rels/workbook.xml.rels": rels(("r1", "worksheet", "worksheets/sheet1.xml"), ("r2", "worksheet", "worksheets/sheet2.xml")),
        "xl/sharedStrings.xml": f"<sst {W}><si><t>region</t></si><si><r><t>North</t></r><r><t>west</t></r></si></sst>",
        "xl/styles.xml": f'<styleSheet {W}><numFmts><numFmt numFmtId="170" formatCode="0.0%"/></numFmts><cellXfs><xf numFmtId="0"/><xf numFmtId="170"/></cellXfs></styleSheet>',
        "xl/worksheets/sheet1.xml": f"""<worksheet {W}><dimension ref="A1:C3"/><sheetData>
<row r="1"><c r="A1" t="s"><v>0</v></c><c r="B1" t="inlineStr"><is><t>value</t></is></c></row>
<row r="3"><c r="A3" t="s"><v>1</v></c><c r="B3" s="1"><f>B1*2</f><v>4</v></c><c r="C3" t="b"><v>1</v></c><c r="D3"><f>NOW()</f></c></row></sheetData>
<mergeCells><mergeCell ref="A1:A2"/></mergeCells></worksheet>""",
        "xl/worksheets/_rels/sheet1.xml.rels": rels(("c1", "comments", "../comments1.xml")),
        "xl/comments1.xml": f'<comments {W}><commentList><comment ref="A3"><text><t>check this</t></text></comment></commentList></comments>',
        "xl/worksheets/sheet2.xml": f"<worksheet {W}><sheetData/></worksheet>",
        "xl/media/image1.png": "x",
    })


def docx() -> bytes:
    p = lambda t, s="": f'<p>{f"<pPr><pStyle val={chr(34)}{s}{chr(34)}/></pPr>" if s else ""}<r><t>{t}</t></r></p>'
    return packed({
        "[Content_Types].xml": "<Types/>",
        "word/styles.xml": f'<styles {W}><style styleId="H1"><name val="heading 1"/></style></styles>',
        "word/document.xml": f"""<document {W}><body>{p("Title", "H1")}{p("First")}<tbl><tr><tc>{p("a")}</tc><tc>{p("b")}</tc></tr>
<tr><tc><tcPr><gridSpan val="2"/></tcPr>{p("wide")}</tc></tr></tbl>{p("Last")}</body></document>""",
        "word/_rels/document.xml.rels": rels(("h", "header", "header1.xml"), ("c", "comments", "comments.xml")),
        "word/header1.xml": f"<hdr {W}>{p('Head')}</hdr>",
        "word/footnotes.xml": f"<footnotes {W}><footnote>{p('Note')}</footnote></footnotes>",
        "word/comments.xml": f"<comments {W}><comment>{p('Remark')}</comment></comments>",
    })


def pptx(title: bool = True) -> bytes:
    ph = '<ph type="title"/>' if title else ""
    return packed({
        "[Content_Types].xml": "<Types/>",
        "ppt/presentation.xml": f'<presentation {W}><sldIdLst><sldId id="256" r:id="r1"/></sldIdLst></presentation>',
        "ppt/_rels/presentation.xml.rels": rels(("r1", "slide", "slides/slide1.xml")),
        "ppt/slides/slide1.xml": f"""<sld {W}><cSld><spTree><sp><nvSpPr><cNvPr id="2" name="T"/><nvPr>{ph}</nvPr></nvSpPr><txBody><p><r><t>Goals</t></r></p></txBody></sp>
<pic><nvPicPr><cNvPr id="6" name="Logo"/></nvPicPr></pic></spTree></cSld></sld>""",
        "ppt/slides/_rels/slide1.xml.rels": rels(("n", "notesSlide", "../notesSlides/notesSlide1.xml")),
        "ppt/notesSlides/notesSlide1.xml": f'<notes {W}><cSld><spTree><sp><nvSpPr><nvPr><ph type="body"/></nvPr></nvSpPr><txBody><p><r><t>Say hello</t></r></p></txBody></sp></spTree></cSld></notes>',
    })


def test_csv_rows():
    f = parsers.csv_rows
    assert f("a,b\n1,2,3\n\n\"x\"\"y\"z,q\nm\"id,2\n4\n") == [["a", "b"], ["1", "2", "3"], [""], ['x"yz', "q"], ['m"id', "2"], ["4"]]
    assert f("a\rb\r\nc") == [["a"], ["b"], ["c"]]
    assert f('"line\none,two",3') == [["line\none,two", "3"]]
    assert f("x" * 65535 + ',"a""b"')[0][1] == 'a"b'
    for bad in ('"open', ""):
        with pytest.raises(QueryError):
            f(bad)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.text("ab,\"\n\r;é", max_size=5), min_size=1, max_size=4), min_size=1, max_size=5))
def test_csv_round_trip(rows):
    text = "".join(",".join('"' + v.replace('"', '""') + '"' for v in r) + "\n" for r in rows)
    assert parsers.csv_rows(text) == rows


def test_csv_encoding_and_delimiter():
    assert parsers.csv_text("深圳".encode("gb18030")) == ("深圳", "gb18030")
    assert parsers.csv_text(b"\xef\xbb\xbfa") == ("a", "utf-8")
    with pytest.raises(QueryError):
        parsers.csv_text(b"\xff\xff\xff")
    assert [parsers.csv_delimiter(x) for x in (b"a;b;c", b"a\tb", b"a,b;c", b"")] == [";", "\t", ",", ","]


@given(st.integers(1, 18278))
def test_columns(n):
    assert cells.parse_a1(f"{cells.column_name(n)}9") == (9, n)


def test_ranges():
    assert cells.parse_range("c400:A20") == (20, 1, 400, 3)
    assert cells.parse_range("B2") == (2, 2, 2, 2)
    assert cells.parse_range("A1:B2:C3") == (1, 1, 2, 2)
    for bad in ("A0", "$A$1", "A", "AAAA1", ""):
        with pytest.raises(QueryError):
            cells.parse_range(bad)


def test_xlsx():
    rows = parsers.parse("xlsx", xlsx())
    by = lambda f: [r for r in rows if r["family"] == f]
    assert [(r["name"], r["status"]) for r in by("sheets")] == [("Main", "visible"), ("Hidden", "hidden")]
    assert [r["value"] for r in by("cells")] == ["region", "value", "Northwest", "4", "TRUE", ""]
    assert [(r["cell"], r["status"], r["name"]) for r in by("formulas")] == [("B3", "SAVED_CACHE", "0.0%"), ("D3", "FORMULA_ONLY", None)]
    table = by("tables")[0]
    assert table["headers"] == ["region", "value", "C", "D"] and table["rows"][1] == ["Northwest", "4", "TRUE", ""]
    assert {r["type"] for r in by("blocks")} == {"comment", "cell-row"} and len(by("images")) == 1


def test_docx():
    rows = parsers.parse("docx", docx())
    blocks = [(r["path"], r["type"], r["text"], r.get("parent_id")) for r in rows if r["family"] == "blocks"]
    assert ("/body/p[1]", "heading", "Title", None) in blocks and ("/body/p[2]", "paragraph", "First", "block-1") in blocks
    assert {"/header[1]", "/footnotes", "/comments/comment[1]"} <= {b[0] for b in blocks}
    table = next(r for r in rows if r["family"] == "tables")
    assert table["path"] == "/body/tbl[1]" and table["headers"] == ["a", "b"] and table["rows"] == [["wide"]]
    assert table["merged"] == [{"row": 2, "col": 1, "row_span": 1, "col_span": 2}]


def test_pptx():
    rows = parsers.parse("pptx", pptx())
    assert next(r for r in rows if r["family"] == "images")["path"] == "/slide[1]/picture[@id=6]"
    assert [(r["type"], r["text"]) for r in rows if r["family"] == "blocks"] == [("heading", "Goals"), ("note", "Say hello")]
    assert next(r for r in parsers.parse("pptx", pptx(False)) if r["family"] == "outline")["title"] == "Goals"


def test_merged_cells():
    span = lambda r, c, h, w: {"row": r, "col": c, "row_span": h, "col_span": w}
    rows = [[("a", 2, 1, ""), ("b", 1, 1, "restart")], [("c", 1, 1, "restart"), ("d", 1, 1, ""), ("", 1, 1, "continue")], [("", 1, 1, "continue"), ("e", 1, 1, ""), ("f", 1, 1, "")], [("", 1, 1, "continue")]]
    assert parsers.table_of(rows)["merged"] == [span(1, 1, 1, 2), span(1, 3, 2, 1), span(2, 1, 3, 1)]
    assert parsers.table_of([]) == {"headers": [], "rows": [], "merged": None}
    tbl = parsers.ElementTree.fromstring(
        '<tbl><tr><tc gridSpan="2" rowSpan="2"><p><t>x</t></p></tc><tc hMerge="1"/><tc><p><t>y</t></p></tc></tr><tr><tc gridSpan="2" vMerge="1"/><tc hMerge="1" vMerge="1"/><tc/></tr></tbl>'
    )
    got = parsers.table_of(parsers.slide_table(tbl))
    assert got == {"headers": ["x", "y"], "rows": [["", ""]], "merged": [span(1, 1, 2, 2)]}


def test_damaged_files_are_error_rows():
    """Whatever is wrong in a file, it is one error row and no exception."""
    import random

    r = random.Random(3)
    known = {"DOCUMENT_CORRUPT", "FILE_TYPE_MISMATCH", "DOCUMENT_RESOURCE_LIMIT", "ENCRYPTED_DOCUMENT_UNSUPPORTED", "TEXT_ENCODING_UNSUPPORTED"}
    for kind, data in (("xlsx", xlsx()), ("docx", docx()), ("pptx", pptx()), ("csv", b'a,"b\n')):
        for _ in range(150):
            bad = bytearray(data)
            for _ in range(r.randrange(1, 6)):
                bad[r.randrange(len(bad))] = r.randrange(256)
            for rows in (parsers.parse(kind, bytes(bad[: r.randrange(len(bad))] if r.random() < 0.3 else bad)), parsers.parse(kind, bytes(bad), index_from=0)):
                assert rows[0]["family"] == "document" or (len(rows) == 1 and rows[0]["family"] == "error" and rows[0]["status"] in known)
    part = lambda body: packed({"[Content_Types].xml": "<Types/>", "word/document.xml": f"<document {W}>{body}</document>"})
    assert parsers.parse("docx", part(""))[0]["status"] == "DOCUMENT_CORRUPT"
    odd = parsers.parse("docx", part('<body><tbl><tr><tc><tcPr><gridSpan val="x"/></tcPr><p><r><t>a</t></r></p></tc></tr></tbl></body>'))
    assert [r["family"] for r in odd] == ["document", "tables"] and odd[1]["merged"] is None


def test_large_sheets_on_demand():
    book = xlsx()
    index = parsers.parse("xlsx", book, index_from=0)
    assert [(r["family"], r.get("title") or r.get("name"), r.get("cell")) for r in index[1:]] == [("outline", "Main", "A1:C3"), ("outline", "Hidden", None), ("sheets", "Main", "A1:C3"), ("sheets", "Hidden", None)]
    got = parsers.read_range("xlsx", book, "Main", "D3:A2")
    assert [(r["family"], r["cell"], r.get("value")) for r in got] == [("cells", "A3", "Northwest"), ("cells", "B3", "4"), ("formulas", "B3", None), ("cells", "C3", "TRUE"), ("cells", "D3", ""), ("formulas", "D3", None)]
    assert got[2]["id"] == "formula-stream-B3" and got[2]["status"] == "SAVED_CACHE"
    assert parsers.read_range("xlsx", book, "Nope", "A1")[0]["status"] == "PARSER_OUTPUT_INVALID" and parsers.read_range("csv", b"a,b", "Main", "A1")[0]["status"] == "PARSER_OUTPUT_INVALID"
    rows = "\n".join(f"r{i},{i}" for i in range(3000)).encode()
    got = parsers.read_range("csv", rows + b'\n"never closed', "CSV", "A2:B1500")
    assert len(got) == 2000 and got[0]["value"] == "r1" and got[-1]["cell"] == "B1001"


def test_parse_deadline(spark):
    """A file that takes too long is an error row; the files after it in the task are parsed."""
    from quire.sources.files import parse_documents

    slow = ",".join(["x"] * 50) + "\n"
    files = spark.createDataFrame([("slow", "slow.csv", bytearray((slow * 40_000).encode())), ("quick", "quick.csv", bytearray(b"a,b\n"))], "doc_id string, name string, content binary").coalesce(1)
    got = parse_documents(files, families=("error", "cells"), fields=("status", "cell"), seconds=0.2).select("doc_id", "family", "status", "cell").collect()
    assert sorted(map(tuple, got), key=repr) == [("quick", "cells", None, "A1"), ("quick", "cells", None, "B1"), ("slow", "error", "DOCUMENT_PARSE_TIMEOUT", None)]
    assert parsers.parse("csv", b"a,b\n", seconds=5)[0]["family"] != "error"


def test_errors():
    code = lambda k, d: parsers.parse(k, d)[0]["status"]
    assert code("xlsx", docx()) == "FILE_TYPE_MISMATCH"
    assert code("docx", b"PK\x03\x04") == "DOCUMENT_CORRUPT"
    assert code("docx", bytes.fromhex("D0CF11E0A1B11AE1") + b"x") == "ENCRYPTED_DOCUMENT_UNSUPPORTED"
    for parts, want in (({"../escape.txt": "x"}, "ARCHIVE_UNSAFE_PATH"), ({"zeros": "0" * (2 << 20)}, "ARCHIVE_RESOURCE_LIMIT")):
        with pytest.raises(QueryError) as e:
            parsers.zip_manifest(packed(parts))
        assert e.value.code == want


def test_images():
    png = b"\x89PNG\r\n\x1a\n\0\0\0\rIHDR" + (640).to_bytes(4) + (480).to_bytes(4)
    assert images.dimensions(png) == (640, 480)
    assert images.dimensions(b"GIF89a" + (7).to_bytes(2, "little") + (9).to_bytes(2, "little")) == (7, 9)
    jpeg = b"\xff\xd8\xff\xe0\0\x04ab\xff\xc0\0\x0b\x08" + (30).to_bytes(2) + (40).to_bytes(2) + b"\0" * 8
    assert images.dimensions(jpeg) == (40, 30)
    vp8x = b"RIFF\0\0\0\0WEBPVP8X" + b"\0" * 8 + (99).to_bytes(3, "little") + (49).to_bytes(3, "little")
    assert images.dimensions(vp8x) == (100, 50)
    assert images.dimensions(b"nothing") is None


def test_corpus(spark, tmp_path):
    (tmp_path / "book.xlsx").write_bytes(xlsx())
    (tmp_path / "deck.pptx").write_bytes(pptx())
    (tmp_path / "rows.csv").write_text("name,rank\nBerlin,2\n")
    (tmp_path / "notes.md").write_text("# One\ntext with needle\n## Two")
    (tmp_path / "pack.zip").write_bytes(packed({"README.md": "a needle here\nsecond", "logo.bin": "x"}))
    (tmp_path / "broken.docx").write_bytes(b"no")
    c = Corpus(spark, str(tmp_path))
    assert {(r.doc_id.rsplit("/")[-1], r.coverage or r.error) for r in c.coverage().collect()} == {
        ("book.xlsx", "COMPLETE"), ("deck.pptx", "COMPLETE"), ("rows.csv", "COMPLETE"), ("broken.docx", "DOCUMENT_CORRUPT")
    }
    assert [r.value for r in c.range("CSV", "A2:B2").orderBy("ord").collect()] == ["Berlin", "2"]
    assert [(r.value, r.formula) for r in c.range("Main", "B3").orderBy("ord").collect()] == [("4", None), (None, "=B1*2")]
    assert c.search("goals").count() == 2 and c.slide(1, include_notes=False).where("type = 'note'").count() == 0
    assert [r.line_no for r in c.text_search("NEEDLE").collect()] == [2]
    assert [(r.path, r.line_no) for r in c.archive_search("needle").collect()] == [("README.md", 1)]
    assert c.read_entry("README.md").first().total_lines == 2
    assert [(r.total_lines, r.error) for r in c.read_entry("none.md").collect()] == [(None, "ARCHIVE_ENTRY_NOT_FOUND")]
    assert [(bytes(r.content), r.error) for r in c.entry_bytes("logo.bin").collect()] == [(b"x", None)]
    assert [r.status for r in c.entry_items("logo.bin").collect()] == ["UNSUPPORTED_FILE_TYPE"] and [r.status for r in c.entry_items("README.md").collect()] == ["ARCHIVE_ENTRY_UNSUPPORTED"]
    assert {r.doc_id.rsplit("/")[-1]: r.preview.split("\n")[1] for r in c.preview().collect() if "csv" in r.doc_id} == {"rows.csv": "CSV · CSV!A1:B2"}
    assert {(r.family, r.cell) for r in c.first_cells().where("doc_id like '%xlsx'").collect()} == {(f, x) for f, x in (("cells", "A1"), ("cells", "B1"), ("cells", "A3"), ("cells", "B3"), ("cells", "C3"), ("cells", "D3"), ("formulas", "B3"), ("formulas", "D3"))}
    assert {k: v.count() for k, v in c.read("needle").items()} == {"document": 0, "text": 1, "archive": 1}
    assert c.read()["text"].first().total_lines == 3 and c.text_coverage().first().coverage == "COMPLETE"


def test_corpus_cache(spark, tmp_path, monkeypatch):
    """Equal bytes are parsed once, and only what is new on a second look."""
    from quire.sources import files

    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.csv").write_text("x,y\n1,2\n")
    (tmp_path / "in" / "b.csv").write_text("x,y\n1,2\n")
    (tmp_path / "in" / "c.csv").write_bytes(b'"open')
    parsed, parse = [], files.parse_documents
    monkeypatch.setattr(files, "parse_documents", lambda d, i=None: parsed.append(d.count()) or parse(d, i))
    cells_of = lambda c: sorted((r.doc_id.rsplit("/")[-1], r.cell, r.value) for r in c.items.where("family = 'cells'").collect())
    want = [(f, c, v) for f in ("a.csv", "b.csv") for c, v in (("A1", "x"), ("A2", "1"), ("B1", "y"), ("B2", "2"))]
    assert cells_of(Corpus(spark, str(tmp_path / "in"), cache=str(tmp_path / "cache"))) == want
    (tmp_path / "in" / "d.csv").write_text("z\n")
    c = Corpus(spark, str(tmp_path / "in"), cache=str(tmp_path / "cache"))
    assert cells_of(c) == [*want, ("d.csv", "A1", "z")] and parsed == [2, 1]
    assert {r.doc_id.rsplit("/")[-1] for r in c.coverage().where("error is not null").collect()} == {"c.csv"}


def test_damaged_archives(spark, tmp_path):
    good = packed({"a.txt": "hello", "b.txt": "again " * 50, "c.bin": "x"})
    bad = bytearray(good)
    at = good.index(b"b.txt") + 5
    bad[at : at + 4] = b"\xff\xff\xff\xff"
    (tmp_path / "bad.zip").write_bytes(bytes(bad))
    (tmp_path / "none.zip").write_bytes(b"PK")
    (tmp_path / "many.zip").write_bytes(packed({f"n{i}.txt": str(i) for i in range(2500)}))
    rows = Corpus(spark, str(tmp_path)).entries.collect()
    by = lambda n: [(r.path, r.text and r.text[:5], r.error) for r in rows if r.archive_id.endswith(n)]
    assert by("bad.zip") == [("a.txt", "hello", None), ("b.txt", None, "ARCHIVE_CORRUPT"), ("c.bin", None, None)]
    assert by("none.zip") == [(None, None, "ARCHIVE_CORRUPT")]
    assert by("many.zip") == [(f"n{i}.txt", str(i), None) for i in range(2500)]


def answered(spark, query, n: int) -> None:
    """Waits for so many answers; timeouts keep such a query running until it is stopped."""
    import time

    for _ in range(600):
        if spark.table(query.name).count() >= n or query.exception():
            break
        time.sleep(0.1)
    query.stop()


def test_uploads_stream(spark, tmp_path):
    from quire.streaming.uploads import run_uploads

    rows = [
        ("s", "u", "begin", 0, 0, 0, 10), ("s", "u", "chunk", 1, 0, 6, 0), ("s", "u", "chunk", 2, 2, 4, 0), ("s", "u", "chunk", 3, 1, 4, 0), ("s", "u", "commit", 4, 0, 0, 0),
        ("s", "v", "begin", 5, 0, 0, 5), ("s", "v", "chunk", 6, 0, 9, 0), ("s", "v", "commit", 7, 0, 0, 0), ("s", "v", "cancel", 8, 0, 0, 0), ("s", "w", "chunk", 9, 0, 1, 0),
    ]
    schema = "session_id string, upload_id string, event string, seq long, idx int, bytes long, declared long"
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(str(tmp_path / "in"))
    events = spark.readStream.schema(schema).parquet(str(tmp_path / "in"))
    q = run_uploads(events).writeStream.format("memory").queryName("uploads").option("checkpointLocation", str(tmp_path / "ck")).start()
    answered(spark, q, 10)
    got = {r.seq: r.status for r in spark.table("uploads").collect()}
    assert got == {0: "OPEN", 1: "OK", 2: "BAD_REQUEST", 3: "OK", 4: "COMMITTED", 5: "OPEN", 6: "BAD_REQUEST", 7: "BAD_REQUEST", 8: "CANCELLED", 9: "BAD_REQUEST"}


def test_uploads_global_cap(spark, tmp_path):
    from quire.streaming.uploads import run_capped_uploads

    rows = [(f"s{k % 2}", f"u{k}", "begin", k, 0, 0, 4) for k in range(4)]
    rows += [("s0", "u0", "chunk", 4, 0, 4, 0), ("s0", "u0", "commit", 5, 0, 0, 0), ("s1", "u4", "begin", 6, 0, 0, 4), ("s0", "", "cancel_session", 7, 0, 0, 0), ("s1", "u5", "begin", 8, 0, 0, 4), ("s1", "u6", "begin", 9, 0, 0, 4)]
    schema = "session_id string, upload_id string, event string, seq long, idx int, bytes long, declared long"
    spark.createDataFrame(rows, schema).repartition(3).write.parquet(str(tmp_path / "in"))
    events = spark.readStream.schema(schema).parquet(str(tmp_path / "in"))
    q = run_capped_uploads(events, most=3).writeStream.format("memory").queryName("capped").option("checkpointLocation", str(tmp_path / "ck")).start()
    answered(spark, q, 10)
    got = [(r.seq, r.upload_id, r.status) for r in spark.table("capped").orderBy("seq").collect()]
    assert got == [
        (0, "u0", "OPEN"), (1, "u1", "OPEN"), (2, "u2", "OPEN"), (3, "u3", "BAD_REQUEST"), (4, "u0", "OK"), (5, "u0", "COMMITTED"), (6, "u4", "OPEN"), (7, "u2", "CANCELLED"), (8, "u5", "OPEN"), (9, "u6", "BAD_REQUEST"),
    ]


def test_upload_machine_expires():
    from types import SimpleNamespace as E

    from quire.streaming.uploads import Machine

    m = Machine(10, 100, 100, 1)
    ev = lambda upload, event, seq, idx=0, size=0, declared=0: E(session_id="s", upload_id=upload, event=event, seq=seq, idx=idx, bytes=size, declared=declared)
    m.event(ev("a", "begin", 0, declared=5), 0)
    m.event(ev("b", "begin", 1, declared=5), 99)
    m.event(ev("b", "begin", 2, declared=5), 100)  # the idle one makes room
    m.event(ev("c", "begin", 3, declared=101), 100)
    assert [(a[1], a[2], a[4]) for a in m.answers] == [("a", "begin", "OPEN"), ("b", "begin", "BAD_REQUEST"), ("a", "expire", "EXPIRED"), ("b", "begin", "OPEN"), ("c", "begin", "FILE_TOO_LARGE")]
    again = Machine(10, 100, 100, 1)
    again.load(m.dump())
    assert again.open == m.open


def test_archive_budgets(spark):
    """The greedy choice passes over what does not fit, within small budgets."""
    from quire.operators import archive

    sizes = [5, 9, 4, 8, 1, 1, 1]
    e = spark.createDataFrame([("z", i, f"{i}.md" if i != 5 else "5.bin", n, False, "with x") for i, n in enumerate(sizes)], "archive_id string, ord int, path string, bytes long, directory boolean, text string")
    got = archive.admitted(e, files=3, total=11, each=8)
    assert sorted(r.ord for r in got.collect()) == [0, 2, 4] and {(r.searchable, r.searched) for r in got.collect()} == {(5, 3)}
    assert [r.path for r in archive.search(e, "WITH", 2, files=3, total=11, each=8).orderBy("hit").collect()] == ["0.md", "2.md"]


def test_dense_rows_of_doubled_cells(spark):
    d = spark.createDataFrame([(1, "s", 1, 1, "a"), (1, "s", 1, 1, "b"), (1, "s", 1, 3, "c"), (1, "s", 2, 2, "d")], "doc_id int, sheet string, row_no int, col_no int, value string")
    assert sorted((r.row_no, r.fields) for r in cells.dense_rows(d).collect()) == [(1, ["b", "", "c"]), (2, ["", "d", ""])]


def test_argument_text():
    from quire.operators import misc

    assert misc.argument_text({"a": "x", "b": [1, "y", {"c": "z"}]}) == "x\n\ny\nz"
    assert misc.argument_text([[[[["deep"]]]]]).strip() == "" and misc.argument_text([[[["four"]]]]) == "four"


def test_text_details(spark):
    from pyspark.sql import functions as F

    from quire.operators import misc, text, uploads

    d = spark.createDataFrame([(1, "ab\U0001f600c"), (2, "x\U0001f600"), (3, None), (4, "")], "doc_id long, text string")
    assert [r.preview for r in text.preview(d, 3).orderBy("doc_id").collect()] == ["ab", "x\U0001f600", ""]
    with pytest.raises(QueryError):
        text.search(d, " 　 ")
    b = spark.createDataFrame([("aGk=",), ("aGk",), ("aGl=",), ("",)], "t string").select(uploads.strict_base64(F.col("t")).alias("b"))
    assert [r.b and bytes(r.b) for r in b.collect()] == [b"hi", None, None, None]
    w, h = misc.patch_budget(F.lit(4096), F.lit(3072))
    assert spark.range(1).select(w, h).first()[:] == (1823, 1367)
    files = spark.createDataFrame([(bytearray(b"\xef\xbb\xbfhi"),), (bytearray(b"\xff"),), (bytearray(b"a\0"),), (bytearray(b""),)], "content binary")
    assert [(r.text, r.reason) for r in text.admission(files).collect()] == [("hi", None), (None, "TEXT_ENCODING_UNSUPPORTED"), (None, "TEXT_ENCODING_UNSUPPORTED"), (None, "BAD_REQUEST")]
