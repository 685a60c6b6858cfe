"""PDF files made by the tests, read with the standard library, with a stand-in for an extra reader and with errors."""

import zlib

from graphloom.sources import pdf, readers


def make(pages, title=b"(A \\(small\\) report)", packed=True, author=b"<FEFF00C9006C0061>"):
    """A PDF of pages, each a list of lines."""
    objects = {1: b"<< /Type /Catalog /Pages 2 0 R >>", 3: b"<< /Title " + title + b" /Author " + author + b" >>"}
    kids = []
    for i, lines in enumerate(pages):
        n = 10 + 2 * i
        kids.append(b"%d 0 R" % n)
        text = b"BT /F1 12 Tf 72 700 Td " + b" 0 -14 Td ".join(line if line.startswith(b"[") else b"(" + line + b") Tj" for line in lines) + b" ET"
        body = zlib.compress(text) if packed else text
        objects[n] = b"<< /Type /Page /Parent 2 0 R /Contents %d 0 R >>" % (n + 1)
        objects[n + 1] = b"<< /Length %d%s >>\nstream\n" % (len(body), b" /Filter /FlateDecode" if packed else b"") + body + b"\nendstream"
    objects[2] = b"<< /Type /Pages /Count %d /Kids [%s] >>" % (len(kids), b" ".join(kids))
    return b"%PDF-1.4\n" + b"".join(b"%d 0 obj\n%s\nendobj\n" % (n, b) for n, b in sorted(objects.items())) + b"trailer << /Root 1 0 R /Info 3 0 R >>\n%%EOF"


PAGES = [[b"before", b"METHODS", b"caf\\351 \\(one\\)"], [b"[(Wa) 20 (ter) -300 (rises)] TJ", b"RESULTS", b"all good"]]


def test_pages_and_properties():
    for packed in (True, False):
        texts, info = pdf.read(make(PAGES, packed=packed))
        assert texts == ["before\nMETHODS\ncafé (one)", "Water rises\nRESULTS\nall good"]
        assert info == {"Title": "A (small) report", "Author": "Éla"}


def test_sections_go_over_pages(spark):
    files = spark.createDataFrame([("d/a.pdf", bytearray(make(PAGES))), ("d/b.pdf", bytearray(b"no pdf")), ("d/c.pdf", bytearray(make([[b""]]))), ("d/d.pdf", bytearray(make(PAGES) + b"/Encrypt"))], "path string, content binary")
    docs = readers.read_pdf(files).cache()
    got = {r.source: (r.title, r.author, r.pages, r.error is None) for r in docs.collect()}
    assert got == {"d/a.pdf": ("A (small) report", "Éla", 2, True), "d/b.pdf": ("b.pdf", None, None, False), "d/c.pdf": ("c.pdf", None, None, False), "d/d.pdf": ("d.pdf", None, None, False)}
    assert docs.where("pages = 2").first().text == "before\nMETHODS\ncafé (one)\n\nWater rises\nRESULTS\nall good\n\n"
    cut = [(r.section_no, r.title, r.content) for r in readers.pdf_sections(docs).orderBy("section_no").collect()]
    assert cut == [(1, "Introduction", "before\n"), (2, "METHODS", "café (one)\nWater rises\n"), (3, "RESULTS", "all good\n")]


def test_the_next_reader_is_tried(spark):
    def broken(content):
        raise RuntimeError("first reader")

    files = spark.createDataFrame([("x.pdf", bytearray(b"ok")), ("y.pdf", bytearray(b"bad"))], "path string, content binary")

    def second(content):
        if content == b"bad":
            raise ValueError("second reader")
        return ["one", "", "two"], {}

    got = {r.source: (r.text, r.pages, r.title, r.error) for r in readers.read_pdf(files, [broken, second]).collect()}
    assert got == {"x.pdf": ("one\n\ntwo\n\n", 3, "x.pdf", None), "y.pdf": (None, None, "y.pdf", "ValueError: second reader")}
