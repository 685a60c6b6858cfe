"""Text and properties of simple PDF files with the standard library alone.

Reads plain and object streams, Flate compression, page trees and text operators of
fonts with a single-byte encoding. Encrypted files and files without such text raise
ValueError, so a caller can try another reader.
"""

from __future__ import annotations

import re
import zlib

_OBJECT = re.compile(rb"(\d+)\s+\d+\s+obj\b(.*?)\bendobj", re.S)
_STREAM = re.compile(rb"stream\r?\n(.*?)\r?\n?endstream", re.S)
_REF = re.compile(rb"(\d+)\s+\d+\s+R")
_TOKEN = re.compile(rb"\((?:[^()\\]|\\.|\((?:[^()\\]|\\.)*\))*\)|<[0-9A-Fa-f\s]*>|\[|\]|/[^\s/\[\]()<>]+|[-+]?\d*\.?\d+|[A-Za-z'\"*]+[0-9]?", re.S)
_ESCAPES = {b"n": b"\n", b"r": b"\r", b"t": b"\t", b"b": b"\b", b"f": b"\f"}
#: a gap in a line of shown strings, in thousandths of the font size, that stands for a blank
GAP = 200


def _string(raw: bytes) -> str:
    """A literal or hexadecimal string; UTF-16 when it is marked so, else cp1252."""
    if raw.startswith(b"<"):
        digits = re.sub(rb"\s", b"", raw[1:-1])
        data = bytes.fromhex((digits + b"0" * (len(digits) % 2)).decode())
    else:
        one = lambda m: _ESCAPES.get(m.group(1), b"") or (bytes([int(m.group(1), 8) & 255]) if m.group(1)[:1].isdigit() else m.group(1).strip(b"\r\n"))
        data = re.sub(rb"\\([0-7]{1,3}|\r\n|.)", one, raw[1:-1], flags=re.S)
    return data[2:].decode("utf-16-be", "replace") if data.startswith(b"\xfe\xff") else data.decode("cp1252", "replace")


def _inflated(body: bytes) -> bytes | None:
    m = _STREAM.search(body)
    if not m:
        return None
    head = body[: m.start()]
    if b"/FlateDecode" in head:
        return zlib.decompressobj().decompress(m.group(1))
    return None if b"/Filter" in head else m.group(1)


def _objects(content: bytes) -> dict[int, bytes]:
    found = {int(m.group(1)): m.group(2) for m in _OBJECT.finditer(content)}
    for body in list(found.values()):
        if b"/ObjStm" in body and (data := _inflated(body)):
            first = int(re.search(rb"/First\s+(\d+)", body).group(1))
            heads = list(map(int, data[:first].split()))
            ends = [*heads[3::2], len(data) - first]
            for number, start, end in zip(heads[::2], heads[1::2], ends):
                found.setdefault(number, data[first + start : first + end])
    return found


def _pages(objects: dict[int, bytes]) -> list[bytes]:
    """Page objects in the order of the page tree, else of their numbers."""
    is_page = lambda b: re.search(rb"/Type\s*/Page\b(?!s)", b) is not None
    root = next((b for b in objects.values() if re.search(rb"/Type\s*/Catalog\b", b)), b"")
    top = re.search(rb"/Pages\s+(\d+)", root)
    out, seen = [], set()
    stack = [int(top.group(1))] if top else []
    while stack:
        n = stack.pop()
        body = objects.get(n, b"")
        if n in seen:
            continue
        seen.add(n)
        if is_page(body):
            out.append(body)
        elif kids := re.search(rb"/Kids\s*\[(.*?)\]", body, re.S):
            stack += [int(r) for r in reversed(_REF.findall(kids.group(1)))]
    return out or [b for _, b in sorted(objects.items()) if is_page(b)]


def _shown(data: bytes) -> str:
    """Text of a content stream; a move to another line gives a newline."""
    out: list[str] = []
    operands: list[bytes] = []
    for m in _TOKEN.finditer(data):
        t = m.group()
        if t[:1] in b"(<[]/+-.0123456789":
            operands.append(t)
            continue
        if t in (b"Tj", b"TJ", b"'", b'"'):
            if t in (b"'", b'"'):
                out.append("\n")
            for x in operands:
                if x[:1] in b"(<":
                    out.append(_string(x))
                elif t == b"TJ" and x[:1] not in b"[]/" and float(x) < -GAP:
                    out.append(" ")
        elif t == b"T*" or (t in (b"Td", b"TD") and len(operands) > 1 and float(operands[-1]) != 0) or t in (b"Tm", b"BT"):
            out.append("\n")
        operands = []
    lines = [x.strip() for x in "".join(out).split("\n")]
    return "\n".join(x for x in lines if x)


def read(content: bytes) -> tuple[list[str], dict[str, str]]:
    """(texts of the pages, properties such as Title and Author)."""
    if not content.lstrip()[:5] == b"%PDF-":
        raise ValueError("no PDF file")
    if b"/Encrypt" in content:
        raise ValueError("an encrypted PDF file")
    objects = _objects(content)
    texts = []
    for page in _pages(objects):
        m = re.search(rb"/Contents\s*(\[.*?\]|\d+\s+\d+\s+R)", page, re.S)
        parts = [_inflated(objects.get(int(r), b"")) for r in _REF.findall(m.group(1))] if m else []
        texts.append(_shown(b"\n".join(p for p in parts if p)))
    if not any(texts):
        raise ValueError("no text that this reader understands")
    info = re.search(rb"/Info\s+(\d+)", content)
    body = objects.get(int(info.group(1)), b"") if info else b""
    found = re.findall(rb"/(Title|Author|Subject|Creator|Producer)\s*(\((?:[^()\\]|\\.)*\)|<[0-9A-Fa-f\s]*>)", body, re.S)
    return texts, {k.decode(): _string(v) for k, v in found}
