"""Parsers of whole documents as vectorised UDFs: HTML blocks, Markdown review units, XML bibliographies, equation density."""

from __future__ import annotations

import re
from collections.abc import Callable
from html.parser import HTMLParser

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

_S, _I = T.StringType(), T.IntegerType()


def _list(**fields: T.DataType) -> T.ArrayType:
    return T.ArrayType(T.StructType([T.StructField(n, t) for n, t in fields.items()]))


def _parser(kind: T.DataType, of: Callable, at_once: int = 1 << 20) -> Callable:
    """A UDF of ``of`` on each row's text. Python's objects are those of about ``at_once`` bytes of texts; of the rest of a batch there are
    only Arrow arrays, which are many times smaller."""
    arrow = to_arrow_type(kind)

    def run(texts: pa.Array) -> pa.Array:
        done, start, held = [pa.array([], arrow)], 0, 0
        for stop, size in enumerate(pc.binary_length(texts).fill_null(0).to_pylist(), 1):
            held += size
            if held >= at_once or stop == len(texts):
                done.append(pa.array([of(x) for x in texts.slice(start, stop - start).to_pylist()], arrow))
                start, held = stop, 0
        return pa.concat_arrays(done)

    run.__annotations__ = {"texts": pa.Array, "return": pa.Array}
    return F.arrow_udf(run, kind)


FURNITURE_TAGS = {"head", "script", "style", "nav", "footer", "aside", "form", "noscript", "template"}
FURNITURE_WORDS = {"nav", "menu", "sidebar", "footer", "cookie", "breadcrumb", "advert", "share", "banner"}
BLOCK_TAGS = {"p", "li", "td", "th", "blockquote", "pre", "dd", "dt", "figcaption"}
HEADINGS = {f"h{i}": i for i in range(1, 7)}
VOID = {"br", "img", "hr", "meta", "link", "input", "source", "wbr", "area", "base", "col", "embed", "track", "param"}


class _Blocks(HTMLParser):
    """Headings and paragraphs in reading order, without what stands inside furniture."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.stack: list[tuple[str, bool]] = []
        self.hidden = 0
        self.text: list[str] = []
        self.kind, self.level = "paragraph", 0
        self.out: list[tuple[str, str, int]] = []

    def _flush(self) -> None:
        text = " ".join("".join(self.text).split())
        self.text = []
        if text and (not self.out or self.out[-1][1] != text):
            self.out.append((self.kind, text, self.level))

    def handle_starttag(self, tag, attrs):
        if tag in HEADINGS or tag in BLOCK_TAGS:
            self._flush()
            self.kind, self.level = ("heading", HEADINGS[tag]) if tag in HEADINGS else ("paragraph", 0)
        if tag == "br":
            self.text.append(" ")
        if tag in VOID:
            return
        named = {w for k, v in attrs if k in ("class", "id") and v for w in re.split(r"[\s_-]+", v.lower())}
        bad = tag in FURNITURE_TAGS or bool(named & FURNITURE_WORDS)
        if bad and not self.hidden:
            self._flush()
        self.hidden += bad
        self.stack.append((tag, bad))

    def handle_endtag(self, tag):
        if tag in HEADINGS or tag in BLOCK_TAGS:
            self._flush()
            self.kind, self.level = "paragraph", 0
        if any(t == tag for t, _ in self.stack):
            while self.stack:
                t, bad = self.stack.pop()
                self.hidden -= bad
                if t == tag:
                    break

    def handle_data(self, data):
        if not self.hidden:
            self.text.append(data)


def blocks_of(html: str) -> list[tuple[str, str, int]]:
    p = _Blocks()
    p.feed(html)
    p.close()
    p._flush()
    return p.out


html_blocks = _parser(_list(kind=_S, text=_S, level=_I), lambda h: [] if h is None else [{"kind": k, "text": t, "level": n} for k, t, n in blocks_of(h)])


def units_of(text: str) -> list[tuple[str, str, str]]:
    """(section, kind, text) of a Markdown text: paragraphs, bullets and table rows; fenced code is no prose and holds no headings."""
    out, section, para, fence = [], "", [], None

    def close() -> None:
        if para:
            out.append((section, "paragraph", " ".join(para)))
            para.clear()

    for line in text.split("\n"):
        mark = re.match(r"\s*(`{3,}|~{3,})", line)
        if fence:
            if mark and mark[1][0] == fence[0] and len(mark[1]) >= len(fence) and line.strip() == mark[1]:
                fence = None
            continue
        if mark:
            close()
            fence = mark[1]
        elif h := re.match(r"\s{0,3}#{1,6}\s+(.*?)\s*#*\s*$", line):
            close()
            section = h[1]
        elif not line.strip():
            close()
        elif b := re.match(r"\s*(?:[-*+]|\d+[.)])\s+(.*)", line):
            close()
            out.append((section, "bullet", b[1].strip()))
        elif line.lstrip().startswith("|"):
            close()
            if not re.fullmatch(r"[\s|:\-]+", line):
                out.append((section, "row", line.strip().strip("|").strip()))
        else:
            para.append(line.strip())
    close()
    return out


markdown_units = _parser(_list(section=_S, kind=_S, text=_S), lambda t: [] if t is None else [{"section": s, "kind": k, "text": x} for s, k, x in units_of(t)])


def sentences_of(text: str) -> list[str]:
    """Sentences; full stops inside quotation marks or square brackets end none."""
    out, start, quoted, depth = [], 0, False, 0
    for i, c in enumerate(text):
        if c in "\"“”":
            quoted = c == "“" or (c == '"' and not quoted)
        depth += (c == "[") - (c == "]" and depth > 0)
        if c in ".!?" and not quoted and not depth and (i + 1 == len(text) or text[i + 1].isspace()):
            out.append(text[start : i + 1].strip())
            start = i + 1
    return [s for s in [*out, text[start:].strip()] if s]


sentences = _parser(T.ArrayType(_S), lambda t: [] if t is None else sentences_of(t))


def density_of(text: str) -> float:
    """Share of non-space characters in mathematics: lines that end in a number in brackets and short lines with a relation count whole, others their operators."""
    total = maths = 0
    for line in text.split("\n"):
        n = len(re.sub(r"\s", "", line))
        total += n
        if re.search(r"\(\d+(\.\d+)?\)\s*$", line) or (n <= 40 and re.search(r"[=<>≤≥≈∈]", line)):
            maths += n
        else:
            maths += len(re.findall(r"[=<>≤≥≈∈∑∫∂√±×÷^_{}\\α-ωΑ-Ω]", line))
    return round(maths / total, 6) if total else 0.0


equation_density = _parser(T.DoubleType(), lambda t: None if t is None else density_of(t))


def repeated_tail_of(text: str, least: int = 4, longest: int = 60) -> tuple[int, int, str] | None:
    """(repeats, length, unit) of the shortest unit of up to ``longest`` characters that stands ``least`` times or more at the
    text's end; None if there is none. The repeats are counted over the whole text."""
    for n in range(1, min(longest, len(text) // least) + 1):
        unit = text[-n:]
        if text.endswith(unit * least):
            at = len(text) - n * least
            while at >= n and text.startswith(unit, at - n):
                at -= n
            return (len(text) - at) // n, n, unit
    return None


def _tail(text: str | None) -> dict:
    return dict(zip(("repeats", "length", "unit"), (text and repeated_tail_of(text)) or (None, None, None)))


repeated_tail = _parser(T.StructType([T.StructField("repeats", _I), T.StructField("length", _I), T.StructField("unit", _S)]), _tail)


def references_of(xml: str) -> list[dict]:
    """title, doi, year and family names of each bibliographic entry of a TEI document."""
    import xml.etree.ElementTree as ET

    try:
        root = ET.fromstring(xml)
    except ET.ParseError:
        return []
    local = lambda e: e.tag.rsplit("}", 1)[-1]
    out = []
    for bib in (e for e in root.iter() if local(e) == "biblStruct"):
        titles = ["".join(e.itertext()).strip() for e in bib.iter() if local(e) == "title"]
        ids = ["".join(e.itertext()).strip() for e in bib.iter() if local(e) == "idno" and (e.get("type") or "").upper() == "DOI"]
        when = [e.get("when") or "" for e in bib.iter() if local(e) == "date"]
        years = [m[0] for w in when if (m := re.match(r"\d{4}", w))]
        out.append({"title": next((t for t in titles if t), None), "doi": ids[0].lower() if ids else None, "year": int(years[0]) if years else None, "families": ["".join(e.itertext()).strip() for e in bib.iter() if local(e) == "surname"]})
    return out


tei_references = _parser(_list(title=_S, doi=_S, year=_I, families=T.ArrayType(_S)), lambda x: [] if x is None else references_of(x))


def boxes_of(coords: str | None) -> list[tuple[int, list[float]]]:
    """(page, x0, y0, x1, y1) of "page,x,y,width,height" groups parted by semicolons; a group that isn't five numbers is left out."""
    out = []
    for group in (coords or "").split(";"):
        try:
            page, x, y, w, h = map(float, group.split(","))
        except ValueError:
            continue
        out.append((int(page), [x, y, x + w, y + h]))
    return out


def mentions_of(xml: str) -> list[dict]:
    """A row a box of each in-text reference of a TEI body, one without a place if it has none, with the sentence that it stands in."""
    import xml.etree.ElementTree as ET

    try:
        root = ET.fromstring(xml)
    except ET.ParseError:
        return []
    local = lambda e: e.tag.rsplit("}", 1)[-1]
    words = lambda e: " ".join("".join(e.itertext()).split())
    out = []

    def walk(element: ET.Element, sentence: ET.Element | None) -> None:
        if local(element) == "s":
            sentence = element
        if local(element) == "ref" and element.get("type") == "bibr":
            said = boxes_of(sentence.get("coords")) if sentence is not None else []
            for i, (page, box) in enumerate(boxes_of(element.get("coords")) or [(None, None)]):
                out.append({"target": (element.get("target") or "").lstrip("#"), "marker": words(element), "page": page, "box": box, "box_index": i, "sentence": "" if sentence is None else words(sentence), "sentence_page": said[0][0] if said else None})
        for child in element:
            walk(child, sentence)

    for text in (e for e in root.iter() if local(e) == "text"):
        for body in (e for e in text if local(e) == "body"):
            walk(body, None)
            return out
    return out


citation_mentions = _parser(_list(target=_S, marker=_S, page=_I, box=T.ArrayType(T.DoubleType()), box_index=_I, sentence=_S, sentence_page=_I), lambda x: [] if x is None else mentions_of(x))
