"""Publisher dialects of full-text XML: what in a document is a table, figure, reference or section.

Parsing is plain ElementTree on one document. Names lose their namespaces. Comments and processing instructions
are not content.
"""

from __future__ import annotations

import xml.etree.ElementTree as ET
from collections.abc import Iterator

Element = ET.Element


def flat(el: Element | None) -> str:
    """All text below an element, white space squashed."""
    return " ".join("".join(el.itertext()).split()) if el is not None else ""


def attribute(el: Element | None, ending: str) -> str:
    """The first attribute whose name ends so."""
    return next((v for k, v in el.attrib.items() if k.endswith(ending)), "") if el is not None else ""


def load(content: bytes) -> Element:
    """The root of a document, tags without namespaces."""
    root = ET.fromstring(content)
    for el in root.iter():
        if isinstance(el.tag, str):
            el.tag = el.tag.rpartition("}")[2]
    return root


def cell(el: Element) -> dict:
    """A cell's text, its lines (between breaks), footnote marks and the ids that it refers to."""
    lines = [""]

    def walk(e: Element) -> None:
        if e.tag == "break":
            lines.append("")
        lines[-1] += e.text or ""
        for child in e:
            walk(child)
            lines[-1] += child.tail or ""

    walk(el)
    kept = [x for x in (" ".join(s.split()) for s in lines) if x]
    marks = [m for m in ((s.text or "").strip() for s in el.iter("sup")) if m]
    refs = [r for x in el.iter() if x.tag in ("xref", "cross-ref") for r in [x.get("rid") or x.get("refid")] if r]
    return {"text": " ".join(kept), "lines": kept, "markers": marks, "ref_ids": refs}


def grid(rows: list[list[tuple[dict, int, int]]]) -> tuple[dict[tuple[int, int], dict], int, list[dict]]:
    """(cells by row and column, width, ragged rows) of rows of (cell, further rows, columns).

    A row is ragged if its own and held cells don't fill the width, or if a wide cell runs into a held one.
    """
    filled: dict[tuple[int, int], dict] = {}
    clashes = set()
    for r, row in enumerate(rows):
        c = 0
        for value, down, across in row:
            while (r, c) in filled:
                c += 1
            for k in range(max(1, across)):
                if (r, c + k) in filled:
                    clashes.add(r)
                for d in range(down + 1):
                    if r + d < len(rows):
                        filled[r + d, c + k] = value
            c += max(1, across)
    width = max((c for _, c in filled), default=-1) + 1
    counts = [sum((r, c) in filled for c in range(width)) for r in range(len(rows))]
    return filled, width, [{"row": r, "width": n} for r, n in enumerate(counts) if n != width or r in clashes]


def table(el: Element, label: str, caption: str, footnotes: str, header: list, body: list) -> dict:
    """A table with every cell of its rectangle, header rows and body rows numbered apart."""
    head, wide_head, _ = grid(header)
    rows, wide, ragged = grid(body)
    width = max(wide_head, wide)
    empty = {"text": "", "lines": [], "markers": [], "ref_ids": []}
    cells = [
        {"part": part, "row": r, "col": c} | filled.get((r, c), empty)
        for part, filled, n in (("header", head, len(header)), ("body", rows, len(body)))
        for r in range(n)
        for c in range(width)
    ]
    return {"table_id": el.get("id", ""), "label": label, "caption": caption, "footnotes": footnotes, "n_columns": width, "n_header": len(header), "ragged": ragged, "cells": cells}


def paragraphs(el: Element, *tags: str) -> list[str]:
    """The texts of an element's paragraphs, each once, in order."""
    return [t for t in (flat(p) for p in el.iter() if p.tag in tags) if t]


class Elsevier:
    """Documents with core data and CALS tables."""

    name = "elsevier"

    def matches(self, root: Element) -> bool:
        return root.find(".//coredata") is not None

    def paper(self, root: Element) -> dict:
        core = root.find(".//coredata")
        get = lambda tag: flat(core.find(tag))
        authors = "; ".join(flat(c) for c in core.findall("creator"))
        pages = get("pageRange") or get("articleNumber")
        return {"doi": get("doi"), "title": get("title"), "authors": authors, "journal": get("publicationName"), "volume": get("volume"), "issue": "", "pages": pages, "year": get("coverDate")[:4]}

    def tables(self, root: Element) -> Iterator[dict]:
        for el in root.findall(".//floats/table") or root.findall(".//table"):
            group = el.find(".//tgroup")
            names = [c.get("colname") for c in group.findall("colspec")] if group is not None else []

            def spans(entry: Element) -> tuple[dict, int, int]:
                ends = entry.get("namest"), entry.get("nameend")
                across = names.index(ends[1]) - names.index(ends[0]) + 1 if all(e in names for e in ends) else 1  # noqa: B023
                return cell(entry), int(entry.get("morerows") or 0), across

            parts = [[[spans(e) for e in row.findall("entry")] for row in (group.findall(f"{p}/row") if group is not None else [])] for p in ("thead", "tbody")]
            yield table(el, flat(el.find("label")), flat(el.find("caption")), " ".join(flat(x) for x in el.findall(".//legend")), *parts)

    def figures(self, root: Element) -> Iterator[dict]:
        for el in root.findall(".//floats/figure") or root.findall(".//figure"):
            yield {"figure_id": el.get("id", ""), "label": flat(el.find("label")), "caption": flat(el.find("caption")), "image_link": attribute(el.find(".//link"), "href")}

    def references(self, root: Element) -> Iterator[dict]:
        for el in root.findall(".//bibliography//bib-reference") or root.findall(".//bib-reference"):
            titles = [flat(t) for t in el.iter("maintitle")] + ["", ""]
            authors = [" ".join(filter(None, (flat(a.find("given-name")), flat(a.find("surname"))))) for a in el.iter("author")]
            yield {"label": flat(el.find("label")), "authors": [a for a in authors if a], "title": titles[0], "journal": titles[1], "year": flat(next(el.iter("date"), None)), "raw": flat(el)}

    def sections(self, root: Element) -> Iterator[dict]:
        body = root.find(".//body")
        for el in (root if body is None else body).iter("section"):
            if el.find("section") is None and el.find(".//table") is None:
                yield {"section_id": el.get("id", ""), "title": flat(el.find("section-title")), "text": flat(el), "paragraphs": paragraphs(el, "para", "simple-para")}


class Jats:
    """Documents of the journal archiving tag set."""

    name = "jats"

    def matches(self, root: Element) -> bool:
        return root.find(".//article-meta") is not None

    def paper(self, root: Element) -> dict:
        meta = root.find(".//article-meta")
        doi = next((flat(x) for x in meta.findall("article-id") if x.get("pub-id-type") == "doi"), "")
        names = [" ".join(filter(None, (flat(n.find("given-names")), flat(n.find("surname"))))) for n in meta.iter("name")]
        first, last = flat(meta.find("fpage")), flat(meta.find("lpage"))
        pages = f"{first}-{last}" if first and last else first or flat(meta.find("elocation-id"))
        return {
            "doi": doi,
            "title": flat(meta.find(".//article-title")),
            "authors": "; ".join(names),
            "journal": flat(root.find(".//journal-title")),
            "volume": flat(meta.find("volume")),
            "issue": flat(meta.find("issue")),
            "pages": pages,
            "year": flat(meta.find("pub-date/year")),
        }

    def tables(self, root: Element) -> Iterator[dict]:
        def spans(e: Element) -> tuple[dict, int, int]:
            return cell(e), int(e.get("rowspan") or 1) - 1, int(e.get("colspan") or 1)

        for el in root.iter("table-wrap"):
            parts = [[[spans(e) for e in row if e.tag in ("td", "th")] for row in el.findall(f".//{p}/tr")] for p in ("thead", "tbody")]
            yield table(el, flat(el.find("label")), flat(el.find("caption")), " ".join(flat(x) for x in el.findall("table-wrap-foot")), *parts)

    def figures(self, root: Element) -> Iterator[dict]:
        for el in root.iter("fig"):
            yield {"figure_id": el.get("id", ""), "label": flat(el.find("label")), "caption": flat(el.find("caption")), "image_link": attribute(el.find(".//graphic"), "href")}

    def references(self, root: Element) -> Iterator[dict]:
        for el in root.findall(".//ref-list//ref"):
            authors = [" ".join(filter(None, (flat(n.find("given-names")), flat(n.find("surname"))))) for n in el.iter("name")]
            yield {"label": flat(el.find("label")).rstrip("."), "authors": authors, "title": flat(next(el.iter("article-title"), None)), "journal": flat(next(el.iter("source"), None)), "year": flat(next(el.iter("year"), None)), "raw": flat(el)}

    def sections(self, root: Element) -> Iterator[dict]:
        body = root.find(".//body")
        for el in (root if body is None else body).iter("sec"):
            if el.find("sec") is None and el.find(".//table-wrap") is None:
                yield {"section_id": el.get("id", ""), "title": flat(el.find("title")), "text": flat(el), "paragraphs": paragraphs(el, "p")}


_DIALECTS: list = [Elsevier(), Jats()]


def register_dialect(dialect) -> None:
    """Adds a dialect (name, matches, paper, tables, figures, references, sections); it is asked before the others."""
    _DIALECTS.insert(0, dialect)


def parse(content: bytes, known: list | None = None) -> dict:
    """paper, tables, figures, references and sections of a document; an error names the root of an unknown one."""
    root = load(content)
    dialect = next((d for d in known or _DIALECTS if d.matches(root)), None)
    if dialect is None:
        raise ValueError(f"no dialect knows <{root.tag}>")
    references: dict[int, dict] = {}
    for ref in dialect.references(root):
        label = ref.pop("label").strip("[] ")
        if label.isdigit():
            references[int(label)] = {"ref_number": int(label)} | ref
    return {
        "paper": dialect.paper(root) | {"dialect": dialect.name},
        "tables": list(dialect.tables(root)),
        "figures": list(dialect.figures(root)),
        "references": list(references.values()),
        "sections": list(dialect.sections(root)),
    }
