"""Jobs over landed web pages: text, links, dates and tables from HTML."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from html.parser import HTMLParser
from itertools import islice
from urllib.parse import urljoin

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from foghorn import vocab
from foghorn.functions import dates as dx, measures as mx, text as tx
from foghorn.operators.rows import keep_one

TEXT_TAGS = {"h1", "h2", "h3", "p", "li"}
SILENT = {"script", "style"}
CLOSES_ITSELF = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}


class _PageReader(HTMLParser):
    """Collects title, text parts in document order, links, time and date marks."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.title: list[str] = []
        self.titles = 0
        self.parts: list[list[str]] = []
        self.links: list[str] = []
        self.time = ""
        self.times = 0
        self.metas: dict[str, str] = {}
        self.stack: list[tuple[str, int]] = []

    def handle_starttag(self, tag, attrs):
        values = dict(attrs)
        if tag == "a" and values.get("href") is not None:
            self.links.append(values["href"])
        elif tag == "time":
            if self.times == 0:
                self.time = values.get("datetime") or ""
            self.times += 1
        elif tag == "meta":
            key = "published" if values.get("property") == "article:published_time" else None
            if key is None and values.get("name") == "date":
                key = "date"
            if key:
                self.metas.setdefault(key, values.get("content") or "")
        elif tag == "title":
            self.titles += 1
        if tag in CLOSES_ITSELF:
            return
        part = -1
        if tag in TEXT_TAGS:
            part = len(self.parts)
            self.parts.append([])
        self.stack.append((tag, part))

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in CLOSES_ITSELF:
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        for i in range(len(self.stack) - 1, -1, -1):
            if self.stack[i][0] == tag:
                del self.stack[i:]
                return

    def handle_data(self, data):
        text = data.strip()
        if not text:
            return
        open_tags = [t for t, _ in self.stack]
        if any(t in SILENT for t in open_tags):
            return
        if "title" in open_tags and self.titles == 1:
            self.title.append(text)
        for _, part in self.stack:
            if part >= 0:
                self.parts[part].append(text)


def _read_page(url: str, html: str, max_parts: int | None = None) -> dict:
    reader = _PageReader()
    reader.feed(html or "")
    reader.close()
    return {
        "title": " ".join(reader.title),
        "text": " ".join(" ".join(p) for p in reader.parts[:max_parts]),
        "hrefs": [urljoin(url, h.strip()) if not h.startswith("http") else h for h in reader.links],
        "time_tag": reader.time,
        "meta_tag": reader.metas.get("published") or reader.metas.get("date") or "",
    }


#: Bytes of HTML that are read together; a larger page is read alone.
PAGE_BYTES = 1 << 20


def _small(batches: Iterator[pa.RecordBatch], limit: int = PAGE_BYTES) -> Iterator[dict[str, list]]:
    """Rows of Arrow batches as Python lists, a few pages at a time."""
    for batch in batches:
        begin, held = 0, 0
        sizes = pc.fill_null(pc.binary_length(batch.column("html")), 0).to_pylist()
        for end, size in enumerate(sizes, 1):
            held += size
            if held >= limit or end == len(sizes):
                yield batch.slice(begin, end - begin).to_pydict()
                begin, held = end, 0


def page_contents(pages: DataFrame, max_parts: int | None = None) -> DataFrame:
    """``page_id, url, title, text, hrefs, published`` per landed page, in Arrow batches.

    The text is that of the headings, paragraphs and list items; ``max_parts``
    stops after that many of them, by default the whole page is taken.
    """

    text = pa.string()
    schema = pa.schema(
        {"page_id": pa.int64(), "url": text, "title": text, "text": text, "hrefs": pa.list_(text), "time_tag": text, "meta_tag": text}
    )

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _small(batches):
            pages = zip(rows["page_id"], rows["url"], rows["html"])
            yield pa.RecordBatch.from_pylist(
                [{"page_id": i, "url": u, **_read_page(u, h, max_parts)} for i, u, h in pages], schema
            )

    parsed = pages.select("page_id", "url", "html").mapInArrow(
        parse,
        "page_id bigint, url string, title string, text string, hrefs array<string>, "
        "time_tag string, meta_tag string",
    )
    published = dx.page_date(
        F.nullif(F.col("time_tag"), F.lit("")), F.nullif(F.col("meta_tag"), F.lit("")), F.col("url")
    )
    return parsed.withColumn("published", published).drop("time_tag", "meta_tag")


def page_links(contents: DataFrame, same_domain: bool = True) -> DataFrame:
    """Distinct canonical links per page, to the page's own domain only by default."""
    links = contents.select("page_id", "url", F.explode("hrefs").alias("href")).withColumn(
        "link", tx.canonical_url("href")
    )
    if same_domain:
        links = links.filter(tx.url_domain("href").contains(tx.url_domain("url")))
    return links.select("page_id", "link").distinct()


def page_scores(contents: DataFrame, as_of: str, patterns: Sequence[str] = vocab.PAGE_TERMS) -> DataFrame:
    """Density, score and canonical url per page; zero scores dropped, one row per url."""
    text = F.concat(F.col("title"), F.lit("\n"), F.col("text"))
    scored = contents.withColumn("density", mx.term_density(text, patterns)).withColumn(
        "score",
        mx.page_score(F.col("url"), F.col("density"), dx.age_days(dx.as_of_lit(as_of), F.col("published"))),
    )
    kept = scored.filter("score > 0").withColumn("url", tx.canonical_url("url"))
    return keep_one(kept, ["url"], [F.col("page_id").asc()])


def page_events(scored: DataFrame, universe: DataFrame, as_of: str) -> DataFrame:
    """Scored pages as events of the company that owns the domain."""
    owners = keep_one(
        universe.filter(F.trim(tx.text_or_blank("company_domain")) != "").withColumn(
            "_domain", F.lower(F.trim("company_domain"))
        ),
        ["_domain"],
        [F.col("company_id").asc()],
    )
    return (
        scored.withColumn("_domain", tx.url_domain("url"))
        .join(owners, "_domain")
        .withColumns(
            {
                "source": F.lit("webscan"),
                "signal_type": F.lit("web_esg"),
                "signal_strength": F.col("score"),
                "ts": F.coalesce("published", dx.as_of_lit(as_of)),
                "text_snippet": F.col("text"),
            }
        )
        .drop("_domain")
    )


# --- tables -------------------------------------------------------------------

class _TableReader(HTMLParser):
    """Rows of every table: cells with their text, tag, class and first link."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.tables: list[list[list[dict]]] = []
        self.open: list[int] = []
        self.cell: dict | None = None

    def handle_starttag(self, tag, attrs):
        values = dict(attrs)
        if tag == "table":
            self.tables.append([])
            self.open.append(len(self.tables) - 1)
            self.cell = None
        elif tag == "tr" and self.open:
            self.tables[self.open[-1]].append([])
            self.cell = None
        elif tag in ("td", "th") and self.open and self.tables[self.open[-1]]:
            self.cell = {"tag": tag, "cls": (values.get("class") or "").split(), "text": [], "href": ""}
            self.tables[self.open[-1]][-1].append(self.cell)
        elif tag == "a" and self.cell is not None and values.get("href") and not self.cell["href"]:
            self.cell["href"] = values["href"]

    def handle_endtag(self, tag):
        if tag in ("td", "th", "tr"):
            self.cell = None
        elif tag == "table" and self.open:
            self.open.pop()
            self.cell = None

    def handle_data(self, data):
        if self.cell is not None and data.strip():
            self.cell["text"].append(data.strip())


def _table_rows(url: str, html: str) -> Iterator[dict]:
    reader = _TableReader()
    reader.feed(html or "")
    reader.close()
    for table_no, rows in enumerate(reader.tables):
        header = next((r for r in rows if r and all(c["tag"] == "th" for c in r)), None)
        names = [" ".join(c["text"]) for c in header] if header else []
        row_no = 0
        for row in rows:
            if not row or row is header:
                continue
            texts = [" ".join(c["text"]) for c in row]
            if names and len(names) >= len(texts):
                cells = dict(zip(names, texts + [""] * (len(names) - len(texts))))
            else:
                cells = {f"col_{i}": t for i, t in enumerate(texts)}
            classes = {name: t for c, t in zip(row, texts) for name in c["cls"]}
            heads = [c for c in row if c["tag"] == "th"]
            link = next((c["href"] for c in heads + row if c["href"]), "")
            yield {
                "url": url,
                "table_no": table_no,
                "row_no": row_no,
                "cells": list(cells.items()),
                "classes": list(classes.items()),
                "values": texts,
                "first_is_head": row[0]["tag"] == "th",
                "link": urljoin(url, link) if link else "",
            }
            row_no += 1


_TABLE_SCHEMA = pa.schema(
    {
        "url": pa.string(),
        "table_no": pa.int32(),
        "row_no": pa.int32(),
        "cells": pa.list_(pa.struct({"k": pa.string(), "v": pa.string()})),
        "classes": pa.list_(pa.struct({"k": pa.string(), "v": pa.string()})),
        "values": pa.list_(pa.string()),
        "first_is_head": pa.bool_(),
        "link": pa.string(),
    }
)


def _table_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for pages in _small(batches):
        found = (r for u, h in zip(pages["url"], pages["html"]) for r in _table_rows(u, h))
        while rows := list(islice(found, 5000)):
            yield pa.RecordBatch.from_pylist(rows, _TABLE_SCHEMA)


def table_rows(pages: DataFrame) -> DataFrame:
    """One row per HTML table row: cells by header, by class, in order, and the first link."""
    pairs = "array<struct<k: string, v: string>>"
    out = pages.select("url", "html").mapInArrow(
        _table_batches,
        f"url string, table_no int, row_no int, cells {pairs}, classes {pairs}, "
        "values array<string>, first_is_head boolean, link string",
    )
    last_wins = lambda c: F.map_from_entries(
        F.filter(
            F.transform(c, lambda e, i: F.when(
                ~F.exists(F.slice(c, i + 2, F.size(c)), lambda later: later["k"] == e["k"]), e
            )),
            lambda e: e.isNotNull(),
        )
    )
    return out.withColumns({"cells": last_wins(F.col("cells")), "classes": last_wins(F.col("classes"))})


def _member(name: Column, url: Column, ts: Column, kind: str, country: Column, sector: Column) -> list[Column]:
    return [
        name.alias("member_name"),
        url.alias("url"),
        ts.alias("ts"),
        F.lit("memberships").alias("source"),
        F.lit(kind).alias("signal_type"),
        country.alias("country"),
        sector.alias("sector"),
    ]


def _first_by_name(members: DataFrame) -> DataFrame:
    """First row per lower-case name in page and row order."""
    kept = keep_one(
        members.withColumn("_name", F.lower("member_name")),
        ["_name"],
        [F.col("_page").asc(), F.col("_row").asc()],
    )
    return kept.drop("_name", "_page", "_row")


def generic_members(rows: DataFrame, kind: str) -> DataFrame:
    """Members of the first table of a page, by the usual header names."""
    cell = lambda *names: F.coalesce(
        *[F.nullif(F.try_element_at("cells", F.lit(n)), F.lit("")) for n in names]
    )
    name = F.coalesce(cell("Company", "Organization", "Name"), F.try_element_at("values", F.lit(1)))
    return rows.filter("table_no = 0").select(
        *_member(
            F.trim(name), F.col("url"), F.coalesce(cell("Date", "Joined", "Fecha"), F.lit("")),
            kind, F.lit(""), F.lit(""),
        )
    ).filter("member_name <> ''")


def energy_members(rows: DataFrame) -> DataFrame:
    """Members of the renewable-power list layout: name head, join year, sector, headquarters."""
    at = lambda i: tx.collapse_ws(F.try_element_at("values", F.lit(i)))
    name = F.try_element_at("classes", F.lit("notranslate"))
    country = tx.country_to_iso2(at(-1), vocab.MEMBER_LIST_COUNTRY_TO_ISO2)
    members = rows.filter((F.col("table_no") == 0) & name.isNotNull()).select(
        *_member(
            tx.collapse_ws(name),
            F.coalesce(F.nullif(F.col("link"), F.lit("")), F.col("url")),
            dx.join_year(at(3)),
            "re100",
            country,
            at(6),
        ),
        F.col("url").alias("_page"),
        F.col("row_no").alias("_row"),
    )
    return _first_by_name(members.filter("member_name <> '' AND country <> ''"))


def compact_members(rows: DataFrame) -> DataFrame:
    """Members of the compact participants layout, whose cells carry class names."""
    by_class = lambda n: tx.collapse_ws(F.try_element_at("classes", F.lit(n)))
    members = rows.filter("table_no = 0 AND first_is_head").select(
        *_member(
            by_class("name"),
            F.coalesce(F.nullif(F.col("link"), F.lit("")), F.col("url")),
            dx.day_first_date(by_class("joined-on")),
            "ungc",
            tx.country_to_iso2(by_class("country"), vocab.MEMBER_LIST_COUNTRY_TO_ISO2),
            by_class("sector"),
        ),
        F.col("url").alias("_page"),
        F.col("row_no").alias("_row"),
    )
    return _first_by_name(members.filter("member_name <> '' AND country <> ''"))


def participant_rows(rows: DataFrame) -> DataFrame:
    """Rows of the participants grid by header name."""
    cell = lambda n: F.coalesce(F.try_element_at("cells", F.lit(n)), F.lit(""))
    return rows.filter("table_no = 0").select(
        cell("Name").alias("name"),
        cell("Type").alias("type"),
        cell("Sector").alias("sector"),
        cell("Country").alias("country"),
        cell("Joined On").alias("joined_on"),
        F.col("link").alias("participant_url"),
    )
