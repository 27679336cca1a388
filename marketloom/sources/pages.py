"""Captured web pages: a Python data source for folders of HTML, and the parsers of its pages.

A page is parsed once into a small tree; fundamentals come out as long rows (one per symbol,
table, period and metric), stories and company lists as plain rows.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator
from html.parser import HTMLParser
from urllib.parse import urljoin

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from marketloom.functions.fundamentals import MONTHS, TABLE_METRICS, metric_name, norm_label
from marketloom.functions.market import figure
from marketloom.operators.articles import collapsed

# The sections of a company page, the place of a table in its section, and its name.
SECTIONS = (
    ("quarters", 0, "quarterly_results"),
    ("profit-loss", 0, "profit_loss"),
    ("balance-sheet", 0, "balance_sheet"),
    ("cash-flow", 0, "cash_flow"),
    ("ratios", 0, "ratios"),
    ("shareholding", 0, "shareholding_quarterly"),
    ("shareholding", 1, "shareholding_yearly"),
)
# The tables of which a page must have one.
CORE = ("quarterly_results", "profit_loss", "balance_sheet", "cash_flow", "ratios")
PERIOD = re.compile(rf"(?:(?:{'|'.join(MONTHS)})\s+\d{{4}}|TTM)")
_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}


class Node:
    __slots__ = ("tag", "attrs", "children", "up")

    def __init__(self, tag: str, attrs: dict[str, str], up: Node | None):
        self.tag, self.attrs, self.children, self.up = tag, attrs, [], up

    def walk(self) -> Iterator[Node]:
        for c in self.children:
            if isinstance(c, Node):
                yield c
                yield from c.walk()

    def find(self, tag: str | tuple[str, ...] = "", cls: str = "", id_: str = "") -> list[Node]:
        tags = (tag,) if isinstance(tag, str) else tag
        return [n for n in self.walk() if (not tag or n.tag in tags) and (not cls or cls in n.attrs.get("class", "").split()) and (not id_ or n.attrs.get("id") == id_)]

    def text(self) -> str:
        return "".join(c if isinstance(c, str) else c.text() for c in self.children).strip()


class _Builder(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = self.at = Node("", {}, None)

    def handle_starttag(self, tag, attrs):
        # cells and rows end where the next one begins
        ends = {"td": ("td", "th"), "th": ("td", "th"), "tr": ("tr",), "li": ("li",), "p": ("p",)}.get(tag, ())
        n = self.at
        while n.up is not None and ends and n.tag not in ("table", "ul", "section"):
            if n.tag in ends:
                self.at = n.up
                break
            n = n.up
        node = Node(tag, {k: v or "" for k, v in attrs}, self.at)
        self.at.children.append(node)
        if tag not in _VOID:
            self.at = node

    def handle_endtag(self, tag):
        n = self.at
        while n.up is not None and n.tag != tag:
            n = n.up
        if n.up is not None:
            self.at = n.up

    def handle_data(self, data):
        self.at.children.append(data)


def parse(html: str | None) -> Node:
    b = _Builder()
    b.feed(html or "")
    b.close()
    return b.root


def fundamentals_rows(html: str | None) -> list[tuple[str, str, str, str]]:
    """(table_name, financial_period, label, text) of a company page.

    Cells belong to the header above them, so a column that is no period doesn't shift the others.
    """
    out = []
    sections = {n.attrs.get("id", ""): n for n in parse(html).find("section")}
    for section, place, name in SECTIONS:
        tables = sections[section].find("table") if section in sections else []
        if len(tables) <= place:
            continue
        rows = [[c.text() for c in r.children if isinstance(c, Node) and c.tag in ("td", "th")] for r in tables[place].find("tr")]
        rows = [r for r in rows if r]
        if not rows:
            continue
        at = [(i, h) for i, h in enumerate(rows[0]) if i and PERIOD.fullmatch(h)]
        for r in rows[1:]:
            if r[0].strip() and r[0].strip().lower() != "raw pdf":
                out += [(name, h, r[0], r[i] if i < len(r) else "") for i, h in at]
    return out


def story_rows(html: str | None, base: str) -> list[tuple[str, str, str, str]]:
    """(heading, content, url, date) of a news page; stories without a link take the page's own address."""
    out = []
    for s in parse(html).find("div", cls="eachStory"):
        heading = next((n.text() for n in s.find("h3")), "")
        kind = next((n.text() for n in s.find(cls="secCategory")), "").lower()
        if not heading or kind not in ("", "news"):
            continue
        href = next((n.attrs["href"] for n in s.find("a") if n.attrs.get("href")), "")
        url = urljoin(base, href) if href else base
        if "bseindia" in url and "articleshow" not in url:
            continue
        when = next((n.text() for n in s.find("time")), "") or next((n.text() for n in s.find(cls="storyDate")), "")
        out.append((heading, next((n.text() for n in s.find("p")), ""), url, when))
    return out


def company_rows(html: str | None, base: str) -> list[tuple[str, str, str]]:
    """(company_id, company_name, stocks_url) of an index page, each link once."""
    seen, out = set(), []
    for n in parse(html).find("a"):
        m = re.search(r"/stocks/companyid-(\d+)", n.attrs.get("href", ""))
        if m and n.attrs["href"] not in seen:
            seen.add(n.attrs["href"])
            out.append((m[1], re.sub(r"\s*Share Price$", "", re.sub(r"\s+", " ", n.text())), urljoin(base, n.attrs["href"])))
    return out


def _mapped(pages: DataFrame, keep: list[str], schema: str, rows) -> DataFrame:
    def run(batches):
        for pdf in batches:
            out = [(*(r[c] for c in keep), *x) for r in pdf.to_dict("records") for x in rows(r)]
            yield pd.DataFrame(out, columns=names)

    kept = ", ".join(f"`{c}` {pages.schema[c].dataType.simpleString()}" for c in keep)
    names = [*keep, *(p.split()[0] for p in schema.split(", "))]
    return pages.mapInPandas(run, f"{kept}, {schema}")


def fundamentals(pages: DataFrame, modes: bool = True) -> DataFrame:
    """(symbol, table_name, financial_period, metric, value) of pages (symbol, consolidated, html).

    A consolidated page without any core table gives way to the standalone one; symbols without
    either don't come out. Pages are parsed once for all tables.
    """
    raw = _mapped(pages.select("symbol", "consolidated", "html"), ["symbol", "consolidated"], "table_name string, financial_period string, label string, text string", lambda r: fundamentals_rows(r["html"]))
    best = raw.where(F.col("table_name").isin(*CORE)).groupBy("symbol").agg(F.max("consolidated").alias("consolidated"))
    chosen = raw.join(best, ["symbol", "consolidated"])
    return chosen.where(norm_label(F.col("label")) != "").select(F.upper(F.trim("symbol")).alias("symbol"), "table_name", "financial_period", metric_name(F.col("label")).alias("metric"), figure(F.col("text")).alias("value"))


def fundamentals_table(long: DataFrame, name: str, metrics: tuple[str, ...] | None = None) -> DataFrame:
    """One wide table: a row per symbol and period, a column per metric, by default those of the table's layout."""
    return long.where(F.col("table_name") == name).groupBy("symbol", "financial_period").pivot("metric", list(metrics or TABLE_METRICS[name])).agg(F.max("value"))


def available(pages: DataFrame) -> DataFrame:
    """Pages (status, final_url, html, ...) that hold a company: answered, found, and not led away from it."""
    text = F.lower(F.coalesce("html", F.lit("")))
    found = ~(F.contains(text, F.lit("page not found")) | F.contains(text, F.lit("could not find")))
    return pages.where((F.col("status") == 200) & found & F.contains(F.lower("final_url"), F.lit("/company/")))


def stories(pages: DataFrame) -> DataFrame:
    """(url, heading, content, date, companies) of pages (page_url, company_name, html): a story once, with all its companies.

    Of differing texts the last in the order of arrival counts: by ``page_no``, where pages carry
    it, then by the place on the page.
    """
    if "page_no" not in pages.columns:
        pages = pages.withColumn("page_no", F.lit(0))
    numbered = lambda r: [(*x, i) for i, x in enumerate(story_rows(r["html"], r["page_url"]))]
    raw = _mapped(pages.select("page_no", "page_url", "company_name", "html"), ["page_no", "page_url", "company_name"], "heading string, content string, url string, date string, place int", numbered)
    return collapsed(raw.withColumnRenamed("company_name", "company").withColumn("_seq", F.struct("page_no", "page_url", "place")), "_seq")


def companies(pages: DataFrame) -> DataFrame:
    """Companies of index pages (page_no, page_url, html), the first page's entry for each id."""
    raw = _mapped(pages.select("page_no", "page_url", "html"), ["page_no"], "company_id string, company_name string, stocks_url string", lambda r: company_rows(r["html"], r["page_url"]))
    rn = F.row_number().over(Window.partitionBy("company_id").orderBy("page_no", "stocks_url"))
    return raw.withColumn("_rn", rn).where("_rn = 1").drop("_rn", "page_no")


class CapturedPages(DataSource):
    """``spark.read.format("captured_pages").load(folder)``: (name, html); up to FILES_A_TASK files to a partition."""

    @classmethod
    def name(cls) -> str:
        return "captured_pages"

    def schema(self) -> str:
        return "name string, html string"

    def reader(self, schema) -> DataSourceReader:
        return _Reader(self.options["path"])


#: Files that one task reads.
FILES_A_TASK = 64


class _Files(InputPartition):
    def __init__(self, paths: list[str]):
        self.paths = paths


class _Reader(DataSourceReader):
    def __init__(self, folder: str):
        self.folder = folder

    def partitions(self) -> list[InputPartition]:
        names = [os.path.join(self.folder, f) for f in sorted(os.listdir(self.folder)) if f.endswith((".html", ".htm"))]
        return [_Files(names[i : i + FILES_A_TASK]) for i in range(0, len(names), FILES_A_TASK)]

    def read(self, partition: _Files):
        for path in partition.paths:
            with open(path, encoding="utf-8", errors="replace") as f:
                yield os.path.basename(path), f.read()
