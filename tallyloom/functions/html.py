"""HTML functions H1-H3 for newsletter bodies."""

from __future__ import annotations

import html as _html
import sys
from html.parser import HTMLParser

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from tallyloom.functions.text import BLANKS

# --- Fixed values -----------------------------------------------------------
PLACEHOLDERS = [r"\{\{.*?\}\}", r"\[\[.*?\]\]", r"<mj-raw>.*?</mj-raw>"]
VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
# ----------------------------------------------------------------------------


def strip_placeholders(col: Column, patterns: list[str] | None = None) -> Column:
    """H1: every pattern removed, across line breaks; null gives empty text."""
    out = col
    for pattern in PLACEHOLDERS if patterns is None else patterns:
        out = F.regexp_replace(out, f"(?s){pattern}", "")
    return F.coalesce(out, F.lit(""))


def strip_placeholders_by(col: Column, company: Column, patterns: dict[str, list[str]], default: str = "it") -> Column:
    """H1 with one pattern set per company; unknown companies use ``default``."""
    out = strip_placeholders(col, patterns.get(default, []))
    for code in sorted(set(patterns) - {default}):
        out = F.when(company == code, strip_placeholders(col, patterns[code])).otherwise(out)
    return out


def squeeze_whitespace(col: Column) -> Column:
    """H2: blanks between tags out, runs of spaces to one, trimmed."""
    between = F.regexp_replace(col, f">[{BLANKS}]+<", "><")
    return F.regexp_replace(F.regexp_replace(between, r" +", " "), f"^[{BLANKS}]+|[{BLANKS}]+$", "")


def body_of(col: Column) -> Column:
    """H3: the ``<body>`` element, or the whole text when there is none."""
    body = F.regexp_extract(col, r"(?is)<body\b.*?</body\s*>", 0)
    return F.when(body != "", body).otherwise(col)


# Workers get the helper with the task, so the package need not be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


class _Balancer(HTMLParser):
    """Re-emits markup with every element closed and stray end tags dropped."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=False)
        self.out: list[str] = []
        self.open: list[str] = []

    def _emit(self, tag: str, attrs: list, end: str) -> None:
        text = "".join(f' {k}="{_html.escape(v or "", quote=True)}"' for k, v in attrs)
        self.out.append(f"<{tag}{text}{end}")

    def handle_starttag(self, tag, attrs):
        if tag in VOID_TAGS:
            self._emit(tag, attrs, "/>")
        else:
            self._emit(tag, attrs, ">")
            self.open.append(tag)

    def handle_startendtag(self, tag, attrs):
        self._emit(tag, attrs, "/>")

    def handle_endtag(self, tag):
        if tag in self.open:
            while True:
                last = self.open.pop()
                self.out.append(f"</{last}>")
                if last == tag:
                    break

    def handle_data(self, data):
        self.out.append(data)

    def handle_entityref(self, name):
        self.out.append(f"&{name};")

    def handle_charref(self, name):
        self.out.append(f"&#{name};")

    def handle_comment(self, data):
        self.out.append(f"<!--{data}-->")

    def handle_decl(self, decl):
        self.out.append(f"<!{decl}>")

    def handle_pi(self, data):
        self.out.append(f"<?{data}>")

    def unknown_decl(self, data):
        self.out.append(f"<![{data}]>")


def balance_markup(text: str | None) -> str | None:
    """One document with open elements closed; the small per-row helper behind :func:`repair_markup`."""
    if text is None:
        return None
    parser = _Balancer()
    parser.feed(text)
    parser.close()
    return "".join(parser.out) + "".join(f"</{tag}>" for tag in reversed(parser.open))


@F.pandas_udf(StringType())
def repair_markup(docs: pd.Series) -> pd.Series:
    """H3: structure repair, Arrow-batched; the only Python in the row path."""
    return docs.map(balance_markup)
