"""Main texts of web pages, by wrappers that are inferred for each host."""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tableflow.llm.common import ids_column, prepare
from tableflow.llm.wrapper import extract, infer, merge, page_id, parse, rules
from tableflow.session import materialise

SALTS = 32
HELD_CHARS = 1 << 24

_PAGE = "host string, page long, items string"
_PART = "host string, salt int, pages long, items string"


def _merged(rows: pd.DataFrame) -> tuple[int, list]:
    total, items = 0, None
    for pages, text in sorted(zip(rows["pages"], rows["items"], strict=True)):
        total += pages
        items = json.loads(text) if items is None else merge(items, json.loads(text))
    return total, items


def wrappers(pages: DataFrame) -> DataFrame:
    """``host``, ``pages`` (distinct ones) and ``verdicts`` (JSON) from all pages of each host (columns host and html).

    Copies of a page are merged first, in the task that reads them and then where all rows of that
    page meet, so that each counts once. There the pages of a host that a task holds become one
    expression; those are merged in two steps, so that a host with a third of all pages is a few
    rows for each task.
    """
    prepare(pages.sparkSession)

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[tuple[str, int], str] = {}
        chars = 0

        def rows() -> pd.DataFrame:
            return pd.DataFrame([(*key, text) for key, text in held.items()], columns=["host", "page", "items"])

        for batch in batches:
            for host, page in zip(batch["host"], batch["html"], strict=True):
                kids = parse(page)
                key, text = (host, page_id(kids)), json.dumps(infer(kids))
                known = held.get(key)
                if known != text:
                    held[key] = text if known is None else json.dumps(merge(json.loads(known), json.loads(text), one_page=True))
                    chars += len(held[key]) - len(known or "")
                if chars > HELD_CHARS:
                    yield rows()
                    held.clear()
                    chars = 0
        if held:
            yield rows()

    def unite(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        salt = TaskContext.get().partitionId() % SALTS
        of = at = copies = items = None  # the host, its last page, that page's copies and the pages before it
        count = 0

        def row() -> pd.DataFrame:
            whole = copies if items is None else merge(items, copies)
            return pd.DataFrame([(of, salt, count, json.dumps(whole))], columns=["host", "salt", "pages", "items"])

        for batch in batches:
            for host, page, text in zip(batch["host"], batch["page"], batch["items"], strict=True):
                found = json.loads(text)
                if host == of and page == at:
                    copies = merge(copies, found, one_page=True)
                    continue
                if host == of:
                    items = copies if items is None else merge(items, copies)
                else:
                    if count:
                        yield row()
                    items, count = None, 0
                of, at, copies, count = host, page, found, count + 1
        if count:
            yield row()

    def join(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        total, items = _merged(rows)
        return pd.DataFrame([(key[0], key[1], total, json.dumps(items))], columns=["host", "salt", "pages", "items"])

    def judge(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        total, items = _merged(rows)
        return pd.DataFrame([(key[0], total, json.dumps(rules(items, total)))], columns=["host", "pages", "verdicts"])

    each = pages.select("host", "html").mapInPandas(read, _PAGE).repartition("host", "page").sortWithinPartitions("host", "page", "items")
    return (each.mapInPandas(unite, _PART).groupBy("host", "salt").applyInPandas(join, _PART)
            .groupBy("host").applyInPandas(judge, "host string, pages long, verdicts string"))


@lru_cache(maxsize=256)
def _verdicts(text: str) -> list:
    return json.loads(text)


def main_texts(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """page_id, url, text and n_chars (code points) of each page; blocks of the main text are lines.

    Null html counts as empty and gives an empty text. Pages without a host in their URL share one
    wrapper. Every row is read whole and gives one row; repeated rows count each; nulls in the id
    and the URL stay.
    """
    prepare(pages.sparkSession)
    host = F.lower(F.coalesce(F.regexp_extract(F.col(f"`{url_col}`"), "^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1), F.lit("")))
    rows = pages.select(F.col(f"`{id_col}`").cast("long").alias("page_id"), F.col(f"`{url_col}`").alias("url"),
                        F.coalesce(F.col(f"`{html_col}`"), F.lit("")).alias("html"), host.alias("host"))
    known = materialise(wrappers(rows).select(F.col("host").alias("of"), "verdicts"), "wrappers")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [extract(parse(page), _verdicts(v)) for page, v in zip(batch["html"], batch["verdicts"], strict=True)]
            yield pd.DataFrame({"page_id": ids_column(batch["page_id"]), "url": batch["url"], "text": found, "n_chars": [len(t) for t in found]})

    return rows.join(known, rows.host == known.of).select("page_id", "url", "html", "verdicts").mapInPandas(
        run, "page_id long, url string, text string, n_chars long")
