"""Main text of web pages by differencing pages of neighbouring urls.

Pages of one host in order of their url path are likely to share a template.
Each page's lines (blocks of text) are aligned with those of the nearest page
before and behind that is no copy of it by longest common subsequence, and lines that are shared
go: they are the template's.  What the markup itself sets apart counts beside
it: menus, adverts and the like are no text of the article even where each
page has other ones, and lines inside an article element are the article's
even where a mirror page has them too.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tessera.llm.common import python_tasks, materialize, small_side
from tessera.llm.html_blocks import blocks
from tessera.llm.url_filter import url_parts

#: Pages that one task compares in a row.
RUN = 512
#: Two pages that both share this much of their text are copies of one article, and say nothing on the template.
COPY = 0.8


def common_lines(a: list, b: list) -> tuple[np.ndarray, np.ndarray]:
    """Which lines of ``a`` and of ``b`` are on a longest common subsequence."""
    in_a, in_b = np.zeros(len(a), bool), np.zeros(len(b), bool)
    head, tail = 0, 0
    while head < min(len(a), len(b)) and a[head] == b[head]:
        head += 1
    while tail < min(len(a), len(b)) - head and a[-1 - tail] == b[-1 - tail]:
        tail += 1
    in_a[:head] = in_b[:head] = True
    in_a[len(a) - tail:] = in_b[len(b) - tail:] = True
    # only lines that both have can be aligned
    both = set(a[head:len(a) - tail]) & set(b[head:len(b) - tail])
    ia = [k for k in range(head, len(a) - tail) if a[k] in both]
    ib = [k for k in range(head, len(b) - tail) if b[k] in both]
    todo = [(ia, ib)]
    while todo:  # halved until the table of a part is small
        x, y = todo.pop()
        if not x or not y:
            continue
        if len(x) == 1:
            for k in y:
                if a[x[0]] == b[k]:
                    in_a[x[0]] = in_b[k] = True
                    break
            continue
        if len(x) * len(y) <= 4_000_000:
            lengths = np.zeros((len(x) + 1, len(y) + 1), np.int32)
            number = {s: k for k, s in enumerate(both)}
            cx, cy = np.array([number[a[k]] for k in x]), np.array([number[b[k]] for k in y])
            for k in range(len(x) - 1, -1, -1):
                row = np.where(cy == cx[k], lengths[k + 1, 1:] + 1, lengths[k + 1, :-1])
                lengths[k, :-1] = np.maximum.accumulate(row[::-1])[::-1]
            k = t = 0
            while k < len(x) and t < len(y):
                if cx[k] == cy[t] and lengths[k, t] == lengths[k + 1, t + 1] + 1:
                    in_a[x[k]] = in_b[y[t]] = True
                    k, t = k + 1, t + 1
                elif lengths[k + 1, t] >= lengths[k, t + 1]:
                    k += 1
                else:
                    t += 1
            continue
        half = len(x) // 2
        left = _row([a[k] for k in x[:half]], [b[k] for k in y])
        right = _row([a[k] for k in x[half:]][::-1], [b[k] for k in y][::-1])[::-1]
        cut = int(np.argmax(left + right))
        todo += [(x[:half], y[:cut]), (x[half:], y[cut:])]
    return in_a, in_b


def _row(a: list, b: list) -> np.ndarray:
    """Lengths of the common subsequences of ``a`` and every head of ``b``."""
    number = {s: k for k, s in enumerate(set(a) | set(b))}
    cb = np.array([number[s] for s in b])
    last = np.zeros(len(b) + 1, np.int32)
    for s in a:
        row = np.where(cb == number[s], last[:-1] + 1, last[1:])
        last = np.concatenate([[0], np.maximum.accumulate(row)])
    return last


def main_text(lines: list[tuple[str, str]], shared) -> str:
    """What is left when lines of menus and the like, and shared lines outside
    an article element, are gone.  A page with an article element has no main
    text outside it."""
    has_main = any(z == "main" for z, _ in lines)
    return "\n".join(t for (z, t), s in zip(lines, shared, strict=True) if z == "main" or (not has_main and z == "" and not s))


def _copies(sizes: tuple[np.ndarray, ...], shared: tuple[np.ndarray, ...]) -> bool:
    """Whether both pages share most of their text outside menus and the like."""
    return all(n.sum() and n[s].sum() >= COPY * n.sum() for n, s in zip(sizes, shared, strict=True))


def page_lines(pages: DataFrame, id_col: str, url_col: str, html_col: str) -> DataFrame:
    """``id, url, page`` (a hash of the html), ``hashes`` of the page's lines
    and their ``sizes``, 0 in menus and the like."""

    @F.pandas_udf("hashes array<long>, sizes array<int>")
    def of(pages: pd.Series) -> pd.DataFrame:
        import xxhash

        lines = [blocks(p or "") for p in pages]
        return pd.DataFrame({
            "hashes": [np.array([xxhash.xxh64_intdigest(t) for _, t in x], np.uint64).view(np.int64) for x in lines],
            "sizes": [np.array([0 if z == "chrome" else len(t) for z, t in x], np.int32) for x in lines]})

    return (pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"),
                         F.xxhash64(F.col(html_col)).alias("page"), of(F.col(html_col)).alias("x"))
            .select("id", "url", "page", "x.*"))


def url_order(lines: DataFrame) -> DataFrame:
    """``lines`` with ``host`` and ``place``, the row's place in the order of
    host, path and id.  Rows are range-partitioned, so a hot host is spread; a
    partition starts behind the rows of those before it (the only window, with
    a row per partition)."""
    host, path = url_parts(F.col("url"))
    order = ["host", "path", "id", "url", "page"]
    keyed = (lines.withColumns({"host": host, "path": path}).repartitionByRange(*order).sortWithinPartitions(*order)
             .drop("path").withColumn("m", F.monotonically_increasing_id()))
    keyed = materialize(keyed, "html_order").withColumn("part", F.shiftright("m", 33))
    rows = keyed.groupBy("part").agg(F.count(F.lit(1)).alias("rows"))
    before = rows.select("part", (F.sum("rows").over(Window.orderBy("part")) - F.col("rows")).alias("before"))
    return (keyed.join(F.broadcast(before), "part")
            .withColumn("place", F.col("before") + F.col("m").bitwiseAND(F.lit((1 << 33) - 1)))
            .drop("part", "before", "m"))


def _parts(a: dict, b: dict) -> bool:
    """Whether ``b``, the page behind ``a``, is of another host or no copy of it."""
    if a["host"] != b["host"]:
        return True
    return not _copies((a["sizes"], b["sizes"]), common_lines(a["hashes"].tolist(), b["hashes"].tolist()))


def _pages(pdf: pd.DataFrame) -> list[dict]:
    """Rows in order of place; a page that is needed twice comes once."""
    return pdf.sort_values("place").drop_duplicates("place").to_dict("records")


def shared_lines(ordered: DataFrame) -> DataFrame:
    """``id, url, page, shared``: for each line, whether the nearest page before
    or behind on the same host that is no copy has it aligned.

    Copies in a row are a group, and all its pages are compared with the page
    before the group and the page behind it.  Groups may be longer than a run,
    so a first pass finds each run's first and last place where a group starts,
    which tells every run the pages that it needs from outside.
    """
    run, within = F.floor(F.col("place") / RUN), F.col("place") % RUN
    table = ordered.withColumn("run", run)
    near = ordered.withColumn("run", F.explode(F.filter(F.array(run, F.when(within == RUN - 1, run + 1)), lambda r: r.isNotNull())))

    def starts(pdf: pd.DataFrame) -> pd.DataFrame:
        pages, number = _pages(pdf), int(pdf["run"].iloc[0])
        own = [k for k, p in enumerate(pages) if p["place"] // RUN == number]
        starts_group = lambda k: k == 0 or _parts(pages[k - 1], pages[k])
        first = next((k for k in own if starts_group(k)), None)
        last = None if first is None else next(k for k in reversed(own) if k == first or starts_group(k))
        place = lambda k: None if k is None else pages[k]["place"]
        return pd.DataFrame({"run": [number], "first": [place(first)], "last": [place(last)]}).astype({"first": "Int64", "last": "Int64"})[:len(own)]

    # a row per run: the only window
    found = materialize(near.select("run", "host", "place", "hashes", "sizes").groupBy("run")
                        .applyInPandas(starts, "run long, first long, last long"), "html_starts")
    before = F.last("last", ignorenulls=True).over(Window.orderBy("run").rowsBetween(Window.unboundedPreceding, -1))
    behind = F.first("first", ignorenulls=True).over(Window.orderBy("run").rowsBetween(1, Window.unboundedFollowing))
    at_once = F.when(F.col("first") == F.col("run") * RUN, F.col("first"))
    needs = materialize(found.select(F.col("run").alias("to"), F.array(F.coalesce(at_once, before) - 1, behind).alias("ats"))
                        .select("to", F.explode("ats").alias("at")).where("at >= 0"), "html_needs")
    outside = ordered.join(small_side(needs), F.col("place") == F.col("at")).withColumn("run", F.col("to")).select(table.columns)

    def compare(pdf: pd.DataFrame) -> pd.DataFrame:
        pages, number = _pages(pdf), int(pdf["run"].iloc[0])
        own = [k for k, p in enumerate(pages) if p["place"] // RUN == number]
        if not own:
            return pd.DataFrame(columns=["id", "url", "page", "shared"])
        marks = [np.zeros(len(p["hashes"]), bool) for p in pages]
        # groups of own pages; the pages outside are the nearest that are no copies
        groups, pair = [[own[0]]], {}
        for k in own[1:]:
            pair[k] = common_lines(pages[k - 1]["hashes"].tolist(), pages[k]["hashes"].tolist()) if pages[k - 1]["host"] == pages[k]["host"] else None
            if pair[k] is not None and _copies((pages[k - 1]["sizes"], pages[k]["sizes"]), pair[k]):
                groups[-1].append(k)
            else:
                groups.append([k])
        for group in groups:
            for other in (group[0] - 1, group[-1] + 1):
                if not 0 <= other < len(pages) or pages[other]["host"] != pages[group[0]]["host"]:
                    continue
                known: dict[bytes, np.ndarray] = {}  # equal pages are compared once
                for k in group:
                    key = pages[k]["hashes"].tobytes()
                    if key not in known:
                        if other == k - 1 and k in pair:
                            known[key] = pair[k][1]
                        elif other == k + 1 and other in pair:
                            known[key] = pair[other][0]
                        else:
                            known[key] = common_lines(pages[k]["hashes"].tolist(), pages[other]["hashes"].tolist())[0]
                    marks[k] = marks[k] | known[key]
        return pd.DataFrame({"id": pd.Series([pages[k]["id"] for k in own], dtype=pdf["id"].dtype), "url": [pages[k]["url"] for k in own],
                             "page": [pages[k]["page"] for k in own],
                             "shared": pd.Series([marks[k].tolist() for k in own], dtype=object)})

    kind = table.schema["id"].dataType.simpleString()
    return (table.unionByName(outside).groupBy("run")
            .applyInPandas(compare, f"id {kind}, url string, page long, shared array<boolean>"))


def html_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per row of ``pages``: ``id_col, url, text, n_lines, n_shared``
    (lines of the page, and those that a neighbour shares).

    Null html counts as empty and gives an empty text.  Pages without a host
    are neighbours of one another.  Rows that repeat id, url and html are one
    page, and each gets its text.  Two pages that both share most of their text
    are copies, leave each other's lines alone and are both compared with the
    nearest pages that are none.  An empty table gives an empty result; other
    columns are not looked at.

    Only hashes of lines are put in order and compared: runs of ``RUN`` pages,
    each with the two pages outside that it needs, are a task's group.  The flags of
    shared lines are joined back to the pages.
    """
    python_tasks(pages.sparkSession, 256)
    lines = page_lines(pages, id_col, url_col, html_col).dropDuplicates(["id", "url", "page"])
    flags = materialize(shared_lines(url_order(lines)), "html_shared")

    @F.pandas_udf("text string, n_lines long, n_shared long")
    def of(pages: pd.Series, shared: pd.Series) -> pd.DataFrame:
        lines = [blocks(p or "") for p in pages]
        marks = [np.zeros(len(x), bool) if s is None else s for x, s in zip(lines, shared, strict=True)]
        return pd.DataFrame({"text": [main_text(x, s) for x, s in zip(lines, marks, strict=True)],
                             "n_lines": [len(x) for x in lines], "n_shared": [int(np.sum(s)) for s in marks]})

    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"),
                        F.xxhash64(F.col(html_col)).alias("page"))
    f = small_side(flags.select(F.col("id").alias("i"), F.col("url").alias("u"), F.col("page").alias("p"), "shared"), 100_000)
    on = F.col("id").eqNullSafe(F.col("i")) & F.col("url").eqNullSafe(F.col("u")) & (F.col("page") == F.col("p"))
    return (rows.join(f, on, "left").select("id", "url", of("html", "shared").alias("x"))
            .select(F.col("id").alias(id_col), F.col("url").alias(url_col), "x.*"))
