"""Reading order of pages from word boxes: the gutter between two columns, rows, bands."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

#: Points within which words share a row; share of words that may cross a gutter; words of a column; band of gutters.
ROW, CROSS, COLUMN, BAND = 3.0, 0.04, 8, (0.35, 0.65)
#: Share of words that each side needs, and that start at the gutter, within two points.
SIDE, START = 0.3, 0.04
#: Rows of two columns that make a page of bands.
ROWS = 3


def gutter(x0: np.ndarray, x1: np.ndarray, width: float) -> float:
    """The left edge of a word, near the middle, that fewest words cross (of equals the nearest to the middle); the middle unless it parts two columns."""
    middle, n = width / 2, len(x0)
    edges = np.unique(np.append(x0[(x0 >= BAND[0] * width) & (x0 <= BAND[1] * width)], middle))
    # words that begin before an edge, less those that end by it
    crossing = np.searchsorted(np.sort(x0), edges) - np.searchsorted(np.sort(x1), edges, side="right")
    best = edges[np.lexsort((np.abs(edges - middle), crossing))[0]]
    crossed = ((x0 < best) & (x1 > best)).sum()
    sides = min((x1 <= best).sum(), (x0 >= best).sum())
    parts = crossed <= CROSS * n and sides >= SIDE * n and (np.abs(x0 - best) <= 2).sum() >= START * n
    return float(best if parts else middle)


def rows(words: pd.DataFrame) -> list[pd.DataFrame]:
    """Words in visual rows from top to bottom, each from left to right; a row's first word sets its height."""
    w = words.assign(__k=(words["top"] / ROW).round()).sort_values(["__k", "x0"], kind="stable").drop(columns="__k")
    number, height, of = -1, None, []
    for top in w["top"]:
        if height is None or abs(top - height) > ROW:
            number, height = number + 1, top
        of.append(number)
    return [r.sort_values("x0", kind="stable") for _, r in w.groupby(np.array(of), sort=True)] if of else []


def _line(words: pd.DataFrame) -> str:
    return " ".join(words["text"])


def page_text(words: pd.DataFrame, width: float) -> str:
    """A page's text: left column before right where two are, banded where full rows part them, else row by row."""
    if words.empty:
        return ""
    x0, x1 = words["x0"].to_numpy(float), words["x1"].to_numpy(float)
    g = gutter(x0, x1, width)
    left, right = words[x1 <= g], words[x0 >= g]
    if ((x0 < g) & (x1 > g)).mean() < CROSS and min(len(left), len(right)) >= COLUMN:
        return "\n".join(_line(r) for side in (left, right) for r in rows(side))
    all_ = rows(words)
    spans = [bool(((r["x0"] < g) & (r["x1"] > g)).any()) for r in all_]
    if sum(not s and (r["x1"] <= g).any() and (r["x0"] >= g).any() for s, r in zip(spans, all_)) < ROWS:
        return "\n".join(map(_line, all_))
    # a band ends with each full row: order by band, then side, then row
    band, out = 0, []
    for k, (s, r) in enumerate(zip(spans, all_)):
        if s:
            out.append((band, 2, k, _line(r)))
            band += 1
        else:
            out += [(band, side, k, _line(part)) for side, part in ((0, r[r["x1"] <= g]), (1, r[r["x0"] >= g])) if len(part)]
    return "\n".join(x[3] for x in sorted(out))


def pages_from_words(words: DataFrame) -> DataFrame:
    """doc_id, page, raw_text from words (doc_id, page, width, text, x0, x1, top): a page is one group, whose size a page bounds."""
    kind = dict(words.dtypes)["doc_id"]

    def one(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame([(key[0], key[1], page_text(pdf, float(pdf["width"].iloc[0])))], columns=["doc_id", "page", "raw_text"])

    return words.groupBy("doc_id", "page").applyInPandas(one, f"doc_id {kind}, page int, raw_text string")
