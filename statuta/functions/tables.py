"""Markdown tables in texts, and from rows of cells."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from statuta.functions.text import strip


def row_cells(line: Column) -> Column:
    """Cells of a pipe row, else null."""
    s = strip(line)
    inner = F.substring(s, F.lit(2), F.char_length(s) - 2)
    return F.when((F.char_length(s) >= 3) & s.startswith("|") & s.endswith("|"), F.transform(F.split(inner, r"\|", -1), strip))


def is_rule(cells: Column) -> Column:
    """Whether cells are the rule under a header: dashes and colons only."""
    full = F.filter(cells, lambda c: c != "")
    return (F.size(full) > 0) & F.forall(full, lambda c: c.rlike("^[-:]+$"))


def tables(text: Column) -> Column:
    """array<array<array<string>>>: runs of pipe rows, without rules, of at least two rows and two columns."""
    kinds = F.transform(F.split(text, r"\r\n|[\n\r\x0B\x0C\x1C-\x1E\x85  ]"), row_cells)
    empty = F.array().cast("array<array<string>>")
    begin = F.struct(empty.alias("run"), F.array().cast("array<array<array<string>>>").alias("done"))

    def close(acc: Column) -> Column:
        wide = (F.size(acc["run"]) >= 2) & F.exists(acc["run"], lambda r: F.size(r) >= 2)
        return F.when(wide, F.concat(acc["done"], F.array(acc["run"]))).otherwise(acc["done"])

    def step(acc: Column, cells: Column) -> Column:
        return (
            F.when(cells.isNull(), F.struct(empty.alias("run"), close(acc).alias("done")))
            .when(is_rule(cells), acc)
            .otherwise(F.struct(F.concat(acc["run"], F.array(cells)).alias("run"), acc["done"].alias("done")))
        )

    none = F.array().cast("array<array<array<string>>>")
    return F.when(text.contains("|"), F.aggregate(kinds, begin, step, close)).otherwise(none)


def tables_json(text: Column, given: Column | None = None) -> Column:
    """JSON of a text's tables, or null without any; what is given wins."""
    t = tables(text)
    made = F.when(F.size(t) > 0, F.to_json(t))
    return made if given is None else F.coalesce(given, made)


def to_markdown(rows: Column) -> Column:
    """A markdown table from an array of rows of cells: nulls empty, line ends blank, short rows filled up."""
    width = F.array_max(F.transform(rows, lambda r: F.size(r)))
    clean = lambda c: F.trim(F.replace(F.coalesce(c, F.lit("")), F.lit("\n"), F.lit(" ")))
    line = lambda cells: F.concat(F.lit("| "), F.array_join(cells, " | "), F.lit(" |"))
    full = F.transform(rows, lambda r: line(F.concat(F.transform(r, clean), F.array_repeat(F.lit(""), width - F.size(r)))))
    rule = line(F.array_repeat(F.lit("---"), width))
    return F.when(F.size(rows) > 0, F.array_join(F.concat(F.slice(full, 1, 1), F.array(rule), F.slice(full, 2, F.size(full))), "\n")).otherwise("")


def table_lines(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """A row for each pipe row of a text: id, line_no, n_cells, is_rule."""
    lines = docs.select(F.col(id_col), F.posexplode(F.split(text_col, "\n")).alias("line_no", "line"))
    cells = lines.withColumn("cells", row_cells(F.col("line"))).where(F.col("cells").isNotNull())
    return cells.select(id_col, "line_no", F.size("cells").alias("n_cells"), is_rule(F.col("cells")).alias("is_rule"))
