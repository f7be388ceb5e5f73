"""Section scan of line-ordered text reports (SRC-1, JOIN-2, AGG-5, FLT-1, FLT-2).

A section is the run of lines strictly between the first line containing a
header text and the first *later* line containing the footer text.  A header
without a footer (or no header) yields no section.

Two physical forms, same result:

* :func:`sections_in_text` - one row per whole report text.  One pass over its
  lines finds those that contain any header or the footer; each header's section
  is then a fold over these few lines: a narrow map, no shuffle.  Parallelism
  comes from the number of reports.
* :func:`sections_in_lines` - a landed line table ``(keys.., line_no, line)``
  for reports too large for one row.  Lines are dealt out once, by report and
  block of consecutive lines; header hits and footer lines are reduced to a row
  per block, and the section lines come from a join on (report, block), so a
  report with most of all lines is spread over its blocks.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import contains_text, split_lines
from ..rules import SECTION_FOOTER

# Lines of a block, the unit in which a report of the line table is dealt out.
BLOCK_LINES = 4096


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.get(F.transform(F.array(value), body), 0)


def header_hits(lines: Column, headers: Column | Sequence[str], footer: str) -> Column:
    """JOIN-2 / FLT-1 in one pass: the lines that contain any of the headers
    (texts, or a column of ``struct(p, t)`` arrays) or the footer, as
    ``struct(i, x)`` of line number and line, in order."""
    def hit(x: Column) -> Column:
        if isinstance(headers, Column):
            return contains_text(x, footer) | F.exists(headers, lambda h: contains_text(x, h["t"]))
        out = contains_text(x, footer)
        for h in headers:
            out = out | contains_text(x, h)
        return out

    found = F.transform(lines, lambda x, i: F.when(hit(x), F.struct(i.alias("i"), x.alias("x"))))
    return F.filter(found, lambda s: s.isNotNull())


def section_bounds(hits: Column, header: Column, footer: str) -> Column:
    """AGG-5 as a fold over the hits: ``struct(h, f)``, the number of the first
    line with the header and of the first later line with the footer (NULL when
    missing)."""
    def step(b: Column, s: Column) -> Column:
        h, f = b["h"], b["f"]
        return F.struct(
            F.when(h.isNull() & contains_text(s["x"], header), s["i"]).otherwise(h).alias("h"),
            F.when(h.isNotNull() & f.isNull() & contains_text(s["x"], footer), s["i"]).otherwise(f).alias("f"))

    none = F.lit(None).cast("int")
    return F.aggregate(hits, F.struct(none.alias("h"), none.alias("f")), step)


def _header_arrays(headers: DataFrame, header_keys: Sequence[str], header_col: str,
                   position_col: str) -> DataFrame:
    """A header table as one array per key: few rows, which the planner's size
    check lets a join broadcast."""
    if not header_keys:
        raise ValueError("a header table needs header_keys; pass a list of texts instead")
    return headers.groupBy(*header_keys).agg(F.array_sort(F.collect_list(
        F.struct(F.col(position_col).alias("p"), F.col(header_col).alias("t")))).alias("_hdrs"))


def _header_list(headers: Sequence[str]) -> Column:
    return F.array(*[F.struct(F.lit(i).alias("p"), F.lit(h).alias("t")) for i, h in enumerate(headers)])


def sections_in_text(reports: DataFrame, headers: DataFrame | Sequence[str],
                     text_col: str = "text", keys: Sequence[str] = (),
                     header_keys: Sequence[str] = (), footer: str = SECTION_FOOTER,
                     header_col: str = "data_set", position_col: str = "position",
                     keep_status: bool = False) -> DataFrame:
    """Lines of every section, one output row per line.

    ``reports`` has one row per report with ``text_col``; ``keys`` identify a
    report.  ``headers`` is a list of header texts or a small DataFrame with
    ``header_col``/``position_col`` plus ``header_keys`` shared with
    ``reports`` (e.g. ``source_id``: each report kind has its own headers).
    Output: ``keys + [position, header_col, line_no, line]`` with ``line_no``
    the 0-based line index in the report.

    With ``keep_status=True`` the output is one row per (report, header) with
    ``header_line``/``footer_line`` (NULL when missing) and the section's line
    array (NULL when the section is incomplete).

    No filter is placed on the derived bounds: a pushed-down filter would
    search again, so missing sections simply explode to no rows.
    """
    out_keys = list(keys) + [k for k in header_keys if k not in keys]
    base = reports.select(*out_keys, split_lines(text_col).alias("_lines"))
    if isinstance(headers, DataFrame):
        base = base.join(_header_arrays(headers, header_keys, header_col, position_col), list(header_keys), "inner")
        hits = header_hits(F.col("_lines"), F.col("_hdrs"), footer)
    else:
        base = base.withColumn("_hdrs", _header_list(headers))
        hits = header_hits(F.col("_lines"), list(headers), footer)

    def section(hd: Column) -> Column:
        return _let(section_bounds(F.col("_hits"), hd["t"], footer), lambda b: F.struct(
            hd["p"].alias(position_col), hd["t"].alias(header_col),
            b["h"].alias("header_line"), b["f"].alias("footer_line"),
            F.when(b["f"].isNotNull(), F.slice("_lines", b["h"] + 2, b["f"] - b["h"] - 1)).alias("section_lines")))

    per = base.withColumn("_hits", hits).select(*out_keys, F.inline(F.transform("_hdrs", section)))
    if keep_status:
        return per
    return (per.select(*out_keys, position_col, header_col, "header_line",
                       F.posexplode("section_lines").alias("_pos", "line"))
            .select(*out_keys, position_col, header_col,
                    (F.col("header_line") + 1 + F.col("_pos")).cast("bigint").alias("line_no"),
                    "line"))


def report_lines(reports: DataFrame, text_col: str = "text",
                 keys: Sequence[str] = ()) -> DataFrame:
    """SRC-1 landing step: whole text -> ``(keys.., line_no, line)``; narrow."""
    return reports.select(*keys, F.posexplode(split_lines(text_col)).alias("line_no", "line")) \
        .withColumn("line_no", F.col("line_no").cast("bigint"))


def sections_in_lines(lines: DataFrame, headers: DataFrame | Sequence[str], keys: Sequence[str],
                      header_keys: Sequence[str] = (), footer: str = SECTION_FOOTER,
                      header_col: str = "data_set", position_col: str = "position",
                      block_lines: int = BLOCK_LINES) -> DataFrame:
    """Same result as :func:`sections_in_text` over a line table.

    ``lines``: ``keys + [line_no, line]`` (``header_keys`` among ``keys``);
    ``headers`` as there.  Lines without a key or number are in no section.

    The lines are shuffled once, by report and block of ``block_lines`` lines,
    and everything that touches a line works on that: a report with most of
    all lines is as many groups as it has blocks.
    """
    keys = list(keys)
    spot = [*keys, "_block"]
    block = F.floor(F.col("line_no") / block_lines)
    present = [F.col(c).isNotNull() for c in [*spot, "line_no"]]
    dealt = lines.select(*keys, F.col("line_no").cast("bigint").alias("line_no"), "line", block.alias("_block"))
    for p in present:
        dealt = dealt.where(p)
    dealt = dealt.repartition(*spot)

    # JOIN-2: which headers each line contains, and whether the footer: a narrow
    # filter of a short array.
    if isinstance(headers, DataFrame):
        with_hdrs = dealt.join(_header_arrays(headers, header_keys, header_col, position_col),
                               list(header_keys), "inner")
    else:
        with_hdrs = dealt.withColumn("_hdrs", _header_list(headers))
    marks = F.concat(F.transform("_hdrs", lambda h: F.struct(h["p"].alias("p"), h["t"].alias("t"), F.lit(False).alias("_foot"))),
                     F.array(F.struct(F.lit(None).alias("p"), F.lit(footer).alias("t"), F.lit(True).alias("_foot"))))
    hits = with_hdrs.select(*spot, "line_no", F.inline(F.filter(marks, lambda h: contains_text("line", h["t"]))))

    # AGG-5: the first header line, and the first footer line after it: in the
    # same block, else the first one of a later block.  Both are a running
    # minimum from the end, in which a line's (a block's) headers come before its
    # footer; the second one gets a row per block and header.
    def later(keys: Sequence[str], order: str, line: str) -> Column:
        behind = Window.partitionBy(*keys).orderBy(F.col(order).desc(), "_foot").rowsBetween(Window.unboundedPreceding, -1)
        return F.min(F.when(F.col("_foot"), F.col(line))).over(behind)

    firsts = (hits.withColumn("_after", later(spot, "line_no", "line_no")).groupBy(*spot, "_foot", "p", "t")
              .agg(F.min(F.struct(F.col("line_no").alias("_h"), "_after")).alias("_m")).select(*spot, "_foot", "p", "t", "_m.*"))
    bounds = (firsts.withColumn("_end", F.coalesce("_after", later(keys, "_block", "_h"))).where("not _foot")
              .groupBy(*keys, "p", "t").agg(F.min(F.struct("_h", "_end")).alias("_m")).select(*keys, "p", "t", "_m.*"))

    # FLT-2: the lines in between, joined block by block.  The planner sizes both
    # sides by the files that the lines are derived from, often a fraction, so it
    # is told to merge: it would send all lines of many small reports by the driver.
    spans = bounds.where(F.col("_end") - F.col("_h") > 1).select(
        *keys, "p", "t", "_h", "_end",
        F.explode(F.sequence(F.floor((F.col("_h") + 1) / block_lines),
                             F.floor((F.col("_end") - 1) / block_lines))).alias("_block")).hint("merge")
    body = dealt.join(spans, spot).where((F.col("line_no") > F.col("_h")) & (F.col("line_no") < F.col("_end")))
    return body.select(*keys, F.col("p").alias(position_col), F.col("t").alias(header_col), "line_no", "line")
