"""Cutting source files down to the code a test ran.

Python only names the spans of definitions in one file; what is kept, the budgets and the rendering
are column expressions.
"""

from __future__ import annotations

import ast
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from runlens.functions.testnames import test_func_name
from runlens.operators.ordered import hash_chunk, running_sum
from runlens.session import reliable_checkpoint
from runlens.sources.documents import map_documents

# Fixed value: marker text.
CUT_MARK = "\n... [truncated]"

SPANS = "file_id string, spans array<struct<owner:int,first:int,last:int,kind:string>>, parsed boolean"
_DEFINITIONS = (ast.FunctionDef, ast.AsyncFunctionDef, ast.ClassDef)


def _spans(source: str) -> list[tuple[int, int, int, str]]:
    """(owner, first, last, kind) of top-level definitions, and of methods with their class as owner."""
    out = []
    for node in ast.parse(source).body:
        if not isinstance(node, _DEFINITIONS):
            continue
        is_class = isinstance(node, ast.ClassDef)
        out.append((-1, *_extent(node), "class" if is_class else "function"))
        if is_class:
            owner = len(out) - 1
            out += [(owner, *_extent(m), "method") for m in node.body if isinstance(m, _DEFINITIONS[:2])]
    return out


def _extent(node: ast.AST) -> tuple[int, int]:
    return min([node.lineno, *[d.lineno for d in node.decorator_list]]), node.end_lineno


def _name_spans(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        rows = []
        for file_id, content in zip(batch["file_id"], batch["content"]):
            try:
                rows.append((file_id, _spans(content), True))
            except (SyntaxError, ValueError):
                rows.append((file_id, [], False))
        yield pd.DataFrame(rows, columns=["file_id", "spans", "parsed"])


def definition_spans(files: DataFrame) -> DataFrame:
    """Definitions of each file `(file_id, content)`; `parsed` is false where the text is no Python."""
    return map_documents(files.select("file_id", "content"), _name_spans, SPANS)


def _chars(lines: Column, first: Column, last: Column) -> Column:
    """Characters of a line range, its line ends included."""
    part = F.slice(lines, first, F.greatest(last - first + 1, F.lit(0)))
    total = F.aggregate(part, F.lit(0), lambda acc, line: acc + F.length(line) + 1)
    return total - F.when(last >= F.size(lines), 1).otherwise(0)


def classified(files: DataFrame, executed: DataFrame, spans: DataFrame | None = None) -> DataFrame:
    """Each (sample, file) with its lines and the spans that may be dropped, in source order.

    `files(file_id, content)`, `executed(sample_id, file_id, lines)`. Droppable are functions and
    classes nothing ran in, and such methods of classes something ran in.
    """
    known = files.join(definition_spans(files) if spans is None else spans, "file_id")
    rows = executed.join(known, "file_id").withColumn("_lines", F.split("content", "\n"))

    def ran(span: Column) -> Column:
        return F.exists("lines", lambda line: line.between(span["first"], span["last"]))

    droppable = F.filter(
        "spans",
        lambda s: ~ran(s) & ((s["kind"] != "method") | ran(F.get(F.col("spans"), s["owner"]))),
    )
    sized = F.transform(
        droppable,
        lambda s: F.struct(
            s["first"].alias("first"), s["last"].alias("last"), _chars(F.col("_lines"), s["first"], s["last"]).alias("chars")
        ),
    )
    rows = rows.withColumn("droppable", F.array_sort(sized))
    dropped = F.aggregate("droppable", F.lit(0), lambda acc, s: acc + s["chars"])
    return rows.withColumn("full_chars", F.length("content")).withColumn(
        "essential_chars", F.when(F.col("parsed"), F.col("full_chars") - dropped).otherwise(F.col("full_chars"))
    )


def fill_budget(ranges: Column | str, used: Column, budget: Column) -> Column:
    """Optional ranges taken in order whenever one still fits; one that does not is passed over."""
    start = F.struct(used.cast("long").alias("used"), F.array().cast("array<struct<first:int,last:int,chars:int>>").alias("left"))

    def take(acc: Column, span: Column) -> Column:
        fits = acc["used"] + span["chars"] <= budget
        return F.struct(
            F.when(fits, acc["used"] + span["chars"]).otherwise(acc["used"]).alias("used"),
            F.when(fits, acc["left"]).otherwise(F.concat(acc["left"], F.array(span))).alias("left"),
        )

    return F.aggregate(F.col(ranges) if isinstance(ranges, str) else ranges, start, take)


def _gaps(left: Column) -> Column:
    """Dropped spans with adjacent ones merged."""
    empty = F.array().cast("array<struct<first:int,last:int>>")

    def merge(acc: Column, span: Column) -> Column:
        tail = F.try_element_at(acc, F.lit(-1))
        touching = (F.size(acc) > 0) & (span["first"] <= tail["last"] + 1)
        joined = F.struct(tail["first"].alias("first"), F.greatest(tail["last"], span["last"]).alias("last"))
        alone = F.struct(span["first"].alias("first"), span["last"].alias("last"))
        return F.when(touching, F.concat(F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(0))), F.array(joined))).otherwise(
            F.concat(acc, F.array(alone))
        )

    return F.aggregate(left, empty, merge)


def _marker(first: Column, last: Column) -> Column:
    return F.concat(
        F.lit("# ... ["), last - first + 1, F.lit(" lines elided: original lines "), first, F.lit("-"), last, F.lit("]")
    )


def _kept_text(lines: Column, first: Column, last: Column) -> Column:
    text = F.array_join(F.slice(lines, first, F.greatest(last - first + 1, F.lit(0))), "\n")
    ends_file = (last >= F.size(lines)) & (F.element_at(lines, -1) == "") & (last > first)
    return F.when(ends_file, F.regexp_replace(text, "\n\\z", "")).otherwise(text)


def _render(lines: Column, gaps: Column) -> Column:
    """Kept ranges with one marker line per gap."""
    count = F.size(lines)
    before = F.transform(
        gaps,
        lambda gap, i: F.struct(
            F.when(i == 0, 1).otherwise(F.get(gaps, i - 1)["last"] + 1).alias("from"), gap["first"].alias("first"), gap["last"].alias("last")
        ),
    )
    pieces = F.flatten(
        F.transform(
            before,
            lambda g: F.when(
                g["from"] < g["first"], F.array(_kept_text(lines, g["from"], g["first"] - 1), _marker(g["first"], g["last"]))
            ).otherwise(F.array(_marker(g["first"], g["last"]))),
        )
    )
    rest = F.when(F.size(gaps) > 0, F.element_at(gaps, -1)["last"] + 1).otherwise(1)
    tail = F.when(rest <= count, F.array(_kept_text(lines, rest, count))).otherwise(F.array().cast("array<string>"))
    return F.concat(F.array_join(F.concat(pieces, tail), "\n"), F.lit("\n"))


def render_slices(rows: DataFrame, budget: Column) -> DataFrame:
    """Slices of classified files under a budget per row, with coverage statistics.

    What ran is kept even over the budget. A file that is no Python is kept whole.
    """
    filled = fill_budget("droppable", F.col("essential_chars"), budget)
    rows = rows.withColumn("_budget", budget).withColumn("_left", filled["left"]).withColumn("_gaps", _gaps(F.col("_left")))
    blank = ~F.col("content").rlike(r"\S")
    plain = blank | ~F.col("parsed")
    text = F.when(plain, F.col("content")).otherwise(_render(F.col("_lines"), F.col("_gaps")))
    rows = rows.withColumn("slice", text)
    in_kept = F.size(
        F.filter("lines", lambda line: ~F.exists("_gaps", lambda g: line.between(g["first"], g["last"])))
    )
    return rows.select(
        "sample_id",
        "file_id",
        "slice",
        "full_chars",
        F.when(blank, 0).otherwise(F.col("essential_chars")).alias("essential_chars"),
        F.when(blank, 0).otherwise(F.length("slice")).alias("kept_chars"),
        (~plain & (F.col("essential_chars") > F.col("_budget"))).alias("essential_over_budget"),
        (~F.col("parsed") & ~blank).alias("parse_fail"),
        F.size("lines").alias("exec_total"),
        F.when(plain, F.size("lines")).otherwise(in_kept).alias("exec_in_kept"),
    )


def slice_sources(files: DataFrame, executed: DataFrame, budget: int) -> DataFrame:
    """Every (sample, file) sliced under the same budget."""
    return render_slices(classified(files, executed), F.lit(budget))


def _rendered_chars(file: Column, remaining: Column) -> Column:
    """Length of the slice that a budget gives, from span sizes alone."""
    filled = fill_budget(file["droppable"], file["essential_chars"], remaining)
    gaps = _gaps(filled["left"])
    marks = F.aggregate(gaps, F.lit(0), lambda acc, g: acc + F.length(_marker(g["first"], g["last"])) + 1)
    end = F.coalesce(F.try_element_at(gaps, F.lit(-1))["last"], F.lit(0))
    # The empty line after the last one is kept by itself, or the text ends without a line end.
    lone_end = F.when(file["ends_with_newline"], end == file["line_count"] - 1).otherwise(end < file["line_count"])
    return F.when(file["plain"], file["plain_chars"]).otherwise(filled["used"] + marks + lone_end.cast("int"))


def _spent(files: Column, start: Column, budget: int) -> Column:
    """(file_id, remaining) of the files in their order: what is left of the budget when a file's turn comes."""
    empty = F.struct(start.cast("long").alias("used"), F.array().cast("array<struct<file_id:string,remaining:bigint>>").alias("turns"))

    def turn(acc: Column, file: Column) -> Column:
        remaining = F.greatest(F.lit(0).cast("long"), F.lit(budget) - acc["used"])
        here = F.struct(file["file_id"].alias("file_id"), remaining.alias("remaining"))
        return F.struct(
            (acc["used"] + _rendered_chars(file, remaining)).cast("long").alias("used"),
            F.concat(acc["turns"], F.array(here)).alias("turns"),
        )

    return F.aggregate(files, empty, turn, lambda acc: acc["turns"])


def smart_context(
    samples: DataFrame, files: DataFrame, executed: DataFrame, budget: int
) -> tuple[DataFrame, DataFrame]:
    """Slices per sample under one running budget, and the sample's statistics.

    `samples(sample_id, start_chars)` starts with the test file's length; files come in the order of
    `executed.shuffle_key`, an md5. Each file's budget depends on what the former ones used, but only
    until the budget is spent: files whose predecessors' guaranteed text already exceeds it have
    nothing left. Every file that is not blank renders at least one character, so the sequential step
    sees at most `budget` rows of span sizes per sample.
    """
    # The only Python stage over whole texts feeds three branches, so its small result is kept.
    spans = reliable_checkpoint(definition_spans(files))
    rows = classified(files, executed, spans).join(samples.select("sample_id", "start_chars"), "sample_id")
    blank = ~F.col("content").rlike(r"\S")
    narrow = rows.select(
        "sample_id",
        "file_id",
        "shuffle_key",
        "start_chars",
        "droppable",
        "essential_chars",
        (blank | ~F.col("parsed")).alias("plain"),
        F.when(blank, 0).otherwise(F.col("full_chars")).alias("plain_chars"),
        F.size("_lines").alias("line_count"),
        F.col("content").endswith("\n").alias("ends_with_newline"),
    )
    # A blank file costs nothing and ignores its budget.
    narrow = narrow.where(~F.col("plain") | (F.col("plain_chars") > 0))
    sure = F.when(F.col("plain"), F.col("plain_chars")).otherwise(F.greatest("essential_chars", F.lit(1)))
    placed = running_sum(
        narrow.withColumn("_sure", sure), ["sample_id"], "shuffle_key", "_sure", "_before", hash_chunk("shuffle_key")
    )
    open_rows = placed.where(F.col("_before") + F.col("start_chars") < budget).drop("_before", "_sure")
    file = F.struct("shuffle_key", "file_id", "droppable", "essential_chars", "plain", "plain_chars", "line_count", "ends_with_newline")
    turns = open_rows.groupBy("sample_id").agg(F.max("start_chars").alias("start"), F.array_sort(F.collect_list(file)).alias("files"))
    spent = turns.select("sample_id", F.inline(_spent(F.col("files"), F.col("start"), budget)))
    budgets = rows.join(spent, ["sample_id", "file_id"], "left").withColumn("_open", F.coalesce("remaining", F.lit(0)))
    sliced = render_slices(budgets, F.col("_open"))
    order = rows.select("sample_id", "file_id", "shuffle_key", "start_chars")
    used = running_sum(
        sliced.join(order, ["sample_id", "file_id"]), ["sample_id"], "shuffle_key", "kept_chars", "_used", hash_chunk("shuffle_key")
    )
    over = F.col("essential_over_budget") | (F.col("start_chars") + F.col("_used") + F.col("kept_chars") > budget)
    flagged = used.withColumn("over_budget", over).drop("_used")
    stats = flagged.groupBy("sample_id").agg(
        F.max("start_chars").alias("test_file_chars"),
        (F.max("start_chars") + F.sum("kept_chars")).alias("total_chars"),
        F.count(F.lit(1)).alias("n_files"),
        F.count_if("over_budget").alias("n_files_over_budget"),
        F.count_if("parse_fail").alias("n_parse_failures"),
        F.sum("essential_chars").alias("essential_chars_total"),
    )
    return flagged, stats.withColumn("budget_exceeded", F.col("total_chars") > budget)


def _cut(text: Column, limit: Column) -> Column:
    return F.when(F.length(text) <= limit, text).otherwise(
        F.concat(F.substring(text, F.lit(1), limit), F.lit(CUT_MARK))
    )


def oracle_context(files: DataFrame, budget: int, per_file: int, least_last: int) -> DataFrame:
    """Whole files in order under a budget: each cut at its own limit, the last one at what is left.

    `files(sample_id, file, content, shuffle_key, start_chars)`. The first file that does not fit is
    cut if at least `least_last` characters remain; nothing follows it.
    """
    cut = files.withColumn("content", _cut(F.col("content"), F.lit(per_file))).withColumn("_chars", F.length("content"))
    placed = running_sum(cut, ["sample_id"], "shuffle_key", "_chars", "_before", hash_chunk("shuffle_key"))
    used = F.col("start_chars") + F.col("_before")
    left = F.lit(budget) - used
    whole = F.col("_chars") <= left
    # The running sum passes the budget once; that row is the one to cut.
    kept = placed.where((used < budget) & (whole | (left >= least_last)))
    text = F.when(whole, F.col("content")).otherwise(_cut(F.col("content"), left.cast("int")))
    return kept.select("sample_id", "file", "shuffle_key", text.alias("content"), (~whole).alias("cut"))


def carve_window(
    files: DataFrame, longest: int, head: int, window: int, content: str = "content", test: str = "test"
) -> DataFrame:
    """Test files beyond `longest` characters as their head and a window around the target function.

    Both are cut at line ends; other files stay whole.
    """
    text = F.col(content)
    files = files.withColumn("_func", test_func_name(test))
    found = F.regexp_instr(text, F.concat(F.lit(r"(?m)^\s*def\s+\Q"), F.col("_func"), F.lit(r"\E\s*\(")))
    files = files.withColumn("_at", found - 1).withColumn("_n", F.length(content))
    head_end = F.locate("\n", text, head + 1) - 1
    files = files.withColumn("_head", F.when(head_end < 0, F.lit(head)).otherwise(head_end))
    half = window // 2
    files = files.withColumn("_from", F.greatest(F.col("_head") + 1, F.col("_at") - half))
    files = files.withColumn("_to", F.least(F.col("_n"), F.col("_at") + half))
    # Last line end before the window, first one after it.
    lead = F.substring(text, F.lit(1), F.col("_from"))
    before = F.col("_from") - F.length(F.substring_index(lead, "\n", -1)) - 1
    files = files.withColumn("_from", F.when(before >= F.col("_head"), before + 1).otherwise(F.col("_from")))
    after = F.expr(f"locate('\\n', {content}, _to + 1)") - 1
    files = files.withColumn("_to", F.when(after >= 0, after).otherwise(F.col("_to")))

    def piece(start: Column, stop: Column) -> Column:
        return F.substring(text, start + 1, F.greatest(stop - start, F.lit(0)))

    n, head_to, start, stop = (F.col(c) for c in ("_n", "_head", "_from", "_to"))
    keep_to = F.greatest(head_to, stop)
    inside = F.concat(
        piece(F.lit(0), keep_to),
        F.when(
            keep_to < n, F.concat(F.lit("\n# ... [test file truncated past byte "), keep_to, F.lit("]\n"))
        ).otherwise(""),
    )
    windowed = F.concat(
        piece(F.lit(0), head_to),
        F.lit("\n# ... [skipped "), start - head_to, F.lit(" chars]\n"),
        piece(start, stop),
        F.when(stop < n, F.concat(F.lit("\n# ... [skipped "), n - stop, F.lit(" trailing chars]\n"))).otherwise(""),
    )
    lost = F.concat(
        F.substring(text, 1, longest),
        F.lit("\n# ... [test file truncated — target `"), F.col("_func"), F.lit("` not located]\n"),
    )
    carved = (
        F.when(n <= longest, text)
        .when(F.col("_at") < 0, lost)
        .when(F.col("_at") < head_to, inside)
        .otherwise(windowed)
    )
    return files.withColumn("window", carved).drop("_func", "_at", "_n", "_head", "_from", "_to")
