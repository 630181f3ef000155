"""Line numbers and code lines of a diff's hunks."""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

HUNK = r"^@@ -(\d+)(?:,\d+)? \+(\d+)(?:,\d+)? @@"


def hunk_lines(df: DataFrame, keys: list[str], patch: str) -> DataFrame:
    """(keys, file, pos, mark, text, old_line, new_line) for every line in a hunk; the mark is "+", "-" or " ".

    Running counts within a hunk give the numbers; an added line has no old number and a removed one no new number.
    """
    lines = df.select(*keys, F.posexplode(F.split(patch, "\r\n|\n|\r")).alias("pos", "line"))
    order = Window.partitionBy(*keys).orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    is_file, is_hunk = F.col("line").startswith("diff --git"), F.col("line").rlike(HUNK)
    marked = (
        lines.withColumn("file", F.last(F.when(is_file, F.regexp_extract("line", r" b/(.*)$", 1)), ignorenulls=True).over(order))
        .withColumn("fileno", F.sum(is_file.cast("int")).over(order))
        .withColumn("hunk", F.sum((is_hunk | is_file).cast("int")).over(order))
        .withColumn("in_hunk", F.last(F.when(is_hunk, True).when(is_file, False), ignorenulls=True).over(order))
        .withColumn("old0", F.last(F.when(is_hunk, F.regexp_extract("line", HUNK, 1).try_cast("int")), ignorenulls=True).over(order))
        .withColumn("new0", F.last(F.when(is_hunk, F.regexp_extract("line", HUNK, 2).try_cast("int")), ignorenulls=True).over(order))
    )
    body = marked.where(F.col("in_hunk") & ~is_hunk & ~is_file & ~F.col("line").startswith("\\"))
    mark = F.when(F.col("line").startswith("+"), "+").when(F.col("line").startswith("-"), "-").otherwise(" ")
    within = Window.partitionBy(*keys, "hunk").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    old = F.sum((mark != "+").cast("int")).over(within) - 1 + F.col("old0")
    new = F.sum((mark != "-").cast("int")).over(within) - 1 + F.col("new0")
    return body.select(
        *keys,
        "file",
        "pos",
        mark.alias("mark"),
        F.expr("substring(line, 2)").alias("text"),
        F.when(mark != "+", old).alias("old_line"),
        F.when(mark != "-", new).alias("new_line"),
    )


def lines_of_interest(df: DataFrame, keys: list[str], patch: str) -> DataFrame:
    """(keys, file, line): added lines, and around every removal the lines that survive from before it to behind it."""
    lines = hunk_lines(df, keys, patch)
    order = Window.partitionBy(*keys, "file").orderBy("pos")
    before = F.last("new_line", ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, -1))
    marked = lines.withColumn("_before", before).withColumn("_prev", F.lag("mark").over(order))
    added = marked.where("mark = '+'").select(*keys, "file", F.col("new_line").alias("line"))
    around = marked.where("_prev = '-' and mark <> '-' and _before is not null")
    survivors = around.select(*keys, "file", F.explode(F.sequence("_before", "new_line")).alias("line"))
    return added.unionByName(survivors).distinct()


def code_lines(lines: Column) -> Column:
    """Of an array of source lines those that are code: no blanks, comments or docstrings.

    A docstring that does not close on its line hides the following lines up to the one with its mark.
    """
    start = F.struct(F.lit("").alias("mark"), F.expr("cast(array() as array<string>)").alias("out"))

    def step(s: Column, line: Column) -> Column:
        opened = F.regexp_extract(line, r"^\s*(\"\"\"|''')", 1)
        closes = F.regexp_replace(line, r"^\s*(\"\"\"|''')", "").contains(opened)
        skip = line.rlike(r"^\s*$") | line.rlike(r"^\s*#")
        inside = s["mark"] != ""
        return (
            F.when(line.rlike(r"^\s*$"), s)
            .when(inside, F.struct(F.when(line.contains(s["mark"]), "").otherwise(s["mark"]).alias("mark"), s["out"].alias("out")))
            .when(opened != "", F.struct(F.when(closes, "").otherwise(opened).alias("mark"), s["out"].alias("out")))
            .when(skip, s)
            .otherwise(F.struct(F.lit("").alias("mark"), F.array_append(s["out"], line).alias("out")))
        )

    return F.aggregate(lines, start, step, lambda s: s["out"])


def meaningful_change(patch: Column) -> Column:
    """Whether a file other than Python changes, or a Python file in more than comments, docstrings and blank lines."""
    files = F.slice(F.split(patch, "diff --git"), 2, 1_000_000)

    def file_counts(part: Column) -> Column:
        dest = F.regexp_replace(F.element_at(F.split(F.trim(F.substring_index(part, "\n", 1)), r"\s+"), -1), "^b/", "")
        lines = F.split(F.regexp_replace(part, r"(?s)^.*?\n@@[^\n]*\n?", ""), "\n")
        lines = F.when(part.contains("\n@@"), lines).otherwise(F.expr("cast(array() as array<string>)"))
        plus = F.filter(lines, lambda x: x.startswith("+") & ~x.startswith("+++"))
        minus = F.filter(lines, lambda x: x.startswith("-") & ~x.startswith("---"))
        bare = lambda a: F.transform(a, lambda x: F.substr(x, F.lit(2)))
        some = F.size(plus) + F.size(minus) > 0
        code = (F.size(code_lines(bare(plus))) > 0) | (F.size(code_lines(bare(minus))) > 0)
        return some & (~dest.endswith(".py") | code)

    return F.coalesce(F.exists(files, file_counts), F.lit(False))


def minimal_patch(patch: Column) -> Column:
    """The patch with its hunks trimmed: context before the first change goes, as does what follows the last change but
    for one line; lines lose white space at their ends, and headers are counted anew. Of each file the two name lines
    stay; files without them (binary, renamed only) and hunks without counts or changes go."""
    return _trimmed_patches(patch)


def _trimmed_hunk(start: int, shift: int, body: list[str]) -> tuple[str, int]:
    """A hunk's text from its old first line, the lines that the file has gained so far, and the lines that it gains."""
    changed = [i for i, line in enumerate(body) if line[:1] in ("+", "-")]
    if not changed:
        return "", 0
    kept = [line.rstrip() for line in body[changed[0] : changed[-1] + 2]]
    counted = kept[:-1] if kept[-1] == "" else kept
    plus, minus = (sum(line[:1] == mark for line in counted) for mark in "+-")
    at = start + changed[0]
    head = f"@@ -{at},{len(counted) - plus} +{at + shift},{len(counted) - minus} @@"
    return "\n".join([head, *kept, ""]), plus - minus


def _trimmed(patch: str | None) -> str | None:
    if patch is None:
        return None
    out: list[str] = []
    start, shift, body = 0, 0, None

    def close(more: bool) -> None:
        nonlocal shift, body
        if body is not None:
            text, gained = _trimmed_hunk(start, shift, [*body, ""] if more else body)
            out.append(text)
            shift += gained
        body = None

    for line in patch.split("\n"):
        if found := re.match(r"@@\s+-(\d+),\d+\s+\+\d+,\d+\s+@@", line):
            close(True)
            start, body = int(found[1]), []
        elif line.startswith(("diff ", "--- a/")):
            close(True)
            shift = 0
            if line.startswith("---"):
                out.append(line + "\n")
        elif body is not None:
            body.append(line)
        elif line.startswith("+++ b/"):
            out.append(line + "\n")
    close(False)
    return "".join(out)


@F.pandas_udf(T.StringType())
def _trimmed_patches(patches: pd.Series) -> pd.Series:
    return patches.map(_trimmed)
