"""Test logs to rows (keys..., test, status): one rule per format, a registry by repository, functions for SQL.

Every parser takes (logs, keys, text) and gives one row per key and test; where a log names a test twice, the rule of
the format (mostly: the last line) decides, by line position. Formats that are read line by line are LineParser: a table
whose logs have many of them is read once, each log by its own.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.udtf import AnalyzeResult

Parser = Callable[[DataFrame, list[str], str], DataFrame]

# fixed values: the statuses of test runs and the pattern of terminal codes
STATUSES = ["FAILED", "PASSED", "SKIPPED", "ERROR", "XFAIL"]
ANSI = r"\x1B(?:[@-Z\\-_]|\[[0-?]*[ -/]*[@-~])"


def _split(text: Column, clean: Callable[[Column], Column] | None = None, prev: Column | None = None) -> Column:
    """The lines of a text, cleaned, as structs (line, prev)."""
    lines = F.split(text, "\r\n|\n|\r")
    prev = F.lit(None).cast("string") if prev is None else prev
    return F.transform(lines, lambda line: F.struct((clean(line) if clean else line).alias("line"), prev.alias("prev")))


def _case(test: Column, status: Column, place: int = 0) -> Column:
    return F.struct(test.alias("test"), status.alias("status"), F.lit(place).alias("place"))


@dataclass(frozen=True, eq=False)
class LineParser:
    """A format that names tests line by line; called as any parser.

    lines: text to an array of (line, prev), prev being what a line must know of those before it. keep: which lines are
    looked at. found: what a line says, an array of cases; of the cases of one test the largest (place, position) counts.
    alone: tests count under their name before "[", and only where one test has it.
    """

    found: Callable[[Column, Column], Column]
    keep: Callable[[Column], Column]
    lines: Callable[[Column], Column] = _split
    alone: bool = False

    def __call__(self, logs: DataFrame, keys: list[str], text: str) -> DataFrame:
        return _parsed(logs, keys, text, [(self, F.lit(True))])


def _parsed(logs: DataFrame, keys: list[str], text: str, chosen: list[tuple[LineParser, Column]]) -> DataFrame:
    """Every log by the first parser whose condition it meets, in one scan and one grouped pass."""

    def by_tag(of: Callable[[LineParser], Column]) -> Column:
        if len(chosen) == 1:
            return of(chosen[0][0])
        return reduce(lambda case, i: case.when(F.col("_tag") == i, of(chosen[i][0])), range(1, len(chosen)), F.when(F.col("_tag") == 0, of(chosen[0][0])))

    tag = reduce(lambda case, i: case.when(chosen[i][1], i), range(1, len(chosen)), F.when(chosen[0][1], 0))
    tagged = logs.select(*keys, F.col(text).alias("_text"), tag.alias("_tag")).where("_tag is not null")
    rows = tagged.select(*keys, "_tag", F.posexplode(by_tag(lambda p: p.lines(F.col("_text")))).alias("_pos", "_l")).select(*keys, "_tag", "_pos", "_l.line", "_l.prev")
    rows = rows.where(by_tag(lambda p: p.keep(F.col("line"))))
    cases = rows.select(*keys, "_tag", "_pos", F.posexplode(by_tag(lambda p: p.found(F.col("line"), F.col("prev")))).alias("_k", "_x"))
    cases = cases.select(*keys, "_tag", "_pos", "_k", "_x.*").where("test is not null and test <> '' and status is not null")
    alone = F.col("_tag").isin([i for i, (p, _) in enumerate(chosen) if p.alone])
    unit = F.when(alone, F.substring_index("test", "[", 1)).otherwise(F.col("test"))
    last = F.max_by("status", F.struct("place", "_pos", "_k")).alias("status")
    units = cases.groupBy(*keys, "_tag", unit.alias("_unit")).agg(last, F.min("test").alias("_low"), F.max("test").alias("_high"))
    return units.where(~alone | (F.col("_low") == F.col("_high"))).select(*keys, F.col("_unit").alias("test"), "status")


def _last(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Of the lines of one test the last one's status."""
    # rows of one element, so that the filter stays behind the expressions of test and status
    named = rows.select(*keys, "pos", F.inline_outer(F.array(F.struct("test", "status")))).where("test is not null and test <> '' and status is not null")
    return named.groupBy(*keys, "test").agg(F.max_by("status", "pos").alias("status"))


def _starts(line: Column) -> Column:
    return reduce(lambda a, b: a | b, [line.startswith(s) for s in STATUSES])


def _ends(line: Column) -> Column:
    return reduce(lambda a, b: a | b, [line.endswith(s) for s in STATUSES])


def _undashed(line: Column) -> Column:
    return F.when(line.startswith("FAILED"), F.replace(line, F.lit(" - "), F.lit(" "))).otherwise(line)


def drop_trailing(name: Column) -> Column:
    """A test name without what follows it: up to the first white space, or to where its first bracket closes (the
    whole name where it does not). Bracket by bracket, adding up lengths."""
    tokens = F.regexp_extract_all(name, F.lit(r"[^\[\]]*[\[\]]"), F.lit(0))
    start = F.struct(F.lit(0).alias("open"), F.lit(False).alias("done"), F.lit(0).alias("length"))

    def step(s: Column, token: Column) -> Column:
        now = F.greatest(s["open"] + F.when(token.endswith("["), 1).otherwise(-1), F.lit(0))
        closed = (now == 0) & (s["open"] == 1)
        return F.when(s["done"], s).otherwise(F.struct(now.alias("open"), closed.alias("done"), (s["length"] + F.length(token)).alias("length")))

    closed = F.aggregate(tokens, start, step, lambda s: F.when(s["done"], s["length"]))
    bracketed = F.substring(name, F.lit(1), F.coalesce(closed, F.length(name)))
    return F.when(~name.contains("["), F.get(F.split(F.ltrim(name), r"\s+"), F.lit(0))).otherwise(bracketed)


def _words(line: Column) -> Column:
    return F.split(F.trim(line), r"\s+")


def _either_end(line: Column) -> Column:
    return _starts(line) | _ends(line)


def _pytest_case(line: Column, _: Column) -> Column:
    parts = F.split(F.regexp_replace(line, r"\s+$", ""), r"\s+", 2)
    return F.transform(F.array(parts), lambda p: _case(drop_trailing(F.get(p, F.lit(1))), p[0]))  # bound once


#: Lines that begin with a status; options in brackets stay in the name, what follows goes.
pytest_log = LineParser(_pytest_case, _starts, lambda text: _split(text, _undashed))

#: As pytest, only tests whose name before the bracket is the only one, under that name.
numpy_log = LineParser(_pytest_case, _starts, lambda text: _split(text, _undashed), alone=True)


def _options_case(line: Column, _: Column) -> Column:
    name = F.get(_words(line), F.lit(1))
    main, option = F.regexp_extract(name, r"^(.*?)\[(.*)\]", 1), F.regexp_extract(name, r"^(.*?)\[(.*)\]", 2)
    path = option.startswith("/") & ~option.startswith("//") & ~option.contains("*")
    short = F.when(path, F.concat(F.lit("/"), F.substring_index(option, "/", -1))).otherwise(option)
    test = F.when(name.rlike(r"^(.*?)\[(.*)\]"), F.concat(main, F.lit("["), short, F.lit("]"))).otherwise(name)
    return F.array(_case(test, _words(line)[0]))


#: As pytest, the name being the second word; an option that is a path keeps its last part only.
pytest_options_log = LineParser(_options_case, _starts, lambda text: _split(text, _undashed))


def _later_case(line: Column, _: Column) -> Column:
    front = F.split(line, r"\s+", 2)
    back = [F.regexp_extract(line, r"^\s*(.*?)\s+(\S+)\s*$", i) for i in (1, 2)]
    test = F.when(_starts(line), F.regexp_replace(F.get(front, F.lit(1)), r"\s+$", "")).otherwise(back[0])
    return F.array(_case(test, F.when(_starts(line), front[0]).otherwise(back[1])))


#: Terminal codes are removed; older lines end with the status. The whole rest of a line is the name.
pytest_later_log = LineParser(_later_case, _either_end, lambda text: _split(text, lambda line: _undashed(F.regexp_replace(line, ANSI, ""))))


def _pydantic_clean(line: Column) -> Column:
    plain = F.regexp_replace(F.regexp_replace(line, r"\[(\d+)m", ""), r"[\x01-\x1f]", "")
    return _undashed(F.regexp_replace(plain, r"FAILED\s*\[.*?\]", "FAILED"))


def _pydantic_case(line: Column, _: Column) -> Column:
    first, second = F.get(_words(line), F.lit(0)), F.get(_words(line), F.lit(1))
    return F.array(_case(F.when(_starts(line), second).otherwise(first), F.when(_starts(line), first).otherwise(second)))


#: Colours and control characters are removed, and the bracket behind FAILED.
pydantic_log = LineParser(_pydantic_case, _either_end, lambda text: _split(text, _pydantic_clean))


def _seaborn_case(line: Column, _: Column) -> Column:
    first, second = F.get(_words(line), F.lit(0)), F.get(_words(line), F.lit(1))
    failed = line.startswith("FAILED")
    passed = F.when(line.contains(" PASSED "), F.when(second == "PASSED", first)).when(line.startswith("PASSED"), second)
    return F.array(_case(F.when(failed, second).otherwise(passed), F.when(failed, "FAILED").otherwise("PASSED")))


seaborn_log = LineParser(_seaborn_case, lambda line: line.startswith("FAILED") | line.contains(" PASSED ") | line.startswith("PASSED"))


def _buttons(line: Column) -> Column:
    return F.replace(F.replace(line, F.lit("MouseButton.LEFT"), F.lit("1")), F.lit("MouseButton.RIGHT"), F.lit("3"))


#: The second word is the name; mouse buttons are numbers.
matplotlib_log = LineParser(
    lambda line, _: F.array(_case(F.get(_words(line), F.lit(1)), _words(line)[0])), _starts, lambda text: _split(text, lambda line: _undashed(_buttons(line)))
)

SYMPY_HEADER = r"(_*) (.*)\.py:(.*) (_*)"


def _sympy_case(line: Column, prev: Column) -> Column:
    words = F.split(line, r"\s+")
    bare = F.regexp_replace(line, r"\s*\[(FAIL|OK)\]$", "")
    status = F.when(bare.endswith(" E"), "ERROR").when(bare.endswith(" F"), "FAILED").when(bare.endswith(" ok"), "PASSED")
    file = F.concat(F.regexp_extract(line, SYMPY_HEADER, 2), F.lit(".py:"), F.regexp_extract(line, SYMPY_HEADER, 3))
    modern = F.array(_case(words[0], F.get(words, F.lit(1))))
    named = F.when(line.startswith("test_"), _case(F.substring_index(bare, " ", 1), status))
    header = F.when(line.rlike(SYMPY_HEADER), _case(file, F.lit("FAILED"), -1))
    return F.when(prev == "pytest", F.when(line.startswith("sympy/") & (F.size(words) >= 3), modern)).otherwise(F.filter(F.array(named, header), lambda c: c.isNotNull()))


#: Under pytest the lines of sympy/ files with at least three words; else headers of failures (any line of a test says
#: more) and lines of test_.
sympy_log = LineParser(
    _sympy_case,
    lambda line: line.startswith("sympy/") | line.startswith("test_") | line.rlike(SYMPY_HEADER),
    lambda text: F.when(text.contains("pytest"), _split(text, F.trim, F.lit("pytest"))).otherwise(_split(text, F.trim)),
)


def _django_lines(text: Column) -> Column:
    """Trimmed lines in stretches that begin with a line that names a test, which is `prev` for all of the stretch."""
    trimmed = F.regexp_replace(text, r"(?m)^[^\S\r\n]+|[^\S\r\n]+$", "")
    stretches = F.split(trimmed, r"(?m)^(?=[^\r\n]* \.\.\. )")
    return F.flatten(F.transform(stretches, lambda s: _split(s, None, F.when(F.substring_index(s, "\n", 1).contains(" ... "), F.substring_index(s, " ... ", 1)))))


def _django_case(line: Column, prev: Column) -> Column:
    def says(condition: Column, test: Column, status: str) -> Column:
        return F.when(condition, _case(test, F.lit(status)))

    before = lambda mark: F.substring_index(line, mark, 1)
    word = F.get(F.split(line, r"\s+"), F.lit(1))
    odd = "Applying sites.0002_alter_domain_unique...test_no_migrations"
    moved = F.when(line.startswith(odd), F.trim(F.regexp_replace(line, r"^.*?\.\.\.", ""))).otherwise(line)
    version = "--version is equivalent to version"
    found = F.array(
        says(line.contains(version), F.lit(version), "PASSED"),
        says(line.rlike(r" \.\.\. {1,2}(ok|OK)$") & ~line.rlike(r" \.\.\.  ok$"), F.regexp_replace(moved, r" \.\.\. {1,2}(ok|OK)$", ""), "PASSED"),
        says(line.contains(" ... skipped"), before(" ... skipped"), "SKIPPED"),
        says(line.endswith(" ... FAIL"), before(" ... FAIL"), "FAILED"),
        says(line.startswith("FAIL:"), word, "FAILED"),
        says(line.endswith(" ... ERROR"), before(" ... ERROR"), "ERROR"),
        says(line.startswith("ERROR:"), word, "ERROR"),
        says(line.startswith("ok") & prev.isNotNull(), prev, "PASSED"),
    )
    return F.filter(found, lambda x: x.isNotNull())


#: Suffixes of "name ... ok" lines, FAIL: and ERROR: headers; a later bare "ok" passes the last test named before.
django_log = LineParser(_django_case, lambda line: line.contains(" ... ") | line.contains("--version") | line.rlike("^(FAIL:|ERROR:|ok)"), _django_lines)

# fixed values: the lines of two test runners
GTEST_LINE = r"^\[\s+(RUN|OK|FAILED|SKIPPED|DISABLED|PASSED)\s+\]\s+(\S+\.\S+)"
CTEST_LINE = r"(?i)^\s*Test\s+#\d+:\s+(\S+)\s+\.+\s*(\*\*\*)?\s*(Passed|Failed|Skipped|Timeout|Not Run)"


def _gtest_case(line: Column, _: Column) -> Column:
    verb, test = F.regexp_extract(line, GTEST_LINE, 1), F.regexp_extract(line, GTEST_LINE, 2)
    status = F.when(verb.isin("OK", "PASSED"), "PASSED").when(verb == "FAILED", "FAILED").otherwise("SKIPPED")
    return F.when(verb == "RUN", F.array(_case(test, F.lit("ERROR"), -1))).otherwise(F.array(_case(test, status)))


#: gtest lines; a RUN without a verdict before or behind it is an error.
gtest_log = LineParser(_gtest_case, lambda line: line.rlike(GTEST_LINE))


def _ctest_case(line: Column, _: Column) -> Column:
    word = F.lower(F.regexp_extract(line, CTEST_LINE, 3))
    status = F.when(word == "passed", "PASSED").when(word.isin("failed", "timeout"), "FAILED").otherwise("SKIPPED")
    return F.array(_case(F.regexp_extract(line, CTEST_LINE, 1), status))


#: CTest summary lines; a timeout fails, what did not run is skipped.
ctest_log = LineParser(_ctest_case, lambda line: line.rlike(CTEST_LINE))


GTEST_JSON = "struct<testsuites:array<struct<name:string,testsuite:array<struct<name:string,classname:string,status:string,result:string,failures:array<struct<failure:string>>>>>>>"
VITEST_JSON = "struct<testResults:array<struct<assertionResults:array<struct<fullName:string,title:string,status:string>>>>>"


def _full(classname: Column, name: Column) -> Column:
    return F.when(F.coalesce(classname, F.lit("")) != "", F.concat(classname, F.lit("."), F.coalesce(name, F.lit("")))).otherwise(name)


def gtest_json(logs: DataFrame, keys: list[str], text: str) -> DataFrame:
    suites = logs.select(*keys, F.posexplode(F.from_json(text, GTEST_JSON)["testsuites"]).alias("_i", "suite"))
    cases = suites.select(*keys, "_i", "suite.name", F.posexplode("suite.testsuite").alias("_j", "case"))
    c = F.col("case")
    status = (
        F.when((c["status"] == "NOTRUN") | c["result"].isin("SKIPPED", "SUPPRESSED"), "SKIPPED")
        .when(F.size(c["failures"]) > 0, "FAILED")
        .when((c["result"] == "COMPLETED") & (c["status"] == "RUN"), "PASSED")
        .otherwise("ERROR")
    )
    test = _full(F.coalesce(c["classname"], F.col("name")), c["name"])
    return _last(cases.select(*keys, F.struct("_i", "_j").alias("pos"), test.alias("test"), status.alias("status")), keys)


def vitest_status(status: Column) -> Column:
    low = F.lower(F.coalesce(status, F.lit("")))
    return F.when(low == "passed", "PASSED").when(low == "failed", "FAILED").when(low.isin("skipped", "pending", "todo"), "SKIPPED").otherwise("ERROR")


def vitest_json(logs: DataFrame, keys: list[str], text: str) -> DataFrame:
    files = logs.select(*keys, F.posexplode(F.from_json(text, VITEST_JSON)["testResults"]).alias("_i", "_f"))
    cases = files.select(*keys, "_i", F.posexplode("_f.assertionResults").alias("_j", "_c"))
    test = F.coalesce(F.nullif("_c.fullName", F.lit("")), F.col("_c.title"))
    return _last(cases.select(*keys, F.struct("_i", "_j").alias("pos"), test.alias("test"), vitest_status(F.col("_c.status")).alias("status")), keys)


def junit_xml(logs: DataFrame, keys: list[str], text: str, default_class: str = "") -> DataFrame:
    """JUnit XML with one suite or several; a text that is no XML has no tests.

    Elements are found by pattern: a case is a testcase tag with what stands in it, so broken texts do no harm.
    """
    suites = F.regexp_extract_all(text, F.lit(r"(?s)<testsuite(?=[\s>])([^>]*)>(.*?)</testsuite>"), F.lit(0))
    rows = logs.select(*keys, F.posexplode(suites).alias("_i", "suite"))
    attribute = lambda tag, name: F.regexp_extract(tag, rf'(?s)^<\w+(?=\s)[^>]*?\s{name}="([^"]*)"', 1)
    cases = rows.select(
        *keys,
        "_i",
        F.coalesce(F.nullif(attribute(F.col("suite"), "name"), F.lit("")), F.lit(default_class)).alias("suite_name"),
        F.posexplode(F.regexp_extract_all("suite", F.lit(r"(?s)<testcase(?=[\s/>])(?:[^>]*/>|[^>]*>.*?</testcase>)"), F.lit(0))).alias("_j", "case"),
    )
    c = F.col("case")
    test = _full(F.coalesce(F.nullif(attribute(c, "classname"), F.lit("")), F.col("suite_name")), attribute(c, "name"))
    has = lambda tag: c.rlike(rf"<{tag}[\s/>]")
    status = F.when(has("failure"), "FAILED").when(has("error"), "ERROR").when(has("skipped"), "SKIPPED").otherwise("PASSED")
    return _last(cases.select(*keys, F.struct("_i", "_j").alias("pos"), test.alias("test"), status.alias("status")), keys)


def catch2_xml(logs: DataFrame, keys: list[str], text: str) -> DataFrame:
    """Catch2's own XML: the overall result of each case, skipped if it holds a Skip."""
    native = logs.where(F.col(text).rlike(r"<(Catch|Catch2TestRun)[\s>]"))
    other = junit_xml(logs.where(~F.col(text).rlike(r"<(Catch|Catch2TestRun)[\s>]")), keys, text, "Catch2")
    rows = native.select(*keys, F.posexplode(F.regexp_extract_all(text, F.lit(r"(?s)<TestCase(?=\s).*?</TestCase>"), F.lit(0))).alias("pos", "case"))
    c = F.col("case")
    success = F.lower(F.regexp_extract(c, r'<OverallResult[^>]*\ssuccess="([^"]*)"', 1))
    status = F.when(~c.contains("<OverallResult"), "ERROR").when(c.rlike(r"<Skip[\s/>]"), "SKIPPED").when(success == "true", "PASSED").otherwise("FAILED")
    named = rows.select(*keys, "pos", F.regexp_extract(c, r'^<TestCase[^>]*?\sname="([^"]*)"', 1).alias("test"), status.alias("status"))
    return _last(named, keys).unionByName(other)


def first_of(parsers: list[Parser]) -> Parser:
    """Best effort: all parsers' rows, the first parser that knows a test wins."""

    def run(logs: DataFrame, keys: list[str], text: str) -> DataFrame:
        ranked = [p(logs, keys, text).withColumn("_rank", F.lit(i)) for i, p in enumerate(parsers)]
        every = reduce(lambda a, b: a.unionByName(b), ranked)
        return every.groupBy(*keys, "test").agg(F.min_by("status", "_rank").alias("status"))

    return run


#: Repositories with formats of their own; all others read as pytest (Python) or best effort.
PARSERS: dict[str, Parser] = {
    "django/django": django_log,
    "mwaskom/seaborn": seaborn_log,
    "sympy/sympy": sympy_log,
    "matplotlib/matplotlib": matplotlib_log,
    "numpy/numpy": numpy_log,
    "scipy/scipy": numpy_log,
    "pydantic/pydantic": pydantic_log,
    "psf/requests": pytest_options_log,
    "scikit-learn/scikit-learn": pytest_later_log,
    "sphinx-doc/sphinx": pytest_later_log,
    "astropy/astropy": pytest_later_log,
}


def register_parser(repo: str, parser: Parser) -> None:
    """Adds a repository's parser; names are compared in lower case."""
    PARSERS[repo.lower()] = parser


def parse_logs(logs: DataFrame, keys: list[str], text: str, repo: str, default: Parser = pytest_log) -> DataFrame:
    """Rows of every log by its repository's parser (column `repo`, case apart), others by the default.

    Logs are tagged with their parser and read once for all that are LineParser; each other registered parser reads the
    logs of its repositories once more.
    """
    low = F.lower(F.coalesce(F.col(repo), F.lit("")))
    groups: dict[Parser, list[str]] = {}
    for name, parser in PARSERS.items():
        groups.setdefault(parser, []).append(name)
    by_line = [(p, low.isin(names)) for p, names in groups.items() if isinstance(p, LineParser)]
    parts = [p(logs.where(low.isin(names)), keys, text) for p, names in groups.items() if not isinstance(p, LineParser)]
    rest = ~low.isin(*PARSERS)
    if isinstance(default, LineParser):
        by_line.append((default, rest))
    else:
        parts.append(default(logs.where(rest), keys, text))
    if by_line:
        parts.append(_parsed(logs, keys, text, by_line))
    return reduce(lambda a, b: a.unionByName(b), parts)


#: What a parser that SQL can call gives for a log: (test, status) in order, the last of a test counts.
Reader = Callable[[str], Iterable[tuple[str, str]]]


def pattern_reader(pattern: str, words: dict[str, str], other: str | None = None) -> Reader:
    """A reader of lines that a pattern finds, with groups named test and status; words: from what a log says (case
    apart) to a status. Words that are not there have the status `other`, or are left out."""
    known, line = {k.lower(): v for k, v in words.items()}, re.compile(pattern, re.MULTILINE)
    if not {"test", "status"} <= set(line.groupindex):
        raise ValueError("the pattern has no groups test and status")

    def read(log: str) -> Iterable[tuple[str, str]]:
        for found in line.finditer(log):
            status = known.get(found["status"].lower(), other)
            if status is not None:
                yield found["test"], status

    return read


def register_log_function(spark: SparkSession, readers: dict[str, Reader], name: str = "parse_log", default: str | None = None) -> None:
    """A table function for SQL: name(log, parser) gives (test, status), a row for each test of the log, by the reader
    that is registered as `parser` (case apart), else by the default one, else none.

        SELECT l.id, t.test, t.status FROM logs l, LATERAL parse_log(l.log, l.parser) t

    Registering again under the same name replaces the readers, so formats can be added while a session runs. Null logs
    have no rows. Other arguments than two strings are refused when the query is analysed. Rows pass pickled, many at a
    time; with Arrow each log would be a frame of its own.
    """
    known = {k.lower(): r for k, r in readers.items()}
    fallback = known[default.lower()] if default is not None else None
    schema = T.StructType([T.StructField("test", T.StringType()), T.StructField("status", T.StringType())])

    class ParseLog:
        @staticmethod
        def analyze(log, parser):
            for argument in (log, parser):
                if not isinstance(argument.dataType, (T.StringType, T.NullType)):
                    raise ValueError(f"{name}(log, parser) takes two strings, not {argument.dataType.simpleString()}")
            return AnalyzeResult(schema)

        def eval(self, log, parser):
            read = known.get((parser or "").lower(), fallback)
            if log is None or read is None:
                return
            yield from {test: status for test, status in read(log) if test and status is not None}.items()

    spark.udtf.register(name, F.udtf(ParseLog, useArrow=False))


def eval_section(log: Column, start: str, failures: list[str]) -> Column:
    """What a log says behind its last start mark; null if a failure mark is in it or the start mark is not."""
    broken = reduce(lambda a, b: a | b, [log.contains(f) for f in failures], F.lit(False))
    return F.when(~broken & log.contains(start), F.substring_index(log, start, -1))


def has_missing_name(log: Column) -> Column:
    """Whether a line tells of an attribute or import error."""
    return F.exists(F.split(F.lower(log), "\n"), lambda line: line.contains("attributeerror") | line.contains("importerror") | line.contains("modulenotfounderror"))


def status_map(json_text: Column) -> Column:
    return F.from_json(json_text, T.MapType(T.StringType(), T.StringType()))


def load_statuses(logs: DataFrame, keys: list[str], text: str) -> DataFrame:
    """A JSON status map where the text is one, else lines that begin with a status."""
    mapped = logs.withColumn("_m", F.when(F.col(text).rlike(r"(?s)^\s*\{.*\}\s*$"), status_map(F.col(text))))
    from_json = mapped.where("_m is not null").select(*keys, F.explode("_m").alias("test", "status"))
    return from_json.unionByName(pytest_log(mapped.where("_m is null").drop("_m"), keys, text))
