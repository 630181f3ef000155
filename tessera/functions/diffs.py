"""Column functions on unified diffs and on the paths that they touch."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tessera.functions.text import any_of, contains_any, is_blank

# Paths by kind.
TEST_PATHS = r"(^|/)tests?/|(^|/)testing/|(^|/)test_[^/]+\.py$|(^|/)[^/]*_test\.py$|(^|/)conftest\.py$|(^|/)fixtures?/"
BENCHMARK_PATHS = r"(^|/)benchmarks?/|(^|/)bench_[^/]+\.py$|(^|/)[^/]*_bench\.py$|(^|/)asv_bench/|(^|/)perf/"
DOC_PATHS = r"(?i)(^|/)docs?/|(^|/)documentation/|(^|/)CHANGES|(^|/)CHANGELOG|(^|/)HISTORY|(^|/)NEWS|(^|/)AUTHORS|(^|/)CONTRIBUTORS"
DOC_EXTENSIONS = [".md", ".rst", ".txt", ".adoc", ".asciidoc"]
CI_PATHS = [
    ".github/workflows/", ".github/actions/", ".circleci/", ".travis.yml", "Jenkinsfile", "azure-pipelines",
    ".gitlab-ci", "tox.ini", "noxfile.py", ".pre-commit-config.yaml",
]
DEPENDENCY_FILES = ["setup.cfg", "setup.py", "pyproject.toml", "Pipfile", "Pipfile.lock", "poetry.lock", "pdm.lock"]
DEPENDENCY_ENDS = ["requirements.txt", "requirements.in", "constraints.txt"]
CONFIG_FILES = [
    "makefile", "dockerfile", ".dockerignore", ".gitignore", ".editorconfig", ".flake8", ".pylintrc", ".mypy.ini",
    "mypy.ini", "pyrightconfig.json", ".coveragerc",
]
CONFIG_EXTENSIONS = [".cfg", ".ini", ".toml", ".yaml", ".yml"]
TEST_WORDS = ["test", "tests", "e2e", "testing"]


def _name(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def _extension(path: Column) -> Column:
    """The suffix with its dot, lower case; '' for none and for names that only begin with a dot."""
    return F.lower(F.regexp_extract(_name(path), r"^.+(\.[^.]+)$", 1))


def is_benchmark_file(path: Column) -> Column:
    return path.rlike(BENCHMARK_PATHS)


def is_test_file(path: Column) -> Column:
    """Benchmarks are no tests."""
    return ~is_benchmark_file(path) & path.rlike(TEST_PATHS)


def is_doc_file(path: Column) -> Column:
    return _extension(path).isin(DOC_EXTENSIONS) | path.rlike(DOC_PATHS)


def is_ci_file(path: Column) -> Column:
    return contains_any(path, CI_PATHS)


def is_deps_file(path: Column) -> Column:
    name = _name(path)
    versions = name.startswith("requirements") & _extension(path).isin(".txt", ".in", ".cfg", "")
    return name.isin(DEPENDENCY_FILES) | any_of([name.endswith(e) for e in DEPENDENCY_ENDS]) | versions


def is_lock_file(path: Column) -> Column:
    return path.endswith(".lock")


def is_config_file(path: Column) -> Column:
    return F.lower(_name(path)).isin(CONFIG_FILES) | (_extension(path).isin(CONFIG_EXTENSIONS) & ~path.contains("/"))


def is_code_free(path: Column) -> Column:
    return is_doc_file(path) | is_ci_file(path) | is_deps_file(path) | is_config_file(path) | is_lock_file(path)


def edits(patch: Column) -> Column:
    """Array of (source, dest, content), one for each file of a diff.

    Paths come from the header, or from rename lines where there are any; binary files have no content. A null or
    blank patch, and one without a file header, has none.
    """
    parts = F.slice(F.split(patch, "diff --git"), 2, 1_000_000)
    parts = F.filter(F.transform(parts, lambda p: F.regexp_replace(p, r"^\s+|\s+$", "")), lambda p: p != "")

    # step by step, so that no expression is written out twice
    def cut(part: Column) -> Column:
        return F.struct(F.substring_index(part, "\n", 1).alias("header"), F.regexp_replace(part, r"^[^\n]*\n?", "").alias("body"))

    def marked(p: Column) -> Column:
        return F.struct(
            p["header"].alias("header"),
            p["body"].alias("body"),
            F.locate(" b/", p["header"]).alias("at"),
            F.split(F.trim(p["header"]), r"\s+").alias("words"),
            (p["body"].contains("Binary files") & p["body"].contains("differ")).alias("binary"),
            F.regexp_extract(p["body"], r"(?m)^rename from (.*)$", 1).alias("old"),
            F.regexp_extract(p["body"], r"(?m)^rename to (.*)$", 1).alias("new"),
        )

    def edit(p: Column) -> Column:
        named = p["at"] > 0
        left = F.when(named, F.trim(p["header"].substr(F.lit(1), p["at"] - 1))).otherwise(F.get(p["words"], F.lit(0)))
        right = F.when(named, F.trim(p["header"].substr(p["at"] + 1, F.length(p["header"])))).otherwise(F.get(p["words"], F.lit(1)))
        return F.struct(
            F.when((p["old"] != "") & ~p["binary"], p["old"]).otherwise(F.regexp_replace(left, "^a/", "")).alias("source"),
            F.when((p["new"] != "") & ~p["binary"], p["new"]).otherwise(F.regexp_replace(right, "^b/", "")).alias("dest"),
            F.when(p["binary"], "").otherwise(p["body"]).alias("content"),
        )

    found = F.filter(F.transform(F.transform(F.transform(parts, cut), marked), edit), lambda e: e["dest"].isNotNull())
    return F.when(is_blank(patch), F.expr("cast(array() as array<struct<source:string,dest:string,content:string>>)")).otherwise(found)


def any_test_file(found: Column) -> Column:
    """Whether an edit of edits() comes from or goes to a test file."""
    return F.exists(found, lambda e: is_test_file(e["source"]) | is_test_file(e["dest"]))


def all_code_free(found: Column) -> Column:
    return F.forall(found, lambda e: is_code_free(e["dest"]))


def touches_tests(patch: Column) -> Column:
    return any_test_file(edits(patch))


def is_non_code_only(patch: Column) -> Column:
    """Whether every file is documentation, automation, dependencies or configuration; true for none."""
    return all_code_free(edits(patch))


def modified_lines(patch: Column) -> Column:
    """Added and removed lines, file headers apart."""
    plus = lambda line: line.startswith("+") & ~line.startswith("+++")
    minus = lambda line: line.startswith("-") & ~line.startswith("---")
    return F.coalesce(F.size(F.filter(F.split(patch, "\r\n|\n|\r"), lambda line: plus(line) | minus(line))), F.lit(0))


def modified_files(patch: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(patch, F.lit(r"diff --git a/.* b/(.*)"), F.lit(1)))


def change_shape(patch: Column) -> Column:
    """Struct (lines, files, funcs) of a diff; funcs counts the functions named behind hunk headers."""
    named = F.regexp_extract_all(patch, F.lit(r"(?m)^@@[^@]*@@.*?\b(?:def|class|function|func|fn)\s+(\w+)"), F.lit(1))
    return F.struct(
        modified_lines(patch).cast("long").alias("lines"),
        F.size(modified_files(patch)).cast("long").alias("files"),
        F.size(F.array_distinct(named)).cast("long").alias("funcs"),
    )


def split_patch(patch: Column) -> Column:
    """Struct (patch, test_patch): files with a test word anywhere in their path go to the second ("latest" is one)."""
    files = F.transform(F.slice(F.split(patch, "diff --git "), 2, 1_000_000), lambda p: F.concat(F.lit("diff --git "), p))
    header = lambda p: F.substring_index(p, "\n", 1)
    return F.struct(
        F.array_join(F.filter(files, lambda p: ~contains_any(header(p), TEST_WORDS)), "").alias("patch"),
        F.array_join(F.filter(files, lambda p: contains_any(header(p), TEST_WORDS)), "").alias("test_patch"),
    )


def test_directive(path: Column) -> Column:
    """A test file as Django's runner names it: without tests/ and .py, dots for slashes."""
    return F.replace(F.regexp_replace(F.regexp_replace(path, r"\.py$", ""), r"^tests/", ""), F.lit("/"), F.lit("."))
