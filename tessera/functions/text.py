"""Column functions on text: keyword filters, comments, references, code blocks, versions."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Keyword lists of the performance filter.
PERF_KEYWORDS = [
    "performance", "speedup", "speeds up", "speed-up", "speed up", "faster", "memory", "optimize", "optimization",
    "profiling", "accelerate", "runtime", "efficiency", "benchmark", "latency", "throughput", "multithreading",
    "parallel", "concurrency", "concurrent", "CPU usage", "memory usage", "resource usage", "cache", "caching",
    "timeit", "asv",
]
EXTENDED_KEYWORDS = [
    *PERF_KEYWORDS, "bottleneck", "slow", "overhead", "vectorize", "vectorization", "allocat", "gc", "garbage collect",
    "memoiz", "lazy", "eager", "batch", "bulk", "regression", "time complex", "space complex",
]
WHOLE_WORDS = ["fast"]
VERBATIM_KEYWORDS = ["PERF", "OPTIM"]
NEGATIVE_TITLES = [
    "bump", "pin", "pre-commit", "dependabot", "renovate", "github actions", "ci:", "ci(", "[ci]", "translation",
    "translate", "typo", "docs:", "doc:", "[docs]", "release:", "[release]", "changelog",
]
PERF_LABELS = ["performance", "perf", "optimization", "speed", "benchmark"]
CLOSING_WORDS = ["close", "closes", "closed", "fix", "fixes", "fixed", "resolve", "resolves", "resolved"]
# Patterns that find a version in a source file, in order.
VERSION_PATTERNS = [
    r"""__version__\s*=\s*['"]([^'"]+)['"]""",
    r"""__version__\s*=\s*version\s*=\s*['"]([^'"]+)['"]""",
    r"""\bversion\s*=\s*['"](\d+\.\d+[^'"]*)['"]""",
    r"""VERSION\s*=\s*\(([^)]+)\)""",
    r"""VERSION\s*=\s*['"]([^'"]+)['"]""",
]
# Licences by their texts, in order.
LICENSES = [
    ("MIT", r"(?is)\bMIT License\b|Permission is hereby granted.*MIT"),
    ("MIT-0", r"(?i)\bMIT-0\b|MIT No Attribution"),
    ("Apache-2.0", r"(?is)Apache License.*Version 2\.0|Licensed under the Apache License"),
    ("BSD-3-Clause", r"(?is)BSD 3-Clause|Redistribution and use.*three conditions"),
    ("BSD-2-Clause", r"(?i)BSD 2-Clause|Simplified BSD"),
    ("ISC", r"(?i)\bISC License\b|ISC license"),
]


def any_of(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions, F.lit(False))


def contains_any(text: Column, words: list[str]) -> Column:
    return text.rlike("|".join(re.escape(w) for w in words))


def strip_comments(text: Column) -> Column:
    """Without HTML comments."""
    return F.regexp_replace(text, r"(?s)<!--.*?-->", "")


def strip(text: Column) -> Column:
    """Without white space of any kind at either end (trim() knows spaces only)."""
    return F.regexp_replace(text, r"^\s+|\s+$", "")


def is_blank(text: Column) -> Column:
    return F.coalesce(F.length(strip(text)) == 0, F.lit(True))


def mentions_performance(text: Column, extended: bool = False, verbatim: bool = False) -> Column:
    """Whether the text, comments apart, has a keyword as a substring or a whole word.

    "CPU usage" never matches lower-cased text; it is kept as the lists have it. verbatim also looks for upper-case
    marks in the text as it is, comments included.
    """
    text = F.coalesce(text, F.lit(""))
    low = strip_comments(F.lower(text))
    found = contains_any(low, EXTENDED_KEYWORDS if extended else PERF_KEYWORDS) | any_of([low.rlike(rf"\b{w}\b") for w in WHOLE_WORDS])
    return found | contains_any(text, VERBATIM_KEYWORDS) if verbatim else found


def has_label(labels: Column, values: list[str]) -> Column:
    """Whether a label (array of strings) contains one of the values, case apart."""
    return F.coalesce(F.exists(labels, lambda label: contains_any(F.lower(label), values)), F.lit(False))


def performance_pull(title: Column, body: Column, labels: Column, extended: bool = False) -> Column:
    """A negative title rejects; then a label or a keyword in body or title accepts."""
    negative = contains_any(F.lower(F.coalesce(title, F.lit(""))), NEGATIVE_TITLES)
    said = mentions_performance(body, extended, True) | mentions_performance(title, extended, True)
    return ~negative & (has_label(labels, PERF_LABELS) | said)


def labelled_pull(title: Column, labels: Column, label_values: list[str], title_words: list[str]) -> Column:
    """The stricter filter of repositories with label conventions."""
    low = F.lower(F.coalesce(title, F.lit("")))
    return ~contains_any(low, NEGATIVE_TITLES) & (has_label(labels, label_values) | contains_any(low, title_words))


def resolved_issues(text: Column) -> Column:
    """Issue numbers behind closing words; of one word (as spelt) the last number counts. In order of first mention."""
    clean = strip_comments(F.coalesce(text, F.lit("")))
    words = F.regexp_extract_all(clean, F.lit(r"(\w+)\s+#(\d+)"), F.lit(1))
    numbers = F.regexp_extract_all(clean, F.lit(r"(\w+)\s+#(\d+)"), F.lit(2))
    last = lambda w: F.element_at(F.filter(F.arrays_zip(words.alias("w"), numbers.alias("n")), lambda p: p["w"] == w), -1)["n"]
    return F.transform(F.filter(F.array_distinct(words), lambda w: F.lower(w).isin(CLOSING_WORDS)), last)


def first_code_block(text: Column) -> Column:
    """The first fenced block, stripped; null without one."""
    pattern = r"(?s)```[^\n]*\n(.*?)```"
    return F.when(text.rlike(pattern), strip(F.regexp_extract(text, pattern, 1)))


def code_blocks(text: Column) -> Column:
    """All fenced blocks but those marked `suggestion`."""
    kinds = F.regexp_extract_all(text, F.lit(r"(?s)```([^\n]*)\n(.*?)```"), F.lit(1))
    blocks = F.regexp_extract_all(text, F.lit(r"(?s)```([^\n]*)\n(.*?)```"), F.lit(2))
    pairs = F.filter(F.arrays_zip(kinds.alias("k"), blocks.alias("b")), lambda p: F.trim(p["k"]) != "suggestion")
    return F.transform(pairs, lambda p: p["b"])


def first_json_object(text: Column) -> Column:
    """From the first brace to the last, null without."""
    return F.nullif(F.regexp_extract(text, r"(?s)\{.*\}", 0), F.lit(""))


def between(text: Column, start: str, end: str) -> Column:
    """What stands between two marks, stripped; null without them."""
    pattern = rf"(?s){start}(.*?){end}"
    return F.when(text.rlike(pattern), strip(F.regexp_extract(text, pattern, 1)))


def find_version(text: Column) -> Column:
    """The first pattern's version in a source text without docstrings; null if none."""
    clean = F.regexp_replace(text, r'(?s)""".*?"""', "")
    found = [F.when(clean.rlike(p), F.regexp_extract(clean, p, 1)) for p in VERSION_PATTERNS]
    return F.regexp_replace(F.coalesce(*found), " ", "")


def major_minor(version: Column) -> Column:
    """First two parts (split by dots, then commas), digits and dots only."""
    dots = F.when(version.contains("."), F.substring_index(version, ".", 2)).otherwise(version)
    commas = F.when(dots.contains(","), F.substring_index(dots, ",", 2)).otherwise(dots)
    return F.regexp_replace(commas, r"[^0-9.]", "")


def packed_version(raw: Column) -> Column:
    """C++ form: major.minor, packed integers (120101 is 12.1) unpacked; null if nothing is left."""
    text = F.regexp_replace(F.regexp_replace(strip(raw), r"(?s)\(.*$", ""), r"[^0-9.]", "")
    clean = F.regexp_replace(text, r"^\.+|\.+$", "")
    packed = clean.rlike(r"^\d{5,6}$")
    n = clean.try_cast("long")
    unpacked = F.concat_ws(".", F.floor(n / 10000).cast("string"), F.floor(F.pmod(F.floor(n / 100), F.lit(100))).cast("string"))
    return F.when(clean == "", None).when(packed, unpacked).otherwise(F.substring_index(clean, ".", 2))


def full_version(raw: Column) -> Column:
    """TypeScript form: the whole version without a leading v; null if blank."""
    return F.nullif(strip(F.regexp_replace(strip(raw), r"^[vV]", "")), F.lit(""))


# fixed values: what a Python requirement looks like, and the version where there is none
LOWEST_PYTHON, EXACT_PYTHON, ANY_PYTHON = r">=?\s*(\d+\.\d+)", r"==\s*(\d+\.\d+)", "3.10"


def min_python(spec: Column) -> Column:
    """The version of the first >= or >, else of ==, else ANY_PYTHON."""
    lower = F.nullif(F.regexp_extract(spec, LOWEST_PYTHON, 1), F.lit(""))
    exact = F.nullif(F.regexp_extract(spec, EXACT_PYTHON, 1), F.lit(""))
    return F.coalesce(lower, exact, F.lit(ANY_PYTHON))


def license_of(text: Column) -> Column:
    out = F.lit(None).cast("string")
    for name, pattern in reversed(LICENSES):
        out = F.when(text.rlike(pattern), F.lit(name)).otherwise(out)
    return out


def instance_id(full_name: Column, number: Column) -> Column:
    return F.replace(F.concat(full_name, F.lit("-"), number.cast("string")), F.lit("/"), F.lit("__"))


def split_instance_id(column: Column) -> Column:
    """Struct (owner, name, number) of owner__name-number."""
    part = lambda i: F.regexp_extract(column, r"^(.*?)__(.*)-(\d+)$", i)
    return F.struct(part(1).alias("owner"), part(2).alias("name"), part(3).try_cast("long").alias("number"))


def last_two_components(path: Column) -> Column:
    return F.substring_index(path, "/", -2)
