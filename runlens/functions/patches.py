"""Unified-diff texts as column expressions, always over the whole patch."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Where tests live, and the paths a tree comparison is mounted at.
TEST_PATH = r"(?:^|/)tests?/|(?:^|/)test_[^/]+\.py$|(?:^|/)[^/]+_test\.py$|(?:^|/)conftest\.py$"
OLD_MOUNT, NEW_MOUNT = "golden_app", "testbed"
DEFAULT_SCOPE = "tests/"


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def sections(col: Column | str) -> Column:
    """The patch cut before every `diff --git` line; blank pieces dropped."""
    return F.filter(F.split(_col(col), r"(?m)(?=^diff --git )"), lambda s: s != "")


def _ended(text: Column) -> Column:
    return F.when(text.endswith("\n") | (text == ""), text).otherwise(F.concat(text, F.lit("\n")))


def normalize_patch(col: Column | str) -> Column:
    """Drop entries named by a timestamp and restore the final newline."""
    kept = F.filter(sections(col), lambda s: ~s.rlike(r"\Adiff --git a/\d{4}-\d{2}-\d{2} "))
    return _ended(F.array_join(kept, ""))


def _header_path(section: Column, group: int) -> Column:
    return F.regexp_extract(section, r"(?m)^diff --git a/(.+?) b/(.+?)$", group)


def filter_test_sections(col: Column | str) -> Column:
    """Drop sections whose old or new path is a test file."""

    def is_source(section: Column) -> Column:
        touched = _header_path(section, 1).rlike(TEST_PATH) | _header_path(section, 2).rlike(TEST_PATH)
        return section.rlike(r"\S") & ~touched

    return F.array_join(F.filter(sections(col), is_source), "")


def normalize_paths(col: Column | str, old: str = OLD_MOUNT, new: str = NEW_MOUNT) -> Column:
    """Mount-prefixed paths to repo-relative ones.

    Sections without both file lines cannot be applied and are dropped, as are those of `.git`.
    """

    def applies(section: Column) -> Column:
        return section.rlike(r"(?m)^--- ") & section.rlike(r"(?m)^\+\+\+ ")

    def strip(section: Column) -> Column:
        section = F.regexp_replace(
            section, rf"(?m)^diff --git a/(?:{old}/)?(.+?) b/(?:{new}/)?(.+?)$", "diff --git a/$1 b/$2"
        )
        for lead, mount in (("--- a/", old), (r"\+\+\+ b/", new), ("rename from ", old), ("rename to ", new)):
            plain = lead.replace("\\", "")
            section = F.regexp_replace(section, rf"(?m)^{lead}(?:{mount}/)?(.*?)[^\S\n]*$", f"{plain}$1")
        return section

    def outside_git(section: Column) -> Column:
        return ~_header_path(section, 1).rlike(r"\A\.git(/|\z)") & ~_header_path(section, 2).rlike(r"\A\.git(/|\z)")

    kept = F.filter(F.transform(F.filter(sections(col), applies), strip), outside_git)
    return F.array_join(kept, "")


def concat_patches(*cols: Column | str) -> Column:
    """Patches one after another, each newline-terminated; null when none is left."""
    parts = F.array_compact(F.array(*[F.nullif(_col(c), F.lit("")) for c in cols]))
    return F.when(F.size(parts) > 0, F.array_join(F.transform(parts, _ended), ""))


def scope_from_patch(col: Column | str) -> Column:
    """Paths a patch touches, sorted; the default scope when there are none."""
    lines = F.regexp_extract_all(_col(col), F.lit(r"(?m)^(?:--- a/|\+\+\+ b/)(.*)$"), 1)
    paths = F.filter(F.transform(lines, F.trim), lambda p: p != "/dev/null")
    found = F.array_sort(F.array_distinct(paths))
    return F.when(F.size(found) > 0, found).otherwise(F.array(F.lit(DEFAULT_SCOPE)))


def patch_dirs(*cols: Column | str) -> Column:
    """Top-level directories touched by any of the patches; a root file stands for itself."""
    paths = F.concat(
        *[F.regexp_extract_all(F.coalesce(_col(c), F.lit("")), F.lit(r"(?m)^diff --git a/(\S+) b/\S+"), 1) for c in cols]
    )
    tops = F.transform(paths, lambda p: F.substring_index(p, "/", 1))
    return F.array_sort(F.array_distinct(F.filter(tops, lambda t: t != "")))


def patch_parent_dirs(col: Column | str) -> Column:
    """Parent directories of the files on the file lines."""
    files = F.regexp_extract_all(_col(col), F.lit(r"(?m)^(?:---|\+\+\+) [ab]/(.+)$"), 1)
    parents = F.transform(
        F.filter(files, lambda f: (f != "/dev/null") & f.contains("/")),
        lambda f: F.regexp_replace(f, "/+[^/]*$", ""),
    )
    return F.array_sort(F.array_distinct(F.filter(parents, lambda p: p != "")))


def patch_touches_scope(patch: Column | str, scope: Column | str) -> Column:
    """Does either path of any section equal a scope entry or lie below it?"""
    pattern = F.lit(r"(?m)^diff --git a/(.+) b/(.+)$")
    paths = F.array_distinct(
        F.concat(F.regexp_extract_all(_col(patch), pattern, 1), F.regexp_extract_all(_col(patch), pattern, 2))
    )
    entries = F.transform(_col(scope), lambda e: F.regexp_replace(e, "/+$", ""))
    return F.exists(
        paths, lambda p: F.exists(entries, lambda e: (p == e) | p.startswith(F.concat(e, F.lit("/"))))
    )


def diff_fingerprint(col: Column | str) -> Column:
    """Equal for patches with the same content change.

    Line offsets, blob ids, whitespace and the order of the files do not matter.
    """

    def counts(line: Column) -> Column:
        return ~line.startswith("index ") & ~line.startswith("@@ ") & ~line.startswith("\\ ")

    def clean(section: Column) -> Column:
        body = F.array_join(F.filter(F.split(section, "\n"), counts), "")
        return F.sha2(F.regexp_replace(body, r"\s+", ""), 256)

    digests = F.array_sort(F.transform(sections(col), clean))
    return F.when(_col(col).rlike(r"\S"), F.sha2(F.array_join(digests, ""), 256))


def heredoc_patch(col: Column | str) -> Column:
    """Body of the quoted here-document a script applies as a patch; empty without one."""
    return F.regexp_extract(_col(col), r"(?s)git apply[^\n]*<<'(EOF_\d+)'\n(.*?)\n\1", 2)
