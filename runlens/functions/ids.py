"""Instance, pair and sample ids."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from runlens.schemas import BASE_ID_PATH

# The id alphabet and delimiters.
SEGMENT = "[A-Za-z0-9._-]+"
SEPARATOR = "__"
PAIR_DELIMITER = "__::__"


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def safe_segments(col: Column | str) -> Column:
    return F.forall(F.split(_col(col), SEPARATOR), lambda part: part.rlike(rf"\A{SEGMENT}\z"))


def valid_instance_id(col: Column | str) -> Column:
    """At least two `__`-separated segments, all of the safe alphabet."""
    return (F.size(F.split(_col(col), SEPARATOR)) >= 2) & safe_segments(col)


def valid_test_scope(col: Column | str) -> Column:
    """A non-empty list of non-blank repo-relative paths without `..` segments."""
    fine = F.forall(
        _col(col),
        lambda path: path.rlike(r"\S")
        & ~path.startswith("/")
        & ~F.array_contains(F.split(path, "/"), ".."),
    )
    return F.coalesce((F.size(_col(col)) > 0) & fine, F.lit(False))


def valid_pair_id(col: Column | str) -> Column:
    """Exactly two halves around the delimiter, every segment safe."""
    halves = F.split(_col(col), PAIR_DELIMITER)
    return (F.size(halves) == 2) & F.forall(halves, safe_segments)


def valid_pair(a: str = "instance_id_A", b: str = "instance_id_B", patch_b: str = "patch_B") -> Column:
    """Two different states, the base never on side B."""
    return (F.col(a) != F.col(b)) & F.col(patch_b).isNotNull()


def is_base_by_patch(col: Column | str = "patch") -> Column:
    return _col(col).isNull()


def is_base_by_id(col: Column | str = "instance_id") -> Column:
    """Everything after the two-segment stem is exactly `base`."""
    parts = F.split(_col(col), SEPARATOR)
    return F.slice(parts, 3, F.greatest(F.size(parts), F.lit(1))) == F.array(F.lit("base"))


def base_ref(commit: str = "base_commit", metadata: str = "metadata") -> Column:
    """The commit, or the base id kept in the metadata; null when neither identifies the base."""
    base_id = F.get_json_object(F.col(metadata), BASE_ID_PATH)
    return F.coalesce(F.col(commit), F.nullif(base_id, F.lit("")))


def suffix_of(col: Column | str) -> Column:
    """Segments after the two-segment stem, joined again."""
    parts = F.split(_col(col), SEPARATOR)
    return F.array_join(F.slice(parts, 3, F.greatest(F.size(parts), F.lit(1))), SEPARATOR)


def make_pair_id(a: Column | str, b: Column | str) -> Column:
    return F.concat(_col(a), F.lit(PAIR_DELIMITER), suffix_of(b))


def base_stem(repo: Column | str, commit: Column | str, placeholder_time: Column | str) -> Column:
    """Repository name and short commit, or a placeholder built from the given time."""
    name = F.element_at(F.split(_col(repo), "/"), -1)
    short = F.coalesce(F.substring(F.nullif(_col(commit), F.lit("")), 1, 8), F.concat(F.lit("none_"), _col(placeholder_time)))
    return F.concat(name, F.lit(SEPARATOR), short)


def state_id(stem: Column | str, suffix: Column | str) -> Column:
    return F.concat(_col(stem), F.lit(SEPARATOR), _col(suffix))


def make_sample_id(instance: Column | str, test: Column | str, task: Column | str, side: Column | str) -> Column:
    digest = F.substring(F.sha1(_col(test)), 1, 10)
    return F.concat_ws("::", _col(instance), digest, _col(task), _col(side))


def trailing_number(col: Column | str) -> Column:
    """Digits after the last dash of an id as a number; zero and non-digits give null."""
    tail = F.regexp_extract(_col(col), r"-([0-9]+)\z", 1)
    return F.nullif(tail.try_cast("bigint"), F.lit(0).cast("bigint"))


def stem_from_image(col: Column | str) -> Column:
    """Last path part of an image reference without tag or digest."""
    last = F.substring_index(_col(col), "/", -1)
    return F.substring_index(F.substring_index(last, "@", 1), ":", 1)


def repo_from_text(col: Column | str) -> Column:
    """owner/name of the first clone URL in a build file; null without one."""
    found = F.regexp_extract(_col(col), r"https://github\.com/([^/\s\"']+/[^/\s\"']+)\.git", 1)
    return F.nullif(found, F.lit(""))


def stable_hash(col: Column | str, length: int = 12) -> Column:
    return F.substring(F.sha2(_col(col), 256), 1, length)


def bounded_name(prefix: str, col: Column | str, max_length: int = 63) -> Column:
    """Lower-case dashed name of bounded length, made unique by six hash digits."""
    digest = stable_hash(col, 6)
    dashed = F.regexp_replace(F.lower(F.concat(F.lit(f"{prefix}-"), _col(col))), "[^a-z0-9-]+", "-")
    clean = F.regexp_replace(dashed, "^-+|-+$", "")
    base = F.substring(clean, 1, max_length - 7)
    trimmed = F.regexp_replace(F.concat(base, F.lit("-"), digest), "^-+|-+$", "")
    return F.substring(trimmed, 1, max_length)


# The two spellings of an object-store address.
OBJECT_SCHEME = "gs://"
OBJECT_HTTPS = "https://storage.googleapis.com/"


def normalize_uri(col: Column | str) -> Column:
    """Both spellings to the short scheme; null for any other address."""
    url = _col(col)
    return F.when(
        url.startswith(OBJECT_HTTPS), F.concat(F.lit(OBJECT_SCHEME), F.substring(url, len(OBJECT_HTTPS) + 1, 1 << 30))
    ).when(url.startswith(OBJECT_SCHEME), url)


def result_url(root: Column | str, run: Column | str, instance: Column | str) -> Column:
    """Browser address of one row's result file."""
    base = _col(root)
    https = F.when(
        base.startswith(OBJECT_SCHEME),
        F.concat(F.lit(OBJECT_HTTPS), F.substring(base, len(OBJECT_SCHEME) + 1, 1 << 30)),
    ).otherwise(base)
    return F.concat(
        F.regexp_replace(https, "/+$", ""), F.lit("/"), _col(run), F.lit("/workers/"), _col(instance), F.lit("/result.json")
    )
