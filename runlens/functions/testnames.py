"""Test ids and statuses from report attributes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def _last(parts: Column, start: Column) -> Column:
    return F.slice(parts, start, F.greatest(F.size(parts), F.lit(1)))


def node_id(file: Column | str, classname: Column | str, name: Column | str) -> Column:
    """Path, class chain and test name joined by `::`.

    Without a file attribute the dotted class name is cut at its first capitalized segment.
    """
    file, classname, name = (F.coalesce(_col(c), F.lit("")) for c in (file, classname, name))
    parts = F.split(classname, r"\.")
    capital = F.array_position(F.transform(parts, lambda p: p.rlike(r"\A\p{Lu}")), F.lit(True)).cast("int")
    modules = F.when(capital > 0, F.slice(parts, 1, F.greatest(capital - 1, F.lit(0)))).otherwise(parts)
    classes = F.when(capital > 0, _last(parts, F.greatest(capital, F.lit(1)))).otherwise(F.slice(parts, 1, 0))
    guessed = F.when(F.size(modules) > 0, F.concat(F.array_join(modules, "/"), F.lit(".py"))).otherwise("")
    dotted = F.replace(F.regexp_replace(file, r"\.py\z", ""), F.lit("/"), F.lit("."))
    lead = F.concat(dotted, F.lit("."))
    stated = (
        F.when((classname == "") | (classname == dotted), "")
        .when(
            classname.startswith(lead),
            F.replace(F.substring(classname, F.length(lead) + 1, F.length(classname)), F.lit("."), F.lit("::")),
        )
        .otherwise(classname)
    )
    path = F.when(file == "", guessed).otherwise(file)
    chain = F.when(file == "", F.array_join(classes, "::")).otherwise(stated)
    return F.when(chain == "", F.concat_ws("::", path, name)).otherwise(F.concat_ws("::", path, chain, name))


def with_case_status(cases: DataFrame) -> DataFrame:
    """Kind, test id and status of each testcase row.

    kind: `test`, `discovery` for a module that failed collection, `malformed` for a case without the
    attributes a test needs. A skipped module counts as a skipped test of its path.
    """
    classname, name = F.col("_classname"), F.col("_name")
    no_class = F.coalesce(classname, F.lit("")) == ""
    module_skip = no_class & F.col("skipped").isNotNull()
    collection = ~module_skip & no_class & F.col("error").isNotNull()
    kind = (
        F.when(collection, "discovery")
        .when(~module_skip & (classname.isNull() | name.isNull()), "malformed")
        .otherwise("test")
    )
    blank = F.coalesce(name, F.lit(""))
    test = F.when(module_skip, F.concat(F.replace(blank, F.lit("."), F.lit("/")), F.lit(".py"))).when(
        ~collection, node_id("_file", "_classname", "_name")
    )
    status = (
        F.when(module_skip, "SKIPPED")
        .when(F.col("failure").isNotNull(), "FAILED")
        .when(F.col("error").isNotNull(), "ERROR")
        .when(F.col("skipped").isNotNull(), "SKIPPED")
        .otherwise("PASSED")
    )
    return cases.select(
        "*",
        kind.alias("kind"),
        F.when(kind == "test", test).alias("test"),
        F.when(kind == "test", status).alias("status"),
        F.when(kind == "discovery", blank).alias("module"),
    )


def flag_status(passed: Column, failed: Column, runtime: Column, timeout: Column, memory: Column) -> Column:
    """Status of one case from its five flags."""
    return (
        F.when(runtime | timeout | memory, "ERROR").when(failed, "FAILED").when(passed, "PASSED").otherwise("SKIPPED")
    )


def prefix_path(col: Column | str, prefix: str) -> Column:
    return F.when(_col(col).startswith(prefix), _col(col)).otherwise(F.concat(F.lit(prefix), _col(col)))


def test_func_name(col: Column | str) -> Column:
    """Function name of `path::Class::name[x]`, `name (module.Class)` or a bare name."""
    test = _col(col)
    tail = (
        F.when(test.contains("::"), F.substring_index(test, "::", -1))
        .when(test.contains("("), F.substring_index(test, " (", 1))
        .otherwise(test)
    )
    return F.substring_index(tail, "[", 1)


def test_files(tests: DataFrame, files: DataFrame, keys: list[str]) -> DataFrame:
    """File of each test id: the path before `::`, or the module of the dotted form.

    A dotted module may live under `tests/` or at the root; the first that exists among `files(keys,
    file)` wins, else the one under `tests/` stands as a hint. Other ids have no file (empty).
    """
    dotted = F.regexp_extract("test", r"\A\S+\s+\(([\w.]+)\)\s*\z", 1)
    parts = F.split(dotted, r"\.")
    last = F.element_at(parts, -1)
    kept = F.when((F.size(parts) > 1) & last.rlike(r"\A\p{Lu}"), F.slice(parts, 1, F.greatest(F.size(parts) - 1, F.lit(1))))
    module = F.concat(F.array_join(F.coalesce(kept, parts), "/"), F.lit(".py"))
    named = tests.withColumn("_module", F.when(dotted != "", module))
    known = files.select(*keys, F.col("file").alias("_file"), F.lit(True).alias("_known")).distinct()
    for flag, path in (("_below", F.concat(F.lit("tests/"), "_module")), ("_root", F.col("_module"))):
        named = named.withColumn("_file", path).join(
            known.withColumnRenamed("_known", flag), [*keys, "_file"], "left"
        ).drop("_file")
    path = (
        F.when(F.col("test").contains("::"), F.substring_index("test", "::", 1))
        .when(F.col("_module").isNull(), "")
        .when(F.col("_below"), F.concat(F.lit("tests/"), "_module"))
        .when(F.col("_root"), F.col("_module"))
        .otherwise(F.concat(F.lit("tests/"), "_module"))
    )
    return named.withColumn("test_file", path).drop("_module", "_below", "_root")
