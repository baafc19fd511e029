"""Shell command texts: finding and editing the test-runner call."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The runner word, install arguments before it, and the workload file.
RUNNER_WORD = r"(?:^|(?<=\s))(?:\S*/)?pytest(?=\s|$)"
# Possessive, so that any number of arguments is a loop and not a recursion.
INSTALL_TAIL = r"\binstall\s++(?:[-\w=.\[\]]++\s++)*+\z"
WORKLOAD_FILE = "/tmp/test_workload.py"
HEREDOC_START, HEREDOC_END = "<<'PYEOF'\n", "PYEOF\n"
CANONICAL_RUN = "pytest /tmp/test_workload.py -rA -vv --tb=no --junitxml=/results/junit.xml'"


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def command_between(col: Column | str, start: str, end: str) -> Column:
    """Trimmed text between the first line holding `start` and the next one holding `end`."""
    lines = F.split(_col(col), "\r\n|\r|\n")
    first = F.array_position(F.transform(lines, lambda line: line.contains(start)), F.lit(True))
    rest = F.slice(lines, (first + 1).cast("int"), F.size(lines))
    last = F.array_position(F.transform(rest, lambda line: line.contains(end)), F.lit(True))
    body = F.array_join(F.slice(rest, 1, F.greatest(last - 1, F.lit(0)).cast("int")), "\n")
    body = F.regexp_replace(body, r"\A\s+|\s+\z", "")
    return F.when((first > 0) & (last > 0) & (body != ""), body)


def quote(arg: Column) -> Column:
    """POSIX quoting of one argument."""
    quoted = F.concat(F.lit("'"), F.replace(arg, F.lit("'"), F.lit("'\"'\"'")), F.lit("'"))
    return F.when(arg.rlike(r"\A[A-Za-z0-9_@%+=:,./-]+\z"), arg).otherwise(quoted)


def runner_parts(col: Column | str) -> Column:
    """Text up to and including the runner call, and the text after it; null without a call.

    A runner word that is an install argument is not the call.
    """
    command = _col(col)
    words = F.regexp_extract_all(command, F.lit(RUNNER_WORD), 0)
    gaps = F.split(command, RUNNER_WORD)
    # Text before word i: gaps 0..i with the words between them.
    heads = F.transform(
        words,
        lambda word, i: F.concat(
            F.array_join(
                F.transform(
                    F.slice(words, 1, i), lambda w, j: F.concat(F.get(gaps, j), w)
                ),
                "",
            ),
            F.get(gaps, i),
        ),
    )
    calls = F.transform(
        heads,
        lambda head, i: F.when(
            ~head.rlike(INSTALL_TAIL),
            F.struct(
                head.alias("before"),
                F.concat(head, F.get(words, i)).alias("upto"),
                F.substring(command, F.length(head) + F.length(F.get(words, i)) + 1, F.length(command)).alias("after"),
            ),
        ),
    )
    return F.get(F.filter(calls, lambda c: c.isNotNull()), F.lit(0))


def insert_args(col: Column | str, args: Column) -> Column:
    """Quoted arguments right after the runner call; null when the command runs no tests."""
    parts = runner_parts(col)
    quoted = F.array_join(F.transform(args, quote), " ")
    return F.when(
        parts.isNotNull(),
        F.when(quoted == "", _col(col)).otherwise(
            F.concat(parts["upto"], F.lit(" "), quoted, parts["after"])
        ),
    )


def workload_command(command: Column | str, body: Column | str, strip_scopes: list[str]) -> Column:
    """Wrap a workload body as a test file and run it with the original command.

    Scope paths that must not become further collection roots are removed.
    """
    trimmed = F.regexp_replace(_col(body), "\n+\\z", "")
    lines = F.transform(
        F.split(trimmed, "\n"), lambda line: F.when(line == "", line).otherwise(F.concat(F.lit("    "), line))
    )
    file = F.concat(F.lit("def test_workload():\n"), F.array_join(lines, "\n"), F.lit("\n    assert True\n"))
    heredoc = F.concat(F.lit(f"cat > {WORKLOAD_FILE} {HEREDOC_START}"), file, F.lit(HEREDOC_END))
    run = insert_args(command, F.array(F.lit(WORKLOAD_FILE)))
    for scope in strip_scopes:
        bare = scope.rstrip("/").replace(".", r"\.")
        run = F.regexp_replace(run, rf"\s+{bare}/?(?=\s|'|$)", " ")
    return F.concat(heredoc, run)


def generated_command(command: Column | str, file: Column | str) -> Column:
    """Splice a generated workload file in and run the canonical call instead of the original one.

    Null when the command runs no tests or does not end with the closing quote.
    """
    content = F.concat(F.regexp_replace(_col(file), r"\s+\z", ""), F.lit("\n"))
    parts = runner_parts(command)
    spliced = F.concat(
        F.lit(f"cat > {WORKLOAD_FILE} {HEREDOC_START}"), content, F.lit(HEREDOC_END), parts["before"], F.lit(CANONICAL_RUN)
    )
    return F.when(_col(command).endswith("'"), spliced)


def workload_body(col: Column | str) -> Column:
    """Text of the here-document a workload command writes."""
    after = F.substring_index(_col(col), HEREDOC_START, -1)
    return F.when(_col(col).contains(HEREDOC_START), F.substring_index(after, HEREDOC_END, 1))


# Fixed value: the probe for parallel workers.
PROBE = "$(python -c 'import xdist' 2>/dev/null && echo '-n 4 --max-worker-restart=4')"


def adapt_command(commands: DataFrame, rules: DataFrame) -> DataFrame:
    """Repository-specific test commands: replacement, worker flags, probe, scope.

    `rules(repo, override, env_prefix, flags, scope)` holds one row per special repository and is a
    registry the user maintains, so it is small; the planner broadcasts it if it is.
    """
    joined = commands.join(rules, "repo", "left")
    base = F.coalesce("override", "command")
    flagged = F.concat(
        F.coalesce("env_prefix", F.lit("")), F.regexp_replace(base, r"\s-n\s?\S+", ""), F.lit(" "), F.col("flags")
    )
    at = F.instr(base, "pytest ")
    probed = F.when(
        at > 0,
        F.concat(
            F.substring(base, F.lit(1), at + 6), F.lit(f"{PROBE} "), F.substring(base, at + 7, F.length(base))
        ),
    ).otherwise(base)
    run = F.when(F.col("flags").isNotNull(), flagged).when(F.col("override").isNotNull(), base).otherwise(probed)
    bare = F.regexp_replace("scope", "/+$", "")
    scoped = F.when(
        F.coalesce(F.length("scope"), F.lit(0)).cast("boolean") & ~run.contains(bare),
        F.concat(F.rtrim(run), F.lit(" "), F.col("scope")),
    ).otherwise(run)
    return joined.withColumn("adapted", scoped).drop("override", "env_prefix", "flags", "scope")

