"""Running tests and audits: fused counts, failure samples, result logs."""

from __future__ import annotations

import functools
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import scalar as S
from ..operators.windows import top_n
from ..sources.partitioned import written
from ..sources.tables import literal_rows
from .audits import Audit, Models, RowAudit, registry

SAMPLE_ROWS = 50


@dataclass
class RowTest:
    """A row-wise test: rows for which ``fails`` holds."""

    name: str
    fails: Column


def fused_row_tests(df: DataFrame, tests: Sequence[RowTest], where: Column | None = None) -> DataFrame:
    """Failure counts of many row tests of one table from a single scan."""
    rows = df if where is None else df.where(where)
    counts = [F.struct(F.lit(t.name).alias("test_name"), F.count_if(t.fails).alias("failure_count"), F.count(F.lit(1)).alias("rows_tested")) for t in tests]
    return rows.agg(F.array(*counts).alias("t")).select(F.inline("t"))


def not_null_test(column: str) -> RowTest:
    return RowTest(f"not_null_{column}", F.col(column).isNull())


def range_test(column: str, lo: float | None = None, hi: float | None = None) -> RowTest:
    bad = F.lit(False)
    if lo is not None:
        bad = bad | (F.col(column) < lo)
    if hi is not None:
        bad = bad | (F.col(column) > hi)
    return RowTest(f"accepted_range_{column}", bad)


def values_test(column: str, values: Sequence) -> RowTest:
    return RowTest(f"accepted_values_{column}", ~F.col(column).isin(*values))


def expression_test(name: str, expression: str) -> RowTest:
    return RowTest(name, ~F.expr(expression))


def test_result(name: str, failing: DataFrame, severity: str = "error", fail_calc: Column | None = None, error_if: int = 1) -> DataFrame:
    """One result row: failures (row count unless ``fail_calc``), severity and status."""
    calc = F.count(F.lit(1)) if fail_calc is None else F.coalesce(fail_calc, F.lit(0))
    status = F.when(F.col("failures") < error_if, "pass").otherwise("fail" if severity == "error" else "warn")
    return failing.agg(calc.cast("long").alias("failures")).select(F.lit(name).alias("test_name"), F.lit(severity).alias("severity"), "failures", status.alias("status"))


def _percent(failures: Column, total: Column) -> Column:
    return F.when(total > 0, (total - failures) * 100.0 / total).otherwise(F.lit(100.0))


def runnable(models: Models, only: Sequence[str] | None = None) -> list:
    """Audits of the registry whose tables are all there."""
    known = registry()
    names = list(only) if only else list(known)
    return [known[n] for n in names if all(t in models for t in known[n].needs)]


def _texts(columns: Sequence[str]) -> Column:
    """The values of some columns as texts, in their order."""
    return F.array(*[F.col(f"`{c}`").cast("string") for c in columns])


def _columns(a: Audit | RowAudit, models: Models) -> list[str]:
    """Columns of an audit's failing rows."""
    if isinstance(a, RowAudit):
        return [*[k for k in a.keep if k in models[a.table].columns], a.label]
    return a.failing(models).columns


def _row_audit_parts(df: DataFrame, audits: Sequence[RowAudit], samples: bool) -> DataFrame:
    """One scan of a table for all its row audits: failing rows by audit, and numbers of rows by the set of audits they belong to."""
    none = F.lit(None).cast("array<string>")

    def failing(a: RowAudit) -> Column:
        keep = [k for k in a.keep if k in df.columns]
        values = F.array(*[F.col(f"`{k}`").cast("string") for k in keep], S.violations(a.checks)) if samples else none
        return F.when(a.fails(), F.struct(F.lit(a.name).alias("audit"), F.lit(0).cast("long").alias("within"), values.alias("values")))

    bits = F.lit(0).cast("long")
    for i, a in enumerate(audits):
        bits = bits + F.when(a.inside(), F.lit(1 << i)).otherwise(F.lit(0)).cast("long")
    member = F.struct(F.lit(None).cast("string").alias("audit"), bits.alias("within"), none.alias("values"))
    found = F.filter(F.array(member, *[failing(a) for a in audits]), lambda x: x.isNotNull())
    rows = df.select(F.inline(found)).groupBy("audit", "within", "values").agg(F.count(F.lit(1)).alias("n"))
    return rows.select(F.lit(audits[0].table).alias("table"), "*")


def _table_audit_parts(a: Audit, models: Models, samples: bool) -> DataFrame:
    """Failing rows and population of an audit over groups or several tables, each computed once."""
    head = [F.lit(a.table).alias("table"), F.lit(a.name).alias("audit")]
    bad = a.failing(models)
    values = _texts(bad.columns) if samples else F.lit(None).cast("array<string>")
    failing = bad.select(values.alias("values")).groupBy("values").agg(F.count(F.lit(1)).alias("n"))
    whole = a.population(models).agg(F.count(F.lit(1)).alias("n"))
    kind = lambda k: F.lit(k).cast("long").alias("within")
    return failing.select(*head, kind(0), "values", "n").unionByName(whole.select(*head, kind(-1), F.lit(None).cast("array<string>").alias("values"), "n"))


def run_audits(models: Models, only: Sequence[str] | None = None, samples: bool = True) -> DataFrame:
    """One result row per audit; audits with a missing table are skipped.

    All row audits of a table are told in one scan of it, samples included: a row gives one
    count for the set of audits it belongs to and one narrow row for each audit it fails,
    and equal ones are added up before they are shuffled. What comes out is stored under the
    checkpoint folder; counts and samples (the first rows by their values, at most
    ``SAMPLE_ROWS``, chosen before the shuffle) are read from there. Pass stored tables, so
    that the scans read files rather than recompute models.
    """
    chosen = runnable(models, only)
    by_table: dict[str, list[RowAudit]] = {}
    for a in chosen:
        if isinstance(a, RowAudit):
            by_table.setdefault(a.table, []).append(a)
    parts = [_row_audit_parts(models[t], audits, samples) for t, audits in by_table.items()]
    parts += [_table_audit_parts(a, models, samples) for a in chosen if not isinstance(a, RowAudit)]
    work = written(functools.reduce(DataFrame.unionByName, parts), "audit-rows")

    names = [F.when((F.col("table") == t) & (F.col("within").bitwiseAND(F.lit(1 << i)) != 0), F.lit(a.name)) for t, audits in by_table.items() for i, a in enumerate(audits)]
    members = work.where("audit is null").groupBy("table", "within").agg(F.sum("n").alias("n"))
    totals = work.where("audit is not null and within = -1").select(F.col("audit").alias("t_audit"), F.col("n").alias("total"))
    if names:
        each = members.select(F.explode(F.filter(F.array(*names), lambda x: x.isNotNull())).alias("t_audit"), "n")
        totals = totals.unionByName(each.groupBy("t_audit").agg(F.sum("n").alias("total")))
    failing = work.where("audit is not null and within = 0")
    counts = failing.groupBy(F.col("audit").alias("f_audit")).agg(F.sum("n").alias("failures"))

    known = [(a.table, f"{a.table} :: {a.name}", a.name, a.kind) for a in chosen]
    out = literal_rows(work.sparkSession, known, "table_name string, model_name string, test_name string, test_type string")
    out = out.join(counts, F.col("test_name") == F.col("f_audit"), "left").join(totals, F.col("test_name") == F.col("t_audit"), "left")
    out = out.withColumns({"failure_count": F.coalesce("failures", F.lit(0)).cast("long"), "rows_compared": F.coalesce("total", F.lit(0)).cast("long")})
    sample = F.lit(None).cast("string")
    if samples:
        out = out.join(_samples(failing, {a.name: _columns(a, models) for a in chosen}), F.col("test_name") == F.col("s_audit"), "left")
        sample = F.coalesce("sample", F.lit("[]"))
    percent = _percent(F.col("failure_count"), F.col("rows_compared"))
    return out.select("table_name", "model_name", "test_name", "test_type", "failure_count", "rows_compared", percent.alias("perfect_match_pct"), sample.alias("sample_json"))


def _samples(failing: DataFrame, columns: dict[str, list[str]]) -> DataFrame:
    """(s_audit, sample): the first failing rows of each audit as JSON."""
    first = top_n(failing, ["audit"], [F.col("values")], SAMPLE_ROWS)
    again = F.transform(F.sort_array(F.collect_list(F.struct("values", "n"))), lambda x: F.array_repeat(x["values"], F.least(x["n"], F.lit(SAMPLE_ROWS)).cast("int")))
    held = first.groupBy(F.col("audit").alias("s_audit")).agg(F.slice(F.flatten(again), 1, SAMPLE_ROWS).alias("rows"))

    def json(names: list[str]) -> Column:
        return F.to_json(F.transform("rows", lambda v: F.struct(*[v[i].alias(n) for i, n in enumerate(names)])))

    return held.select("s_audit", F.coalesce(*[F.when(F.col("s_audit") == a, json(names)) for a, names in columns.items()]).alias("sample"))


def audit_log_rows(results: DataFrame) -> DataFrame:
    """Audit results in the shape of the audit log."""
    return results.select(
        "model_name",
        F.concat_ws(" - ", "test_type", "table_name").alias("baseline_description"),
        F.current_timestamp().alias("run_at"),
        "rows_compared",
        F.lit(None).cast("int").alias("columns_compared"),
        "perfect_match_pct",
        F.col("failure_count").alias("conflicting_values"),
        F.lit(None).cast("long").alias("missing_from_a"),
        F.lit(None).cast("long").alias("missing_from_b"),
    )
