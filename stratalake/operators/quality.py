"""Data-quality constraints evaluated as ordinary DataFrame aggregations.

A :class:`Check` is a named list of constraints. :func:`verify` turns any number
of checks over one DataFrame into a *report* DataFrame with one row per
constraint::

    check, check_level, check_status, constraint, constraint_status,
    constraint_message, metric

Execution plan:

* every completeness / data-type / compliance metric of all checks is one
  aggregate expression of a **single** ``df.agg(...)`` (one scan, map-side
  partial aggregation, a one-row result);
* every uniqueness constraint is one ``groupBy(columns).count()`` followed by a
  global aggregate; a hot value is pre-aggregated map-side before the shuffle;
* when there are both, the scan metrics ride along the first uniqueness
  ``groupBy`` as per-group partial sums, so the input is read once;
* the metric rows are unioned; when every assertion is expressible as a Column
  (the default "metric == 1", or :func:`at_least` / :func:`between` / ...) the
  report stays lazy. A Python callable assertion makes ``verify`` collect the
  metric rows (one per constraint, never data rows) and decide on the driver.

Metric conventions: a ratio over zero rows is NULL (``try_divide``) and a NULL
metric is a Failure. Completeness = non-NULL / rows. Uniqueness = values that
occur exactly once / rows whose key is not entirely NULL. Size = rows. Data type = share of
non-NULL values in the wanted class (0 when every value is NULL). Compliance =
rows whose predicate is TRUE / rows (NULL counts as not compliant unless
``nulls="pass"``).
"""

from __future__ import annotations

import logging
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .._cols import require_columns

log = logging.getLogger(__name__)

# ---------------------------------------------------------------------------
# Fixed values.
# Text classes for string columns, tested in this order, first match wins
# (a NULL value is class "Null"; anything unmatched is "String"). Patterns are
# matched against the whole value (\z: a trailing line feed is not passed over).
#   Fractional  ^(-|\+| )?\d*\.\d*\z
#   Integral    ^(-|\+| )?\d*\z
#   Boolean     ^(true|false)\z
# Report wording: statuses "Success" / "Failure"; check levels "Error" /
# "Warning"; failure messages below.
# ---------------------------------------------------------------------------
FRACTIONAL_PATTERN = r"^(-|\+| )?\d*\.\d*\z"
INTEGRAL_PATTERN = r"^(-|\+| )?\d*\z"
BOOLEAN_PATTERN = r"^(true|false)\z"
TYPE_CLASSES = ("Null", "Fractional", "Integral", "Boolean", "String")
DATA_TYPES = {
    "String": ("String",),
    "Numeric": ("Integral", "Fractional"),
    "Integral": ("Integral",),
    "Fractional": ("Fractional",),
    "Boolean": ("Boolean",),
}
LEVELS = ("Error", "Warning")
SUCCESS, FAILURE = "Success", "Failure"
MSG_FAILED = "Value does not meet the constraint requirement!"
MSG_EMPTY = "Empty state: the metric could not be computed."

REPORT_SCHEMA = T.StructType(
    [
        T.StructField("check", T.StringType()),
        T.StructField("check_level", T.StringType()),
        T.StructField("check_status", T.StringType()),
        T.StructField("constraint", T.StringType()),
        T.StructField("constraint_status", T.StringType()),
        T.StructField("constraint_message", T.StringType()),
        T.StructField("metric", T.DoubleType()),
    ]
)


# ---------------------------------------------------------------------------
# Assertions
# ---------------------------------------------------------------------------
@dataclass(frozen=True)
class Bound:
    """A Column-expressible assertion on the metric: ``lo <= metric <= hi``."""

    lo: float | None = None
    hi: float | None = None
    label: str = ""

    def column(self, m: Column) -> Column:
        cond = F.lit(True)
        if self.lo is not None:
            cond = cond & (m >= F.lit(float(self.lo)))
        if self.hi is not None:
            cond = cond & (m <= F.lit(float(self.hi)))
        return cond

    def __call__(self, value: float) -> bool:
        if self.lo is not None and not value >= self.lo:
            return False
        if self.hi is not None and not value <= self.hi:
            return False
        return True


def is_one() -> Bound:
    return Bound(1.0, 1.0, "== 1.0")


def at_least(x: float) -> Bound:
    return Bound(x, None, f">= {x}")


def at_most(x: float) -> Bound:
    return Bound(None, x, f"<= {x}")


def between(lo: float, hi: float) -> Bound:
    return Bound(lo, hi, f"in [{lo}, {hi}]")


@dataclass(frozen=True)
class Recent:
    """An assertion that looks back: between ``lo`` and ``hi`` times the mean of the metric
    in the last ``last`` published versions.

    Only where reports are kept (``publish(reports=...)``), which puts a :class:`Bound` in
    its place. Versions in which the metric was missing do not count; with fewer than
    ``least`` that do, any metric passes.
    """

    lo: float | None = None
    hi: float | None = None
    last: int = 3
    least: int = 1

    def __post_init__(self):
        if self.last < 1 or self.least < 1:
            raise ValueError("last and least must be at least 1")

    def bound(self, mean: float | None, versions: int) -> Bound:
        if mean is None or versions < self.least:
            return Bound(None, None, "too few versions to compare with")
        ends = [None if x is None else x * mean for x in (self.lo, self.hi)]
        # of a negative mean the smaller multiple is the upper end
        lo, hi = ends if mean >= 0 else reversed(ends)
        return Bound(lo, hi, f"in [{lo}, {hi}], by {versions} versions")

    def __call__(self, value: float) -> bool:
        raise ValueError("an assertion on recent versions needs kept reports: publish(..., reports=...)")


Assertion = Bound | Recent | Callable[[float], bool]


# ---------------------------------------------------------------------------
# Constraints and checks
# ---------------------------------------------------------------------------
@dataclass(frozen=True)
class Constraint:
    kind: str  # size | completeness | uniqueness | datatype | compliance
    columns: tuple[str, ...]
    name: str
    assertion: Assertion = field(default_factory=is_one)
    data_type: str | None = None
    predicate: str | None = None
    nulls: str = "fail"

    @property
    def lazy(self) -> bool:
        return isinstance(self.assertion, Bound)


@dataclass(frozen=True)
class Check:
    """Named, levelled list of constraints. Builder methods return a new Check."""

    name: str
    level: str = "Error"
    constraints: tuple[Constraint, ...] = ()

    def __post_init__(self):
        if self.level not in LEVELS:
            raise ValueError(f"level must be one of {LEVELS}")

    def _add(self, c: Constraint) -> Check:
        return replace(self, constraints=(*self.constraints, c))

    def has_size(self, assertion: Assertion) -> Check:
        """An assertion on the number of rows."""
        return self._add(Constraint("size", (), "Size(*)", assertion))

    def is_complete(self, column: str, assertion: Assertion | None = None) -> Check:
        return self._add(
            Constraint("completeness", (column,), f"Completeness({column})",
                       assertion or is_one())
        )

    def is_unique(self, *columns: str, assertion: Assertion | None = None) -> Check:
        if not columns:
            raise ValueError("is_unique needs at least one column")
        return self._add(
            Constraint("uniqueness", tuple(columns),
                       f"Uniqueness({','.join(columns)})", assertion or is_one())
        )

    def has_data_type(
        self, column: str, data_type: str, assertion: Assertion | None = None
    ) -> Check:
        if data_type not in DATA_TYPES:
            raise ValueError(f"data_type must be one of {sorted(DATA_TYPES)}")
        return self._add(
            Constraint("datatype", (column,), f"DataType({column},{data_type})",
                       assertion or is_one(), data_type=data_type)
        )

    def satisfies(
        self,
        predicate: str,
        name: str,
        assertion: Assertion | None = None,
        nulls: str = "fail",
    ) -> Check:
        if nulls not in ("fail", "pass"):
            raise ValueError("nulls must be 'fail' or 'pass'")
        return self._add(
            Constraint("compliance", (), f"Compliance({name})", assertion or is_one(),
                       predicate=predicate, nulls=nulls)
        )


# ---------------------------------------------------------------------------
# Metric expressions
# ---------------------------------------------------------------------------
def _ratio(num: Column, den: Column) -> Column:
    return F.try_divide(num.cast("double"), den.cast("double"))


def text_class(c: Column) -> Column:
    """Class of a string value (see the fixed patterns above)."""
    return (
        F.when(c.isNull(), F.lit("Null"))
        .when(c.rlike(FRACTIONAL_PATTERN), F.lit("Fractional"))
        .when(c.rlike(INTEGRAL_PATTERN), F.lit("Integral"))
        .when(c.rlike(BOOLEAN_PATTERN), F.lit("Boolean"))
        .otherwise(F.lit("String"))
    )


def value_class(df: DataFrame, column: str) -> Column:
    """Class of each value of ``column``.

    String columns are classed by their text. Typed columns are classed by
    their Spark type (a double never becomes "String" because its text form
    is ``1.0E7``); other types fall back to the text of the value.
    """
    dt = df.schema[column].dataType
    c = F.col(column)
    if isinstance(dt, T.StringType):
        return text_class(c)
    if isinstance(dt, T.IntegralType):
        fixed = "Integral"
    elif isinstance(dt, T.FractionalType):
        fixed = "Fractional"
    elif isinstance(dt, T.BooleanType):
        fixed = "Boolean"
    else:
        return text_class(c.cast("string"))
    return F.when(c.isNull(), F.lit("Null")).otherwise(F.lit(fixed))


CLASS_PREFIX = "__dq_class_"


def _class_columns(df: DataFrame, entries) -> dict[str, Column]:
    """One class column per column that has a data-type constraint.

    Projecting the class once per row lets every data-type metric on that
    column (and every histogram bucket) reuse it instead of re-running the
    regex chain per aggregate expression.
    """
    cols = sorted({c.columns[0] for _, c in entries if c.kind == "datatype"})
    return {f"{CLASS_PREFIX}{n}": value_class(df, col) for n, col in enumerate(cols)}


def _class_name(entries, column: str) -> str:
    cols = sorted({c.columns[0] for _, c in entries if c.kind == "datatype"})
    return f"{CLASS_PREFIX}{cols.index(column)}"


def _scan_metric(df: DataFrame, c: Constraint, cls: str | None = None) -> Column:
    """Aggregate expression of a scan-shareable constraint.

    ``cls`` names a pre-projected class column for data-type constraints.
    """
    rows = F.count(F.lit(1))
    if c.kind == "size":
        return rows.cast("double")
    if c.kind == "completeness":
        return _ratio(F.count(F.col(c.columns[0])), rows)
    if c.kind == "compliance":
        pred = F.expr(c.predicate)
        if c.nulls == "pass":
            pred = F.coalesce(pred, F.lit(True))
        return _ratio(F.count_if(pred), rows)
    if c.kind == "datatype":
        col = c.columns[0]
        klass = F.col(cls) if cls is not None else value_class(df, col)
        hit = klass.isin(*DATA_TYPES[c.data_type])
        non_null = F.count(F.col(col))
        share = F.coalesce(_ratio(F.count_if(hit), non_null), F.lit(0.0))
        return F.when(rows > 0, share)
    raise ValueError(c.kind)


def _uniqueness_metric(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """One-row frame with the uniqueness ratio of ``cols``."""
    any_set = reduce(lambda a, b: a | b, [F.col(c).isNotNull() for c in cols])
    freq = df.where(any_set).groupBy(*cols).agg(F.count(F.lit(1)).alias("_n"))
    return freq.agg(_ratio(F.count_if(F.col("_n") == 1), F.sum("_n")).alias("metric"))


def type_histogram(df: DataFrame, column: str) -> DataFrame:
    """One row: number of values per class (Null, Fractional, Integral, Boolean, String)."""
    require_columns(df, [column])
    cls = df.select(value_class(df, column).alias("_class"))  # classify each value once
    return cls.agg(
        *[F.count_if(F.col("_class") == F.lit(k)).alias(f"n_{k.lower()}") for k in TYPE_CLASSES]
    )


# ---------------------------------------------------------------------------
# Verification
# ---------------------------------------------------------------------------
def _entries(checks: Sequence[Check]):
    for chk in checks:
        for c in chk.constraints:
            yield chk, c


def _no_recent(checks: Sequence[Check]) -> None:
    for _, c in _entries(checks):
        if isinstance(c.assertion, Recent):
            raise ValueError(f"{c.name}: an assertion on recent versions needs kept reports: publish(..., reports=...)")


def _required(checks: Sequence[Check]) -> set[str]:
    return {col for _, c in _entries(checks) for col in c.columns}


def metrics(df: DataFrame, *checks: Check) -> DataFrame:
    """Metric rows ``(cid, check_id, check, check_level, constraint, metric, passed)``.

    ``check_id`` is the position of the check, so checks of one name stay apart. The
    input is computed once for the scan metrics and once per uniqueness key: store an
    expensive input first. ``passed`` is present for Column-expressible assertions and NULL otherwise.
    """
    require_columns(df, _required(checks))
    _no_recent(checks)
    entries = list(_entries(checks))
    if not entries:
        raise ValueError("no constraints to verify")

    def meta(i, chk, c, m: Column) -> list[Column]:
        passed = F.coalesce(c.assertion.column(m), F.lit(False)) if c.lazy else F.lit(None).cast("boolean")
        return [
            F.lit(i).alias("cid"),
            F.lit(next(k for k, x in enumerate(checks) if x is chk)).alias("check_id"),
            F.lit(chk.name).alias("check"),
            F.lit(chk.level).alias("check_level"),
            F.lit(c.name).alias("constraint"),
            m.alias("metric"),
            passed.alias("passed"),
        ]

    parts: list[DataFrame] = []
    scan = [(i, chk, c) for i, (chk, c) in enumerate(entries) if c.kind != "uniqueness"]
    uniq = [i for i, (_, c) in enumerate(entries) if c.kind == "uniqueness"]
    if scan:
        # one pass without a shuffle of rows; each uniqueness key is its own count per key,
        # so the exchange on the key carries nothing but the key and that count
        prep = df.withColumns(_class_columns(df, entries)) if _class_columns(df, entries) else df
        one = prep.agg(*[
            _scan_metric(df, c, _class_name(entries, c.columns[0]) if c.kind == "datatype" else None)
            .alias(f"m{i}") for i, _, c in scan
        ])
        structs = [F.struct(*meta(i, chk, c, F.col(f"m{i}"))) for i, chk, c in scan]
        parts.append(one.select(F.inline(F.array(*structs))))
    for i in uniq:
        chk, c = entries[i]
        u = _uniqueness_metric(df, c.columns)
        parts.append(u.select(*meta(i, chk, c, F.col("metric"))))
    return reduce(DataFrame.unionByName, parts)


def _decide(entries, values: dict) -> list[tuple]:
    """Report rows (driver side) from metric values keyed by constraint index."""
    passed = {}
    for i, (chk, c) in enumerate(entries):
        v = values.get(i)
        ok = False
        if v is not None:
            try:
                ok = bool(c.assertion(v))
            except Exception:  # an assertion that raises is a failed constraint
                log.exception("assertion of %s raised", c.name)
        passed[i] = ok
    failed_checks = {id(chk) for i, (chk, _) in enumerate(entries) if not passed[i]}
    rows = []
    for i, (chk, c) in enumerate(entries):
        v = values.get(i)
        ok = passed[i]
        msg = "" if ok else (MSG_EMPTY if v is None else MSG_FAILED)
        rows.append((
            chk.name, chk.level, chk.level if id(chk) in failed_checks else SUCCESS,
            c.name, SUCCESS if ok else FAILURE, msg, None if v is None else float(v),
        ))
    return rows


class ObservedVerification:
    """Verification that rides along another action (typically the write).

    :meth:`attach` adds every scan-shareable metric to a DataFrame as an
    observation, so those metrics cost no extra pass over the data. Attach it
    as the *last* step before the action (after any exchange), so that it runs
    in the result stage, where Spark applies each task's update exactly once
    even when tasks or executors are lost. After the action has run,
    :meth:`report` adds the uniqueness metrics (each one ``groupBy`` over
    ``stored``, reading only its key columns) and returns the report.
    """

    def __init__(self, df: DataFrame, *checks: Check):
        from pyspark.sql import Observation

        require_columns(df, _required(checks))
        _no_recent(checks)
        self.entries = list(_entries(checks))
        self.scan = [i for i, (_, c) in enumerate(self.entries) if c.kind != "uniqueness"]
        self.obs = Observation()
        self.classes = _class_columns(df, self.entries)
        self.exprs = []
        for i in self.scan:
            c = self.entries[i][1]
            cls = _class_name(self.entries, c.columns[0]) if c.kind == "datatype" else None
            self.exprs.append(_scan_metric(df, c, cls).alias(f"m{i}"))

    def attach(self, frame: DataFrame) -> DataFrame:
        if not self.exprs:
            return frame
        if not self.classes:
            return frame.observe(self.obs, *self.exprs)
        # class columns exist only for the observation; the action sees ``frame``'s columns
        observed = frame.withColumns(self.classes).observe(self.obs, *self.exprs)
        return observed.drop(*self.classes)

    def report(self, stored: DataFrame) -> DataFrame:
        values = {}
        if self.scan:
            got = self.obs.get
            values.update({i: got[f"m{i}"] for i in self.scan})
        for i, (_, c) in enumerate(self.entries):
            if c.kind == "uniqueness":
                values[i] = _uniqueness_metric(stored, c.columns).first()["metric"]
        return stored.sparkSession.createDataFrame(_decide(self.entries, values), REPORT_SCHEMA)


def _finish(m: DataFrame) -> DataFrame:
    failed_error = F.max(
        F.when(~F.col("passed"), F.col("check_level")).otherwise(F.lit(None))
    ).over(Window.partitionBy("check_id"))
    return m.select(
        "check",
        "check_level",
        F.coalesce(failed_error, F.lit(SUCCESS)).alias("check_status"),
        "constraint",
        F.when(F.col("passed"), F.lit(SUCCESS)).otherwise(F.lit(FAILURE)).alias("constraint_status"),
        F.when(F.col("passed"), F.lit(""))
        .when(F.col("metric").isNull(), F.lit(MSG_EMPTY))
        .otherwise(F.lit(MSG_FAILED))
        .alias("constraint_message"),
        F.col("metric").cast("double").alias("metric"),
    )


def verify(df: DataFrame, *checks: Check) -> DataFrame:
    """Run all constraints of ``checks`` over ``df``; return the report DataFrame."""
    m = metrics(df, *checks)
    entries = list(_entries(checks))
    if all(c.lazy for _, c in entries):
        return _finish(m)
    # A Python assertion: decide on the driver over the (bounded) metric rows.
    values = {r["cid"]: r["metric"] for r in m.select("cid", "metric").collect()}
    return df.sparkSession.createDataFrame(_decide(entries, values), REPORT_SCHEMA)


class VerificationError(AssertionError):
    """Raised by :func:`gate` when an Error-level constraint failed."""

    def __init__(self, failures: list[dict]):
        self.failures = failures
        names = ", ".join(f["constraint"] for f in failures)
        super().__init__(f"One or more constraints failed during validation: {names}")


def gate(report: DataFrame, level: str = "Error") -> None:
    """Raise :class:`VerificationError` if any constraint at ``level`` failed.

    Failed Warning-level constraints are logged only. Collects only failed
    report rows (at most one per constraint).
    """
    failed = [
        r.asDict()
        for r in report.where(F.col("constraint_status") == FAILURE).collect()
    ]
    for f in failed:
        log.error("constraint %r failed: %s (metric=%s)", f["constraint"],
                  f["constraint_message"], f["metric"])
    blocking = [f for f in failed if f["check_level"] == level]
    if blocking:
        raise VerificationError(blocking)
