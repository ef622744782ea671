"""Schema contract over raw CSV batches.

``profile`` infers, per batch and column, the type a CSV sniffer
would report by classifying *every* value (not a sample), so a bad value deep in a
file is caught here rather than by the bronze cast. Each value is mapped to one class bit by
anchored regular expressions and casts; ``bit_or`` per (file, position) is a primitive partial
aggregate, so a file holding a third of all rows costs no more than any
other. The same scan counts the rows whose cells don't match the header.

The scan knows cells by position only: one scan for each number of columns, however many
headers there are. Names meet the masks after the aggregation, where one verdict expression
turns masks into types. What a file was found to hold is one row (``file_profiles``), which a
build keeps as its ledger: a file of the same path, length and modification time isn't
parsed for the contract again.

Rows torn by quoted line breaks don't match the header. Files with such rows are
read once more, each by one task, with line breaks allowed; all others stay splittable.

A profile row is one header of one batch, known by the full batch path, so
headers of different files are never merged. The contract itself is a literal
array/map: the missing, type and additive checks need no join.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeward.config import RAW_CONTRACT
from lakeward.session import scratch_path
from lakeward.sources.batches import MALFORMED, FileHeader, cells_by_width, headers, plain_paths

# ---------------------------------------------------------------------------
# Type classes a CSV sniffer assigns, first match wins.
# ---------------------------------------------------------------------------
BOOLEAN, BIGINT, HUGEINT, DOUBLE, TIME, DATE, TIMESTAMP, TIMESTAMPTZ, VARCHAR = (
    "BOOLEAN", "BIGINT", "HUGEINT", "DOUBLE", "TIME", "DATE", "TIMESTAMP",
    "TIMESTAMP WITH TIME ZONE", "VARCHAR",
)
CLASSES: tuple[str, ...] = (BOOLEAN, BIGINT, HUGEINT, DOUBLE, TIME, DATE, TIMESTAMP, TIMESTAMPTZ, VARCHAR)
BIT: dict[str, int] = {name: 1 << i for i, name in enumerate(CLASSES)}

RE_INTEGER = r"^-?(0|[1-9][0-9]*)$"
RE_DOUBLE = r"^-?(([0-9]+\.[0-9]*|\.[0-9]+)([eE][-+]?[0-9]+)?|[0-9]+[eE][-+]?[0-9]+)$|^NaN$"
RE_TIME = r"^([01][0-9]|2[0-3]):[0-5][0-9]:[0-5][0-9]$"
RE_DATE = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$"
_TS = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}[ T][0-9]{2}:[0-9]{2}(:[0-9]{2}(\.[0-9]+)?)?"
RE_TIMESTAMP = _TS + r"$"
RE_TIMESTAMPTZ = _TS + r"(Z|[+-][0-9]{2}(:?[0-9]{2})?)$"

MISSING = "missing_required_column"
INCOMPATIBLE = "incompatible_column_type"
MALFORMED_ROWS = "malformed_rows"
ANY_COLUMN = "*"


def _text(value: str) -> str:
    """A SQL string literal."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def value_class_bit(value: str) -> str:
    """SQL of the class bit of one CSV value (0 for NULL), a column that is taken as read
    (the contract scan trims surrounding spaces at parse time).

    Cheap dispatch first: text whose first character cannot start a number,
    date or time is BOOLEAN, NaN or VARCHAR without any regular expression; a
    value with ``:`` can only be a time or timestamp, one without only a
    number or date. At most three anchored patterns run per value. Text in the form of a
    date or timestamp that no calendar has is VARCHAR."""
    b, v = BIT, value
    return f"""case
      when {v} is null then 0
      when substring({v}, 1, 1) not in ({", ".join(_text(c) for c in "0123456789-.")}) then case
        when length({v}) <= 5 and lower({v}) in ('true', 'false') then {b[BOOLEAN]}
        when {v} = 'NaN' then {b[DOUBLE]} else {b[VARCHAR]} end
      when instr({v}, ':') > 0 then case
        when {v} rlike r'{RE_TIMESTAMP}' and try_cast({v} as timestamp_ntz) is not null then {b[TIMESTAMP]}
        when {v} rlike r'{RE_TIMESTAMPTZ}' and try_cast({v} as timestamp) is not null then {b[TIMESTAMPTZ]}
        when {v} rlike r'{RE_TIME}' then {b[TIME]} else {b[VARCHAR]} end
      when {v} rlike r'{RE_INTEGER}' then if(try_cast({v} as bigint) is not null, {b[BIGINT]}, {b[HUGEINT]})
      when {v} rlike r'{RE_DOUBLE}' then {b[DOUBLE]}
      when {v} rlike r'{RE_DATE}' and try_cast({v} as date) is not null then {b[DATE]}
      else {b[VARCHAR]} end"""


def verdict(mask: str) -> str:
    """SQL of the column type from the OR of its value classes, a column or lambda variable."""
    b, m = BIT, mask
    ints = b[BIGINT] | b[HUGEINT]
    single = " ".join(f"when {b[name]} then {_text(name)}" for name in CLASSES)
    return f"""case
      when {m} = 0 or {m} & {b[VARCHAR]} <> 0 then '{VARCHAR}'
      when bit_count({m}) = 1 then case {m} {single} end
      when {m} & ~{ints} = 0 then '{HUGEINT}'
      when {m} & ~{ints | b[DOUBLE]} = 0 then '{DOUBLE}'
      when {m} = {b[TIMESTAMP] | b[TIMESTAMPTZ]} then '{TIMESTAMPTZ}'
      else '{VARCHAR}' end"""


FILE_PROFILE = "file_path string, masks array<int>, malformed bigint, multiline boolean"


def _measured(spark: SparkSession, hs: Sequence[FileHeader], multiline: bool) -> DataFrame:
    """FILE_PROFILE of the files that have rows: one scan for each width."""
    out = spark.createDataFrame([], FILE_PROFILE)
    for width, cells in cells_by_width(spark, hs, multiline):
        masks = cells.groupBy("file").agg(
            F.count(MALFORMED).alias("malformed"), *[F.expr(f"bit_or({value_class_bit(f'c{i}')})").alias(f"m{i}") for i in range(width)])
        out = out.unionByName(masks.select(
            plain_paths(F.col("file")).alias("file_path"), F.array(*[F.col(f"m{i}") for i in range(width)]).alias("masks"), "malformed",
            F.lit(multiline).alias("multiline")))
    return out


def file_profiles(spark: SparkSession, hs: Sequence[FileHeader], multiline: bool = False, ledger: DataFrame | None = None) -> DataFrame:
    """FILE_PROFILE of all files, read from a small written table. Files that ``ledger`` knows
    (``FileHeader.known``) come from there; the others are parsed, and those with rows of
    another width than their header's once more, with quoted line breaks allowed."""
    new = [h for h in hs if not h.known]
    found = spark.createDataFrame([], FILE_PROFILE)
    if new:
        path = scratch_path(spark, "file-profiles")
        _measured(spark, new, multiline).write.parquet(path)
        found = spark.read.schema(FILE_PROFILE).parquet(path)
    if not multiline and new:
        torn = {r["file_path"] for r in found.where("malformed > 0").select("file_path").collect()}
        if torn:
            again = scratch_path(spark, "file-profiles-multiline")
            _measured(spark, [h for h in new if h.file_path in torn], True).write.parquet(again)
            found = found.where("malformed = 0").unionByName(spark.read.schema(FILE_PROFILE).parquet(again))
    if ledger is not None:
        known = spark.createDataFrame([(h.file_path,) for h in hs if h.known], "file_path string")
        found = found.unionByName(ledger.join(known, "file_path", "left_semi").select("file_path", "masks", "malformed", "multiline"))
    return found


def ledger_rows(spark: SparkSession, hs: Sequence[FileHeader], found: DataFrame) -> DataFrame:
    """The ledger of a run: FILE_PROFILE with length, modification time and header of each file."""
    files = spark.createDataFrame([(h.file_path, h.length, h.modified, list(h.columns)) for h in hs],
                                  "file_path string, length bigint, modified bigint, columns array<string>")
    return files.join(found, "file_path", "left").select(
        "file_path", "length", "modified", "columns", F.coalesce("masks", F.expr("transform(columns, c -> 0)")).alias("masks"),
        F.coalesce("malformed", F.lit(0).cast("bigint")).alias("malformed"), F.coalesce("multiline", F.lit(False)).alias("multiline"))


def profile(
    spark: SparkSession, paths: str | Sequence[str], file_headers: list[FileHeader] | None = None,
    multiline: bool = False, found: DataFrame | None = None,
) -> DataFrame:
    """(batch, file_name, width, cells, malformed): for each header of each batch its column
    number, its (column, position, observed_type) and its count of malformed rows. A
    header without rows is there too. ``file_name`` is the basename, or the whole
    path where two batches have the same basename. ``found`` are the file profiles, if they are known."""
    hs = file_headers if file_headers is not None else headers(spark, paths)
    if not hs:
        raise FileNotFoundError(f"no input files match {paths}")
    found = file_profiles(spark, hs, multiline) if found is None else found
    shapes = sorted({h.columns for h in hs})
    place = {columns: n for n, columns in enumerate(shapes)}
    names = _report_names(hs)
    files = spark.createDataFrame([(h.file_path, h.batch, names[h.batch], place[h.columns]) for h in hs],
                                  "file_path string, batch string, file_name string, shape int")
    columns = spark.createDataFrame([(n, list(c)) for n, c in enumerate(shapes)], "shape int, columns array<string>")
    masks = files.join(found, "file_path", "left").groupBy("batch", "file_name", "shape").agg(
        F.coalesce(F.sum("malformed"), F.lit(0).cast("bigint")).alias("malformed"),
        *[F.expr(f"coalesce(bit_or(get(masks, {i})), 0)").alias(f"m{i}") for i in range(max(map(len, shapes)))])
    held = masks.select("batch", "file_name", "shape", "malformed", F.array(*[c for c in masks.columns if c[0] == "m" and c[1:].isdigit()]).alias("masks"))
    return held.join(columns, "shape").select(
        "batch", "file_name", F.size("columns").alias("width"),
        F.expr(f"""transform(zip_with(columns, slice(masks, 1, size(columns)), (c, m) -> named_struct('c', c, 'm', m)), (x, i) ->
                   named_struct('column', x.c, 'position', i, 'observed_type', {verdict('x.m')}))""").alias("cells"),
        "malformed")


def _report_names(hs: Sequence[FileHeader]) -> dict[str, str]:
    """Batch -> its name in reports."""
    labels = {h.batch: h.label for h in hs}
    shared = Counter(labels.values())
    return {batch: label if shared[label] == 1 else batch for batch, label in labels.items()}


def observed_types(
    spark: SparkSession, paths: str | Sequence[str], file_headers: list[FileHeader] | None = None
) -> DataFrame:
    """(file_name, column, position, observed_type) for every batch column."""
    return profile(spark, paths, file_headers).select("file_name", F.explode("cells").alias("c")).select("file_name", "c.*")


def _expected_text(contract: Mapping[str, Sequence[str]]) -> dict[str, str]:
    return {c: ", ".join(sorted(types)) for c, types in contract.items()}


def _names(contract: Mapping[str, Sequence[str]]) -> str:
    return f"array({', '.join(map(_text, contract))})"


def _extra_columns(contract: Mapping[str, Sequence[str]]) -> Column:
    return F.expr(f"array_except(transform(cells, c -> c.column), {_names(contract)})")


def _issue(kind: int, rank: str, column: str, issue: str, expected: str, observed: str) -> str:
    return (f"named_struct('_kind', {kind}, '_rank', {rank}, 'column', {column}, 'issue', {_text(issue)}, "
            f"'expected', {expected}, 'observed', {observed})")


def _issue_array(contract: Mapping[str, Sequence[str]]) -> Column:
    """The issues of one profile row in report order: missing columns by name, type
    issues in contract order, malformed rows."""
    expected = "map(" + ", ".join(f"{_text(c)}, {_text(t)}" for c, t in _expected_text(contract).items()) + ")"
    order = "map(" + ", ".join(f"{_text(c)}, {i}" for i, c in enumerate(contract)) + ")"
    allowed = "map(" + ", ".join(f"{_text(c)}, array({', '.join(map(_text, types))})" for c, types in contract.items()) + ")"
    missing = f"""transform(array_except({_names(contract)}, transform(cells, c -> c.column)),
      c -> {_issue(0, '0', 'c', MISSING, f'{expected}[c]', "'missing'")})"""
    wrong = f"""transform(filter(cells, c -> array_contains({_names(contract)}, c.column) and not array_contains({allowed}[c.column], c.observed_type)),
      c -> {_issue(1, f'{order}[c.column]', 'c.column', INCOMPATIBLE, f'{expected}[c.column]', 'c.observed_type')})"""
    torn = _issue(2, "0", _text(ANY_COLUMN), MALFORMED_ROWS, "concat(width, ' cells in every row')", "concat(malformed, ' rows that differ')")
    return F.expr(f"array_sort(concat({missing}, {wrong}, filter(array({torn}), t -> malformed > 0)))")


ISSUE_FIELDS = ("column", "issue", "expected", "observed")


def issues(profiles: DataFrame, contract: Mapping[str, Sequence[str]] = RAW_CONTRACT) -> DataFrame:
    """All issues, with the columns (_kind, _rank) that order those of a file."""
    return profiles.select("file_name", F.explode(_issue_array(contract)).alias("i")).select(
        "file_name", *[f"i.{c}" for c in ISSUE_FIELDS], "i._kind", "i._rank")


def missing_columns(profiles: DataFrame, contract: Mapping[str, Sequence[str]] = RAW_CONTRACT) -> DataFrame:
    return issues(profiles, contract).where(F.col("issue") == MISSING).select("file_name", *ISSUE_FIELDS)


def type_mismatches(profiles: DataFrame, contract: Mapping[str, Sequence[str]] = RAW_CONTRACT) -> DataFrame:
    return issues(profiles, contract).where(F.col("issue") == INCOMPATIBLE).select("file_name", *ISSUE_FIELDS)


def malformed_rows(profiles: DataFrame, contract: Mapping[str, Sequence[str]] = RAW_CONTRACT) -> DataFrame:
    return issues(profiles, contract).where(F.col("issue") == MALFORMED_ROWS).select("file_name", *ISSUE_FIELDS)


def ordered_issues(profiles: DataFrame, contract: Mapping[str, Sequence[str]] = RAW_CONTRACT) -> DataFrame:
    return issues(profiles, contract).orderBy("file_name", "_kind", "_rank", "column").drop("_kind", "_rank")


def additive_columns(profiles: DataFrame, contract: Mapping[str, Sequence[str]] = RAW_CONTRACT) -> DataFrame:
    """(file_name, additive_columns sorted; empty array when none), one row a batch."""
    return profiles.groupBy("batch", "file_name").agg(
        F.array_sort(F.array_distinct(F.flatten(F.collect_set(_extra_columns(contract))))).alias("additive_columns")).drop("batch")


def files_checked(profiles: DataFrame) -> DataFrame:
    return profiles.agg(F.count_distinct("batch").alias("files_checked"))


@dataclass(frozen=True)
class Issue:
    file_name: str
    column: str
    issue: str
    expected: str
    observed: str


@dataclass(frozen=True)
class ContractSummary:
    files_checked: int
    additive_columns: dict[str, list[str]] = field(default_factory=dict)
    issues: list[Issue] = field(default_factory=list)

    def detail(self) -> str:
        return "; ".join(f"{i.file_name}:{i.column}:{i.issue} expected {i.expected} observed {i.observed}"
                         for i in self.issues)


def summarise(spark: SparkSession, hs: list[FileHeader], found: DataFrame,
              contract: Mapping[str, Sequence[str]] = RAW_CONTRACT) -> ContractSummary:
    """The contract's verdict on files and their profiles. The driver gets one row for each batch
    that has an issue or an additive column."""
    report = profile(spark, [], hs, found=found).select("file_name", _extra_columns(contract).alias("extra"), _issue_array(contract).alias("issues"))
    rows = report.where((F.size("extra") > 0) | (F.size("issues") > 0)).collect()
    add: dict[str, set[str]] = {name: set() for name in _report_names(hs).values()}
    bad = []
    for r in rows:
        add[r["file_name"]].update(r["extra"])
        bad += [(r["file_name"], i["_kind"], i["_rank"], *(i[c] for c in ISSUE_FIELDS)) for i in r["issues"]]
    return ContractSummary(len(add), {name: sorted(extra) for name, extra in sorted(add.items())},
                           [Issue(row[0], *row[3:]) for row in sorted(bad)])


def inspect(spark: SparkSession, paths: str | Sequence[str],
            contract: Mapping[str, Sequence[str]] = RAW_CONTRACT,
            file_headers: list[FileHeader] | None = None, multiline: bool = False,
            ledger: DataFrame | None = None) -> ContractSummary:
    """Run the contract over all files; those that ``ledger`` knows unchanged aren't read."""
    hs = file_headers if file_headers is not None else headers(spark, paths, ledger)
    return summarise(spark, hs, file_profiles(spark, hs, multiline, ledger), contract) if hs else ContractSummary(0, {}, [])


def passed(summary: ContractSummary) -> ContractSummary:
    """Raise if any batch breaks the contract."""
    if summary.issues:
        raise ValueError(f"raw schema compatibility failed: {summary.detail()}")
    return summary


def enforce(spark: SparkSession, paths: str | Sequence[str],
            contract: Mapping[str, Sequence[str]] = RAW_CONTRACT, file_headers: list[FileHeader] | None = None,
            multiline: bool = False, ledger: DataFrame | None = None) -> ContractSummary:
    """Raise before bronze when any batch breaks the contract."""
    return passed(inspect(spark, paths, contract, file_headers, multiline, ledger))


def with_line_breaks(hs: list[FileHeader], found: DataFrame) -> list[FileHeader]:
    """The files, those marked that have quoted line breaks."""
    broken = {r["file_path"] for r in found.where("multiline").select("file_path").collect()}
    return [replace(h, multiline=h.file_path in broken) for h in hs]


def gate_row(profiles: DataFrame, contract: Mapping[str, Sequence[str]] = RAW_CONTRACT) -> DataFrame:
    """One row: passed, issue count, the joined detail text (as the raised message)."""
    iss = issues(profiles, contract)
    text = F.concat_ws(" ", F.concat_ws(":", "file_name", "column", "issue"),
                       F.lit("expected"), F.col("expected"), F.lit("observed"), F.col("observed"))
    ordered = F.sort_array(F.collect_list(F.struct("file_name", "_kind", "_rank", "column", text.alias("t"))))
    return iss.agg(ordered.alias("_i")).select(
        (F.size("_i") == 0).alias("passed"),
        F.size("_i").cast("bigint").alias("issue_count"),
        F.array_join(F.transform("_i", lambda s: s["t"]), "; ").alias("detail"),
    )
