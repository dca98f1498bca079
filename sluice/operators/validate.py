"""Width and type checks of CSV lines against a load spec.

The raw line is parsed once by ``from_csv``.  ``inline`` keeps Catalyst from
copying that parse into every expression that uses a field: a projection
would be inlined into the filter and parsed once per check.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.functions.casts import EXPECTED, cast_field, is_wrong
from sluice.operators.running import running_total
from sluice.session import remove_dir, work_dir
from sluice.spec import LoadSpec

_CORRUPT = "_corrupt"
_CSV = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT, "escape": '"'}
_WIDTH = -1  # verdict of a line with the wrong number of fields
_SPLIT = ("path", "file_name", "block_start")
_PROVENANCE = (*_SPLIT, "row_id")

# Texts of the entries on rejected lines.
WRONG_WIDTH = "expected %d columns, but found %d."
WRONG_TYPE = "%s was expected, but the value was '%s'."
AT_LINE = "[%s, line:%d]: "
AT_COLUMN = "[%s, line:%d, column:%d]: "

# One window of the line count covers at most this many bytes of a file.
LINE_CHUNK_BYTES = 1 << 40


def _field(i: int) -> str:
    return f"_f{i}"


def csv_width(line: Column) -> Column:
    """Number of fields of one CSV line; a blank line has one.

    A line without quotes has one more than it has commas, which takes no
    regular expression to count.
    """
    quoted = F.size(F.split(F.regexp_replace(line, r'(^|,)"(?:[^"]++|"")*+("|$)', "$1"), ",", -1))
    plain = F.octet_length(line) - F.octet_length(F.replace(line, F.lit(","), F.lit(""))) + 1
    return F.when(line.contains('"'), quoted).otherwise(plain)


def _verdict(spec: LoadSpec) -> Column:
    """Null for a good line, else the first fault: -1 for the width, or the
    0-based index of the first wrong column."""
    n = len(spec.columns)
    width = F.col(_CORRUPT).isNotNull()
    if n != 1:
        width = width | (F.col("value") == "")
    cases = [F.when(width, F.lit(_WIDTH))]
    for i, column in enumerate(spec.columns):
        wrong = is_wrong(F.col(_field(i)), column.spark_type)
        if wrong is not None:
            cases.append(F.when(wrong, F.lit(i)))
    return F.coalesce(*cases)


def _pick(values: list[Column], index: Column) -> Column:
    return F.get(F.array(*values), index)


@dataclass(frozen=True)
class Checked:
    """Lines parsed once, with the verdict on each."""

    spec: LoadSpec
    lines: DataFrame
    parsed: DataFrame
    staged_rows: DataFrame | None = None
    staged_quarantine: DataFrame | None = None
    staged_stats: DataFrame | None = None
    staged_folder: str | None = None

    @property
    def good(self) -> DataFrame:
        """Accepted rows under the declared schema."""
        return self.good_with()

    def good_with(self, *provenance: str) -> DataFrame:
        """Accepted rows with provenance columns in front."""
        if self.staged_rows is not None:
            return self.staged_rows.where(F.col("policy").isNull()).select(*provenance, "row.*")
        return self.parsed.where(F.col("_verdict").isNull()).select(*provenance, *self._fields())

    def _fields(self) -> list[Column]:
        return [cast_field(F.col(_field(i)), c.spark_type).alias(c.name) for i, c in enumerate(self.spec.columns)]

    def _policy(self) -> Column:
        policies = [F.lit(c.on_wrong_type) for c in self.spec.columns]
        at = F.col("_verdict")
        return F.when(at == _WIDTH, F.lit(self.spec.on_wrong_column_count)).otherwise(_pick(policies, at))

    @cached_property
    def quarantine(self) -> DataFrame:
        """Rejected lines: where, what, why and under which policy."""
        if self.staged_quarantine is not None:
            return self.staged_quarantine
        rejected = self.parsed.where(F.col("_verdict").isNotNull())
        return rejected.select(*self._provenance, F.col("value").alias("raw"), *self._faults())

    def _faults(self) -> list[Column]:
        """What is wrong with a rejected line, and the policy it falls under."""
        at = F.col("_verdict")
        expected = [F.lit(EXPECTED[c.spark_type]) for c in self.spec.columns]
        texts = [F.col(_field(i)) for i in range(len(self.spec.columns))]
        width_fault = F.format_string(WRONG_WIDTH, F.lit(len(texts)), csv_width(F.col("value")))
        type_fault = F.format_string(WRONG_TYPE, _pick(expected, at), _pick(texts, at))
        return [
            F.when(at != _WIDTH, at).alias("column_index"),
            F.when(at == _WIDTH, width_fault).otherwise(type_fault).alias("fault"),
            self._policy().alias("policy"),
        ]

    @cached_property
    def split_sizes(self) -> DataFrame:
        """Lines per file split, without parsing them."""
        if self.staged_stats is not None:
            return self.staged_stats
        return self.lines.groupBy(*_SPLIT).agg(
            F.count("*").alias("rows_read"), F.min("row_id").alias("first_id"), F.max("row_id").alias("last_id")
        )

    @cached_property
    def split_stats(self) -> DataFrame:
        """Counts per file split: one small row each, combined before the shuffle."""
        if self.staged_stats is not None:
            return self.staged_stats
        bad = F.col("_verdict").isNotNull()
        return self.parsed.groupBy(*_SPLIT).agg(
            F.count("*").alias("rows_read"),
            F.count_if(bad).alias("rows_skipped"),
            F.count_if(bad & (self._policy() == "fail")).alias("rows_failed"),
        )

    @cached_property
    def file_stats(self) -> DataFrame:
        """Rows read (accepted and rejected) and rejected, per file."""
        return self.split_stats.groupBy("path", "file_name").agg(
            *[F.sum(c).alias(c) for c in ("rows_read", "rows_skipped", "rows_failed")]
        )

    def stage(self, spark: SparkSession) -> Checked:
        """Read, parse and judge every line once, and keep what came of it.

        One write takes all lines in their order: a good one as its typed row,
        a rejected one as it was, with its fault and policy.  Good rows,
        quarantine, line numbers, log and the fail check then read columns of
        that table; those of rejected lines skip the row groups that have none.
        """
        folder = work_dir(spark, "checked")
        bad = F.col("_verdict").isNotNull()
        raw = F.when(bad, F.col("value")).alias("raw")
        faults = [F.when(bad, c).alias(n) for c, n in zip(self._faults(), ("column_index", "fault", "policy"), strict=True)]
        tagged = self.parsed.select(*self._provenance, F.when(~bad, F.struct(*self._fields())).alias("row"), raw, *faults)
        tagged.write.parquet(f"{folder}/lines")
        rows = spark.read.schema(tagged.schema).parquet(f"{folder}/lines")
        quarantine = rows.where(F.col("policy").isNotNull()).drop("row")
        stats = rows.groupBy(*_SPLIT).agg(
            F.count("*").alias("rows_read"),
            F.min("row_id").alias("first_id"),
            F.max("row_id").alias("last_id"),
            F.count("policy").alias("rows_skipped"),
            F.count_if(F.col("policy") == "fail").alias("rows_failed"),
        )
        stats.write.parquet(f"{folder}/stats")
        stats = spark.read.schema(stats.schema).parquet(f"{folder}/stats")
        return Checked(self.spec, self.lines, self.parsed, rows, quarantine, stats, folder)

    def close(self) -> None:
        """Remove what ``stage`` wrote; the staged tables can't be read after that."""
        if self.staged_folder is not None:
            remove_dir(self.lines.sparkSession, self.staged_folder)

    @property
    def _provenance(self) -> tuple[str, ...]:
        """Where a row came from; records of several lines bring their line number along."""
        return (*_PROVENANCE, "line") if "line" in self.lines.columns else _PROVENANCE

    def with_line(self, rows: DataFrame) -> DataFrame:
        """Add the absolute 1-based line number to rows that kept provenance; those that have one keep it.

        Only split counts are summed; the rows themselves are not sorted.  Row
        ids must run without gaps in each split; the line numbers of a split
        where they don't would be wrong, so it raises instead.
        """
        if "line" in rows.columns:
            return rows
        starts = running_total(
            self.split_sizes.select("path", "block_start", "rows_read", "first_id", "last_id"),
            ["path"],
            "block_start",
            "rows_read",
            "_before",
            F.expr(f"block_start div {LINE_CHUNK_BYTES}"),
        ).select("path", "block_start", "first_id", "_before", (F.expr("last_id - first_id + 1 = rows_read")).alias("_whole"))
        line = F.col("_before") + F.col("row_id") - F.col("first_id") + 1
        known = (
            F.when(F.col("_whole"), line)
            .when(F.col("_before").isNull(), F.raise_error(F.lit("a file split has no line offset")).cast("bigint"))
            .otherwise(F.raise_error(F.lit("the row ids of a file split have gaps")).cast("bigint"))
        )
        return (
            rows.join(starts, ["path", "block_start"], "left")
            .withColumn("line", known)
            .drop("_before", "first_id", "_whole")
        )


def check(lines: DataFrame, spec: LoadSpec) -> Checked:
    """Parse and judge every line."""
    n = len(spec.columns)
    ddl = ", ".join(f"{name} string" for name in [*map(_field, range(n)), _CORRUPT])
    # The parser gives up on a line of very many fields.  The width is judged
    # beforehand, and a short line of wrong width stands in for a wrong one.
    line = F.when(csv_width(F.col("value")) == n, F.col("value")).otherwise("," * n)
    fields = lines.select(*lines.columns, F.inline(F.array(F.from_csv(line, ddl, _CSV))))
    return Checked(spec, lines, fields.withColumn("_verdict", _verdict(spec)))


def fault_message(fault: Column, file_name: Column, line: Column, column_index: Column) -> Column:
    """Full text of a log entry on a rejected line."""
    place = F.when(
        column_index.isNull(), F.format_string(AT_LINE, file_name, line)
    ).otherwise(F.format_string(AT_COLUMN, file_name, line, column_index))
    return F.concat(place, fault)
