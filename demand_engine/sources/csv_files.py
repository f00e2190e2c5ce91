"""CSV scans over files whose headers differ and some of which hold NUL bytes."""

from __future__ import annotations

import csv
import itertools
from collections import defaultdict
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from io import TextIOWrapper

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from demand_engine.functions.times import parse_time
from demand_engine.operators.tables import canonical, quoted, rename_known, union_relaxed
from demand_engine.schemas import STATION_HEADERS, STATION_TYPES, TRIP_HEADERS, TRIP_TYPES
from demand_engine.session import cut_lineage, scratch_path
from demand_engine.sources.files import decoded_path, name_below, opened, spread

# Fixed value: how the files write a missing value.
CSV_OPTIONS = {"nullValue": "\\N", "escape": '"'}

NUL = "\x00"
SOURCE_FILE = "source_file"


def _first_lines(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        lines = []
        for path in batch["path"]:
            with opened(path) as stream:
                text = TextIOWrapper(stream, encoding="utf-8-sig", errors="replace")
                lines.append(text.readline().rstrip("\n").replace("\x00", ""))
        yield pd.DataFrame({"path": batch["path"], "line": lines})


def headers(files: DataFrame) -> dict[str, list[str]]:
    """Header line -> paths. Tasks read the first line of each file of the listing."""
    found = spread(files.select("path")).mapInPandas(_first_lines, "path string, line string")
    groups: dict[str, list[str]] = defaultdict(list)
    for row in found.collect():
        groups[row["line"]].append(row["path"])
    return {line: sorted(paths) for line, paths in sorted(groups.items())}


# One field whose quotes, if it has any, end; a field in quotes that the line leaves open.
_CLOSED = r'(?:"[^"]*+(?:""[^"]*+)*+"[^,]*+|[^",][^,]*+|)'
_OPEN = r'"[^"]*+(?:""[^"]*+)*+'
_QUOTED = r'[^"]*+(?:""[^"]*+)*+'
# Lines that end inside quotes: begun outside; begun inside, if the quotes never end or if others open behind them.
_OPENS = rf"^(?:{_CLOSED},)*+{_OPEN}\z"
_STAYS = rf'^(?:{_QUOTED}|{_QUOTED}"[^,]*+,(?:{_CLOSED},)*+{_OPEN})\z'


def staged_lines(spark: SparkSession, files: DataFrame) -> DataFrame:
    """The lines of all files of (path, group), written by group: the one read of the files.

    (source_path, block, place, line, opens, stays, group): `block` is where the split begins that the
    line was read in, so that large files are read by many tasks, `place` ascends in it. NUL bytes are
    gone. `opens` and `stays` tell whether a line ends inside quotes, if it begins outside and if it begins
    inside them.
    """
    paths = [r["path"] for r in files.collect()]
    by_path = files.select(F.col("path").alias("source_path"), "group")
    quoted_line = F.contains("line", F.lit('"'))
    lines = spark.read.option("lineSep", "\n").text(paths).select(
        decoded_path(F.col("_metadata.file_path")).alias("source_path"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("place"),
        F.replace("value", F.lit(NUL), F.lit("")).alias("line"),
    )
    marked = lines.withColumns(
        {
            "opens": F.when(quoted_line, F.rlike("line", F.lit(_OPENS))).otherwise(False).cast("int"),
            "stays": F.when(quoted_line, F.rlike("line", F.lit(_STAYS))).otherwise(True).cast("int"),
        }
    )
    path = scratch_path(spark, "lines")
    marked.join(F.broadcast(by_path), "source_path").write.partitionBy("group").parquet(path)
    return spark.read.schema(f"{_LINES}, group int").parquet(path)


_LINES = "source_path string, block bigint, place bigint, line string, opens int, stays int"


def _begins(rows: DataFrame, within: Sequence[str], order: str) -> DataFrame:
    """`rows` with what is known of the state, inside quotes or not, that each begins in.

    A row either sets the state (opens = stays), turns it (opens > stays) or keeps it. So the state is
    `turned` modulo 2 behind the last setting row, and that beyond the group's own begin where no row has set it.
    """
    before = Window.partitionBy(*within).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    turns = (F.col("opens") > F.col("stays")).cast("int")
    counted = rows.withColumn("turns", F.coalesce(F.sum(turns).over(before), F.lit(0)))
    seen = F.when(F.col("opens") == F.col("stays"), F.struct(F.col("opens").alias("to"), (F.col("turns") + turns).alias("turns")))
    last = counted.withColumn("set", F.last(seen, ignorenulls=True).over(before))
    turned = F.when(F.col("set").isNull(), F.col("turns")).otherwise(F.col("set.to") + F.col("turns") - F.col("set.turns"))
    return last.withColumns({"is_set": F.col("set").isNotNull(), "turned": turned % 2}).drop("set", "turns")


def _records_across_lines(lines: DataFrame) -> DataFrame:
    """(source_path, block, place, line) per record of files in which records go over several lines.

    A scan over the states in which lines begin: inside each block, over the blocks of a file, and back.
    Lines that are records of their own stay where they are; only pieces of others meet, by the line
    that opens them, in whatever blocks they lie. A record is held whole by the task that joins it.
    """
    begun = _begins(lines, ["source_path", "block"], "place")
    last = F.max_by(F.struct("is_set", "turned", "opens", "stays"), "place").alias("last")
    blocks = begun.groupBy("source_path", "block").agg(last)
    ends = {to: F.when((F.col("last.turned") + start) % 2 == 1, F.col("last.stays")).otherwise(F.col("last.opens")) for to, start in (("opens", 0), ("stays", 1))}
    set_ends = F.when(F.col("last.turned") == 1, F.col("last.stays")).otherwise(F.col("last.opens"))
    whole = blocks.select("source_path", "block", *(F.when(F.col("last.is_set"), set_ends).otherwise(e).alias(to) for to, e in ends.items()))
    starts = _begins(whole, ["source_path"], "block").select(
        F.col("source_path").alias("__path"), F.col("block").alias("__block"), F.col("turned").alias("__inside")
    )
    at_block = (F.col("source_path") == F.col("__path")) & (F.col("block") == F.col("__block"))
    inside = F.when(F.col("is_set"), F.col("turned")).otherwise((F.col("turned") + F.col("__inside")) % 2)
    stated = cut_lineage(begun.join(starts, at_block).select("source_path", "block", "place", "line", "opens", inside.alias("inside")))

    alone = (F.col("inside") == 0) & (F.col("opens") == 0)
    pieces = stated.where(~alone)
    opening = F.when(F.col("inside") == 0, F.struct("block", "place"))
    so_far = Window.partitionBy("source_path", "block").orderBy("place")
    earlier = Window.partitionBy("source_path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    by_block = pieces.groupBy("source_path", "block").agg(F.max(opening).alias("opened"))
    carried = by_block.select(
        F.col("source_path").alias("__path"), F.col("block").alias("__block"), F.last("opened", ignorenulls=True).over(earlier).alias("__opened")
    )
    own = pieces.withColumn("own", F.last(opening, ignorenulls=True).over(so_far)).join(carried, at_block)
    joined = own.groupBy("source_path", F.coalesce("own", "__opened").alias("first")).agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("block", "place", "line"))), lambda r: r["line"]), "\n").alias("line")
    )
    columns = ["source_path", "block", "place", "line"]
    return stated.where(alone).select(columns).unionByName(joined.select("source_path", "first.block", "first.place", "line"))


def _whole_file_rows(width: int):
    """Task function: whole files -> rows of text, for files whose lines end in carriage returns alone."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path in batch["path"]:
                with opened(path) as stream:
                    text = TextIOWrapper(stream, encoding="utf-8-sig", errors="replace", newline="")
                    rows = csv.reader(line.replace(NUL, "") for line in text)
                    next(rows, None)
                    while held := list(itertools.islice(rows, 10_000)):
                        cells = [[c if c not in ("", "\\N") else None for c in r] for r in held if r]
                        full = [(r + [None] * width)[:width] + [path] for r in cells]
                        yield pd.DataFrame(full, columns=[*(f"c{i}" for i in range(width)), "source_path"], dtype=object)

    return run


@dataclass(frozen=True)
class Marks:
    """Files that need more than a look at each line: those in which records go over several lines, and
    those whose lines end in carriage returns alone, which Spark's line reader can't split."""

    across: frozenset[str]
    carriage: frozenset[str]


def marks(lines: DataFrame) -> Marks:
    """What is special about each file of `staged_lines`."""
    lone = F.contains(F.regexp_replace("line", r"\r\z", ""), F.lit("\r")) & (F.col("opens") == 0) & (F.col("stays") == 1)
    found = lines.groupBy("source_path").agg(F.bool_or(F.col("opens") == 1).alias("across"), F.bool_or(lone).alias("carriage"))
    rows = found.where("across OR carriage").collect()
    carriage = frozenset(r["source_path"] for r in rows if r["carriage"])
    return Marks(frozenset(r["source_path"] for r in rows if r["across"]) - carriage, carriage)


def _parsed(records: DataFrame, lines: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Records as columns of text, without the one that each file's first line opens and without blank ones."""
    ddl = ", ".join(f"c{i} STRING" for i in range(len(columns)))
    firsts = lines.where("block = 0").groupBy(F.col("source_path").alias("__path")).agg(F.min("place").alias("__first"))
    is_first = (F.col("source_path") == F.col("__path")) & (F.col("block") == 0) & (F.col("place") == F.col("__first"))
    text = F.regexp_replace("line", r"\r\z", "")
    return (
        records.join(F.broadcast(firsts), is_first, "left_anti")
        .where(F.trim(text) != "")
        .select("source_path", F.from_csv(text, ddl, CSV_OPTIONS).alias("row"))
        .select(*(F.col(f"row.c{i}").alias(c) for i, c in enumerate(columns)), "source_path")
    )


def read_text_columns(spark: SparkSession, header: str, paths: Sequence[str], lines: DataFrame, marked: Marks) -> DataFrame:
    """Files with one header, all columns as text, and `source_path`, from their staged lines."""
    columns = next(csv.reader([header]), [])
    special = [p for p in paths if p in marked.across]
    odd = [p for p in paths if p in marked.across or p in marked.carriage]
    parts = []
    if len(odd) < len(paths):
        plain = lines.where(~F.col("source_path").isin(odd)) if odd else lines
        parts.append(_parsed(plain.select("source_path", "block", "place", "line"), lines, columns))
    if special:
        parts.append(_parsed(_records_across_lines(lines.where(F.col("source_path").isin(special))), lines, columns))
    if len(odd) > len(special):
        files = spread(spark.createDataFrame([(p,) for p in paths if p in marked.carriage], "path string"))
        ddl = ", ".join([*(f"c{i} string" for i in range(len(columns))), "source_path string"])
        parts.append(files.mapInPandas(_whole_file_rows(len(columns)), ddl).toDF(*columns, "source_path"))
    return reduce(DataFrame.unionByName, parts)


def read_csv(
    files: DataFrame,
    names: Mapping[str, str],
    types: Mapping[str, str],
    roots: Sequence[str] | None = None,
) -> DataFrame:
    """The rows of all files under canonical names and types, plus columns not declared as text.

    Files are grouped by header, since one scan over different headers would put values into the
    wrong columns, and the groups are united by name. Beside its first line each file is read once, as
    lines, which are written to the shared folder; what is special about a file is found there, and all
    parsing is done from there. With `roots`, the folders the files lie in, a
    `source_file` column holds the name below them.
    """
    spark = files.sparkSession
    groups = headers(files)
    if not groups:
        raise ValueError("no files to read")
    grouped = [(path, k) for k, paths in enumerate(groups.values()) for path in paths]
    lines = staged_lines(spark, spark.createDataFrame(grouped, "path string, group int"))
    marked = marks(lines)
    parts = []
    for group, (header, paths) in enumerate(groups.items()):
        own = lines.where(F.col("group") == group)
        rows = rename_known(read_text_columns(spark, header, paths, own, marked), names)
        times = {
            c: parse_time(quoted(c))
            for c, t in types.items()
            if t == "timestamp_ntz" and c in rows.columns
        }
        parts.append(canonical(rows.withColumns(times), types))
    rows = union_relaxed(parts)
    if roots is not None:
        rows = rows.withColumn(SOURCE_FILE, name_below(F.col("source_path"), roots))
    return rows.drop("source_path")


def read_trip_csv(files: DataFrame, roots: Sequence[str] | None = None) -> DataFrame:
    return read_csv(files, TRIP_HEADERS, TRIP_TYPES, roots)


def read_station_csv(files: DataFrame, version: int, effective_from) -> DataFrame:
    """One published station list with its version and first day."""
    return read_csv(files, STATION_HEADERS, STATION_TYPES).withColumns(
        {
            "station_version": F.lit(version),
            "effective_from": F.lit(effective_from).cast("timestamp_ntz"),
        }
    )
