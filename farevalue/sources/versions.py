"""Tables that are replaced run by run, with a log of the finished runs.

    PATH/runs/RUN/PART/period=DAY/...   what one run wrote
    PATH/commits                        one row per finished run

A run becomes visible by its row in the log, which is one small file, after all its parts are
written. A run that stops earlier leaves readers the table of before, and a failed job is
told apart by the missing row. A run may hold a few periods only: of every period, the
newest run counts, so loading a day again writes that day and no other.

Parts may be bucketed by a key. Readers get the bucketing, and the place of every period,
as an external table of the session's catalog, so joins, groups and windows by the key
need no shuffle.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from dataclasses import dataclass
from functools import cached_property

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StringType, StructField, StructType

from farevalue.contracts import Contract, literal_rows
from farevalue.sources.files import folders, remove
from farevalue.sources.writers import save_buckets

PERIOD = "period"

# Fixed value: Spark's name for the folder of null.
NULL_FOLDER = "__HIVE_DEFAULT_PARTITION__"
ROWS = "rows"

LOG = Contract(
    "commits",
    """
    sequence bigint, run string, complete boolean, periods string, present string,
    buckets int, inputs string
    """,
)


@dataclass(frozen=True)
class Commit:
    """A finished run. ``periods`` are those it decides on, ``present`` those with rows;
    a complete run decides on all. ``inputs`` says what it was made of."""

    sequence: int
    run: str
    complete: bool
    periods: tuple[str | None, ...]
    present: tuple[str | None, ...]
    buckets: int
    inputs: dict


Periods = set[str | None]


def period_of(day: Column, unit: str = "day") -> Column:
    """The day, or the first day of its ``month`` or ``year``; null stays null."""
    return day if unit == "day" else F.trunc(day, unit)


def period_text(day: str | None, unit: str = "day") -> str | None:
    """``period_of`` for the text of a day."""
    if day is None or unit == "day":
        return day
    year, month, _ = day.rsplit("-", 2)
    return f"{year}-{month}-01" if unit == "month" else f"{year}-01-01"


def within(periods: Periods | None, column: str = PERIOD) -> Column:
    """A test on the period that prunes folders; ``None`` is no limit."""
    if periods is None:
        return F.lit(True)
    days = F.col(column).isin(*(F.lit(p).cast("date") for p in in_order(periods) if p is not None))
    days = F.coalesce(days, F.lit(False)) if None in periods else days
    return days | F.col(column).isNull() if None in periods else days


def outside(periods: Periods, column: str = PERIOD) -> Column:
    """The opposite of ``within``, for null too."""
    return ~F.coalesce(within(periods, column), F.lit(False))


def in_order(periods: Periods) -> list[str | None]:
    return sorted(periods, key=lambda p: (p is not None, p or ""))


def quoted(text: str) -> str:
    """A SQL string."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


class Versions:
    """A table at ``path``; the log is read once per object."""

    def __init__(self, spark: SparkSession, path: str, period: str = PERIOD) -> None:
        self.spark = spark
        self.path = path.rstrip("/")
        self.period = period

    @cached_property
    def log(self) -> list[Commit]:
        """Finished runs, oldest first."""
        try:
            rows = self.spark.read.schema(LOG.schema).parquet(f"{self.path}/commits").collect()
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return []
        return [
            Commit(
                r["sequence"], r["run"], r["complete"], tuple(json.loads(r["periods"])),
                tuple(json.loads(r["present"])), r["buckets"], json.loads(r["inputs"]),
            )
            for r in sorted(rows, key=lambda r: (r["sequence"], r["run"]))
        ]

    @property
    def newest(self) -> Commit | None:
        return self.log[-1] if self.log else None

    def _last(self, upto: int | None = None) -> Commit:
        found = [c for c in self.log if upto is None or c.sequence <= upto]
        if not found:
            raise FileNotFoundError(f"Source path does not exist: {self.path}")
        return found[-1]

    def live(self, upto: int | None = None) -> dict[str | None, str]:
        """The run that counts, of every period with rows."""
        runs: dict[str | None, str] = {}
        for commit in self.log:
            if upto is not None and commit.sequence > upto:
                break
            if commit.complete:
                runs = {}
            for period in commit.periods:
                runs.pop(period, None)
            runs.update(dict.fromkeys(commit.present, commit.run))
        return runs

    def changed_since(self, sequence: int) -> Periods | None:
        """Periods of the runs after ``sequence``; ``None`` if one of them replaced all."""
        later = [c for c in self.log if c.sequence > sequence]
        if any(c.complete for c in later):
            return None
        return {p for c in later for p in c.periods}

    def begin(self) -> str:
        return uuid.uuid4().hex

    def folder(self, run: str, part: str = ROWS) -> str:
        return f"{self.path}/runs/{run}/{part}"

    def write(
        self, df: DataFrame, run: str, part: str = ROWS, dated: bool = True, key: str | None = None,
        buckets: int = 0,
    ) -> None:
        """Write one part of a run, in a folder per period if ``dated``. ``key`` and ``buckets``
        bucket and sort it; rows that come dealt by them leave one file per bucket."""
        writer = df.write.mode("overwrite").format("parquet").option("compression", "zstd")
        if dated:
            writer = writer.partitionBy(self.period)
        if not buckets:
            writer.save(self.folder(run, part))
            return
        save_buckets(self.spark, writer, self.folder(run, part), key, buckets)

    def periods_in(self, run: str, part: str = ROWS) -> Periods:
        """Periods that one part of a run has rows for, by the names of its folders."""
        named = (f.split("=", 1) for f in folders(self.spark, self.folder(run, part)) if "=" in f)
        return {None if value == NULL_FOLDER else value for _, value in named}

    def commit(
        self,
        run: str,
        present: Periods = frozenset(),
        periods: Periods | None = None,
        buckets: int = 0,
        inputs: dict | None = None,
    ) -> Commit:
        """Make a run visible. ``periods`` limits what it replaces; ``None`` replaces all."""
        last = self.newest
        sequence = last.sequence + 1 if last else 1
        decided = in_order(present if periods is None else periods)
        row = (
            sequence, run, periods is None, json.dumps(decided), json.dumps(in_order(present)),
            buckets, json.dumps(inputs or {}, sort_keys=True),
        )
        literal_rows(self.spark, LOG.schema, [row]).write.mode("append").parquet(f"{self.path}/commits")
        self.__dict__.pop("log", None)
        return self.newest

    def read(
        self, schema: StructType, part: str = ROWS, key: str | None = None, upto: int | None = None
    ) -> DataFrame:
        """A part of the table, with the column of the period last; as of commit ``upto`` if given.

        Periods of one run that is not bucketed are read by path. Otherwise a table in the
        catalog has the place of every period; it is named by the commit and never changes.
        """
        last, live = self._last(upto), self.live(upto)
        full = StructType([*schema, StructField(self.period, DateType())])
        runs = set(live.values()) or {last.run}
        if len(runs) == 1 and not (key and last.buckets):
            (run,) = runs
            whole = self.spark.read.schema(full).parquet(self.folder(run, part))
            stale = {p for c in self.log if c.run == run for p in c.present} - set(live)
            return whole.where(outside(stale, self.period)) if stale else whole
        digest = hashlib.md5(f"{self.path}/{part}/{key}".encode()).hexdigest()[:16]
        name = f"farevalue_{digest}_{last.sequence}"
        if not self.spark.catalog.tableExists(name):
            self._register(name, full, part, key, last.buckets, live)
        return self.spark.table(name)

    def _register(self, name, full, part, key, buckets, live) -> None:
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in full)
        bucketing = f"CLUSTERED BY (`{key}`) INTO {buckets} BUCKETS" if key and buckets else ""
        self.spark.sql(
            f"CREATE TABLE {name} ({columns}) USING parquet PARTITIONED BY ({self.period}) {bucketing} "
            f"LOCATION {quoted(self.path + '/runs')}"
        )
        places = [
            f"PARTITION ({self.period}={'null' if p is None else repr(p)}) "
            f"LOCATION {quoted(self._place(live[p], part, p))}"
            for p in in_order(set(live))
        ]
        for at in range(0, len(places), 500):
            self.spark.sql(f"ALTER TABLE {name} ADD {' '.join(places[at : at + 500])}")

    def _place(self, run: str, part: str, period: str | None) -> str:
        """The folder of one period, which Spark names so for null."""
        return f"{self.folder(run, part)}/{self.period}={period or NULL_FOLDER}"

    def read_newest(self, schema: StructType, part: str) -> DataFrame:
        """A part without periods, as the newest run wrote it."""
        return self.spark.read.schema(schema).parquet(self.folder(self._last().run, part))

    def read_text(self, part: str) -> DataFrame:
        """A part of JSON lines: one row per line, whatever run holds it."""
        live = self.live()
        places = [self._place(live[p], part, p) for p in in_order(set(live))]
        layout = StructType([StructField("value", StringType())])
        return self.spark.read.text(places) if places else literal_rows(self.spark, layout, [])

    def prune(self, keep: int = 2) -> list[str]:
        """Remove the files of runs that no state since the last ``keep`` complete runs needs,
        beside those of unfinished runs that nobody knows of; return the runs removed."""
        complete = [n for n, c in enumerate(self.log) if c.complete]
        if len(complete) <= keep:
            return []
        old = [c.run for c in self.log[: complete[-keep]]]
        for run in old:
            remove(self.spark, f"{self.path}/runs/{run}")
        return old
