"""Versioned tables: data folders that never change, and one small log that names the current ones.

A table is a folder with data folders (``data-...``) and a log (``_commits``). A commit
is one numbered JSON file: the folders that make up the table at that version (each
with its month, where the table is kept by month), the schema, and a little state of
the writer's own. A writer first writes new folders, then adds the commit that names
them. So

* a reader sees the version it looked up to its end, whatever is written meanwhile;
* a writer that dies leaves the table as it was, and what it wrote is named nowhere;
* data and the state that goes with it (how far a load has come) change together;
* reading looks at one file; it neither lists nor probes what increments there are, and
  months that are not asked for are left out before Spark sees them.

Large tables by month have a folder for each month. Small ones, of which an increment
replaces the last months, have a folder for each increment, and the log says which of
its months still count (``replace_months``): few files, and old ones are never rewritten.

The commit is written beside its place and moved there by a rename that does not replace
a file, so of two writers of one version one fails. One run writes a warehouse at a time.
``vacuum`` removes folders and commits that none of the last versions name.
"""

from __future__ import annotations

import json
import re
import uuid
from dataclasses import dataclass, field, replace
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from adlens.session import delete, list_names, read_text, write_new

LOG = "_commits"
KEPT_VERSIONS = 10
MOST_PARTS = 16  # folders of a small table by month, before they are joined
MONTH = "month"  # partition column of tables kept by month: yyyy-MM


@dataclass(frozen=True)
class Folder:
    """A data folder below the table, its month if it has one, the number of the load that added
    it, and what it holds where that is not the table's rows (an index kept with them).

    ``live`` are the months that count of a folder of several, ``part`` whether it has others.
    """

    path: str
    month: str | None = None
    seq: int = 0
    kind: str = ""
    live: tuple[str, ...] = ()
    part: bool = False


@dataclass(frozen=True)
class Commit:
    version: int = 0
    folders: tuple[Folder, ...] = ()
    schema: str | None = None
    state: dict = field(default_factory=dict)

    def months(self, after_seq: int = -1) -> list[str]:
        """The months with a folder added after load ``after_seq``."""
        some = [f for f in self.folders if f.seq > after_seq and not f.kind]
        return sorted({f.month for f in some if f.month is not None} | {m for f in some for m in f.live})


class VersionedTable:
    """One table below ``path``."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _numbers(self) -> list[int]:
        names = (re.fullmatch(r"(\d{12})\.json", n) for n in list_names(self.spark, f"{self.path}/{LOG}"))
        return sorted(int(m[1]) for m in names if m)

    def _commit(self, number: int) -> Commit:
        found = json.loads(read_text(self.spark, f"{self.path}/{LOG}/{number:012d}.json"))
        return Commit(number, tuple(Folder(**{**f, "live": tuple(f["live"])}) for f in found["folders"]), found["schema"], found["state"])

    def current(self) -> Commit:
        """The last version; version 0 without folders where nothing was committed."""
        numbers = self._numbers()
        return self._commit(numbers[-1]) if numbers else Commit()

    def new_folder(self) -> str:
        """The name of a data folder that is not in use."""
        return f"data-{uuid.uuid4().hex[:16]}"

    def write(self, df: DataFrame, by_month: bool = False) -> list[Folder]:
        """``df`` as new data folders, not yet part of the table; one for each month with ``by_month``."""
        name = self.new_folder()
        if not by_month:
            df.write.parquet(f"{self.path}/{name}")
            return [Folder(name)]
        df.write.partitionBy(MONTH).parquet(f"{self.path}/{name}")
        return self.written_months(name)

    def written_months(self, name: str, seq: int = 0, kind: str = "") -> list[Folder]:
        """The months below a written data folder."""
        return [Folder(f"{name}/{n}", n.split("=", 1)[1], seq, kind)
                for n in list_names(self.spark, f"{self.path}/{name}") if n.startswith(f"{MONTH}=")]

    def commit(self, base: Commit, folders, schema: StructType | str | None = None, state: dict | None = None) -> Commit:
        """Make ``folders`` the table's next version after ``base``."""
        kept = schema.json() if isinstance(schema, StructType) else schema or base.schema
        new = Commit(base.version + 1, tuple(folders), kept, base.state if state is None else state)
        text = json.dumps({"folders": [vars(f) for f in new.folders], "schema": kept, "state": new.state}, sort_keys=True)
        write_new(self.spark, f"{self.path}/{LOG}/{new.version:012d}.json", text)
        return new

    def replace(self, df: DataFrame, state: dict | None = None) -> Commit:
        """The whole table anew."""
        base = self.current()
        return self.commit(base, self.write(df), df.schema, {} if state is None else state)

    def read(self, at: Commit | None = None, months=None, schema: StructType | None = None, kind: str = "") -> DataFrame:
        """The table at a version (the last one if not given), of some months only if given."""
        at = at or self.current()
        schema = schema or (StructType.fromJson(json.loads(at.schema)) if at.schema else None)
        if schema is None:
            raise FileNotFoundError(f"no version of a table at {self.path}")
        wanted = None if months is None else set(months)
        whole, parts = [], []
        for f in at.folders:
            if f.kind != kind or (wanted is not None and f.month not in wanted and wanted.isdisjoint(f.live)):
                continue
            some = [m for m in f.live if wanted is None or m in wanted]
            if f.live and (f.part or len(some) < len(f.live)):
                parts.append((f.path, some))
            else:
                whole.append(f"{self.path}/{f.path}")
        frames = [self.spark.read.schema(schema).parquet(*whole)] if whole else []
        frames += [self.spark.read.schema(schema).parquet(f"{self.path}/{path}").where(F.col(MONTH).isin(some))
                   for path, some in parts]
        return reduce(DataFrame.unionByName, frames) if frames else self.spark.createDataFrame([], schema)

    def replace_months(self, base: Commit, months: list[str] | None, rows: DataFrame, all_months, state: dict) -> Commit:
        """``rows``, which have a month, in place of ``months`` (None: of everything; their months are among ``all_months``)."""
        (new,) = self.write(rows)
        here = tuple(sorted(all_months if months is None else months))
        kept = [] if months is None else [
            f if live == f.live else replace(f, live=live, part=True) for f in base.folders
            if (live := tuple(m for m in f.live if m not in here))]
        done = self.commit(base, [*kept, replace(new, live=here)], rows.schema, state)
        if len(done.folders) <= MOST_PARTS:
            return done
        (joined,) = self.write(self.read(done))
        return self.commit(done, [replace(joined, live=tuple(done.months()))])

    def vacuum(self, keep: int = KEPT_VERSIONS) -> int:
        """Remove what none of the last ``keep`` versions names; returns how many data folders went.

        Not while another run is writing the table: what it has written is not named yet.
        """
        numbers = self._numbers()
        named = {f.path.split("/")[0] for n in numbers[-keep:] for f in self._commit(n).folders}
        gone = [n for n in list_names(self.spark, self.path) if n.startswith("data-") and n not in named]
        for n in numbers[:-keep]:
            delete(self.spark, f"{self.path}/{LOG}/{n:012d}.json")
        for n in gone:
            delete(self.spark, f"{self.path}/{n}")
        return len(gone)


__all__ = ["Commit", "Folder", "KEPT_VERSIONS", "MONTH", "VersionedTable"]
