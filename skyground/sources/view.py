"""The latest row per key of a day table, kept up to date file by file."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from skyground.operators.current import latest_by
from skyground.session import remove_folder
from skyground.sources.tables import read_table

BUCKETS = 200


def newer(old: DataFrame, new: DataFrame, key: str, order: list[str]) -> DataFrame:
    """Of each key the row that comes first in falling ``order``; of equal ones the old. Both sides have one row per key.

    A full outer join on the key: the side that is stored bucketed by it stays where it is.
    """
    columns = old.columns
    left = old.select(F.col(key).alias("_old_key"), F.struct(*columns).alias("_old"))
    right = new.select(F.col(key).alias("_new_key"), F.struct(*columns).alias("_new"))
    both = left.join(right.hint("merge"), F.col("_old_key") == F.col("_new_key"), "full_outer")
    rank = lambda side: F.struct(*[F.col(f"{side}.{c}") for c in order])  # noqa: E731  a null comes below any value
    wins = F.col("_old_key").isNull() | (F.col("_new_key").isNotNull() & (rank("_new") > rank("_old")))
    return both.select(F.when(wins, F.col("_new")).otherwise(F.col("_old")).alias("_row")).select("_row.*")


class CurrentView:
    """The latest row of each key of the day table at ``table``, stored below ``folder``, bucketed by the key.

    ``order`` names the columns whose largest values make a row the latest. :meth:`refresh` reads the files that came since the last
    time and merges their latest rows into the stored ones: days that did not change are not read, however
    many there are, and the stored side of the join does not move. Where files are gone, as after a day was replaced, the view is
    made anew, since what they won cannot be taken back. A refresh writes a new version and names the merged files last, so one
    that failed half-way leaves the version before, and running it again is safe.

    Bucketing is known to the session's catalog; a session without the tables makes the view anew.
    """

    def __init__(
        self, spark: SparkSession, name: str, folder: str, table: str, schema: StructType, key: str, order: list[str], buckets: int = BUCKETS
    ):
        if not re.fullmatch(r"[A-Za-z_]\w*", name):
            raise ValueError(f"{name!r} names no table")
        self.spark, self.name, self.folder, self.table = spark, name.lower(), folder, table
        self.schema, self.key, self.order, self.buckets = schema, key, order, buckets

    def _rows(self) -> DataFrame:
        return read_table(self.spark, self.table, self.schema)

    def _version(self) -> int:
        """The last version whose list of files was written; 0 before the first."""
        names = [t.name for t in self.spark.catalog.listTables(pattern=f"{self.name}_files_*")]
        found = (re.fullmatch(rf"{self.name}_files_(\d+)", n) for n in names)
        return max([0, *(int(m[1]) for m in found if m)])

    def _drop(self, kind: str, version: int) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}_{kind}_{version}")
        remove_folder(self.spark, f"{self.folder}/{kind}_{version}")

    def _save(self, df: DataFrame, kind: str, version: int, bucketed: bool) -> None:
        # What a refresh that failed left behind has the name, but is not listed.
        self._drop(kind, version)
        writer = df.write.format("parquet").option("path", f"{self.folder}/{kind}_{version}")
        if bucketed:
            writer = writer.bucketBy(self.buckets, self.key).sortBy(self.key)
        writer.saveAsTable(f"{self.name}_{kind}_{version}")

    def pending(self) -> tuple[list[str], bool]:
        """Names of the table's files that are not merged yet, and whether merged ones are gone. Names and footers are read, no rows."""
        live = self._rows().select(F.col("_metadata.file_path").alias("file")).distinct()
        version = self._version()
        if not version:
            return [r["file"] for r in live.collect()], False
        merged = self.spark.table(f"{self.name}_files_{version}")
        gone = merged.join(live, "file", "left_anti").limit(1).count() > 0
        return [r["file"] for r in live.join(merged, "file", "left_anti").collect()], gone

    def latest_of(self, files: list[str]) -> DataFrame:
        """The latest rows with a key among those of ``files``, dealt like the buckets."""
        rows = self._rows().filter(F.col("_metadata.file_path").isin(files) & F.col(self.key).isNotNull())
        order: list[Column] = [F.col(c).desc_nulls_last() for c in self.order]
        # The columns before what file names add.
        return latest_by(rows, self.key, *order).select(*self.schema.fieldNames()).repartition(self.buckets, self.key)

    def refresh(self) -> int:
        """Merge what came since the last time; returns the number of files read."""
        files, gone = self.pending()
        version = self._version()
        if gone:
            files = [r["file"] for r in self._rows().select(F.col("_metadata.file_path").alias("file")).distinct().collect()]
        if not files and not gone and version:
            return 0
        new = self.latest_of(files)
        fresh = self.spark.createDataFrame([(f,) for f in files], "file string")
        if version and not gone:
            new = newer(self.spark.table(f"{self.name}_rows_{version}"), new, self.key, self.order)
            fresh = fresh.unionByName(self.spark.table(f"{self.name}_files_{version}"))
        self._save(new, "rows", version + 1, bucketed=True)
        self._save(fresh, "files", version + 1, bucketed=False)
        # Whoever reads the version before may go on; the one before that goes.
        if version > 1:
            for kind in ("rows", "files"):
                self._drop(kind, version - 1)
        return len(files)

    def read(self, unkeyed: bool = True) -> DataFrame:
        """The latest row of each key as of the last refresh, and all rows of the table without a key unless told otherwise."""
        version = self._version()
        rows = self.spark.table(f"{self.name}_rows_{version}") if version else self.spark.createDataFrame([], self.schema)
        if not unkeyed:
            return rows
        # Row groups without a null are left out by their statistics.
        without = self._rows().filter(F.col(self.key).isNull()).select(*self.schema.fieldNames())
        return rows.unionByName(without)
