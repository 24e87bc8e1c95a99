"""Where tables live: the catalog, a folder of files, or a store behind a connector.

The catalog and folders can replace a table at once: its parts are written to a
staged table of the same store (``staged``), which readers and listings do not
see, and then takes the name of the old one (``switch``). A switch is entered in
a log before it starts, so one that was cut off is ended by the next writer
(``end_switches``).
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from courtside.operators.catalog import list_tables
from courtside.sources.csv import table_paths


# Names that begin like this are staged tables, or old ones on their way out.
STAGED, RETIRED = "__staged_", "__retired_"


@dataclass(frozen=True)
class CatalogStore:
    """A database of the session's catalog."""

    database: str
    format: str = "parquet"

    def _name(self, table: str) -> str:
        return f"`{self.database}`.`{table}`"

    def tables(self, spark: SparkSession) -> list[str]:
        names = [name for _, name in list_tables(spark, [self.database])]
        return [n for n in names if not n.startswith((STAGED, RETIRED))]

    def read(self, spark: SparkSession, table: str) -> DataFrame:
        return spark.table(self._name(table))

    def write(self, df: DataFrame, table: str, mode: str = "overwrite") -> None:
        """``mode``: overwrite, append, ignore (keep what is there) or error."""
        df.write.format(self.format).mode(mode).saveAsTable(self._name(table))

    def drop(self, spark: SparkSession, table: str) -> None:
        spark.sql(f"DROP TABLE IF EXISTS {self._name(table)}")

    def staged(self, spark: SparkSession, table: str) -> str:
        """The name of an empty place for the parts of a table."""
        self.drop(spark, STAGED + table)
        return STAGED + table

    def switch(self, spark: SparkSession, table: str) -> None:
        """Let what was staged be the table. The old one is kept until the new one has its name."""
        self.drop(spark, RETIRED + table)
        if spark.catalog.tableExists(self._name(table)):
            spark.sql(f"ALTER TABLE {self._name(table)} RENAME TO {self._name(RETIRED + table)}")
        spark.sql(f"ALTER TABLE {self._name(STAGED + table)} RENAME TO {self._name(table)}")
        self.drop(spark, RETIRED + table)

    def end_switches(self, spark: SparkSession) -> list[str]:
        """Tables whose switch was cut off and is ended now: the catalog's names are the log.

        Only between its two steps has a table an old form and no present one.
        """
        names = {name for _, name in list_tables(spark, [self.database])}
        cut = sorted(n.removeprefix(RETIRED) for n in names if n.startswith(RETIRED))
        for table in cut:
            if table not in names:
                # The staged table was whole before the old one was put aside.
                form = STAGED if STAGED + table in names else RETIRED
                spark.sql(f"ALTER TABLE {self._name(form + table)} RENAME TO {self._name(table)}")
            self.drop(spark, RETIRED + table)
        return cut


@dataclass(frozen=True)
class FolderStore:
    """One folder or file per table: ``<path>/<table>.<format>``."""

    path: str
    format: str = "parquet"
    options: dict = field(default_factory=dict)

    def _options(self) -> dict:
        """CSV quotes are doubled and cells may hold line breaks, as the loader reads them."""
        spaces = {"ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
        return {"escape": '"', "multiLine": "true", **spaces, **self.options} if self.format == "csv" else self.options

    def _path(self, table: str) -> str:
        return f"{self.path.rstrip('/')}/{table}.{self.format}"

    def tables(self, spark: SparkSession) -> list[str]:
        ending = f".{self.format}"
        return [step.removesuffix(ending) for step in table_paths(spark, self.path, ending)]

    def read(self, spark: SparkSession, table: str) -> DataFrame:
        return spark.read.format(self.format).options(**self._options()).load(self._path(table))

    def write(self, df: DataFrame, table: str, mode: str = "overwrite") -> None:
        df.write.format(self.format).options(**self._options()).mode(mode).save(self._path(table))

    def drop(self, spark: SparkSession, table: str) -> None:
        files, path = self._files(spark, self._path(table))
        files.delete(path, True)

    def _files(self, spark: SparkSession, name: str):
        """The file system of a path, and the path."""
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(name)
        return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), path

    def _log(self, kind: str) -> str:
        # Spark's listings leave out names that begin with an underscore.
        return f"{self.path.rstrip('/')}/_{kind}"

    def staged(self, spark: SparkSession, table: str) -> str:
        """The name of an empty place for the parts of a table."""
        self.drop(spark, f"_staged/{table}")
        return f"_staged/{table}"

    def switch(self, spark: SparkSession, table: str) -> None:
        """Let what was staged be the table.

        The log entry is made first: from then on the new table is what counts,
        and :meth:`end_switches` does what this call could not.
        """
        files, entry = self._files(spark, f"{self._log('switches')}/{table}")
        files.mkdirs(entry)
        self._end_switch(spark, table)

    def _end_switch(self, spark: SparkSession, table: str) -> None:
        files, entry = self._files(spark, f"{self._log('switches')}/{table}")
        _, staged = self._files(spark, self._path(f"_staged/{table}"))
        _, present = self._files(spark, self._path(table))
        _, old = self._files(spark, f"{self._log('retired')}/{table}")
        # Each step may be done again: without a staged table it has its name already.
        if files.exists(staged):
            moved = True
            if files.exists(present):
                files.mkdirs(old)
                _, retired = self._files(spark, f"{self._log('retired')}/{table}/{uuid.uuid4().hex}")
                moved = files.rename(present, retired)
            if not (moved and files.rename(staged, present)):
                raise OSError(f"{table}: the staged table could not take its name; the switch stays in the log")
        files.delete(old, True)
        files.delete(entry, True)

    def end_switches(self, spark: SparkSession) -> list[str]:
        """Tables whose switch was cut off and is ended now."""
        files, log = self._files(spark, self._log("switches"))
        cut = sorted(entry.getPath().getName() for entry in files.listStatus(log)) if files.exists(log) else []
        for table in cut:
            self._end_switch(spark, table)
        return cut


@dataclass(frozen=True)
class ConnectorStore:
    """Tables behind a connector: a relational store by JDBC, or a warehouse by its own format.

    ``bounds`` names, per table, a whole-number column with its ends and a count:
    the table is then read in so many ranges at once instead of in pages one
    after the other.
    """

    format: str = "jdbc"
    options: dict = field(default_factory=dict)
    table_option: str = "dbtable"
    listing: str | None = None
    bounds: dict = field(default_factory=dict)
    write_options: dict = field(default_factory=lambda: {"batchsize": "50000"})

    def read_options(self, table: str) -> dict[str, str]:
        options = {**self.options, self.table_option: table}
        if table in self.bounds:
            column, low, high, parts = self.bounds[table]
            options.update(
                partitionColumn=column, lowerBound=str(low), upperBound=str(high), numPartitions=str(parts)
            )
        return options

    def tables(self, spark: SparkSession) -> list[str]:
        if self.listing is None:
            raise ValueError("this store needs a query that lists its tables")
        rows = spark.read.format(self.format).options(**self.options, query=self.listing).load()
        return sorted(row[0] for row in rows.collect())

    def read(self, spark: SparkSession, table: str) -> DataFrame:
        return spark.read.format(self.format).options(**self.read_options(table)).load()

    def write(self, df: DataFrame, table: str, mode: str = "overwrite") -> None:
        options = {**self.options, **self.write_options, self.table_option: table}
        df.write.format(self.format).options(**options).mode(mode).save()

    def external_table(self, name: str, table: str) -> str:
        """The statement that makes the table readable under a name of the catalog."""
        listed = ", ".join(f"{key} '{value}'" for key, value in self.read_options(table).items())
        return f"CREATE TABLE {name} USING {self.format} OPTIONS ({listed})"
