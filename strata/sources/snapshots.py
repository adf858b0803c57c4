"""Snapshot tables: Parquet partitioned by an as-of column, rerun-safe.

Writing period P replaces partition P only (dynamic partition overwrite, or
the partition's removal if the new result is empty), so rerunning a step is
idempotent -- the stand-in for the reference's
``INSERT`` / ``ON CONFLICT DO UPDATE`` on a keyed table. Reading one period
is a partition-pruned scan. Each written step also cuts the lineage of a
period-by-period fold, so a lost executor only recomputes one step.

Columns may change while periods are kept (``rename_column``, ``add_column``,
``widen_column``): a small file beside the partitions lists each column's
name, its name inside the files and its type. Files are never rewritten: old
partitions are read under the new names, and a column that they lack is NULL
there. A write must bring exactly the table's columns.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import json
from collections.abc import Sequence
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    ByteType,
    DataType,
    DateType,
    IntegerType,
    LongType,
    MapType,
    ShortType,
    StructField,
    StructType,
)

from ..session import state_path
from .versions import Folder

COLUMNS = "_columns"  # names starting with _ are not data to Spark

NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"  # how Spark names the folder of a NULL value


class ColumnMismatchError(ValueError):
    """Rows do not have exactly the columns of the stored table."""


def _widens(old: DataType, new: DataType) -> bool:
    """``new`` is ``old``, perhaps with further fields inside its structs (by name, at any depth)."""
    if isinstance(old, StructType) and isinstance(new, StructType):
        return all(f.name in new.names and _widens(f.dataType, new[f.name].dataType) for f in old)
    if isinstance(old, ArrayType) and isinstance(new, ArrayType):
        return _widens(old.elementType, new.elementType)
    if isinstance(old, MapType) and isinstance(new, MapType):
        return old.keyType == new.keyType and _widens(old.valueType, new.valueType)
    return old == new


def _nullable(dtype: DataType) -> DataType:
    """The type as files give it back: everything inside may be NULL."""
    if isinstance(dtype, StructType):
        return StructType([StructField(f.name, _nullable(f.dataType)) for f in dtype])
    if isinstance(dtype, ArrayType):
        return ArrayType(_nullable(dtype.elementType))
    if isinstance(dtype, MapType):
        return MapType(dtype.keyType, _nullable(dtype.valueType))
    return dtype


def _parse_partition_value(text: str, dtype):
    if text == NULL_PARTITION:
        return None
    if isinstance(dtype, (IntegerType, LongType, ShortType, ByteType)):
        return int(text)
    if isinstance(dtype, DateType):
        return dt.date.fromisoformat(text)
    return text


class SnapshotTable:
    def __init__(
        self,
        spark: SparkSession,
        path: str,
        as_of_col: str,
        sort_cols: Sequence[str] = (),
        buckets: int | None = None,
    ) -> None:
        """``buckets`` (optional) stores the table bucketed by its first sort
        column (the entity key) through the session catalog. A later step's
        join on that key then reads the state already hash-partitioned and
        shuffles only the other side (the period's new rows) instead of the
        whole state. Choose at least ``spark.sql.shuffle.partitions`` buckets.
        """
        self.spark = spark
        self.path = path
        self.as_of_col = as_of_col
        self.sort_cols = list(sort_cols)
        self.schema: StructType | None = None
        self.stored_names: dict[str, str] = {}  # column to its name in the files, where the two differ
        self.written: list = []
        if buckets and not self.sort_cols:
            raise ValueError("a bucketed table needs a key in sort_cols")
        self.buckets = buckets
        self.table_name = "strata_" + hashlib.sha1(path.encode()).hexdigest()[:16] if buckets else None

    @classmethod
    def scratch(
        cls, spark: SparkSession, name: str, as_of_col: str, sort_cols: Sequence[str] = (), buckets: int | None = None
    ) -> SnapshotTable:
        """A fresh table under the shared checkpoint folder."""
        return cls(spark, state_path(spark, name), as_of_col, sort_cols, buckets)

    @classmethod
    def at(
        cls, spark: SparkSession, path: str, as_of_col: str, sort_cols: Sequence[str] = (), buckets: int | None = None
    ) -> SnapshotTable:
        """The table stored at ``path``: re-opened if it exists, else a new (empty) one."""
        try:
            return cls.open(spark, path, as_of_col, sort_cols, buckets)
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return cls(spark, path, as_of_col, sort_cols, buckets)  # nothing written there yet

    @classmethod
    def open(
        cls, spark: SparkSession, path: str, as_of_col: str, sort_cols: Sequence[str] = (), buckets: int | None = None
    ) -> SnapshotTable:
        """Re-open a table written earlier (e.g. by a driver that was restarted).

        The schema comes from the table's list of columns if they were ever
        changed, else from the Parquet footers, and the written periods from
        the partition directory names. A bucketed table is registered in the
        session catalog again if this session does not know it.
        """
        table = cls(spark, path, as_of_col, sort_cols, buckets)
        table.schema = spark.read.parquet(path).schema
        table._load_columns()
        if buckets and not spark.catalog.tableExists(table.table_name):
            stored = table._stored_schema()
            cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in stored.fields)
            key = table.stored_name(table.sort_cols[0])
            spark.sql(
                f"CREATE TABLE {table.table_name} ({cols}) USING parquet PARTITIONED BY (`{as_of_col}`) "
                f"CLUSTERED BY (`{key}`) SORTED BY (`{key}`) INTO {buckets} BUCKETS LOCATION '{path}'"
            )
            spark.sql(f"ALTER TABLE {table.table_name} RECOVER PARTITIONS")  # catalog learns the stored periods
        table.written = table.periods()
        return table

    def _listing(self, *below: str) -> list:
        """Entries of the table's folder or of one below it: one listing, no job; empty if it is absent."""
        jvm = self.spark._jvm
        path = jvm.org.apache.hadoop.fs.Path("/".join([self.path.rstrip("/"), *below]))
        files = path.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf())
        return list(files.listStatus(path)) if files.exists(path) else []

    def _folders(self) -> dict[str, object]:
        """As-of partition folders: name to value."""
        dtype = self.schema[self.as_of_col].dataType
        names = [s.getPath().getName() for s in self._listing() if s.isDirectory()]
        prefix = f"{self.as_of_col}="
        return {n: _parse_partition_value(unquote(n[len(prefix) :]), dtype) for n in names if n.startswith(prefix)}

    def files_of(self, as_of) -> set[str]:
        """Names of the files that hold period ``as_of``."""
        if self.schema is None:
            return set()
        folders = [name for name, value in self._folders().items() if value == as_of]
        return {s.getPath().getName() for name in folders for s in self._listing(name)}

    def periods(self) -> list:
        """As-of values present in storage (NULL last), from the partition folders' names."""
        if self.schema is None:
            raise ValueError("table has not been written yet")
        return sorted(set(self._folders().values()), key=lambda v: (v is None, v if v is not None else 0))

    def drop_period(self, as_of) -> None:
        """Remove a period's folder (a rerun whose result is empty)."""
        jvm = self.spark._jvm
        for name in [name for name, value in self._folders().items() if value == as_of]:
            path = jvm.org.apache.hadoop.fs.Path(f"{self.path.rstrip('/')}/{name}")
            path.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf()).delete(path, True)
        if self.buckets:
            self.spark.sql(f"ALTER TABLE {self.table_name} DROP IF EXISTS PARTITION ({self.as_of_col}='{as_of}')")
        self.written = [w for w in self.written if w != as_of]

    def write(self, df: DataFrame, mode: str = "overwrite") -> None:
        """Write (replace) the as-of partitions present in ``df``.

        Rows are sorted by key within each task before the write so equal
        keys sit together in the Parquet pages (run-length / dictionary
        friendly), as the reference notes for sorted names.
        """
        if self.schema is None:
            self.schema = df.schema
        rows = self._to_stored(df)
        if self.buckets:
            self._write_bucketed(rows)
            return
        # REBALANCE on the partition column: AQE cuts the output into
        # advisory-size tasks (splitting a large as-of partition, merging
        # small ones), so each as-of directory gets a few well-sized files
        # instead of one file per upstream task.
        out = rows.hint("rebalance", self.as_of_col)
        if self.sort_cols:
            # partition column first: it is the order the partitioned writer
            # needs anyway, so Spark sorts once instead of twice
            out = out.sortWithinPartitions(self.as_of_col, *[self.stored_name(c) for c in self.sort_cols])
        (
            out.write.mode(mode)
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(self.as_of_col)
            .parquet(self.path)
        )

    def _write_bucketed(self, out: DataFrame) -> None:
        key = self.stored_name(self.sort_cols[0])
        if not self.spark.catalog.tableExists(self.table_name):
            (
                out.write.bucketBy(self.buckets, key)
                .sortBy(key)
                .partitionBy(self.as_of_col)
                .mode("overwrite")
                .option("path", self.path)
                .saveAsTable(self.table_name)
            )
            return
        # replace only the as-of partitions present in ``out``; insertInto
        # takes the session's overwrite mode, so set it for this write only
        conf = "spark.sql.sources.partitionOverwriteMode"
        before = self.spark.conf.get(conf)
        self.spark.conf.set(conf, "dynamic")
        try:
            out.select(*self.spark.table(self.table_name).columns).write.insertInto(self.table_name, overwrite=True)
        finally:
            self.spark.conf.set(conf, before)

    def replace(self, df: DataFrame) -> None:
        """Truncate and reload: the table afterwards holds exactly ``df``'s periods.

        The stand-in for TRUNCATE followed by INSERT; a static overwrite drops
        every as-of partition that ``df`` does not contain. The new files hold
        the columns under their present names.
        """
        self.schema = df.schema if self.schema is None else self.schema
        self._check_columns(df)
        out = df.select(*self.schema.fieldNames())
        self.stored_names = {}
        if self.buckets:
            key = self.sort_cols[0]
            (
                out.write.bucketBy(self.buckets, key)
                .sortBy(key)
                .partitionBy(self.as_of_col)
                .mode("overwrite")
                .option("path", self.path)
                .saveAsTable(self.table_name)
            )
        else:
            (
                out.hint("rebalance", self.as_of_col)
                .sortWithinPartitions(self.as_of_col, *self.sort_cols)
                .write.mode("overwrite")
                .option("partitionOverwriteMode", "static")
                .partitionBy(self.as_of_col)
                .parquet(self.path)
            )
        Folder(self.spark, self.path).remove(COLUMNS)
        self.written = self.periods()

    def write_period(self, df: DataFrame, as_of) -> None:
        """Replace partition ``as_of``; an empty result removes it, so no old rows stay behind."""
        before = self.files_of(as_of)
        self.write(df)
        after = self.files_of(as_of)
        if before and after == before:  # nothing was written in its place
            self.drop_period(as_of)
        elif after and as_of not in self.written:
            self.written.append(as_of)

    def read(self, as_of=None, as_of_in: Sequence | None = None) -> DataFrame:
        if self.schema is None:
            raise ValueError("table has not been written yet")
        if self.buckets:
            df = self.spark.table(self.table_name)  # bucketed scan: hash-partitioned by the key
        else:
            df = self.spark.read.schema(self._stored_schema()).parquet(self.path)
        if as_of is not None:
            df = df.where(F.col(self.as_of_col) == F.lit(as_of))
        if as_of_in is not None:
            df = df.where(F.col(self.as_of_col).isin(list(as_of_in)))
        return df.select(*[F.col(f"`{self.stored_name(c)}`").alias(c) for c in self.schema.fieldNames()])

    def has(self, as_of) -> bool:
        return as_of in self.written

    # ------------------------------------------------------------ columns

    def stored_name(self, column: str) -> str:
        """The column's name inside the files."""
        return self.stored_names.get(column, column)

    def _stored_schema(self) -> StructType:
        return StructType([StructField(self.stored_name(f.name), f.dataType) for f in self.schema])

    def _load_columns(self) -> None:
        text = Folder(self.spark, self.path).read(COLUMNS)
        if text is not None:
            columns = json.loads(text)
            self.schema = StructType.fromJson({"type": "struct", "fields": [c["field"] for c in columns]})
            self.stored_names = {c["field"]["name"]: c["stored"] for c in columns}

    def _change_columns(self, fields: Sequence[StructField], stored_names: dict[str, str]) -> None:
        """Switch to other columns: the list on storage first, replaced in one step, then this object."""
        columns = [{"field": f.jsonValue(), "stored": stored_names.get(f.name, f.name)} for f in fields]
        Folder(self.spark, self.path).write(COLUMNS, json.dumps(columns))
        self.schema = StructType(list(fields))
        self.stored_names = stored_names

    def _check_columns(self, df: DataFrame) -> None:
        unknown = [c for c in df.columns if c not in self.schema.names]
        missing = [c for c in self.schema.names if c not in df.columns]
        if unknown or missing:
            raise ColumnMismatchError(f"{self.path}: unknown columns {unknown}, missing columns {missing}")
        for f in self.schema:  # a column may lack fields that were added inside it
            if not _widens(_nullable(df.schema[f.name].dataType), _nullable(f.dataType)):
                got = df.schema[f.name].dataType.simpleString()
                raise ColumnMismatchError(f"{self.path}: {f.name} is {f.dataType.simpleString()}, not {got}")

    def _to_stored(self, df: DataFrame) -> DataFrame:
        """``df`` as the files hold it; other columns than the table's are an error."""
        self._check_columns(df)
        return df.select(*[F.col(f"`{c}`").alias(self.stored_name(c)) for c in self.schema.names])

    def _column(self, name: str) -> StructField:
        if self.schema is None:
            raise ValueError("table has not been written yet")
        if name not in self.schema.names:
            raise ColumnMismatchError(f"{self.path}: no column {name!r}")
        return self.schema[name]

    def rename_column(self, old: str, new: str) -> None:
        """``ALTER TABLE ... RENAME COLUMN``: every period, old or new, has the column as ``new`` from now on."""
        field = self._column(old)
        if old == self.as_of_col:
            raise ColumnMismatchError(f"{self.path}: the as-of column names the folders and keeps its name")
        if new in self.schema.names:
            raise ColumnMismatchError(f"{self.path}: column {new!r} exists")
        fields = [StructField(new, f.dataType, f.nullable) if f is field else f for f in self.schema]
        names = {new if c == old else c: stored for c, stored in self.stored_names.items()}
        self._change_columns(fields, {**names, new: self.stored_name(old)})
        self.sort_cols = [new if c == old else c for c in self.sort_cols]

    def add_column(self, name: str, dtype: DataType) -> None:
        """``ALTER TABLE ... ADD COLUMN``: NULL in the periods written before."""
        self._column(self.as_of_col)
        if name in self.schema.names:
            raise ColumnMismatchError(f"{self.path}: column {name!r} exists")
        # a column renamed away may still hold the name inside the files
        taken = {self.stored_name(c).lower() for c in self.schema.names}
        stored, n = name, 1
        while stored.lower() in taken:
            stored, n = f"{name}_{n}", n + 1
        if self.buckets:
            self.spark.sql(f"ALTER TABLE {self.table_name} ADD COLUMNS (`{stored}` {dtype.simpleString()})")
        fields = [f for f in self.schema if f.name != self.as_of_col]
        fields += [StructField(name, dtype), self.schema[self.as_of_col]]
        self._change_columns(fields, {**self.stored_names, name: stored})

    def widen_column(self, name: str, dtype: DataType) -> None:
        """Add fields inside a column's structs (say, a new stat in a history): NULL in the entries written before.

        Fields go by name; none may be lost or change its type. Bucketed
        tables, whose columns the session catalog holds, cannot be widened.
        """
        field = self._column(name)
        if self.buckets:
            raise ColumnMismatchError(f"{self.path}: columns of a bucketed table cannot be widened")
        if not _widens(_nullable(field.dataType), _nullable(dtype)):
            raise ColumnMismatchError(f"{self.path}: {dtype.simpleString()} loses fields of {name!r}")
        fields = [StructField(name, _nullable(dtype)) if f is field else f for f in self.schema]
        self._change_columns(fields, self.stored_names)
