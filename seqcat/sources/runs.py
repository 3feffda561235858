"""Tables that grow run by run.

Every run writes folders of its own (``<root>/<table>/run=<n>``), and one row in ``<root>/commits``, written last, makes them
visible.  Nothing that a former run wrote is touched, so readers see whole runs only, and a run that died is simply
done again under the same number.  Two kinds of table:

* grown: all rows of all runs (``append`` / ``rows``);
* keyed: a run writes the whole new state of some keys (``replace``), and of each key the last run that names
  it counts (``current``); a key may be named without rows: it is gone.

The commit row keeps the schema of every table, so files are read with a declared schema: columns that later runs add
are null in older files, and no footers are merged.
"""

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seqcat.operators._join import null_safe_join
from seqcat.sources.folders import exists, remove, subfolders
from seqcat.sources.tables import stage_write

COMMIT = "run int, base int, schemas string"


class SchemaChanged(ValueError):
    """A column has another type than in the stored runs: only a full refresh can unite them."""


def _merged(old: T.StructType | None, new: T.StructType, table: str) -> T.StructType:
    if old is None:
        return new
    fields = {f.name: f for f in old.fields}
    for f in new.fields:
        if f.name in fields and f.dataType.simpleString() != fields[f.name].dataType.simpleString():
            raise SchemaChanged(f"{table}.{f.name}: {fields[f.name].dataType.simpleString()} was stored, now {f.dataType.simpleString()}")
        fields.setdefault(f.name, f)
    return T.StructType(list(fields.values()))


class Runs:
    """The tables below ``root``.  ``full_refresh`` starts a new base: what former runs wrote no longer counts."""

    def __init__(self, spark: SparkSession, root: str, *, full_refresh: bool = False) -> None:
        self.spark, self.root = spark, root.rstrip("/")
        last = self._last_commit()
        self.committed = last["run"] if last else 0
        self.base = 1 if last is None else last["base"]
        self.schemas = {} if last is None else {k: T.StructType.fromJson(v) for k, v in json.loads(last["schemas"]).items()}
        self.run = self.committed  # readable up to here; a started run reads its own tables too
        if full_refresh:
            self.base, self.schemas = self.committed + 1, {}

    def _last_commit(self):
        path = f"{self.root}/commits"
        if not exists(self.spark, path):
            return None
        return self.spark.read.schema(COMMIT).parquet(path).orderBy(F.desc("run")).first()

    def start(self) -> int:
        """Begin the next run.  Folders that a former, uncommitted try at the same number left are removed."""
        self.run = self.committed + 1
        for table in subfolders(self.spark, self.root) if exists(self.spark, self.root) else []:
            if table != "commits":
                remove(self.spark, f"{self.root}/{table}/run={self.run}")
        return self.run

    def commit(self) -> None:
        schemas = json.dumps({k: v.jsonValue() for k, v in self.schemas.items()})
        row = self.spark.createDataFrame([(self.run, self.base, schemas)], COMMIT)
        row.coalesce(1).write.mode("append").parquet(f"{self.root}/commits")
        self.committed = self.run

    def _write(self, table: str, df: DataFrame, partition_by: str | None = None, sort_by=()) -> None:
        self.schemas[table] = _merged(self.schemas.get(table), df.schema, table)
        stage_write(df, f"{self.root}/{table}/run={self.run}", partition_by=partition_by, sort_by=sort_by)

    def _read(self, table: str) -> DataFrame:
        schema = T.StructType([*self.schemas[table].fields, T.StructField("run", T.IntegerType())])
        df = self.spark.read.schema(schema).option("basePath", f"{self.root}/{table}").parquet(f"{self.root}/{table}")
        return df.where(F.col("run").between(self.base, self.run)).withColumnRenamed("run", "_run").select(
            *self.schemas[table].fieldNames(), "_run")

    def has(self, table: str) -> bool:
        return table in self.schemas

    def append(self, table: str, df: DataFrame, partition_by: str | None = None) -> None:
        """Add rows (of this run only) to a grown table."""
        self._write(table, df, partition_by)

    def rows(self, table: str) -> DataFrame:
        """All rows of a grown table."""
        return self._read(table).drop("_run")

    def new_rows(self, table: str) -> DataFrame:
        """The rows that the current run added."""
        return self._read(table).where(F.col("_run") == self.run).drop("_run")

    def replace(self, table: str, key: str, keys: DataFrame, rows: DataFrame, partition_by: str | None = None, sort_by=()) -> None:
        """The new state of ``keys`` (one column): ``rows`` must hold those keys only."""
        self._write(f"{table}_keys", keys.select(key).distinct())
        self._write(table, rows, partition_by, sort_by)

    def current(self, table: str, key: str) -> DataFrame:
        """The rows of each key from the last run that names it.  Partitions of other runs are pruned where the
        key is the partition column."""
        heads = self._read(f"{table}_keys").groupBy(key).agg(F.max("_run").alias("_run"))
        return null_safe_join(self._read(table), heads, [key, "_run"], "left_semi").drop("_run")
