"""Tables as Parquet folders, and the ways rows are merged into them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from claimcheck import schemas

PARTITIONS = {"messages": ["group_id"], "bars": ["instrument", "interval", "day"]}


def _first_of_key(df: DataFrame, keys: list[str], order: list) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("__r", F.row_number().over(w)).where("__r = 1").drop("__r")


def new_rows(existing: DataFrame, incoming: DataFrame, table: str, order: list[str]) -> DataFrame:
    """Incoming rows whose key is new, the first of each key: insert or ignore."""
    keys = schemas.KEYS[table]
    return _first_of_key(incoming.join(existing.select(keys), keys, "left_anti"), keys, order)


def merged(existing: DataFrame, incoming: DataFrame, table: str, keep: list[str] | None = None) -> DataFrame:
    """All rows, incoming ones in place of existing ones of their key: insert or replace.

    ``keep``: columns that keep the existing value where there is one, as an
    update that leaves them alone.
    """
    keys, keep = schemas.KEYS[table], keep or []
    old, new = existing.withColumn("__new", F.lit(0)), incoming.withColumn("__new", F.lit(1))
    if not keep:
        return _first_of_key(old.unionByName(new), keys, [F.desc("__new")]).drop("__new")
    cols = [c for c in existing.columns if c not in keys]
    o = existing.select(*keys, F.struct(*cols).alias("o"))
    n = _first_of_key(incoming, keys, keys).select(*keys, F.struct(*cols).alias("n"))
    both = o.join(n, keys, "full")
    pick = lambda c: F.when(F.col("n").isNull() | (F.lit(c in keep) & F.col("o").isNotNull()), F.col(f"o.{c}")).otherwise(F.col(f"n.{c}"))
    return both.select(*keys, *[pick(c).alias(c) for c in cols]).select(existing.columns)


def write(df: DataFrame, path: str, table: str) -> None:
    """Overwrites the partitions that the rows touch (all of it for a table without partitions)."""
    if table == "bars":
        df = df.withColumn("day", F.to_date("ts"))
    w = df.write.mode("overwrite")
    if table in PARTITIONS:
        w = w.option("partitionOverwriteMode", "dynamic").partitionBy(*PARTITIONS[table])
    w.parquet(path)


def read(spark: SparkSession, path: str, group: str | None = None) -> DataFrame:
    """A table; a group's rows only where asked, which prunes partitions or reaches the scan."""
    df = spark.read.parquet(path)
    return df if group is None else df.where(F.col("group_id") == group)


def lookup(outcomes: DataFrame, signal_id: str) -> DataFrame:
    """The outcome rows of one signal."""
    return outcomes.where(F.col("signal_id") == signal_id)


class Store:
    """The tables of a data folder, each a row of versions: NAME/v000001, NAME/v000002, ..

    A table is replaced by a new version, which counts once Spark has marked it
    complete; readers of the one before are left alone, as are its files while
    the new one is made from them.  Older versions are removed.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _fs(self, path: str):
        at = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return at.getFileSystem(self.spark._jsc.hadoopConfiguration()), at

    def _versions(self, name: str) -> list[tuple[int, bool]]:
        fs, at = self._fs(f"{self.root}/{name}")
        if not fs.exists(at):
            return []
        found = [x.getPath().getName() for x in fs.listStatus(at) if x.isDirectory()]
        numbers = sorted(int(n[1:]) for n in found if n[:1] == "v" and n[1:].isdigit())
        return [(n, fs.exists(self._fs(f"{self._at(name, n)}/_SUCCESS")[1])) for n in numbers]

    def _at(self, name: str, version: int) -> str:
        return f"{self.root}/{name}/v{version:06d}"

    def path(self, name: str) -> str | None:
        """The folder of the newest complete version."""
        done = [n for n, complete in self._versions(name) if complete]
        return self._at(name, done[-1]) if done else None

    def get(self, name: str) -> DataFrame | None:
        path = self.path(name)
        if path is None:
            return None
        df = self.spark.read.parquet(path)
        return schemas.decoded(df, name) if name in schemas.TABLES else df

    def __getitem__(self, name: str) -> DataFrame:
        df = self.get(name)
        if df is None:
            raise KeyError(f"{self.root} has no table {name}")
        return df

    def empty(self, name: str) -> DataFrame:
        return self.spark.createDataFrame([], schemas.TABLES[name])

    def replace(self, name: str, df: DataFrame) -> int:
        """Writes a table anew and returns its rows; ``df`` may read the version before."""
        seen = self._versions(name)
        df.write.parquet(self._at(name, seen[-1][0] + 1 if seen else 1))
        for n, _ in seen[:-1]:
            fs, at = self._fs(self._at(name, n))
            fs.delete(at, True)
        return self.spark.read.parquet(self.path(name)).count()

    def upsert(self, name: str, df: DataFrame) -> int:
        """Puts rows in place of those of their key and keeps all others; returns the table's rows."""
        have = self.get(name)
        cols = [c for c, _ in schemas.columns(name)]
        new = schemas.decoded(df, name)
        return self.replace(name, merged(have, new, name).select(cols) if have is not None else _first_of_key(new, schemas.KEYS[name], schemas.KEYS[name]))

    def add(self, name: str, df: DataFrame) -> int:
        """Appends rows and returns how many; files of a task that fails are not seen."""
        path = self.path(name)
        if path is None:
            return self.replace(name, df)
        df = df.persist()
        n = df.count()
        df.write.mode("append").parquet(path)
        df.unpersist()
        return n

    def migrate(self) -> list[int]:
        """Takes the folder to the newest schema, step by step; returns the steps taken."""
        have = self.get("schema_versions")
        done = {r.version for r in have.collect()} if have is not None else set()
        taken = []
        for version, step in sorted(MIGRATIONS.items()):
            if version not in done:
                step(self)
                self.add("schema_versions", self.spark.range(1).select(F.lit(version).alias("version"), F.current_timestamp().alias("applied_at")))
                taken.append(version)
        return taken


def _create(tables: Store) -> None:
    """Makes the tables that are missing."""
    for name in schemas.TABLES:
        if name != "resolver_cache" and tables.path(name) is None:
            tables.replace(name, tables.empty(name))


def _conform(tables: Store) -> None:
    """Writes tables whose columns are not the schema's anew."""
    for name in schemas.TABLES:
        path = tables.path(name)
        if path is not None and tables.spark.read.parquet(path).columns != [c for c, _ in schemas.columns(name)]:
            tables.replace(name, tables[name])


MIGRATIONS = {1: _create, 2: _conform}
