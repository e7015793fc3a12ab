"""Tables whose changes rewrite only what they touch.

A table is divided by a hash of its id. A version is a small manifest that names, for
each division, the generation of files that counts; a change writes a new generation of
the divisions it touches and then a manifest, which is the last thing written. Readers
see one version or the next, and a change that fails leaves the last one as it was. Two
versions differ at most in the divisions whose generations differ, so what has changed
between them is found without reading the others.

One writer at a time; a writer that finds a newer version than its own stops.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

DIVISIONS = 64
_MANIFEST = "division int, gen int, id_col string, divisions int, schema string, next_gen int"


class Snapshots:
    """The versions of a divided table at ``path``."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path.rstrip("/")
        self.version = self._latest()
        self._entries = {self.version: self._manifest(self.version)}
        head = self._entries[self.version][0]
        self.id_col, self.divisions, self.next_gen = head["id_col"], head["divisions"], head["next_gen"]
        self.schema = StructType.fromJson(json.loads(head["schema"]))

    def _latest(self) -> int:
        return self.spark.read.parquet(f"{self.path}/manifest").agg(F.max("version")).first()[0]

    def _manifest(self, version: int) -> list:
        """A row per division; the first has division -1 and carries the table's facts."""
        rows = self.spark.read.schema(_MANIFEST).parquet(f"{self.path}/manifest/version={version}").collect()
        return sorted(rows, key=lambda r: r["division"])

    @classmethod
    def create(cls, df: DataFrame, path: str, id_col: str = "id", divisions: int = DIVISIONS) -> Snapshots:
        """Write the first version. Ids must be unique and not null."""
        self = cls.__new__(cls)
        self.spark, self.path, self.version = df.sparkSession, path.rstrip("/"), 0
        self.id_col, self.divisions, self.next_gen = id_col, divisions, 1
        self.schema = StructType([StructField(f.name, f.dataType) for f in df.schema])  # later rows may hold nulls
        self._write(df.withColumn("division", self._division()), 1)
        self._publish({d: 1 for d in range(divisions)}, 2)
        return cls(self.spark, path)

    def _division(self) -> Column:
        return F.pmod(F.xxhash64(self.id_col), F.lit(self.divisions)).cast("int")

    def _write(self, rows: DataFrame, gen: int) -> None:
        divided = rows.hint("rebalance", "division")
        divided.write.mode("overwrite").partitionBy("division").parquet(f"{self.path}/rows/gen={gen}")

    def _publish(self, gens: dict[int, int], next_gen: int) -> None:
        facts = (self.id_col, self.divisions, self.schema.json(), next_gen)
        rows = [(-1, 0, *facts), *[(d, g, None, None, None, None) for d, g in sorted(gens.items())]]
        manifest = self.spark.createDataFrame(rows, _MANIFEST).coalesce(1)
        manifest.write.mode("overwrite").parquet(f"{self.path}/manifest/version={self.version + 1}")

    def _gens(self, version: int) -> dict[int, int]:
        if version not in self._entries:
            self._entries[version] = self._manifest(version)
        return {r["division"]: r["gen"] for r in self._entries[version] if r["division"] >= 0}

    def _read(self, gens: dict[int, int]) -> DataFrame:
        """Some divisions, each in one generation."""
        base, schema = f"{self.path}/rows", StructType(list(self.schema.fields)).add("division", "integer").add("gen", "integer")
        if not gens:
            return self.spark.createDataFrame([], schema).drop("gen")
        reader = self.spark.read.schema(schema).option("basePath", base)
        rows = reader.parquet(*[f"{base}/gen={g}" for g in sorted(set(gens.values()))])
        wanted = F.lit(False)
        for gen in set(gens.values()):
            mine = sorted(d for d, g in gens.items() if g == gen)
            wanted = wanted | ((F.col("gen") == gen) & F.col("division").isin(mine))
        return rows.filter(wanted).drop("gen")  # prunes folders

    def read(self, version: int | None = None) -> DataFrame:
        return self._read(self._gens(self.version if version is None else version)).drop("division")

    def look_up(self, ids: list) -> DataFrame:
        """Rows by id, from the divisions they can be in."""
        asked = self.spark.createDataFrame([(i,) for i in ids], StructType([self.schema[self.id_col]]))
        some = {r[0] for r in asked.select(self._division()).distinct().collect()}
        gens = {d: g for d, g in self._gens(self.version).items() if d in some}
        return self._read(gens).drop("division").filter(F.col(self.id_col).isin(ids))

    def change(self, rows: DataFrame | None = None, gone: DataFrame | None = None) -> Snapshots:
        """Insert or replace ``rows`` (one per id), delete the ids in ``gone``."""
        names = [f.name for f in self.schema]
        new = None if rows is None else rows.select(*names).withColumn("division", self._division())
        ids = [f.select(self.id_col).withColumn("division", self._division()) for f in (new, gone) if f is not None]
        touched = ids[0] if len(ids) == 1 else ids[0].unionByName(ids[1])
        gens = self._some(touched)
        kept = self._read(gens).join(touched.select(self.id_col).distinct(), self.id_col, "left_anti")
        return self._replace(gens, kept.unionByName(new) if new is not None else kept)

    def update(self, where: Column, values: dict[str, Column]) -> Snapshots:
        """Set columns of the rows that meet a condition. Not the id."""
        if self.id_col in values:
            raise ValueError("an update can't change the id")
        hit = self._read(self._gens(self.version)).filter(where)
        gens = self._some(hit)
        changed = self._read(gens)
        meets = F.coalesce(where, F.lit(False))
        out = [F.when(meets, values[f.name]).otherwise(F.col(f.name)).cast(f.dataType).alias(f.name) if f.name in values else F.col(f.name) for f in self.schema]
        return self._replace(gens, changed.select(*out, "division"))

    def delete(self, where: Column) -> Snapshots:
        gens = self._some(self._read(self._gens(self.version)).filter(where))
        return self._replace(gens, self._read(gens).filter(~F.coalesce(where, F.lit(False))))

    def _some(self, touched: DataFrame) -> dict[int, int]:
        if self._latest() != self.version:
            raise RuntimeError("the table has a newer version; open it again")
        some = {r[0] for r in touched.select("division").distinct().collect()}  # at most ``divisions``
        return {d: g for d, g in self._gens(self.version).items() if d in some}

    def _replace(self, gens: dict[int, int], rows: DataFrame) -> Snapshots:
        if not gens:
            return self
        gen = self.next_gen
        self._write(rows, gen)
        self._publish(self._gens(self.version) | {d: gen for d in gens}, gen + 1)
        return Snapshots(self.spark, self.path)

    def touched(self, since: int, until: int | None = None) -> list[int]:
        """Divisions that two versions have in different generations."""
        old, new = self._gens(since), self._gens(self.version if until is None else until)
        return sorted(d for d in new if old[d] != new[d])

    def changes(self, since: int, until: int | None = None) -> DataFrame:
        """``change`` (insert, update, delete) and the row as it is now, or was last, of
        every id that two versions have differently. Reads touched divisions only."""
        until = self.version if until is None else until
        some = self.touched(since, until)
        old, new = (self._read({d: self._gens(v)[d] for d in some}).drop("division") for v in (since, until))
        names = [f.name for f in self.schema]
        was, now = (f.select(F.col(self.id_col).alias("_id"), F.struct(*names).alias(side)) for f, side in ((old, "was"), (new, "now")))
        both = was.join(now, "_id", "full").filter(~F.col("was").eqNullSafe(F.col("now")))
        kind = F.when(F.col("was").isNull(), "insert").when(F.col("now").isNull(), "delete").otherwise("update")
        row = F.coalesce("now", "was")
        return both.select(kind.alias("change"), *[row[n].alias(n) for n in names])
