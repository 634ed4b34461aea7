"""Stored facts in buckets of the trade id, with replacement and compaction.

Facts are only ever appended, in folders by bucket and load, as a table that is also
bucketed by trade id: joins on the trade id read it without a shuffle. A load lists the
ids whose earlier facts it replaces, bucketed alike, and becomes visible with its row in
``fact_loads``, written last; a load that dies before leaves the visible facts untouched.

Compaction rewrites only the buckets that hold replaced facts. It is a load of its own:
the current rows of those buckets under a new number, and for each of them the number
below which its folders no longer count. Once it is visible, the folders that it
supersedes and the lists of replaced ids are deleted. One load or compaction runs at a
time.
"""

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tradeloom.functions.staging import delete_folder, settle, watched

#: Buckets of a new store; some gigabytes each at full size.
BUCKETS = 16
LOADS = "load_id int, batch_id string, last_key bigint"
FLOORS = "bucket int, load_id int"
FOLDERS = {"fact_trades": ["bucket", "load_id"], "fact_replaced": ["replaced_by"]}


class FactStore:
    """The facts below a pipeline's tables. ``buckets`` only counts for a store without facts."""

    def __init__(self, spark: SparkSession, tables, buckets: int = BUCKETS):
        self.spark, self.tables = spark, tables
        layout = tables.read(spark, "fact_layout")
        self.buckets = buckets if layout is None else layout.first().buckets
        self.stored = layout is not None
        self.registered: dict[str, str] = {}

    # --- tables ----------------------------------------------------------------

    def _register(self, name: str, schema: str) -> str:
        """The bucketed table over a folder, with the partitions it has now; data stay where they are.

        Later inserts through the table add their partitions to it.
        """
        if name in self.registered:
            return self.registered[name]
        path = self.tables.path(name)
        table = f"facts_{hashlib.md5(path.encode()).hexdigest()[:16]}"
        self.spark.sql(f"DROP TABLE IF EXISTS {table}")
        where = path.replace("'", "\\'")
        self.spark.sql(
            f"CREATE TABLE {table} ({schema}) USING parquet PARTITIONED BY ({', '.join(FOLDERS[name])}) "
            f"CLUSTERED BY (trade_id) SORTED BY (trade_id) INTO {self.buckets} BUCKETS LOCATION '{where}'"
        )
        if self.tables.read(self.spark, name) is not None:
            self.spark.sql(f"ALTER TABLE {table} RECOVER PARTITIONS")
        self.registered[name] = table
        return table

    def _table(self, name: str) -> str | None:
        if name in self.registered:
            return self.registered[name]
        stored = self.tables.read(self.spark, name)
        return None if stored is None else self._register(name, ", ".join(f"`{f}` {t}" for f, t in stored.dtypes))

    def _bucket(self, column: str) -> Column:
        # the hash by which the table itself is bucketed
        return F.pmod(F.hash(column), F.lit(self.buckets)).cast("int")

    def _insert(self, rows: DataFrame, name: str) -> None:
        if not self.stored:
            layout = self.spark.createDataFrame([(self.buckets,)], "buckets int")
            layout.write.parquet(self.tables.path("fact_layout"))
            self.stored = True
        last = FOLDERS[name]
        rows = rows.select(*[c for c in rows.columns if c not in last], *last)
        rows.write.insertInto(self._register(name, ", ".join(f"`{f}` {t}" for f, t in rows.dtypes)))

    # --- loads -----------------------------------------------------------------

    def next_load(self) -> int:
        """A load number that was never used, by loads that never finished either."""
        used = [0]
        loads = self.tables.read(self.spark, "fact_loads")
        if loads is not None:
            used.append(loads.agg(F.max("load_id")).first()[0] or 0)
        for name, columns in FOLDERS.items():
            if (table := self._table(name)) is not None:
                number = F.regexp_extract("partition", rf"{columns[-1]}=(\d+)", 1).cast("int")
                used.append(self.spark.sql(f"SHOW PARTITIONS {table}").agg(F.max(number)).first()[0] or 0)
        return max(used) + 1

    def last_key(self) -> int:
        """The highest surrogate key of the finished loads."""
        loads = self.tables.read(self.spark, "fact_loads")
        return 0 if loads is None else loads.agg(F.max("last_key")).first()[0] or 0

    def spread(self, rows: DataFrame) -> DataFrame:
        """Rows shuffled by trade id so that a task's rows lie in one bucket, in no fewer tasks than other shuffles have.

        A load of rows spread before they are joined by trade id is not shuffled again.
        """
        wanted = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        return rows.repartition(self.buckets * -(-wanted // self.buckets), "trade_id")

    def append(self, staged: DataFrame, load_id: int, spread: bool = True) -> int:
        """Store the facts of a load, still invisible; returns their highest surrogate key."""
        rows = staged.withColumns({"bucket": self._bucket("trade_id"), "load_id": F.lit(load_id)})
        if spread:
            rows = self.spread(rows)
        rows, seen = watched(rows, last=F.max("trade_key"))
        self._insert(rows, "fact_trades")
        return seen.get["last"] or 0

    def replace(self, ids: DataFrame, load_id: int) -> None:
        """List the stored facts that a load replaces: those of earlier loads with the ids of ``ids``."""
        current = self.current()
        if current is not None:
            wanted = ids.select("trade_id").repartition(self.buckets, "trade_id")
            found = current.select("trade_id").join(wanted, "trade_id", "left_semi")
            self._insert(settle(found.withColumn("replaced_by", F.lit(load_id)), "replaced"), "fact_replaced")

    def commit(self, load_id: int, batch_id: str, last_key: int) -> None:
        """Make a load visible."""
        row = self.spark.createDataFrame([(load_id, batch_id, last_key)], LOADS)
        row.coalesce(1).write.mode("append").parquet(self.tables.path("fact_loads"))

    def _finished(self, name: str) -> DataFrame:
        # one number for each load
        return F.broadcast(self.tables.read(self.spark, "fact_loads").select(F.col("load_id").alias(name)))

    def _floors(self) -> dict[int, int]:
        """For each compacted bucket the number of its last compaction: at most one entry a bucket."""
        floors = self.tables.read(self.spark, "fact_floors")
        if floors is None:
            return {}
        visible = floors.join(self._finished("load_id"), "load_id", "left_semi")
        return dict(visible.groupBy("bucket").agg(F.max("load_id")).collect())

    def current(self) -> DataFrame | None:
        """The visible facts: rows of finished loads that no finished load replaced."""
        table = self._table("fact_trades")
        if table is None or self.tables.read(self.spark, "fact_loads") is None:
            return None
        facts, floors = self.spark.table(table), self._floors()
        if floors:
            entries = F.create_map(*[F.lit(x) for item in floors.items() for x in item])
            facts = facts.where(F.col("load_id") >= F.coalesce(F.try_element_at(entries, F.col("bucket")), F.lit(0)))
        facts = facts.join(self._finished("load_id"), "load_id", "left_semi")
        gone = self._replaced()
        if gone is not None:
            # a list replaces what came before its load, so that trade ids alone are matched
            gone = gone.select(F.col("trade_id").alias("_gone"), F.col("replaced_by").alias("_by"))
            facts = facts.join(gone, (F.col("trade_id") == F.col("_gone")) & (F.col("load_id") < F.col("_by")), "left_anti")
        return facts

    def _replaced(self) -> DataFrame | None:
        table = self._table("fact_replaced")
        return None if table is None else self.spark.table(table).join(self._finished("replaced_by"), "replaced_by", "left_semi")

    # --- compaction ------------------------------------------------------------

    def compact(self, batch_id: str = "compaction") -> list[int]:
        """Rewrite the buckets that hold replaced facts; returns them."""
        gone = self._replaced()
        if gone is None:
            return []
        # numbers of buckets, at most all of them
        hit = sorted(r.bucket for r in gone.select(self._bucket("trade_id").alias("bucket")).distinct().collect())
        if hit:
            load_id = self.next_load()
            rows = self.current().where(F.col("bucket").isin(hit)).drop("bucket", "load_id")
            self.append(rows, load_id, spread=False)
            floors = self.spark.createDataFrame([(b, load_id) for b in hit], FLOORS)
            floors.coalesce(1).write.mode("append").parquet(self.tables.path("fact_floors"))
            self.commit(load_id, batch_id, self.last_key())
            self.vacuum()
        return hit

    def vacuum(self) -> None:
        """Delete folders of compacted buckets below their floor, and lists that a compaction has settled."""
        floors = self._floors()
        last = max(floors.values(), default=0)
        for name, columns in FOLDERS.items():
            table = self._table(name)
            listed = self.spark.sql(f"SHOW PARTITIONS {table}").collect() if table else []  # folder names
            for row in listed:
                at = dict(part.split("=") for part in row.partition.split("/"))
                floor = floors.get(int(at["bucket"]), 0) if "bucket" in at else last
                if int(at[columns[-1]]) < floor:
                    delete_folder(self.spark, f"{self.tables.path(name)}/{row.partition}")
        self.registered = {}
