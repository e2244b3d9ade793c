"""Sharding by a keyed permutation of global row numbers, in SQL functions only.

Rows are numbered 0 to n - 1 in a total order of their ids and texts; a Feistel
network permutes the numbers, and number ``y`` of the permutation is slot
``y div shards`` of shard ``y mod shards``.  So shards differ by one row at
most, slots have no gaps, the shuffle depends on the seed and the rows alone,
and both directions are a formula: :meth:`Shuffle.place` gives shard and slot
of a row number, :meth:`Shuffle.number_at` the row number at a shard and slot.

The network works on pairs (l, r) of the numbers below a and b with
a * b >= n, a about the root of n.  The fewer than a numbers beyond n - 1 are
walked through: a result that is no row number is permuted again.  How often
that can happen is measured over just those numbers, so the walk is exact.

No text and no group of equal rows is gathered anywhere: numbering range-sorts
(id, hash of the text, place in the input), which no two rows share.
"""

from __future__ import annotations

from dataclasses import dataclass
from math import isqrt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from toneflow.llm.ordering import numbered
from toneflow.llm.tables import OWN, stored

#: Rounds of the network; seed of the shuffle.
ROUNDS, SEED = 8, 11


def div(x: Column, y: int) -> Column:
    return F.call_function("div", x, F.lit(y).cast("long"))


@dataclass(frozen=True)
class Shuffle:
    """The permutation of ``n`` row numbers under a seed, dealt to ``shards``.

    ``further`` is the number of passes after the first that the longest walk takes; :meth:`of` measures it.
    """
    n: int
    shards: int
    seed: int = SEED
    further: int = 0

    @classmethod
    def of(cls, spark: SparkSession, n: int, shards: int, seed: int = SEED) -> Shuffle:
        if n < 0 or shards < 1:
            raise ValueError(f"cannot deal {n} rows to {shards} shards")
        free = cls(n, shards, seed)
        # Walks of row numbers enter the numbers beyond n - 1 where the way back leads out of them at once.
        entered = spark.range(n, free.sides[0] * free.sides[1]).filter(free._network(F.col("id"), True) < n)
        further = 0
        while not entered.filter(free._settle(F.col("id"), False, further) >= n).isEmpty():
            further += 1
        return cls(n, shards, seed, further)

    @property
    def sides(self) -> tuple[int, int]:
        """(a, b) with n <= a * b < n + a."""
        a = isqrt(max(0, self.n - 1)) + 1
        return a, max(1, -(-self.n // a))

    def _noise(self, turn: Column, value: Column) -> Column:
        """Pseudo-random number of 60 bits."""
        text = F.concat_ws("|", F.lit(str(self.seed)), turn.cast("string"), value.cast("string"))
        return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long")

    def _network(self, x: Column, back: bool) -> Column:
        """One pass through the network, or through its inverse."""
        a, b = (F.lit(v).cast("long") for v in self.sides)

        def turn(s: Column, i: Column) -> Column:
            left = i % 2 == 0
            noise = self._noise(i, F.when(left, s["r"]).otherwise(s["l"])) * (-1 if back else 1)
            return F.struct(F.when(left, F.pmod(s["l"] + F.pmod(noise, a), a)).otherwise(s["l"]).alias("l"),
                            F.when(left, s["r"]).otherwise(F.pmod(s["r"] + F.pmod(noise, b), b)).alias("r"))

        rounds = range(ROUNDS)
        start = F.struct(div(x, self.sides[1]).alias("l"), F.pmod(x, b).alias("r"))
        return F.aggregate(F.array(*map(F.lit, rounds[::-1] if back else rounds)), start, turn,
                           lambda s: s["l"] * b + s["r"])

    def _settle(self, x: Column, back: bool, times: int) -> Column:
        """Permute what is no row number, at most ``times`` times."""
        if not times:
            return x
        return F.aggregate(F.array(*map(F.lit, range(times))), x,
                           lambda y, _: F.when(y < self.n, y).otherwise(self._network(y, back)))

    def place(self, number: Column) -> tuple[Column, Column]:
        """(shard, slot) of a row number."""
        at = self._settle(self._network(number.cast("long"), False), False, self.further)
        return F.pmod(at, F.lit(self.shards)).cast("int"), div(at, self.shards)

    def number_at(self, shard: Column, slot: Column) -> Column:
        """The row number at a shard and slot; null where there is none."""
        at = slot.cast("long") * self.shards + shard.cast("long")
        there = (shard >= 0) & (shard < self.shards) & (at >= 0) & (at < self.n)
        return F.when(there, self._settle(self._network(at, True), True, self.further))


def assign(docs: DataFrame, shards: int, seed: int = SEED, id_col: str = "doc_id", text_col: str = "text",
           row: Column | None = None) -> DataFrame:
    """(id, size, text_crc32, number, shard, slot, row) of every row of ``docs``.

    ``size`` is the bytes of the text in UTF-8 plus one, ``text_crc32`` its
    checksum; a null text has no bytes.  Rows are numbered by id (nulls last),
    then by the text's hash; rows that agree in both are interchangeable here
    and get places of their own.  ``row`` is handed through.  Other columns do
    not matter.  An empty table gives no rows.  ``number`` is a row's place in
    the order, from which a :class:`Shuffle` of as many rows gives the rest.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("id"), (F.octet_length(text) + 1).cast("long").alias("size"),
                       F.crc32(text).alias("text_crc32"), F.xxhash64(text_col).alias(f"{OWN}hash"),
                       (F.lit(None) if row is None else row).cast("long").alias("row"))
    rows, n = numbered(rows, F.col("id").asc_nulls_last(), F.col(f"{OWN}hash"))
    shard, slot = Shuffle.of(docs.sparkSession, n, shards, seed).place(F.col("number"))
    return rows.drop(f"{OWN}hash").withColumn("shard", shard).withColumn("slot", slot)


def write_shards(docs: DataFrame, path: str, shards: int, seed: int = SEED, parts: int = 1,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Write ``docs`` as Parquet folders ``shard=0``, ``shard=1``, ...; every file holds one run of slots in order.

    A shard is cut into ``parts`` runs of equally many slots, one task and file
    each, so no task holds a whole shard unless asked to.  Columns ``shard``
    and ``slot`` of ``docs`` are replaced.  Returns what was written.
    """
    row = f"{OWN}row"
    rows = stored(docs.drop("shard", "slot").withColumn(row, F.monotonically_increasing_id()), "rows")
    places = stored(assign(rows, shards, seed, id_col, text_col, F.col(row)).select(F.col("row").alias(row), "shard", "slot"), "shards")
    most = max(1, -(-(places.agg(F.max("slot")).first()[0] or 0) // parts) + 1)
    run = div(F.col("slot"), most)
    out = rows.join(places, row).drop(row).withColumn(f"{OWN}run", run)
    out = out.repartitionByRange(shards * parts, "shard", f"{OWN}run").sortWithinPartitions("shard", f"{OWN}run", "slot")
    out = out.drop(f"{OWN}run")
    out.write.partitionBy("shard").mode("overwrite").parquet(path)
    return docs.sparkSession.read.schema(out.schema).parquet(path)
