"""Ids that are known already, so that only new items are taken (SRC4, JN4b).

The ids stand in buckets. Beside them a bitmap of their hashes is kept, a bit for each place a hash can have; an item
whose bit is not set is new for sure, and no id is read for it. Only for the others, those that are known and
a few whose place is taken by chance, the buckets they belong in are read and compared.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from jobmeld.functions.binding import detached
from jobmeld.sources.store import SnapshotStore

PLACES = 1 << 32  # a bit each: some ten times the ids that are expected
_ROW = 32768  # bits in a row of the bitmap


class KnownIds:
    """Ids below one name of a store; `places` is fixed when the first ids come in."""

    def __init__(self, store: SnapshotStore, name: str, places: int = PLACES):
        self.store, self.ids, self.bits, self.places = store, f"{name}/ids", f"{name}/bits", places

    def _place(self, key: Column) -> Column:
        # bit positions count from 1
        return F.pmod(F.xxhash64(key.cast("string")), F.lit(self.places)) + 1

    def add(self, ids: DataFrame, key: str) -> None:
        """Take in the ids of a column; repeated and known ones do no harm, nulls are left out.

        The bitmap is written first: an id that only the bitmap has is compared and found new.
        """
        new = ids.select(F.col(key).cast("string").alias("id")).filter("id IS NOT NULL").distinct()
        place = self._place(F.col("id"))
        bits = new.groupBy(F.bitmap_bucket_number(place).alias("row")).agg(
            F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("bits")
        )
        self.store.merge(self.bits, bits, ["row"], _united)
        self.store.merge(self.ids, new, ["id"], lambda dest, src: dest.join(src, "id", "full").select("id"))

    def unseen(self, items: DataFrame, key: str) -> DataFrame:
        """The rows of `items` whose key is not known; a null key is never known."""
        if not self.store.exists(self.ids):
            return items
        maybe, new = self.parted(items, key)
        text = F.col(key).cast("string")
        known = self.store.read_touched(self.ids, maybe.select(text.alias("id")), ["id"])
        kept = maybe.join(known.select(detached(F.col("id")).alias("_id")), text == F.col("_id"), "left_anti")
        return new.unionByName(kept)

    def parted(self, items: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
        """(rows whose bit is set, rows that are new for sure)."""
        place = self._place(F.col(key))
        bits = self.store.read(self.bits).select(detached(F.col("row")).alias("_row"), F.col("bits").alias("_bits"))
        held = items.join(bits, F.bitmap_bucket_number(place) == F.col("_row"), "left")
        at = F.bitmap_bit_position(place)
        byte = F.conv(F.hex(F.substring("_bits", (F.floor(at / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
        hit = F.coalesce(F.floor(byte / F.pow(F.lit(2), at % 8)) % 2 == 1, F.lit(False))
        tagged = held.select(*items.columns, hit.alias("_hit"))
        return tagged.filter("_hit").drop("_hit"), tagged.filter(~F.col("_hit")).drop("_hit")


def _united(dest: DataFrame, src: DataFrame) -> DataFrame:
    return dest.unionByName(src.select(*dest.columns)).groupBy("row").agg(F.bitmap_or_agg("bits").alias("bits"))
