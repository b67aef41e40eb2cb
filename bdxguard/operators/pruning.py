"""Which partitions of the history can hold a key of the batch.

Validated tables grow with every quarter, and a duplicate is looked for in all of it.  Each partition therefore keeps
bitmaps of its keys: one group of 32,768-bit maps per value of the *exact* columns (the valuation date), in which a hash
of the whole key sets one bit.  A batch builds the same maps, ANDs them with the stored ones, and only partitions with a
bit in common are scanned.

There are no false negatives: equal keys set the same bit of the same map.  A partition may be read in vain; the exact
join that follows decides.  ``spread`` maps per exact value keep that rare for large partitions.  Keys with a NULL never
match in that join and are left out on both sides.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MAP_BITS = 32768  # fixed value: bits of one map of bitmap_construct_agg


def key_maps(rows: DataFrame, keys: Sequence[str], by: Sequence[str] = (), exact: Sequence[str] = (), spread: int = 8) -> DataFrame:
    """Bitmaps of the keys of each partition: columns ``by``, ``exact``, ``_map`` (0 to spread - 1) and ``bits``.

    One partial aggregate; a key of any frequency sets its bit once per task.
    """
    h = F.pmod(F.xxhash64(*keys), F.lit(MAP_BITS * spread))
    whole = rows.dropna(subset=list(keys)).select(*by, *exact, F.floor(h / MAP_BITS).cast("int").alias("_map"),
                                                  F.bitmap_bit_position(h % MAP_BITS + 1).alias("_bit"))
    return whole.groupBy(*by, *exact, "_map").agg(F.bitmap_construct_agg("_bit").alias("bits"))


def merge_maps(old: DataFrame | None, new: DataFrame, by: Sequence[str], exact: Sequence[str] = ()) -> DataFrame:
    """Stored maps after rows were added: bits are only ever added, so rows that an update replaced stay as possible hits."""
    both = new if old is None else old.select(*new.columns).unionByName(new)
    return both.groupBy(*by, *exact, "_map").agg(F.bitmap_or_agg("bits").alias("bits"))


def partitions_to_read(maps: DataFrame, batch: DataFrame, by: Sequence[str], exact: Sequence[str] = ()) -> DataFrame:
    """Partitions whose maps share a bit with the maps of the batch (``key_maps`` without ``by``)."""
    on = [*exact, "_map"]
    stored = maps.select(*by, *on, "bits").join(batch.select(*on), on, "left_semi")
    asked = maps.select(*by, *on).join(batch.select(*on, "bits"), on)
    met = stored.unionByName(asked).groupBy(*by, *on).agg(F.bitmap_and_agg("bits").alias("bits"))
    return met.filter(F.bitmap_count("bits") > 0).select(*by).distinct()
