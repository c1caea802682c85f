"""Sharding by a permutation-filled lookup table.

Every shard has its own preference order over the slots of a table of prime size: ``(offset + j * skip) mod size`` passes
each slot once. Shards take turns, each claiming its next free slot, until the table is full, so shares differ by one
slot at most and few keys move when the set of shards changes. The table has a fixed size, whatever the data, so it is
broadcast; a key is placed by one hash and one lookup.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TABLE_SIZE = 65_537


def _number(text: str) -> int:
    return int.from_bytes(hashlib.blake2b(text.encode(), digest_size=8).digest(), "big")


def lookup_table(shards: Sequence[str], size: int = TABLE_SIZE) -> np.ndarray:
    """Slot -> position of its shard in ``shards``. ``size`` must be a prime not under the number of shards; names must differ."""
    if not shards or len(set(shards)) != len(shards):
        raise ValueError("shard names must be there and differ")
    if size < max(2, len(shards)) or any(size % k == 0 for k in range(2, int(size**0.5) + 1)):
        raise ValueError("the table size must be a prime not under the number of shards")
    table = np.full(size, -1, dtype=np.int32)
    slot = np.array([_number(f"offset {s}") % size for s in shards])
    skip = np.array([_number(f"skip {s}") % (size - 1) + 1 for s in shards])
    free = size
    while free:
        for k in range(len(shards)):
            at = int(slot[k])
            while table[at] >= 0:
                at = (at + int(skip[k])) % size
            table[at] = k
            slot[k] = (at + int(skip[k])) % size
            free -= 1
            if not free:
                break
    return table


def place(df: DataFrame, key: str, shards: Sequence[str], size: int = TABLE_SIZE) -> DataFrame:
    """All rows of ``df`` with ``slot`` (long) and ``shard`` (string).

    Equal keys, however many and however long, have one shard; a null key counts as the empty text. Columns of ``df`` named
    slot or shard are replaced, after the key is read. An empty table gives an empty one.
    """
    spark = df.sparkSession
    table = lookup_table(shards, size)
    rows = [(i, shards[k]) for i, k in enumerate(table.tolist())]
    lookup = spark.createDataFrame(rows, "slot long, shard string")
    slot = F.pmod(F.xxhash64(F.coalesce(F.col(f"`{key}`").cast("string"), F.lit(""))), F.lit(size))
    return df.withColumn("slot", slot).drop("shard").join(F.broadcast(lookup), "slot")


def write_shards(df: DataFrame, path: str, key: str, shards: Sequence[str], splits: int = 8, size: int = TABLE_SIZE) -> None:
    """Write ``df`` partitioned by shard; rows of one shard are dealt over ``splits`` tasks by a hash of the whole row, so that a hot key is not one task.

    Columns named slot or shard are replaced; all others are kept. The slot is written only where there is no other column.
    """
    placed = place(df, key, shards, size)
    split = "split"
    while split in df.columns:
        split += "_"
    # maps cannot be hashed; their JSON can
    parts = [F.to_json(F.struct(F.col(f"`{f.name}`").alias("x"))) if "map" in f.dataType.simpleString() else F.col(f"`{f.name}`") for f in placed.schema if f.name not in ("slot", "shard")]
    dealt = placed.withColumn(split, F.pmod(F.xxhash64(F.lit(0), *parts), F.lit(splits)))
    dealt.repartition("shard", split).drop(split, *(["slot"] if parts else [])).write.partitionBy("shard").parquet(path)
