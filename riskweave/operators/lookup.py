"""Join rows to a keyed state table without trusting the key to be even."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskweave.session import stored

# Size up to which a state table is broadcast; its bytes are counted (``row_bytes``), never guessed.
BROADCAST_BYTES = 64 << 20
HOT_SHARE = 1 / 1000
SALTS = 64


def row_bytes(table: DataFrame) -> Column:
    """The bytes of a row's values: eight for a number, the text for all else."""
    out = F.lit(0)
    for f in table.schema.fields:
        if isinstance(f.dataType, (T.NumericType, T.BooleanType, T.DatetimeType)):
            out = out + F.lit(8)
        else:
            text = F.col(f.name) if isinstance(f.dataType, T.StringType) else F.to_json(F.struct(f.name))
            out = out + F.coalesce(F.octet_length(text), F.lit(0))
    return out


@dataclass
class State:
    """One row per key, written to the shared folder, with its size in bytes known."""

    table: DataFrame
    key: str
    bytes: int
    weight: str  # column with the number of rows behind a key

    @classmethod
    def of(cls, table: DataFrame, key: str, weight: str) -> State:
        return cls.read(stored(table.filter(F.col(key).isNotNull()), "state"), key, weight)

    @classmethod
    def read(cls, table: DataFrame, key: str, weight: str) -> State:
        """The state in a table that is stored already."""
        return cls(table, key, table.agg(F.sum(row_bytes(table))).first()[0] or 0, weight)


def lookup_join(df: DataFrame, state: State, spread_by: str, limit: int | None = None):
    """Left join on the state's key.

    A state of at most ``limit`` bytes (``BROADCAST_BYTES``) is broadcast. A larger one is shuffled; keys
    that hold more than 1/1000 of the rows (at most 1000 such keys) and NULL keys
    are salted over ``SALTS`` partitions by ``spread_by``.
    """
    key = state.key
    table = state.table.drop(state.weight)
    if state.bytes <= (BROADCAST_BYTES if limit is None else limit):
        return df.join(F.broadcast(table), key, "left")
    total = state.table.agg(F.sum(state.weight)).first()[0]
    is_hot = F.col(state.weight) > F.lit(total * HOT_SHARE)
    hot = state.table.filter(is_hot).select(key, F.lit(True).alias("_hot"))
    copies = F.when(is_hot, F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))
    salted_state = state.table.withColumn("_salt", F.explode(copies)).drop(state.weight)
    salt = F.pmod(F.xxhash64(spread_by), F.lit(SALTS)).cast("int")
    return (
        df.join(F.broadcast(hot), key, "left")
        .withColumn("_salt", F.when(F.col("_hot") | F.col(key).isNull(), salt).otherwise(0))
        .drop("_hot")
        .join(salted_state, [key, "_salt"], "left")
        .drop("_salt")
    )
