"""Join strategy for query-side tables.

Query-derived tables (query terms with their idf, source rows of a
more-like-this batch, ...) are usually small, while the index tables grow
with the corpus.  A broadcast of the query side keeps the index table from
being shuffled at all; but a broadcast is only taken when its measured bytes prove
the side small.  Above the bound the plain shuffled join is used, and AQE splits
skewed keys (a hot term) there.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, MapType, StringType, StructType

# estimated bytes of a query-side table that may be sent to every task
BROADCAST_MAX_BYTES = 32 << 20
HELD_ROWS = 100_000  # rows of a query-side table that the driver may hold


def join_small(big: DataFrame, small: DataFrame, on, how: str = "inner", max_bytes: int | None = None,
               materialize: bool = True) -> DataFrame:
    """``big.join(small)`` with ``small`` broadcast only when its measured
    bytes stay ≤ ``max_bytes``.

    ``materialize``: the small side (it often reads the vocabulary itself) is
    held first (see :func:`held`), so it is measured and joined without being
    computed twice.
    """
    if materialize:
        small, rows = held(small)
        if rows is not None:
            fits = rows.nbytes <= (BROADCAST_MAX_BYTES if max_bytes is None else max_bytes)
            return big.join(F.broadcast(small) if fits else small, on, how)
    if fits_broadcast(small, max_bytes):
        return big.join(F.broadcast(small), on, how)
    return big.join(small, on, how)


def held(df: DataFrame, most: int | None = None, costly: bool = False) -> tuple[DataFrame, pa.Table | None]:
    """``df`` as rows the driver knows, and these rows, if there are at most
    ``most`` (by default ``HELD_ROWS``); else its checkpoint and None.  One job for a
    small table, where a checkpoint, its count and its values would be three.
    ``costly``: the checkpoint comes first, so what shuffles much is computed once."""
    most = HELD_ROWS if most is None else most
    if costly:
        df = checkpointed(df)
    rows = df.limit(most + 1).toArrow()
    if rows.num_rows > most or rows.nbytes > BROADCAST_MAX_BYTES:
        return df if costly else checkpointed(df), None
    return df.sparkSession.createDataFrame(rows, df.schema), rows


def join_held(big: DataFrame, small: DataFrame, rows: pa.Table | None, on, how: str = "inner") -> DataFrame:
    """``big`` joined with what :func:`held` returned for a side; rows it holds are within the broadcast bound."""
    return join_small(big, small, on, how, materialize=False) if rows is None else big.join(F.broadcast(small), on, how)


def join_hashed(big: DataFrame, small: DataFrame, on) -> DataFrame:
    """``big.join(small)``: broadcast or, where a shuffle partition of ``small`` keeps to the broadcast
    bound, hashed there, which saves sorting ``big``; else the plain join."""
    size = measured_bytes(small)
    if size <= BROADCAST_MAX_BYTES:
        return big.join(F.broadcast(small), on)
    parts = int(big.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return big.join(small.hint("shuffle_hash") if size <= parts * BROADCAST_MAX_BYTES else small, on)


def fits_broadcast(df: DataFrame, max_bytes: int | None = None) -> bool:
    """Measured bytes of the rows ≤ the broadcast budget."""
    limit = BROADCAST_MAX_BYTES if max_bytes is None else max_bytes
    return measured_bytes(df) <= limit


def measured_bytes(df: DataFrame) -> int:
    """Bytes of the values of ``df``: real lengths of strings, binaries and arrays,
    the JSON length of other nested values, 8 for anything else."""
    return df.agg(F.sum(sum((_cell_bytes(f) for f in df.schema.fields), F.lit(0)))).first()[0] or 0


def _cell_bytes(field):
    c, kind = F.col(f"`{field.name}`"), field.dataType
    if isinstance(kind, (StringType, BinaryType)):
        size = F.octet_length(c) + 16
    elif isinstance(kind, ArrayType) and isinstance(kind.elementType, StringType):
        size = F.octet_length(F.array_join(c, "")) + 16 * F.size(c)
    elif isinstance(kind, ArrayType) and not isinstance(kind.elementType, (ArrayType, StructType, MapType, BinaryType)):
        size = 8 * F.size(c) + 16
    elif isinstance(kind, (ArrayType, StructType, MapType)):
        size = F.octet_length(F.to_json(F.struct(c))) + 16
    else:
        return F.lit(8).cast("bigint")
    return F.coalesce(size, F.lit(8)).cast("bigint")


def checkpointed(df: DataFrame) -> DataFrame:
    """Reliable checkpoint in ``spark.checkpoint.dir`` (cuts lineage; survives
    executor loss, unlike a local checkpoint)."""
    from ..session import work_dir

    work_dir(df.sparkSession)  # make sure a checkpoint folder is set
    return df.checkpoint(eager=True)
