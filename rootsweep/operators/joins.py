"""Key-set joins: semi (archived rows), anti (retained rows), flag (both at once).

Every join here is a single-column equi join of a (possibly huge) table against
a key set of distinct ids. The join side is broadcast only when the key set's
size in memory is known and under ``max_bytes``. Otherwise the join shuffles: NULL
foreign keys, which match nothing, are spread over all partitions, and so are the
foreign-key values measured as heavy (the few key rows they match are repeated).
Lazy key sets of unknown size are left to Catalyst and AQE.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bytes of key sets in memory that one move may broadcast.
DEFAULT_MAX_BROADCAST_BYTES = 256 << 20
#: Parts over which the rows of a NULL or heavy key are spread in a shuffle join.
SALTS = 64

_KEY = "__rs_key"
_HIT = "__rs_hit"
_SALT = "__rs_salt"


@dataclass(frozen=True)
class Keys:
    """A key set: DataFrame with an ``id`` column (plus carried columns).

    ``rows`` and ``size`` (bytes in memory) are known for materialised key sets;
    the latter is what makes a broadcast safe. ``distinct`` says ids are known
    unique, ``heavy`` names values that many rows of the joined table hold, ``low`` and
    ``high`` are the smallest and largest id where measured."""

    name: str
    df: DataFrame
    rows: int | None = None
    distinct: bool = False
    size: int | None = None
    heavy: tuple = ()
    low: int | str | None = None
    high: int | str | None = None

    def small(self, max_bytes: int = DEFAULT_MAX_BROADCAST_BYTES) -> bool:
        return self.size is not None and self.size <= max_bytes

    def side(self, flag: bool = False) -> DataFrame:
        """The key column under a private name."""
        side = self.df.select(F.col("id").alias(_KEY))
        if flag:
            if not self.distinct:
                side = side.distinct()  # an outer join must not multiply rows
            side = side.withColumn(_HIT, F.lit(True))
        return side


def quoted(name: str) -> Column:
    """The column of exactly this name, dots and all."""
    return F.col("`" + name.replace("`", "``") + "`")


def _join(df: DataFrame, column: str, keys: Keys, max_bytes: int, how: str, flag: bool = False) -> DataFrame:
    side, fk = keys.side(flag), quoted(column)
    if keys.small(max_bytes):
        return df.join(F.broadcast(side), fk == F.col(_KEY), how)
    if keys.size is None:
        return df.join(side, fk == F.col(_KEY), how)
    hashable = [quoted(f.name) for f in df.schema.fields if not any(x in f.dataType.simpleString() for x in ("map<", "variant"))]
    spread = F.pmod(F.xxhash64(*hashable), F.lit(SALTS))
    apart = fk.isNull() | fk.isin(*keys.heavy) if keys.heavy else fk.isNull()
    salted = df.withColumn(_SALT, F.when(F.coalesce(apart, F.lit(False)), spread).otherwise(F.lit(0)))
    copies = F.when(F.col(_KEY).isin(*keys.heavy), F.lit(SALTS - 1)).otherwise(F.lit(0)) if keys.heavy else F.lit(0)
    side = side.withColumn("__rs_s", F.explode(F.sequence(F.lit(0), copies)))
    return salted.join(side, (fk == F.col(_KEY)) & (F.col(_SALT) == F.col("__rs_s")), how).drop(_SALT, "__rs_s")


def heavy_values(df: DataFrame, column: str, rows: int = 1_000_000, most: int = 256) -> tuple:
    """Values of ``column`` held by at least ``rows`` rows, the ``most`` heaviest (others
    are joined all the same, only not spread). Reads one column, partial counts."""
    top = (df.select(quoted(column).alias("v")).where("v is not null").groupBy("v").count()
           .where(F.col("count") >= rows).orderBy(F.desc("count"), "v").limit(most).collect())
    return tuple(r["v"] for r in top)


def semi(df: DataFrame, column: str, keys: Keys, max_bytes: int = DEFAULT_MAX_BROADCAST_BYTES) -> DataFrame:
    """Rows of ``df`` whose ``column`` is in the key set (``INSERT ... SELECT t.*
    ... JOIN k``). A NULL never matches."""
    return _join(df, column, keys, max_bytes, "left_semi")


def anti(df: DataFrame, column: str, keys: Keys, max_bytes: int = DEFAULT_MAX_BROADCAST_BYTES) -> DataFrame:
    """Rows of ``df`` whose ``column`` is not in the key set (what a ``DELETE t
    FROM t JOIN k`` leaves). NULL keys are retained, unlike ``NOT IN``."""
    return _join(df, column, keys, max_bytes, "left_anti")


def flag(df: DataFrame, column: str, keys: Keys, max_bytes: int = DEFAULT_MAX_BROADCAST_BYTES,
         name: str = "archived") -> DataFrame:
    """All rows of ``df`` plus a boolean ``name``: the single-pass form of the
    semi + anti pair (one scan, one write for both parts)."""
    joined = _join(df, column, keys, max_bytes, "left", flag=True)
    return joined.select(*[quoted(c) for c in df.columns],
                         F.coalesce(F.col(_HIT), F.lit(False)).alias(name))
