"""Column expressions shared by operators, queries and the run.

All built from ``pyspark.sql.functions`` so they stay inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StructType


def csv_items(csv: str | None) -> list[str]:
    """Items of a csv list exactly as ``FIND_IN_SET`` sees them: split on ``,``,
    no trimming, no case folding. An empty or NULL list has no items (the MySQL
    behaviour; Spark's ``find_in_set('', '')`` would return 1)."""
    if csv is None or csv == "":
        return []
    return csv.split(",")


def hashable(c: Column, kind: DataType) -> Column:
    """``c`` in a form that can be hashed: maps, also nested ones, as entries in key order."""
    if isinstance(kind, MapType):
        entries = F.array_sort(F.map_entries(c))
        return F.transform(entries, lambda e: F.struct(e["key"].alias("key"), hashable(e["value"], kind.valueType).alias("value")))
    if isinstance(kind, ArrayType):
        return F.transform(c, lambda e: hashable(e, kind.elementType)) if "map<" in kind.simpleString() else c
    if isinstance(kind, StructType) and "map<" in kind.simpleString():
        fields = [hashable(c.getField(f.name), f.dataType).alias(f.name) for f in kind.fields]
        return F.when(c.isNotNull(), F.struct(*fields))
    return c


def row_hash(schema: StructType) -> Column:
    """64-bit content hash of a row, null positions included (so ``(1, NULL)`` and
    ``(NULL, 1)`` differ)."""
    if not schema.fields:
        return F.lit(0).cast("bigint")
    cols = [(F.col("`" + f.name.replace("`", "``") + "`"), f.dataType) for f in schema.fields]
    return F.xxhash64(*[hashable(c, t) for c, t in cols], *[c.isNull() for c, _ in cols])


def fingerprint_aggs(schema: StructType, prefix: str = "") -> list[Column]:
    """(row count, order-free sum of row hashes) as aggregate columns.

    The sum is put together, in ``decimal(38,0)``, from the sums of the hash's three parts
    of at most 22 bits, as bigints (good for 2^41 rows; a decimal sum makes objects for each
    row); equal multisets of rows give equal pairs, independent of partitioning and order."""
    h, low = row_hash(schema), F.lit((1 << 22) - 1).cast("bigint")
    parts = [h.bitwiseAND(low), F.shiftright(h, 22).bitwiseAND(low), F.shiftright(h, 44)]
    whole = [F.coalesce(F.sum(p), F.lit(0)).cast("decimal(20,0)") * F.lit(1 << 22 * i).cast("decimal(14,0)") for i, p in enumerate(parts)]
    return [
        F.count(F.lit(1)).alias(f"{prefix}rows"),
        (whole[0] + whole[1] + whole[2]).cast("decimal(38,0)").alias(f"{prefix}fingerprint"),
    ]


def error_text(exc: BaseException, table: str) -> str:
    """``ERROR <condition> (<sqlstate>) processing table `<t>`: <message>``."""
    condition = None
    state = None
    get_cond = getattr(exc, "getCondition", None)
    get_state = getattr(exc, "getSqlState", None)
    try:
        condition = get_cond() if callable(get_cond) else None
        state = get_state() if callable(get_state) else None
    except Exception:  # pragma: no cover - diagnostics must never raise
        pass
    condition = condition or type(exc).__name__
    state = state or getattr(exc, "sqlstate", None) or "HY000"
    msg = str(exc).strip().splitlines()[0] if str(exc).strip() else type(exc).__name__
    return f"ERROR {condition} ({state}) processing table `{table}`: {msg}"
