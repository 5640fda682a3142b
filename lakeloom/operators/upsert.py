"""Silver upsert (U1, K6, J3, J4, T3, A1, A2, W3) and the mapped legacy form (M2).

Semantics (update-then-insert, no delete):
  * silver rows whose business key matches a source row: every source column is
    overwritten, ``etlactiveind=1``, job/env/datasource set, ``etlupdateddatetime``
    = as_of; ``etlcreateddatetime`` and the surrogate key are kept            -> 'U'
  * source rows with no match: inserted with the same audit values,
    ``etlcreateddatetime`` = as_of and a new surrogate key continuing after the
    table's greatest key, numbered in business-key order                    -> 'I'
  * silver rows with no source row: untouched                               -> 'K'
  A NULL key never matches (SQL ``=``), so such source rows are always inserted.

Plan: silver LEFT JOIN source on the keys gives 'U' and 'K' rows (one shuffle of
each side); the 'I' rows are ``source LEFT ANTI silver-keys`` (only the key
columns of silver are read again), numbered by the distributed row index.  Rows
with a NULL key are split off before the joins: they can never match, and
sending them through the join would pile them into one hash partition.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import cached_property, reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.exprs import AUDIT_NAMES
from .rowindex import with_row_index

META_COLUMNS = ("etljobname", "envsourcecd", "datasourcecd")


@dataclass
class UpsertResult:
    """The parts of an upsert.  New rows get their surrogate keys, which takes a sort, only when they are asked for."""

    matched: DataFrame                        # silver rows with ``_action`` U or K
    new: DataFrame                            # source rows to insert, as they are
    numbered: Callable[[DataFrame], DataFrame]  # ``new`` -> silver rows with ``_action`` I
    source: DataFrame
    keys: list

    @cached_property
    def inserted(self) -> DataFrame:
        return self.numbered(self.new)

    @property
    def rows(self) -> DataFrame:
        """The new silver table, with ``_action`` in U / I / K."""
        return self.matched.unionByName(self.inserted)

    @property
    def table(self) -> DataFrame:
        return self.rows.drop("_action")

    @property
    def updates(self) -> DataFrame:
        return self.matched.where(F.col("_action") == "U").drop("_action")

    @property
    def inserts(self) -> DataFrame:
        return self.inserted.drop("_action")

    def counts(self) -> DataFrame:
        """(srccnt, inscnt, updcnt, dltcount); nothing is numbered or written for it."""
        src = self.source.select(F.count(F.lit(1)).cast("long")).scalar()
        ins = self.new.select(F.count(F.lit(1)).cast("long")).scalar()
        upd = self.matched.agg(F.count_if(F.col("_action") == "U").cast("long").alias("updcnt"))
        return upd.select(src.alias("srccnt"), ins.alias("inscnt"), "updcnt", F.lit(None).cast("long").alias("dltcount"))


def _all(cols: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, cols) if cols else F.lit(True)


def _any(cols: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, cols) if cols else F.lit(False)


def _now(as_of) -> Column:
    if isinstance(as_of, Column):
        return as_of
    return F.current_timestamp().cast("timestamp_ntz") if as_of is None else F.lit(as_of).cast("timestamp_ntz")


def _audit_value(c: str, inserted: bool, meta: dict, now: Column) -> Column | None:
    if c == "etlactiveind":
        return F.lit(1)
    if c in META_COLUMNS:
        return F.lit(meta.get(c))
    if c == "etlupdateddatetime" or c == "etlcreateddatetime" and inserted:
        return now
    return None


def unique_upsert(target: DataFrame, source: DataFrame, pairs: list[tuple[str, str]], *, surrogate: str | None = None,
                  max_key: int = 0, meta: dict | None = None, as_of=None, only_changed: bool = False) -> DataFrame:
    """The upsert of a source with unique keys by one full outer join: ``target`` rows and new ones with ``_action``.

    ``source`` has ``_rn``, the new rows' place in the order of surrogate keys; those continue after ``max_key``."""
    now, meta, types = _now(as_of), dict(meta or {}), dict(target.dtypes)
    keyed = {t: s for s, t in pairs}
    data = [c for c in target.columns if (c in source.columns or c in keyed) and c != surrogate and c not in AUDIT_NAMES]
    of = {c: F.col(f"_s_{keyed.get(c, c)}").cast(types[c]) for c in data}
    side = source.select(*[F.col(c).alias(f"_s_{c}") for c in source.columns], F.lit(True).alias("_hit"))
    j = target.withColumn("_old", F.lit(True)).join(side, _all([F.col(t) == F.col(f"_s_{s}") for s, t in pairs]), "full_outer")
    changed = _any([~F.col(c).eqNullSafe(of[c]) for c in data]) if only_changed else F.lit(True)
    new = F.col("_old").isNull()
    old_hit = ~new & F.col("_hit").isNotNull() & changed
    out = []
    for c in target.columns:
        value = F.col(c)
        if c == surrogate:
            value = F.when(new, (F.lit(max_key) + F.col("_s__rn")).cast(types[c])).otherwise(value)
        elif c in of:
            value = F.when(new | old_hit, of[c]).otherwise(value)
        elif c in AUDIT_NAMES:
            for when, inserted in ((old_hit, False), (new, True)):
                if (given := _audit_value(c, inserted, meta, now)) is not None:
                    value = F.when(when, given.cast(types[c])).otherwise(value)
        out.append(value.alias(c))
    return j.select(*out, F.when(new, "I").when(old_hit, "U").otherwise("K").alias("_action"))


def upsert(target: DataFrame, source: DataFrame, keys: list, *, surrogate: str | None = None,
           meta: dict | None = None, as_of=None, only_changed: bool = False,
           keyless: str = "refuse", insert_columns: list[str] | None = None,
           update_columns: list[str] | None = None, insert_defaults: dict | None = None,
           insert_null_test: str = "all") -> UpsertResult:
    """Upsert ``source`` into ``target`` on ``keys``.

    ``keys``: column names, or ``(source_col, target_col)`` pairs when names differ.
    ``meta``: values of etljobname / envsourcecd / datasourcecd.
    ``as_of``: timestamp Column or value used for now().
    ``keyless``: with no keys, 'refuse' (default) raises, 'append' inserts every
      source row.  The keyless cross product of the original procedure is not offered.
    ``update_columns`` / ``insert_columns`` / ``insert_defaults``: explicit column
      plan (the mapped legacy form); by default every source column present in
      the target is updated and inserted.
    ``insert_null_test``: 'all' (anti join on every key) or 'first' (legacy: a
      source row is new when its first key finds no silver row).
    """
    meta = dict(meta or {})
    now = _now(as_of)
    pairs = [(k, k) if isinstance(k, str) else tuple(k) for k in keys]
    if not pairs and keyless != "append":
        raise ValueError("no business key: refusing the keyless update/insert; pass keyless='append'")
    ttypes = dict(target.dtypes)
    tcols = target.columns
    scols = set(source.columns)
    upd = [c for c in (update_columns if update_columns is not None else tcols)
           if c in scols and c in ttypes and c != surrogate and c not in AUDIT_NAMES]
    ins = [c for c in (insert_columns if insert_columns is not None else tcols)
           if c in scols and c != surrogate and c not in AUDIT_NAMES]
    defaults = dict(insert_defaults or {})

    def audit_value(c: str, inserted: bool) -> Column | None:
        return _audit_value(c, inserted, meta, now)

    # -- 'U' / 'K': silver left join source ---------------------------------
    s_key_ok = _all([F.col(s).isNotNull() for s, _ in pairs])
    t_key_ok = _all([F.col(t).isNotNull() for _, t in pairs])
    if pairs:
        # UPDATE ... FROM writes a silver row once even when several source rows
        # match it: reduce the update side to one row per key first.  A partial
        # aggregation, so a hot duplicated key is combined map-side and the join
        # below sees unique keys on the source side.
        one = one_per_key(source.where(s_key_ok), [s for s, _ in pairs])
        s_side = one.select(*[F.col(c).alias(f"_s_{c}") for c in source.columns], F.lit(True).alias("_hit"))
        t_nn = target.where(t_key_ok)
        cond = _all([F.col(t) == F.col(f"_s_{s}") for s, t in pairs])
        j = t_nn.join(s_side, cond, "left")
    else:
        j = None
    hit = F.coalesce(F.col("_hit"), F.lit(False))
    if only_changed and pairs:
        changed = _any([~F.col(c).eqNullSafe(F.col(f"_s_{c}")) for c in upd])
        hit = hit & changed
    out = []
    for c in tcols:
        if c in upd:
            v = F.when(hit, F.col(f"_s_{c}").cast(ttypes[c])).otherwise(F.col(c))
        elif c in AUDIT_NAMES and audit_value(c, False) is not None:
            v = F.when(hit, audit_value(c, False).cast(ttypes[c])).otherwise(F.col(c))
        else:
            v = F.col(c)
        out.append(v.alias(c))
    out.append(F.when(hit, F.lit("U")).otherwise(F.lit("K")).alias("_action"))
    if pairs:
        matched = j.select(*out).unionByName(
            target.where(~t_key_ok).withColumn("_action", F.lit("K")))
    else:
        matched = target.withColumn("_action", F.lit("K"))

    # -- 'I': source rows with no silver row ----------------------------------
    if pairs:
        probe = pairs if insert_null_test == "all" else pairs[:1]
        tk = target.select(*[F.col(t).alias(f"_k_{s}") for s, t in probe]).where(
            _all([F.col(f"_k_{s}").isNotNull() for s, _ in probe]))
        new = source.where(s_key_ok).join(
            tk, _all([F.col(s) == F.col(f"_k_{s}") for s, _ in probe]), "left_anti")
        new = new.unionByName(source.where(~s_key_ok))
    else:
        new = source
    order = [s for s, _ in pairs] + [c for c in source.columns if c not in {s for s, _ in pairs}]

    def numbered(rows: DataFrame) -> DataFrame:
        if surrogate:
            maxkey = target.select(F.coalesce(F.max(surrogate), F.lit(0)).cast("long")).scalar()
            # keys first, then whatever can be ordered; other columns by a hash of their text
            names = {f.name: f.dataType for f in source.schema.fields}
            by = [F.col(c) if orderable(names[c]) else F.xxhash64(F.to_json(F.struct(F.col(c)))) for c in order]
            rows = with_row_index(rows, by, name="_rn")
        iout = []
        for c in tcols:
            if c == surrogate:
                v = (maxkey + F.col("_rn")).cast(ttypes[c])
            elif c in AUDIT_NAMES and audit_value(c, True) is not None:
                v = audit_value(c, True).cast(ttypes[c])
            elif c in ins:
                v = F.col(c).cast(ttypes[c])
            elif c in defaults:
                v = F.lit(defaults[c]).cast(ttypes[c])
            else:
                v = F.lit(None).cast(ttypes[c])
            iout.append(v.alias(c))
        return rows.select(*iout, F.lit("I").alias("_action"))

    return UpsertResult(matched, new, numbered, source, pairs)


def source_duplicates(source: DataFrame, keys: list[str]) -> DataFrame:
    """Business keys that occur more than once in the source (Q5).

    A matched silver row would otherwise be updated from an arbitrary one."""
    nn = _all([F.col(k).isNotNull() for k in keys])
    return (source.where(nn).groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
            .where(F.col("n") > 1))


def orderable(dt: T.DataType) -> bool:
    if isinstance(dt, T.MapType) or isinstance(dt, T.VariantType):
        return False
    if isinstance(dt, T.StructType):
        return all(orderable(f.dataType) for f in dt.fields)
    if isinstance(dt, T.ArrayType):
        return orderable(dt.elementType)
    return True


def one_per_key(source: DataFrame, keys: list[str]) -> DataFrame:
    """One row per key: the greatest row by its other columns (deterministic),
    or any one when a column cannot be ordered (the original picks any)."""
    rest = [f for f in source.schema.fields if f.name not in keys]
    if not rest:
        return source.dropDuplicates(keys)
    packed = F.struct(*[F.col(f.name) for f in rest])
    agg = F.max(packed) if all(orderable(f.dataType) for f in rest) else F.first(packed)
    g = source.groupBy(*keys).agg(agg.alias("_one"))
    return g.select(*keys, *[F.col(f"_one.{f.name}").alias(f.name) for f in rest]).select(*source.columns)


def dedupe_source(source: DataFrame, keys: list[str], order_by: list) -> DataFrame:
    """Keep one row per business key: the greatest by ``order_by`` (Q5 option).

    A partial ``max_by``-style aggregation (max of a struct) - no window, so a
    hot key is combined map-side instead of landing whole in one task."""
    cols = [c for c in source.columns if c not in keys]
    ordered = [F.col(c) if isinstance(c, str) else c for c in order_by]
    best = F.max(F.struct(*[o.alias(f"_o{i}") for i, o in enumerate(ordered)],
                          *[F.col(c) for c in cols])).alias("_best")
    g = source.groupBy(*keys).agg(best)
    return g.select(*keys, *[F.col(f"_best.{c}").alias(c) for c in cols]).select(*source.columns)
