"""Insert-or-update and insert-or-ignore over immutable tables.

Both return the new state of the target as a DataFrame; publish it as a new
version (``lendscope.sources.store``).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lendscope.operators.dedup import first_per_key, newest_per_key
from lendscope.operators.keys import assign_keys
from lendscope.operators.sizes import BROADCAST_BYTES, estimated_bytes
from lendscope.sources.workspace import stored


def _insert_value(column: str, source: DataFrame, defaults: dict[str, Column], target: DataFrame) -> Column:
    if column in source.columns:
        return F.col(column)
    if column in defaults:
        return defaults[column]
    return F.lit(None).cast(target.schema[column].dataType)


def known_keys(target: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    """Keys of the target rows that the source mentions, stored: at most as many
    as the source has rows. Reads the key columns of the target alone; a batch
    small enough is broadcast, and the target not shuffled."""
    return stored(target.select(*keys).join(source.select(*keys), keys, "left_semi"), "known-keys")


def _without(source: DataFrame, known: DataFrame, keys: list[str]) -> DataFrame:
    """Source rows whose key is not among the known ones. Where these are too many to be broadcast, the keys
    that are left are found first, from the key columns alone; if they are few, no other column is shuffled."""
    if estimated_bytes(known) > BROADCAST_BYTES:
        left = stored(source.select(*keys).join(known, keys, "left_anti"), "unknown-keys")
        if estimated_bytes(left) <= BROADCAST_BYTES:
            names = F.broadcast(left.select(*[F.col(k).alias(f"_left_{k}") for k in keys]))
            # a row without a key is not known either
            return source.join(names, reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(f"_left_{k}")) for k in keys]), "left_semi")
    return source.join(known, keys, "left_anti")


def new_rows(
    target: DataFrame,
    source: DataFrame,
    keys: list[str],
    surrogate: str | None,
    defaults: dict[str, Column],
    known: DataFrame | None = None,
    held: bool = True,
) -> DataFrame:
    """Source rows whose key the target lacks, in the target's layout. ``held``: the source is cheap to
    read twice (see ``assign_keys``)."""
    known = known_keys(target, source, keys) if known is None else known
    fresh = _without(source, known.select(*keys), keys)
    if surrogate:
        start = target.agg(F.max(surrogate)).scalar()
        key_type = target.schema[surrogate].dataType.simpleString()
        fresh = assign_keys(fresh, keys[0], surrogate, start, key_type, held=held)
        columns = [surrogate, *source.columns]
    else:
        columns = list(source.columns)
    layout = [
        (F.col(c) if c in columns else _insert_value(c, source, defaults, target))
        .cast(target.schema[c].dataType)
        .alias(c)
        for c in target.columns
    ]
    return fresh.select(*layout)


def _changes(batch: DataFrame, keys: list[str], update_cols: list[str]) -> DataFrame:
    return batch.select(*keys, F.lit(True).alias("_hit"), *[F.col(c).alias(f"_new_{c}") for c in update_cols])


def _new_values(target: DataFrame, update_cols: list[str], touched: dict[str, Column]) -> dict[str, Column]:
    """What an updated row gets, by column; over the target's rows joined to ``_changes``."""
    values = {**touched, **{c: F.col(f"_new_{c}") for c in update_cols}}
    return {c: values[c].cast(target.schema[c].dataType) for c in target.columns if c in values}


def _changed(
    target: DataFrame, batch: DataFrame, keys: list[str], update_cols: list[str], touched: dict[str, Column]
) -> DataFrame:
    """The target with the listed columns of the batch's rows."""
    values = _new_values(target, update_cols, touched)
    updated = [F.when(F.col("_hit"), values[c]).otherwise(F.col(c)).alias(c) if c in values else F.col(c) for c in target.columns]
    return target.join(_changes(batch, keys, update_cols), keys, "left").select(*updated)


def upsert(
    target: DataFrame,
    source: DataFrame,
    keys: list[str],
    update_cols: list[str],
    surrogate: str | None = None,
    touched: dict[str, Column] | None = None,
    defaults: dict[str, Column] | None = None,
    order: list[str] | None = None,
) -> DataFrame:
    """New keys are inserted whole; of known keys only ``update_cols`` change.

    ``source`` may repeat a key: the newest row by ``order`` wins (None: keys
    are unique already). ``touched``
    sets columns of updated rows only (an audit time stamp), ``defaults`` fills
    target columns the source lacks on insert, ``surrogate`` numbers new rows
    after the target's largest key.

    Updates are a left join of the target to the source, which Catalyst
    broadcasts when the batch is small, so that a large target is not
    shuffled; otherwise both sides shuffle once on the key, which is unique on
    both. Beside that, only the target's key columns are read.
    """
    batch = _batch(target, source, keys, order)
    kept = _changed(target, batch, keys, update_cols, touched or {})
    return kept.unionByName(new_rows(target, batch, keys, surrogate, defaults or {}, held=order is None))


def _batch(target: DataFrame, source: DataFrame, keys: list[str], order: list[str] | None) -> DataFrame:
    batch = newest_per_key(source, keys, order) if order is not None else source
    return batch.select(*keys, *[c for c in batch.columns if c not in keys and c in target.columns])


def upsert_folders(
    target: DataFrame,
    source: DataFrame,
    keys: list[str],
    update_cols: list[str],
    folder: str,
    folder_of: Column,
    surrogate: str | None = None,
    touched: dict[str, Column] | None = None,
    defaults: dict[str, Column] | None = None,
) -> tuple[DataFrame, list[int]]:
    """``upsert`` for a target in folders: the new rows of the touched folders,
    stored, and which folders these are. All others keep their files, also those
    whose rows the batch brings again just as they are.

    ``folder_of`` is the folder of a source row; a known key keeps the folder of
    its target row, since updates do not move rows. Folders are calendar months,
    so their list is short.
    """
    batch = _batch(target, source, keys, None)
    values = _new_values(target, update_cols, touched or {})
    same = reduce(Column.__and__, [F.col(c).eqNullSafe(v) for c, v in values.items()], F.lit(True))
    known = target.join(_changes(batch, keys, update_cols), keys).select(*keys, folder, (~same).alias("_differs"))
    known = stored(known, "known-keys")
    fresh = new_rows(target.drop(folder), batch, keys, surrogate, defaults or {}, known).withColumn(folder, folder_of)
    fresh = stored(fresh, "new-rows")
    folders = known.filter("_differs").select(folder).unionByName(fresh.select(folder)).distinct()
    names = sorted(row[0] for row in folders.collect())
    kept = stored(_changed(target.filter(F.col(folder).isin(*names)), batch, keys, update_cols, touched or {}), "kept-rows")
    return kept.unionByName(fresh.select(*kept.columns)), names


def insert_ignore(
    target: DataFrame,
    source: DataFrame,
    keys: list[str],
    order: list[str] | None,
    surrogate: str | None = None,
    defaults: dict[str, Column] | None = None,
) -> DataFrame:
    """Rows to append: source rows with a key the target lacks, the first by
    ``order`` per key (None: keys are unique already). Append them; the target
    itself is not rewritten."""
    batch = source if order is None else first_per_key(source, keys, order)
    return new_rows(target, batch, keys, surrogate, defaults or {}, held=order is None)


def merge_into(source: DataFrame, table: str, keys: list[str], update_cols: list[str]) -> None:
    """The same upsert as one MERGE, for catalogs with row-level operations."""
    on = [F.col(f"{table}.{k}") == F.col(f"source.{k}") for k in keys]
    condition = on[0]
    for part in on[1:]:
        condition = condition & part
    (
        source.alias("source")
        .mergeInto(table, condition)
        .whenMatched()
        .update({c: F.col(f"source.{c}") for c in update_cols})
        .whenNotMatched()
        .insertAll()
        .merge()
    )
