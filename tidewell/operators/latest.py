"""Latest row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

RECENCY = ("_ingest_timestamp", "ingested_at", "_ingestion_run_id")


def latest_per_key(
    df: DataFrame,
    keys: str | Sequence[str],
    settle_ties_by: Sequence[str] | None = None,
    null_keys_match: bool = True,
) -> DataFrame:
    """Keep the most recently ingested row of each key.

    Spark plans ``row_number() = 1`` as a group limit that already runs before the shuffle, so a
    key holding a large part of the table leaves each map task as a single row.

    Rows ingested at the same time are ordered by upload time and run, then by ``settle_ties_by``;
    by default that is a hash of the whole row, so a task that runs again picks the same row.

    With ``null_keys_match=False`` rows without a key are no duplicates of one another (only exact
    copies collapse), the way a MERGE condition treats them.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    row_hash = f"xxhash64({', '.join(f'`{c}`' for c in df.columns)})"
    order = [f"`{c}`" for c in RECENCY if c in df.columns]
    order += [row_hash] if settle_ties_by is None else [f"`{c}`" for c in settle_ties_by]
    group = [f"`{c}`" for c in keys]
    if not null_keys_match:
        group.append(f"if({' or '.join(f'{c} is null' for c in group)}, {row_hash}, null)")
    newest_first = ", ".join(f"{c} desc nulls last" for c in order)
    nth = f"row_number() over (partition by {', '.join(group)} order by {newest_first}) as _nth"
    return df.selectExpr("*", nth).filter("_nth = 1").drop("_nth")
