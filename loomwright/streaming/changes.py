"""Changes by key on a stream: a row goes on where it is newer than what its key had and says something else.

The state of a key is the place and a fingerprint of its last row, so late, repeated and unchanged rows are dropped across batches and
restarts. A key that is quiet for long enough is forgotten, and its next row goes on as new.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout


def changed(rows: DataFrame, keys: Sequence[str], place: str, quiet: int | None = None) -> DataFrame:
    """For each batch and key the last row by `place` (a whole number, such as microseconds or a version), where it is later than the key's last row and differs in any other column.

    Of rows of one place that with the largest fingerprint counts, so a repeated read gives the same. Rows without a place are
    left out; null keys are a key. A key's rows of a batch are read piece by piece, and one of them is held.

    quiet: milliseconds after which a key without rows is forgotten; for streams that run on, since Spark then runs batches
    for time alone and a stream of the rows available now would not end. Without it, keys are kept."""
    columns = rows.columns
    told = F.sha2(F.to_json(F.struct(*(c for c in columns if c != place)), {"ignoreNullFields": "false"}), 256)
    marked = rows.where(F.col(place).isNotNull()).withColumn("_place", F.col(place).cast("long")).withColumn("_told", told)

    def newest(key, pieces: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        last = None
        for piece in pieces:
            top = piece.sort_values(["_place", "_told"]).tail(1)
            if last is None or (top["_place"].iloc[0], top["_told"].iloc[0]) > (last["_place"].iloc[0], last["_told"].iloc[0]):
                last = top
        before = state.get if state.exists else None
        if last is not None:
            at, now = int(last["_place"].iloc[0]), last["_told"].iloc[0]
            if before is None or at > before[0]:
                state.update((at, now))
                if before is None or now != before[1]:
                    yield last[columns]
        if quiet:
            state.setTimeoutDuration(quiet)

    schema = T.StructType(rows.schema.fields)
    return marked.groupBy(*keys).applyInPandasWithState(newest, schema, "place long, told string", "append", GroupStateTimeout.ProcessingTimeTimeout if quiet else GroupStateTimeout.NoTimeout)
