"""Custom keyed state."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import pandas as pd
from pyspark.sql import DataFrame, GroupedData, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

PROVIDER = "spark.sql.streaming.stateStore.providerClass"


def _add(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    n, cents = state.get if state.exists else (0, 0)
    for b in batches:
        n += len(b)
        cents += int(b["cents"].sum())
    state.update((n, cents))
    yield pd.DataFrame({"user_id": [key[0]], "n": [n], "cents": [cents]})


def running_totals(events: DataFrame) -> DataFrame:
    """After each batch, the count and sum so far of each user that it has rows of. The state is two numbers a user."""
    rows = events.selectExpr("user_id", "cast(round(value * 100) as bigint) AS cents")
    return rows.groupBy("user_id").applyInPandasWithState(_add, "user_id bigint, n bigint, cents bigint", "n bigint, cents bigint", "update", GroupStateTimeout.NoTimeout)


#: Neighbouring keys that share a state: each call of a processor costs far more than a row does.
GROUP = 64


def in_groups(rows: DataFrame, key: str) -> GroupedData:
    """Rows by groups of a number key: GROUP neighbours at most (twice as many around 0), so that groups grow in number, not in size. Null keys are one group."""
    return rows.withColumn("key_group", F.expr(f"`{key}` div {GROUP}")).groupBy("key_group")


class Counter(StatefulProcessor):
    """The rows of each user of a group so far."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.seen = handle.getValueState("seen", "user_id array<bigint>, n array<bigint>")

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timers: object) -> Iterator[pd.DataFrame]:
        known = dict(zip(*self.seen.get(), strict=True)) if self.seen.exists() else {}
        new = {}
        for part in rows:
            for user, n in part["user_id"].astype("Int64").value_counts(dropna=False).items():
                user = None if pd.isna(user) else int(user)
                new[user] = new.get(user, 0) + int(n)
        new = {user: known.get(user, 0) + n for user, n in new.items()}
        known |= new
        self.seen.update((list(known), list(known.values())))
        yield pd.DataFrame({"user_id": pd.array(list(new), "Int64"), "n": list(new.values())})

    def close(self) -> None:
        pass


def running_counts(events: DataFrame) -> DataFrame:
    """As running_totals, counts only, by a stateful processor; it needs rocks()."""
    return in_groups(events.select("user_id"), "user_id").transformWithStateInPandas(Counter(), "user_id bigint, n bigint", "update", "none")


@contextmanager
def rocks(spark: SparkSession) -> Iterator[None]:
    """The session keeps state in RocksDB, which stateful processors need, for as long."""
    before = spark.conf.get(PROVIDER, None)
    spark.conf.set(PROVIDER, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        yield
    finally:
        spark.conf.set(PROVIDER, before) if before else spark.conf.unset(PROVIDER)
