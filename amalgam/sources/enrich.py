"""Enrichment from an interface that answers a few keys a call."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Keys of a call, tries of it, and seconds before the second try (doubled each time).
PER_CALL, TRIES, WAIT = 20, 5, 1.0

#: A call: keys to (redirects of a key to another, answers by key).
Fetch = Callable[[list[str]], tuple[dict[str, str], dict[str, str]]]


def answers(keys: list[str], fetch: Fetch, tries: int = TRIES, wait: float = WAIT) -> list[str | None]:
    """The answer to each key, looked up through redirects; null if there is none or all tries failed."""
    for turn in range(tries):
        try:
            moved, found = fetch(keys)
            break
        except (OSError, TimeoutError, ValueError):
            if turn + 1 < tries:
                time.sleep(wait * 2**turn)
    else:
        return [None] * len(keys)
    out = []
    for key in keys:
        seen = set()
        while key in moved and key not in seen:
            seen.add(key)
            key = moved[key]
        out.append(found.get(key))
    return out


def enrich(rows: DataFrame, key: str, fetch: Fetch, answer: str = "answer", per_call: int = PER_CALL, tasks: int = 8, tries: int = TRIES, wait: float = WAIT) -> DataFrame:
    """(key, answer) of the distinct keys of ``rows``, ``per_call`` in a call, ``tasks`` calls at a time.

    ``fetch`` runs in Python workers; failing calls are tried again with
    growing pauses. Nothing else is done twice on purpose, but a lost executor's
    calls are repeated.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            keys = batch["key"].tolist()
            for at in range(0, len(keys), per_call):
                some = keys[at : at + per_call]
                yield pd.DataFrame({key: some, answer: pd.Series(answers(some, fetch, tries, wait), dtype=object)})

    distinct = rows.select(F.col(key).cast("string").alias("key")).filter("key is not null").distinct().repartition(tasks, "key")
    return distinct.mapInPandas(run, f"`{key}` string, `{answer}` string")
