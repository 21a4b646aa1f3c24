"""Remote answers (geocoders, embeddings, language models) behind a provider and a cache: only misses are asked for."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.queues import misses
from tidemark.operators.tables import upsert

#: A provider answers a batch of keys with one (answer, error) per key; a transient failure has an error and no answer.
Provider = Callable[[list[str]], list[tuple[str | None, str | None]]]
#: Errors that are answers: they will not go away and are cached.
PERMANENT = ("no result present", "no railway result present", "unknown")


def stub(keys: list[str]) -> list[tuple[str | None, str | None]]:
    """A provider for work without a network: the hash of the key."""
    return [(hashlib.md5(k.encode()).hexdigest(), None) for k in keys]


def ask(wanted: DataFrame, key: str, provider: Provider, batch: int = 100) -> DataFrame:
    """(key, answer, error) from the provider, in batches, each row's failure kept beside it."""

    def call(pdfs: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in pdfs:
            keys, out = pdf[key].tolist(), []
            for i in range(0, len(keys), batch):
                part = keys[i : i + batch]
                try:
                    out += provider(part)
                except Exception as e:  # noqa: BLE001  (an item's failure must not end the run)
                    out += [(None, f"{type(e).__name__}: {e}")] * len(part)
            yield pd.DataFrame({key: keys, "answer": [a for a, _ in out], "error": [e for _, e in out]})

    return wanted.select(key).mapInPandas(call, f"{key} string, answer string, error string")


def cached_lookup(wanted: DataFrame, cache: DataFrame, key: str, provider: Provider, bypass: Column | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(answers of all wanted keys, the new cache, failures). ``cache``: key, answer. ``bypass``: cached rows that do not count.
    Answers and permanent errors are cached; transient errors are reported and asked again next time."""
    usable = cache if bypass is None else cache.filter(~F.coalesce(bypass, F.lit(False)))
    asked = ask(misses(wanted, usable, key), key, provider).persist()
    lasting = F.col("error").isNull() | F.lower("error").isin(*PERMANENT)
    fresh = asked.filter(lasting).select(key, "answer")
    new_cache = upsert(cache, fresh, [key])
    return wanted.join(new_cache.select(key, "answer"), key, "left"), new_cache, asked.filter(~lasting)
