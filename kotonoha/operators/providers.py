"""Plug-in points for models: each is an Arrow function that loads its model once per worker, on the first batch.

A sample that fails gives an error in its row; a failure of the model itself is raised and fails the task.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Any

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

RESULT = T.StructType([T.StructField("value", T.StringType()), T.StructField("error", T.StringType())])


class SampleError(ValueError):
    """One sample can't be handled; others can."""


def provider(load: Callable[[], Any], call: Callable[[Any, str], str]) -> Callable[[Column], Column]:
    """struct(value, error) of a string column. Without rows the model is never loaded."""

    @F.pandas_udf(RESULT)
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        model = None
        for batch in batches:
            out = []
            for x in batch:
                if not isinstance(x, str):
                    out.append((None, None))
                    continue
                model = load() if model is None else model
                try:
                    out.append((call(model, x), None))
                except SampleError as e:
                    out.append((None, str(e)))
            yield pd.DataFrame(out, columns=RESULT.names, dtype=object)

    return run


def _look_up(table: dict[str, str], text: str) -> str:
    if text not in table:
        raise SampleError("no entry")
    return table[text]


def lookup(table: dict[str, str]) -> Callable[[Column], Column]:
    """A provider that knows its answers; stands in for readings, transcripts and the like in tests."""
    return provider(lambda: table, _look_up)


def kana_passthrough() -> Callable[[Column], Column]:
    """Reading of texts that are kana already."""
    import unicodedata

    def call(_: Any, text: str) -> str:
        out = "".join(chr(ord(c) + 0x60) if "ぁ" <= c <= "ゖ" else c for c in unicodedata.normalize("NFKC", text))
        if any("一" <= c <= "鿿" for c in out):
            raise SampleError("kanji needs a dictionary")
        return out

    return provider(dict, call)


def synthesize(plans: DataFrame, load: Callable[[], Any], call: Callable[[Any, dict], bytes], parallel: int | None = None) -> DataFrame:
    """Plans with ``audio`` and ``error``: one model a task, as many tasks at once as ``parallel`` devices."""
    schema = T.StructType([*plans.schema.fields, T.StructField("audio", T.BinaryType()), T.StructField("error", T.StringType())])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = None
        for batch in batches:
            audio: list[bytes | None] = []
            error: list[str | None] = []
            for row in batch.to_dict("records"):
                model = load() if model is None else model
                try:
                    audio.append(call(model, row))
                    error.append(None)
                except SampleError as e:
                    audio.append(None)
                    error.append(str(e))
            yield batch.assign(audio=pd.Series(audio, index=batch.index, dtype=object), error=pd.Series(error, index=batch.index, dtype=object))

    own = plans.repartition(parallel) if parallel else plans
    return own.mapInPandas(run, schema)


def tone(rate: int = 24_000) -> Callable[[Any, dict], bytes]:
    """Test voice: a tone as long as the text, its pitch taken from ``seed``."""
    import numpy as np

    from ..sources.audio import encode

    def call(_: Any, row: dict) -> bytes:
        text = row.get("text")
        if not isinstance(text, str) or not text:
            raise SampleError("no text")
        n = len(text) * rate // 20
        return encode(0.3 * np.sin(2 * np.pi * (200 + int(row.get("seed") or 0) % 200) * np.arange(n) / rate), rate)

    return call
