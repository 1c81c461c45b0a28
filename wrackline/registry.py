"""Plug-ins: analysers of payloads and of text, added by decorator and run in one pass.

A payload analyser is ``f(data: bytes, url: str) -> dict[str, str]`` for media
types that match its patterns; a text analyser is ``f(text: str) -> dict``. They
run in the order of their registration in one Arrow pass. A failure, or a run
over ``seconds``, becomes an entry in ``errors`` and loses nothing else.
"""

from __future__ import annotations

import re
import signal
import threading
from collections.abc import Callable
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

RESULT = T.StructType([T.StructField("fields", T.MapType(T.StringType(), T.StringType())), T.StructField("errors", T.ArrayType(T.StringType()))])


def limited(call: Callable, seconds: float, *args):
    """The call's result, or TimeoutError after some seconds (in a worker's main thread)."""
    if seconds <= 0 or threading.current_thread() is not threading.main_thread():
        return call(*args)

    def stop(*_):
        raise TimeoutError(f"over {seconds} s")

    before = signal.signal(signal.SIGALRM, stop)
    signal.setitimer(signal.ITIMER_REAL, seconds)
    try:
        return call(*args)
    finally:
        signal.setitimer(signal.ITIMER_REAL, 0)
        signal.signal(signal.SIGALRM, before)


@dataclass
class Registry:
    payload: list[tuple[str, re.Pattern, Callable, float]] = field(default_factory=list)
    text: list[tuple[str, Callable, float]] = field(default_factory=list)

    def payload_analyser(self, name: str, mime: str = "", seconds: float = 30.0):
        def add(call):
            self.payload.append((name, re.compile(mime), call, seconds))
            return call

        return add

    def text_analyser(self, name: str, seconds: float = 30.0):
        def add(call):
            self.text.append((name, call, seconds))
            return call

        return add

    @staticmethod
    def _run(steps) -> tuple[dict, list[str]]:
        fields: dict[str, str] = {}
        errors: list[str] = []
        for name, call, seconds, args in steps:
            try:
                fields.update({k: str(v) for k, v in (limited(call, seconds, *args) or {}).items() if v is not None})
            except Exception as e:  # noqa: BLE001 - isolated per analyser
                errors.append(f"{type(e).__name__} {name}: {e}")
        return fields, errors

    def analyse_payload(self, data: Column, mime: Column, url: Column) -> Column:
        steps = list(self.payload)

        @F.pandas_udf(RESULT)
        def run(bodies: pd.Series, mimes: pd.Series, urls: pd.Series) -> pd.DataFrame:
            rows = [Registry._run([(n, c, s, (bytes(b), u)) for n, p, c, s in steps if b is not None and p.search(m or "")]) for b, m, u in zip(bodies, mimes, urls)]
            return pd.DataFrame(rows, columns=["fields", "errors"])

        return run(data, mime, url)

    def analyse_text(self, text: Column) -> Column:
        steps = list(self.text)

        @F.pandas_udf(RESULT)
        def run(texts: pd.Series) -> pd.DataFrame:
            rows = [Registry._run([(n, c, s, (t.strip(),)) for n, c, s in steps if t and t.strip()]) for t in texts]
            return pd.DataFrame(rows, columns=["fields", "errors"])

        return run(text)
