"""External text models behind one protocol: batches of prompts in Arrow, retries, repair of answers, pacing, resumable rounds.

A client is made on the worker by a factory that is pickled to it; the engine has no client of its own.
"""

from __future__ import annotations

import json
import random
import time
from collections import deque
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from typing import Protocol

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Marks of errors that pass, delays between attempts in seconds, rounds of repair.
PASSING = ("503", "UNAVAILABLE", "429", "RESOURCE_EXHAUSTED")
DELAY, LONGEST, JITTER = 1.5, 20.0, 0.25
RETRIES, REPAIRS = 4, 2
WINDOW, SHARE = 60.0, 0.9


class TextModel(Protocol):
    def complete(self, system: str, user: str) -> str: ...


def passes(error: Exception) -> bool:
    """Whether an error may be gone at the next attempt."""
    return any(mark in str(error) for mark in PASSING)


def persistent(call: Callable[[], str], retries: int = RETRIES, sleep: Callable[[float], None] = time.sleep) -> str:
    """The call's answer; errors that pass are waited out, twice as long each time with some jitter."""
    for n in range(retries + 1):
        try:
            return call()
        except Exception as error:
            if n == retries or not passes(error):
                raise
            sleep(min(LONGEST, DELAY * 2**n) * (1 + random.random() * JITTER))  # noqa: S311
    raise AssertionError


def json_object(text: str | None) -> dict | None:
    """The whole text, or what stands between its first and last brace, as an object."""
    t = text or ""
    for part in (t, t[t.find("{") : t.rfind("}") + 1]):
        try:
            found = json.loads(part)
        except ValueError:
            continue
        if isinstance(found, dict):
            return found
    return None


def looks_cut(text: str | Column) -> Column:
    """Whether an answer ends before its braces and brackets are closed."""
    t = F.rtrim(F.col(text) if isinstance(text, str) else text)
    count = lambda c: F.length(t) - F.length(F.replace(t, F.lit(c), F.lit("")))
    return ~t.rlike(r"[}\]]\z") | (count("{") != count("}")) | (count("[") != count("]"))


def asked_for_json(model: TextModel, system: str, user: str, repairs: int = REPAIRS, retries: int = RETRIES, sleep: Callable[[float], None] = time.sleep) -> tuple[dict | None, int]:
    """(object, calls): the answer as an object, asked again with the failed answer as context up to `repairs` times."""
    said = persistent(lambda: model.complete(system, user), retries, sleep)
    for n in range(repairs + 1):
        found = json_object(said)
        if found is not None or n == repairs:
            return found, n + 1
        again = f"{user}\n\nThe answer before wasn't one JSON object:\n{said}\n\nGive the object alone."
        said = persistent(lambda again=again: model.complete(system, again), retries, sleep)
    raise AssertionError


def mapped(rows: DataFrame, factory: Callable[[], TextModel], system: str, prompt: str, keep: list[str], repairs: int = REPAIRS) -> DataFrame:
    """Rows (keep, key, value, calls, error): the facts of each row's answer, values as text; a row without any has one of null key.

    One client for each worker task. A failed call is a row with its error, never a failed job.
    """
    kinds = dict(rows.select(*keep).dtypes)
    schema = ", ".join(f"`{c}` {t}" for c, t in kinds.items()) + ", key string, value string, calls int, error string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = factory()
        for batch in batches:
            row, keys, values, calls, errors = [], [], [], [], []

            def put(i: int, key: str | None, value: str | None, n: int, error: str | None) -> None:
                for column, v in zip((row, keys, values, calls, errors), (i, key, value, n, error), strict=True):  # noqa: B023
                    column.append(v)

            for i, user in enumerate(batch.column(len(keep)).to_pylist()):
                try:
                    found, n = asked_for_json(model, system, user or "", repairs)
                except Exception as error:
                    put(i, None, None, 0, str(error)[:500])
                    continue
                for key, value in (found or {}).items():
                    value = value.get("value") if isinstance(value, dict) else value
                    put(i, key, value if value is None or isinstance(value, str) else json.dumps(value, ensure_ascii=False), n, None)
                if not found:
                    put(i, None, None, n, None if found is not None else "no JSON object")
            own = [batch.column(c).take(pa.array(row, pa.int64())) for c in range(len(keep))]
            yield pa.RecordBatch.from_arrays([*own, pa.array(keys, pa.string()), pa.array(values, pa.string()), pa.array(calls, pa.int32()), pa.array(errors, pa.string())], names=[*keep, "key", "value", "calls", "error"])

    return rows.select(*keep, F.col(prompt).cast("string").alias("__prompt")).mapInArrow(run, schema)


def first_facts(facts: DataFrame, keys: list[str], key: str, value: str, order: list[str]) -> DataFrame:
    """The first non-null value of each key in the order of the calls."""
    return facts.where(F.col(value).isNotNull()).groupBy(*keys, key).agg(F.min(F.struct(*order, value)).alias("m")).select(*keys, key, F.col(f"m.{value}").alias(value))


def in_rounds(pending: DataFrame, keys: list[str], attempt: Callable[[DataFrame, int], DataFrame], write: Callable[[DataFrame, int], DataFrame], rounds: int) -> DataFrame:
    """What `attempt` makes of the pending rows, those without an answer (column done) again, up to `rounds` times.

    `write` stores a round and reads it back, so a round is never computed twice; a later run can leave out what is stored.
    """
    done = None
    for n in range(rounds):
        got = write(attempt(pending, n), n)
        good = got.where("done")
        done = good if done is None else done.unionByName(good)
        pending = pending.join(good.select(*keys), keys, "left_anti")
        if n + 1 == rounds or pending.isEmpty():
            break
    return done


@dataclass
class Pace:
    """Requests and tokens within a sliding window, kept under a share of their limits. Used by a client, never across tasks.

    A request is admitted with its estimated tokens and corrected when it is done; without limits everything is.
    """

    requests: int | None = None
    tokens: int | None = None
    window: float = WINDOW
    share: float = SHARE
    clock: Callable[[], float] = time.monotonic
    log: deque[list[float]] = field(default_factory=deque)

    def _trim(self, now: float) -> None:
        while self.log and self.log[0][0] <= now - self.window:
            self.log.popleft()

    def wait(self, estimate: int) -> float:
        """Seconds until a request of so many tokens may start; 0 if now."""
        now = self.clock()
        self._trim(now)
        until = now
        if self.requests is not None and len(self.log) >= max(1, int(self.requests * self.share)):
            until = max(until, self.log[len(self.log) - max(1, int(self.requests * self.share))][0] + self.window)
        if self.tokens is not None:
            room, used = self.tokens * self.share, sum(e[1] for e in self.log)
            for at, n in self.log:
                if used + estimate <= room:
                    break
                used -= n
                until = max(until, at + self.window)
        return until - now

    def start(self, estimate: int) -> list[float]:
        entry = [self.clock(), float(estimate)]
        self.log.append(entry)
        return entry

    def done(self, entry: list[float], actual: int) -> None:
        entry[1] = float(actual)


def paced(model: TextModel, pace: Pace, sleep: Callable[[float], None] = time.sleep) -> TextModel:
    """The model behind a pace; tokens are estimated as a quarter of the characters."""

    class Paced:
        def complete(self, system: str, user: str) -> str:
            estimate = max(1, -(-(len(system) + len(user)) // 4))
            while (left := pace.wait(estimate)) > 0:
                sleep(left)
            entry = pace.start(estimate)
            said = model.complete(system, user)
            pace.done(entry, estimate + max(1, -(-len(said) // 4)))
            return said

    return Paced()
