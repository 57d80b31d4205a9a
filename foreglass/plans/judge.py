"""Calls of an external model as a table operator. The client is injected, so tests need no network."""

from __future__ import annotations

import concurrent.futures as futures
import json
import time
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, functions as F

from foreglass.functions.text import without_assistant
from foreglass.plans.prefix import group_positions
from foreglass.sources import io

#: Called with (system, user), returns the answer's text or a JSON object.
Client = Callable[[str, str], "str | dict"]

RETRIED = ("timeout", "rate_limit", "api_error")


def classify_error(error: BaseException) -> str:
    """The kind of a failed call, by words in its message; the first that fits."""
    text = f"{type(error).__name__} {error}".lower() if isinstance(error, (TimeoutError, futures.TimeoutError)) else str(error).lower()
    if "timeout" in text or "timed out" in text:
        return "timeout"
    if "rate" in text and "limit" in text:
        return "rate_limit"
    if "parse" in text or "validation" in text or "json" in text:
        return "parse_error"
    if "api" in text or "request" in text:
        return "api_error"
    return "unknown"


def call(client: Client, system: str, user: str, retries: int = 3, initial: float = 1.0, factor: float = 2.0, sleep: Callable[[float], None] = time.sleep) -> tuple[str | None, str | None, str | None]:
    """``(answer, error type, error)``; timeouts, rate limits and API errors are tried again after growing waits."""
    for attempt in range(retries + 1):
        try:
            answer = client(system, user)
            return (answer if isinstance(answer, str) else json.dumps(answer, ensure_ascii=False)), None, None
        except Exception as error:  # noqa: BLE001 - any failure of the client becomes a row
            kind = classify_error(error)
            if kind not in RETRIED or attempt == retries:
                return None, kind, str(error)
            sleep(initial * factor**attempt)
    return None, "unknown", ""


def ask(df: DataFrame, client: Client, system: str, user: str = "prompt", workers: int = 16, timeout: float | None = None, retries: int = 3, initial: float = 1.0, factor: float = 2.0) -> DataFrame:
    """Adds ``answer``, ``error_type`` and ``error`` to each row, asking with the column ``user``.

    Each task keeps at most ``workers`` calls under way. A call that exceeds
    ``timeout`` seconds fails as a timeout; a null prompt is not asked and has
    three nulls. A lost task repeats its calls.
    """
    names = df.columns

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pool = futures.ThreadPoolExecutor(workers)
        try:
            for pdf in batches:
                waiting = [pool.submit(call, client, system, p, retries, initial, factor) if isinstance(p, str) else None for p in pdf[user]]
                results = []
                for w in waiting:
                    try:
                        results.append((None, None, None) if w is None else w.result(timeout))
                    except futures.TimeoutError:
                        w.cancel()
                        results.append((None, "timeout", f"no answer within {timeout} s"))
                out = pdf[names].copy()
                out["answer"], out["error_type"], out["error"] = ([r[k] for r in results] for k in range(3))
                yield out
        finally:
            pool.shutdown(wait=False, cancel_futures=True)

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema) + ", answer string, error_type string, error string"
    return df.mapInPandas(run, schema)


def batched(df: DataFrame, order: list[str], size: int, start: int = 0) -> DataFrame:
    """Adds ``batch_id`` by position in the given order and drops the batches before ``start``."""
    keyed = df.withColumn("__all", F.lit(0))
    placed = group_positions(keyed.select("__all", *order), "__all", order).select(*order, F.floor((F.col("position") - 1) / size).cast("int").alias("batch_id"))
    return df.join(placed.filter(F.col("batch_id") >= start), order)


def in_batches(df: DataFrame, answer: Callable[[DataFrame], DataFrame], folder: str, batches: int) -> DataFrame:
    """``answer(df)``, saved below ``folder`` for every so many batches of ``batch_id`` as soon as they are done.

    What was saved by an earlier run stays as it is, so a run that failed goes
    on where it ended and no call is repeated.
    """
    spark = df.sparkSession
    edges = df.agg(F.min("batch_id").alias("first"), F.max("batch_id").alias("last")).first()
    if edges.first is None:
        return answer(df)
    for begin in range(edges.first // batches * batches, edges.last + 1, batches):
        if not io.exists(spark, f"{folder}/batch_id={begin}/_SUCCESS"):
            part = df.filter(F.col("batch_id").between(begin, begin + batches - 1)).withColumnRenamed("batch_id", "batch")
            io.append_batch(answer(part), folder, begin)
    return spark.read.parquet(folder).drop("batch_id").withColumnRenamed("batch", "batch_id")


def evaluate(df: DataFrame, client: Callable[[list[dict]], "str | dict"], keep: tuple[str, ...] = ("event_ticker", "submission_id", "market_outcome"), workers: int = 16, timeout: float | None = None, retries: int = 3) -> DataFrame:
    """``(*keep, content, reasoning, error_type)``: a model's answer to the chat in ``messages`` of each row, one request a row.

    A chat of three messages loses its last, the expected answer; other lengths
    and orders than system, user[, assistant] are not asked and have a null
    answer. The client takes the messages and returns the answer's text or
    ``{"content": ..., "reasoning": ...}``. A failed request leaves a row with
    its kind of error.
    """
    asked = df.select(*keep, F.to_json(without_assistant(F.col("messages"))).alias("prompt"))
    answered = ask(asked, lambda _, user: client(json.loads(user)), "", workers=workers, timeout=timeout, retries=retries)
    whole = F.from_json("answer", "struct<content: string, reasoning: string>")
    return answered.select(*keep, F.coalesce(whole["content"], "answer").alias("content"), whole["reasoning"].alias("reasoning"), "error_type")


def evaluate_models(df: DataFrame, models: dict[str, Callable[[], Callable[[list[dict]], "str | dict"]]], folder: str, **options) -> tuple[DataFrame | None, dict[str, str]]:
    """``(rows with model, errors by model)``: each model's answers, saved as soon as it is done.

    ``models`` maps names to functions that start a model and return its
    client. A model that does not start or fails as a whole is reported and the
    next one goes on; one whose answers are saved already is not asked again.
    The model's name is a column, never part of a file name to be read back.
    """
    spark, errors, done = df.sparkSession, {}, []
    for number, (name, start) in enumerate(models.items()):
        place = f"{folder}/model={number}"
        try:
            if not io.exists(spark, f"{place}/_SUCCESS"):
                io.write_frame(evaluate(df, start(), **options).withColumn("name", F.lit(name)), place)
            done.append(spark.read.parquet(place))
        except Exception as error:  # noqa: BLE001 - the next model goes on
            errors[name] = f"{type(error).__name__}: {error}"
    rows = None
    for part in done:
        rows = part if rows is None else rows.unionByName(part)
    return None if rows is None else rows.withColumnRenamed("name", "model"), errors
