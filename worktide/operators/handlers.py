"""Handlers by job type: what "executing" a job computes, as columns or as Arrow batches."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from worktide.functions import rules as R

ColumnHandler = Callable[[DataFrame], Column]
RowHandler = Callable[[dict], str]


class HandlerError(Exception):
    """A failure with its own code, and whether trying again may help."""

    def __init__(self, code: str, message: str, retryable: bool, retry_after_seconds: int = 0):
        super().__init__(message)
        self.code, self.retryable, self.retry_after_seconds = code, retryable, retry_after_seconds


_UNSUPPORTED = "UNSUPPORTED_JOB_TYPE"


def apply_handlers(jobs: DataFrame, handlers: Mapping[str, ColumnHandler]) -> DataFrame:
    """Add result, succeeded, error_code, retryable and message from column handlers.

    A job type without a handler is a permanent error.
    """
    known = F.coalesce(F.col("job_type").isin(*handlers), F.lit(False)) if handlers else F.lit(False)
    result = F.lit(None).cast("string")
    for job_type, handler in handlers.items():
        result = F.when(F.col("job_type") == job_type, handler(jobs)).otherwise(result)
    return jobs.withColumns({
        "result": result, "succeeded": known, "error_code": F.when(~known, _UNSUPPORTED),
        "retryable": F.when(~known, False),
        "message": F.when(~known, F.concat(F.lit("unsupported job type "), F.coalesce("job_type", F.lit("")))),
    })


def apply_row_handlers(jobs: DataFrame, handlers: Mapping[str, RowHandler]) -> DataFrame:
    """The same for Python handlers that take a row as a dict and return a JSON text.

    Errors are caught per row: a HandlerError keeps its code, a timeout is TIMEOUT, anything else is
    HANDLER_ERROR and may be retried.
    """
    schema = jobs.schema
    kinds = {"result": T.StringType(), "kind": T.StringType(), "code": T.StringType(),
             "typed_retryable": T.BooleanType(), "message": T.StringType(), "retry_after_seconds": T.IntegerType()}
    schema = T.StructType([*jobs.schema.fields, *[T.StructField(name, kind) for name, kind in kinds.items()]])
    table = dict(handlers)

    def run(row: dict) -> tuple:
        handler = table.get(row["job_type"])
        try:
            if handler is None:
                raise HandlerError(_UNSUPPORTED, f"unsupported job type {row['job_type']}", False)
            return handler(row), None, None, None, None, 0
        except HandlerError as error:
            return None, "typed", error.code, error.retryable, str(error), error.retry_after_seconds
        except TimeoutError as error:
            return None, "timeout", None, None, str(error), 0
        except Exception as error:  # noqa: BLE001 - any failure of a handler is an outcome, not a crash
            return None, "other", None, None, str(error), 0

    def task(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            outcomes = [run(row) for row in frame.to_dict("records")]
            yield frame.join(pd.DataFrame(outcomes, columns=list(kinds), index=frame.index, dtype=object))

    done = jobs.mapInPandas(task, schema)
    failed = F.col("kind").isNotNull()
    verdict = R.classify_error(F.col("kind"), F.col("code"), F.col("typed_retryable"), F.col("message"))
    return done.withColumn("__verdict", verdict).withColumns({
        "succeeded": ~failed, "error_code": F.when(failed, F.col("__verdict.error_code")),
        "retryable": F.when(failed, F.col("__verdict.retryable")),
    }).drop("__verdict", "kind", "code", "typed_retryable")
