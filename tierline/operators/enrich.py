"""Row enrichment by a model, on executors.

The scorer is injected: a picklable callable ``list[str] -> list[str]`` (one
answer per prompt, same order). It runs inside ``mapInPandas`` on Arrow
batches, so prompts never pass through the driver and the work spreads over
all partitions. A failure of the scorer on a batch is retried row by row; a row
that still fails gets ``error_prefix + message`` as its answer instead of
failing the job.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The batch function runs in Python workers, which need not have this library
# installed: ship this module's functions by value rather than by import path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

Scorer = Callable[[list[str]], list[str]]
#: Begins the answer of a call that failed.
ERROR_PREFIX = "AI call failed: "


def _answer_batch(prompts: list[str], scorer: Scorer, error_prefix: str) -> list[str]:
    try:
        answers = list(scorer(prompts))
        if len(answers) != len(prompts):
            raise ValueError(f"scorer returned {len(answers)} answers for {len(prompts)} prompts")
        return answers
    except Exception:
        out = []
        for p in prompts:
            try:
                out.append(list(scorer([p]))[0])
            except Exception as e:  # noqa: BLE001 - the message becomes data
                out.append(f"{error_prefix}{e}")
        return out


def enrich_with_model(
    df: DataFrame,
    prompt_col: str,
    scorer: Scorer,
    out_col: str = "ai_result",
    batch_size: int = 64,
    error_prefix: str = ERROR_PREFIX,
) -> DataFrame:
    """Append ``out_col`` = scorer(prompt) for every row (NULL prompt → NULL)."""
    schema = T.StructType([*df.schema.fields, T.StructField(out_col, T.StringType(), True)])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            prompts = pdf[prompt_col]
            answers: list[str | None] = [None] * len(pdf)
            idx = [i for i, p in enumerate(prompts) if p is not None]
            for lo in range(0, len(idx), batch_size):
                chunk = idx[lo : lo + batch_size]
                got = _answer_batch([prompts.iloc[i] for i in chunk], scorer, error_prefix)
                for i, a in zip(chunk, got):
                    answers[i] = a
            yield pdf.assign(**{out_col: answers})

    return df.mapInPandas(run, schema)


def digest_scorer(prompts: list[str]) -> list[str]:
    """Deterministic stand-in for a model: SHA-256 hex of each whole prompt."""
    import hashlib

    return [hashlib.sha256(p.encode("utf-8")).hexdigest() for p in prompts]
