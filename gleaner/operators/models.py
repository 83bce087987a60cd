"""A place for models: any callable over batches, run in tasks, for the rows that need it alone."""

from __future__ import annotations

import logging
from collections.abc import Callable, Iterator
from typing import Any, Tuple  # noqa: UP035

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

Model = Callable[..., Any]


_log = logging.getLogger("gleaner")


def _answers(model: Model, inputs: list[pd.Series]) -> list[tuple[Any, str | None]]:
    """The model's answers, each with an error or none; where a batch fails its rows are tried apart, and those that fail are null."""
    try:
        return [(x, None) for x in model(*inputs)]
    except Exception:
        out: list[tuple[Any, str | None]] = []
        for i in range(len(inputs[0])):
            try:
                out += [(x, None) for x in model(*(x.iloc[i : i + 1] for x in inputs))]
            except Exception as e:
                _log.warning("a model failed for a row: %r", e)
                out.append((None, f"{type(e).__name__}: {e}"))
        return out


def batch_model(load: Callable[[], Model], returns: str, errors: bool = False) -> Callable[..., Column]:
    """``use(active, *columns)``: answers of the model where ``active`` holds, null elsewhere.

    A row that the model fails for is null and logged by its task; with ``errors`` the column is a struct (answer, error), so that failures
    can be counted and told from answers that are null.

    ``load`` is called once a task that has active rows and gives a callable from Series to as many answers. The
    column is marked as not deterministic, so that no plan evaluates it twice or moves a filter below it.
    """

    def run(batches: Iterator[Tuple[pd.Series, ...]]) -> Iterator[pd.DataFrame]:  # noqa: UP006
        model = None
        for active, *inputs in batches:
            wanted = active.fillna(False).astype(bool).to_numpy()
            out = pd.Series([(None, None)] * len(active), dtype=object)
            if wanted.any():
                model = model or load()
                picked = [x[wanted].reset_index(drop=True) for x in inputs]
                for place, answer in zip(wanted.nonzero()[0], _answers(model, picked), strict=True):
                    out.iat[place] = answer
            yield pd.DataFrame(out.tolist(), columns=["answer", "error"], dtype=object)

    def use(active: Column, *columns: Column) -> Column:
        made = F.pandas_udf(run, f"answer {returns}, error string").asNondeterministic()(active, *columns)  # made once a session stands
        return made if errors else made["answer"]

    return use
