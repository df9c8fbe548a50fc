"""Batched user code (UD-01, UD-02): the slow path, Arrow-batched, never per row.

``batched_map`` runs a pandas function over Arrow batches (``mapInPandas``). ``batch_classify``
scores a table with a user-supplied model: the factory is called once per Python worker task
(model load), then rows are scored batch by batch; the responses go through the same typed
parse and checks as any other model output.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame

from labelgraph import constants as K


def batched_map(df: DataFrame, fn: Callable[[pd.DataFrame], pd.DataFrame], schema: str) -> DataFrame:
    """Apply ``fn`` to every Arrow batch of ``df``; ``schema`` declares the output."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield fn(pdf)

    return df.mapInPandas(run, schema)


def python_token_counts(pdf: pd.DataFrame) -> pd.DataFrame:
    """Example user function: Python ``str.split()`` token counts; the words of one text at a time are held."""
    return pd.DataFrame({"doc_id": pdf["doc_id"], "n_tokens": pdf["text"].fillna("").map(lambda t: len(t.split())).astype("int64")})


def batch_classify(
    df: DataFrame,
    scorer_factory: Callable[[], Callable[[pd.Series], pd.Series]],
    text: str = "text",
    key: str = "sample_id",
) -> DataFrame:
    """``(key, response)``: raw model text per row from ``scorer_factory()`` (built once per task)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        score = scorer_factory()
        for pdf in batches:
            yield pd.DataFrame({key: pdf[key], "response": score(pdf[text].fillna(""))})

    kind = df.schema[key].dataType.simpleString()
    return df.select(key, text).mapInPandas(run, f"`{key}` {kind}, response string")


def keyword_scorer(keywords: dict[str, tuple[str, str]]) -> Callable[[], Callable[[pd.Series], pd.Series]]:
    """Deterministic stand-in model: a keyword present in the text adds its (dim, term) label.

    The response imitates decoded chat output (prompt, then ``assistant\\n`` and the JSON), so
    extraction and parsing are exercised exactly as for a real model.
    """
    import json

    def factory():
        items = sorted(keywords.items())

        def score(texts: pd.Series) -> pd.Series:
            out = []
            for t in texts:
                words = set(t.lower().split())
                labels = {k: [] for k in K.LABEL_KEYS}
                for kw, (dim, term) in items:
                    if kw in words:
                        labels[K.LABEL_KEYS[K.DIM_NAMES.index(dim)]].append(term)
                body = json.dumps(labels) if any(labels.values()) else json.dumps({"Error": "NotMathMaterial"})
                out.append(f"system\nYou are a helpful assistant.\nuser\n<image>\n{K.ASSISTANT_MARKER}{body}")
            return pd.Series(out)

        return score

    return factory
