"""Batched model calls: trait scores and inline embeddings with a pluggable function.

The function takes a list of texts and returns one list of numbers per text. It runs inside
the tasks, on slices of a partition; nothing is numbered or gathered across partitions.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playledger.functions.vectors import fixed_width
from playledger.schemas import EMBEDDING_DIM, TRAITS

REQUEST_ROWS = 8

Scorer = Callable[[list[str]], Sequence[Sequence[float]]]


def slices(batches: Iterator[pd.DataFrame], rows: int) -> Iterator[pd.DataFrame]:
    """Slices of exactly `rows` rows across Arrow batches; only the last may be shorter."""
    rest = None
    for batch in batches:
        if rest is not None and len(rest):
            batch = pd.concat([rest, batch], ignore_index=True)
        full = len(batch) - len(batch) % rows
        for start in range(0, full, rows):
            yield batch.iloc[start : start + rows]
        rest = batch.iloc[full:]
    if rest is not None and len(rest):
        yield rest


def _called(texts: DataFrame, scorer: Scorer, request_rows: int) -> DataFrame:
    """(id, scores) of (id, content); a null content fails the job before it is sent."""
    inputs = texts.select("id", "content")
    id_type = inputs.schema["id"].dataType.simpleString()

    def call(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in slices(batches, request_rows):
            if part["content"].isna().any():
                raise ValueError("Null batch inputs detected")
            scores = scorer(part["content"].tolist())
            if len(scores) != len(part):
                raise ValueError(f"{len(part)} texts sent, {len(scores)} answers received")
            values = [[float(value) for value in row] for row in scores]
            yield pd.DataFrame({"id": part["id"].to_numpy(), "scores": values})

    return inputs.mapInPandas(call, f"id {id_type}, scores array<double>")


def score_traits(
    texts: DataFrame, scorer: Scorer, request_rows: int = REQUEST_ROWS
) -> DataFrame:
    """(id, OPN, CON, EXT, AGR, NEU) of (id, content)."""
    scored = _called(texts, scorer, request_rows)
    five = fixed_width(F.col("scores"), len(TRAITS))
    return scored.select("id", five.alias("scores")).select(
        "id", *(F.col("scores")[i].alias(trait) for i, trait in enumerate(TRAITS))
    )


def embed_inline(
    texts: DataFrame, embedder: Scorer, dim: int = EMBEDDING_DIM, request_rows: int = REQUEST_ROWS
) -> DataFrame:
    """(id, embedding) of (id, content); every vector must be `dim` wide."""
    embedded = _called(texts, embedder, request_rows)
    return embedded.select("id", fixed_width(F.col("scores"), dim).alias("embedding"))
