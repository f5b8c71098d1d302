"""Incremental top-two and winners of candidates. Both folds are commutative and associative, so late or reordered rows
change nothing; state is a few values for each candidate."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

TOP_TWO = "cand_id string, t1 double, t2 double"
WINNER = "cand_id string, prob double, s1_id string"


def fold_top_two(held: tuple[float | None, float | None], scores: list[float]) -> tuple[float | None, float | None]:
    best = sorted([x for x in (*held, *scores) if x is not None], reverse=True)[:2]
    return (best[0] if best else None, best[1] if len(best) > 1 else None)


def fold_winner(held: tuple[float, str] | None, claims: list[tuple[float, str]]) -> tuple[float, str] | None:
    """The most probable claim, ties to the smallest s1_id."""
    return min([*([held] if held else []), *claims], key=lambda c: (-c[0], c[1]), default=None)


def top_two_stream(pairs: DataFrame, score: str = "score") -> DataFrame:
    """Updates of (cand_id, t1, t2) from a stream of (cand_id, score)."""

    def step(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        held = state.get if state.exists else (None, None)
        for frame in frames:
            held = fold_top_two(held, frame[score].tolist())
        state.update(held)
        yield pd.DataFrame({"cand_id": [key[0]], "t1": [held[0]], "t2": pd.Series([held[1]], dtype="float64")})

    return pairs.groupBy("cand_id").applyInPandasWithState(step, TOP_TWO, "t1 double, t2 double", "update", GroupStateTimeout.NoTimeout)


def winner_stream(pairs: DataFrame, score: str = "prob") -> DataFrame:
    """Updates of (cand_id, prob, s1_id) from a stream of (cand_id, s1_id, prob)."""

    def step(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        held = state.get if state.exists else None
        for frame in frames:
            held = fold_winner(held, list(zip(frame[score].tolist(), frame["s1_id"].tolist(), strict=True)))
        state.update(held)
        yield pd.DataFrame({"cand_id": [key[0]], "prob": [held[0]], "s1_id": [held[1]]})

    return pairs.groupBy("cand_id").applyInPandasWithState(step, WINNER, "prob double, s1_id string", "update", GroupStateTimeout.NoTimeout)
