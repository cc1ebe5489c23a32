"""Mixing sources to target weights by iterative proportional fitting (raking).

Documents are counted in tokens (words) by cell, a combination of source, language and
topic.  Raking scales the cells' weights in turn so that the weighted tokens meet the
target shares of each source, each language and each topic.  The fitted weights, scaled so
that the largest is ``max_weight``, are inclusion probabilities (1 or less) or expected
numbers of copies (over 1); each document is drawn by a hash of its id and text, so a
rerun draws the same ones and no row is moved for it.

Where that scale would keep less than ``keep`` of the tokens, as a rare source or language
needs more than it has, the weights are trimmed: values whose whole text falls short of
their target are kept whole (``max_weight``), the others share the rest of ``keep`` by their
targets, and raking goes on among the cells under ``max_weight``.

The table of cells is counted by a partial aggregate in Spark; as raking looks only at it,
it comes to the driver, and its size is checked against ``max_cells`` (the product of the
numbers of sources, languages and topics bounds it, not the documents).

Default targets: each share of tokens to the power ``flatten``, for topics unchanged.
Defined results: null source, language or topic are values of their own; null or empty
texts have no tokens, weigh as much as their cell's other documents and do not count in it;
targets that name values without tokens are spread over the others in proportion; values
without a target get none (weight 0); equal rows draw alike.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridsmith.llm.common import fresh

MARGINS = ("source", "lang", "topic")

#: Topics by the first of these that a text contains; all others are prose.
TOPIC_MARKS = (("legal", ("icensed under", "Copyright", "License")), ("code", ("api_key", "token =", "password", "{")),
               ("table", (" | ",)), ("contact", ("@",)))


@dataclass(frozen=True)
class Params:
    flatten: float = 0.7
    max_weight: float = 1.0
    #: Share of the tokens that is kept at least (expected), if those of values with a target suffice.
    keep: float = 0.65
    rounds: int = 200
    tolerance: float = 1e-9
    max_cells: int = 1_000_000
    seed: int = 7


def topic(text: Column) -> Column:
    out = F
    for name, marks in TOPIC_MARKS:
        has = F.lit(False)
        for m in marks:
            has = has | F.contains(text, F.lit(m))
        out = out.when(has, name)
    return out.otherwise("prose")


def n_tokens(text: Column) -> Column:
    """Words of a text: runs of anything but white space."""
    return F.coalesce(F.regexp_count(text, F.lit(r"\S+")), F.lit(0)).cast("long")


def described(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", "source", "lang", topic(F.col("text")).alias("topic"), n_tokens(F.col("text")).alias("n_tokens"))


def cells_of(rows: DataFrame, p: Params = Params()) -> pd.DataFrame:
    """Tokens by cell, for rows with MARGINS and n_tokens."""
    cells = rows.groupBy(*MARGINS).agg(F.sum("n_tokens").alias("tokens")).limit(p.max_cells + 1).toPandas()
    if len(cells) > p.max_cells:
        raise ValueError(f"more than {p.max_cells} cells; merge rare sources, or raise max_cells if the driver can hold them")
    for m in MARGINS:
        cells[m] = cells[m].astype(object).where(cells[m].notna(), None)
    return cells.sort_values(list(MARGINS), na_position="first", ignore_index=True)


def rake(cells: pd.DataFrame, targets: dict[str, dict], p: Params = Params()) -> np.ndarray:
    """Weights by cell with which the tokens meet the target shares of every margin."""
    tokens = cells["tokens"].to_numpy(dtype=float)
    w = np.ones(len(cells))
    if not tokens.sum():
        return w
    codes, goals = [], []
    for m in MARGINS:
        values = list(dict.fromkeys(cells[m]))
        code = cells[m].map({v: i for i, v in enumerate(values)}).to_numpy()
        share = np.array([float(targets[m].get(v, 0.0)) for v in values])
        share[np.bincount(code, tokens, len(values)) == 0] = 0
        if not share.sum():
            raise ValueError(f"no target of {m} has any tokens")
        codes.append(code)
        goals.append(share / share.sum() * tokens.sum())
    for _ in range(p.rounds):
        worst = 0.0
        for code, goal in zip(codes, goals):
            have = np.bincount(code, w * tokens, len(goal))
            f = np.divide(goal, have, out=np.zeros_like(goal), where=have > 0)
            worst = max(worst, np.abs(have - goal).max() / tokens.sum())
            w = w * f[code]
        if worst < p.tolerance:
            break
    return w


def flattened(cells: pd.DataFrame, p: Params = Params()) -> dict[str, dict]:
    """The default targets; see the module."""
    out = {}
    for m in MARGINS:
        have: dict = {}
        for v, n in zip(cells[m], cells["tokens"]):
            have[v] = have.get(v, 0) + float(n or 0)
        power = 1.0 if m == "topic" else p.flatten
        raised = {v: n ** power if n else 0.0 for v, n in have.items()}
        total = sum(raised.values()) or 1.0
        out[m] = {v: n / total for v, n in raised.items()}
    return out


def filled(v: np.ndarray, tokens: np.ndarray, goal: float, most: float) -> np.ndarray:
    """v times the factor with which the tokens, no weight over ``most``, add up to ``goal`` (or as near as they can)."""
    order = np.argsort(-v, kind="stable")
    x, t = v[order], tokens[order]
    full = np.cumsum(t) - t  # tokens of the cells before, all at most
    rest = np.cumsum((x * t)[::-1])[::-1]
    factor = np.divide(goal - most * full, rest, out=np.zeros(len(x)), where=rest > 0)
    fits = np.flatnonzero((rest > 0) & (factor * x <= most))
    return np.minimum(v * factor[fits[0]], most) if len(fits) else np.where(v > 0, most, 0.0)


def trimmed(cells: pd.DataFrame, w: np.ndarray, goal: float, p: Params) -> np.ndarray:
    """Weights up to max_weight with ``goal`` tokens that meet the shares of w in every margin, as far as its values last."""
    tokens, most = cells["tokens"].to_numpy(dtype=float), p.max_weight
    codes, goals = [], []
    for m in MARGINS:
        values = list(dict.fromkeys(cells[m]))
        code = cells[m].map({v: i for i, v in enumerate(values)}).to_numpy()
        usable, share = np.bincount(code, tokens * (w > 0), len(values)), np.bincount(code, tokens * w, len(values))
        codes.append(code)
        goals.append(usable * filled(np.divide(share, usable, out=np.zeros_like(share), where=usable > 0), usable, goal, most))
    v = filled(w, tokens, goal, most)
    for _ in range(p.rounds):
        worst = 0.0
        for code, want in zip(codes, goals):
            have, at_most = np.bincount(code, v * tokens, len(want)), v >= most
            free = np.bincount(code, v * tokens * ~at_most, len(want))
            worst = max(worst, np.abs(have - want).max() / tokens.sum())
            down = np.divide(want, have, out=np.ones_like(want), where=have > want)
            up = np.divide(want - have + free, free, out=np.ones_like(want), where=(free > 0) & (have < want))
            v = np.minimum(v * np.where(at_most, down[code], (down * up)[code]), most)
        if worst < p.tolerance:
            break
    return filled(v, tokens, goal, most)


def calibrated(cells: pd.DataFrame, w: np.ndarray, p: Params = Params()) -> np.ndarray:
    """Weights scaled so that the largest of a cell with tokens is max_weight, or trimmed there to keep enough tokens."""
    tokens = cells["tokens"].to_numpy(dtype=float)
    most = w[tokens > 0].max(initial=0.0)
    if not most:
        return np.ones(len(w))
    v = w * (p.max_weight / most)
    goal = min(p.keep * tokens.sum(), p.max_weight * tokens[w > 0].sum())
    return v if (v * tokens).sum() >= goal else trimmed(cells, w, goal, p)


def uniform(p: Params) -> Column:
    """A number in [0, 1) from a document's id and text."""
    return F.shiftrightunsigned(F.xxhash64(F.lit(p.seed), "doc_id", "text"), 11) / F.lit(float(1 << 53))


def drawn(docs: DataFrame, targets: dict[str, dict] | None = None, p: Params = Params()) -> DataFrame:
    """docs with (struct) column ``mix``: topic, n_tokens, raked (the raking weight), weight (calibrated) and copies
    (0, 1 or, for weights over 1, more)."""
    base = described(docs)
    cells = cells_of(base, p)
    raked = rake(cells, targets or flattened(cells, p), p)
    weights = cells[list(MARGINS)].assign(raked=raked, weight=calibrated(cells, raked, p))
    spark = docs.sparkSession
    mix, cell = fresh(docs, "mix"), fresh(docs, "cell")
    table = spark.createDataFrame([(tuple(r),) for r in weights.itertuples(index=False)],
                                  f"{cell} struct<source:string,lang:string,topic:string,raked:double,weight:double>")
    rows = docs.withColumn(mix, F.struct(topic(F.col("text")).alias("topic"), n_tokens(F.col("text")).alias("n_tokens"),
                                         uniform(p).alias("u")))
    on = F.col("source").eqNullSafe(F.col(f"{cell}.source")) & F.col("lang").eqNullSafe(F.col(f"{cell}.lang")) & (
        F.col(f"{mix}.topic") == F.col(f"{cell}.topic"))
    # The cells number max_cells at most: broadcast.
    rows = rows.join(F.broadcast(table), on, "left")
    weight = F.col(f"{cell}.weight")
    copies = (F.floor(weight) + (F.col(f"{mix}.u") < weight - F.floor(weight)).cast("int")).cast("int")
    return rows.withColumn(mix, F.struct(f"{mix}.topic", f"{mix}.n_tokens", F.col(f"{cell}.raked").alias("raked"),
                                         weight.alias("weight"), copies.alias("copies"))).drop(cell)


def sample(docs: DataFrame, targets: dict[str, dict] | None = None, p: Params = Params()) -> DataFrame:
    """The drawn rows of docs, all columns; a row with several copies is repeated."""
    rows = drawn(docs, targets, p)
    mix = rows.columns[-1]
    copies = F.col(f"{mix}.copies")
    kept = rows.where(copies >= 1)
    if p.max_weight > 1:
        kept = kept.withColumn(mix, F.explode(F.array_repeat(F.lit(0), copies)))
    return kept.drop(mix)
