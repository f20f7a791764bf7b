"""Frame classifiers: multinomial logistic regression and histogram gradient boosting.

Fitting sees a sample of bounded size (a parameter), chosen by hash; prediction covers all rows.
"""

from __future__ import annotations

import hashlib
import io
import json
import pickle
from collections.abc import Collection, Iterator, Sequence
from dataclasses import dataclass, field
from pathlib import Path

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from phasemill.schemas import LABELS

SAMPLE_ROWS, FOLDS = 30_000, 5


def bounded_sample(df: DataFrame, keys: Sequence[str], rows: int = SAMPLE_ROWS, seed: int = 0) -> DataFrame:
    """The ``rows`` rows of least hash of their keys: the same ones in every run and partitioning."""
    return df.withColumn("__h", F.xxhash64(F.lit(seed), *keys)).orderBy("__h", *keys).limit(rows).drop("__h")


def balanced_weights(y: np.ndarray) -> np.ndarray:
    classes, inverse, counts = np.unique(y, return_inverse=True, return_counts=True)
    return (len(y) / (len(classes) * counts))[inverse]


@dataclass
class Logistic:
    """Standardised multinomial logistic regression, fitted by damped Newton steps on the penalised likelihood."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray  # features + 1 x classes

    @classmethod
    def fit(cls, x: np.ndarray, y: np.ndarray, c: float = 0.3, steps: int = 300) -> Logistic:
        k = len(LABELS)
        mean, scale = x.mean(0), x.std(0)
        scale[scale == 0] = 1.0
        z = np.hstack([(x - mean) / scale, np.ones((len(x), 1))])
        w, target = balanced_weights(y), np.eye(k)[y]
        ridge = np.full((z.shape[1], 1), 1.0 / c)
        ridge[-1] = 0
        b = np.zeros((z.shape[1], k))
        # Boehning's bound: one factorisation serves every step, and each step lowers the loss
        bound = np.linalg.inv(0.5 * (z * w[:, None]).T @ z + np.diag(ridge[:, 0]) + 1e-9 * np.eye(z.shape[1]))
        momentum = b.copy()
        for i in range(steps):
            p = _softmax(z @ momentum)
            new = momentum - bound @ (z.T @ ((p - target) * w[:, None]) + ridge * momentum)
            momentum = new + i / (i + 3.0) * (new - b)
            if np.abs(new - b).max() < 1e-7:
                b = new
                break
            b = new
        return cls(mean, scale, b)

    def predict(self, x: np.ndarray) -> np.ndarray:
        return _softmax(np.hstack([(x - self.mean) / self.scale, np.ones((len(x), 1))]) @ self.weights)


def _softmax(s: np.ndarray) -> np.ndarray:
    e = np.exp(s - s.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


@dataclass
class Boosting:
    """Gradient boosting of shallow trees on binned features, one tree per class and round, softmax loss."""

    cuts: list[np.ndarray]
    base: np.ndarray
    trees: list[list[tuple[np.ndarray, np.ndarray, np.ndarray]]] = field(default_factory=list)
    rate: float = 0.08
    depth: int = 3

    @classmethod
    def fit(cls, x: np.ndarray, y: np.ndarray, rounds: int = 150, rate: float = 0.08, depth: int = 3, l2: float = 1.0, bins: int = 64, least: float = 20) -> Boosting:
        k = len(LABELS)
        w, target = balanced_weights(y), np.eye(k)[y]
        cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) for j in range(x.shape[1])]
        prior = np.log(np.maximum((target * w[:, None]).sum(0) / w.sum(), 1e-9))
        model = cls(cuts, prior, [], rate, depth)
        binned = model._bins(x)
        offset = np.arange(x.shape[1]) * bins
        score = np.tile(prior, (len(x), 1))
        for _ in range(rounds):
            p = _softmax(score)
            trees = []
            for c in range(k):
                grad, hess = (p[:, c] - target[:, c]) * w, np.maximum(p[:, c] * (1 - p[:, c]), 1e-9) * w
                tree, leaf = _grow(binned + offset, grad, hess, depth, bins, x.shape[1], l2, least)
                trees.append(tree)
                score[:, c] += rate * tree[2][leaf]
            model.trees.append(trees)
        return model

    def _bins(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(c, x[:, j], side="right") for j, c in enumerate(self.cuts)], 1)

    def predict(self, x: np.ndarray) -> np.ndarray:
        binned, score = self._bins(x), np.tile(self.base, (len(x), 1))
        for trees in self.trees:
            for c, (feature, cut, value) in enumerate(trees):
                node = np.zeros(len(x), int)
                for _ in range(self.depth):
                    node = 2 * node + 1 + (binned[np.arange(len(x)), feature[node]] > cut[node])
                score[:, c] += self.rate * value[node - (2**self.depth - 1)]
        return _softmax(score)


def _grow(flat: np.ndarray, grad: np.ndarray, hess: np.ndarray, depth: int, bins: int, features: int, l2: float, least: float) -> tuple[tuple[np.ndarray, np.ndarray, np.ndarray], np.ndarray]:
    """A complete tree: split feature and bin of each inner node, values of the leaves, and the leaf of each row."""
    inner = 2**depth - 1
    feature, cut = np.zeros(inner, int), np.full(inner, bins)
    node = np.zeros(len(grad), int)
    for n in range(inner):
        rows = np.flatnonzero(node == n)
        if len(rows) >= 2 * least:
            f = flat[rows].ravel()
            per = [np.bincount(f, np.repeat(v[rows], features), minlength=features * bins).reshape(features, bins).cumsum(1) for v in (grad, hess)]
            count = np.bincount(f, minlength=features * bins).reshape(features, bins).cumsum(1)
            g, h = grad[rows].sum(), hess[rows].sum()
            gain = per[0] ** 2 / (per[1] + l2) + (g - per[0]) ** 2 / (h - per[1] + l2) - g * g / (h + l2)
            gain[(count < least) | (len(rows) - count < least)] = -np.inf
            best = np.unravel_index(int(np.argmax(gain)), gain.shape)
            if gain[best] > 1e-12:
                feature[n], cut[n] = best
        right = flat[rows, feature[n]] - feature[n] * bins > cut[n]
        node[rows] = 2 * n + 1 + right
    leaf = node - inner
    leaves = 2**depth
    value = -np.bincount(leaf, grad, leaves) / (np.bincount(leaf, hess, leaves) + l2)
    return (feature, cut, value), leaf


def fit(sample: pd.DataFrame, features: Sequence[str], kind: str = "logreg", label: str = "label") -> Logistic | Boosting:
    x = sample[list(features)].to_numpy(float)
    y = np.array([LABELS.index(v) for v in sample[label]])
    return {"logreg": Logistic, "hgb": Boosting}[kind].fit(x, y)


def fold_of(take: Column, folds: int = FOLDS) -> Column:
    """The fold of a take, by hash: all its samples and copies are in one."""
    return F.pmod(F.xxhash64(F.lit("fold"), take), F.lit(folds)).cast("int")


def fold_models(sample: DataFrame, features: Sequence[str], kind: str, folds: int = FOLDS) -> dict[int | None, Logistic | Boosting]:
    """A model per ``fold`` of the ``sample`` fitted without that fold, or under None one fitted on all if ``folds`` is 0.

    The sample has ``take, sample_idx, label, fold`` and the features. Each model is fitted in a task
    of its own, on at most the sample's rows; the driver gets the models only.
    """
    each = sample.withColumn("model", F.explode(F.sequence(F.lit(0), F.lit(folds - 1)))).filter("model != fold") if folds else sample.withColumn("model", F.lit(-1))

    def run(key: tuple, g: pd.DataFrame) -> pd.DataFrame:
        if folds and g["label"].nunique() < 2:
            return pd.DataFrame({"model": [], "fitted": []})
        return pd.DataFrame({"model": [key[0]], "fitted": [pickle.dumps(fit(g.sort_values(["take", "sample_idx"]), features, kind))]})

    rows = each.groupBy("model").applyInPandas(run, "model int, fitted binary").collect()
    models: dict[int | None, Logistic | Boosting] = {r["model"] if folds else None: pickle.loads(r["fitted"]) for r in rows}
    if len(models) < max(folds, 1):
        raise ValueError("no labelled samples to fit on" if not folds else f"takes too few to fit without each of {folds} folds")
    return models


def rows_by_model(keys: pd.Series, models: Collection) -> dict[str | int | None, np.ndarray]:
    """Positions of the rows each model predicts; keys without a model are None's, all at once."""
    own = np.array([k if k in models else None for k in keys], dtype=object)
    return {k: np.flatnonzero(own == k) for k in set(own)}


def with_posteriors(df: DataFrame, features: Sequence[str], models: dict[str | int | None, Logistic | Boosting], keep: Sequence[str], by: str = "take") -> DataFrame:
    """``(*keep, p_<LABEL>...)`` of every row; a take (or other value of ``by``) listed in ``models`` has its own model, others that under None.

    Models go to the workers once, as a broadcast variable (a few hundred kilobytes each).
    """
    held = df.sparkSession.sparkContext.broadcast(models)
    schema = df.select(*keep).schema
    for x in LABELS:
        schema = schema.add(f"p_{x}", "double")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = b[list(keep)].copy()
            p = np.zeros((len(b), len(LABELS)))
            x = b[list(features)].to_numpy(float)
            for k, rows in rows_by_model(b[by], held.value).items():
                p[rows] = held.value[k].predict(x[rows])
            for i, x in enumerate(LABELS):
                out[f"p_{x}"] = p[:, i]
            yield out

    return df.select(*dict.fromkeys([*keep, *features, by])).mapInPandas(run, schema)


def save(model: Logistic | Boosting, path: str | Path, **meta: object) -> str:
    """Arrays as ``.npz`` with JSON metadata beside it, which holds the file's SHA-256."""
    if isinstance(model, Logistic):
        arrays = {"mean": model.mean, "scale": model.scale, "weights": model.weights}
    else:
        flat = [t for trees in model.trees for t in trees]
        arrays = {"base": model.base, "feature": np.array([t[0] for t in flat]), "cut": np.array([t[1] for t in flat]), "value": np.array([t[2] for t in flat]), "cuts": np.concatenate(model.cuts), "sizes": np.array([len(c) for c in model.cuts]), "rate": model.rate, "depth": model.depth}
    buffer = io.BytesIO()
    np.savez(buffer, **arrays)
    Path(path).write_bytes(buffer.getvalue())
    digest = hashlib.sha256(buffer.getvalue()).hexdigest()
    Path(f"{path}.json").write_text(json.dumps({"kind": type(model).__name__, "sha256": digest, **meta}, indent=1))
    return digest


def load(path: str | Path) -> tuple[Logistic | Boosting, dict]:
    """The model and its metadata; refuses a file whose hash isn't the recorded one."""
    meta, data = json.loads(Path(f"{path}.json").read_text()), Path(path).read_bytes()
    if hashlib.sha256(data).hexdigest() != meta["sha256"]:
        raise ValueError(f"{path}: the file isn't the one its metadata describes")
    a = np.load(io.BytesIO(data))
    if meta["kind"] == "Logistic":
        return Logistic(a["mean"], a["scale"], a["weights"]), meta
    k = len(LABELS)
    flat = list(zip(a["feature"], a["cut"], a["value"], strict=True))
    cuts = np.split(a["cuts"], np.cumsum(a["sizes"])[:-1])
    return Boosting(cuts, a["base"], [flat[i : i + k] for i in range(0, len(flat), k)], float(a["rate"]), int(a["depth"])), meta


def leave_one_out(sample: pd.DataFrame, features: Sequence[str], kind: str, takes: Sequence[str] | None = None) -> dict[str | None, Logistic | Boosting]:
    """A model per take fitted without it, and under None one fitted on all; for honest labels of the takes trained on."""
    takes = sorted(set(sample["take"])) if takes is None else list(takes)
    models: dict[str | None, Logistic | Boosting] = {None: fit(sample, features, kind)}
    for t in takes:
        rest = sample[sample["take"] != t]
        if rest["label"].nunique() > 1:
            models[t] = fit(rest, features, kind)
    return models


def best_setting(grid: DataFrame, value: str = "objective", tie: str = "penalty", digits: int = 6) -> DataFrame:
    """The row of the greatest value; of equal ones (to ``digits``) that of the greatest ``tie``."""
    return grid.orderBy(F.round(value, digits).desc(), F.col(tie).desc()).limit(1)
