"""Toxicity classifier that is held to the same score when identity terms are swapped.

A logistic regression over the words that a text holds and their beginnings. Besides the usual loss, training swaps identity terms
of a group inside the labelled texts and penalises the square of the change in score, so that naming a group says little by itself.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import checkpointed, pieces, text_bytes
from .labelled import labelled_sample
from .words import BYTE_VALUE, inverse_powers, mix, running_hash, words

#: Labelled rows that a model is fitted on, at most.
TRAIN_ROWS = 20_000
#: Features are hashed into 2 ** BITS places; CHOSEN of them at most, each in LEAST_TEXTS texts of the sample or more, are fitted.
BITS, LEAST_TEXTS, CHOSEN = 22, 5, 4096
#: Bytes of a word's beginning that are features besides the word.
BEGINNINGS = (4, 5, 6, 7, 8)
#: Penalties that training tries, from strong to weak: lasso, which chooses features, and ridge for those. FOLDS parts of the permitted
#: rows, told apart by a hash of the text, are held out in turn to choose among them.
PENALTIES, FOLDS, SWAP = ((3e-3, 1e-4), (1e-3, 3e-5), (3e-4, 1e-5)), 3, 1.0
#: Groups of terms that may stand for each other (fixed values).
IDENTITY_TERMS = (
    ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "atheists"),
    ("black", "white", "asian", "latino", "arab", "indian"),
    ("gay", "straight", "lesbian", "bisexual", "heterosexual", "transgender"),
    ("women", "men"), ("woman", "man"), ("female", "male"), ("girls", "boys"), ("girl", "boy"),
    ("old", "young"), ("immigrant", "native"), ("immigrants", "natives"), ("deaf", "blind", "disabled"),
)
#: Bytes that end a word here: all of ASCII but letters, digits, apostrophe and hyphen. They read as blanks.
PUNCTUATION = np.arange(256, dtype=np.uint8)
PUNCTUATION[[b for b in range(128) if not (chr(b).isalnum() or chr(b) in "'-")]] = 32


@dataclass(frozen=True)
class ToxicityModel:
    bias: float
    weights: np.ndarray  # one for each place, nearly all 0


def swapped_text(text: str, groups=IDENTITY_TERMS) -> str:
    """``text`` with each identity term, whatever its case, replaced by the next of its group."""
    others = {a: b for g in groups for a, b in zip(g, g[1:] + g[:1])}
    if not others:
        return text
    return re.sub(r"(?i)\b(?:" + "|".join(sorted(others, key=len, reverse=True)) + r")\b", lambda m: others[m[0].lower()], text)


def features(data: np.ndarray, offsets: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """The words with the first byte of each: their places, then those of their beginnings, for words that are longer."""
    data = PUNCTUATION[data]
    shift = np.uint64(64 - BITS)
    hashes, first, last, _ = words(data, offsets, rolling=True)
    out = [((hashes >> shift).astype(np.int32), first)]
    sums, back = running_hash(data, BYTE_VALUE), inverse_powers(len(data) + 1)
    for n in BEGINNINGS:
        at = first[last - first > n]
        out.append(((mix((sums[at + n] - sums[at]) * back[at] + np.uint64(n)) >> shift).astype(np.int32), at))
    return out


def places_held(data: np.ndarray, offsets: np.ndarray, wanted: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Text and place of each feature, each place once a text; with ``wanted``, only places where it is true."""
    held = []
    for place, at in features(data, offsets):
        if wanted is not None:
            keep = np.flatnonzero(wanted[place])
            place, at = place[keep], at[keep]
        held.append((np.searchsorted(offsets, at, "right") - 1 << BITS) + place)
    held = np.unique(np.concatenate(held))
    return held >> BITS, held & ((1 << BITS) - 1)


def place_counts(sample: DataFrame, text_col: str) -> DataFrame:
    """For each place held by LEAST_TEXTS texts or more, in how many of either label and of each fold: ``clean0`` .. ``toxic0`` ..;
    the sample bounds the number of rows."""
    kinds = 2 * FOLDS

    def run(batches):
        waiting, size = [], 0

        def counted():
            keys, counts = np.unique(np.concatenate(waiting), return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(keys // kinds), pa.array(keys % kinds), pa.array(counts)], names=["place", "kind", "n"])

        for batch in batches:
            kind = batch.column("__fold").to_numpy() * 2 + (batch.column("__label").to_numpy() > 0)
            done = 0
            for rows, data, offsets in pieces(batch, text_col):
                text, place = places_held(data, offsets)
                waiting.append(place * kinds + kind[done + text])
                size += len(place)
                done += len(rows)
                if size > 2_000_000:
                    yield counted()
                    waiting, size = [], 0
        if size:
            yield counted()

    counts = sample.mapInArrow(run, "place long, kind long, n long")
    own = [F.sum(F.when(F.col("kind") == k, F.col("n")).otherwise(0)).alias(f"{('clean', 'toxic')[k % 2]}{k // 2}") for k in range(kinds)]
    return counts.groupBy("place").agg(F.sum("n").alias("n"), *own).where(F.col("n") >= LEAST_TEXTS).drop("n")


def place_sets(sample: DataFrame, text_col: str, chosen: np.ndarray, groups=IDENTITY_TERMS) -> DataFrame:
    """For each labelled text the chosen places that it holds, and those it holds after the swap (null if it names no group)."""

    def run(batches):
        wanted = np.zeros(1 << BITS, bool)
        wanted[chosen] = True

        def sets(texts):
            if not texts:
                return []
            text, place = places_held(*text_bytes(pa.array(texts, pa.large_string())), wanted)
            return np.split(place.astype(np.int32), np.searchsorted(text, np.arange(1, len(texts))))

        for batch in batches:
            done = 0
            labels, folds = batch.column("__label"), batch.column("__fold")
            for rows, _, _ in pieces(batch, text_col):
                texts = [t or "" for t in rows.column(text_col).to_pylist()]
                others = [swapped_text(t, groups) for t in texts]
                named = [i for i, (t, o) in enumerate(zip(texts, others)) if t != o]
                after = dict(zip(named, sets([others[i] for i in named])))
                yield pa.RecordBatch.from_arrays(
                    [
                        labels.slice(done, len(rows)),
                        folds.slice(done, len(rows)),
                        pa.array([x.tobytes() for x in sets(texts)], pa.binary()),
                        pa.array([after[i].tobytes() if i in after else None for i in range(len(texts))], pa.binary()),
                    ],
                    names=["label", "fold", "places", "swapped"],
                )
                done += len(rows)

    return sample.mapInArrow(run, "label int, fold int, places binary, swapped binary")


def choose(place: np.ndarray, clean: np.ndarray, toxic: np.ndarray, rows: int, positive: int) -> np.ndarray:
    """The places in at least LEAST_TEXTS texts whose share differs most, in standard errors, between the classes."""
    share, total = positive / rows, clean + toxic
    z = np.abs(toxic - total * share) / np.sqrt(np.maximum(total * share * (1 - share), 1e-9))
    z[total < LEAST_TEXTS] = -1
    order = np.lexsort((place, -z))[:CHOSEN]
    return np.sort(place[order[z[order] >= 0]])


def sparse(sets: list[np.ndarray], chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row and column of each chosen place in each set."""
    flat = np.concatenate(sets) if sets else np.zeros(0, np.int32)
    return np.repeat(np.arange(len(sets)), [len(s) for s in sets]), np.searchsorted(chosen, flat)


def fit_toxicity(
    labels: np.ndarray, chosen: np.ndarray, sets: list[np.ndarray], swapped: list[np.ndarray | None], swap: float = SWAP,
    penalties: tuple[float, float] = PENALTIES[1], steps: int = 400,
) -> ToxicityModel:
    """With one class only, or no rows at all, every score is the smoothed share of ones. Only ``chosen`` places of the sets count."""
    lasso, ridge = penalties
    sets = [s[np.isin(s, chosen, assume_unique=True)] for s in sets]
    swapped = [None if s is None else s[np.isin(s, chosen, assume_unique=True)] for s in swapped]
    y = labels.astype(np.float64)
    share = (y.sum() + 0.5) / (len(y) + 1)
    prior = float(np.log(share / (1 - share)))
    weights = np.zeros(1 << BITS)
    if not len(chosen):
        return ToxicityModel(prior, weights)
    named = [i for i, s in enumerate(swapped) if s is not None]
    row, col = sparse(sets, chosen)
    row_b, col_b = sparse([sets[i] for i in named], chosen)
    row_a, col_a = sparse([swapped[i] for i in named], chosen)
    # Rows of the change that a swap makes: +1 for what it brings, -1 for what it takes away.
    d_row, d_col = np.concatenate([row_a, row_b]), np.concatenate([col_a, col_b])
    d_value = np.concatenate([np.ones(len(row_a)), -np.ones(len(row_b))])
    n, k = len(y), len(chosen)

    def slope(bias, w, ridge):
        margin = bias + np.bincount(row, weights=w[col], minlength=n)
        off = 1 / (1 + np.exp(-np.clip(margin, -30, 30))) - y
        change = np.bincount(d_row, weights=d_value * w[d_col], minlength=max(1, len(named)))
        pull = np.bincount(d_col, weights=d_value * change[d_row], minlength=k) * swap / n
        return off.mean(), np.bincount(col, weights=off[row], minlength=k) / n + pull + ridge * w

    def descend(lasso, ridge, support, steps):
        # Steps as long as the curvature of each weight allows, with momentum that restarts.
        reach = np.bincount(row, minlength=n)[row] + 1.0
        curve = np.bincount(col, weights=reach, minlength=k) / (4 * n) + ridge
        widths = np.bincount(d_row, minlength=max(1, len(named)))
        curve += swap * np.bincount(d_col, weights=widths[d_row].astype(float), minlength=k) / n
        bias_curve = (np.bincount(row, minlength=n) + 1).mean() / 4
        bias, w, t = prior, np.zeros(k), 1.0
        ahead_bias, ahead = bias, w
        for _ in range(steps):
            g0, g = slope(ahead_bias, ahead, ridge)
            new_bias, new = ahead_bias - g0 / bias_curve, ahead - g / curve
            new = np.where(support, np.sign(new) * np.maximum(np.abs(new) - lasso / curve, 0), 0)
            t, before = (1 + np.sqrt(1 + 4 * t * t)) / 2, t
            ahead_bias, ahead = new_bias + (before - 1) / t * (new_bias - bias), new + (before - 1) / t * (new - w)
            bias, w = new_bias, new
        return bias, w

    _, w = descend(lasso, 0.0, np.ones(k, bool), steps)
    support = w != 0
    used = support[col]  # the second fit only has what the lasso kept
    row, col = row[used], col[used]
    used = support[d_col]
    d_row, d_col, d_value = d_row[used], d_col[used], d_value[used]
    bias, w = descend(0.0, ridge, support, steps)
    weights[chosen[support]] = w[support]
    return ToxicityModel(float(bias), weights)


def train_toxicity(
    docs: DataFrame, labels: DataFrame, label: str = "toxic", id_col: str = "doc_id", text_col: str = "text", rows: int = TRAIN_ROWS,
    groups=IDENTITY_TERMS, swap: float = SWAP,
) -> ToxicityModel:
    """A model of ``label`` over whole texts, fitted on a bounded sample of the given labels.

    The penalties are those of PENALTIES with the least loss on folds of the given rows that were held out, features included; copies of a
    text are in one fold. Null labels and ids take no part, an id with several labels has the larger one, null and empty texts are texts that
    hold nothing, repeated rows count each (as far as the bound on rows allows). With no rows or one class every text has the same score.
    """
    sample = labelled_sample(docs.select(id_col, text_col), labels, label, id_col, rows)
    fold = F.pmod(F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))), F.lit(FOLDS)).cast("int").alias("__fold")
    sample = checkpointed(sample.select("__label", fold, text_col))
    classes = sample.groupBy("__fold", (F.col("__label") > 0).alias("toxic")).count().collect()
    held = np.zeros((FOLDS, 2), np.int64)
    for r in classes:
        held[r["__fold"], int(r["toxic"])] = r["count"]
    names = [f"{kind}{f}" for kind in ("clean", "toxic") for f in range(FOLDS)]
    some = held.sum(axis=0).all()
    counts = place_counts(sample, text_col).select("place", *names).toPandas().to_numpy(np.int64) if some else np.zeros((0, 1 + 2 * FOLDS), np.int64)
    counts = counts[np.argsort(counts[:, 0])]

    def without(folds: list[int]) -> np.ndarray:
        """The places that rows outside these folds choose."""
        keep = [f for f in range(FOLDS) if f not in folds]
        clean, toxic = held[keep].sum(axis=0)
        if not clean or not toxic or not len(counts):
            return np.zeros(0, np.int64)
        return choose(counts[:, 0], counts[:, 1:][:, keep].sum(axis=1), counts[:, 1 + FOLDS :][:, keep].sum(axis=1), clean + toxic, toxic)

    chosen, in_folds = without([]), [without([f]) for f in range(FOLDS)]
    wanted = np.unique(np.concatenate([chosen, *in_folds]))
    found = sorted((r["label"], r["places"], r["swapped"] is not None, r["swapped"] or b"", r["fold"]) for r in place_sets(sample, text_col, wanted, groups).collect())
    y = np.array([v > 0 for v, *_ in found], np.float64)
    sets = [np.frombuffer(w, np.int32) for _, w, *_ in found]
    swapped = [np.frombuffer(s, np.int32) if named else None for _, _, named, s, _ in found]
    folds = np.array([f for *_, f in found], np.int64)
    penalties = best_penalties(y, folds, in_folds, sets, swapped, swap) if len(chosen) else PENALTIES[0]
    return fit_toxicity(y, chosen, sets, swapped, swap, penalties)


def best_penalties(y: np.ndarray, folds: np.ndarray, in_folds: list[np.ndarray], sets: list, swapped: list, swap: float) -> tuple[float, float]:
    """The penalties with the least loss over all folds, each scored by a model of the others; of equal ones the first."""
    losses = []
    for penalties in PENALTIES:
        loss = 0.0
        for fold, chosen in enumerate(in_folds):
            own, rest = np.flatnonzero(folds == fold), np.flatnonzero(folds != fold)
            model = fit_toxicity(y[rest], chosen, [sets[i] for i in rest], [swapped[i] for i in rest], swap, penalties, 150)
            margin = np.array([model.bias + model.weights[sets[i]].sum() for i in own])
            loss += float(np.logaddexp(0, np.where(y[own] > 0, -margin, margin)).sum())
        losses.append(loss)
    return PENALTIES[int(np.argmin(losses))]


def scores(model: ToxicityModel, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The score of each text."""
    n = len(offsets) - 1
    text, place = places_held(data, offsets, model.weights != 0)
    margin = model.bias + np.bincount(text, weights=model.weights[place], minlength=n)
    return 1 / (1 + np.exp(-np.clip(margin, -30, 30)))


def score_toxicity(docs: DataFrame, model: ToxicityModel, text_col: str = "text") -> DataFrame:
    """``docs`` with ``score`` from 0 to 1 over the whole text. Null and empty texts get the score of a text that holds nothing known;
    a column named ``score`` is replaced; repeated rows get the same score; an empty table stays empty."""
    fields = [f for f in docs.schema.fields if f.name != "score"]
    docs = docs.select(*[f"`{f.name}`" for f in fields])
    known = np.flatnonzero(model.weights)
    bias, values = model.bias, model.weights[known]

    def run(batches):
        weights = np.zeros(1 << BITS)
        weights[known] = values
        own = ToxicityModel(bias, weights)
        for batch in batches:
            for rows, data, offsets in pieces(batch, text_col):
                yield pa.RecordBatch.from_arrays(
                    [*rows.columns, pa.array(scores(own, data, offsets))], names=[*rows.schema.names, "score"]
                )

    return docs.mapInArrow(run, T.StructType([*fields, T.StructField("score", T.DoubleType())]))
