"""Consensus of several annotators' labels by a competence-and-spamming mixture.

Each label is either the item's true label (with the annotator's competence as probability) or a draw from
the annotator's own guess distribution. Expectation-maximisation yields the posterior of each item's label,
each annotator's competence and each annotator's guesses. An annotator who truthfully reports under exchanged
label names (A for B) would look like a guesser; after a first fit such a renaming is read off the expected
table of true label against vote, and a second fit reads the annotator's labels under it.

Votes are gathered once into one short array per item (one vote per annotator and item, combined map-side),
written to shared storage, and every EM step is a narrow pass over these arrays that returns a row of sums for each
annotator that a task met. The parameters travel with the tasks; their size is that of the annotator
list, which is checked against ``max_annotators``. Beyond it every step, and the renaming, is run as joins on
the annotator, with the same steps, the same end and the same results.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..workspace import discard, materialize


@dataclass
class Fit:
    annotators: list[str]
    labels: list[str]
    competence: np.ndarray  # annotators
    guesses: np.ndarray  # annotators x labels
    prior: np.ndarray  # labels
    steps: int
    names: np.ndarray | None = None  # annotators x labels: what a written label means


def normal_label(raw: Column, labels: list[str]) -> Column:
    """The label that a written choice names, or null: case, blanks, quotes, brackets and a leading ``series`` don't count."""
    bare = F.trim(F.regexp_replace(F.lower(raw), r"[^\p{L}\p{N}]+", " "))
    bare = F.regexp_replace(bare, r"^(series|study|choice|answer|option|label) ", "")
    out = F.lit(None).cast("string")
    for label in labels:
        out = F.when(bare == label.lower(), F.lit(label)).otherwise(out)
    return out


def latest_votes(votes: DataFrame, labels: list[str]) -> DataFrame:
    """Per item and annotator the latest valid label of ``votes(item, annotator, choice, at, vote_id)``.

    Void and null choices count for nothing, ties in time go to the larger vote_id, a null time comes first,
    and votes without item or annotator are left out. The combination is a max by (time, id), so redelivered
    rows and hot items are reduced before the shuffle.
    """
    valid = votes.withColumn("label", normal_label(F.col("choice"), labels)).filter(F.col("label").isNotNull() & F.col("item").isNotNull() & F.col("annotator").isNotNull())
    return valid.groupBy("item", "annotator").agg(F.max(F.struct("at", "vote_id", "label")).alias("m")).select("item", "annotator", F.col("m.label").alias("label"))


def _posterior(a: np.ndarray, y: np.ndarray, item: np.ndarray, n: int, fit: Fit) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Posterior of each item (n x labels), probability that each vote is truthful given the item's label equals it, and the log evidence of each item."""
    guess = (1 - fit.competence[a]) * fit.guesses[a, y]
    hit = fit.competence[a] + guess
    log = np.tile(np.log(fit.prior), (n, 1))
    np.add.at(log, item, np.log(guess)[:, None])
    np.add.at(log, (item, y), np.log(hit) - np.log(guess))
    top = log.max(1, keepdims=True)
    p = np.exp(log - top)
    z = p.sum(1, keepdims=True)
    return p / z, fit.competence[a] / hit, (top + np.log(z))[:, 0]


def _flat(batch: pd.DataFrame, names: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    sizes = batch["a"].map(len).to_numpy()
    item = np.repeat(np.arange(len(batch)), sizes)
    a = np.concatenate(batch["a"].to_numpy())
    return a, names[a, np.concatenate(batch["y"].to_numpy())], item


def best_match(gain: np.ndarray) -> list[int]:
    """For each row the column of the one-to-one assignment with the greatest sum (shortest augmenting paths), the identity among equals."""
    k = len(gain)
    cost = -np.asarray(gain, dtype="float64") - 1e-9 * np.eye(k)
    u, v, owner = np.zeros(k + 1), np.zeros(k + 1), np.full(k + 1, -1)
    for i in range(k):
        owner[k] = i
        at, low, way, done = k, np.full(k, np.inf), np.full(k, -1), np.zeros(k + 1, dtype=bool)
        while owner[at] >= 0:
            done[at] = True
            row = owner[at]
            slack = np.where(done[:k], np.inf, cost[row] - u[row] - v[:k])
            better = slack < low
            low[better], way[better] = slack[better], at
            open_low = np.where(done[:k], np.inf, low)
            to = int(open_low.argmin())
            step = open_low[to]
            u[owner[done]] += step
            v[done] -= step
            low[~done[:k]] -= step
            at = to
        while at != k:
            before = way[at]
            owner[at] = owner[before]
            at = before
    out = [0] * k
    for column, row in enumerate(owner[:k]):
        out[row] = column
    return out


def renamings(table: np.ndarray, least_gain: float = 0.2) -> np.ndarray:
    """By annotator, the renaming of labels that agrees best with ``table`` (annotator x true label x written label).

    The identity stays unless another renaming agrees on ``least_gain`` more of the n votes, and on 3 sqrt(n) more, which
    chance doesn't reach.
    """
    m, k, _ = table.shape
    names = np.tile(np.arange(k), (m, 1))
    for i in range(m):
        n = table[i].sum()
        best = best_match(table[i].T)
        gain = sum(table[i, best[y], y] - table[i, y, y] for y in range(k))
        if n > 0 and gain >= max(least_gain * n, 3 * np.sqrt(n)):
            names[i] = best
    return names


def fit_mixture(items: DataFrame, annotators: list[str], labels: list[str], steps: int = 60, tolerance: float = 1e-4, smoothing: float = 0.5) -> Fit:
    """EM over ``items(item, a array<int>, y array<int>)``; stops when no competence moves by more than ``tolerance``."""
    m, k = len(annotators), len(labels)
    first = Fit(annotators, labels, np.full(m, 0.7), np.full((m, k), 1 / k), np.full(k, 1 / k), 0, np.tile(np.arange(k), (m, 1)))
    used, fit = _em(items, first, steps, tolerance, smoothing)
    names = renamings(_vote_table(items, used))
    if (names == fit.names).all():
        return fit
    competence = np.where((names == np.arange(k)).all(1), fit.competence, 0.7)
    return _em(items, Fit(annotators, labels, competence, fit.guesses, fit.prior, fit.steps, names), steps, tolerance, smoothing)[1]


def _sums(items: DataFrame, fit: Fit, width: int, add: Callable) -> dict[int, np.ndarray]:
    """By annotator the sums of ``width`` numbers over all votes, -1 for sums over items; ``add(a, y, item, p, honest)`` yields (annotators, column, values).

    A task sends a row for each annotator that it met; the rows are added up map-side and only the parameters' sums come
    to the driver.
    """
    m = len(fit.annotators)

    def part(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((m + 1, width))
        for batch in batches:
            if len(batch):
                a, y, item = _flat(batch, fit.names)
                p, honest, _ = _posterior(a, y, item, len(batch), fit)
                for who, column, values in add(a, y, item, p, honest):
                    np.add.at(total, (who, column), values)
        met = np.flatnonzero(total.any(axis=1))
        yield pd.DataFrame(np.column_stack([np.where(met == m, -1, met), total[met]]), columns=["a", *[f"x{i}" for i in range(width)]])

    rows = items.select("a", "y").mapInPandas(part, ", ".join(["a double", *[f"x{i} double" for i in range(width)]]))
    return {int(r[0]): np.array(r[1:], dtype="float64") for r in rows.groupBy("a").agg(*[F.sum(f"x{i}").alias(f"x{i}") for i in range(width)]).collect()}


def _vote_table(items: DataFrame, fit: Fit) -> np.ndarray:
    """Expected votes by annotator, true label and written label."""
    m, k = len(fit.annotators), len(fit.labels)

    def add(a: np.ndarray, y: np.ndarray, item: np.ndarray, p: np.ndarray, honest: np.ndarray) -> Iterator[tuple]:
        for t in range(k):
            yield a, t * k + y, p[item, t]

    table = np.zeros((m, k * k))
    for i, x in _sums(items, fit, k * k, add).items():
        table[i] = x
    return table.reshape(m, k, k)


def _em(items: DataFrame, fit: Fit, steps: int, tolerance: float, smoothing: float) -> tuple[Fit, Fit]:
    """(the parameters that the last step used, those that it gave)."""
    m, k = len(fit.annotators), len(fit.labels)

    def add(a: np.ndarray, y: np.ndarray, item: np.ndarray, p: np.ndarray, honest: np.ndarray) -> Iterator[tuple]:
        t = p[item, y] * honest
        yield a, 0, t
        yield a, 1, 1.0
        yield a, 2 + y, 1 - t
        # the sums of the posteriors stand in the row behind the annotators
        yield np.full(k, m), 2 + np.arange(k), p.sum(0)

    used = fit
    for _ in range(steps):
        total = np.zeros((m + 1, 2 + k))
        for i, x in _sums(items, fit, 2 + k, add).items():
            total[i] = x
        truthful, votes, guessed, classes = total[:m, 0], total[:m, 1], total[:m, 2:], total[m, 2:]
        competence = (truthful + smoothing) / (votes + 2 * smoothing)
        moved = float(np.abs(competence - fit.competence).max()) if m else 0.0
        guesses = (guessed + smoothing) / (guessed.sum(1, keepdims=True) + k * smoothing)
        used, fit = fit, Fit(fit.annotators, fit.labels, competence, guesses, (classes + 1) / (classes.sum() + k), fit.steps + 1, fit.names)
        if moved < tolerance:
            break
    return used, fit


def _joined_fit(votes: DataFrame, labels: list[str], steps: int, smoothing: float, tolerance: float = 1e-4) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(posteriors, annotators, votes as they are read): ``fit_mixture`` for an annotator list of any size, whose parameters are a table that is joined on the annotator."""
    k = len(labels)
    y = F.create_map(*[v for i, x in enumerate(labels) for v in (F.lit(x), F.lit(i))])[F.col("label")]
    votes = materialize(votes.select("item", "annotator", y.alias("y")), "votes")
    params = votes.select("annotator").distinct().select("annotator", F.lit(0.7).alias("c"), *[F.lit(1.0 / k).alias(f"g{j}") for j in range(k)])
    params, prior, post = _joined_em(votes, materialize(params, "annotators"), [1.0 / k] * k, steps, smoothing, tolerance)
    if post is None:
        return materialize(_joined_posterior(votes.join(params, "annotator"), prior), "posterior"), params, votes
    names = materialize(_joined_renamings(votes, post, k), "names")
    same = F.col("names") == F.array(*[F.lit(j) for j in range(k)])
    if names.filter(~same).limit(1).count():
        votes = materialize(votes.join(names, "annotator").select("item", "annotator", F.element_at("names", F.col("y") + 1).alias("y")), "votes")
        params = params.join(names, "annotator").select("annotator", F.when(same, F.col("c")).otherwise(0.7).alias("c"), *[f"g{j}" for j in range(k)])
        params, prior, _ = _joined_em(votes, materialize(params, "annotators"), prior, steps, smoothing, tolerance)
    return materialize(_joined_posterior(votes.join(params, "annotator"), prior), "posterior"), params, votes


def _joined_renamings(votes: DataFrame, post: DataFrame, k: int) -> DataFrame:
    """(annotator, names): the renaming of each annotator by the expected table of true label and vote."""
    table = votes.join(post, "item").groupBy("annotator").agg(F.array(*[F.sum(F.when(F.col("y") == j, F.col(f"p{i}")).otherwise(0.0)) for i in range(k) for j in range(k)]).alias("t"))

    def rename(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            if len(b):
                yield pd.DataFrame({"annotator": b["annotator"], "names": renamings(np.stack(b["t"].to_numpy()).reshape(-1, k, k)).tolist()})

    return table.mapInPandas(rename, "annotator string, names array<int>")


def _rated(scored: DataFrame, k: int) -> DataFrame:
    g = F.element_at(F.array(*[F.col(f"g{j}") for j in range(k)]), F.col("y") + 1)
    return scored.withColumn("guess", (1 - F.col("c")) * g).withColumn("hit", F.col("c") + F.col("guess"))


def _joined_posterior(scored: DataFrame, prior: list[float]) -> DataFrame:
    k = len(prior)
    logs = _rated(scored, k).groupBy("item").agg(
        *[(F.sum(F.log("guess")) + F.sum(F.when(F.col("y") == j, F.log("hit") - F.log("guess")).otherwise(0.0)) + F.lit(float(np.log(prior[j])))).alias(f"l{j}") for j in range(k)]
    )
    top = F.greatest(*[F.col(f"l{j}") for j in range(k)])
    exps = logs.select("item", *[F.exp(F.col(f"l{j}") - top).alias(f"e{j}") for j in range(k)])
    z = sum((F.col(f"e{j}") for j in range(1, k)), F.col("e0"))
    return exps.select("item", *[(F.col(f"e{j}") / z).alias(f"p{j}") for j in range(k)])


def _joined_em(votes: DataFrame, params: DataFrame, prior: list[float], steps: int, smoothing: float, tolerance: float) -> tuple[DataFrame, list[float], DataFrame]:
    """``_em`` as joins: the annotators and the prior after the last step, and the posteriors that this step used."""
    k, post = len(prior), None
    for _ in range(steps):
        if post is not None:
            discard(post)
        scored = votes.join(params, "annotator")
        post = materialize(_joined_posterior(scored, prior), "posterior")
        t = F.element_at(F.array(*[F.col(f"p{j}") for j in range(k)]), F.col("y") + 1) * F.col("c") / F.col("hit")
        stats = _rated(scored, k).join(post, "item").withColumn("t", t).groupBy("annotator").agg(
            ((F.sum("t") + smoothing) / (F.count("*") + 2 * smoothing)).alias("new"),
            F.first("c").alias("old"),
            *[(F.sum(F.when(F.col("y") == j, 1 - F.col("t")).otherwise(0.0)) + smoothing).alias(f"n{j}") for j in range(k)],
        )
        n = sum((F.col(f"n{j}") for j in range(1, k)), F.col("n0"))
        new = materialize(stats.select("annotator", F.col("new").alias("c"), "old", *[(F.col(f"n{j}") / n).alias(f"g{j}") for j in range(k)]), "annotators")
        discard(params)
        moved = new.agg(F.max(F.abs(F.col("c") - F.col("old")))).first()[0]
        params = new.drop("old")
        sums = post.agg(*[F.sum(f"p{j}").alias(f"p{j}") for j in range(k)]).first()
        classes = np.array([sums[f"p{j}"] or 0.0 for j in range(k)])
        prior = ((classes + 1) / (classes.sum() + k)).tolist()
        if moved < tolerance:
            break
    return params, prior, post


def consensus(votes: DataFrame, labels: list[str], max_annotators: int = 50_000, steps: int = 60, smoothing: float = 0.5) -> tuple[DataFrame, DataFrame]:
    """(items, annotators) of ``votes(item, annotator, choice, at, vote_id)``.

    items: item, choice, posterior (the agreement measure of the model), agreement (share of pairs of votes
    that agree, null for one vote), n_votes. annotators: annotator, reliability (competence), n_votes and the
    guess distribution. Items without a valid vote give no row, equal posteriors go to the earlier label of
    ``labels``, and an empty table gives two empty results.
    """
    valid = materialize(latest_votes(votes, labels), "latest-votes")
    per = valid.groupBy("annotator").count().orderBy("annotator").limit(max_annotators + 1).collect()
    k = len(labels)
    pairs = F.try_divide(sum((F.col(f"n{j}") * (F.col(f"n{j}") - 1) for j in range(1, k)), F.col("n0") * (F.col("n0") - 1)).cast("double"), F.col("n_votes") * (F.col("n_votes") - 1))
    if len(per) > max_annotators:
        post, params, read = _joined_fit(valid, labels, steps, smoothing)
        counts = read.groupBy("item").agg(F.count("*").alias("n_votes"), *[F.count(F.when(F.col("y") == j, 1)).alias(f"n{j}") for j in range(k)])
        top = F.greatest(*[F.col(f"p{j}") for j in range(k)])
        best = F.coalesce(*[F.when(F.col(f"p{j}") >= top - 1e-12, F.lit(x)) for j, x in enumerate(labels)])
        items = post.join(counts, "item").select("item", best.alias("choice"), top.alias("posterior"), pairs.alias("agreement"), "n_votes")
        n = valid.groupBy("annotator").agg(F.count("*").alias("n_votes"))
        people = params.join(n, "annotator").select("annotator", F.col("c").alias("reliability"), "n_votes", F.array(*[F.col(f"g{j}") for j in range(k)]).alias("guesses"))
        return items, people
    names = [r.annotator for r in per]
    spark = votes.sparkSession
    if not names:
        item_type = valid.schema["item"].dataType.simpleString()
        return (
            spark.createDataFrame([], f"item {item_type}, choice string, posterior double, agreement double, n_votes long"),
            spark.createDataFrame([], "annotator string, reliability double, n_votes long, guesses array<double>"),
        )
    a_index = spark.createDataFrame([(x, i) for i, x in enumerate(names)], "annotator string, a int")
    y_index = F.create_map(*[v for i, x in enumerate(labels) for v in (F.lit(x), F.lit(i))])[F.col("label")]
    coded = valid.join(F.broadcast(a_index), "annotator").select("item", "a", y_index.alias("y"))
    arrays = coded.groupBy("item").agg(F.sort_array(F.collect_list(F.struct("a", "y"))).alias("v")).select("item", F.col("v.a").alias("a"), F.col("v.y").alias("y"))
    items = materialize(arrays, "items")
    fit = fit_mixture(items, names, labels, steps, smoothing=smoothing)

    def label(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if not len(batch):
                continue
            a, y, item = _flat(batch, fit.names)
            p, _, _ = _posterior(a, y, item, len(batch), fit)
            counts = np.zeros((len(batch), k), dtype="int64")
            np.add.at(counts, (item, y), 1)
            best = (p >= p.max(1, keepdims=True) - 1e-12).argmax(1)
            yield pd.DataFrame({"item": batch["item"], "choice": [labels[i] for i in best], "posterior": p.max(1), "n_votes": counts.sum(1), **{f"n{j}": counts[:, j] for j in range(k)}})

    item_type = items.schema["item"].dataType.simpleString()
    schema = f"item {item_type}, choice string, posterior double, n_votes long, " + ", ".join(f"n{j} long" for j in range(k))
    labelled = items.mapInPandas(label, schema).select("item", "choice", "posterior", pairs.alias("agreement"), "n_votes")
    n_votes = {r.annotator: r["count"] for r in per}
    people = spark.createDataFrame(
        [(x, float(fit.competence[i]), n_votes[x], fit.guesses[i].tolist()) for i, x in enumerate(names)], "annotator string, reliability double, n_votes long, guesses array<double>"
    )
    return labelled, people
