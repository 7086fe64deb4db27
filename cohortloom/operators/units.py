"""Quantities recorded in different units: a hidden Markov model per device decodes each value's unit.

The hidden state of a record is its unit, and the amount behind the record moves smoothly from one record of a
device to the next. So the score of a step from unit to unit has two parts: the odds that the unit is kept or
switched, and the density of the jump that the log amount would then make, log value plus log unit against the same
sum of the record before. A switch of the unit shows as a jump of the written value that the level doesn't share;
jumps have a floor, since the level itself may break. Where a level begins, the spread of all stated amounts of the
base unit tells the units apart. A unit that the record states is evidence of ``stated_odds``. Viterbi decoding gives
the most probable unit of every record.

A device may hold any share of the rows: rows are range-partitioned by (device, time, id) into blocks of bounded
size, each block is summed up by the max-plus matrix between the states of its first and last row of a device, these
are multiplied up in a tree of bounded fan-in, the states at the cuts come down the same tree, and every block is
then decoded on its own. No step gathers more than a bounded number of matrices in one task and nothing grows on the
driver. The result is a best path of one Viterbi pass over the whole device.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.quantities import DOSE_UNITS, SPAN_UNITS, bare_number, parse_dose, parse_duration
from ..workspace import materialize, spread, whole_groups


@dataclass(frozen=True)
class UnitModel:
    """Hidden states and their odds.

    ``states``: (base unit, size in base units); ``stay``: probability that the unit is kept; ``sigma``: spread of the
    log10 jump of the amount between neighbouring records; ``stray``: probability of a jump to anywhere within
    ``decades``; ``stated_odds``: log odds of a unit that the record states, None for more than any jumps and switches
    around it can outweigh.
    """

    states: tuple[tuple[str, Fraction], ...]
    stay: float = 0.9
    sigma: float = 1.0
    stray: float = 0.01
    decades: float = 20.0
    stated_odds: float | None = None
    block_rows: int = 50_000
    fan_in: int = 64

    def index(self) -> dict[tuple[str, Fraction], int]:
        return {s: i for i, s in enumerate(self.states)}


DOSE_MODEL = UnitModel(tuple(sorted(set(DOSE_UNITS.values()))))
DURATION_MODEL = UnitModel(tuple(sorted({("s", s) for s in SPAN_UNITS.values()})))


def _reader(model: UnitModel, quantity: str) -> Callable[..., tuple[Fraction, int | None] | None]:
    """A row's raw text, numeric column, unit and agent to the one number it states and the stated unit's state or None."""
    index = model.index()

    def read(raw: object, numeric: float | None, unit: object, agent: object) -> tuple[Fraction, int | None] | None:
        numeric = None if numeric is None or numeric != numeric else float(numeric)
        raw = raw if isinstance(raw, str) else None
        if quantity == "dose":
            got = parse_dose(raw, numeric, unit if isinstance(unit, str) else None, agent if isinstance(agent, str) else None)
        elif got := parse_duration(raw, numeric):
            got = got[0], ("s", got[1])
            if got[1] not in index:
                got = (got[0] * got[1][1], ("s", Fraction(1)))
        elif raw is not None and (value := bare_number(raw)) is not None:
            got = value, None
        return got and (got[0], index.get(got[1]) if got[1] else None)

    return read


def _whole(number: Fraction, size: Fraction) -> int | None:
    amount = round(number * size)
    return amount if abs(amount) < 2**63 else None


def _quantity_rows(df: DataFrame, id_col: str, device_col: str, time_col: str, agent_col: str, quantity: str, value: str) -> DataFrame:
    """The fields that a quantity is read from: row_id, device, at, raw, numeric, unit, agent."""
    q = F.col(value)
    second = q["value_numeric"] if quantity == "dose" else q["value_hours"]
    unit = q["unit"] if quantity == "dose" else F.lit(None).cast("string")
    rows = df.select(
        F.col(id_col).alias("row_id"),
        F.coalesce(F.col(device_col).cast("string"), F.lit("")).alias("device"),
        F.coalesce(F.unix_micros(F.col(time_col).cast("timestamp_ltz")), F.lit(0)).alias("at"),
        q["value_raw"].alias("raw"),
        second.alias("numeric"),
        unit.alias("unit"),
        (F.col(agent_col) if quantity == "dose" else F.lit(None).cast("string")).alias("agent"),
    ).filter(F.col("raw").isNotNull() | F.col("numeric").isNotNull())
    return spread(rows)


def parsed_quantities(df: DataFrame, id_col: str, device_col: str, time_col: str, agent_col: str, model: UnitModel, quantity: str, value: str) -> DataFrame:
    """Rows that state one number: id, device, time, the number as text, its log10 and the stated unit's state or null.

    Null structs, ranges, alternatives and texts without a number give no row; a null device or time is kept
    as the empty device or the first time.
    """
    read = _reader(model, quantity)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for key, device, at, *fields in b.itertuples(index=False, name=None):
                if got := read(*fields):
                    number, state = got
                    log = math.log10(number) if number > 0 else None
                    out.append((key, device, at, f"{number.numerator}/{number.denominator}", log, state))
            frame = pd.DataFrame(out, columns=["row_id", "device", "at", "number", "log_value", "stated"])
            frame["stated"] = frame["stated"].astype("Int32")
            yield frame

    rows = _quantity_rows(df, id_col, device_col, time_col, agent_col, quantity, value)
    return rows.mapInPandas(run, "row_id long, device string, at long, number string, log_value double, stated int")


def stated_amounts(df: DataFrame, id_col: str, device_col: str, time_col: str, agent_col: str, value: str, quantity: str) -> DataFrame:
    """Every number of ``value`` whose unit the row states, in base units, read from the row alone.

    A stated unit counts whatever the neighbours say, so these are the ``stated`` rows of ``common_units``, and no path
    is decoded for them. An amount beyond a bigint is null.
    """
    model = DOSE_MODEL if quantity == "dose" else DURATION_MODEL
    read = _reader(model, quantity)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out, amounts = [], []
            for key, *fields in b.itertuples(index=False, name=None):
                if (got := read(*fields)) and got[1] is not None:
                    base, size = model.states[got[1]]
                    out.append((key, base))
                    amounts.append(_whole(got[0], size))
            frame = pd.DataFrame(out, columns=["row_id", "base_unit"])
            frame["amount"] = pd.array(amounts, dtype="Int64")
            yield frame

    rows = _quantity_rows(df, id_col, device_col, time_col, agent_col, quantity, value).drop("device", "at")
    return rows.mapInPandas(run, "row_id long, base_unit string, amount long").withColumnRenamed("row_id", id_col).withColumn("quantity", F.lit(quantity))


class Decoder:
    """Scores and Viterbi passes over the states that the data show.

    ``counts``: the stated rows of each state of the model; ``sums``: number, sum and sum of squares of their log values.
    """

    def __init__(self, model: UnitModel, counts: dict[int, int], sums: dict[int, tuple[int, float, float]] | None = None) -> None:
        self.states = [i for i in range(len(model.states)) if counts.get(i)] or list(range(len(model.states)))
        self.k = len(self.states)
        self.code = np.full(len(model.states) + 1, -1)
        self.code[self.states] = range(self.k)
        prior = np.array([counts.get(i, 0) + 1.0 for i in self.states])
        self.prior = np.log(prior / prior.sum())
        self.t = np.log((1 - model.stay) * np.exp(self.prior))[None, :].repeat(self.k, 0)
        self.t[np.diag_indices(self.k)] = np.log(model.stay + (1 - model.stay) * np.exp(self.prior))
        size = np.array([math.log10(model.states[i][1]) for i in self.states])
        base = np.array([model.states[i][0] for i in self.states])
        self.shift = (size[None, :] - size[:, None]) / model.sigma
        self.apart = base[None, :] != base[:, None]
        self.sigma, self.size = model.sigma, size
        self.mean, self.spread = np.zeros(self.k), np.full(self.k, 3.0)
        for b in set(base):
            own = [(n, t + n * c, q + 2 * c * t + n * c * c) for i, c, x in zip(self.states, size, base) if x == b for n, t, q in [(sums or {}).get(i, (0, 0.0, 0.0))]]
            n, t, q = map(sum, zip(*own))
            if n:
                # one more amount a decade off the mean, so that few amounts don't make a narrow level
                self.mean[base == b], self.spread[base == b] = t / n, math.sqrt((max(0.0, q - t * t / n) + 1) / (n + 1))
        self.floor = math.log(model.stray / model.decades * model.sigma * math.sqrt(2 * math.pi) / (1 - model.stray))
        most = 2 * (float(self.t.max() - self.t.min()) - self.floor) + float(self.prior.max() - self.prior.min())
        most += float(np.log(self.spread).max() - np.log(self.spread).min()) - self.floor
        self.odds = most + 1 if model.stated_odds is None else model.stated_odds

    def steps(self, jump: np.ndarray) -> np.ndarray:
        """(rows x from x to): scores of the steps into rows whose log value is ``jump`` above that of the row before; nan where either has none."""
        z = (jump / self.sigma)[:, None, None] + self.shift
        near = -0.5 * z * z
        near[:, self.apart] = self.floor
        return np.fmax(near, self.floor) + self.t

    def evidence(self, x: np.ndarray, stated: np.ndarray) -> np.ndarray:
        """(rows x states): what the row itself says, by its stated unit and by the amount that its value would be."""
        z = (x[:, None] + self.size - self.mean) / self.spread
        e = np.fmax(-0.5 * z * z, self.floor) - np.log(self.spread)
        e[np.isnan(x)] = 0
        known = np.flatnonzero(stated >= 0)
        own = e[known, stated[known]]
        e[known] -= self.odds
        e[known, stated[known]] = own
        return e

    def matrix(self, x: np.ndarray, stated: np.ndarray) -> np.ndarray:
        """Best scores from each state of the first row to each state of the last."""
        e = self.evidence(x, stated)
        m = np.full((self.k, self.k), -np.inf)
        np.fill_diagonal(m, e[0])
        for s in range(1, len(x), 512):
            for step, own in zip(self.steps(x[s : s + 512] - x[s - 1 : len(x) - 1][: 512]), e[s : s + 512]):
                m = (m[:, :, None] + step[None]).max(1) + own
        return m

    def enter(self, state: int, jump: float) -> np.ndarray:
        """Scores of the first row's states behind a row in ``state``, or at the start of a device (-1)."""
        return self.prior if state < 0 else self.steps(np.array([jump]))[0, state]

    def decode(self, x: np.ndarray, stated: np.ndarray, edges: list[int], enter: np.ndarray, before: np.ndarray, leave: np.ndarray) -> np.ndarray:
        """The best path of each run ``edges[i]:edges[i + 1]``, all runs stepped side by side.

        ``enter``, ``before``: state and log value of the row before the run (-1: the device starts); ``leave``: the
        state of its last row (-1: free).
        """
        starts, sizes = np.array(edges[:-1]), np.diff(edges)
        order = np.argsort(-sizes, kind="stable")
        starts, sizes, enter, before, leave = starts[order], sizes[order], enter[order], before[order], leave[order]
        e = self.evidence(x, stated)
        back = np.zeros((len(x), self.k), dtype="int16")
        path = np.zeros(len(x), dtype="int64")
        v = np.where((enter < 0)[:, None], self.prior, self.steps(x[starts] - before)[np.arange(len(starts)), enter]) + e[starts]
        ends = np.where(leave >= 0, leave, 0)
        longest = int(sizes[0])
        active = len(starts)
        for t in range(longest):
            if t:
                at = starts[:active] + t
                scores = v[:active, :, None] + self.steps(x[at] - x[at - 1])
                back[at] = scores.argmax(1)
                v = scores.max(1) + e[at]
            still = int(np.searchsorted(-sizes, -(t + 1), side="left"))
            done = np.arange(still, active)
            ends[done] = np.where(leave[done] >= 0, leave[done], v[still:active].argmax(1))
            v, active = v[:still], still
        state = ends.copy()
        for t in range(longest - 1, -1, -1):
            active = int(np.searchsorted(-sizes, -t, side="left"))
            at = starts[:active] + t
            path[at] = state[:active]
            state[:active] = back[at, state[:active]]
        return path


_SEGMENT = "device string, idx long, first_x double, last_x double, m array<double>"
_CUT = "device string, idx long, enter int, before double, leave int"


def multiply_up(segments: DataFrame, decoder: Decoder, fan_in: int) -> DataFrame:
    """Segments of a device, ``fan_in`` neighbours each, put together; their ``idx`` is divided by ``fan_in``."""
    k = decoder.k

    def up(g: pd.DataFrame) -> pd.DataFrame:
        g = g.sort_values("idx")
        m = g["m"].iloc[0].reshape(k, k)
        x = g["last_x"].to_numpy(dtype="float64")
        for jump, own in zip(g["first_x"].to_numpy(dtype="float64")[1:] - x[:-1], g["m"].iloc[1:]):
            step = decoder.steps(np.array([jump]))[0]
            m = ((m[:, :, None] + step[None]).max(1)[:, :, None] + own.reshape(k, k)[None]).max(1)
        return pd.DataFrame({"device": g["device"].iloc[:1], "idx": g["idx"].iloc[:1] // fan_in, "first_x": g["first_x"].iloc[:1], "last_x": x[-1:], "m": [m.ravel()]})

    return segments.groupBy("device", F.floor(F.col("idx") / fan_in)).applyInPandas(lambda key, g: up(g), _SEGMENT)


def hand_down(segments: DataFrame, cuts: DataFrame | None, decoder: Decoder, fan_in: int) -> DataFrame:
    """The states at both ends of each segment, given those of the groups of segments above; None: the devices' own segments."""
    k = decoder.k

    def down(g: pd.DataFrame, enter: int, before: float, leave: int) -> pd.DataFrame:
        g = g.sort_values("idx")
        first, last = g["first_x"].to_numpy(dtype="float64"), g["last_x"].to_numpy(dtype="float64")
        ms = [m.reshape(k, k) for m in g["m"]]
        v = (decoder.enter(enter, first[0] - before)[:, None] + ms[0]).max(0)
        back = []
        for i in range(1, len(ms)):
            hop = (decoder.steps(first[i : i + 1] - last[i - 1 : i])[0][:, :, None] + ms[i][None]).max(1)
            scores = v[:, None] + hop
            back.append(scores.argmax(0))
            v = scores.max(0)
        state = int(v.argmax()) if leave < 0 else leave
        leaves = [state]
        for b in reversed(back):
            leaves.append(state := int(b[state]))
        leaves.reverse()
        return pd.DataFrame({"device": g["device"], "idx": g["idx"], "enter": [enter, *leaves[:-1]], "before": [before, *last[:-1]], "leave": leaves})

    if cuts is None:
        return segments.groupBy("device").applyInPandas(lambda key, g: down(g, -1, math.nan, -1), _CUT)

    def both(key: tuple, g: pd.DataFrame, c: pd.DataFrame) -> pd.DataFrame:
        return down(g, int(c["enter"].iloc[0]), float(c["before"].iloc[0]), int(c["leave"].iloc[0]))

    grouped = segments.groupBy("device", F.floor(F.col("idx") / fan_in).alias("up"))
    return grouped.cogroup(cuts.groupBy("device", F.col("idx").alias("up"))).applyInPandas(both, _CUT)


def _edges(block: pd.DataFrame) -> list[int]:
    d = block["device"].to_numpy()
    return [0, *(np.flatnonzero(d[1:] != d[:-1]) + 1).tolist(), len(d)]


def decode_units(rows: DataFrame, model: UnitModel, n_rows: int) -> DataFrame:
    """Decoded unit of every row of ``parsed_quantities``: row_id, base_unit, amount, evidence.

    ``evidence`` is ``stated`` where the path goes through the unit that the row states, ``corrected`` where it goes
    through another (only with a ``stated_odds`` of one's own), and ``inferred`` where the row states none. States are
    the units that some row states. Equal times are ordered by id, repeated rows each keep their row, zeros have no
    jump, an empty table gives none, and an amount beyond a bigint is null.
    """
    x = F.col("log_value")
    seen = rows.filter(F.col("stated").isNotNull()).groupBy("stated").agg(F.count("*").alias("n"), F.count(x).alias("m"), F.coalesce(F.sum(x), F.lit(0.0)).alias("t"), F.coalesce(F.sum(x * x), F.lit(0.0)).alias("q")).collect()
    decoder = Decoder(model, {r.stated: r.n for r in seen}, {r.stated: (r.m, r.t, r.q) for r in seen})
    blocks = max(1, math.ceil(n_rows / model.block_rows))
    order = ["device", "at", "row_id", "number", "stated"]
    cut = rows.repartitionByRange(blocks, *order).withColumn("block", F.spark_partition_id()).sortWithinPartitions("block", *order)
    # a block is one row group of one file, so that one task reads all of it
    cut = materialize(cut, "unit-blocks", {"parquet.block.size": str(2**30)})

    def sequences(block: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
        return block["log_value"].to_numpy(dtype="float64"), decoder.code[block["stated"].fillna(-1).to_numpy(dtype="int64")]

    def sum_up(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in whole_groups(batches, "block"):
            x, stated = sequences(b)
            edges = _edges(b)
            out = [(b["device"].iloc[s], int(b["block"].iloc[s]), x[s], x[t - 1], decoder.matrix(x[s:t], stated[s:t]).ravel()) for s, t in zip(edges, edges[1:])]
            yield pd.DataFrame(out, columns=["device", "idx", "first_x", "last_x", "m"])

    # devices that no block cuts need no ends
    ends = materialize(cut.groupBy("device").agg(F.min("block").alias("_lo"), F.max("block").alias("_hi")).filter("_lo < _hi").select("device"), "cut-devices")
    touched = cut.join(ends, "device", "left_semi").select(*order, "log_value", "block").sortWithinPartitions("block", *order)
    levels = [materialize(touched.mapInPandas(sum_up, _SEGMENT), "segments")]
    width = blocks
    while width > model.fan_in:
        levels.append(materialize(multiply_up(levels[-1], decoder, model.fan_in), "segments"))
        width = math.ceil(width / model.fan_in)
    known = None
    for level in reversed(levels):
        known = materialize(hand_down(level, known, decoder, model.fan_in), "cuts")

    states = [model.states[i] for i in decoder.states]

    def decode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in whole_groups(batches, "block"):
            x, stated = sequences(b)
            edges = _edges(b)
            heads = b.iloc[edges[:-1]]
            path = decoder.decode(x, stated, edges, heads["enter"].fillna(-1).to_numpy(dtype="int64"), heads["before"].to_numpy(dtype="float64"), heads["leave"].fillna(-1).to_numpy(dtype="int64"))
            amounts = []
            for number, p in zip(b["number"], path):
                top, bottom = number.split("/")
                amounts.append(_whole(Fraction(int(top), int(bottom)), states[p][1]))
            evidence = np.where(stated < 0, "inferred", np.where(stated == path, "stated", "corrected"))
            yield pd.DataFrame({"row_id": b["row_id"], "base_unit": [states[p][0] for p in path], "amount": pd.array(amounts, dtype="Int64"), "evidence": evidence})

    rows_and_ends = cut.join(known.withColumnRenamed("idx", "block"), ["block", "device"], "left").select("row_id", "device", "at", "number", "log_value", "stated", "block", "enter", "before", "leave")
    return rows_and_ends.sortWithinPartitions("block", *order).mapInPandas(decode, "row_id long, base_unit string, amount long, evidence string")


def common_units(df: DataFrame, id_col: str, device_col: str, time_col: str, agent_col: str, value: str, quantity: str) -> DataFrame:
    """Every stated number of ``value`` in base units, with the evidence for its unit."""
    model = DOSE_MODEL if quantity == "dose" else DURATION_MODEL
    rows = materialize(parsed_quantities(df, id_col, device_col, time_col, agent_col, model, quantity, value), f"parsed-{quantity}")
    return decode_units(rows, model, rows.count()).withColumnRenamed("row_id", id_col).withColumn("quantity", F.lit(quantity))


def masked_recovery(df: DataFrame, id_col: str, device_col: str, time_col: str, agent_col: str, value: str, quantity: str, share: float = 0.2) -> DataFrame:
    """How well the model decodes units that it isn't told: one row with quantity, n_masked, n_base (base unit right), n_amount (amount right).

    The stated unit of a share of the rows, drawn by the hash of their id, is hidden and all rows are decoded; zeros
    aren't scored. No rows give zeros.
    """
    model = DOSE_MODEL if quantity == "dose" else DURATION_MODEL
    rows = materialize(parsed_quantities(df, id_col, device_col, time_col, agent_col, model, quantity, value), f"parsed-{quantity}")
    n = rows.count()
    hide = F.pmod(F.xxhash64("row_id"), F.lit(1_000_000)) < int(share * 1_000_000)
    masked = rows.withColumn("stated", F.when(~hide, F.col("stated")))
    told = decode_units(rows, model, n).select("row_id", F.col("base_unit").alias("base"), F.col("amount").alias("true_amount"), F.col("evidence").alias("e"))
    guessed = decode_units(masked, model, n).join(told.filter("e = 'stated' and true_amount > 0"), "row_id").filter(F.col("evidence") == "inferred")
    return guessed.agg(F.count("*").alias("n_masked"), F.count_if(F.col("base_unit") == F.col("base")).alias("n_base"), F.count_if((F.col("base_unit") == F.col("base")) & (F.col("amount") == F.col("true_amount"))).alias("n_amount")).withColumn("quantity", F.lit(quantity))
