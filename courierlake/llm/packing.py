"""Packing documents into sequences of fixed length by a configuration linear program.

1. *Pieces.* Every document is encoded whole, an end id is added, and longer ones are cut. A piece
   carries the task that made it and its number among that task's pieces of its length.
2. *Plan.* The histogram of lengths, which has at most ``SEQUENCE`` rows however many documents
   there are, goes to the driver. A configuration is a multiset of lengths that fits a sequence; the
   program minimises the number of configurations used so that each length is covered. It is solved
   by multiplicative weights: prices of the lengths fall as they are covered, and a knapsack dynamic
   program over the capacity finds the configurations of the highest price. Fractional amounts are
   rounded down, the program is solved again for what is left, and a last remainder takes best-fit
   configurations, largest lengths first.
3. *Places.* The plan is a table of runs (length, first number, last number -> sequences, offset).
   Counts by task and length turn the numbers within tasks into numbers over all pieces, and each
   piece looks its run up. No window or sort meets the pieces of one length in one task.

Defined results: null text counts as empty, and an empty document is one piece of the end id;
repeated rows are packed once each; null ids pass through; an empty table gives no row; further
columns are ignored. Sequences are numbered from 0 without gaps.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from courierlake.llm.byte_bpe import token_ids
from courierlake.llm.common import stored, whole_text

SEQUENCE = 2048
END_ID = 0
#: Price updates in one solution of the program, and solutions before the last remainder.
UPDATES = 24
ROUNDS = 6
#: How strongly coverage lowers a price; configurations this close to the best price are used.
RATE, SLACK = 0.5, 0.02

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, task int, number long"


def pieces(
    docs: DataFrame, tokenizer: str, sequence: int = SEQUENCE, text: str = "text", doc_id: str = "doc_id"
) -> DataFrame:
    """The pieces of all documents; only the first piece of a document may be shorter."""
    end = np.array([END_ID], dtype="<u4")

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        task = TaskContext.get().partitionId()
        made = np.zeros(sequence + 1, dtype=np.int64)
        for batch in batches:
            rows = []
            for key, ids in zip(batch["doc_id"], token_ids(tokenizer, batch["text"]), strict=True):
                data = np.append(ids.astype("<u4"), end)
                n = len(data)
                start, stop = 0, n % sequence or sequence
                piece = 0
                while start < n:
                    crc = zlib.crc32(data[start:stop])
                    rows.append((key, piece, start, stop - start, crc, task, made[stop - start]))
                    made[stop - start] += 1
                    piece, start, stop = piece + 1, stop, stop + sequence
            out = pd.DataFrame(rows, columns=[c.split()[0] for c in PIECES.split(", ")])
            yield out.astype({"doc_id": "Int64"})

    return docs.select(
        F.col(doc_id).cast("long").alias("doc_id"), whole_text(F.col(text)).alias("text")
    ).mapInPandas(cut, PIECES)


def _knapsack(prices: np.ndarray, lengths: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Best total price for each capacity, and the index of the last length taken (-1: none)."""
    best, last = np.zeros(size + 1), np.full(size + 1, -1)
    for room in range(1, size + 1):
        fits = np.searchsorted(lengths, room, side="right")
        best[room], last[room] = best[room - 1], -1
        if fits:
            value = best[room - lengths[:fits]] + prices[:fits]
            k = int(value.argmax())
            if value[k] > best[room]:
                best[room], last[room] = value[k], k
    return best, last


def _configuration(first: int, last: np.ndarray, lengths: np.ndarray, size: int) -> dict[int, int]:
    """The best configuration that holds length ``first``: index of length -> number."""
    config, room = {first: 1}, size - int(lengths[first])
    while room > 0:
        k = int(last[room])
        if k < 0:
            room -= 1
            continue
        config[k] = config.get(k, 0) + 1
        room -= int(lengths[k])
    return config


def _multiplicative_weights(
    lengths: np.ndarray, need: np.ndarray, size: int
) -> list[tuple[dict[int, int], float]]:
    """Configurations and fractional amounts that about cover ``need``."""
    covered = np.zeros(len(lengths))
    amounts: dict[tuple, float] = {}
    for _ in range(UPDATES):
        # At a perfect packing a token's price is the same in all lengths; that is the start.
        prices = lengths / size * np.exp(-RATE * covered / need)
        best, last = _knapsack(prices, lengths, size)
        value = prices + best[size - lengths]
        for first in np.flatnonzero((value >= (1 - SLACK) * value.max()) & (covered < need)):
            config = _configuration(int(first), last, lengths, size)
            keys, counts = np.array([*config]), np.array([*config.values()])
            step = float(np.min(np.maximum(need[keys] - covered[keys], need[keys] / UPDATES) / counts))
            step = min(step, float(np.min(need[keys] / counts)) / 4)
            covered[keys] += step * counts
            key = tuple(sorted(config.items()))
            amounts[key] = amounts.get(key, 0.0) + step
        if (covered >= need).all():
            break
    return [(dict(k), v) for k, v in sorted(amounts.items(), key=lambda kv: -kv[1])]


def plan_sequences(histogram: dict[int, int], size: int = SEQUENCE) -> list[tuple[dict[int, int], int]]:
    """Configurations (length -> number) and how many sequences take each; all pieces are placed."""
    left = {int(n): int(c) for n, c in histogram.items() if c}
    plan: list[tuple[dict[int, int], int]] = []

    def take(config: dict[int, int], times: int) -> None:
        times = min(times, *(left.get(n, 0) // a for n, a in config.items()))
        if times > 0:
            plan.append((config, times))
            for n, a in config.items():
                left[n] -= a * times
                if not left[n]:
                    del left[n]

    take({size: 1}, left.get(size, 0)) if size in left else None
    for _ in range(ROUNDS):
        if not left:
            break
        lengths = np.array(sorted(left))
        need = np.array([left[n] for n in lengths], dtype=float)
        for config, amount in _multiplicative_weights(lengths, need, size):
            take({int(lengths[k]): a for k, a in config.items()}, int(amount))
    while left:
        order = np.array(sorted(left))
        config, room, rest = {}, size, dict(left)
        while True:
            k = int(np.searchsorted(order, room, side="right")) - 1
            while k >= 0 and not rest[int(order[k])]:
                k -= 1
            if k < 0:
                break
            n = int(order[k])
            times = min(rest[n], room // n) if config else 1
            config[n] = config.get(n, 0) + times
            rest[n] -= times
            room -= n * times
        take(config, min(left[n] // a for n, a in config.items()))
    return plan


def _runs(plan: list[tuple[dict[int, int], int]]) -> pd.DataFrame:
    """A row for each length of a configuration: its pieces' numbers, sequences and offset."""
    used: dict[int, int] = {}
    rows, base = [], 0
    for config, times in plan:
        offset = 0
        for n, a in sorted(config.items(), reverse=True):
            rows.append((n, used.get(n, 0), base, times, offset))
            used[n] = used.get(n, 0) + a * times
            offset += n * a
        base += times
    runs = pd.DataFrame(rows, columns=["length", "first", "base", "times", "offset"], dtype="int64")
    return runs.sort_values(["length", "first"], ignore_index=True)


def pack(
    docs: DataFrame, tokenizer: str, sequence: int = SEQUENCE, text: str = "text", doc_id: str = "doc_id"
) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset) for every piece."""
    cut = stored(pieces(docs, tokenizer, sequence, text, doc_id), "pieces")
    made = stored(cut.groupBy("task", "length").agg(F.count("*").alias("n")), "made")
    histogram = {r.length: r.n for r in made.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    runs = docs.sparkSession.sparkContext.broadcast(_runs(plan_sequences(histogram, sequence)))
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    starts = made.select(
        "task", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before")
    )

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        table = runs.value
        # One sorted key of (length, number); numbers stay far below 2**48.
        keys = (table["length"].to_numpy() << 48) + table["first"].to_numpy()
        for batch in batches:
            length = batch["length"].to_numpy()
            number = batch["before"].to_numpy() + batch["number"].to_numpy()
            k = np.searchsorted(keys, (length << 48) + number, side="right") - 1
            of, times = number - table["first"].to_numpy()[k], table["times"].to_numpy()[k]
            out = batch[["doc_id", "piece", "start", "length", "ids_crc32"]].copy()
            out["sequence_id"] = table["base"].to_numpy()[k] + of % times
            out["offset"] = table["offset"].to_numpy()[k] + of // times * length
            yield out.astype({"doc_id": "Int64"})

    # ``starts`` grows with the tasks, so it is not to be broadcast.
    return cut.join(starts.hint("merge"), ["task", "length"]).mapInPandas(
        place,
        "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long",
    )
