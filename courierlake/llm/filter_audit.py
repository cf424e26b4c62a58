"""What each filter of a chain removes, in every order the chain could have.

Five filters, by the condition on which a document fails: A has under 50 words; B has fewer than 65
different words in 100 (case-sensitive); C has more than 5 capitals ``[A-Z]`` in 100 code points; D holds
any of ``#$%&*|``; E has the text of a smaller ``doc_id``, anywhere in the table, removed or not.

1. *Facts.* One pass over the texts gives each document's failures of A to D and its text's SHA-256. The
   smallest id of each text (combined in the map tasks, so copies cost one row each) is joined back by text
   and id, a key that is as rare as repeated ids are: who meets it passes E, the others fail.
2. *Counts.* Documents are counted by part and failures, all, those of good quality and toxic ones: at most
   32 rows for each part, however many documents it has.
3. *Tensors.* A part's counts are reshaped to 2x2x2x2x2, pass or fail along each axis. For every step of
   every order one ``einsum`` contracts all tensors of a batch with a vector for each axis, which selects pass,
   fail or all. Parts are spread over tasks; a task holds ``BATCH`` parts at once.

Defined results: null text counts as empty (fails A, passes B, C and D); a null ``doc_id`` counts as larger
than all others; rows that repeat id and text are copies of none of each other; a null or empty part is
the empty string; documents without a label, and labels that are null, are neither good nor toxic, and
of several labels of an id any that says so counts; an empty table gives no row; further columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from courierlake.llm.common import stored, whole_text

FILTERS = "ABCDE"
LEAST_WORDS = 50
LEAST_DIFFERENT = 65
MOST_CAPITALS = 5
#: Parts whose tensors are contracted together.
BATCH = 256

MEASURES = ("n", "good", "toxic")
_BLANKS = "[\\x20\\x09-\\x0D]++"
_PASS, _FAIL, _ALL = (1, 0), (0, 1), (1, 1)

AUDIT = (
    "part string, filter_order string, step int, kept long, removed long, redundant long,"
    " unique_fails long, good_lost long, toxic_lost long, shapley long"
)


def failures(text: Column) -> dict[str, Column]:
    """Whether a text fails A, B, C and D."""
    text = whole_text(text)
    words = F.array_remove(F.split(text, _BLANKS), "")
    return {
        "A": F.size(words) < LEAST_WORDS,
        "B": 100 * F.size(F.array_distinct(words)) < LEAST_DIFFERENT * F.size(words),
        "C": 100 * F.regexp_count(text, F.lit("[A-Z]")).cast("long") > MOST_CAPITALS * F.char_length(text),
        "D": text.rlike("[#$%&*|]"),
    }


def facts(docs: DataFrame) -> DataFrame:
    """(doc_id, part, failed) for every row; bit k of ``failed`` is the filter ``FILTERS[k]``."""
    own = failures(F.col("text"))
    bits = sum((own[f].cast("int") * (1 << k) for k, f in enumerate("ABCD")), F.lit(0))
    rows = stored(
        docs.select(
            F.col("doc_id").cast("long").alias("doc_id"),
            F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part"),
            bits.alias("failed"),
            F.unhex(F.sha2(whole_text(F.col("text")), 256)).alias("sha"),
        ),
        "facts",
    )
    # The smallest id of a text; null only where no row of it has one.
    first = rows.groupBy(F.col("sha").alias("of")).agg(F.min("doc_id").alias("first"))
    same = (F.col("sha") == F.col("of")) & F.col("doc_id").eqNullSafe(F.col("first"))
    copy = F.when(F.col("of").isNull(), 1 << FILTERS.index("E")).otherwise(0)
    return rows.join(first, same, "left").select("doc_id", "part", (F.col("failed") + copy).alias("failed"))


def counts(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, failed, n, good, toxic): documents by part and by the filters they fail."""
    known = labels.groupBy(F.col("doc_id").cast("long").alias("__id")).agg(
        F.max((F.col("quality") == 1).cast("int")).alias("good"),
        F.max((F.col("toxic") == 1).cast("int")).alias("toxic"),
    )
    return (
        facts(docs)
        .join(known, F.col("doc_id") == F.col("__id"), "left")
        .groupBy("part", "failed")
        .agg(
            F.count("*").alias("n"),
            F.coalesce(F.sum("good"), F.lit(0)).alias("good"),
            F.coalesce(F.sum("toxic"), F.lit(0)).alias("toxic"),
        )
    )


def orders() -> list[str]:
    return ["".join(p) for p in permutations(FILTERS)]


def contract(tensors: np.ndarray, choices: list[list[tuple[int, int]]]) -> np.ndarray:
    """Sums over the cells that the choices select: (tensors, measures, choices)."""
    picked = np.array(choices, dtype=np.int64)
    axes = [picked[:, k] for k in range(len(FILTERS))]
    return np.einsum("pmabcde,sa,sb,sc,sd,se->pms", tensors, *axes, optimize="greedy")


def _step(done: str, now: str, here: tuple[int, int]) -> list[tuple[int, int]]:
    """Pass along the axes of ``done``, ``here`` along that of ``now``, all along the others."""
    return [here if f == now else _PASS if f in done else _ALL for f in FILTERS]


def _steps() -> tuple[list[str], list[int], np.ndarray]:
    named = [order for order in orders() for _ in FILTERS]
    step = [k for _ in orders() for k in range(1, len(FILTERS) + 1)]
    now = np.array([FILTERS.index(o[k - 1]) for o, k in zip(named, step, strict=True)])
    return named, step, now


def audits(parts: list[str], tensors: np.ndarray) -> pd.DataFrame:
    """All orders and steps of some parts; ``tensors`` is (parts, measures, 2, 2, 2, 2, 2)."""
    named, step, now = _steps()
    kept, removed, failing, alone = (
        contract(tensors, choices)
        for choices in (
            [_step(o[: k - 1], o[k - 1], _PASS) for o, k in zip(named, step, strict=True)],
            [_step(o[: k - 1], o[k - 1], _FAIL) for o, k in zip(named, step, strict=True)],
            [_step("", f, _FAIL) for f in FILTERS],
            [_step(FILTERS.replace(f, ""), f, _FAIL) for f in FILTERS],
        )
    )
    n, good, toxic = range(len(MEASURES))
    shapley = np.stack([removed[:, n, now == k].sum(axis=1) for k in range(len(FILTERS))], axis=1)
    columns = {
        "kept": kept[:, n],
        "removed": removed[:, n],
        "redundant": failing[:, n][:, now] - removed[:, n],
        "unique_fails": alone[:, n][:, now],
        "good_lost": removed[:, good],
        "toxic_lost": removed[:, toxic],
        "shapley": shapley[:, now],
    }
    return pd.DataFrame(
        {
            "part": np.repeat(np.array(parts, dtype=object), len(named)),
            "filter_order": named * len(parts),
            "step": np.tile(np.array(step, dtype=np.int32), len(parts)),
            **{name: values.reshape(-1) for name, values in columns.items()},
        }
    )


def _contracted(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        for at in range(0, len(frame), BATCH):
            rows = frame.iloc[at : at + BATCH]
            cells = np.zeros((len(rows), len(MEASURES), 1 << len(FILTERS)), dtype=np.int64)
            for k, counted in enumerate(rows["cells"]):
                for cell in counted:
                    cells[k, :, cell["failed"]] = [cell[m] for m in MEASURES]
            # Bit 0, filter A, changes fastest in a cell's number: it is the last axis before the turn.
            tensors = cells.reshape(len(rows), len(MEASURES), *[2] * len(FILTERS))
            turned = tensors.transpose(0, 1, *range(len(FILTERS) + 1, 1, -1))
            yield audits(rows["part"].tolist(), turned)


def filter_audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """A row for each part, order of the filters and step."""
    cells = (
        counts(docs, labels)
        .groupBy("part")
        .agg(F.collect_list(F.struct("failed", *MEASURES)).alias("cells"))  # 32 of them at most
    )
    return cells.mapInPandas(_contracted, AUDIT)
