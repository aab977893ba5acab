"""Which rule applies to which file.

All patterns of the rules become one automaton (Aho and Corasick's), packed into arrays of one row, and a fold over the
characters of a name walks it once. So the work per name follows its length, whatever the number of rules, no
rule is joined with a name, and nothing is measured while the plan is built.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_AUTOMATON = "letters array<int>, width int, steps array<int>, found array<int>"


def automaton(patterns: Sequence[str]) -> tuple[list[int], int, np.ndarray, np.ndarray]:
    """(letters, width, steps, found) of the patterns in their order.

    `letters[c]` is the class of the character c, 0 for one that no pattern has; characters beyond the end have
    class 0 as well. `steps[state * width + class]` is the next state, `found[state]` the last of the patterns that
    end where the state is reached, -1 for none.
    """
    points = sorted({ord(c) for p in patterns for c in p})
    letters = [0] * (points[-1] + 1 if points else 0)
    for k, c in enumerate(points, 1):
        letters[c] = k
    width = len(points) + 1
    tree: list[dict[int, int]] = [{}]
    found = [-1]
    for number, pattern in enumerate(patterns):
        state = 0
        for c in pattern:
            state = tree[state].setdefault(letters[ord(c)], len(tree))
            if state == len(tree):
                tree.append({})
                found.append(-1)
        found[state] = number
    steps = np.zeros((len(tree), width), np.int32)
    fall = [0] * len(tree)
    queue = deque([0])
    while queue:
        state = queue.popleft()
        # What isn't in the tree goes on as from the longest suffix, which is complete by now.
        steps[state] = steps[fall[state]] if state else 0
        for letter, child in tree[state].items():
            fall[child] = int(steps[state, letter])
            steps[state, letter] = child
            queue.append(child)
        found[state] = max(found[state], found[fall[state]])
    return letters, width, steps.reshape(-1), np.array(found, np.int32)


def packed_rules(rules: DataFrame, pattern: str) -> DataFrame:
    """One row: the automaton over the patterns in the order of `line_no`, and the rules in that order."""
    listed = F.sort_array(F.collect_list(F.struct("line_no", *[c for c in rules.columns if c != "line_no"])))
    whole = rules.where(F.col(pattern).isNotNull()).agg(listed.alias("rules")).withColumn("patterns", F.col(f"rules.{pattern}"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            letters, width, steps, found = automaton(batch.column("patterns")[0].as_py())  # there is one row
            lists = [pa.array([x], pa.list_(pa.int32())) for x in (letters, steps, found)]
            made = [batch.column("rules"), lists[0], pa.array([width], pa.int32()), *lists[1:]]
            yield pa.RecordBatch.from_arrays(made, ["rules", "letters", "width", "steps", "found"])

    kind = T.StructType([whole.schema["rules"], *T.StructType.fromDDL(_AUTOMATON).fields])
    return whole.mapInArrow(run, kind)


def last_match(name: Column, machine: Column) -> Column:
    """The number of the last pattern that occurs in the lower-cased name, -1 for none; null for no name."""

    def walk(lowered: Column) -> Column:
        def step(state: Column, at: Column) -> Column:
            letter = F.coalesce(F.get(machine["letters"], F.ascii(F.substr(lowered, at, F.lit(1)))), F.lit(0))
            there = F.get(machine["steps"], state["at"] * machine["width"] + letter)
            return F.struct(there.alias("at"), F.greatest(state["best"], F.get(machine["found"], there)).alias("best"))

        places = F.when(F.length(lowered) > 0, F.sequence(F.lit(1), F.length(lowered))).otherwise(F.array().cast("array<int>"))
        start = F.struct(F.lit(0).alias("at"), F.get(machine["found"], F.lit(0)).alias("best"))
        return F.aggregate(places, start, step, lambda state: state["best"])

    # The lambda holds the lower-cased name, so that it is made once.
    return F.when(name.isNotNull(), F.transform(F.array(F.lower(name)), walk)[0])


def route_files(files: DataFrame, rules: DataFrame, name: str = "file_name", pattern: str = "table_name") -> DataFrame:
    """Add the last rule whose pattern occurs in the lower-cased file name; nulls where there is none.

    `rules` has a `line_no` column, the highest one wins. The table of rules is configuration: it travels as one row.
    """
    row = packed_rules(rules, pattern)
    known = files.withColumn("_rules", row.select(F.struct(*row.columns)).scalar())
    chosen = known.withColumn("_rule", F.get(F.col("_rules.rules"), F.nullif(last_match(F.col(name), F.col("_rules")), F.lit(-1))))
    others = [c for c in files.columns if c != name]
    return chosen.select(name, *others, *[F.col("_rule")[c].alias(c) for c in rules.columns])
