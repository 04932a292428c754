"""A running state over ordered rows, by composing functions of a few states.

Each row has a symbol; a rule says which state follows from a state and a
symbol. A run of rows is then a function from states to states: runs are
summed up apart, their functions composed from the left, and each row's state
read off within its run. Nothing leaves built-in expressions, and no run is
longer than ``RUN`` rows.
"""

from __future__ import annotations

from collections.abc import Callable
from itertools import product

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

RUN = 64


class Machine:
    """States and symbols as dicts of flags, and the rule between them; all are numbered in the order of their values."""

    def __init__(self, states: list[dict], flags: dict[str, list], rule: Callable[[dict, dict], dict]) -> None:
        self.states, self.flags = states, flags
        self.symbols = [dict(zip(flags, values, strict=True)) for values in product(*flags.values())]
        self.table = [states.index(rule(state, symbol)) for symbol in self.symbols for state in states]

    def symbol(self, **given: Column) -> Column:
        """The number of the symbol with these values, a column for each flag."""
        out = F.lit(0)
        for name, values in self.flags.items():
            at = F.coalesce(*[F.when(given[name] == F.lit(v), F.lit(i)) for i, v in enumerate(values)], F.lit(0))
            out = out * len(values) + at
        return out.cast("int")

    def flag(self, state: Column, name: str) -> Column:
        """What a state's flag is."""
        return F.get(F.array(*[F.lit(s[name]) for s in self.states]), state)

    def before(self, rows: DataFrame, keys: list[str], order: list[str], symbol: str, name: str = "state") -> DataFrame:
        """``rows`` with the state that each finds, all rows of the keys taken in order from the first state on."""
        step = F.split(F.lit(" ".join(map(str, self.table))), " ").cast("array<int>")
        follow = lambda s, x: F.get(step, x * len(self.states) + s)
        line, run, at = "__line", "__run", "__at"
        numbered = rows.withColumn(line, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)) - 1)
        numbered = numbered.withColumns({run: F.floor(F.col(line) / RUN), at: (F.col(line) % RUN).cast("int")})
        runs = numbered.groupBy(*keys, run).agg(F.transform(F.array_sort(F.collect_list(F.struct(at, symbol))), lambda r: r[symbol]).alias("__symbols"))
        whole = [F.aggregate("__symbols", F.lit(s), follow) for s in range(len(self.states))]
        runs = runs.withColumn("__whole", F.array(*whole))
        earlier = F.transform(F.array_sort(F.collect_list(F.struct(run, "__whole")).over(Window.partitionBy(*keys))), lambda r: r["__whole"])
        entered = F.aggregate(F.slice(earlier, 1, F.col(run).cast("int")), F.lit(0), lambda s, f: F.get(f, s))
        runs = runs.withColumn("__entered", entered).drop("__whole")
        found = F.aggregate(F.slice("__symbols", 1, F.col(at)), F.col("__entered"), follow)
        return numbered.join(runs, [*keys, run]).withColumn(name, found).drop(line, run, at, "__symbols", "__entered")
