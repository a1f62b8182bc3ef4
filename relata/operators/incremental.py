"""Rule scans of a growing table that read what changed: mergeable states of each slice, kept as a table.

A sliced table (``sinks.tables``) names the immutable folders of each slice. The state of a slice under a rule set is its row
count, the rows each row rule passes, the values of the aggregates that table rules use, and the row counts of the keys of
uniqueness rules. States are stored with a mark of the slice's folders and of each rule. A scan evaluates the slices without
such a state, all in one pass, and merges: counts are added, extremes compared, keys counted over slices. So new,
replaced and appended slices are read again, dropped ones are left out, and the result is that of a scan of everything.

The states of row and table rules are a few rows per slice; those of uniqueness rules are as many as the slice has keys.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F

from relata.functions.records import instant
from relata.operators.quality import _union
from relata.operators.scans import GROUP_KINDS, ROW_KINDS, _bind, _group_result, _group_rows, _missing, _result, _row_pass
from relata.operators.joins import never_null
from relata.sinks.tables import DEFAULT_PARTITION, Layers
from relata.sources.rules import ScanRule

#: The aggregates of one column, or of all rows, that table rules may combine.
CALLS = re.compile(r"\b(max|min|sum|count)\(\s*(\*|[A-Za-z_]\w*)\s*\)", re.IGNORECASE)
#: How states of an aggregate are merged.
MERGED = {"max": F.max, "min": F.min, "sum": F.sum, "count": F.sum}

STATE = "slice string, mark string, rule string, rows bigint, passed bigint, held map<string,string>"
KEYS = "slice string, mark string, rule string, key array<string>, rows bigint"


class NotMergeable(ValueError):
    """A rule whose result for a table does not follow from its results for slices."""


def definition(rule: ScanRule) -> str:
    return hashlib.sha256(json.dumps(rule.as_row()).encode()).hexdigest()


def _calls(rule: ScanRule) -> dict[str, tuple[str, str]]:
    """The aggregates of a table rule, by the text of the call: function and argument."""
    return {match.group(0): (match.group(1).lower(), match.group(2)) for match in CALLS.finditer(rule.expression or "")}


class IncrementalScan:
    """Scans of ``table`` (layer and name), sliced by ``column``, with states in ``states`` (layer and name).

    The slice column holds dates, numbers or plain names, as they are folder names.
    """

    def __init__(self, layers: Layers, table: tuple[str, str], column: str, states: tuple[str, str], rules: Sequence[ScanRule]) -> None:
        self.layers, self.table, self.column, self.rules = layers, table, column, list(rules)
        self.states, self.keys = states, (states[0], f"{states[1]}_keys")
        for name, schema in ((self.states, STATE), (self.keys, KEYS)):
            layers.ensure(*name, schema)

    def _marks(self) -> dict[str, str]:
        """A mark of the current folders and rules for each slice of the table."""
        rules = ",".join(sorted(definition(rule) for rule in self.rules))
        folders: dict[str, list[str]] = {}
        for name, held in self.layers.log(*self.table).state().current.items():
            folders.setdefault(name.split("/")[0], []).extend(held)
        return {name: hashlib.sha256(f"{rules};{','.join(sorted(held))}".encode()).hexdigest() for name, held in folders.items()}

    def stale(self) -> dict[str, str]:
        """The slices whose state is missing or of other folders or rules, with the mark it should have."""
        known = self.layers.read(*self.states).select("slice", "mark").distinct()
        held = {(row[0], row[1]) for row in known.collect()}
        return {name: mark for name, mark in self._marks().items() if (name, mark) not in held}

    def _rows(self, names: Sequence[str]) -> DataFrame:
        rows = self.layers.read(*self.table, under=names)
        value = F.coalesce(F.col(self.column).cast("string"), F.lit(DEFAULT_PARTITION))
        return rows.withColumn("_slice", F.concat(F.lit(f"{self.column}="), value))

    def _reason(self, rule: ScanRule, rows: DataFrame, as_of: datetime) -> str | None:
        """Why a rule cannot be evaluated on a table of these columns."""
        if rule.kind in GROUP_KINDS:
            where = rule.options.get("where")
            return _missing(rows, lambda: where and rows.select(F.expr(where))) or _missing(rows, lambda: _group_rows(rule, rows))
        if rule.kind in ROW_KINDS:
            if ":as_of" in (rule.expression or ""):
                raise NotMergeable(f"{rule.rule_id} compares rows with the time of the scan")
            return _missing(rows, lambda: rows.select(_row_pass(rule, rows, as_of)))
        return _missing(rows, lambda: rows.agg(*[F.expr(call).alias(f"a{i}") for i, call in enumerate(_calls(rule))], F.count(F.lit(1))))

    def update(self, as_of: datetime) -> list[str]:
        """Evaluate the slices without a current state, in one pass over them; returns their names."""
        stale = self.stale()
        if not stale:
            return []
        rows = self._rows(list(stale))
        usable = [rule for rule in self.rules if self._reason(rule, rows, as_of) is None]
        counted, outcomes = [F.count(F.lit(1)).alias("_total")], [_state("", F.col("_total"), F.lit(None), {})]
        for i, rule in enumerate(usable):
            if rule.kind in ROW_KINDS:
                counted.append(F.count_if(_row_pass(rule, rows, as_of)).alias(f"_r{i}"))
                outcomes.append(_state(rule.rule_id, F.col("_total"), F.col(f"_r{i}"), {}))
            elif rule.kind not in GROUP_KINDS:
                calls = {call: f"_r{i}_{n}" for n, call in enumerate(_calls(rule))}
                counted += [F.expr(call).cast("string").alias(name) for call, name in calls.items()]
                outcomes.append(_state(rule.rule_id, F.col("_total"), F.lit(None), {call: F.col(name) for call, name in calls.items()}))
        marks = F.create_map(*[F.lit(part) for pair in stale.items() for part in pair])
        slices = [{"slice": name} for name in stale]
        # Keys first: the states say that a slice is done.
        groups = [rule for rule in usable if rule.kind in GROUP_KINDS]
        if groups:
            parts = []
            for rule in groups:
                keys = rule.options.get("keys") or [rule.column]
                grouped = _group_rows(rule, rows, ["_slice"])
                key = F.array(*[F.col(name).cast("string") for name in keys])
                parts.append(grouped.select(F.col("_slice").alias("slice"), marks[F.col("_slice")].alias("mark"), F.lit(rule.rule_id).alias("rule"), key.alias("key"), F.col("_rows").alias("rows")))
            self.layers.replace_slices(_union(parts), *self.keys, slices)
        states = rows.groupBy("_slice").agg(*counted).select("_slice", F.inline(F.array(*outcomes)))
        states = states.select(F.col("_slice").alias("slice"), marks[F.col("_slice")].alias("mark"), "rule", "rows", "passed", "held")
        self.layers.replace_slices(states, *self.states, slices)
        return sorted(stale)

    def _current(self, name: tuple[str, str], marks: dict[str, str]) -> DataFrame:
        """The stored states of the slices that the table has now."""
        held = self.layers.read(*name)
        return held.where(F.col("mark").isin(list(marks.values())) & F.col("slice").isin(list(marks)))

    def scan(self, scan_id: str, as_of: datetime) -> DataFrame:
        """The result rows of the rule set over the whole table, after an update."""
        self.update(as_of)
        marks = self._marks()
        states = self._current(self.states, marks)
        rows = self._rows(list(marks))
        merged, outcomes, grouped = [F.coalesce(F.sum(F.when(F.col("rule") == "", F.col("rows"))), F.lit(0)).alias("_total")], [], []
        total = F.col("_total")
        for i, rule in enumerate(self.rules):
            reason, own = self._reason(rule, rows, as_of), F.col("rule") == rule.rule_id
            if reason is not None:
                outcomes.append(_result(rule, F.lit(False), total, None, reason))
            elif rule.kind in GROUP_KINDS:
                keys = self._current(self.keys, marks).where(own).groupBy("key").agg(F.sum("rows").alias("_rows"))
                grouped.append(_group_result(rule, keys))
            elif rule.kind in ROW_KINDS:
                merged.append(F.coalesce(F.sum(F.when(own, F.col("passed"))), F.lit(0)).alias(f"_r{i}"))
                outcomes.append(_result(rule, F.col(f"_r{i}") == total, total, F.col(f"_r{i}"), None))
            elif rule.kind == "countBetween":
                outcomes.append(_result(rule, (total >= rule.options["min"]) & (total <= rule.options["max"]), total, None, None))
            else:
                condition = rule.expression
                for n, (call, (function, _)) in enumerate(_calls(rule).items()):
                    kind = rows.select(F.expr(call)).schema[0].dataType
                    merged.append(MERGED[function](F.when(own, F.col("held")[call]).cast(kind)).alias(f"_r{i}_{n}"))
                    condition = condition.replace(call, f"_r{i}_{n}")
                outcomes.append(_result(rule, never_null(F.expr(_bind(condition, as_of))), total, None, None))
        parts = list(grouped)
        if outcomes:
            one = states.agg(*merged)
            if reason := _missing(one, lambda: one.select(*outcomes)):
                raise NotMergeable(f"a table rule of {scan_id} uses more than simple aggregates: {reason}")
            parts.insert(0, one.select(F.inline(F.array(*outcomes))))
        return _union(parts).select(F.lit(scan_id).alias("scan_id"), "*", instant(as_of).alias("job_start_time"))


def _state(rule: str, rows: Column, passed: Column, held: dict[str, Column]) -> Column:
    values = F.create_map(*[part for call, value in held.items() for part in (F.lit(call), value)]) if held else F.create_map()
    return F.struct(
        F.lit(rule).alias("rule"), rows.cast("bigint").alias("rows"), passed.cast("bigint").alias("passed"), values.cast("map<string,string>").alias("held")
    )
