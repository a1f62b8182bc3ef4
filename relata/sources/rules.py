"""Rule documents: JSON (or YAML where a YAML reader is installed) to rules."""

from __future__ import annotations

import json
from dataclasses import dataclass, field
from importlib import resources

from pyspark.sql import SparkSession

RULE_SCHEMA = (
    "rule_id string, dimension string, severity string, failure_action string, "
    "kind string, rule_column string, expression string, options string"
)

#: document key -> kind
EXPECTATIONS = {
    "nonNullExpectation": "nonNull",
    "uniquenessExpectation": "uniqueness",
    "rowConditionExpectation": "rowCondition",
    "tableConditionExpectation": "tableCondition",
    "countBetweenExpectation": "countBetween",
    "equalsExpectation": "equals",
    "parsableExpectation": "parsable",
    "duplicatesAtMostExpectation": "duplicatesAtMost",
}


@dataclass(frozen=True)
class ScanRule:
    rule_id: str
    kind: str
    column: str | None = None
    expression: str | None = None
    dimension: str = "VALIDITY"
    severity: str = "MEDIUM"
    failure_action: str = "ALERT_ONLY"
    options: dict = field(default_factory=dict)

    def as_row(self) -> tuple:
        return (
            self.rule_id,
            self.dimension,
            self.severity,
            self.failure_action,
            self.kind,
            self.column,
            self.expression,
            json.dumps(self.options, sort_keys=True),
        )


@dataclass(frozen=True)
class RuleSet:
    sampling_percent: float
    rules: tuple[ScanRule, ...]


def rules_from_document(document: dict) -> RuleSet:
    spec = document["dataQualitySpec"]
    rules = []
    for entry in spec["rules"]:
        named = [key for key in EXPECTATIONS if key in entry]
        if len(named) != 1:
            raise ValueError(f"rule {entry.get('ruleId')}: exactly one expectation is needed, found {named}")
        options = dict(entry[named[0]] or {})
        expression = options.pop("sqlExpression", None)
        rules.append(
            ScanRule(
                rule_id=entry["ruleId"],
                kind=EXPECTATIONS[named[0]],
                column=entry.get("column"),
                expression=expression,
                dimension=entry.get("dimension", "VALIDITY"),
                severity=entry.get("severity", "MEDIUM"),
                failure_action=entry.get("failureAction", "ALERT_ONLY"),
                options=options,
            )
        )
    return RuleSet(float(spec.get("samplingPercent", 100)), tuple(rules))


def parse_rules(text: str, path: str = "") -> RuleSet:
    if path.endswith((".yaml", ".yml")):
        try:
            import yaml
        except ImportError as error:  # pragma: no cover - depends on the image
            raise RuntimeError("reading YAML rule documents needs a YAML package; use JSON instead") from error
        return rules_from_document(next(yaml.safe_load_all(text)))
    return rules_from_document(json.loads(text))


def load_rules(spark: SparkSession, path: str) -> RuleSet:
    rows = spark.read.text(path, wholetext=True).take(1)
    return parse_rules(rows[0].value, path)


def built_in_rules(name: str) -> RuleSet:
    """One of the shipped rule sets: user_360, audience, staging_sales, staging_users."""
    return parse_rules(resources.files("relata.rules").joinpath(f"{name}.json").read_text("utf-8"))
