"""From an audience to campaign members: who is eligible, whom the row means, what is new."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

from relata.functions.text import contact_name, lower_trimmed
from relata.operators.audience import EMAIL_CONSENT, PARTNER_OPT_IN, PASSED, READY
from relata.operators.dedupe import first_per_key
from relata.operators.joins import apart, unmatched
from relata.operators.paging import AUDIENCE_ORDER, page

# Field names and texts of the member interface.
CONTACT_ID, LEAD_ID = "ContactId", "LeadId"
DEFAULT_MEMBER_STATUS = "Sent"
LEAD_COMPANY = "Partner Lead"
LEAD_SOURCE = "Partner Referral"
NO_TARGET = "No Salesforce Contact or Lead found"
ALREADY_PUSHED = "Skipped because a successful non-dry-run execution already exists."
SUCCESS, FAILED = "SUCCESS", "FAILED"

#: Begins the member id of a person that does not exist yet.
BY_EMAIL = "email:"

CREATED, SKIPPED_EXISTING, FAILED_NO_TARGET = "created", "skipped_existing", "failed"

PUSH_RUN_SCHEMA = (
    "run_date date, campaign_id string, started_at timestamp, completed_at timestamp, status string, "
    "records_processed bigint, is_dry_run boolean, error_message string"
)

#: Columns older audiences may lack, with the default a missing column stands for.
OPTIONAL_COLUMNS = {
    "salesforce_contact_id": ("string", None),
    "activation_status": ("string", READY),
    "quality_gate_status": ("string", PASSED),
}


def columns_of(df: DataFrame) -> set[str]:
    return set(df.columns)


def evolve(df: DataFrame, defaults: Mapping[str, tuple[str, object]]) -> DataFrame:
    """Add missing columns with their default; fill NULLs of present ones with it."""
    present = columns_of(df)
    changes = {}
    for name, (kind, default) in defaults.items():
        value = F.lit(default).cast(kind)
        changes[name] = F.coalesce(F.col(name), value) if name in present else value
    return df.withColumns(changes)


def eligible(audience: DataFrame, run_date: str) -> DataFrame:
    """Rows of the run date with a known consent that passed the gate and are ready.

    A status column only filters where the audience has it; NULL in it is not ready.
    """
    present = columns_of(audience)
    rows = audience.where(
        (F.col("run_date") == F.lit(run_date).cast("date"))
        & F.col("consent_status").isin(EMAIL_CONSENT, PARTNER_OPT_IN)
    )
    for name, wanted in (("quality_gate_status", PASSED), ("activation_status", READY)):
        if name in present:
            rows = rows.where(F.col(name) == wanted)
    missing = {name: rule for name, rule in OPTIONAL_COLUMNS.items() if name not in present}
    return evolve(rows, missing).select(
        "run_date",
        "user_id",
        "lead_email",
        "salesforce_contact_id",
        "segment_name",
        "score",
        "consent_status",
        "activation_status",
        "quality_gate_status",
    )


def eligible_page(audience: DataFrame, run_date: str, limit: int = 0, offset: int = 0) -> DataFrame:
    return page(eligible(audience, run_date), AUDIENCE_ORDER, limit, offset)


def previous_success(audit: DataFrame, run_date: str, campaign_id: str) -> DataFrame:
    return audit.where(
        (F.col("run_date") == F.lit(run_date).cast("date"))
        & (F.col("campaign_id") == campaign_id)
        & (F.col("status") == SUCCESS)
        & ~F.col("is_dry_run")
    )


def pushed_verdict(audit: DataFrame, run_date: str, campaign_id: str) -> DataFrame:
    """One row: was this campaign already pushed for the run date, dry runs apart?"""
    return previous_success(audit, run_date, campaign_id).agg(F.count(F.lit(1)).alias("successful_runs")).select(
        (F.col("successful_runs") > 0).alias("already_pushed"), "successful_runs"
    )


def already_pushed(audit: DataFrame, run_date: str, campaign_id: str) -> bool:
    return bool(previous_success(audit, run_date, campaign_id).take(1))


def payloads(rows: DataFrame, campaign_id: str) -> DataFrame:
    """Dry-run payloads as JSON text."""
    fields = F.struct(
        F.lit(campaign_id).alias("CampaignId"),
        F.col("lead_email").alias("Email"),
        F.col("segment_name").alias("Segment"),
        F.col("score").alias("Score"),
        F.col("user_id").alias("UserId"),
        F.col("salesforce_contact_id").alias("ContactId"),
    )
    return rows.select(F.to_json(fields, {"ignoreNullFields": "false"}).alias("payload"))


def _directory(contacts: DataFrame, leads: DataFrame) -> DataFrame:
    """One row per normalised e-mail: the lowest contact id and the lowest lead id, where several match."""
    none = F.lit(None).cast("string")
    email = lower_trimmed("email").alias("_email")
    both = contacts.select(email, F.col("id").alias("_contact"), none.alias("_lead")).unionByName(
        leads.select(email, none.alias("_contact"), F.col("id").alias("_lead"))
    )
    known = both.where(F.col("_email") != "").groupBy(*apart("_email"))
    return known.agg(F.min("_contact").alias("_contact"), F.min("_lead").alias("_lead")).drop("_apart")


def resolve_targets(audience: DataFrame, contacts: DataFrame, leads: DataFrame) -> DataFrame:
    """``id_field`` and ``member_id`` of each row: own contact id, else contact, else lead by e-mail.

    Both directories are one table with one row per address, so rows never multiply and one join does; a hot address of
    the audience, or the NULL one, is on the left of two plain shuffles, where adaptive execution can split it.
    """
    own = F.nullif(F.col("salesforce_contact_id"), F.lit(""))
    contact = F.coalesce(own, F.col("_contact"))
    return (
        audience.withColumn("_email", lower_trimmed("lead_email"))
        .join(_directory(contacts, leads), "_email", "left")
        .select(
            *audience.columns,
            F.when(contact.isNotNull(), F.lit(CONTACT_ID)).when(F.col("_lead").isNotNull(), F.lit(LEAD_ID)).alias("id_field"),
            F.coalesce(contact, F.col("_lead")).alias("member_id"),
        )
    )


def new_members(targets: DataFrame, members: DataFrame, campaign_id: str) -> DataFrame:
    """Resolved rows whose target is not yet a member of the campaign, one row per target."""
    mine = members.where(F.col("campaign_id") == campaign_id)
    fresh = unmatched(targets.where(F.col("member_id").isNotNull()), mine, ["id_field", "member_id"])
    order = [F.coalesce(F.col(name), F.lit("")) for name in AUDIENCE_ORDER]
    rest = [F.col(n).asc_nulls_last() for n in fresh.columns if n not in {*AUDIENCE_ORDER, "id_field", "member_id"}]
    return first_per_key(fresh, ["id_field", "member_id"], [*order, *rest])


def member_payloads(fresh: DataFrame, campaign_id: str, status: str = DEFAULT_MEMBER_STATUS) -> DataFrame:
    """Member rows to create, one id column filled."""
    target = F.col("member_id")
    return fresh.where(~target.startswith(BY_EMAIL)).select(
        F.lit(campaign_id).alias("CampaignId"),
        F.when(F.col("id_field") == CONTACT_ID, target).alias(CONTACT_ID),
        F.when(F.col("id_field") == LEAD_ID, target).alias(LEAD_ID),
        F.lit(status).alias("Status"),
    )


def unresolved(targets: DataFrame) -> DataFrame:
    return targets.where(F.col("member_id").isNull())


def _missing_people(targets: DataFrame) -> DataFrame:
    """One row per address that no directory knows."""
    return (
        unresolved(targets)
        .where(F.col("lead_email").isNotNull() & (F.col("lead_email") != ""))
        .select("lead_email")
        .distinct()
    )


def missing_leads(targets: DataFrame) -> DataFrame:
    return _missing_people(targets).select(
        contact_name("lead_email").alias("LastName"),
        F.lit(LEAD_COMPANY).alias("Company"),
        F.col("lead_email").alias("Email"),
        F.lit(LEAD_SOURCE).alias("LeadSource"),
    )


def missing_contacts(targets: DataFrame) -> DataFrame:
    return missing_leads(targets).drop("Company")


def with_created(targets: DataFrame, id_field: str) -> DataFrame:
    """Targets once the missing people are created: rows with an address point to the person to come, by that address."""
    email = lower_trimmed("lead_email")
    comes = F.col("member_id").isNull() & (F.coalesce(email, F.lit("")) != "")
    return targets.withColumns(
        {
            "id_field": F.when(comes, F.lit(id_field)).otherwise(F.col("id_field")),
            "member_id": F.when(comes, F.concat(F.lit(BY_EMAIL), email)).otherwise(F.col("member_id")),
        }
    )


def created_members(fresh: DataFrame, campaign_id: str, status: str = DEFAULT_MEMBER_STATUS) -> DataFrame:
    """Members to add of people that the same push creates; the address stands for the id they will get."""
    return fresh.where(F.col("member_id").startswith(BY_EMAIL)).select(
        F.lit(campaign_id).alias("CampaignId"),
        F.col("id_field").alias("IdField"),
        F.substring("member_id", len(BY_EMAIL) + 1, 1 << 30).alias("Email"),
        F.lit(status).alias("Status"),
    )


def target_outcomes(targets: DataFrame, members: DataFrame, campaign_id: str) -> DataFrame:
    """Rows created, skipped and failed per target.

    A target that is a member skips all its rows; of a new one, the first row creates the member and
    the others find it there; rows without a target fail. Row counts per target are all that takes,
    and they are combined before the shuffle, so a hot target is one row per map task.
    """
    mine = members.where(F.col("campaign_id") == campaign_id).select(
        "id_field", "member_id", F.lit(True).alias("_member")
    ).distinct()
    groups = targets.groupBy("id_field", "member_id").agg(F.count(F.lit(1)).alias("_rows"))
    failed = F.col("member_id").isNull()
    fresh = ~failed & F.col("_member").isNull()
    zero = F.lit(0).cast("bigint")
    created = F.when(fresh, F.lit(1).cast("bigint")).otherwise(zero)
    return groups.join(mine, ["id_field", "member_id"], "left").select(
        "id_field",
        "member_id",
        created.alias(CREATED),
        F.when(failed, zero).otherwise(F.col("_rows") - created).alias(SKIPPED_EXISTING),
        F.when(failed, F.col("_rows")).otherwise(zero).alias(FAILED_NO_TARGET),
    )


def outcome_counts(targets: DataFrame, members: DataFrame, campaign_id: str) -> DataFrame:
    """One row: created, skipped and failed rows of the whole push."""
    outcomes = target_outcomes(targets, members, campaign_id)
    return outcomes.agg(
        *[
            F.coalesce(F.sum(kind), F.lit(0)).alias(f"{name}_count")
            for kind, name in ((CREATED, "created"), (SKIPPED_EXISTING, "skipped"), (FAILED_NO_TARGET, "failed"))
        ]
    )


def push_failures(targets: DataFrame) -> DataFrame:
    """The rows no member could be made from, with the reason."""
    return unresolved(targets).select("user_id", "lead_email", F.lit(NO_TARGET).alias("error"))


def push_audit(
    counts: DataFrame,
    run_date: str,
    campaign_id: str,
    started_at: Column,
    completed_at: Column,
    is_dry_run: bool = False,
) -> DataFrame:
    """The push's audit row. Any failed row makes the run FAILED and counts created rows alone."""
    failed = F.col("failed_count") > 0
    return counts.select(
        F.lit(run_date).cast("date").alias("run_date"),
        F.lit(campaign_id).alias("campaign_id"),
        started_at.alias("started_at"),
        completed_at.alias("completed_at"),
        F.when(failed, F.lit(FAILED)).otherwise(F.lit(SUCCESS)).alias("status"),
        F.when(failed, F.col("created_count"))
        .otherwise(F.col("created_count") + F.col("skipped_count"))
        .alias("records_processed"),
        F.lit(is_dry_run).alias("is_dry_run"),
        F.when(failed, F.concat(F.lit("push had "), F.col("failed_count").cast("string"), F.lit(" failed rows: " + NO_TARGET)))
        .alias("error_message"),
    )


def audience_summary(audience: DataFrame, run_date: str, execution_id: str, dry_run: bool = True, step: str = "push_salesforce") -> DataFrame:
    """One row: the audience's size with the run's identity."""
    return audience.agg(F.count(F.lit(1)).alias("audience_count")).select(
        F.lit(execution_id).alias("execution_id"),
        F.lit(run_date).cast("date").alias("run_date"),
        F.lit(step).alias("step_name"),
        F.lit(dry_run).alias("dry_run"),
        "audience_count",
    )
