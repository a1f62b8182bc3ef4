"""Registered queries: file round trips, table maintenance, segmentation, activation, change feeds."""

from __future__ import annotations

from contextlib import suppress
from dataclasses import replace
from datetime import date

from pyspark.sql import DataFrame, functions as F

from relata.catalog.adapters import AS_OF, RUN_DATE, as_of
from relata.catalog.models import Models
from relata.catalog.oracles import PIECES, STEPS, doubles, oracle, rounded, texts
from relata.catalog.portable import portable
from relata.functions.records import utc
from relata.operators import activation, audit, cdc, segments, validation
from relata.operators.aggregates import row_counts
from relata.operators.audience import selected_segments
from relata.session import scratch_path
from relata.sinks import tables
from relata.sinks.scratch import stored
from relata.sinks.tables import Layers
from relata.sources import csv_files
from relata.sources.contracts import CONTRACTS, Contract, ContractError
from relata.sources.manifest import manifest_files, read_manifest
from relata.streaming.changes import ChangeTable, start_cdc

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(key: str, sql: str | None = None, rounded_columns: tuple[str, ...] = ()):
    def register(build):
        QUERIES[key] = lambda spark, sf_dir: portable(build(Models(spark, sf_dir)), rounded_columns)
        if sql is not None:
            ORACLES[key] = sql
        return build

    return register


SALES, LEADS = CONTRACTS["crm_sales"], CONTRACTS["crm_new_partner_leads"]

# ---------------------------------------------------------------- A: scans, each after a write of the same rows


def _written_csv(m: Models, name: str, contract, columns: list[str] | None = None) -> str:
    """The text rows as CSV files named by the contract's pattern, below a fresh folder."""
    return _written_rows(m, m.raw(name).select(*(columns or contract.names)), contract)


def _written_rows(m: Models, rows: DataFrame, contract: Contract) -> str:
    path = scratch_path(m.spark, "csv")
    options = {"header": True, "escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    rows.write.options(**options).csv(f"{path}/{contract.source_type}_all.csv")
    return path


def _broken_over_lines(m: Models) -> DataFrame:
    """The text sales with line ends, quotes and delimiters in a field of every row."""
    region = F.concat(F.lit('"'), "deal_stage", F.lit('",\n"'), "owner_region", F.lit('\n\n,"'))
    return m.raw("text_sales").withColumn("owner_region", region).select(*SALES.names)


def _part_files(contract: Contract) -> Contract:
    """The contract with a pattern that matches the part files Spark writes."""
    return replace(contract, file_pattern=f"{contract.source_type}_all.csv/part-*.csv")


def _empty_as_null(*columns: str) -> str:
    """An empty field and an absent one are the same to the row rules, and the scan gives NULL for both."""
    return ", ".join(f"nullif({c}, '') as {c}" for c in columns)


query("a1_csv_by_name", oracle(f"select {_empty_as_null(*SALES.names)} from text_sales", "text_sales"))(
    lambda m: csv_files.read_crm_csv(m.spark, _written_csv(m, "text_sales", SALES), _part_files(SALES)).select(*SALES.names)
)
query(
    "a1_csv_shuffled_header",
    oracle(f"select null::varchar as currency, {_empty_as_null(*[c for c in SALES.names if c != 'currency'])} from text_sales", "text_sales"),
)(
    # Other column order, one contract column missing.
    lambda m: csv_files.read_crm_csv(
        m.spark,
        _written_csv(m, "text_sales", SALES, [name for name in reversed(SALES.names) if name != "currency"]),
        _part_files(SALES),
    ).select(*SALES.names)
)
_BROKEN = "'\"' || deal_stage || '\",' || chr(10) || '\"' || owner_region || chr(10) || chr(10) || ',\"' as owner_region"
query(
    "a1_csv_quoted_newlines",
    oracle(f"select {_empty_as_null(*SALES.names[:-1])}, {_BROKEN} from text_sales", "text_sales"),
)(lambda m: csv_files.read_crm_csv(m.spark, _written_rows(m, _broken_over_lines(m), SALES), _part_files(SALES)).select(*SALES.names))
query(
    "a2_file_match",
    oracle("select count(*) as records, count(distinct owner_region) as regions from text_sales", "text_sales"),
)(
    lambda m: csv_files.read_crm_csv(m.spark, _written_csv(m, "text_sales", SALES), _part_files(SALES), multi_line=False).agg(
        F.count(F.lit(1)).alias("records"), F.count_distinct("owner_region").alias("regions")
    )
)


def _typed_round_trip(m: Models) -> DataFrame:
    path = scratch_path(m.spark, "typed")
    rows = m.raw("crm_support").withColumn("csat_score", F.col("csat_score").cast("double"))
    rows.write.options(header=True, escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False).csv(path)
    return csv_files.load_typed_csv(m.spark, path, CONTRACTS["crm_support"].schema())


query("a4_typed_csv_load", oracle(f"select ticket_id, user_id, priority, status, category, {doubles('csat_score')} from crm_support", "crm_support"))(_typed_round_trip)


def _unquoted_round_trip(m: Models) -> DataFrame:
    path = scratch_path(m.spark, "positional")
    rows = m.raw("crm_support").select("ticket_id", F.concat(F.lit('"'), "category").alias("category"))
    rows.write.options(header=True, quote="", ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False).csv(path)
    return csv_files.scan_positional_csv(m.spark, path, rows.schema)


query("a5_positional_csv", oracle("select ticket_id, '\"' || category as category from crm_support", "crm_support"))(_unquoted_round_trip)


def _manifest_round_trip(m: Models) -> DataFrame:
    """Each day's manifest as a JSON document over several lines in a file of its own, read by the manifest reader."""
    path = scratch_path(m.spark, "manifest")
    entry = F.struct("source_type", "object_uri", F.col("size_bytes").cast("bigint").alias("size_bytes"), F.lit("1").alias("generation"))
    documents = m.raw("arrival_announced").groupBy("run_date").agg(F.collect_list(entry).alias("files"))
    documents = documents.select(
        "run_date", F.lit("job").alias("transfer_job_name"), F.lit("op").alias("transfer_operation_id"), F.lit("SUCCESS").alias("status"), "files"
    )
    lines = F.replace(F.to_json(F.struct("*"), {"pretty": "true"}), F.lit("\n"), F.lit("\n\n"))
    # A folder per day holds one document.
    documents.select(F.col("run_date").alias("day"), lines.alias("value")).repartition("day").write.partitionBy("day").text(path)
    return manifest_files(read_manifest(m.spark, f"{path}/day=*/*.txt")).drop("generation")


query(
    "a9_manifest_files",
    oracle("select cast(run_date as varchar) as run_date, 'SUCCESS' as status, source_type, object_uri, cast(size_bytes as bigint) as size_bytes from arrival_announced", "arrival_announced"),
)(_manifest_round_trip)

query(
    "a11_inline_relation",
    oracle(
        "select x.segment_id, x.campaign_code, count(u.user_id) as users from (select cast(1 as bigint) as segment_id, 'campaign_engaged_growth' as campaign_code union all select 2, 'high_value_sales_growth') x "
        "left join users u on cast(substr(u.user_id, 2) as bigint) % 4 + 1 = x.segment_id group by x.segment_id, x.campaign_code",
        "users",
    ),
)(
    lambda m: selected_segments(m.spark)
    .join(
        m.raw("user_raw").groupBy((F.expr("substring(USER_ID, 2)").cast("bigint") % 4 + 1).alias("segment_id")).agg(
            F.count(F.lit(1)).alias("users")
        ),
        "segment_id",
    )
    .select("segment_id", "campaign_code", "users")
)

# ---------------------------------------------------------------- B: tables


def _layers(m: Models) -> Layers:
    return Layers(m.spark, scratch_path(m.spark, "layers"))


_SALES_META = f"customer_id, user_id, deal_id, deal_amount, {texts('run_date')}, source_type"


def _dated_sales(m: Models) -> DataFrame:
    return m.raw("raw_sales").where(F.col("run_date").isNotNull()).select(
        "customer_id", "user_id", "deal_id", "deal_amount", "run_date", "source_type"
    )


def _appended(m: Models) -> DataFrame:
    store = _layers(m)
    store.append(_dated_sales(m), "raw", "crm_sales")
    store.append(_dated_sales(m), "raw", "crm_sales")
    return store.read("raw", "crm_sales")


query(
    "b1_append_twice",
    oracle(f"select {_SALES_META} from raw_sales where run_date is not null union all select {_SALES_META} from raw_sales where run_date is not null", "raw_sales"),
)(_appended)


def _truncated(m: Models) -> DataFrame:
    path = scratch_path(m.spark, "truncate")
    tables.truncate_load(_dated_sales(m), path)
    tables.truncate_load(_dated_sales(m).where("deal_id is not null"), path)
    return m.spark.read.parquet(path)


query("b2_truncate_load", oracle(f"select {_SALES_META} from raw_sales where run_date is not null and deal_id is not null", "raw_sales"))(_truncated)


def _replaced(m: Models) -> DataFrame:
    """Replace a table by a query over itself."""
    store = _layers(m)
    store.replace(_dated_sales(m), "curated", "sales")
    store.replace(store.current("curated", "sales").where("deal_id is not null"), "curated", "sales")
    return store.current("curated", "sales")


query("b3_replace_from_itself", oracle(f"select {_SALES_META} from raw_sales where run_date is not null and deal_id is not null", "raw_sales"))(_replaced)


def _rejected(m: Models) -> DataFrame:
    rows = m.raw("text_leads")
    raw_row = F.create_map(*[p for c in sorted(LEADS.names) for p in (F.lit(c), F.coalesce(F.col(c), F.lit("")))])
    scanned = rows.select(
        *LEADS.names,
        raw_row.alias(validation.RAW_ROW),
        F.lit("é.csv").alias(validation.FILE),
        F.monotonically_increasing_id().alias(validation.NUMBER),
        F.lit(0).cast("bigint").alias(validation.OFFSET),
    )
    checked = validation.validated(scanned, LEADS)
    return validation.rejected_rows(checked, LEADS, RUN_DATE, as_of(), with_row_number=False)


def _rejected_file(m: Models) -> DataFrame:
    path = scratch_path(m.spark, "rejected")
    tables.write_rejected(_rejected(m), path)
    return m.spark.read.text(f"{path}/part")


_B4 = (
    "select cast(json_object('error_reasons', list_filter([case when no_id then 'external_lead_id is required' end, case when no_email then 'email is required' end, "
    "case when bad_score then 'lead_score: invalid INTEGER: ' || lead_score end, case when bad_created then 'created_at: invalid TIMESTAMP: ' || created_at end, "
    "case when bad_opt then 'opt_in: invalid BOOL: ' || opt_in end], lambda x: x is not null), "
    "'raw_row', json_object('created_at', coalesce(created_at, ''), 'email', coalesce(email, ''), 'external_lead_id', coalesce(external_lead_id, ''), "
    "'lead_score', coalesce(lead_score, ''), 'opt_in', coalesce(opt_in, ''), 'partner_name', coalesce(partner_name, ''), 'utm_source', coalesce(utm_source, '')), "
    f"'rejected_ts', '2024-02-01T00:00:00Z', 'row_number', null, 'run_date', '{RUN_DATE}', 'source_file', 'é.csv', 'source_type', 'crm_new_partner_leads') as varchar) as value "
    "from checked_leads where (bad_score or bad_created or bad_opt or no_id or no_email)"
)
query("b4_rejected_lines", oracle(_B4, "checked_leads"))(_rejected_file)


def _slice_replaced(m: Models) -> DataFrame:
    """A slice written, replaced by fewer rows, and another replaced by none."""
    store = _layers(m)
    rows = _dated_sales(m)
    both = rows.unionByName(rows.withColumn("run_date", F.date_add("run_date", 1)))
    store.append(both, "raw", "crm_sales", ("run_date", "source_type"))
    kept = rows.where("deal_id is not null")
    store.replace_slice(kept, "raw", "crm_sales", {"run_date": RUN_DATE, "source_type": "crm_sales"})
    store.replace_slice(kept, "raw", "crm_sales", {"run_date": "2024-02-02", "source_type": "crm_sales"})
    return store.read("raw", "crm_sales")


query("b5_replace_slice", oracle(f"select {_SALES_META} from raw_sales where run_date is not null and deal_id is not null", "raw_sales"))(_slice_replaced)


def _audit_rows(m: Models) -> DataFrame:
    """An audit table created empty, then given a row whose count comes from the data."""
    store, schema = _layers(m), activation.PUSH_RUN_SCHEMA
    store.ensure("audit", "push_runs", schema)
    store.ensure("audit", "push_runs", schema)
    count = m.raw("crm_sales").count()
    for status in ("FAILED", "SUCCESS"):
        row = (AS_OF.date(), "CAMP_MOCK_1", utc(AS_OF), utc(AS_OF), status, count, False, None)
        store.append_row(row, "audit", "push_runs", schema)
    return store.read("audit", "push_runs")


query(
    "b6_b7_audit_rows",
    oracle(
        "select '2024-02-01' as run_date, 'CAMP_MOCK_1' as campaign_id, '2024-02-01 00:00:00' as started_at, '2024-02-01 00:00:00' as completed_at, s as status, (select count(*) from crm_sales) as records_processed, "
        "false as is_dry_run, cast(null as varchar) as error_message from (select unnest(['FAILED', 'SUCCESS']) as s) q",
        "crm_sales",
    ),
)(_audit_rows)


def _clustered(m: Models) -> DataFrame:
    store = _layers(m)
    store.append(_dated_sales(m), "raw", "crm_sales", ("run_date",), ("user_id", "deal_id"))
    return store.read("raw", "crm_sales")


query("b8_clustered_layout", oracle(f"select {_SALES_META} from raw_sales where run_date is not null", "raw_sales"))(_clustered)
query(
    "b9_evolved_columns",
    oracle(
        "select lead_email, user_id, cast(null as varchar) as salesforce_contact_id, case when score = 45 then 'ready' else activation_status end as activation_status, 'passed' as quality_gate_status from audience",
        "audience",
    ),
)(
    lambda m: activation.evolve(
        m.audience()
        .drop("salesforce_contact_id", "quality_gate_status")
        .withColumn("activation_status", F.when(F.col("score") == 45, F.lit(None)).otherwise(F.col("activation_status"))),
        activation.OPTIONAL_COLUMNS,
    ).select("lead_email", "user_id", *activation.OPTIONAL_COLUMNS)
)


def _archived(m: Models) -> DataFrame:
    store = _layers(m)
    names = ("crm_sales", "crm_support", "crm_campaign_events", "crm_new_partner_leads")
    for name in names:
        dated = m.raw(name).withColumn("run_date", F.lit(RUN_DATE).cast("date"))
        store.append(dated, "raw", name)
    store.archive_slice(names, RUN_DATE)
    left = sum(len(store.slices("raw", name)) for name in names)
    counts = row_counts({name: store.read("archive", name) for name in names})
    return counts.withColumn("slices_left", F.lit(left))


query(
    "b10_archived_slices",
    oracle(
        " union all ".join(
            f"select '{n}' as table_name, (select count(*) from {n}) as row_count, cast(0 as bigint) as slices_left"
            for n in ("crm_sales", "crm_support", "crm_campaign_events", "crm_new_partner_leads")
        ),
        "crm_sales", "crm_support", "crm_campaign_events", "crm_new_partner_leads",
    ),
)(_archived)
query(
    "b11_expired_slices",
    oracle("select distinct cast(closed_date as varchar) as run_date from crm_sales where closed_date < date '1998-01-01' - 730", "crm_sales"),
)(
    lambda m: tables.expired_slices(
        m.raw("crm_sales").select(F.col("closed_date").alias("run_date")), date(1998, 1, 1), tables.RETENTION_DAYS["raw"]
    )
)


def _loaded_twice(m: Models) -> DataFrame:
    store = _layers(m)
    for _ in range(2):
        store.load_run(_dated_sales(m), "raw", "crm_sales", RUN_DATE, "crm_sales", ("user_id", "deal_id"))
    return store.read("raw", "crm_sales")


query("b12_rerun_safe_load", oracle(f"select {_SALES_META} from raw_sales where run_date is not null", "raw_sales"))(_loaded_twice)


def _record_numbers(m: Models) -> DataFrame:
    """Record numbers of every row of every file, reduced to what must hold for each file."""
    return validation.numbering(csv_files.read_crm_csv(m.spark, _written_rows(m, _broken_over_lines(m), SALES), _part_files(SALES)))


query("c12_record_numbers", oracle("select true as numbered_without_gap, count(*) as records from text_sales", "text_sales"))(_record_numbers)

# ---------------------------------------------------------------- K: segmentation

_GOVERNED = segments.GOVERNED_FEATURES


def _unit_centers(width: int) -> tuple[tuple[float, ...], ...]:
    """Four given centers in standardised space."""
    return tuple(tuple(0.5 * level + 0.1 * i for i in range(width)) for level in (-1, 0, 1, 3))


def _fitted(features: DataFrame, names: tuple[str, ...]) -> tuple[segments.SegmentModel, DataFrame]:
    """A model and the rows it was fitted on, which are computed once for the fit and for scoring."""
    features = stored(features, "features")
    return segments.fit_segments(features, names), features


def _governed_scored(m: Models) -> tuple[segments.SegmentModel, DataFrame]:
    return _fitted(m.features(), _GOVERNED)


def _fit_pieces(prefix: str, source: str, features: tuple[str, ...]) -> None:
    """The exact fit in SQL, each seed and each round a step of its own: ``<prefix>_fit`` has the centers, ``<prefix>_near`` each
    user's distances from them."""
    wide, clusters = range(len(features)), range(segments.CLUSTERS)
    steps: list[tuple[str, str]] = []

    def cols(template: str) -> str:
        return ", ".join(template.replace("#", str(i)) for i in wide)

    def apart(point: str, center: str) -> str:
        return " + ".join(f"({point}.z{i} - {center}.z{i}) * ({point}.z{i} - {center}.z{i})" for i in wide)

    numbers = ", ".join(f"cast(floor(cast({name} as double) * 1000000 + 0.5) as hugeint) as x{i}" for i, name in enumerate(features))
    steps.append(("x", f"select ('0x' || substr(md5('{segments.SEED}:' || user_id), 1, 15))::bigint as h, user_id, {numbers} from {source} where user_id is not null"))
    steps.append(("m", f"select count(*) as n, {cols('coalesce(sum(x#) // greatest(count(x#), 1), 0) as m#')} from {prefix}_x"))
    steps.append(("d", f"select h, user_id, {cols('coalesce(x# - m#, 0) as d#')} from {prefix}_x, {prefix}_m"))
    steps.append(("s", f"select {cols('cast(floor(sqrt(cast(sum(d# * d#) // greatest(count(*) - 1, 1) as double))) as hugeint) as s#')} from {prefix}_d"))
    steps.append(("z", f"select h, user_id, {cols('case when s# = 0 then 0::hugeint else d# * 10000 // s# end as z#')} from {prefix}_d, {prefix}_s"))
    steps.append(("seed0", f"select {cols('z#')} from {prefix}_z order by h, user_id limit 1"))
    for k in clusters[1:]:
        earlier = [f"{prefix}_seed{j}" for j in range(k)]
        nearest = f"least({', '.join(apart('p', seed) for seed in earlier)})" if k > 1 else apart("p", earlier[0])
        steps.append((f"seed{k}", f"select {cols('z#')} from (select p.*, {nearest} as d from {prefix}_z p, {', '.join(earlier)}) q where d > 0 order by h // d, h, user_id limit 1"))
    steps.append(("c0", " union all ".join(f"select {k} as id, {cols('z#')} from {prefix}_seed{k}" for k in clusters)))
    for n in range(segments.ITERATIONS):
        near = f"select p.*, c.id, row_number() over (partition by p.user_id order by {apart('p', 'c')}, c.id) as place from {prefix}_z p, {prefix}_c{n} c"
        steps.append((f"a{n}", f"select id, count(*) as n, {cols('sum(z#) // count(*) as z#')} from ({near}) q where place = 1 group by id"))
        steps.append((f"c{n + 1}", f"select c.id, {cols('coalesce(a.z#, c.z#) as z#')} from {prefix}_c{n} c left join {prefix}_a{n} a using (id)"))
    steps.append(("fit", f"select * from {prefix}_c{segments.ITERATIONS}"))
    # Scoring, in the same order of operations on doubles.
    value = ", ".join(
        f"case when s{i} > 0 then (coalesce(cast(f.{name} as double), m{i} / 1000000.0::double) - m{i} / 1000000.0::double) / (s{i} / 1000000.0::double) else 0.0::double end as v{i}"
        for i, name in enumerate(features)
    )
    steps.append(("v", f"select f.user_id, {value} from {source} f, {prefix}_m, {prefix}_s where f.user_id is not null"))
    square = "0.0::double"
    for i in wide:
        square = f"({square} + (v{i} - z{i} / 10000.0::double) * (v{i} - z{i} / 10000.0::double))"
    steps.append(("near", f"select user_id, id + 1 as centroid_id, distance from (select v.user_id, c.id, sqrt({square}) as distance from {prefix}_v v, {prefix}_fit c) q qualify row_number() over (partition by user_id order by distance, id) = 1"))
    names = [f"{prefix}_{name}" for name, _ in steps]
    for i, (_, text) in enumerate(steps):
        PIECES[names[i]] = ((), (source, *names[:i]), text)
    STEPS.update(names)


_fit_pieces("governed", "features", _GOVERNED)
_fit_pieces("classic", "user_features", segments.CLASSIC_FEATURES)
_MEANS = ("avg_deal_amount", "avg_csat_score")
_SEGMENT_SCORE = "round(100.0::double / (1.0::double + distance), 2)"


def _fit_report(m: Models) -> DataFrame:
    model, features = _governed_scored(m)
    scored = segments.user_segments_governed(model, features, as_of())
    return scored.groupBy("segment_name").agg(
        F.count(F.lit(1)).alias("users"), F.min("segment_score").alias("low"), F.max("segment_score").alias("high")
    )


def _fitted_centers(m: Models, features: DataFrame, names: tuple[str, ...]) -> DataFrame:
    """The centers of a fit as rows."""
    model = segments.fit_segments(features, names)
    rows = [(i + 1, name, value) for i, center in enumerate(model.centers) for name, value in zip(model.features, center, strict=True)]
    return m.spark.createDataFrame(rows, "centroid_id bigint, feature string, value double")


def _centers_sql(prefix: str, features: tuple[str, ...]) -> str:
    parts = [f"select cast(id + 1 as bigint) as centroid_id, '{name}' as feature, z{i} / 10000.0::double as value from {prefix}_fit" for i, name in enumerate(features)]
    return oracle(" union all ".join(parts), f"{prefix}_fit")


query("k1_fit_centers", _centers_sql("governed", _GOVERNED))(lambda m: _fitted_centers(m, m.features(), _GOVERNED))
query("k2_fit_centers", _centers_sql("classic", segments.CLASSIC_FEATURES))(lambda m: _fitted_centers(m, m.user_features(), segments.CLASSIC_FEATURES))
query(
    "k1_k5_fit_and_score",
    oracle(
        f"select 'segment_' || centroid_id as segment_name, count(*) as users, min({_SEGMENT_SCORE}) as low, max({_SEGMENT_SCORE}) as high from governed_near group by centroid_id",
        "governed_near",
    ),
)(_fit_report)
query(
    "k2_fit_classic",
    oracle(
        "select u.user_id, email, can_email, city, country, income_band, centroid_id as segment_id, 'segment_' || centroid_id as segment_name, "
        + ", ".join((rounded if name in _MEANS else doubles)(name) for name in segments.CLASSIC_FEATURES)
        + ", '2024-02-01 00:00:00' as segmented_at from user_features u join classic_near using (user_id)",
        "user_features", "classic_near",
    ),
    _MEANS,
)(
    lambda m: segments.user_segments_classic(*_fitted(m.user_features(), segments.CLASSIC_FEATURES), as_of())
)


def _fit_quality(features: DataFrame, names: tuple[str, ...]) -> DataFrame:
    """What every fit must keep: all users scored, four segments, each user at its nearest center, less cost than one center has."""
    model, features = _fitted(features, names)
    at = F.col("nearest_centroids_distance")
    scaled = [
        (F.coalesce(F.col(name).cast("double"), F.lit(mean)) - F.lit(mean)) / F.lit(dev) if dev > 0 else F.lit(0.0)
        for name, mean, dev in zip(model.features, model.means, model.deviations)
    ]
    to_mean = F.aggregate(F.array(*[value * value for value in scaled]), F.lit(0.0), lambda total, square: total + square)
    scored = segments.score_segments(model, features)
    return scored.agg(
        F.count(F.lit(1)).alias("users"),
        F.count_distinct("centroid_id").alias("segments"),
        F.bool_and(at[0]["distance"] == F.array_min(F.transform(at, lambda pair: pair["distance"]))).alias("nearest"),
        (F.sum(F.pow(at[0]["distance"], 2)) < F.sum(to_mean)).alias("better_than_one"),
    )


_FIT = "select count(*) as users, 4 as segments, true as nearest, true as better_than_one from {0} where user_id is not null"
query("k1_fit_quality", oracle(_FIT.format("features"), "features"))(lambda m: _fit_quality(m.features(), _GOVERNED))
query("k2_fit_quality", oracle(_FIT.format("user_features"), "user_features"))(
    lambda m: _fit_quality(m.user_features(), segments.CLASSIC_FEATURES)
)


def _scored_shape(m: Models) -> DataFrame:
    scored = segments.user_segments_governed(*_governed_scored(m), as_of())
    known = F.col("segment_name").isin([f"segment_{i}" for i in range(1, 5)]) & (F.col("segment_score") > 0) & (F.col("segment_score") <= 100)
    return scored.select("user_id", F.col("run_date").cast("string").alias("run_date"), known.alias("known"))


query("k8_scored_shape", oracle(f"select user_id, '{RUN_DATE}' as run_date, true as known from features where user_id is not null", "features"))(_scored_shape)
query(
    "k8_scored_users",
    oracle(
        f"select '{RUN_DATE}' as run_date, user_id, 'segment_' || centroid_id as segment_name, {_SEGMENT_SCORE} as segment_score, '{segments.MODEL_NAME}' as model_name, "
        f"'{segments.MODEL_VERSION}' as model_version, '2024-02-01 00:00:00' as scored_at from governed_near",
        "governed_near",
    ),
)(lambda m: segments.user_segments_governed(*_governed_scored(m), as_of()))
query(
    "k3_mean_imputation",
    oracle(
        "select user_id, round(coalesce(cast(avg_csat_score as double), (select avg(cast(avg_csat_score as double)) from features)), 6) as avg_csat_score from features",
        "features",
    ),
    ("avg_csat_score",),
)(lambda m: segments.impute_mean(m.features(), ["avg_csat_score"]).select("user_id", "avg_csat_score"))

_SCALED = ("deal_count", "won_revenue", "ticket_count", "account_age_days")
_Z = ", ".join(f"({c} - avg(cast({c} as double)) over ()) / stddev_samp(cast({c} as double)) over () as {c}" for c in _SCALED)
PIECES["scaled"] = ((), ("features",), f"select user_id, {_Z} from features")
query(
    "k4_standardised",
    oracle(f"select user_id, {', '.join(f'round({c}, 6) as {c}' for c in _SCALED)} from scaled", "scaled"),
    _SCALED,
)(lambda m: segments.standardise(m.features(), _SCALED).select("user_id", *_SCALED))


def _assigned(m: Models) -> DataFrame:
    scaled = segments.standardise(m.features(), _SCALED).select("user_id", *_SCALED)
    return segments.assign_to_centers(scaled, _SCALED, _unit_centers(len(_SCALED)))


_CENTER_ROWS = ", ".join(
    f"({i}, {', '.join(repr(x) for x in center)})" for i, center in enumerate(_unit_centers(len(_SCALED)), start=1)
)
_DISTANCE = " + ".join(f"power(s.{c} - k.c{i}, 2)" for i, c in enumerate(_SCALED))
PIECES["assigned"] = (
    (),
    ("scaled",),
    f"select s.user_id, k.id as centroid_id, sqrt({_DISTANCE}) as distance, row_number() over (partition by s.user_id order by sqrt({_DISTANCE}), k.id) as place "
    f"from scaled s, (values {_CENTER_ROWS}) k(id, c0, c1, c2, c3)",
)
query(
    "k9_given_centers",
    oracle("select user_id, cast(centroid_id as bigint) as centroid_id, round(distance, 6) as distance from assigned where place = 1", "assigned"),
    ("distance",),
)(lambda m: _assigned(m).select("user_id", "centroid_id", F.col("nearest_centroids_distance")[0]["distance"].alias("distance")))
query(
    "k5_all_distances",
    oracle("select user_id, place, cast(centroid_id as bigint) as centroid_id, round(distance, 6) as distance from assigned", "assigned"),
    ("distance",),
)(
    lambda m: _assigned(m)
    .select("user_id", F.posexplode("nearest_centroids_distance").alias("at", "near"))
    .select("user_id", (F.col("at") + 1).alias("place"), "near.centroid_id", "near.distance")
)
query(
    "k6_k7_name_and_score",
    oracle(
        "select user_id, 'segment_' || cast(centroid_id as varchar) as segment_name, round(100.0 / (1.0 + distance), 2) as segment_score from assigned where place = 1",
        "assigned",
    ),
)(lambda m: _assigned(m).select("user_id", segments.segment_name().alias("segment_name"), segments.segment_score().alias("segment_score")))

# ---------------------------------------------------------------- N: activation, with E9 and E10

CAMPAIGN = "CAMP_MOCK_1"


def _eligible(m: Models) -> DataFrame:
    """The audience with own contact ids and unready rows planted by score and id."""
    number = F.expr("substring(user_id, 2)").cast("bigint")
    members = m.audience().withColumns(
        {
            "salesforce_contact_id": F.when(number % 7 == 0, F.concat(F.lit("003own"), number.cast("string"))),
            "activation_status": F.when(F.col("score") == 45, F.lit("held")).otherwise(F.col("activation_status")),
        }
    )
    return activation.eligible(members, RUN_DATE)


PIECES["eligible"] = (
    (),
    ("audience",),
    f"""select run_date, user_id, lead_email,
        case when cast(substr(user_id, 2) as bigint) % 7 = 0 then '003own' || cast(cast(substr(user_id, 2) as bigint) as varchar) end as salesforce_contact_id,
        segment_name, score, consent_status, activation_status, quality_gate_status
        from audience where run_date = date '{RUN_DATE}' and (score <> 45 or score is null) and consent_status in ('email_consent', 'partner_opt_in')""",
)
PIECES["targets"] = (
    ("contacts", "lead_directory"),
    ("eligible",),
    """select e.*, case when e.salesforce_contact_id is not null or c.id is not null then 'ContactId' when l.id is not null then 'LeadId' end as id_field,
        coalesce(e.salesforce_contact_id, c.id, l.id) as member_id
        from eligible e left join (select email, min(id) as id from contacts where email <> '' group by email) c on c.email = e.lead_email
        left join (select email, min(id) as id from lead_directory where email <> '' group by email) l on l.email = e.lead_email""",
)
PIECES["fresh"] = (
    ("members",),
    ("targets",),
    """select distinct id_field, member_id from targets t where member_id is not null and not exists
        (select 1 from members m where m.campaign_id = 'CAMP_MOCK_1' and m.id_field = t.id_field and m.member_id = t.member_id)""",
)
PIECES["outcomes"] = (
    ("members",),
    ("targets",),
    """select t.id_field, t.member_id, count(*) as n, bool_or(m.member_id is not null) as known from targets t
        left join (select distinct id_field, member_id from members where campaign_id = 'CAMP_MOCK_1') m on m.id_field = t.id_field and m.member_id = t.member_id
        group by t.id_field, t.member_id""",
)
_COUNTS = (
    "select count(*) filter (where member_id is not null and not known) as created_count, "
    "cast(coalesce(sum(case when member_id is null then 0 when known then n else n - 1 end), 0) as bigint) as skipped_count, "
    "cast(coalesce(sum(n) filter (where member_id is null), 0) as bigint) as failed_count from outcomes"
)


def _targets(m: Models) -> DataFrame:
    return activation.resolve_targets(_eligible(m), m.raw("contacts"), m.raw("lead_directory"))


def _fresh(m: Models) -> DataFrame:
    return activation.new_members(_targets(m), m.raw("members"), CAMPAIGN)


query(
    "n1_eligible",
    oracle(f"select {texts('run_date')}, user_id, lead_email, salesforce_contact_id, segment_name, score, consent_status, activation_status, quality_gate_status from eligible", "eligible"),
)(_eligible)
query(
    "n1_eligible_without_status_columns",
    oracle("select lead_email, user_id, cast(null as varchar) as salesforce_contact_id, 'ready' as activation_status, 'passed' as quality_gate_status from audience", "audience"),
)(
    lambda m: activation.eligible(m.audience().drop(*activation.OPTIONAL_COLUMNS), RUN_DATE).select(
        "lead_email", "user_id", *activation.OPTIONAL_COLUMNS
    )
)
query(
    "n2_pushed_verdict",
    oracle(
        "select count(*) > 0 as already_pushed, count(*) as successful_runs from push_runs where run_date = date '2024-01-05' and campaign_id = 'CAMP_MOCK_1' and status = 'SUCCESS' and not is_dry_run",
        "push_runs",
    ),
)(lambda m: activation.pushed_verdict(m.raw("push_runs"), "2024-01-05", CAMPAIGN))
query(
    "n3_dry_run_payloads",
    oracle(
        "select cast(json_object('CampaignId', 'CAMP_MOCK_1', 'Email', lead_email, 'Segment', segment_name, 'Score', score, 'UserId', user_id, 'ContactId', salesforce_contact_id) as varchar) as payload from eligible",
        "eligible",
    ),
)(lambda m: activation.payloads(_eligible(m), CAMPAIGN))
query("e10_resolved_targets", oracle("select lead_email, user_id, score, id_field, member_id from targets", "targets"))(
    lambda m: _targets(m).select("lead_email", "user_id", "score", "id_field", "member_id")
)
query("e9_new_members", oracle("select id_field, member_id from fresh", "fresh"))(lambda m: _fresh(m).select("id_field", "member_id"))
query(
    "n4_member_payloads",
    oracle(
        "select 'CAMP_MOCK_1' as CampaignId, case when id_field = 'ContactId' then member_id end as ContactId, case when id_field = 'LeadId' then member_id end as LeadId, 'Sent' as Status from fresh",
        "fresh",
    ),
)(lambda m: activation.member_payloads(_fresh(m), CAMPAIGN))
_PEOPLE = "from (select distinct lead_email from targets where member_id is null and lead_email <> '') q"
_NAME = "coalesce(nullif(left(split_part(lead_email, '@', 1), 80), ''), 'Unknown') as LastName"
query(
    "n5_missing_leads",
    oracle(f"select {_NAME}, 'Partner Lead' as Company, lead_email as Email, 'Partner Referral' as LeadSource {_PEOPLE}", "targets"),
)(lambda m: activation.missing_leads(_targets(m)))
query("n5_missing_contacts", oracle(f"select {_NAME}, lead_email as Email, 'Partner Referral' as LeadSource {_PEOPLE}", "targets"))(
    lambda m: activation.missing_contacts(_targets(m))
)
query(
    "n5_created_members",
    oracle(
        "select 'CAMP_MOCK_1' as CampaignId, 'LeadId' as IdField, email as Email, 'Responded' as Status "
        "from (select distinct lower(trim(lead_email)) as email from targets where member_id is null and trim(lead_email) <> '') q",
        "targets",
    ),
)(
    lambda m: activation.created_members(
        activation.new_members(activation.with_created(_targets(m), "LeadId"), m.raw("members"), CAMPAIGN), CAMPAIGN, "Responded"
    )
)
query("n6_outcome_counts", oracle(_COUNTS, "outcomes"))(lambda m: activation.outcome_counts(_targets(m), m.raw("members"), CAMPAIGN))
query(
    "n6_push_failures",
    oracle("select user_id, lead_email, 'No Salesforce Contact or Lead found' as error from targets where member_id is null", "targets"),
)(lambda m: activation.push_failures(_targets(m)))
query(
    "n7_push_audit",
    oracle(
        f"select '{RUN_DATE}' as run_date, 'CAMP_MOCK_1' as campaign_id, '2024-02-01 00:00:00' as started_at, '2024-02-01 00:00:00' as completed_at, "
        "case when failed_count > 0 then 'FAILED' else 'SUCCESS' end as status, case when failed_count > 0 then created_count else created_count + skipped_count end as records_processed, "
        "false as is_dry_run, case when failed_count > 0 then 'push had ' || cast(failed_count as varchar) || ' failed rows: No Salesforce Contact or Lead found' end as error_message "
        f"from ({_COUNTS}) c",
        "outcomes",
    ),
)(
    lambda m: activation.push_audit(
        activation.outcome_counts(_targets(m), m.raw("members"), CAMPAIGN), RUN_DATE, CAMPAIGN, as_of(), as_of()
    )
)
query(
    "n8_audience_summary",
    oracle(f"select 'x1' as execution_id, '{RUN_DATE}' as run_date, 'push_salesforce' as step_name, true as dry_run, count(*) as audience_count from audience", "audience"),
)(lambda m: activation.audience_summary(m.audience(), RUN_DATE, "x1"))

# ---------------------------------------------------------------- O: change feeds

_USER_TEXT = "user_id, email, first_name, city, country, consent_email, " + texts("signup_date", "updated_at")
PIECES["changes"] = (("user_changes",), (), "select USER_ID as user_id, EMAIL as email, FIRST_NAME as first_name, CITY as city, COUNTRY as country, CONSENT_EMAIL as consent_email, SIGNUP_DATE as signup_date, UPDATED_AT as updated_at, op, seq from user_changes")
PIECES["merged"] = (
    (),
    ("users", "changes"),
    """select * from (select user_id, email, first_name, city, country, consent_email, signup_date, updated_at, 'I' as op, cast(-1 as bigint) as seq from users
        union all select user_id, email, first_name, city, country, consent_email, signup_date, updated_at, op, seq from changes)
        qualify row_number() over (partition by user_id order by seq desc) = 1""",
)
_MERGED = oracle(f"select {_USER_TEXT} from merged where op <> 'D'", "merged")
_USER_NAMES = ("user_id", "email", "first_name", "city", "country", "consent_email", "signup_date", "updated_at")


def _changes(m: Models) -> DataFrame:
    changes = m.raw("user_changes")
    return changes.toDF(*[name.lower() for name in changes.columns]).withColumn("seq", F.col("seq").cast("bigint"))


query("o1_merged_changes", _MERGED)(lambda m: cdc.apply_changes(m.lower_users(), _changes(m), ["user_id"]).select(*_USER_NAMES))


def _streamed(m: Models, compact: bool) -> DataFrame:
    """The same merge as a stream: the feed in several files, worked off in several batches."""
    root = scratch_path(m.spark, "feed")
    users = m.lower_users()
    for number, operation in enumerate(("U", "D", "I")):
        _changes(m).where(F.col("op") == operation).coalesce(1).write.parquet(f"{root}/feed/part={number}")
    target = ChangeTable(m.spark, f"{root}/table", ["user_id"], fold_after=2)
    follow = start_cdc(
        m.spark, f"{root}/feed/part=*", target, users.schema, f"{root}/checkpoint", backfill=users, available_now=True, files_per_batch=1
    )
    follow.awaitTermination()
    if compact:
        target.compact()
    return target.current().select(*_USER_NAMES)


query("o2_streamed_changes", _MERGED)(lambda m: _streamed(m, False))
query("o2_streamed_and_compacted", _MERGED)(lambda m: _streamed(m, True))


def _backfilled(m: Models) -> DataFrame:
    target = ChangeTable(m.spark, f"{scratch_path(m.spark, 'backfill')}/table", ["user_id"])
    target.backfill(m.lower_users())
    return target.current().select(*_USER_NAMES)


query("o3_backfill", oracle(f"select {_USER_TEXT} from users", "users"))(_backfilled)
query(
    "o4_insert_missing",
    oracle(
        f"select {_USER_TEXT} from users where cast(substr(user_id, 2) as bigint) % 3 <> 0 union all select user_id, email, first_name, 'SEED' as city, country, consent_email, "
        f"{texts('signup_date', 'updated_at')} from users where cast(substr(user_id, 2) as bigint) % 3 = 0",
        "users",
    ),
)(
    lambda m: (
        lambda u, number: cdc.insert_missing(u.where(number % 3 != 0), u.withColumn("city", F.lit("SEED")), ["user_id"])
    )(m.lower_users().select(*_USER_NAMES), F.expr("substring(user_id, 2)").cast("bigint"))
)

# ---------------------------------------------------------------- M5 and C7: steps and refusals

def _audited_steps(m: Models) -> DataFrame:
    """Three steps over the orders, recorded and read back: one counts them, one finds nothing to do, one fails."""
    layers = Layers(m.spark, scratch_path(m.spark, "audited"))
    layers.ensure("audit", "step_status", audit.STEP_STATUS_SCHEMA)
    orders = m.raw("crm_sales")

    def skip() -> None:
        if orders.where("deal_id = 'none'").isEmpty():
            raise audit.SkipStep("no such deal")

    def fail() -> None:
        raise ValueError(f"{'some' if orders.take(1) else 'no'} rows, sent with Bearer abc")

    for name, step in (("count", orders.count), ("skip", skip), ("fail", fail)):
        with suppress(audit.SkipStep, ValueError):
            audit.audited(m.spark, lambda row: layers.append(row, "audit", "step_status"), AS_OF, "nightly", "run-1", name, step)
    return layers.read("audit", "step_status").select("task_id", "status", "message", "try_number")


query(
    "m5_audited_steps",
    "select 'count' as task_id, 'SUCCESS' as status, null as message, 1 as try_number union all select 'skip', 'SKIPPED', 'no such deal', 1 "
    "union all select 'fail', 'FAILED', (case when count(*) > 0 then 'some' else 'no' end) || ' rows, sent with Bearer [REDACTED]', 1 from orders",
)(_audited_steps)


def _refused_contract(m: Models) -> DataFrame:
    """A contract with an unknown type is refused before any of its rows is read."""
    try:
        replace(LEADS, columns=(*LEADS.columns, replace(LEADS.columns[0], name="point", type="GEOGRAPHY")))
        refused = False
    except ContractError as error:
        refused = "GEOGRAPHY" in str(error)
    return m.raw("text_leads").agg(F.count(F.lit(1)).alias("unread_rows")).withColumn("refused", F.lit(refused))


query("c7_unknown_type", oracle("select count(*) as unread_rows, true as refused from text_leads", "text_leads"))(_refused_contract)
