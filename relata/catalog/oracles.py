"""Shared pieces of the DuckDB oracles, written from the model semantics."""

from __future__ import annotations

from relata.catalog.adapters import SQL_AS_OF, SQL_RUN_DATE, ctes

AMOUNT = "try_cast(case when regexp_full_match(trim(deal_amount), '[+-]?[0-9]+(\\.[0-9]+)?') then trim(deal_amount) end as decimal(18,2))"

_LOWER = ", ".join(
    f"{name.upper()} as {name}"
    for name in (
        "user_id", "email", "first_name", "last_name", "gender", "birth_date", "city", "country", "signup_date",
        "consent_email", "income_band", "last_login_at", "source_system", "updated_at",
    )
)

# name -> (derived tables it reads, oracle pieces it reads, text)
PIECES: dict[str, tuple[tuple[str, ...], tuple[str, ...], str]] = {
    "users": (("user_raw",), (), f"select {_LOWER} from user_raw"),
    "versions": (("user_versions",), (), f"select {_LOWER} from user_versions"),
    "stg_sales": (
        ("raw_sales",),
        (),
        f"""select customer_id, user_id, deal_id, lower(trim(deal_stage)) as deal_stage, {AMOUNT} as deal_amount,
            currency, closed_date, owner_region, run_date, source_type, source_file, ingestion_ts
            from raw_sales where run_date is not null""",
    ),
    "stg_support": (
        ("raw_support",),
        (),
        """select ticket_id, user_id, lower(trim(priority)) as priority, lower(trim(status)) as status,
            lower(trim(category)) as category, cast(csat_score as decimal(18,2)) as csat_score,
            run_date, source_type, source_file, ingestion_ts
            from raw_support where run_date is not null""",
    ),
    "stg_events": (
        ("raw_events",),
        (),
        """select event_id, user_id, campaign_id, lower(trim(channel)) as channel, lower(trim(event_type)) as event_type,
            event_ts, run_date, source_type, source_file, ingestion_ts from raw_events where run_date is not null""",
    ),
    "stg_leads": (
        ("raw_leads",),
        (),
        """select external_lead_id, lower(trim(email)) as lead_email, lower(trim(partner_name)) as partner_name,
            cast(lead_score as bigint) as lead_score, lower(trim(utm_source)) as utm_source, created_at, opt_in,
            run_date, source_type, source_file, ingestion_ts from raw_leads where run_date is not null""",
    ),
    "stg_users": (
        (),
        ("users",),
        """select user_id, lower(trim(email)) as email, first_name, last_name, gender, birth_date, city, country,
            signup_date, consent_email = 'Y' as consent_email, income_band, last_login_at, source_system, updated_at
            from users where user_id is not null""",
    ),
    "user_360": (
        (),
        ("stg_users", "stg_sales", "stg_support", "stg_events"),
        f"""select u.user_id, u.email, u.first_name, u.last_name, u.city, u.country, u.signup_date, u.consent_email,
            u.income_band, u.last_login_at,
            coalesce(s.deal_count, 0) as deal_count, coalesce(s.won_deal_count, 0) as won_deal_count,
            coalesce(s.won_revenue, 0) as won_revenue, s.latest_deal_date,
            coalesce(t.ticket_count, 0) as ticket_count, coalesce(t.open_ticket_count, 0) as open_ticket_count,
            t.avg_csat_score,
            coalesce(e.campaign_event_count, 0) as campaign_event_count,
            coalesce(e.high_intent_event_count, 0) as high_intent_event_count, e.latest_campaign_event_ts,
            {SQL_AS_OF} as transformed_at
            from stg_users u
            left join (select user_id, count(*) as deal_count,
                         count(*) filter (where deal_stage = 'won') as won_deal_count,
                         sum(case when deal_stage = 'won' then deal_amount else 0 end) as won_revenue,
                         max(closed_date) as latest_deal_date from stg_sales group by user_id) s on s.user_id = u.user_id
            left join (select user_id, count(*) as ticket_count,
                         count(*) filter (where status <> 'closed') as open_ticket_count,
                         avg(csat_score) as avg_csat_score from stg_support group by user_id) t on t.user_id = u.user_id
            left join (select user_id, count(*) as campaign_event_count,
                         count(*) filter (where event_type in ('click', 'purchase')) as high_intent_event_count,
                         max(event_ts) as latest_campaign_event_ts from stg_events group by user_id) e on e.user_id = u.user_id""",
    ),
    "matches": (
        (),
        ("stg_leads", "stg_users"),
        f"""select l.external_lead_id, l.lead_email, l.partner_name, l.lead_score, l.utm_source, l.created_at, l.opt_in,
            u.user_id as matched_user_id, u.consent_email as matched_user_consent_email,
            case when u.user_id is null then 'prospect' else 'matched_user' end as identity_status,
            l.run_date, {SQL_AS_OF} as transformed_at
            from (select * from stg_leads qualify row_number() over (partition by lead_email, partner_name
                    order by created_at desc nulls last, external_lead_id desc nulls last, lead_score nulls last, utm_source nulls last) = 1) l
            left join stg_users u on u.email = l.lead_email""",
    ),
    "given_segments": (
        (),
        ("stg_users",),
        """select user_id, 'segment_' || cast(cast(substr(user_id, 2) as bigint) % 3 + 1 as varchar) as segment_name,
            cast(cast(substr(user_id, 2) as bigint) % 100 as double) as segment_score
            from stg_users where cast(substr(user_id, 2) as bigint) % 4 = 0""",
    ),
    "audience": (
        (),
        ("user_360", "given_segments", "matches"),
        f"""select (select coalesce(max(run_date), {SQL_RUN_DATE}) from matches) as run_date, 'CAMP_MOCK_1' as campaign_id,
            u.user_id, u.email as lead_email, cast(null as varchar) as salesforce_contact_id,
            coalesce(g.segment_name, case when u.high_intent_event_count >= 2 or u.won_revenue >= 10000 then 'high_value'
              when u.open_ticket_count > 0 then 'support_followup' else 'nurture' end) as segment_name,
            coalesce(g.segment_score, cast(least(100, u.high_intent_event_count * 15 + u.won_deal_count * 20 + u.deal_count * 5) as double)) as score,
            'email_consent' as consent_status, 'ready' as activation_status, 'passed' as quality_gate_status,
            'existing_user' as audience_type
            from user_360 u left join given_segments g on g.user_id = u.user_id where u.consent_email is true
            union all
            select run_date, 'CAMP_MOCK_1', matched_user_id, lead_email, null,
            case when lead_score >= 70 then 'partner_hot_lead' else 'partner_nurture' end, cast(lead_score as double),
            'partner_opt_in', 'ready', 'passed', identity_status from matches where opt_in is true""",
    ),
    "features": (
        (),
        ("user_360",),
        f"""select user_id, email, country, income_band, consent_email, deal_count, won_deal_count, won_revenue, ticket_count,
            open_ticket_count, avg_csat_score, campaign_event_count, high_intent_event_count,
            date_diff('day', signup_date, cast({SQL_AS_OF} as date)) as account_age_days,
            date_diff('day', cast(last_login_at as date), cast({SQL_AS_OF} as date)) as days_since_last_login,
            {SQL_AS_OF} as feature_generated_at from user_360""",
    ),
    "sales_clean": (
        ("crm_sales",),
        (),
        f"""select customer_id, user_id, deal_id, upper(trim(deal_stage)) as deal_stage, coalesce({AMOUNT}, 0) as deal_amount,
            currency, closed_date, owner_region from crm_sales where user_id is not null""",
    ),
    "support_clean": (
        ("crm_support",),
        (),
        """select ticket_id, user_id, upper(trim(priority)) as priority, upper(trim(status)) as status, category, csat_score
            from crm_support where user_id is not null""",
    ),
    # The joined form on purpose: the fan-out the Spark side never builds.
    "lean_360": (
        (),
        ("users", "sales_clean", "support_clean"),
        """select u.user_id, max(u.email) as email, max(u.country) as country,
            count(distinct s.deal_id) as sales_deal_count, sum(coalesce(s.deal_amount, 0)) as total_deal_amount,
            count(distinct t.ticket_id) as support_ticket_count, avg(t.csat_score) as avg_csat_score
            from users u left join sales_clean s on s.user_id = u.user_id
            left join support_clean t on t.user_id = u.user_id group by u.user_id""",
    ),
    "deduped_sales": (
        ("crm_sales",),
        (),
        """select * from crm_sales where trim(deal_id) <> '' qualify row_number() over (partition by deal_id order by
            customer_id nulls last, user_id nulls last, deal_stage nulls last, deal_amount nulls last, currency nulls last,
            closed_date nulls last, owner_region nulls last) = 1""",
    ),
    "deduped_support": (
        ("crm_support",),
        (),
        """select * from crm_support where trim(ticket_id) <> '' qualify row_number() over (partition by ticket_id order by
            user_id nulls last, priority nulls last, status nulls last, category nulls last, csat_score nulls last) = 1""",
    ),
    "deduped_events": (
        ("crm_campaign_events",),
        (),
        """select * from crm_campaign_events where trim(event_id) <> '' qualify row_number() over (partition by event_id order by
            user_id nulls last, campaign_id nulls last, channel nulls last, event_type nulls last, event_ts nulls last) = 1""",
    ),
}


def _user_features(users: str) -> str:
    return f"""select u.user_id, u.email, u.first_name, u.last_name, u.city, u.country, u.income_band, u.source_system,
        u.consent_email, u.signup_at, u.last_login_at, u.updated_at,
        coalesce(s.n, 0) as sales_deal_count, coalesce(s.won, 0) as won_deal_count,
        coalesce(s.total, 0) as total_deal_amount, coalesce(s.mean, 0) as avg_deal_amount,
        coalesce(t.n, 0) as support_ticket_count, coalesce(t.mean, 0) as avg_csat_score,
        coalesce(e.n, 0) as campaign_event_count, coalesce(e.clicks, 0) as campaign_click_count, coalesce(e.opens, 0) as campaign_open_count,
        date_diff('day', cast(u.signup_at as date), cast({SQL_AS_OF} as date)) as days_since_signup,
        date_diff('day', cast(u.last_login_at as date), cast({SQL_AS_OF} as date)) as days_since_last_login,
        u.consent_email = 'Y' as can_email
        from (select user_id, lower(trim(email)) as email, first_name, last_name, city, country, income_band, source_system,
                upper(trim(consent_email)) as consent_email, cast(signup_date as timestamp) as signup_at, last_login_at, updated_at
              from {users} where trim(user_id) <> ''
              qualify row_number() over (partition by user_id order by updated_at desc nulls last, lower(trim(email)) nulls last,
                first_name nulls last, last_name nulls last, city nulls last, country nulls last) = 1) u
        left join (select user_id, count(*) as n, count(*) filter (where lower(deal_stage) in ('closed_won', 'won')) as won,
                     sum({AMOUNT}) as total, avg({AMOUNT}) as mean from deduped_sales group by user_id) s on s.user_id = u.user_id
        left join (select user_id, count(*) as n, avg(csat_score) as mean from deduped_support group by user_id) t on t.user_id = u.user_id
        left join (select user_id, count(*) as n, count(*) filter (where lower(event_type) in ('click', 'clicked')) as clicks,
                     count(*) filter (where lower(event_type) in ('open', 'opened')) as opens
                   from deduped_events group by user_id) e on e.user_id = u.user_id"""


_DEDUPED = ("deduped_sales", "deduped_support", "deduped_events")
PIECES["user_features"] = ((), ("users", *_DEDUPED), _user_features("users"))
PIECES["user_features_versions"] = ((), ("versions", *_DEDUPED), _user_features("versions"))


#: Pieces that several later ones read and that are computed once.
STEPS: set[str] = set()


def oracle(select: str, *names: str) -> str:
    """``select`` with the named pieces and derived tables, and all they need, defined before it."""
    views: list[str] = []
    pieces: list[str] = []

    def need(name: str) -> None:
        if name not in PIECES:
            if name not in views:
                views.append(name)
            return
        if name in pieces:
            return
        tables, others, _ = PIECES[name]
        for other in (*tables, *others):
            need(other)
        pieces.append(name)

    for name in names:
        need(name)
    defined = [f"{name} as {'materialized ' if name in STEPS else ''}({PIECES[name][2]})" for name in pieces]
    head = ctes(*views) if views else "with"
    return f"{head}{', ' if views and defined else ' '}{', '.join(defined)} {select}"


def texts(*columns: str) -> str:
    """Days and instants as text."""
    return ", ".join(f"cast({c} as varchar) as {c.split('.')[-1]}" for c in columns)


def doubles(*columns: str) -> str:
    return ", ".join(f"cast({c} as double) as {c.split('.')[-1]}" for c in columns)


def rounded(*columns: str, digits: int = 6) -> str:
    return ", ".join(f"round(cast({c} as double), {digits}) as {c.split('.')[-1]}" for c in columns)
