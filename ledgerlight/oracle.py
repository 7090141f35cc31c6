"""The registered queries in DuckDB SQL, written independently of the DataFrame plans.

Every statement starts from the raw test tables. Where a plan is clever (monthly
changes instead of month × subscription pairs, merges by flags, schedules by
``sequence``), the SQL takes the plain way.
"""

from __future__ import annotations

from ledgerlight.plans.quality import MAX_LENGTH

AS_OF = "date '2001-12-01'"
AS_OF_EPOCH = 1007164800
FIRST_SYNC = "timestamp '2000-01-01'"
FIRST_SYNC_EPOCH = 946684800
SECOND_SYNC = "timestamp '2001-12-01'"
PERIOD = 2592000

_CANCEL = "case when o_orderstatus = 'F' then o_orderdate + to_days(cast(o_orderkey % 151 as integer)) end"
_STATUS = "case when o_orderstatus = 'F' then 'canceled' else 'active' end"
_PLAN = (
    "case o_orderpriority when '1-URGENT' then 'enterprise' when '2-HIGH' then 'professional' "
    "when '5-LOW' then 'legacy' else 'starter' end"
)
_CENTS = (
    "cast(case o_orderpriority when '1-URGENT' then 29900 when '2-HIGH' then 9900 "
    "when '5-LOW' then 1900 else 2900 end as integer)"
)


def _hash(prefix: str, value: str) -> str:
    return f"'{prefix}' || substr(md5({value}), 1, 24)"


def _epoch(ts: str) -> str:
    return f"(epoch_us({ts}) // 1000000)"


def _from_epoch(seconds: str) -> str:
    return f"make_timestamp({seconds} * 1000000)"


def _whole_days(later: str, earlier: str) -> str:
    # microseconds of the difference, truncated toward zero
    return f"cast(trunc((epoch_us({later}) - epoch_us({earlier})) / 86400000000.0) as bigint)"


# Relations derived from the raw tables: name -> (body, relations it reads)
RELATIONS: dict[str, tuple[str, tuple[str, ...]]] = {
    "src_users": (
        """
        select *, case when activated_at is not null and id % 5 < 2 then
                   case when id % 11 < 7 then 'starter' when id % 11 < 9 then 'professional'
                        else 'enterprise' end end as plan
        from (
          select *, case when id % 7 < 5 then created_at + to_hours(1 + id * 31 % 168) end as activated_at
          from (
            select c_custkey as id,
                   (case when c_custkey % 4 = 0 then 'USER' else 'user' end)
                     || c_custkey::varchar || '@example.com' as email,
                   c_name as name, c_mktsegment as company,
                   timestamp '2023-10-01' + to_days(cast(c_custkey % 181 as integer)) as created_at
            from customer))
        """,
        (),
    ),
    "src_subs": (
        f"""
        select o_orderkey as id, o_custkey as user_id, {_hash('sub_', 'o_orderkey::varchar')} as stripe_subscription_id,
               {_PLAN} as plan, {_STATUS} as status, {_CENTS} as mrr_cents,
               o_orderdate as started_at, {_CANCEL} as canceled_at, o_orderdate as created_at
        from orders
        """,
        (),
    ),
    "src_events": (
        """
        select event_id as id, user_id, event_type as event_name, props as event_properties,
               ts - to_days(cast(day(ts) - 1 as integer))
                  + to_days(cast((day(ts) - 1) % (1 + user_id % 30) as integer)) as created_at
        from events
        """,
        (),
    ),
    "src_op_charges": (
        f"""
        select {_hash('ch_', "id::varchar || '-' || n::varchar")} as id,
               {_hash('cus_', 'user_id::varchar')} as customer_id, mrr_cents as amount_cents,
               'succeeded' as status, started_at + to_days(cast(30 * n as integer)) as created_at
        from (
          select *, unnest(range(0, cast(ceil((epoch_us(ends_at) - epoch_us(started_at))
                                             / ({PERIOD} * 1000000.0)) as bigint))) as n
          from (select *, coalesce(canceled_at, {AS_OF}::timestamp) as ends_at from src_subs))
        """,
        ("src_subs",),
    ),
    "pay_customers": (
        f"""
        select {_hash('cus_', 'c_custkey::varchar')} as id,
               case when c_custkey % 3 <> 0 then 'User' || c_custkey::varchar || '@Example.com' end as email,
               c_name as name, 1696118400 + c_custkey % 181 * 86400 as created, 'usd' as currency,
               case when c_custkey % 9 <> 0 then c_mktsegment end as company,
               null::varchar as industry, {FIRST_SYNC} as synced_at
        from customer
        """,
        (),
    ),
    "pay_subs": (
        f"""
        select {_hash('sub_', 'o_orderkey::varchar')} as id, {_hash('cus_', 'o_custkey::varchar')} as customer_id,
               {_STATUS} as status, {_PLAN} as plan_id, {_CENTS} as plan_amount, 'usd' as plan_currency,
               'month' as plan_interval, {_epoch('o_orderdate')} as created, {_epoch(_CANCEL)} as canceled_at,
               {FIRST_SYNC} as synced_at
        from orders
        """,
        (),
    ),
    "pay_periods": (
        f"""
        select *, created + n * {PERIOD} as bills_at
        from (
          select *, unnest(range(0, cast(ceil((coalesce(canceled_at, {AS_OF_EPOCH}) - created)
                                             / {PERIOD}.0) as bigint))) as n
          from pay_subs)
        """,
        ("pay_subs",),
    ),
    "pay_charges": (
        f"""
        select {_hash('ch_', 'id || n::varchar')} as id, customer_id, plan_amount as amount,
               plan_currency as currency, 'succeeded' as status, true as paid, bills_at as created,
               id as subscription_id, {FIRST_SYNC} as synced_at
        from pay_periods
        """,
        ("pay_periods",),
    ),
    "pay_invoices": (
        f"""
        select {_hash('in_', 'id || n::varchar')} as id, customer_id, id as subscription_id,
               plan_amount as amount_due, plan_amount as amount_paid, 'paid' as status, bills_at as created,
               bills_at as period_start, bills_at + {PERIOD} as period_end, {FIRST_SYNC} as synced_at
        from pay_periods
        """,
        ("pay_periods",),
    ),
}


def _sql(body: str, *relations: str) -> str:
    """The statement with the relations it needs in front, each once, dependencies first."""
    needed: list[str] = []

    def visit(name: str) -> None:
        for dependency in RELATIONS[name][1]:
            visit(dependency)
        if name not in needed:
            needed.append(name)

    for relation in relations:
        visit(relation)
    with_list = ",\n".join(f"{name} as ({RELATIONS[name][0]})" for name in needed)
    return f"with {with_list}\n{body}"


def _mrr_by_month() -> str:
    def plan_sum(plan: str) -> str:
        return f"sum(case when s.plan = '{plan}' then s.mrr_cents else 0 end)::double / 100 as mrr_{plan}"

    return _sql(
        f"""
        , spans as (
          select *, date_trunc('month', started_at)::date as first_m,
                 date_trunc('month', canceled_at)::date as gone_m
          from src_subs),
        spine as (
          select first_m as m from spans where first_m is not null
          union select date_trunc('month', {AS_OF})::date)
        select spine.m as "month",
               count(distinct s.id) as active_subscriptions,
               count(distinct s.user_id) as paying_customers,
               sum(s.mrr_cents)::double / 100 as total_mrr,
               round(sum(s.mrr_cents)::double / count(s.mrr_cents) / 100, 6) as avg_mrr_per_customer,
               {plan_sum('starter')}, {plan_sum('professional')}, {plan_sum('enterprise')}
        from spine join spans s
          on s.first_m <= spine.m and (s.gone_m is null or s.gone_m > spine.m)
        group by spine.m
        """,
        "src_subs",
    )


def _user_metrics() -> str:
    return _sql(
        f"""
        select u.id as user_id, u.email, u.name as user_name, u.company, u.created_at as signup_at,
               u.activated_at, u.activated_at is not null as is_activated,
               {_whole_days('u.activated_at', 'u.created_at')} as days_to_activate, u.plan,
               coalesce(e.n, 0)::bigint as total_events, coalesce(e.days, 0)::bigint as active_days,
               e.first_at as first_event_at, e.last_at as last_event_at,
               coalesce(s.mrr, 0)::double as current_mrr, coalesce(s.active, 0) > 0 as is_paying,
               case when coalesce(e.days, 0) = 0 then 'none' when e.days < 5 then 'low'
                    when e.days < 20 then 'medium' else 'high' end as engagement_level
        from src_users u
        left join (select user_id, count(*) as n, count(distinct created_at::date) as days,
                          min(created_at) as first_at, max(created_at) as last_at
                   from src_events group by user_id) e on e.user_id = u.id
        left join (select user_id, max(case when status = 'active' then mrr_cents else 0 end)::double / 100 as mrr,
                          count(*) filter (where status = 'active') as active
                   from src_subs group by user_id) s on s.user_id = u.id
        """,
        "src_users",
        "src_subs",
        "src_events",
    )


def _activation_funnel() -> str:
    return _sql(
        f"""
        , daily as (
          select created_at::date as signup_date, count(*) as signups, count(activated_at) as activated,
                 count(plan) as converted_to_paid,
                 avg({_whole_days('activated_at', 'created_at')}) as avg_days
          from src_users where created_at is not null group by 1)
        select signup_date, signups, activated, converted_to_paid,
               round(100.0 * activated / signups, 2)::double as activation_rate,
               round(100.0 * converted_to_paid / nullif(activated, 0), 2)::double as activation_to_paid_rate,
               round(100.0 * converted_to_paid / signups, 2)::double as signup_to_paid_rate,
               round(avg_days, 1)::double as avg_days_to_activate
        from daily
        """,
        "src_users",
    )


def _revenue_attribution() -> str:
    starts, ends = _from_epoch("s.created"), _from_epoch("s.canceled_at")
    return _sql(
        f"""
        select u.id as user_id, u.email, u.name as user_name, u.company, c.id as stripe_customer_id,
               s.id as stripe_subscription_id, s.plan_id, s.plan_amount::double / 100 as mrr, s.status,
               {starts} as subscription_start_date, {ends} as subscription_end_date,
               {_whole_days(f"coalesce({ends}, {AS_OF}::timestamp)", starts)} as subscription_days,
               u.created_at as signup_at, {_whole_days(starts, 'u.created_at')} as days_to_subscribe
        from src_users u, pay_customers c, pay_subs s
        where lower(u.email) = lower(c.email) and s.customer_id = c.id
        """,
        "src_users",
        "pay_customers",
        "pay_subs",
    )


def _staging() -> dict[str, str]:
    return {
        "stg_users": _sql(
            f"""
            select id as user_id, email, name as user_name, company, created_at as signup_at, activated_at, plan,
                   activated_at is not null as is_activated,
                   {_whole_days('activated_at', 'created_at')} as days_to_activate
            from src_users
            """,
            "src_users",
        ),
        "stg_subscriptions": _sql(
            """
            select id as subscription_id, user_id, stripe_subscription_id, plan, status,
                   mrr_cents::double / 100 as mrr, started_at, canceled_at, created_at,
                   coalesce(status = 'active', false) as is_active
            from src_subs
            """,
            "src_subs",
        ),
        "stg_events": _sql(
            "select id as event_id, user_id, event_name, event_properties, created_at as event_at from src_events",
            "src_events",
        ),
        "stg_stripe_customers": _sql(
            f"""
            select id as stripe_customer_id, email, name as customer_name, {_from_epoch('created')} as created_at,
                   currency, company, industry
            from pay_customers
            """,
            "pay_customers",
        ),
        "stg_stripe_subscriptions": _sql(
            f"""
            select id as stripe_subscription_id, customer_id as stripe_customer_id, status, plan_id,
                   plan_amount::double / 100 as mrr, plan_currency, plan_interval,
                   {_from_epoch('created')} as created_at, {_from_epoch('canceled_at')} as canceled_at,
                   coalesce(status = 'active', false) as is_active
            from pay_subs
            """,
            "pay_subs",
        ),
    }


def _lists(cursor: str, customer: str) -> dict[str, str]:
    page = "select id, email, name, created, currency, company, industry, rest > 100 as has_more from ("
    page += "select *, count(*) over () as rest from pay_customers where {where}) order by id limit 100"
    newest = "order by created desc, id limit 100"
    subs = (
        "select id, customer_id, status, plan_id, plan_amount, plan_currency, plan_interval, created, canceled_at "
        "from pay_subs {where} order by id limit 100"
    )
    charges = "select * exclude (synced_at) from pay_charges {where} " + newest
    invoices = "select * exclude (synced_at) from pay_invoices {where} " + newest
    of_customer = f"where customer_id = '{customer}'"
    return {
        "list_customers_page": _sql(page.format(where=f"id > '{cursor}'"), "pay_customers"),
        "list_customers_page_clustered": _sql(page.format(where=f"id > '{cursor}'"), "pay_customers"),
        "list_customers_pages": _sql(
            """
            , r as (select * exclude (synced_at), row_number() over (order by id) as place, count(*) over () as n from pay_customers)
            select c.id as cursor, (r.place - c.place)::integer as rank, r.id, r.email, r.name, r.created, r.currency,
                   r.company, r.industry, c.place + 10 < c.n as has_more
            from r c join r on r.place between c.place + 1 and c.place + 10
            """,
            "pay_customers",
        ),
        "list_customers_first_page": _sql(page.format(where="true"), "pay_customers"),
        "list_customers_unknown_cursor": _sql(page.format(where="true"), "pay_customers"),
        "list_subscriptions": _sql(subs.format(where=""), "pay_subs"),
        "list_subscriptions_by_status": _sql(subs.format(where="where status = 'canceled'"), "pay_subs"),
        "list_charges": _sql(charges.format(where=""), "pay_charges"),
        "list_charges_by_customer": _sql(charges.format(where=of_customer), "pay_charges"),
        "list_invoices": _sql(invoices.format(where=""), "pay_invoices"),
        "list_invoices_by_customer": _sql(invoices.format(where=of_customer), "pay_invoices"),
    }


def _constraints(tables: dict[str, str]) -> str:
    """Rows of all checks of the given tables, by relation."""
    keys = " union all ".join(
        f"""
        select 'unique' as "check", '{name}' as "table", 'id' as "column",
               (select count(*) from (select id from {rel} where id is not null group by id having count(*) > 1))
                 as violations
        union all select 'not_null', '{name}', 'id', (select count(*) from {rel} where id is null)
        union all select 'not_empty', '{name}', '*',
                         (select case when count(*) = 0 then 1 else 0 end from {rel})
        """
        for name, rel in tables.items()
    )
    users = tables["users"]
    others = f"""
        select 'unique', 'users', 'email',
               (select count(*) from (select email from {users} where email is not null
                                      group by email having count(*) > 1))
        union all select 'not_null', 'users', 'email', (select count(*) from {users} where email is null)
        union all select 'not_null', 'users', 'created_at', (select count(*) from {users} where created_at is null)
        """
    lengths = " union all ".join(
        f"select 'max_length', '{name}', '{column}', (select count(*) from {rel} where length({column}) > {limit})"
        for name, rel in tables.items()
        for column, limit in MAX_LENGTH[name].items()
    )
    orphans = " union all ".join(
        f"""
        select 'foreign_key', '{name}', 'user_id',
               (select count(*) from {tables[name]} x where x.user_id is not null
                and not exists (select 1 from {users} u where u.id = x.user_id))
        """
        for name in ("subscriptions", "events")
    )
    return f"{keys} union all {others} union all {lengths} union all {orphans}"


def _kpis() -> dict[str, str]:
    tables = {
        "users": "src_users",
        "subscriptions": "src_subs",
        "events": "src_events",
        "stripe_charges": "src_op_charges",
        "stripe.customers": "pay_customers",
        "stripe.subscriptions": "pay_subs",
        "stripe.charges": "pay_charges",
        "stripe.invoices": "pay_invoices",
    }
    counts = " union all ".join(
        f"select '{name}' as table_name, count(*) as row_count from {relation}"
        for name, relation in tables.items()
    )
    # Only subscription records can lack a field: legacy ones have no plan
    missing = {
        "customers": dict.fromkeys(("id", "email", "name", "created", "currency"), "0"),
        "subscriptions": dict.fromkeys(("id", "customer", "status", "created"), "0")
        | dict.fromkeys(
            ("plan.id", "plan.amount", "plan.currency", "plan.interval"),
            "(select count(*) from pay_subs where plan_id = 'legacy')",
        ),
        "charges": dict.fromkeys(("id", "customer", "amount", "currency", "status", "paid", "created"), "0"),
        "invoices": dict.fromkeys(
            ("id", "customer", "subscription", "amount_due", "amount_paid", "status", "created", "period_start",
             "period_end"),
            "0",
        ),
    }
    required = " union all ".join(
        f"select 'required', 'landed.{name}', '{field}', {count}"
        for name, fields in missing.items()
        for field, count in fields.items()
    )
    finished = " union all ".join(f"select 'finished', 'landed.{name}', '*', 0" for name in missing)
    quality = f"""
        select "check", "table", "column", violations::bigint as violations
        from ({_constraints(tables)} union all {required} union all {finished})
        """
    # The same checks over tables with faults, see testdata.faulty_sources and faulty_pages
    faulty = {name: f"bad_{name}" for name in ("users", "subscriptions", "events", "stripe_charges")}
    lacking = " union all ".join(
        f"select 'required', 'landed.{name}', '{field}', (select count(*) from {table} where {condition})"
        for name, table, fields in (
            ("customers", "customer", {"id": "false", "email": "c_custkey % 4 = 0", "name": "c_custkey % 6 = 0",
                                       "created": "false", "currency": "false"}),
            ("charges", "orders", {"id": "false", "customer": "o_orderkey % 5 = 0", "amount": "o_orderkey % 7 = 0",
                                   "currency": "false", "status": "false", "paid": "false", "created": "false"}),
            ("invoices", "orders", {"id": "false", "customer": "o_orderkey % 5 = 0", "subscription": "false",
                                    "amount_due": "false", "amount_paid": "o_orderkey % 3 = 0", "status": "false",
                                    "created": "false", "period_start": "false", "period_end": "false"}),
        )
        for field, condition in fields.items()
    )
    more = " union all ".join(f"select 'finished', 'landed.{name}', '*', 1" for name in ("customers", "charges", "invoices"))
    dirty = f"""
        , twice as (select * from src_users union all select * from src_users where id % 10 = 3),
        bad_users as (
          select case when id % 50 <> 7 then id end as id,
                 case when id % 60 = 5 then null when id % 20 = 0 then 'same@example.com'
                      when id % 70 = 1 then repeat('e', 300) else email end as email,
                 case when id % 30 = 1 then repeat('n', 256) else name end as name, company,
                 case when id % 40 <> 2 then created_at end as created_at, activated_at, plan
          from twice),
        bad_subscriptions as (
          select * replace (case when id % 25 = 0 then user_id + 10000000 else user_id end as user_id,
                            case when id % 90 = 1 then repeat('s', 51) else status end as status)
          from src_subs),
        bad_events as (select * from src_events where false),
        bad_stripe_charges as (
          select case when created % 7 = 0 then repeat('c', 260) else id end as id, id as customer_id,
                 'succeeded' as status
          from pay_customers)
        select "check", "table", "column", violations::bigint as violations
        from ({_constraints(faulty)} union all {lacking} union all {more})
        """
    kpi = """
        select (select count(*) from src_users) as total_users,
               (select count(*) from src_users where activated_at is not null) as activated_users,
               (select count(*) from src_subs where status = 'active') as active_subscriptions,
               (select count(*) from src_events) as total_events,
               (select count(*) from src_op_charges) as total_charges,
               (select count(distinct case when activated_at is not null then id end)::double / count(*) * 100
                from src_users) as activation_rate,
               (select count(distinct case when plan is not null then id end)::double
                       / count(distinct case when activated_at is not null then id end) * 100
                from src_users) as conversion_rate,
               (select sum(mrr_cents)::double / 100 from src_subs where status = 'active') as current_mrr
        """
    return {
        "kpi_summary": _sql(kpi, "src_users", "src_subs", "src_events", "src_op_charges"),
        "table_counts": _sql(counts, *tables.values()),
        "data_quality": _sql(quality, *tables.values()),
        "data_quality_pages": """
            with pages as (select distinct c_custkey // 10 as p from customer),
            kept as (select * from pages where p % 9 <> 4),
            found as (
              select 'page_gap' as "check", max(p) - min(p) + 1 - count(*) as violations from kept union all
              select 'page_repeated', 0 union all
              select 'early_end', count(*) from kept where p % 5 = 2 and p < (select max(p) from kept) union all
              select 'page_overlap', count(*) from kept a join kept b on b.p = a.p + 1
                join customer on c_custkey = b.p * 10 where a.p % 6 = 1 union all
              select 'finished', (max(p) % 5 <> 2)::bigint from kept)
            select "check", 'landed.customers' as "table", '*' as "column", violations::bigint as violations from found
            union all
            select 'required', 'landed.customers', unnest(['id', 'email', 'name', 'created', 'currency']), 0::bigint
            """,
        "data_quality_dirty": _sql(dirty, "src_users", "src_subs", "src_events", "pay_customers"),
    }


def _ingest() -> dict[str, str]:
    return {
        "ingest_customers": _sql(
            "select id, coalesce(email, '') as email, name, created, currency, company, industry from pay_customers",
            "pay_customers",
        ),
        "ingest_subscriptions": _sql(
            "select * exclude (synced_at) from pay_subs where plan_id <> 'legacy'", "pay_subs"
        ),
        "ingest_subscriptions_rejects": _sql(
            "select id, 'plan.id, plan.amount, plan.currency, plan.interval' as missing "
            "from pay_subs where plan_id = 'legacy'",
            "pay_subs",
        ),
        "ingest_customers_rejects": f"""
            select {_hash("cus_", "c_custkey::varchar")} as id,
                   concat_ws(', ', case when c_custkey % 4 = 0 then 'email' end,
                             case when c_custkey % 6 = 0 then 'name' end) as missing
            from customer where c_custkey % 4 = 0 or c_custkey % 6 = 0
            """,
        "ingest_charges_rejects": f"""
            select {_hash("x_", "o_orderkey::varchar")} as id,
                   concat_ws(', ', case when o_orderkey % 5 = 0 then 'customer' end,
                             case when o_orderkey % 7 = 0 then 'amount' end) as missing
            from orders where o_orderkey % 5 = 0 or o_orderkey % 7 = 0
            """,
        "ingest_invoices_rejects": f"""
            select {_hash("x_", "o_orderkey::varchar")} as id,
                   concat_ws(', ', case when o_orderkey % 5 = 0 then 'customer' end,
                             case when o_orderkey % 3 = 0 then 'amount_paid' end) as missing
            from orders where o_orderkey % 5 = 0 or o_orderkey % 3 = 0
            """,
        "ingest_charges": _sql("select * exclude (synced_at) from pay_charges", "pay_charges"),
        "ingest_invoices": _sql("select * exclude (synced_at) from pay_invoices", "pay_invoices"),
    }


def _upserts() -> dict[str, str]:
    """Each statement spells out, per column, what is known before and after.

    A row is ``there`` when the first sync knew it and ``again`` when the second one brings it.
    """
    known = f"created < {FIRST_SYNC_EPOCH}"
    pending = f"coalesce(canceled_at >= {FIRST_SYNC_EPOCH}, false)"
    absent, lost = "regexp_matches(id, '[01]$')", "regexp_matches(id, '[23]$')"
    synced = f"case when again then {SECOND_SYNC} else {FIRST_SYNC} end as synced_at"
    merged = {
        "upsert_customers": _sql(
            f"""
            , early as (select *, created < 1696118400 + 90 * 86400 as there, not {absent} as again from pay_customers)
            select id, case when again and {lost} then null else email end as email,
                   case when again then name else 'Old ' || name end as name, created,
                   case when there then currency else 'eur' end as currency,
                   case when there then company else 'moved' end as company, industry, {synced}
            from early where there or again
            """,
            "pay_customers",
        ),
        "upsert_subscriptions": _sql(
            f"""
            , early as (select *, {known} as there, not ({known}) or {pending} as again from pay_subs)
            select id, customer_id, case when again and {lost} then null else status end as status, plan_id,
                   case when there then plan_amount else plan_amount + 100 end as plan_amount,
                   plan_currency, plan_interval, created, canceled_at, {synced}
            from early
            """,
            "pay_subs",
        ),
        # paid is not an update column: it stays as first seen
        "upsert_charges": _sql(
            f"""
            , early as (select *, {known} as there, not {absent} as again from pay_charges)
            select id, customer_id, case when there then amount else amount + 100 end as amount, currency,
                   case when not again then 'failed' when {lost} then null else status end as status,
                   not there as paid, created, subscription_id, {synced}
            from early where there or again
            """,
            "pay_charges",
        ),
        "upsert_invoices": _sql(
            f"""
            , early as (select *, {known} as there, not {absent} as again from pay_invoices)
            select id, customer_id, subscription_id,
                   case when there then amount_due else amount_due + 100 end as amount_due,
                   case when not again then 0 when {lost} then null else amount_paid end as amount_paid,
                   case when again then status else 'open' end as status, created, period_start, period_end, {synced}
            from early where there or again
            """,
            "pay_invoices",
        ),
        # The first page that has a charge inserts it; the last one changes only its status.
        "upsert_charges_replayed": _sql(
            f"""
            select id, customer_id, amount, currency, 'succeeded' as status, false as paid, created, subscription_id,
                   {SECOND_SYNC} as synced_at
            from pay_charges
            """,
            "pay_charges",
        ),
    }
    # However a table is kept, a merge gives the same rows.
    stored = {f"upsert_{t}_stored": merged[f"upsert_{t}"] for t in ("customers", "subscriptions", "charges", "invoices")}
    return merged | stored | {"upsert_charges_appended": merged["upsert_charges"]}


def statements(cursor: str, customer: str) -> dict[str, str]:
    return {
        "mrr_by_month": _mrr_by_month(),
        "mrr_by_month_daily": _mrr_by_month(),
        "user_metrics": _user_metrics(),
        "user_metrics_by_day": _user_metrics(),
        "activation_funnel": _activation_funnel(),
        "revenue_attribution": _revenue_attribution(),
        "revenue_attribution_split": _revenue_attribution(),
        **_staging(),
        **_lists(cursor, customer),
        "invoice_schedule": _sql("select * exclude (synced_at) from pay_invoices", "pay_invoices"),
        "invoice_schedule_daily": _sql("select * exclude (synced_at) from pay_invoices", "pay_invoices"),
        "charge_schedule": _sql("select * exclude (synced_at) from pay_charges", "pay_charges"),
        "operational_charges": _sql("select * from src_op_charges", "src_op_charges"),
        **_kpis(),
        **_ingest(),
        **_upserts(),
    }
