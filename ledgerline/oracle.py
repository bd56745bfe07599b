"""DuckDB SQL for every registered query: the correctness oracle.

The views below restate ``ledgerline.sources.shop_tables`` and the models in plain SQL
over the driver's tables (``part``, ``orders``, ... are registered views in DuckDB).
Each query string is ``WITH <views> <select>``; DuckDB ignores views a query does not use.
"""

from __future__ import annotations

VIEWS = {
    "f_items": """
        select p_partkey as item_id, concat(p_name, ' ', cast(p_partkey // 4 as varchar)) as name, p_type as description,
               p_retailprice as unit_price,
               cast(date '2024-01-01' as timestamp) as created_at,
               cast(date '2024-01-01' + p_size as timestamp) as updated_at
        from part""",
    "f_customers": """
        select c_custkey as customer_id, c_name as name,
               concat(lower(replace(c_name, '#', '.')), '@example.com') as email,
               cast(date '2024-01-01' as timestamp) as created_at,
               cast(date '2024-01-01' + c_nationkey as timestamp) as updated_at
        from customer""",
    "f_payment_methods": """
        select distinct cast(split_part(o_orderpriority, '-', 1) as bigint) as payment_method_id,
               substr(o_orderpriority, 3) as name, true as is_active,
               cast(date '2024-01-01' as timestamp) as created_at
        from orders""",
    "f_transactions": """
        select cast(o_orderkey as varchar) as transaction_id, o_custkey as customer_id,
               cast(split_part(o_orderpriority, '-', 1) as bigint) as payment_method_id,
               case when o_orderkey % 2 = 0 then 'In-store' else 'Takeaway' end as location,
               o_totalprice as total_spent,
               case o_orderstatus when 'F' then 'completed' when 'O' then 'pending'
                    else 'cancelled' end as status,
               cast(o_orderdate as timestamp) as created_at,
               cast(o_orderdate as timestamp) as updated_at
        from orders""",
    "f_transaction_items": """
        select cast(l_orderkey as varchar) as transaction_id, l_partkey as item_id,
               cast(l_quantity as bigint) as quantity,
               l_extendedprice / l_quantity as unit_price, l_extendedprice as subtotal,
               cast(l_shipdate as timestamp) as created_at
        from lineitem""",
    "f_sales_dirty": """
        select case when event_id % 97 = 0 then null
                    else concat('TXN_', cast(event_id as varchar)) end as "Transaction ID",
               case when event_id % 11 = 0 then 'ERROR' when event_id % 13 = 0 then 'UNKNOWN'
                    when event_id % 17 = 0 then null
                    when event_id % 59 = 0 then 'a "hot" tea,' || chr(10) || 'big'
                    else concat(p_name, ' ', cast(p_partkey // 4 as varchar)) end as "Item",
               case when event_id % 19 = 0 then 'ERROR' when event_id % 23 = 0 then 'UNKNOWN'
                    when event_id % 47 = 0 then 'two'
                    else cast(1 + event_id % 5 as varchar) end as "Quantity",
               case when event_id % 29 = 0 then 'ERROR'
                    else cast(p_retailprice as varchar) end as "Price Per Unit",
               case when event_id % 31 = 0 then 'UNKNOWN' when event_id % 53 = 0 then 'n/a'
                    else cast(value as varchar) end as "Total Spent",
               case when event_id % 37 = 0 then null when event_id % 2 = 0 then 'In-store'
                    else 'Takeaway' end as "Location",
               case when event_id % 41 = 0 then 'ERROR' when user_id % 3 = 0 then 'Cash'
                    when user_id % 3 = 1 then 'Credit Card'
                    else 'Digital Wallet' end as "Payment Method",
               case when event_id % 43 = 0 then 'UNKNOWN' when event_id % 61 = 0 then '2024-13-45'
                    else cast(cast(ts as date) as varchar) end as "Transaction Date"
        from events left join part on p_partkey = event_id % (select count(*) from part)""",
    "stg_customers": "select distinct customer_id, name, email, created_at, updated_at from f_customers",
    "stg_items": """select distinct item_id, name, description, unit_price, created_at, updated_at
                    from f_items""",
    "stg_payment_methods": """select distinct payment_method_id, name, is_active, created_at
                              from f_payment_methods""",
    "stg_transactions": """
        select distinct transaction_id, customer_id, payment_method_id, total_spent, location,
               status, created_at, updated_at
        from f_transactions""",
    "stg_transaction_items": """
        select distinct transaction_id, item_id, quantity, unit_price, subtotal, created_at
        from f_transaction_items""",
    "sales_complete": """
        select * from f_sales_dirty
        where "Transaction ID" is not null and "Transaction ID" not in ('ERROR', 'UNKNOWN')
          and "Item" is not null and "Item" not in ('ERROR', 'UNKNOWN')
          and "Quantity" is not null and "Quantity" not in ('ERROR', 'UNKNOWN')
          and "Price Per Unit" is not null and "Price Per Unit" not in ('ERROR', 'UNKNOWN')
          and "Total Spent" is not null and "Total Spent" not in ('ERROR', 'UNKNOWN')
          and "Location" is not null and "Location" not in ('ERROR', 'UNKNOWN')
          and "Payment Method" is not null and "Payment Method" not in ('ERROR', 'UNKNOWN')
          and "Transaction Date" is not null and "Transaction Date" not in ('ERROR', 'UNKNOWN')""",
    "sales_typed": """
        select "Transaction ID" as transaction_id, "Item" as item_name,
               try_cast("Quantity" as bigint) as quantity,
               try_cast("Price Per Unit" as double) as unit_price,
               try_cast("Total Spent" as double) as total_spent,
               "Location" as location, "Payment Method" as payment_method,
               try_cast("Transaction Date" as date) as transaction_date
        from sales_complete""",
    "stg_static": """
        select distinct * from sales_typed
        where quantity is not null and unit_price is not null and total_spent is not null
          and transaction_date is not null""",
    "dim_ti": """
        select transaction_id, item_id, quantity, unit_price, subtotal, created_at
        from stg_transaction_items
        union all
        select s.transaction_id, i.item_id, s.quantity, s.unit_price, s.total_spent as subtotal,
               cast(s.transaction_date as timestamp) as created_at
        from stg_static s left join stg_items i on s.item_name = i.name""",
    "fct": """
        select t.transaction_id, t.customer_id, p.name as payment_method_name, t.location,
               t.total_spent, t.created_at, t.updated_at,
               cast(t.created_at as date) as transaction_date
        from stg_transactions t
        left join stg_payment_methods p on t.payment_method_id = p.payment_method_id
        union all
        select transaction_id, cast(null as bigint) as customer_id,
               payment_method as payment_method_name, location, total_spent,
               cast(null as timestamp) as created_at, cast(null as timestamp) as updated_at,
               transaction_date
        from stg_static""",
    "item_qty": """
        select i.name as item_name, cast(sum(t.quantity) as bigint) as total_quantity
        from dim_ti t left join stg_items i on t.item_id = i.item_id
        group by i.name""",
    "req_h": """
        select cast(o.o_orderkey as varchar) as request_id,
               case when o.o_orderkey % 101 = 0 then '   '
                    when o.o_orderkey % 89 = 0
                         then concat('new.', cast(o.o_custkey as varchar), '@shop.example')
                    when o.o_orderkey % 10 = 3 then concat('  ', upper(c.email), ' ')
                    else c.email end as customer_email,
               case when o.o_orderkey % 53 = 0 then 'Bitcoin'
                    else substr(o.o_orderpriority, 3) end as payment_method,
               case when o.o_orderkey % 59 = 0 then 'Delivery'
                    when o.o_orderkey % 2 = 0 then 'In-store' else 'Takeaway' end as location,
               cast(o.o_orderdate as timestamp) as created_at,
               cast(o.o_orderdate as timestamp) as updated_at
        from orders o left join f_customers c on o.o_custkey = c.customer_id""",
    "req_l": """
        select cast(l_orderkey as varchar) as request_id, l_linenumber as line_no,
               case when l_orderkey % 67 = 0 and l_linenumber = 1 then 'Unknown Gadget'
                    when l_orderkey % 71 = 0 and l_linenumber = 1 then '  '
                    when l_orderkey % 7 = 1 then concat(' ', p_name, ' ', cast(p_partkey // 4 as varchar), ' ')
                    else concat(p_name, ' ', cast(p_partkey // 4 as varchar)) end as item_name,
               case when l_orderkey % 61 = 0 and l_linenumber = 1 then cast(0 as bigint)
                    else cast(l_quantity as bigint) end as quantity
        from lineitem left join part on l_partkey = p_partkey""",
    "latest_items": """
        select * from (select *, row_number() over (partition by name
                                                    order by updated_at desc nulls last,
                                                             item_id desc nulls last) as rn
                       from f_items) where rn = 1""",
    "latest_pm": """
        select * from (select *, row_number() over (partition by name
                                                    order by created_at desc nulls last,
                                                             payment_method_id desc nulls last) as rn
                       from f_payment_methods) where rn = 1""",
    "priced": """
        select l.request_id, l.item_name, l.quantity, l.name_norm, li.item_id, li.unit_price,
               (l.item_name is null or length(l.name_norm) = 0
                or length(l.item_name) > 100) as bad_name,
               (l.quantity is null or l.quantity <= 0) as bad_qty,
               (li.item_id is null
                and not (l.item_name is null or length(l.name_norm) = 0)) as no_item
        from (select *, regexp_replace(item_name, '^\\s+|\\s+$', '', 'g') as name_norm
              from req_l) l
        left join latest_items li on l.name_norm = li.name""",
    "summ": """
        select request_id, count(*) as n_lines, count(name_norm) as n_names,
               count(distinct name_norm) as n_distinct_names,
               max(cast(bad_name as int)) as any_bad_name,
               max(cast(bad_qty as int)) as any_bad_qty,
               max(cast(no_item as int)) as any_no_item
        from priced group by request_id""",
    "req_t": """
        select h.*, lower(regexp_replace(h.customer_email, '^\\s+|\\s+$', '', 'g')) as email_norm,
               length(regexp_replace(h.customer_email, '^\\s+|\\s+$', '', 'g')) as email_len,
               p.payment_method_id, s.n_lines, s.n_names, s.n_distinct_names,
               s.any_bad_name, s.any_bad_qty, s.any_no_item
        from req_h h left join latest_pm p on h.payment_method = p.name
        left join summ s on h.request_id = s.request_id""",
    "req_msg": """
        select *, nullif(concat_ws('; ',
            case when customer_email is null or email_len = 0
                 then 'Customer email cannot be empty' end,
            case when length(customer_email) > 100 then 'Customer email is longer than 100' end,
            case when coalesce(n_lines, 0) < 1 then 'At least one item is required' end,
            case when any_bad_name = 1 then 'Item name cannot be empty or longer than 100' end,
            case when any_bad_qty = 1 then 'Quantity must be greater than 0' end,
            case when n_names != n_distinct_names
                 then 'Duplicate items are not allowed in the same transaction' end,
            case when length(payment_method) > 50 then 'Payment method is longer than 50' end,
            case when location is null or location not in ('In-store', 'Takeaway')
                      or length(location) > 255
                 then 'Location must be either "In-store" or "Takeaway"' end,
            case when payment_method_id is null then 'Payment method not found' end,
            case when any_no_item = 1 then 'Item not found' end), '') as error_message
        from req_t""",
    "req_good": "select * from req_msg where error_message is null",
    "new_cust": """
        select ('0x' || substr(md5(email), 1, 15))::bigint as customer_id,
               split_part(email, '@', 1) as name, email, first_at as created_at,
               first_at as updated_at
        from (select email_norm as email, min(created_at) as first_at from req_good group by 1) e
        where email not in (select email from f_customers where email is not null)""",
    "static_checked": """
          select "Transaction ID" as transaction_id, "Item" as item, "Quantity" as quantity,
                 "Price Per Unit" as price_per_unit, "Total Spent" as total_spent,
                 "Payment Method" as payment_method, "Location" as location,
                 "Transaction Date" as transaction_date,
                 nullif(concat_ws('; ',
                   case when "Transaction ID" is null then 'Transaction ID is missing' end,
                   case when length("Transaction ID") > 16 then 'transaction_id is longer than 16' end,
                   case when length("Item") > 20 then 'item is longer than 20' end,
                   case when length("Quantity") > 10 then 'quantity is longer than 10' end,
                   case when length("Price Per Unit") > 10 then 'price_per_unit is longer than 10' end,
                   case when length("Total Spent") > 10 then 'total_spent is longer than 10' end,
                   case when length("Payment Method") > 20 then 'payment_method is longer than 20' end,
                   case when length("Location") > 20 then 'location is longer than 20' end,
                   case when length("Transaction Date") > 10 then 'transaction_date is longer than 10' end
                 ), '') as error_message
          from f_sales_dirty""",
    "lookup_ids": "select distinct cast(event_id * 2 as varchar) as transaction_id from events",
}


def with_views(select: str) -> str:
    body = ",\n".join(f"{name} AS ({sql})" for name, sql in VIEWS.items())
    head = select.lstrip()
    if head[:5].lower() == "with ":  # fold the query's own views into the same WITH
        return f"WITH {body},\n{head[5:]}"
    return f"WITH {body}\n{select}"


QUERIES = {
    # --- analytics (M10–M12, A5, A6, F4, F5) ---
    "monthly_sales": """
        select cast(date_trunc('month', transaction_date) as date) as month,
               count(distinct transaction_id) as order_count,
               sum(cast(total_spent as decimal(38, 9))) as total_sales
        from fct group by 1 order by 1""",
    "item_quantity": "select * from item_qty",
    "item_quantity_table": "select * from item_qty",
    "item_share": """
        select item_name, total_quantity,
               cast(total_quantity as double) / cast(sum(total_quantity) over () as double) as share
        from item_qty""",
    "explore_scan": """
        select transaction_id, customer_id, payment_method_name, location, total_spent,
               created_at, updated_at, cast(transaction_date as timestamp) as transaction_date
        from fct""",
    "count_transactions": "select count(*) as transaction_count from f_transactions",
    "list_transactions": "select * from f_transactions",
    "get_transaction": """
        select * from f_transactions
        where transaction_id in (select transaction_id from lookup_ids)""",
    "get_transaction_missing": """
        select transaction_id from lookup_ids
        where transaction_id not in (select transaction_id from f_transactions)""",
    "table_counts": """
        select 'transaction_items' as table_name, count(*) as row_count from f_transaction_items
        union all select 'transactions', count(*) from f_transactions
        union all select 'transactions_static', count(*) from f_sales_dirty
        union all select 'customers', count(*) from f_customers
        union all select 'items', count(*) from f_items
        union all select 'payment_methods', count(*) from f_payment_methods""",
    # --- staging (M1–M6, F1) ---
    "stg_customers": "select * from stg_customers",
    "stg_items": "select * from stg_items",
    "stg_payment_methods": "select * from stg_payment_methods",
    "stg_transactions": "select * from stg_transactions",
    "stg_transaction_items": "select * from stg_transaction_items",
    "drop_sentinels": "select * from sales_complete",
    "stg_transactions_static": "select * from stg_static",
    # --- marts (M7–M9, W1) ---
    "dim_customers": "select * from stg_customers",
    "dim_items": "select * from stg_items",
    "dim_payment_methods": "select * from stg_payment_methods",
    "dim_transaction_items": "select * from dim_ti",
    "fct_transactions": "select * from fct",
    "latest_by": """
        select item_id, name, description, unit_price, created_at, updated_at from (
            select *, row_number() over (partition by name
                                         order by updated_at desc nulls last,
                                                  item_id desc nulls last) as rn
            from stg_items) where rn = 1""",
}


QUERIES.update({
    # --- incremental (F2, F3, A4, I1, I5, I6, S7) ---
    "newer_than_strict": """
        select distinct * from stg_static
        where transaction_date > (select max(transaction_date) from stg_static
                                  where transaction_date <= date '2024-01-15')""",
    "newer_than_inclusive": """
        select * from fct
        where created_at is not null
          and transaction_date >= (select max(transaction_date) from fct
                                   where transaction_date <= date '1998-06-30')""",
    "high_water": "select max(transaction_date) as high_water from fct",
    "cursor_state": """
        select 'items' as table_name, 'updated_at' as cursor_column,
               strftime(max(updated_at), '%Y-%m-%d %H:%M:%S') as cursor_value from f_items
        union all select 'customers', 'updated_at',
               strftime(max(updated_at), '%Y-%m-%d %H:%M:%S') from f_customers
        union all select 'payment_methods', 'created_at',
               strftime(max(created_at), '%Y-%m-%d %H:%M:%S') from f_payment_methods
        union all select 'transactions', 'updated_at',
               strftime(max(updated_at), '%Y-%m-%d %H:%M:%S') from f_transactions
        union all select 'transaction_items', 'created_at',
               strftime(max(created_at), '%Y-%m-%d %H:%M:%S') from f_transaction_items
        union all select 'transactions_static', 'transaction_date',
               strftime(max(try_cast("Transaction Date" as date)), '%Y-%m-%d') from f_sales_dirty""",
    "incremental_load": """
        with tgt as (select * from f_transactions
                     where updated_at < timestamp '1998-06-01'
                        or (updated_at = timestamp '1998-06-01' and location = 'In-store')),
             m as (select max(updated_at) as m from tgt)
        select s.* from f_transactions s
        where s.updated_at >= (select m from m)
          and not exists (select 1 from tgt t
                          where t.updated_at = (select m from m)
                            and t.transaction_id = s.transaction_id)""",
    "merge_upsert": """
        with tgt as (select * from fct where transaction_date < date '1998-01-01'),
             src as (select transaction_id, customer_id, payment_method_name, location,
                            total_spent + 1.0 as total_spent, created_at, updated_at,
                            transaction_date
                     from fct where transaction_date >= date '1997-12-01'),
             u as (select *, 1 as prio from src union all select *, 2 as prio from tgt)
        select transaction_id, customer_id, payment_method_name, location, total_spent,
               created_at, updated_at, transaction_date
        from (select *, row_number() over (partition by transaction_id order by prio) as rn
              from u) where rn = 1""",
    "merge_moved_partition": """
        with tgt as (select * from fct where transaction_date < date '1998-01-01'),
             src as (select transaction_id, customer_id, payment_method_name, location,
                            total_spent, created_at, updated_at,
                            transaction_date + 40 as transaction_date
                     from fct where transaction_date >= date '1997-12-01'),
             u as (select *, 1 as prio from src union all select *, 2 as prio from tgt)
        select transaction_id, customer_id, payment_method_name, location, total_spent,
               created_at, updated_at, transaction_date
        from (select *, row_number() over (partition by transaction_id order by prio) as rn
              from u) where rn = 1""",
    "append_replace_load": """
        select * from f_transactions where created_at < timestamp '1998-01-01'
        union all
        select * from f_transactions where created_at >= timestamp '1997-12-01'""",
    "schema_guard": """
        select * from fct
        where created_at is null
           or transaction_date >= (select max(transaction_date) from fct
                                   where transaction_date <= date '1998-06-30')""",
})


QUERIES.update({
    # --- quality (R11–R14) ---
    "check_unique": """
        select transaction_id, item_id, count(*) as n from f_transaction_items
        group by transaction_id, item_id having count(*) > 1""",
    "check_fk": """
        select * from f_transactions t
        where customer_id is not null
          and not exists (select 1 from customer c
                          where c.c_acctbal >= 0 and c.c_custkey = t.customer_id)""",
    "check_subtotal": "select * from f_transaction_items where subtotal != quantity * unit_price",
    "validate_static": "select * from static_checked where error_message is not null",
    # --- ingest (M13, J4–J6) ---
    "validate_requests_good": "select request_id, email_norm, payment_method_id, n_lines from req_good",
    "validate_requests_rejected": """
        select request_id, error_message from req_msg where error_message is not null""",
    "upsert_customers": "select * from new_cust",
    "require_payment_method": """
        select h.request_id, h.payment_method, p.payment_method_id
        from req_h h left join latest_pm p on h.payment_method = p.name""",
    "latest_price": "select name, item_id, unit_price from latest_items",
    "ingest_transactions": """
        select substr(sha256(g.request_id), 1, 16) as transaction_id,
               coalesce(c.customer_id, n.customer_id) as customer_id, g.payment_method_id,
               g.location, t.total_spent, 'completed' as status, g.created_at, g.updated_at
        from req_good g
        left join (select email, min(customer_id) as customer_id from f_customers
                   group by email) c on g.email_norm = c.email
        left join new_cust n on g.email_norm = n.email
        left join (select request_id,
                          cast(sum(cast(unit_price * quantity as decimal(38, 9))) as double)
                            as total_spent
                   from priced where request_id in (select request_id from req_good)
                   group by request_id) t on g.request_id = t.request_id""",
    "ingest_items": """
        select substr(sha256(p.request_id), 1, 16) as transaction_id, p.item_id, p.quantity,
               p.unit_price, p.unit_price * p.quantity as subtotal, g.created_at
        from priced p join req_good g on p.request_id = g.request_id""",
    "ingest_errors": """
        select substr(sha256(request_id), 1, 16) as transaction_id, customer_email,
               payment_method, location, cast(created_at as varchar) as transaction_date,
               error_message
        from req_msg where error_message is not null""",
})


QUERIES.update({
    # --- connectors (S2–S5, S13, S16, S17) ---
    "csv_import": "select * exclude (error_message) from static_checked where error_message is null",
    "load_if_empty": "select * exclude (error_message) from static_checked where error_message is null",
    "json_array_import": "select * from f_items",
    "lake_snapshot": "select * from f_transactions",
    "reset_tables": """
        select table_name, rows_before, cast(0 as bigint) as rows_after from (
          select 'transaction_items' as table_name, count(*) as rows_before from f_transaction_items
          union all select 'transactions', count(*) from f_transactions
          union all select 'transactions_static', count(*) from static_checked
                    where error_message is null
          union all select 'transactions_errors', count(*) from static_checked
                    where error_message is not null
          union all select 'customers', count(*) from f_customers
          union all select 'items', count(*) from f_items
          union all select 'payment_methods', count(*) from f_payment_methods)""",
    # --- whole hourly run (M16) and the streaming load (I8) ---
    "hourly_run": "select * from fct",
    "hourly_run_exclude_static": "select * from dim_ti",
    "load_report": """
        select 'stg_transactions_static' as model, count(*) as row_count from stg_static
        union all select 'dim_customers', count(*) from stg_customers
        union all select 'dim_items', count(*) from stg_items
        union all select 'dim_payment_methods', count(*) from stg_payment_methods
        union all select 'dim_transaction_items', count(*) from dim_ti
        union all select 'fct_transactions', count(*) from fct""",
    "stream_load": "select * from f_transactions",
})


QUERIES.update({
    # --- faults mended: merges, replaces, quarantines, keys ---
    "merge_null_keys": """
        with d as (select case when cast(transaction_id as bigint) % 13 != 0 then transaction_id end as k,
                          location, total_spent, strftime(created_at, '%Y:%m') as month
                   from f_transactions)
        select * from d union all select * from d where k is null and month like '1997:%'""",
    "merge_text_partition": """
        select transaction_id as k, location, total_spent,
               case when year(created_at) = 1997 then 'moved: a/b=c'
                    else strftime(created_at, '%Y:%m') end as month
        from f_transactions where cast(transaction_id as bigint) % 13 != 0""",
    "replace_partitioned": """
        select case when cast(transaction_id as bigint) % 13 != 0 then transaction_id end as k,
               location, total_spent, strftime(created_at, '%Y:%m') as month
        from f_transactions where created_at >= timestamp '1997-12-01'""",
    "full_refresh": "select * from stg_static where transaction_date > date '2024-01-15'",
    "cursor_quarantine": """
        select distinct * from (
          select 'transactions' as table_name, transaction_id as row_key,
                 'updated_at is missing or no value' as error_message
          from f_transactions where cast(transaction_id as bigint) % 23 = 0
          union all
          select 'transactions_static', coalesce("Transaction ID", ''),
                 'transaction_date is missing or no date'
          from (select distinct * from f_sales_dirty)
          where try_cast("Transaction Date" as date) is null and "Transaction ID" is not null)
        union all
        select 'transactions_static', '', 'transaction_date is missing or no date'
        from (select distinct * from f_sales_dirty
              where try_cast("Transaction Date" as date) is null and "Transaction ID" is null)""",
    "fanout_hot_key": """
        select s.transaction_id, i.item_id, count(*) as n, cast(sum(s.quantity) as bigint) as quantity
        from stg_static s left join (select cast(7 as bigint) as item_id, split_part(name, ' ', 1) as name
                                     from stg_items) i on split_part(s.item_name, ' ', 1) = i.name
        group by 1, 2""",
    "integrity_report": """
        with c as (select * from f_customers
                   where customer_id not in (select c_custkey from customer where c_acctbal < 0)),
             u as (
          select 'transactions_static.transaction_id' as rule, count(*) as violations from (
            select "Transaction ID" from f_sales_dirty where "Transaction ID" is not null group by 1 having count(*) > 1)
          union all select 'items.item_id', count(*) from (select item_id from f_items group by 1 having count(*) > 1)
          union all select 'customers.customer_id', count(*) from (select customer_id from c group by 1 having count(*) > 1)
          union all select 'customers.email', count(*) from (select email from c group by 1 having count(*) > 1)
          union all select 'payment_methods.payment_method_id', count(*) from (
            select payment_method_id from f_payment_methods group by 1 having count(*) > 1)
          union all select 'payment_methods.name', count(*) from (select name from f_payment_methods group by 1 having count(*) > 1)
          union all select 'transactions.transaction_id', count(*) from (select transaction_id from f_transactions group by 1 having count(*) > 1)
          union all select 'transaction_items.transaction_id, item_id', count(*) from (
            select transaction_id, item_id from f_transaction_items group by 1, 2 having count(*) > 1)
          union all select 'transactions.customer_id', count(*) from f_transactions
            where customer_id is not null and customer_id not in (select customer_id from c)
          union all select 'transactions.payment_method_id', count(*) from f_transactions
            where payment_method_id not in (select payment_method_id from f_payment_methods)
          union all select 'transaction_items.transaction_id', count(*) from f_transaction_items
            where transaction_id not in (select transaction_id from f_transactions)
          union all select 'transaction_items.item_id', count(*) from f_transaction_items
            where item_id not in (select item_id from f_items))
        select * from u""",
    "static_quarantine": """
        select c."Transaction ID" as transaction_id, c."Item" as item, c."Quantity" as quantity,
               c."Price Per Unit" as price_per_unit, c."Total Spent" as total_spent,
               c."Payment Method" as payment_method, c."Location" as location,
               c."Transaction Date" as transaction_date,
               concat_ws('; ',
                 case when try_cast("Quantity" as bigint) is null then 'Quantity is not an integer' end,
                 case when try_cast("Price Per Unit" as double) is null then 'Price Per Unit is not a number' end,
                 case when try_cast("Total Spent" as double) is null then 'Total Spent is not a number' end,
                 case when try_cast("Transaction Date" as date) is null then 'Transaction Date is not a date' end
               ) as error_message
        from sales_complete c
        where try_cast("Quantity" as bigint) is null or try_cast("Price Per Unit" as double) is null
           or try_cast("Total Spent" as double) is null or try_cast("Transaction Date" as date) is null""",
    "static_accounting": """
        with t as (select (select count(*) from f_sales_dirty) as n, (select count(*) from sales_complete) as c,
                          (select count(*) from sales_typed where quantity is not null and unit_price is not null
                             and total_spent is not null and transaction_date is not null) as g)
        select 'incomplete' as fate, n - c as row_count from t
        union all select 'rejected', c - g from t union all select 'good', g from t""",
    "import_errors": """
        select * from static_checked where error_message is not null
        union all
        select null, null, null, null, null, null, null, null,
               'Malformed row: BAD_' || event_id || ',tea,1,2.0,2.0,In-store,Cash,2024-01-01,extra'
        from events where event_id % 101 = 0""",
    "import_error_ids": """
        with n as (select (select count(*) from static_checked where error_message is not null)
                          + (select count(*) from events where event_id % 101 = 0) as n)
        select n, n as n_ids from n""",
    "add_customers": """
        with b as (select customer_id + 1000000000 as customer_id, name,
                          case when customer_id % 5 = 0 then email when customer_id % 7 = 0 then 'twice@shop.example'
                               when customer_id % 11 = 0 then chr(160)
                               else 'n' || customer_id || '@shop.example' end as email, created_at, updated_at
                   from f_customers)
        select b.*, nullif(concat_ws('; ',
                 case when email = chr(160) then 'Customer email cannot be empty' end,
                 case when length(name) > 100 then 'Customer name is longer than 100' end,
                 case when email in (select email from f_customers) then 'Customer email already exists' end,
                 case when count(*) over (partition by email) > 1 then 'Customer email repeated in the batch' end),
               '') as error_message
        from b""",
    "add_payment_methods": """
        with b as (select p_partkey + 100 as payment_method_id,
                          case when p_partkey % 4 = 0 then p_type else p_name || ' ' || p_partkey end as name,
                          p_partkey % 3 != 0 as is_active, timestamp '2024-02-01' as created_at from part
                   union all select payment_method_id + 50, name, is_active, created_at from f_payment_methods)
        select b.*, nullif(concat_ws('; ',
                 case when length(name) > 50 then 'Payment method is longer than 50' end,
                 case when name in (select name from f_payment_methods) then 'Payment method already exists' end,
                 case when count(*) over (partition by name) > 1 then 'Payment method repeated in the batch' end),
               '') as error_message
        from b""",
    "hourly_rows_appended": """
        select 'items' as table_name, cast(0 as bigint) as rows_appended
        union all select 'transactions', count(*) from f_transactions where updated_at >= timestamp '1998-01-01'
        union all select 'transaction_items', count(*) from f_transaction_items where created_at >= timestamp '1998-01-01'
        union all select 'customers', 0 union all select 'payment_methods', 0
        union all select 'transactions_static', 0""",
    "stream_load_rejected": """
        select transaction_id as row_key from f_transactions where cast(transaction_id as bigint) % 23 = 0""",
})
QUERIES["ingest_nested"] = QUERIES["ingest_transactions"]
QUERIES["stream_load"] = "select * from f_transactions where cast(transaction_id as bigint) % 23 != 0"


_FCT = """transaction_id, customer_id, payment_method_name, location, total_spent, created_at, updated_at, transaction_date"""

QUERIES.update({
    # --- versioned tables, stored cursors and the run kept up by deltas ---
    "merge_crash_safe": f"""
        with tgt as (select * from fct where transaction_date < date '1998-01-01'),
             src as (select * replace (total_spent + 1.0 as total_spent) from fct where transaction_date >= date '1997-12-01'),
             u as (select *, 1 as prio from src union all select *, 2 as prio from tgt)
        select {_FCT}, 'after the crash' as seen from tgt
        union all
        select {_FCT}, 'after the merge' from (select *, row_number() over (partition by transaction_id order by prio) as rn
                                               from u) where rn = 1""",
    "merge_versioned_moved": QUERIES["merge_moved_partition"],
    "state_resume": "select * from f_transactions",
    "stored_cursors": """
        with c as (
          select 'items' as table_name, 'updated_at' as cursor_column, cast(item_id as varchar) as k,
                 strftime(updated_at, '%Y-%m-%d %H:%M:%S') as v from f_items
          union all select 'customers', 'updated_at', cast(customer_id as varchar), strftime(updated_at, '%Y-%m-%d %H:%M:%S')
                    from f_customers
          union all select 'payment_methods', 'created_at', cast(payment_method_id as varchar),
                    strftime(created_at, '%Y-%m-%d %H:%M:%S') from f_payment_methods
          union all select 'transactions', 'updated_at', transaction_id, strftime(updated_at, '%Y-%m-%d %H:%M:%S')
                    from f_transactions
          union all select 'transaction_items', 'created_at', concat(transaction_id, ' ', item_id),
                    strftime(created_at, '%Y-%m-%d %H:%M:%S') from f_transaction_items
          union all select 'transactions_static', 'transaction_date', coalesce("Transaction ID", '-'),
                    strftime(try_cast("Transaction Date" as date), '%Y-%m-%d') from f_sales_dirty)
        select table_name, cursor_column, v as cursor_value, count(distinct k) as keys_on_mark
        from c where v = (select max(v) from c as d where d.table_name = c.table_name) group by 1, 2, 3""",
    "incremental_facts": "select * from fct",
    "incremental_transaction_items": "select * from dim_ti",
    "dashboard_monthly": QUERIES["monthly_sales"],
    "dashboard_item_quantity": "select * from item_qty",
    "run_ledger": """
        with t as (
          select 'items' as t, count(*) as n, count(*) filter (where updated_at < timestamp '2024-01-20') as old, 0 as bad from f_items
          union all select 'transactions', count(*), count(*) filter (where updated_at < timestamp '1998-01-01'), 0 from f_transactions
          union all select 'transaction_items', count(*), count(*) filter (where created_at < timestamp '1998-01-01'), 0
                    from f_transaction_items
          union all select 'customers', count(*), count(*), 0 from f_customers
          union all select 'payment_methods', count(*), count(*), 0 from f_payment_methods
          union all select 'transactions_static', count(*), count(try_cast("Transaction Date" as date)),
                    count(*) - count(try_cast("Transaction Date" as date)) from f_sales_dirty),
             good as (select transaction_date from sales_typed where quantity is not null and unit_price is not null
                        and total_spent is not null and transaction_date is not null),
             s as (select (select count(*) from f_sales_dirty) as n,
                          count(*) filter (where transaction_date > date '2024-01-15') as fresh,
                          count(*) filter (where transaction_date <= date '2024-01-15') as old from good)
        select concat('extract_', t) as step, 'done' as status, n as rows_read, n as rows_written, cast(0 as bigint) as rows_known,
               cast(0 as bigint) as rows_rejected, true as adds_up from t
        union all select concat('load_', t), 'done', n, n - old - bad, old, cast(bad as bigint), true from t
        union all select 'stg_transactions_static', 'done', n, fresh, old, n - fresh - old, true from s""",
    "late_static": """
        with m as (select max(transaction_date) as m from stg_static
                   where transaction_date <= date '2024-01-15' and payment_method != 'Cash')
        select distinct 'transactions_static' as table_name, transaction_id as row_key,
               'transaction_date is not after those loaded before' as error_message
        from stg_static, m where transaction_date <= m and payment_method = 'Cash'""",
    "static_fates": """
        with m as (select max(transaction_date) as m from stg_static
                   where transaction_date <= date '2024-01-15' and payment_method != 'Cash'),
             g as (select payment_method, transaction_date from sales_typed where quantity is not null and unit_price is not null
                     and total_spent is not null and transaction_date is not null),
             f as (select case when transaction_date > m then 'new' when payment_method = 'Cash' then 'late' else 'known' end as fate
                   from g, m)
        select fate, count(*) as row_count from f group by 1
        union all select 'rejected', (select count(*) from sales_complete) - (select count(*) from g)
        union all select 'incomplete', (select count(*) from f_sales_dirty) - (select count(*) from sales_complete)""",
})


_SEVEN = QUERIES["reset_tables"].split("from (", 1)[1].rsplit(")", 1)[0]

QUERIES.update({
    # --- catalog tables, reload after a reset, kept results, whole rejected requests ---
    "catalog_monthly_sales": QUERIES["monthly_sales"],
    "catalog_publish": QUERIES["merge_moved_partition"],
    "catalog_truncate": QUERIES["reset_tables"],
    "reset_and_reload": f"""
        select table_name, rows_before,
               case when table_name in ('items', 'customers', 'payment_methods', 'transactions') then rows_before
                    else 0 end as rows_reloaded
        from ({_SEVEN})""",
    "kept_results": """
        with a as (select *, 1 as load from fct where transaction_date < date '1998-01-01' union all select *, 2 from fct)
        select cast(date_trunc('month', transaction_date) as date) as month, count(distinct transaction_id) as order_count,
               sum(cast(total_spent as decimal(38, 9))) as total_sales, load
        from a group by 1, load""",
    "default_dates": """
        select count(*) as n, count(*) filter (where "Transaction Date" = 'UNKNOWN') as n_today from f_sales_dirty""",
    "ingest_error_items": """
        select substr(sha256(request_id), 1, 16) as transaction_id, line_no, item_name, quantity
        from req_l where request_id in (select request_id from req_msg where error_message is not null)""",
    "ingest_error_bodies": """
        with q as (select x, replace(replace(x, chr(92), chr(92) || chr(92)), '"', chr(92) || '"') as e
                   from (select item_name as x from req_l union select customer_email from req_h
                         union select payment_method from req_h)),
             i as (select request_id, string_agg(concat('{"item_name":"', e, '","quantity":', quantity, '}'), ','
                                                 order by line_no, item_name, quantity) as items
                   from req_l join q on x = item_name group by 1)
        select substr(sha256(m.request_id), 1, 16) as transaction_id,
               concat('{"customer_email":"', a.e, '","items":[', coalesce(i.items, ''), '],"payment_method":"', b.e,
                      '","location":"', m.location, '","created_at":"', strftime(m.created_at, '%Y-%m-%d %H:%M:%S'), '"}') as body
        from req_msg m left join i on i.request_id = m.request_id join q a on a.x = customer_email
        join q b on b.x = payment_method
        where error_message is not null""",
})


def oracle_sql() -> dict[str, str]:
    return {name: with_views(sql) for name, sql in QUERIES.items()}
