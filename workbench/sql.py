"""DuckDB twins of the views and operators, as named common table expressions.

``statement(body)`` puts in front of a body every expression it needs, directly
or through others.
"""

from __future__ import annotations

import re

from workbench.flaws import flawed_sql

RAW = {
    "v_lines": """
        select l.*, n_regionkey + 1 as a, cast(substr(p_brand, 7) as int) as s,
               cast(o_orderdate as date) as d,
               case when l_linenumber = 7 and l_tax < 0.005 then 0.0 else l_quantity end as qty,
               l_tax > 0.075 as late,
               printf('TRD%d-%d', l_orderkey, l_linenumber) as tid
        from lineitem l
        join orders on o_orderkey = l_orderkey
        join customer on c_custkey = o_custkey
        join nation on n_nationkey = c_nationkey
        join part on p_partkey = l_partkey""",
    "v_known": "select distinct cast(substr(p_brand, 7) as int) as s from part where cast(substr(p_brand, 7) as int) < 25",
    "v_days": "select distinct cast(o_orderdate as date) as d from orders",
    "v_pairs": "select distinct a, s from v_lines",
    "v_broken": """
        select case o_orderkey % 40 when 11 then printf('{"trade_id": "TRD%d', o_orderkey)
                    when 12 then printf('"order %d"', o_orderkey) else printf('order %d is late', o_orderkey) end as line,
               case o_orderkey % 40 when 12 then 'NOT_A_RECORD' else 'NOT_JSON' end as reason
        from orders where o_orderkey % 40 in (11, 12, 13)""",
    "r_securities": """
        select printf(' sec%03d ', s) as security_id, printf('tkr%d', s) as ticker,
               printf(' Brand %d Inc. ', s) as company_name,
               case when s % 2 = 0 then 'nyse' else ' nasdaq' end as exchange,
               case when s < 13 then 'Technology ' else 'Energy' end as sector, s <> 9 as is_active
        from v_known""",
    "v_price_base": """
        select s, d, 100.0::double + 5 * s + ((37 * (d - date '1995-01-01') + 11 * s) % 23) * 0.5::double as close
        from v_known cross join v_days where day(d) <> s""",
    "r_prices": """
        select printf(' sec%03d', s) as security_id, d::varchar as price_date, close - 0.5 as open_price,
               close + case when s = 11 and day(d) = 15 then -2.0 else 1.0 end as high_price,
               close - 1.5 as low_price, close as close_price,
               cast(1000 * s + (d - date '1995-01-01') as bigint) as volume
        from (select * from v_price_base
              union all
              select s, d, case when s = 6 then close + 0.5 else close end from v_price_base
              where (s = 5 and day(d) = 17) or (s = 6 and day(d) = 18))""",
    "r_corporate_actions": """
        select printf(' CA-SPL-%d', n_nationkey) as corporate_action_id,
               printf('sec%03d', n_nationkey) as security_id, ' stock_split' as action_type,
               (date '1996-01-01' + (n_nationkey * 60)::int)::varchar as effective_date,
               case when n_nationkey % 2 = 0 then 2.0 else 4.0 end::double as split_ratio,
               ' forward split ' as description
        from nation where n_regionkey = 2
        union all
        select 'CA-SPL-3', 'sec002', 'stock_split', '2000-03-01', 0.5::double, 'reverse split'
        from nation where n_nationkey = 3
        union all
        select printf('CA-DIV-%d', s_suppkey), printf('sec%03d', s_suppkey % 24 + 1), 'cash_dividend',
               (date '1995-01-01' + (150 + s_suppkey % 2000)::int)::varchar, null::double, 'dividend'
        from supplier""",
    "r_starting_positions": """
        select printf('acc%03d', a) as account_id, printf('sec%03d ', s) as security_id,
               '1995-01-01' as position_date, (1000 * a + 100 * s)::double as quantity
        from v_pairs where s - a not in (0, 5, 10, 15)""",
    "r_trades": """
        select ' ' || tid as trade_id, printf('acc%03d', a) as account_id,
               printf(' sec%03d ', s) as security_id,
               case when l_returnflag = 'A' then 'b' when l_returnflag = 'R' then 'Buy'
                    when l_linestatus = 'O' then ' SELL ' else 's' end as side,
               qty as quantity,
               case when not (l_linenumber = 6 and l_tax between 0.005 and 0.015)
                    then l_extendedprice / l_quantity end as execution_price,
               d::varchar as trade_date, (d + 2)::varchar as settlement_date,
               d::varchar || 'T10:00:00' as event_timestamp,
               (case when late then d + 3 else d end)::varchar || 'T11:00:00' as ingestion_timestamp,
               case when l_linestatus = 'O' then 'oms_alpha' else ' ems_beta' end as source_system
        from v_lines""",
    "v_factor": """
        select s, d,
               case when day(d) = s then 1.0::double else
                 case when s % 5 = 2 and d < date '1996-01-01' + (s * 60)::int
                      then case when s % 2 = 0 then 2.0::double else 4.0::double end else 1.0::double end
                 * case when s = 2 and d < date '2000-03-01' then 0.5::double else 1.0::double end
               end as f
        from v_known cross join v_days""",
    "v_moves": """
        select a, l.s, case when late then l.d + 3 else l.d end as d,
               sum(case when l_returnflag = 'N' then -qty else qty end * f) as net
        from v_lines l join v_factor f on f.s = l.s and f.d = l.d group by 1, 2, 3""",
    "v_books": """
        select a, s, d, held / f + case
                 when day(d) = 13 and s = a + 7 then 25.0 when day(d) = 27 and s = 2 * a + 1 then 150.0
                 when a = 1 and s % 5 = 2 and d = date '1996-01-01' + (s * 60)::int then 10.0
                 else 0.0 end as quantity
        from (select u.a, u.s, u.d, is_cell,
                     coalesce(case when u.s - u.a not in (0, 5, 10, 15)
                                   then (1000 * u.a + 100 * u.s)::double end, 0.0)
                     * case when u.s = 2 then 1.0 when u.s % 10 = 2 then 2.0 when u.s % 10 = 7 then 4.0 else 1.0 end
                     + sum(net) over (partition by u.a, u.s order by u.d) as held
              from (select a, s, d, 0.0::double as net, true as is_cell from v_pairs cross join v_days where s < 25
                    union all select a, s, d, net, false from v_moves) u) x
        join v_factor using (s, d)
        where is_cell and not (day(d) = a and month(d) in (1, 4, 7, 10))""",
    "r_reported_positions": """
        select printf('ACC%03d ', a) as account_id, printf('sec%03d', s) as security_id,
               d::varchar as position_date, quantity as reported_quantity, 'custody_gamma ' as source_system
        from (select * from v_books
              union all
              select a, s, d, quantity + case when a = 3 then 40.0 else 0.0 end from v_books
              where (a = 3 and s = 7 and day(d) = 21) or (a = 4 and s = 8 and day(d) = 22))""",
    "r_filing_events": """
        select printf(' EVT%d', o_orderkey) as event_id, printf('sec%03d', o_custkey % 24 + 1) as security_id,
               (cast(o_orderdate as date) + case when o_orderpriority = '5-LOW' then 2 else 0 end)::varchar as event_date,
               case o_orderpriority when '1-URGENT' then 'earnings_release' when '2-HIGH' then 'sec_10k'
                    when '3-MEDIUM' then ' sec_10q' when '4-NOT SPECIFIED' then 'dividend_announcement'
                    when '5-LOW' then 'guidance_update ' end as event_type,
               printf(' Order %d has status %s', o_orderkey, o_orderstatus) as event_summary
        from orders""",
    "v_issues": """
        select distinct 'DUPLICATE_TRADE' as issue_type, 'trades' as affected_entity, tid as affected_record_id,
               null::varchar as account_id, null::varchar as security_id, tid as trade_id, null::varchar as issue_date,
               'DUPLICATE_TRADE' as expected_detection_category
        from (select tid from v_lines group by tid having count(*) > 1)
        union all
        select distinct 'LATE_ARRIVING_TRADE', 'trades', tid, null, null, tid, null, 'LATE_ARRIVING_TRADE'
        from v_lines where late
        union all
        select distinct 'INVALID_SECURITY_ID', 'trades', tid, null, null, tid, null, 'UNKNOWN_SECURITY'
        from v_lines where s = 25
        union all
        select distinct 'MISSING_PRICE', 'prices', printf('SEC%03d|%s', s, d::varchar), null, printf('SEC%03d', s), null,
               d::varchar, 'MISSING_PRICE'
        from v_lines where s < 25 and day(d) = s
        union all
        select 'WRONG_REPORTED_POSITION', 'reported_positions', printf('ACC%03d|SEC%03d|%s', a, s, d::varchar),
               printf('ACC%03d', a), printf('SEC%03d', s), null, d::varchar, 'QUANTITY_MISMATCH'
        from v_pairs cross join v_days
        where s < 25 and ((day(d) = 13 and s = a + 7) or (day(d) = 27 and s = 2 * a + 1))""",
    "r_injected_issues_manifest": """
        select 'ISS-' || issue_type || '-' || affected_record_id as issue_id, issue_type, affected_entity,
               affected_record_id, account_id, security_id, trade_id, issue_date, expected_detection_category,
               'built into the view' as short_description
        from v_issues""",
}

CLEAN = {
    "c_securities": """
        select upper(trim(security_id)) as security_id, upper(trim(ticker)) as ticker,
               trim(company_name) as company_name, upper(trim(exchange)) as exchange,
               trim(sector) as sector, is_active from r_securities""",
    "c_prices": """
        select upper(trim(security_id)) as security_id, cast(price_date as date) as price_date,
               open_price, high_price, low_price, close_price, volume from r_prices""",
    "c_corporate_actions": """
        select trim(corporate_action_id) as corporate_action_id, upper(trim(security_id)) as security_id,
               upper(trim(action_type)) as action_type, cast(effective_date as date) as effective_date,
               split_ratio, trim(description) as description from r_corporate_actions""",
    "c_starting_positions": """
        select upper(trim(account_id)) as account_id, upper(trim(security_id)) as security_id,
               cast(position_date as date) as position_date, quantity from r_starting_positions""",
    "c_trades": """
        select trim(trade_id) as trade_id, upper(trim(account_id)) as account_id,
               upper(trim(security_id)) as security_id,
               case when upper(trim(side)) in ('B', 'BUY') then 'BUY'
                    when upper(trim(side)) in ('S', 'SELL') then 'SELL' else upper(trim(side)) end as side,
               quantity, execution_price, cast(trade_date as date) as trade_date,
               cast(settlement_date as date) as settlement_date,
               cast(event_timestamp as timestamp) as event_timestamp,
               cast(ingestion_timestamp as timestamp) as ingestion_timestamp,
               upper(trim(source_system)) as source_system from r_trades""",
    "c_reported_positions": """
        select upper(trim(account_id)) as account_id, upper(trim(security_id)) as security_id,
               cast(position_date as date) as position_date, reported_quantity,
               upper(trim(source_system)) as source_system from r_reported_positions""",
    "c_filing_events": """
        select trim(event_id) as event_id, upper(trim(security_id)) as security_id,
               cast(event_date as date) as event_date, upper(trim(event_type)) as event_type,
               trim(event_summary) as event_summary from r_filing_events""",
}

ADJUSTED = {
    "v_splits": """
        select security_id, effective_date, split_ratio, corporate_action_id
        from c_corporate_actions where action_type = 'STOCK_SPLIT'""",
    "v_factors": """
        select p.security_id, p.price_date,
               coalesce(product(s.split_ratio) filter (where s.split_ratio > 0), 1.0) as split_adjustment_factor
        from (select distinct security_id, price_date from c_prices) p
        left join v_splits s on s.security_id = p.security_id and s.effective_date > p.price_date
        group by 1, 2""",
    "s_prices": """
        select p.*, f as split_adjustment_factor, open_price / f as adjusted_open_price,
               high_price / f as adjusted_high_price, low_price / f as adjusted_low_price,
               close_price / f as adjusted_close_price
        from (select p.*, coalesce(x.split_adjustment_factor, 1.0) as f from c_prices p
              left join v_factors x using (security_id, price_date)) p""",
    "s_starting_positions": """
        select p.account_id, p.security_id, p.position_date, p.quantity,
               coalesce(x.split_adjustment_factor, 1.0) as split_adjustment_factor,
               p.quantity * coalesce(x.split_adjustment_factor, 1.0) as adjusted_quantity
        from c_starting_positions p
        left join v_factors x on x.security_id = p.security_id and x.price_date = p.position_date""",
    "s_trades": """
        select t.*, coalesce(x.split_adjustment_factor, 1.0) as split_adjustment_factor,
               t.quantity * coalesce(x.split_adjustment_factor, 1.0) as adjusted_quantity,
               t.execution_price / coalesce(x.split_adjustment_factor, 1.0) as adjusted_execution_price
        from c_trades t left join v_factors x on x.security_id = t.security_id and x.price_date = t.trade_date""",
    "s_reported_positions": """
        select r.*, coalesce(x.split_adjustment_factor, 1.0) as split_adjustment_factor,
               r.reported_quantity * coalesce(x.split_adjustment_factor, 1.0) as adjusted_reported_quantity
        from c_reported_positions r
        left join v_factors x on x.security_id = r.security_id and x.price_date = r.position_date""",
}


def _trade_flag(kind: str, severity: str, text: str, condition: str) -> str:
    return f"""
        select distinct
               sha256('{kind}' || '||' || coalesce(trade_id, '') || '||' || coalesce(account_id, '') || '||'
                      || coalesce(security_id, '') || '||' || coalesce(trade_date::varchar, '')) as flag_id,
               '{kind}' as flag_type, 'trades' as affected_entity, trade_id as affected_record_id,
               account_id, security_id, trade_date as flag_date, '{severity}' as severity,
               '{text}' as description
        from c_trades where {condition}"""


FLAGS = {
    "f_duplicate": _trade_flag(
        "DUPLICATE_TRADE",
        "HIGH",
        "Duplicate trade_id detected in silver trades.",
        "trade_id in (select trade_id from c_trades group by trade_id having count(*) > 1)",
    ),
    "f_unknown": _trade_flag(
        "UNKNOWN_SECURITY",
        "HIGH",
        "Trade references a security_id not present in securities_clean.",
        "security_id not in (select security_id from c_securities)",
    ),
    "f_missing_price": _trade_flag(
        "MISSING_PRICE",
        "MEDIUM",
        "No matching price record found for trade security_id and trade_date.",
        "security_id in (select security_id from c_securities) and not exists "
        "(select 1 from c_prices p where p.security_id = c_trades.security_id and p.price_date = c_trades.trade_date)",
    ),
    "f_quantity": _trade_flag(
        "INVALID_QUANTITY",
        "HIGH",
        "Trade quantity is null or not strictly positive.",
        "quantity is null or quantity <= 0",
    ),
    "f_price": _trade_flag(
        "INVALID_PRICE",
        "HIGH",
        "Execution price is null or not strictly positive.",
        "execution_price is null or execution_price <= 0",
    ),
    "f_late": _trade_flag(
        "LATE_ARRIVING_TRADE",
        "MEDIUM",
        "Ingestion timestamp date occurs after the trade date.",
        "cast(ingestion_timestamp as date) > trade_date",
    ),
    "v_daily_reports": """
        select account_id, security_id, position_date, min(reported_quantity) as q
        from c_reported_positions group by 1, 2, 3""",
    "f_split": """
        select sha256(concat_ws('||', 'SPLIT_ADJUSTMENT_BREAK', r.account_id, r.security_id,
                                r.position_date::varchar, s.corporate_action_id)) as flag_id,
               'SPLIT_ADJUSTMENT_BREAK' as flag_type, 'reported_positions' as affected_entity,
               concat_ws('|', r.account_id, r.security_id, r.position_date::varchar) as affected_record_id,
               r.account_id, r.security_id, r.position_date as flag_date, 'HIGH' as severity,
               'Reported position does not align with expected split-adjusted quantity around split date.' as description
        from v_daily_reports r
        join v_splits s on s.security_id = r.security_id and s.effective_date = r.position_date
        join lateral (select p.q from v_daily_reports p where p.account_id = r.account_id
                      and p.security_id = r.security_id and p.position_date < r.position_date
                      order by p.position_date desc limit 1) p on true
        where abs(r.q - p.q * s.split_ratio) > 1e-9""",
    "s_flags": """
        select * from f_duplicate union all select * from f_unknown union all select * from f_missing_price
        union all select * from f_quantity union all select * from f_price union all select * from f_late
        union all select * from f_split""",
}

GOLD = {
    "g_valid": "select t.* from s_trades t where security_id in (select security_id from c_securities)",
    "g_activity": """
        select account_id, security_id, trade_date as position_date,
               sum(case when side = 'BUY' then adjusted_quantity else 0.0 end) as daily_buy_quantity,
               sum(case when side = 'SELL' then adjusted_quantity else 0.0 end) as daily_sell_quantity
        from g_valid group by 1, 2, 3""",
    "g_scaffold": """
        select account_id, security_id, position_date from
          (select account_id, security_id from s_starting_positions union
           select account_id, security_id from g_valid union
           select account_id, security_id from s_reported_positions)
        cross join
          (select position_date from s_starting_positions union select trade_date from g_valid union
           select position_date from s_reported_positions)""",
    "g_baseline": """
        select account_id, security_id, coalesce(max(adjusted_quantity), 0.0) as starting_quantity
        from s_starting_positions group by 1, 2""",
    "g_expected": """
        select account_id, security_id, position_date, starting_quantity, cumulative_buy_quantity,
               cumulative_sell_quantity,
               starting_quantity + cumulative_buy_quantity - cumulative_sell_quantity as expected_position
        from (select account_id, security_id, position_date, coalesce(starting_quantity, 0.0) as starting_quantity,
                     sum(coalesce(daily_buy_quantity, 0.0)) over w as cumulative_buy_quantity,
                     sum(coalesce(daily_sell_quantity, 0.0)) over w as cumulative_sell_quantity
              from g_scaffold left join g_baseline using (account_id, security_id)
              left join g_activity using (account_id, security_id, position_date)
              window w as (partition by account_id, security_id order by position_date
                           rows between unbounded preceding and current row))""",
    "g_joined": """
        select e.*, r.adjusted_reported_quantity as reported_position
        from g_expected e left join s_reported_positions r using (account_id, security_id, position_date)""",
    "g_signals": """
        select account_id, security_id, flag_date as position_date,
               max((flag_type = 'SPLIT_ADJUSTMENT_BREAK')::int) as has_split_adjustment_break_flag,
               max((flag_type = 'DUPLICATE_TRADE')::int) as has_duplicate_trade_flag,
               max((flag_type = 'LATE_ARRIVING_TRADE')::int) as has_late_arriving_trade_flag,
               max((flag_type = 'MISSING_PRICE')::int) as has_missing_price_flag
        from s_flags group by 1, 2, 3""",
    "g_status": """
        select j.*, reported_position - expected_position as position_difference,
               case when reported_position is null then 'BREAK'
                    when reported_position - expected_position = 0.0 then 'MATCH' else 'BREAK' end as reconciliation_status
        from g_joined j""",
    "g_reason": """
        select s.*,
               case when reported_position is null then 'POSITION_NOT_REPORTED'
                    when position_difference = 0.0 then 'MATCH'
                    when has_split_adjustment_break_flag = 1 then 'SPLIT_ADJUSTMENT_BREAK'
                    when has_duplicate_trade_flag = 1 then 'DUPLICATE_TRADE'
                    when has_late_arriving_trade_flag = 1 then 'LATE_ARRIVING_TRADE'
                    when has_missing_price_flag = 1 then 'MISSING_PRICE'
                    else 'QUANTITY_MISMATCH' end as break_reason_code
        from g_status s left join g_signals using (account_id, security_id, position_date)""",
    "g_ordered": """
        select r.*, reconciliation_status = 'BREAK' as is_break,
               row_number() over (partition by account_id, security_id
                                  order by position_date, reported_position nulls first) as seq
        from g_reason r""",
    "g_starts": """
        select o.*, (is_break and not coalesce(lag(is_break) over
                       (partition by account_id, security_id order by seq), false))::int as is_start
        from g_ordered o""",
    "g_segments": """
        select s.*, sum(is_start) over (partition by account_id, security_id order by seq) as break_segment_id
        from g_starts s""",
    "g_causes": """
        select s.*,
               case when is_break then min(position_date) over seg end as first_break_date,
               case when is_break then first_value(break_reason_code) over
                 (partition by account_id, security_id, break_segment_id order by seq) else 'MATCH' end
                 as root_cause_reason_code
        from g_segments s window seg as (partition by account_id, security_id, break_segment_id)""",
    "g_positions": """
        select account_id, security_id, position_date, starting_quantity, cumulative_buy_quantity,
               cumulative_sell_quantity, expected_position, reported_position, position_difference,
               reconciliation_status, break_reason_code, root_cause_reason_code, first_break_date,
               cast(position_date - first_break_date as int) as days_since_first_break,
               coalesce(position_date > first_break_date, false) as is_cascading_break
        from g_causes""",
    "g_breaks": """
        select sha256(concat_ws('||', account_id, security_id, position_date::varchar, break_reason_code,
                                root_cause_reason_code)) as break_id,
               account_id, security_id, position_date, expected_position, reported_position, position_difference,
               break_reason_code, root_cause_reason_code, first_break_date, days_since_first_break, is_cascading_break,
               case when abs(position_difference) >= 100 then 'HIGH'
                    when abs(position_difference) >= 25 then 'MEDIUM' else 'LOW' end as severity,
               case break_reason_code
                 when 'POSITION_NOT_REPORTED' then 'No reported position exists for this account/security/date.'
                 when 'SPLIT_ADJUSTMENT_BREAK' then 'Difference aligns with split-adjustment break flags on this date.'
                 when 'DUPLICATE_TRADE' then 'Difference aligns with duplicate-trade flags on this date.'
                 when 'LATE_ARRIVING_TRADE' then 'Difference aligns with late-arriving trade flags on this date.'
                 when 'MISSING_PRICE' then 'Difference aligns with missing-price flags on this date.'
                 else 'Expected and reported quantities differ for this date.' end as investigation_notes
        from g_positions where reconciliation_status = 'BREAK'""",
}

EVENTS = {
    "e_index": """
        select security_id, price_date, close_price, cast(trading_day_index as int) as trading_day_index, prev_close_price,
               case when prev_close_price <> 0 then (close_price - prev_close_price) / prev_close_price end as daily_return
        from (select security_id, price_date, adjusted_close_price as close_price,
                     row_number() over w as trading_day_index, lag(adjusted_close_price) over w as prev_close_price
              from s_prices
              window w as (partition by security_id order by price_date, adjusted_close_price))""",
    "e_mapped": """
        select e.event_id, e.security_id, e.event_date, e.event_type, p.price_date as event_price_date,
               p.i as event_trading_day_index
        from c_filing_events e
        asof left join (select security_id, price_date, min(trading_day_index) as i from e_index group by 1, 2) p
          on p.security_id = e.security_id and p.price_date >= e.event_date""",
    "e_window": """
        select ev.event_id, ev.security_id, ev.event_date, ev.event_type, ev.event_trading_day_index, px.price_date,
               px.trading_day_index, px.close_price, px.daily_return,
               px.trading_day_index - ev.event_trading_day_index as "offset"
        from e_mapped ev left join e_index px on px.security_id = ev.security_id
          and px.trading_day_index between ev.event_trading_day_index - 5 and ev.event_trading_day_index + 5""",
    "e_measured": """
        select event_id, security_id, event_date, event_type, event_trading_day_index,
               max(close_price) filter (where "offset" = -5) as close_m5,
               max(close_price) filter (where "offset" = -1) as close_m1,
               max(close_price) filter (where "offset" = 0) as close_0,
               max(close_price) filter (where "offset" = 1) as close_p1,
               max(close_price) filter (where "offset" = 5) as close_p5,
               stddev_samp(daily_return) filter (where "offset" between -5 and -1) as pre_event_volatility,
               stddev_samp(daily_return) filter (where "offset" between 1 and 5) as post_event_volatility,
               count(daily_return) filter (where "offset" between -5 and -1) as pre_return_obs,
               count(daily_return) filter (where "offset" between 1 and 5) as post_return_obs
        from e_window group by all""",
    "e_prices": """
        select m.*,
               case when close_m5 <> 0 then (close_m1 - close_m5) / close_m5 end as pre_event_return,
               case when close_p1 <> 0 then (close_p5 - close_p1) / close_p1 end as post_event_return,
               case when close_m1 <> 0 then (close_0 - close_m1) / close_m1 end as event_day_return,
               close_m5 is not null and close_m1 is not null and close_p1 is not null and close_p5 is not null
                 and pre_return_obs >= 5 and post_return_obs >= 5 as is_full_window
        from e_measured m""",
    "e_held": """
        select h.security_id, h.price_date, h.position_quantity, p.trading_day_index, p.close_price
        from (select security_id, position_date as price_date, sum(expected_position) as position_quantity
              from g_positions group by 1, 2) h
        left join e_index p using (security_id, price_date)""",
    "e_indexed_held": "select * from e_held where trading_day_index is not null",
    "e_before": """
        select ev.event_id, ev.security_id, h.position_quantity as position_before_event,
               h.close_price as close_price_before
        from (select * from e_mapped where event_trading_day_index is not null) ev
        asof left join e_indexed_held h on h.security_id = ev.security_id
          and h.trading_day_index < ev.event_trading_day_index""",
    "e_after": """
        select ev.event_id, ev.security_id,
               arg_max(h.position_quantity, h.trading_day_index) as position_after_event,
               arg_max(h.close_price, h.trading_day_index) as close_price_after
        from e_mapped ev left join e_indexed_held h on h.security_id = ev.security_id
          and h.trading_day_index > ev.event_trading_day_index
          and h.trading_day_index <= ev.event_trading_day_index + 5
        group by 1, 2""",
    "e_metrics": """
        select m.event_id, m.security_id, event_date, event_type, event_trading_day_index, pre_event_return,
               post_event_return, event_day_return, pre_event_volatility, post_event_volatility,
               position_before_event, position_after_event,
               position_after_event - position_before_event as position_change_around_event,
               position_before_event * close_price_before as exposure_before_event,
               position_after_event * close_price_after as exposure_after_event,
               position_after_event * close_price_after - position_before_event * close_price_before
                 as exposure_change_around_event,
               is_full_window
        from e_prices m left join e_before using (event_id, security_id)
        left join e_after using (event_id, security_id)""",
}

def _f4(column: str) -> str:
    return f"coalesce(printf('%.4f', {column}), 'null')"


def _f6(column: str) -> str:
    return f"coalesce(printf('%.6f', round({column}, 6)), 'null')"


def _entries(**values: str) -> str:
    """key=value pairs in key order, joined by semicolons."""
    parts = [f"'{key}=' || coalesce({values[key]}, 'null')" for key in sorted(values)]
    return " || ';' || ".join(parts)


_MEASURES = (
    "pre_event_return",
    "post_event_return",
    "event_day_return",
    "position_change_around_event",
    "exposure_change_around_event",
)

CORPUS = {
    "k_breaks": f"""
        select sha256(concat_ws('||', 'RECONCILIATION_BREAK_SUMMARY', account_id, security_id, position_date::varchar,
                                break_reason_code)) as document_id,
               'RECONCILIATION_BREAK_SUMMARY' as document_type, account_id, security_id, position_date,
               null::date as event_date,
               concat_ws(' ', 'Reconciliation break', account_id, '/', security_id, 'on', position_date::varchar) as title,
               printf('Reconciliation break for %s / %s on %s.', account_id, security_id, position_date::varchar)
                 || ' Expected position was ' || {_f4("expected_position")} || ', reported position was '
                 || {_f4("reported_position")} || ', difference was ' || {_f4("position_difference")}
                 || '. Break reason was ' || break_reason_code || '. Root cause reason was ' || root_cause_reason_code
                 || '.' as text,
               'gold.reconciliation_breaks' as sources,
               {_entries(break_id="break_id", break_reason_code="break_reason_code",
                         root_cause_reason_code="root_cause_reason_code", severity="severity",
                         first_break_date="first_break_date::varchar",
                         days_since_first_break="days_since_first_break::varchar",
                         is_cascading_break="is_cascading_break::varchar")} as entries
        from g_breaks""",
    "k_events_full": f"""
        select sha256(concat_ws('||', 'EVENT_WINDOW_SUMMARY', m.event_id, m.security_id, m.event_date::varchar)) as document_id,
               'EVENT_WINDOW_SUMMARY' as document_type, null::varchar as account_id, m.security_id,
               null::date as position_date, m.event_date,
               concat_ws(' ', 'Event window', m.event_id, 'for', m.security_id, 'on', m.event_date::varchar) as title,
               printf('Event-window metrics for %s (%s) for %s on %s.', m.event_id, e.event_type, m.security_id,
                      m.event_date::varchar)
                 || ' Pre-event return was ' || {_f6("pre_event_return")} || ', post-event return was '
                 || {_f6("post_event_return")} || ', event-day return was ' || {_f6("event_day_return")}
                 || '. Position change around event was ' || {_f4("position_change_around_event")}
                 || ', exposure change was ' || {_f4("exposure_change_around_event")}
                 || '. Window completeness status was ' || case when is_full_window then 'FULL' else 'PARTIAL' end || '.' as text,
               'gold.event_window_metrics,silver.events_clean' as sources,
               {_entries(event_id="m.event_id", event_type="e.event_type", event_summary="e.event_summary",
                         window_completeness="case when is_full_window then 'FULL' else 'PARTIAL' end")} as entries,
               {", ".join(_MEASURES)}
        from e_metrics m left join c_filing_events e on e.event_id = m.event_id""",
    "k_events": """
        select document_id, document_type, account_id, security_id, position_date, event_date, title, text, sources, entries
        from k_events_full""",
    "k_quality": f"""
        select sha256(concat_ws('||', 'TRADE_QUALITY_SUMMARY', account_id, security_id, position_date::varchar)) as document_id,
               'TRADE_QUALITY_SUMMARY' as document_type, account_id, security_id, position_date, null::date as event_date,
               concat_ws(' ', 'Trade quality flags', account_id, '/', security_id, 'on', position_date::varchar) as title,
               printf('Trade quality summary for %s / %s on %s.', account_id, security_id, position_date::varchar)
                 || printf(' Detected %d quality flags with types [%s].', flag_count, flag_types)
                 || printf(' Trade count was %d, buy quantity was %.4f, sell quantity was %.4f.', coalesce(trade_count, 0),
                           coalesce(buy_quantity, 0.0), coalesce(sell_quantity, 0.0))
                 || ' Flag details: ' || flag_descriptions || '.' as text,
               'silver.trade_quality_flags,silver.trades_clean' as sources,
               {_entries(flag_types="flag_types", flag_count="flag_count::varchar",
                         trade_count="coalesce(trade_count, 0)::varchar",
                         buy_quantity="coalesce(buy_quantity, 0.0)::varchar",
                         sell_quantity="coalesce(sell_quantity, 0.0)::varchar")} as entries
        from (select account_id, security_id, flag_date as position_date, count(*) as flag_count,
                     string_agg(distinct flag_type, ', ' order by flag_type) as flag_types,
                     string_agg(distinct description, ' | ' order by description) as flag_descriptions
              from s_flags group by 1, 2, 3)
        left join (select account_id, security_id, trade_date as position_date, count(*) as trade_count,
                          sum(case when side = 'BUY' then quantity else 0.0 end) as buy_quantity,
                          sum(case when side = 'SELL' then quantity else 0.0 end) as sell_quantity
                   from c_trades group by 1, 2, 3) using (account_id, security_id, position_date)""",
    "k_corpus": "select * from k_breaks union all select * from k_events union all select * from k_quality",
    "k_documents": """
        select document_id, document_type, coalesce(account_id, '') as account_id, coalesce(security_id, '') as security_id,
               coalesce(position_date::varchar, '') as position_date, coalesce(event_date::varchar, '') as event_date,
               title, text, sources
        from (select *, row_number() over (partition by document_id order by text) as seq from k_corpus)
        where seq = 1""",
    "k_questions": """
        select sha256(query) as query_id, query from (
          select printf('Why is %s %s broken on %s?', account_id, security_id, max(position_date)::varchar) as query
          from g_breaks group by account_id, security_id
          union all
          select printf('What happened to %s on %s?', security_id, max(position_date)::varchar)
          from g_breaks group by security_id
          union all
          select distinct 'Show event context for ' || lower(security_id) from g_breaks
          union all
          select distinct 'List duplicate trade flags of ' || lower(account_id) from g_breaks
          union all
          select 'Summarise all open breaks')""",
    "k_parsed": r"""
        select query_id, query,
               upper(nullif(regexp_extract(query, '(?i)\b(ACC\d{3})\b', 1), '')) as account_id,
               upper(nullif(regexp_extract(query, '(?i)\b(SEC\d{3})\b', 1), '')) as security_id,
               nullif(regexp_extract(query, '\b(\d{4}-\d{2}-\d{2})\b', 1), '') as target_date
        from k_questions""",
}


def _vectors(key: str, text: str, table: str) -> str:
    """A vector per row of a table: every different token is hashed once, then each text's places are counted."""
    return f"""
        with found as materialized (
          select {key}, token, count(*) as n
          from (select {key}, unnest(regexp_extract_all(lower({text}), '[a-z0-9]+(?:[.-][a-z0-9]+)*')) as token from {table})
          group by 1, 2
        ), places as materialized (
          select token, ('0x' || substr(md5(token), 1, 8))::bigint % 64 as place from (select distinct token from found)
        ), counted as (
          select {key}, map_from_entries(list((place, n))) as counts
          from (select {key}, place, sum(n)::float as n from found join places using (token) group by 1, 2) group by 1
        )
        select {key}, list_transform(range(64), lambda i: coalesce(counts[i], 0)::float)::float[64] as vector
        from {table} left join counted using ({key})"""


RETRIEVAL = {
    "n_vectors": _vectors("document_id", "text", "k_documents"),
    "n_sized": "select document_id, vector, array_inner_product(vector, vector)::double as size from n_vectors",
    "n_questions": _vectors("query_id", "query", "k_questions"),
    "n_queries": "select query_id, vector, array_inner_product(vector, vector)::double as size from n_questions",
    "n_cut": """
        select query_id, list_max(min(q.size + d.size - 2 * array_inner_product(q.vector, d.vector)::double, 15)) as cut
        from n_queries q cross join n_sized d group by 1""",
    "n_asked": "select * from n_queries join n_cut using (query_id)",
    "n_near": """
        select q.query_id, d.document_id, q.vector as a, d.vector as b, q.size + d.size as sizes
        from n_asked q join n_sized d
          on q.size + d.size - 2 * array_inner_product(q.vector, d.vector)::double <= q.cut""",
    "n_ranked": """
        select query_id, document_id, sizes - 2 * array_inner_product(a, b)::double as distance,
               row_number() over (partition by query_id
                                  order by sizes - 2 * array_inner_product(a, b)::double, document_id) as rank
        from n_near qualify rank <= 15""",
    "n_exact": """
        select query_id, document_id, row_number() over (partition by query_id order by priority, document_id) as place
        from (select q.query_id, d.document_id,
                     case document_type when 'RECONCILIATION_BREAK_SUMMARY' then 0 when 'TRADE_QUALITY_SUMMARY' then 1
                          when 'EVENT_WINDOW_SUMMARY' then 2 else 99 end as priority
              from k_parsed q join k_documents d on d.account_id = q.account_id and d.security_id = q.security_id
                and (d.position_date = q.target_date or d.event_date = q.target_date))
        qualify place <= 5""",
    "n_security": """
        select q.query_id, d.document_id, row_number() over (partition by q.query_id order by d.document_id) as place
        from k_parsed q join k_documents d on d.security_id = q.security_id
        where q.account_id is null or q.target_date is null
        qualify place <= 5""",
    "n_candidates": """
        select query_id, document_id, 0 as tier, place from n_exact
        union all select query_id, document_id, 0, place from n_security
        union all select query_id, document_id, 1, 0 from n_ranked""",
    "n_evidence": """
        select query_id, document_id, row_number() over (partition by query_id order by tier, place, document_id) as rank,
               tier = 0 as is_exact
        from (select query_id, document_id, min(tier) as tier, min(case when tier = 0 then place end) as place
              from n_candidates group by 1, 2)
        qualify rank <= 5""",
}

INVESTIGATION = {
    "i_break": """
        select q.query_id, b.* from k_parsed q
        join (select *, row_number() over (partition by account_id, security_id, position_date
                                           order by break_id, reported_position nulls first) as place from g_breaks) b
          on b.account_id = q.account_id and b.security_id = q.security_id
          and b.position_date = try_cast(q.target_date as date) and place = 1""",
    "i_flags": """
        select q.query_id, f.*, row_number() over (partition by q.query_id order by flag_type, flag_id) as rank
        from k_parsed q join s_flags f
          on (q.account_id is null or f.account_id = q.account_id)
          and (q.security_id is null or f.security_id = q.security_id)
          and (q.target_date is null or f.flag_date = try_cast(q.target_date as date))
        qualify rank <= 20""",
    "i_events": """
        select q.query_id, m.event_id, m.security_id, m.event_date, e.event_type, e.event_summary, pre_event_return,
               post_event_return, event_day_return, position_change_around_event, exposure_change_around_event,
               is_full_window,
               row_number() over (partition by q.query_id order by m.event_date, m.event_id) as rank
        from k_parsed q join e_metrics m on m.security_id = q.security_id
          and (q.target_date is null or abs(m.event_date - try_cast(q.target_date as date)) <= 5)
        left join c_filing_events e on e.event_id = m.event_id
        qualify rank <= 10""",
    "i_packet": """
        select q.query_id, q.query, q.account_id, q.security_id, q.target_date,
               case when b.break_id is not null then
                 printf('Structured break found and used as primary evidence. For %s / %s on %s, expected position was ',
                        b.account_id, b.security_id, b.position_date::varchar)
                 || coalesce(b.expected_position::varchar, 'None') || ', reported position was '
                 || coalesce(b.reported_position::varchar, 'None') || ', and difference was '
                 || coalesce(b.position_difference::varchar, 'None') || '. Break reason is ' || b.break_reason_code
                 || ' with root cause ' || b.root_cause_reason_code || ' and severity ' || b.severity || '.'
               else 'Structured break not found for parsed fields; investigation relies on retrieved evidence and any available quality/event context.'
               end as summary,
               b.break_id is not null as has_break,
               coalesce(f.flag_count, 0) as flag_count, f.flags, coalesce(e.event_count, 0) as event_count, e.events,
               d.evidence, d.titles,
               'Deterministic workflow: regex parsing + direct parquet lookups + vector retrieval. | No LLM generation used; output is template-based. | '
                 || case when d.is_exact then 'Exact metadata-filtered evidence found.' else 'Semantic retrieval fallback used.' end
                 || case when b.break_id is not null then ' | Confidence higher because exact structured break row was found.'
                         else ' | Confidence lower because no exact structured break row was found.' end as confidence_notes,
               concat_ws(' | ',
                 case when q.account_id is null then 'account_id not found in query; structured filters are partial.' end,
                 case when q.security_id is null then 'security_id not found in query; structured filters are partial.' end,
                 case when q.target_date is null then 'date not found in query; structured filters are partial.' end,
                 case when b.break_id is null then 'structured break not found for parsed account/security/date.' end,
                 case when f.flag_count is null then 'no matching trade quality flags found.' end,
                 case when e.event_count is null then 'no nearby event-window context found for parsed security/date.' end)
                 as missing_data_notes,
               d.types, d.exact_ids
        from k_parsed q
        left join i_break b on b.query_id = q.query_id
        left join (select query_id, count(*) as flag_count,
                          string_agg(flag_type || ':' || affected_record_id, ';' order by rank) as flags
                   from i_flags group by 1) f on f.query_id = q.query_id
        left join (select query_id, count(*) as event_count, string_agg(event_id, ';' order by rank) as events
                   from i_events group by 1) e on e.query_id = q.query_id
        left join (select v.query_id, bool_or(v.is_exact) as is_exact, string_agg(v.document_id, ';' order by v.rank) as evidence,
                          string_agg(d.title, ';' order by v.rank) as titles,
                          string_agg(distinct d.document_type, ';' order by d.document_type) as types,
                          string_agg(v.document_id, ';' order by v.rank) filter (where d.account_id = p.account_id
                            and d.security_id = p.security_id
                            and (d.position_date = p.target_date or d.event_date = p.target_date)) as exact_ids
                   from n_evidence v join k_documents d using (document_id) join k_parsed p on p.query_id = v.query_id
                   group by 1) d on d.query_id = q.query_id""",
    "i_claims": """
        select p.query_id, p.summary, p.has_break, p.evidence,
               [coalesce(b.account_id::varchar, 'None'), coalesce(b.security_id::varchar, 'None'),
                coalesce(b.position_date::varchar, 'None'), coalesce(b.expected_position::varchar, 'None'),
                coalesce(b.reported_position::varchar, 'None'), coalesce(b.position_difference::varchar, 'None'),
                coalesce(b.break_reason_code, 'None'), coalesce(b.root_cause_reason_code, 'None'),
                coalesce(b.severity, 'None')] as break_values,
               e.evidence_values
        from i_packet p left join i_break b on b.query_id = p.query_id
        left join (select v.query_id,
                          flatten(list([coalesce(d.account_id, ''), coalesce(d.security_id, ''), coalesce(d.position_date, ''),
                                        coalesce(d.event_date, ''), coalesce(d.document_type, ''), coalesce(d.title, '')]))
                            as evidence_values
                   from n_evidence v join k_documents d using (document_id) group by 1) e on e.query_id = p.query_id""",
    "i_risk": """
        select query_id,
               case when not has_break and evidence is null and summary <> '' then 'HIGH'
                    when len(list_filter(case when has_break then break_values else evidence_values end,
                                         lambda x: x <> '' and contains(summary, x))) > 0 then 'LOW'
                    else 'MEDIUM' end as risk
        from i_claims""",
    "i_checks": """
        select query_id, query, account_id, security_id, target_date,
               has_break as structured_break_found,
               exact_ids is not null as exact_evidence_found, coalesce(exact_ids, '') as matching_document_ids,
               (not has_break or contains(types, 'RECONCILIATION_BREAK_SUMMARY'))
                 and (flag_count = 0 or contains(types, 'TRADE_QUALITY_SUMMARY')) as evidence_type_coverage,
               types as retrieved_types,
               event_count = 0 and missing_data_notes <> '' as missing_data_coverage,
               cast(event_count as int) as event_context_count,
               case when missing_data_notes = '' then 0 else len(string_split(missing_data_notes, ' | ')) end::int
                 as missing_data_notes_count,
               risk as unsupported_claim_risk
        from i_packet join i_risk using (query_id)""",
    "i_scores": """
        select *, round((structured_break_found::int + exact_evidence_found::int + evidence_type_coverage::int
                         + missing_data_coverage::int + (unsupported_claim_risk = 'LOW')::int) / 5.0::double, 2) as groundedness_score
        from i_checks""",
}

LEDGER = {
    "l_calendar": """
        select row_number() over (order by d) - 1 as day_index, d as trading_day
        from (select unnest(generate_series(min(cast(o_orderdate as date)), max(cast(o_orderdate as date)), interval 1 day))::date as d
              from orders)
        where isodow(d) < 6""",
    "l_pairs": """
        select account_id, security_id, coalesce(max(quantity), 0.0) as baseline
        from (select account_id, security_id, quantity from c_starting_positions
              union all select account_id, security_id, null from c_trades) group by 1, 2""",
    "l_signed": """
        select account_id, security_id, trade_date, settlement_date,
               case when side = 'BUY' then quantity else -quantity end as q from c_trades""",
    "l_trade_basis": """
        select p.account_id, p.security_id, c.trading_day as position_date, baseline, coalesce(net, 0.0) as net,
               sum(coalesce(net, 0.0)) over (partition by p.account_id, p.security_id order by c.trading_day) as run
        from l_pairs p cross join l_calendar c
        left join (select account_id, security_id, trade_date as d, sum(q) as net from l_signed group by 1, 2, 3) a
          on a.account_id = p.account_id and a.security_id = p.security_id and a.d = c.trading_day""",
    "l_settle_basis": """
        select p.account_id, p.security_id, c.trading_day as position_date, baseline, coalesce(net, 0.0) as net,
               sum(coalesce(net, 0.0)) over (partition by p.account_id, p.security_id order by c.trading_day) as run
        from l_pairs p cross join l_calendar c
        left join (select account_id, security_id, settlement_date as d, sum(q) as net from l_signed group by 1, 2, 3) a
          on a.account_id = p.account_id and a.security_id = p.security_id and a.d = c.trading_day""",
    "l_near_events": """
        select distinct e.security_id, w.trading_day as price_date
        from (select distinct security_id, event_date from c_filing_events) e
        join l_calendar c on c.trading_day = e.event_date
        join l_calendar w on w.day_index between c.day_index - 5 and c.day_index + 5""",
    "l_required": """
        select security_id, trade_date as price_date from c_trades union select security_id, price_date from l_near_events""",
    "l_manifest": f"select * from {flawed_sql('r_injected_issues_manifest', 'injected_issues_manifest')}",
    "l_detected": """
        select flag_type as category, account_id, security_id, flag_date::varchar as day from s_flags
        union all select break_reason_code, account_id, security_id, position_date::varchar from g_breaks""",
    "l_reports": """
        select account_id, security_id, position_date, min(reported_quantity) as q,
               row_number() over (partition by account_id, security_id order by position_date) as seq
        from c_reported_positions group by 1, 2, 3""",
    "l_steps": """
        select b.*, coalesce(a.net, 0.0) as net,
               coalesce((select product(s.split_ratio) from v_splits s where s.security_id = b.security_id
                         and s.effective_date <= b.position_date
                         and s.effective_date > coalesce(p.position_date, date '0001-01-01')), 1.0) as ratio,
               exists (select 1 from v_splits s where s.security_id = b.security_id
                       and s.effective_date <= coalesce(p.position_date, date '0001-01-01')) as after_split
        from l_reports b
        left join l_reports p on p.account_id = b.account_id and p.security_id = b.security_id and p.seq = b.seq - 1
        left join (select account_id, security_id, trade_date, sum(q) as net from l_signed group by 1, 2, 3) a
          on a.account_id = b.account_id and a.security_id = b.security_id and a.trade_date = b.position_date""",
    "l_walk": """
        select account_id, security_id, position_date, seq, q * ratio as value from l_steps where seq = 1
        union all
        select s.account_id, s.security_id, s.position_date, s.seq,
               case when s.after_split then (w.value + s.net) * s.ratio else s.q * s.ratio end
        from l_walk w join l_steps s on s.account_id = w.account_id and s.security_id = w.security_id and s.seq = w.seq + 1""",
}
RECURSIVE = {"l_walk"}

EXPRESSIONS: dict[str, str] = {
    **RAW,
    **CLEAN,
    **ADJUSTED,
    **FLAGS,
    **GOLD,
    **EVENTS,
    **CORPUS,
    **RETRIEVAL,
    **INVESTIGATION,
    **LEDGER,
}


def _needed(body: str) -> list[str]:
    found: list[str] = []
    seen: set[str] = set()

    def visit(text: str) -> None:
        for name in re.findall(r"\b[a-z]_\w+\b", text):
            if name in EXPRESSIONS and name not in seen:
                seen.add(name)
                visit(EXPRESSIONS[name])
                found.append(name)

    visit(body)
    return found


def statement(body: str) -> str:
    """The body with every expression it depends on in front."""
    names = _needed(body)
    if not names:
        return body
    ctes = ",\n".join(
        f"{name} as {'' if name in RECURSIVE else 'materialized '}({EXPRESSIONS[name]})" for name in names
    )
    return f"with {'recursive ' if RECURSIVE & set(names) else ''}{ctes}\n{body}"
