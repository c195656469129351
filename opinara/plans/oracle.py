"""DuckDB SQL for the named queries, written from the definitions and not from our plans."""

from __future__ import annotations

_FIELDS = """
    'src-' || event_id::varchar as id,
    case when user_id % 20 < 14 then 'WB-' else 'OZ-' end
        || lpad((user_id % 20 + 1)::varchar, 3, '0') as product_id,
    (floor(value)::int % 7)::int as rating,
    (floor(value)::int % 61) / 10.0::double as rating_f,
    (json_extract_string(props, '$.k')::int - 10)::int as likes,
    (event_id % 20)::int as dislikes,
    ts as date,
    ts + to_minutes(((event_id * 7919) % 1440)::int) as arrival_ts,
    event_id as seq"""

_REVIEWS = f"reviews as (select {_FIELDS} from events)"

_TEXTS = f"""reviews as (
    select {_FIELDS}, case when event_id % 13 = 0 then '' else d.text end as text
    from events join documents d on d.doc_id = event_id % (select count(*) from documents))"""

_BUCKETED = """bucketed as (
    select *, time_bucket(interval 6 hours, date, timestamp '1970-01-01') as window_start from reviews)"""

_WINDOWS = f"""{_REVIEWS}, {_BUCKETED}, windows as (
    select product_id, window_start, round(sum(rating)::double / count(*) * 100) / 100 as avg_rating,
           sum(likes)::bigint as total_likes, count(*) as review_count
    from bucketed group by all)"""

# Windows of a day every six hours: an arrival lies in the four that start up to 18 hours earlier.
_SLIDES = f"""{_REVIEWS}, hops as (
    select *, time_bucket(interval 6 hours, arrival_ts, timestamp '1970-01-01')
              - to_hours((6 * k.k)::int) as window_start
    from reviews, (select unnest([0, 1, 2, 3]) as k) k where rating between 1 and 5),
grouped as (
    select product_id, window_start, window_start + interval 24 hours as window_end, count(*) as c,
           sum(rating)::double as r, count(*) filter (rating < 3) as neg, max(date) as newest
    from hops group by all),
slides as (
    select window_start, window_end, window_end as computed_at, product_id, c as review_count,
           round_even(r / c * 100, 0) / 100 as avg_rating,
           round_even(neg / c * 10000, 0) / 10000 as negative_share, newest as max_review_date,
           round_even(greatest(0.0::double, (epoch_us(window_end) - epoch_us(newest)) / 1e6) * 100, 0) / 100
               as latency_sec
    from grouped)"""

_CLASSES = f"""{_REVIEWS}, {_BUCKETED}, classed as (
    select *, case when arrival_ts <= window_start + interval 6 hours then 'on_time'
                   when arrival_ts <= window_start + interval 18 hours then 'late'
                   else 'dropped' end as arrival_class from bucketed)"""

_FINAL_KEPT = f"""{_CLASSES}, windows as (
    select product_id, window_start, round(sum(rating)::double / count(*) * 100) / 100 as avg_rating,
           sum(likes)::bigint as total_likes, count(*) as review_count
    from classed where arrival_class <> 'dropped' group by all)"""

_CHANGES = f"""{_CLASSES},
closing as (
    select product_id, window_start, window_start + interval 6 hours as emitted_at, max(seq) as seq,
           sum(rating) as r, sum(likes) as l, count(*) as c, true as at_close
    from classed where arrival_class = 'on_time' group by product_id, window_start),
steps as (
    select * from closing union all
    select product_id, window_start, arrival_ts, seq, rating, likes, 1, false
    from classed where arrival_class = 'late'),
changes as (
    select product_id, window_start, emitted_at, seq,
           round((sum(r) over sofar)::double / (sum(c) over sofar) * 100) / 100 as avg_rating,
           (sum(l) over sofar)::bigint as total_likes, (sum(c) over sofar)::bigint as review_count,
           not at_close and not (bool_and(not at_close) over w
               and row_number() over (partition by window_start order by emitted_at, seq) = 1) as is_update
    from steps
    window sofar as (partition by product_id, window_start order by emitted_at, seq
                     rows between unbounded preceding and current row),
           w as (partition by window_start))"""

_CHECKED = f"""{_TEXTS}, checked as (
    select *, case when rating_f < 1 or rating_f > 5 then 'rating' when text = '' then 'empty_text'
                   when length(text) > 5000 then 'long_text' when likes < 0 then 'likes' else '' end as error_code,
           case when rating_f < 1 or rating_f > 5
                    then 'rating must be between 1.0 and 5.0, got ' || rating_f::varchar
                when text = '' then 'text must not be empty'
                when length(text) > 5000 then 'text too long: ' || length(text)::varchar || ' chars, max 5000'
                when likes < 0 then 'likes must be >= 0, got ' || likes::varchar else '' end as error_msg
    from reviews)"""

_SNAPSHOTS = """slots as (select floor(epoch(arrival_ts) / 3600)::bigint as slot from reviews),
grid as (select unnest(range((select min(slot) from slots), (select max(slot) from slots) + 1)) as slot),
snapshots as (
    select make_timestamp((g.slot + 1) * 3600 * 1000000) as snapshot_at,
           ((g.slot - (select min(slot) from slots) + 1) * 3600)::double as elapsed_s,
           (sum(count(s.slot)) over (order by g.slot))::bigint as total_reviews,
           count(s.slot) / 3600.0::double as reviews_per_sec
    from grid g left join slots s on s.slot = g.slot group by g.slot)"""

_SUMMARY = """summary as (
    select arg_max(elapsed_s, snapshot_at) as duration_s, arg_max(total_reviews, snapshot_at) as total_reviews,
           round(avg(reviews_per_sec), 9) as avg_rps, max(reviews_per_sec) as peak_rps from snapshots)"""

_SCORES_TO_HITS = """hits as (
    select *, 'low_rating' as rule,
           'Mean rating of ' || product_id || ' fell to '
               || printf('%.2f', round_even(mean_rating * 100, 0) / 100) || ' (threshold 3.0)' as message
    from scores where mean_rating < 3.0
    union all
    select *, 'negative_share', 'Negative share of ' || product_id || ' is '
               || printf('%.0f', round_even(negative / windows * 100, 0)) || '% (threshold 30%, '
               || negative::varchar || '/' || windows::varchar || ' windows)'
    from scores where negative / windows > 0.30)"""

_MEAN = "sum(round_even(avg_rating * 100, 0)::bigint)::double / count(*) / 100"

_HISTORY = f"""{_WINDOWS}, scores as (
    select product_id, window_start + to_hours((6 * k.k)::int) as check_at, {_MEAN} as mean_rating,
           count(*) filter (avg_rating < 3.0) as negative, count(*) as windows
    from windows, (select unnest(range(1, 21)) as k) k group by all), {_SCORES_TO_HITS}"""


def _iso(column: str) -> str:
    return f"strftime({column}, '%Y-%m-%dT%H:%M:%S.%f') || 'Z'"


def _pair(left: str, right: str, label: str) -> str:
    return f"""select count(*) filter (n > 0) as only_left, count(*) filter (n < 0) as only_right,
        count(*) filter (n <> 0) = 0 as equal, '{label}' as pair
        from (select product_id, window_start, sum(s) as n from (
            select *, 1 as s from windows where {left} union all
            select *, -1 from windows where {right}) group by all)"""


def _run(source: str) -> str:
    return f"""(with {_REVIEWS.replace("from events)", "from events where user_id % 20 " + source + ")")},
        {_SNAPSHOTS}, {_SUMMARY} unpivot (select duration_s, total_reviews::double as total_reviews, avg_rps, peak_rps
        from summary) on duration_s, total_reviews, avg_rps, peak_rps into name metric value value)"""


ORACLE: dict[str, str] = {
    "tumbling_final": f"with {_WINDOWS} select * from windows",
    "sliding_agg": f"with {_SLIDES} select * from slides",
    "late_classes": f"""with {_CLASSES} select arrival_class, count(*) as n, sum(rating)::bigint as rating_sum
        from classed group by all""",
    "tumbling_changelog": f"with {_CHANGES} select * from changes",

    "validate_reviews": f"""with {_CHECKED} select * exclude (text), error_code = '' as is_valid from checked""",
    "is_valid_flag": f"with {_CHECKED} select id, error_code = '' as is_valid from checked",
    "validate_in_sql": f"with {_CHECKED} select id, error_code = '' as is_valid, error_msg from checked",
    "clean_reviews": f"with {_CHECKED} select * exclude (error_code, error_msg) from checked where error_code = ''",
    "rejected_reviews": f"""with {_CHECKED} select id as review_id, product_id, rating_f as rating, likes,
        false as is_valid, error_msg from checked where error_code <> ''""",
    "validation_summary": f"""with {_CHECKED} select count(*) as total,
        count(*) filter (error_code = '') as valid, count(*) filter (error_code <> '') as invalid,
        count(*) filter (error_code = '') * 100.0::double / count(*) as valid_pct,
        count(*) filter (error_code <> '') * 100.0::double / count(*) as invalid_pct from checked""",
    "error_breakdown": f"""with {_CHECKED}, counted as (
        select error_code, error_msg, count(*) as n from checked where error_code <> '' group by all
        order by n desc, error_msg limit 10)
        select error_code, case when length(error_msg) > 70 then left(error_msg, 70) || '...' else error_msg end
        as error_msg, n from counted""",
    "json_quarantine": f"""with {_TEXTS} select seq, seq % 50 = 0 as corrupt,
        case when seq % 50 <> 0 then id end as id, case when seq % 50 <> 0 then product_id end as product_id,
        case when seq % 50 <> 0 then rating end as rating, case when seq % 50 <> 0 then likes end as likes,
        case when seq % 50 <> 0 then dislikes end as dislikes, case when seq % 50 <> 0 then date end as date,
        case when seq % 50 <> 0 then length(text)::int end as text_chars from reviews""",

    "valid_ratings": f"with {_REVIEWS} select id, product_id, rating, date from reviews where rating between 1 and 5",
    "fill_defaults": f"""with {_REVIEWS} select id,
        case when seq % 11 = 0 then 0 else rating end::int as rating,
        case when seq % 17 = 0 then 'unknown' else product_id end as product_id from reviews""",
    "review_stats": f"""with {_REVIEWS} select count(*) as total,
        count(*) filter (rating between 1 and 5) as valid,
        count(*) filter (rating not between 1 and 5) as invalid,
        coalesce(sum(rating) filter (rating between 1 and 5)::double
                 / count(*) filter (rating between 1 and 5), 0) as avg_rating from reviews""",
    "rating_distribution": f"""with {_REVIEWS} select s.r::int as rating, count(v.rating) as n,
        count(v.rating) * 100.0::double / (select count(*) from reviews where rating between 1 and 5) as pct
        from (select unnest(range(1, 6)) as r) s left join reviews v on v.rating = s.r group by all""",
    "top_products": f"""with {_REVIEWS} select product_id, count(*) as n from reviews group by 1
        order by n desc, min(seq) limit 5""",
    "last_reviews": f"""with {_REVIEWS} select seq, left(id, 20) as id, product_id, rating from reviews
        order by seq desc limit 5""",
    "throughput": f"with {_REVIEWS}, {_SNAPSHOTS} select * from snapshots",
    "throughput_delta": f"""with {_REVIEWS}, {_SNAPSHOTS}, lagged as (
        select *, lag(total_reviews) over (order by snapshot_at) as before,
               lag(snapshot_at) over (order by snapshot_at) as before_at from snapshots)
        select snapshot_at, total_reviews, total_reviews - coalesce(before, 0) as new_reviews,
        case when before_at is null then 0.0::double else
            (total_reviews - before) / ((epoch_us(snapshot_at) - epoch_us(before_at)) / 1e6) end as reviews_per_sec
        from lagged""",
    "moving_rps": f"""with {_REVIEWS}, cum as (
        select slot, (sum(n) over (order by slot))::bigint as total from (
            select floor(epoch(arrival_ts) / 600)::bigint as slot, count(*) as n from reviews group by 1)),
        framed as (select slot, total, first_value(slot) over f as slot0, first_value(total) over f as total0
            from cum window f as (order by slot range between 5 preceding and current row))
        select make_timestamp(slot * 600 * 1000000) as sampled_at, total - total0 as new_reviews,
        case when slot > slot0 then (total - total0)::double / ((slot - slot0) * 600) else 0.0::double end
            as reviews_per_sec from framed""",
    "run_summary": f"with {_REVIEWS}, {_SNAPSHOTS}, {_SUMMARY} select * from summary",
    "run_totals": f"""with {_REVIEWS} select product_id, count(*) as n from reviews group by 1
        union all select 'TOTAL', count(*) from reviews""",
    "compare_runs": f"""select metric, a.value as base_value, b.value as other_value,
        round((b.value - a.value) / nullif(a.value, 0) * 100.0, 6) as change_pct,
        round(greatest(a.value, b.value) / nullif(least(a.value, b.value), 0), 6) as ratio
        from {_run("< 14")} a full join {_run(">= 14")} b using (metric)""",
    "parse_summaries": f"""with {_REVIEWS}, runs as (select product_id, left(product_id, 2) as language,
        (epoch_us(max(arrival_ts)) - epoch_us(min(arrival_ts))) / 1e6 as wall_clock_s, count(*) as total_reviews
        from reviews group by 1)
        select product_id, 'good' as kind, language, wall_clock_s, total_reviews, null::varchar as error from runs
        union all select product_id, k, null, null, null, 'no summary'
        from runs, (select unnest(['none', 'broken']) as k)""",
    "backlog": f"""with {_REVIEWS}, {_BUCKETED} select product_id from (
        select product_id from reviews union select unnest(['WB-900', 'WB-901', 'WB-902']))
        where product_id not in (select product_id from bucketed
            where window_start = (select max(window_start) from bucketed))""",

    "kpi_windows": f"""with {_WINDOWS} select count(*) as windows, count(distinct product_id) as products,
        {_MEAN} as avg_rating, sum(total_likes)::bigint as total_likes from windows""",
    "weighted_rating": f"""with {_WINDOWS} select product_id,
        sum(round_even(avg_rating * 100, 0)::bigint * review_count)::double / sum(review_count) / 100
        as weighted_rating from windows group by 1""",
    "kpi_latest": f"""with {_SLIDES}, latest as (select * from slides
        qualify row_number() over (partition by product_id order by computed_at desc) = 1)
        select {_MEAN} as avg_rating, sum(review_count)::bigint as review_count,
        sum(round_even(negative_share * 10000, 0)::bigint)::double / count(*) / 10000 * 100 as negative_pct,
        (select latency_sec from slides order by computed_at desc, product_id desc limit 1) as last_latency_sec
        from latest""",
    "latest_per_product": f"""with {_SLIDES} select * from slides
        qualify row_number() over (partition by product_id order by computed_at desc) = 1""",
    "top20_latest": f"""with {_SLIDES} select product_id, review_count, avg_rating from (select * from slides
        qualify row_number() over (partition by product_id order by computed_at desc) = 1)
        order by review_count desc, product_id limit 20""",
    "reviews_by_product": f"""with {_WINDOWS} select product_id, sum(review_count)::bigint as review_count
        from windows group by 1""",
    "top20_rating": f"""with {_WINDOWS} select product_id, {_MEAN} as avg_rating from windows group by 1
        order by avg_rating desc, product_id limit 20""",
    "timeline": f"""with {_WINDOWS} select window_start, sum(review_count)::bigint as review_count
        from windows group by 1""",
    "latency_series": f"""with {_SLIDES} select computed_at,
        sum(round_even(latency_sec * 100, 0)::bigint)::double / count(*) / 100 as latency_sec from slides
        where computed_at >= (select max(computed_at) from slides) - interval 2 days group by 1""",
    "current_latency": f"""with {_SLIDES} select computed_at,
        sum(round_even(latency_sec * 100, 0)::bigint)::double / count(*) / 100 as latency_sec from slides
        where computed_at = (select max(computed_at) from slides) group by 1""",
    "product_list": f"with {_REVIEWS} select distinct product_id from reviews",
    "product_series": f"""with {_SLIDES} select product_id, computed_at, avg_rating,
        negative_share * 100 as negative_pct from slides""",
    "rating_bands": f"""with {_WINDOWS} select product_id, window_start, avg_rating,
        case when avg_rating >= 4 then 'green' when avg_rating >= 3 then 'yellow' else 'red' end as band
        from windows""",
    "recent_table": f"""with {_SLIDES} select product_id, review_count,
        printf('%.2f', avg_rating) as avg_rating,
        printf('%.1f', round_even(negative_share * 100 * 10, 0) / 10) || '%' as negative_share,
        printf('%.1f', round_even(latency_sec * 10, 0) / 10) || 's' as latency,
        strftime(computed_at, '%H:%M:%S') as "time"
        from slides order by computed_at desc, product_id limit 50""",
    "windows_newest": f"""with {_WINDOWS} select product_id, avg_rating, total_likes, review_count,
        strftime(window_start, '%H:%M:%S') as window_time from windows""",
    "emissions_newest": f"""with {_CHANGES} select row_number() over (order by emitted_at, seq) as position, product_id,
        avg_rating, total_likes, review_count, strftime(window_start, '%H:%M:%S') as window_time from changes""",
    "windows_sorted": f"with {_WINDOWS} select * from windows",
    "parse_window_start": f"""with {_WINDOWS} select product_id, review_count, case review_count % 4
        when 0 then strftime(window_start, '%Y-%m-%dT%H:%M:%SZ')
        when 1 then strftime(window_start, '%Y-%m-%dT%H:%M:%S')
        when 2 then (epoch_us(window_start) * 1000)::varchar else 'garbage' end as raw_start,
        case when review_count % 4 < 3 then window_start end as window_start from windows""",

    "filter_prefix": f"with {_WINDOWS} select * from windows where product_id like 'WB-00%'",
    "filter_exact": f"with {_WINDOWS} select * from windows where product_id = 'WB-002'",
    "ticket_filter": f"with {_WINDOWS} select * from windows where product_id like 'OZ-%'",
    "serve_projection": f"""with {_CHANGES} select product_id, window_start, avg_rating, total_likes, review_count
        from changes""",
    "paths_equal": f"""with {_WINDOWS} {_pair("product_id like 'WB-%'", "left(product_id, 3) = 'WB-'", "path_ticket")}
        union all {_pair("product_id like 'WB-%'", "true", "path_all")}""",
    "encode_raw": f"""with {_TEXTS} select product_id as key, to_json(struct_pack(id := id,
        product_id := product_id, rating := rating, text := text, likes := likes, dislikes := dislikes,
        date := {_iso("date")}))::varchar as value from reviews""",
    "encode_windowed": f"""with {_WINDOWS} select product_id || '-' || (epoch_us(window_start) * 1000)::varchar as key,
        to_json(struct_pack(product_id := product_id, window_start := {_iso("window_start")},
        avg_rating := avg_rating, total_likes := total_likes, review_count := review_count))::varchar as value
        from windows""",
    "encode_sliding": f"""with {_SLIDES} select product_id as key,
        to_json(struct_pack(window_start := {_iso("window_start")}, window_end := {_iso("window_end")},
        computed_at := {_iso("computed_at")}, product_id := product_id, review_count := review_count,
        avg_rating := avg_rating, negative_share := negative_share,
        max_review_date := {_iso("max_review_date")}, latency_sec := latency_sec))::varchar as value from slides""",
    "json_payload_bytes": f"""with {_WINDOWS} select count(*) as records,
        sum(strlen(to_json(struct_pack(product_id := product_id, window_start := {_iso("window_start")},
        avg_rating := avg_rating, total_likes := total_likes, review_count := review_count))::varchar))::bigint
        as json_bytes, (count(*) * 36 + 4 + sum(strlen(product_id)))::bigint as columnar_bytes from windows""",

    "upsert_windows": f"with {_FINAL_KEPT} select * from windows",
    "mark_updates": f"""with {_CLASSES} select distinct product_id, window_start, window_start in (
        select window_start from classed where arrival_class = 'on_time') as is_update
        from classed where arrival_class = 'late'""",
    "dedup_reviews": f"with {_REVIEWS} select * exclude (rating_f) from reviews",
    "dedup_within_horizon": f"""with recursive {_REVIEWS},
        fetched as (select product_id || '-' || (seq % 3)::varchar as id, arrival_ts, min(seq) as seq,
                    arg_min(rating, seq) as rating from reviews group by all),
        accepted(id, arrival_ts) as (
            select id, min(arrival_ts) from fetched group by 1
            union all
            select a.id, (select min(f.arrival_ts) from fetched f where f.id = a.id
                          and f.arrival_ts >= a.arrival_ts + interval 6 hours)
            from accepted a where a.arrival_ts is not null)
        select f.* from fetched f join accepted using (id, arrival_ts)""",
    "retain_last_n": f"with {_WINDOWS} select * from windows order by window_start desc, product_id desc limit 100",
    "retain_last_emitted": f"""with {_CHANGES}, newest as (select * from changes order by emitted_at desc, seq desc limit 100)
        select *, row_number() over (order by emitted_at, seq)::int as position from newest""",
    "retain_24h": f"""with {_WINDOWS} select * from windows
        where window_start >= (select max(window_start) from windows) - interval 24 hours""",
    "recent_windows": f"""with {_WINDOWS} select * from windows
        where window_start >= (select max(window_start) from windows) - interval 5 days""",

    "anomalies": f"""with {_WINDOWS}, scores as (
        select product_id, {_MEAN} as mean_rating, count(*) filter (avg_rating < 3.0) as negative,
               count(*) as windows from windows
        where window_start >= (select max(window_start) from windows) - interval 5 days group by 1),
        {_SCORES_TO_HITS} select * from hits""",
    "anomaly_history": f"with {_HISTORY} select * from hits",
    "alert_cooldown": f"""with recursive {_HISTORY},
        checks as (select distinct product_id, check_at from hits),
        sent(product_id, check_at) as (
            select product_id, min(check_at) from checks group by 1
            union all
            select s.product_id, (select min(c.check_at) from checks c where c.product_id = s.product_id
                                  and c.check_at >= s.check_at + interval 24 hours)
            from sent s where s.check_at is not null)
        select h.* from hits h join sent s using (product_id, check_at)""",

    "stream_tumbling_table": f"with {_FINAL_KEPT} select * from windows",
    "stream_sliding": f"with {_SLIDES} select * from slides",
    "stream_tumbling_future": f"""with {_REVIEWS}, ahead as (
        select * replace (case when seq % 50 = 0 then date - interval 1 hour else arrival_ts end as arrival_ts) from reviews),
        placed as (select *, time_bucket(interval 6 hours, date, timestamp '1970-01-01') as window_start from ahead)
        select product_id, window_start, round(sum(rating)::double / count(*) * 100) / 100 as avg_rating,
               sum(likes)::bigint as total_likes, count(*) as review_count
        from placed where arrival_ts <= window_start + interval 18 hours group by all""",
    "stream_restart_table": f"""with {_FINAL_KEPT}, halves as (
        select product_id, window_start, round(sum(rating)::double / count(*) * 100) / 100 as avg_rating,
               sum(likes)::bigint as total_likes, count(*) as review_count
        from classed where arrival_class <> 'dropped' and seq % 2 = 0 group by all)
        select * from halves union all
        select w.* from windows w anti join halves h using (product_id, window_start)""",
    "quarantine_counts": f"""with {_REVIEWS}, gaps as (
        select case when seq % 19 <> 0 then date end as date, case when seq % 23 <> 0 then arrival_ts end as arrival_ts from reviews),
        aged as (select *, time_bucket(interval 6 hours, date, timestamp '1970-01-01') as s from gaps)
        select case when date is null then 'no_date' when arrival_ts is null then 'no_arrival'
                    when arrival_ts <= s + interval 6 hours then 'on_time'
                    when arrival_ts <= s + interval 18 hours then 'late' else 'dropped' end as fate, count(*) as n
        from aged group by 1""",
    "stream_rating_counts": f"""with {_REVIEWS} select product_id, rating, count(*) as n from reviews
        where rating between 1 and 5 group by all""",
    "stream_dedup": f"with {_REVIEWS} select id, product_id, rating, arrival_ts from reviews",
}
ORACLE["stream_review_stats"] = ORACLE["review_stats"]
ORACLE["tumbling_changelog_split"] = ORACLE["tumbling_changelog"]
ORACLE["dedup_reviews_by_id"] = ORACLE["dedup_reviews"]
ORACLE["stream_tumbling_shuffled"] = ORACLE["stream_tumbling_table"]
ORACLE["stream_dedup_refetched"] = ORACLE["dedup_within_horizon"]
ORACLE["stream_closing"] = ORACLE["tumbling_changelog"]
ORACLE["filter_stored"] = ORACLE["filter_prefix"]
ORACLE["stream_messages"] = f"select * exclude (seq) from ({ORACLE['json_quarantine']})"
ORACLE["stream_flushed"] = ORACLE["stream_tumbling_table"]
ORACLE["stream_alerts"] = ORACLE["alert_cooldown"]
ORACLE["sliding_fine"] = f"""with {_REVIEWS}, hops as (
    select *, time_bucket(interval 80 seconds, arrival_ts, timestamp '1970-01-01') - to_seconds(80 * k.k) as window_start
    from reviews, (select unnest(range(1080)) as k) k where rating between 1 and 5),
grouped as (
    select product_id, window_start, window_start + interval 24 hours as window_end, count(*) as c,
           sum(rating)::double as r, count(*) filter (rating < 3) as neg, max(date) as newest
    from hops group by all)
select product_id, window_start::date as day, count(*) as n_windows, sum(c)::bigint as reviews, max(c) as busiest,
       sum(round_even(r / c * 100, 0)::bigint)::bigint as ratings, sum(round_even(neg / c * 10000, 0)::bigint)::bigint as negative,
       max(newest) as newest,
       max(round_even(greatest(0.0::double, (epoch_us(window_end) - epoch_us(newest)) / 1e6) * 100, 0) / 100) as slowest
from grouped group by all"""

_SPANS = f"""{_REVIEWS}, spans as (
    select *, time_bucket(interval 1 day, date, timestamp '1970-01-01') - to_days(k.k::int) as span_start
    from reviews, (select unnest([0, 1, 2, 3, 4, 5, 6]) as k) k)"""
ORACLE["approx_distinct"] = f"""with {_SPANS} select span_start, count(*) as reviews,
    count(distinct product_id || '-' || (seq % 3)::varchar || '-' || (seq % 500)::varchar) as n_ids,
    count(distinct product_id) as n_products, true as ids_in_bounds, true as products_in_bounds from spans group by 1"""
ORACLE["approx_top_products"] = f"""with {_SPANS}, counts as (select span_start, product_id, count(*) as n from spans group by all),
    ranked as (select *, row_number() over (partition by span_start order by n desc, product_id)::int as rank from counts)
    select span_start, rank, product_id, n, 0::bigint as max_error from ranked where rank <= 5"""
