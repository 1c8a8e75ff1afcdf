"""DuckDB statements that give the same rows as the queries of the same name."""

from __future__ import annotations

LINES = "(select unnest(string_split(text, chr(10))) as line from documents)"
WORDS = f"(select word from (select unnest(string_split(line, ' ')) as word from {LINES}) where word <> '')"
ALL_WORDS = f"(select unnest(string_split(line, ' ')) as word from {LINES})"
PAIRS = f"""(select unnest(list_transform(range(1, len(w)), lambda i: w[i] || '-' || w[i + 1])) as pair
  from (select list_filter(string_split(line, ' '), lambda x: x <> '') as w from {LINES}) where len(w) > 1)"""
BATCHES = "(select l_partkey, l_returnflag, l_quantity, year(l_shipdate) * 100 + month(l_shipdate) as batch from lineitem)"
LABELLED = "(select d.doc_id, d.lang, d.source, l.quality, l.toxic from documents d left join labels l on l.doc_id = d.doc_id)"
ROUGH = """(select cast(o_orderkey as varchar) as o_orderkey,
  case when o_orderstatus = 'P' then 'n/a' when o_orderpriority = '5-LOW' then null
       else cast(o_totalprice as varchar) end as o_totalprice, o_orderstatus from orders)"""


def windows(width: str, *, table: str = "events", where: str = "true") -> str:
    return f"""select time_bucket(interval {width}, ts) as window_start,
      time_bucket(interval {width}, ts) + interval {width} as window_end, event_type, count(*) as count
      from {table} where {where} group by all"""


def profile_of(table: str, columns: dict[str, str], estimated: str | None = None) -> str:
    """One select per column; the types are Spark's names for them. Of an estimated column no distinct values are counted."""
    selects = []
    for column, kind in columns.items():
        numeric = kind != "string"
        mean = f"round(avg(cast({column} as double)), 4)" if numeric else "cast(null as double)"
        dev = f"round(stddev_samp(cast({column} as double)), 4)" if numeric else "cast(null as double)"
        quarters = [f"quantile_disc(cast({column} as double), {q / 100})" if numeric else "cast(null as double)" for q in (25, 50, 75)]
        selects.append(
            f"""select '{column}' as column_name, '{kind}' as data_type, true as nullable,
            count(*) as row_count, count(*) - count({column}) as null_count,
            {"cast(null as bigint)" if column == estimated else f"count(distinct {column})"} as distinct_count, cast(min({column}) as varchar) as min_value,
            cast(max({column}) as varchar) as max_value, {mean} as mean, {dev} as stddev,
            {quarters[0]} as q25, {quarters[1]} as q50, {quarters[2]} as q75 from {table}"""
        )
    return " union all ".join(selects)


MULTIPLIERS = """with entries as {entries}, wins as ({wins}),
  copies as (select e.batch, e.l_partkey, count(*) as multiplier from entries e join wins w on w.l_partkey = e.l_partkey
             group by all),
  best as (select l_partkey, max(multiplier) as multiplier from copies group by all)
  select multiplier, count(*) as cnt from best group by all order by multiplier"""

INTERVAL_PAIRS = """select c.user_id, c.event_id as click_id, c.ts as click_ts,
  v.user_id as view_user, v.event_id as view_id, v.ts as view_ts
  from events c join events v on v.user_id = c.user_id and c.ts >= v.ts and c.ts <= v.ts + interval 1 hour
  where c.event_type = 'click' and v.event_type = 'view'"""

# Lines of the first day arrive again after the watermark has passed it.
LATE = """with first as (select min(ts::date) as first from events),
  mark as (select max(ts) - interval 5 minute as mark from events, first where ts::date > first),
  counted as (select ts, event_type from events, first where ts::date >= first
    union all select ts, event_type from events, first, mark
      where ts::date = first and time_bucket(interval 10 minute, ts) + interval 10 minute > mark)"""

# Murmur3 of one 32-bit integer with seed 42, step by step in 64-bit arithmetic.
MURMUR = """with m1 as (select *, (c_nationkey::bigint * 3432918353) & 4294967295 as k from customer),
  m2 as (select *, ((((k << 15) | (k >> 17)) & 4294967295)::hugeint * 461845907 % 4294967296)::bigint as k1 from m1),
  m3 as (select *, xor(42::bigint, k1) as h from m2),
  m4 as (select *, ((((h << 13) | (h >> 19)) & 4294967295) * 5 + 3864292196) & 4294967295 as h1 from m3),
  m5 as (select *, xor(h1, 4::bigint) as h2 from m4),
  m6 as (select *, (xor(h2, h2 >> 16)::hugeint * 2246822507 % 4294967296)::bigint as h3 from m5),
  m7 as (select *, (xor(h3, h3 >> 13)::hugeint * 3266489909 % 4294967296)::bigint as h4 from m6),
  m8 as (select *, xor(h4, h4 >> 16) as h5 from m7)"""

ORACLES: dict[str, str] = {
    # words
    "wc_top5": f"select word, count(*) as cnt from {WORDS} group by word order by cnt desc, word limit 5",
    "wc_whitespace": """select word, count(*) as cnt from
      (select unnest(regexp_split_to_array(text, '\\s+')) as word from documents) where word <> ''
      group by word order by cnt desc, word""",
    "wc_hashed": f"select md5(word) as digest, count(*) as cnt from {WORDS} group by all",
    "wc_hashed_top5": f"""select md5(word) as digest, count(*) as cnt from {WORDS}
      group by all order by cnt desc, digest limit 5""",
    "wc_weighted": f"""select word, cast(sum(case when word = 'the' then 2 else 1 end) as bigint) as cnt
      from {WORDS} group by word""",
    "wc_weight_table": f"""with weights as (select word, max(p_size) as weight from
        (select p_size, unnest(string_split(p_name, ' ')) as word from part) group by word)
      select w.word, cast(count(*) * coalesce(any_value(weight), 1) as bigint) as cnt
      from {WORDS} w left join weights on weights.word = w.word group by w.word""",
    "bigrams": f"select pair, count(*) as cnt from {PAIRS} group by pair",
    "bigrams_top5": f"select pair, count(*) as cnt from {PAIRS} group by pair order by cnt desc, pair limit 5",
    "saved_counts": f"select '(' || word || ',' || count(*) || ')' as value from {WORDS} group by word",
    "text_lines": f"select line as value, count(*) as cnt from {LINES} group by line",
    # multipliers, groups and joins
    "multiplier_dist": MULTIPLIERS.format(
        entries=BATCHES, wins="select distinct l_partkey from entries where l_returnflag = 'R' and batch >= 199506"
    ),
    "multiplier_repeat_wins": MULTIPLIERS.format(
        entries=BATCHES, wins="select l_partkey from entries where l_returnflag = 'R' and batch >= 199506"
    ),
    "partitioned_scan": f"select cast(batch as integer) as batch, count(*) as cnt from {BATCHES} where batch >= 199801 group by all",
    "join_agg_sort": """select c_mktsegment,
      cast(sum(cast(o_totalprice as decimal(18,2))) as double) as sum_price,
      round(cast(sum(cast(o_totalprice as decimal(18,2))) as double) / count(o_totalprice), 4) as avg_price
      from orders join customer on c_custkey = o_custkey group by all order by sum_price desc, c_mktsegment""",
    "group_sum_avg": """select l_returnflag, l_linestatus,
      cast(sum(cast(l_quantity as decimal(18,2))) as double) as sum_qty,
      round(cast(sum(cast(l_quantity as decimal(18,2))) as double) / count(l_quantity), 4) as avg_qty
      from lineitem group by all""",
    "average_of_text": f"""select o_orderstatus, cast(round(
        cast(sum(try_cast(o_totalprice as decimal(18,2))) as double)
        / nullif(count(try_cast(o_totalprice as decimal(18,2))), 0), 4) as varchar) as avg_price
      from {ROUGH} group by o_orderstatus""",
    "composite_counts": "select user_id, event_type, count(*) as cnt from events group by all",
    "join_inner": """select c_custkey, o_orderkey, o_totalprice, c_name from orders
      join customer on c_custkey = o_custkey""",
    "join_by_key": """select c_custkey, o_orderkey, o_totalprice, c_name from orders
      join customer on c_custkey = o_custkey""",
    "join_left": """select c_custkey, c_name, o_orderkey, o_totalprice from customer
      left join orders on o_custkey = c_custkey""",
    "join_right": "select d.doc_id, quality, toxic, lang, source from labels l right join documents d on l.doc_id = d.doc_id",
    "join_semi": "select doc_id, lang, source from documents where doc_id in (select doc_id from labels)",
    "join_anti": "select doc_id, lang, source from documents where doc_id not in (select doc_id from labels)",
    "join_static": """select s_suppkey, s_name, s_nationkey, n_nationkey, n_name
      from supplier join nation on n_nationkey = s_nationkey""",
    "interval_pairs": INTERVAL_PAIRS,
    # projection, cleaning, preparation
    "project_expr": """select c_custkey, c_custkey || '_' || c_name as id_name, c_mktsegment as segment
      from customer where c_acctbal > 0""",
    "mask": """select c_custkey, c_name, c_mktsegment as segment, c_custkey || '_' || c_name as id_name,
      sha256('brook' || c_nationkey) as crypto from customer""",
    "mask_hash": MURMUR + """ select c_custkey, c_name, c_custkey || '_' || c_name as id_name,
      cast(case when h5 >= 2147483648 then h5 - 4294967296 else h5 end as integer) as crypto from m8""",
    "dedup_by_key": """select unnest(arg_min(c, c_custkey)) from customer c group by c_nationkey""",
    "dedup_any": "select distinct o_custkey from orders",
    "distinct": "select distinct l_returnflag, l_linestatus from lineitem",
    "na_fill": f"""select doc_id, lang, source, coalesce(quality, -1) as quality, coalesce(toxic, -1) as toxic
      from {LABELLED}""",
    "na_drop": f"select * from {LABELLED} where quality is not null and toxic is not null",
    "na_replace": """select o_orderkey, case o_orderstatus when 'F' then 'finished' when 'O' then 'open'
      else o_orderstatus end as o_orderstatus from orders""",
    "union_all": """select p_partkey as id, p_name as name from part
      union all select c_custkey as id, c_name as name from customer""",
    "sample_by_key": """select o_orderkey, o_totalprice from orders
      where md5(cast(o_orderkey as varchar)) < printf('%08x', cast(floor(0.3 * 4294967296) as bigint))""",
    "repartition_write": "select o_orderkey, o_custkey from orders",
    "explode_array": "select distinct o_custkey, o_orderpriority as priority from orders",
    "name_columns": """select p_partkey as id, unnest(string_split(p_name, ' ')) as word from part""",
    "conform_accepted": f"""select cast(o_orderkey as bigint) as o_orderkey, cast(o_totalprice as double) as o_totalprice,
      o_orderstatus from {ROUGH} where try_cast(o_totalprice as double) is not null""",
    "conform_rejected": f"""select cast(o_orderkey as bigint) as o_orderkey,
      case when o_totalprice is null then 'o_totalprice: missing' else 'o_totalprice: bad value' end as reasons,
      o_totalprice as loaded
      from {ROUGH} where try_cast(o_totalprice as double) is null""",
    "profile_customer": profile_of("customer", {"c_custkey": "bigint", "c_acctbal": "double", "c_mktsegment": "string"}),
    "profile_labelled": profile_of(LABELLED, {"doc_id": "bigint", "source": "string", "quality": "int"}),
    "profile_merged": profile_of("customer", {"c_custkey": "bigint", "c_nationkey": "int", "c_mktsegment": "string"}, "c_custkey"),
    "conform_written": f"""select verdict, count(*) as observed, count(*) as written from
      (select case when try_cast(o_totalprice as double) is null then 'rejected' else 'accepted' end as verdict from {ROUGH})
      group by verdict""",
    "preview_and_profile": """select * from (select c_custkey, c_acctbal, c_mktsegment from customer order by c_custkey limit 5),
      (select count(*) as row_count, count(*) - count(c_acctbal) as null_count, count(distinct c_acctbal) as distinct_count,
       round(avg(c_acctbal), 4) as mean, round(stddev_samp(c_acctbal), 4) as stddev from customer)""",
    "first_rows": "select o_orderkey, o_totalprice from orders order by o_orderkey limit 20",
    "sort_mixed": """select o_orderkey, o_orderpriority, o_totalprice from orders
      order by o_totalprice desc, o_orderpriority""",
    # row functions
    "label_map": "select o_orderkey, 'No: ' || o_orderkey as label from orders",
    "range_labels": "select 'No: ' || i as label from range(0, (select max(o_orderkey) + 1 from orders)) r(i)",
    "vector_labels": "select o_orderkey, 'No: ' || o_orderkey as label from orders",
    "map_record": "select o_orderkey as number from orders",
    "map_partitions": """select c_custkey, c_acctbal, (c_acctbal >= -500)::int + (c_acctbal >= 0)::int
      + (c_acctbal >= 250)::int + (c_acctbal >= 1000)::int + (c_acctbal >= 5000)::int as bracket from customer""",
    "task_writer": "select o_orderkey, o_orderstatus from orders",
    "sample_random": "select true as share_is_near, true as repeats, true as is_part",
    "map_frames": "select c_custkey, least(c_acctbal, 0.0) as debt from customer",
    "keyed_reduce": """select user_id, max(case when event_type <> 'click' then value end) as value
      from events group by user_id""",
    # views, catalog and file formats
    "sql_view": "select * from part",
    "sql_shared_view": "select * from supplier",
    "catalog_table": "select * from orders",
    "csv_text_columns": """select cast(c_custkey as varchar) as c_custkey, c_name,
      cast(c_nationkey as varchar) as c_nationkey from customer""",
    "csv_typed": "select * from customer",
    "csv_options": """select o_orderkey, 'says "' || o_orderpriority || '" | ok' as note,
      case when o_orderpriority <> '5-LOW' then o_totalprice end as amount, cast(cast(o_orderdate as date) as varchar) as day from orders""",
    "csv_permissive": f"""select cast(o_orderkey as bigint) as o_orderkey, try_cast(o_totalprice as double) as o_totalprice,
      o_orderstatus from {ROUGH}""",
    "csv_dropmalformed": f"""select cast(o_orderkey as bigint) as o_orderkey, cast(o_totalprice as double) as o_totalprice,
      o_orderstatus from {ROUGH} where o_totalprice is null or o_totalprice <> 'n/a'""",
    "csv_quarantine": f"""select cast(o_orderkey as bigint) as o_orderkey,
      o_orderkey || ',n/a,' || o_orderstatus as record from {ROUGH} where o_totalprice = 'n/a'""",
    "json_roundtrip": "select * from documents",
    "orc_roundtrip": "select * from lineitem",
    "part_files": "select o_orderkey, o_totalprice, o_orderstatus from orders",
    "write_modes": """select o_orderkey, o_orderstatus from orders
      union all select o_orderkey, o_orderstatus from orders""",
    # streams
    "stream_wc": f"select word, count(*) as count from {ALL_WORDS} group by word",
    "tumble_5m": windows("5 minute"),
    # Windows the watermark has passed: it stands at the last event, in whole milliseconds,
    # less the lateness.
    "tumble_10m_append": f"""select * from ({windows("10 minute")}) where window_end <=
      (select date_trunc('millisecond', max(ts)) - interval 5 minute from events)""",
    "tumble_10m_update": windows("10 minute"),
    "tumble_5m_update": windows("5 minute"),
    "timed_words": windows("5 minute").replace("event_type", "event_type as word", 1),
    "stream_static": """select time_bucket(interval 1 hour, ts) as window_start,
      time_bucket(interval 1 hour, ts) + interval 1 hour as window_end, user_id, event_type, count(*) as count,
      c_custkey, c_name, c_mktsegment from events join customer on c_custkey = user_id group by all""",
    "stream_static_fresh": """with first as (select min(ts::date) as first from events)
      select time_bucket(interval 1 hour, ts) as window_start, time_bucket(interval 1 hour, ts) + interval 1 hour as window_end,
      user_id, event_type, count(*) as count, c_custkey, c_name, c_mktsegment
      from events join customer on c_custkey = user_id, first where c_custkey % 2 = 0 or ts::date > first group by all""",
    "stream_stream": INTERVAL_PAIRS,
    "join_state": """with first as (select min(ts::date) as first from events),
      runs as (select 1 as run, event_type, ts from events, first where ts::date = first union all select 2, event_type, ts from events),
      marks as (select run, least(max(ts) filter (event_type = 'click') - interval 1 hour,
                                  max(ts) filter (event_type = 'view') - interval 5 minute) as mark from runs group by run)
      select run, 'left' as side, count(*) as kept from runs join marks using (run)
        where event_type = 'click' and ts > mark group by run
      union all select run, 'right', 4 * count(*) from runs join marks using (run)
        where event_type = 'view' and ts + interval 1 hour > mark group by run""",
    "keyed_avg": """select event_type as client,
      round(cast(sum(cast(value as decimal(18,2))) as double) / count(value), 6) as average_value
      from events group by event_type""",
    "topic_frame": """select event_type as key,
      cast(round(cast(sum(cast(value as decimal(18,2))) as double) / count(value), 4) as varchar) as value
      from events group by event_type""",
    "usage_pct": """select l_returnflag, round(avg((l_extendedprice - l_extendedprice * l_discount)
      / nullif(l_extendedprice, 0) * 100), 4) as usage from lineitem group by l_returnflag""",
    "stream_passthrough": """select event_type as key, cast(value as varchar) as value, 'usage' as topic,
      0 as partition, event_id as "offset" from events""",
    "late_words": LATE + """ select time_bucket(interval 10 minute, ts) as window_start,
      time_bucket(interval 10 minute, ts) + interval 10 minute as window_end, event_type as word, count(*) as count
      from counted group by all""",
    "late_rows": LATE + """ select (select 2 * count(*) from events, first where ts::date = first)
      + (select count(*) from events, first where ts::date > first) - (select count(*) from counted) as late""",
    "stream_every_second": "select o_orderstatus, count(*) as count from orders group by all",
    "cleaning_job": """select c_custkey, segment, id_name, crypto, unnest(string_split(c_name, '#')) as part from
      (select distinct c_custkey, c_name, c_mktsegment as segment, c_custkey || '_' || c_name as id_name,
              sha256('brook' || c_nationkey) as crypto from customer join orders on o_custkey = c_custkey)""",
    "stream_restart": "select o_orderkey, o_orderstatus from orders",
    "stream_csv": windows("1 hour"),
    "stream_lines": f"select word, count(*) as count from {ALL_WORDS} group by word",
}
