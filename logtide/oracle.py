"""DuckDB SQL for every registered query (the correctness oracle).

Each text runs on DuckDB over the supplied tables (views ``events``,
``lineitem``, ...). Log queries start from the ``log_lines`` stand-in view,
written here in DuckDB dialect; :mod:`logtide.sources.standins` renders the
same rows on Spark.

Typing: DuckDB ``year()`` is BIGINT and ``sum(bigint)`` HUGEINT, so results
are cast to the Spark types (int, bigint). Regexes use single backslashes.
"""

from __future__ import annotations

LOG_LINES = r"""
log_lines as (
with g as (select *, cast(floor(event_id/2.0) as bigint) g, event_id % 10 r from events),
a as (select *, cast(floor(sqrt(cast(g as double))) as bigint) app from g),
m as (select *, cast(floor(g/5.0) as bigint) m, cast(floor(floor(g/5.0)/2.0) as bigint) tid from a),
b as (select *, concat(case when app % 16 < 14 then '1485248649253' when app % 16 = 14 then '1472621869829' else '1448006111297' end,'_',lpad(cast(app as varchar),4,'0')) ca, strftime(ts,'%y/%m/%d %H:%M:%S') t,
 concat(cast(tid % 8 as varchar),'.0 in stage ',cast(tid % 16 as varchar),'.0 (TID ',cast(tid as varchar),')') task from m)
select event_id, concat('application_',ca,'/container_',ca,'_0',cast(1+m%2 as varchar),'_',lpad(cast(1+g%7 as varchar),6,'0'),'.log') file_path,
 case r when 0 then concat(t,' INFO executor.Executor: Running task ',task)
 when 1 then case when event_type='error' then concat(t,' ERROR executor.Executor: Exception in task ',task) else concat(t,' INFO executor.Executor: Finished task ',task,'. 2364 bytes result sent to driver') end
 when 2 then concat(t,' INFO python.PythonRunner: Times: total = ',cast(user_id*10+20 as varchar),', boot = -12, init = 50, finish = ',cast(user_id as varchar))
 when 3 then concat(t,' INFO YarnAllocator: Will request ',cast(1+user_id%16 as varchar),' executor containers, each with 5 cores and ',cast(1024*(1+user_id%28) as varchar),' MB memory including 2560 MB overhead')
 when 4 then concat(t,' INFO storage.MemoryStore: Block rdd_',cast(g as varchar),'_25 stored as bytes in memory (estimated size ',cast(user_id as varchar),'.0 ',case when user_id%2=0 then 'KB' else 'MB' end,', free 4.5 GB)')
 when 5 then concat(t,' WARN YarnAllocator: Container request (host: Any, capability: <memory:',cast(1024*(1+user_id%28) as varchar),', vCores:5>)')
 when 6 then concat(t,' INFO storage.ShuffleBlockFetcherIterator: Getting ',cast(user_id as varchar),' non-empty blocks out of ',cast(user_id+50 as varchar),' blocks')
 when 7 then concat(t,' INFO rdd.HadoopRDD: Input split: hdfs://namenode.example/in/f.txt:',cast(g*1024 as varchar),'+1024')
 when 8 then '    at foo.Bar(INFORMATION.java:1)'
 else concat(t,' DEBUG broadcast.TorrentBroadcast: retry after ERROR in variable ',cast(g as varchar),' from mesos-slave-',cast(g % 20 as varchar),' via mesos-master-1') end log_entry from b
)"""

# parsed record, mirrors logtide.functions.parse
PARSED = r"""
parsed as (
select event_id, file_path, log_entry,
 regexp_extract(log_entry, '\b(INFO|WARN|ERROR|DEBUG)\b', 1) log_level,
 regexp_extract(log_entry, '^(\d{2}/\d{2}/\d{2} \d{2}:\d{2}:\d{2})', 1) ts_text,
 regexp_extract(file_path, 'application_(\d+)_(\d+)/', 1) cluster_id,
 regexp_extract(file_path, 'application_(\d+)_(\d+)/', 2) app_id
from log_lines
),
stamped as (
select *, try_cast(regexp_replace(ts_text, '^(\d{2})/(\d{2})/(\d{2}) ', '20\1-\2-\3 ') as timestamp) ts
from parsed
)"""

TIMELINE = r"""
timeline as (
select cluster_id, app_id, min(ts) start_time, max(ts) end_time, count(*) log_lines,
 date_diff('second', min(ts), max(ts)) duration_sec
from stamped where ts is not null group by cluster_id, app_id
)"""

TRIPS = r"""
trips as (
select l_shipdate tpep_pickup_datetime, l_quantity trip_distance, l_quantity passenger_count,
 l_extendedprice fare_amount, l_discount tip_amount, l_tax mta_tax from lineitem
)"""


def with_logs(body: str, *ctes: str) -> str:
    parts = [LOG_LINES, PARSED, *ctes]
    return "with " + ",".join(parts) + "\n" + body


def with_trips(body: str, *ctes: str) -> str:
    return "with " + ",".join([TRIPS, *ctes]) + "\n" + body


SQL: dict[str, str] = {}

SQL["log_level_counts"] = with_logs("""
select log_level, count(*) as count from parsed where log_level <> '' group by log_level order by log_level""")

SQL["log_scan_count"] = with_logs("select count(*) as total_lines from log_lines")

SQL["lines_with_levels"] = with_logs(
    "select count(*) filter (where log_level <> '') as lines_with_levels from parsed")

SQL["log_scan_totals"] = with_logs("""
select count(*) as total_lines, count(*) filter (where log_level <> '') as lines_with_levels,
 count(distinct nullif(log_level, '')) as unique_levels from parsed""")

SQL["log_level_pct"] = with_logs("""
select log_level, count, cast(count as double) / cast(sum(count) over () as double) * 100.0 as pct
from (select log_level, count(*) as count from parsed where log_level <> '' group by log_level)
order by log_level""")

SQL["log_summary_text"] = with_logs(r"""
select concat_ws(chr(10),
  'Total log lines processed: ' || format('{:,}', total),
  'Total lines with log levels: ' || format('{:,}', leveled),
  'Unique log levels found: ' || cast(levels as varchar),
  '', 'Log level distribution:') ||
  coalesce(chr(10) || body, '') as summary
from (
 select sum(count) total, sum(count) filter (where log_level <> '') leveled,
  count(*) filter (where log_level <> '') levels,
  string_agg(printf('  %-5s: %10s (%6.2f%%)', log_level, format('{:,}', count),
     cast(count as double) / cast(lv as double) * 100.0), chr(10) order by log_level)
     filter (where log_level <> '') body
 from (select log_level, count(*) count, sum(count(*)) filter (where log_level <> '') over () lv
       from parsed group by log_level)
)""")

SQL["log_sample"] = with_logs("""
select log_entry, log_level from parsed where log_level <> ''
order by md5(concat('42|', cast(event_id as varchar))) limit 10""")

SQL["component_top20"] = with_logs(r"""
select component, count(*) as count from
 (select regexp_extract(log_entry, '(INFO|WARN|ERROR|DEBUG)\s+([^:]+):', 2) component from log_lines)
group by component order by count desc, component limit 20""")

SQL["level_counts_unbounded"] = with_logs("""
select regexp_extract(log_entry, '(INFO|WARN|ERROR|DEBUG)', 1) as level, count(*) as count
from log_lines group by 1 order by 1""")

SQL["level_occurrences"] = with_logs("""
select level, count(*) as occurrences from
 (select unnest(regexp_extract_all(log_entry, '(INFO|WARN|ERROR|DEBUG)', 1)) as level from log_lines)
group by level order by level""")

SQL["distinct_levels"] = with_logs(
    "select distinct log_level from parsed where log_level <> '' order by log_level")

SQL["error_lines"] = with_logs("select file_path, log_entry from parsed where log_level = 'ERROR'")

SQL["parsed_log"] = with_logs(r"""
select ts_text as timestamp, regexp_extract(log_entry, '(INFO|WARN|ERROR|DEBUG)', 1) as level,
 regexp_extract(log_entry, '(INFO|WARN|ERROR|DEBUG)\s+([^:]+):', 2) as component,
 log_entry as message from parsed""")

SQL["parse_quality"] = with_logs(r"""
select count(*) as total_lines,
 count(*) filter (where log_level = '') as no_level,
 count(*) filter (where ts_text = '') as no_timestamp,
 count(*) filter (where ts_text <> '' and ts is null) as bad_timestamp,
 count(*) filter (where regexp_extract(log_entry, '(INFO|WARN|ERROR|DEBUG)\s+([^:]+):', 2) = '')
   as no_component
from stamped""")

FILES = r"""
files as (
select file_path, count(*) log_lines,
 regexp_extract(file_path, 'application_(\d+_\d+)', 0) application_id,
 regexp_extract(file_path, '(container_\d+_\d+_\d+_\d+)', 1) container_id,
 regexp_extract(file_path, 'application_(\d+)_(\d+)/', 1) cluster_id,
 regexp_extract(file_path, 'application_(\d+)_(\d+)/', 2) app_id
from log_lines group by file_path
)"""

SQL["basic_counts"] = with_logs("""
select count(distinct nullif(application_id, '')) as applications,
 count(distinct nullif(container_id, '')) as containers,
 cast(coalesce(sum(log_lines), 0) as bigint) as log_entries from files""", FILES)

SQL["containers_per_app"] = with_logs("""
select application_id, count(distinct nullif(container_id, '')) as containers
from files where application_id <> '' group by application_id
order by containers desc, application_id limit 5""", FILES)

SQL["container_roles"] = with_logs(r"""
select application_id, container_id,
 regexp_extract(file_path, 'container_(\d+)_(\d+)_(\d+)_(\d+)', 3) as attempt,
 regexp_extract(file_path, 'container_(\d+)_(\d+)_(\d+)_(\d+)', 4) as container_number,
 case when regexp_extract(file_path, 'container_(\d+)_(\d+)_(\d+)_(\d+)', 4) = '000001' then 'ApplicationMaster'
      when regexp_extract(file_path, 'container_(\d+)_(\d+)_(\d+)_(\d+)', 4) <> '' then 'Executor'
      else '' end as role,
 log_lines from files""", FILES)

SQL["failed_containers"] = with_logs(r"""
select regexp_extract(file_path, 'application_(\d+_\d+)', 0) as application_id,
 regexp_extract(file_path, '(container_\d+_\d+_\d+_\d+)', 1) as container_id,
 case when regexp_extract(file_path, 'container_(\d+)_(\d+)_(\d+)_(\d+)', 4) = '000001' then 'ApplicationMaster'
      when regexp_extract(file_path, 'container_(\d+)_(\d+)_(\d+)_(\d+)', 4) <> '' then 'Executor'
      else '' end as role,
 error_lines, task_exceptions
from (select file_path, count(*) filter (where log_level = 'ERROR') error_lines,
  count(*) filter (where contains(log_entry, 'Exception in task')) task_exceptions
 from parsed group by file_path)
where error_lines > 0 or task_exceptions > 0""")

SQL["cluster_start"] = with_logs("""
select distinct cluster_id, epoch_ms(cast(cluster_id as bigint)) as cluster_started
from files where cluster_id <> ''""", FILES)

SQL["timestamped_lines"] = with_logs(
    "select count(*) as timestamped_lines from stamped where ts is not null")

SQL["app_timeline"] = with_logs(
    "select * from timeline order by cluster_id, start_time", TIMELINE)

CLUSTERS = """
clusters as (
select cluster_id, count(app_id) num_applications, min(start_time) first_app_start,
 max(end_time) last_app_end, min(duration_sec) min_duration_sec, max(duration_sec) max_duration_sec
from timeline group by cluster_id
)"""

SQL["cluster_summary"] = with_logs(
    "select * from clusters order by cluster_id", TIMELINE, CLUSTERS)

SQL["usage_stats"] = with_logs("""
select count(distinct cluster_id) as total_clusters, count(*) as total_applications,
 cast(count(*) as double) / cast(count(distinct cluster_id) as double) as avg_apps_per_cluster,
 avg(duration_sec) as avg_duration_sec, min(duration_sec) as min_duration_sec,
 max(duration_sec) as max_duration_sec,
 (select string_agg(cluster_id || ':' || cast(num_applications as varchar), ',' order by num_applications desc, cluster_id)
  from (select * from clusters order by num_applications desc, cluster_id limit 5)) as most_used
from timeline""", TIMELINE, CLUSTERS)

SQL["top_cluster"] = with_logs("""
select cluster_id, num_applications from clusters
order by num_applications desc, cluster_id limit 1""", TIMELINE, CLUSTERS)

SQL["top_clusters"] = with_logs("""
select cluster_id, num_applications from clusters
order by num_applications desc, cluster_id limit 5""", TIMELINE, CLUSTERS)

LARGEST = """
largest as (
select t.* from timeline t
where t.cluster_id in (select cluster_id from clusters order by num_applications desc, cluster_id limit 1)
 and t.duration_sec > 0
)"""

SQL["largest_cluster_apps"] = with_logs("select * from largest", TIMELINE, CLUSTERS, LARGEST)

SQL["app_timeline_contract"] = with_logs("""
select cluster_id, concat('application_', cluster_id, '_', app_id) as application_id,
 app_id as app_number, start_time, end_time from timeline order by cluster_id, start_time""",
    TIMELINE)

SQL["cluster_summary_contract"] = with_logs("""
select cluster_id, num_applications, first_app_start as cluster_first_app,
 last_app_end as cluster_last_app from clusters order by cluster_id""", TIMELINE, CLUSTERS)

SQL["cluster_lookup_join"] = with_logs("""
select t.*, l.cluster_apps, l.cluster_started from timeline t left join
 (select cluster_id, count(app_id) cluster_apps,
   epoch_ms(try_cast(cluster_id as bigint)) cluster_started
  from timeline group by cluster_id) l on t.cluster_id = l.cluster_id""", TIMELINE)

SQL["cluster_share"] = with_logs("""
select cluster_id, num_applications,
 cast(num_applications as double) / cast(sum(num_applications) over () as double) as app_share,
 num_containers,
 cast(num_containers as double) / cast(sum(num_containers) over () as double) as container_share,
 log_lines, cast(log_lines as double) / cast(sum(log_lines) over () as double) as line_share
from (select cluster_id, count(distinct nullif(app_id, '')) num_applications,
  count(distinct nullif(container_id, '')) num_containers, cast(sum(log_lines) as bigint) log_lines
  from files group by cluster_id)""", FILES)

SQL["host_lines"] = with_logs(r"""
select host, count(*) as log_lines, count(distinct file_path) as containers from
 (select file_path, unnest(list_distinct(regexp_extract_all(log_entry, '(mesos-(?:slave|master)-\d+)', 1))) host from log_lines)
group by host order by log_lines desc, host""")

SQL["log_entries"] = with_logs(r"""
select file_path, arg_min(log_entry, event_id) as first_line, max(nullif(ts_text, '')) as entry_ts_text,
 max(case when ts_text <> '' then log_level end) as entry_level,
 count(*) as lines, count(*) filter (where ts_text = '') as continuation_lines
from (select *, sum(case when ts_text <> '' then 1 else 0 end)
  over (partition by file_path order by event_id rows unbounded preceding) e from parsed)
group by file_path, e""")

SQL["distinct_ids_from_states"] = with_logs("""
select cluster_id, count(*) as log_lines, true as same_lines, true as applications_within, true as containers_within
from parsed group by cluster_id""")

SQL["containers_carried_over"] = with_logs(r"""
select d.cluster_id, d.day, count(*) as containers,
 case when any_value(d.before) is not null then count(p.container_id) end as carried_over
from (select *, (select max(e.day) from days e where e.cluster_id = days.cluster_id and e.day < days.day) as before from days) d
left join days p on p.cluster_id = d.cluster_id and p.day = d.before and p.container_id = d.container_id
group by d.cluster_id, d.day""", r"""
days as (
select distinct cluster_id, cast(ts as date) as day, regexp_extract(file_path, '(container_\d+_\d+_\d+_\d+)', 1) as container_id
from stamped where ts is not null
)""")

SQL["cluster_bar"] = with_logs(
    "select cluster_id, num_applications from clusters order by cluster_id", TIMELINE, CLUSTERS)

SQL["duration_histogram"] = with_logs("""
select b.bin, b.bin_start, b.bin_end, coalesce(c.count, 0) as count, s.n,
 cast(coalesce(c.count, 0) as double) / (b.bin_end - b.bin_start) / cast(s.n as double) as density
from stats s,
 (select cast(i as integer) bin,
   case when i >= 30 then s.hi else cast(i as double) * ((s.hi - s.lo) / 30.0) + s.lo end bin_start,
   case when i + 1 >= 30 then s.hi else cast(i + 1 as double) * ((s.hi - s.lo) / 30.0) + s.lo end bin_end
  from stats s, range(0, 30) r(i)) b
 left join (
  select bin, count(*) count from (
   select x, case when i1 + 1 < 30 and x >= (cast(i1 + 1 as double) * st + lo) then i1 + 1 else i1 end bin
   from (
    select x, lo, st, case when x < (case when i0 >= 30 then hi else cast(i0 as double) * st + lo end)
                           then i0 - 1 else i0 end i1
    from (select x, lo, hi, st,
           least(cast(floor((x - lo) / (hi - lo) * 30.0) as integer), 29) i0
          from (select cast(duration_sec as double) x from largest),
               (select lo, hi, (hi - lo) / 30.0 st from stats))))
  group by bin) c on c.bin = b.bin
where s.n >= 2 and s.hi > s.lo
order by b.bin""", TIMELINE, CLUSTERS, LARGEST, """
stats as (
select count(*) n, min(cast(duration_sec as double)) lo, max(cast(duration_sec as double)) hi
from largest
)""")

SQL["duration_kde"] = with_logs("""
select g.point, round(g.x, 3) as x, round(sum(exp(-0.5 * ((g.x - d.x) / s.h) * ((g.x - d.x) / s.h)))
   / (cast(s.n as double) * s.h * sqrt(2 * pi())), 12) as density
from kstats s,
 (select cast(i as integer) point,
   pow(10.0, case when i = 499 then log10(s.hi)
            else cast(i as double) * ((log10(s.hi) - log10(s.lo)) / 499.0) + log10(s.lo) end) x
  from kstats s, range(0, 500) r(i)) g,
 (select cast(duration_sec as double) x from largest) d
where s.n >= 2 and s.sd > 0
group by g.point, g.x, s.n, s.h order by g.point""", TIMELINE, CLUSTERS, LARGEST, """
kstats as (
select count(*) n, min(cast(duration_sec as double)) lo, max(cast(duration_sec as double)) hi,
 stddev_samp(cast(duration_sec as double)) sd,
 stddev_samp(cast(duration_sec as double)) * pow(cast(count(*) as double), -0.2) h
from largest
)""")

TASKS = r"""
task_lines as (
select cluster_id, app_id, regexp_extract(file_path, 'container_(\d+)_(\d+)_(\d+)_(\d+)', 3) attempt, ts,
 try_cast(nullif(regexp_extract(log_entry, 'Running task (\S+) in stage (\S+) \(TID (\d+)\)', 3), '') as bigint) start_tid,
 concat(regexp_extract(log_entry, 'Running task (\S+) in stage (\S+) \(TID (\d+)\)', 2),
  regexp_extract(log_entry, 'Finished task (\S+) in stage (\S+) \(TID (\d+)\)', 2)) stage,
 try_cast(nullif(regexp_extract(log_entry, 'Finished task (\S+) in stage (\S+) \(TID (\d+)\)', 3), '') as bigint) finish_tid
from stamped where contains(log_entry, '(TID ')
),
starts as (
select cluster_id, app_id, attempt, start_tid tid, stage, min(ts) start_time, count(*) n
from task_lines where start_tid is not null group by all
),
finishes as (
select cluster_id, app_id, attempt, finish_tid tid, stage, max(ts) end_time, count(*) n
from task_lines where finish_tid is not null group by all
),
task_times as (
select s.cluster_id, s.app_id, s.attempt, s.tid, s.stage, s.start_time, f.end_time,
 date_diff('second', s.start_time, f.end_time) duration_sec
from starts s join finishes f using (cluster_id, app_id, attempt, tid, stage)
where s.start_time is not null and f.end_time is not null
)"""

SQL["task_durations"] = with_logs("""
select cluster_id, app_id, count(*) as num_tasks, avg(duration_sec) as avg_task_sec,
 min(duration_sec) as min_task_sec, max(duration_sec) as max_task_sec
from task_times group by cluster_id, app_id""", TASKS)

SQL["unfinished_tasks"] = with_logs("""
select s.cluster_id, s.app_id, s.attempt, s.tid, s.stage, s.start_time from starts s
anti join finishes f using (cluster_id, app_id, attempt, tid, stage)""", TASKS)

SQL["slowest_tasks"] = with_logs("""
select cluster_id, app_id, attempt, tid, stage, duration_sec from task_times
order by duration_sec desc, cluster_id, app_id, attempt, tid, stage limit 10""", TASKS)

SQL["slowest_stages"] = with_logs("""
select cluster_id, app_id, attempt, stage, count(*) as num_tasks, cast(sum(duration_sec) as bigint) as task_sec,
 date_diff('second', min(start_time), max(end_time)) as span_sec
from task_times group by cluster_id, app_id, attempt, stage
order by span_sec desc, cluster_id, app_id, attempt, stage limit 10""", TASKS)

SQL["stage_skew"] = with_logs("""
select cluster_id, app_id, attempt, stage, count(*) as num_tasks, max(duration_sec) as max_task_sec,
 quantile_cont(duration_sec, 0.5) as median_task_sec,
 cast(max(duration_sec) as double) / nullif(quantile_cont(duration_sec, 0.5), 0) as skew
from task_times group by cluster_id, app_id, attempt, stage""", TASKS)

RUNNING = """
steps as (
select {keys}, ts, sum(d) d from (
 select *, start_time ts, 1 d from task_times where duration_sec > 0
 union all select *, end_time ts, -1 d from task_times where duration_sec > 0)
group by {keys}, ts having sum(d) <> 0
),
running as (
select *, sum(d) over w as n, date_diff('second', ts, lead(ts) over w) as sec from steps
window w as (partition by {keys} order by ts)
)"""

CONCURRENCY = """
select {keys}, t.num_tasks, t.task_sec, cast(coalesce(r.busy_sec, 0) as bigint) as busy_sec,
 cast(coalesce(r.peak_tasks, 0) as bigint) as peak_tasks,
 cast(t.task_sec as double) / cast(nullif(r.busy_sec, 0) as double) as mean_tasks
from (select {keys}, count(*) as num_tasks, cast(sum(greatest(duration_sec, 0)) as bigint) as task_sec from task_times group by {keys}) t
left join (select {keys}, sum(sec) filter (where n > 0) as busy_sec, max(n) as peak_tasks from running group by {keys}) r using ({keys})"""

for _name, _keys in (("task_concurrency", "cluster_id, app_id"), ("cluster_concurrency", "cluster_id")):
    SQL[_name] = with_logs(CONCURRENCY.format(keys=_keys), TASKS, RUNNING.format(keys=_keys))

SQL["python_timings"] = with_logs(r"""
select cluster_id, app_id, count(*) as runs, cast(sum(total) as bigint) as sum_total,
 avg(total) as avg_total, avg(boot) as avg_boot, avg(init) as avg_init, avg(finish) as avg_finish,
 max(total) as max_total, quantile_disc(total, 0.5) as p50_total, quantile_disc(total, 0.95) as p95_total
from (select cluster_id, app_id,
  try_cast(nullif(regexp_extract(log_entry, 'Times: total = (-?\d+), boot = (-?\d+), init = (-?\d+), finish = (-?\d+)', 1), '') as bigint) total,
  try_cast(nullif(regexp_extract(log_entry, 'Times: total = (-?\d+), boot = (-?\d+), init = (-?\d+), finish = (-?\d+)', 2), '') as bigint) boot,
  try_cast(nullif(regexp_extract(log_entry, 'Times: total = (-?\d+), boot = (-?\d+), init = (-?\d+), finish = (-?\d+)', 3), '') as bigint) init,
  try_cast(nullif(regexp_extract(log_entry, 'Times: total = (-?\d+), boot = (-?\d+), init = (-?\d+), finish = (-?\d+)', 4), '') as bigint) finish
 from parsed where contains(log_entry, 'PythonRunner: Times:'))
where total is not null group by cluster_id, app_id""")

SQL["resource_requests"] = with_logs(r"""
select cluster_id, app_id, count(*) as requests, cast(sum(executors) as bigint) as executors_requested,
 max(cores) as max_cores_per_executor, max(memory_mb) as max_memory_mb_per_executor,
 cast(sum(executors * cores) as bigint) as cores_requested,
 cast(sum(executors * memory_mb) as bigint) as memory_mb_requested
from (select cluster_id, app_id,
  try_cast(nullif(regexp_extract(log_entry, 'Will request (\d+) executor containers, each with (\d+) cores and (\d+) MB memory', 1), '') as bigint) executors,
  try_cast(nullif(regexp_extract(log_entry, 'Will request (\d+) executor containers, each with (\d+) cores and (\d+) MB memory', 2), '') as bigint) cores,
  try_cast(nullif(regexp_extract(log_entry, 'Will request (\d+) executor containers, each with (\d+) cores and (\d+) MB memory', 3), '') as bigint) memory_mb
 from parsed where contains(log_entry, 'Will request'))
where executors is not null group by cluster_id, app_id""")

SQL["container_requests"] = with_logs(r"""
select cluster_id, app_id, host, count(*) as requests, cast(sum(memory_mb) as bigint) as memory_mb_requested,
 max(memory_mb) as max_memory_mb, cast(sum(cores) as bigint) as cores_requested
from (select cluster_id, app_id, regexp_extract(log_entry, 'Container request \(host: ([^,]*), capability: <memory:(\d+), vCores:(\d+)>\)', 1) host,
  try_cast(nullif(regexp_extract(log_entry, 'Container request \(host: ([^,]*), capability: <memory:(\d+), vCores:(\d+)>\)', 2), '') as bigint) memory_mb,
  try_cast(nullif(regexp_extract(log_entry, 'Container request \(host: ([^,]*), capability: <memory:(\d+), vCores:(\d+)>\)', 3), '') as bigint) cores
 from parsed)
where memory_mb is not null group by cluster_id, app_id, host""")

SQL["failure_rates"] = with_logs("""
select cluster_id, app_id, count(*) as log_lines, count(*) filter (where log_level = 'ERROR') as error_lines,
 cast(count(*) filter (where log_level = 'ERROR') as double) / cast(count(*) as double) as error_rate
from parsed group by cluster_id, app_id""")

SQL["shuffle_blocks"] = with_logs(r"""
select cluster_id, app_id, count(*) as fetches, cast(sum(non_empty) as bigint) as non_empty_blocks,
 cast(sum(blocks) as bigint) as total_blocks,
 cast(sum(non_empty) as double) / nullif(cast(sum(blocks) as double), 0) as non_empty_share
from (select cluster_id, app_id,
  try_cast(nullif(regexp_extract(log_entry, 'Getting (\d+) non-empty blocks out of (\d+) blocks', 1), '') as bigint) non_empty,
  try_cast(nullif(regexp_extract(log_entry, 'Getting (\d+) non-empty blocks out of (\d+) blocks', 2), '') as bigint) blocks
 from parsed where contains(log_entry, 'non-empty blocks'))
where blocks is not null group by cluster_id, app_id""")

SQL["memory_blocks"] = with_logs(r"""
select cluster_id, app_id, count(*) as blocks, cast(sum(bytes) as bigint) as bytes_stored,
 max(bytes) as max_block_bytes
from (select cluster_id, app_id,
  cast(round(try_cast(regexp_extract(log_entry, 'Block (\S+) stored as bytes in memory \(estimated size ([0-9.]+) (B|KB|MB|GB)', 2) as double)
   * case regexp_extract(log_entry, 'Block (\S+) stored as bytes in memory \(estimated size ([0-9.]+) (B|KB|MB|GB)', 3)
       when 'B' then 1 when 'KB' then 1024 when 'MB' then 1048576 when 'GB' then 1073741824 end) as bigint) bytes
 from parsed where contains(log_entry, 'stored as bytes in memory'))
where bytes is not null group by cluster_id, app_id""")

SQL["input_splits"] = with_logs(r"""
select cluster_id, app_id, input_file, count(*) as splits, cast(sum(length) as bigint) as bytes_read
from (select cluster_id, app_id,
  regexp_extract(log_entry, 'Input split: (.*):(\d+)\+(\d+)$', 1) input_file,
  try_cast(nullif(regexp_extract(log_entry, 'Input split: (.*):(\d+)\+(\d+)$', 3), '') as bigint) length
 from parsed where contains(log_entry, 'Input split:'))
where length is not null group by cluster_id, app_id, input_file""")

SQL["trip_row_count"] = "select count(*) as total_rows from lineitem"

SQL["year_filter_count"] = with_trips("""
select count(*) as filtered_rows from trips
where tpep_pickup_datetime >= timestamp '1997-01-01' and tpep_pickup_datetime < timestamp '1998-01-01'""")

SQL["date_parts"] = with_trips("""
select tpep_pickup_datetime, cast(year(tpep_pickup_datetime) as integer) as dt_year,
 cast(month(tpep_pickup_datetime) as integer) as dt_month,
 cast(day(tpep_pickup_datetime) as integer) as dt_day from trips""")

DAILY = """
select cast(year(tpep_pickup_datetime) as integer) as dt_year,
 cast(month(tpep_pickup_datetime) as integer) as dt_month,
 cast(day(tpep_pickup_datetime) as integer) as dt_day,
 count(*) as num_trips, avg(trip_distance) as mean_trip_distance, max(mta_tax) as max_mta_tax,
 quantile_disc(fare_amount, 0.95) as q95_fare_amount, min(tip_amount) as min_tip_amount,
 cast(ceil(avg(passenger_count)) as bigint) as mean_passenger_count
from trips {where} group by 1, 2, 3"""

YEAR_1997 = ("where tpep_pickup_datetime >= timestamp '1997-01-01'"
             " and tpep_pickup_datetime < timestamp '1998-01-01'")

SQL["daily_summary"] = with_trips(DAILY.format(where=YEAR_1997) + " order by 1 desc, 2 desc, 3 desc")

SQL["daily_summary_all_years"] = with_trips(DAILY.format(where="") + " order by 1 desc, 2 desc, 3 desc")

SQL["daily_summary_from_states"] = SQL["daily_summary_all_years"]

SQL["yearly_quantile_ranks"] = with_trips("""
select cast(year(tpep_pickup_datetime) as int) as dt_year, count(*) as num_trips, true as within_error
from trips group by 1""")

SQL["daily_totals"] = with_trips("""
select count(*) as num_days, cast(min(make_date(dt_year, dt_month, dt_day)) as timestamp) as first_date,
 cast(max(make_date(dt_year, dt_month, dt_day)) as timestamp) as last_date, cast(sum(num_trips) as bigint) as total_trips,
 avg(num_trips) as avg_daily_trips from daily""", "daily as (" + DAILY.format(where=YEAR_1997) + ")")

SQL["sql_count"] = with_logs("select count(*) as total from log_lines")

SQL["even_doubled"] = "select event_id * 2 as doubled from events where event_id % 2 = 0"

PY = r"'Times: total = (-?\d+), boot = (-?\d+), init = (-?\d+), finish = (-?\d+)'"
RQ = r"'Will request (\d+) executor containers, each with (\d+) cores and (\d+) MB memory'"
SH = r"'Getting (\d+) non-empty blocks out of (\d+) blocks'"
MB = r"'Block (\S+) stored as bytes in memory \(estimated size ([0-9.]+) (B|KB|MB|GB)'"


def _num(marker: str, pattern: str, idx: int) -> str:
    return (f"case when contains(log_entry, '{marker}') then "
            f"try_cast(nullif(regexp_extract(log_entry, {pattern}, {idx}), '') as bigint) end")


SQL["app_report"] = with_logs(f"""
select cluster_id, app_id, count(*) as log_lines,
 count(*) filter (where log_level = 'ERROR') as error_lines,
 count(py_total) as python_runs, avg(py_total) as avg_python_total, avg(py_boot) as avg_python_boot,
 cast(coalesce(sum(executors), 0) as bigint) as executors_requested,
 cast(coalesce(sum(executors * memory_mb), 0) as bigint) as memory_mb_requested,
 coalesce(max(cores), 0) as max_cores_per_executor,
 count(blocks) as shuffle_fetches, cast(coalesce(sum(non_empty), 0) as bigint) as non_empty_blocks,
 cast(coalesce(sum(blocks), 0) as bigint) as total_blocks,
 count(block_bytes) as memory_blocks, cast(coalesce(sum(block_bytes), 0) as bigint) as bytes_stored,
 cast(count(*) filter (where log_level = 'ERROR') as double) / cast(count(*) as double) as error_rate
from (select cluster_id, app_id, log_level,
  {_num('PythonRunner: Times:', PY, 1)} py_total,
  {_num('PythonRunner: Times:', PY, 2)} py_boot,
  {_num('Will request', RQ, 1)} executors,
  {_num('Will request', RQ, 2)} cores,
  {_num('Will request', RQ, 3)} memory_mb,
  {_num('non-empty blocks', SH, 1)} non_empty,
  {_num('non-empty blocks', SH, 2)} blocks,
  case when contains(log_entry, 'stored as bytes in memory') then
   cast(round(try_cast(regexp_extract(log_entry, {MB}, 2) as double)
    * case regexp_extract(log_entry, {MB}, 3)
        when 'B' then 1 when 'KB' then 1024 when 'MB' then 1048576 when 'GB' then 1073741824 end) as bigint)
  end block_bytes
 from parsed)
group by cluster_id, app_id""")
