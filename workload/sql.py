"""SQL counterparts of the derived tables, as common table expressions."""

from __future__ import annotations

BASE = """base as (
 select lpad(cast(user_id as varchar), 8, '0') as run, user_id,
  lpad(cast(cast(floor((extract(day from ts) - 1) / 10.0) as int) as varchar), 3, '0') as subrun,
  row_number() over (partition by user_id order by ts, event_id) - 1 as seq0,
  case when user_id % 10 = 7 then 0.0 else value end as nanotime,
  case when user_id % 10 = 7 then 0.0
       else cast(extract(hour from ts) * 60 + extract(minute from ts) as double) end as time2,
  case when user_id % 10 = 7 then case event_type when 'click' then 1 when 'error' then 2
        when 'purchase' then 3 when 'signup' then 4 else 5 end else event_id end as id,
  event_id, value
 from events)"""

CALIB = """calib as (
 select run, user_id, subrun, 'M1' as tel, seq0 as seq, nanotime, time2, id, event_id, value from base
  where event_id % 7 <> 0 and not (user_id % 10 = 6 and subrun = '002')
    and not (user_id % 10 = 8 and seq0 % 4 <> 0)
 union all
 select run, user_id, subrun, 'M2', seq0, nanotime, time2, id, event_id, value from base
  where event_id % 11 <> 0)"""


def stereo(min_value: float = 5, name: str = "stereo") -> str:
    return f"""{name}_list as (
 select run, user_id, 2 * seq0 + case when user_id % 10 = 4 and seq0 % 8 = 0 then 17 else 0 end as pos,
  nanotime, time2, id from base
  where value > {min_value} and event_id % 7 <> 0 and (event_id % 11 <> 0 or user_id % 10 = 3)
 union all
 select run, user_id, 2 * seq0 + 1, nanotime, time2, id from (
  select b.*, max(seq0) over (partition by run) as mx from base b
   where value > {min_value} and event_id % 7 <> 0 and event_id % 11 <> 0) x
  where user_id % 10 = 5 and seq0 = mx),
 {name} as (
 select run, user_id, row_number() over (partition by run order by pos, id) - 1 as sseq,
  nanotime, time2, id from {name}_list),
 {name}_keys as (select run, sseq, tel, nanotime, time2, id from {name}, (values ('M1'), ('M2')) t(tel))"""


VALID = "valid as (select distinct run, subrun from base)"

COMPLETE = """complete as (
 select v.run, t.tel, coalesce(f.n_files, 0) as n_files, v.n_valid,
  coalesce(f.n_files, 0) >= v.n_valid as complete
 from (select run, count(distinct subrun) as n_valid from valid group by run) v
 cross join (values ('M1'), ('M2')) t(tel)
 left join (select run, tel, count(distinct subrun) as n_files from calib group by run, tel) f
  on f.run = v.run and f.tel = t.tel)"""


def walk(calib: str = "calib", keys: str = "stereo_keys", name: str = "walk") -> str:
    """The two-pointer walk, one calibrated row of every run per recursion."""
    return f"""{name}_c as (
 select run, tel, seq, nanotime, time2, id,
  row_number() over (partition by run, tel order by seq) as k from {calib}),
 {name} as (
 select distinct run, tel, cast(0 as bigint) as k, cast(0 as bigint) as p,
  cast(null as bigint) as sseq, cast(null as bigint) as seq from {keys}
 union all
 select w.run, w.tel, c.k, w.p + case when s.sseq is null then 0 else 1 end, s.sseq,
  case when s.sseq is null then null else c.seq end
 from {name} w join {name}_c c on c.run = w.run and c.tel = w.tel and c.k = w.k + 1
 left join {keys} s on s.run = w.run and s.tel = w.tel and s.sseq = w.p
  and s.nanotime = c.nanotime and s.time2 = c.time2 and s.id = c.id),
 {name}_n as (
 select r.run, r.tel, r.n_ref, coalesce(c.n_calib, 0) as n_calib, w.n_found, w.last_seq, r.tail_equal
 from (select run, tel, count(*) as n_ref,
        count(*) filter (where sseq >= mx - 1) = 2
        and count(distinct case when sseq >= mx - 1 then (nanotime, time2, id) end) = 1 as tail_equal
       from (select *, max(sseq) over (partition by run, tel) as mx from {keys}) group by run, tel) r
 left join (select run, tel, count(*) as n_calib from {calib} group by run, tel) c
  on c.run = r.run and c.tel = r.tel
 join (select run, tel, max(p) as n_found, max(seq) as last_seq from {name} group by run, tel) w
  on w.run = r.run and w.tel = r.tel),
 {name}_status as (
 select run, tel, case when n_calib < n_ref then 'calib_shorter' when n_found = 0 then 'empty'
   when n_found = n_ref then 'ok' when n_found = n_ref - 1 and tail_equal then 'tail_dup'
   else 'mismatch' end as status, n_calib, n_ref, last_seq from {name}_n),
 {name}_kept as (
 select w.run, w.tel, w.sseq, w.seq from {name} w join {name}_status s
  on s.run = w.run and s.tel = w.tel where w.sseq is not null and s.status in ('ok', 'tail_dup')
 union all
 select run, tel, n_ref - 1, last_seq from {name}_status where status = 'tail_dup')"""


def accepted(name: str = "walk", complete: bool = True) -> str:
    """Status of every run with missing files and partner failure; kept rows of accepted runs."""
    lost = (
        f"""union all
 select c.run, c.tel, 'missing_files', null, r.n_ref from complete c
 join (select run, tel, count(*) as n_ref from stereo_keys group by run, tel) r
  on r.run = c.run and r.tel = c.tel where not c.complete"""
        if complete
        else ""
    )
    return f"""{name}_all as (
 select run, tel, status, n_calib, n_ref from {name}_status
 {lost}),
 {name}_good as (
 select run from {name}_all group by run having count(*) = 2
  and bool_and(status in ('ok', 'tail_dup')) and min(n_ref) = max(n_ref)),
 {name}_final as (
 select a.run, a.tel, case when a.status in ('ok', 'tail_dup') and g.run is null then 'partner_failed'
   else a.status end as status, a.n_calib, a.n_ref,
  cast(case when g.run is null then 0 else a.n_ref end as bigint) as n_kept
 from {name}_all a left join {name}_good g on g.run = a.run),
 {name}_selected as (select k.* from {name}_kept k where k.run in (select run from {name}_good))"""


USABLE = """usable as (
 select c.* from calib c join complete d on d.run = c.run and d.tel = c.tel where d.complete),
 wanted as (
 select s.* from stereo_keys s join complete d on d.run = s.run and d.tel = s.tel where d.complete)"""

FEATURES = """feats as (
 select vec_id, generate_subscripts(embedding, 1) - 1 as p, cast(unnest(embedding) as double) as x
 from embeddings),
 digest as (
 select vec_id, sum(x) as s, sum(x * p) as m, max(case when p = 0 then x end) as e0, cast(count(*) as int) as n
 from feats group by vec_id)"""

# All rows of the table serve as features, whatever their number.
N_VEC = "(select count(*) from embeddings)"
VEC = f"case when tel = 'M1' then event_id % {N_VEC} else (event_id * 7 + 3) % {N_VEC} end"


#: Simulated runs have even numbers.
MC = "cast(run as bigint) % 2 = 0 as mc"


def side(mc: bool | None, name: str = "ev") -> str:
    """Simulated or observed events, or with None both."""
    kept = "" if mc is None else f"where user_id % 2 = {0 if mc else 1}"
    return f"""{name} as (
 select lpad(cast(user_id as varchar), 8, '0') as run, event_id, value, ts,
  cast(event_id % 46 as double) as zd, cast(event_id % 360 as double) as az
 from events {kept})"""


def longform(ev: str = "ev", name: str = "longform") -> str:
    """One row per event and interleaved feature."""
    return f"""{name} as (
 select run, event_id, 2 * p as pos, case when p = 0 then 1.0 else x end as x
  from {ev} join feats on vec_id = event_id % {N_VEC}
 union all
 select run, event_id, 2 * p + 1, x from {ev} join feats on vec_id = (event_id * 7 + 3) % {N_VEC})"""


def stats(ev: str, feats: str, mc: bool, name: str, by: str = "") -> str:
    """Norm of one side; ``by`` is an extra grouping column."""
    g = f"{by}, " if by else ""
    gb = f"group by {by}" if by else ""
    shift = 1 if mc else 0
    energy = (
        f"""union all
 select {g}0, avg(ln(value)), stddev_pop(ln(value)) from {ev} {gb}"""
        if mc
        else ""
    )
    return f"""{name} as (
 select {g}pos + {shift} as pos, avg(x) as mean, stddev_pop(x) as std from {feats} group by {g}pos
 union all select {g}{128 + shift}, avg(zd), stddev_pop(zd) from {ev} {gb}
 union all select {g}{129 + shift}, avg(az), stddev_pop(az) from {ev} {gb}
 {energy})"""


SCALE = """scale as (
 select avg(ln(value)) as mean, stddev_pop(ln(value)) as std from events where user_id % 2 = 0)"""

FILES = """files as (
 select run, tel, subrun, count(*) * 1000 as bytes,
  '20240101_' || tel || '_' || run || '.' || subrun || '_Y_Src.csv' as name
 from calib group by run, tel, subrun)"""

DAYS = """days as (
 select strftime(ts, '%Y%m%d') as day, lpad(strftime(ts, '%d'), 8, '0') as run,
  case when extract(hour from ts) < 12 then '001' else '002' end as subrun, tel, event_id, event_id as id, event_type,
  value as nanotime, cast(extract(hour from ts) * 60 + extract(minute from ts) as double) as time2, value,
  cast(event_id % 46 as double) as zd, cast(event_id % 360 as double) as az,
  strftime(ts, '%Y%m%d') || '_' || tel || '_' || lpad(strftime(ts, '%d'), 8, '0') || '.'
   || case when extract(hour from ts) < 12 then '001' else '002' end || '_Y_Src.csv' as name
 from events, (values ('M1'), ('M2')) t(tel) where tel = 'M1' or event_type <> 'error')"""

DAY_DIGEST = f"""day_digest as (
 select d.*, g.n as n_features, round(g.s - case when tel = 'M1' then g.e0 - 1.0 else 0.0 end, 6) as pix_sum,
  round(g.m, 6) as pix_moment
 from days d join digest g on g.vec_id = {VEC})"""

CALIB_DIGEST = f"""calib_digest as (
 select c.*, g.n as n_features, round(g.s - case when tel = 'M1' then g.e0 - 1.0 else 0.0 end, 6) as pix_sum,
  round(g.m, 6) as pix_moment
 from calib c join digest g on g.vec_id = {VEC})"""


def sql(*parts: str, select: str, recursive: bool = False) -> str:
    head = "with recursive " if recursive else "with "
    return head + ",\n".join(parts) + "\n" + select


def r6(expression: str) -> str:
    """Six digits, without negative zero."""
    return f"round({expression}, 6) + 0.0"
