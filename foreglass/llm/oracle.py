"""Oracle SQL of the training-data queries that SQL can express."""

_SCORED = "scored as (select distinct submission_id, score_id, forecaster, brier_score from brier_scores where submission_id is not null and not isnan(brier_score) and brier_score between 0 and 1)"
_CUT = f"""{_SCORED},
 ranked as (select *, row_number() over (partition by submission_id order by brier_score) rn, count(*) over (partition by submission_id) n from scored),
 cuts as (select submission_id, max(brier_score) cutoff, max(n) n from ranked where rn = greatest(1, n // 5) group by submission_id)"""

_TRIM = r"regexp_replace({}, '^[\s\p{{Z}}]+|[\s\p{{Z}}]+$', '', 'g')"
_RECORDS = f"""records as (select distinct event_ticker, submission_id, lower({_TRIM.format('category')}) name from sampled_rows where event_ticker is not null and submission_id is not null),
 supply as (select name, sum(least(n, 5)) available from (select name, event_ticker, count(*) n from records group by all) group by name),
 needs as (select category, target_share, min_rows, greatest(min_rows, cast(floor(target_share * sample_size + 0.5 + 1e-9) as bigint)) wanted, coalesce(available, 0) available from category_targets left join supply on lower(category) = name)"""

_BOUND = f"""with recursive tickers as (select upper({_TRIM.format('event_ticker')}) e, regexp_replace(lower(submission_id), '[^0-9a-f]', '', 'g') s from predictions where event_ticker is not null),
 kept as (select distinct e, s from tickers where e <> '' and regexp_matches(s, '[1-9a-f]')),
 links as (select distinct a.e a, b.e b from kept a join kept b on a.s = b.s and a.e <> b.e),
 reach(a, b) as (select a, b from links union select r.a, l.b from reach r join links l on r.b = l.a)"""
_QUOTAS = f"""{_RECORDS},
 scarce as (select category, name_of name, wanted / available scarcity from (select *, lower(category) name_of from needs) where available > 0),
 one as (select event_ticker, submission_id, category, scarcity from records join scarce using (name) qualify row_number() over (partition by event_ticker, submission_id order by scarcity desc, category desc) = 1),
 own as (select *, row_number() over (partition by event_ticker, category order by md5('42|' || event_ticker || '|' || submission_id), submission_id) turn from one),
 pool as (select * from own qualify row_number() over (partition by event_ticker order by scarcity < 1, turn, scarcity desc, category) <= 5),
 have as (select category, count(*) n from pool group by 1),
 size as (select max(sample_size) k from category_targets),
 slots as (select category, j, case when j <= least(n, min_rows) then 0.0::double else (j - 0.5::double) / target_share end priority from have join category_targets using (category), unnest(generate_series(1, n)) s(j) where j <= least(n, min_rows) or target_share > 0),
 quotas as (select category, count(*) drawn from (select category, row_number() over (order by priority, category, j) place from slots) where place <= (select k from size) group by 1)"""

ORACLE = {
    "p1_found": f"with {_RECORDS} select category from needs where available < wanted",
    "p1_report": f"""with {_QUOTAS}
 select category, target_share, min_rows, wanted, available, greatest(0, wanted - available) short, coalesce(drawn, 0) drawn, coalesce(drawn, 0) / (select sum(drawn) from quotas) drawn_share, target_share - coalesce(drawn, 0) / (select sum(drawn) from quotas) gap from needs left join quotas using (category)""",
    "p2_found": f"{_BOUND} select distinct a event_ticker_a, b event_ticker_b from reach where a < b",
    "p2_members": f"{_BOUND}, t as (select distinct e from tickers where e <> ''), c as (select a, min(b) least, count(*) n from reach group by a) select e event_ticker, coalesce(least, e) class, coalesce(n, 1) n_bound from t left join c on e = a",
    "p2_splits": f"""{_BOUND}, cls as (select a, min(b) root from reach group by a),
 allrows as (select prediction_id id, nullif(upper({_TRIM.format('event_ticker')}), '') hub, case when regexp_matches(regexp_replace(lower(submission_id), '[^0-9a-f]', '', 'g'), '[1-9a-f]') then regexp_replace(lower(submission_id), '[^0-9a-f]', '', 'g') end spoke from predictions where prediction_id is not null),
 one as (select id, hub, spoke from allrows qualify row_number() over (partition by id order by hub nulls first, spoke nulls first) = 1),
 mates as (select spoke, min(hub) mate from allrows where hub is not null and spoke is not null group by 1),
 named as (select id, coalesce(h.root, hub, m.root, mate, 'spoke ' || one.spoke, 'row ' || id) component from one left join cls h on h.a = hub left join mates on mates.spoke = one.spoke left join cls m on m.a = mate),
 sizes as (select component, count(*) w from named group by 1),
 run as (select component, sum(w) over (order by w desc, md5('42|' || component), component rows between unbounded preceding and current row) - w before from sizes),
 edges as (select split_name, sum(share) over (order by share desc, split_name rows between unbounded preceding and current row) / (select sum(share) from split_shares) edge from split_shares),
 put as (select component, coalesce((select arg_min(split_name, edge) from edges where before < (select count(*) from named) * edge), (select arg_max(split_name, edge) from edges)) split_name from run)
 select id prediction_id, component, split_name from named join put using (component)""",
    "p4_found": f"""with {_SCORED},
 ranked as (select *, row_number() over (partition by submission_id order by brier_score, forecaster, score_id) rn from scored)
 select submission_id, score_id from ranked where rn <= 3""",
    "p5_found": f"with {_CUT} select s.submission_id, s.score_id from scored s join cuts c on s.submission_id = c.submission_id where s.brier_score <= c.cutoff",
    "p5_cutoffs": f"with {_CUT} select s.submission_id, any_value(c.cutoff) cutoff, count(*) n_scored, count(*) filter (where s.brier_score <= c.cutoff) n_kept from scored s join cuts c on s.submission_id = c.submission_id group by s.submission_id",
}
