"""Core queries and their oracle SQL, side by side."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from foreglass.functions import text
from foreglass.operators import analyze, enrich, ingest, metrics, ranking, sampling, selection, weights
from foreglass.plans.judge import ask, evaluate, evaluate_models
from foreglass.plans.prompts import REASONING, TITLE
from foreglass.queries import nested
from foreglass.queries.loose_sql import elements, loose
from foreglass.queries.views import FORECASTS_SQL, MARKETS_SQL, SCORES_SQL, forecasts, markets, read, scores
from foreglass.session import scratch_folder
from foreglass.streaming.scoring import score_outputs

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = dict(nested.QUERIES)
ORACLE: dict[str, str] = dict(nested.ORACLE)
METRIC = "brier_score"


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Registers a query under its name, with its oracle if SQL can express it."""
    def register(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLE[f.__name__] = sql
        return f

    return register


def six(name: str):
    return F.round(name, 6).alias(name)


def nine(name: str):
    """Scores of prices and probabilities with two decimals often end in a 5 at the seventh, where engines round apart."""
    return F.round(name, 9).alias(name)


def fx(*parts: str) -> str:
    return "with" + FORECASTS_SQL + "".join(f",\n {p}" for p in parts) + "\n"


def b(*parts: str) -> str:
    return "with" + SCORES_SQL + "".join(f",\n {p}" for p in parts) + "\n"


def mk(*parts: str) -> str:
    return "with" + MARKETS_SQL + "".join(f",\n {p}" for p in parts) + "\n"


# --- scores and leaderboards -------------------------------------------------


@query(fx() + "select row_id, forecaster, event_ticker, submission_id, round, round(brier_score, 6) brier_score from sc")
def brier_score(spark, sf_dir):
    return metrics.with_brier(forecasts(spark, sf_dir)).select("row_id", "forecaster", "event_ticker", "submission_id", "round", six("brier_score"))


@query(fx() + "select cast(rank() over (order by s) as int) rank, forecaster, round(s, 6) score from (select forecaster, sum(brier_score * weight) / sum(weight) s from sc group by forecaster)")
def forecaster_leaderboard(spark, sf_dir):
    return ranking.rank_forecasters(metrics.with_brier(forecasts(spark, sf_dir))).select("rank", "forecaster", six("score"))


@query(fx("n as (select *, weight / count(*) over (partition by forecaster, event_ticker) w from sc)") + "select cast(rank() over (order by s) as int) rank, forecaster, round(s, 6) score from (select forecaster, sum(brier_score * w) / sum(w) s from n group by forecaster)")
def leaderboard_round_normalized(spark, sf_dir):
    return ranking.rank_forecasters(metrics.with_brier(forecasts(spark, sf_dir)), by_round=True).select("rank", "forecaster", six("score"))


_BASELINE = fx("base as (select * from (select *, row_number() over (partition by submission_id order by row_id) rn from fx) where rn = 1)",
               "every as (select forecaster, weight, brier_score from sc union all select 'market-baseline', weight, ((a1-y1)*(a1-y1) + (a2-y2)*(a2-y2) + (a3-y3)*(a3-y3)) / 3 from base)")


@query(_BASELINE + "select cast(rank() over (order by s) as int) rank, forecaster, round(s, 6) score from (select forecaster, sum(brier_score * weight) / sum(weight) s from every group by forecaster)")
def market_baseline_leaderboard(spark, sf_dir):
    rows = ranking.with_market_baseline(forecasts(spark, sf_dir))
    return ranking.rank_forecasters(metrics.with_brier(rows)).select("rank", "forecaster", six("score"))


_EDGES = "e as (select *, " + ", ".join(f"p{i}/a{i} ye{i}, (1-p{i})/n{i} ne{i}, case when p{i}/a{i} > (1-p{i})/n{i} then y{i}/a{i} else (1-y{i})/n{i} end pay{i}, greatest(p{i}/a{i}, (1-p{i})/n{i}) best{i}" for i in (1, 2, 3)) + " from fx)"
_ALLIN = "r as (select *, case when best1 >= best2 and best1 >= best3 then pay1 when best2 >= best3 then pay2 else pay3 end average_return from e)"


def _returns(spark, sf_dir, spread: bool = False):
    return forecasts(spark, sf_dir).withColumn("average_return", metrics.average_return(F.col("prediction"), F.col("market_outcome"), F.col("odds"), F.col("no_odds"), spread))


@query(fx(_EDGES, _ALLIN) + "select row_id, forecaster, round(average_return, 6) average_return from r")
def average_return_allin(spark, sf_dir):
    return _returns(spark, sf_dir).select("row_id", "forecaster", six("average_return"))


@query(fx(_EDGES) + "select row_id, forecaster, round((pay1 + pay2 + pay3) / 3, 6) average_return from e")
def average_return_spread(spark, sf_dir):
    return _returns(spark, sf_dir, True).select("row_id", "forecaster", six("average_return"))


@query(fx(_EDGES, _ALLIN) + "select forecaster, round(avg(average_return - 1) / stddev_samp(average_return - 1), 6) sharpe_ratio, round(avg(average_return - 1), 6) mean_excess_return, round(stddev_samp(average_return - 1), 6) std_excess_return from r group by forecaster")
def sharpe_ratio(spark, sf_dir):
    return metrics.sharpe(_returns(spark, sf_dir), "average_return", 1.0).select("forecaster", six("sharpe_ratio"), six("mean_excess_return"), six("std_excess_return"))


@query(fx(_EDGES, _ALLIN, "ev as (select forecaster, event_ticker, sum(average_return * weight) / sum(weight) - 1 x from r group by all)") + "select forecaster, round(case when stddev_samp(x) > 0 then avg(x) / stddev_samp(x) when avg(x) = 0 then 0 else sign(avg(x)) * 'inf'::double end, 6) sharpe_ratio, round(avg(x), 6) mean_excess_return, round(stddev_samp(x), 6) std_excess_return from ev group by forecaster")
def sharpe_by_event(spark, sf_dir):
    return metrics.sharpe(_returns(spark, sf_dir), "average_return", 1.0, by_event=True).select("forecaster", six("sharpe_ratio"), six("mean_excess_return"), six("std_excess_return"))


_PAIRS = "pairs as (select forecaster, weight / 3 w, unnest([p1, p2, p3]) p, unnest([y1, y2, y3]) y from fx)"
_INNER = "[" + ", ".join(f"{e!r}::double" for e in metrics.bin_edges(10)) + "]"


def _bins(edges: str) -> list[str]:
    return [f"binned as (select pairs.*, len(list_filter({edges}, lambda e: p >= e)) bin from pairs{' join q using (forecaster)' if edges == 'inner_edges' else ''})",
            "bins as (select forecaster, bin, sum(w) sw, sum(w*p)/sum(w) confidence, sum(w*y)/sum(w) accuracy, count(*) c from binned group by all)",
            "whole as (select forecaster, sum(sw) aw, sum(c) n from bins group by all)",
            "counted as (select forecaster, bin, confidence, accuracy, cast(floor(sw * n / aw + 1e-9) as bigint) count, n from bins join whole using (forecaster))"]


_ECE = "select forecaster, round(sum(abs(confidence - accuracy) * count / n), 6) ece_score from counted group by forecaster"


@query(fx(_PAIRS, *_bins(_INNER)) + _ECE)
def ece_uniform(spark, sf_dir):
    return metrics.calibration_error(forecasts(spark, sf_dir)).select("forecaster", six("ece_score"))


@query(fx(_PAIRS, *_bins(_INNER)) + "select forecaster, cast(bin as int) bin, round(confidence, 6) confidence, round(accuracy, 6) accuracy, count from counted")
def ece_bins_detail(spark, sf_dir):
    return metrics.calibration_bins(forecasts(spark, sf_dir)).select("forecaster", "bin", six("confidence"), six("accuracy"), "count")


_QUANTILES = "q as (select forecaster, list_distinct(quantile_cont(p, [" + ", ".join(f"{i / 5!r}" for i in range(6)) + "])) e from pairs group by forecaster), q0 as (select forecaster, list_sort(e) e from q)"


@query(fx(_PAIRS, _QUANTILES.replace("q as", "qa as", 1).replace("from q)", "from qa)"), "q as (select forecaster, e[2:len(e)-1] inner_edges from q0)", *_bins("inner_edges")) + _ECE)
def ece_quantile(spark, sf_dir):
    return metrics.calibration_error(forecasts(spark, sf_dir), n_bins=5, strategy="quantile").select("forecaster", six("ece_score"))


_SUMMARY = """select count(*) n, count(distinct event_ticker) n_events, count(distinct submission_id) n_submissions, round(avg(brier_score), 6) mean, round(median(brier_score), 6) median, round(min(brier_score), 6) min, round(max(brier_score), 6) max, round(stddev_samp(brier_score), 6) std,
 any_value(em) event_mean, any_value(ed) event_median, any_value(ei) event_min, any_value(ex) event_max, any_value(es) event_std
 from b cross join (select round(avg(m), 6) em, round(median(m), 6) ed, round(min(m), 6) ei, round(max(m), 6) ex, round(stddev_samp(m), 6) es from (select event_ticker, avg(brier_score) m from b where brier_score is not null group by 1)) where brier_score is not null"""


@query(b() + _SUMMARY)
def score_summary(spark, sf_dir):
    rows = metrics.score_summary(scores(spark, sf_dir))
    return rows.select(*(c if t == "bigint" else six(c) for c, t in rows.dtypes))


@query(b() + "select count(brier_score) n_valid, round(avg(brier_score), 6) mean_score, (select round(avg(m), 6) from (select avg(brier_score) m from b where brier_score is not null group by event_ticker)) event_mean_score, (select count(*) from (select distinct event_ticker from b where brier_score is not null)) n_events from b")
def event_mean_summary(spark, sf_dir):
    return metrics.event_mean(scores(spark, sf_dir)).select("n_valid", six("mean_score"), six("event_mean_score"), "n_events")


@query()
def bootstrap_ci(spark, sf_dir):
    return ranking.rank_forecasters(scores(spark, sf_dir), interval={"n": 1000, "level": 0.9, "seed": 42})


# --- selection ---------------------------------------------------------------

_Z = ["g as (select submission_id, count(*) n, avg(brier_score) m, stddev_samp(brier_score) s from b where submission_id is not null group by 1)",
      "rep as (select submission_id from (select submission_id, forecaster, count(*) c from b group by all) group by 1 having max(c) = 1)",
      "z as (select b.*, (brier_score - m) / s z_score from b join g using (submission_id) join rep using (submission_id) where n >= 2 and s > 0)"]
_AMB = ["amb_g as (select submission_id from b where submission_id is not null group by 1 having count(*) = count(brier_score) and min(brier_score) > 0.15)",
        "amb_rows as (select b.* from b join amb_g using (submission_id) where brier_score < 0.25)",
        "amb as (select * exclude (rn) from (select *, row_number() over (partition by submission_id order by brier_score, row_id) rn from amb_rows) where rn <= 3)"]
_PLACED = "placed as (select *, row_number() over (partition by submission_id order by coalesce(brier_score, 'inf'::double), row_id) rn, count(*) over (partition by submission_id) n from b where submission_id is not null)"
_KEY = ["row_id", "submission_id", "forecaster"]


@query(b(*_Z) + "select row_id, submission_id, forecaster from z where z_score < -1.5 and brier_score <= 0.15")
def z_score_filter(spark, sf_dir):
    return selection.top_z_score(scores(spark, sf_dir), METRIC, "row_id", 1.5, -1, 0.15).select(_KEY)


@query(b(*_AMB) + "select row_id, submission_id, forecaster from amb")
def ambiguous_filter(spark, sf_dir):
    return selection.ambiguous(scores(spark, sf_dir), METRIC, "row_id", 0.25, 0.15, 3).select(_KEY)


@query(b(_PLACED) + "select row_id, submission_id, forecaster from placed where rn <= 2")
def absolute_topk(spark, sf_dir):
    return selection.top_absolute(scores(spark, sf_dir), METRIC, "row_id", top_k=2).select(_KEY)


@query(b(_PLACED) + "select row_id, submission_id, forecaster from placed where rn <= greatest(1, floor(n * 0.1::double)) and brier_score <= 0.2")
def absolute_topp(spark, sf_dir):
    return selection.top_absolute(scores(spark, sf_dir), METRIC, "row_id", top_p=0.1, min_val=0.2).select(_KEY)


_COMBINED = "tagged as (select 0 part, row_id, forecaster, event_ticker, submission_id, round from z where z_score < -1.5 and brier_score <= 0.15 union all select 1, row_id, forecaster, event_ticker, submission_id, round from amb)"


@query(b(*_Z, *_AMB, _COMBINED) + "select row_id, submission_id, forecaster from (select *, row_number() over (partition by forecaster, event_ticker, submission_id, round order by part, row_id) rn from tagged) where rn = 1")
def combined_filter(spark, sf_dir):
    rows = scores(spark, sf_dir)
    parts = [selection.top_z_score(rows, METRIC, "row_id", 1.5, -1, 0.15), selection.ambiguous(rows, METRIC, "row_id", 0.25, 0.15, 3)]
    return selection.combine(parts, "row_id", rows).select(_KEY)


def _dedup_sql(order: str) -> str:
    return b() + f"select row_id, submission_id, forecaster from (select *, row_number() over (partition by event_ticker, submission_id order by {order}) rn from b) where rn = 1"


@query(_dedup_sql("row_id"))
def dedup_first(spark, sf_dir):
    return selection.deduplicate_problems(scores(spark, sf_dir), "row_id", "first").select(_KEY)


@query(_dedup_sql("md5('42|' || row_id), row_id"))
def dedup_random_md5(spark, sf_dir):
    return selection.deduplicate_problems(scores(spark, sf_dir), "row_id", "random", 42).select(_KEY)


@query(_dedup_sql("coalesce(brier_score, 'inf'::double), row_id"))
def dedup_best(spark, sf_dir):
    return selection.deduplicate_problems(scores(spark, sf_dir), "row_id", "best_brier").select(_KEY)


@query(b() + "select row_id, submission_id, forecaster from b order by md5('42|' || row_id), row_id limit 500")
def limit_problems_md5(spark, sf_dir):
    return selection.limit_problems(scores(spark, sf_dir), "row_id", 500, True, 42).select(_KEY)


@query(b() + "select row_id, submission_id, forecaster from (select *, row_number() over (partition by event_ticker order by row_id) rn from b) where rn <= 5")
def cap_per_event(spark, sf_dir):
    return selection.cap_per_event(scores(spark, sf_dir), ["row_id"], 5).select(_KEY)


_DONE = "done as (select distinct submission_id, forecaster from augmented_reasoning)"


@query(b(_DONE) + "select row_id, submission_id, forecaster from b anti join done using (submission_id, forecaster)")
def remaining_work_anti(spark, sf_dir):
    return selection.remaining_work(scores(spark, sf_dir), read(spark, sf_dir, "augmented_reasoning"))[0].select(_KEY)


@query(b(_DONE) + "select distinct aug_id, submission_id, forecaster from augmented_reasoning semi join (select distinct submission_id, forecaster from b) using (submission_id, forecaster)")
def wanted_results_semi(spark, sf_dir):
    return selection.remaining_work(scores(spark, sf_dir), read(spark, sf_dir, "augmented_reasoning"))[1].select("aug_id", "submission_id", "forecaster").distinct()


@query(b() + "select row_id, submission_id, forecaster from b where not exists (select 1 from model_outputs m where m.event_ticker is not distinct from b.event_ticker and m.submission_id is not distinct from b.submission_id)")
def exclude_test_set(spark, sf_dir):
    return selection.exclude_pairs(scores(spark, sf_dir), read(spark, sf_dir, "model_outputs")).select(_KEY)


# --- weights and windows -----------------------------------------------------

_TIME_RANK = "tr as (select row_id, forecaster, event_ticker, round, rank() over (partition by forecaster, event_ticker order by round desc) + (count(*) over (partition by forecaster, event_ticker, round) - 1) / 2.0 - 1 time_rank from fx)"


@query(fx(_TIME_RANK) + "select row_id, round(cast(time_rank as double), 6) time_rank from tr")
def time_rank(spark, sf_dir):
    return weights.with_time_rank(forecasts(spark, sf_dir)).select("row_id", six("time_rank"))


@query(fx(_TIME_RANK) + "select row_id, round(exp(-0.1::double * time_rank), 6) weight from tr")
def exp_weighting(spark, sf_dir):
    return weights.exponential(0.1)(weights.with_time_rank(forecasts(spark, sf_dir))).select("row_id", six("weight"))


def _nth_sql(order: str) -> str:
    return fx() + f"select row_id, case when row_number() over (partition by forecaster, event_ticker order by round {order}, row_id) <= 2 then 1.0::double else 0.0::double end weight from fx"


@query(_nth_sql(""))
def first_n_weighting(spark, sf_dir):
    return weights.first_n(2, ["row_id"])(forecasts(spark, sf_dir)).select("row_id", "weight")


@query(_nth_sql("desc"))
def last_n_weighting(spark, sf_dir):
    return weights.last_n(2, ["row_id"])(forecasts(spark, sf_dir)).select("row_id", "weight")


# --- splits and samples ------------------------------------------------------


def _split_sql(draw: str) -> str:
    return fx("sizes as (select event_ticker, count(*) n from fx group by 1)", f"run as (select event_ticker, n, sum(n) over (order by {draw}, event_ticker rows between unbounded preceding and current row) - n before from sizes)") + "select event_ticker, case when before < floor((select count(*) from fx) * 0.1::double) then 'test' else 'train' end split, n n_rows from run"


def _split(spark, sf_dir, seed):
    return sampling.split_by_event(forecasts(spark, sf_dir), 0.1, seed).groupBy("event_ticker", "split").agg(F.count(F.lit(1)).alias("n_rows"))


@query(_split_sql("md5('42|' || event_ticker)"))
def train_test_split(spark, sf_dir):
    return _split(spark, sf_dir, 42)


@query(_split_sql("n"))
def split_deterministic(spark, sf_dir):
    return _split(spark, sf_dir, -1)


_DRAWN = ["drawn as (select *, case when category in ('BUILDING', 'MACHINERY') then category else 'Other' end cat, md5('42|' || row_id) draw from one)",
          "capped as (select * from (select *, row_number() over (partition by event_ticker order by draw, row_id) rn from drawn) where rn <= 3)",
          "ranked as (select *, row_number() over (partition by cat order by draw, row_id) place from capped)"]


@query(fx("one as (select distinct row_id, event_ticker, category from fx)", *_DRAWN) + "select row_id, event_ticker, category from ranked where place <= case cat when 'BUILDING' then 300 when 'MACHINERY' then 200 else 100 end")
def category_sampler(spark, sf_dir):
    rows = forecasts(spark, sf_dir).select("row_id", "event_ticker", "category").distinct()
    return sampling.category_sample(rows, {"BUILDING": 300, "MACHINERY": 200}, "row_id", 3, other=100, seed=42)


@query("with c as (select category, count(*) n from submissions group by 1) select category, n, round(n / sum(n) over (), 6) share from c qualify n / sum(n) over () >= 0.01")
def category_distribution(spark, sf_dir):
    return sampling.category_distribution(read(spark, sf_dir, "submissions")).select("category", "n", six("share"))


def _assigned_sql(drawn: str) -> str:
    return b("sz as (select floor(count(*) * 0.3::double) k from b)") + drawn


_ORDER = "select row_id, row_number() over (order by md5('{}|' || row_id), row_id) p from b"


@query(_assigned_sql(" union all ".join(f"select row_id, 'model-{m}' augmenter from ({_ORDER.format(2025 + i)}), sz where p <= k" for i, m in enumerate("ab"))))
def model_assignment(spark, sf_dir):
    return sampling.assign_random(scores(spark, sf_dir), ["model-a", "model-b"], 0.3, "row_id", True, 2025).select("row_id", "augmenter")


@query(_assigned_sql(f"select row_id, case when p <= k then 'model-a' else 'model-b' end augmenter from ({_ORDER.format(2025)}), sz where p <= 2 * k"))
def model_assignment_disjoint(spark, sf_dir):
    return sampling.assign_random(scores(spark, sf_dir), ["model-a", "model-b"], 0.3, "row_id", False, 2025).select("row_id", "augmenter")


@query(b() + "select row_id, unnest(['model-a', 'model-b']) augmenter from b")
def model_assignment_repetitive(spark, sf_dir):
    return sampling.assign_repetitive(scores(spark, sf_dir), ["model-a", "model-b"]).select("row_id", "augmenter")


# --- snapshots and joins -----------------------------------------------------

_CANON = ["canon as (select distinct v.event_ticker, market_title from vm v join (select event_ticker, min(created_at) created_at from vm group by 1) f on v.event_ticker = f.event_ticker and v.created_at = f.created_at)",
          "held as (select v.event_ticker, v.created_at, count(*) n, sum(yes_ask) yes_sum from vm v join canon c on v.event_ticker = c.event_ticker and v.market_title = c.market_title group by v.event_ticker, v.created_at)",
          "sizes as (select event_ticker, count(*) wanted from canon group by 1)",
          "complete as (select h.* from held h join sizes using (event_ticker) where n = wanted)"]


@query(mk() + "select event_ticker, market_title, created_at, yes_ask, no_ask, liquidity from vm")
def valid_market_rows(spark, sf_dir):
    return markets(spark, sf_dir).filter(ingest.valid_market()).select("event_ticker", "market_title", "created_at", "yes_ask", "no_ask", "liquidity")


@query(mk(*_CANON) + "select event_ticker, string_agg(market_title, ',' order by market_title) titles from canon group by 1")
def canonical_markets(spark, sf_dir):
    rows = ingest.canonical_markets(markets(spark, sf_dir).filter(ingest.valid_market()))
    return rows.select("event_ticker", F.array_join("titles", ",").alias("titles"))


def _complete(spark, sf_dir):
    rows = markets(spark, sf_dir).filter(ingest.valid_market())
    return ingest.complete_snapshots(rows, ingest.canonical_markets(rows), "event_id")


@query(mk(*_CANON) + "select event_ticker, created_at, n n_markets, yes_sum from complete")
def complete_snapshots(spark, sf_dir):
    total = F.aggregate(F.map_values("market_data"), F.lit(0.0), lambda a, x: a + x["yes_ask"])
    return _complete(spark, sf_dir).select("event_ticker", "created_at", F.size("market_data").cast("long").alias("n_markets"), total.alias("yes_sum"))


@query(mk(*_CANON) + "select event_ticker, created_at, row_number() over (partition by event_ticker order by created_at) - 1 round from complete")
def snapshot_round(spark, sf_dir):
    return ingest.with_round(_complete(spark, sf_dir)).select("event_ticker", "created_at", F.col("round").cast("long").alias("round"))


_TIMES = "times as (select distinct submission_id, event_ticker, snapshot_time, round, title from submissions)"


@query(f"with {_TIMES}, p as (select distinct prediction_id, submission_id, forecaster from predictions) select p.prediction_id, p.forecaster, t.event_ticker, t.round, t.snapshot_time from p join times t using (submission_id)")
def prediction_snapshot_join(spark, sf_dir):
    predictions = read(spark, sf_dir, "predictions").select("prediction_id", "submission_id", "forecaster").distinct()
    times = read(spark, sf_dir, "submissions").select("submission_id", "event_ticker", "snapshot_time", "round").distinct()
    return predictions.join(times, "submission_id").select("prediction_id", "forecaster", "event_ticker", "round", "snapshot_time")


@query("select distinct prediction_id, forecaster, event_ticker from predictions where created_at > timestamp '2025-06-01' and created_at < timestamp '2026-01-01' and forecaster like 'agent-%'")
def prediction_scan(spark, sf_dir):
    rows = ingest.scan_predictions(read(spark, sf_dir, "predictions"), "2025-06-01 00:00:00", "2026-01-01 00:00:00", True)
    return rows.select("prediction_id", "forecaster", "event_ticker").distinct()


def _first(rows: DataFrame, key: str) -> DataFrame:
    """One row for each key: the first by all columns in the order of their names."""
    return selection.first_of(rows, [key], sorted(rows.columns))


def _first_sql(table: str, key: str, columns: list[str]) -> str:
    return f"select {', '.join(columns)} from (select *, row_number() over (partition by {key} order by {', '.join(f'{c} nulls first' for c in sorted(columns))}) rn from {table}) where rn = 1"


_PREDICTION_COLUMNS = ["prediction_id", "submission_id", "forecaster", "event_ticker", "title", "round", "prediction", "created_at"]
_SUBMISSION_COLUMNS = ["submission_id", "event_ticker", "title", "round", "snapshot_time", "close_time", "market_data", "market_outcome", "category"]
_OUTPUT_COLUMNS = ["output_id", "model", "event_ticker", "submission_id", "market_outcome", "think", "content"]


def _by_market(name: str, rows: str, json: str, value: str, scalar: str | None = None) -> str:
    """``name(id, names, vals)``: the values of each record ordered by market, the last of repeated ones; records with unnamed elements are left out."""
    one = f"case when json_type(e.value) = 'OBJECT' then {value}{f' else ({scalar})' if scalar else ''} end"
    return f"""{name}_l as (select id, {elements(json, 'market').replace("else el->>'$'", "")} l from {rows}),
 {name}_u as (select id, i, l[i].key k, l[i] e from {name}_l, unnest(generate_series(1, len(l))) s(i)),
 {name}_v as (select id, k, i, try_cast({one} as double) v from {name}_u),
 {name}_w as (select id, k, v from {name}_v where id not in (select id from {name}_v where k is null) qualify row_number() over (partition by id, k order by i desc) = 1),
 {name} as (select id, list(k order by k) names, list(v order by k) vals from {name}_w group by id)"""


_DOLLAR = "e.value->>'$'"
_READ = f"""with {loose('pj', _first_sql('predictions', 'prediction_id', _PREDICTION_COLUMNS), 'prediction')},
 {loose('mj', _first_sql('submissions', 'submission_id', _SUBMISSION_COLUMNS), 'market_data')},
 {loose('oj', _first_sql('submissions', 'submission_id', _SUBMISSION_COLUMNS), 'market_outcome')},
 pr as (select prediction_id id, case when json_type(j->'prediction') in ('OBJECT', 'ARRAY') then j->'prediction' else j end->'probabilities' pj from pj where json_type(j) = 'OBJECT'),
 {_by_market('p', 'pr', 'pj', "e.value->>'probability'", _DOLLAR)},
 mr as (select submission_id id, j from mj where j is not null), {_by_market('a', 'mr', 'j', "e.value->>'yes_ask'")},
 os as (select submission_id id, j from oj where json_type(j) = 'OBJECT'), {_by_market('o', 'os', 'j', "null", _DOLLAR)},
 nulls as (select 1)"""
_SCORED_SQL = "case when len(list_filter(p.vals, lambda v: v is null)) + len(list_filter(o.vals, lambda v: v is null)) > 0 then null else list_sum(list_transform(list_zip(p.vals, o.vals), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) / len(p.vals) end"


@query(f"""{_READ},
 f as (select l.forecaster, l.submission_id, l.event_ticker, l.round, {_SCORED_SQL} s from pj l join mj r on l.event_ticker = r.event_ticker and l.round = r.round
  join p on p.id = l.prediction_id join a on a.id = r.submission_id join o on o.id = r.submission_id where len(p.vals) = len(a.vals) and len(p.vals) = len(o.vals))
 select forecaster, event_ticker, submission_id, round, rank() over (partition by forecaster, event_ticker order by round desc) + (count(*) over (partition by forecaster, event_ticker, round) - 1) / 2.0e0 - 1 time_rank, round(s, 9) brier_score from f""")
def forecasts_from_json(spark, sf_dir):
    """Predictions and submissions parsed and merged into vectors, with time ranks."""
    rows = ingest.parse_and_merge(_first(read(spark, sf_dir, "predictions"), "prediction_id"), _first(read(spark, sf_dir, "submissions"), "submission_id"))
    return metrics.with_brier(rows).select("forecaster", "event_ticker", "submission_id", "round", "time_rank", nine("brier_score"))


_MARKET_SCORES = f"""{_READ}, named as (select o.id, o.vals, list_transform(o.names, lambda n: list_extract(a.vals, list_position(a.names, n)) / 100) prices from o left join a using (id)),
 ms as (select id submission_id, case when len(list_filter(prices, lambda v: v is null)) + len(list_filter(vals, lambda v: v is null)) > 0 or prices is null then null else list_sum(list_transform(list_zip(prices, vals), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) / len(vals) end s from named)"""


def _market_scores(spark, sf_dir) -> DataFrame:
    rows = _first(read(spark, sf_dir, "submissions"), "submission_id")
    parsed = rows.select("submission_id", "event_ticker", text.read_prices(F.col("market_data")).alias("prices"), text.read_outcome(F.col("market_outcome")).alias("outcome"))
    return parsed.select("submission_id", "event_ticker", metrics.market_brier(F.col("prices"), F.col("outcome")).alias("brier_score"))


@query(f"{_MARKET_SCORES} select submission_id, event_ticker, round(s, 9) brier_score from oj left join ms using (submission_id)")
def market_brier_scores(spark, sf_dir):
    """What the market itself scored, by submission."""
    return _market_scores(spark, sf_dir).select("submission_id", "event_ticker", nine("brier_score"))


@query(f"{_MARKET_SCORES}, s as (select event_ticker, s from oj join ms using (submission_id) where s is not null) select count(*) n_valid, round(avg(s), 6) mean_score, (select round(avg(m), 6) from (select avg(s) m from s group by event_ticker)) event_mean_score, (select count(*) from (select distinct event_ticker from s)) n_events from s")
def market_brier_summary(spark, sf_dir):
    return metrics.event_mean(_market_scores(spark, sf_dir)).select("n_valid", six("mean_score"), six("event_mean_score"), "n_events")


def _database(spark, sf_dir) -> dict[str, DataFrame]:
    """Raw tables as a database holds them: each user's day is a snapshot with a submission by one agent; users with an outcome are known events."""
    number = F.substring("event_ticker", 2, 20).cast("long")
    rows = markets(spark, sf_dir).withColumn("created_at", (F.col("created_at").cast("timestamp") + F.make_dt_interval(secs=number)).cast("timestamp_ntz"))
    ids = rows.select("event_ticker", "created_at").distinct().select(F.concat_ws("/", "event_ticker", F.date_format("created_at", "yyyyMMdd")).alias("submission_id"), "event_ticker", F.col("created_at").alias("snapshot_time"))
    outcome = F.when(number % 3 != 0, F.lit('{"click": 1}'))
    events = rows.select("event_ticker").distinct().select("event_ticker", F.lit("t").alias("title"), outcome.alias("market_outcome"), F.lit("c").alias("category"), F.lit(None).cast("string").alias("close_time"))
    predictions = ids.select("submission_id", "event_ticker", F.lit("agent-1").alias("forecaster"), F.lit("{}").alias("prediction"), F.col("snapshot_time").alias("created_at"))
    return {"predictions": predictions, "submissions": ids.drop("event_ticker"), "markets": rows, "events": events}


@query(mk("known as (select * from vm where cast(substring(event_ticker, 2) as bigint) % 3 != 0)", *[c.replace(" vm ", " known ") for c in _CANON]) + "select concat(event_ticker, '/', strftime(created_at, '%Y%m%d')) submission_id, event_ticker, row_number() over (partition by event_ticker order by created_at) - 1 round, n n_markets from complete")
def rounds_from_database(spark, sf_dir):
    """Raw tables through rounds and snapshots to predictions and submissions."""
    tables = ingest.load(**_database(spark, sf_dir), agents_only=True)
    markets_of = F.size(F.from_json("market_data", "map<string, string>")).cast("long")
    sizes = tables["submissions"].select("submission_id", markets_of.alias("n_markets"))
    return tables["predictions"].join(sizes, "submission_id").select("submission_id", "event_ticker", F.col("round").cast("long").alias("round"), "n_markets")


_SRC = "pairs as (select distinct concat('O', cast(l_orderkey as varchar)) submission_id, l_partkey from lineitem), src as (select distinct submission_id, p_name url, p_type summary, p_brand contributor, p_name title from pairs join part on l_partkey = p_partkey)"


@query(f"with {_SRC} select submission_id, count(*) n_sources, string_agg(concat_ws('|', url, summary, title), ';' order by url, summary, contributor, title) sources from src group by 1")
def sources_agg(spark, sf_dir):
    usage = read(spark, sf_dir, "lineitem").select(F.concat(F.lit("O"), "l_orderkey").alias("submission_id"), F.col("l_partkey").alias("source_id"))
    parts = read(spark, sf_dir, "part").select(F.col("p_partkey").alias("source_id"), F.col("p_name").alias("url"), F.col("p_type").alias("summary"), F.col("p_brand").alias("contributor"), F.col("p_name").alias("title"))
    rows = enrich.without_contributor(enrich.aggregate_sources(usage, parts))
    return rows.select("submission_id", F.size("sources").cast("long").alias("n_sources"), F.array_join(F.transform("sources", lambda s: F.concat_ws("|", s["url"], s["summary"], s["title"])), ";").alias("sources"))


@query(b("p as (select distinct submission_id, forecaster, prediction from predictions where prediction is not null)", "i as (select distinct event_ticker, title, category, rules from event_info)") + "select row_id, coalesce(title, '') title, coalesce(category, '') category, coalesce(rules, '') rules, prediction from b join p using (submission_id, forecaster) left join i using (event_ticker)")
def enrich_chain(spark, sf_dir):
    predictions = read(spark, sf_dir, "predictions").select("submission_id", "forecaster", "prediction").distinct()
    events = read(spark, sf_dir, "event_info").select("event_ticker", "title", "category", "rules").distinct()
    rows = enrich.with_event_details(enrich.with_predictions(scores(spark, sf_dir), predictions), events)
    return rows.select("row_id", "title", "category", "rules", "prediction")


# --- analysis ----------------------------------------------------------------


def _sweep_sql(name: str, rows: str, kept: str, values) -> str:
    return " union all ".join(f"select '{name}' parameter, {float(v)}::double \"value\", count(*) n_rows, count(distinct event_ticker) n_events from {rows} where {kept.format(float(v))}" for v in values)


@query(b(*_Z) + _sweep_sql("min_z", "z", "z_score < -({}::double) and brier_score <= 0.15", analyze.Z_VALUES))
def sweep_z(spark, sf_dir):
    return analyze.sweep_z(scores(spark, sf_dir), METRIC, "row_id", min_val=0.15)


@query(b(*_AMB, "ar as (select b.* from b join amb_g using (submission_id))") + _sweep_sql("min_val", "ar", "brier_score < {}::double", analyze.AMBIGUOUS_VALUES))
def sweep_ambiguous(spark, sf_dir):
    return analyze.sweep_ambiguous(scores(spark, sf_dir), METRIC, "row_id")


@query(b(*_Z, *_AMB, _COMBINED, "u as (select distinct forecaster, event_ticker, submission_id, round from tagged)", "n as (select 'z_score' \"filter\", count(*) n_rows from tagged where part = 0 union all select 'ambiguous', count(*) from tagged where part = 1 union all select 'union', count(*) from u)") + "select \"filter\", n_rows, cast(floor(n_rows * 2 * 0.6::double) as bigint) n_traces from n where n_rows > 0")
def estimate_traces(spark, sf_dir):
    rows = scores(spark, sf_dir).filter("forecaster is not null")
    return analyze.estimate_traces(rows, METRIC, "row_id", 2, 0.6, z={"min_z": 1.5, "min_val": 0.15}, amb={"top_k": 3})


_COLUMNS = {"event_ticker": "string", "title": "string", "markets": "string", "market_outcome": "string", "category": "string", "close_time": "timestamp_ntz", "rules": "string"}


@query(" union all ".join(f"select '{c}' \"column\", '{t}' dtype, count({c}) non_null, count(*) - count({c}) nulls from event_info" for c, t in _COLUMNS.items()))
def describe_schema(spark, sf_dir):
    return analyze.describe_schema(read(spark, sf_dir, "event_info"))


@query("select concat('code-', cast(json_extract(props, '$.k') as int) % 7) error_type, count(*) n from events where event_type = 'error' group by 1")
def error_summary(spark, sf_dir):
    kind = F.when(F.col("event_type") == "error", F.concat(F.lit("code-"), F.get_json_object("props", "$.k").cast("int") % 7))
    return analyze.error_summary(read(spark, sf_dir, "events").withColumn("error_type", kind))


# --- texts -------------------------------------------------------------------

_FIELDS = text.RATIONALE_FIELDS


def _replaced(expression: str) -> str:
    for phrase in text.GIVEAWAYS:
        expression = f"replace({expression}, '{phrase}', '{text.REPLACEMENT}')"
    return expression


def _injected_sql(f: str) -> str:
    """Some rows get the phrases, in the same way in both engines."""
    return f"case when aug_id % 5 = 0 then concat(augmented_rationale.{f}, ' See the original rationale.') when aug_id % 7 = 0 then concat(augmented_rationale.{f}, ' Mind the leakage.') else augmented_rationale.{f} end"


_AUG = "a as (select distinct aug_id, " + ", ".join(f"{_injected_sql(f)} {f}" for f in _FIELDS) + ", title from augmented_reasoning where augmented_rationale is not null)"
_KEPT = "k as (select * from a where not (" + " or ".join(f"coalesce(contains({f}, 'leakage'), false)" for f in _FIELDS) + "))"


def _augmented(spark, sf_dir) -> DataFrame:
    extra = F.when(F.col("aug_id") % 5 == 0, " See the original rationale.").when(F.col("aug_id") % 7 == 0, " Mind the leakage.").otherwise("")
    struct = F.struct(*(F.concat(F.col(f"augmented_rationale.{f}"), extra).alias(f) for f in _FIELDS))
    rows = read(spark, sf_dir, "augmented_reasoning").select("aug_id", "title", F.when(F.col("augmented_rationale").isNotNull(), struct).alias("augmented_rationale"))
    return rows.distinct()


@query(f"with {_AUG}, {_KEPT} select aug_id from k")
def leakage_filter(spark, sf_dir):
    return text.clean_rationales(_augmented(spark, sf_dir)).select("aug_id")


@query(f"with {_AUG}, {_KEPT} select aug_id, " + ", ".join(f"{_replaced(f)} {f}" for f in _FIELDS) + " from k")
def replace_phrases(spark, sf_dir):
    return text.clean_rationales(_augmented(spark, sf_dir)).select("aug_id", *(F.col(f"augmented_rationale.{f}").alias(f) for f in _FIELDS))


_ANSWER = "concat('<think>\n', concat_ws('\n\n', {}), '\n</think>\n<probabilities>\n', '{{}}', '\n</probabilities>')".format(", ".join(_replaced(f) for f in _FIELDS))


@query(f"with {_AUG}, {_KEPT} select aug_id, 3::bigint n_messages, 'assistant' last_role, md5({_ANSWER}) answer from k where " + " and ".join(f"{f} is not null" for f in _FIELDS))
def sft_messages(spark, sf_dir):
    rows = text.clean_rationales(_augmented(spark, sf_dir))
    rows = rows.withColumn("answer", text.assistant_text(F.col("augmented_rationale"), F.lit("{}"))).filter("answer is not null")
    rows = rows.withColumn("messages", text.chat(F.lit("system text"), F.col("title"), F.col("answer")))
    last = F.element_at("messages", -1)
    return rows.select("aug_id", F.size("messages").cast("long").alias("n_messages"), last["role"].alias("last_role"), F.md5(last["content"]).alias("answer"))


_PRICES = ", ".join(f"""'"{x}":' || cast(try_cast(e.value->>'{x}' as double) as varchar)""" for x in text.PRICE_FIELDS)
_SOURCE_ROWS = "select submission_id, min(sources) sources from sampled_rows where submission_id is not null and sources is not null group by 1"
_RL_SQL = f"""with {loose('mj', _first_sql('submissions', 'submission_id', _SUBMISSION_COLUMNS), 'market_data')},
 {loose('oj', _first_sql('submissions', 'submission_id', _SUBMISSION_COLUMNS), 'market_outcome')},
 {loose('sj', _SOURCE_ROWS, 'sources')},
 ml as (select submission_id, {elements('j', 'market').replace("else el->>'$'", "")} l from mj where j is not null),
 mu as (select submission_id, i, l[i] e from ml, unnest(generate_series(1, len(l))) s(i)),
 mt as (select submission_id, '{{' || string_agg(to_json(e.key) || ':{{' || concat_ws(',', {_PRICES}) || '}}', ',' order by i) || '}}' prices from mu group by 1),
 st as (select submission_id, string_agg('[' || i || '] ' || coalesce(l[i]->>'title', '') || ': ' || coalesce(l[i]->>'summary', ''), chr(10) order by i) lines
  from (select submission_id, cast(case when json_type(j->'sources') = 'ARRAY' then j->'sources' else j end as json[]) l from sj where json_type(j) = 'ARRAY' or json_type(j->'sources') = 'ARRAY'), unnest(generate_series(1, len(l))) s(i) group by 1),
 u as (select o.submission_id, o.event_ticker, 'Event: ' || coalesce(o.title, '') || chr(10) || 'Possible outcomes: ' || array_to_string(coalesce(json_keys(o.j), []), ', ') || chr(10) || chr(10) || 'Sources:' || chr(10) || coalesce(lines, '')
  || case when length(coalesce(prices, '')) > 2 then chr(10) || chr(10) || 'Market prices:' || chr(10) || prices else '' end || chr(10) || chr(10) || 'Give your reasoning, then your probabilities.' t from oj o left join mt using (submission_id) left join st using (submission_id))"""


def _problems(spark, sf_dir) -> DataFrame:
    """The prompt of each submission from its title, outcomes, sources and prices."""
    rows = _first(read(spark, sf_dir, "submissions"), "submission_id").select("submission_id", "event_ticker", "title", text.read_outcome(F.col("market_outcome")).alias("market_outcome"), text.read_prices(F.col("market_data")).alias("market_data"))
    sources = read(spark, sf_dir, "sampled_rows").filter("submission_id is not null and sources is not null").groupBy("submission_id").agg(F.min("sources").alias("sources"))
    told = sources.select("submission_id", text.read_sources(F.col("sources")).alias("sources"))
    joined = rows.join(told, "submission_id", "left")
    outcomes = F.coalesce(F.array_join(F.map_keys("market_outcome"), ", "), F.lit(""))
    return joined.withColumn("prompt", text.user_prompt(F.coalesce("title", F.lit("")), outcomes, F.coalesce(text.sources_text(F.col("sources")), F.lit("")), F.to_json("market_data")))


@query(f"{_RL_SQL} select submission_id, event_ticker, 2::bigint n_messages, md5(t) user_text from u")
def rl_messages(spark, sf_dir):
    """Chats without an answer, with the outcomes, sources and prices of each submission."""
    rows = _problems(spark, sf_dir).withColumn("messages", text.chat(F.lit("system text"), F.col("prompt")))
    return rows.select("submission_id", "event_ticker", F.size("messages").cast("long").alias("n_messages"), F.md5(F.col("messages")[1]["content"]).alias("user_text"))


def _shout(messages: list[dict]) -> dict:
    """Stands for a model: answers with the prompt's last part, and fails for some prompts."""
    if len(messages[-1]["content"]) % 17 == 0:
        raise ValueError("could not parse")
    return {"content": messages[-1]["content"][-30:].upper(), "reasoning": messages[0]["role"]}


_ANSWERED = "case when length(t) % 17 = 0 then null else upper(right(t, 30)) end content, case when length(t) % 17 = 0 then null else 'system' end reasoning, case when length(t) % 17 = 0 then 'parse_error' end error_type from u"


@query(f"{_RL_SQL} select submission_id, {_ANSWERED}")
def evaluate_rows(spark, sf_dir):
    """A model asked once for each submission; failed requests keep their row."""
    rows = _problems(spark, sf_dir).withColumn("messages", text.chat(F.lit("system text"), F.col("prompt"), F.lit("expected")))
    return evaluate(rows, _shout, keep=("submission_id",), retries=0)


@query(f"{_RL_SQL} select unnest(['org/a:1', 'b']) model, submission_id, {_ANSWERED}")
def evaluate_many_models(spark, sf_dir):
    """Two models and one that does not start: its error stops nothing."""
    def broken():
        raise RuntimeError("no server")

    rows = _problems(spark, sf_dir).withColumn("messages", text.chat(F.lit("system text"), F.col("prompt")))
    models = {"org/a:1": lambda: _shout, "down": broken, "b": lambda: _shout}
    return evaluate_models(rows, models, scratch_folder(spark), keep=("submission_id",), retries=0)[0]


@query(f"with o as ({_first_sql('model_outputs', 'output_id', _OUTPUT_COLUMNS)}) select output_id, event_ticker, submission_id, md5(content) content from o")
def pasted_outputs(spark, sf_dir):
    """Ids and outputs side by side by their row number."""
    rows = _first(read(spark, sf_dir, "model_outputs"), "output_id")
    return enrich.paste(rows.select("output_id", "event_ticker", "submission_id"), rows.select("output_id", F.md5("content").alias("content")), "output_id")


@query("""with r as (select distinct event_ticker, submission_id from sampled_rows), t as (select distinct event_ticker, title augmented_title from event_info), e as (select distinct event_ticker, rules from event_info),
 us as (select distinct submission_id, cast(length(title) % 25 as bigint) source_id from submissions where submission_id is not null and title is not null),
 l as (select submission_id, string_agg(concat_ws('|', n_name, n_nationkey, n_regionkey), ';' order by n_name) sources from us join nation on source_id = n_nationkey group by 1)
 select submission_id, event_ticker, augmented_title, rules, coalesce(sources, '') sources from r left join t using (event_ticker) left join e using (event_ticker) left join l using (submission_id)""")
def sampled_with_details(spark, sf_dir):
    """Sampled rows with title, rules and sources; nations stand for the sources."""
    sampled = read(spark, sf_dir, "sampled_rows").select("event_ticker", "submission_id").distinct()
    events = read(spark, sf_dir, "event_info")
    usage = read(spark, sf_dir, "submissions").filter("submission_id is not null and title is not null").select("submission_id", (F.length("title") % 25).cast("long").alias("source_id"))
    sources = read(spark, sf_dir, "nation").select(F.col("n_nationkey").cast("long").alias("source_id"), F.col("n_name").alias("summary"), F.col("n_regionkey").cast("string").alias("title"), F.lit(None).cast("double").alias("popularity_score"), F.lit(None).cast("string").alias("url"))
    rows = enrich.sampled_with_details(sampled, events.select("event_ticker", F.col("title").alias("augmented_title")), events, usage, sources)
    listed = F.from_json("sources", "array<struct<summary: string, source_id: string, title: string>>")
    return rows.withColumn("sources", F.array_join(F.transform(listed, lambda s: F.concat_ws("|", s["summary"], s["source_id"], s["title"])), ";"))


@query(f"with {_AUG}, {_KEPT} select aug_id, 2::bigint n_messages, 'user' last_role from k where " + " and ".join(f"{f} is not null" for f in _FIELDS))
def strip_assistant(spark, sf_dir):
    rows = text.clean_rationales(_augmented(spark, sf_dir))
    rows = rows.withColumn("answer", text.assistant_text(F.col("augmented_rationale"), F.lit("{}"))).filter("answer is not null")
    messages = text.without_assistant(text.chat(F.lit("system text"), F.col("title"), F.col("answer")))
    return rows.select("aug_id", F.size(messages).cast("long").alias("n_messages"), F.element_at(messages, -1)["role"].alias("last_role"))


@query("with o as (select distinct output_id, think, content from model_outputs where think is not null and content is not null) select output_id, regexp_replace(think, '^[ \\t\\n\\r]+|[ \\t\\n\\r]+$', '', 'g') = '' empty_think, md5(regexp_replace(content, '^\\s+|\\s+$', '', 'g')) content from o")
def split_thinking(spark, sf_dir):
    rows = read(spark, sf_dir, "model_outputs").filter("think is not null and content is not null").select("output_id", "think", "content").distinct()
    thinking, content = text.split_thinking(F.concat(F.lit("<think>"), F.col("think"), F.lit("</think>"), F.col("content")))
    return rows.select("output_id", (F.trim(F.regexp_replace(thinking, r"[ \t\n\r]+", " ")) == "").alias("empty_think"), F.md5(content).alias("content"))


_BLOCK = r"""with o as (select distinct output_id, content from model_outputs where content is not null),
 x as (select output_id, content, regexp_extract(content, '<probabilities>([^\n]*)</probabilities>', 1) inl from o)
 select output_id, md5(regexp_replace(case when length(inl) > 0 then inl when contains(content, '</probabilities>') then regexp_replace(split_part(content, '</probabilities>', 1), '^.*<probabilities>', '', 's') else content end, '^\s+|\s+$', '', 'g')) block from x"""


@query(_BLOCK)
def parse_probabilities(spark, sf_dir):
    rows = read(spark, sf_dir, "model_outputs").filter("content is not null").select("output_id", "content").distinct()
    return rows.select("output_id", F.md5(text.tagged_probabilities(F.col("content"))).alias("block"))


_STRIPPED = r"regexp_replace({}, '^\s+|\s+$', '', 'g')"
_OUTPUT_SCORES = f"""with mo as ({_first_sql('model_outputs', 'output_id', _OUTPUT_COLUMNS)}),
 x as (select *, case when contains(content, '</think>') then {_STRIPPED.format("substr(content, strpos(content, '</think>') + 8)")} else {_STRIPPED.format('content')} end c from mo),
 y as (select *, regexp_extract(c, '<probabilities>([^\\n]*)</probabilities>', 1) inl from x),
 z as (select *, {_STRIPPED.format("case when length(inl) > 0 then inl when contains(c, '</probabilities>') then regexp_replace(split_part(c, '</probabilities>', 1), '^.*<probabilities>', '', 's') else c end")} block from y),
 {loose('bj', 'select output_id, block from z', 'block')}, {loose('oj', 'select output_id, market_outcome from mo', 'market_outcome')},
 br as (select output_id id, case when json_type(j->'probabilities') in ('OBJECT', 'ARRAY') then j->'probabilities' else j end j from bj where json_type(j) in ('OBJECT', 'ARRAY')),
 {_by_market('p', 'br', 'j', "e.value->>'probability'", _DOLLAR)},
 os as (select output_id id, j from oj where json_type(j) = 'OBJECT'), {_by_market('o', 'os', 'j', "null", _DOLLAR)},
 whole as (select * from p where len(list_filter(vals, lambda v: v is null)) = 0),
 named as (select o.id, o.vals o, list_transform(o.names, lambda n: coalesce(list_extract(w.vals, list_position(w.names, n)), 0)) p from o join whole w using (id)),
 sc as (select id output_id, case when len(list_filter(o, lambda v: v is null or v not in (0, 1))) + len(list_filter(p, lambda v: v < 0 or v > 1)) = 0 then list_sum(list_transform(list_zip(p, o), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) / len(o) end s from named)"""


@query(f"{_OUTPUT_SCORES} select output_id, model, event_ticker, submission_id, round(s, 9) brier_score from mo left join sc using (output_id)")
def score_model_outputs(spark, sf_dir):
    """Brier scores of model outputs, null where no probabilities can be read."""
    rows = _first(read(spark, sf_dir, "model_outputs"), "output_id")
    return score_outputs(rows).select("output_id", "model", "event_ticker", "submission_id", nine("brier_score"))


@query(f"{_OUTPUT_SCORES}, g as (select model, event_ticker, submission_id, s from mo join sc using (output_id) where s is not null and model is not null), e as (select model, event_ticker, avg(s) m from g group by all) select model, count(*) n, round(avg(s), 6) mean, round(median(s), 6) median, any_value(em) event_mean, any_value(ed) event_median from g join (select model, round(avg(m), 6) em, round(median(m), 6) ed from e group by model) using (model) group by model")
def score_summary_by_model(spark, sf_dir):
    """Summary of the scores of each model's outputs."""
    rows = score_outputs(_first(read(spark, sf_dir, "model_outputs"), "output_id"))
    return metrics.score_summary(rows, ["model"]).select("model", "n", six("mean"), six("median"), six("event_mean"), six("event_median"))


_OUTCOME_LIST = f"case json_type(j) when 'ARRAY' then array_to_string(cast(j as varchar[]), ', ') when 'OBJECT' then array_to_string(json_keys(j), ', ') else '{text.NO_OUTCOME}' end"
_TITLE_SQL = f"with {loose('i', 'select distinct event_ticker, title, rules, markets from event_info where title is not null', 'markets')}, u as (select *, concat('Title: ', title, chr(10), 'Rules: ', coalesce(rules, ''), chr(10), 'Outcomes: ', {_OUTCOME_LIST}, chr(10), chr(10), 'Write a title that can be understood without the rules and outcomes.') t from i)"


def _title_prompts(spark, sf_dir) -> DataFrame:
    rows = read(spark, sf_dir, "event_info").filter("title is not null").select("event_ticker", "title", "rules", "markets").distinct()
    return rows.withColumn("prompt", TITLE.column(raw=F.col("title"), rules=F.coalesce("rules", F.lit("")), outcome=text.market_list_text(F.coalesce("markets", F.lit("")))))


@query(f"{_TITLE_SQL} select event_ticker, md5(t) prompt from u")
def title_prompts(spark, sf_dir):
    return _title_prompts(spark, sf_dir).select("event_ticker", F.md5("prompt").alias("prompt"))


@query("select event_ticker, substring(md5(concat(title, rules)), 1, 8) prompt_hash from (select distinct event_ticker, title, rules from event_info where title is not null and rules is not null)")
def prompt_hashes(spark, sf_dir):
    rows = read(spark, sf_dir, "event_info").filter("title is not null and rules is not null").select("event_ticker", "title", "rules").distinct()
    return rows.select("event_ticker", text.prompt_hash(F.col("title"), F.col("rules")).alias("prompt_hash"))


def _echo(system: str, user: str) -> dict:
    """Stands for an external model: answers with a struct, and fails for some prompts."""
    if len(user) % 17 == 0:
        raise ValueError("parse error in the answer")
    return {"source_analysis": user[:20], "market_analysis": user[20:40], "rationale": user[40:80]}


@query(f"{_TITLE_SQL} select event_ticker, title, regexp_replace(regexp_replace(trim('\"' || split_part(title, chr(10), 1) || '\"'), '^\\s*<event>\\s*|\\s*</event>\\s*$', '', 'g'), '^[\"'']+|[\"'']+$', '', 'g') augmented_title from u")
def llm_title_augment(spark, sf_dir):
    answered = ask(_title_prompts(spark, sf_dir), lambda system, user: f'"{user.splitlines()[0][7:]}"', TITLE.system)
    return answered.select("event_ticker", "title", text.clean_title(F.col("answer")).alias("augmented_title"))


_REASON_SQL = f"""{_RL_SQL}, a as (select aug_id, submission_id, title, original_rationale from ({_first_sql('augmented_reasoning', 'aug_id', ['aug_id', 'submission_id', 'title', 'original_rationale'])})),
 q as (select aug_id, 'Event: ' || coalesce(title, '') || chr(10) || chr(10) || 'Sources:' || chr(10) || coalesce(lines, '') || chr(10) || chr(10) || 'Market prices: ' || coalesce(prices, '{{}}') || chr(10) || chr(10) || 'Forecast: {{}}' || chr(10) || chr(10) || 'Reasoning so far: ' || original_rationale t from a left join st using (submission_id) left join mt using (submission_id))"""


@query(f"{_REASON_SQL} select aug_id, case when length(t) % 17 > 0 then substr(t, 1, 20) end source_analysis, case when length(t) % 17 > 0 then substr(t, 21, 20) end market_analysis, case when length(t) % 17 > 0 then substr(t, 41, 40) end rationale, case when length(t) % 17 = 0 then 'parse_error' end error_type from q")
def llm_reason_augment(spark, sf_dir):
    """A model's answers to the reasoning prompts of event, sources and prices, and the errors of failed calls."""
    rows = _first(read(spark, sf_dir, "augmented_reasoning").select("aug_id", "submission_id", "title", "original_rationale"), "aug_id")
    details = _problems(spark, sf_dir).select("submission_id", text.sources_text(F.col("sources")).alias("sources"), F.to_json("market_data").alias("market_data"))
    joined = rows.join(details, "submission_id", "left")
    prompt = REASONING.column(event_info=F.concat(F.lit("Event: "), F.coalesce("title", F.lit(""))), sources=F.coalesce("sources", F.lit("")), market_data=F.coalesce("market_data", F.lit("{}")), vanilla_rationale=F.col("original_rationale"), llm_prediction=F.lit("{}"))
    answered = ask(joined.withColumn("prompt", prompt), _echo, REASONING.system, retries=0)
    whole = F.from_json("answer", "struct<source_analysis: string, market_analysis: string, rationale: string>")
    return answered.select("aug_id", *(whole[f].alias(f) for f in _FIELDS), "error_type")
