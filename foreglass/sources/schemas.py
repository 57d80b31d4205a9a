"""Schemas of the base and derived tables as DDL; CSV is never read by inference."""

PREDICTIONS = "prediction_id long, submission_id string, forecaster string, event_ticker string, title string, round int, prediction string"
SUBMISSIONS = "submission_id string, event_ticker string, title string, round int, snapshot_time timestamp_ntz, close_time string, market_data string, market_outcome string, category string"
EVENTS = "event_ticker string, title string, markets string, market_outcome string, category string, close_time timestamp_ntz, rules string"
MARKETS = "event_ticker string, market_title string, created_at timestamp_ntz, yes_ask double, yes_bid double, no_ask double, no_bid double, liquidity double"
SOURCES = "source_id long, url string, summary string, contributor string, title string, popularity_score double"
SOURCE_USAGE = "submission_id string, source_id long"
BRIER_SCORES = "forecaster string, event_ticker string, submission_id string, weight double, round int, brier_score double"
SCORED_OUTPUTS = "event_ticker string, submission_id string, brier_score double"
AUGMENTED_EVENTS = "event_ticker string, title string, augmented_title string"
AUGMENTED_REASONING = "event_ticker string, submission_id string, title string, forecaster string, augmenter string, original_rationale string, augmented_rationale struct<source_analysis: string, market_analysis: string, rationale: string>"
CHAT = "event_ticker string, submission_id string, market_outcome string, messages array<struct<role: string, content: string>>"

BY_NAME = {"predictions": PREDICTIONS, "submissions": SUBMISSIONS, "events": EVENTS, "markets": MARKETS, "sources": SOURCES, "source_usage": SOURCE_USAGE, "brier_scores": BRIER_SCORES, "augmented_events": AUGMENTED_EVENTS, "augmented_reasoning": AUGMENTED_REASONING}
