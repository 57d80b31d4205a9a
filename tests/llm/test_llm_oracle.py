"""Queries against their oracle SQL, and what must hold between those that SQL cannot express."""

from collections import Counter, defaultdict

import pytest
from tokenizers import Tokenizer

from foreglass.llm.oracle import ORACLE
from foreglass.llm.queries import QUERIES
from foreglass.llm.tokens import VOCABULARY
from foreglass.session import scratch
from tests.oracle_check import DATA, assert_equal


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_oracle(spark, name):
    with scratch(spark):
        assert_equal(spark, QUERIES[name], ORACLE[name])


def rows(spark, name):
    with scratch(spark):
        return QUERIES[name](spark, DATA).collect()


def table(spark, name):
    return spark.read.parquet(f"{DATA}/{name}.parquet").collect()


def test_drawn_sample_fits_its_reports(spark):
    drawn, report, margins = (rows(spark, f"p1_{n}") for n in ("sample", "report", "margins"))
    assert Counter(r.category for r in drawn) == {r.category: r.drawn for r in report if r.drawn}
    assert sum(r.drawn for r in margins) == len(drawn) == len({(r.event_ticker, r.submission_id) for r in drawn})
    assert max(Counter(r.event_ticker for r in drawn).values()) <= 5


def test_splits_agree_with_the_bound_tickers(spark):
    split = {r.prediction_id: r.split_name for r in rows(spark, "p2_splits")}
    assert set(split) == {r.prediction_id for r in table(spark, "predictions") if r.prediction_id is not None}
    classes = {r.event_ticker: r["class"] for r in rows(spark, "p2_members")}
    of_class = defaultdict(set)
    for r in table(spark, "predictions"):
        if r.event_ticker and (ticker := r.event_ticker.strip().upper()):
            of_class[classes[ticker]].add(split[r.prediction_id])
    pairs = {(r.event_ticker_a, r.event_ticker_b) for r in rows(spark, "p2_found")}
    assert pairs == {(a, b) for a in classes for b in classes if a < b and classes[a] == classes[b]}
    # a ticker's rows may be bound by others too, but never part
    assert sum(len(s) > 1 for s in of_class.values()) == 0


def test_truncation_rates_count_the_found_rows(spark):
    found, rates = rows(spark, "p3_found"), rows(spark, "p3_rates")
    assert sum(r.n_truncated for r in rates) == len(found) == len({r.output_id for r in found})
    assert all(r.n_truncated == r.n_length + r.n_transfer + r.n_ending for r in rates)
    limits = {r.model for r in rows(spark, "p3_lengths") if r.unit != "transfer"}
    assert {r.model for r in rates if r.n_length} <= limits


def test_every_defect_lies_in_its_row(spark):
    answers = {r.aug_id: r.augmented_rationale for r in table(spark, "augmented_reasoning")}
    found = {(r.aug_id, r.field_name): r.defect for r in rows(spark, "p6_found")}
    fields = ("source_analysis", "market_analysis", "rationale")
    assert {k for k, v in found.items() if v == "empty"} >= {(i, f) for i, a in answers.items() for f in fields if a is None or a[f] is None}
    assert set(found.values()) <= {"empty", "refusal", "copy", "language", "truncated"}


def test_tokens_and_pieces_of_every_document(spark):
    tokenizer = Tokenizer.from_file(VOCABULARY)
    texts = {r.doc_id: r.text or "" for r in table(spark, "documents")}
    ids = {r.doc_id: r.ids for r in rows(spark, "p8_ids")}
    assert ids == {d: tokenizer.encode(t, add_special_tokens=False).ids for d, t in texts.items()}
    pieces = defaultdict(list)
    for r in rows(spark, "p10_pieces"):
        pieces[r.doc_id].append(r)
    assert set(pieces) == {d for d, i in ids.items() if len(i) > 512} == {r.doc_id for r in rows(spark, "p10_found")}
    for d, parts in pieces.items():
        parts.sort(key=lambda r: r.piece)
        assert "".join(texts[d][r.core:r.end] for r in parts) == texts[d]
        assert all(len(tokenizer.encode(r.text, add_special_tokens=False).ids) == r.tokens <= 512 for r in parts)


def test_leaks_share_words_with_their_item(spark):
    texts, items = ({r[0]: set((r.text or "").lower().split()) for r in table(spark, n)} for n in ("documents", "eval_items"))
    found = rows(spark, "p9_found")
    assert found and len(found) == len({(r.doc_id, r.item_id) for r in found})
    assert all(len(texts[r.doc_id] & items[r.item_id]) >= 3 for r in found)
